"""Headline timings: one JSON line. Reads $BENCH_SF_DIR, runs on local[$BENCH_CPUS].

Each figure is the best of BENCH_RUNS runs (default 2). `sequential_*` repeat
the work the way a single-threaded tool does it (one ZIP file, one loop), on
the same files, without Spark.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time
import zipfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
REPLAY_COMMITS = 1000



def sequential_export(table: str, out: str) -> None:
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for directory, _, names in os.walk(table):
            for name in names:
                if not name.startswith(".") and name != "_SUCCESS":
                    path = os.path.join(directory, name)
                    archive.write(path, os.path.relpath(path, table))


def sequential_import(bundle: str, target: str) -> None:
    staging = target + "-staging"
    with zipfile.ZipFile(bundle) as archive:
        archive.extractall(staging)
    shutil.copytree(staging, target)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from lakeship.functions.checksum import table_checksum
    from lakeship.operators import dml, replay, text, write
    from lakeship.plans import apply, export
    from lakeship.queries import register
    from lakeship.sources import log, table

    root = tempfile.mkdtemp(prefix="bench-")
    timings: dict[str, float] = {}

    def timed(name, run, runs=RUNS):
        best, result = None, None
        for k in range(runs):
            start = time.perf_counter()
            result = run(k)
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        timings[name] = round(best, 3)
        return result

    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    changes = lines.select(
        (F.hash("l_orderkey", "l_linenumber") % REPLAY_COMMITS + REPLAY_COMMITS).alias("n"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("name"),
        "l_quantity",
    ).withColumn("version", (F.col("n") % REPLAY_COMMITS).cast("bigint"))
    body = F.struct(F.struct(F.col("name").alias("path"), F.col("l_quantity").cast("bigint").alias("size")).alias("add"))
    logged = changes.select(
        F.format_string("_delta_log/%020d.json", "version").alias("path"), F.to_json(body).alias("value")
    )
    text.write_texts(logged, f"{root}/log")
    timed(
        "replay_1000_commits",
        lambda k: replay.table_detail(
            replay.active_files(replay.file_actions(log.scan_actions(spark, f"{root}/log", 0, 999)))
        ).collect(),
    )

    source = f"{root}/lineitem"
    half = F.col("l_orderkey") % 2
    timed("write_table", lambda k: write.write_table(lines.where(half == 0).repartition(int(CPUS)), f"{source}{k}"))
    source = f"{source}0"
    write.write_table(lines.where(half == 1).repartition(int(CPUS)), source)
    timed("table_update", lambda k: dml.update(spark, source, f"l_orderkey % 100 = {k}", {"l_tax": "0.5"}))
    timed("table_delete", lambda k: dml.delete(spark, source, f"l_orderkey % 100 = {k + 10}"))
    timed("table_read", lambda k: table.read_table(spark, source).agg(F.sum("l_extendedprice")).collect())
    timed("table_checksum", lambda k: table_checksum(table.read_table(spark, source)).collect())
    timed("export_full", lambda k: export.export(spark, source, f"{root}/bundle{k}"))
    timed("import_new", lambda k: apply.import_bundle(spark, f"{root}/bundle0.zip", f"{root}/copy{k}"))
    timed("sequential_export", lambda k: sequential_export(source, f"{root}/sequential{k}.zip"))
    timed("sequential_import", lambda k: sequential_import(f"{root}/sequential0.zip", f"{root}/plain{k}"))
    for name in ("log_actions", "active_files", "manifest_files", "manifest_dvs", "bundle_packing", "latest_version"):
        register.QUERIES[name](spark, SF_DIR).count()
        timed(name, lambda k, name=name: register.QUERIES[name](spark, SF_DIR).count())
    spark.stop()
    headline = ("replay_1000_commits", "export_full", "import_new", "table_checksum")
    print(
        json.dumps(
            {
                "metric": "seconds for " + ", ".join(headline),
                "value": round(sum(timings[n] for n in headline), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
