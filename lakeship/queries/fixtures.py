"""Tables, logs and bundles that the registered queries run on, all made from the given tables.

Each is built once per Spark application and input directory, in the folder
that the cluster shares.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeship import storage
from lakeship.functions.actions import VECTOR
from lakeship.operators import dml, text, write
from lakeship.plans import apply, export
from lakeship.sources import table

_built: dict[tuple, object] = {}


def once(build: Callable) -> Callable:
    @wraps(build)
    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _built:
            _built[key] = build(spark, sf_dir)
        return _built[key]

    return get


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place(spark: SparkSession, label: str) -> str:
    return storage.scratch_dir(spark, label)


# --- E: a commit log made from events ---------------------------------------


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file action per event: version, ts, op, path, size."""
    return given(spark, sf_dir, "events").select(
        "ts",
        F.col("event_id").alias("version"),
        F.when(F.col("event_type") == "error", "remove").otherwise("add").alias("op"),
        F.col("user_id").cast("string").alias("path"),
        (F.col("event_id") % 1000).alias("size"),
    )


def event_commit(spark: SparkSession, sf_dir: str) -> Column:
    """Commit of an event: the hour of its time, counted from midnight of the first day."""
    first = given(spark, sf_dir, "events").agg(F.min("ts").cast("date")).first()[0]
    return F.datediff(F.col("ts").cast("date"), F.lit(first)).cast("bigint") * 24 + F.hour("ts")


def _write_log(lines: DataFrame, root: str) -> str:
    """Write (version, value) as commit files."""
    name = F.format_string("_delta_log/%020d.json", "version")
    text.write_texts(lines.select(name.alias("path"), "value"), root)
    return root


def _action_json(op: Column, fields: list[Column]) -> Column:
    body = F.struct(*fields)
    add, remove = F.when(op == "add", body).alias("add"), F.when(op == "remove", body).alias("remove")
    return F.to_json(F.struct(add, remove))


@once
def event_log(spark: SparkSession, sf_dir: str) -> str:
    """Log with a commit for every hour that has events; a commit holds the last event of each path."""
    last = (
        event_changes(spark, sf_dir)
        .withColumn("event_id", F.col("version"))
        .withColumn("version", event_commit(spark, sf_dir))
        .groupBy("version", "path")
        .agg(F.max_by(F.struct("op", "size"), "event_id").alias("a"))
    )
    encoded = F.concat(F.lit("part%20"), F.col("path"), F.lit("%2B.parquet")).alias("path")
    line = _action_json(F.col("a.op"), [encoded, F.col("a.size").alias("size")])
    return _write_log(last.select("version", line.alias("value")), place(spark, "event-log"))


@once
def vector_log(spark: SparkSession, sf_dir: str) -> str:
    """Log with a deletion vector of every storage kind on three of four events."""
    events = event_changes(spark, sf_dir).withColumn("event_id", F.col("version"))
    kind = F.element_at(F.array(F.lit("n"), F.lit("u"), F.lit("p"), F.lit("i")), (F.col("event_id") % 4 + 1).cast("int"))
    code = F.substring(F.md5(F.col("path")), 1, 20)
    location = (
        F.when(F.col("kind") == "u", F.concat(F.lit("ab"), code))
        .when(F.col("kind") == "p", F.concat(F.lit("dv%20"), F.col("path"), F.lit(".bin")))
        .otherwise(F.lit("0000000000"))
    )
    vector = F.when(
        F.col("kind") != "n",
        F.struct(
            F.col("kind").alias("storageType"),
            location.alias("pathOrInlineDv"),
            F.lit(1).alias("offset"),
            F.lit(40).alias("sizeInBytes"),
            F.lit(2).alias("cardinality"),
        ),
    )
    line = _action_json(
        F.col("op"),
        [F.col("event_id").cast("string").alias("path"), F.col("size"), vector.alias("deletionVector")],
    )
    version = event_commit(spark, sf_dir).alias("version")
    lines = events.withColumn("kind", kind).select(version, line.alias("value"))
    return _write_log(lines, place(spark, "vector-log"))


# --- H: the history of an orders table, shipped in three rounds --------------


def batch_label() -> Column:
    return F.when(F.col("o_orderkey") % 5 == 0, "A").otherwise("C")


@once
def history(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Six versions of orders and the bundles [0..0], [1..2], [3..5] and [0..5]."""
    orders = given(spark, sf_dir, "orders")
    root = place(spark, "history")
    where = {"table": f"{root}/orders_history"}

    def third(k: int) -> DataFrame:
        return orders.where(F.col("o_orderkey") % 3 == k)

    def ship_from(version: int) -> None:
        export.export(spark, where["table"], f"{root}/from_{version}", version)
        where[f"from_{version}"] = f"{root}/from_{version}.zip"

    write.write_table(third(0), where["table"])
    ship_from(0)
    write.write_table(third(1), where["table"])
    dml.update(spark, where["table"], "o_orderkey % 10 = 0", {"o_orderstatus": "'U'"})
    ship_from(1)
    labelled = table.read_table(spark, where["table"]).withColumn("batch", batch_label())
    write.write_table(labelled, where["table"], "overwrite", overwrite_schema=True)
    write.write_table(third(2).withColumn("batch", batch_label()), where["table"])
    dml.delete(spark, where["table"], "o_orderkey % 50 = 0")
    ship_from(3)
    export.export(spark, where["table"], f"{root}/full")
    return where | {"full": f"{root}/full.zip", "root": root}


@once
def imported(spark: SparkSession, sf_dir: str) -> str:
    """The full bundle, imported at a new place."""
    target = place(spark, "imported")
    apply.import_bundle(spark, history(spark, sf_dir)["full"], target)
    return target


@once
def checkpointed(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """H with a checkpoint every two commits; also shipped, and once without its first commits."""
    orders = given(spark, sf_dir, "orders")
    root = place(spark, "checkpointed")
    source, shipped, tail = f"{root}/source", f"{root}/shipped", f"{root}/tail"
    third = [orders.where(F.col("o_orderkey") % 3 == k) for k in range(3)]
    write.write_table(third[0], source, configuration={"delta.checkpointInterval": "2"})
    write.write_table(third[1], source)
    dml.update(spark, source, "o_orderkey % 10 = 0", {"o_orderstatus": "'U'"})
    labelled = table.read_table(spark, source).withColumn("batch", batch_label())
    write.write_table(labelled, source, "overwrite", overwrite_schema=True)
    write.write_table(third[2].withColumn("batch", batch_label()), source)
    dml.delete(spark, source, "o_orderkey % 50 = 0")
    export.export(spark, source, f"{root}/bundle")
    apply.import_bundle(spark, f"{root}/bundle.zip", shipped)
    located = storage.qualify(spark, source)
    _, files, _, _ = export.plan_range(spark, located, 0)
    files = files.withColumn("entry", F.lit(None).cast("string"))
    early = F.col("path").rlike("_delta_log/0{19}[0-3][.]")
    apply.copy_files(files.where(~early & (F.col("kind") != "hint")), tail)
    return {"source": source, "shipped": shipped, "tail": tail}


# --- P: partitioned orders ----------------------------------------------------


@once
def partitioned(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Orders by (status, year): load, append, update in a partition, drop a partition; shipped twice."""
    orders = given(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    root = place(spark, "partitioned")
    source, target = f"{root}/source", f"{root}/target"
    write.write_table(orders.where("o_orderkey % 2 = 0"), source, partition_by=["o_orderstatus", "o_year"])
    export.export(spark, source, f"{root}/from_0")
    apply.import_bundle(spark, f"{root}/from_0.zip", target)
    write.write_table(orders.where("o_orderkey % 2 = 1"), source)
    dml.update(
        spark, source, "o_orderstatus = 'F' AND o_year = 1996 AND o_orderkey % 7 = 0", {"o_totalprice": "1.5"}
    )
    dml.delete(spark, source, "o_orderstatus = 'O' AND o_year = 1997")
    export.export(spark, source, f"{root}/from_1", 1)
    apply.import_bundle(spark, f"{root}/from_1.zip", target, "apply")
    return {"source": source, "target": target}


# Fixed bytes of the public formats: bitmaps of the rows 10 to 39 (a run, in Z85), of the rows 0, 2, 5 and 100 (a
# list), and of all odd rows below 65,536 (a bitset). A stored one has its size before it and its CRC-32 behind it.
RUN_VECTOR = "^Bg9^0rr910000000000j1{Tm0rr9u0096b0384t"
LIST_VECTOR = "d1d339640100000000000000000000003a3000000100000000000300100000000000020005006400"
ODD_VECTOR = "d1d339640100000000000000000000003a300000010000000000ff7f10000000" + "aa" * 8192
VECTOR_FILE = "deletion_vector_00000000-0000-0000-0000-000000000000.bin"
MARKED_FILES = 64


def stored_vector(blob: str) -> bytes:
    data = bytes.fromhex(blob)
    return b"\x01" + len(data).to_bytes(4, "big") + data + zlib.crc32(data).to_bytes(4, "big")


@once
def marked(spark: SparkSession, sf_dir: str) -> str:
    """Orders in files by the key's remainder, sorted by key; three of four have a vector: inline, by UUID, by path."""
    target = storage.qualify(spark, place(spark, "marked"))
    bucket = (F.col("o_orderkey") % MARKED_FILES).cast("int")
    orders = given(spark, sf_dir, "orders").withColumn("bucket", bucket)
    write.create_table(spark, target, orders.schema, ["bucket"], {"delta.enableDeletionVectors": "true"})
    spread = orders.repartition(MARKED_FILES, "bucket").sortWithinPartitions("bucket", "o_orderkey")
    spread.write.partitionBy("bucket").parquet(f"{target}/load")
    storage.write_bytes(spark, f"{target}/{VECTOR_FILE}", stored_vector(LIST_VECTOR))
    storage.write_bytes(spark, f"{target}/odd.bin", stored_vector(ODD_VECTOR))

    def vector(kind: str, place_of: str, offset: int | None, size: int, rows: int) -> Column:
        fields = {"storageType": kind, "pathOrInlineDv": place_of, "offset": offset, "sizeInBytes": size, "cardinality": rows}
        return F.from_json(F.lit(json.dumps(fields)), VECTOR)

    kind = F.col("add.partitionValues")["bucket"].cast("int") % 4
    marks = (
        F.when(kind == 1, vector("i", RUN_VECTOR, None, 31, 30))
        .when(kind == 2, vector("u", "0" * 20, 1, 40, 4))
        .when(kind == 3, vector("p", f"{target}/odd.bin", 1, 8224, 32768))
    )
    adds = write.add_actions(spark, target, f"{target}/load", ["bucket"])
    write.commit(spark, target, 1, adds.select(F.col("add").withField("deletionVector", marks).alias("add")), "WRITE")
    return target


# --- C: many commits with checkpoints ------------------------------------------


@once
def many_commits(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Seventeen commits with a checkpoint every five: loads, ten appends, updates, a delete, new columns; shipped."""
    orders = given(spark, sf_dir, "orders")
    root = place(spark, "many-commits")
    source, target = f"{root}/source", f"{root}/target"
    third, load = F.col("o_orderkey") % 3, F.col("o_orderkey") % 10
    changed = F.lit(0).alias("changed")
    write.write_table(orders.where(third == 0), source, configuration={"delta.checkpointInterval": "5"})
    write.write_table(orders.where(third == 0).select("*", changed), source, "overwrite", overwrite_schema=True)
    for k in range(10):
        write.write_table(orders.where((third > 0) & (load == k)).select("*", changed), source)
    dml.update(spark, source, "o_orderstatus = 'F'", {"changed": "1"})
    dml.update(spark, source, "o_orderstatus = 'O'", {"changed": "changed + 2"})
    dml.delete(spark, source, "o_orderkey % 50 = 0")
    scored = table.read_table(spark, source).select("*", F.lit(True).alias("is_active"), (load * 7).cast("int").alias("score"))
    write.write_table(scored, source, "overwrite", overwrite_schema=True)
    dml.update(spark, source, "o_orderkey % 25 = 5", {"is_active": "false"})
    apply.ship(spark, source, target)
    return {"source": source, "target": target}


@once
def ranged(spark: SparkSession, sf_dir: str) -> str:
    """All line items, in files that each hold a range of order keys."""
    target = place(spark, "ranged")
    lines = given(spark, sf_dir, "lineitem")
    write.write_table(lines.repartitionByRange(16, "l_orderkey"), target)
    return target
