"""Export: a range of versions and the files it needs, as a bundle of ZIP parts."""

from __future__ import annotations

import json
import warnings
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeship import storage, workers
from lakeship.functions import paths
from lakeship.operators import history, manifest, packing
from lakeship.sources import log
from lakeship.sources.bundle import MANIFEST_DIR
from lakeship.storage import ShippingError

PART_SCHEMA = "part bigint, path string, kind string, live boolean, size bigint, crc bigint, status string"


def resolve_range(table: str, listing: DataFrame, from_version: int) -> int:
    """Last version of the range, after checking that its history is complete."""
    commits = listing.where("kind = 'commit'")
    latest = history.latest_version(commits, [from_version]).first().latest
    if latest is None:
        raise ShippingError(f"{table} has no versions from {from_version} on")
    if from_version > 0 and not history.history_ok(listing, [from_version]).first().history_ok:
        absent = history.missing_versions(commits, from_version).agg(F.min("version")).first()[0]
        raise ShippingError(
            f"{table} has neither all commits before {from_version} nor a checkpoint at or below it; "
            f"commit {absent} is the first that is missing"
        )
    return latest


def plan_range(spark: SparkSession, table: str, from_version: int) -> tuple[int, DataFrame, int, int]:
    """Last version, manifest (written down once and checked), file count and bytes of a range."""
    if not storage.is_dir(spark, log.log_dir(table)):
        raise ShippingError(f"{table} has no {paths.LOG_DIR}")
    listing = log.list_log(spark, table)
    to_version = resolve_range(table, listing, from_version)
    actions = log.scan_actions(spark, table, from_version, to_version)
    # a log file may be another one under the same name when it is shipped again; data files never are
    logged = manifest.log_manifest(listing, from_version, to_version, F.unix_micros("modified").alias("stamp"))
    named = manifest.needed_files(manifest.references(actions)).withColumn("stamp", F.col("size"))
    files = logged.unionByName(named)
    files, count, size = checked_manifest(table, files)
    unsupported = listing.where(F.col("name").rlike(paths.UNSUPPORTED_CHECKPOINT_PATTERN)).first()
    if unsupported is not None:
        warnings.warn(f"{unsupported.name} and others of its kind stay behind in {table}", stacklevel=2)
    hint = hint_version(spark, table)
    shipped = history.complete_checkpoints(listing.where(F.col("version").between(from_version, to_version)))
    if hint is not None and not shipped.where(F.col("version") == hint).isEmpty():
        files = files.unionByName(hint_row(table, files))
    return to_version, files, count, size


def plan_commits(spark: SparkSession, table: str, first: int, last: int) -> tuple[DataFrame, int, int]:
    """Manifest, file count and bytes of a range whose commits are known to be there; no log is listed.

    Of checkpoints, those in one file are found by their names.
    """
    actions = log.scan_commits(spark, table, first, last)
    logged = actions.groupBy("version").agg(F.max("log_size").alias("size"), F.max("log_modified").alias("modified"))
    logged = logged.withColumn("name", paths.commit_name(F.col("version"))).withColumn("kind", F.lit("commit"))
    stamp = F.unix_micros("modified").alias("stamp")
    names = spark.range(first, last + 1).select(paths.join_path(paths.LOG_DIR, paths.checkpoint_name(F.col("id"))).alias("path"))
    found = manifest.probe(names, table).where("found_size IS NOT NULL")
    checkpoints = found.select(
        "path", F.lit("checkpoint").alias("kind"), F.col("found_size").alias("size"), F.lit(True).alias("live"), F.col("found_size").alias("stamp")
    )
    named = manifest.needed_files(manifest.references(actions)).withColumn("stamp", F.col("size"))
    files = manifest.log_manifest(logged, first, last, stamp).unionByName(checkpoints).unionByName(named)
    files, count, size = checked_manifest(table, files)
    hint = hint_version(spark, table)
    if hint is not None and not files.where((F.col("kind") == "checkpoint") & F.endswith("path", F.lit(f"{hint:020d}.checkpoint.parquet"))).isEmpty():
        files = files.unionByName(hint_row(table, files))
    return files, count, size


def hint_row(table: str, files: DataFrame) -> DataFrame:
    name = f"{paths.LOG_DIR}/{paths.HINT_FILE}"
    return files.sparkSession.createDataFrame([(name, "hint", 0, False, None, f"{table}/{name}")], files.schema)


def checked_manifest(table: str, files: DataFrame) -> tuple[DataFrame, int, int]:
    """The manifest with every file's `source`, written down once; its file count and bytes. Raises if it cannot be shipped."""
    files = storage.materialize(files.withColumn("source", manifest.locate(table)), "manifest")
    wrong = (F.col("kind") == "broken") | paths.is_absolute(F.col("path"))
    row = files.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
        F.max(F.when(wrong, F.struct("kind", "path"))).alias("bad"),
    ).first()
    if row.bad and row.bad.kind == "broken":
        raise ShippingError(f"the log of {table} has a line that does not parse: {row.bad.path[:200]}")
    if row.bad:
        raise ShippingError(f"{row.bad.path} is named by an absolute location and cannot move with the table")
    return files, row.n, row.size


def hint_version(spark: SparkSession, table: str) -> int | None:
    location = f"{log.log_dir(table)}/{paths.HINT_FILE}"
    if not storage.exists(spark, location):
        return None
    try:
        return int(json.loads(storage.read_text(spark, location))["version"])
    except (ValueError, KeyError, TypeError):
        return None


def bundle_location(out: str) -> str:
    return out if out.lower().endswith(".zip") else out + ".zip"


@storage.tidy
def export(
    spark: SparkSession,
    table: str,
    out: str,
    from_version: int = 0,
    part_bytes: int = packing.PART_BYTES,
    single_file: bool = False,
) -> DataFrame:
    """Write versions `from_version`..latest to a bundle; returns its manifest with copy status.

    The bundle is a directory of ZIP parts. Tasks stream files straight into
    their part; `metadata.json` comes last and makes the bundle valid. Files
    that a later commit of the range removed may be missing, live ones may not.
    With `single_file` a range of at most `part_bytes` becomes one ZIP file
    that holds its metadata too.
    """
    table, bundle = storage.qualify(spark, table), storage.qualify(spark, bundle_location(out))
    if storage.exists(spark, bundle):
        raise ShippingError(f"{bundle} already exists")
    to_version, files, count, size = plan_range(spark, table, from_version)
    if single_file and size > part_bytes:
        raise ShippingError(f"{size} bytes are too many for one file; export to parts instead")
    location = storage.scratch_dir(spark, "single", result=True) if single_file else bundle
    if single_file:
        parts, n_parts = files.withColumn("part", F.lit(0).cast("bigint")), 1
    else:
        parts = storage.materialize(packing.global_next_fit(files, part_bytes, count), "parts")
        n_parts = parts.agg(F.max("part")).first()[0] + 1
    metadata = metadata_text(table, from_version, to_version, n_parts, count)
    pack = partial(
        workers.write_parts,
        bundle=bundle,
        options=storage.storage_options(spark),
        closing=metadata if single_file else None,
    )
    written = (
        parts.repartitionById(n_parts, F.col("part").cast("int"))
        .sortWithinPartitions("part", "path")
        .mapInPandas(pack, PART_SCHEMA)
    )
    try:
        written.write.parquet(f"{location}/{MANIFEST_DIR}")
        shipped = spark.read.parquet(storage.no_glob(f"{location}/{MANIFEST_DIR}"))
        lost = shipped.where("status = 'missing' AND live").first()
        if lost is not None:
            raise ShippingError(f"{table} needs {lost.path}, which does not exist")
        if not single_file:
            storage.write_text(spark, f"{bundle}/{paths.METADATA_FILE}", metadata)
    except Exception:
        storage.remove_dir(spark, bundle)  # what this call has made; the next export starts anew
        raise
    return shipped


def metadata_text(table: str, from_version: int, to_version: int, parts: int, files: int) -> str:
    now = datetime.now(timezone.utc).isoformat(timespec="milliseconds").replace("+00:00", "Z")
    described = {
        "tablePath": table,
        "tableName": table.rsplit("/", 1)[1],
        "fromVersion": from_version,
        "toVersion": to_version,
        "exportTimestamp": now,
        "parts": parts,
        "files": files,
    }
    return json.dumps(described)
