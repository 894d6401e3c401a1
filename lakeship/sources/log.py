"""The commit log as DataFrames: its files, its actions, its checkpoints."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeship import storage
from lakeship.functions import paths
from lakeship.functions.actions import ACTION_SCHEMA
from lakeship.operators import history
from lakeship.storage import ShippingError

CORRUPT = "_corrupt_record"
SCAN_SCHEMA = StructType([*ACTION_SCHEMA.fields, StructField(CORRUPT, StringType())])


def log_dir(table: str) -> str:
    return f"{table.rstrip('/')}/{paths.LOG_DIR}"


def intent_file(table: str) -> str:
    """Where a log that is about to be replaced is written down."""
    return f"{table.rstrip('/')}/_shipping/publish.json"


def recover(spark: SparkSession, table: str) -> bool:
    """Finish a replacement of the log that was stopped between its two renames; whether there is a log then."""
    if storage.is_dir(spark, log_dir(table)):
        return True
    if not storage.exists(spark, intent_file(table)):
        return False
    new = json.loads(storage.read_text(spark, intent_file(table)))["new"]
    if storage.is_dir(spark, new):
        storage.move_new(spark, new, log_dir(table))  # False: somebody else was faster, with the same log
    return storage.is_dir(spark, log_dir(table))


def list_log(spark: SparkSession, table: str) -> DataFrame:
    """Log files: name, size, modified, kind, version, and the part of a checkpoint.

    Only the listing is read, never the content. The checkpoint hint is hidden
    from Spark's readers; nothing here needs it.
    """
    listing = spark.read.format("binaryFile").load(storage.no_glob(log_dir(table)))
    name = F.col("name")
    pieces = F.split(name, r"\.")
    return (
        listing.select(
            F.col("_metadata.file_name").alias("name"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .withColumn("kind", paths.file_class(paths.join_path(paths.LOG_DIR, name)))
        .withColumn("version", paths.version_of(name))
        .withColumn(
            "parts",
            F.when((F.col("kind") == "checkpoint") & (F.size(pieces) == 5), pieces[3].try_cast("int")).when(
                F.col("kind") == "checkpoint", 1
            ),
        )
    )


def scan_actions(
    spark: SparkSession, table: str, from_version: int | None = None, to_version: int | None = None
) -> DataFrame:
    """One row per log line of the commits in the range, both ends included.

    A version that is absent gives no rows; `sources.table.snapshot` counts the versions it gets. The range is a literal filter on the file name, so commits outside it are
    never opened. Lines that do not parse keep their text in `_corrupt_record`.
    """
    scan = _json_reader(spark).option("pathGlobFilter", "*.json").json(storage.no_glob(log_dir(table)))
    name = F.col("_metadata.file_name")
    if from_version is not None:
        scan = scan.where(name >= f"{from_version:020d}.json")
    if to_version is not None:
        scan = scan.where(name <= f"{to_version:020d}.json")
    return _with_version(scan.where(name.rlike(paths.COMMIT_PATTERN)))


def scan_commits(spark: SparkSession, table: str, first: int, last: int) -> DataFrame:
    """`scan_actions` of a range whose commits are known to be there, with `log_size` and `log_modified` of each one's file.

    The files are named one by one, so the log is not listed; one that is absent is an error.
    """
    names = [f"{storage.no_glob(log_dir(table))}/{version:020d}.json" for version in range(first, last + 1)]
    meta = F.col("_metadata")
    return _json_reader(spark).json(names).select(
        paths.version_of(meta["file_name"]).alias("version"), "*",
        meta["file_size"].alias("log_size"), meta["file_modification_time"].alias("log_modified"),
    )


def _json_reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.schema(SCAN_SCHEMA).option("mode", "PERMISSIVE").option("encoding", "UTF-8")


def _with_version(scan: DataFrame) -> DataFrame:
    return scan.select(paths.version_of(F.col("_metadata.file_name")).alias("version"), "*")


def corrupt_lines(actions: DataFrame) -> DataFrame:
    """Lines that are not JSON or whose fields have other types than an action has.

    Spark refuses to report on the text column alone; reading every action
    beside it also makes every field be parsed.
    """
    parsed = F.length(F.to_json(F.struct(*[f.name for f in ACTION_SCHEMA]))) >= 0
    return actions.where(F.col(CORRUPT).isNotNull() & parsed).select("version", CORRUPT)


def scan_checkpoint(spark: SparkSession, table: str, version: int, parts: int = 1) -> DataFrame:
    """Actions of a classic checkpoint, single-part or multi-part."""
    stem = f"{storage.no_glob(log_dir(table))}/{version:020d}.checkpoint"
    files = (
        [f"{stem}.parquet"]
        if parts == 1
        else [f"{stem}.{p:010d}.{parts:010d}.parquet" for p in range(1, parts + 1)]
    )
    checkpoint = spark.read.schema(ACTION_SCHEMA).parquet(*files)
    return checkpoint.select(
        F.lit(version).cast("bigint").alias("version"), "*", F.lit(None).cast("string").alias(CORRUPT)
    )


@dataclass(frozen=True)
class Segment:
    """What has to be read to know a table at one version."""

    version: int
    checkpoint: int | None
    parts: int


def resolve_segment(spark: SparkSession, table: str, as_of: int | None = None) -> Segment:
    """Newest usable checkpoint and the last version that follows it without a gap."""
    if not recover(spark, table):
        raise ShippingError(f"{table} has no {paths.LOG_DIR}")
    listing = list_log(spark, table)
    newest, parts = history.newest_checkpoint(listing, as_of).first() or (None, 1)
    start = 0 if newest is None else newest + 1
    latest = history.latest_version(listing.where("kind = 'commit'"), [start]).first().latest
    if latest is None and newest is None:
        unsupported = listing.where(F.col("name").rlike(paths.UNSUPPORTED_CHECKPOINT_PATTERN))
        hint = "; its checkpoints are of an unsupported kind" if not unsupported.isEmpty() else ""
        raise ShippingError(f"{table} has no readable history from version 0{hint}")
    latest = newest if latest is None else latest
    if as_of is not None and as_of > latest:
        raise ShippingError(f"{table} has no version {as_of}; the latest is {latest}")
    version = latest if as_of is None else as_of
    return Segment(version, newest, parts)


def scan_state(spark: SparkSession, table: str, segment: Segment) -> DataFrame:
    """All actions that make up a table at the segment's version."""
    if segment.checkpoint is None:
        return scan_actions(spark, table, 0, segment.version)
    checkpoint = scan_checkpoint(spark, table, segment.checkpoint, segment.parts)
    if segment.version == segment.checkpoint:
        return checkpoint
    commits = scan_actions(spark, table, segment.checkpoint + 1, segment.version)
    return checkpoint.unionByName(commits)


