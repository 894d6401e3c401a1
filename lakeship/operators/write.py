"""Table writes: data files first, then one commit file put in place if absent."""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeship import storage
from lakeship.functions import paths
from lakeship.functions.actions import ACTION_SCHEMA, STATE_ACTIONS
from lakeship.operators import replay, skipping
from lakeship.sources import log
from lakeship.sources.table import Snapshot, snapshot
from lakeship.storage import ShippingError

LOAD_KEY = "_load"
FILES_PER_CHECKPOINT_PART = 500_000
CHECKPOINT_INTERVAL = "delta.checkpointInterval"
DEFAULT_CHECKPOINT_INTERVAL = "10"
RETENTION = "delta.deletedFileRetentionDuration"
DEFAULT_RETENTION = "interval 1 week"
#: Writer features that are either built or refused below where a table makes use of them.
WRITER_FEATURES = {
    "appendOnly",
    "changeDataFeed",
    "checkConstraints",
    "columnMapping",
    "deletionVectors",
    "generatedColumns",
    "identityColumns",
    "invariants",
    "timestampNtz",
    "vacuumProtocolCheck",
}
#: Fixed values of the public format: features that writer versions below 7 imply.
IMPLIED_FEATURES = {
    2: ("appendOnly", "invariants"),
    3: ("checkConstraints",),
    4: ("changeDataFeed", "generatedColumns"),
    5: ("columnMapping",),
    6: ("identityColumns",),
}
#: Column metadata that a writer would have to act on.
COLUMN_RULES = ("delta.invariants", "delta.generationExpression", "delta.identity.", "CURRENT_DEFAULT")


def table_exists(spark: SparkSession, table: str) -> bool:
    table = storage.qualify(spark, table)
    return log.recover(spark, table) and storage.has_entries(spark, log.log_dir(table))


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    configuration: dict[str, str] | None = None,
    if_not_exists: bool = False,
) -> int:
    """Commit 0 with protocol and metadata, and no files."""
    table = storage.qualify(spark, table)
    if table_exists(spark, table):
        if if_not_exists:
            return snapshot(spark, table).version
        raise ShippingError(f"{table} already exists")
    head = _head(spark, schema, partition_by, configuration or {})
    commit(spark, table, 0, head, "CREATE TABLE")
    return 0


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "append",
    partition_by: Sequence[str] | None = None,
    overwrite_schema: bool = False,
    merge_schema: bool = False,
    configuration: dict[str, str] | None = None,
) -> int:
    """Append to or overwrite a table, creating it where absent; returns the new version.

    mode: append | overwrite | error (refuse an existing table)
    """
    if mode not in ("append", "overwrite", "error"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    table = storage.qualify(spark, table)
    _check_partitions(df.schema, partition_by or ())
    if not table_exists(spark, table):
        head = _head(spark, df.schema, partition_by or (), configuration or {})
        adds = write_files(df, table, list(partition_by or ()))
        return commit(spark, table, 0, union_actions([head, adds]), "WRITE")
    if mode == "error":
        raise ShippingError(f"{table} already exists")
    snap = require_writable(snapshot(spark, table), removes_rows=mode == "overwrite")
    replaces = mode == "overwrite" and overwrite_schema
    if partition_by is not None and list(partition_by) != snap.partition_columns and not replaces:
        raise ShippingError(f"{table} is partitioned by {snap.partition_columns}, not {list(partition_by)}")
    partitions = list(partition_by) if partition_by is not None else snap.partition_columns
    schema = nullable(df.schema) if replaces else _evolved(snap.schema, nullable(df.schema), merge_schema, table)
    settings = {**(snap.metadata["configuration"] or {}), **(configuration or {})}
    actions = []
    if schema != snap.schema or partitions != snap.partition_columns or configuration:
        actions.append(_head(spark, schema, partitions, settings, snap))
    if mode == "overwrite":
        actions.append(removes(snap.files))
    for name in partitions:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(schema[name].dataType))
    actions.append(write_files(df, table, partitions))
    return commit(spark, table, snap.version + 1, union_actions(actions), "WRITE", settings)


def require_writable(snap: Snapshot, removes_rows: bool = False, changes_rows: bool = False) -> Snapshot:
    """Refuse to write to a table with rules that this writer does not follow; gives the snapshot back."""
    settings = snap.metadata["configuration"] or {}
    unknown = set(snap.protocol["writerFeatures"] or []) - WRITER_FEATURES
    if snap.protocol["minWriterVersion"] > 7:
        unknown.add(f"writer version {snap.protocol['minWriterVersion']}")
    unknown |= {name for name in settings if name.startswith("delta.constraints.")}
    for field in snap.schema:
        unknown |= {f"{name} of {field.name}" for name in field.metadata if name.startswith(COLUMN_RULES)}
    if changes_rows and settings.get("delta.enableChangeDataFeed") == "true":
        unknown.add("changeDataFeed")
    if unknown:
        raise ShippingError(f"{snap.table} needs writer features that are not supported: {sorted(unknown)}")
    if removes_rows and settings.get("delta.appendOnly") == "true":
        raise ShippingError(f"{snap.table} only takes new rows (delta.appendOnly)")
    return snap


def _check_partitions(schema: StructType, partition_by: Sequence[str]) -> None:
    absent = [c for c in partition_by if c not in schema.names]
    if absent or len(partition_by) == len(schema.names):
        raise ShippingError(f"cannot partition {schema.names} by {list(partition_by)}")


def _evolved(old: StructType, new: StructType, merge_schema: bool, table: str) -> StructType:
    known = {f.name: f for f in old}
    added = [f for f in new if f.name not in known]
    if added and not merge_schema:
        raise ShippingError(f"{table} has no columns {[f.name for f in added]}; use merge_schema")
    for field in new:
        if field.name in known and field.dataType != known[field.name].dataType:
            raise ShippingError(
                f"{table}.{field.name} is {known[field.name].dataType.simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    return StructType([*old, *added])


def nullable(schema: StructType) -> StructType:
    """The schema as the log declares it: a column may be absent from any file."""
    text = schema.json().replace('"nullable":false', '"nullable":true')
    return StructType.fromJson(json.loads(text))


def _head(
    spark: SparkSession,
    schema: StructType,
    partition_by: Sequence[str],
    configuration: dict[str, str],
    snap: Snapshot | None = None,
) -> DataFrame:
    """Protocol and metadata actions; reader features only where the schema needs them.

    A table that exists keeps its versions, features, name and description; none is ever lowered.
    """
    needed = set()
    if "timestamp_ntz" in schema.simpleString():
        needed.add("timestampNtz")
    if configuration.get("delta.enableDeletionVectors") == "true":
        needed.add("deletionVectors")
    old = snap.protocol if snap else {"minReaderVersion": 1, "minWriterVersion": 2}
    reader = needed | set(old.get("readerFeatures") or [])
    writer = needed | set(old.get("writerFeatures") or [])
    if needed and old["minWriterVersion"] < 7:  # features that the old version implied are listed from now on
        writer |= {name for version, names in IMPLIED_FEATURES.items() if version <= old["minWriterVersion"] for name in names}
    if needed and 2 <= old["minReaderVersion"] < 3:
        reader.add("columnMapping")
    protocol = {
        "minReaderVersion": max(old["minReaderVersion"], 3 if needed else 1),
        "minWriterVersion": max(old["minWriterVersion"], 7 if needed else 2),
    }
    if protocol["minReaderVersion"] == 3:
        protocol["readerFeatures"] = sorted(reader)
    if protocol["minWriterVersion"] == 7:
        protocol["writerFeatures"] = sorted(writer)
    metadata = {
        "id": snap.metadata["id"] if snap else str(uuid.uuid4()),
        **({k: snap.metadata[k] for k in ("name", "description") if snap.metadata[k] is not None} if snap else {}),
        "format": {"provider": "parquet", "options": {}},
        "schemaString": nullable(schema).json(),
        "partitionColumns": list(partition_by),
        "configuration": configuration,
        "createdTime": snap.metadata["createdTime"] if snap else int(time.time() * 1000),
    }
    rows = [{"protocol": protocol}, {"metaData": metadata}]
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "line string")
    shape = StructType([f for f in ACTION_SCHEMA if f.name in ("protocol", "metaData")])
    return lines.select(F.from_json("line", shape).alias("a")).select("a.*")


def write_files(df: DataFrame, table: str, partition_by: list[str]) -> DataFrame:
    """Write rows under a directory of their own and return their add actions.

    Nothing is moved afterwards; files of a failed write stay unreferenced. A
    partitioned write is rebalanced first, so a partition with very many rows is
    split over tasks and small ones do not become many small files.
    """
    spark = df.sparkSession
    load = f"{table}/{LOAD_KEY}={uuid.uuid4().hex}"
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(load)
    return add_actions(spark, table, load, partition_by, df.schema)


def add_actions(
    spark: SparkSession, table: str, load: str, partition_by: list[str], schema: StructType | None = None
) -> DataFrame:
    """Add actions of the files below `load`; with their rows' schema, also with statistics."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(storage.no_glob(load))
        .select("path", "length", "modificationTime")
    )
    if schema is not None:
        stored = StructType([f for f in schema if f.name not in partition_by])
        listing = skipping.footer_stats(listing.withColumn("source", paths.normal_uri(F.col("path"))), stored)
    else:
        listing = listing.withColumn("stats", F.lit(None).cast("string"))
    path = paths.relative_to(table, F.col("path"))
    pairs = [x for c in partition_by for x in (F.lit(c), paths.partition_value(path, c))]
    values = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return listing.select(
        F.struct(
            paths.encode_path(path).alias("path"),
            values.alias("partitionValues"),
            F.col("length").alias("size"),
            F.unix_millis("modificationTime").alias("modificationTime"),
            F.lit(True).alias("dataChange"),
            "stats",
        ).alias("add")
    )


def removes(files: DataFrame) -> DataFrame:
    """Remove actions for live files."""
    return files.select(
        F.struct(
            F.col("raw_path").alias("path"),
            F.unix_millis(F.current_timestamp()).alias("deletionTimestamp"),
            F.lit(True).alias("dataChange"),
            F.lit(True).alias("extendedFileMetadata"),
            F.col("partition_values").alias("partitionValues"),
            "size",
            F.col("vector").alias("deletionVector"),
        ).alias("remove")
    )


def union_actions(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def commit(
    spark: SparkSession,
    table: str,
    version: int,
    actions: DataFrame,
    operation: str,
    configuration: dict[str, str] | None = None,
) -> int:
    """Write one commit file in a task and rename it into place; fail on a conflict."""
    info = spark.range(1).select(
        F.struct(
            F.unix_millis(F.current_timestamp()).alias("timestamp"), F.lit(operation).alias("operation")
        ).alias("commitInfo")
    )
    staging = f"{log.log_dir(table)}/_staged-{uuid.uuid4().hex}"
    lines = union_actions([info, actions])
    lines.select(F.to_json(F.struct("*")).alias("value")).repartition(1).write.text(staging)
    try:
        (staged,) = storage.written_files(spark, staging)
        if not storage.move_new(spark, staged, f"{log.log_dir(table)}/{version:020d}.json"):
            raise ShippingError(f"version {version} of {table} was committed by another writer")
    finally:
        storage.remove_dir(spark, staging)
    interval = int((configuration or {}).get(CHECKPOINT_INTERVAL, DEFAULT_CHECKPOINT_INTERVAL))
    if version > 0 and version % interval == 0:
        write_checkpoint(spark, table, version)
    return version


def checkpoint_actions(snap: Snapshot) -> DataFrame:
    """The rows of a checkpoint: newest state of every key.

    Tombstones older than the table's `delta.deletedFileRetentionDuration` are left out.
    """
    retention = (snap.metadata["configuration"] or {}).get(RETENTION, DEFAULT_RETENTION)
    last = replay.latest_actions(replay.file_actions(snap.actions))
    shared = [
        F.col("raw_path").alias("path"),
        F.col("partition_values").alias("partitionValues"),
        F.col("size"),
        F.col("vector").alias("deletionVector"),
    ]
    add = F.struct(
        *shared,
        F.col("modified").alias("modificationTime"),
        F.lit(False).alias("dataChange"),
        "stats",
        "tags",
    )
    remove = F.struct(
        *shared,
        F.col("deleted").alias("deletionTimestamp"),
        F.lit(False).alias("dataChange"),
        F.lit(True).alias("extendedFileMetadata"),
    )
    oldest = F.unix_millis(F.current_timestamp() - F.expr(f"CAST('{retention}' AS INTERVAL)"))
    files = last.where((F.col("op") == "add") | F.col("deleted").isNull() | (F.col("deleted") > oldest)).select(
        F.when(F.col("op") == "add", add).alias("add"), F.when(F.col("op") == "remove", remove).alias("remove")
    )
    newest = replay.last_of(snap.actions, "metaData", "protocol")
    txn = snap.actions.where("txn.appId IS NOT NULL").groupBy("txn.appId").agg(F.max_by("txn", "version").alias("txn"))
    domains = (
        snap.actions.where("domainMetadata.domain IS NOT NULL")
        .groupBy("domainMetadata.domain")
        .agg(F.max_by("domainMetadata", "version").alias("domainMetadata"))
        .where("NOT coalesce(domainMetadata.removed, false)")
    )
    rows = [newest.select("metaData"), newest.select("protocol"), txn.select("txn")]
    return union_actions([*rows, domains.select("domainMetadata"), files]).select(*STATE_ACTIONS)


@storage.tidy
def write_checkpoint(
    spark: SparkSession, table: str, version: int | None = None, per_part: int = FILES_PER_CHECKPOINT_PART
) -> int:
    """Write a checkpoint of a version; large tables get a multi-part one.

    A version that has any checkpoint file already keeps what it has: parts of two attempts must never mix.
    """
    table = storage.qualify(spark, table)
    snap = require_writable(snapshot(spark, table, version))
    listed = log.list_log(spark, table).where((F.col("kind") == "checkpoint") & (F.col("version") == snap.version))
    if not listed.isEmpty():
        return snap.version
    rows = storage.materialize(checkpoint_actions(snap), "checkpoint")
    size = rows.count()
    parts = max(1, math.ceil(size / per_part))
    staging = f"{log.log_dir(table)}/_staged-{uuid.uuid4().hex}"
    key = F.xxhash64(*[f"{kind}.path" for kind in ("add", "remove")])
    rows.repartitionById(parts, F.pmod(key, F.lit(parts)).cast("int")).write.parquet(staging)
    staged = storage.written_files(spark, staging)
    stem = f"{log.log_dir(table)}/{snap.version:020d}.checkpoint"
    for number, source in enumerate(staged, 1):
        name = f"{stem}.parquet" if len(staged) == 1 else f"{stem}.{number:010d}.{len(staged):010d}.parquet"
        if not storage.move_new(spark, source, name):
            storage.remove_dir(spark, staging)
            raise ShippingError(f"another writer made a checkpoint of version {snap.version}")
    storage.remove_dir(spark, staging)
    hint = {"version": snap.version, "size": size} | ({"parts": len(staged)} if len(staged) > 1 else {})
    storage.write_text(spark, f"{log.log_dir(table)}/{paths.HINT_FILE}", json.dumps(hint), overwrite=True)
    return snap.version
