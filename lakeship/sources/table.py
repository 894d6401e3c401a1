"""Table reads: replay the log, then let Spark's own Parquet reader do the scan."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import partial, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeship import storage, workers
from lakeship.functions import paths
from lakeship.functions.actions import LONG, STATE_ACTIONS, STRING, struct_type
from lakeship.operators import replay
from lakeship.sources import log
from lakeship.storage import ShippingError

FILE_PATH = "__file_path"
ROW_INDEX = "__row_index"
#: Files whose vectors one scan names, about 250 bytes each; the vectors themselves are read in tasks.
VECTORS_AT_ONCE = 50_000
READER_FEATURES = {"deletionVectors", "timestampNtz", "vacuumProtocolCheck"}


@dataclass(frozen=True)
class Snapshot:
    """A table at one version; `files` and `actions` stay lazy."""

    spark: SparkSession
    table: str
    version: int
    schema: StructType
    partition_columns: list[str]
    metadata: dict
    protocol: dict
    actions: DataFrame
    files: DataFrame

    @property
    def data_schema(self) -> StructType:
        return StructType([f for f in self.schema if f.name not in self.partition_columns])


def snapshot(spark: SparkSession, table: str, as_of: int | None = None, to_ship: bool = False) -> Snapshot:
    """A table at one version. Shipping copies bytes, so `to_ship` accepts tables whose rows cannot be read."""
    table = storage.qualify(spark, table)
    segment = log.resolve_segment(spark, table, as_of)
    actions = log.scan_state(spark, table, segment)
    state = _checked_state(actions).first()
    if state[log.CORRUPT] is not None:
        raise ShippingError(f"{table} has a log line that does not parse: {state[log.CORRUPT][:200]}")
    first = 0 if segment.checkpoint is None else segment.checkpoint
    if state.versions != segment.version - first + 1:
        raise ShippingError(f"{table} lost commits between versions {first} and {segment.version} while it was read")
    if state.metaData is None or state.protocol is None:
        raise ShippingError(f"{table} has no metadata or protocol at version {segment.version}")
    unknown = set(state.protocol.readerFeatures or []) - READER_FEATURES
    if state.protocol.minReaderVersion > 3:
        unknown.add(f"reader version {state.protocol.minReaderVersion}")
    if (state.metaData.configuration or {}).get("delta.columnMapping.mode", "none") != "none":
        unknown.add("columnMapping")
    if unknown and not to_ship:
        raise ShippingError(f"{table} needs reader features that are not supported: {sorted(unknown)}")
    return Snapshot(
        spark,
        table,
        segment.version,
        StructType.fromJson(json.loads(state.metaData.schemaString)),
        list(state.metaData.partitionColumns or []),
        state.metaData.asDict(recursive=True),
        state.protocol.asDict(recursive=True),
        actions,
        replay.active_files(replay.file_actions(actions)),
    )


def _checked_state(actions: DataFrame) -> DataFrame:
    """One row: newest metadata and protocol, number of versions read, some line that does not parse.

    Counting the other actions makes the reader parse them too, so a line that replay would skip is found.
    """
    kinds = ("metaData", "protocol")
    of_version = actions.groupBy("version").agg(
        *[F.any_value(k, ignoreNulls=True).alias(k) for k in kinds],
        F.max(log.CORRUPT).alias(log.CORRUPT),
        *[F.count(k).alias(f"n_{k}") for k in STATE_ACTIONS if k not in kinds],
    )
    parsed = [F.sum(f"n_{k}").alias(f"n_{k}") for k in STATE_ACTIONS if k not in kinds]
    newest = [F.expr(f"max_by({k}, version) FILTER (WHERE {k} IS NOT NULL)").alias(k) for k in kinds]
    return of_version.agg(*newest, F.max(log.CORRUPT).alias(log.CORRUPT), F.count("*").alias("versions"), *parsed)


def read_table(
    spark: SparkSession, table: str, as_of: int | None = None, partitions: Column | str | None = None
) -> DataFrame:
    """Rows of a table at its latest version, or as of an earlier one.

    `partitions`, a condition on partition columns, keeps the files of all other
    partitions from being listed at all; an ordinary filter prunes them later.
    """
    snap = snapshot(spark, table, as_of)
    return read_files(snap, None if partitions is None else partition_files(snap, partitions))


def read_files(
    snap: Snapshot, files: DataFrame | None = None, with_position: bool = False
) -> DataFrame:
    """Rows of some live files (default: all), without deleted positions.

    The list of paths goes to the driver, as in every Spark file scan; rows do
    not. With `with_position`, the key of the row's file and the row index are kept.
    """
    if files is None:
        needed = ("partition_values", "vector")
        files = replay.active_files(replay.file_actions(snap.actions), keep=needed)
    listed = files.select(
        "path",
        _layout(snap).alias("layout"),
        F.col("vector").isNotNull().alias("marked"),
        *_vector_place(snap.table, F.col("vector")),
    )
    listed = listed.toArrow().to_pandas()
    extra = [FILE_PATH, ROW_INDEX] if with_position else []
    wanted = [F.col(f"`{f.name}`") for f in snap.schema] + [F.col(c) for c in extra]
    if listed.empty:
        schema = StructType([*snap.schema, *struct_type(**{FILE_PATH: STRING, ROW_INDEX: LONG})])
        return snap.spark.createDataFrame([], schema).select(*wanted)
    native = listed["layout"].nunique(dropna=False) == 1 and listed["layout"].iloc[0] is not None
    marked = listed["marked"]
    scans = []
    if not marked.all():
        plain = listed.loc[~marked, "path"]
        scans.append(_scan(snap, files, plain, native, with_position).select(*wanted))
    vectors = listed[marked]
    for at in range(0, len(vectors), VECTORS_AT_ONCE):
        some = vectors.iloc[at : at + VECTORS_AT_ONCE]
        scans.append(_without_deleted(snap, _scan(snap, files, some["path"], native, True), some).select(*wanted))
    return reduce(DataFrame.unionByName, scans)


def _layout(snap: Snapshot) -> Column:
    """Names of a file's key=value directories where they tell the logged values, else NULL."""
    if not snap.partition_columns:
        return F.lit("")
    directories = F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1)
    keys = F.array_join(F.transform(directories, lambda d: F.substring_index(d, "=", 1)), "/")
    plain = F.forall(directories, lambda d: F.contains(d, F.lit("=")))
    agrees = [
        paths.partition_value(F.col("path"), c).eqNullSafe(
            paths.blank_to_null(F.element_at("partition_values", F.lit(c)))
        )
        for c in snap.partition_columns
    ]
    named = [F.array_contains(F.split(keys, "/"), c) for c in snap.partition_columns]
    fits = plain
    for condition in (*agrees, *named):
        fits = fits & condition
    return F.when(fits, keys)


def file_key(snap: Snapshot) -> Column:
    """What `read_files` puts into FILE_PATH for a live file."""
    return F.concat(F.lit(snap.table + "/"), F.col("path"))


def _scan(snap, files, names, native: bool, with_position: bool) -> DataFrame:
    """One Parquet scan over named files; the declared schema fills absent columns with NULL.

    When directories tell the partition values, they become real partition
    columns and Catalyst prunes on them. Otherwise the values come from the log
    by a join on the file's path, whose strategy is left to adaptive execution.
    The path of a row needs no decoding where no name holds a special character.
    """
    file_uri = F.col("_metadata.file_path")
    plain = paths.plain_root(snap.table) and names.str.fullmatch(paths.PLAIN_PATH).all()
    locations = [storage.no_glob(f"{snap.table}/{name}") for name in names]
    reader = snap.spark.read
    if native and snap.partition_columns:
        reader = reader.schema(snap.schema).option("basePath", snap.table)
    else:
        reader = reader.schema(snap.data_schema).option("recursiveFileLookup", True)
    scan = storage.read_parquet(reader, locations)
    joins = not native and snap.partition_columns
    if with_position or joins:
        scan = scan.select(
            "*",
            (file_uri if plain else paths.normal_uri(paths.decode_path(file_uri))).alias(FILE_PATH),
            F.col("_metadata.row_index").alias(ROW_INDEX),
        )
    if joins:
        values = [
            paths.blank_to_null(F.element_at("partition_values", F.lit(c)))
            .cast(snap.schema[c].dataType)
            .alias(c)
            for c in snap.partition_columns
        ]
        scan = scan.join(files.select(file_key(snap).alias(FILE_PATH), *values), FILE_PATH)
    return scan


def _vector_place(table: str, vector: Column) -> list[Column]:
    """Where the bytes of a deletion vector are: dv_source and offset, or inline."""
    stored, code = vector["storageType"], vector["pathOrInlineDv"]
    location = paths.dv_relative_path(stored, code)
    return [
        F.when(stored == "p", location).otherwise(F.concat(F.lit(table + "/"), location)).alias("dv_source"),
        F.when(stored == "i", code).alias("inline"),
        vector["offset"].cast("int").alias("offset"),
    ]


def _without_deleted(snap: Snapshot, rows: DataFrame, vectors: pd.DataFrame) -> DataFrame:
    """Rows whose position no vector marks; neither rows nor positions are shuffled or broadcast.

    Only (file, row index) go through the function, which reads the vector of the file that its task scans.
    """
    keys = snap.table + "/" + vectors["path"]
    offsets = [None if pd.isna(at) else int(at) for at in vectors["offset"]]
    places = dict(zip(keys, zip(vectors["dv_source"], vectors["inline"], offsets)))
    unmarked = workers.unmarked_rows(places, storage.storage_options(snap.spark))
    return rows.where(F.pandas_udf(unmarked, "boolean")(FILE_PATH, ROW_INDEX))


def partition_files(snap: Snapshot, condition: Column | str) -> DataFrame:
    """Live files whose logged partition values satisfy a condition on partition columns."""
    return with_partition_columns(snap).where(condition).select(*snap.files.columns)


def with_partition_columns(snap: Snapshot) -> DataFrame:
    typed = [
        paths.blank_to_null(F.element_at("partition_values", F.lit(c)))
        .cast(snap.schema[c].dataType)
        .alias(c)
        for c in snap.partition_columns
    ]
    return snap.files.select("*", *typed)


def partition_counts(snap: Snapshot) -> DataFrame:
    """Rows per partition, ordered by the partition columns."""
    columns = snap.partition_columns
    return read_files(snap).groupBy(*columns).agg(F.count("*").alias("n_rows")).orderBy(*columns)
