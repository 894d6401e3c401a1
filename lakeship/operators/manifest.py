"""Which files a range of versions needs, and which of them are there."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeship import storage, workers
from lakeship.functions import paths
from lakeship.functions.actions import vector_files, vector_id
from lakeship.operators import packing
from lakeship.storage import ShippingError

MANIFEST_COLUMNS = ["path", "kind", "size", "live"]
LISTING_SCHEMA = "source string, size bigint, modified timestamp, is_directory boolean, share int, shares int"


def references(actions: DataFrame) -> DataFrame:
    """Every mention of a file in the log, from one scan: version, kind, path, key, size, added.

    `key` tells apart the vectors that one file holds. A line that does not
    parse is a row of kind 'broken' with its text.
    """
    added = F.col("add.path").isNotNull()
    path = paths.decode_path(F.coalesce(F.col("add.path"), F.col("remove.path")))
    vector = F.coalesce(F.col("add.deletionVector"), F.col("remove.deletionVector"))
    vector_end = vector["offset"] + vector["sizeInBytes"] + 8
    descriptor = paths.blank_to_null(F.col("add.deletionVectorDescriptor.storagePath"))
    empty = F.lit("")

    def mention(kind: str, path: Column, key: Column, size: Column, added: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            path.alias("path"),
            key.alias("key"),
            size.cast("bigint").alias("size"),
            added.alias("added"),
        )

    vectors = F.transform(
        vector_files(vector),
        lambda file: mention("dv", file, F.concat_ws("|", path, vector_id(vector)), vector_end, added),
    )
    plain = F.array(
        mention("data", path, empty, F.coalesce(F.col("add.size"), F.col("remove.size")), added),
        mention("dv", paths.decode_path(descriptor), F.lit("descriptor"), F.lit(None), F.lit(False)),
        mention("cdc", paths.decode_path(F.col("cdc.path")), empty, F.col("cdc.size"), F.lit(False)),
        mention("broken", F.col("_corrupt_record"), empty, F.lit(None), F.lit(True)),
    )
    return actions.select("version", F.inline(F.concat(plain, F.coalesce(vectors, F.array())))).where(
        "path IS NOT NULL"
    )


def needed_files(mentions: DataFrame) -> DataFrame:
    """Each file of a range once; `live` if the last action that names it is an add.

    Data files that the range only removes belong to an earlier range. The
    first aggregation decides per key, the second joins the vectors of a file;
    both combine before they shuffle.
    """
    added = F.col("added")
    return (
        mentions.groupBy("kind", "path", "key")
        .agg(
            F.max(F.when(added | (F.col("kind") != "data"), F.col("size"))).alias("size"),
            F.max_by(added, F.struct("version", "added")).alias("live"),
            F.bool_or(added | (F.col("kind") != "data")).alias("shipped"),
        )
        .where("shipped")
        .groupBy("kind", "path")
        .agg(F.max("size").alias("size"), F.bool_or("live").alias("live"))
        .select(*MANIFEST_COLUMNS)
    )


def data_files(actions: DataFrame) -> DataFrame:
    """Distinct data files that a range adds."""
    return needed_files(references(actions).where("kind = 'data'"))


def vector_manifest(actions: DataFrame) -> DataFrame:
    """Distinct deletion-vector files of adds and removes; inline vectors have none."""
    return needed_files(references(actions).where("kind = 'dv'"))


def log_manifest(listing: DataFrame, from_version: int, to_version: int, *more: Column) -> DataFrame:
    """Commits and checkpoints of the range, with further columns of the listing."""
    inside = F.col("kind").isin("commit", "checkpoint") & F.col("version").between(from_version, to_version)
    return listing.where(inside).select(
        paths.join_path(paths.LOG_DIR, F.col("name")).alias("path"), "kind", "size", F.lit(True).alias("live"), *more
    )


def range_manifest(actions: DataFrame, listing: DataFrame, from_version: int, to_version: int) -> DataFrame:
    """Everything a range needs, each file once."""
    named = needed_files(references(actions))
    return log_manifest(listing, from_version, to_version).unionByName(named)


def list_files(spark: SparkSession, location: str, pattern: str = ".*", recursive: bool = False) -> DataFrame:
    """Files below a directory whose whole name matches a regular expression.

    Directories of one depth are listed by parallel tasks, then those of the next depth; a directory with very many
    entries is divided among tasks until each has a bounded number. The driver never holds the list. Empty and hidden
    files count.
    """
    root = storage.qualify(spark, location)
    if not storage.is_dir(spark, root):
        raise ShippingError(f"{root} is not a directory")
    look = partial(workers.list_directories, options=storage.storage_options(spark))
    tasks = packing.few_tasks(spark)
    whole = F.lit(None).cast("int")
    level, levels = spark.range(1).select(F.lit(root).alias("source"), whole.alias("share"), whole.alias("shares")), []
    more = "shares IS NOT NULL OR is_directory" if recursive else "shares IS NOT NULL"
    while levels == [] or not level.isEmpty():
        listed = storage.materialize(level.repartition(tasks).mapInPandas(look, LISTING_SCHEMA), "listing")
        levels.append(listed.where("NOT is_directory AND shares IS NULL"))
        level = listed.where(more).select("source", "share", "shares")
    found = reduce(DataFrame.unionByName, levels)
    return found.select(
        paths.relative_to(root, F.col("source")).alias("path"),
        paths.base_name(F.col("source")).alias("name"),
        "size",
        "modified",
    ).where(F.col("name").rlike(f"^(?:{pattern})$"))


def directory_exists(spark: SparkSession, location: str) -> bool:
    """Whether a directory holds anything; one listing page, not a full listing."""
    return storage.has_entries(spark, location)


def probe(files: DataFrame, root: str, tasks: int | None = None) -> DataFrame:
    """Adds `found_size`, NULL where `root/path` is absent; the lookups run in `tasks` tasks (default: by the session).

    Only the named files are looked up, so a small range of a huge table does
    not pay for a listing of the whole table.
    """
    spark = files.sparkSession
    located = files.withColumn("source", locate(root))
    tasks = tasks or packing.few_tasks(spark)
    look = partial(workers.probe_files, options=storage.storage_options(spark))
    schema = StructType([*located.schema, StructField("found_size", LongType())])
    return located.repartition(tasks).mapInPandas(look, schema).drop("source")


def locate(root: str) -> Column:
    """Full location of `path`; the log may also name files by absolute URI."""
    path = F.col("path")
    return F.when(paths.is_absolute(path), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def missing(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Manifest rows without a file of that relative path."""
    return manifest.join(present.select("path"), "path", "left_anti")


def files_by_extension(files: DataFrame) -> DataFrame:
    return (
        files.select(paths.extension(F.col("path")).alias("extension"), "size")
        .groupBy("extension")
        .agg(F.count("*").alias("n_files"), F.sum("size").alias("bytes"))
    )
