"""Bundles: a directory of ZIP parts with `metadata.json`, or one ZIP file with all of it."""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeship import storage, workers
from lakeship.functions import paths
from lakeship.functions.actions import BUNDLE_SCHEMA, LONG, struct_type
from lakeship.operators import packing
from lakeship.storage import ShippingError

METADATA_SCHEMA = StructType([*BUNDLE_SCHEMA, *struct_type(parts=LONG, files=LONG)])
MANIFEST_DIR = "manifest"
ENTRY_SCHEMA = "source string, entry string, size bigint, crc bigint, seekable boolean"


def archives(spark: SparkSession, bundle: str) -> DataFrame:
    """ZIP files of a bundle, as `source`."""
    bundle = storage.qualify(spark, bundle)
    if not storage.exists(spark, bundle):
        raise ShippingError(f"bundle {bundle} does not exist")
    reader = spark.read.format("binaryFile")
    if storage.is_dir(spark, bundle):
        reader = reader.option("pathGlobFilter", "*.zip")
    return reader.load(bundle).select(F.col("path").alias("source"))


def bundle_entries(spark: SparkSession, bundle: str) -> DataFrame:
    """Regular-file entries of all parts: source, entry, size, crc, seekable (not compressed), kind, version, safe.

    Only the central directories of the ZIP files are read.
    """
    tasks = packing.few_tasks(spark)
    look = partial(workers.list_archives, options=storage.storage_options(spark))
    entry = F.col("entry")
    return (
        archives(spark, bundle)
        .repartition(tasks)
        .mapInPandas(look, ENTRY_SCHEMA)
        .where(~entry.endswith("/"))
        .withColumn("kind", paths.file_class(entry))
        .withColumn("version", F.when(F.startswith(entry, F.lit(paths.LOG_DIR)), paths.version_of(paths.base_name(entry))))
        .withColumn("safe", paths.is_safe_entry(entry))
    )


def bundle_metadata(spark: SparkSession, bundle: str) -> DataFrame:
    """The one row that describes a bundle; a bundle without it is not usable."""
    return spark.createDataFrame([read_metadata(spark, bundle)], METADATA_SCHEMA)


def read_metadata(spark: SparkSession, bundle: str) -> Row:
    """The metadata of a bundle as a row; a few hundred bytes of JSON."""
    bundle = storage.qualify(spark, bundle)
    if storage.is_dir(spark, bundle):
        location = f"{bundle}/{paths.METADATA_FILE}"
        if not storage.exists(spark, location):
            raise ShippingError(f"bundle {bundle} has no {paths.METADATA_FILE}; its export did not finish")
        texts = [storage.read_text(spark, location)]
    else:
        entry = archives(spark, bundle).withColumn("entry", F.lit(paths.METADATA_FILE))
        read = partial(workers.read_entries, options=storage.storage_options(spark))
        texts = [row.value for row in entry.mapInPandas(read, "value string").collect()]
    try:
        (found,) = [json.loads(text) for text in texts]
        row = Row(**{name: found.get(name) for name in METADATA_SCHEMA.names})
        complete = isinstance(row.fromVersion, int) and isinstance(row.toVersion, int) and row.tablePath
    except (ValueError, AttributeError):
        complete = False
    if not complete:
        raise ShippingError(f"{paths.METADATA_FILE} of bundle {bundle} is missing or broken")
    return row


def bundle_check(entries: DataFrame, to_version: int) -> DataFrame:
    """One row: counts over all entries, the highest version, and whether that is as it must be."""
    log_file = F.col("kind").isin("commit", "checkpoint")
    return entries.agg(
        F.count_if(log_file).alias("log_files"),
        F.count_if(~F.col("safe")).alias("unsafe_entries"),
        F.max(F.when(log_file, F.col("version"))).alias("highest_version"),
        F.count_distinct("source").alias("archives"),
        F.count("*").alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
    ).withColumn(
        "versions_ok",
        (F.col("log_files") > 0)
        & (F.col("unsafe_entries") == 0)
        & (F.coalesce(F.col("highest_version"), F.lit(-1)) <= F.lit(to_version)),
    )


def data_entries(entries: DataFrame) -> DataFrame:
    """Entries that belong to the table's data, not to its log or to the bundle."""
    return entries.where(~F.startswith(F.col("entry"), F.lit(paths.LOG_DIR + "/")) & (F.col("entry") != paths.METADATA_FILE))
