"""Small text files and other plain sources beside a table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeship import storage, workers


def write_texts(lines: DataFrame, root: str) -> DataFrame:
    """Write rows (path, value) as one text file per path; returns path, size, lines.

    Lines of a file are streamed by the task that owns the path.
    """
    spark = lines.sparkSession
    root = storage.qualify(spark, root)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write = partial(workers.write_texts, root=root, options=storage.storage_options(spark))
    owned = lines.select("path", "value").repartition(tasks, "path").sortWithinPartitions("path")
    return storage.materialize(owned.mapInPandas(write, "path string, size bigint, lines bigint"), "texts")


def read_texts(spark: SparkSession, location: str, pattern: str = "*") -> DataFrame:
    """Whole text of every matching file in a directory: name, text."""
    scan = spark.read.option("pathGlobFilter", pattern).text(storage.no_glob(storage.qualify(spark, location)), wholetext=True)
    return scan.select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def read_csv(spark: SparkSession, location: str, schema: StructType | str) -> DataFrame:
    """CSV with a header line and a declared schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(location)
