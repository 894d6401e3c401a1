"""Continuous shipping: a stream over the names in the commit log tells which versions to ship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from lakeship import storage
from lakeship.functions import paths
from lakeship.operators.write import table_exists
from lakeship.plans.apply import ship_range
from lakeship.sources import log
from lakeship.storage import ShippingError
from lakeship.streaming.frontier import contiguous_ranges

#: Fixed columns of Spark's `binaryFile` source; the content is never read.
FILE_SCHEMA = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
    ]
)


def commit_versions(spark: SparkSession, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of `version`, one row for each commit file that appears in the log; only names are read."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.json")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    name = paths.base_name(F.col("path"))
    return reader.load(storage.no_glob(log.log_dir(table))).where(name.rlike(paths.COMMIT_PATTERN)).select(paths.version_of(name).alias("version"))


def ship_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Ship every new version of `source` to `target`.

    Without `processing_time` the query takes what is there and ends. Commit files may arrive in any order, late, or
    again: a stateful operator holds back what lies beyond a gap and gives out each version once, in ranges that
    continue one another. A batch costs its own range; the logs are listed by the stream's own source and, for the
    first range, to see where the target stands. A batch that failed is repeated when the query is started again, and
    goes on where it stopped.
    """
    location, destination = storage.qualify(spark, source), storage.qualify(spark, target)
    start = log.resolve_segment(spark, destination).version + 1 if table_exists(spark, destination) else 0
    commits = log.list_log(spark, location).where("kind = 'commit'")
    known = commits.agg(F.max("version").alias("most"), F.count_if(F.col("version") == start).alias("n")).first()
    if known.most is not None and known.most >= start and not known.n:
        raise ShippingError(f"{location} has versions up to {known.most}, but not {start}, which {destination} needs next")
    ranges = contiguous_ranges(commit_versions(spark, location, max_files_per_trigger), start)

    @storage.tidy
    def on_batch(batch: DataFrame, _: int) -> None:
        for row in batch.orderBy("first").collect():  # one range at most
            ship_range(batch.sparkSession, location, destination, row.first, row.last)

    writer = ranges.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return writer.trigger(**trigger).start()
