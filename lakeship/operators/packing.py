"""Splitting files into parts of bounded size, and work into tasks."""

from __future__ import annotations

import math
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeship import storage, workers

FILES_PER_SHARD = 20_000
FILES_PER_RANGE = 200_000
PART_BYTES = 128 << 20
TASK_BYTES = 256 << 20
TASK_FILES = 2_000


def totals(files: DataFrame) -> tuple[int, int]:
    """Number of files and their bytes."""
    row = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    return row.n, row.size


def default_shard(files: int) -> Column:
    return F.pmod(F.xxhash64("path"), F.lit(max(1, math.ceil(files / FILES_PER_SHARD))))


def next_fit(files: DataFrame, limit: int, shard: Column, order: str = "path") -> DataFrame:
    """Adds `shard` and `local_part`: a part closes when the next file would exceed `limit`.

    Parts never span shards, so shards are packed in parallel; a file larger
    than the limit has a part of its own.
    """

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order, kind="stable")
        return group.assign(local_part=workers.next_fit(group["size"].fillna(0), limit))

    sharded = files.withColumn("shard", shard.cast("bigint"))
    return sharded.groupBy("shard").applyInPandas(
        pack, StructType([*sharded.schema, StructField("local_part", LongType())])
    )


OUTCOME_SCHEMA = "range int, covers bigint, opened bigint, used bigint"


def global_next_fit(files: DataFrame, limit: int, count: int, per_block: int = FILES_PER_SHARD) -> DataFrame:
    """Adds `part`: the parts that one walk over all files in the order of their paths makes, found in parallel.

    The files are dealt out by ranges of the order, one for a task. What a run of files does depends only on how full
    the part is that is open when the walk enters it, and that decides which file opens the run's first new part: one of
    those in its first `limit` bytes. A task says for these what would come out of each block of `per_block` files, and
    joins its blocks' outcomes into those of the range; the driver goes from range to range, one of these rows at a time,
    and then every range numbers its own files. So there are as many tasks as the files need, however small the blocks.
    """
    order, blocks = F.col("path").asc_nulls_last(), math.ceil(count / per_block)
    if blocks <= 1:
        walk = files.repartition(1).sortWithinPartitions(order)
        return _numbered(walk.select("*", *_entry(0, -1, workers.ANY_FILL)), limit)  # no part is open: the first file opens one
    ranges = min(blocks, max(files.sparkSession.sparkContext.defaultParallelism, math.ceil(count / FILES_PER_RANGE)))
    dealt = files.repartitionByRange(ranges, order).sortWithinPartitions(order)
    dealt = dealt.select("*", F.spark_partition_id().alias("__range"), F.monotonically_increasing_id().alias("__at"))
    dealt = storage.materialize(dealt, "ranges")  # from here on a file's range and its place in it are stored facts
    found = (
        dealt.select("__range", "__at", "size")
        .repartitionById(ranges, "__range")
        .sortWithinPartitions("__at")
        .mapInArrow(partial(workers.range_outcomes, limit=limit, per_block=per_block), OUTCOME_SCHEMA)
    )
    entries, used, part = [], workers.ANY_FILL, -1
    for row in storage.materialize(found, "outcomes").orderBy("range", "covers").toLocalIterator():
        if (entries and entries[-1][0] == row.range) or row.covers < used:
            continue
        entries.append((row.range, part, used))
        part, used = part + row.opened, row.used if row.opened else used + row.used
    starts = files.sparkSession.createDataFrame(entries, "__range int, __part bigint, __used bigint")
    entered = dealt.repartitionById(ranges, "__range").join(F.broadcast(starts), "__range")  # one row a range
    return _numbered(entered.sortWithinPartitions("__at"), limit)


def _entry(number: int, part: int, used: int) -> list[Column]:
    return [
        F.lit(number).alias("__range"),
        F.lit(part).cast("bigint").alias("__part"),
        F.lit(used).cast("bigint").alias("__used"),
    ]


def _numbered(entered: DataFrame, limit: int) -> DataFrame:
    kept = [f for f in entered.schema if not f.name.startswith("__")]
    schema = StructType([*kept, StructField("part", LongType())])
    return entered.mapInArrow(partial(workers.number_files, limit=limit, kept=[f.name for f in kept]), schema)


def number_parts(packed: DataFrame) -> DataFrame:
    """Adds `part`, dense from 0 over all shards."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        packed.groupBy("shard")
        .agg((F.max("local_part") + 1).alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_part"))
    )
    numbered = packed.join(offsets, "shard")
    return numbered.withColumn("part", F.col("first_part") + F.col("local_part")).drop(
        "first_part", "local_part", "shard"
    )


def part_sizes(packed: DataFrame) -> DataFrame:
    """Files and bytes of every part."""
    return packed.groupBy("shard", "local_part").agg(
        F.count("*").alias("n_files"), F.sum("size").alias("bytes")
    )


def task_count(spark: SparkSession, files: int, size: int) -> int:
    """Tasks for a copy: enough to use the cluster and to keep each one short."""
    wanted = max(spark.sparkContext.defaultParallelism, size // TASK_BYTES, files // TASK_FILES)
    return int(max(1, min(files, wanted)))


def few_tasks(spark: SparkSession) -> int:
    """Tasks for small lookups whose number is not known: one for each slot, however many shuffle partitions are set."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
