"""Helpers that the operators of this package share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of characters that are none of these: space, tab, line feed, \v, \f, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BREAK = r"[\x20\x09-\x0D]+"
LOWEST = -(2**63)
#: Code points of a block of a long text.
TEXT_BLOCK = 4096


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below `spark.checkpoint.dir`; below a temporary one only in local mode, where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}"
    return f"{base.rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back: it runs once, and lost executors cost only a reread.

    Shuffle files of the finished step are of no more use. Spark drops them once the JVM has collected what refers to
    them (two collections: the first frees the Python side's handles), so that the disk holds one step's shuffle at a time.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, label)
    df.write.parquet(folder)
    schema = df.schema
    del df
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)
    return spark.read.schema(schema).parquet(folder)


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, also where `body` uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, combine) -> Column:
    """What `combine`, an associative function, makes of each element and all before it.

    Each pass joins every element with the one 1, 2, 4, ... places before it. No array grows element by element, so long ones
    cost n log n; the array of an empty one is empty.
    """
    steps = F.array(*[F.lit(1 << e) for e in range(31)])
    joined = lambda x, d: F.transform(
        x, lambda v, i: F.when(i >= d, combine(F.get(x, i - d), v)).otherwise(v)
    )
    return let(values, lambda x: F.aggregate(F.filter(steps, lambda d: d < F.size(x)), x, joined))


def blocks_of(text: Column) -> Column:
    """The text in blocks of TEXT_BLOCK code points, for `part_of`."""
    last = F.floor(F.length(text) / TEXT_BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i * TEXT_BLOCK + 1, F.lit(TEXT_BLOCK)))


def part_of(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from `start` up to `end`, without counting from the start of the text."""
    first = F.floor(start / TEXT_BLOCK).cast("int")
    count = F.floor(end / TEXT_BLOCK).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(blocks, first + 1, count), ""), start - first * TEXT_BLOCK + 1, end - start)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches as array<struct<start, end, value, before>>.

    Positions are code points, `end` is exclusive; `value` is `group`'s text and `before` the text between
    this match and the one before it. `split` and `regexp_extract_all` walk over the same matches; running sums of what they
    give are the positions.
    """
    found = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        *([F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values")] if group else []),
    )

    def placed(f):
        lengths = F.transform(f["hits"], lambda hit, i: F.length(F.get(f["gaps"], i)) + F.length(hit))
        span = lambda ends, hit, i: F.struct(
            (F.get(ends, i) - F.length(hit)).alias("start"),
            F.get(ends, i).alias("end"),
            (F.get(f["values"], i) if group else hit).alias("value"),
            F.get(f["gaps"], i).alias("before"),
        )
        sums = running(lengths, lambda a, b: a + b)
        return let(sums, lambda ends: F.transform(f["hits"], lambda hit, i: span(ends, hit, i)))

    return let(found, placed)


def running_totals(df: DataFrame, block: str, order: list[str], value: str) -> DataFrame:
    """Adds `row_before`, `value_before` (rows and sum of `value` ahead in the order (block, *order)) and `value_total`.

    Only one row for each block meets in one place; `block` must be non-null, and its values few against the rows.
    """
    totals = df.groupBy(block).agg(F.count(F.lit(1)).alias("_rows"), F.sum(value).alias("_sum"))
    ahead = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col(block).alias("_block"),
        F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_rows_ahead"),
        F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_sum_ahead"),
        F.sum("_sum").over(Window.orderBy(block).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(
            "value_total"
        ),
    )
    inside = Window.partitionBy(block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_row", F.count(F.lit(1)).over(inside))
        .withColumn("_value", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(totals, F.col(block) == F.col("_block"))
        .withColumn("row_before", F.col("_row") + F.col("_rows_ahead"))
        .withColumn("value_before", F.col("_value") + F.col("_sum_ahead"))
        .drop("_block", "_rows_ahead", "_sum_ahead", "_row", "_value")
    )
