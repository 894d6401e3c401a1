"""Contiguous, balanced shards from global prefix sums of byte sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeship.llm.common import LOWEST, running_totals, settle, whole_text

ROW_BYTES = 8


def shard_by_bytes(
    df: DataFrame, order: list[Column], size: Column, shards: int = 24, keep: dict[str, Column] | None = None
) -> DataFrame:
    """Cut all rows, in the order given, into `shards` contiguous runs of nearly equal size.

    Rows are dealt out by ranges of the whole order, so equal leading values do not meet in one task. Each
    range's rows and bytes are summed, the sums of the ranges are accumulated (one row a range), and a row goes to
    the shard in which its middle byte lies; so each shard is within one row's size of the target.
    Returns the columns of `keep`, `size`, `shard` and `slot` (0, 1, ... within the shard).

    Nulls come first in the order; rows that are equal in it take neighbouring places. Rows of size 0 are
    placed like others; if all sizes are 0, every row is in shard 0. No row: no result.
    """
    keys = [f"_k{i}" for i in range(len(order))]
    rows = df.select(
        *[c.alias(f"_out_{name}") for name, c in (keep or {}).items()],
        *[c.alias(k) for k, c in zip(keys, order, strict=True)],
        size.cast("long").alias("size"),
    )
    rows = rows.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    rows = settle(rows, "shard")  # from here on, a row's range is a stored fact
    rows = running_totals(rows, "_range", [*keys, "size"], "size")
    target = F.expr(f"((value_before * 2 + size) * {shards}) div greatest(value_total * 2, 1)")
    placed = rows.withColumn("shard", F.least(target, F.lit(shards - 1)).cast("int"))
    firsts = placed.groupBy(F.col("shard").alias("_shard")).agg(F.min("row_before").alias("_first"))
    placed = placed.join(F.broadcast(firsts), F.col("shard") == F.col("_shard"))  # one row a shard
    return placed.select(
        *[F.col(f"_out_{name}").alias(name) for name in (keep or {})],
        "size",
        "shard",
        (F.col("row_before") - F.col("_first")).alias("slot"),
    )


def op4_prefix_sum_shards(df: DataFrame, shards: int = 24) -> DataFrame:
    """All documents in `shards` shards under the law `bytes`; columns of the contract, one row a document.

    Size: UTF-8 bytes of the text (null: none) plus 8. Documents are in the order of their text's MD5, then
    doc_id, so equal texts are neighbours: they share a shard unless a cut falls between them.
    """
    text = whole_text()
    return shard_by_bytes(
        df,
        order=[F.md5(text), F.coalesce(F.col("doc_id"), F.lit(LOWEST))],
        size=F.octet_length(text) + F.lit(ROW_BYTES),
        shards=shards,
        keep={"doc_id": F.col("doc_id"), "text_crc32": F.crc32(text)},
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
