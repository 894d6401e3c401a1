"""Differences between two tables by a tree of hashed buckets: only rows of buckets that differ are shuffled.

A row falls into a leaf by its own hash, and leaves into branches. First every branch's rows are summed on both sides; then
the leaves of the branches that differ; what remains are the rows of leaves that differ, which are counted as whole rows.
Sums are combined before the shuffle, so what moves is a few numbers a bucket and task, and for equal tables nothing else.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeship import storage
from lakeship.functions.checksum import hashable

BRANCHES = 4096
#: Leaves are as many as the rows that have to be told apart, up to this number: their bitmap is at most 16 MiB.
MOST_LEAF_BITS = 27
#: Bits in one piece of a bitmap (as Spark's bitmap functions cut it).
PIECE_BITS = 32_768


def _hashed(df: DataFrame, side: int, columns: list[str]) -> DataFrame:
    """Rows with their side, a hash for their place in the tree, and two halves of another one for the sums."""
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    flagged = [part for c in hashable(rows) for part in (c, c.isNull())]
    other = F.xxhash64(F.lit(1), *flagged)
    return rows.withColumns(
        {
            "__side": F.lit(side),
            "__place": F.xxhash64(*flagged),
            "__high": F.shiftrightunsigned(other, 32),
            "__low": other.bitwiseAND(0xFFFFFFFF),
        }
    )


def _branch() -> Column:
    return F.pmod(F.col("__place"), F.lit(BRANCHES)).cast("int")


def _leaf(bits: int) -> Column:
    """Bits of the hash that the branch does not use."""
    return F.shiftrightunsigned(F.col("__place"), 12).bitwiseAND((1 << bits) - 1)


def _differing(both: DataFrame, bucket: Column) -> DataFrame:
    """(bucket, n): buckets whose rows, or sums of them, are not the same on the two sides."""

    def on(side: int, value: Column) -> Column:
        return F.sum(F.when(F.col("__side") == side, value).otherwise(F.lit(0)))

    values = [F.lit(1).cast("long"), F.col("__high"), F.col("__low")]
    sums = both.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n"), *[on(side, v).alias(f"{name}{i}") for i, v in enumerate(values) for side, name in ((1, "a"), (0, "b"))]
    )
    return sums.where("a0 <> b0 OR a1 <> b1 OR a2 <> b2").select("bucket", "n")


def differing_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of both sides (`__side` 1 and 0) that lie in leaves that differ; no row with another number of copies is left out.

    Three passes at most read the tables, and none of them shuffles rows. A branch or leaf that differs is kept whole.
    Two buckets of other content would have to agree in a 64-bit sum of hashes to be taken for equal.
    """
    columns = source.columns
    both = _hashed(source, 1, columns).unionByName(_hashed(target, 0, columns))
    branches = _differing(both, _branch()).collect()  # BRANCHES rows at most
    if not branches:
        return both.limit(0)
    if len(branches) < BRANCHES:
        both = both.where(_branch().isin([row.bucket for row in branches]))
    bits = min(MOST_LEAF_BITS, max(1, math.ceil(math.log2(sum(row.n for row in branches)))))
    leaves = storage.materialize(_differing(both, _leaf(bits)).select("bucket"), "leaves")
    pieces = leaves.groupBy((F.col("bucket") / PIECE_BITS).cast("long").alias("__piece")).agg(
        F.bitmap_construct_agg(F.pmod(F.col("bucket"), F.lit(PIECE_BITS))).alias("__bits")
    )
    inside = F.pmod(_leaf(bits), F.lit(PIECE_BITS))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (inside / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, (inside % 8).cast("int")) == 1
    located = both.withColumn("__piece", (_leaf(bits) / PIECE_BITS).cast("long"))
    # at most 4096 pieces of 4 KiB
    return located.join(F.broadcast(pieces), "__piece").where(marked).drop("__piece", "__bits")


def diff_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with both numbers: n_source, n_target. Columns are those of `source`.

    Rows compare as groups do: NULL equals NULL. Both sides must have the same types, none of them nested.
    """
    columns = [F.col(f"`{c}`") for c in source.columns]
    counted = differing_rows(source, target).groupBy(*columns).agg(
        F.sum(F.col("__side").cast("long")).alias("n_source"), F.sum((1 - F.col("__side")).cast("long")).alias("n_target")
    )
    return counted.where("n_source <> n_target")
