"""Are two tables the same?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from lakeship.functions.checksum import table_checksum
from lakeship.operators import hashtree
from lakeship.operators.write import nullable
from lakeship.sources.table import read_files, snapshot


def compare_tables(spark: SparkSession, source: str, target: str) -> DataFrame:
    """One row: versions, row counts, schemas and checksums of both, and a verdict."""
    a, b = snapshot(spark, source), snapshot(spark, target)
    both = [
        table_checksum(read_files(snap)).select(F.lit(side).alias("side"), "*")
        for side, snap in (("source", a), ("target", b))
    ]
    sides = both[0].unionByName(both[1])

    def pick(side: str, column: str):
        return F.max(F.when(F.col("side") == side, F.col(column))).alias(f"{side}_{column}")

    picked = [pick(side, c) for c in ("n_rows", "hash_sum", "checksum") for side in ("source", "target")]
    equal = [F.col(f"source_{c}") == F.col(f"target_{c}") for c in ("version", "n_rows", "hash_sum", "checksum")]
    return (
        sides.agg(*picked)
        .withColumn("source_version", F.lit(a.version).cast("bigint"))
        .withColumn("target_version", F.lit(b.version).cast("bigint"))
        .withColumn("same_schema", F.lit(nullable(a.schema) == nullable(b.schema)))
        .withColumn("equal", F.col("same_schema") & equal[0] & equal[1] & equal[2] & equal[3])
    )


def diff_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with both numbers; see `hashtree`.

    Rows with nested columns, whose hashes do not see where a null is, are counted without the tree.
    """
    kinds = [{f.name: f.dataType for f in df.schema} for df in (source, target)]
    if kinds[0] == kinds[1] and not any(isinstance(f.dataType, (StructType, ArrayType, MapType)) for f in source.schema):
        return hashtree.diff_rows(source, target)
    return count_copies(source, target)


def count_copies(source: DataFrame, target: DataFrame) -> DataFrame:
    """The same without a tree: one aggregation over the union of all rows answers both directions with one shuffle."""
    columns = [F.col(f"`{c}`") for c in source.columns]
    tagged = source.select(*columns, F.lit(1).alias("__side")).unionByName(
        target.select(*columns, F.lit(0).alias("__side"))
    )
    return (
        tagged.groupBy(*columns)
        .agg(
            F.sum("__side").alias("n_source"),
            (F.count("*") - F.sum("__side")).alias("n_target"),
        )
        .where("n_source <> n_target")
    )
