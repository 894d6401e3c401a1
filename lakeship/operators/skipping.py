"""Which files can hold rows that a condition asks for: an interval index over the logged file statistics.

The log keeps for each file its number of rows and, by column, least and greatest value and number of nulls. As a DataFrame
that is one row a file with typed columns, and a condition on rows becomes a condition on intervals. What the index does
not know is never skipped: files without statistics, columns of other types, conditions of other forms.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType, StructField, StructType,
)

from lakeship import storage, workers
from lakeship.functions import paths
from lakeship.operators import packing
from lakeship.sources.table import Snapshot, read_files, snapshot

#: Types whose least and greatest value in a Parquet footer are exact and order as Spark orders them.
INDEXED = (ByteType, ShortType, IntegerType, LongType, DecimalType, DateType, StringType)
#: Columns that get statistics, as many as the public format has by default.
STATS_COLUMNS = 32
#: Ranges that stand for the keys of a MERGE; more keys make them wider, never more numerous.
KEY_RANGES = 1024
LEAST, MOST, NULLS = "least", "most", "nulls"


def indexed_fields(schema: StructType) -> list[StructField]:
    """The columns that have intervals: top-level, plain types; strings only in binary order."""
    plain = [f for f in schema if isinstance(f.dataType, INDEXED)]
    return [f for f in plain if not isinstance(f.dataType, StringType) or f.dataType == StringType()][:STATS_COLUMNS]


def footer_stats(files: DataFrame, schema: StructType) -> DataFrame:
    """Adds `stats`, the statistics to log for new Parquet files (`source`), from footers that tasks read."""
    spark = files.sparkSession
    names = [f.name for f in indexed_fields(schema)]
    read = partial(workers.footer_stats, columns=names, options=storage.storage_options(spark))
    shape = StructType([*files.schema, StructField("stats", StringType())])
    return files.repartition(packing.few_tasks(spark)).mapInPandas(read, shape)


def interval_index(snap: Snapshot) -> DataFrame:
    """Live files with n_rows and, for each indexed column, its least and greatest value and its number of nulls.

    Columns of `snap.files` stay; intervals are structs named least, most and nulls. A partition column's interval is its
    one value. NULL stands for unknown.
    """
    data = indexed_fields(snap.data_schema)
    kinds = StructType([StructField(f.name, f.dataType) for f in data])
    counts = StructType([StructField(f.name, LongType()) for f in data])
    shape = StructType(
        [StructField("numRecords", LongType()), StructField("minValues", kinds), StructField("maxValues", kinds), StructField("nullCount", counts)]
    )
    stats = F.from_json("stats", shape)
    parts = {
        f.name: paths.blank_to_null(F.element_at("partition_values", F.lit(f.name))).cast(f.dataType)
        for f in snap.schema
        if f.name in snap.partition_columns
    }
    rows = F.col("__stats.numRecords")

    def side(logged: str) -> Column:
        known = [F.col(f"__stats.{logged}")[f.name].alias(f.name) for f in data]
        return F.struct(*known, *[value.alias(name) for name, value in parts.items()], F.lit(None).alias("__none"))

    blank = [F.when(value.isNull(), rows).otherwise(0).alias(name) for name, value in parts.items()]
    nulls = F.struct(*[F.col("__stats.nullCount")[f.name].alias(f.name) for f in data], *blank, F.lit(None).alias("__none"))
    return (
        snap.files.withColumn("__stats", stats)
        .select(*snap.files.columns, rows.alias("n_rows"), side("minValues").alias(LEAST), side("maxValues").alias(MOST), nulls.alias(NULLS))
    )


def _bounds(name: str) -> tuple[Column, Column, Column]:
    return F.col(LEAST)[name], F.col(MOST)[name], F.col(NULLS)[name]


#: What an interval says about a comparison with a value; the other side is turned around.
MAY_HOLD = {
    "EqualTo": lambda low, high, v: (low <= v) & (high >= v),
    "EqualNullSafe": lambda low, high, v: v.isNull() | ((low <= v) & (high >= v)),
    "LessThan": lambda low, high, v: low < v,
    "LessThanOrEqual": lambda low, high, v: low <= v,
    "GreaterThan": lambda low, high, v: high > v,
    "GreaterThanOrEqual": lambda low, high, v: high >= v,
}
TURNED = {
    "LessThan": "GreaterThan", "LessThanOrEqual": "GreaterThanOrEqual", "GreaterThan": "LessThan", "GreaterThanOrEqual": "LessThanOrEqual",
}


def may_hold(snap: Snapshot, condition: Column | str) -> Column:
    """The condition on the interval index that holds for every file in which the given condition is true of some row.

    Spark analyses the condition; of the result, AND, OR, comparisons of an indexed column with a constant, BETWEEN, IN, IS [NOT]
    NULL and startswith are rewritten. Everything else counts as possible.
    """
    names = {f.name for f in indexed_fields(snap.data_schema)}
    names |= {f.name for f in snap.schema if f.name in snap.partition_columns and isinstance(f.dataType, INDEXED)}
    analysed = snap.spark.createDataFrame([], snap.schema).where(condition)._jdf.queryExecution().analyzed()
    return F.coalesce(_rewritten(analysed.condition(), names), F.lit(True))


def _children(e) -> list:
    return [e.children().apply(i) for i in range(e.children().size())]


def _rewritten(e, names: set[str], shared: str | None = None) -> Column:
    """`shared` is the column behind the common expression that Spark makes of BETWEEN's left side."""
    kind, children = e.getClass().getSimpleName(), _children(e)
    if kind in ("And", "Or"):
        left, right = (F.coalesce(_rewritten(child, names, shared), F.lit(True)) for child in children)
        return left & right if kind == "And" else left | right
    if kind == "Between" and len(children) == 1:
        return _rewritten(children[0], names)
    if kind == "With" and len(children) == 2:
        return _rewritten(children[0], names, _column(_children(children[1])[0], names))
    column = _column(children[0], names, shared) if children else None
    if kind in MAY_HOLD:
        if column is None:
            children, kind = children[::-1], TURNED.get(kind, kind)
            column = _column(children[0], names, shared)
        value = _constant(children[1])
        if column is not None and value is not None:
            low, high, nulls = _bounds(column)
            filled = F.lit(True) if kind == "EqualNullSafe" else F.coalesce(F.col("n_rows") > nulls, F.lit(True))
            return filled & F.coalesce(MAY_HOLD[kind](low, high, value), F.lit(True))
    elif kind == "In" and column is not None:
        values = [_constant(child) for child in children[1:]]
        if all(value is not None for value in values):
            low, high, nulls = _bounds(column)
            unknown = (low.isNull() | high.isNull()) & F.coalesce(F.col("n_rows") > nulls, F.lit(True))
            return reduce(lambda a, b: a | b, [F.coalesce((low <= v) & (high >= v), F.lit(False)) for v in values], unknown)
    elif kind == "IsNull" and column is not None:
        return _bounds(column)[2] > 0
    elif kind == "IsNotNull" and column is not None:
        return F.col("n_rows") > _bounds(column)[2]
    elif kind == "StartsWith" and column is not None and (value := _constant(children[1])) is not None:
        low, high, _ = _bounds(column)
        size = F.length(value)
        return (F.substring(low, F.lit(1), size) <= value) & (F.substring(high, F.lit(1), size) >= value)
    return F.lit(True)


def _column(e, names: set[str], shared: str | None = None) -> str | None:
    """The indexed column that an expression is, also through a cast to the type it has."""
    kind = e.getClass().getSimpleName()
    if kind == "CommonExpressionRef":
        return shared
    if kind == "Cast" and e.dataType().equals(e.child().dataType()):
        return _column(e.child(), names, shared)
    name = e.name() if kind == "AttributeReference" else None
    return name if name in names else None


def _constant(e) -> Column | None:
    """A constant of the condition, such as a literal or a cast of one."""
    return F.expr(e.sql()) if e.foldable() and e.deterministic() else None


def candidate_files(snap: Snapshot, condition: Column | str) -> DataFrame:
    """Live files that may hold rows for which the condition is true."""
    return interval_index(snap).where(may_hold(snap, condition)).select(*snap.files.columns)


def key_ranges(keys: DataFrame, at_most: int = KEY_RANGES) -> DataFrame:
    """At most `at_most` ranges (low, high structs) that together hold every key; single keys where there are few.

    The keys are dealt out by ranges of the first column, and each range is aggregated: bounded, however many there are.
    """
    first = keys.columns[0]
    dealt = keys.repartitionByRange(at_most, F.col(f"`{first}`")).groupBy(F.spark_partition_id().alias("__range"))
    ends = [(F.min(F.col(f"`{c}`")).alias(f"low{i}"), F.max(F.col(f"`{c}`")).alias(f"high{i}")) for i, c in enumerate(keys.columns)]
    return dealt.agg(*[end for both in ends for end in both]).drop("__range")


def files_with_keys(snap: Snapshot, keys: DataFrame) -> DataFrame:
    """Live files whose intervals meet a range of the keys in every key column; `keys` holds no nulls.

    The ranges are broadcast: at most KEY_RANGES rows of two values a column.
    """
    indexed = {f.name for f in indexed_fields(snap.data_schema)}
    indexed |= {f.name for f in snap.schema if f.name in snap.partition_columns and isinstance(f.dataType, INDEXED)}
    usable = [c for c in keys.columns if c in indexed]
    if not usable or usable[0] != keys.columns[0]:
        keys = keys.select(*[f"`{c}`" for c in (*usable, *[c for c in keys.columns if c not in usable])])
    ranges = storage.materialize(key_ranges(keys), "key-ranges")
    meets = F.lit(True)
    for i, c in enumerate(keys.columns):
        if c in indexed:
            low, high, _ = _bounds(c)
            meets &= F.coalesce((low <= F.col(f"high{i}")) & (high >= F.col(f"low{i}")), F.lit(True))
    return interval_index(snap).join(F.broadcast(ranges), meets, "left_semi").select(*snap.files.columns)


def read_where(spark: SparkSession, table: str, condition: Column | str, as_of: int | None = None) -> DataFrame:
    """Rows of a table for which a condition is true; files that cannot hold such rows are not opened."""
    snap = snapshot(spark, table, as_of)
    return read_files(snap, candidate_files(snap, condition)).where(condition)
