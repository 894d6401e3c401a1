"""UPDATE, DELETE and MERGE on a table: rewrite the files they touch, then commit."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeship import storage
from lakeship.operators import skipping, write
from lakeship.sources import table as source
from lakeship.sources.table import FILE_PATH, Snapshot
from lakeship.storage import ShippingError


def _repeatable(rows: DataFrame, *values: Column) -> None:
    """Rows are read twice, so what decides about them must give the same answer both times."""
    plan = rows.select(*values)._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        raise ShippingError("conditions and values must give the same result at every evaluation")


def _as_column(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _touched(snap: Snapshot, hits: DataFrame) -> DataFrame:
    """Live files that hold at least one of the given rows, written down once."""
    names = hits.select(FILE_PATH).distinct()
    files = snap.files.withColumn(FILE_PATH, source.file_key(snap))
    return storage.materialize(files.join(names, FILE_PATH, "left_semi").drop(FILE_PATH), "touched")


def _rewrite(snap: Snapshot, touched: DataFrame, rows: DataFrame | None, operation: str) -> int:
    actions = [write.removes(touched)]
    if rows is not None:
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in snap.schema]
        actions.append(write.write_files(rows.select(*columns), snap.table, snap.partition_columns))
    return _commit(snap, write.union_actions(actions), operation)


def _commit(snap: Snapshot, actions: DataFrame, operation: str) -> int:
    settings = snap.metadata["configuration"] or {}
    return write.commit(snap.spark, snap.table, snap.version + 1, actions, operation, settings)


@storage.tidy
def update(
    spark: SparkSession, table: str, condition: Column | str, assignments: dict[str, Column | str]
) -> int:
    """Set columns of the rows where the condition is true; NULL counts as false.

    Only files whose logged statistics leave room for such rows are opened.
    """
    snap = write.require_writable(source.snapshot(spark, table), removes_rows=True, changes_rows=True)
    unknown = set(assignments) - set(snap.schema.names)
    if unknown:
        raise ShippingError(f"{table} has no columns {sorted(unknown)}")
    condition = _as_column(condition)
    found = source.read_files(snap, skipping.candidate_files(snap, condition), with_position=True)
    _repeatable(found, condition)
    touched = _touched(snap, found.where(condition))
    if touched.isEmpty():
        return snap.version
    rows = source.read_files(snap, touched)
    columns = [
        F.when(condition, _as_column(assignments[f.name]).cast(f.dataType))
        .otherwise(F.col(f"`{f.name}`"))
        .alias(f.name)
        if f.name in assignments
        else F.col(f"`{f.name}`")
        for f in snap.schema
    ]
    return _rewrite(snap, touched, rows.select(*columns), "UPDATE")


@storage.tidy
def delete(spark: SparkSession, table: str, condition: Column | str | None = None) -> int:
    """Delete the rows where the condition is true; no condition deletes all.

    A condition on partition columns alone only drops whole files from the log. Other files that hold such rows are
    rewritten, also in tables that allow deletion vectors; rows that a vector marks already are left out then.
    """
    snap = write.require_writable(source.snapshot(spark, table), removes_rows=True, changes_rows=True)
    if condition is None:
        return _rewrite(snap, snap.files, None, "DELETE")
    condition = _as_column(condition)
    whole = _whole_partitions(snap, condition)
    if whole is not None:
        whole = storage.materialize(whole, "touched")
        return snap.version if whole.isEmpty() else _rewrite(snap, whole, None, "DELETE")
    found = source.read_files(snap, skipping.candidate_files(snap, condition), with_position=True)
    _repeatable(found, condition)
    touched = _touched(snap, found.where(condition))
    if touched.isEmpty():
        return snap.version
    kept = source.read_files(snap, touched).where(~F.coalesce(condition, F.lit(False)))
    return _rewrite(snap, touched, kept, "DELETE")


def _whole_partitions(snap: Snapshot, condition: Column) -> DataFrame | None:
    """Files to drop if the condition needs partition columns only, else None."""
    if not snap.partition_columns:
        return None
    typed = source.with_partition_columns(snap)
    try:
        typed.select(*snap.partition_columns).where(condition).schema
    except AnalysisException:
        return None
    return source.partition_files(snap, condition)


@storage.tidy
def merge(spark: SparkSession, table: str, changes: DataFrame, key: str | list[str]) -> int:
    """Upsert by key: rows with a known key replace the old ones, others are inserted.

    Only files whose intervals meet the ranges of the keys are searched for them.
    The changes are written down first, so that a source that gives other rows when read again does no harm.
    """
    keys = [key] if isinstance(key, str) else list(key)
    snap = write.require_writable(source.snapshot(spark, table), removes_rows=True, changes_rows=True)
    if set(changes.columns) != set(snap.schema.names):
        raise ShippingError(f"columns {changes.columns} are not those of {table}")
    changes = storage.materialize(changes, "changes")
    matchable = changes.dropna(subset=keys)
    if not matchable.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ShippingError(f"the changes hold more than one row for a key of {keys}")
    known = matchable.select(*keys)
    near = skipping.files_with_keys(snap, known)
    hits = source.read_files(snap, near, with_position=True).select(*keys, FILE_PATH).join(known, keys, "left_semi")
    touched = _touched(snap, hits)
    rows = changes.select(*snap.schema.names)
    if touched.isEmpty():
        return write.write_table(rows, snap.table, "append")
    kept = source.read_files(snap, touched).join(known, keys, "left_anti")
    return _rewrite(snap, touched, kept.select(*snap.schema.names).unionByName(rows), "MERGE")
