"""Log replay: from file actions to the files that are live."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeship.functions import paths
from lakeship.functions.actions import vector_id

REPLAY_KEY = ("path", "dv_id")


def file_actions(actions: DataFrame) -> DataFrame:
    """Adds and removes as rows of one shape; `path` is decoded, `raw_path` as logged."""

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"add.{name}"), F.col(f"remove.{name}"))

    raw_path = either("path")
    return actions.where(raw_path.isNotNull()).select(
        "version",
        F.when(F.col("add.path").isNotNull(), "add").otherwise("remove").alias("op"),
        paths.decode_path(raw_path).alias("path"),
        vector_id(either("deletionVector")).alias("dv_id"),
        raw_path.alias("raw_path"),
        either("size").alias("size"),
        either("partitionValues").alias("partition_values"),
        F.col("add.modificationTime").alias("modified"),
        F.col("add.stats").alias("stats"),
        F.col("add.tags").alias("tags"),
        either("deletionVector").alias("vector"),
        F.col("remove.deletionTimestamp").alias("deleted"),
    )


def latest_actions(
    file_rows: DataFrame, key: Sequence[str] = REPLAY_KEY, keep: Sequence[str] | None = None
) -> DataFrame:
    """The last action of every key; a partial aggregate runs before the shuffle.

    Inside one commit an add outranks a remove, so file order never matters.
    Only the columns in `keep` (default: all) go through the shuffle.
    """
    payload = [c for c in file_rows.columns if c not in key and c not in ("version", "op")]
    payload = payload if keep is None else [c for c in payload if c in keep]
    order = F.struct(F.col("version"), F.col("op") == "add")
    last = F.max_by(F.struct("version", "op", *payload), order).alias("last")
    return file_rows.groupBy(*key).agg(last).select(*key, "last.*")


def active_files(
    file_rows: DataFrame, key: Sequence[str] = REPLAY_KEY, keep: Sequence[str] | None = None
) -> DataFrame:
    """Files whose last action is an add."""
    return latest_actions(file_rows, key, keep).where("op = 'add'").drop("op")


def last_of(actions: DataFrame, *kinds: str) -> DataFrame:
    """One row with the newest non-null value of each action kind."""
    return actions.agg(
        *[F.expr(f"max_by(`{k}`, version) FILTER (WHERE `{k}` IS NOT NULL)").alias(k) for k in kinds]
    )


def table_detail(active: DataFrame, *extra: Column) -> DataFrame:
    """File count, bytes and newest version of a set of live files."""
    return active.agg(
        F.count("*").alias("num_files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("size_in_bytes"),
        F.max("version").alias("version"),
        *extra,
    )


