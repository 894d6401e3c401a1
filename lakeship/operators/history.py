"""Questions about versions, answered from a listing or any DataFrame of versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _run_ends(versions: DataFrame) -> DataFrame:
    """Every version that is there, and whether its successor is absent.

    One scan emits every version as itself and as its predecessor's successor; one shuffle finds the ends, so
    no task ever sees the whole list.
    """
    marks = versions.select(
        F.inline(
            F.array(
                F.struct(F.col("version"), F.lit(True).alias("present")),
                F.struct((F.col("version") - 1).alias("version"), F.lit(False).alias("present")),
            )
        )
    )
    found = marks.groupBy("version").agg(F.bool_or("present").alias("present"), F.bool_and("present").alias("ends"))
    return found.where("present").select("version", "ends")


def _reached(start: int) -> Column:
    """Over `_run_ends`: the last version reached from `start` without a gap, NULL if `start` is absent."""
    last = F.min(F.when(F.col("ends") & (F.col("version") >= start), F.col("version")))
    return F.when(F.bool_or(F.col("version") == start), last)


def _per_start(one_row: DataFrame, starts: Sequence[int], answer: str, values: Sequence[Column]) -> DataFrame:
    rows = [
        F.struct(F.lit(v).cast("bigint").alias("from_version"), value.alias(answer)) for v, value in zip(starts, values)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def latest_version(versions: DataFrame, starts: Sequence[int] = (0,)) -> DataFrame:
    """(from_version, latest) for every start, from one scan; NULL where the start is absent."""
    reached = _run_ends(versions).agg(*[_reached(v).alias(f"r{i}") for i, v in enumerate(starts)])
    return _per_start(reached, starts, "latest", [F.col(f"r{i}") for i in range(len(starts))])


def missing_versions(versions: DataFrame, before: int) -> DataFrame:
    """Versions of 0..before-1 that are absent."""
    required = versions.sparkSession.range(0, before).toDF("version")
    return required.join(versions.select("version"), "version", "left_anti")


def history_ok(files: DataFrame, starts: Sequence[int]) -> DataFrame:
    """(from_version, history_ok) for every start, from one scan of the listing.

    A range needs all commits before it, or a complete checkpoint at or below its first version.
    """
    commits = _run_ends(files.where("kind = 'commit'"))
    checkpoints = complete_checkpoints(files).select(F.col("version").alias("checkpoint"))
    facts = commits.unionByName(checkpoints, allowMissingColumns=True).agg(
        _reached(0).alias("reached"), F.min("checkpoint").alias("checkpoint")
    )

    def enough(start: int) -> Column:
        by_checkpoint = F.coalesce(F.col("checkpoint") <= start, F.lit(False))
        return F.lit(start == 0) | by_checkpoint | F.coalesce(F.col("reached") >= start - 1, F.lit(False))

    return _per_start(facts, starts, "history_ok", [enough(v) for v in starts])


def newest_checkpoint(files: DataFrame, at_most: int | None = None) -> DataFrame:
    """At most one row: the newest checkpoint whose parts are all there, with fewest parts."""
    newest = complete_checkpoints(files, at_most).agg(F.max(F.struct("version", (-F.col("parts")).alias("fewest"))).alias("c"))
    return newest.where("c IS NOT NULL").select("c.version", (-F.col("c.fewest")).alias("parts"))


def complete_checkpoints(files: DataFrame, at_most: int | None = None) -> DataFrame:
    checkpoints = files.where("kind = 'checkpoint'")
    if at_most is not None:
        checkpoints = checkpoints.where(F.col("version") <= at_most)
    found = checkpoints.groupBy("version", "parts").agg(F.count("*").alias("found"))
    return found.where("found = parts").select("version", "parts")
