"""Versions that arrive in any order, as ranges that continue one another: a stateful streaming operator."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakeship import workers

RANGE_SCHEMA = "first bigint, last bigint"
STATE_SCHEMA = "next bigint, lows array<bigint>, highs array<bigint>"


def contiguous_ranges(versions: DataFrame, start: int = 0) -> DataFrame:
    """(first, last) of a stream of `version`s: the ranges that follow version `start - 1` without a gap, in order.

    A trigger gives at most one range, as soon as nothing before it is missing. The state is the next version and
    the intervals beyond gaps, so its size is the number of gaps; a log has one state, and tasks send it intervals.
    """

    def step(_, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        following, lows, highs = state.get if state.exists else (start, [], [])
        seen = [pair for part in parts for pair in zip(part["low"].tolist(), part["high"].tolist())]
        now, waiting = workers.advance(following, list(zip(lows, highs)), seen)
        state.update((now, [low for low, _ in waiting], [high for _, high in waiting]))
        if now > following:
            yield pd.DataFrame({"first": [following], "last": [now - 1]})

    intervals = versions.where("version IS NOT NULL").mapInPandas(workers.version_intervals, "low bigint, high bigint")
    return intervals.withColumn("log", F.lit(0)).groupBy("log").applyInPandasWithState(
        step, RANGE_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )
