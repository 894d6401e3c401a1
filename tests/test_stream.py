"""Versions that arrive late, twice or in another order, and the stream that ships them."""

import json
import os
import random
import shutil

import pytest

from lakeship import workers
from lakeship.operators import compare, write
from lakeship.plans import apply, export
from lakeship.sources import log, table
from lakeship.storage import ShippingError
from lakeship.streaming.frontier import contiguous_ranges
from lakeship.streaming.ship import commit_versions, ship_stream


def test_intervals_against_sets():
    chance = random.Random(2)
    for _ in range(300):
        following, waiting, seen, given = 3, [], set(), []
        for _ in range(8):
            batch = [chance.randint(0, 25) for _ in range(chance.randint(0, 6))]
            seen |= set(batch)
            now, waiting = workers.advance(following, waiting, [(v, v) for v in batch])
            given += range(following, now)
            following = now
            assert waiting == workers.merged((v, v) for v in seen if v >= following)
            assert not waiting or waiting[0][0] > following
        expected = []
        while 3 + len(expected) in seen:
            expected.append(3 + len(expected))
        assert given == expected


def touch(folder, *versions):
    os.makedirs(folder, exist_ok=True)
    for v in versions:
        with open(f"{folder}/{v:020d}.json", "w") as out:
            out.write("{}\n")


def test_ranges_of_a_stream(spark, place):
    root, state, got = place("table"), place("state"), []
    folder = f"{root}/_delta_log"

    def trigger(*versions):
        touch(folder, *versions)
        ranges = contiguous_ranges(commit_versions(spark, root), 2)
        query = ranges.writeStream.foreachBatch(lambda df, _: got.extend(tuple(r) for r in df.collect()))
        query.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        seen, got[:] = list(got), []
        return seen

    assert trigger(0, 1, 3, 4) == []
    assert trigger(7) == []
    assert trigger(2) == [(2, 4)]
    assert trigger() == []
    assert trigger(5, 6, 9) == [(5, 7)]
    touch(folder, 3)  # an old version again
    assert trigger(8) == [(8, 9)]


def build(spark, root, first, last):
    for v in range(first, last + 1):
        write.write_table(spark.range(v * 10, v * 10 + 5).coalesce(1), root)


def same(spark, source, target):
    return compare.compare_tables(spark, source, target).first().equal


def test_a_late_commit_holds_back_those_after_it(spark, place):
    source, target, state = place("source"), place("target"), place("state")
    build(spark, source, 0, 4)
    late = f"{source}/_delta_log/{2:020d}.json"
    shutil.move(late, late + ".aside")
    ship_stream(spark, source, target, state).awaitTermination()
    assert table.snapshot(spark, target).version == 1
    shutil.move(late + ".aside", late)
    ship_stream(spark, source, target, state).awaitTermination()
    assert table.snapshot(spark, target).version == 4 and same(spark, source, target)


def test_later_ranges_list_no_log(spark, place, monkeypatch):
    source, target, state = place("source"), place("target"), place("state")
    build(spark, source, 0, 8)
    ship_stream(spark, source, target, state).awaitTermination()
    build(spark, source, 9, 11)  # writes a checkpoint at 10
    listed, plain = [], log.list_log
    monkeypatch.setattr(log, "list_log", lambda s, t: listed.append(t) or plain(s, t))
    assert apply.ship_range(spark, source, target, 9, 11) is not None
    assert listed == []
    monkeypatch.undo()
    assert same(spark, source, target)
    assert os.path.exists(f"{target}/_delta_log/{10:020d}.checkpoint.parquet")
    with open(f"{target}/_delta_log/_last_checkpoint") as hint:
        assert json.load(hint)["version"] == 10
    assert apply.ship_range(spark, source, target, 9, 11) is None
    ship_stream(spark, source, target, state).awaitTermination()  # gives out 9..11, which are there


def test_ranges_that_do_not_continue_the_target(spark, place):
    source, target = place("source"), place("target")
    build(spark, source, 0, 5)
    apply.ship_range(spark, source, target, 3, 4)  # a new target: it gets everything
    assert table.snapshot(spark, target).version == 5
    behind = place("behind")
    export.export(spark, source, source + "-b")
    apply.import_bundle(spark, source + "-b.zip", behind)
    for v in (4, 5):
        os.remove(f"{behind}/_delta_log/{v:020d}.json")
    apply.ship_range(spark, source, behind, 5, 5)
    assert same(spark, source, behind)


def test_a_source_without_the_next_version(spark, place):
    source, target = place("source"), place("target")
    build(spark, source, 0, 3)
    os.remove(f"{source}/_delta_log/{0:020d}.json")
    with pytest.raises(ShippingError, match="but not 0"):
        ship_stream(spark, source, target, place("state"))
