"""Logged statistics, and which files they rule out; rows are compared with reads of everything."""

import json
import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeship.operators import dml, skipping, write
from lakeship.sources import table

SCHEMA = "id long, small int, name string, day date, price decimal(10,2), kind string"


def build(spark, root, partition_by=(), **options):
    """Eight files of 25 ids each; `small` is null in the last one, `name` is long in the first."""
    rows = [
        (i, None if i >= 175 else i % 7, ("x" * 100 if i < 25 else "n") + f"{i:03d}", date(2020, 1 + i // 25, 1 + i % 25),
         Decimal(i) / 4, "abc"[i % 3])
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartitionByRange(8, "id").sortWithinPartitions("id")
    for part in range(8):
        write.write_table(df.where(f"id div 25 = {part}").coalesce(1), root, partition_by=list(partition_by), **options)
    return root


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


CONDITIONS = [
    ("id = 30", 1), ("30 = id", 1), ("id = 30 OR id = 180", 2), ("id >= 150 AND id < 160", 1), ("160 > id AND id >= 150", 1),
    ("id BETWEEN 40 AND 80", 3), ("id IN (1, 2, 199)", 2), ("id IN (1, NULL)", 1), ("id <=> 30", 1), ("id > 1000", 0), ("id < 0", 0),
    ("small IS NULL", 1), ("small IS NOT NULL", 7), ("small = 3 AND id > 170", 1), ("name = 'n100'", 1), ("startswith(name, 'n10')", 1),
    ("startswith(name, 'xx')", 1), ("name > 'w'", 1), ("day = DATE'2020-03-04'", 1), ("day < DATE'2020-02-01'", 1), ("price = 12.50", 1),
    ("price > 49", 1), ("NOT (id = 3)", 8), ("id % 10 = 0", 8), ("id = small", 8), ("id = 30 AND kind = 'z'", 0), ("id + 1 = 31", 8),
    ("(id = 3 OR id % 2 = 0) AND id < 60", 3), ("id = 5 + 5", 1), ("id = NULL", 8), ("true", 8),
]


@pytest.fixture(scope="module")
def plain(spark, tmp_path_factory):
    return build(spark, str(tmp_path_factory.mktemp("skipping") / "plain"))


@pytest.mark.parametrize("condition, most", CONDITIONS)
def test_conditions(spark, plain, condition, most):
    snap = table.snapshot(spark, plain)
    found = skipping.candidate_files(snap, condition)
    assert found.count() <= most
    assert ids(table.read_files(snap, found).where(condition)) == ids(table.read_files(snap).where(condition))


def test_only_candidates_are_opened(spark, plain):
    assert len(skipping.read_where(spark, plain, "id = 30").inputFiles()) == 1
    assert ids(skipping.read_where(spark, plain, (F.col("id") > 20) & (F.col("id") < 30))) == list(range(21, 30))
    assert len(skipping.read_where(spark, plain, "id = 30", as_of=0).inputFiles()) == 0


def test_statistics_in_the_log(spark, plain):
    with open(f"{plain}/_delta_log/{7:020d}.json") as commit:
        (add,) = [json.loads(line)["add"] for line in commit if '"add"' in line]
    stats = json.loads(add["stats"])
    assert stats["numRecords"] == 25 and stats["nullCount"]["small"] == 25 and "small" not in stats["minValues"]
    assert (stats["minValues"]["id"], stats["maxValues"]["id"], stats["maxValues"]["day"]) == (175, 199, "2020-08-25")
    assert '"price":43.75' in add["stats"]
    index = skipping.interval_index(table.snapshot(spark, plain)).where("least.id = 0").first()
    assert index.least.name == "x" * 64 and index.most["name"] is None and index.most.price == Decimal("6.00")


def test_files_without_statistics_stay(spark, place):
    root = build(spark, place())
    for version in (2, 3):
        path = f"{root}/_delta_log/{version:020d}.json"
        with open(path) as commit:
            lines = [json.loads(line) for line in commit]
        for line in lines:
            if "add" in line:
                line["add"]["stats"] = None if version == 2 else '{"numRecords": broken'
        os.remove(f"{root}/_delta_log/.{version:020d}.json.crc")
        with open(path, "w") as commit:
            commit.write("\n".join(json.dumps(line) for line in lines) + "\n")
    snap = table.snapshot(spark, root)
    assert skipping.candidate_files(snap, "id = 0").count() == 3
    assert ids(skipping.read_where(spark, root, "id IN (60, 80)")) == [60, 80]


def test_partition_columns_and_added_columns(spark, place):
    root = build(spark, place(), ["kind"])
    assert len(skipping.read_where(spark, root, "kind = 'a' AND id < 25").inputFiles()) == 1
    more = spark.createDataFrame([(500, "new")], "id long, extra string")
    write.write_table(more, root, merge_schema=True)
    snap = table.snapshot(spark, root)
    assert skipping.candidate_files(snap, "kind IS NULL").count() == 1
    assert ids(skipping.read_where(spark, root, "extra IS NULL AND id > 197")) == [198, 199]
    assert ids(skipping.read_where(spark, root, "extra = 'new'")) == [500]
    assert ids(skipping.read_where(spark, root, "kind IS NULL")) == [500]


def opened(monkeypatch):
    """Files that DML hands to its searches, per call."""
    seen, read = [], table.read_files

    def watched(snap, files=None, with_position=False):
        rows = read(snap, files, with_position)
        if with_position:
            seen.append(len(rows.inputFiles()))
        return rows

    monkeypatch.setattr(table, "read_files", watched)
    return seen


def test_dml_opens_few_files(spark, place, monkeypatch):
    root = build(spark, place())
    seen = opened(monkeypatch)
    dml.update(spark, root, "id = 30", {"name": "'changed'"})
    dml.delete(spark, root, "id BETWEEN 50 AND 54")
    dml.update(spark, root, "id > 10000", {"name": "'none'"})
    changes = table.read_table(spark, root).where("id IN (3, 180)").withColumn("small", F.lit(99))
    changes = changes.unionByName(changes.where("id = 3").withColumn("id", F.lit(700).cast("long")))
    dml.merge(spark, root, changes, "id")
    assert seen == [1, 1, 0, 2]
    rows = {r.id: r for r in table.read_table(spark, root).collect()}
    assert sorted(rows) == [*range(50), *range(55, 200), 700]
    assert rows[30].name == "changed" and {i for i, r in rows.items() if r.small == 99} == {3, 180, 700}


def test_merge_with_several_keys_and_many_of_them(spark, place, monkeypatch):
    root = build(spark, place())
    monkeypatch.setattr(skipping, "KEY_RANGES", 4)
    seen = opened(monkeypatch)
    two = table.read_table(spark, root).where("id IN (3, 20) ").withColumn("price", F.lit(0).cast("decimal(10,2)"))
    dml.merge(spark, root, two, ["kind", "id"])
    dml.merge(spark, root, table.read_table(spark, root).where("id % 5 = 0").withColumn("small", F.lit(55)), "id")
    dml.merge(spark, root, two.withColumn("id", F.col("id") + 1000), ["id", "kind"])
    assert seen[0] == 1 and seen[1] >= 8 and seen[2] == 0
    rows = table.read_table(spark, root)
    assert rows.count() == 202 and rows.where("small = 55").count() == 40 and rows.where("price = 0").count() == 5


def test_key_ranges_hold_every_key(spark):
    keys = spark.range(10_000).select((F.col("id") * 37 % 10_007).alias("k"))
    ranges = [tuple(r) for r in skipping.key_ranges(keys, 16).collect()]
    assert len(ranges) <= 16
    assert all(any(low <= r.k <= high for low, high in ranges) for r in keys.collect())
