"""Checksums of files and versions, and differences by a tree of hashes, against plain counts."""

import os
import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeship.functions import checksum
from lakeship.operators import compare, dml, fingerprints, hashtree, write
from lakeship.plans import apply, export
from lakeship.sources import table
from lakeship.storage import ShippingError

# --- row texts ------------------------------------------------------------------

KINDS = (
    "a int, b string, c double, d decimal(9,3), e date, f timestamp, g timestamp_ntz, h binary, i boolean, "
    "j array<string>, k map<string,int>, l struct<x:int,y:string>, m array<struct<z:binary>>"
)
ROW = (
    1, "x|y", 1.5, Decimal("2.125"), date(2020, 2, 29), datetime(2020, 1, 2, 3, 4, 5, 6), datetime(2021, 1, 1), b"\x00\xff", True,
    ["p", None], {"u": 1, "t": 2}, (3, None), [(b"q",)],
)


def number(spark, rows, schema=KINDS):
    return checksum.table_checksum(spark.createDataFrame(rows, schema)).first()


def test_every_value_and_null_counts(spark):
    seen = {number(spark, [ROW]).checksum}
    others = [2, "x|z", 1.25, Decimal("2.126"), date(2020, 3, 1), datetime(2020, 1, 2, 3, 4, 5, 7), datetime(2021, 1, 2), b"\x00", False,
              ["p", "None"], {"u": 1, "t": 3}, (3, ""), [(b"r",)]]
    for i, other in enumerate(others):
        for value in (other, None):
            seen.add(number(spark, [ROW[:i] + (value,) + ROW[i + 1 :]]).checksum)
    assert len(seen) == 1 + 2 * len(others)
    pairs = [("a|b", "c"), ("a", "b|c"), ("a,b=1:c", None), ("a", "c"), ("", None), (None, ""), (None, None)]
    assert len({number(spark, [p], "a string, b string").checksum for p in pairs}) == len(pairs)


def test_order_and_added_columns_do_not_count(spark):
    rows = [(1, "x"), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "a int, b string")
    whole = checksum.table_checksum(df).first().checksum
    assert checksum.table_checksum(df.select("b", "a").orderBy(F.desc("a"))).first().checksum == whole
    assert checksum.table_checksum(df.withColumn("later", F.lit(None).cast("int"))).first().checksum == whole
    parts = [checksum.table_checksum(spark.createDataFrame([r], "a int, b string")).first().checksum for r in rows]
    assert sum(parts) == whole


# --- files ----------------------------------------------------------------------


def total(spark, root, as_of=None):
    return fingerprints.version_checksum(spark, root, as_of).first()


def full(spark, root, as_of=None):
    row = checksum.table_checksum(table.read_table(spark, root, as_of)).first()
    return row.n_rows, row.checksum


def grow(spark, root):
    """Versions of appends, an update, a delete, a new column, an overwrite; yields after each."""
    rows = spark.range(100).withColumn("value", F.concat(F.lit("v"), "id"))
    write.write_table(rows.repartition(4), root)
    yield
    write.write_table(spark.range(100, 120).withColumn("value", F.lit("w")).coalesce(1), root)
    yield
    dml.update(spark, root, "id = 7", {"value": "'seven'"})
    yield
    dml.delete(spark, root, "id = 8")
    yield
    more = spark.range(120, 125).withColumn("value", F.lit(None).cast("string")).withColumn("extra", F.lit(1)).coalesce(1)
    write.write_table(more, root, merge_schema=True)
    yield
    write.write_table(spark.range(0).selectExpr("id", "'x' AS value", "1 AS extra"), root, "overwrite")
    yield


def test_every_version_is_proved_from_its_new_files(spark, place):
    root, read = place(), []
    for version, _ in enumerate(grow(spark, root)):
        row = total(spark, root)
        assert (row.version, row.n_rows, row.checksum) == (version, *full(spark, root))
        read.append(row.files_read)
        assert total(spark, root).files_read == 0
    assert read == [4, 1, 1, 1, 1, 1] or read == [4, 1, 1, 1, 1, 0]
    for version in range(5):
        row = total(spark, root, version)
        assert (row.n_rows, row.checksum) == full(spark, root, version) and row.files_read == 0


def test_rounds_of_a_shipment_read_only_what_they_bring(spark, place):
    source, target = place("source"), place("target")
    steps = grow(spark, source)
    for expected in (4, 1, 1):
        next(steps)
        apply.ship(spark, source, target)
        row = fingerprints.verify_content(spark, source, target).first()
        assert row.source_files_read == row.target_files_read == expected
        assert (row.target_n_rows, row.target_checksum) == full(spark, source)
    assert fingerprints.verify_content(spark, source, target).first().target_files_read == 0


def test_other_rows_are_found(spark, place):
    source, target = place("source"), place("target")
    next(grow(spark, source))
    export.export(spark, source, source + "-b")
    apply.import_bundle(spark, source + "-b.zip", target)
    path = table.snapshot(spark, target).files.agg(F.min("path")).first()[0]
    write.write_table(spark.range(25).withColumn("value", F.lit("other")).coalesce(1), place("x"))
    other = place("other")
    spark.range(25).withColumn("value", F.lit("other")).coalesce(1).write.parquet(other)
    (name,) = [n for n in os.listdir(other) if n.endswith(".parquet")]
    os.replace(f"{other}/{name}", f"{target}/{path}")
    crc = os.path.join(target, os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(ShippingError, match=f"such as those of {path}"):
        fingerprints.verify_content(spark, source, target)


# --- differences ----------------------------------------------------------------


def plain_diff(a, b):
    a, b = Counter(a), Counter(b)
    return sorted(((*row, a[row], b[row]) for row in a.keys() | b.keys() if a[row] != b[row]), key=str)


def found_diff(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_differences_of_random_tables(spark):
    chance = random.Random(6)
    schema = "k long, v string, d double"
    for size, changed in ((0, 0), (50, 50), (3000, 5), (3000, 300), (3000, 0)):
        a = [(chance.choice([None, chance.randint(0, size)]), chance.choice(["a", None, "c"]), chance.choice([0.5, None])) for _ in range(size)]
        b = list(a)
        chance.shuffle(b)
        for _ in range(changed):
            b[chance.randrange(size)] = (chance.randint(0, size), "new", None)
        b += b[:changed]
        ours, theirs = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
        assert found_diff(compare.diff_rows(ours, theirs)) == plain_diff(a, b)
        assert found_diff(compare.diff_rows(theirs, ours)) == plain_diff(b, a)
    other = spark.createDataFrame([(1, "a")], "k int, v string")
    assert compare.diff_rows(other, other.withColumn("k", F.col("k").cast("long"))).count() == 0
    nested = spark.createDataFrame([((None, 1),)], "s struct<a:int,b:int>")
    assert compare.diff_rows(nested, spark.createDataFrame([((1, None),)], nested.schema)).count() == 2
    maps = spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    assert compare.diff_rows(maps, maps).count() == 0 and compare.diff_rows(maps, maps.limit(0)).count() == 1


def test_few_rows_move(spark):
    source = spark.range(200_000).withColumn("text", F.concat(F.lit("some text "), "id"))
    assert hashtree.differing_rows(source, source).count() == 0
    target = source.withColumn("text", F.when(F.col("id") % 100 == 0, "changed").otherwise(F.col("text")))
    moved = hashtree.differing_rows(source, target)
    assert 4_000 <= moved.count() <= 12_000  # of 400,000 rows; 4,000 differ
    assert found_diff(hashtree.diff_rows(source, target).agg(F.count("*"), F.sum("n_source"), F.sum("n_target"))) == [(4000, 2000, 2000)]


def test_leaves_are_bounded(spark, monkeypatch):
    """With too few leaves more rows move; the result is the same."""
    monkeypatch.setattr(hashtree, "MOST_LEAF_BITS", 2)
    monkeypatch.setattr(hashtree, "PIECE_BITS", 32_768)
    source = spark.range(1000).withColumn("v", F.col("id") % 7)
    target = source.where("id <> 5").unionByName(source.where("id = 9"))
    assert found_diff(hashtree.diff_rows(source, target)) == sorted([(5, 5, 1, 0), (9, 2, 1, 2)], key=str)
