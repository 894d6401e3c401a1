"""Files above the size of a range: many tasks copy them, and their checksums are joined."""

import os
import zlib

import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_resume import block, build, data_files, same, statuses

from lakeship import workers
from lakeship.operators import ledger, ranges, write
from lakeship.plans import apply, export
from lakeship.storage import ShippingError


@given(st.lists(st.binary(max_size=300), max_size=6))
def test_checksums_of_pieces_join(pieces):
    crc = 0
    for piece in pieces:
        crc = workers.joined_crc(crc, zlib.crc32(piece), len(piece))
    assert crc == zlib.crc32(b"".join(pieces))


@pytest.mark.parametrize("size,expected", [(99, []), (100, []), (101, [100, 1]), (200, [100, 100]), (350, [100, 100, 100, 50])])
def test_ranges_cover_a_file_once(spark, place, size, expected):
    path = place("file")
    with open(path, "wb") as file:
        file.write(b"x" * size)
    row = [("p", "data", size, None, f"file:{path}", None, True)]
    files = spark.createDataFrame(row, "path string, kind string, size bigint, stamp bigint, source string, entry string, seekable boolean")
    found = ranges.divide(ranges.large_files(files, 100), 100).orderBy("at").collect()
    assert [r.length for r in found] == expected
    assert [r.at for r in found] == [100 * i for i in range(len(expected))]


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_BYTES", 500)


def crcs(report):
    return {r.path: (r.size, r.crc) for r in report.where("kind = 'data'").collect()}


def on_disk(root):
    found = {}
    for path in data_files(root):
        with open(path, "rb") as file:
            body = file.read()
        found[os.path.relpath(path, root)] = (len(body), zlib.crc32(body))
    return found


def test_ship_and_import_by_ranges(spark, place, small_ranges):
    source, out = build(spark, place("source")), place("bundle")
    assert all(size > 500 for size, _ in on_disk(source).values())
    target, copy = place("target"), place("copy")
    report = apply.ship(spark, source, target)
    assert statuses(report) == {"copied": 6} and crcs(report) == on_disk(source) == on_disk(target)
    assert same(spark, source, target) and not os.path.exists(f"{target}/_shipping")
    write.write_table(spark.range(100, 120).withColumn("value", F.lit("w")).coalesce(1), source)
    export.export(spark, source, out)
    report = apply.import_bundle(spark, out + ".zip", copy)
    assert crcs(report) == on_disk(source) == on_disk(copy) and same(spark, source, copy)
    report = apply.import_bundle(spark, out + ".zip", target, "apply")
    assert statuses(report) == {"present": 6, "copied": 1} and same(spark, source, target)


def test_ranges_go_on_after_a_stop(spark, place, small_ranges):
    source, target = build(spark, place("source")), place("target")
    restore = block(data_files(source)[2])
    with pytest.raises(Exception):
        apply.ship(spark, source, target)
    restore()
    report = apply.ship(spark, source, target)
    assert sum(statuses(report).values()) == 6 and crcs(report) == on_disk(source) == on_disk(target)


def test_other_bytes_at_the_target_are_refused(spark, place, small_ranges):
    source, target = build(spark, place("source"), 1), place("target")
    apply.ship(spark, source, target)
    write.write_table(spark.range(50, 70).withColumn("value", F.lit("w")).coalesce(1), source)
    (new,) = set(on_disk(source)) - set(on_disk(target))
    os.makedirs(os.path.dirname(f"{target}/{new}"), exist_ok=True)
    for body in (b"short", b"y" * os.path.getsize(f"{source}/{new}")):
        with open(f"{target}/{new}", "wb") as file:
            file.write(body)
        with pytest.raises(ShippingError, match="other content"):
            apply.ship(spark, source, target)
        with open(f"{target}/{new}", "rb") as file:
            assert file.read() == body


def test_a_broken_entry_is_refused(spark, place, small_ranges):
    source, out, target = build(spark, place("source"), 1, 1), place("bundle"), place("target")
    export.export(spark, source, out)
    (part,) = [n for n in os.listdir(out + ".zip") if n.endswith(".zip")]
    with open(f"{out}.zip/{part}", "r+b") as archive:
        body = archive.read()
        at = body.index(b"PAR1")
        archive.seek(at + 10)
        archive.write(bytes([body[at + 10] ^ 255]))
    with pytest.raises(Exception, match="Bad CRC-32"):
        apply.import_bundle(spark, out + ".zip", target)
    assert not data_files(target)
    with open(f"{out}.zip/{part}", "wb") as archive:
        archive.write(body)
    apply.import_bundle(spark, out + ".zip", target)
    assert same(spark, source, target)


def test_a_repeated_task_changes_nothing(tmp_path):
    source, root, hidden = tmp_path / "source", tmp_path / "root", tmp_path / "hidden"
    source.write_bytes(bytes(range(250)))
    rows = pd.DataFrame(
        {"path": "d/f", "kind": "data", "stamp": 250, "source": str(source), "entry": None, "found_size": 250,
         "at": [0, 100, 200], "length": [100, 100, 50]}
    )
    for order in ([2, 0], [1, 2], [0, 1, 2]):
        (found,) = workers.copy_ranges([rows.iloc[order]], str(root), str(hidden), {})
    done = pd.DataFrame(
        {"path": ["d/f"], "kind": "data", "size": 250, "stamp": 250, "is_entry": False, "lengths": [[100, 100, 50]],
         "crcs": [found["crc"].tolist()], "states": [found["state"].tolist()]}
    )
    for _ in range(2):  # the second attempt finds the file in its place
        (report,) = workers.finish_ranges([done], str(root), str(hidden), {}, None)
        assert report.iloc[0].tolist() == ["d/f", "data", 250, zlib.crc32(bytes(range(250))), "copied"]
    assert (root / "d/f").read_bytes() == bytes(range(250)) and ledger.RANGES_DIR == "ranges"
