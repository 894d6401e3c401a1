import uuid

import pytest
import vectors
from pyspark.sql import functions as F

from lakeship import workers
from lakeship.functions import paths
from lakeship.functions.checksum import table_checksum


def values(spark, texts, *columns):
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_encode_decode_keep_special_names(spark):
    names = ["a b/c+d.parquet", "x=1/y%2Fz/é#?.parquet", "plain-1_2.parquet", "k=a%20b/f"]
    rows = values(
        spark, names, paths.encode_path(F.col("p")), paths.decode_path(paths.encode_path(F.col("p")))
    )
    assert [r[1] for r in rows] == names
    assert rows[0][0] == "a%20b/c%2Bd.parquet"
    assert values(spark, ["a+b%20c", "50%"], paths.decode_path(F.col("p"))) == [("a+b c",), ("50%",)]


def test_file_classes(spark):
    log = "_delta_log/" + "0" * 19
    names = {
        log + "1.json": "commit",
        log + "1.checkpoint.parquet": "checkpoint",
        log + "1.checkpoint.0000000001.0000000002.parquet": "checkpoint",
        log + "1.checkpoint.80a083e8-7026-4e79-81be-64bd76c43a11.parquet": "log",
        "_delta_log/_last_checkpoint": "hint",
        "_delta_log/1.crc": "log",
        "metadata.json": "metadata",
        "a/metadata.json": "data",
        "ab/deletion_vector_x.bin": "dv",
        "y=1/part.parquet": "data",
    }
    found = values(spark, names, paths.file_class(F.col("p")))
    assert [f for (f,) in found] == list(names.values())


def test_versions_and_extensions(spark):
    names = ["00000000000000000012.json", "0000.json", "abcdefghijabcdefghij.json", "README"]
    assert [v for (v,) in values(spark, names, paths.version_of(F.col("p")))] == [12, None, None, None]
    assert [e for (e,) in values(spark, names, paths.extension(F.col("p")))] == ["json", "json", "json", ""]


def test_unsafe_entries(spark):
    entries = ["a/b", "../a", "a/../b", "a/..", "/etc/x", "C:/x", "a\\..\\b", "a..b/c", "..a/b"]
    expected = [True, False, False, False, False, False, False, True, True]
    assert [s for (s,) in values(spark, entries, paths.is_safe_entry(F.col("p")))] == expected


def test_uris(spark):
    uris = ["s3a://bucket/a/b", "s3a://bucket", "file:///x"]
    assert values(spark, uris, paths.bucket_of(F.col("p")), paths.key_of(F.col("p"))) == [
        ("bucket", "a/b"),
        ("bucket", ""),
        ("", ""),
    ]
    same = ["/a/b", "file:/a/b", "file:///a/b"]
    assert {u for (u,) in values(spark, same, paths.normal_uri(F.col("p")))} == {"file:/a/b"}


def test_vector_file_name(spark):
    name = uuid.UUID("d2c639aa-8816-431a-aaf6-d3fe2512ff61")
    code = vectors.z85(name.bytes)
    assert workers.z85_decode(code) == name.bytes
    rows = [("u", "ab" + code), ("u", code), ("p", "s3a://b/x%20y.bin"), ("i", code)]
    df = spark.createDataFrame(rows, "t string, p string")
    found = [r[0] for r in df.select(paths.dv_relative_path(F.col("t"), F.col("p"))).collect()]
    assert found == [
        f"ab/deletion_vector_{name}.bin",
        f"deletion_vector_{name}.bin",
        "s3a://b/x y.bin",
        None,
    ]


@pytest.mark.parametrize(
    "positions",
    [
        [],
        [0],
        [0, 1, 65535, 65536, 70000],
        list(range(5000)),
        list(range(0, 400_000, 7)),
        [3, (1 << 32) + 5, (1 << 33) + 70_000],
    ],
)
def test_bitmaps_are_read(positions):
    assert workers.read_positions(vectors.bitmap(positions)).tolist() == positions


def test_bitmap_with_runs():
    """A run container laid out by the published format: cookie, flags, header, runs."""
    import struct

    bitmap = struct.pack("<I", (0 << 16) | workers.ROARING_WITH_RUNS) + b"\x01"
    bitmap += struct.pack("<HH", 2, 6) + struct.pack("<H", 2) + struct.pack("<HHHH", 10, 3, 100, 2)
    blob = struct.pack("<iq", workers.DV_MAGIC, 1) + struct.pack("<I", 0) + bitmap
    base = 2 << 16
    assert workers.read_positions(blob).tolist() == [base + p for p in (10, 11, 12, 13, 100, 101, 102)]


def test_checksum_sees_nulls_duplicates_and_order(spark):
    def checksum(rows):
        return tuple(table_checksum(spark.createDataFrame(rows, "a int, b int, m map<string,int>")).first())

    left, right = [(1, None, {"k": 1, "l": 2})], [(None, 1, {"l": 2, "k": 1})]
    assert checksum(left)[1] == checksum(right)[1]
    assert checksum(left)[2] != checksum(right)[2]
    assert checksum(left) != checksum(left * 2)
    assert checksum(left + right) == checksum(right + left)
    assert checksum([]) == (0, 0, 0)
