"""Copying one large file by many tasks, each of which brings a range of its bytes."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeship import storage, workers
from lakeship.operators import packing

RANGE_BYTES = 256 << 20
LARGE_SCHEMA = "path string, kind string, size bigint, stamp bigint, source string, entry string, found_size bigint"
PIECE_SCHEMA = "path string, kind string, size bigint, stamp bigint, is_entry boolean, at bigint, length bigint, crc bigint, state string"


def can_write_ranges(root: str) -> bool:
    """Whether files below `root` can be written at any place: so on disks and mounts, not on HDFS and object stores."""
    return root.startswith("file:")


def large_files(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Files of more than `range_bytes` bytes that can be read by ranges, with `found_size`, what they really have.

    Compressed ZIP entries cannot, and files that are absent or shorter than the log says are not among them.
    """
    spark = files.sparkSession
    columns = ["path", "kind", "size", "stamp", "source", "entry"]
    large = files.where(F.col("seekable") & (F.col("size") > range_bytes)).select(*columns)
    plain, packed = large.where("entry IS NULL"), large.where("entry IS NOT NULL")
    probe = partial(workers.probe_files, options=storage.storage_options(spark))
    found = plain.repartition(packing.few_tasks(spark)).mapInPandas(probe, LARGE_SCHEMA)
    return found.unionByName(packed.withColumn("found_size", F.col("size"))).where(F.col("found_size") > range_bytes)


def divide(large: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row a range: `at`, its first byte, and `length`; the last range of a file may be shorter."""
    size = F.col("found_size")
    ranges = large.withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1, F.lit(range_bytes).cast("bigint"))))
    return ranges.withColumn("length", F.least(F.lit(range_bytes).cast("bigint"), size - F.col("at")))


def copy_by_ranges(
    large: DataFrame, root: str, hidden: str, ledger_dir: str, schema: str, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Copy `large_files` below `root`, a task a range; the report has one row a file, as that of whole copies.

    Ranges are written to their places in a file of the folder `hidden`, so a repeated attempt writes the same bytes
    again. When all ranges are there their checksums are joined to the file's (for ZIP entries it must be the one that
    the archive states), and a rename shows the file.
    """
    spark = large.sparkSession
    options = storage.storage_options(spark)
    pieces = divide(large, range_bytes)
    tasks = max(1, pieces.count())
    copy = partial(workers.copy_ranges, root=root, hidden=hidden, options=options)
    copied = storage.materialize(pieces.repartition(tasks).mapInPandas(copy, PIECE_SCHEMA), "ranges")
    in_order = F.sort_array(F.collect_list(F.struct("at", "length", "crc", "state")))
    files = copied.groupBy("path", "kind", "size", "stamp", "is_entry").agg(in_order.alias("r"))
    lists = [F.col(f"r.{name}").alias(f"{name}s") for name in ("length", "crc", "state")]
    files = files.select("path", "kind", "size", "stamp", "is_entry", *lists)
    finish = partial(workers.finish_ranges, root=root, hidden=hidden, options=options, ledger=ledger_dir)
    return files.mapInPandas(finish, schema)
