"""Checksums of data files, kept beside the table: what has been read once is not read again to prove a version.

A checksum is a sum over rows (`functions.checksum`), so a version's is the sum over its live files. Files never change,
so a file's checksum stays valid from version to version; adds bring new ones, removes take theirs out of the sum.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeship import storage
from lakeship.functions.checksum import checksum_of, row_number_of
from lakeship.operators.write import nullable
from lakeship.sources.table import FILE_PATH, Snapshot, file_key, read_files, snapshot
from lakeship.storage import ShippingError

STORE_DIR = "_checksums"
FILE_KEY = ["path", "dv_id", "size"]
STORE_SCHEMA = "path string, dv_id string, size bigint, n_rows bigint, checksum decimal(38,0)"


def file_checksums(snap: Snapshot, files: DataFrame) -> DataFrame:
    """(path, dv_id, size, n_rows, checksum) of live files, from their rows; files without a row count as well."""
    rows = read_files(snap, files, with_position=True)
    number = row_number_of(rows.drop(FILE_PATH, "__row_index").schema)
    sums = rows.groupBy(FILE_PATH).agg(F.count("*").alias("n_rows"), checksum_of(number).alias("checksum"))
    keyed = files.select(*FILE_KEY, file_key(snap).alias(FILE_PATH))
    found = keyed.join(sums, FILE_PATH, "left")
    zero = F.lit(0).cast("decimal(38,0)")
    return found.select(*FILE_KEY, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("checksum", zero).alias("checksum"))


def stored(spark: SparkSession, table: str) -> DataFrame:
    """The checksums that have been kept, each file's once."""
    location = f"{table}/{STORE_DIR}"
    if not storage.exists(spark, location):
        return spark.createDataFrame([], STORE_SCHEMA)
    kept = spark.read.schema(STORE_SCHEMA).option("recursiveFileLookup", True).parquet(storage.no_glob(location))
    return kept.groupBy(*FILE_KEY).agg(F.max("n_rows").alias("n_rows"), F.max("checksum").alias("checksum"))


def _same_file():
    return [F.col(f"live.{c}").eqNullSafe(F.col(f"kept.{c}")) for c in FILE_KEY]


def live_checksums(snap: Snapshot, keep: bool = True) -> tuple[DataFrame, int]:
    """Checksums of all live files, and how many of them had to be read for it; what is new is kept, unless told not to."""
    spark = snap.spark
    live, kept = snap.files.alias("live"), stored(spark, snap.table).alias("kept")
    unknown = storage.materialize(live.join(kept, _same_file(), "left_anti"), "unread")
    n_unknown = unknown.count()
    known = live.join(kept, _same_file()).select(*[f"kept.{c}" for c in (*FILE_KEY, "n_rows", "checksum")])
    if not n_unknown:
        return known, 0
    new = storage.materialize(file_checksums(snap, unknown), "checksums")
    whole = storage.materialize(known.unionByName(new), "all-checksums")  # before the store grows below it
    if keep:
        new.coalesce(1 + n_unknown // 100_000).write.parquet(f"{snap.table}/{STORE_DIR}/{uuid.uuid4().hex}")
    return whole, n_unknown


def _total(snap: Snapshot, files: DataFrame, n_read: int) -> DataFrame:
    summed = files.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), checksum_of(F.col("checksum")).alias("checksum"),
        F.count("*").alias("n_files"),
    )
    return summed.select(
        F.lit(snap.version).cast("bigint").alias("version"), "n_rows", "checksum", "n_files", F.lit(n_read).cast("bigint").alias("files_read")
    )


@storage.tidy
def version_checksum(spark: SparkSession, table: str, as_of: int | None = None) -> DataFrame:
    """One row: version, n_rows, checksum (as of `table_checksum`), n_files, and files_read: those not read before."""
    snap = snapshot(spark, table, as_of)
    total = _total(snap, *live_checksums(snap))
    return spark.createDataFrame([total.first()], total.schema)


@storage.tidy
def verify_content(spark: SparkSession, source: str, target: str) -> DataFrame:
    """One row: version, n_rows, checksum and files_read of both tables; raises unless the contents are the same.

    After an incremental round only the files that it brought are read, on either side. When the tables differ, the error
    names a file that both have with different rows, if there is one.
    """
    a, b = snapshot(spark, source), snapshot(spark, target)
    if nullable(a.schema) != nullable(b.schema):
        raise ShippingError(f"{source} and {target} have different columns")
    (ours, read_here), (theirs, read_there) = live_checksums(a), live_checksums(b)
    totals = [_total(snap, files, n).first() for snap, files, n in ((a, ours, read_here), (b, theirs, read_there))]
    if (totals[0].n_rows, totals[0].checksum) != (totals[1].n_rows, totals[1].checksum):
        both = ours.alias("a").join(theirs.alias("b"), [F.col("a.path") == F.col("b.path"), F.col("a.dv_id") == F.col("b.dv_id")])
        row = both.where("a.checksum <> b.checksum OR a.n_rows <> b.n_rows").select("a.path").first()
        raise ShippingError(f"{source} and {target} hold different rows" + (f", such as those of {row.path}" if row else ""))
    names = ["version", "n_rows", "checksum", "files_read"]
    schema = ", ".join(f"{side}_{c} {'decimal(38,0)' if c == 'checksum' else 'bigint'}" for side in ("source", "target") for c in names)
    return spark.createDataFrame([tuple(t[c] for t in totals for c in names)], schema)
