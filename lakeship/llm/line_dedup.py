"""Line dedup: two Bloom filters tell lines seen once from lines seen again, and only the latter are shuffled as texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeship.llm.common import LOWEST, settle, whole_text

#: Lines whose key is shorter than this are never dropped.
KEY_CHARS = 40
#: A key is repeated when this many documents hold it.
LEAST_DOCUMENTS = 5
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A filter is cut into slices of 2^19 bits (64 KiB); a hash has all its bits in one slice.
SLICE_BITS = 19
#: Filter size follows the number of keys (16 bits each), between these numbers of slices: 64 KiB and 64 MiB. A fuller
#: filter takes more lines for repeats; that costs shuffle and never changes the result.
FEWEST_SLICES, MOST_SLICES = 1, 1024
BITS_PER_KEY = 16
SLICE_SCHEMA = "slice int, once binary, twice binary"


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, LOWER)


def long_keys(text: Column) -> Column:
    """Keys of the lines that are long enough to count, each once."""
    keys = F.transform(F.split(text, "\n", -1), line_key)
    return F.array_distinct(F.filter(keys, lambda key: F.char_length(key) >= KEY_CHARS))


def _bits(hashes: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """(slice of each hash, its three bits inside the slice)."""
    h = hashes.view(np.uint64)
    mask = np.uint64((1 << SLICE_BITS) - 1)
    inside = [((h >> np.uint64(shift)) & mask).astype(np.int64) for shift in (0, 19, 38)]
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64) % slices, np.stack(inside)


class SeenTwice:
    """One slice of both filters as bytes of one bit each: what was seen, and what was seen again."""

    def __init__(self) -> None:
        self.once = np.zeros(1 << SLICE_BITS, bool)
        self.twice = np.zeros(1 << SLICE_BITS, bool)

    def add(self, bits: np.ndarray, again: np.ndarray) -> None:
        """Different hashes (their three bits); `again` marks those seen several times in this batch."""
        known = self.once[bits].all(axis=0) | again
        self.twice[bits[:, known]] = True
        self.once[bits] = True

    def merge(self, once: np.ndarray, twice: np.ndarray) -> None:
        """Bits that two sides set once each are set twice; any other order of merging ends in a superset of the repeats."""
        self.twice |= twice | (self.once & once)
        self.once |= once


def pack(bits: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8)).view(bool)


def _filter_of_task(slices: int):
    """Hashes of one task's documents into its own pair of filters; slices that it did not touch are not sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, SeenTwice] = {}
        for batch in batches:
            hashes, times = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            if not len(hashes):
                continue
            place, bits = _bits(hashes, slices)
            order = np.argsort(place, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(place[order]) > 0])
            for one in np.split(order, starts[1:]):
                seen.setdefault(int(place[one[0]]), SeenTwice()).add(bits[:, one], times[one] > 1)
            if len(seen) > 128:  # 1 MiB a slice: what a task holds stays small
                yield _sent(seen)
                seen.clear()
        if seen:
            yield _sent(seen)

    return run


def _sent(seen: dict[int, SeenTwice]) -> pa.RecordBatch:
    rows = sorted(seen.items())
    columns = [
        pa.array([k for k, _ in rows], pa.int32()),
        pa.array([pack(s.once) for _, s in rows], pa.binary()),
        pa.array([pack(s.twice) for _, s in rows], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["slice", "once", "twice"])


def _merged_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slice: one row for each, made one after the other in constant memory."""
    rows = ((s, o, t) for b in batches for s, o, t in zip(*(c.to_pylist() for c in b.columns)))
    for number, parts in groupby(rows, key=lambda row: row[0]):
        both = SeenTwice()
        for _, once, twice in parts:
            both.merge(unpack(once), unpack(twice))
        yield _sent({number: both})


def repeat_filter(hashes: DataFrame, slices: int) -> dict[int, bytes]:
    """The filter of hashes seen twice or more, by slice, from a table with one array of different hashes a document.

    Every task makes filters of its own documents; they meet slice by slice. The result is at most `slices` times 64 KiB.
    """
    parts = hashes.select("hashes").mapInArrow(_filter_of_task(slices), SLICE_SCHEMA)
    # first by (slice, part of the tasks), then by slice: a slice's rows do not all meet at once
    parts = parts.withColumn("part", F.pmod(F.xxhash64("once"), F.lit(16)))
    for keys in (["slice", "part"], ["slice"]):
        parts = parts.repartition(*keys).sortWithinPartitions("slice")
        if "part" in keys:
            merged = parts.select("slice", "once", "twice").mapInArrow(_merged_slices, SLICE_SCHEMA)
            parts = merged
    merged = settle(parts.mapInArrow(_merged_slices, SLICE_SCHEMA), "line-filter")
    return {row.slice: bytes(row.twice) for row in merged.select("slice", "twice").toLocalIterator()}


def _probe(spark: SparkSession, twice: dict[int, bytes], slices: int):
    """A function on arrays of hashes that marks those the filter has; the filter's size is bounded by MOST_SLICES."""
    shared = spark.sparkContext.broadcast(twice)
    opened: dict[int, np.ndarray] = {}

    @F.pandas_udf("array<boolean>")
    def suspects(column: pd.Series) -> pd.Series:
        packed = shared.value
        flat = np.concatenate([np.empty(0, np.int64), *column]).astype(np.int64)
        place, bits = _bits(flat, slices)
        hit = np.zeros(len(flat), bool)
        order = np.argsort(place, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(place[order]) > 0]) if len(order) else []
        for here in np.split(order, starts[1:]) if len(order) else []:
            number = int(place[here[0]])
            if number not in packed:
                continue
            if number not in opened:
                opened[number] = np.frombuffer(zlib.decompress(packed[number]), np.uint8)
            b = bits[:, here]
            hit[here] = ((opened[number][b >> 3] >> (7 - (b & 7))) & 1).all(axis=0)
        ends = np.cumsum([len(x) for x in column])
        return pd.Series(np.split(hit, ends[:-1])) if len(column) else pd.Series([], dtype=object)

    return suspects


def without_lines(text: pd.Series, drops: pd.Series) -> pd.DataFrame:
    """Texts without the lines whose keys are listed."""
    fold = str.maketrans(UPPER, LOWER)
    rows = []
    for whole, keys in zip(text, drops):
        keys, lines = set(keys), whole.split("\n")
        kept = [line for line in lines if line.strip(BLANKS).translate(fold) not in keys] if keys else lines
        rows.append(("\n".join(kept), len(lines) - len(kept)))
    return pd.DataFrame(rows, columns=["kept", "n_dropped"])


def dedup_lines(df: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept: texts without the lines that `least` documents or more hold.

    A document is a doc_id: rows that share one are one document, and null is one too, the smallest. Of a repeated key all
    lines go, but for those in the largest doc_id that has it. Null texts are empty texts, and have one empty line; rows
    that repeat stay rows; an empty table gives no rows. Other columns are not looked at.

    Two filters are filled from 64-bit hashes of the keys, a document's key counting once; hashes seen twice or more are
    suspects. Documents without a suspect are done at once. Of the others the suspected keys are counted as whole texts, so
    neither a false positive nor equal hashes change the result. A key that very many documents hold is summed before
    its shuffle, and its join is one that adaptive execution splits.
    """
    spark = df.sparkSession
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    hashed = docs.select(F.transform(long_keys(F.col("text")), lambda key: F.xxhash64(key)).alias("hashes"))
    hashed = settle(hashed.where("size(hashes) > 0"), "line-hashes")
    n_keys = hashed.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
    slices = min(MOST_SLICES, max(FEWEST_SLICES, -(-n_keys * BITS_PER_KEY >> SLICE_BITS)))
    suspects = _probe(spark, repeat_filter(hashed, slices), slices)

    own = F.transform(long_keys(F.col("text")), lambda key: F.xxhash64(key))
    checked = docs.withColumn("suspects", suspects(own))
    clean = ~F.exists("suspects", lambda marked: marked)
    checked = checked.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(LOWEST)).alias("doc"),
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        "text",
        "suspects",
        clean.alias("clean"),
    )
    checked = settle(checked, "line-suspects")
    left = checked.where("NOT clean")
    pairs = left.select(
        "doc",
        F.explode(F.filter(long_keys(F.col("text")), lambda key, at: F.get("suspects", at))).alias("key"),
    ).distinct()
    pairs = settle(pairs, "line-pairs")
    repeated = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("documents"), F.max("doc").alias("keeper"))
    repeated = settle(repeated.where(F.col("documents") >= least).select("key", "keeper"), "line-repeats")
    drops = pairs.join(repeated, "key").where("doc <> keeper").groupBy("doc").agg(F.collect_list("key").alias("drops"))
    cut = left.join(drops, "doc", "left").withColumn("drops", F.coalesce("drops", F.array().cast("array<string>")))
    cutter = F.pandas_udf(without_lines, "struct<kept:string,n_dropped:long>")
    cut = cut.withColumn("cut", cutter("text", "drops"))
    done = cut.select("doc_id", "n_lines", "cut.n_dropped", "cut.kept")
    rest = checked.where("clean").select("doc_id", "n_lines", F.lit(0).cast("long").alias("n_dropped"), F.col("text").alias("kept"))
    return rest.unionByName(done)


def op12_bloom_line_dedup(df: DataFrame) -> DataFrame:
    """Dropped lines of every document, and what is left of it; columns of the contract, one row a row."""
    return dedup_lines(df).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


#: The same rows in DuckDB.
SQL = rf"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, row, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM docs
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), '{UPPER}', '{LOWER}') AS key,
    coalesce(doc_id, -9223372036854775808) AS doc
  FROM lines
), repeated AS (
  SELECT key, max(doc) AS keeper FROM keyed WHERE length(key) >= {KEY_CHARS}
  GROUP BY key HAVING count(DISTINCT doc) >= {LEAST_DOCUMENTS}
), judged AS (
  SELECT k.doc_id, k.row, k.place, k.line, (r.key IS NULL OR r.keeper = k.doc) AS stays
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT CAST(any_value(doc_id) AS BIGINT) AS doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE stays), '')) AS kept_sha256
FROM judged GROUP BY row
"""
