"""SimHash near-duplicates: fingerprints, links found by pigeonring chains, and their components."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeship.llm.common import settle, whole_text
from lakeship.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
BITS, SEGMENTS, MOST_DIFFERENT = 64, 4, 3
_WIDTH = BITS // SEGMENTS
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
#: Shingles whose bits are summed at a time, so that a very long text needs no more memory than others.
SHINGLES_AT_ONCE = 50_000
#: Rows of the candidate index that are looked at together.
ROWS_AT_ONCE = 100_000


def fingerprint(text: str) -> int:
    """SimHash of the text's lower-cased 3-word shingles, repeats included; 0 without a word."""
    words = _WORDS(text.translate(_LOWER))
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [" ".join(words)]
    else:
        shingles = list(map(" ".join, zip(words, words[1:], words[2:], strict=False)))
    digest, ones = xxhash.xxh64_digest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(shingles), SHINGLES_AT_ONCE):
        hashed = b"".join([digest(s.encode("utf-8", "surrogatepass"), SEED) for s in shingles[at : at + SHINGLES_AT_ONCE]])
        ones += np.unpackbits(np.frombuffer(hashed, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big")


def fingerprints(df: DataFrame, hashed: bool = False) -> DataFrame:
    """doc_id, fp (the 64 bits as a long); null and empty texts, and texts without a word, have 0. `hashed` adds text_hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(text.as_py()) for text in batch.column(1)], dtype=np.uint64)
            columns = [batch.column(0), pa.array(values.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "text_hash"][: len(columns)])

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    if hashed:
        return rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, fp long, text_hash long")
    return rows.mapInArrow(run, "doc_id long, fp long")


def candidate_keys(codes: DataFrame) -> DataFrame:
    """The pigeonring index of distinct codes: (key, segment, fp), 64 rows a code.

    Four segments of 16 bits lie on a ring and three bits may differ. By the pigeonring principle some segment starts a
    chain in which l segments together differ in at most l * 3/4 bits: none in the first, at most one in the first
    two, at most two in the first three. So two linked codes agree, from some segment on, in 16 bits and in 15 of the
    next 16; a key is these 31 bits with the place of the bit that is left out.
    """
    variants = codes.withColumn("_v", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS * _WIDTH - 1))))
    segment = F.expr(f"_v div {_WIDTH}")
    turned = F.expr(f"CASE WHEN _v < {_WIDTH} THEN fp ELSE "
                    f"(shiftleft(fp, int(_v div {_WIDTH}) * {_WIDTH}) | "
                    f"shiftrightunsigned(fp, {BITS} - int(_v div {_WIDTH}) * {_WIDTH})) END")
    top = F.shiftrightunsigned(turned, 2 * _WIDTH)
    masked = top.bitwiseAND(F.expr(f"~shiftleft(1L, _v % {_WIDTH})"))
    key = masked.bitwiseOR(F.expr(f"shiftleft(bigint(_v), {2 * _WIDTH})"))
    return variants.select(key.alias("key"), segment.cast("int").alias("segment"), "fp")


def _chain_holds(a: np.ndarray, b: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """The chain of segments from `segment` on: cumulative differences within 3/4 a segment, the last step being the
    full Hamming distance."""
    differ = a ^ b
    total = np.zeros(len(differ), dtype=np.int64)
    alive = np.ones(len(differ), dtype=bool)
    for length in range(1, SEGMENTS + 1):
        place = (segment + length - 1) % SEGMENTS
        part = (differ >> ((SEGMENTS - 1 - place) * _WIDTH).astype(np.uint64)) & np.uint64(2**_WIDTH - 1)
        total += np.bitwise_count(part)
        alive &= total <= length * MOST_DIFFERENT // SEGMENTS
    return alive


def _spanning_links(codes: np.ndarray, segment: int) -> list[tuple[int, int]]:
    """Links that tie the same codes together as all links within the group do, but at most one fewer than the codes.

    Codes still apart are compared with each component's members in turn; in a dense group nearly all fall to the first
    few, so the work stays near the group's size.
    """
    links, apart = [], np.arange(len(codes))
    while len(apart):
        edge, apart = apart[:1], apart[1:]
        while len(edge) and len(apart):  # grow one component by breadth
            at, edge = edge[0], edge[1:]
            near = _chain_holds(codes[apart], np.full(len(apart), codes[at]), np.full(len(apart), segment))
            found = apart[near]
            links.extend((at, int(x)) for x in found)
            edge, apart = np.concatenate([edge, found]), apart[~near]
    return links


def _links_of_groups(key: np.ndarray, segment: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys; the arrays are sorted by key."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    pairs = starts[sizes == 2]
    near = _chain_holds(code[pairs], code[pairs + 1], segment[pairs])
    a, b = [code[pairs][near]], [code[pairs + 1][near]]
    for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
        members = code[start : start + size]
        links = _spanning_links(members, int(segment[start]))
        if links:
            left, right = np.array(links).T
            a.append(members[left])
            b.append(members[right])
    return np.concatenate(a), np.concatenate(b)


def links(codes: DataFrame) -> DataFrame:
    """(a, b): links between distinct codes that differ in 3 or fewer bits, enough of them to tie every component.

    Each key's codes lie together, sorted, in one task, which holds 16 bytes for a distinct code; copies of a
    document have been merged before. A pair is never made of two codes that are already tied in their key's group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint64)]
        waiting: list[list[np.ndarray]] = []

        def found(last: bool):
            nonlocal held, waiting
            key, segment, code = (np.concatenate([h, *(w[i] for w in waiting)]) for i, h in enumerate(held))
            waiting = []
            cut = len(key) if last or not len(key) else int(np.searchsorted(key, key[-1]))
            held = [key[cut:], segment[cut:], code[cut:]]
            a, b = _links_of_groups(key[:cut], segment[:cut], code[:cut]) if cut else (code[:0], code[:0])
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            key, segment, code = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            waiting.append([key, segment, code.view(np.uint64)])
            if sum(len(w[0]) for w in waiting) >= max(ROWS_AT_ONCE, len(held[0])):
                yield found(False)
        yield found(True)

    keyed = candidate_keys(codes).repartition("key").sortWithinPartitions("key", "fp")
    found = keyed.mapInArrow(run, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(df: DataFrame, hashed: bool = False) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links reach, itself included); one row a row.

    Equal fingerprints link at once, so the search runs over distinct ones. A null doc_id never names a component
    unless all its members have none. Repeated rows share a component; an empty table gives no rows.
    `hashed` adds text_hash and root, which tells components apart that share a doc_id.
    """
    prints = settle(fingerprints(df, hashed), "fingerprints")
    codes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(links(codes.select("fp")))
    grouped = codes.join(roots, codes["fp"] == roots["node"], "left")
    grouped = grouped.select(F.coalesce("root", "fp").alias("root"), "fp", "low")
    lows = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    of_code = grouped.join(lows, "root").select(F.col("fp").alias("_fp"), "component_id", *["root"] * hashed)
    return prints.join(of_code, F.col("fp") == F.col("_fp")).drop("_fp")


def op6_simhash_pigeonring(df: DataFrame) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(df)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each_group(df: DataFrame) -> DataFrame:
    """Of each component the document with the smallest (doc_id, text hash); one row of it, if rows repeat.

    Different texts with one doc_id each count by themselves. Rows without a doc_id have no place in that order: all of
    them stay. All columns are kept.
    """
    found = near_duplicates(df, hashed=True).where("doc_id IS NOT NULL")
    keepers = found.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("_first"))
    keepers = keepers.select(F.col("_first.doc_id").alias("_keep"), F.col("_first.text_hash").alias("_keep_hash"))
    hashed = df.withColumn("_text_hash", F.xxhash64(whole_text()))
    kept = hashed.join(keepers, (F.col("doc_id") == F.col("_keep")) & (F.col("_text_hash") == F.col("_keep_hash")), "left_semi")
    copies = Window.partitionBy("doc_id", "_text_hash").orderBy("_text_hash")
    kept = kept.withColumn("_copy", F.row_number().over(copies))
    return kept.where("_copy = 1").drop("_text_hash", "_copy").unionByName(df.where("doc_id IS NULL"))
