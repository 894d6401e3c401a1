"""Removal of repeated byte strings by prefix doubling over sampled suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeship.llm.common import LOWEST, settle, whole_text

THRESHOLD = 50
#: Prefix length of the first ranks. With a window of THRESHOLD - FIRST + 1 sampled starts, every string of THRESHOLD
#: bytes holds a sampled position that its bytes alone choose, with all of that position's first prefix inside.
FIRST = 20
_WINDOW = THRESHOLD - FIRST + 1
_SIDE = THRESHOLD - FIRST
_CONTEXT = _SIDE + THRESHOLD
#: Bytes of text that a task ranks together, and rows of positions that it looks at together.
BYTES_AT_ONCE = 2_000_000
ROWS_AT_ONCE = 100_000
WINDOWS_AT_ONCE = 20_000
_PAD = 96
_U64 = np.uint64
_MULTIPLY = _U64(0x9E3779B97F4A7C15)
_STIR = _U64(0xD6E8FEB86659FD93)


def _mixed(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    state = (state ^ word) * _MULTIPLY
    return (state ^ (state >> _U64(29))) * _STIR


def _words_at(data: np.ndarray) -> np.ndarray:
    """For each position the eight bytes from it on, as one number."""
    n = len(data) - 7
    out = data[:n].astype(_U64)
    for i in range(1, 8):
        out |= data[i : n + i].astype(_U64) << _U64(8 * i)
    return out


def _hash_from(words: np.ndarray, start: np.ndarray | slice, length: int) -> np.ndarray:
    """Hash of `length` bytes from each start; eight bytes at a time, the last step overlaps."""
    steps = [*range(0, length - 7, 8)]
    if steps[-1] != length - 8:
        steps.append(length - 8)
    state = None
    for step in steps:
        if isinstance(start, slice):
            word = words[step : step + start.stop]
        else:
            word = words[start + step]
        state = _mixed(np.full(len(word), length, _U64) if state is None else state, word)
    return state ^ (state >> _U64(32))


def _sample(words: np.ndarray, first: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """Sampled positions of texts that lie at `first` in one buffer: in each window, the start whose prefix hash is least.

    The choice depends on the bytes of the window only, so equal strings choose the same place.
    """
    n = len(words) - _PAD
    order = _hash_from(words, slice(0, n), FIRST)
    bits = _U64(max(n, 2).bit_length())
    place = np.arange(n, dtype=_U64)
    value = ((order >> bits) << bits) | place
    width = 1
    while width * 2 <= _WINDOW:
        value = np.minimum(value[: len(value) - width], value[width:])
        width *= 2
    rest = _WINDOW - width
    if rest:
        value = np.minimum(value[: len(value) - rest], value[rest:])
    long = n_bytes >= THRESHOLD
    starts, counts = first[long], n_bytes[long] - THRESHOLD + 1
    windows = np.repeat(starts - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
    chosen = (value[windows] & ((_U64(1) << bits) - _U64(1))).astype(np.int64)
    return chosen[np.r_[True, chosen[1:] != chosen[:-1]]] if len(chosen) else chosen


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with the texts apart by _PAD zeros, their places and their lengths."""
    gap = bytes(_PAD)
    n_bytes = np.array([len(t) for t in texts], dtype=np.int64)
    first = _PAD + np.r_[0, np.cumsum(n_bytes + _PAD)[:-1]].astype(np.int64)
    return np.frombuffer(gap + b"".join(t + gap for t in texts) + gap, dtype=np.uint8), first, n_bytes


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about BYTES_AT_ONCE bytes of text."""
    sizes = np.cumsum(batch.column(column).to_pandas().map(len).to_numpy(dtype=np.int64))
    cuts = np.flatnonzero(np.diff(sizes // BYTES_AT_ONCE, prepend=0)) + 1
    for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(sizes)], strict=True):
        if start < end:
            yield batch.slice(start, end - start)


def _bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [x.as_py() for x in batch.column(column)]


POSITIONS = "rank long, class long, doc long, row int, at int"


def _rank_positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sampled positions with the rank of their first FIRST bytes and the class of all bytes around them that matter.

    Copies that a smaller document of the same slice already covers are known to be repeats: they get rank 0, class -1 and
    need no further look.
    """
    for whole in batches:
        for batch in _slices(whole, "body"):
            data, first, n_bytes = _laid_out(_bytes(batch, "body"))
            words = _words_at(data)
            at = _sample(words, first, n_bytes)
            if not len(at):
                continue
            owner = np.searchsorted(first, at, side="right") - 1
            left = np.minimum(at - first[owner], _SIDE)
            right = np.minimum(first[owner] + n_bytes[owner] - at, THRESHOLD)
            rank = _hash_from(words, at, FIRST)
            group = _mixed(_hash_from(words, at - _SIDE, _CONTEXT), (left * 64 + right).astype(_U64))
            doc = batch.column("doc").to_numpy()[owner]
            row = batch.column("row").to_numpy()[owner]
            order = np.lexsort((doc, group))
            change = np.r_[True, group[order][1:] != group[order][:-1]]
            lowest = doc[order][np.flatnonzero(change)][np.cumsum(change) - 1]
            repeat = np.empty(len(at), bool)
            repeat[order] = doc[order] > lowest
            # known repeats spread over all tasks by their own place
            rank = np.where(repeat, _mixed(rank ^ doc.view(_U64), at.astype(_U64)), rank)
            kind = np.where(repeat, _U64(0), group | _U64(1))
            columns = [rank.view(np.int64), kind.view(np.int64), doc, row, (at - first[owner]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], ["rank", "class", "doc", "row", "at"]
            )


SETTLED = "doc long, row int, at int, rank long, repeat boolean"


def _rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions sorted by (rank, class, doc): drop unique ranks, settle what is past the threshold, pass on the rest.

    Of a class (equal in all THRESHOLD-byte strings around the position) every document after the first holds only
    repeats there. Its first document is passed on if the rank has other classes, as single strings may still be shared.
    """

    def work(columns: list[np.ndarray]) -> pa.RecordBatch:
        rank, kind, doc, row, at = columns
        known = kind == 0
        new_rank = np.r_[True, rank[1:] != rank[:-1]]
        new_kind = new_rank | np.r_[True, kind[1:] != kind[:-1]]
        start = np.flatnonzero(new_rank)
        rank_no, kind_no = np.cumsum(new_rank) - 1, np.cumsum(new_kind) - 1
        lowest = doc[np.flatnonzero(new_kind)][kind_no]
        classes = np.add.reduceat(new_kind.astype(np.int64), start)[rank_no]
        docs_low = np.minimum.reduceat(doc, start)[rank_no]
        docs_high = np.maximum.reduceat(doc, start)[rank_no]
        repeat = known | (doc > lowest)
        more = ~repeat & (classes > 1) & (docs_low < docs_high)
        keep = repeat | more
        values = [doc[keep], row[keep], at[keep], np.where(repeat, 0, rank)[keep], repeat[keep]]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["doc", "row", "at", "rank", "repeat"])

    yield from _by_group(batches, work, ROWS_AT_ONCE)


def _by_group(batches, work, rows_at_once: int) -> Iterator[pa.RecordBatch]:
    """`work` on runs of rows sorted by their first column; a run never splits equal values."""
    held: list[np.ndarray] | None = None
    waiting: list[list[np.ndarray]] = []

    def joined():
        parts = ([held] if held is not None else []) + waiting
        return [np.concatenate([p[i] for p in parts]) for i in range(len(parts[0]))]

    for batch in batches:
        waiting.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if sum(len(w[0]) for w in waiting) >= max(rows_at_once, 0 if held is None else len(held[0])):
            columns = joined()
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            held, waiting = [c[cut:] for c in columns], []
            if cut:
                yield work([c[:cut] for c in columns])
    if held is not None or waiting:
        columns = joined()
        if len(columns[0]):
            yield work(columns)


CONTEXTS = "rank long, doc long, row int, at int, lead int, body binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around each position of (doc, row, places, body); `lead` of them lie before the position."""
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for doc, row, places, body in zip(*(batch.column(n) for n in ("doc", "row", "places", "body")), strict=True):
            doc, row, body = doc.as_py(), row.as_py(), body.as_py()
            for place in places.as_py():
                at = place["at"]
                lead = min(at, _SIDE)
                for column, value in zip(
                    out, (place["rank"], doc, row, at, lead, body[at - lead : at + THRESHOLD]), strict=True
                ):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["rank", "doc", "row", "at", "lead", "body"]
        )


SPANS = "doc long, row int, span long"


def _double(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For positions of equal rank, rank the THRESHOLD-byte strings around them; yield runs that a smaller document has."""

    def work(columns: list[np.ndarray]) -> pa.RecordBatch:
        rank, doc, row, at, lead, body = columns
        n = len(rank)
        grid = np.zeros((n, _CONTEXT + 8), dtype=np.uint8)
        lengths = np.empty(n, np.int64)
        for i, (part, shift) in enumerate(zip(body, _SIDE - lead, strict=True)):
            grid[i, shift : shift + len(part)] = np.frombuffer(part, np.uint8)
            lengths[i] = shift + len(part)
        words = _words_at(grid.reshape(-1)) if n else np.empty(0, _U64)
        base = np.arange(n) * (_CONTEXT + 8)
        hit = np.zeros((n, _SIDE + 2), dtype=bool)  # a column of False at the end closes runs
        for i in range(_SIDE + 1):
            inside = np.flatnonzero((i >= _SIDE - lead) & (i + THRESHOLD <= lengths))
            if not len(inside):
                continue
            value = _hash_from(words, base[inside] + i, THRESHOLD)
            order = np.lexsort((doc[inside], value, rank[inside]))
            r, v, d = rank[inside][order], value[order], doc[inside][order]
            new = np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])]
            hit[inside[order], i] = d > d[np.flatnonzero(new)][np.cumsum(new) - 1]
        edges = np.diff(hit.astype(np.int8), axis=1, prepend=0)
        who, begin = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        start = (at[who] - _SIDE + begin).astype(np.int64)
        stop = (at[who] - _SIDE + end - 1 + THRESHOLD).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[who]), pa.array(row[who]), pa.array((start << 32) | stop)], ["doc", "row", "span"]
        )

    yield from _by_group(batches, work, WINDOWS_AT_ONCE)


def _texts(df: DataFrame) -> DataFrame:
    """doc (null ids are below all), row (tells rows of one doc_id apart by their text), body."""
    text = whole_text()
    return df.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc"),
        F.hash(text).alias("row"),
        text.cast("binary").alias("body"),
    )


def repeated_spans(df: DataFrame) -> DataFrame:
    """(doc, row, spans): byte spans, packed as start << 32 | end and overlapping, of THRESHOLD-byte strings that a
    document with a smaller doc_id has too.

    Ranks of prefixes grow from FIRST bytes to the threshold as in prefix doubling: Spark sorts (rank, class) pairs,
    positions with a unique rank leave, those whose class is past the threshold are settled, and the rest is reranked by
    whole strings. Positions are sampled by their own bytes (see FIRST), which loses no string; a rank is a hash
    of its bytes, so that texts are not moved to name it. A class that fills many documents is merged in each task first.
    """
    texts = _texts(df)
    positions = texts.where(F.octet_length("body") >= THRESHOLD).mapInArrow(_rank_positions, POSITIONS)
    sorted_pairs = positions.repartition("rank").sortWithinPartitions("rank", "class", "doc")
    settled = settle(sorted_pairs.mapInArrow(_rerank, SETTLED), "ranks")
    places = settled.where("NOT repeat").groupBy("doc", "row").agg(F.collect_list(F.struct("at", "rank")).alias("places"))
    # rows equal in id and text share their places; one of them is enough
    asked = places.withColumnsRenamed({"doc": "_doc", "row": "_row"})
    found = texts.join(asked, (F.col("doc") == F.col("_doc")) & (F.col("row") == F.col("_row")))
    contexts = found.select("doc", "row", "places", "body").mapInArrow(_contexts, CONTEXTS)
    reranked = contexts.repartition("rank").sortWithinPartitions("rank").mapInArrow(_double, SPANS)
    reranked = settle(reranked, "spans")
    start = F.greatest(F.col("at") - _SIDE, F.lit(0)).cast("long")
    whole = settled.where("repeat").select(
        "doc", "row", F.shiftleft(start, 32).bitwiseOR(F.col("at").cast("long") + THRESHOLD).alias("span")
    )
    return whole.unionByName(reranked).groupBy("doc", "row").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def merged_spans(spans: list[int] | np.ndarray, n_bytes: int) -> list[tuple[int, int]]:
    """Maximal runs of the packed spans, which come sorted; ends beyond the text are cut."""
    runs: list[tuple[int, int]] = []
    for span in spans:
        start, end = span >> 32, min(span & 0xFFFFFFFF, n_bytes)
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def dedup_substrings(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) for each row.

    Null and empty texts, and texts below the threshold, stay as they are. Rows with equal doc_id never count as
    earlier for each other; a null doc_id counts as below all others. A text with many spans holds one number for each.
    """
    spans = repeated_spans(df).withColumnsRenamed({"doc": "_doc", "row": "_row"})
    texts = _texts(df)
    joined = texts.join(spans, (F.col("doc") == F.col("_doc")) & (F.col("row") == F.col("_row")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        for whole in batches:
            for batch in _slices(whole, "body"):
                out: list[list] = [[] for _ in names]
                for doc, body, found in zip(*(batch.column(n) for n in ("doc", "body", "spans")), strict=True):
                    doc, body = doc.as_py(), body.as_py()
                    runs = merged_spans(found.as_py() or [], len(body))
                    parts, at = [], 0
                    for start, end in runs:
                        parts.append(body[at:start])
                        at = end
                    kept = b"".join([*parts, body[at:]])
                    values = (
                        None if doc == LOWEST else doc,
                        len(body),
                        len(body) - len(kept),
                        len(runs),
                        hashlib.sha256(kept).hexdigest(),
                        kept,
                    )
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return joined.select("doc", "body", "spans").mapInArrow(cut, schema)


def op9_prefix_doubling_dedup(df: DataFrame) -> DataFrame:
    """Every document less the bytes of 50-byte strings that an earlier document has."""
    return dedup_substrings(df).drop("kept")
