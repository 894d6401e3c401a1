"""Quality rules by compression bands: zstandard ratios over whole documents and fixed chunks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeship.llm.common import whole_text

LEVEL = 3
CHUNK_BYTES = 4096
#: Whole documents: (from this many bytes on, least and most bytes of text for a compressed byte). Short texts
#: compress little, and the format's own few bytes weigh more, so their band lies lower and the checks start at 64 bytes.
DOCUMENT_BANDS = ((64, 0.80, 6.0), (512, 1.05, 6.0), (2_048, 1.15, 7.0), (16_384, 1.25, 9.0))
#: Full chunks of CHUNK_BYTES: the same, and the share of a document's chunks that may lie outside.
CHUNK_BAND = (1.15, 8.0)
CHUNKS_OUTSIDE = 0.5
SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 50
MOST_REPEATED_PERCENT = 50

_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, and words in 3-word windows found twice or more."""
    words = _WORDS(text)
    n_words = len(words)
    word_chars = sum(map(len, words))
    n_symbols = sum(map(text.count, SYMBOLS))
    seen, n_dup_lines = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n_dup_lines += 1
        elif _WORDS(line):
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    n_repeat_words = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        covered = 0  # words up to here are counted
        for at, window in enumerate(windows):
            if often[window] > 1:
                n_repeat_words += at + 3 - max(at, covered)
                covered = at + 3
    return n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words


def ratios(data: bytes, compressor: zstandard.ZstdCompressor, chunk: int = CHUNK_BYTES) -> tuple[float, list[float]]:
    """Bytes for each compressed byte: of the whole, and of each full chunk. What is left over is judged by a last full
    chunk, which ends with the text and overlaps the one before; a text below a chunk has the whole's ratio only."""
    whole = len(data) / len(compressor.compress(data))
    starts = list(range(0, len(data) - chunk + 1, chunk))
    if starts and len(data) % chunk:
        starts.append(len(data) - chunk)
    parts = [chunk / len(compressor.compress(data[at : at + chunk])) for at in starts]
    return whole, parts


def inside_bands(
    n_bytes: int,
    whole: float,
    parts: Sequence[float],
    bands: Sequence[tuple[int, float, float]] = DOCUMENT_BANDS,
    chunk_band: tuple[float, float] = CHUNK_BAND,
    most_outside: float = CHUNKS_OUTSIDE,
) -> bool:
    """Whether the ratios say neither repetitive (above a band) nor incompressible (below)."""
    limits = [band for band in bands if n_bytes >= band[0]]
    if limits and not limits[-1][1] <= whole <= limits[-1][2]:
        return False
    outside = sum(not chunk_band[0] <= part <= chunk_band[1] for part in parts)
    return outside <= most_outside * len(parts)


def compression_quality(df: DataFrame, level: int = LEVEL, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Counts, ratios and verdict for each row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, ratio, worst_low, worst_high.

    One pass without a shuffle. Null and empty texts have no words, fail the base and have ratio 0; a row's result
    depends on its own text alone, so repeated rows agree. `worst_*` are the extreme chunk ratios (null: no full chunk).
    """
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, ratio double, worst_low double, worst_high double"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=level)
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                counts = base_counts(text)
                failed = counts[0] < FEWEST_WORDS or 100 * counts[4] > MOST_REPEATED_PERCENT * counts[0]
                data = text.encode("utf-8", "surrogatepass")
                whole, parts = ratios(data, compressor, chunk)
                kept = not failed and inside_bands(len(data), whole, parts)
                row = (doc_id.as_py(), *counts, failed, kept, whole, min(parts, default=None), max(parts, default=None))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(judge, schema)


def op8_compression_bands(df: DataFrame) -> DataFrame:
    """Base counts and verdict of every document, by the documented bands."""
    return compression_quality(df)
