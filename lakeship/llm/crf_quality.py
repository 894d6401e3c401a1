"""Quality classifier: a linear-chain conditional random field over the lines of a document."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeship.llm.common import whole_text

#: At most so many labelled documents are used to fit; the same ones in every run (lowest hashes of doc_id).
TRAINING_DOCUMENTS = 2_500
ROUNDS, STEP, RIDGE = 150, 0.15, 1e-3
#: Lines that are scored together.
LINES_AT_ONCE = 20_000
SYMBOLS = "#*$%&|<>"
ENDINGS = tuple(".!?:;\"'”’)")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall

OWN = (
    "symbols", "bangs", "bars", "upper", "digits", "letters", "distinct", "doubled", "most_common", "word_length",
    "long_words", "few_words", "no_words", "log_words", "ends_open", "seen_before", "marked_words",
)
#: Features of the line before and after that a line also sees.
SHARED = ("symbols", "bangs", "bars", "upper", "distinct", "doubled", "seen_before", "marked_words")
_SHARED_AT = [OWN.index(name) for name in SHARED]
FEATURES = [*OWN, *[f"before_{n}" for n in SHARED], *[f"after_{n}" for n in SHARED], "first", "last", "bias"]


def line_features(line: str, seen: set[str]) -> tuple[float, ...]:
    """Features of one line on its own; `seen` holds the document's lines so far."""
    words = _WORDS(line)
    n, n_words = max(len(line), 1), len(words)
    if not n_words:
        return (0.0,) * 12 + (1.0,) + (0.0,) * 4
    distinct = set(words)
    doubled = sum(map(str.__eq__, words, words[1:])) / n_words
    common = (n_words - len(distinct)) / n_words
    upper = sum(map(str.isupper, words)) / n_words
    symbols = sum(map(line.count, SYMBOLS)) / n
    digits = sum(map(line.count, "0123456789")) / n
    letters = sum(map(len, words)) / n
    marked = sum(map(line.count, ("###", "***", "$$$", "%%%", "&&&", "!!"))) / n_words
    lengths = list(map(len, words))
    repeated = float(line in seen)
    seen.add(line)
    return (
        symbols * 10,
        line.count("!") / n_words,
        line.count(" | ") / n_words,
        upper,
        digits * 5,
        letters,
        len(distinct) / n_words,
        doubled,
        common,
        min(sum(lengths) / n_words, 30.0) / 10,
        float(max(lengths) > 40),
        float(n_words < 4),
        0.0,
        float(np.log1p(n_words)) / 5,
        float(not line.rstrip().endswith(ENDINGS)),
        repeated,
        min(marked, 2.0),
    )


def document_lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and lengths (at least 1) of a text's lines; an empty text has one empty line."""
    lines, seen = text.split("\n"), set()
    own = np.array([line_features(line, seen) for line in lines], dtype=np.float64)
    shared = own[:, _SHARED_AT]
    edge = np.zeros((1, len(SHARED)))
    place = np.zeros((len(lines), 3))
    place[0, 0] = place[-1, 1] = 1.0
    place[:, 2] = 1.0
    before, after = np.concatenate([edge, shared[:-1]]), np.concatenate([shared[1:], edge])
    lengths = np.array([max(len(line), 1) for line in lines], dtype=np.float64)
    return np.concatenate([own, before, after, place], axis=1), lengths


@dataclass
class Chain:
    """Weights of the label `good` against `bad` for each feature, and of each pair of neighbouring labels."""

    weights: np.ndarray
    pairs: np.ndarray

    def marginals(self, scores: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Forward-backward over documents laid end to end: P(good) for each line, expected counts of label pairs, and the
        sum of the log partition functions. Runs over line numbers, with all documents that have such a line at once."""
        first = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
        order = np.argsort(-sizes, kind="stable")
        longest = int(sizes.max(initial=0))
        has = [int(np.searchsorted(-sizes[order], -t, side="left")) for t in range(longest)]  # documents with a line t
        emit = np.stack([np.zeros_like(scores), scores], axis=1)
        ahead, behind = np.empty_like(emit), np.zeros_like(emit)
        ahead[first[order]] = emit[first[order]]
        for t in range(1, longest):
            at = first[order[: has[t]]] + t
            before = ahead[at - 1]
            ahead[at] = emit[at] + np.logaddexp(before[:, :1] + self.pairs[0], before[:, 1:] + self.pairs[1])
        last = first + sizes - 1
        whole = np.logaddexp(ahead[last, 0], ahead[last, 1])
        total = np.repeat(whole, sizes)
        expected = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            at = first[order[: has[t + 1]]] + t
            after = behind[at + 1] + emit[at + 1]
            behind[at] = np.logaddexp(self.pairs[:, 0] + after[:, :1], self.pairs[:, 1] + after[:, 1:])
            both = ahead[at][:, :, None] + self.pairs[None] + after[:, None, :] - total[at][:, None, None]
            expected += np.exp(both).sum(axis=0)
        return np.exp(ahead[:, 1] + behind[:, 1] - total), expected, float(whole.sum())

    def scores(self, features: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Length-weighted mean of P(good) over each document's lines."""
        good, _, _ = self.marginals(features @ self.weights, sizes)
        first = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
        return np.add.reduceat(good * lengths, first) / np.add.reduceat(lengths, first)


def fit_chain(documents: list[tuple[str, int]]) -> Chain:
    """Fit by gradient ascent (Adam) on the mean log-likelihood a line; every line carries its document's label.

    Documents that have only one label, or none at all, give a chain that scores all texts by that label's share
    (smoothed), 0.5 without any.
    """
    good = sum(label for _, label in documents)
    chain = Chain(np.zeros(len(FEATURES)), np.zeros((2, 2)))
    if good in (0, len(documents)):
        chain.weights[-1] = np.log((good + 1) / (len(documents) - good + 1))
        return chain
    parts = [document_lines(text) for text, _ in documents]
    features = np.concatenate([p[0] for p in parts])
    sizes = np.array([len(p[1]) for p in parts])
    labels = np.repeat([label for _, label in documents], sizes).astype(np.float64)
    inner = np.ones(len(labels), dtype=bool)  # lines with a line before them
    inner[np.r_[0, np.cumsum(sizes)[:-1]]] = False
    good_pairs = float(labels[inner].sum())
    seen = np.diag([inner.sum() - good_pairs, good_pairs])  # neighbours carry the same label
    seen_features = features.T @ labels
    lines = len(labels)
    state = np.zeros(len(FEATURES) + 4)
    mean, square = np.zeros_like(state), np.zeros_like(state)
    for n in range(1, ROUNDS + 1):
        chain = Chain(state[:-4], state[-4:].reshape(2, 2))
        marginal, expected, _ = chain.marginals(features @ chain.weights, sizes)
        slope = np.r_[seen_features - features.T @ marginal, (seen - expected).ravel()] / lines - RIDGE * state
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        state = state + STEP * (mean / (1 - 0.9**n)) / (np.sqrt(square / (1 - 0.99**n)) + 1e-8)
    return Chain(state[:-4], state[-4:].reshape(2, 2))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 3, is 1. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(df: DataFrame, labels: DataFrame, most: int = TRAINING_DOCUMENTS) -> Chain:
    """A chain fitted on at most `most` labelled documents that are not held out; this bounded sample goes to the driver."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label"))
    known = known.where("_id IS NOT NULL AND _label IN (0, 1)").where(~held_out(F.col("_id")))
    sample = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    sample = sample.orderBy(F.xxhash64(F.lit(17), "_id"), "_id").limit(most)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))  # the bound is `most` rows
    first = rows.groupBy("doc_id", "_label").agg(F.min("text").alias("text"))  # repeated ids: one text of each
    return fit_chain([(row["text"], row["_label"]) for row in first.orderBy("doc_id").collect()])


def scores_of(chain: Chain, texts: Iterable[str]) -> np.ndarray:
    """Scores of texts, LINES_AT_ONCE lines or one long text at a time."""
    out, parts, held = [np.empty(0)], [], 0

    def flush():
        sizes = np.array([len(p[1]) for p in parts])
        features, lengths = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        out.append(np.clip(chain.scores(features, lengths, sizes).round(9), 0.0, 1.0))

    for text in texts:
        parts.append(document_lines(text))
        held += len(parts[-1][1])
        if held >= LINES_AT_ONCE:
            flush()
            parts, held = [], 0
    if parts:
        flush()
    return np.concatenate(out)


def score(df: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, score (0 to 1) for each row, from its text alone; null and empty texts are one empty line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = scores_of(chain, (text.as_py() for text in batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "score"])

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def op7_crf_quality(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every document; learned from `labels.quality` of rows that are not held out."""
    scored = score(df, train(df, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def good_documents(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score 0.5 or more, with all their columns. No shuffle: the text is scored where it is read."""
    chain = train(df, labels)

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        return pd.Series(scores_of(chain, texts))

    return df.where(quality(whole_text()) >= 0.5)
