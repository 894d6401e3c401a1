"""Ranked lexical search for many queries at once: what queries share is summed once for each document.

The items' terms are factored into a graph before any document is scored. Terms that occur in exactly the same items form
one shared set; sets that several items hold together are paired into larger ones, again and again. A document's scores
are then read off the graph: each set's sum is made once, and items add the sums of a few sets instead of all their terms.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeship.llm.common import running_totals, settle, whole_text

#: A term is a run of characters that are none of these; bytes from 0x80 on belong to terms.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Byte by byte: capital letters become small ones, whatever ends a term becomes a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Items are searched in blocks of about so many (item, term) pairs; each block reads the documents once.
BLOCK_TERMS = 200_000
#: Sums that a task holds at once: nodes of the graph times documents.
SUMS_AT_ONCE = 4_000_000
#: Sets of an item among which pairs are looked for; it bounds the work of mining and has no part in the result.
PAIRED_SETS = 64


@dataclass(frozen=True)
class SharingGraph:
    """Nodes 0..n_sets-1 are sets of terms; node n_sets+i adds `pairs[i]`; an item adds its nodes of `item_nodes`."""

    items: list
    set_of_term: np.ndarray
    n_sets: int
    pairs: list[tuple[int, int]]
    item_nodes: list[list[int]]

    @property
    def n_nodes(self) -> int:
        return self.n_sets + len(self.pairs)

    def additions(self) -> int:
        """Additions of sums that a document costs, those inside the sets aside."""
        return len(self.pairs) + sum(max(len(nodes) - 1, 0) for nodes in self.item_nodes)


def sharing_graph(items: list, terms_of_item: list[list[int]], n_terms: int) -> SharingGraph:
    """Factor items (lists of different term numbers) into shared sets and pairs of them."""
    holders: dict[int, list[int]] = defaultdict(list)
    for item, terms in enumerate(terms_of_item):
        for term in terms:
            holders[term].append(item)
    sets: dict[tuple, int] = {}
    set_of_term = np.zeros(n_terms, np.int64)
    for term in range(n_terms):
        set_of_term[term] = sets.setdefault(tuple(holders[term]), len(sets))
    nodes: list[set[int]] = [set() for _ in items]
    for held_by, number in sets.items():
        for item in held_by:
            nodes[item].add(number)
    pairs: list[tuple[int, int]] = []
    while True:
        often = Counter(node for held in nodes for node in held)
        together: Counter = Counter()
        for held in nodes:
            shared = sorted((n for n in held if often[n] > 1), key=lambda n: (-often[n], n))[:PAIRED_SETS]
            together.update((min(a, b), max(a, b)) for i, a in enumerate(shared) for b in shared[i + 1 :])
        before = len(pairs)
        used: set[int] = set()
        for (a, b), times in sorted(together.items(), key=lambda x: (-x[1], x[0])):
            if times < 2:
                break
            if a in used or b in used:
                continue
            used |= {a, b}
            for held in nodes:
                if a in held and b in held:
                    held -= {a, b}
                    held.add(len(sets) + len(pairs))
            pairs.append((a, b))
        if len(pairs) == before:
            return SharingGraph(items, set_of_term, len(sets), pairs, [sorted(held) for held in nodes])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once. Rows of one item_id (null is one too) are one item; null texts have no terms."""
    folded = F.translate(whole_text(), UPPER, LOWER)
    return items.select("item_id", F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def _in_blocks(pairs: DataFrame, block_terms: int) -> DataFrame:
    """Adds `block`: whole items, in the order of their ids, cut wherever another `block_terms` pairs are full."""
    sizes = pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("terms"))
    sizes = sizes.repartitionByRange("item_id").withColumn("_range", F.spark_partition_id())
    sizes = running_totals(settle(sizes, "search-items"), "_range", ["item_id"], "terms")
    sizes = sizes.select(F.col("item_id").alias("_item"), F.expr(f"value_before div {block_terms}").alias("block"))
    return pairs.join(sizes, F.col("item_id").eqNullSafe(F.col("_item"))).drop("_item")


def term_counts(batches: Iterator[pa.RecordBatch], numbers: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, terms, counts): all terms of a text, and how often it has each that some item asks for."""
    for batch in batches:
        lengths, terms, counts, offsets = [], [], [], [0]
        for text in batch.column(1).cast(pa.binary()):
            words = text.as_py().translate(FOLD).split()
            asked = Counter([numbers[w] for w in words if w in numbers])
            lengths.append(len(words))
            terms += asked.keys()
            counts += asked.values()
            offsets.append(len(terms))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(counts, pa.int64())),
            ],
            ["doc_id", "n", "terms", "counts"],
        )


def _all_scores(graph: SharingGraph, docs: int, doc: np.ndarray, term: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Scores (item, document) of one batch: the sets' sums once, then pairs of sums, then the items."""
    sums = np.zeros((graph.n_nodes, docs), np.int64)
    np.add.at(sums, (graph.set_of_term[term], doc), gain)
    for node, (a, b) in enumerate(graph.pairs, graph.n_sets):
        np.add(sums[a], sums[b], out=sums[node])
    scores = np.zeros((len(graph.items), docs), np.int64)
    for item, nodes in enumerate(graph.item_nodes):
        for node in nodes:
            scores[item] += sums[node]
    return scores


def best_documents(
    batches: Iterator[pa.RecordBatch], graph: SharingGraph, weights: np.ndarray, n_docs: int, n_terms: int, most: int
) -> Iterator[pa.RecordBatch]:
    """(item, doc_id, score): the best `most` documents of each item among those of one task."""
    at_once = max(1, SUMS_AT_ONCE // (graph.n_nodes + len(graph.items)))
    held = [np.empty(0, np.int64) for _ in range(4)]  # item, -score, id without nulls, is null
    least = np.zeros(len(graph.items), np.int64)
    for whole in batches:
        for start in range(0, whole.num_rows, at_once):
            batch = whole.slice(start, at_once)
            ids, lengths, terms, counts = batch.columns
            per_doc = np.diff(terms.offsets.to_numpy())
            doc = np.repeat(np.arange(batch.num_rows), per_doc)
            term, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy()
            share = [10 + 90 * n * n_docs // n_terms for n in lengths.to_pylist()]  # Python's own whole numbers
            m = np.array(share, np.int64)[doc]
            gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            scores = _all_scores(graph, batch.num_rows, doc, term, gain)
            item, at = np.nonzero((scores > 0) & (scores >= least[:, None]))
            missing = np.asarray(ids.is_null())
            plain = ids.fill_null(0).to_numpy()
            new = [item, -scores[item, at], plain[at], missing[at].astype(np.int64)]
            held = [np.concatenate(x) for x in zip(held, new)]
            order = np.lexsort((held[2], held[3], held[1], held[0]))
            first = np.searchsorted(held[0][order], np.arange(len(graph.items)))
            place = np.arange(len(order)) - first[held[0][order]]
            order = order[place < most]
            held = [x[order] for x in held]
            full = place[place < most] == most - 1
            least[held[0][full]] = -held[1][full]
    for start in range(0, len(held[0]), 10_000):
        item, score, doc_id, missing = (x[start : start + 10_000] for x in held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(doc_id, pa.int64(), mask=missing == 1), pa.array(-score, pa.int64())],
            ["item", "doc_id", "score"],
        )


def _search_block(docs: DataFrame, pairs: DataFrame, most: int) -> DataFrame | None:
    """Ranks of one block of items, whose pairs fit the driver by the block's bound; None if no document has a term."""
    rows = pairs.select("item_id", "term").orderBy("item_id", "term").toArrow()
    items = rows.column(0).unique().to_pylist()
    terms = rows.column(1).unique().to_pylist()
    numbers = {term: i for i, term in enumerate(terms)}
    place = {item: i for i, item in enumerate(items)}
    terms_of_item: list[list[int]] = [[] for _ in items]
    for item, term in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
        terms_of_item[place[item]].append(numbers[term])
    graph = sharing_graph(items, terms_of_item, len(terms))

    count = partial(term_counts, numbers={term.encode(): i for term, i in numbers.items()})
    counted = docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        count, "doc_id long, n long, terms array<int>, counts array<long>"
    )
    counted = settle(counted.where("n > 0"), "search-terms")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    weights = np.zeros(len(terms), np.int64)
    for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[term] = floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))
    best = partial(best_documents, graph=graph, weights=weights, n_docs=n_docs, n_terms=n_terms, most=most)
    found = settle(counted.mapInArrow(best, "item long, doc_id long, score long"), "search-best")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    names = docs.sparkSession.createDataFrame(list(enumerate(items)), "_item long, item_id long")
    return ranked.join(names, F.col("item") == F.col("_item")).select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, most: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: for each item its `most` best documents with a score above 0.

    Documents are rows of `docs` (doc_id, text); a repeated row is a document of its own, and rows that tie in score and
    doc_id take ranks in any order. A null doc_id comes last among equal scores. Null and empty texts have no terms and
    are never found. Items without terms, and items of which no document has a term, have no rows; so has an empty table.
    Other columns are not looked at. Whole texts count, of any length.

    The items are cut into blocks of `block_terms` terms (an item with more is a block of its own), so what goes to the
    driver and to the tasks is bounded however many items there are; each block reads the documents once. A task keeps
    `most` rows an item, and no (item, document) pair below that is ever shuffled.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pairs = settle(_in_blocks(settle(item_terms(items), "search-pairs"), block_terms), "search-blocks")
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for (block,) in pairs.select("block").distinct().orderBy("block").toLocalIterator():
        found = _search_block(docs, pairs.where(F.col("block") == block), most)
        if found is not None:
            result = result.unionByName(found)
    return result


def op13_shared_ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The ten best documents of every benchmark item; columns of the contract."""
    return ranked_search(docs, items)


#: The same rows in DuckDB, term by term and item by item.
SQL = rf"""
WITH words AS (
  SELECT doc_id, row, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS row FROM documents)
), lengths AS (SELECT row, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY row),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
tf AS (SELECT row, term, count(*) AS tf FROM words GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark
), scores AS (
  SELECT item_id, doc_id, row,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (row), totals
  GROUP BY item_id, doc_id, row
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT CAST(item_id AS BIGINT) AS item_id, CAST(rank AS INTEGER) AS rank, CAST(doc_id AS BIGINT) AS doc_id, score
FROM ranked WHERE rank <= 10
"""
