"""A trie over rebuilt conversations, made from fingerprints that compose; no rebuilt text is ever put together.

A list of turns t1..tn has the fingerprint (n, t1*x + t2*x^2 + ... + tn*x^n), and lists compose as
(n, a) o (m, b) = (n + m, a + x^n * b): a monoid, whose parts can be summed anywhere and in any grouping. The prefix of a
rebuilt conversation is a head of one conversation and a stretch of another, so its fingerprint follows from three stored
numbers. Nodes of the trie are groups of equal fingerprints, and each group is checked against the turns themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeship.llm.common import settle

#: Conversations c with the same c - c % FAMILY share a base; heads have fewer than HEADS turns.
FAMILY, HEADS = 5, 9
PRIME = 2**31 - 1
#: Four lanes of 31 bits; further rows are taken if a group turns out to hold different turns.
BASES = (
    (1_103_515_245, 736_338_717, 1_812_433_253, 214_013_911),
    (1_664_525_003, 950_706_376, 1_226_874_159, 62_089_911),
)
LANES = range(4)
#: Rows of one block when something is summed along a conversation, and ids that are joined before they are hashed.
BLOCK_TURNS, BLOCK_IDS = 4096, 4096


def _times(a: Column, b: Column | int) -> Column:
    return a * b % F.lit(PRIME)


def _power(base: int, exponent: Column) -> Column:
    """base ** exponent modulo PRIME, by the exponent's binary digits; 1 where it is 0."""
    square_step = lambda acc, digit: acc * acc % F.lit(PRIME) * F.when(digit == "1", base).otherwise(1) % F.lit(PRIME)
    return F.aggregate(F.split(F.bin(exponent), ""), F.lit(1).cast("long"), square_step)


def _lanes(name: str) -> list[str]:
    return [f"{name}{i}" for i in LANES]


def stored_turns(df: DataFrame) -> DataFrame:
    """Every turn with its place: conv, pos (1, 2, ...), role, text, bytes, and four numbers t0..t3 of its content.

    Order within a conversation: turn (null first), then role and text. All turns are dealt out by ranges of this order,
    so those of one long conversation lie in many tasks; its rows in earlier ranges are counted and added.
    """
    turns = df.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = [F.asc_nulls_first("turn"), "role", "text"]
    turns = turns.repartitionByRange("conv", *order).withColumn("range", F.spark_partition_id())
    turns = settle(turns, "trie-ranges")
    counts = turns.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("conv", "range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    placed = turns.withColumn("row", F.row_number().over(Window.partitionBy("conv", "range").orderBy(*order)))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    numbers = [
        F.pmod(F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("long"), F.lit(PRIME)).alias(f"t{i}") for i in LANES
    ]
    placed = placed.join(counts, ["conv", "range"]).select(
        "conv", (F.col("row") + F.col("ahead")).alias("pos"), "role", "text", F.octet_length("text").alias("bytes"), *numbers
    )
    return settle(placed, "trie-turns")


def running_sums(df: DataFrame, group: str, place: str, values: list[str], backwards: bool = False) -> DataFrame:
    """Replaces values by their sums along `place` (1, 2, ... in each group), itself included; one block is one task's."""
    blocked = df.withColumn("_block", F.expr(f"{place} div {BLOCK_TURNS}"))
    sums = blocked.groupBy(group, "_block").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    direction = F.desc if backwards else F.asc
    ahead = Window.partitionBy(group).orderBy(direction("_block")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "_block", *[F.coalesce(F.sum(f"_sum_{v}").over(ahead), F.lit(0)).alias(f"_ahead_{v}") for v in values])
    inside = Window.partitionBy(group, "_block").orderBy(direction(place))
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = blocked.withColumns({v: F.sum(v).over(inside) for v in values}).join(sums, [group, "_block"])
    return summed.withColumns({v: F.col(v) + F.col(f"_ahead_{v}") for v in values}).drop(
        "_block", *[f"_ahead_{v}" for v in values]
    )


def prefix_fingerprints(store: DataFrame, bases: tuple[int, ...]) -> DataFrame:
    """Turns without text: conv, pos, bytes, terms s0..s3 (t * x^pos) and fingerprints h0..h3 of the turns up to here."""
    terms = {f"s{i}": _times(F.col(f"t{i}"), _power(bases[i], F.col("pos"))) for i in LANES}
    turns = store.select("conv", "pos", "bytes", *_lanes("t")).withColumns(terms)
    turns = turns.withColumns({f"h{i}": F.col(f"s{i}") for i in LANES})
    summed = running_sums(turns, "conv", "pos", _lanes("h"))
    return summed.select("conv", "pos", "bytes", *_lanes("s"), *[_times(F.col(h), 1).alias(h) for h in _lanes("h")])


def rebuilt_prefixes(turns: DataFrame, bases: tuple[int, ...]) -> DataFrame:
    """Every prefix of every rebuilt conversation, as a row without text.

    conv, depth, bytes of its last turn, fingerprint f0..f3, that of the prefix before it p0..p3, and where the last turn
    is stored: ref_conv, ref_pos. A rebuilt conversation without turns has only its root row (depth 0), as all have one.
    """
    top = F.when(F.col("pos") < HEADS, F.struct("pos", "bytes", *_lanes("s"), *_lanes("h")))
    # fewer than HEADS structs a conversation: collect_list skips the nulls of all later turns
    convs = turns.groupBy("conv").agg(F.max("pos").alias("n"), F.array_sort(F.collect_list(top)).alias("top"))
    convs = settle(convs, "trie-convs")
    wanted = convs.withColumn("base", F.expr(f"conv - conv % {FAMILY}")).withColumn(
        "h", F.expr(f"crc32(cast(conv AS string)) % {HEADS}").cast("long")
    )
    wanted = wanted.join(convs.select(F.col("conv").alias("base"), F.col("top").alias("base_top")), "base", "left")
    wanted = wanted.withColumn("k", F.least("h", F.greatest(F.size("base_top"), F.lit(0))).cast("long"))
    at_k, at_h = F.get("base_top", F.col("k").cast("int") - 1), F.get("top", F.col("h").cast("int") - 1)
    zero = F.lit(0).cast("long")
    wanted = wanted.select(
        "conv", "base", "n", "h", "k", F.slice("base_top", 1, F.col("k").cast("int")).alias("head"),
        *[F.coalesce(at_k[f"h{i}"], zero).alias(f"k{i}") for i in LANES],
        *[F.coalesce(at_h[f"h{i}"], zero).alias(f"o{i}") for i in LANES],
        # heads are never shorter than the stretch that they replace: the shift is a negative power
        *[_power(pow(bases[i], -1, PRIME), F.col("h") - F.col("k")).alias(f"x{i}") for i in LANES],
    )
    wanted = settle(wanted, "trie-plans")

    none = F.lit(None).cast("long")
    roots = wanted.select(
        "conv", zero.alias("depth"), zero.alias("bytes"), *[zero.alias(f) for f in _lanes("f")],
        *[zero.alias(p) for p in _lanes("p")], none.alias("ref_conv"), none.alias("ref_pos"),
    )
    heads = wanted.select("conv", "base", F.explode("head").alias("t")).select(
        "conv", F.col("t.pos").cast("long").alias("depth"), F.col("t.bytes").cast("long").alias("bytes"),
        *[F.col(f"t.h{i}").alias(f"f{i}") for i in LANES],
        *[_times(F.col(f"t.h{i}") - F.col(f"t.s{i}") + PRIME, 1).alias(f"p{i}") for i in LANES],
        F.col("base").alias("ref_conv"), F.col("t.pos").cast("long").alias("ref_pos"),
    )
    own = turns.join(wanted.where("n > h").drop("head", "n", "base"), "conv").where("pos > h")

    def moved(i: int, value: Column) -> Column:
        return _times(_times(value - F.col(f"o{i}") + PRIME, F.col(f"x{i}")) + F.col(f"k{i}"), 1)

    own = own.select(
        "conv", (F.col("pos") - F.col("h") + F.col("k")).cast("long").alias("depth"), F.col("bytes").cast("long").alias("bytes"),
        *[moved(i, F.col(f"h{i}")).alias(f"f{i}") for i in LANES],
        *[moved(i, _times(F.col(f"h{i}") - F.col(f"s{i}") + PRIME, 1)).alias(f"p{i}") for i in LANES],
        F.col("conv").alias("ref_conv"), F.col("pos").cast("long").alias("ref_pos"),
    )
    rows = roots.unionByName(heads).unionByName(own)
    packed = {
        name: (F.col(f"{lane}{i}") * (PRIME + 1) + F.col(f"{lane}{i + 1}")).alias(name)
        for name, lane, i in (("fa", "f", 0), ("fb", "f", 2), ("pa", "p", 0), ("pb", "p", 2))
    }
    return rows.select("conv", "depth", "bytes", "ref_conv", "ref_pos", *packed.values())


def groups_hold(rows: DataFrame, store: DataFrame) -> bool:
    """Whether all prefixes of one fingerprint have the same turns.

    By induction over the depth: their last turns, fetched by reference, have the same role and text, and the prefixes before
    them the same fingerprint. Least and greatest values are made before the shuffle, so a hot group moves few rows.
    """
    node = ["depth", "fa", "fb"]
    before = rows.groupBy(*node).agg(F.min(F.struct("pa", "pb")).alias("least"), F.max(F.struct("pa", "pb")).alias("most"))
    refs = rows.where("depth > 0").select(*node, F.col("ref_conv").alias("conv"), F.col("ref_pos").alias("pos")).distinct()
    said = refs.join(store.select("conv", "pos", F.struct("role", "text").alias("said")), ["conv", "pos"])
    said = said.groupBy(*node).agg(F.min("said").alias("least"), F.max("said").alias("most"))
    return all(x.where("least <> most").isEmpty() for x in (before, said))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, fa, fb, block, ids) sorted by these: one SHA-256 of the joined ids a node, fed block by block."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
    out: list[tuple] = []
    for node, parts in groupby(rows, key=lambda row: row[:3]):
        digest = sha256()
        for i, (*_, ids) in enumerate(parts):
            digest.update((b"," if i else b"") + ids.encode())
        out.append((*node, digest.hexdigest()))
        if len(out) >= 10_000:
            yield _digest_batch(out)
            out = []
    if out:
        yield _digest_batch(out)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["depth", "fa", "fb", "ends_sha256"])


def prefix_trie(df: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows with a null conv_id belong to no conversation; null roles and texts are empty; rows that repeat are turns of their
    own; turns that tie are ordered by role and text. An empty table has no conversations and no node. Other columns are
    not looked at. Texts are never joined, of any length, and a conversation may have any number of turns.

    A node is known by its smallest member and its depth, so what nodes owe to their subtrees is summed backwards along each
    conversation and then over the members: a subtree's nodes each count at exactly one member of its top.
    """
    store = stored_turns(df)
    for bases in BASES:
        rows = settle(rebuilt_prefixes(settle(prefix_fingerprints(store, bases), "trie-prefixes"), bases), "trie-rows")
        if groups_hold(rows, store):
            break
    else:
        raise RuntimeError("different prefixes share a fingerprint under every base")
    node = ["depth", "fa", "fb"]
    nodes = rows.groupBy(*node).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"),
        F.max("bytes").alias("bytes"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
    )
    nodes = settle(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("fa"), F.col("pb").alias("fb"))
    nodes = nodes.join(children.agg(F.count(F.lit(1)).alias("n_children")), node, "left")
    nodes = settle(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-children")

    own = nodes.select(
        "conv", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    totals = rows.select("conv", "depth", "fa", "fb").join(own, ["conv", "depth"], "left").na.fill(0, ["n_leaves", "saved_tokens"])
    totals = running_sums(totals, "conv", "depth", ["n_leaves", "saved_tokens"], backwards=True)
    totals = totals.groupBy(*node).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    last = rows.groupBy("conv").agg(F.max(F.struct(*node)).alias("end")).select("conv", "end.*")
    ends = last.withColumn("block", F.expr(f"floor(conv / {BLOCK_IDS}D)")).groupBy(*node, "block")
    ends = ends.agg(F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    ends = ends.repartition(*node).sortWithinPartitions(*node, "block").select(*node, "ids")
    ends = ends.mapInArrow(_digests, "depth long, fa long, fb long, ends_sha256 string")

    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("fa").alias("pa"), F.col("fb").alias("pb"), F.col("conv").alias("parent_conv_id")
    )
    joined = nodes.join(parents, ["depth", "pa", "pb"], "left")
    joined = reduce(lambda left, right: left.join(right, node, "left"), (totals, ends), joined)
    return joined.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op11_monoid_prefix_trie(df: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations; columns of the contract."""
    return prefix_trie(df)


#: CRC-32 of the decimal digits, bit by bit (the polynomial is a fixed value).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END)), 4294967295::BIGINT)"""
#: The same rows in DuckDB, with prefixes as joined digests of turns.
SQL = f"""
WITH own AS (
  SELECT conv_id, sha256(concat(length(role), ':', role, text)) AS said, strlen(text) AS bytes,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % {FAMILY} AS base, {_CRC} % {HEADS} AS h FROM own GROUP BY conv_id
), plans AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS k FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
rebuilt AS (
  SELECT p.conv_id, o.pos AS depth, o.said, o.bytes FROM plans p JOIN own o ON o.conv_id = p.base AND o.pos <= p.k
  UNION ALL
  SELECT p.conv_id, o.pos - p.h + p.k, o.said, o.bytes FROM plans p JOIN own o ON o.conv_id = p.conv_id AND o.pos > p.h
), prefixes AS (
  SELECT conv_id, depth, bytes, string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs
), ends AS (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = last), '')) AS ends_sha256
  FROM (SELECT p.*, e.depth AS last FROM prefixes p JOIN ends e USING (conv_id)) GROUP BY path, depth
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND starts_with(c.path, n.path)) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND starts_with(n.path, p.path)
)
SELECT CAST(a.conv_id AS BIGINT) AS conv_id, CAST(a.depth AS BIGINT) AS depth, CAST(any_value(a.parent_conv_id) AS BIGINT) AS parent_conv_id,
  CAST(any_value(a.n_convs) AS BIGINT) AS n_convs, CAST(any_value(a.n_children) AS BIGINT) AS n_children,
  count(*) FILTER (WHERE d.n_children = 0) AS n_leaves,
  CAST(sum((d.n_convs - 1) * d.bytes) AS BIGINT) AS saved_tokens, any_value(a.ends_sha256) AS ends_sha256
FROM linked a JOIN linked d ON d.depth >= a.depth AND starts_with(d.path, a.path)
GROUP BY a.path, a.conv_id, a.depth
"""
