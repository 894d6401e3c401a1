"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeship.llm.common import WORD, settle, whole_text

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 4096
#: A source's rows are shuffled into so many buckets; it bounds what one task sorts, not the result's quality.
BUCKETS = 1024
#: Slots of the schedule that one task ranks together.
SLOTS_A_CHUNK = 65_536
#: Fractional part of the golden ratio, as a multiple of 2^-31, and the modulus. Odd, so a full period.
GOLDEN, TURN = 1_327_217_885, 2**31
CELLS = 1024


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Words each source should give: (source, source_size) -> plus `rank`, `weight`, `target`.

    Sources in code-point order, null last, take the weights in turn; all targets together are 100 % of all
    sizes. A target stops at `most` times its source's size and the excess goes to the others by weight,
    until none is above. That level is found in closed form: with sources sorted by cap / weight, the first k
    are capped, where k is the longest run for which each cap lies under the level that the rest would have.
    One row a source (not a document) meets in one task.
    """
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    cases = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", cases).withColumn("_cap", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("_cap") / F.col("weight"), "rank")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ranked = ranked.withColumn("_level", left / F.sum("weight").over(onward))
    ranked = ranked.withColumn("_capped", F.col("_level") * F.col("weight") > F.col("_cap"))
    ranked = ranked.withColumn("_capped", F.min("_capped").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    level = F.min(F.when(~F.col("_capped"), F.struct(F.col("_cap") / F.col("weight"), "rank", "_level"))).over(everywhere)
    return ranked.withColumn("_final", level["_level"]).select(
        "source",
        "source_size",
        "rank",
        "weight",
        F.when(F.col("_capped"), F.col("_cap"))
        .otherwise(F.least(F.col("_cap"), F.col("_final") * F.col("weight")))
        .alias("target"),
    )


def slot_count(targets: DataFrame, block: int = BLOCK_WORDS) -> int:
    """How many slots of `block` words the mix has; turns that the points leave out follow in one more."""
    words = targets.agg(F.sum("target")).first()[0] or 0
    return -int(-words // block)


def schedule(targets: DataFrame, block: int = BLOCK_WORDS, chunk: int = SLOTS_A_CHUNK) -> DataFrame:
    """The order in which blocks are read: (slot, rank, turn); `turn` counts a source's slots from 0.

    Slot j lies at the golden-ratio point j * phi mod 1; the cumulative shares of the targets say which
    source's it is. Any stretch of slots thus holds each source in close to its share. Turns beyond a source's
    target are dropped, and turns that the points left out (a few for a source) follow at the end.
    `targets` must be stored (it is read more than once).
    """
    spark = targets.sparkSession
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    high = F.sum("target").over(upto) / F.sum("target").over(everywhere) * TURN
    low = (F.sum("target").over(upto) - F.col("target")) / F.sum("target").over(everywhere) * TURN
    shares = targets.where("target > 0").select(
        "rank", F.ceil(F.col("target") / block).alias("turns"), low.alias("_low"), high.alias("_high")
    )
    cell = TURN // CELLS
    # the cells of the unit interval that a source's share touches, so that points find their source by equality
    cells = shares.withColumn(
        "_cell",
        F.explode(F.sequence(F.floor(F.col("_low") / cell), F.least(F.floor(F.col("_high") / cell), F.lit(CELLS - 1)))),
    )
    length = slot_count(targets, block)
    slots = spark.range(length).withColumnRenamed("id", "slot")
    slots = slots.withColumn("_point", F.expr(f"(slot % {TURN}) * {GOLDEN}L % {TURN}"))
    slots = slots.withColumn("_chunk", F.expr(f"slot div {chunk}")).withColumn("_cell", F.expr(f"_point div {cell}"))
    slots = slots.join(cells, "_cell").where("_point >= _low AND _point < _high")
    counts = slots.groupBy("rank", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("rank").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("rank", "_chunk", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("rank", "_chunk").orderBy("slot")
    turned = slots.withColumn("_in", F.row_number().over(inside) - 1).join(starts, ["rank", "_chunk"])
    turned = turned.withColumn("turn", (F.col("_in") + F.col("_ahead")).cast("long")).where("turn < turns")
    short = shares.join(counts.groupBy("rank").agg(F.sum("_n").alias("_n")), "rank", "left")
    short = short.withColumn("_n", F.coalesce("_n", F.lit(0))).where("_n < turns")
    closing = short.select(
        F.lit(length).cast("long").alias("slot"), "rank", F.explode(F.expr("sequence(_n, turns - 1)")).alias("turn")
    )
    return turned.select("slot", "rank", "turn").unionByName(closing)


def mix(
    df: DataFrame,
    keep: dict[str, Column],
    seed: int = 7,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
    block: int = BLOCK_WORDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """How many words of each row the mix takes: columns of `keep`, source, size, source_size, target, taken.

    Rows of a source are laid out in a shuffled order (by a hash of doc_id and text with `seed`), again and again if
    need be, and cut into blocks of `block` words. A source's slot of turn t reads block t of that endless layout; the
    last turn stops at the target. `taken` sums what the slots read of a row, `n_slots` counts them, and `starts` says
    for each of its copies where in the mix it begins: struct<slot, at>, `at` being its place in its source's layout. The
    mix is what one reads in the order of the starts. `mix_slots` is the number of all slots. The order depends on the rows alone, so
    reruns and other cluster sizes give the same mix.

    Null sources are a source of their own, last in order; null texts have size 0 and give 0 words; an empty table gives
    no rows; equal rows are rows of their own.
    """
    size = F.regexp_count(whole_text(), F.lit(WORD))
    rows = df.select(
        *[c.alias(f"_out_{name}") for name, c in keep.items()],
        F.col("source").cast("string").alias("source"),
        size.cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), whole_text()).alias("_hash"),
    )
    rows = settle(rows, "mix-rows")
    targets = settle(
        source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets"
    )
    goals = targets.select(
        F.col("source").alias("_source"), "source_size", "rank", "target", F.round("target").cast("long").alias("_goal")
    )
    rows = rows.join(goals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # place of each row in its source's layout: sums of buckets, then sums within a bucket
    rows = rows.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    sums = rows.groupBy("rank", "_bucket").agg(F.sum("size").alias("_n"))
    ahead = Window.partitionBy("rank").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "_bucket", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    outs = [f"_out_{name}" for name in keep]
    inside = Window.partitionBy("rank", "_bucket").orderBy("_hash", *outs, "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums, ["rank", "_bucket"]).withColumn("_start", F.col("_in") + F.col("_ahead")).drop("_in", "_ahead")
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    rows = settle(rows, "mix-layout")
    # every copy of a row in the layout that starts ahead of the goal, cut into the blocks it touches
    copies = rows.where("size > 0 AND _start < _goal").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(_goal - 1 - _start) div source_size")))
    )
    copies = copies.withColumn("_from", F.col("_start") + F.col("_copy") * F.col("source_size"))
    copies = copies.withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("_goal")))
    pieces = copies.withColumn(
        "turn", F.explode(F.sequence(F.expr(f"_from div {block}"), F.expr(f"(_to - 1) div {block}")))
    ).select(
        "_row",
        "rank",
        "turn",
        "_copy",
        "_from",
        (F.least("_to", (F.col("turn") + 1) * block) - F.greatest("_from", F.col("turn") * block)).alias("_words"),
    )
    taken = pieces.join(schedule(targets, block), ["rank", "turn"])
    begins = [F.min(F.when(F.col("_copy") == c, F.struct("slot", F.col("_from").alias("at")))) for c in range(most + 1)]
    taken = taken.groupBy("_row").agg(
        F.sum("_words").alias("_taken"), F.count(F.lit(1)).alias("_n_slots"), F.array_compact(F.array(*begins)).alias("starts")
    )
    return rows.join(taken, "_row", "left").select(
        *[F.col(f"_out_{name}").alias(name) for name in keep],
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("_n_slots", F.lit(0)).cast("long").alias("n_slots"),
        "starts",
        F.lit(slot_count(targets, block)).cast("long").alias("mix_slots"),
    )


def op5_low_discrepancy_mix(df: DataFrame) -> DataFrame:
    """The mix of all documents, one row a document: columns of the contract, then where the mix first reads it.

    `first_slot` and `first_at` order the mix (null: nothing is taken); `n_slots` slots read of the document.
    """
    first = F.col("starts")[0]
    return mix(df, keep={"doc_id": F.col("doc_id")}).select(
        "doc_id", "size", "source_size", "target", "taken", first["slot"].alias("first_slot"), first["at"].alias("first_at"), "n_slots"
    )


def mixed_documents(df: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The documents of the mix, whole, each as often as the mix takes it (taken / size, rounded half up), in its order.

    Each copy stands where the schedule reads its first word: partitions, and thus the files of a written result, are
    stretches of equally many slots, and rows in them are sorted by slot. All columns stay; documents without a word have
    nothing to give and go. Rows that are equal in doc_id, source and text share evenly in what the mix takes of them, and
    stand together.
    """
    key = ["_id", "_source", "_text"]
    parts = {"_id": F.col("doc_id"), "_source": F.col("source"), "_text": F.xxhash64(whole_text())}
    starts = F.array_compact(F.array(*[F.min(F.get("starts", F.lit(c))) for c in range(MOST_REPEATS + 1)]))
    mixed = mix(df, keep=parts, block=block).groupBy(key).agg(
        F.sum("taken").alias("_taken"), F.sum("size").alias("_size"), starts.alias("_starts"), F.max("mix_slots").alias("_slots")
    )
    mixed = mixed.where("_size > 0").withColumn("_times", F.expr("int(floor(_taken / _size + 0.5D))")).where("_times > 0")
    whole = F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_doc")
    rows = df.select(whole, *[column.alias(f"_doc{name}") for name, column in parts.items()])
    same = [F.col(f"_doc{name}").eqNullSafe(F.col(name)) for name in key]
    joined = rows.join(mixed, (same[0]) & (same[1]) & (same[2]))
    joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    joined = joined.withColumn("_start", F.coalesce(F.get("_starts", F.col("_copy")), F.col("_starts")[0]))
    stretches = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretch = F.least(F.col("_start.slot") * stretches / F.greatest("_slots", F.lit(1)), F.lit(stretches - 1))
    placed = joined.repartitionById(stretches, F.floor(stretch).cast("int"))
    placed = placed.sortWithinPartitions("_start.slot", "_start.at", "_doc_id", "_doc_text")
    return placed.select("_doc.*")
