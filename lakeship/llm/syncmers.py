"""Document fingerprints of closed syncmers, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeship.llm.common import LOWEST, WORD_BREAK, let, whole_text

#: Words of a k-mer and of its inner substrings: two of K - S + 1 inner places are edges, so about 2/5 of the k-mers stay.
K, S = 6, 2
#: Buckets of consecutive doc_ids that the neighbours of documents are found in, for each shuffle partition.
BUCKETS_A_PARTITION = 4


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def syncmers(text: Column, k: int = K, s: int = S) -> Column:
    """The closed syncmers of a text's words as array<struct<position, anchor>>.

    A k-mer is k words in a row; it stays if the least hash of its inner substrings (s words) is its first or its last
    one. That depends on the k-mer alone, so a passage keeps its anchors in any surroundings. Texts of fewer than k
    words have one anchor, all words at position 0; texts without words have none.
    """
    inner = k - s + 1

    def edges(hashes: Column) -> Column:
        least_inner = lambda i: F.least(*[hashes[i + j] for j in range(1, inner - 1)])
        return F.filter(
            F.sequence(F.lit(0), F.size(hashes) - inner),
            lambda i: F.least(hashes[i], hashes[i + inner - 1]) <= least_inner(i),
        )

    def anchors(own: Column) -> Column:
        pieces = F.transform(
            F.sequence(F.lit(0), F.size(own) - s), lambda i: F.xxhash64(*[own[i + j] for j in range(s)])
        )
        return F.transform(
            let(pieces, edges),
            lambda i: F.struct(i.alias("position"), F.xxhash64(*[own[i + j] for j in range(k)]).alias("anchor")),
        )

    kind = "array<struct<position:int,anchor:bigint>>"
    whole = lambda own: F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(own).alias("anchor")))
    return let(
        F.transform(words(text), lambda w: F.xxhash64(w)),
        lambda own: F.when(F.size(own) >= k, anchors(own).cast(kind))
        .when(F.size(own) > 0, whole(own).cast(kind))
        .otherwise(F.array().cast(kind)),
    )


def fingerprint(text: Column) -> Column:
    """The anchors of a text as distinct 32-bit numbers, in the order of their first positions."""
    return F.array_distinct(
        F.transform(syncmers(text), lambda a: F.shiftrightunsigned(a["anchor"], 32).bitwiseAND(F.lit(0xFFFFFFFF)))
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of anchors that two fingerprints have in common: twice the common ones by all; 1 if both have none."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def written(prints: Column) -> Column:
    """A fingerprint as text: the anchors in hexadecimal, separated by spaces."""
    return F.array_join(F.transform(prints, lambda a: F.lower(F.hex(a))), " ")


def positional_matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Where texts share anchors: (left_id, right_id, shift, n) for tables (id, text); `shift` is how many words later
    the passage stands on the right. Anchors join by equality; those of one pair and shift are counted before the shuffle.
    """
    def placed(df: DataFrame, side: str) -> DataFrame:
        rows = df.select(F.col("id").alias(f"{side}_id"), F.explode(syncmers(whole_text())).alias("a"))
        return rows.select(f"{side}_id", F.col("a.anchor").alias("anchor"), F.col("a.position").alias(f"{side}_at"))

    joined = placed(left, "left").join(placed(right, "right"), "anchor")
    return joined.groupBy("left_id", "right_id", (F.col("right_at") - F.col("left_at")).alias("shift")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _bounds(df: DataFrame, buckets: int) -> list[int]:
    """First ids of up to `buckets` ranges of about equal size; one number a range comes to the driver."""
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx("_id", shares, 100 * buckets)).first()[0]
    return sorted(set(found or []))


def with_next(df: DataFrame) -> DataFrame:
    """doc_id, text, next_text, and the fingerprints of both: `print`, `next_print`.

    The next document is the one with the next higher (doc_id, text hash); after the last comes the first. Null ids come
    first. Documents lie in buckets of consecutive ids; the first document of each bucket is copied to the one
    before it, so one shuffle of the texts brings all neighbours together, in buckets of bounded size. (Rows with one and
    the same doc_id share a bucket.)
    """
    rows = df.select(
        F.col("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("_id"),
        whole_text().alias("text"),
    )
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(rows, BUCKETS_A_PARTITION * partitions)
    # the lowest id of each bucket that has rows, as a list of one number a bucket
    edges = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    bucket = F.size(F.filter(edges, lambda b: b <= F.col("_id")))
    firsts = [r["first"] for r in rows.groupBy(bucket.alias("b")).agg(F.min("_id").alias("first")).collect()]
    firsts.sort()
    lows = F.array(*[F.lit(b).cast("long") for b in firsts]) if firsts else F.array().cast("array<bigint>")
    place = F.size(F.filter(lows, lambda b: b <= F.col("_id"))) - 1
    rows = rows.withColumn("_place", place)
    is_first = F.get(lows, F.col("_place")) == F.col("_id")
    before = F.pmod(F.col("_place") - 1, F.lit(max(len(firsts), 1)))
    own = F.struct(F.lit(False).alias("lent"), F.col("_place").alias("bucket"))
    lent = F.struct(F.lit(True).alias("lent"), before.alias("bucket"))
    rows = rows.withColumn("_at", F.explode(F.when(is_first, F.array(own, lent)).otherwise(F.array(own))))
    rows = rows.select("doc_id", "_id", "text", "_at.lent", "_at.bucket").repartition("bucket")
    rows = rows.withColumn("print", fingerprint(F.col("text"))).withColumn("_hash", F.xxhash64("text"))
    ahead = Window.partitionBy("bucket").orderBy("lent", "_id", "_hash", "text")
    after = F.lead(F.struct("text", "print")).over(ahead)
    return rows.withColumn("_next", after).where("NOT lent").select(
        "doc_id", "text", "print", F.col("_next.text").alias("next_text"), F.col("_next.print").alias("next_print")
    )


def op3_closed_syncmers(df: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses; the columns of the contract.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of the next
    document's. Null texts are empty; an empty text has no anchors, and two such are alike (1). A single document is its own
    next. Repeated rows follow each other.
    """
    rows = with_next(df).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.concat(F.expr("left(text, int(n_chars - n_chars div 4))"), F.expr("left(next_text, int(n_chars div 4))"))
    rows = rows.withColumn("edited", edited).withColumn("edited_print", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("print")).alias("fingerprint"),
        written(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
