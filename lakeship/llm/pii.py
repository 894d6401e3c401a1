"""Personal data: fixed forms, and identifiers that bootstrapped contexts point to. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeship.llm.common import blocks_of, let, matches, part_of, running, settle, whole_text

KINDS = ("email", "ip", "card", "phone")
#: The base forms, written so that each position is tried at most once: a match starts where a run of its characters
#: starts, or where the match before it ended (\G). Possessive loops never go back and take no stack.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Only runs of 16 digits or more are of interest; they are the whole runs of the base form.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_VALUE = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
_QUAD = r"(?![0-9]++(?:\.[0-9]++){3})"
#: Adjacent tokens of digits and the signs between them, as in '(555) 123-4567' or '4111 1111 1111 1111': together at most
#: the 19 digits of the longest base form, cut between tokens only. What looks like an address stays by itself.
NUMBER = (
    rf"(?<!\S)[^\s0-9@]*+(?<!\p{{L}}){_QUAD}[0-9](?:(?:[()-]|\.(?!\x20)|\x20{_QUAD})*+[0-9]){{0,18}}"
    r"[.,;:!?)\]}>\"']*+(?!\S)"
)
#: What may be an identifier: such a number, or a token that has a digit or an @.
TOKEN = NUMBER + r"|(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Stands for each character of a base match where candidates are looked for.
BLANK = "\ufffc"

ROUNDS = 3
#: A pattern counts once this many distinct known instances stand behind it, and is trusted from this score on.
LEAST_INSTANCES, LEAST_SCORE = 3, 0.6
#: Added to the number of a pattern's occurrences, so that few of them can't make it sure.
DOUBT = 1.0
SPAN = "struct<kind:int,start:int,end:int>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass the check: from the right, every second one doubled, sum of digits a multiple of 10."""
    turned = F.split(F.reverse(_digits(value)), "")
    numbers = F.filter(turned, lambda d: d != "")
    doubled = F.transform(
        numbers,
        lambda d, i: F.when(i % 2 == 1, F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int") + 1))
        .otherwise(d.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0


def _kept(found: Column, kind: int, holds) -> Column:
    spans = F.filter(found, lambda m: holds(m["value"]))
    return F.transform(
        spans, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
    ).cast(f"array<{SPAN}>")


def base_spans(text: Column) -> Column:
    """The base forms as array<struct<kind, start, end>>, by kind as listed, then by start."""
    none = F.array().cast(f"array<{SPAN}>")
    sixteen = lambda v: F.length(_digits(v)).between(16, 19) & _luhn(v)
    return F.concat(
        F.when(text.contains("@"), _kept(matches(text, EMAIL), 0, lambda v: F.lit(True))).otherwise(none),
        F.when(text.rlike(IP), _kept(matches(text, IP), 1, lambda v: v.rlike(IP_VALUE))).otherwise(none),
        F.when(text.rlike(CARD), _kept(matches(text, CARD), 2, sixteen)).otherwise(none),
        F.when(
            text.contains("+"), _kept(matches(text, PHONE), 3, lambda v: F.length(_digits(v)).between(8, 15))
        ).otherwise(none),
    )


def _normal(value: Column) -> Column:
    """What tells identifiers apart: the digits if there are as many as in a phone or card number, else lower case."""
    number = value.rlike(r"^[^\p{L}@]*$") & ~value.rlike(_QUAD.replace("?!", "?:", 1)) & (F.length(_digits(value)) >= 8)
    return F.when(number, _digits(value)).otherwise(F.lower(value))


def _instances(text: Column, base: Column) -> Column:
    """Base matches as struct<blanked, found>: the text with BLANK for each of their characters, and
    array<struct<start, end, value, context, kind>>.

    Each is a seed with its whole value. `context` is the word before the token where it starts; it is empty for a further
    match in one token. Of overlapping matches the first counts.
    """
    kind = "array<struct<start:int,end:int,value:string,context:string,kind:int>>"
    order = F.array_sort(F.transform(base, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"])))
    spans = F.transform(order, lambda s: F.struct(s["start"], (-s["back"]).alias("end"), s["kind"]))

    def seed(blocks, s):
        ahead = part_of(blocks, s["at"], s["start"])
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            _normal(part_of(blocks, s["start"], s["end"])).alias("value"),
            F.lower(F.regexp_extract(ahead, r"(?<!\S)(\S++)\s++\S*+$", 1)).alias("context"),
            s["kind"].alias("kind"),
        )

    def blanked(blocks, s):
        ahead = F.when(s["start"] > s["at"], part_of(blocks, s["at"], s["start"])).otherwise("")
        return F.concat(ahead, F.repeat(F.lit(BLANK), F.greatest(s["end"] - F.greatest(s["at"], s["start"]), F.lit(0))))

    def seen(blocks, placed):
        first = F.filter(placed, lambda s: s["start"] >= s["at"])
        parts = F.transform(placed, lambda s: blanked(blocks, s))
        return F.struct(
            F.concat(F.array_join(parts, ""), _rest(text, placed)).alias("blanked"),
            F.transform(first, lambda s: seed(blocks, s)).cast(kind).alias("found"),
        )

    many = let(blocks_of(text), lambda blocks: let(_after_others(spans), lambda placed: seen(blocks, placed)))
    return F.when(F.size(base) > 0, many).otherwise(F.struct(text.alias("blanked"), F.array().cast(kind).alias("found")))


def _after_others(spans: Column) -> Column:
    """Spans, sorted by start, each with `at`, where those before it end; those that start before `at` overlap."""
    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest)
    at = lambda ends, i: F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
    place = lambda ends, s, i: F.struct(
        at(ends, i).alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
    )
    return let(ends, lambda ends: F.transform(spans, lambda s, i: place(ends, s, i)))


def _rest(text: Column, placed: Column) -> Column:
    """The text behind all spans."""
    return F.substring(text, F.array_max(F.transform(placed, lambda s: s["end"])) + 1, F.length(text))


def candidates(text: Column) -> Column:
    """What may be an identifier, as array<struct<start, end, value, context, kind>> with kind null; `context` is the word
    before."""
    bare = lambda m: F.regexp_replace(m["value"], r"(?<![.,;:!?)\]}>\"'])[.,;:!?)\]}>\"']++$", "")

    def case(tokens, m, i):
        touching = F.regexp_extract(F.get(tokens, i - 1)["value"], r"(?<!\S)(\S++)$", 1)
        word = F.when((i > 0) & ~m["before"].rlike(r"\S"), touching).otherwise(
            F.regexp_extract(m["before"], r"(?<!\S)(\S++)\s++$", 1)
        )
        return let(
            bare(m),
            lambda value: F.struct(
                m["start"].alias("start"),
                (m["start"] + F.length(value)).alias("end"),
                _normal(value).alias("value"),
                F.lower(word).alias("context"),
                F.lit(None).cast("int").alias("kind"),
            ),
        )

    return let(matches(text, TOKEN), lambda tokens: F.transform(tokens, lambda m, i: case(tokens, m, i)))


def _untouched(cases: Column, text: Column, blanked: Column) -> Column:
    """Those of `cases` that overlap no base match. Base forms have no BLANK of their own, so where one lies the texts differ."""

    def alike(before, after, c):
        part = part_of(after, c["start"], c["end"])
        return ~part.contains(BLANK) | (part == part_of(before, c["start"], c["end"]))

    blocks = F.struct(blocks_of(text).alias("before"), blocks_of(blanked).alias("after"))
    return let(blocks, lambda b: F.filter(cases, lambda c: alike(b["before"], b["after"], c)))


def scan(df: DataFrame, keep: dict[str, Column]) -> DataFrame:
    """Columns of `keep`, base, cases for each row; one pass over the texts."""
    rows = df.select(*[c.alias(f"_out_{name}") for name, c in keep.items()], whole_text().alias("_text"))
    text, blanked = F.col("_text"), F.col("_seen.blanked")
    none = F.array().cast("array<struct<start:int,end:int,value:string,context:string,kind:int>>")
    rows = rows.withColumn("_base", base_spans(text)).withColumn("_seen", _instances(text, F.col("_base")))
    apart = F.when(F.size("_base") > 0, _untouched(candidates(blanked), text, blanked)).otherwise(candidates(blanked))
    fresh = F.when(blanked.rlike("[0-9@]"), apart).otherwise(none)
    return rows.select(
        *[F.col(f"_out_{name}").alias(name) for name in keep],
        F.col("_base").alias("base"),
        F.concat("_seen.found", fresh).alias("cases"),
    )


def context_counts(df: DataFrame) -> DataFrame:
    """(word, n): how often each word, in lower case, stands before another one in all texts."""
    words = df.select(F.explode(F.split(F.lower(whole_text()), r"\s+")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def trusted_patterns(
    cases: DataFrame, counts: DataFrame, rounds: int = ROUNDS, least: float = LEAST_SCORE, support: int = LEAST_INSTANCES
) -> DataFrame:
    """(context, kind, score) of the patterns that hold after `rounds` of bootstrapping.

    `cases`: (context, value, kind), kind null where the value is no seed. The graph of patterns and instances has an edge
    for each distinct (context, value), with its number of occurrences. A pattern's score is the share of all occurrences
    of its context, in the whole corpus, that stand before known instances, each by its own score; an instance that is no
    seed is as sure as its patterns together make it (noisy or). Seeds stay sure. A pattern without enough
    distinct known instances has no say. Contexts and values that very many rows share are summed before the shuffle.
    """
    edges = cases.where("context <> ''").groupBy("context", "value").agg(
        F.count(F.lit(1)).alias("n"), F.max("kind").alias("kind")
    )
    edges = settle(edges, "pii-graph")
    seeds = edges.where("kind IS NOT NULL").groupBy("value").agg(F.max("kind").alias("kind"), F.lit(1.0).alias("belief"))
    known = seeds
    totals = counts.withColumnRenamed("word", "context").withColumnRenamed("n", "occurrences")
    # an inner join: a semi join would be moved below the aggregation and shuffle every word
    totals = settle(totals.join(edges.select("context").distinct(), "context"), "pii-contexts")
    patterns = None
    for _ in range(rounds):
        backed = edges.drop("kind").join(known, "value")
        by_kind = backed.groupBy("context", "kind").agg(
            F.sum(F.col("n") * F.col("belief")).alias("weight"), F.count(F.lit(1)).alias("instances")
        )
        best = by_kind.groupBy("context").agg(
            F.max_by(F.struct("kind", "weight", "instances"), F.struct("weight", "instances", -F.col("kind"))).alias("best")
        )
        patterns = best.join(totals, "context").select(
            "context",
            F.col("best.kind").alias("kind"),
            (F.col("best.weight") / (F.col("occurrences") + DOUBT)).alias("score"),
            F.col("best.instances").alias("instances"),
        )
        patterns = settle(patterns.where(F.col("instances") >= support), "pii-patterns")
        doubt = F.sum(F.col("n") * F.log1p(-F.least(F.col("score"), F.lit(0.999))))
        pointed = edges.drop("kind").join(patterns.drop("instances"), "context").groupBy("value").agg(
            (1 - F.exp(doubt)).alias("belief"), F.max_by("kind", "score").alias("kind")
        )
        fresh = pointed.join(seeds.select("value"), "value", "left_anti").where(F.col("belief") >= least)
        known = settle(seeds.unionByName(fresh.select("value", "kind", "belief")), "pii-instances")
    return patterns.where(F.col("score") >= least).select("context", "kind", "score")


def find_pii(df: DataFrame, keep: dict[str, Column], rounds: int = ROUNDS) -> DataFrame:
    """Columns of `keep`, base, found for each row: the base spans, and identifiers that trusted contexts point to.

    Both are arrays of struct<kind, start, end> (kind: place in KINDS), sorted; positions are code points, ends exclusive.
    `found` never overlaps a base span. Null and empty texts have none; repeated rows each have their own result; an
    empty table gives no rows; a corpus without seeds has no patterns and finds nothing more.
    """
    scanned = settle(scan(df, keep).withColumn("_row", F.monotonically_increasing_id()), "pii")
    cases = scanned.select("_row", F.explode("cases").alias("case")).select("_row", "case.*").where("start < end")
    patterns = trusted_patterns(cases.select("context", "value", "kind"), context_counts(df), rounds)
    patterns = patterns.select(F.col("context").alias("_context"), F.col("kind").alias("_kind"))
    fresh = cases.where("kind IS NULL").join(patterns, F.col("context") == F.col("_context"))
    span = F.struct(F.col("_kind").alias("kind"), "start", "end")
    fresh = fresh.groupBy(F.col("_row").alias("_of")).agg(F.array_sort(F.collect_list(span)).alias("found"))
    none = F.array().cast(f"array<{SPAN}>")
    rows = scanned.join(fresh, F.col("_row") == F.col("_of"), "left")
    return rows.select(*keep, "base", F.coalesce("found", none).alias("found"))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op1_bootstrapped_pii(df: DataFrame) -> DataFrame:
    """Counts, digest and spans of every document; the columns of the contract."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return find_pii(df, {"doc_id": F.col("doc_id")}).select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "found"))).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each of the spans replaced by its kind, e.g. <EMAIL>. Overlapping spans give one mark, that of the
    first; `spans` are sorted by start."""
    names = F.array(*[F.lit(f"<{kind.upper()}>") for kind in KINDS])

    def marked(blocks, placed):
        first = F.filter(placed, lambda s: s["start"] >= s["at"])
        parts = F.transform(first, lambda s: F.concat(part_of(blocks, s["at"], s["start"]), F.get(names, s["kind"])))
        return F.concat(F.array_join(parts, ""), _rest(text, placed))

    many = let(blocks_of(text), lambda blocks: let(_after_others(spans), lambda placed: marked(blocks, placed)))
    return F.when(F.size(spans) > 0, many).otherwise(text)


def masked_documents(df: DataFrame) -> DataFrame:
    """The documents with all found personal data masked; `n_chars` follows where the text changes, all else stays."""
    keep = {f"c{i}": F.col(f"`{name}`") for i, name in enumerate(df.columns)}
    found = find_pii(df, keep)
    by_start = F.array_sort(F.transform(F.concat("base", "found"), lambda s: F.struct(s["start"], s["end"], s["kind"])))
    text = F.col(f"c{df.columns.index('text')}")
    out = found.withColumn("_spans", by_start).withColumn(
        "_masked", F.when(F.size("_spans") > 0, masked(text, F.col("_spans"))).otherwise(text)
    )
    columns = []
    for short, name in zip(keep, df.columns, strict=True):
        if name == "text":
            columns.append(F.col("_masked").alias(name))
        elif name == "n_chars":
            kind = df.schema[name].dataType
            columns.append(F.when(F.size("_spans") > 0, F.length("_masked")).otherwise(F.col(short)).cast(kind).alias(name))
        else:
            columns.append(F.col(short).alias(name))
    return out.select(*columns)
