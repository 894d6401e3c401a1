"""Secret scan: fixed forms, and values in credential contexts that are costly to guess."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeship.llm.common import settle, whole_text

KINDS = ("assign", "access", "hex", "guess")
_VALUE = r"[\"'`]?([^\s\"'`<>]{6,})"
#: Contexts whose value the guess cost judges: a credential's name, perhaps a remark in brackets, a sign or `is` (after
#: `bearer` a space will do), and the value; a value after an authentication scheme is judged too. A match ends before
#: the values, so that none of them hides the next context.
CONTEXT = re.compile(
    r"(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|bearer|auth(?:orization)?|"
    r"(?:api|access|private|client|secret)[_\x20-]?(?:key|secret|token))[\"'`]?"
    r"(?:\x20*(?:\([^()\r\n]*\)|\[[^\[\]\r\n]*\])[\"'`]?)?"
    r"(?:\x20*(?:[:=]+>?|->)\x20*|\x20+(?:is|was)\x20+:?\x20*|(?<=bearer)\x20+)"
    rf"(?:(?={_VALUE}))?(?:(?=[\"'`]?(?:bearer|basic|token|digest|api-?key|oauth|negotiate|ntlm|dpop)\x20+{_VALUE}))?",
    re.I | re.A,
)
#: A name and its sign take no more, from where a value that they end may be looked at again.
LONGEST_NAME = 40
_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

#: Guesses, as a power of two, from which on a value counts as a secret.
LEAST_BITS = 40.0
#: `guess_bits` bounds repeats and walks by this where it is called without `longest`; the scan does not.
LONGEST_SEGMENT = 40
SHORTEST_WORD, LONGEST_WORD = 3, 20
#: Rows of a keyboard; neighbours in a row, either way, are steps of a walk. Fixed values.
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
_STEPS = {pair for row in KEY_ROWS for a, b in zip(row, row[1:], strict=False) for pair in (a + b, b + a)}
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
                   r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d")  # fmt: skip
_LETTERS = re.compile(r"[^\W\d_]+")


def base_matches(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, sorted. Matches that fail are dropped without another try."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def context_values(text: str) -> list[tuple[int, str]]:
    """(start, value) of the values in credential contexts, sorted.

    The next context may begin within a value if its own value lies behind it, as in `auth: Bearer ...`. A name and value
    that both lie in a value are judged as part of it, so a run of characters is read a few times at most.
    """
    found, at, covered = [], 0, 0
    while m := CONTEXT.search(text, at):
        at = max(m.end(), m.end(1) - LONGEST_NAME)
        for group in (1, 2):
            value = (m[group] or "").rstrip(".,;:!?)]}")
            if m.start(group) >= covered and len(value) >= 6:
                found.append((m.start(group), value))
            covered = max(covered, m.end(group))
    return found


def words_in(value: str) -> set[str]:
    """All runs of letters, in lower case, of the lengths that count as words, within a value's runs of letters."""
    out = set()
    for run in _LETTERS.findall(value.lower()):
        for start in range(len(run) - SHORTEST_WORD + 1):
            out.update(run[start:end] for end in range(start + SHORTEST_WORD, min(len(run), start + LONGEST_WORD) + 1))
    return out


def _brute_bits(value: str) -> float:
    """Bits a character for trying all characters of the kinds that the value has."""
    if re.fullmatch("[0-9a-f]*", value) or re.fullmatch("[0-9A-F]*", value):
        return 4.0
    size = 10 * bool(re.search("[0-9]", value)) + 26 * bool(re.search("[a-z]", value))
    size += 26 * bool(re.search("[A-Z]", value)) + 33 * bool(re.search("[^A-Za-z0-9]", value))
    return math.log2(max(size, 2))


def _case_bits(part: str) -> float:
    """Upper case costs one bit if it is the usual kind (first or all letters), else one a letter that changes case."""
    if part.islower() or not any(map(str.isupper, part)):
        return 0.0
    return 1.0 if part.isupper() or part[1:].islower() else 1.0 + sum(map(str.isupper, part))


class _Starts:
    """Starts of segments in one run (of a unit, or of a walk), to find the least cost of a segment that ends somewhere.

    A segment of n units from start s costs what lies ahead, plus log2(n). A start is left out if an earlier one is
    never dearer: log2 grows slowest far out, so it is enough to compare at the first end that the later one has. Starts
    are added at that end, so all of them stay valid until the run breaks.
    """

    def __init__(self, unit: int, fewest: int, longest: int | None):
        self.unit, self.fewest, self.longest, self.starts = unit, fewest, longest, []

    def add(self, start: int, cost: float) -> None:
        first = start + self.fewest * self.unit
        bits = cost + math.log2(self.fewest)
        if self.longest or all(bits < c + math.log2((first - s) // self.unit) for s, c in self.starts):
            self.starts.append((start, cost))

    def least(self, end: int) -> float:
        return min(
            (c + math.log2((end - s) // self.unit) for s, c in self.starts if not self.longest or end - s <= self.longest),
            default=math.inf,
        )


def guess_bits(
    value: str, word_bits: dict[str, float], longest: int | None = LONGEST_SEGMENT, enough: float = math.inf
) -> float:
    """Least log2 of guesses over all segmentations of a value, by dynamic programming over its prefixes.

    A segment is a word (of the corpus, by its frequency), a date, a repeat of a unit, a walk over neighbouring keys, or
    brute force; each further segment costs a bit. Repeats and walks are at most `longest` long; None: any length.
    Exact below `enough`; any value that costs more gives some number from there on, as prefixes that cost so much are
    not continued. Linear in the value's length if `enough` or `longest` is set.
    """
    lower, each, n = value.lower(), _brute_bits(value), len(value)
    if len(lower) != n:  # a few capitals have longer small letters; they stay as they are
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    widest = int(min(n // 2, longest // 2 if longest else n, enough / each))
    repeats = [[_Starts(unit, max(2, 4 - unit), longest) for _ in range(unit)] for unit in range(1, widest + 1)]
    run = [0] * (widest + 1)  # where the run of each unit starts
    walk, walk_from = _Starts(1, 3, longest), 0
    turns = [0] * (n + 2)  # how many turns lie before each place
    best = [0.0] + [math.inf] * n
    reach = max(LONGEST_WORD, 10, 2 * widest + 1)
    alive, open_runs = 0, 0
    ahead = lambda start: best[start] + (1.0 if start else 0.0)
    for end in range(1, n + 1):
        turns[end] = turns[end - 1] + (end > 2 and lower[end - 1] == lower[end - 3])
        cost = best[end - 1] + each
        for start in range(max(end - LONGEST_WORD, 0), end - 2):
            if (before := ahead(start)) >= min(cost, enough):
                continue
            part, size = lower[start:end], end - start
            if part in word_bits:
                cost = min(cost, before + word_bits[part] + _case_bits(value[start:end]))
            if 4 <= size <= 10 and _DATE.fullmatch(part):
                cost = min(cost, before + (math.log2(366 * 100) if size >= 6 else math.log2(200)))
        open_runs = 0
        for unit in range(1, widest + 1):
            if end > unit and lower[end - 1] != lower[end - 1 - unit]:
                if run[unit] < end - unit:
                    run[unit] = end - unit
                for starts in repeats[unit - 1]:
                    starts.starts.clear()
                continue
            starts = repeats[unit - 1][end % unit]
            start = end - starts.fewest * unit
            if start >= run[unit] and ahead(start) < enough:
                starts.add(start, ahead(start))
            if starts.starts:
                cost = min(cost, unit * each + starts.least(end) + 1)
            open_runs += any(s.starts for s in repeats[unit - 1])
        if end > 1 and lower[end - 2 : end] not in _STEPS:
            walk_from = end - 1
            walk.starts.clear()
        elif end - 3 >= walk_from and ahead(end - 3) < enough:
            walk.add(end - 3, ahead(end - 3) - 2 * turns[end - 1])
        if walk.starts:
            cost = min(cost, math.log2(36) + walk.least(end) + 1 + 2 * turns[end])
            open_runs += 1
        best[end] = cost
        if cost < enough:
            alive = end
        elif not open_runs and end - alive > reach:
            return cost
    return best[-1]


SCANNED = "doc_id long, base array<struct<start:int,kind:int,end:int>>, cases array<struct<start:int,end:int,value:string>>"


def scan(df: DataFrame) -> DataFrame:
    """Fixed forms and values in credential contexts of each row, as SCANNED. One pass over the texts."""
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    case = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, cases = [], []
            for text in batch.column(1):
                text = text.as_py()
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in base_matches(text)])
                cases.append([{"start": s, "end": s + len(v), "value": v} for s, v in context_values(text)])
            columns = [batch.column(0), pa.array(base, pa.list_(span)), pa.array(cases, pa.list_(case))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "cases"])

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, SCANNED)


def corpus_words(df: DataFrame) -> DataFrame:
    """(word, n): how often each run of letters, in lower case, stands in all texts; counted before the shuffle."""
    words = df.select(F.explode(F.split(F.lower(whole_text()), r"[^\p{L}]+")).alias("word"))
    words = words.where(F.length("word").between(SHORTEST_WORD, LONGEST_WORD))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def value_bits(values: DataFrame, words: DataFrame, enough: float = math.inf) -> DataFrame:
    """(value, bits) for distinct values, with word costs -log2 of their share among all counted words; see guess_bits.

    What a value needs of the corpus is found by a join with its own runs of letters, so no dictionary goes to tasks whole.
    """
    @F.pandas_udf("array<string>")
    def runs(values_: pd.Series) -> pd.Series:
        return values_.map(lambda value: sorted(words_in(value)))

    needed = values.select("value", F.explode(runs("value")).alias("word"))
    total = words.agg(F.sum("n")).first()[0] or 1
    known = needed.join(words, "word").groupBy("value").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for value, found in zip(batch.column(0), batch.column(1), strict=True):
                costs = {w["word"]: math.log2(total / w["n"]) + 1 for w in found.as_py() or []}
                bits.append(guess_bits(value.as_py(), costs, None, enough))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.float64())], ["value", "bits"])

    every = values.join(known.withColumnRenamed("value", "_value"), F.col("value") == F.col("_value"), "left")
    return every.select("value", "known").mapInArrow(judge, "value string, bits double")


def find_secrets(df: DataFrame, least_bits: float = LEAST_BITS) -> DataFrame:
    """doc_id, base, found for each row: the fixed forms, and the other values that cost `least_bits` or more.

    Both are arrays of struct<start, kind, end> (kind: place in KINDS), sorted; positions are code points. `found` has the
    values that no base span holds. Null and empty texts have none; repeated rows each have their own; the word costs
    count all texts given. A value that very many rows share is judged once.
    """
    scanned = scan(df).withColumn("_row", F.monotonically_increasing_id())
    scanned = settle(scanned, "secrets")
    cases = scanned.select("_row", "base", F.explode("cases").alias("case")).select("_row", "base", "case.*")
    cases = cases.where(~F.exists("base", lambda b: (b["start"] <= F.col("start")) & (b["end"] >= F.col("end"))))
    words = settle(corpus_words(df), "words")
    judged = settle(value_bits(cases.select("value").distinct(), words, least_bits), "guesses").where(F.col("bits") >= least_bits)
    judged = judged.select(F.col("value").alias("_value"))
    costly = cases.join(judged, F.col("value") == F.col("_value"))
    span = F.struct("start", F.lit(KINDS.index("guess")).alias("kind"), "end")
    costly = costly.groupBy(F.col("_row").alias("_of")).agg(F.array_sort(F.collect_list(span)).alias("found"))
    rows = scanned.join(costly, F.col("_row") == F.col("_of"), "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.select("doc_id", "base", F.coalesce("found", none).alias("found"))


def _written(spans):
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(text, ",")


def op10_guess_cost_secrets(df: DataFrame) -> DataFrame:
    """Counts, digest and spans of every document; the columns of the contract."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return find_secrets(df).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "found"))).alias("spans"),
    )
