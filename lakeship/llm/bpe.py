"""Byte-level BPE as a bounded-lookahead streaming transducer, and decoding as a byte-to-text state machine."""

from __future__ import annotations

import codecs
import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeship.llm.common import whole_text

#: The published splitting pattern of byte-level BPE with `use_regex`; a fixed value. Which characters its classes hold depends
#: on the Unicode version, see `classes`.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces up to this many bytes, and runs of pieces between spaces up to this many characters, are remembered with their
#: tokens, up to so many at a time.
SHORT_PIECE, REMEMBERED = 48, 300_000
REMEMBERED_PAIRS = 500_000
#: Characters of a text that are split at a time, and tokens that are handed over and decoded at a time.
CHARACTERS_AT_ONCE, TOKENS_AT_ONCE = 65_536, 65_536
#: Ids that a task hands over at a time, or those of one text.
IDS_AT_ONCE = 1_000_000


def byte_letters() -> dict[int, str]:
    """The public byte-to-letter table of byte-level BPE, by its rule: printable Latin-1 letters stand for themselves, the
    other bytes, in order, for the letters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


def sufficient_lookahead(merges: list[tuple[int, int, int]], length: list[int]) -> int:
    """Bytes after a token's end that can still change it; `merges` are (left, right, result) in order of rank.

    A merge of (u, v) can be undone only by an earlier merge that takes v, (v, w); and that by one still earlier that
    takes w. Ranks fall along such a chain, so one pass in order of rank finds the longest.
    """
    reach = [0] * len(length)  # of a token: how far behind its end the merge that made it could be undone
    taken = [0] * len(length)  # of a token as left part of the merges so far
    most = 0
    for left, right, result in merges:
        reach[result] = max(reach[right], taken[right])
        taken[left] = max(taken[left], length[right] + max(reach[right], reach[result]))
        most = max(most, reach[result])
    return most + max(length, default=0)


@functools.lru_cache(maxsize=1)
def classes() -> dict[str, str]:
    """The characters of \\p{L}, \\p{N} and \\s as ranges of a character class.

    The library's own engine tells them, as other engines follow other versions of Unicode.
    """
    from tokenizers import Regex, pre_tokenizers

    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    out = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        runs = pre_tokenizers.Split(Regex(name + "+"), "removed", invert=True).pre_tokenize_str(every)
        codes = np.frombuffer("".join(run for run, _ in runs).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        starts = np.flatnonzero(np.r_[True, np.diff(codes) != 1])
        ends = np.r_[starts[1:], len(codes)] - 1
        out[name] = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(codes[starts], codes[ends], strict=True))
    return out


def splitting_pattern(of: dict[str, str]) -> str:
    """PATTERN with its classes written out."""
    pattern = PATTERN.replace(r"\S", r"[^\s]").replace(r"\s+", r"[\s]+")
    pattern = pattern.replace(r" ?\p{L}+", r" ?[\p{L}]+").replace(r" ?\p{N}+", r" ?[\p{N}]+")
    for name, ranges in of.items():
        pattern = pattern.replace(name, ranges)
    return pattern


class _Unclean(Exception):
    """White space next to a space or a line end: only the pattern over the whole text can tell how it splits."""


class _Remembered(dict):
    """Packed ids by key, filled by `make`; starts anew when full, so that memory stays bounded."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= SHORT_PIECE:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


class Bpe:
    """Vocabulary and merge list of a byte-level BPE in the public JSON form of tokenizers.

    `of` are the character classes, by default the library's.
    """

    def __init__(self, text: str, of: dict[str, str] | None = None):
        of = of or classes()
        spec = json.loads(text)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or not plain:
            raise ValueError("only byte-level BPE without a prefix space, dropout or unknown token is supported")
        if spec.get("normalizer") or not before.get("use_regex", True):
            raise ValueError("only byte-level BPE without a normalizer and with its splitting pattern is supported")
        byte_of = {letter: b for b, letter in byte_letters().items()}
        to_bytes = lambda token: bytes(byte_of[c] for c in token)
        vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that look at their surroundings are not supported")
        self.bytes_of = {i: to_bytes(token) for token, i in vocabulary.items()}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        self.id_of = {to_bytes(token): i for token, i in vocabulary.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
        self.merge = {(a, b): (rank, c) for rank, (a, b, c) in enumerate(merges)}
        length = [len(self.bytes_of.get(i, b"")) for i in range(max(self.bytes_of) + 1)]
        self.longest = max(map(len, self.id_of))
        self.lookahead = sufficient_lookahead(merges, length)
        self.longest_by_end: dict[bytes, int] = {}
        self.longest_by_start: dict[bytes, int] = {}
        for token in self.id_of:
            for table, part in ((self.longest_by_end, token[-2:]), (self.longest_by_start, token[:2])):
                table[part] = max(table.get(part, 0), len(token))
        self.single = [self.id_of.get(bytes([b])) for b in range(256)]
        self.made = [-1] * len(length)  # rank of the merge that makes a token, and its two parts
        self.parts = [(-1, -1)] * len(length)
        for rank, (a, b, c) in enumerate(merges):
            self.made[c], self.parts[c] = rank, (a, b)
        self.any_splitter = re.compile(splitting_pattern(of))
        # the same for texts of ASCII alone, whose short classes are looked through faster
        ascii_of = {name: "".join(re.escape(chr(c)) for c in range(128) if re.match(f"[{r}]", chr(c))) for name, r in of.items()}
        self.ascii_splitter = re.compile(splitting_pattern(ascii_of))
        self.gap = re.compile(rf"[^{of[r'\s']}][{of[r'\s']}]")
        contents = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, contents))) if contents else None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = _Remembered(self._packed)
        self.after_space = _Remembered(lambda run: self._packed_run(" ", run))
        self.at_start = _Remembered(lambda run: self._packed_run("", run))
        self.line_end = b"".join(i.to_bytes(4, "little") for i in self._short(b"\n"))

    def merged(self, data: bytes) -> list[int]:
        """The tokens of a few bytes by the merge list itself: the pair of the lowest rank first, leftmost among equals."""
        ids = [self.single[b] for b in data]
        merge = self.merge
        while len(ids) > 1:
            best = min(((merge[p][0], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in merge), default=None)
            if best is None:
                break
            i = best[1]
            ids[i : i + 2] = [merge[ids[i], ids[i + 1]][1]]
        return ids

    def _apart(self, left: int, right: int) -> bool:
        """Whether no merge ever crosses the border between two tokens.

        Going back in time from both tokens to their bytes gives each pair that met at the border. Such a pair would
        have merged if its rank came before the merge that took its right part, or, as the leftmost of equals goes
        first, together with it; and before the merge that took its left part.
        """
        merge, made, parts = self.merge, self.made, self.parts
        left_taken = right_taken = len(merge)
        while True:
            met = merge.get((left, right))
            if met is not None and met[0] < left_taken and met[0] <= right_taken:
                return False
            if made[left] > made[right]:
                left_taken, left = made[left], parts[left][1]
            elif made[right] >= 0:
                right_taken, right = made[right], parts[right][0]
            else:
                return True

    def adjacent(self, left: int, right: int) -> bool:
        """Whether two tokens can stand side by side; left -1 asks whether a token can stand alone."""
        if len(self.pairs) >= REMEMBERED_PAIRS:
            self.pairs.clear()
        fits = self._apart(left, right) if left >= 0 else self.merged(self.bytes_of[right]) == [right]
        self.pairs[left, right] = fits
        return fits

    def _short(self, data: bytes) -> list[int]:
        """The transducer of `tokens` for a piece that is there as a whole.

        Longest tokens from the left are tried first: if all neighbours fit, they are the encoding.
        """
        id_of, pairs, n = self.id_of.get, self.pairs.get, len(data)
        out, at, before = [], 0, -1
        while at < n:
            for end in range(min(at + self.longest_by_start.get(data[at : at + 2], 1), n), at, -1):
                token = id_of(data[at:end])
                if token is not None:
                    break
            else:
                raise ValueError("a byte has no token in this vocabulary")
            fits = pairs((before, token))
            if not (fits or fits is None and self.adjacent(before, token)):
                break
            out.append(token)
            before, at = token, end
        else:
            return out
        last, longest_by_end = [-1], self.longest_by_end.get
        for end in range(1, n + 1):
            for start in range(end - 1, max(end - longest_by_end(data[max(end - 2, 0) : end], 1), 0) - 1, -1):
                token = id_of(data[start:end])
                if token is not None:
                    fits = pairs((last[start], token))
                    if fits or fits is None and self.adjacent(last[start], token):
                        last.append(token)
                        break
            else:
                raise ValueError("a byte has no token in this vocabulary")
        return self._path(last, n)

    def tokens(self, data: Iterable[bytes]) -> Iterator[int]:
        """The transducer: reads chunks of one piece, emits its tokens as soon as no later byte can change them.

        A sequence is the encoding of its bytes if and only if each two neighbours are, so the encoding of every prefix
        follows from shorter ones by its last token alone. Tokens that all live prefixes share are stable; the live ones
        are those within a token's length of the read position. Memory: the sufficient lookahead plus one chunk.
        """
        text = bytearray()
        last: list[int] = [-1]  # last token of the encoding of each prefix of `text`
        base = -1  # token before `text`
        id_of, longest_by_end, pairs = self.id_of, self.longest_by_end, self.pairs
        for chunk in data:
            text += chunk
            for i in range(len(last), len(text) + 1):
                end = bytes(text[max(i - 2, 0) : i])
                most = min(i, longest_by_end.get(end, 1) if i > 1 else 1)
                piece = bytes(text[i - most : i])
                for start in range(most - 1, -1, -1):
                    token = id_of.get(piece[start:])
                    if token is None:
                        continue
                    before = last[i - most + start] if i - most + start else base
                    fits = pairs.get((before, token))
                    if self.adjacent(before, token) if fits is None else fits:
                        last.append(token)
                        break
                else:
                    raise ValueError("a byte has no token in this vocabulary")
            if len(text) > self.lookahead:
                stable = self._stable(last)
                if stable:
                    out = self._path(last, stable)
                    yield from out
                    base = out[-1]
                    del text[:stable]
                    last = [-1, *last[stable + 1 :]]
        yield from self._path(last, len(text))

    def _stable(self, last: list[int]) -> int:
        """The furthest prefix that every prefix from which a later token may start goes back to."""
        live = set(range(max(len(last) - self.longest, 0), len(last)))
        while len(live) > 1:
            top = max(live)
            live.discard(top)
            live.add(top - len(self.bytes_of[last[top]]))
        return live.pop()

    def _path(self, last: list[int], end: int) -> list[int]:
        out = []
        while end:
            out.append(last[end])
            end -= len(self.bytes_of[last[end]])
        return out[::-1]

    def splitter(self, text: str) -> re.Pattern:
        return self.ascii_splitter if text.isascii() else self.any_splitter

    def _packed(self, piece: str) -> bytes:
        """A piece's ids as little-endian 32-bit numbers."""
        data = piece.encode("utf-8", "surrogatepass")
        ids = self._short(data) if len(data) <= SHORT_PIECE else self._streamed(piece)
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def _streamed(self, piece: str) -> Iterator[int]:
        """The ids of a long piece; its bytes go through the transducer in chunks."""
        step = max(self.lookahead, 1024)
        return self.tokens(piece[at : at + step].encode("utf-8", "surrogatepass") for at in range(0, len(piece), step))

    def _packed_run(self, before: str, run: str) -> bytes:
        """The ids of what lies between two spaces or line ends. A space goes to the piece after it, so the pieces of
        such a run do not depend on its neighbours, unless white space touches white space."""
        if not run or run[0].isspace() or run[-1].isspace():
            raise _Unclean
        return b"".join(map(self.pieces.__getitem__, self.splitter(run).findall(before + run)))

    def _encode_part(self, text: str) -> bytes:
        out = []
        try:
            for line in text.split("\n"):
                first, *others = line.split(" ")
                out.append(self.line_end)
                out.append(self.at_start[first])
                out.extend(map(self.after_space.__getitem__, others))
            return b"".join(out[1:])
        except _Unclean:
            return b"".join(map(self.pieces.__getitem__, self.splitter(text).findall(text)))

    def _parts(self, text: str, at: int, end: int) -> Iterator[bytes]:
        """The packed ids of text[at:end], which holds no added token, part by part.

        No piece has a character and then white space, so a cut between two such changes nothing. What has no such place
        is taken piece by piece, and a long piece chunk by chunk.
        """
        while at < end:
            cut = end
            if end - at > 2 * CHARACTERS_AT_ONCE:
                gap = self.gap.search(text, at + CHARACTERS_AT_ONCE - 1, end)
                cut = gap.start() + 1 if gap else end
            if cut - at <= 2 * CHARACTERS_AT_ONCE:
                yield self._encode_part(text[at:cut] if cut - at < len(text) else text)
            else:
                for piece in self.splitter(text).finditer(text, at, cut):
                    ids = self._streamed(piece.group())
                    while some := list(itertools.islice(ids, TOKENS_AT_ONCE)):
                        yield np.array(some, dtype="<u4").tobytes()
            at = cut

    def encode_parts(self, text: str) -> Iterator[bytes]:
        """All ids of a text, packed, in parts; added tokens in the text are recognised first."""
        at = 0
        for found in self.specials.finditer(text) if self.specials else ():
            yield from self._parts(text, at, found.start())
            yield self.special[found.group()].to_bytes(4, "little")
            at = found.end()
        yield from self._parts(text, at, len(text))

    def encode(self, text: str) -> bytes:
        """All ids of a text, packed."""
        return b"".join(self.encode_parts(text))


class Decoder:
    """Ids to text, token by token: at most three bytes wait for the rest of their character; what is no UTF-8 becomes
    U+FFFD, one for each maximal broken part."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


@functools.lru_cache(maxsize=2)
def loaded(text: str, of: tuple[tuple[str, str], ...] = ()) -> Bpe:
    """One model a process."""
    return Bpe(text, dict(of))


def ids_of(packed: bytes) -> memoryview:
    return memoryview(packed).cast("I")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(df: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Each row's ids and what they decode to: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    `path` names the tokenizer's JSON file on the driver, from where it goes to the tasks, as do the character classes. No
    shuffle; a row's result depends on its text alone. Without ids, a text's tokens go to the digest and the decoder part by
    part, and are never held together. Null and empty texts have no ids. Repeated rows give equal results.
    """
    with open(path or tokenizer_path(), encoding="utf-8") as file:
        spec = file.read()
    of = tuple(classes().items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(spec, of)
        for batch in batches:
            doc_ids, n_tokens, of_ids, of_text, ids = [], [], [], [], []

            def made() -> pa.RecordBatch:
                columns = [pa.array(doc_ids, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(of_ids, pa.string())]
                columns.append(pa.array(of_text, pa.string()))
                if with_ids:
                    offsets = np.r_[0, np.cumsum(n_tokens, dtype=np.int64)].astype(np.int32)
                    values = np.frombuffer(b"".join(ids), dtype="<i4")
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
                return pa.RecordBatch.from_arrays(columns, names)

            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                digest, back, decoder, n = hashlib.sha256(), hashlib.sha256(), Decoder(bpe.bytes_of), 0
                for packed in bpe.encode_parts(text.as_py()):
                    n += len(packed) // 4
                    digest.update(packed)
                    back.update(decoder.push(ids_of(packed)).encode("utf-8"))
                    if with_ids:
                        ids.append(packed)
                back.update(decoder.finish().encode("utf-8"))
                doc_ids.append(doc_id.as_py())
                n_tokens.append(n)
                of_ids.append(digest.hexdigest())
                of_text.append(back.hexdigest())
                if with_ids and sum(n_tokens) >= IDS_AT_ONCE:  # ids leave in parts, and never become Python numbers
                    yield made()
                    doc_ids, n_tokens, of_ids, of_text, ids = [], [], [], [], []
            if doc_ids:
                yield made()

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, schema)


def op2_streaming_bpe(df: DataFrame) -> DataFrame:
    """Ids of every whole text, and the text that they decode to, as digests."""
    return encode_documents(df, with_ids=False)
