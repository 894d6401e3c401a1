"""Code that runs inside Spark tasks: moving bytes, ZIP parts, bitmap blobs.

Every function takes and yields pandas batches of file names; file bodies are
streamed in blocks and never become rows. A retried or speculative attempt is
harmless: bytes go to a hidden name first and are moved into place when whole.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from decimal import Decimal
from itertools import groupby

import numpy as np
import pandas as pd

from lakeship.functions.paths import Z85_ALPHABET

BLOCK = 8 << 20
ZIP_EPOCH = (1980, 1, 1, 0, 0, 0)
OBJECT_STORES = ("s3", "gcs", "abfs")

# Fixed values of the public deletion-vector and Roaring bitmap formats.
DV_MAGIC = 1681511377
ROARING_NO_RUNS = 12346
ROARING_WITH_RUNS = 12347
ROARING_NO_OFFSET_LIMIT = 4
ARRAY_CONTAINER_MAX = 4096


def open_fs(uri, options):
    """(filesystem, path) for a plain, unescaped URI."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme == "file" or uri.startswith("/"):
        return fs.LocalFileSystem(), "/" + (rest if scheme == "file" else uri).lstrip("/")
    authority, _, key = rest.lstrip("/").partition("/")
    if scheme in ("s3", "s3a", "s3n"):
        settings = {}
        if options.get("access_key"):
            settings.update(access_key=options["access_key"], secret_key=options.get("secret_key"))
        if options.get("endpoint"):
            settings["endpoint_override"] = options["endpoint"]
            settings["force_virtual_addressing"] = options.get("path_style", "false") != "true"
        return fs.S3FileSystem(**settings), f"{authority}/{key}"
    if scheme == "hdfs":
        host, _, port = authority.partition(":")
        return fs.HadoopFileSystem(host or "default", int(port or 0)), "/" + key
    filesystem, base = fs.FileSystem.from_uri(f"{scheme}://{authority}")
    return filesystem, f"{base.rstrip('/')}/{key}"


def stream_copy(source, target):
    """Copy block by block; returns (bytes, crc32)."""
    size = crc = 0
    while block := source.read(BLOCK):
        target.write(block)
        crc = zlib.crc32(block, crc)
        size += len(block)
    return size, crc


def file_crc(filesystem, path):
    class Sink:
        def write(self, block):
            pass

    with filesystem.open_input_stream(path) as source:
        return stream_copy(source, Sink())[1]


def put(filesystem, path, fill):
    """Create `path` whole or not at all; `fill(stream)` writes the body."""
    if filesystem.type_name in OBJECT_STORES:
        with filesystem.open_output_stream(path) as target:
            return fill(target)
    parent, _, name = path.rpartition("/")
    filesystem.create_dir(parent, recursive=True)
    hidden = f"{parent}/.{name}.{uuid.uuid4().hex}.tmp"
    try:
        with filesystem.open_output_stream(hidden) as target:
            result = fill(target)
        filesystem.move(hidden, path)
    except BaseException:
        if is_file(filesystem, hidden):
            filesystem.delete_file(hidden)
        raise
    if filesystem.type_name == "local" and is_file(filesystem, f"{parent}/.{name}.crc"):
        filesystem.delete_file(f"{parent}/.{name}.crc")
    return result


def is_file(filesystem, path):
    from pyarrow import fs

    return filesystem.get_file_info(path).type == fs.FileType.File


class Sources:
    """Opens plain files and ZIP entries; keeps the archives of one task open."""

    def __init__(self, options):
        self.options = options
        self.archives = {}

    def open(self, source, entry):
        if entry is None:
            filesystem, path = open_fs(source, self.options)
            return filesystem.open_input_stream(path)
        if source not in self.archives:
            filesystem, path = open_fs(source, self.options)
            self.archives[source] = zipfile.ZipFile(filesystem.open_input_file(path))
        return self.archives[source].open(entry)

    def open_at(self, source, entry, at):
        """As `open`, from byte `at` on; for plain files and ZIP entries that are stored as they are."""
        if entry is None:
            filesystem, path = open_fs(source, self.options)
            stream = filesystem.open_input_file(path)
        else:
            stream = self.open(source, entry)
        stream.seek(at)
        return stream


def text_or_none(value):
    return value if isinstance(value, str) else None


def probe_files(batches, options):
    """Adds `found_size` (NULL where the file is absent) to rows with `source`."""
    from pyarrow import fs

    for batch in batches:
        sizes = []
        for _, names in groupby(batch["source"], key=lambda uri: uri.split("/", 3)[:3] if "://" in uri else ""):
            opened = [open_fs(name, options) for name in names]
            infos = opened[0][0].get_file_info([path for _, path in opened])
            sizes += [info.size if info.type == fs.FileType.File else None for info in infos]
        yield batch.assign(found_size=pd.array(sizes, dtype="Int64"))


#: Entries of one directory that one task looks up; a larger one is divided among DIVIDED tasks, again and again.
ENTRIES_PER_TASK, DIVIDED = 20_000, 16


def list_directories(batches, options):
    """Files and directories directly below each directory in `source`, or of its `share` of `shares` by names' CRCs.

    A share with more than ENTRIES_PER_TASK entries is not listed: it gives rows that name its parts, for other tasks. On a
    local disk names are read one by one, so no directory is ever held whole; other stores hand over whole listings.
    """
    columns = ["source", "size", "modified", "is_directory", "share", "shares"]
    for batch in batches:
        for row in batch.itertuples(index=False):
            shares = 1 if pd.isna(row.shares) else int(row.shares)
            share = 0 if shares == 1 else int(row.share)
            rows = []
            for name, size, modified, directory in directory_entries(*open_fs(row.source, options), share, shares):
                rows.append((f"{row.source}/{name}", size, modified, directory, None, None))
                if len(rows) > ENTRIES_PER_TASK:
                    rows = [(row.source, None, None, False, share + shares * i, shares * DIVIDED) for i in range(DIVIDED)]
                    break
            for at in range(0, len(rows), 10_000):
                found = pd.DataFrame(rows[at : at + 10_000], columns=columns)
                found["modified"] = pd.to_datetime(found["modified"].astype("Int64"), unit="us", utc=True)
                yield found.astype({"size": "Int64", "share": "Int32", "shares": "Int32"})


def directory_entries(filesystem, path, share, shares):
    """(name, size, time in microseconds, is a directory) of a directory's entries that fall into a share."""
    from pyarrow import fs

    if filesystem.type_name != "local":
        for info in filesystem.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if zlib.crc32(info.base_name.encode()) % shares == share:
                yield info.base_name, info.size, info.mtime_ns // 1000, info.type == fs.FileType.Directory
        return
    try:
        entries = os.scandir(path)
    except (FileNotFoundError, NotADirectoryError):
        return
    with entries:
        for entry in entries:
            if zlib.crc32(os.fsencode(entry.name)) % shares != share:
                continue
            try:
                status = entry.stat()
            except FileNotFoundError:  # gone meanwhile, or a link to nowhere
                continue
            yield entry.name, None if entry.is_dir() else status.st_size, status.st_mtime_ns // 1000, entry.is_dir()


def copy_files(batches, root, options, ledger=None, replaced=()):
    """Copy each row's file or ZIP entry to `root/path`; reports what happened.

    status: copied | present (same bytes were there) | missing | conflict. Files of the kinds in `replaced` are written
    anew. What has been copied is noted in the folder `ledger` while the task goes on, also when it fails.
    """
    sources = Sources(options)
    notes = Notes(ledger, options)
    try:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                entry = text_or_none(row.entry)
                filesystem, path = open_fs(f"{root}/{row.path}", options)
                try:
                    stream = sources.open(row.source, entry)
                except FileNotFoundError:
                    rows.append((row.path, row.kind, 0, None, "missing"))
                    continue
                status = "copied"
                with stream:
                    if row.kind not in replaced and is_file(filesystem, path):
                        crc, size = file_crc(filesystem, path), filesystem.get_file_info(path).size
                        status = "present" if (size, crc) == fingerprint(sources, row.source, entry) else "conflict"
                    else:
                        size, crc = put(filesystem, path, lambda out: stream_copy(stream, out))
                rows.append((row.path, row.kind, size, crc, status))
                if status != "conflict":
                    notes.add(row, size, crc)
            yield pd.DataFrame(rows, columns=["path", "kind", "size", "crc", "status"])
    finally:
        notes.write()


def copy_ranges(batches, root, hidden, options):
    """Bring range `at`, `length` of each row's file or ZIP entry to its place in a file of the folder `hidden`.

    state: copied | present (`root/path` is there, with these bytes) | conflict | missing. `crc` is that of the range. What is
    at `root/path` is compared and not touched.
    """
    sources = Sources(options)
    for batch in batches:
        rows = []
        for row in batch.itertuples(index=False):
            entry, state, crc = text_or_none(row.entry), "copied", None
            there, path = open_fs(f"{root}/{row.path}", options)
            try:
                stream = sources.open_at(row.source, entry, row.at)
            except FileNotFoundError:
                state = "missing"
            else:
                with stream:
                    if is_file(there, path):
                        same_size = there.get_file_info(path).size == row.found_size
                        crc = range_crc(stream, row.length)
                        with there.open_input_file(path) as present:
                            present.seek(row.at if same_size else 0)
                            same = same_size and range_crc(present, row.length) == crc
                        state = "present" if same else "conflict"
                    else:
                        with open_sized(hidden_name(hidden, row.path, options), row.found_size) as target:
                            target.seek(row.at)
                            crc = range_crc(stream, row.length, target)
            rows.append((row.path, row.kind, row.found_size, row.stamp, entry is not None, row.at, row.length, crc, state))
        columns = ["path", "kind", "size", "stamp", "is_entry", "at", "length", "crc", "state"]
        yield pd.DataFrame(rows, columns=columns).astype({"stamp": "Int64", "crc": "Int64"})


def finish_ranges(batches, root, hidden, options, ledger):
    """Show the files of which all ranges have arrived, with the checksum joined from theirs; the report of `copy_files`."""
    notes = Notes(ledger, options)
    try:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                states, crc = set(row.states), 0
                status = next(s for s in ("missing", "conflict", "copied", "present") if s in states)
                if status in ("copied", "present"):
                    for piece, length in zip(row.crcs, row.lengths, strict=True):
                        crc = joined_crc(crc, int(piece), int(length))
                    if row.is_entry and crc != row.stamp:
                        raise zipfile.BadZipFile(f"Bad CRC-32 for file {row.path!r}")
                if status == "copied":
                    filesystem, new = open_fs(f"{root}/{row.path}", options)
                    old = hidden_name(hidden, row.path, options)
                    if is_file(filesystem, old):
                        filesystem.create_dir(new.rpartition("/")[0], recursive=True)
                        if not move_if_absent(filesystem, old, new):
                            status = "present" if file_crc(filesystem, new) == crc else "conflict"
                    elif not is_file(filesystem, new):  # an earlier attempt of this task would have moved it
                        raise FileNotFoundError(f"the ranges of {row.path} are gone")
                rows.append((row.path, row.kind, row.size if status != "missing" else 0, crc, status))
                if status in ("copied", "present"):
                    notes.add(row, int(row.size), crc)
            yield pd.DataFrame(rows, columns=["path", "kind", "size", "crc", "status"])
    finally:
        notes.write()


def hidden_name(hidden, path, options):
    return open_fs(f"{hidden}/{hashlib.md5(path.encode()).hexdigest()}", options)[1]


def open_sized(path, size):
    """A local file of `size` bytes to write into; tasks that open it at once keep each other's bytes."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    descriptor = os.open(path, os.O_RDWR | os.O_CREAT, 0o644)
    os.ftruncate(descriptor, size)
    return open(descriptor, "r+b")


def range_crc(stream, length, target=None):
    """CRC of the next `length` bytes, which also go to `target`."""
    crc, left = 0, length
    while left:
        block = stream.read(min(BLOCK, left))
        if not block:
            raise EOFError(f"{left} bytes are missing at the end of a range")
        if target is not None:
            target.write(block)
        crc, left = zlib.crc32(block, crc), left - len(block)
    return crc


#: Fixed value of the public CRC-32: its polynomial, lowest power in the highest bit.
CRC_POLYNOMIAL = 0xEDB88320


def joined_crc(head, tail, length):
    """CRC-32 of two pieces one after the other, the second of `length` bytes, from the CRCs of both.

    Each byte that follows multiplies what stands before it by x^8 modulo the polynomial.
    """

    def product(a, b):
        total = 0
        for power in range(31, -1, -1):
            if a >> power & 1:
                total ^= b
            b = b >> 1 ^ (CRC_POLYNOMIAL if b & 1 else 0)
        return total

    square = 1 << 23  # x^8
    while length:
        if length & 1:
            head = product(square, head)
        square, length = product(square, square), length >> 1
    return head ^ tail


class Notes:
    """Files that one task has brought to the target, written down as JSON lines in whole small files."""

    FILES, BYTES = 500, 1 << 30

    def __init__(self, ledger, options):
        self.ledger, self.options, self.lines, self.size = ledger, options, [], 0

    def add(self, row, size, crc):
        if self.ledger is None:
            return
        stamp = None if pd.isna(row.stamp) else int(row.stamp)
        self.lines.append(json.dumps({"path": row.path, "kind": row.kind, "size": size, "crc": crc, "stamp": stamp}))
        self.size += size
        if len(self.lines) >= self.FILES or self.size >= self.BYTES:
            self.write()

    def write(self):
        if self.lines:
            filesystem, path = open_fs(f"{self.ledger}/{uuid.uuid4().hex}.json", self.options)
            body = "\n".join(self.lines).encode() + b"\n"
            put(filesystem, path, lambda out: out.write(body))
            self.lines, self.size = [], 0


def place_files(batches, source, target, options):
    """Move `source/name` to `target/name` where nothing is there yet.

    status: moved | present (the same bytes are there) | conflict. A name whose source is gone and whose target is there was
    moved by an earlier attempt of this task.
    """
    for batch in batches:
        rows = []
        for name in batch["name"]:
            filesystem, old = open_fs(f"{source}/{name}", options)
            _, new = open_fs(f"{target}/{name}", options)
            if not is_file(filesystem, old):
                status = "moved" if is_file(filesystem, new) else "missing"
            elif move_if_absent(filesystem, old, new):
                status = "moved"
            else:
                status = "present" if file_crc(filesystem, old) == file_crc(filesystem, new) else "conflict"
            rows.append((name, status))
        yield pd.DataFrame(rows, columns=["name", "status"])


def move_if_absent(filesystem, old, new):
    """Whether `old` became `new`; on a local disk and on HDFS no file is ever replaced, also by two tasks at once."""
    if filesystem.type_name == "local":
        try:
            os.link(old, new)
        except FileExistsError:
            return False
        os.remove(old)
        folder, _, name = new.rpartition("/")
        if is_file(filesystem, f"{folder}/.{name}.crc"):  # of a file that was there before
            filesystem.delete_file(f"{folder}/.{name}.crc")
        return True
    if is_file(filesystem, new):
        return False
    filesystem.move(old, new)
    return True


def fingerprint(sources, source, entry):
    if entry is not None:
        info = sources.archives[source].getinfo(entry)
        return info.file_size, info.CRC
    filesystem, path = open_fs(source, sources.options)
    return filesystem.get_file_info(path).size, file_crc(filesystem, path)


#: Longer strings give no upper bound, and only their beginning as the lower one.
STATS_CHARS = 64


def footer_stats(batches, columns, options):
    """Adds `stats` to rows with `source`: what a file's Parquet footer says, in the public format of the log."""
    from pyarrow import parquet

    for batch in batches:
        found = []
        for source in batch["source"]:
            filesystem, path = open_fs(source, options)
            with parquet.ParquetFile(filesystem.open_input_file(path)) as file:
                found.append(stats_text(*stats_of_footer(file.metadata, columns)))
        yield batch.assign(stats=found)


def stats_of_footer(footer, columns):
    """(rows, least values, greatest values, numbers of nulls); a column is left out where its value is unknown."""
    place = {footer.schema.column(i).path: i for i in range(footer.num_columns)}
    least, most, nulls = {}, {}, {}
    for name in columns:
        if name not in place:  # the column was not written: all its values are null
            nulls[name] = footer.num_rows
            continue
        groups = [footer.row_group(g).column(place[name]).statistics for g in range(footer.num_row_groups)]
        if any(s is None or not s.has_null_count for s in groups):
            continue
        nulls[name] = sum(s.null_count for s in groups)
        filled = [s for s in groups if s.num_values]
        if not filled or not all(s.has_min_max for s in filled):
            continue
        try:
            low, high = min(s.min for s in filled), max(s.max for s in filled)
        except NotImplementedError:  # a type that the footer's reader does not decode
            continue
        if isinstance(low, bytes):
            continue
        least[name] = low[:STATS_CHARS] if isinstance(low, str) else low
        if not isinstance(high, str) or len(high) <= STATS_CHARS:
            most[name] = high
    return footer.num_rows, least, most, nulls


def stats_text(rows, least, most, nulls):
    """Statistics as the log keeps them: numbers as numbers, everything else as text."""

    def one(value):
        return str(value) if isinstance(value, (int, Decimal)) else json.dumps(str(value), ensure_ascii=False)

    def all_of(values):
        return "{" + ",".join(f"{json.dumps(name)}:{one(value)}" for name, value in values.items()) + "}"

    return f'{{"numRecords":{rows},"minValues":{all_of(least)},"maxValues":{all_of(most)},"nullCount":{all_of(nulls)}}}'


def each_row(batches):
    return (row for batch in batches for row in batch.itertuples(index=False))


def write_parts(batches, bundle, options, closing=None):
    """Stream the files of each part, sorted by part, into `bundle/part-N.zip`.

    With `closing` (the metadata text) the one part is the bundle itself and
    ends with that text; it is not made at all if a live file is missing.
    """
    sources = Sources(options)
    for part, rows in groupby(each_row(batches), key=lambda row: int(row.part)):
        name = bundle if closing else f"{bundle}/part-{part:06d}.zip"
        filesystem, path = open_fs(name, options)

        def fill(target, part=part, rows=rows):
            with zipfile.ZipFile(target, "w", allowZip64=True) as archive:
                done = [(part, *add_entry(archive, sources, row)) for row in rows]
                if closing:
                    if any(live and status == "missing" for *_, live, _, _, status in done):
                        raise Incomplete(done)
                    archive.writestr(zipfile.ZipInfo("metadata.json", ZIP_EPOCH), closing)
            return done

        try:
            done = put(filesystem, path, fill)
        except Incomplete as stop:
            (done,) = stop.args
        yield pd.DataFrame(done, columns=["part", "path", "kind", "live", "size", "crc", "status"])


class Incomplete(Exception):
    """A live file is missing, so the archive must not appear."""


def write_texts(batches, root, options):
    """Rows (path, value) sorted by path: one UTF-8 text file per path, a row a line."""
    for name, rows in groupby(each_row(batches), key=lambda row: row.path):
        filesystem, path = open_fs(f"{root}/{name}", options)

        def fill(target, rows=rows):
            size = lines = 0
            for row in rows:
                line = row.value.encode("utf-8") + b"\n"
                target.write(line)
                size, lines = size + len(line), lines + 1
            return size, lines

        size, lines = put(filesystem, path, fill)
        yield pd.DataFrame({"path": [name], "size": [size], "lines": [lines]})


def add_entry(archive, sources, row):
    info = zipfile.ZipInfo(row.path, ZIP_EPOCH)
    packed = row.path.endswith((".parquet", ".bin"))
    info.compress_type = zipfile.ZIP_STORED if packed else zipfile.ZIP_DEFLATED
    try:
        stream = sources.open(row.source, None)
    except FileNotFoundError:
        return row.path, row.kind, bool(row.live), 0, None, "missing"
    with stream, archive.open(info, "w", force_zip64=True) as target:
        size, crc = stream_copy(stream, target)
    return row.path, row.kind, bool(row.live), size, crc, "copied"


def list_archives(batches, options):
    """One row per entry of each archive in `source`, from its central directory."""
    for batch in batches:
        for source in batch["source"]:
            filesystem, path = open_fs(source, options)
            with zipfile.ZipFile(filesystem.open_input_file(path)) as archive:
                infos = archive.infolist()
            for at in range(0, len(infos), 10_000):
                yield pd.DataFrame(
                    [
                        (source, i.filename, i.file_size, i.CRC, i.compress_type == zipfile.ZIP_STORED)
                        for i in infos[at : at + 10_000]
                    ],
                    columns=["source", "entry", "size", "crc", "seekable"],
                )


def read_entries(batches, options):
    """Text of one small entry per archive; nothing where the entry is absent."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            filesystem, path = open_fs(row.source, options)
            with zipfile.ZipFile(filesystem.open_input_file(path)) as archive:
                if row.entry in archive.namelist():
                    yield pd.DataFrame({"value": [archive.read(row.entry).decode("utf-8")]})


def read_named_entries(batches, entry, options):
    """(bundle, value): the text of one small entry of each ZIP file in `source`; others are passed over."""
    for batch in batches:
        rows = []
        for row in batch.itertuples(index=False):
            filesystem, path = open_fs(row.source, options)
            try:
                with zipfile.ZipFile(filesystem.open_input_file(path)) as archive:
                    rows.append((row.bundle, archive.read(entry).decode("utf-8")))
            except (zipfile.BadZipFile, KeyError, ValueError):  # no archive, or none of ours
                continue
        yield pd.DataFrame(rows, columns=["bundle", "value"])


def next_fit(sizes, limit):
    """Part number per file: a new part starts when the next file would exceed `limit`."""
    ends = np.cumsum(np.asarray(sizes, dtype="int64"))
    parts = np.zeros(len(ends), dtype="int64")
    start, part = 0, 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + limit, side="right")), start + 1)
        parts[start:stop] = part
        start, part = stop, part + 1
    return parts


def merged(intervals):
    """Intervals of whole numbers, sorted, with those joined that overlap or touch."""
    out = []
    for low, high in sorted(intervals):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def advance(following, waiting, seen):
    """The next version that is wanted, and the intervals that wait beyond a gap, after some more have been seen.

    Versions below the next one have been given out; that they come again changes nothing.
    """
    held = [(max(low, following), high) for low, high in merged([*waiting, *seen]) if high >= following]
    if held and held[0][0] == following:
        return held[0][1] + 1, held[1:]
    return following, held


def version_intervals(batches):
    """Versions of one task as few intervals, so that little goes to the state."""
    for batch in batches:
        yield pd.DataFrame(merged((v, v) for v in batch["version"].tolist()), columns=["low", "high"], dtype="int64")


#: Stands for "no part is open", which no number of bytes in a part reaches.
ANY_FILL = 1 << 62


def block_outcomes(block, sizes, limit):
    """What next-fit makes of a run of files, by how full the open part is on entry.

    A row for each file that may open the run's first new part (`first`, the number of files where none does): it is the one
    for fills up to `covers` and above the next smaller `covers`; `opened` parts begin in the run, and the last of them
    ends it with `used` bytes (or, if none begins, so many are added to the open one).
    """
    before = np.concatenate([[0], np.cumsum(np.asarray(sizes, dtype="int64"))])
    files = len(before) - 1
    after = np.searchsorted(before, before[:-1] + limit, side="right") - 1
    after = np.maximum(after, np.arange(files) + 1)  # the file that closes a part which starts here
    opened, last = np.ones(files + 1, dtype="int64"), np.arange(files + 1)
    opened[files] = 0
    for start in range(files - 1, -1, -1):
        if after[start] < files:
            opened[start], last[start] = opened[after[start]] + 1, last[after[start]]
    opens = np.r_[np.diff(before) > 0, True]  # an empty file never closes a part that the file before it left open
    opens[0] = True
    firsts = np.flatnonzero((before <= limit) & opens)
    covers = np.where(firsts == 0, ANY_FILL, limit - before[firsts])
    used = np.where(firsts == files, before[files], before[files] - before[np.minimum(last[firsts], files)])
    return pd.DataFrame({"block": block, "first": firsts, "covers": covers, "opened": opened[firsts], "used": used})


def joined_outcomes(former, latter):
    """What next-fit makes of two runs of files, one after the other; each is (covers, opened, used) by rising `covers`.

    Neighbours that lead to the same end become one row.
    """
    (covers, opened, used), (next_covers, next_opened, next_used) = former, latter
    whole = opened > 0  # in these the fill on entry is forgotten
    then = np.searchsorted(next_covers, used[whole])
    joined = [
        covers[whole],
        opened[whole] + next_opened[then],
        np.where(next_opened[then] > 0, next_used[then], used[whole] + next_used[then]),
    ]
    if not whole[0]:  # up to this fill the former run opens no part: the latter is entered with so much more
        reach = np.minimum(next_covers - used[0], covers[0])
        kept = slice(np.searchsorted(reach, 0), np.searchsorted(reach, covers[0]) + 1)
        ends = np.where(next_opened > 0, next_used, used[0] + next_used)
        joined = [np.concatenate([a[kept], b]) for a, b in zip((reach, next_opened, ends), joined)]
    last = np.r_[(np.diff(joined[1]) != 0) | (np.diff(joined[2]) != 0), True]
    return tuple(column[last] for column in joined)


def _range_runs(batch):
    """(range, files): a batch that is sorted by range, cut where the next range begins."""
    ranges = batch.column("__range").to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(np.diff(ranges)) + 1).tolist(), len(ranges)]
    for start, stop in zip(cuts, cuts[1:]):
        if start < stop:
            yield int(ranges[start]), batch.slice(start, stop - start)


def _file_sizes(files):
    return np.asarray(files.column("size").fill_null(0).to_numpy(zero_copy_only=False), dtype="int64")


def range_outcomes(batches, limit, per_block):
    """`block_outcomes` of whole ranges of files, which come in order in Arrow batches, found block by block."""
    import pyarrow as pa

    def rows(number, outcomes):
        return pa.RecordBatch.from_pydict(
            {
                "range": pa.array(np.full(len(outcomes[0]), number), "int32"),
                "covers": pa.array(outcomes[0], "int64"),
                "opened": pa.array(outcomes[1], "int64"),
                "used": pa.array(outcomes[2], "int64"),
            }
        )

    at, found = None, None
    for batch in batches:
        for number, files in _range_runs(batch):
            if number != at and found is not None:
                yield rows(at, found)
                found = None
            at, sizes = number, _file_sizes(files)
            for start in range(0, len(sizes), per_block):
                block = block_outcomes(number, sizes[start : start + per_block], limit).sort_values("covers")
                outcomes = tuple(block[name].to_numpy() for name in ("covers", "opened", "used"))
                found = outcomes if found is None else joined_outcomes(found, outcomes)
    if found is not None:
        yield rows(at, found)


def number_files(batches, limit, kept):
    """The columns `kept` and `part` of files that come in order in Arrow batches, range by range.

    A range is entered with the part `__part` open and `__used` bytes in it.
    """
    import pyarrow as pa

    at = None
    for batch in batches:
        for number, files in _range_runs(batch):
            if number != at:
                at, part, used = number, files.column("__part")[0].as_py(), files.column("__used")[0].as_py()
            sizes = _file_sizes(files)
            upto = np.cumsum(sizes)
            first = int(np.searchsorted(upto, limit - used, side="right"))  # the files before it still fit
            parts = np.full(len(sizes), part, dtype="int64")
            parts[first:] = next_fit(sizes[first:], limit) + part + 1
            used = int(sizes[parts == parts[-1]].sum()) if first < len(sizes) else used + int(upto[-1])
            part = int(parts[-1])
            yield pa.RecordBatch.from_arrays([*(files.column(name) for name in kept), pa.array(parts)], [*kept, "part"])


# --- deletion vectors -------------------------------------------------------


def z85_decode(text):
    digits = np.array([Z85_ALPHABET.index(c) for c in text], dtype="uint64").reshape(-1, 5)
    words = digits @ np.array([85**4, 85**3, 85**2, 85, 1], dtype="uint64")
    return words.astype(">u4").tobytes()


def read_positions(blob):
    """Row positions in a serialized 64-bit Roaring bitmap."""
    magic, count = struct.unpack_from("<iq", blob)
    if magic != DV_MAGIC:
        raise ValueError(f"unknown deletion vector format {magic}")
    at, found = 12, []
    for _ in range(count):
        (high,) = struct.unpack_from("<I", blob, at)
        at, low = read_bitmap(blob, at + 4)
        found.append(low + (np.int64(high) << 32))
    return np.concatenate(found) if found else np.empty(0, dtype="int64")


def read_bitmap(blob, at):
    """(end offset, values) of one 32-bit Roaring bitmap that starts at `at`."""
    base = at
    (cookie,) = struct.unpack_from("<I", blob, at)
    runs = np.zeros(0, dtype=bool)
    if cookie & 0xFFFF == ROARING_WITH_RUNS:
        containers, at = (cookie >> 16) + 1, at + 4
        flags = np.frombuffer(blob, "u1", (containers + 7) // 8, at)
        runs, at = np.unpackbits(flags, bitorder="little")[:containers].astype(bool), at + len(flags)
    elif cookie == ROARING_NO_RUNS:
        (containers,) = struct.unpack_from("<I", blob, at + 4)
        at, runs = at + 8, np.zeros(containers, dtype=bool)
    else:
        raise ValueError(f"unknown bitmap cookie {cookie} at byte {base}")
    header = np.frombuffer(blob, "<u2", 2 * containers, at).reshape(-1, 2).astype("int64")
    at += 4 * containers
    if cookie == ROARING_NO_RUNS or containers >= ROARING_NO_OFFSET_LIMIT:
        at += 4 * containers
    values = []
    for (key, last), is_run in zip(header, runs):
        if is_run:
            (n,) = struct.unpack_from("<H", blob, at)
            pairs = np.frombuffer(blob, "<u2", 2 * n, at + 2).reshape(-1, 2).astype("int64")
            low = np.concatenate([np.arange(s, s + length + 1) for s, length in pairs])
            at += 2 + 4 * n
        elif last + 1 > ARRAY_CONTAINER_MAX:
            bits = np.frombuffer(blob, "u1", 8192, at)
            low, at = np.flatnonzero(np.unpackbits(bits, bitorder="little")), at + 8192
        else:
            low = np.frombuffer(blob, "<u2", last + 1, at).astype("int64")
            at += 2 * (last + 1)
        values.append(low + (key << 16))
    return at, np.concatenate(values) if values else np.empty(0, dtype="int64")


def vector_positions(dv_source, inline, offset, options):
    """Deleted positions of one file, ascending."""
    inline = text_or_none(inline)
    if inline is not None:
        return read_positions(z85_decode(inline))
    filesystem, path = open_fs(dv_source, options)
    with filesystem.open_input_file(path) as source:
        source.seek(int(offset))
        (size,) = struct.unpack(">i", source.read(4))
        return read_positions(source.read(size))


def unmarked_rows(places, options):
    """A function over (file, row index) batches: is the row not deleted?

    `places` tells where each file's vector is. A task scans its files one after the other and holds one vector.
    """

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        held, positions = None, None
        for files, rows in batches:
            codes, names = pd.factorize(files)
            at = rows.to_numpy("int64")
            keep = np.ones(len(at), dtype=bool)
            for code, name in enumerate(names):
                if name != held:
                    held, positions = name, vector_positions(*places[name], options)
                mine = np.flatnonzero(codes == code)
                if len(positions):
                    found = np.minimum(np.searchsorted(positions, at[mine]), len(positions) - 1)
                    keep[mine] = positions[found] != at[mine]
            yield pd.Series(keep)

    return run
