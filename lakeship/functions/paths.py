"""Column expressions over log and bundle paths; all of them stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_DIR = "_delta_log"
METADATA_FILE = "metadata.json"
HINT_FILE = "_last_checkpoint"

# Fixed values of the public table format.
COMMIT_PATTERN = r"^[0-9]{20}\.json$"
CHECKPOINT_PATTERN = r"^[0-9]{20}\.checkpoint(\.[0-9]{10}\.[0-9]{10})?\.parquet$"
UNSUPPORTED_CHECKPOINT_PATTERN = r"^[0-9]{20}\.checkpoint\..*[0-9a-fA-F]{8}-.*$"
Z85_ALPHABET = (
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ.-:+=^!/*?&<>()[]{}@%$#"
)
PLAIN_PATH = r"[A-Za-z0-9_\-!.~'()*,;:$&+=@/]*"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def commit_name(version: Column) -> Column:
    return F.format_string("%020d.json", version)


def checkpoint_name(version: Column) -> Column:
    return F.format_string("%020d.checkpoint.parquet", version)


def version_of(name: Column) -> Column:
    """Version in the first 20 characters of a log file name, else NULL."""
    head = F.substring(name, 1, 20)
    return F.when(head.rlike("^[0-9]{20}$"), head.try_cast("bigint"))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(name: Column) -> Column:
    """Text after the last dot of the file name, '' where there is none."""
    base = base_name(name)
    return F.when(F.contains(base, F.lit(".")), F.substring_index(base, ".", -1)).otherwise("")


def file_class(path: Column) -> Column:
    """What a file of a table or bundle is, from its relative path."""
    base = base_name(path)
    in_log = F.startswith(path, F.lit(LOG_DIR + "/"))
    return (
        F.when(in_log & base.rlike(COMMIT_PATTERN), "commit")
        .when(in_log & base.rlike(CHECKPOINT_PATTERN), "checkpoint")
        .when(in_log & (base == HINT_FILE), "hint")
        .when(in_log, "log")
        .when(path == METADATA_FILE, "metadata")
        .when(base.rlike(r"^deletion_vector_.*\.bin$"), "dv")
        .otherwise("data")
    )


def decode_path(path: Column) -> Column:
    """URI-decode a log path; '+' is an ordinary character there."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def encode_path(path: Column) -> Column:
    """URI-encode a relative path the way the log stores it."""
    encoded = F.url_encode(path)
    for coded, plain in (("+", "%20"), ("%2F", "/"), ("%3D", "=")):
        encoded = F.replace(encoded, F.lit(coded), F.lit(plain))
    return encoded


def is_absolute(path: Column) -> Column:
    return path.rlike(r"^([A-Za-z][A-Za-z0-9+.\-]*:|/)")


def is_safe_entry(entry: Column) -> Column:
    """A bundle entry that stays inside the directory it is extracted to."""
    return ~(is_absolute(entry) | entry.rlike(r"(^|[/\\])\.\.([/\\]|$)") | F.contains(entry, F.lit("\\")))


def normal_uri(uri: Column) -> Column:
    """One spelling for local URIs: file:/a, file:///a and /a are the same file."""
    return F.regexp_replace(F.regexp_replace(uri, "^/+", "file:/"), "^file:/+", "file:/")


def plain_root(root: str) -> bool:
    """Whether a location reads the same with and without URI encoding."""
    return re.fullmatch(PLAIN_PATH, root) is not None


def relative_to(root: str, uri: Column) -> Column:
    """Path below `root` (a qualified location) of a plain, decoded URI."""
    return F.substring(normal_uri(uri), len(root.rstrip("/")) + 2, 1 << 30)


def join_path(*parts) -> Column:
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.regexp_replace(F.concat_ws("/", *cols), "(?<!:)(?<!:/)/{2,}", "/")


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)


def bucket_of(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^[A-Za-z0-9]+://([^/]+)", 1)


def key_of(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^[A-Za-z0-9]+://[^/]+/?(.*)$", 1)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def partition_value(path: Column, column: str) -> Column:
    """Value of one key=value directory, unescaped; the null marker becomes NULL."""
    pattern = "(?:^|/)" + _regex_quote(column) + "=([^/]*)/"
    raw = F.regexp_extract(path, pattern, 1)
    return F.when((raw != NULL_PARTITION) & (raw != ""), decode_path(raw))


def _regex_quote(text: str) -> str:
    return r"\Q" + text + r"\E"


def z85_to_hex(text: Column, groups: int) -> Column:
    """Z85 text (5 characters per 4 bytes) as hex digits."""

    def digit(position: Column) -> Column:
        character = F.substring(text, position, F.lit(1))
        return F.instr(F.lit(Z85_ALPHABET), character).cast("bigint") - 1

    def word(group: Column) -> Column:
        positions = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: group * 5 + i)
        value = F.aggregate(positions, F.lit(0).cast("bigint"), lambda acc, at: acc * 85 + digit(at))
        return F.lpad(F.lower(F.hex(value)), 8, "0")

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), word), "")


def uuid_text(hex32: Column) -> Column:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(hex32, at, n) for at, n in cuts])


def dv_relative_path(storage_type: Column, path_or_inline: Column) -> Column:
    """File that holds a deletion vector: relative ('u'), as given ('p'), none ('i')."""
    prefix = F.substring(path_or_inline, F.lit(1), F.length(path_or_inline) - 20)
    tail = F.substring(path_or_inline, F.greatest(F.length(path_or_inline) - 19, F.lit(1)), F.lit(20))
    name = F.concat(F.lit("deletion_vector_"), uuid_text(z85_to_hex(tail, 5)), F.lit(".bin"))
    return F.when(storage_type == "u", F.concat_ws("/", blank_to_null(prefix), name)).when(
        storage_type == "p", decode_path(path_or_inline)
    )
