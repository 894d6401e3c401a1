"""Driver-side filesystem helpers: thin calls to Hadoop's FileSystem API.

Only small things pass through here (a directory rename, a few-KB text file);
file bodies move inside Spark tasks, see `lakeship.workers`.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

S3_KEYS = {
    "access_key": "fs.s3a.access.key",
    "secret_key": "fs.s3a.secret.key",
    "endpoint": "fs.s3a.endpoint",
    "path_style": "fs.s3a.path.style.access",
}


class ShippingError(Exception):
    """A bundle or table that cannot be shipped, applied or read correctly."""


def _path(spark: SparkSession, location: str):
    return spark._jvm.org.apache.hadoop.fs.Path(location)


def _fs(spark: SparkSession, location: str):
    return _path(spark, location).getFileSystem(spark._jsc.hadoopConfiguration())


def qualify(spark: SparkSession, location: str) -> str:
    """Fully qualified location without a trailing slash, e.g. `file:/data/t`."""
    return _fs(spark, location).makeQualified(_path(spark, location)).toString()


def exists(spark: SparkSession, location: str) -> bool:
    return _fs(spark, location).exists(_path(spark, location))


def is_dir(spark: SparkSession, location: str) -> bool:
    fs, path = _fs(spark, location), _path(spark, location)
    return fs.exists(path) and fs.getFileStatus(path).isDirectory()


def has_entries(spark: SparkSession, location: str) -> bool:
    """Whether a directory holds anything; reads at most one listing page."""
    fs, path = _fs(spark, location), _path(spark, location)
    return fs.exists(path) and fs.listStatusIterator(path).hasNext()


def matching_names(spark: SparkSession, location: str, pattern: str) -> list[str]:
    """Names directly below a directory that match a glob pattern; for patterns that few names match."""
    found = _fs(spark, location).globStatus(_path(spark, f"{no_glob(location)}/{pattern}"))
    return sorted(status.getPath().getName() for status in found or [])


def written_files(spark: SparkSession, location: str) -> list[str]:
    """Non-empty files that a Spark write left in a staging directory of ours."""
    statuses = _fs(spark, location).listStatus(_path(spark, location))
    paths = sorted(s.getPath().toString() for s in statuses if s.getLen() > 0)
    return [p for p in paths if p.rsplit("/", 1)[1].startswith("part-")]


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename `source` to `target` only if `target` does not exist yet."""
    jvm = spark._jvm
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _fs(spark, target).getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(_path(spark, source), _path(spark, target), options)
    except Exception as error:  # py4j wraps the Java exception
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def remove_dir(spark: SparkSession, location: str) -> None:
    """Drop a staging directory of our own."""
    _fs(spark, location).delete(_path(spark, location), True)


def write_text(spark: SparkSession, location: str, text: str, overwrite: bool = False) -> None:
    write_bytes(spark, location, text.encode("utf-8"), overwrite)


def write_bytes(spark: SparkSession, location: str, data: bytes, overwrite: bool = False) -> None:
    stream = _fs(spark, location).create(_path(spark, location), overwrite)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def read_text(spark: SparkSession, location: str) -> str:
    """Whole text of one small file (hints, metadata)."""
    stream = _fs(spark, location).open(_path(spark, location))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def storage_options(spark: SparkSession) -> dict:
    """Object-store settings of the session, for the copy tasks."""
    conf = spark._jsc.hadoopConfiguration()
    found = {name: conf.get(key) for name, key in S3_KEYS.items()}
    return {name: value for name, value in found.items() if value}


def no_glob(location: str) -> str:
    """A location for Spark's readers, in which brackets, braces and the like stand for themselves."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in location)


def read_parquet(reader: DataFrameReader, locations: list[str]) -> DataFrame:
    """`reader.parquet(*locations)` that hands over the list in one call, not one by one. No path holds a NUL."""
    jvm = reader._spark._jvm
    names = jvm.java.util.regex.Pattern.compile("\0").splitAsStream("\0".join(locations)).toList()
    return reader._df(reader._jreader.parquet(jvm.PythonUtils.toSeq(names)))


#: Scratch directories of the operations that run now, the innermost operation's last.
_scratch: ContextVar[tuple[list, ...]] = ContextVar("scratch", default=())


def tidy(operation: Callable) -> Callable:
    """What an operation writes down on its way is deleted when it ends, also when it fails."""

    @wraps(operation)
    def run(*args, **kwargs):
        mine: list[tuple[SparkSession, str]] = []
        token = _scratch.set((*_scratch.get(), mine))
        try:
            return operation(*args, **kwargs)
        finally:
            _scratch.reset(token)
            for spark, location in mine:
                remove_dir(spark, location)

    return run


def scratch_dir(spark: SparkSession, label: str = "run", result: bool = False) -> str:
    """A fresh directory in the folder all executors share.

    It lasts as long as the operation that asks for it; with `result`, as long as the one that called that, if any.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ShippingError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    location = qualify(spark, f"{base.rstrip('/')}/lakeship-{label}-{uuid.uuid4().hex}")
    owners = _scratch.get()[:-1] if result else _scratch.get()
    if owners:
        owners[-1].append((spark, location))
    return location


def materialize(df: DataFrame, label: str = "step", result: bool = False) -> DataFrame:
    """Write a result to shared storage and read it back, so that it runs once."""
    spark = df.sparkSession
    location = scratch_dir(spark, label, result)
    df.write.parquet(location)
    return spark.read.schema(df.schema).parquet(no_glob(location))


