"""Putting shipped files in place: data first, then the log, then proof."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeship import storage, workers
from lakeship.functions import paths
from lakeship.operators import ledger, manifest, packing, ranges
from lakeship.operators.write import table_exists
from lakeship.plans import export as exporting
from lakeship.plans import publish
from lakeship.sources import bundle as bundles
from lakeship.sources import log
from lakeship.sources.table import snapshot
from lakeship.storage import ShippingError

STATUS_SCHEMA = "path string, kind string, size bigint, crc bigint, status string"
LOG_KINDS = ("commit", "checkpoint", "hint")
STAGED = f"{ledger.STATE_DIR}/{ledger.INCOMING_DIR}/"
WRONG_SIZE = "(kind = 'data' AND found_size <> size)"


@dataclass(frozen=True)
class Shipment:
    """Files on their way to a table: path, kind, size, stamp, source, entry, seekable.

    `key` names the shipment: a later attempt with the same key goes on where an earlier one stopped. A file whose `stamp`
    is the same as then is the same file. `seekable` files can be read from any byte on.
    """

    key: str
    files: DataFrame
    from_version: int
    to_version: int
    totals: tuple[int, int]
    archives: int = 0
    continues: bool = False  # the target is known to be at version `from_version - 1`


def plain_files(files: DataFrame) -> DataFrame:
    """Files of a manifest, as a shipment has them."""
    return files.select(
        "path", "kind", "size", "stamp", "source", F.lit(None).cast("string").alias("entry"), F.lit(True).alias("seekable")
    )


@storage.tidy
def import_bundle(spark: SparkSession, bundle: str, target: str, mode: str = "error") -> DataFrame:
    """Bring a bundle to `target`; returns one row per file with what was done.

    mode: error (target must not exist) | overwrite (replace the table) | apply
    (continue the target's history). Nothing becomes visible before every file
    has arrived and the log has been checked. An import that was stopped can be
    called again in the same mode: it copies what has not arrived yet.
    """
    meta = bundles.read_metadata(spark, bundle)
    entries = storage.materialize(bundles.bundle_entries(spark, bundle), "entries")
    check = bundles.bundle_check(entries, meta.toVersion).first()
    if check.unsafe_entries:
        raise ShippingError(f"{bundle} has {check.unsafe_entries} entries that would leave the target directory")
    if not check.log_files:
        raise ShippingError(f"{bundle} holds no log files")
    if not check.versions_ok:
        raise ShippingError(
            f"{bundle} holds version {check.highest_version}, its metadata ends at {meta.toVersion}"
        )
    if meta.parts is not None and check.archives != meta.parts:
        raise ShippingError(f"{bundle} does not have its {meta.parts} parts")
    files = entries.where((F.col("kind") != "metadata") & (F.col("kind") != "log")).select(
        F.col("entry").alias("path"), "kind", "size", F.col("crc").alias("stamp"), "source", "entry", "seekable"
    )
    key = f"bundle of {meta.tablePath}, versions {meta.fromVersion}..{meta.toVersion}, {meta.exportTimestamp}"
    return apply_shipment(spark, Shipment(key, files, meta.fromVersion, meta.toVersion, (check.files, check.bytes), check.archives), target, mode)


@storage.tidy
def ship(spark: SparkSession, source: str, target: str) -> DataFrame | None:
    """Copy the versions that `target` lacks straight from `source`; None if it lacks none.

    One that was stopped, or that failed, can be called again: it copies what has not arrived yet.
    """
    source, target = storage.qualify(spark, source), storage.qualify(spark, target)
    mode = "apply" if table_exists(spark, target) else "error"
    start = log.resolve_segment(spark, target).version + 1 if mode == "apply" else 0
    if mode == "apply" and log.resolve_segment(spark, source).version < start:
        return None
    last, files, count, size = exporting.plan_range(spark, source, start)
    files = plain_files(files)
    return apply_shipment(spark, Shipment(f"table {source}", files, start, last, (count, size)), target, mode)


@storage.tidy
def ship_range(spark: SparkSession, source: str, target: str, first: int, last: int) -> DataFrame | None:
    """Copy versions `first`..`last`, whose commits are known to be there; None if the target has them.

    Where the target ends with `first - 1`, as it does from one range to the next, neither log is listed: the work is
    that of the range. A target in any other state gets what `ship` gives it.
    """
    source, target = storage.qualify(spark, source), storage.qualify(spark, target)

    def has(version: int) -> bool:
        return storage.exists(spark, f"{log.log_dir(target)}/{version:020d}.json")

    if has(last):
        return None
    if first == 0 or has(first) or not has(first - 1):
        return ship(spark, source, target)
    files, count, size = exporting.plan_commits(spark, source, first, last)
    files = plain_files(files)
    shipment = Shipment(f"table {source}", files, first, last, (count, size), continues=True)
    return apply_shipment(spark, shipment, target, "apply")


def apply_shipment(spark: SparkSession, shipment: Shipment, target: str, mode: str) -> DataFrame:
    """Copy, check and publish a shipment; returns one row per file.

    An attempt that stops leaves its claim, its ledger and the files that have arrived below `target/_shipping` or in
    their places. The next attempt of the same shipment in any mode goes on from there (status 'resumed'); other folders that
    exist are still refused in mode `error`. A shipment that a table of its own refuses (other content, a gap) leaves
    nothing. One shipment at a time may go to a target.
    """
    if mode not in ("error", "overwrite", "apply"):
        raise ValueError(f"unknown mode {mode!r}")
    target = storage.qualify(spark, target)
    exists = table_exists(spark, target)
    if mode == "error" and exists:
        raise ShippingError(f"{target} already exists; use mode 'overwrite' or 'apply'")
    current = None
    if mode == "apply" and exists:
        current = shipment.from_version - 1 if shipment.continues else log.resolve_segment(spark, target).version
    if current is not None and shipment.from_version > current + 1:
        raise ShippingError(
            f"{target} is at version {current}; a shipment from {shipment.from_version} leaves a gap"
        )
    ledger.claim(spark, target, shipment.key, take_over=mode != "error")
    staging = ledger.incoming(target)
    try:
        if current is not None:
            publish.take_back(spark, staging, target, current)
        copied = _copy_checked(spark, shipment, target, current)
        if current is None:
            publish.publish_table(spark, staging, target, replace=mode == "overwrite")
        else:
            publish.publish_commits(spark, staging, target, copied.where(F.col("kind").isin(*LOG_KINDS)), current)
    except ShippingError:
        if exists:
            ledger.release(spark, target)
        raise
    expected = max(shipment.to_version, current or 0)
    if not storage.exists(spark, f"{log.log_dir(target)}/{expected:020d}.json"):
        version = log.resolve_segment(spark, target).version  # a range may also end with a checkpoint
        if version != expected:
            raise ShippingError(f"{target} is at version {version}, expected {expected}")
    ledger.release(spark, target)
    return copied.withColumn("path", F.regexp_replace("path", f"^{STAGED}", ""))


def _copy_checked(spark, shipment: Shipment, target: str, current: int | None) -> DataFrame:
    """Copy the log to the staging folder and data files to their places; raises unless the result would be whole.

    A file that the target holds already is never replaced: the same bytes count as copied, others are refused,
    so a shipment that fails leaves the old table as it was.
    """
    in_log = F.col("kind").isin(*LOG_KINDS)
    placed = shipment.files.withColumn("path", F.when(in_log, F.concat(F.lit(STAGED), "path")).otherwise(F.col("path")))
    done = ledger.arrived(spark, target)
    if done is not None and not storage.is_dir(spark, log.log_dir(ledger.incoming(target))):
        done = done.where(~in_log)  # that attempt's log has been published
    if done is not None:
        done = storage.materialize(done, "arrived")  # the copy tasks write to the ledger that is read here
        placed = storage.materialize(placed, "placed")
    totals = shipment.totals if done is None else None
    waiting, notes = ledger.outstanding(placed, done), ledger.ledger_dir(target)
    large = find_large(waiting, target, totals)
    if large is not None:
        waiting = storage.materialize(waiting.join(large.select("path"), "path", "left_anti"), "waiting")
        totals = None
    copied = copy_files(waiting, target, totals, notes, shipment.archives)
    if large is not None:
        by_ranges = ranges.copy_by_ranges(large, target, ledger.ranges_dir(target), notes, STATUS_SCHEMA, ranges.RANGE_BYTES)
        copied = storage.materialize(copied.unionByName(by_ranges), "copied", result=True)
    if done is not None:
        copied = copied.unionByName(ledger.resumed(placed, done))
        copied = storage.materialize(copied, "copied", result=True)
    _require_arrived(copied, shipment, current, target)
    staging = ledger.incoming(target)
    if current is not None:
        _check_overlap(spark, staging, target, shipment.from_version, current)
    _check_complete(spark, staging, target, shipment, current)
    return copied


def find_large(files: DataFrame, root: str, totals: tuple[int, int] | None) -> DataFrame | None:
    """Data files to copy by ranges, written down; None if there are none."""
    limit = ranges.RANGE_BYTES
    if not ranges.can_write_ranges(root) or (totals or packing.totals(files))[1] <= limit:
        return None
    large = ranges.large_files(files.where(~F.col("kind").isin(*LOG_KINDS)), limit)
    large = storage.materialize(large, "large")
    return None if large.isEmpty() else large


def copy_files(
    files: DataFrame,
    root: str,
    totals: tuple[int, int] | None = None,
    ledger_dir: str | None = None,
    archives: int = 0,
) -> DataFrame:
    """Copy files or ZIP entries below `root` in parallel; the status is written down.

    An archive's entries go to as few tasks as use all slots; there are many more tasks than slots when there is
    much to copy, which evens out files of different size.
    """
    spark = files.sparkSession
    tasks = packing.task_count(spark, *(totals or packing.totals(files)))
    options = storage.storage_options(spark)
    copy = partial(workers.copy_files, root=root, options=options, ledger=ledger_dir, replaced=LOG_KINDS)
    portions = -(-tasks // archives) if archives else 1
    spread = files.repartition(tasks, "source", F.pmod(F.xxhash64("path"), F.lit(portions))).sortWithinPartitions("source", "path")
    return storage.materialize(spread.mapInPandas(copy, STATUS_SCHEMA), "copied", result=True)


def _require_arrived(copied: DataFrame, shipment: Shipment, current: int | None, target: str) -> None:
    """No file has other content, the log is all there, and with it every new commit of a shipment that continues a history.

    A file that no snapshot needs may be missing; `_check_complete` looks at the others.
    """
    in_log = F.col("kind").isin(*LOG_KINDS)
    version = paths.version_of(paths.base_name(F.col("path")))
    after = -1 if current is None else current
    new = (F.col("kind") == "commit") & version.between(after + 1, shipment.to_version)
    facts = copied.agg(
        F.min(F.when(F.col("status") == "conflict", F.col("path"))).alias("conflict"),
        F.min(F.when(in_log & (F.col("status") == "missing"), F.col("path"))).alias("missing"),
        F.count_distinct(F.when(new, version)).alias("commits"),
    ).first()
    if facts.conflict is not None:
        raise ShippingError(f"{facts.conflict.removeprefix(STAGED)} is in {target} with other content")
    if facts.missing is not None:
        raise ShippingError(f"{facts.missing.removeprefix(STAGED)} cannot be read from the shipment")
    if current is not None and facts.commits != max(0, shipment.to_version - current):
        raise ShippingError(f"the shipment lacks commits between {current + 1} and {shipment.to_version}")


def _check_overlap(spark, staging: str, target: str, first: int, current: int) -> None:
    """Commits that both sides have must be the same bytes."""

    def digests(table: str) -> DataFrame:
        commits = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(storage.no_glob(log.log_dir(table)))
        name = F.col("_metadata.file_name")
        inside = (name >= f"{first:020d}.json") & (name <= f"{current:020d}.json")
        return commits.where(inside).select(name.alias("name"), F.sha2("content", 256).alias("digest"))

    if first > current:
        return
    differing = digests(staging).alias("a").join(digests(target).alias("b"), "name").where("a.digest <> b.digest")
    row = differing.first()
    if row is not None:
        raise ShippingError(f"{target} has another commit {row.name} than the shipment")


def _check_complete(spark, staging: str, target: str, shipment: Shipment, current: int | None) -> None:
    """Every file that is live after the shipment is at the target already."""
    if current is None:
        actions = snapshot(spark, staging, shipment.to_version, to_ship=True).actions
    else:
        actions = log.scan_actions(spark, staging, current + 1, shipment.to_version)
    live = manifest.needed_files(manifest.references(actions)).where("live")
    lost = manifest.probe(live, target).where(f"found_size IS NULL OR {WRONG_SIZE}").first()
    if lost is not None and lost.kind == "broken":
        raise ShippingError(f"the shipped log has a line that does not parse: {lost.path[:200]}")
    if lost is not None and lost.found_size is not None:
        raise ShippingError(f"{lost.path} has {lost.found_size} bytes; the log says {lost.size}")
    if lost is not None:
        raise ShippingError(f"{lost.path} is live at version {shipment.to_version} but was not shipped")


def verify_import(spark: SparkSession, target: str, expected_version: int | None = None) -> DataFrame:
    """One row: version, live files and bytes, files that are absent; raises if it is not whole."""
    snap = snapshot(spark, target, to_ship=True)
    if expected_version is not None and snap.version != expected_version:
        raise ShippingError(f"{target} is at version {snap.version}, expected {expected_version}")
    live = manifest.needed_files(manifest.references(snap.actions)).where("live")
    found = manifest.probe(live, snap.table)
    report = found.agg(
        F.count("*").alias("live_files"),
        F.coalesce(F.sum("found_size"), F.lit(0)).alias("live_bytes"),
        F.count_if(F.col("found_size").isNull()).alias("missing_files"),
        F.count_if(F.expr(WRONG_SIZE)).alias("wrong_sizes"),
    ).select(F.lit(snap.version).cast("bigint").alias("version"), "*")
    row = report.first()
    if row.missing_files:
        raise ShippingError(f"{target} lacks {row.missing_files} of its {row.live_files} live files")
    if row.wrong_sizes:
        raise ShippingError(f"{row.wrong_sizes} live files of {target} have not the size that the log says")
    return spark.createDataFrame([row], report.schema)
