"""What an unfinished shipment leaves at its target: its claim, and the ledger of the files that have arrived.

Everything lies in `target/_shipping`, which goes when the shipment has been published. The claim tells our unfinished
target from a folder of somebody else; the ledger, written by the copy tasks as they go, tells the next attempt what it
need not copy again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeship import storage
from lakeship.storage import ShippingError

STATE_DIR = "_shipping"
CLAIM_FILE = "claim.json"
LEDGER_DIR = "ledger"
INCOMING_DIR = "incoming"
RANGES_DIR = "ranges"
LEDGER_SCHEMA = "path string, kind string, size bigint, crc bigint, stamp bigint"


def state_dir(target: str) -> str:
    return f"{target}/{STATE_DIR}"


def incoming(target: str) -> str:
    """Where the shipped log waits until all files are there."""
    return f"{state_dir(target)}/{INCOMING_DIR}"


def claim_of(spark: SparkSession, target: str) -> dict | None:
    """The claim on a target; one that was cut short while it was written counts as none."""
    location = f"{state_dir(target)}/{CLAIM_FILE}"
    if not storage.exists(spark, location):
        return None
    try:
        found = json.loads(storage.read_text(spark, location))
    except ValueError:
        return None
    return found if isinstance(found, dict) and "key" in found else None


def claim(spark: SparkSession, target: str, key: str, take_over: bool) -> None:
    """Mark a target as ours, or go on with what an earlier attempt of the same shipment (`key`) has marked.

    A new target must not exist unless it bears our own claim. With `take_over` (the target holds a table, or may be
    replaced) the unfinished state of another shipment is dropped.
    """
    found = claim_of(spark, target)
    if found is not None and found["key"] == key:
        return
    if not take_over and storage.is_dir(spark, target):
        by = f"; an unfinished shipment has claimed it: {found['key']}" if found else ""
        raise ShippingError(f"{target} already exists; use mode 'overwrite' or 'apply'{by}")
    storage.remove_dir(spark, state_dir(target))
    storage.write_text(spark, f"{state_dir(target)}/{CLAIM_FILE}", json.dumps({"key": key, "id": uuid.uuid4().hex}))


def ledger_dir(target: str) -> str:
    return f"{state_dir(target)}/{LEDGER_DIR}"


def ranges_dir(target: str) -> str:
    """Where large files lie until all their ranges are there."""
    return f"{state_dir(target)}/{RANGES_DIR}"


def arrived(spark: SparkSession, target: str) -> DataFrame | None:
    """Files that earlier attempts have brought: path, kind, size, crc, stamp, each once; None if there is no ledger."""
    location = ledger_dir(target)
    if not storage.has_entries(spark, location):
        return None
    notes = spark.read.schema(LEDGER_SCHEMA).json(storage.no_glob(location))
    latest = notes.where("path IS NOT NULL").groupBy("path", "stamp")
    return latest.agg(F.max(F.struct("kind", "size", "crc")).alias("f")).select("path", "f.*", "stamp")


def outstanding(files: DataFrame, done: DataFrame | None) -> DataFrame:
    """Files of the manifest that the ledger does not have in the same state (`stamp`); hints are never kept."""
    if done is None:
        return files
    kept = done.where("kind <> 'hint'").select(F.col("path").alias("_path"), F.col("stamp").alias("_stamp"))
    same = (F.col("path") == F.col("_path")) & F.col("stamp").eqNullSafe(F.col("_stamp"))
    return files.join(kept, same, "left_anti")


def resumed(files: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of the copy report for the manifest's files that need not be copied again."""
    known = done.where("kind <> 'hint'").select(
        F.col("path").alias("_path"), F.col("stamp").alias("_stamp"), F.col("size").alias("_size"), "crc"
    )
    same = (F.col("path") == F.col("_path")) & F.col("stamp").eqNullSafe(F.col("_stamp"))
    found = files.select("path", "kind", "stamp").join(known, same)
    return found.select("path", "kind", F.col("_size").alias("size"), "crc", F.lit("resumed").alias("status"))


def release(spark: SparkSession, target: str) -> None:
    """The shipment has been published, or given up: nothing of its state stays."""
    storage.remove_dir(spark, state_dir(target))
