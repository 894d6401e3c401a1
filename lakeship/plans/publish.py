"""Making shipped versions visible: files are moved by tasks, one rename by the driver shows them all."""

from __future__ import annotations

import json
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeship import storage, workers
from lakeship.functions import paths
from lakeship.operators import ledger, packing
from lakeship.sources import log
from lakeship.storage import ShippingError

REPLACED = "_replaced-"
PLACED_SCHEMA = "name string, status string"


def publish_table(spark: SparkSession, staging: str, target: str, replace: bool) -> None:
    """Put a whole log in place with one rename.

    A log that is replaced has to be moved away first. What is about to happen is written down before, so whoever finds
    no log between the two renames finishes the second one (`log.recover`): there is a table at every moment.
    """
    if replace and storage.exists(spark, log.log_dir(target)):
        old = f"{target}/{REPLACED}{uuid.uuid4().hex}"
        intent = json.dumps({"new": log.log_dir(staging), "old": old})
        storage.write_text(spark, log.intent_file(target), intent, overwrite=True)
        storage.move_new(spark, log.log_dir(target), old)
        log.recover(spark, target)
    elif not storage.move_new(spark, log.log_dir(staging), log.log_dir(target)):
        raise ShippingError(f"{target} was created by another writer")


def publish_commits(spark: SparkSession, staging: str, target: str, staged: DataFrame, current: int) -> None:
    """Continue a history: blocks of commits are moved by tasks, and the first new commit is the marker that shows them.

    History ends before the first version that is absent, so commits above `current + 1` are out of sight until
    that one is renamed, last, by the driver. Checkpoints follow (a reader starts from the newest one), then the
    hint. Stopped before the marker, the table is as it was, and the next try takes its commits back to begin with.
    No commit is ever replaced; when another writer takes the marker's version, ours are taken back and nothing is published.
    Other readers that look between may complain about the gap; a table that is shipped to has no other writers.
    """
    name = paths.base_name(F.col("path"))
    new = staged.select("kind", name.alias("name"), paths.version_of(name).alias("version"))
    ours, theirs = log.log_dir(staging), log.log_dir(target)
    marker = f"{current + 1:020d}.json"
    storage.write_text(spark, _placing(target), json.dumps({"from": current}), overwrite=True)
    placed = _place(spark, new.where((F.col("kind") == "commit") & (F.col("version") > current + 1)), ours, theirs)
    wrong = placed and placed.where("status IN ('conflict', 'missing')").agg(F.min("name")).first()[0]
    if wrong is not None or (
        storage.exists(spark, f"{ours}/{marker}") and not storage.move_new(spark, f"{ours}/{marker}", f"{theirs}/{marker}")
    ):
        take_back(spark, staging, target, current)
        raise ShippingError(f"{wrong or marker} of {target} was committed by another writer")
    _place(spark, new.where((F.col("kind") == "checkpoint") & (F.col("version") > current)), ours, theirs)
    if storage.exists(spark, f"{ours}/{paths.HINT_FILE}"):
        text = storage.read_text(spark, f"{ours}/{paths.HINT_FILE}")
        if json.loads(text).get("version", -1) > current:  # an older one's checkpoint was not published
            storage.write_text(spark, f"{theirs}/{paths.HINT_FILE}", text, overwrite=True)


def _placing(target: str) -> str:
    return f"{ledger.state_dir(target)}/placing.json"


def take_back(spark: SparkSession, staging: str, target: str, current: int) -> None:
    """After a publication that stopped before its marker: move the commits that nobody has seen back to `staging`."""
    if not storage.exists(spark, _placing(target)):
        return
    started = json.loads(storage.read_text(spark, _placing(target)))["from"]
    if started == current:  # else the marker is in place and they have been published
        ours, theirs = log.log_dir(staging), log.log_dir(target)
        unseen = log.list_log(spark, target).where((F.col("kind") == "commit") & (F.col("version") > current + 1))
        _place(spark, storage.materialize(unseen.select("name", "version"), "unseen"), theirs, ours)
    storage.remove_dir(spark, _placing(target))


def _place(spark: SparkSession, files: DataFrame, source: str, target: str) -> DataFrame | None:
    """Move log files by tasks, one block of neighbouring versions each; returns (name, status), None if there are none."""
    count = files.count()
    if not count:
        return None
    place = partial(workers.place_files, source=source, target=target, options=storage.storage_options(spark))
    blocks = files.repartitionByRange(packing.task_count(spark, count, 0), "version").select("name")
    return storage.materialize(blocks.mapInPandas(place, PLACED_SCHEMA), "placed")


def forget_replaced(spark: SparkSession, table: str) -> list[str]:
    """Delete the logs that overwrites have set aside; returns their names. Data files stay where they are."""
    table = storage.qualify(spark, table)
    names = storage.matching_names(spark, table, f"{REPLACED}*")
    for name in names:
        storage.remove_dir(spark, f"{table}/{name}")
    return names
