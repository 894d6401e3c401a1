"""Which bundles bring a table up to date: the shortest chain of version ranges that leaves no gap."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeship import storage, workers
from lakeship.functions import paths
from lakeship.functions.actions import BUNDLE_SCHEMA
from lakeship.operators.write import table_exists
from lakeship.plans.apply import import_bundle
from lakeship.sources import log
from lakeship.storage import ShippingError

CHAIN_SCHEMA = "step int, bundle string, from_version bigint, to_version bigint"


def available_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """(bundle, table, from_version, to_version) of the finished bundles directly in a folder, of both forms.

    Only the few hundred bytes of metadata are read; bundles whose export did not finish have none, and what is not
    a bundle is passed over.
    """
    folder = storage.qualify(spark, folder)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    location, parent = paths.normal_uri(F.col("path")), F.regexp_replace(paths.normal_uri(F.col("path")), r"/[^/]+$", "")
    inside = reader.option("pathGlobFilter", paths.METADATA_FILE).load(storage.no_glob(folder)).where(parent.rlike(r"\.[zZ][iI][pP]$"))
    directories = inside.select(parent.alias("bundle"), F.decode("content", "UTF-8").alias("value"))
    files = reader.option("pathGlobFilter", "*.zip").load(storage.no_glob(folder)).where(parent == folder)
    files = files.select(location.alias("bundle"), F.col("path").alias("source"))
    read = partial(workers.read_named_entries, entry=paths.METADATA_FILE, options=storage.storage_options(spark))
    both = directories.unionByName(files.mapInPandas(read, "bundle string, value string"))
    meta = F.from_json("value", BUNDLE_SCHEMA)
    found = both.select("bundle", meta.alias("m")).where(F.regexp_replace("bundle", r"/[^/]+$", "") == folder)
    found = found.select("bundle", F.col("m.tablePath").alias("table"), F.col("m.fromVersion").alias("from_version"), F.col("m.toVersion").alias("to_version"))
    return found.where("from_version <= to_version")


def shortest_chain(intervals: DataFrame, after: int, until: int | None = None) -> list[tuple[str, int, int]]:
    """The fewest (bundle, from, to) that reach `until` (default: as far as they go) from version `after` without a gap.

    Of the bundles that continue what is there, the one that goes furthest is never worse than another. They are read
    once, in the order of their first versions, and only the best one so far is held.
    """
    best = intervals.groupBy("from_version").agg(F.max(F.struct("to_version", "bundle")).alias("best"))
    chain: list[tuple[str, int, int]] = []
    furthest = None
    for row in best.select("from_version", "best.*").orderBy("from_version").toLocalIterator():
        if furthest is not None and row.from_version > after + 1:
            chain.append(furthest)
            after, furthest = furthest[2], None
        if (until is not None and after >= until) or row.from_version > after + 1:
            break
        if row.to_version > max(after, furthest[2] if furthest else -1):
            furthest = (row.bundle, row.from_version, row.to_version)
    if furthest is not None and (until is None or after < until):
        chain.append(furthest)
    return chain


def plan_bundles(
    spark: SparkSession, folder: str, target: str | None = None, table: str | None = None, until: int | None = None
) -> DataFrame:
    """(step, bundle, from_version, to_version): the fewest bundles of a folder that bring `target` to the newest version.

    Without a target, or where it does not exist yet, the chain starts at version 0. `table` (the exported table's location)
    chooses among bundles of several tables; without it a folder that holds several is refused. With `until`, the chain ends as
    soon as that version is reached, and it is an error if it cannot be. A gap ends the chain.
    """
    bundles = storage.materialize(available_bundles(spark, folder), "bundles", result=True)
    tables = [row.table for row in bundles.select("table").distinct().limit(3).collect()]
    if table is None and len(tables) > 1:
        raise ShippingError(f"{folder} holds bundles of several tables, such as {sorted(tables)}; name one")
    if table is not None:
        bundles = bundles.where(F.col("table") == storage.qualify(spark, table))
    after = -1
    if target is not None and table_exists(spark, target):
        after = log.resolve_segment(spark, storage.qualify(spark, target)).version
    chain = shortest_chain(bundles, after, until)
    reached = chain[-1][2] if chain else after
    if until is not None and reached < until:
        raise ShippingError(f"the bundles in {folder} reach version {reached}, not {until}")
    return spark.createDataFrame([(i, *step) for i, step in enumerate(chain)], CHAIN_SCHEMA)


def import_chain(spark: SparkSession, folder: str, target: str, table: str | None = None) -> list[str]:
    """Import the chain that `plan_bundles` names, one bundle after the other; returns their names."""
    done = []
    for row in plan_bundles(spark, folder, target, table).orderBy("step").toLocalIterator():
        import_bundle(spark, row.bundle, target, "apply" if table_exists(spark, target) else "error")
        done.append(row.bundle)
    return done
