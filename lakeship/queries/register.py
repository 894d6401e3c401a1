"""The registered queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeship import storage
from lakeship.functions import checksum, paths
from lakeship.operators import compare, dml, fingerprints, history, manifest, packing, replay, skipping, text, write
from lakeship.plans import apply, chain, export
from lakeship.queries import fixtures as fx
from lakeship.sources import bundle, log, table
from lakeship.streaming.ship import ship_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


# --- the commit log -----------------------------------------------------------

EVENT_ACTIONS = """
    SELECT datediff('hour', (SELECT date_trunc('day', min(ts)) FROM events), ts) AS version, event_id,
           'part ' || user_id || '+.parquet' AS path, event_id % 1000 AS size,
           CASE WHEN event_type = 'error' THEN 'remove' ELSE 'add' END AS op
    FROM events"""
EVENT_LINES = f"""
    SELECT version, path, size, op FROM ({EVENT_ACTIONS})
    QUALIFY row_number() OVER (PARTITION BY version, path ORDER BY event_id DESC) = 1"""
LIVE_EVENT_FILES = f"""
    SELECT path, size, version FROM (
      SELECT *, row_number() OVER (PARTITION BY path ORDER BY version DESC) AS rn FROM ({EVENT_LINES}))
    WHERE rn = 1 AND op = 'add'"""


def event_file_rows(spark, sf_dir, first=None, last=None) -> DataFrame:
    return replay.file_actions(log.scan_actions(spark, fx.event_log(spark, sf_dir), first, last))


@query(EVENT_LINES)
def log_actions(spark, sf_dir):
    return event_file_rows(spark, sf_dir).select("version", "path", "size", "op")


@query(f"SELECT * FROM ({EVENT_LINES}) WHERE version BETWEEN 2 AND 6")
def log_range(spark, sf_dir):
    return event_file_rows(spark, sf_dir, 2, 6).select("version", "path", "size", "op")


@query(
    f"""SELECT path, max(size) FILTER (WHERE op = 'add') AS size,
               CAST(arg_max(op, version) = 'add' AS BOOLEAN) AS live
        FROM ({EVENT_LINES}) WHERE version >= 3
        GROUP BY path HAVING count(*) FILTER (WHERE op = 'add') > 0"""
)
def manifest_files(spark, sf_dir):
    actions = log.scan_actions(spark, fx.event_log(spark, sf_dir), 3)
    return manifest.data_files(actions).select("path", "size", "live")


@query(LIVE_EVENT_FILES)
def active_files(spark, sf_dir):
    return replay.active_files(event_file_rows(spark, sf_dir)).select("path", "size", "version")


@query(
    f"""SELECT count(*) AS num_files, CAST(sum(size) AS BIGINT) AS size_in_bytes, max(version) AS version
        FROM ({LIVE_EVENT_FILES})"""
)
def table_detail(spark, sf_dir):
    return replay.table_detail(replay.active_files(event_file_rows(spark, sf_dir)))


KEPT_EVENTS = "SELECT event_id AS version FROM events WHERE NOT (event_type = 'error' AND value > 60)"


def kept_events(spark, sf_dir) -> DataFrame:
    events = fx.given(spark, sf_dir, "events")
    return events.where("NOT (event_type = 'error' AND value > 60)").select(F.col("event_id").alias("version"))


@query(
    f"""WITH kept AS ({KEPT_EVENTS}),
             runs AS (SELECT version, version - row_number() OVER (ORDER BY version) AS island FROM kept),
             ends AS (SELECT island, max(version) AS latest FROM runs GROUP BY island),
             starts AS (SELECT unnest([0, 100, 700, 900]) AS from_version)
        SELECT CAST(s.from_version AS BIGINT) AS from_version, e.latest
        FROM starts s LEFT JOIN runs r ON r.version = s.from_version LEFT JOIN ends e USING (island)"""
)
def latest_version(spark, sf_dir):
    return history.latest_version(kept_events(spark, sf_dir), (0, 100, 700, 900))


@query(
    f"""SELECT range AS version FROM range((SELECT max(event_id) + 1 FROM events))
        WHERE range NOT IN ({KEPT_EVENTS})"""
)
def missing_versions(spark, sf_dir):
    last = fx.given(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return history.missing_versions(kept_events(spark, sf_dir), last + 1)


LOG_LISTING = f"""
    SELECT version, 'commit' AS kind, CAST(NULL AS INTEGER) AS parts FROM ({KEPT_EVENTS})
    UNION ALL
    SELECT event_id // 3 AS version, 'checkpoint' AS kind, 3 AS parts FROM events
    WHERE event_type <> 'view' AND event_id >= 300"""


def listing_of_events(spark, sf_dir) -> DataFrame:
    """A log listing made from events: commits with gaps, checkpoints in three parts."""
    checkpoints = fx.given(spark, sf_dir, "events").where("event_type <> 'view' AND event_id >= 300")
    commits = kept_events(spark, sf_dir).select(
        "version", F.lit("commit").alias("kind"), F.lit(None).cast("int").alias("parts")
    )
    return commits.unionByName(
        checkpoints.select(
            F.floor(F.col("event_id") / 3).alias("version"),
            F.lit("checkpoint").alias("kind"),
            F.lit(3).alias("parts"),
        )
    )


@query(
    f"""WITH files AS ({LOG_LISTING}), starts AS (SELECT unnest([0, 5, 99, 600]) AS from_version)
        SELECT CAST(from_version AS BIGINT) AS from_version,
               from_version = 0
               OR EXISTS (SELECT 1 FROM files WHERE kind = 'checkpoint' AND version <= from_version
                         GROUP BY version, parts HAVING count(*) = parts)
               OR (SELECT count(DISTINCT version) FROM files
                   WHERE kind = 'commit' AND version < from_version) = from_version AS history_ok
        FROM starts"""
)
def history_ok(spark, sf_dir):
    return history.history_ok(listing_of_events(spark, sf_dir), (0, 5, 99, 600))


@query(
    f"""SELECT version, parts FROM ({LOG_LISTING}) WHERE kind = 'checkpoint'
        GROUP BY version, parts HAVING count(*) = parts ORDER BY version DESC LIMIT 1"""
)
def newest_checkpoint(spark, sf_dir):
    return history.newest_checkpoint(listing_of_events(spark, sf_dir))


@query(
    """WITH RECURSIVE files AS (
         SELECT event_id // 5000 AS shard, event_id % 1000 AS size,
                row_number() OVER (PARTITION BY event_id // 5000 ORDER BY event_id) AS n
         FROM events),
       packed AS (
         SELECT shard, n, size, CAST(0 AS BIGINT) AS local_part, size AS filled FROM files WHERE n = 1
         UNION ALL
         SELECT f.shard, f.n, f.size,
                p.local_part + CASE WHEN p.filled + f.size > 5000 THEN 1 ELSE 0 END,
                CASE WHEN p.filled + f.size > 5000 THEN f.size ELSE p.filled + f.size END
         FROM packed p JOIN files f ON f.shard = p.shard AND f.n = p.n + 1)
       SELECT shard, local_part, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS bytes
       FROM packed GROUP BY shard, local_part"""
)
def bundle_packing(spark, sf_dir):
    files = fx.event_changes(spark, sf_dir).select(F.col("version").alias("position"), "size")
    shard = F.floor(F.col("position") / 5000)
    return packing.part_sizes(packing.next_fit(files, 5000, shard, order="position"))


Z85 = paths.Z85_ALPHABET
Z85_WORD = "lpad(lower(to_hex({})), 8, '0')"


def _word(g: int) -> str:
    digits = " + ".join(
        f"(strpos('{Z85}', substr(code, {g * 5 + i + 1}, 1)) - 1) * {85 ** (4 - i)}" for i in range(5)
    )
    return Z85_WORD.format(f"CAST({digits} AS BIGINT)")


@query(
    f"""WITH coded AS (
          SELECT user_id, event_type, event_id % 4 AS kind, substr(md5(CAST(user_id AS VARCHAR)), 1, 20) AS code
          FROM events WHERE event_id % 4 IN (1, 2)),
        named AS (
          SELECT event_type,
                 CASE WHEN kind = 2 THEN 'dv ' || user_id || '.bin' ELSE
                   'ab/deletion_vector_' || regexp_replace(
                     {" || ".join(_word(g) for g in range(4))},
                     '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\\1-\\2-\\3-\\4-\\5') || '.bin' END AS path
          FROM coded)
        SELECT path, CAST(49 AS BIGINT) AS size, bool_or(event_type <> 'error') AS live
        FROM named GROUP BY path"""
)
def manifest_dvs(spark, sf_dir):
    actions = log.scan_actions(spark, fx.vector_log(spark, sf_dir))
    return manifest.vector_manifest(actions).select("path", "size", "live")


@query(
    f"""SELECT path, size FROM ({LIVE_EVENT_FILES})
        WHERE path NOT IN (SELECT 'part ' || c_custkey || '+.parquet' FROM customer WHERE c_acctbal > 0)"""
)
def manifest_missing(spark, sf_dir):
    live = replay.active_files(event_file_rows(spark, sf_dir)).select("path", "size")
    name = F.concat(F.lit("part "), F.col("c_custkey"), F.lit("+.parquet"))
    there = fx.given(spark, sf_dir, "customer").where("c_acctbal > 0").select(name.alias("path"))
    return manifest.missing(live, there)


# --- files --------------------------------------------------------------------


@query(
    f"""SELECT DISTINCT lpad(CAST(version AS VARCHAR), 20, '0') || '.json' AS name FROM ({EVENT_ACTIONS})
        WHERE version % 2 = 0"""
)
def list_files(spark, sf_dir):
    location = log.log_dir(fx.event_log(spark, sf_dir))
    return manifest.list_files(spark, location, "[0-9]*[02468]\\.json").select("name")


@query(f"SELECT 'json' AS extension, count(DISTINCT version) AS n_files FROM ({EVENT_ACTIONS})")
def files_by_extension(spark, sf_dir):
    files = manifest.list_files(spark, fx.event_log(spark, sf_dir), recursive=True)
    return manifest.files_by_extension(files).select("extension", "n_files")


@query(f"SELECT version, count(*) AS n_lines FROM ({EVENT_LINES}) GROUP BY version")
def read_text_files(spark, sf_dir):
    texts = text.read_texts(spark, log.log_dir(fx.event_log(spark, sf_dir)), "*.json")
    lines = F.size(F.split(F.rtrim(F.col("text"), F.lit("\n")), "\n")).cast("bigint")
    return texts.select(paths.version_of(F.col("name")).alias("version"), lines.alias("n_lines"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_source(spark, sf_dir):
    customer = fx.given(spark, sf_dir, "customer")
    location = storage.scratch_dir(spark, "csv")
    customer.write.option("header", True).csv(location)
    return text.read_csv(spark, location, customer.schema)


# --- bundles ------------------------------------------------------------------


@query(
    """SELECT '_delta_log/' || lpad(CAST(range AS VARCHAR), 20, '0') || '.json' AS entry,
              'commit' AS kind, range AS version, true AS safe FROM range(6)"""
)
def bundle_entries(spark, sf_dir):
    entries = bundle.bundle_entries(spark, fx.history(spark, sf_dir)["full"])
    return entries.where("kind <> 'data'").select("entry", "kind", "version", "safe")


def rows_of(spark, root: str, files: DataFrame) -> DataFrame:
    """Rows of the live files of a table whose path is among `files`."""
    snap = table.snapshot(spark, root)
    live = snap.files.join(files.select("path").distinct(), "path", "left_semi")
    return table.read_files(snap, storage.materialize(live, "live"))


@query()
def bundle_data_entries(spark, sf_dir):
    made = fx.history(spark, sf_dir)
    entries = bundle.data_entries(bundle.bundle_entries(spark, made["full"]))
    return rows_of(spark, made["table"], entries.select(F.col("entry").alias("path")))


@query(
    """SELECT 'orders_history' AS "tableName", CAST(3 AS BIGINT) AS "fromVersion", CAST(5 AS BIGINT) AS "toVersion",
              true AS stamped"""
)
def bundle_metadata(spark, sf_dir):
    described = bundle.bundle_metadata(spark, fx.history(spark, sf_dir)["from_3"])
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.to_timestamp("exportTimestamp"))
    stamped = F.col("exportTimestamp").rlike("^[0-9-]{10}T[0-9:]{8}[.][0-9]{3}Z$") & age.between(0, 86_400)
    return described.select("tableName", "fromVersion", "toVersion", stamped.alias("stamped"))


@query(
    """SELECT CAST(6 AS BIGINT) AS log_files, CAST(0 AS BIGINT) AS unsafe_entries,
              CAST(5 AS BIGINT) AS highest_version, true AS versions_ok"""
)
def bundle_versions_ok(spark, sf_dir):
    checked = bundle.bundle_check(bundle.bundle_entries(spark, fx.history(spark, sf_dir)["full"]), 5)
    return checked.select("log_files", "unsafe_entries", "highest_version", "versions_ok")


# --- reads and writes of H ------------------------------------------------------

BASE = "o_orderkey, o_custkey, {status} AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
UPDATED = "CASE WHEN o_orderkey % 10 = 0 AND o_orderkey % 3 < 2 THEN 'U' ELSE o_orderstatus END"
LABEL = ", CASE WHEN o_orderkey % 5 = 0 THEN 'A' ELSE 'C' END AS batch"
HISTORY_SQL = [
    f"SELECT {BASE.format(status='o_orderstatus')} FROM orders WHERE o_orderkey % 3 = 0",
    f"SELECT {BASE.format(status='o_orderstatus')} FROM orders WHERE o_orderkey % 3 < 2",
    f"SELECT {BASE.format(status=UPDATED)} FROM orders WHERE o_orderkey % 3 < 2",
    f"SELECT {BASE.format(status=UPDATED)}{LABEL} FROM orders WHERE o_orderkey % 3 < 2",
    f"SELECT {BASE.format(status=UPDATED)}{LABEL} FROM orders",
    f"SELECT {BASE.format(status=UPDATED)}{LABEL} FROM orders WHERE o_orderkey % 50 <> 0",
]
FINAL = HISTORY_SQL[5]
SQL["bundle_data_entries"] = FINAL


def _at_version(name: str, version: int) -> None:
    def build(spark, sf_dir):
        return table.read_table(spark, fx.history(spark, sf_dir)["table"], version)

    build.__name__ = name
    query(HISTORY_SQL[version])(build)


for _name, _version in (
    ("table_overwrite", 0),
    ("table_append", 1),
    ("table_update", 2),
    ("schema_overwrite", 3),
    ("table_read_as_of", 4),
    ("table_delete", 5),
):
    _at_version(_name, _version)


@query(FINAL)
def table_read(spark, sf_dir):
    return table.read_table(spark, fx.history(spark, sf_dir)["table"])


# --- shipping of H ----------------------------------------------------------------


CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


@query(
    f"""SELECT CAST(6 AS BIGINT) AS commits, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS wrong_sizes,
               count(*) AS live_rows, CAST(sum({CENTS}) AS BIGINT) AS live_cents FROM ({FINAL})"""
)
def export_full(spark, sf_dir):
    """What was shipped, against the log's sizes; rows of the live files that arrived."""
    source = fx.history(spark, sf_dir)["table"]
    shipped = export.export(spark, source, storage.scratch_dir(spark, "full"))
    logged = manifest.data_files(log.scan_actions(spark, source)).select("path", F.col("size").alias("logged"))
    of_log = shipped.join(logged, "path", "left").agg(
        F.count_if(F.col("kind") == "commit").alias("commits"),
        F.count_if(F.col("status") != "copied").alias("missing"),
        F.count_if((F.col("kind") == "data") & ~F.col("size").eqNullSafe(F.col("logged"))).alias("wrong_sizes"),
    )
    live = rows_of(spark, source, shipped.where("kind = 'data' AND live")).agg(
        F.count("*").alias("live_rows"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("live_cents")
    )
    return of_log.crossJoin(live)  # one row each


@fx.once
def new_rounds(spark, sf_dir) -> tuple[str, DataFrame]:
    """A table at version 2, then an export from 3 on applied to it: location and what that shipped."""
    made, target = fx.history(spark, sf_dir), storage.scratch_dir(spark, "incremental")
    for first in ("from_0", "from_1"):
        apply.import_bundle(spark, made[first], target, "error" if first == "from_0" else "apply")
    export.export(spark, made["table"], target + "_bundle", 3)
    return target, apply.import_bundle(spark, target + "_bundle.zip", target, "apply")


@query("SELECT 'commit' AS kind, range AS version, 'copied' AS status FROM range(3, 6)")
def export_incremental_files(spark, sf_dir):
    """What an incremental export ships of the log, and any data file that the target had already."""
    _, shipped = new_rounds(spark, sf_dir)
    version = paths.version_of(paths.base_name(F.col("path")))
    shipped = shipped.where("kind <> 'data' OR status <> 'copied'")
    return shipped.select("kind", version.alias("version"), "status")


@query(FINAL)
def export_incremental(spark, sf_dir):
    target, _ = new_rounds(spark, sf_dir)
    return table.read_table(spark, target)


@query(FINAL)
def import_new(spark, sf_dir):
    target = storage.scratch_dir(spark, "new")
    apply.import_bundle(spark, fx.history(spark, sf_dir)["full"], target)
    return table.read_table(spark, target)


@query(FINAL)
def import_overwrite(spark, sf_dir):
    target = storage.scratch_dir(spark, "replaced")
    customer = fx.given(spark, sf_dir, "customer")
    for remainder in range(3):
        write.write_table(customer.where(F.col("c_custkey") % 3 == remainder), target)
    apply.import_bundle(spark, fx.history(spark, sf_dir)["full"], target, "overwrite")
    return table.read_table(spark, target)


@query("SELECT * FROM customer")
def import_refused(spark, sf_dir):
    """A target that exists is refused and stays as it was; without the refusal there are no rows."""
    target = storage.scratch_dir(spark, "refused")
    write.write_table(fx.given(spark, sf_dir, "customer"), target)
    try:
        apply.import_bundle(spark, fx.history(spark, sf_dir)["full"], target)
    except storage.ShippingError:
        return table.read_table(spark, target)
    return table.read_table(spark, target).limit(0)


@query(FINAL)
def import_resumed(spark, sf_dir):
    """A ship that failed for want of one file, called again: only that file is copied, else there are no rows."""
    source, target = storage.scratch_dir(spark, "resumed-source"), storage.scratch_dir(spark, "resumed")
    apply.ship(spark, fx.history(spark, sf_dir)["table"], source)
    lost = table.snapshot(spark, source).files.agg(F.min("path")).first()[0]
    storage.move_new(spark, f"{source}/{lost}", f"{source}/_aside")
    try:
        apply.ship(spark, source, target)
    except storage.ShippingError:
        storage.move_new(spark, f"{source}/_aside", f"{source}/{lost}")
    report = apply.ship(spark, source, target)
    as_expected = report.where("status = 'copied'").agg(F.count("*"), F.min("path")).first() == (1, lost)
    rows = table.read_table(spark, target)
    return rows if as_expected else rows.limit(0)


@query(FINAL)
def import_merge(spark, sf_dir):
    made, target = fx.history(spark, sf_dir), storage.scratch_dir(spark, "merged")
    apply.import_bundle(spark, made["from_0"], target)
    apply.import_bundle(spark, made["full"], target, "apply")
    return table.read_table(spark, target)


@query(HISTORY_SQL[0])
def import_merge_present(spark, sf_dir):
    """Rows of the files that a full bundle finds at a target at version 0: those are not copied again."""
    made, target = fx.history(spark, sf_dir), storage.scratch_dir(spark, "present")
    apply.import_bundle(spark, made["from_0"], target)
    first = table.snapshot(spark, target)
    merged = apply.import_bundle(spark, made["full"], target, "apply")
    present = merged.where("kind = 'data' AND status = 'present'").select("path")
    return table.read_files(first, first.files.join(present, "path", "left_semi"))


@query(
    " UNION ALL ".join(
        f"SELECT CAST({v} AS BIGINT) AS version, count(*) AS n_rows FROM ({HISTORY_SQL[v]})" for v in (0, 2, 5)
    )
)
def incremental_rounds(spark, sf_dir):
    made, target = fx.history(spark, sf_dir), storage.scratch_dir(spark, "rounds")
    rounds = []
    for first, version in (("from_0", 0), ("from_1", 2), ("from_3", 5)):
        apply.import_bundle(spark, made[first], target, "error" if version == 0 else "apply")
        rows = table.read_table(spark, target)
        counted = rows.agg(F.count("*").alias("n_rows"))
        rounds.append(counted.select(F.lit(version).cast("bigint").alias("version"), "n_rows"))
    return write.union_actions(rounds)


@query(
    f"""SELECT CAST(5 AS BIGINT) AS version, CAST(0 AS BIGINT) AS missing_files, CAST(0 AS BIGINT) AS wrong_sizes,
               true AS all_bytes, count(*) AS live_rows FROM ({FINAL})"""
)
def verify_import(spark, sf_dir):
    """The report, its bytes against the log's, and the rows of the files that it verified."""
    target = fx.imported(spark, sf_dir)
    report = apply.verify_import(spark, target, 5)
    detail = replay.table_detail(table.snapshot(spark, target).files).first()
    rows = table.read_table(spark, target).agg(F.count("*").alias("live_rows"))
    all_bytes = (F.col("live_files") == detail.num_files) & (F.col("live_bytes") == detail.size_in_bytes)
    return report.crossJoin(rows).select(  # one row each
        "version", "missing_files", "wrong_sizes", all_bytes.alias("all_bytes"), "live_rows"
    )


@query(FINAL)
def stream_incremental(spark, sf_dir):
    made, target = fx.history(spark, sf_dir), storage.scratch_dir(spark, "streamed")
    apply.import_bundle(spark, made["from_0"], target)
    ship_stream(spark, made["table"], target, storage.scratch_dir(spark, "stream-state")).awaitTermination()
    return table.read_table(spark, target)


@query(FINAL)
def checkpoint_roundtrip(spark, sf_dir):
    return table.read_table(spark, fx.checkpointed(spark, sf_dir)["shipped"])


@query(FINAL)
def snapshot_from_checkpoint(spark, sf_dir):
    return table.read_table(spark, fx.checkpointed(spark, sf_dir)["tail"])


@query(
    """SELECT 'commit' AS kind, range AS version, true AS shipped FROM range(17)
       UNION ALL SELECT 'checkpoint', range, true FROM range(5, 16, 5)"""
)
def checkpoint_files(spark, sf_dir):
    """Commits and checkpoints of seventeen commits, and whether the copy has them with the same size."""
    made = fx.many_commits(spark, sf_dir)
    ours, theirs = (log.list_log(spark, made[side]).where("kind IN ('commit', 'checkpoint')") for side in ("source", "target"))
    both = ours.join(theirs.select("name", F.col("size").alias("arrived")), "name", "left")
    return both.select("kind", "version", F.col("size").eqNullSafe(F.col("arrived")).alias("shipped"))


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
              CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS INTEGER) AS changed,
              o_orderkey % 25 <> 5 AS is_active, CAST(o_orderkey % 10 * 7 AS INTEGER) AS score
       FROM orders WHERE o_orderkey % 50 <> 0"""
)
def checkpoint_rows(spark, sf_dir):
    return table.read_table(spark, fx.many_commits(spark, sf_dir)["target"])


# --- packing and chains ------------------------------------------------------------

PART_LIMIT = 1_000_000


@query(
    f"""WITH RECURSIVE files AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY o_orderkey) AS i, CAST(floor(o_totalprice) AS BIGINT) AS size,
                 sum(CAST(floor(o_totalprice) AS BIGINT)) OVER (ORDER BY o_orderkey) AS upto FROM orders
        ), following AS MATERIALIZED (
          SELECT a.i, min(b.i) AS next FROM files a LEFT JOIN files b ON b.i > a.i AND b.upto - (a.upto - a.size) > {PART_LIMIT} GROUP BY a.i
        ), starts AS (
          SELECT CAST(0 AS BIGINT) AS part, CAST(1 AS BIGINT) AS i
          UNION ALL SELECT s.part + 1, f.next FROM starts s JOIN following f ON f.i = s.i WHERE f.next IS NOT NULL
        ), ends AS (SELECT part, i, lead(i) OVER (ORDER BY part) AS stop FROM starts)
        SELECT e.part, count(*) AS n_files, CAST(sum(f.size) AS BIGINT) AS bytes
        FROM ends e JOIN files f ON f.i >= e.i AND (f.i < e.stop OR e.stop IS NULL) GROUP BY e.part"""
)
def packing_next_fit(spark, sf_dir):
    """Parts of one walk over all orders as files, found block by block."""
    orders = fx.given(spark, sf_dir, "orders")
    files = orders.select(F.lpad("o_orderkey", 12, "0").alias("path"), F.floor("o_totalprice").cast("bigint").alias("size"))
    packed = packing.global_next_fit(files, PART_LIMIT, files.count(), per_block=500)
    return packed.groupBy("part").agg(F.count("*").alias("n_files"), F.sum("size").alias("bytes"))


@query(
    """WITH RECURSIVE bundles AS (
         SELECT l_orderkey % 1000 AS first, l_orderkey % 1000 + CAST(l_quantity AS BIGINT) AS last FROM lineitem
       ), best AS MATERIALIZED (
         SELECT v - 1 AS after, max(last) AS reaches FROM range(1200) r(v) JOIN bundles ON first <= v GROUP BY v
       ), chain AS (
         SELECT CAST(0 AS BIGINT) AS step, CAST(-1 AS BIGINT) AS reached
         UNION ALL SELECT step + 1, reaches FROM chain JOIN best ON after = reached WHERE reaches > reached
       )
       SELECT step, reached FROM chain WHERE step > 0"""
)
def bundle_chain(spark, sf_dir):
    """The shortest chain of version ranges, made from line items, that has no gap."""
    first = F.col("l_orderkey") % 1000
    bundles = fx.given(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("bundle"),
        first.alias("from_version"),
        (first + F.col("l_quantity").cast("bigint")).alias("to_version"),
    )
    steps = [(i, last) for i, (_, _, last) in enumerate(chain.shortest_chain(bundles, -1), 1)]
    return spark.createDataFrame(steps, "step bigint, reached bigint")


# --- file skipping ---------------------------------------------------------------


@query("SELECT * FROM lineitem WHERE l_orderkey BETWEEN 100 AND 250 OR l_orderkey = 777")
def skipping_read(spark, sf_dir):
    """Rows of the files that statistics leave; without rows unless most files were not opened."""
    rows = skipping.read_where(spark, fx.ranged(spark, sf_dir), "l_orderkey BETWEEN 100 AND 250 OR l_orderkey = 777")
    files = table.snapshot(spark, fx.ranged(spark, sf_dir)).files.count()
    return rows if 2 * len(rows.inputFiles()) <= files else rows.limit(0)


@query(
    """SELECT count(*) AS n_rows, min(l_orderkey) AS least_key, max(l_orderkey) AS most_key, min(l_returnflag) AS least_flag,
              max(l_linestatus) AS most_status, CAST(count(*) - count(l_suppkey) AS BIGINT) AS null_suppliers FROM lineitem"""
)
def skipping_index(spark, sf_dir):
    """The interval index, summed up over all files: what the log says of the table without opening a file."""
    index = skipping.interval_index(table.snapshot(spark, fx.ranged(spark, sf_dir)))
    return index.agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("least.l_orderkey").alias("least_key"),
        F.max("most.l_orderkey").alias("most_key"),
        F.min("least.l_returnflag").alias("least_flag"),
        F.max("most.l_linestatus").alias("most_status"),
        F.sum("nulls.l_suppkey").alias("null_suppliers"),
    )


# --- comparison -------------------------------------------------------------------


def row_text_sql(**columns):
    """The text behind a checksum, for columns given as name and SQL text."""
    parts = [f"'{name}=' || length({text}) || ':' || {text}" for name, text in sorted(columns.items())]
    return f"concat_ws(',', {', '.join(parts)})"


ROW_NUMBER = "CAST('0x' || substr(md5({}), 1, 15) AS HUGEINT)"
ORDER_NUMBER = ROW_NUMBER.format(
    row_text_sql(
        **{
            c: f"CAST({c} AS VARCHAR)"
            for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "batch")
        }
    )
)


FIRST_NUMBER = ROW_NUMBER.format(
    row_text_sql(
        **{
            c: f"CAST({c} AS VARCHAR)"
            for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        }
    )
)


@query(
    f"""SELECT count(*) AS n_rows, CAST(sum({ORDER_NUMBER}) AS DECIMAL(38,0)) AS checksum FROM ({FINAL})"""
)
def table_checksum(spark, sf_dir):
    return checksum.table_checksum(table.read_table(spark, fx.imported(spark, sf_dir))).drop("hash_sum")


@query(
    " UNION ALL ".join(
        f"""SELECT CAST({v} AS BIGINT) AS version, count(*) AS n_rows, CAST(sum({number}) AS DECIMAL(38,0)) AS checksum,
                   true AS only_new FROM ({HISTORY_SQL[v]})"""
        for v, number in ((0, FIRST_NUMBER), (2, FIRST_NUMBER), (5, ORDER_NUMBER))
    )
)
def incremental_checksum(spark, sf_dir):
    """The checksum after every round of a shipment; each round reads the files that it brought, and no others."""
    made, target = fx.history(spark, sf_dir), storage.scratch_dir(spark, "checksums")
    rounds, read = [], 0
    for first, mode in (("from_0", "error"), ("from_1", "apply"), ("from_3", "apply")):
        shipped = apply.import_bundle(spark, made[first], target, mode)
        live = table.snapshot(spark, target).files
        brought = live.join(shipped.where("status = 'copied'").select("path"), "path", "left_semi").count()
        total = fingerprints.version_checksum(spark, target)
        rounds.append(total.select("version", "n_rows", "checksum", (F.col("files_read") == brought).alias("only_new")))
    return write.union_actions(rounds)


@query(
    f"""SELECT count(*) AS source_n_rows, count(*) AS target_n_rows, CAST(5 AS BIGINT) AS source_version,
               CAST(5 AS BIGINT) AS target_version, true AS same_schema, true AS equal FROM ({FINAL})"""
)
def table_compare(spark, sf_dir):
    result = compare.compare_tables(spark, fx.history(spark, sf_dir)["table"], fx.imported(spark, sf_dir))
    return result.select(
        "source_n_rows", "target_n_rows", "source_version", "target_version", "same_schema", "equal"
    )


@query(
    f"""SELECT *, CAST(1 AS BIGINT) AS n_source, CAST(0 AS BIGINT) AS n_target
        FROM ({HISTORY_SQL[4]}) WHERE o_orderkey % 50 = 0"""
)
def table_diff(spark, sf_dir):
    source = fx.history(spark, sf_dir)["table"]
    return compare.diff_rows(table.read_table(spark, source, 4), table.read_table(spark, fx.imported(spark, sf_dir)))


# --- P ------------------------------------------------------------------------------

PARTITIONED = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) = 1996 AND o_orderkey % 7 = 0
                THEN 1.5 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_year
    FROM orders"""
AFTER_DROP = "NOT (o_orderstatus = 'O' AND o_year = 1997)"


@query(
    """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders"""
)
def partitioned_write(spark, sf_dir):
    return table.read_table(spark, fx.partitioned(spark, sf_dir)["source"], 1)


@query(f"SELECT * FROM ({PARTITIONED}) WHERE o_orderstatus = 'F' AND o_year = 1996")
def partition_prune(spark, sf_dir):
    source = fx.partitioned(spark, sf_dir)["source"]
    return table.read_table(spark, source, partitions="o_orderstatus = 'F' AND o_year = 1996")


@query(f"SELECT * FROM ({PARTITIONED}) WHERE {AFTER_DROP}")
def partition_delete(spark, sf_dir):
    return table.read_table(spark, fx.partitioned(spark, sf_dir)["source"])


@query(
    f"""SELECT o_orderstatus, o_year, count(*) AS n_rows FROM ({PARTITIONED}) WHERE {AFTER_DROP}
        GROUP BY ALL"""
)
def partition_counts(spark, sf_dir):
    return table.partition_counts(table.snapshot(spark, fx.partitioned(spark, sf_dir)["source"]))


@query(f"SELECT * FROM ({PARTITIONED}) WHERE {AFTER_DROP}")
def partitioned_rounds(spark, sf_dir):
    return table.read_table(spark, fx.partitioned(spark, sf_dir)["target"])


# --- other writes ---------------------------------------------------------------------


@query(
    """SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
       FROM customer
       UNION ALL
       SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment FROM customer WHERE c_custkey % 2 = 0"""
)
def merge_upsert(spark, sf_dir):
    customer = fx.given(spark, sf_dir, "customer")
    target = storage.scratch_dir(spark, "upsert")
    write.write_table(customer, target)
    changed = customer.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    added = changed.withColumn("c_custkey", -1 - F.col("c_custkey"))
    dml.merge(spark, target, changed.unionByName(added), "c_custkey")
    return table.read_table(spark, target)


@query(
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal,
              CASE WHEN s_suppkey % 2 = 1 THEN s_suppkey * 10 END AS rating FROM supplier"""
)
def schema_evolve_append(spark, sf_dir):
    supplier = fx.given(spark, sf_dir, "supplier")
    target = storage.scratch_dir(spark, "evolved")
    write.write_table(supplier.where("s_suppkey % 2 = 0"), target)
    rated = supplier.where("s_suppkey % 2 = 1").withColumn("rating", F.col("s_suppkey") * 10)
    write.write_table(rated, target, merge_schema=True)
    return table.read_table(spark, target)


@query(
    """SELECT * EXCLUDE (n) FROM (
         SELECT *, CAST(o_orderkey % 64 AS INTEGER) AS bucket,
                row_number() OVER (PARTITION BY o_orderkey % 64 ORDER BY o_orderkey) - 1 AS n FROM orders)
       WHERE NOT (bucket % 4 = 1 AND n BETWEEN 10 AND 39) AND NOT (bucket % 4 = 2 AND n IN (0, 2, 5, 100))
         AND NOT (bucket % 4 = 3 AND n % 2 = 1 AND n < 65536)"""
)
def dv_filtered_read(spark, sf_dir):
    return table.read_table(spark, fx.marked(spark, sf_dir))


# --- functions --------------------------------------------------------------------------


@query(
    """SELECT page_id,
              lpad(CAST(page_id AS VARCHAR), 20, '0') || '.json' AS commit_name,
              lpad(CAST(page_id AS VARCHAR), 20, '0') || '.checkpoint.parquet' AS checkpoint_name,
              page_id AS version,
              CAST(NULL AS BIGINT) AS no_version,
              regexp_extract(url, '^[a-z0-9]+://([^/]+)', 1) AS bucket,
              regexp_extract(url, '^[a-z0-9]+://[^/]+/?(.*)$', 1) AS "key",
              regexp_extract(url, '[^/]*$') AS base,
              CASE WHEN regexp_extract(url, '[^/]*$') LIKE '%.%'
                   THEN regexp_extract(url, '[^.]*$') ELSE '' END AS extension,
              url LIKE 'https%' AS is_https,
              url_decode(replace(replace(url, '?', '%3F'), '=', '%3D')) AS decoded,
              url AS roundtrip,
              nullif(regexp_extract(url, '#(.*)$', 1), '') AS fragment,
              'root/' || page_id || '/x' AS joined,
              regexp_extract(rtrim(url, '/'), '[^/]*$') AS last_part,
              lower(url) AS lowered
       FROM pages"""
)
def path_functions(spark, sf_dir):
    url, page = F.col("url"), F.col("page_id")
    coded = F.replace(F.replace(url, F.lit("?"), F.lit("%3F")), F.lit("="), F.lit("%3D"))
    return fx.given(spark, sf_dir, "pages").select(
        "page_id",
        paths.commit_name(page).alias("commit_name"),
        paths.checkpoint_name(page).alias("checkpoint_name"),
        paths.version_of(paths.commit_name(page)).alias("version"),
        paths.version_of(url).alias("no_version"),
        paths.bucket_of(url).alias("bucket"),
        paths.key_of(url).alias("key"),
        paths.base_name(url).alias("base"),
        paths.extension(url).alias("extension"),
        F.startswith(url, F.lit("https")).alias("is_https"),
        paths.decode_path(coded).alias("decoded"),
        paths.decode_path(paths.encode_path(url)).alias("roundtrip"),
        paths.blank_to_null(F.regexp_extract(url, "#(.*)$", 1)).alias("fragment"),
        paths.join_path("root/", page.cast("string"), "x").alias("joined"),
        paths.last_segment(url).alias("last_part"),
        F.lower(url).alias("lowered"),
    )


@query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
              '{"add":{"path":"' || user_id || '","size":' || CAST(json_extract(props, '$.k') AS BIGINT) || '}}' AS line
       FROM events"""
)
def json_functions(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"]
    add = F.struct(F.col("user_id").cast("string").alias("path"), k.alias("size"))
    return fx.given(spark, sf_dir, "events").select(
        "event_id", k.alias("k"), F.to_json(F.struct(add.alias("add"))).alias("line")
    )


@query(
    """SELECT o_orderkey, 'value_' || o_orderkey AS value,
              CASE WHEN o_orderkey % 10 = 0 THEN 'A' WHEN o_orderkey % 5 = 0 THEN 'B' ELSE 'C' END AS category,
              CASE year(o_orderdate) WHEN 1995 THEN 'old' WHEN 1998 THEN 'new' ELSE 'mid' END AS era,
              CAST(o_orderkey % 12 + 1 AS INTEGER) AS month
       FROM orders"""
)
def derived_columns(spark, sf_dir):
    key = F.col("o_orderkey")
    era = F.expr("CASE year(o_orderdate) WHEN 1995 THEN 'old' WHEN 1998 THEN 'new' ELSE 'mid' END")
    return fx.given(spark, sf_dir, "orders").select(
        key,
        F.concat(F.lit("value_"), key).alias("value"),
        F.when(key % 10 == 0, "A").when(key % 5 == 0, "B").otherwise("C").alias("category"),
        era.alias("era"),
        (key % 12 + 1).cast("int").alias("month"),
    )
