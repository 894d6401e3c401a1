import json
import os
import shutil
import zipfile

import pytest
import vectors
from pyspark.sql import functions as F

from lakeship import storage
from lakeship.operators import compare, dml, manifest, write
from lakeship.plans import apply, export
from lakeship.sources import bundle, log, table
from lakeship.storage import ShippingError
from lakeship.streaming.ship import ship_stream


def numbers(spark, first, last):
    return spark.range(first, last).toDF("id").withColumn("value", F.concat(F.lit("v"), "id"))


def build(spark, root, versions=3, **options):
    for v in range(versions):
        write.write_table(numbers(spark, v * 10, v * 10 + 10).repartition(2), root, **options)
    return root


def commit_path(root, version):
    return f"{root}/_delta_log/{version:020d}.json"


def edit_commit(root, version, change):
    """Rewrite a commit file by hand (with its local checksum file)."""
    path = commit_path(root, version)
    with open(path) as old:
        lines = old.read().splitlines()
    os.remove(os.path.join(os.path.dirname(path), f".{version:020d}.json.crc"))
    with open(path, "w") as new:
        new.write("\n".join(change(lines)) + "\n")


def data_file(root, number=0):
    found = [os.path.join(d, f) for d, _, files in os.walk(root) for f in files if f.endswith(".parquet")]
    return sorted(found)[number]


def same(spark, source, target):
    return compare.compare_tables(spark, source, target).first().equal


@pytest.fixture(scope="module")
def shipped(spark, tmp_path_factory):
    """A table of three versions and its bundles [0..2], in three parts, and [1..2]."""
    root = str(tmp_path_factory.mktemp("shipped"))
    build(spark, f"{root}/numbers")
    export.export(spark, f"{root}/numbers", f"{root}/full", part_bytes=1500)
    export.export(spark, f"{root}/numbers", f"{root}/tail", from_version=1)
    return root


def test_bundle_holds_everything(spark, shipped):
    meta = bundle.bundle_metadata(spark, f"{shipped}/full.zip").first()
    assert (meta.tableName, meta.fromVersion, meta.toVersion, meta.files) == ("numbers", 0, 2, 9)
    assert meta.exportTimestamp.endswith("Z") and meta.parts > 1
    entries = bundle.bundle_entries(spark, f"{shipped}/full.zip")
    assert entries.where("kind = 'commit'").count() == 3
    assert bundle.data_entries(entries).count() == 6
    sizes = entries.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    assert sizes.where("size > 1500 AND n > 1").count() == 0
    with pytest.raises(ShippingError, match="already exists"):
        export.export(spark, f"{shipped}/numbers", f"{shipped}/full.zip")


def test_import_policies(spark, shipped, place):
    target = place()
    done = apply.import_bundle(spark, f"{shipped}/full.zip", target)
    assert done.where("status = 'copied'").count() == 9
    assert same(spark, f"{shipped}/numbers", target)
    assert apply.verify_import(spark, target, 2).first().missing_files == 0
    with pytest.raises(ShippingError, match="already exists"):
        apply.import_bundle(spark, f"{shipped}/full.zip", target)
    with pytest.raises(ValueError):
        apply.import_bundle(spark, f"{shipped}/full.zip", target, "replace")
    again = apply.import_bundle(spark, f"{shipped}/full.zip", target, "apply")
    assert again.where("kind = 'data' AND status <> 'present'").count() == 0
    assert same(spark, f"{shipped}/numbers", target)
    assert not [n for n in os.listdir(target) if n.startswith("_incoming")]


def test_overwrite_replaces_a_longer_table(spark, shipped, place):
    target = build(spark, place(), 5)
    apply.import_bundle(spark, f"{shipped}/full.zip", target, "overwrite")
    assert table.snapshot(spark, target).version == 2
    assert same(spark, f"{shipped}/numbers", target)
    apply.import_bundle(spark, f"{shipped}/full.zip", target, "overwrite")
    assert same(spark, f"{shipped}/numbers", target)


def test_incremental_bundle_cannot_make_a_table(spark, shipped, place):
    with pytest.raises(ShippingError, match="no readable history"):
        apply.import_bundle(spark, f"{shipped}/tail.zip", place())


def test_apply_needs_continuity(spark, shipped, place):
    other = build(spark, place("source"), 5)
    export.export(spark, other, other + "-late", from_version=4)
    target = place()
    apply.import_bundle(spark, f"{shipped}/full.zip", target)
    with pytest.raises(ShippingError, match="leaves a gap"):
        apply.import_bundle(spark, other + "-late.zip", target, "apply")
    export.export(spark, other, other + "-all", from_version=2)
    with pytest.raises(ShippingError, match="has another commit 00000000000000000002.json"):
        apply.import_bundle(spark, other + "-all.zip", target, "apply")
    assert table.snapshot(spark, target).version == 2


def test_one_zip_file(spark, shipped, place):
    out, target = place("one"), place()
    export.export(spark, f"{shipped}/numbers", out, single_file=True)
    with zipfile.ZipFile(out + ".zip") as archive:
        names = archive.namelist()
        assert archive.testzip() is None
    assert names[-1] == "metadata.json" and commit_path("x", 0)[2:] in names
    apply.import_bundle(spark, out + ".zip", target)
    assert same(spark, f"{shipped}/numbers", target)
    with pytest.raises(ShippingError, match="too many for one file"):
        export.export(spark, f"{shipped}/numbers", place(), part_bytes=100, single_file=True)


def foreign_zip(root, out, extra=(), skip=(), metadata=None):
    """A bundle as another tool would make it: directories as entries, all deflated."""
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("_delta_log/", "")
        for directory, _, files in os.walk(root):
            for name in files:
                path = os.path.relpath(os.path.join(directory, name), root)
                if not name.startswith(".") and "_SUCCESS" not in name and path not in skip:
                    archive.write(os.path.join(directory, name), path)
        for name, text in extra:
            archive.writestr(name, text)
        if metadata is None:
            metadata = {"tablePath": "/x/t", "tableName": "t", "fromVersion": 0, "toVersion": 2}
        if metadata != "":
            archive.writestr("metadata.json", metadata if isinstance(metadata, str) else json.dumps(metadata))
    return out


def test_foreign_bundles(spark, shipped, place, tmp_path):
    root = f"{shipped}/numbers"

    def attempt(message, **changes):
        target = place()
        made = foreign_zip(root, str(tmp_path / f"{os.path.basename(target)}.zip"), **changes)
        if message is None:
            apply.import_bundle(spark, made, target)
            return target
        with pytest.raises(ShippingError, match=message):
            apply.import_bundle(spark, made, target)
        assert not os.path.exists(f"{target}/_delta_log")

    assert same(spark, root, attempt(None))
    attempt("would leave the target", extra=[("../evil.txt", "x")])
    attempt("would leave the target", extra=[("/evil.txt", "x")])
    attempt("missing or broken", metadata="")
    attempt("missing or broken", metadata="{not json")
    attempt("missing or broken", metadata="null")
    low = {"tablePath": "/x/t", "tableName": "t", "fromVersion": 0, "toVersion": 1}
    attempt("holds version 2, its metadata ends at 1", metadata=low)
    attempt("live at version 2 but was not shipped", skip=[os.path.relpath(data_file(root), root)])
    logs = [os.path.relpath(commit_path(root, v), root) for v in range(3)]
    attempt("holds no log files", skip=logs)
    attempt("no readable history", skip=logs[:1])
    assert not os.path.exists(tmp_path / "evil.txt") and not os.path.exists("/evil.txt")


def test_applied_shipment_needs_all_its_commits(spark, shipped, place, tmp_path):
    root, target = f"{shipped}/numbers", place()
    first = {"tablePath": "/x/t", "tableName": "t", "fromVersion": 0, "toVersion": 0}
    logs = [os.path.relpath(commit_path(root, v), root) for v in range(3)]
    made = foreign_zip(root, str(tmp_path / "first.zip"), skip=logs[1:], metadata=first)
    apply.import_bundle(spark, made, target)
    gap = foreign_zip(root, str(tmp_path / "gap.zip"), skip=logs[1:2])
    with pytest.raises(ShippingError, match="lacks commits between 1 and 2"):
        apply.import_bundle(spark, gap, target, "apply")
    assert table.snapshot(spark, target).version == 0
    apply.import_bundle(spark, foreign_zip(root, str(tmp_path / "all.zip")), target, "apply")
    assert same(spark, root, target)


def test_incomplete_bundle_directories(spark, shipped, place):
    broken = place("broken") + ".zip"
    shutil.copytree(f"{shipped}/full.zip", broken)
    os.remove(f"{broken}/part-000001.zip")
    with pytest.raises(ShippingError, match="does not have its"):
        apply.import_bundle(spark, broken, place())
    os.remove(f"{broken}/metadata.json")
    with pytest.raises(ShippingError, match="did not finish"):
        apply.import_bundle(spark, broken, place())
    with pytest.raises(ShippingError, match="does not exist"):
        apply.import_bundle(spark, place(), place())


def test_export_refuses_what_it_cannot_ship(spark, place):
    with pytest.raises(ShippingError, match="has no _delta_log"):
        export.export(spark, place(), place())
    root = build(spark, place(), 4)
    with pytest.raises(ShippingError, match="no versions from 7"):
        export.export(spark, root, place(), from_version=7)
    os.remove(commit_path(root, 1))
    with pytest.raises(ShippingError, match="neither all commits"):
        export.export(spark, root, place(), from_version=2)
    export.export(spark, root, root + "-first")
    assert bundle.bundle_metadata(spark, root + "-first.zip").first().toVersion == 0
    edit_commit(root, 2, lambda lines: [*lines, '{"add": {"path": '])
    with pytest.raises(ShippingError, match="neither all commits"):
        export.export(spark, root, place(), from_version=3)


def test_broken_line_and_absolute_path(spark, place):
    root = build(spark, place(), 2)
    edit_commit(root, 1, lambda lines: [*lines, '{"add": {"path": '])
    with pytest.raises(ShippingError, match="does not parse"):
        export.export(spark, root, place())
    root = build(spark, place(), 1)
    outside = '{"add": {"path": "file:///elsewhere/x.parquet", "size": 1, "partitionValues": {}, "dataChange": true}}'
    edit_commit(root, 0, lambda lines: [*lines, outside])
    with pytest.raises(ShippingError, match="absolute location"):
        export.export(spark, root, place())


@pytest.mark.parametrize("single_file", [False, True])
def test_missing_files(spark, place, single_file):
    root = build(spark, place(), 1)
    gone = data_file(root)
    dml.delete(spark, root)
    os.remove(gone)
    reported = export.export(spark, root, root + "-ok", single_file=single_file)
    assert reported.where("status = 'missing'").count() == 1
    apply.import_bundle(spark, root + "-ok.zip", place())
    write.write_table(numbers(spark, 0, 3), root)
    live = {r.path for r in table.snapshot(spark, root).files.select("path").collect()}
    os.remove(f"{root}/{live.pop()}")
    with pytest.raises(ShippingError, match="which does not exist"):
        export.export(spark, root, root + "-bad", single_file=single_file)
    with pytest.raises(ShippingError):
        apply.import_bundle(spark, root + "-bad.zip", place())


def test_conflicting_data_file_and_lost_file(spark, shipped, place):
    target = place()
    apply.import_bundle(spark, f"{shipped}/full.zip", target)
    path = data_file(target)
    with open(path, "ab") as out:
        out.write(b"x")
    with pytest.raises(ShippingError, match="with other content"):
        apply.import_bundle(spark, f"{shipped}/full.zip", target, "apply")
    with pytest.raises(ShippingError, match="with other content"):  # no data file is ever replaced
        apply.import_bundle(spark, f"{shipped}/full.zip", target, "overwrite")
    with open(path, "r+b") as out:
        out.truncate(os.path.getsize(path) - 1)
    apply.import_bundle(spark, f"{shipped}/full.zip", target, "overwrite")
    assert same(spark, f"{shipped}/numbers", target)
    os.remove(data_file(target))
    with pytest.raises(ShippingError, match="lacks 1 of its 6 live files"):
        apply.verify_import(spark, target)
    with pytest.raises(ShippingError, match="expected 9"):
        apply.verify_import(spark, target, 9)


def test_hint_outside_the_range_stays_behind(spark, place):
    root = build(spark, place(), 4, configuration={"delta.checkpointInterval": "2"})
    shipped = export.export(spark, root, root + "-all")
    assert {r.kind for r in shipped.collect()} == {"data", "commit", "checkpoint", "hint"}
    late = export.export(spark, root, root + "-late", from_version=3)
    assert {r.kind for r in late.collect()} == {"data", "commit"}
    target = place()
    apply.import_bundle(spark, root + "-all.zip", target)
    counts = [
        sorted((r.extension, r.n_files) for r in manifest.files_by_extension(log_files(spark, t)).collect())
        for t in (root, target)
    ]
    assert counts[0] == counts[1]
    with pytest.raises(ShippingError, match="live at version 3 but was not shipped|no readable history"):
        apply.import_bundle(spark, root + "-late.zip", place())


def log_files(spark, root):
    return log.list_log(spark, root).select(F.col("name").alias("path"), "size")


def test_partitioned_rounds(spark, place):
    """Three rounds over a table by year and month, with a dropped partition at the end."""

    def rows(first, last, year):
        return numbers(spark, first, last).selectExpr(
            "*", f"{year} AS year", "CAST(id % 12 + 1 AS INT) AS month"
        )

    source, target = place("source"), place("target")
    write.write_table(rows(1, 1000, 2023), source, partition_by=["year", "month"])
    export.export(spark, source, source + "-0")
    apply.import_bundle(spark, source + "-0.zip", target)
    assert same(spark, source, target)
    write.write_table(rows(1000, 2000, 2024), source)
    dml.update(spark, source, "year = 2023 AND month = 1", {"value": "'updated'"})
    export.export(spark, source, source + "-1", from_version=1)
    apply.import_bundle(spark, source + "-1.zip", target, "apply")
    assert same(spark, source, target)
    graded = table.read_table(spark, source).withColumn(
        "data_quality", F.expr("CASE year WHEN 2023 THEN 'high' ELSE 'low' END")
    )
    write.write_table(graded, source, "overwrite", overwrite_schema=True)
    write.write_table(rows(2000, 3000, 2025).withColumn("data_quality", F.lit("new")), source)
    dml.delete(spark, source, "year = 2023 AND month = 12")
    export.export(spark, source, source + "-3", from_version=3)
    apply.import_bundle(spark, source + "-3.zip", target, "apply")
    assert same(spark, source, target)
    snap = table.snapshot(spark, target)
    assert snap.version == 5 and snap.partition_columns == ["year", "month"]
    counts = table.partition_counts(snap).collect()
    assert len(counts) == 35 and sum(r.n_rows for r in counts) == 2916
    assert table.read_files(snap).where("value = 'updated'").count() == 83


def test_streams_ship_what_is_new(spark, place):
    source, target, state = build(spark, place(), 2), place(), place()
    ship_stream(spark, source, target, state).awaitTermination()
    assert same(spark, source, target)
    first = table.snapshot(spark, source).files.select("raw_path").first().raw_path
    vectors.mark(spark, source, {first: [0, 2]})
    dml.update(spark, source, "id = 4", {"value": "'four'"})
    ship_stream(spark, source, target, state, max_files_per_trigger=1).awaitTermination()
    assert same(spark, source, target)
    ship_stream(spark, source, target, place("replayed")).awaitTermination()
    assert table.snapshot(spark, target).version == 3
    assert apply.ship(spark, source, target) is None


def scratch_folders(spark):
    shared = os.path.dirname(storage.scratch_dir(spark)).removeprefix("file:")
    return {name for name in os.listdir(shared) if name.startswith("lakeship")}


def test_scratch_folders_go(spark, place):
    source, target, before = build(spark, place(), 2), place(), scratch_folders(spark)
    dml.update(spark, source, "id = 4", {"value": "'four'"})
    export.export(spark, source, place())
    ship_stream(spark, source, target, place("state")).awaitTermination()
    assert same(spark, source, target)
    twice = numbers(spark, 0, 5).unionByName(numbers(spark, 0, 5))
    with pytest.raises(ShippingError, match="more than one row"):
        dml.merge(spark, source, twice, "id")
    assert scratch_folders(spark) == before
    bundle_of = place()
    export.export(spark, source, bundle_of)
    apply.import_bundle(spark, bundle_of + ".zip", place()).collect()  # its report outlives the call
    assert [name.split("-")[1] for name in scratch_folders(spark) - before] == ["copied"]
    for root in (source, target):
        assert not [name for _, names, _ in os.walk(root) for name in names if name.startswith(("_incoming", "_staged"))]


def test_unsupported_checkpoints_are_named_and_their_hint_stays(spark, place):
    source, target = build(spark, place(), 2), place()
    log_dir = f"{source}/_delta_log"
    name = f"{1:020d}.checkpoint.80a083e8-7026-4e79-81be-64bd76c43a11.parquet"
    shutil.copy(data_file(source), f"{log_dir}/{name}")
    with open(f"{log_dir}/_last_checkpoint", "w") as hint:
        hint.write('{"version": 1, "size": 4}')
    with pytest.warns(UserWarning, match="stay behind"):
        apply.ship(spark, source, target)
    assert same(spark, source, target) and not os.path.exists(f"{target}/_delta_log/_last_checkpoint")


def test_differences_are_found(spark, place):
    left, right = place(), place()
    rows = [(1, None), (2, "b"), (2, "b"), (3, "c")]
    write.write_table(spark.createDataFrame(rows, "id int, v string"), left)
    write.write_table(spark.createDataFrame([*rows[1:3], (3, "d")], "id int, v string"), right)
    diff = compare.diff_rows(table.read_table(spark, left), table.read_table(spark, right))
    found = sorted((r.id, r.v, r.n_source, r.n_target) for r in diff.collect())
    assert found == [(1, None, 1, 0), (3, "c", 1, 0), (3, "d", 0, 1)]
    verdict = compare.compare_tables(spark, left, right).first()
    assert not verdict.equal and verdict.same_schema and verdict.source_n_rows == 4


def first_data_file(table):
    found = [f"{d}/{n}" for d, _, names in os.walk(table) for n in names if n.endswith(".parquet") and "_delta_log" not in d]
    return sorted(found)[0]


def test_truncated_files_are_refused(spark, shipped, place):
    target = place()
    apply.import_bundle(spark, f"{shipped}/full.zip", target)
    name = first_data_file(target)
    with open(name, "r+b") as file:
        file.truncate(100)
    crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
    assert not os.path.exists(crc)
    with pytest.raises(ShippingError, match="size"):
        apply.verify_import(spark, target)
    with pytest.raises(ShippingError):
        apply.ship(spark, target, place())


def test_a_failed_overwrite_leaves_the_old_table(spark, place):
    source, target = place("source"), place("target")
    for location, start in ((source, 100), (target, 0)):
        write.write_table(spark.range(start, start + 3), location)
    ours = first_data_file(target)
    theirs = first_data_file(source)
    clash = os.path.join(target, os.path.relpath(theirs, source))
    os.makedirs(os.path.dirname(clash), exist_ok=True)
    with open(clash, "wb") as file:
        file.write(b"other bytes")
    export.export(spark, source, f"{source}-bundle")
    with pytest.raises(ShippingError, match="other content"):
        apply.import_bundle(spark, f"{source}-bundle.zip", target, "overwrite")
    assert os.path.exists(ours) and open(clash, "rb").read() == b"other bytes"
    assert sorted(r.id for r in table.read_table(spark, target).collect()) == [0, 1, 2]
    assert not [n for n in os.listdir(target) if n.startswith("_incoming")]


def test_export_after_a_failed_export(spark, place):
    source, out = place("source"), place("bundle")
    write.write_table(spark.range(3), source)
    name = first_data_file(source)
    body = open(name, "rb").read()
    os.remove(name)
    with pytest.raises(ShippingError, match="does not exist"):
        export.export(spark, source, out)
    with open(name, "wb") as file:
        file.write(body)
    assert export.export(spark, source, out).where("status = 'missing'").count() == 0


def test_tables_that_cannot_be_read_are_shipped(spark, place):
    root, copy, streamed = place(), place("copy"), place("shipped")
    write.write_table(spark.range(3).toDF("id"), root)
    snap = table.snapshot(spark, root)
    protocol = {"minReaderVersion": 3, "minWriterVersion": 7, "readerFeatures": ["columnMapping", "zz"], "writerFeatures": ["columnMapping", "zz"]}
    mapped = {**snap.metadata, "configuration": {"delta.columnMapping.mode": "name"}}
    with open(f"{root}/_delta_log/{1:020d}.json", "w") as out:
        out.write(json.dumps({"protocol": protocol}) + "\n" + json.dumps({"metaData": mapped}) + "\n")
    export.export(spark, root, f"{root}-bundle")
    apply.import_bundle(spark, f"{root}-bundle.zip", copy)
    apply.ship(spark, root, streamed)
    for target in (copy, streamed):
        row = apply.verify_import(spark, target, 1).first()
        assert (row.live_files, row.missing_files) == (snap.files.count(), 0)
        for name in snap.files.select("path").collect():
            with open(f"{root}/{name.path}", "rb") as a, open(f"{target}/{name.path}", "rb") as b:
                assert a.read() == b.read()
        with pytest.raises(ShippingError, match="columnMapping"):
            table.read_table(spark, target)
    with open(f"{root}/_delta_log/{2:020d}.json", "w") as out:
        out.write(json.dumps({"commitInfo": {"operation": "NOTE"}}) + "\n")
    apply.ship(spark, root, copy)
    assert log.resolve_segment(spark, copy).version == 2
