"""Shipments that stop: what the next attempt finds, and what readers see in between."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from lakeship import storage, workers
from lakeship.operators import compare, ledger, write
from lakeship.plans import apply, export, publish
from lakeship.sources import log, table
from lakeship.storage import ShippingError
from lakeship.streaming.ship import ship_stream


def build(spark, root, versions=3, files=2):
    for v in range(versions):
        rows = spark.range(v * 10, v * 10 + 10).withColumn("value", F.concat(F.lit("v"), "id"))
        write.write_table(rows.repartition(files), root)
    return root


def data_files(root):
    found = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]
    return sorted(f for f in found if "_shipping" not in f)


def same(spark, source, target):
    return compare.compare_tables(spark, source, target).first().equal


def block(path):
    """Put a directory in the place of a file: reading it fails as a lost disk would."""
    shutil.move(path, path + ".aside")
    os.mkdir(path)
    return lambda: (os.rmdir(path), shutil.move(path + ".aside", path))


def statuses(report, kind="data"):
    return {r.status: r["count"] for r in report.where(F.col("kind") == kind).groupBy("status").count().collect()}


def test_a_ship_that_missed_a_file_goes_on(spark, place):
    source, target = build(spark, place("source")), place("target")
    gone = data_files(source)[2]
    shutil.move(gone, gone + ".aside")
    with pytest.raises(ShippingError, match="was not shipped"):
        apply.ship(spark, source, target)
    assert ledger.claim_of(spark, target)["key"].endswith(source) and not write.table_exists(spark, target)
    copied = {p: os.stat(p).st_ino for p in data_files(target)}
    shutil.move(gone + ".aside", gone)
    report = apply.ship(spark, source, target)
    assert statuses(report) == {"resumed": 5, "copied": 1}
    assert statuses(report, "commit") == {"resumed": 3}
    assert {p: os.stat(p).st_ino for p in copied} == copied
    assert same(spark, source, target) and not os.path.exists(f"{target}/_shipping")
    assert apply.ship(spark, source, target) is None


@pytest.mark.parametrize("mode", ["error", "overwrite", "apply"])
def test_a_killed_import_goes_on(spark, place, mode):
    source, out, target = build(spark, place("source"), 4), place("bundle"), place("target")
    export.export(spark, source, out, part_bytes=1500)
    if mode == "overwrite":
        build(spark, target, 1)
    if mode == "apply":
        shutil.copytree(source, target)
        forget(target, (2, 3))
        for path in data_files(target)[4:]:
            os.remove(path)
    parts = sorted(n for n in os.listdir(out + ".zip") if n.endswith(".zip"))
    with open(f"{out}.zip/{parts[-1]}", "r+b") as archive:
        body = archive.read()
        at = body.index(b"PAR1")  # break the first file of the last part: its checksum is wrong
        archive.seek(at + 4)
        archive.write(bytes(b ^ 255 for b in body[at + 4 : at + 8]))
    before = table.snapshot(spark, target).version if mode != "error" else None
    with pytest.raises(Exception, match="Bad CRC-32"):
        apply.import_bundle(spark, out + ".zip", target, mode)
    if before is not None:
        assert table.snapshot(spark, target).version == before
    with open(f"{out}.zip/{parts[-1]}", "r+b") as archive:
        archive.write(body)
    report = apply.import_bundle(spark, out + ".zip", target, mode)
    assert statuses(report).get("resumed", 0) > 0 and "conflict" not in statuses(report)
    assert same(spark, source, target) and not os.path.exists(f"{target}/_shipping")


def test_foreign_folders_and_claims_are_refused(spark, place):
    source, other, target = build(spark, place("source"), 1), build(spark, place("other"), 1), place("target")
    os.mkdir(target)
    with pytest.raises(ShippingError, match="already exists"):
        apply.ship(spark, source, target)
    os.rmdir(target)
    restore = block(data_files(source)[0])
    with pytest.raises(Exception):
        apply.ship(spark, source, target)
    with pytest.raises(ShippingError, match="unfinished shipment has claimed it: table .*source"):
        apply.ship(spark, other, target)
    restore()
    apply.ship(spark, source, target)
    assert same(spark, source, target)
    with open(f"{target}/x", "w"):
        pass
    with pytest.raises(ShippingError, match="already exists"):
        export.export(spark, source, source + "-b")
        apply.import_bundle(spark, source + "-b.zip", target)


def test_a_file_that_changed_is_copied_again(spark, place):
    """The ledger knows log files by size and time: one that was rewritten since is not taken for the old one."""
    source, target = build(spark, place("source"), 2), place("target")
    restore = block(data_files(source)[0])
    with pytest.raises(Exception):
        apply.ship(spark, source, target)
    restore()
    commit = f"{source}/_delta_log/{1:020d}.json"
    with open(commit) as old:
        lines = old.read()
    os.remove(f"{source}/_delta_log/.{1:020d}.json.crc")
    with open(commit, "w") as new:
        new.write(lines.replace('"WRITE"', '"Write"'))
    os.utime(commit, (2_000_000_000, 2_000_000_000))
    apply.ship(spark, source, target)
    with open(f"{target}/_delta_log/{1:020d}.json") as shipped:
        assert '"Write"' in shipped.read()


def test_a_stream_whose_first_trigger_failed_goes_on(spark, place):
    source, target, state = build(spark, place("source"), 2), place("target"), place("state")
    restore = block(data_files(source)[1])
    with pytest.raises(Exception):
        ship_stream(spark, source, target, state).awaitTermination()
    restore()
    ship_stream(spark, source, target, state).awaitTermination()
    assert same(spark, source, target)


def forget(root, versions):
    for version in versions:
        os.remove(f"{root}/_delta_log/{version:020d}.json")
        os.remove(f"{root}/_delta_log/.{version:020d}.json.crc")


def staged_commits(spark, source, target, current):
    """An `apply` stopped right before its publication: the staged log, and its rows."""
    staging = ledger.incoming(target)
    shutil.copytree(f"{source}/_delta_log", f"{staging}/_delta_log")
    listing = log.list_log(spark, source).where("kind = 'commit'")
    return staging, listing.select("kind", F.col("name").alias("path"))


def test_commits_appear_all_at_once(spark, place, monkeypatch):
    source, target = build(spark, place("source"), 6), place("target")
    shutil.copytree(source, target)
    forget(target, range(2, 6))
    staging, staged = staged_commits(spark, source, target, 1)
    seen = []
    rename = storage.move_new

    def watched(session, old, new):
        seen.append((sorted(n for n in os.listdir(f"{target}/_delta_log") if n.endswith(".json")), table.snapshot(spark, target).version))
        return rename(session, old, new)

    monkeypatch.setattr(storage, "move_new", watched)
    publish.publish_commits(spark, staging, target, staged, 1)
    ((names, version),) = seen  # one rename by the driver, however many commits
    assert version == 1 and len(names) == 5 and f"{2:020d}.json" not in names
    assert table.snapshot(spark, target).version == 5 and same(spark, source, target)


def test_publication_that_stopped_before_its_marker(spark, place, monkeypatch):
    source, target = build(spark, place("source"), 6), place("target")
    shutil.copytree(source, target)
    forget(target, range(2, 6))

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as stopped:
        stopped.setattr(storage, "move_new", killed)
        with pytest.raises(RuntimeError, match="killed"):
            apply.ship(spark, source, target)
    assert os.path.exists(f"{target}/_delta_log/{4:020d}.json") and table.snapshot(spark, target).version == 1
    report = apply.ship(spark, source, target)
    assert statuses(report, "commit") == {"resumed": 4}
    assert same(spark, source, target) and table.snapshot(spark, target).version == 5


def test_another_writer_takes_the_version(spark, place, monkeypatch):
    source, target = build(spark, place("source"), 5), place("target")
    shutil.copytree(source, target)
    forget(target, range(2, 5))
    rename = storage.move_new

    def too_late(session, old, new):
        if new.endswith(f"_delta_log/{2:020d}.json") and not os.path.exists(new.removeprefix("file:")):
            with open(new.removeprefix("file:"), "w") as theirs:
                theirs.write(json.dumps({"commitInfo": {"operation": "theirs"}}) + "\n")
        return rename(session, old, new)

    monkeypatch.setattr(storage, "move_new", too_late)
    with pytest.raises(ShippingError, match="committed by another writer"):
        apply.ship(spark, source, target)
    names = [n for n in os.listdir(f"{target}/_delta_log") if n.endswith(".json") and not n.startswith(".")]
    assert sorted(names) == [f"{v:020d}.json" for v in range(3)]


def test_overwrite_leaves_a_table_at_every_step(spark, place, monkeypatch):
    source = build(spark, place("source"), 2)
    for stop in (1, 2):  # before the old log goes, and between the two renames
        target = build(spark, place("target"), 4)
        export.export(spark, source, f"{source}-{stop}")
        rename, calls = storage.move_new, []

        def killed(session, old, new):
            calls.append(new)
            if len(calls) >= stop:
                raise RuntimeError("killed")
            return rename(session, old, new)

        with monkeypatch.context() as stopped:
            stopped.setattr(storage, "move_new", killed)
            with pytest.raises(RuntimeError, match="killed"):
                apply.import_bundle(spark, f"{source}-{stop}.zip", target, "overwrite")
        assert os.path.isdir(f"{target}/_delta_log") is (stop == 1)
        assert table.snapshot(spark, target).version == (3 if stop == 1 else 1)
        apply.import_bundle(spark, f"{source}-{stop}.zip", target, "overwrite")
        assert same(spark, source, target) and not os.path.exists(f"{target}/_shipping")
        assert len(publish.forget_replaced(spark, target)) == 1 + (stop == 2)
        assert not [n for n in os.listdir(target) if n.startswith("_replaced")]
        assert same(spark, source, target)


def test_files_are_placed_once(tmp_path):
    import pandas as pd

    old, new = tmp_path / "old", tmp_path / "new"
    for folder in (old, new):
        folder.mkdir()
    for name, ours, theirs in (("a", "1", None), ("b", "1", "1"), ("c", "1", "2"), ("d", None, "1"), ("e", None, None)):
        for folder, text in ((old, ours), (new, theirs)):
            if text:
                (folder / name).write_text(text)
    batch = pd.DataFrame({"name": list("abcde")})
    (found,) = workers.place_files([batch], str(old), str(new), {})
    assert found["status"].tolist() == ["moved", "present", "conflict", "moved", "missing"]
    assert (new / "c").read_text() == "2"
