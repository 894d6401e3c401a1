import json
import os
import random

import pytest
from pyspark.sql import functions as F

from lakeship.operators import history, manifest, packing, replay, write
from lakeship.sources import log, table
from lakeship.storage import ShippingError
from lakeship.workers import next_fit


def write_log(root, commits):
    os.makedirs(f"{root}/_delta_log")
    for version, lines in commits.items():
        with open(f"{root}/_delta_log/{version:020d}.json", "w", encoding="utf-8") as out:
            out.writelines((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines)


def add(path, size=1, **more):
    return {"add": {"path": path, "size": size, "partitionValues": {}, "dataChange": True, **more}}


def remove(path, **more):
    return {"remove": {"path": path, "deletionTimestamp": 5, "dataChange": True, **more}}


def versions(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "version bigint")


@pytest.mark.parametrize("seed", range(3))
def test_latest_and_missing_match_brute_force(spark, seed):
    rng = random.Random(seed)
    present = sorted(rng.sample(range(40), 30))
    df = versions(spark, present + present[:3])
    for start in (0, 7, 20):
        expected = start - 1
        while expected + 1 in present:
            expected += 1
        found = history.latest_version(df, [start]).first().latest
        assert found == (expected if expected >= start else None)
    missing = [r.version for r in history.missing_versions(df, 40).orderBy("version").collect()]
    assert missing == [v for v in range(40) if v not in present]


def test_history_needs_commits_or_a_checkpoint(spark):
    def ok(rows, start):
        files = spark.createDataFrame(rows, "version bigint, kind string, parts int")
        return history.history_ok(files, [start]).first().history_ok

    commits = [(v, "commit", None) for v in range(5)]
    assert ok(commits[3:], 0)
    assert ok(commits, 4)
    assert not ok(commits[1:], 4)
    assert ok(commits[3:] + [(4, "checkpoint", 1)], 4)
    assert not ok(commits[3:] + [(4, "checkpoint", 1)], 3)


def test_newest_checkpoint_needs_all_parts(spark):
    rows = [(2, "checkpoint", 1), (5, "checkpoint", 2), (5, "checkpoint", 2), (9, "checkpoint", 2)]
    files = spark.createDataFrame(rows, "version bigint, kind string, parts int")
    assert tuple(history.newest_checkpoint(files).first()) == (5, 2)
    assert tuple(history.newest_checkpoint(files, 4).first()) == (2, 1)
    assert history.newest_checkpoint(files, 1).first() is None


@pytest.mark.parametrize("seed", range(2))
def test_replay_matches_brute_force(spark, place, seed):
    rng = random.Random(seed)
    root, live, commits = place(), {}, {}
    for version in range(12):
        lines = []
        for name in rng.sample([f"f {i}+.parquet" for i in range(8)], 4):
            coded = name.replace(" ", "%20")
            if name in live and rng.random() < 0.4:
                lines.append(remove(coded))
                del live[name]
            else:
                lines.append(add(coded, version * 10 + 1))
                live[name] = version * 10 + 1
        commits[version] = lines
    write_log(root, commits)
    actions = log.scan_actions(spark, root)
    found = replay.active_files(replay.file_actions(actions)).select("path", "size").collect()
    assert {r.path: r.size for r in found} == live
    early = replay.file_actions(log.scan_actions(spark, root, 0, 5))
    assert early.agg(F.max("version")).first()[0] == 5


def test_same_path_with_another_vector_replaces_the_file(spark, place):
    vector = {"storageType": "i", "pathOrInlineDv": "abc", "sizeInBytes": 3, "cardinality": 1}
    root = place()
    write_log(root, {0: [add("a")], 1: [add("a", deletionVector=vector), remove("a")]})
    rows = replay.file_actions(log.scan_actions(spark, root))
    (only,) = replay.active_files(rows).collect()
    assert (only.path, only.dv_id) == ("a", "iabc")


def test_range_scan_reads_only_its_commits(spark, place):
    root = place()
    write_log(root, {v: [add(f"f{v}")] for v in range(6)})
    scan = log.scan_actions(spark, root, 2, 3)
    assert scan.select("add.path", "version").rdd.getNumPartitions() <= 2
    assert sorted(r.path for r in scan.select("add.path").collect()) == ["f2", "f3"]


def test_broken_lines_are_reported(spark, place):
    root = place()
    write_log(root, {0: [add("a"), '{"add": {"path": "b"'], 1: [add("c", size="many")]})
    broken = log.corrupt_lines(log.scan_actions(spark, root)).orderBy("version").collect()
    assert [r.version for r in broken] == [0, 1]
    kinds = manifest.needed_files(manifest.references(log.scan_actions(spark, root)))
    assert kinds.where("kind = 'broken'").count() == 2


def test_unreadable_tables_raise(spark, place):
    with pytest.raises(ShippingError, match="has no _delta_log"):
        table.snapshot(spark, place())
    root = place()
    write_log(root, {1: [add("a")]})
    with pytest.raises(ShippingError, match="no readable history"):
        table.snapshot(spark, root)
    with open(f"{root}/_delta_log/{2:020d}.checkpoint.80a083e8-7026-4e79-81be-64bd76c43a11.parquet", "w") as out:
        out.write("x")
    with pytest.raises(ShippingError, match="unsupported kind"):
        table.snapshot(spark, root)
    root = place()
    write_log(root, {0: [add("a")]})
    with pytest.raises(ShippingError, match="no metadata"):
        table.snapshot(spark, root)


def test_manifest_of_a_range(spark, place):
    def vector(kind, where, offset=1):
        return {"storageType": kind, "pathOrInlineDv": where, "offset": offset, "sizeInBytes": 10, "cardinality": 1}

    code = "0" * 20
    file = "ab/deletion_vector_00000000-0000-0000-0000-000000000000.bin"
    root = place()
    write_log(
        root,
        {
            0: [add("old")],
            1: [remove("old"), add("kept", 7), add("gone", 5), add("twice")],
            2: [
                remove("gone"),
                add("twice"),
                remove("kept"),
                add("kept", 7, deletionVector=vector("u", "ab" + code)),
                add("other", deletionVector=vector("u", "ab" + code, 50)),
                add("inline", deletionVector=vector("i", "abcde")),
                add("named", deletionVector=vector("p", "dv%20x.bin")),
                {"cdc": {"path": "_change_data/c%20d.parquet", "size": 3}},
            ],
            3: [
                remove("named", deletionVector=vector("p", "dv%20x.bin")),
                add("legacy", deletionVectorDescriptor={"format": "x", "numRows": 1, "storagePath": "l.bin"}),
                add("older", deletionVector={"dvFile": "d.bin", "storagePath": ""}),
            ],
        },
    )
    files = manifest.range_manifest(log.scan_actions(spark, root, 1, 3), log.list_log(spark, root), 1, 3)
    found = {(r.kind, r.path): (r.size, r.live) for r in files.collect() if r.kind != "commit"}
    assert found == {
        ("data", "kept"): (7, True),
        ("data", "gone"): (5, False),
        ("data", "twice"): (1, True),
        ("data", "other"): (1, True),
        ("data", "inline"): (1, True),
        ("data", "named"): (1, False),
        ("data", "legacy"): (1, True),
        ("data", "older"): (1, True),
        ("dv", file): (68, True),
        ("dv", "dv x.bin"): (19, False),
        ("dv", "l.bin"): (None, False),
        ("dv", "d.bin"): (None, True),
        ("cdc", "_change_data/c d.parquet"): (3, False),
    }
    assert files.where("kind = 'commit'").count() == 3


def test_missing_files_and_probe(spark, place):
    root = place()
    os.makedirs(f"{root}/x=a b")
    for name in ("x=a b/one.parquet", "two.parquet"):
        with open(f"{root}/{name}", "w") as out:
            out.write("12345")
    wanted = spark.createDataFrame([("x=a b/one.parquet",), ("two.parquet",), ("three",)], "path string")
    assert {r.path: r.found_size for r in manifest.probe(wanted, root).collect()} == {
        "x=a b/one.parquet": 5,
        "two.parquet": 5,
        "three": None,
    }
    there = manifest.list_files(spark, root, recursive=True)
    assert there.count() == 2
    assert [r.path for r in manifest.missing(wanted, there).collect()] == ["three"]


def test_listing_by_pattern(spark, place):
    root = place()
    os.makedirs(root)
    for name in ("file1.txt", "file2.txt", "file3.log"):
        open(f"{root}/{name}", "w").close()
    found = manifest.list_files(spark, root, r".*\.txt")
    assert sorted(r.name for r in found.collect()) == ["file1.txt", "file2.txt"]
    assert manifest.directory_exists(spark, root) and not manifest.directory_exists(spark, root + "x")
    with pytest.raises(ShippingError, match="not a directory"):
        manifest.list_files(spark, root + "x")


@pytest.mark.parametrize("seed", range(3))
def test_next_fit_matches_brute_force(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 40, 90, 250]) for _ in range(60)]
    part, filled, expected = 0, None, []
    for size in sizes:
        if filled is not None and filled + size > 100:
            part, filled = part + 1, 0
        filled = (filled or 0) + size
        expected.append(part)
    assert next_fit(sizes, 100).tolist() == expected


def test_ten_files_need_five_parts(spark):
    files = spark.createDataFrame([(f"f{i}", 102_400) for i in range(10)], "path string, size bigint")
    packed = packing.next_fit(files, 256_000, F.lit(0))
    assert packing.part_sizes(packed).count() == 5
    assert packing.totals(files) == (10, 1_024_000)
    spread = packing.number_parts(packing.next_fit(files, 256_000, F.pmod(F.crc32("path"), F.lit(3))))
    parts = sorted({r.part for r in spread.collect()})
    assert parts == list(range(len(parts))) and spread.count() == 10


def test_multi_part_checkpoint_and_tombstones(spark, place):
    root = place()
    for k in range(4):
        write.write_table(spark.range(k * 10, k * 10 + 10).toDF("id"), root)
    write.write_table(spark.range(5).toDF("id"), root, "overwrite")
    assert write.write_checkpoint(spark, root, per_part=2) == 4
    names = [n for n in os.listdir(f"{root}/_delta_log") if ".checkpoint." in n and not n.startswith(".")]
    assert len(names) > 1
    state = log.scan_checkpoint(spark, root, 4, len(names))
    assert state.where("remove.path IS NOT NULL").count() >= 4
    for v in range(5):
        os.remove(f"{root}/_delta_log/{v:020d}.json")
    assert table.snapshot(spark, root).version == 4
    assert table.read_table(spark, root).count() == 5
    write.write_table(spark.range(100, 103).toDF("id"), root)
    assert table.read_table(spark, root).count() == 8
    os.remove(f"{root}/_delta_log/{names[0]}")
    with pytest.raises(ShippingError, match="no readable history"):
        table.snapshot(spark, root)


def test_all_starts_from_one_scan(spark):
    rows = [(v, "commit", None) for v in (0, 1, 2, 5, 6, 9)]
    rows += [(2, "checkpoint", 1), (5, "checkpoint", 2), (6, "checkpoint", 2), (6, "checkpoint", 2)]
    files = spark.createDataFrame(rows, "version bigint, kind string, parts int")
    latest = history.latest_version(files.where("kind = 'commit'"), [0, 2, 3, 5, 9, 10]).collect()
    assert {r.from_version: r.latest for r in latest} == {0: 2, 2: 2, 3: None, 5: 6, 9: 9, 10: None}
    ok = history.history_ok(files.where("version <> 2 OR kind = 'commit'"), [0, 3, 4, 5, 6]).collect()
    assert {r.from_version: r.history_ok for r in ok} == {0: True, 3: True, 4: False, 5: False, 6: True}
    assert tuple(history.newest_checkpoint(files).first()) == (6, 2)
    assert tuple(history.newest_checkpoint(files, 5).first()) == (2, 1)
    assert history.newest_checkpoint(files, 1).first() is None
    empty = files.where("false")
    assert history.latest_version(empty, [0]).first().latest is None
    assert [r.history_ok for r in history.history_ok(empty, [0, 1]).collect()] == [True, False]


@pytest.mark.parametrize("line", ['{"add":"b.parquet"}', '{"add":{"path":"b.parquet","size":"many"}}', '{"remove":7}'])
def test_a_broken_action_is_refused_on_reads(spark, place, line):
    root = place()
    write.write_table(spark.range(3).toDF("id"), root)
    with open(f"{root}/_delta_log/{1:020d}.json", "w") as out:
        out.write(line + "\n")
    with pytest.raises(ShippingError, match="does not parse"):
        table.read_table(spark, root)
    assert table.read_table(spark, root, as_of=0).count() == 3


def test_locations_with_glob_characters(spark, place):
    root = place("x[1]{a}*?")
    write.write_table(spark.range(3).toDF("id"), root)
    write.write_table(spark.range(3, 5).toDF("id"), root)
    write.write_checkpoint(spark, root)
    assert sorted(r.id for r in table.read_table(spark, root).collect()) == [0, 1, 2, 3, 4]


def test_a_second_checkpoint_attempt_changes_nothing(spark, place):
    root = place()
    for k in range(3):
        write.write_table(spark.range(k * 10, k * 10 + 10).toDF("id"), root)
    write.write_checkpoint(spark, root, per_part=3)
    directory = f"{root}/_delta_log"
    parts = sorted(n for n in os.listdir(directory) if ".checkpoint." in n and not n.startswith("."))
    os.remove(f"{directory}/{parts[-1]}")
    write.write_checkpoint(spark, root, per_part=3)
    assert sorted(n for n in os.listdir(directory) if ".checkpoint." in n and not n.startswith(".")) == parts[:-1]
    assert table.read_table(spark, root).count() == 30
