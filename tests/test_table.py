import json
import os
import random

import numpy as np
import pytest
import vectors
from pyspark.sql import functions as F

from lakeship import storage
from lakeship.operators import dml, text, write
from lakeship.sources import log, table
from lakeship.storage import ShippingError


def ids(spark, root, as_of=None):
    return sorted(r.id for r in table.read_table(spark, root, as_of).select("id").collect())


def numbers(spark, first, last):
    return spark.range(first, last).toDF("id").withColumn("value", F.concat(F.lit("value_"), "id"))


def test_full_cycle_versions(spark, place):
    root = place()
    write.write_table(numbers(spark, 1, 100), root)
    stamped = table.read_table(spark, root).withColumn("timestamp", F.timestamp_seconds("id"))
    write.write_table(stamped, root, "overwrite", overwrite_schema=True)
    write.write_table(numbers(spark, 100, 200).withColumn("timestamp", F.timestamp_seconds("id")), root)
    assert dml.update(spark, root, "id % 10 = 0", {"value": "'updated_value'"}) == 3
    rows = table.read_table(spark, root)
    assert rows.count() == 199 and rows.columns == ["id", "value", "timestamp"]
    assert rows.where("value = 'updated_value'").count() == 19
    assert [table.read_table(spark, root, v).count() for v in range(4)] == [99, 99, 199, 199]
    assert table.read_table(spark, root, 0).columns == ["id", "value"]
    with pytest.raises(ShippingError, match="no version 4"):
        table.read_table(spark, root, 4)


def test_schema_rules(spark, place):
    root = place()
    write.write_table(numbers(spark, 0, 5), root, "error")
    with pytest.raises(ShippingError, match="already exists"):
        write.write_table(numbers(spark, 0, 5), root, "error")
    wider = numbers(spark, 5, 8).withColumn("extra", F.lit(1))
    with pytest.raises(ShippingError, match="merge_schema"):
        write.write_table(wider, root)
    with pytest.raises(ShippingError, match="is bigint, not string"):
        write.write_table(numbers(spark, 0, 5).withColumn("id", F.col("id").cast("string")), root)
    with pytest.raises(ShippingError, match="partitioned by"):
        write.write_table(numbers(spark, 5, 8), root, partition_by=["id"])
    write.write_table(wider, root, merge_schema=True)
    write.write_table(spark.range(8, 10).toDF("id"), root)
    rows = table.read_table(spark, root)
    assert rows.where("extra IS NULL").count() == 7 and rows.where("value IS NULL").count() == 2
    with pytest.raises(ValueError):
        write.write_table(wider, root, "upsert")


def test_create_and_empty_tables(spark, place):
    root = place()
    schema = numbers(spark, 0, 1).schema
    assert write.create_table(spark, root, schema, ["value"]) == 0
    assert write.create_table(spark, root, schema, if_not_exists=True) == 0
    with pytest.raises(ShippingError, match="already exists"):
        write.create_table(spark, root, schema)
    assert table.read_table(spark, root).count() == 0
    assert dml.delete(spark, root, "id = 3") == 0
    write.write_table(numbers(spark, 0, 4), root)
    assert ids(spark, root) == [0, 1, 2, 3]
    assert dml.delete(spark, root) == 2
    assert ids(spark, root) == []


def test_concurrent_commit_fails(spark, place):
    root = place()
    write.write_table(numbers(spark, 0, 3), root)
    snap = table.snapshot(spark, root)
    write.write_table(numbers(spark, 3, 6), root)
    with pytest.raises(ShippingError, match="another writer"):
        write.commit(spark, snap.table, snap.version + 1, write.removes(snap.files), "DELETE")
    assert ids(spark, root) == list(range(6))


STRANGE = ["a b", "a+b", "50%", "x/y", "é", "k=v", "[1]*?{2}", "a%20b", None]


def test_strange_partition_values(spark, place):
    root = place("a b+c")
    rows = spark.createDataFrame(list(enumerate(STRANGE * 2)), "id bigint, p string")
    write.write_table(rows, root, partition_by=["p"])
    found = table.read_table(spark, root)
    assert sorted((r.id, r.p or "") for r in found.collect()) == [(i, p or "") for i, p in enumerate(STRANGE * 2)]
    snap = table.snapshot(spark, root)
    assert table.partition_files(snap, "p IS NULL").count() >= 1
    assert table.read_files(snap, table.partition_files(snap, "p = '50%'")).count() == 2
    dml.update(spark, root, "p = 'a+b'", {"id": "id + 100"})
    snap = table.snapshot(spark, root)
    row = table.read_files(snap, with_position=True).where("id = 0").first()
    (file,) = snap.files.where(table.file_key(snap) == row[table.FILE_PATH]).collect()
    vectors.mark(spark, root, {file.raw_path: [row[table.ROW_INDEX]]})
    dml.delete(spark, root, "p IS NULL")
    expected = [i + 100 if p == "a+b" else i for i, p in enumerate(STRANGE * 2) if p is not None and i > 0]
    assert ids(spark, root) == sorted(expected)


def test_partition_values_come_from_the_log(spark, place):
    """Directory names are not trusted: here they say nothing, or something else."""
    root = place()
    paths = []
    for k, directory in enumerate(("plain", "p=9")):
        spark.range(k * 10, k * 10 + 3).toDF("id").coalesce(1).write.parquet(f"{root}/{directory}")
        name = next(n for n in os.listdir(f"{root}/{directory}") if n.endswith(".parquet"))
        paths.append(f"{directory}/{name}")
    os.makedirs(f"{root}/_delta_log")
    schema = spark.createDataFrame([], "id bigint, p int").schema
    meta = {"id": "x", "format": {"provider": "parquet", "options": {}}, "schemaString": schema.json()}
    actions = [
        {"protocol": {"minReaderVersion": 1, "minWriterVersion": 2}},
        {"metaData": {**meta, "partitionColumns": ["p"], "configuration": {}}},
        *[
            {"add": {"path": path, "partitionValues": {"p": value}, "size": 1, "dataChange": True}}
            for path, value in zip(paths, ("5", None))
        ],
    ]
    with open(f"{root}/_delta_log/{0:020d}.json", "w") as out:
        out.write("\n".join(json.dumps(a) for a in actions))
    rows = table.read_table(spark, root)
    assert sorted((r.id, r.p) for r in rows.collect()) == [(0, 5), (1, 5), (2, 5), (10, None), (11, None), (12, None)]
    dml.delete(spark, root, "p = 5 AND id = 1")
    assert ids(spark, root) == [0, 2, 10, 11, 12]


def test_unknown_reader_feature(spark, place):
    root = place()
    write.write_table(numbers(spark, 0, 3), root)
    path = f"{root}/_delta_log/{0:020d}.json"
    with open(path) as old:
        lines = [json.loads(line) for line in old]
    for line in lines:
        if "protocol" in line:
            line["protocol"] = {"minReaderVersion": 3, "minWriterVersion": 7, "readerFeatures": ["v2Checkpoint"]}
    os.remove(f"{root}/_delta_log/.{0:020d}.json.crc")
    with open(path, "w") as new:
        new.write("\n".join(json.dumps(line) for line in lines))
    with pytest.raises(ShippingError, match="v2Checkpoint"):
        table.snapshot(spark, root)


@pytest.mark.parametrize("seed", [0, 1])
def test_dml_matches_brute_force(spark, place, seed):
    rng, root = random.Random(seed), place()
    rows = {i: (i % 7 if i % 11 else None, f"v{i}") for i in range(300)}
    frame = spark.createDataFrame([(i, *r) for i, r in rows.items()], "id bigint, k int, v string")
    settings = {"delta.enableDeletionVectors": "true", "delta.checkpointInterval": "3"} if seed else None
    write.write_table(frame.repartition(5, "id"), root, configuration=settings)
    for step in range(4):
        k, m = rng.randrange(7), rng.randrange(3, 9)
        dml.delete(spark, root, f"k = {k} AND id % {m} = 0")
        rows = {i: r for i, r in rows.items() if not (r[0] == k and i % m == 0)}
        dml.update(spark, root, f"k = {(k + 1) % 7}", {"v": f"concat(v, '-{step}')", "k": "k + 1"})
        rows = {i: (r[0] + 1, f"{r[1]}-{step}") if r[0] == (k + 1) % 7 else r for i, r in rows.items()}
        found = {r.id: (r.k, r.v) for r in table.read_table(spark, root).collect()}
        assert found == rows


def test_rows_under_vectors_stay_deleted(spark, place):
    root = place()
    write.write_table(spark.range(0, 200_000, 1, 1).toDF("id"), root, configuration={"delta.checkpointInterval": "2"})
    (path,) = [r.raw_path for r in table.snapshot(spark, root).files.collect()]
    gone = [i for i in range(200_000) if i % 3 == 0 or i > 150_000]
    vectors.mark(spark, root, {path: gone})
    vectors.mark(spark, root, {path: sorted({*gone, *range(0, 200_000, 5)})})
    rows = table.read_table(spark, root)
    expected = [i for i in range(150_001) if i % 3 and i % 5]
    assert rows.agg(F.count("*"), F.sum("id")).first() == (len(expected), sum(expected))
    assert dml.delete(spark, root, "id % 3 = 0") == 2
    dml.delete(spark, root, "id % 7 = 0")
    expected = [i for i in expected if i % 7]
    rows = table.read_table(spark, root)
    assert rows.agg(F.count("*"), F.sum("id")).first() == (len(expected), sum(expected))
    assert table.snapshot(spark, root).files.where("dv_id <> ''").isEmpty()
    dml.delete(spark, root, "id >= 0")
    assert ids(spark, root) == []


def test_many_positions_are_neither_joined_nor_moved(spark, place, monkeypatch):
    root = place()
    write.write_table(spark.range(0, 2_400_000, 1, 3).toDF("id"), root)
    paths = [r.raw_path for r in table.snapshot(spark, root).files.collect()]
    vectors.mark(spark, root, {path: np.arange(0, 800_000, 2) for path in paths})
    monkeypatch.setattr(table, "VECTORS_AT_ONCE", 2)
    rows = table.read_table(spark, root)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text and "Union" in text
    assert rows.agg(F.count("*"), F.sum("id"), F.min("id")).first() == (1_200_000, 1_200_000**2, 1)
    pushed = rows.where("id > 2399990")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,2399990)" in pushed
    assert sorted(r.id for r in rows.where("id > 2399990").collect()) == list(range(2399991, 2400000, 2))


def test_file_lists_go_over_in_one_call(spark, place):
    root = place("a b")
    write.write_table(numbers(spark, 0, 40).withColumn("p", F.col("id") % 4).repartition(3), root, partition_by=["p"])
    assert ids(spark, root) == list(range(40))
    only = table.read_table(spark, root, partitions="p = 3")
    assert len(only.inputFiles()) < len(table.read_table(spark, root).inputFiles())
    assert sorted(r.id for r in only.collect()) == list(range(3, 40, 4))


def test_inline_vector(spark, place):
    root = place()
    write.write_table(spark.range(0, 10, 1, 1).toDF("id"), root)
    (file,) = table.snapshot(spark, root).files.collect()
    vectors.mark(spark, root, {file.raw_path: [2, 7]}, inline=True)
    assert ids(spark, root) == [0, 1, 3, 4, 5, 6, 8, 9]


def test_merge(spark, place):
    root = place()
    write.write_table(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id bigint, v string"), root)
    changes = spark.createDataFrame([("B", 2), ("C", 3), ("N", None)], "v string, id bigint")
    assert dml.merge(spark, root, changes, "id") == 1
    found = sorted((r.id or 0, r.v) for r in table.read_table(spark, root).collect())
    assert found == [(0, "N"), (0, "n"), (1, "a"), (2, "B"), (3, "C")]
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "id bigint, v string")
    with pytest.raises(ShippingError, match="more than one row"):
        dml.merge(spark, root, twice, "id")
    with pytest.raises(ShippingError, match="are not those of"):
        dml.merge(spark, root, twice.drop("v"), "id")
    dml.merge(spark, root, spark.createDataFrame([(9, "z")], "id bigint, v string"), "id")
    assert table.read_table(spark, root).count() == 6


def test_partition_delete_only_touches_the_log(spark, place):
    root = place()
    rows = numbers(spark, 1, 1000).withColumn("month", (F.col("id") % 12 + 1).cast("int"))
    write.write_table(rows, root, partition_by=["month"])
    before = {r.path for r in table.snapshot(spark, root).files.select("path").collect()}
    dml.delete(spark, root, F.col("month") == 12)
    after = {r.path for r in table.snapshot(spark, root).files.select("path").collect()}
    assert after < before and not any("month=12" in p for p in after)
    counts = {r.month: r.n_rows for r in table.partition_counts(table.snapshot(spark, root)).collect()}
    assert sum(counts.values()) == 999 - 83 and 12 not in counts
    with pytest.raises(ShippingError, match="no columns"):
        dml.update(spark, root, "id = 1", {"nope": "1"})


def test_pruning_reaches_the_scan(spark, place):
    root = place()
    rows = numbers(spark, 0, 100).withColumn("p", (F.col("id") % 4).cast("int"))
    write.write_table(rows, root, partition_by=["p"])
    plan = table.read_table(spark, root).where("p = 2 AND id > 50").select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in text and "PushedFilters: [IsNotNull(id), GreaterThan(id,50)]" in text
    assert "ReadSchema: struct<id:bigint>" in text and "Join" not in text


def test_checkpoint_interval(spark, place):
    root = place()
    write.write_table(numbers(spark, 0, 3), root, configuration={"delta.checkpointInterval": "2"})
    for k in range(1, 5):
        write.write_table(numbers(spark, k * 10, k * 10 + 3), root)
    files = log.list_log(spark, root).where("kind = 'checkpoint'").select("version").collect()
    assert sorted(r.version for r in files) == [2, 4]
    assert json.loads(storage.read_text(spark, f"{root}/_delta_log/_last_checkpoint"))["version"] == 4
    assert log.resolve_segment(spark, root) == log.Segment(4, 4, 1)
    assert log.resolve_segment(spark, root, 3) == log.Segment(3, 2, 1)
    assert ids(spark, root, 3) == [0, 1, 2, 10, 11, 12, 20, 21, 22, 30, 31, 32]


def test_plain_text_and_csv(spark, place):
    root = place()
    lines = spark.createDataFrame([("a/x.txt", "one"), ("a/x.txt", "two"), ("a/y.txt", "é")], "path string, value string")
    written = {r.path: (r.size, r.lines) for r in text.write_texts(lines, root).collect()}
    assert written == {"a/x.txt": (8, 2), "a/y.txt": (3, 1)}
    found = {r.name: r.text for r in text.read_texts(spark, f"{root}/a", "*.txt").collect()}
    assert sorted(found["x.txt"].split()) == ["one", "two"] and found["y.txt"] == "é\n"
    people = place("csv")
    os.makedirs(people)
    with open(f"{people}/p.csv", "w") as out:
        out.write("id,name,age,city,timestamp,random_value\n1,Ann,30,Oslo,2025-04-15T10:00:00,0.5\n")
    schema = "id int, name string, age int, city string, timestamp timestamp, random_value double"
    row = text.read_csv(spark, people, schema).first()
    assert (row.id, row.city, row.timestamp.hour, row.random_value) == (1, "Oslo", 10, 0.5)


def add_commit(root, version, *lines):
    with open(f"{root}/_delta_log/{version:020d}.json", "w") as out:
        out.writelines(json.dumps(line) + "\n" for line in lines)


def test_writers_keep_the_protocol_and_the_name(spark, place):
    root = place()
    write.write_table(numbers(spark, 0, 3), root)
    meta = table.snapshot(spark, root).metadata
    features = {"minReaderVersion": 3, "minWriterVersion": 7, "readerFeatures": [], "writerFeatures": ["appendOnly", "invariants"]}
    add_commit(root, 1, {"protocol": features}, {"metaData": {**meta, "name": "n", "description": "d"}})
    write.write_table(numbers(spark, 3, 5).withColumn("more", F.lit(1)), root, merge_schema=True)
    snap = table.snapshot(spark, root)
    assert snap.version == 2 and "more" in snap.schema.names
    assert {k: snap.protocol[k] for k in features} == features
    assert (snap.metadata["name"], snap.metadata["description"], snap.metadata["id"]) == ("n", "d", meta["id"])


def test_rules_that_a_writer_must_follow(spark, place):
    root = place()
    write.write_table(numbers(spark, 0, 9), root, configuration={"delta.appendOnly": "true"})
    write.write_table(numbers(spark, 9, 12), root)
    for change in (
        lambda: dml.update(spark, root, "id = 1", {"id": "2"}),
        lambda: dml.delete(spark, root, "id = 1"),
        lambda: dml.delete(spark, root),
        lambda: dml.merge(spark, root, numbers(spark, 0, 1), "id"),
        lambda: write.write_table(numbers(spark, 0, 1), root, "overwrite"),
    ):
        with pytest.raises(ShippingError, match="only takes new rows"):
            change()
    assert len(ids(spark, root)) == 12
    old = table.snapshot(spark, root).protocol
    add_commit(root, 2, {"protocol": {**old, "minWriterVersion": 7, "writerFeatures": ["rowTracking"]}})
    for write_something in (
        lambda: write.write_table(numbers(spark, 0, 1), root),
        lambda: write.write_checkpoint(spark, root),
    ):
        with pytest.raises(ShippingError, match="rowTracking"):
            write_something()
    assert len(ids(spark, root)) == 12


def test_conditions_that_change_are_refused(spark, place):
    root = place()
    write.write_table(numbers(spark, 0, 9), root)
    for change in (lambda: dml.update(spark, root, "rand() < 0.5", {"id": "0"}), lambda: dml.delete(spark, root, F.rand() < 0.5)):
        with pytest.raises(ShippingError, match="same result"):
            change()


def test_merge_reads_its_source_once(spark, place):
    root = place()
    write.write_table(spark.range(0, 50).select("id", F.lit(0.0).alias("x")), root)
    changes = spark.range(40, 60).select("id", (F.rand() + 1).alias("x")).where("x > 1.5")
    dml.merge(spark, root, changes, "id")
    rows = table.read_table(spark, root)
    assert rows.count() == rows.select("id").distinct().count()
    assert rows.where("id < 50").count() == 50 and rows.where("x > 0 AND x <= 1.5").count() == 0
