"""The pipeline, stage by stage, against what each stage's operator says of its input."""

import cases
import pytest

import corpus_pipeline
from lakeship.llm import pii, simhash

pytestmark = pytest.mark.skipif(not cases.has_data(), reason="needs the generated tables")


def test_stages(spark, tmp_path):
    docs = cases.documents(spark)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "personal_data", "source_mix", "tokens"]
    inputs = []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        out = stage(spark, docs, cases.SF_DIR)
        if name != "tokens":
            assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    labels = spark.read.parquet(f"{cases.SF_DIR}/labels.parquet")
    kept = inputs[1]
    lost = inputs[0].join(kept, "doc_id", "left_anti").join(labels, "doc_id")
    assert lost.where("quality = 1").count() == 0 and lost.where("quality = 0").count() > 0
    groups = simhash.op6_simhash_pigeonring(inputs[2]).select("component_id").distinct().count()
    assert groups == inputs[2].count()
    assert simhash.op6_simhash_pigeonring(inputs[1]).select("component_id").distinct().count() == groups
    left = pii.op1_bootstrapped_pii(inputs[3]).agg({"n_email": "sum", "n_ip": "sum", "n_phone": "sum"}).first()
    assert set(left) == {0}
    found = pii.op1_bootstrapped_pii(inputs[2]).where("spans = ''").select("doc_id")
    assert inputs[3].join(found, "doc_id").exceptAll(inputs[2].join(found, "doc_id")).count() == 0
    assert docs.count() == inputs[4].count() > 0


def test_run_equals_its_stages(spark):
    first = corpus_pipeline.run(spark, cases.SF_DIR).drop("ids")
    again = corpus_pipeline.run(spark, cases.SF_DIR).drop("ids")
    assert first.exceptAll(again).count() == 0 and first.count() == again.count()
