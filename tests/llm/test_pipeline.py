"""Every stage of the pipeline on what its predecessor kept, against brute force."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from citylake.llm import langid, mixing
from tests.llm.helpers import awkward, clashing, empty
from tests.llm.test_linededup import slow as slow_lines
from tests.llm.test_neardup import slow_groups


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output rows of every stage."""
    from citylake.llm.common import staged

    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, sf_dir), "test-stage")
        out.append((docs, after))
        docs = after
    return out


def test_names_and_columns(stages):
    assert len(stages) == 5
    for before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_language_drops_only_what_it_rejects(stages):
    before, after = stages[0]
    model = langid.train(before, "doc_id", "text", "lang")
    want = {r["doc_id"] for r in before.collect() if langid.predict(model, r["text"])[0] != "und"}
    assert {r["doc_id"] for r in after.collect()} == want


def test_lines_as_brute_force(stages):
    before, after = stages[1]
    want = {(i, t) for i, t, _ in slow_lines([(r["doc_id"], r["text"]) for r in before.collect()])}
    rows = after.collect()
    assert {(r["doc_id"], r["text"]) for r in rows} == want
    changed = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in before.join(after, ["doc_id", "text"], "left_semi").collect()}
    assert changed and all(r["n_chars"] == len(r["text"]) for r in rows if r["doc_id"] in changed)


def test_one_document_of_each_group(stages):
    before, after = stages[2]
    rows = before.orderBy("doc_id").collect()
    roots = slow_groups([r["text"] for r in rows])
    want = {rows[i]["doc_id"] for i in set(roots)}
    got = [r["doc_id"] for r in after.collect()]
    assert sorted(got) == sorted(want) and len(want) < len(rows)


def test_mixing_copies(spark, stages, sf_dir):
    before, after = stages[3]
    labels = mixing.quality_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rates = mixing.mix(before, labels).select("id", mixing.copies(F.col("rate"), "id", "row").alias("n")).collect()
    want = {r["id"]: r["n"] for r in rates if r["n"]}
    got = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert got == want


def test_last_stage_and_run(spark, stages, sf_dir):
    got = sorted((r["doc_id"], r["ids_sha256"]) for r in stages[4][1].collect())
    assert got == sorted((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, sf_dir).collect())


def test_a_run_leaves_one_table(spark, sf_dir, monkeypatch, tmp_path):
    """Whatever the stages stage is removed; what the last result reads stays."""
    made = []

    def fresh(_, purpose):
        made.append(tmp_path / f"{purpose}-{len(made)}")
        return str(made[-1])

    monkeypatch.setattr("citylake.llm.common.shared_dir", fresh)
    result = corpus_pipeline.run(spark, sf_dir)
    left = [p.name.rsplit("-", 1)[0] for p in made if p.exists()]
    assert len(made) > 20 and left == ["pipeline-mixing"] and result.count() > 100


@pytest.mark.parametrize("rows", [awkward, clashing, empty])
def test_stages_survive_awkward_rows(spark, sf_dir, rows):
    docs = rows(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        out.collect()
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    roots = slow_groups([r["text"] for r in docs.collect()])
    assert len(kept) == len(set(roots))
    corpus_pipeline.encode(spark, docs, sf_dir).collect()
