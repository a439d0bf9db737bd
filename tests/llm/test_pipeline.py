import re

import public_tokenizers
import pytest

import corpus_pipeline
from tallywatch.llm.pieces import pieces
from tallywatch.llm.queries import QUERIES
from tests.llm import test_near, test_repeats
from tests.llm.test_decontaminate import plain

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage returned, written and read as the driver does."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(spark, stage(spark, docs, sf_dir), "stage")
        out.append(docs)
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_each_stage_equals_a_plain_version(spark, sf_dir, documents, stages):
    good = {r.doc_id for r in QUERIES["op4_rule_anomalies"](spark, sf_dir).filter("kept").collect()}
    want = {r["doc_id"]: r["text"] for r in documents if r["doc_id"] in good}
    assert texts(stages[0]) == want

    groups = test_near.expected(sorted(want.items()))
    want = {i: t for i, t in want.items() if groups[i] == i}
    assert texts(stages[1]) == want

    left = {k: (n, m, t) for k, n, m, t in test_repeats.expected(sorted(want.items()), 50)}
    want = {k: want[k] if not m else t for k, (n, m, t) in left.items() if n > m}
    assert texts(stages[2]) == want

    items = [f" {' '.join(plain(r.text))} " for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    held = {i: f" {' '.join(plain(t))} " for i, t in want.items()}
    want = {i: t for i, t in want.items() if not any(item in held[i] for item in items)}
    assert texts(stages[3]) == want

    got = {r.doc_id: r for r in stages[4].collect()}
    assert set(got) == set(want) and all(r.round_trip for r in got.values())
    for key in sorted(want)[:15]:
        assert got[key].ids == pieces(PATH).encode_text(want[key]) and got[key].n_tokens == len(got[key].ids)


def test_columns_and_counts(documents, stages):
    for frame in stages[:-1]:
        assert frame.columns == list(documents[0])
        assert all(r.n_chars == len(r.text) for r in frame.collect())
    counts = [frame.count() for frame in stages]
    assert len(documents) > counts[0] > counts[1] >= counts[2] >= counts[3] == counts[4] > 100


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    def rows(frame):
        return sorted(map(repr, frame.collect()))

    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(stages[-1])


def test_stages_take_odd_and_empty_tables(spark, sf_dir, odd_pairs):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for rows in ([], [(i, t, None, None, None) for i, t in odd_pairs]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() <= len(rows)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns


def test_stage_names():
    assert [re.sub(r"\W", " ", name) for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near dedup", "substring dedup", "benchmark decontamination", "piece encoding"]
