import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from hypothesis import given
from hypothesis import strategies as st

from tallywatch.llm import rules
from tallywatch.llm.queries import QUERIES
from tests.llm.conftest import WORD

TEXTS = st.text(st.sampled_from("ab #|\n\t!Aé"), max_size=60)


def counted(text):
    text = text or ""
    words, seen, dup, lines = WORD.findall(text), set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines, dup = lines + 1, dup + (line in seen)
            seen.add(line)
    threes = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if threes[tuple(words[i: i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dup, "n_repeat_words": len(covered), "n_lines": lines, "n_upper": len(re.findall("[A-Z]", text)),
        "n_letters": len(re.findall("[A-Za-z]", text)), "n_exclamations": text.count("!"),
    }


@given(st.lists(st.none() | TEXTS, max_size=6))
def test_counts(texts):
    got = rules.count_rules(pa.array(texts, pa.string()))
    want = [counted(t) for t in texts]
    assert {c: got[c].tolist() for c in rules.COUNTS} == {c: [w[c] for w in want] for c in rules.COUNTS}


def test_whole_table(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op4_rule_anomalies"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for row in documents:
        want, got = counted(row["text"]), rows[row["doc_id"]]
        assert {c: got[c] for c in rules.COUNTS} == want
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert got.base_failed == failed and not (failed and got.kept)


def test_verdicts_on_labels_left_out(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    statistics = rules.rule_statistics(spark.read.parquet(f"{path}/documents.parquet"))
    forests = rules.fit(statistics, labels.filter("doc_id % 2 = 0"))
    kept = {r.key: r.kept for r in rules.judged(statistics, forests).filter("NOT base_failed").collect()}
    held = [(kept[r["doc_id"]], r["quality"]) for r in pq.read_table(f"{path}/labels.parquet").to_pylist()
            if r["doc_id"] % 2 and r["doc_id"] in kept]
    good, bad = [k for k, q in held if q == 1], [k for k, q in held if q == 0]
    assert sum(good) >= 0.99 * len(good) > 100 and sum(bad) <= 0.1 * len(bad)


def plain_path(forest, row, root):
    at = root
    while forest.feature[at] >= 0:
        at = forest.left[at] + (row[forest.feature[at]] >= forest.value[at])
    return forest.length[at]


def test_forest_scores_are_those_of_single_paths():
    x = np.random.default_rng(1).normal(size=(500, 2))
    x[0] = (9, -9)
    forest = rules.grow_forest(x, trees=20, tree_rows=64)
    scores = forest.score(x)
    for i in range(0, 500, 50):
        mean = np.mean([plain_path(forest, x[i], root) for root in forest.roots])
        assert math.isclose(scores[i], 2 ** (-mean / forest.normal), rel_tol=1e-9)
    assert scores.argmax() == 0
    assert np.array_equal(scores, rules.grow_forest(x, trees=20, tree_rows=64).score(x))


def test_forest_of_nothing_and_of_equal_rows():
    for x in (np.zeros((0, 2)), np.zeros((1, 2)), np.ones((50, 2))):
        scores = rules.grow_forest(x).score(np.array([[1.0, 1.0], [5.0, 0.0]]))
        assert np.isfinite(scores).all() and scores[0] == scores[1]


def test_threshold():
    good, bad = np.zeros(1000, int), np.zeros(1000, int)
    good[300:400], bad[600:700] = 10, 1
    assert 400 <= rules._threshold(good, bad, 0.002) <= 600
    assert rules._threshold(good, good, 0.002) == math.inf
    assert rules._threshold(good, bad * 0, 0.002) == math.inf
    good[999] = 100  # a tenth of the good rows above all bad ones
    assert rules._threshold(good, bad, 0.002) == math.inf


def test_odd_rows(spark, frame, odd_pairs):
    data = frame(odd_pairs)
    statistics = rules.rule_statistics(data)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    forests = rules.fit(statistics, none)
    assert all(f.threshold == math.inf for f in forests.values())
    got = rules.judged(statistics, forests)
    assert got.count() == len(odd_pairs)
    kept = rules.keep(data, forests)
    assert kept.columns == data.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["4", "4", "5", "6", "8", "None"]
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None), (6, 1)], "doc_id bigint, quality int")
    assert set(rules.fit(statistics, labels)) == set(rules.FAMILIES)
    empty = rules.rule_statistics(frame([]))
    assert rules.judged(empty, rules.fit(empty, labels)).count() == 0


def test_every_tree_draws_from_all_rows(spark):
    rows = [(i, *([i] * len(rules.COUNTS))) for i in range(3000)]
    frame = spark.createDataFrame(rows, "key bigint, " + ", ".join(f"{c} bigint" for c in rules.COUNTS))
    samples = rules.tree_samples(frame.repartition(7), 40, 50)
    assert [len(s["n_words"]) for s in samples] == [50] * 40
    assert all(len(set(s["n_words"].tolist())) == 50 for s in samples)
    seen = np.concatenate([s["n_words"] for s in samples])
    assert len(set(seen.tolist())) > 1200 and abs(seen.mean() - 1500) < 100  # independent draws would meet 1,460
    again = rules.tree_samples(frame.repartition(2), 40, 50, oversampling=1000)
    assert all(np.array_equal(a["n_words"], b["n_words"]) for a, b in zip(samples, again))
    few = rules.tree_samples(frame.limit(3), 5, 50)
    assert [sorted(s["n_words"].tolist()) for s in few] == [[0, 1, 2]] * 5
    assert [len(s["n_words"]) for s in rules.tree_samples(frame.limit(0), 5, 50)] == [0] * 5


def test_more_than_one_family_rejects_bad_rows_on_labels_left_out(spark, sf_dir):
    """What each family rejects by itself among rows whose labels the thresholds did not see."""
    path = sf_dir.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    statistics = rules.rule_statistics(spark.read.parquet(f"{path}/documents.parquet"))
    forests = rules.fit(statistics, labels.filter("doc_id % 2 = 0"))
    scored = rules.judged(statistics, forests).filter("NOT base_failed").join(
        labels.filter("doc_id % 2 = 1").selectExpr("doc_id AS key", "quality"), "key").collect()
    good, bad = ([r for r in scored if r.quality == q] for q in (1, 0))
    caught = {f: np.mean([r[f"{f}_score"] >= forests[f].threshold for r in bad]) for f in forests}
    lost = {f: np.mean([r[f"{f}_score"] >= forests[f].threshold for r in good]) for f in forests}
    assert caught["symbols"] > 0.9 and caught["words"] > 0.3
    assert max(lost.values()) <= 0.005
