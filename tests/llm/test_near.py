import os
import random
from collections import defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
import pytest

from tallywatch.llm import near
from tallywatch.llm.links import classes, stored
from tallywatch.llm.queries import QUERIES
from tallywatch.session import shared_folder
from tests.llm.conftest import PROSE, WORD

PLAIN = near.Weights(np.zeros(0, np.uint64), np.zeros(0), near.COMMON)


def shingled(text):
    words = WORD.findall(text or "")
    found = defaultdict(int)
    for i in range(max(1, len(words) - 4) if words else 0):
        found[tuple(words[i: i + 5])] += 1
    return found


def expected(pairs, common=near.COMMON, similarity=near.SIMILARITY):
    """Class of every id by comparing all documents that share a shingle."""
    sets = [shingled(t) for _, t in pairs]
    spread = defaultdict(int)
    for s in sets:
        for x in s:
            spread[x] += 1
    sets = [{x: n * (1 + np.log(1 / max(spread[x] / len(pairs), common))) for x, n in s.items()} for s in sets]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = defaultdict(float)
    for x, own in holders.items():
        for k, a in enumerate(own):
            for b in own[:k]:
                shared[b, a] += min(sets[a][x], sets[b][x])
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), v in shared.items():
        if v / (sum(sets[a].values()) + sum(sets[b].values()) - v) >= similarity - 1e-9:
            root[find(a)] = find(b)
    least = defaultdict(lambda: 1 << 60)
    for i, (key, _) in enumerate(pairs):
        least[find(i)] = min(least[find(i)], key)
    return {key: least[find(i)] for i, (key, _) in enumerate(pairs)}


def found(spark, data, **options):
    return {r.id: r["class"] for r in near.near_duplicates(spark, data, **options).collect()}


def test_whole_table(spark, sf_dir, documents):
    got = {r.doc_id: r.class_id for r in QUERIES["op6_near_duplicates"](spark, sf_dir).collect()}
    assert got == expected([(r["doc_id"], r["text"]) for r in documents])
    assert len(set(got.values())) < len(got)


def changed(words, n, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.randrange(10 ** 9)}"
    return " ".join(words)


@pytest.mark.parametrize("n", [1, 4, 9])
def test_draws_agree_as_often_as_texts_are_similar(n):
    rng = random.Random(n)
    base = [f"w{rng.randrange(300)}" for _ in range(400)]
    texts = [" ".join(base)] * 20, [changed(base, n, rng) for _ in range(20)]
    similar = near.similarities(*map(pa.array, texts), PLAIN).mean()
    draws = []
    for side in texts:
        keys, counts, bounds, *_ = near.shingles(pa.array(side))
        draws.append(near.draw(keys, counts * PLAIN.of(keys), bounds, 500))
    assert abs((draws[0] == draws[1]).mean() - similar) < 0.03


def test_weights_count():
    rng = random.Random(5)
    many, few = " ".join(["a b c d e"] * 40), " ".join(["a b c d e"] * 20)
    tail = " " + " ".join(f"t{rng.randrange(10 ** 6)}" for _ in range(30))
    texts = [many + tail] * 100, [few + tail] * 100
    similar = near.similarities(*map(pa.array, texts), PLAIN)[0]
    assert 0.4 < similar < 0.75
    draws = []
    for side in texts:
        keys, counts, bounds, *_ = near.shingles(pa.array(side[:1]))
        draws.append(near.draw(keys, counts * PLAIN.of(keys), bounds, 500))
    assert abs((draws[0] == draws[1]).mean() - similar) < 0.08


def test_a_large_group_of_copies_and_one_of_near_copies(spark, frame):
    rng = random.Random(9)
    base = [f"b{rng.randrange(10 ** 6)}" for _ in range(120)]
    pairs = [(i, changed(base, 1, rng)) for i in range(100, 220)]  # two of them differ in ten shingles of 116
    pairs += [(i, PROSE) for i in range(300, 420)]
    pairs += [(i, " ".join(f"c{rng.randrange(10 ** 6)}" for _ in range(120))) for i in range(500, 520)]
    want = expected(pairs)
    assert set(want.values()) == {100, 300, *range(500, 520)}
    assert found(spark, frame(pairs)) == want


def test_common_shingles_are_counted_exactly(spark, frame):
    line = "this line stands at the head of many documents of one house"
    rng = random.Random(2)
    pairs = [(i, (line + " " if i % 4 == 0 else "") + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(30))) for i in range(80)]
    weights = near.common_shingles(frame(pairs, 7).selectExpr("doc_id AS id", "text"))
    assert len(weights.keys) == len(WORD.findall(line)) - 4
    assert np.allclose(weights.idf, 1 + np.log(1 / 0.25))


def test_partners_join_what_all_pairs_would_join():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 6, 40):
        draws = rng.integers(0, 3, (n, 12)).astype("<u2")
        equal = (draws[:, None] == draws[None]).sum(axis=2)
        for least in (4, 6, 8):
            groups = []
            for pairs in (near.partners(draws, least), [tuple(p) for p in np.argwhere(np.triu(equal >= least, 1))]):
                root = list(range(n))
                for a, b in pairs:
                    assert a < b and equal[a, b] >= least
                    root = [root[a] if r == root[b] else r for r in root]
                groups.append([root.index(r) for r in root])
            assert groups[0] == groups[1]
            assert len(near.partners(draws, least)) <= (near.NEAREST + 1) * n


def test_a_bucket_larger_than_a_task_takes(spark, frame, monkeypatch):
    monkeypatch.setattr(near, "TOGETHER", 10)
    rng = random.Random(11)
    base = [f"b{rng.randrange(10 ** 6)}" for _ in range(150)]
    pairs = [(i, changed(base, 1, rng) if i < 70 else " ".join(f"c{i}x{k}" for k in range(9))) for i in range(200)]
    want = expected(pairs)
    assert list(want.values()).count(0) == 70
    assert found(spark, frame(pairs)) == want


def test_classes_follow_long_paths(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 102), (102, 101), (7, 7)]
    got = {r.id: r["class"] for r in classes(spark, spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 102: 100}
    assert classes(spark, spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_odd_rows(spark, frame, odd_pairs):
    got = near.near_duplicates(spark, frame(odd_pairs)).collect()
    assert len(got) == len(odd_pairs)
    assert {(r.id, r["class"]) for r in got} == {
        (None, None), (1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 7), (8, 4)}
    assert near.near_duplicates(spark, frame([])).count() == 0
    assert found(spark, frame([(1, "one two"), (2, "one two"), (3, "one  two "), (4, "two one")])) == {1: 1, 2: 1, 3: 1, 4: 4}


def around_the_limit(seed):
    """A group of 30 near copies whose similarities lie around 0.8, and enough other texts that its shingles are rare."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10 ** 6)}" for _ in range(230)]
    return [(i, changed(base, 3, rng)) for i in range(30)] + [
        (1000 + i, " ".join(f"c{i}x{k}" for k in range(6))) for i in range(300)]


def test_similar_nodes_of_a_large_bucket_meet_wherever_it_is_cut(spark, frame, monkeypatch):
    monkeypatch.setattr(near, "TOGETHER", 4)
    pairs = around_the_limit(2)
    assert found(spark, frame(pairs)) == expected(pairs)


def test_links_outside_the_trees_and_nearest_partners_are_found(spark, frame):
    pairs = around_the_limit(2)
    assert found(spark, frame(pairs)) == expected(pairs)


def test_profiles_give_the_similarity_of_texts():
    rng = random.Random(8)
    base = [f"b{rng.randrange(40)}" for _ in range(120)]
    texts = [changed(base, k % 9, rng) for k in range(40)] + ["", "one two", "a a a a a a a a", "a a a a a a"]
    keys, counts, bounds, *_ = near.shingles(pa.array(texts))
    weights = near.Weights(keys[:30].copy(), np.linspace(0.2, 0.9, 30), near.COMMON)
    parts = [(keys[a:b].tobytes(), counts[a:b].astype("<u4").tobytes()) for a, b in zip(bounds, bounds[1:])]
    profiles = near.Profiles(*map(list, zip(*parts)), weights)
    left, right = np.arange(0, len(texts), 3), np.arange(len(texts))[::-1].copy()
    got = profiles.similarity(left, right)
    for i, a in enumerate(left):
        want = near.similarities(pa.array([texts[a]] * len(texts)), pa.array([texts[b] for b in right]), weights)
        # A node is never held against itself, and what it alone has is left out of intersections.
        assert np.allclose(got[i][right != a], want[right != a])


def cells(spark, pairs, monkeypatch, **sizes):
    """What the second round is given and what it sends on, with every node in a class of its own."""
    for name, value in sizes.items():
        monkeypatch.setattr(near, name, value)
    docs = spark.createDataFrame(pairs, "id bigint, text string")
    weights = near.common_shingles(docs)
    nodes = near.sketches(docs, weights).cache()
    members = nodes.selectExpr("id", "shingles", "inline(arrays_zip(buckets, finer)) AS (bucket, finer)").select("bucket", "id", "shingles")
    alone = docs.selectExpr("id", "id AS class")
    links = near._joining(partial(stored, spark), members, nodes, docs, alone, weights, near.SIMILARITY, near.AGREEMENT)
    return members.count(), [tuple(r) for r in links.collect()]


def test_a_cell_sends_on_fewer_links_than_it_has_nodes(spark, monkeypatch):
    rng = random.Random(12)
    base = [f"b{rng.randrange(10 ** 6)}" for _ in range(300)]
    pairs = [(i, changed(base, 1, rng)) for i in range(400)]
    n_members, links = cells(spark, pairs, monkeypatch)
    assert len(links) < n_members
    got = {r.id: r["class"] for r in classes(spark, spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == expected(pairs)
    n_members, links = cells(spark, around_the_limit(2), monkeypatch, TOGETHER=7, CELL_SHINGLES=3000, COLUMNS=50, STRIP=3)
    want = expected(around_the_limit(2))
    got = {r.id: r["class"] for r in classes(spark, spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {**{i: i for i in want}, **got} == want


def test_intermediate_tables_are_removed(spark, frame):
    before = set(os.listdir(shared_folder(spark)))
    assert found(spark, frame(around_the_limit(2))) == expected(around_the_limit(2))
    assert {name.split("-")[0] for name in set(os.listdir(shared_folder(spark))) - before} == {"classes"}
