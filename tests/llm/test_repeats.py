import hashlib
import random
from functools import partial

import numpy as np
import pytest

from tallywatch.llm import repeats
from tallywatch.llm.links import stored
from tallywatch.llm.queries import QUERIES
from tests.llm.conftest import PROSE, WORD


def expected(pairs, length):
    """Per (id, text): words, removed words and the kept ones."""
    owner = {}
    for key, text in pairs:
        words = WORD.findall(text or "")
        for i in range(len(words) - length + 1):
            if key is not None:
                window = tuple(words[i: i + length])
                owner[window] = min(owner.get(window, key), key)
    out = []
    for key, text in pairs:
        words = WORD.findall(text or "")
        stays = [True] * len(words)
        for i in range(len(words) - length + 1):
            if key is not None and owner[tuple(words[i: i + length])] < key:
                stays[i: i + length] = [False] * length
        out.append((key, len(words), stays.count(False), " ".join(w for w, s in zip(words, stays) if s)))
    return out


def test_whole_table(spark, sf_dir, documents):
    got = [tuple(r) for r in QUERIES["op2_shared_passages"](spark, sf_dir).collect()]
    want = expected([(r["doc_id"], r["text"]) for r in documents], 50)
    assert sorted(got) == sorted((k, n, m, hashlib.sha256(t.encode()).hexdigest()) for k, n, m, t in want)
    assert sum(m for _, _, m, _ in want) > 0


@pytest.mark.parametrize("length", [1, 2, 5, 8])
def test_few_words_many_repeats(spark, frame, length):
    rng = random.Random(length)
    pairs = [(rng.randrange(25), " ".join(rng.choice("ab") for _ in range(rng.randrange(14)))) for _ in range(40)]
    pairs += [(100, None), (None, "a b a b a b a b a b")]
    data = frame(pairs)
    left = repeats.without_repeats(spark, data, length=length, tidy=True)
    assert left.columns == data.columns + ["n_words", "n_removed"]
    plain = left.toDF(*(f"c{i}" for i in range(len(left.columns))))
    at = {name: f"c{i}" for i, name in reversed(list(enumerate(left.columns)))}
    last = f"c{len(left.columns) - 2}", f"c{len(left.columns) - 1}"
    got = [tuple(r) for r in plain.select(at["doc_id"], *last, at["text"]).collect()]
    assert sorted(got, key=repr) == sorted(expected(pairs, length), key=repr)


def test_untouched_texts_stay_as_they_are(spark, frame):
    pairs = [(1, "a  b\nc"), (2, "x " + PROSE + " y"), (3, "z\n" + PROSE + "  end")]
    left = repeats.without_repeats(spark, frame(pairs).select("doc_id", "text"))
    assert {r.doc_id: r.text for r in left.collect()} == {1: "a  b\nc", 2: "x " + PROSE + " y", 3: "z end"}


def test_levels_go_on_until_nothing_is_shared(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
    texts = [" ".join(words), " ".join(words[20:190]), " ".join(words[90:135]), "a b c", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    windows = repeats.shared_windows(partial(stored, spark), docs, 10)
    got = {r.id: r.longest for r in repeats.longer_windows(spark, docs, windows, 10).collect()}
    assert got == {0: 160, 1: 160, 2: 40}
    none = repeats.shared_windows(partial(stored, spark), docs.filter("id > 2"), 10)
    assert repeats.longer_windows(spark, docs, none, 10).count() == 0


@pytest.mark.parametrize("length", [1, 2, 3, 7, 50])
def test_equal_windows_have_equal_anchors(length):
    rng = np.random.default_rng(length)
    words = rng.integers(0, 3 if length < 8 else 2, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first = np.array([0, 150, 150, 152, 400])
    at, rows, keys = repeats.anchors_of(words, first, length)
    seen = {}
    for p, key in zip(at.tolist(), keys.tolist()):
        assert seen.setdefault(tuple(words[p: p + length].tolist()), key) == key
    assert at.tolist() == [p for a, b in zip(first[:-1], first[1:]) for p in range(a, b - length + 1)]


def test_odd_rows(spark, frame, odd_pairs):
    left = repeats.without_repeats(spark, frame(odd_pairs).select("doc_id", "text"), tidy=True)
    got = sorted((tuple(r) for r in left.select("doc_id", "n_words", "n_removed", "text").collect()), key=repr)
    assert got == sorted(expected(odd_pairs, 50), key=repr)
    assert repeats.without_repeats(spark, frame([])).count() == 0
