import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallywatch.llm import decontaminate
from tallywatch.llm.decontaminate import MASKS, leaks
from tallywatch.llm.queries import QUERIES
from tests.llm.conftest import PROSE


def plain(text):
    return re.findall(r"\w+", (text or "").lower())


@pytest.mark.parametrize("length, differences", [(15, 2), (20, 3), (25, 4)])
def test_masks_find_every_pattern(length, differences):
    read = [sum(1 << (at + i) for i, c in enumerate(m) if c == "1") for m in MASKS for at in range(length - len(m) + 1)]
    for changed in itertools.combinations(range(length), differences):
        bits = sum(1 << i for i in changed)
        assert any(not bits & r for r in read)


def test_whole_table_has_all_exact_passages(spark, sf_dir, documents):
    got = {(r.doc_id, r.item_id): r for r in QUERIES["op1_benchmark_leaks"](spark, sf_dir).collect()}
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    texts = {r["doc_id"]: f" {' '.join(plain(r['text']))} " for r in documents}
    want = {(d, i) for d, t in texts.items() for i, w in items.items() if f" {' '.join(w)} " in t}
    assert want and want <= set(got)
    for (doc, item), r in got.items():
        a = texts[doc].split()[r.begin: r.begin + r.n_words]
        b = items[item][r.item_begin: r.item_begin + r.n_words]
        assert sum(x == y for x, y in zip(a, b)) == r.n_equal and len(a) == len(b) == r.n_words
        assert r.n_equal >= min(13, 0.8 * len(items[item])) and r.n_equal >= 0.75 * r.n_words


def brute(docs, items):
    """Best overlap of every pair of texts over all shifts, where it counts."""
    out = set()
    for doc, text in docs:
        a = plain(text)
        for item, other in items:
            b = plain(other)
            best = 0
            for shift in range(-len(b) + 1, len(a)):
                same = [0 <= i + shift < len(a) and a[i + shift] == w for i, w in enumerate(b)]
                same = [s for i, s in enumerate(same) if 0 <= i + shift < len(a)]
                top = (0, 0, 0)
                for i in range(len(same)):
                    for j in range(i + 1, len(same) + 1):
                        n = sum(same[i:j])
                        top = max(top, (3 * n - 2 * (j - i), n, j - i))
                if top[1] >= min(13, -(-8 * len(b) // 10)) and top[1] >= 0.75 * top[2]:
                    best = max(best, top[1])
            if b and best:
                out.add((doc, item, best))
    return out


def cases():
    rng = random.Random(4)
    item = [f"q{i}" for i in range(24)]
    docs = []
    for n in range(9):
        words = list(item)
        for i in rng.sample(range(24), n):
            words[i] = "other"
        docs.append((n, "Before it, " + " ".join(words) + ". After"))
    docs += [(20, " ".join(item[:12])), (21, " ".join(item[:14])), (22, "Tiny ITEM here"), (23, "tiny; item, THERE"),
             (24, " ".join(item[:10] + ["put", "in"] + item[10:])), (25, "ÉTÉ “quoted” words—here and “there” now ok")]
    return docs, [(1, " ".join(item)), (2, "tiny item here"), (3, "été quoted words here and there NOW ok"), (4, ""), (5, None)]


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_substitutions_and_short_items(spark, sent):
    docs, items = cases()
    frames = (spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r.doc_key, r.item_key, r.n_equal) for r in leaks(spark, *frames, sent_bytes=sent).collect()}
    want = brute(docs, items)
    # Beyond three substitutions the masks promise nothing, and equally good stretches differ in length.
    sure = [{(d, i, n) for d, i, n in found if d <= 3 or d >= 20} for found in (got, want)]
    assert sure[0] == sure[1]
    assert {(d, i) for d, i, _ in got} <= {(d, i) for d, i, _ in want}
    assert {(0, 1, 24), (2, 1, 22), (21, 1, 14), (22, 2, 3), (25, 3, 8)} <= got and not {d for d, *_ in got} & {20, 23}


def test_odd_rows(spark, frame, odd_pairs):
    docs = frame(odd_pairs)
    items = frame([(None, PROSE), (1, None), (2, "one"), (2, "one"), (3, "")]).withColumnRenamed("doc_id", "item_id")
    for sent in (1 << 20, 0):
        got = [(r.doc_key, r.item_key) for r in leaks(spark, docs, items, sent_bytes=sent).collect()]
        assert got == [(5, 2)]
        passages = frame([(9, PROSE), (9, PROSE), (None, PROSE)]).withColumnRenamed("doc_id", "item_id")
        got = [(r.doc_key, r.item_key) for r in leaks(spark, docs, passages, sent_bytes=sent).collect()]
        assert sorted(got) == [(4, 9), (5, 9), (8, 9)]
        assert leaks(spark, frame([]), items, sent_bytes=sent).count() == 0
        assert leaks(spark, docs, items.limit(0), sent_bytes=sent).count() == 0


def test_words_beyond_ascii():
    words, first = decontaminate.plain_words(pa.array(["a“b”c\xa0d", "a b c d", "naïve—co", "naïve co"]))
    rows = [words[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
    assert rows[0] == rows[1] and rows[2] == rows[3]


def test_repeated_words_are_laid_out_in_bounded_blocks(monkeypatch):
    """Best overlaps of texts that are full of repeats, whole, in small blocks, and by the way for crowded rows."""
    rng = random.Random(7)
    docs = ["a " * 300, "a b " * 100, "b a c " * 60, " ".join(rng.choices("abc", k=200)), "x " * 40, ""]
    items = ["a " * 30, "a b " * 12, "c b a " * 9, " ".join(rng.choices("abc", k=40)), "b a", ""]
    (words, first), known = decontaminate.plain_words(pa.array(docs)), decontaminate.Items.of(pa.array(items))
    want = sorted(decontaminate.overlaps(words, first, known))
    assert (0, 0, 0, 0, 30, 30) in want and len(want) > 5
    for pairs, cells in ((1, 1), (50, 100), (5000, 64)):
        monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        monkeypatch.setattr(decontaminate, "CELLS", cells)
        assert sorted(decontaminate.overlaps(words, first, known)) == want
    exact = {(d, i, n) for d, i, n in brute(list(enumerate(docs[:4])), list(enumerate(items[:5])))}
    assert {(d, i) for d, i, *_ in want} <= {(d, i) for d, i, _ in exact}
    assert all((d, i, n) in exact for d, i, _, _, m, n in want if m == n)


def test_a_very_long_text_of_one_word(monkeypatch):
    (words, first), known = decontaminate.plain_words(pa.array(["a " * 200_000])), decontaminate.Items.of(pa.array(["a " * 100, "b c"]))
    assert list(decontaminate.overlaps(words, first, known)) == [(0, 0, 0, 0, 100, 100)]


def test_whatever_the_rule_accepts_is_hit():
    """Random substitutions in passages of 15 to 30 words: where the overlap counts, some mask reads equal words only."""
    rng = np.random.default_rng(3)
    for size in range(15, 31):
        item = np.arange(size, dtype=np.uint64)
        accepted = 0
        for n in range(1, size // 3 + 1):
            for _ in range(150):
                equal = np.ones(size, dtype=bool)
                equal[rng.choice(size, n, replace=False)] = False
                doc = np.where(equal, item, item + np.uint64(1000))
                if decontaminate.best_overlap(doc, item, np.zeros(1, np.int64)) is None:
                    continue
                accepted += 1
                assert any(all(equal[at + i] for i, read in enumerate(mask) if read == "1")
                           for mask in decontaminate.MASKS for at in range(size - len(mask) + 1)), (size, equal)
        assert accepted > 100
