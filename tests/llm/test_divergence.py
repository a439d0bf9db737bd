import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from tallywatch.llm import divergence as module
from tallywatch.llm.divergence import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least, top=50):
    """Rows of the result, by dictionaries."""
    counts, spread = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = [t.translate(UPPER) for t in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(terms)
        spread[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in spread[lang].items() if n >= least]
        own = {s: c for (g, s), c in counts.items() if g == lang}
        whole = sum(own.values(), Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        for s in own:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != s]
            ahead = [(q[t] - p[s][t], t.encode(), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(ahead)[:top])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(sorted(found))]
    return sorted(out)


COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def got(spark, rows, parts=3, **options):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("term", "lang", "n", "source", "text", "block", "p")])
    frame = spark.createDataFrame([("x", a, "1", b, c, "y", "z") for a, b, c in rows], schema).repartition(parts)
    return sorted(tuple(r[c] for c in COLUMNS) for r in divergence(spark, frame, **options).collect())


def generated(seed, n=160):
    rng = random.Random(seed)
    words = ["a", "be", "Sea", "LATER", "exactly8", "ninechars", "sixteencharacter", "seventeencharacte", "é", "日本語", "naïveté",
             "x" * 32, "y" * 33, "z" * 200, "ÀÉ" * 20, "d'accord", "co-op", "42nd"]
    rows = []
    for i in range(n):
        words_here = rng.choices(words, weights=range(1, len(words) + 1), k=rng.randrange(30))
        rows.append((rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s1", "s2", "s3", None, "é"]), rng.choice(" \n.,").join(words_here)))
    return rows


def test_generated_texts(spark, monkeypatch):
    rows = generated(1)
    assert got(spark, rows, least_documents=5) == expected(rows, 5)
    monkeypatch.setattr(module, "CELLS", 8)
    assert got(spark, rows, least_documents=2) == expected(rows, 2)
    assert got(spark, rows, least_documents=5, top=2) == expected(rows, 5, 2)


def test_terms_are_kept_by_documents_not_by_occurrences(spark):
    rows = [("en", "a", "rare " * 100), ("en", "b", "often")] + [("en", "a", "often Often")] * 4
    assert got(spark, rows, least_documents=5) == expected(rows, 5)
    assert {r[3] for r in got(spark, rows, least_documents=5) if r[2] == "term"} <= {"often"}


def test_without_kept_terms_and_without_text(spark):
    rows = [("en", "a", "one"), ("en", "b", None), ("en", "c", ""), ("de", None, "..."), (None, None, None)]
    want = [("en", s, "pair", o, 0, i + 1) for s in "abc" for i, o in enumerate(x for x in "abc" if x != s)]
    assert got(spark, rows) == sorted(want) == expected(rows, 30)
    assert got(spark, []) == []


def test_one_very_long_text_counts_as_one_document(monkeypatch):
    monkeypatch.setattr(module, "BLOCK_TERMS", 7)
    rng = random.Random(3)
    text = " ".join(rng.choice(["aa", "b" * 9, "c" * 40, "Dd"]) for _ in range(100))
    want = Counter(t.translate(UPPER) for t in TERM.findall(text))
    found = module.count_slice(pa.array([text]), np.zeros(1, np.int64))
    assert {t: n for c in found.values() for t, n in zip(module.spelled(c).to_pylist(), c.n.tolist())} == want
    assert all((c.docs == 1).all() for c in found.values())


def test_radix_order_sorts_and_keeps_the_order_of_equals():
    rng = np.random.default_rng(2)
    high, low = (rng.integers(0, 5, 1000).astype(np.uint64) << np.uint64(s) for s in (60, 13))
    assert module.radix_order(high, low).tolist() == np.lexsort((low, high)).tolist()
    assert module.radix_order(np.zeros(0, np.uint64)).tolist() == []


def test_held_counts_are_sent_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(module, "HELD_TERMS", 2)
    rows = generated(4, 60)
    counted = module.term_counts(spark.createDataFrame([(a or "", b or "", c) for a, b, c in rows], "lang string, source string, text string"))
    total = counted.groupBy().sum("n").first()[0]
    assert total == sum(len(TERM.findall(r[2])) for r in rows)


def test_shares_of_large_counts_are_exact(spark):
    rows = [(10**15, 3 * 10**15 + 7, 12345), (0, 10, 3), (9, 9, 1), (0, 0, 1)]
    frame = spark.createDataFrame(rows, "c bigint, t bigint, v bigint")
    assert [r[0] for r in frame.select(module.share("c", "t", "v")).collect()] == [
        1 + 10**9 * (c + 5) // (t + 5 * v) for c, t, v in rows]
