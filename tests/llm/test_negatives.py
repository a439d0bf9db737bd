import math
import random

import numpy as np
import pytest

from tallywatch.llm import negatives
from tallywatch.llm.negatives import mine

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def expected(rows):
    """Rows of the result, by Python's integers."""
    seen = set()
    for key, label, vector in rows:
        if None in (key, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        seen.add((key, (label + 1) % 10 if key % 7 == 0 else label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for key, label, v in seen:
        if key % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), other, kind) for other, kind, w in seen if (other, kind, w) != (key, label, v)]
        for p, positive, _ in sorted(s for s in scored if s[2] == label and s[1] != key)[:5]:
            below = sorted(s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            out += [(key, positive, i + 1, other, -p, -s) for i, (s, other, _) in enumerate(below)]
    return sorted(out)


def got(spark, rows, parts=3, **options):
    frame = spark.createDataFrame([("x", *r, "y", "z") for r in rows],
                                  "id string, vec_id bigint, label int, embedding array<float>, v string, score string")
    return sorted(tuple(r[c] for c in COLUMNS) for r in mine(spark, frame.repartition(parts), **options).collect())


def generated(seed, n=400, dimension=8, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i * 4, int(rng.integers(0, 4)), (rng.normal(size=dimension) * spread).astype("float32").tolist()) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [negatives.BLOCK_BYTES, 64 * 40])
def test_generated_vectors(spark, block_bytes):
    rows = generated(1)
    want = expected(rows)
    assert len(want) > 50
    assert got(spark, rows, block_bytes=block_bytes) == want


def test_ties_go_to_the_smaller_id(spark):
    rng = random.Random(2)
    rows = [(i * 5, rng.randrange(3), [rng.choice([0.0, 0.5, 1.0])] * 3) for i in range(300)]
    want = expected(rows)
    assert len(want) > 50 and got(spark, rows, block_bytes=3 * 8 * 50) == want


def test_large_components_need_more_primes(spark):
    rows = generated(3, 150, 5, 1e5)
    assert len(negatives.moduli(5 * (256 * 4 * 10**5) ** 2)) > len(negatives.moduli(10**6))
    assert got(spark, rows) == expected(rows)


def test_scores_are_exact_in_many_dimensions():
    rng = np.random.default_rng(4)
    for size, dimension in ((3, 1), (1000, 700), (2**20, 1000), (2**29, 3)):
        a, b = (rng.integers(-size, size + 1, (n, dimension)) for n in (7, 9))
        chosen = negatives.moduli(dimension * size * size)
        found = negatives.scores(negatives.residues(a, chosen), negatives.residues(b, chosen), chosen)
        assert (found == a @ b.T).all()
    extreme = np.full((2, 600), -(2**20))
    chosen = negatives.moduli(600 * 2**40)
    assert (negatives.scores(*(negatives.residues(m, chosen) for m in (extreme, -extreme)), chosen) == -600 * 2**40).all()


def test_partial_sums_stay_exact_in_float32():
    assert negatives.DEPTH * (negatives.LARGEST_PRIME // 2) ** 2 < 2**24
    assert all(n % k for n in negatives.primes() for k in range(2, n))


def test_scores_that_do_not_fit_are_refused(spark):
    with pytest.raises(ValueError, match="beyond"):
        got(spark, [(0, 1, [1e30]), (1, 1, [1.0])])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(None, 1, [1.0]), (100, None, [1.0]), (200, 1, None), (300, 1, [None, 1.0]), (400, 1, [nan]), (500, 1, [inf, 1.0]), (600, 1, []),
           (601, 1, [1.0, 1.0]), (602, 2, [1.0]), (700, 3, [0.5]), (-100, 1, [1.0, 0.5]), (-7, 0, [1.0, 0.25]), (3, 2, [1.0, 0.3])]
    padded = [(k, l, None if v is None else v + [0.0] * (2 - len(v))) for k, l, v in odd]
    assert got(spark, odd + odd) == expected(padded)
    assert {r[0] for r in got(spark, odd)} == {-100, 600}
    assert got(spark, []) == []
    assert got(spark, [(100, 1, [1.0])]) == []


def test_a_third_of_all_rows_alike(spark):
    rows = generated(5, 300) + [(10_001 + i, 1, [1.0] * 8) for i in range(150)]
    assert got(spark, rows, block_bytes=64 * 64) == expected(rows)
