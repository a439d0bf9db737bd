"""Hard negatives by exact integer scores.

Components become integers, and the score of two rows is their inner product, exact whatever its size. Scores are computed in
a residue number system: the component matrices modulo several small primes, as float32 with residues around 0, are
multiplied by the matrix product of the machine, in which every sum stays below 2^24 and is therefore exact. Balanced
digits of the Chinese remainder theorem (Garner's mixed radix) give the signed score; wrapping int64 arithmetic is right
as long as the score itself fits. As many primes are taken as the largest possible score needs.

Anchors and rows meet in cells of blocks by blocks, each in the memory of one task, and a cell sends on a few rows per
anchor only. The first pass finds the positives of each anchor, the second, over the same cells, the best rows of other
labels in the window below each positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.llm.links import stored

SCALE = 256
ANCHOR_STEP = 100
NOISE_STEP = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 5
# A negative has at least this share, 4 / 5, of the positive's score.
NUMERATOR, DENOMINATOR = 4, 5

# Components that a product sums up at once, and the largest prime: 256 * 255^2 < 2^24.
DEPTH = 256
LARGEST_PRIME = 511
LARGEST_SCORE = 1 << 60

# Bytes of components in a block of rows, and scores that a cell holds at once.
BLOCK_BYTES = 8 << 20
STRIP = 1 << 21


def primes() -> list[int]:
    """Primes up to LARGEST_PRIME, largest first."""
    return [n for n in range(LARGEST_PRIME, 2, -1) if all(n % k for k in range(2, math.isqrt(n) + 1))]


def moduli(largest: int) -> list[int]:
    """The primes whose product tells all scores from -largest to largest apart."""
    chosen, product = [], 1
    for p in primes():
        if product > 2 * largest:
            break
        chosen.append(p)
        product *= p
    return chosen


def balanced(values: np.ndarray, p: int) -> np.ndarray:
    """Residues modulo an odd p, from -(p - 1) / 2 to (p - 1) / 2."""
    half = p // 2
    return (values + half) % p - half


def scores(left: list[np.ndarray], right: list[np.ndarray], chosen: list[int]) -> np.ndarray:
    """Exact inner products of rows, given their residues per prime as float32."""
    total = np.zeros((len(left[0]), len(right[0])), np.int64)
    digits: list[np.ndarray] = []
    for k, p in enumerate(chosen):
        residue = np.zeros(total.shape, np.int32)
        for at in range(0, left[k].shape[1], DEPTH):
            residue += balanced((left[k][:, at: at + DEPTH] @ right[k][:, at: at + DEPTH].T).astype(np.int32), p)
        # Garner: what the digits before already say is taken off, and the rest divided by the primes before.
        for i, digit in enumerate(digits):
            residue = balanced((residue - digit) * pow(chosen[i], -1, p), p)
        digit = balanced(residue, p)
        digits.append(digit)
        weight = math.prod(chosen[:k]) & ((1 << 64) - 1)
        total += digit * np.array(weight, np.uint64).view(np.int64)
    return total


def residues(components: np.ndarray, chosen: list[int]) -> list[np.ndarray]:
    return [balanced(components, p).astype(np.float32) for p in chosen]


def best(values: np.ndarray, allowed: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest allowed values, highest first, ties by place."""
    places = np.flatnonzero(allowed)
    if len(places) > n:
        own = values[places]
        least = np.partition(own, len(own) - n)[len(own) - n]
        above = places[own > least]
        places = np.concatenate([above, places[own == least][: n - len(above)]])
    return places[np.argsort(-values[places], kind="stable")]


def _matrix(column: pa.ChunkedArray, dimension: int) -> np.ndarray:
    """Components as a matrix; shorter vectors end in zeros."""
    column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), dimension), np.int64)
    out[np.arange(dimension) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _strips(rows: pa.Table, anchors: pa.Table, dimension: int, chosen: list[int]) -> Iterator[tuple]:
    """The rows in the order of ids, and per strip of anchors their numbers and scores."""
    rows = rows.sort_by([("id", "ascending"), ("label", "ascending")])
    right = residues(_matrix(rows["v"], dimension), chosen)
    left = residues(_matrix(anchors["v"], dimension), chosen)
    ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
    step = max(1, STRIP // max(1, rows.num_rows))
    for at in range(0, anchors.num_rows, step):
        some = np.arange(at, min(at + step, anchors.num_rows))
        yield ids, labels, some, scores([m[some] for m in left], right, chosen)


def _table(columns: dict[str, list]) -> pa.Table:
    return pa.table({name: pa.array(np.concatenate([np.zeros(0, np.int64), *parts])) for name, parts in columns.items()})


def mine(
    spark: SparkSession, vectors: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, anchor_step: int = ANCHOR_STEP, noise_step: int = NOISE_STEP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for all anchors and positives.

    Rows without label, vector or a finite value for every component take no part, nor do rows without a key, which no
    result could name. Equal rows count once; rows of one key that differ all count, but for the anchor's own key, and
    tie by label. Vectors of different lengths are compared as if the shorter ended in zeros. Scores beyond 2^60 raise
    an error. Other columns do not matter, whatever their names.
    """
    plain = vectors.select(vectors[key].cast("bigint").alias("id"), vectors[label].cast("bigint").alias("label"),
                           vectors[vector].cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    shifted = F.when(F.col("id") % noise_step == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    plain = plain.dropna().filter(finite).select(
        "id", shifted.alias("label"), F.transform("x", lambda c: F.floor(c * SCALE)).alias("v"))
    plain = stored(spark, plain.distinct(), "vectors")

    is_anchor = F.col("id") % anchor_step == 0
    largest = F.max(F.array_max(F.transform("v", lambda c: F.abs(c.cast("double")))))
    n_rows, n_anchors, dimension, largest = plain.agg(
        F.count("*"), F.count_if(is_anchor), F.max(F.size("v")), largest).first()
    dimension, bound = max(dimension or 0, 1), int(largest or 0) ** 2 * max(dimension or 0, 1)
    if bound > LARGEST_SCORE:
        raise ValueError(f"components of up to {largest} in {dimension} dimensions give scores beyond 2^60")
    chosen = moduli(bound)
    block = max(1, block_bytes // (8 * dimension))
    row_blocks, anchor_blocks = (max(1, math.ceil(n / block)) for n in (n_rows, n_anchors))

    def dealt(frame: DataFrame, own: int, others: int, side: str, other: str, salt: int) -> DataFrame:
        """Every row in its own block, once per block of the other side."""
        everyone = F.sequence(F.lit(0).cast("bigint"), F.lit(others - 1).cast("bigint"))
        return frame.withColumn(side, F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(own))).withColumn(other, F.explode(everyone))

    rows = dealt(plain, row_blocks, anchor_blocks, "row_block", "anchor_block", 0).groupBy("row_block", "anchor_block")

    def per_cell(anchors: DataFrame, work, schema: str) -> DataFrame:
        asked = dealt(anchors, anchor_blocks, row_blocks, "anchor_block", "row_block", 1).groupBy("row_block", "anchor_block")
        return rows.cogroup(asked).applyInArrow(work, schema)

    def nearest(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {name: [] for name in ("anchor_key", "id", "score")}
        own, kinds, keys = (anchors[c].to_numpy() for c in ("id", "label", "anchor_key"))
        for ids, labels, some, found in _strips(rows, anchors, dimension, chosen):
            for i, line in zip(some, found):
                picked = best(line, (labels == kinds[i]) & (ids != own[i]), positives)
                out["anchor_key"].append(np.full(len(picked), keys[i]))
                out["id"].append(ids[picked])
                out["score"].append(line[picked])
        return _table(out)

    def windowed(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {name: [] for name in ("anchor_key", "place", "id", "score")}
        kinds, keys = (anchors[c].to_numpy() for c in ("label", "anchor_key"))
        tops = [np.array(t, np.int64) for t in anchors["scores"].to_pylist()]
        for ids, labels, some, found in _strips(rows, anchors, dimension, chosen):
            for i, line in zip(some, found):
                lows = -((-NUMERATOR * tops[i]) // DENOMINATOR)
                near = np.flatnonzero((line >= lows.min()) & (line <= tops[i].max()) & (labels != kinds[i]))
                for place, (low, top) in enumerate(zip(lows, tops[i])):
                    picked = near[best(line[near], (line[near] >= low) & (line[near] <= top), negatives)]
                    out["anchor_key"].append(np.full(len(picked), keys[i]))
                    out["place"].append(np.full(len(picked), place))
                    out["id"].append(ids[picked])
                    out["score"].append(line[picked])
        return _table(out)

    def first(frame: DataFrame, n: int, *by: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
        return frame.withColumn("rank", rank).filter(F.col("rank") <= n)

    anchors = plain.filter(is_anchor).withColumn("anchor_key", F.monotonically_increasing_id())
    anchors = stored(spark, anchors, "anchors")
    found = first(per_cell(anchors, nearest, "anchor_key bigint, id bigint, score bigint"), positives, "anchor_key")
    chosen_rows = F.sort_array(F.collect_list(F.struct("rank", "id", "score")))
    found = found.groupBy("anchor_key").agg(chosen_rows.alias("p"))
    asking = anchors.join(found, "anchor_key").select(
        "anchor_key", "id", "label", "v", F.col("p.id").alias("positives"), F.col("p.score").alias("scores"))
    asking = stored(spark, asking, "positives")
    held = per_cell(asking, windowed, "anchor_key bigint, place bigint, id bigint, score bigint")
    held = first(held, negatives, "anchor_key", "place")
    names = asking.select("anchor_key", F.col("id").alias("anchor_id"), "positives", "scores")
    place = F.col("place").cast("int")
    return held.join(names, "anchor_key").select(
        "anchor_id", F.get("positives", place).alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.get("scores", place).alias("positive_score"), F.col("score").alias("negative_score"))
