"""Isolation Forest (Liu, Ting and Zhou, 2008) over hourly counts.

The features are the count and the one-hot columns of place and type, none of which is materialised: a
row has at most three features that are not 0. Training rows are drawn by hash on the cluster, one task
grows a tree from its few rows, and what comes back is the node table, at most 2 * max_samples - 1 rows
per tree whatever the size of the input.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.functions.scores import COUNT_FEATURE, PLACE_PREFIX, TYPE_PREFIX
from tallywatch.schema import HOURLY_KEY

# The defaults of the model.
TREES = 100
MAX_SAMPLES = 256
SEED = 42

GROWN_FROM = ("tree_id", "place_in_draw", COUNT_FEATURE, "location_name", "crime_type")
OVERSAMPLING = 4
TREES_PER_TASK = 4
# A prime, and a primitive root of it; both halves of a draw are below the first.
DRAWS = 2**31 - 1
MIXER = 48271
ROOT = 1
# Decimals of a score, so that the order in which a mean is summed cannot show.
SCORE_DECIMALS = 12
REMEMBERED = 100_000

EULER_GAMMA = 0.5772156649

NODE_SCHEMA = (
    "tree_id int, node_id int, depth int, feature string, threshold double, "
    "left_id int, right_id int, n_rows long"
)


def mean_path(n: int) -> float:
    """Mean depth of a failed search in a binary search tree of n rows: c(n) of the paper."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER_GAMMA) - 2.0 * (n - 1) / n


def _hashed(text: Column, part: int) -> Column:
    """The part-th eight hex digits of the text's MD5 hash as a number below DRAWS."""
    digits = F.substring(F.md5(text.cast("binary")), 8 * part + 1, 8)
    return F.conv(digits, 16, 10).cast("long") % F.lit(DRAWS)


def row_text(counts: DataFrame, key: Sequence[str], seed: int) -> Column:
    """What is hashed of a row: the seed and its key, times as microseconds and NULL as nothing."""
    parts = [
        F.unix_micros(name) if counts.schema[name].dataType.typeName() == "timestamp" else F.col(name) for name in key
    ]
    return F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def multipliers(tree: int) -> tuple[int, int, int, int]:
    """Factor and summand of a tree for the upper and the lower half of its draws."""
    first = (MIXER * (tree + 1)) % DRAWS
    return first, (MIXER * first + 1) % DRAWS, (first * first + 7) % DRAWS, (MIXER * (first + tree)) % DRAWS


def depth_limit(per_tree: int) -> int:
    return math.ceil(math.log2(max(per_tree, 2)))


def hashed_rows(counts: DataFrame, seed: int, key: Sequence[str] = HOURLY_KEY, *kept: str) -> DataFrame:
    """Key, count and the columns kept of every row, with two numbers u and v by one MD5 hash of key and seed."""
    text = row_text(counts, key, seed)
    return counts.select(*key, COUNT_FEATURE, *kept, _hashed(text, 0).alias("u"), _hashed(text, 1).alias("v"))


def tree_draws(hashed: DataFrame, trees: int, bound: Column | None = None) -> DataFrame:
    """Every row once per tree, with its draw; with a bound only for the trees for which the upper half of the draw does not
    exceed it."""
    numbers = [multipliers(t) for t in range(trees)]
    factor, summand, low_factor, low_summand = (F.array(*map(F.lit, n)) for n in zip(*numbers))

    def upper(tree: Column) -> Column:
        return (F.col("u") * F.get(factor, tree) + F.get(summand, tree)) % F.lit(DRAWS)

    wanted = F.sequence(F.lit(0), F.lit(trees - 1))
    if bound is not None:
        wanted = F.filter(wanted, lambda tree: upper(tree) <= bound)
    tree = F.col("tree_id")
    lower = (F.col("v") * F.get(low_factor, tree) + F.get(low_summand, tree)) % F.lit(DRAWS)
    drawn = hashed.withColumn("tree_id", F.explode(wanted)).withColumn("draw", upper(tree) * F.lit(DRAWS) + lower)
    return drawn.drop("u", "v")


def lowest_draws(drawn: DataFrame, trees: int, per_tree: int, key: Sequence[str] = HOURLY_KEY) -> DataFrame:
    """The per_tree rows of lowest draw of each tree. The rows are few, so an adaptive plan would grow all trees in one
    task; a number of partitions of its own prevents that."""
    drawn = drawn.repartition(math.ceil(trees / TREES_PER_TASK), "tree_id")
    order = Window.partitionBy("tree_id").orderBy("draw", *key)
    return drawn.withColumn("place_in_draw", F.row_number().over(order)).filter(F.col("place_in_draw") <= per_tree)


def draw_samples(
    counts: DataFrame, n_rows: int, trees: int, per_tree: int, seed: int,
    key: Sequence[str] = HOURLY_KEY, oversampling: int = OVERSAMPLING,
) -> DataFrame:
    """per_tree rows for every tree, drawn without replacement.

    A row's key and the seed give two numbers, by one MD5 hash per row, and its draw for a tree is a linear function of
    them modulo a prime, so partitioning has no say in it; a tree takes the lowest draws. Trees for which a row's draw is
    above a bound that leaves about oversampling * per_tree rows are dropped before the row is repeated for the others,
    and the shuffle carries some oversampling * per_tree * trees rows.
    """
    share = oversampling * per_tree / n_rows
    bound = F.lit(int(share * DRAWS)) if share < 1 else None
    return lowest_draws(tree_draws(hashed_rows(counts, seed, key), trees, bound), trees, per_tree, key)


def node_chance(seed: int, tree: int, node: int) -> tuple[int, float]:
    """Two random numbers of a node, by a hash: which feature to split by, and where between its bounds."""
    digits = hashlib.md5(f"{seed}|{tree}|{node}".encode()).hexdigest()
    return int(digits[:8], 16), (int(digits[8:16], 16) + 0.5) / 2**32


def tree_grower(per_tree: int, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Function that grows one tree from the rows drawn for it. The root is node 1, the children of n are 2n and 2n + 1."""
    limit = depth_limit(per_tree)
    columns = ["tree_id", "node_id", "depth", "feature", "threshold", "left_id", "right_id", "n_rows"]
    count_feature, prefixes = COUNT_FEATURE, {"location_name": PLACE_PREFIX, "crime_type": TYPE_PREFIX}

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree_id"].iloc[0])
        features = {count_feature: rows["incident_count"].fillna(0).to_numpy(float)}
        for column, prefix in prefixes.items():
            for category in rows[column].dropna().unique():
                features[prefix + category] = (rows[column] == category).to_numpy(float)
        names = sorted(features)
        matrix = np.column_stack([features[name] for name in names])

        nodes = []
        pending = [(1, np.arange(len(matrix)), 0)]
        while pending:
            node, members, depth = pending.pop()
            block = matrix[members]
            low, high = block.min(axis=0), block.max(axis=0)
            varying = np.flatnonzero(low < high)
            if depth >= limit or not len(varying):
                nodes.append((tree, node, depth, None, None, None, None, len(members)))
                continue
            which, where = node_chance(seed, tree, node)
            split = varying[which % len(varying)]
            threshold = low[split] + where * (high[split] - low[split])
            goes_left = block[:, split] <= threshold
            nodes.append((tree, node, depth, names[split], threshold, 2 * node, 2 * node + 1, len(members)))
            pending += [(2 * node, members[goes_left], depth + 1), (2 * node + 1, members[~goes_left], depth + 1)]
        return pd.DataFrame(nodes, columns=columns).astype({"left_id": "Int32", "right_id": "Int32"})

    return grow


@dataclass(frozen=True)
class Forest:
    """A grown forest; nodes is the whole node table, bounded by trees * (2 * per_tree - 1) rows."""

    nodes: pd.DataFrame
    per_tree: int

    def table(self, spark: SparkSession) -> DataFrame:
        typed = self.nodes.astype({"left_id": "Int32", "right_id": "Int32"}).astype(object)
        return spark.createDataFrame(typed.where(typed.notna(), None).values.tolist(), NODE_SCHEMA)

    def raw_score(self, *columns: Column) -> Column:
        """Score of (incident_count, location_name, crime_type), from -1 (outlier) up to 0.

        Two more columns, arrays of names and values, are all the features of rows in which they are not empty.
        """
        return F.arrow_udf(forest_scorer(self), "double")(*columns)


def fit_forest(
    counts: DataFrame, trees: int = TREES, max_samples: int = MAX_SAMPLES, seed: int = SEED,
    key: Sequence[str] = HOURLY_KEY,
) -> Forest:
    """Grow a forest from a table of counts whose rows the key tells apart."""
    n_rows = counts.count()
    if not n_rows:
        raise ValueError("no rows to train on")
    per_tree = min(max_samples, n_rows)
    oversampling = OVERSAMPLING
    while True:
        forest = grow_forest(draw_samples(counts, n_rows, trees, per_tree, seed, key, oversampling), per_tree, seed)
        roots = forest.nodes[forest.nodes["node_id"] == ROOT]
        # A tree that the bound left short of rows is next to impossible, but would be wrong.
        complete = len(roots) == trees and (roots["n_rows"] == per_tree).all()
        if complete or oversampling * per_tree >= n_rows:
            return forest
        oversampling *= 8


def grow_forest(sample: DataFrame, per_tree: int, seed: int) -> Forest:
    """A tree per tree_id from the rows drawn for it, in the order of their places."""
    # Python gets what a tree is grown from and no more; pandas cannot hold every timestamp Spark can.
    grow = tree_grower(per_tree, seed)
    nodes = sample.select(*GROWN_FROM).groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA).toPandas()
    return Forest(nodes.sort_values(["tree_id", "node_id"], ignore_index=True), per_tree)


def forest_scorer(forest: Forest) -> Callable:
    """Arrow function for Forest.raw_score.

    It closes over plain arrays only, and walks the forest once per distinct combination a task meets: counts
    between the same two thresholds, and values no split asks for, are the same combination. What a task
    remembers is bounded; beyond that it starts anew.
    """
    nodes = forest.nodes
    split = nodes["feature"].notna().to_numpy()
    features = [COUNT_FEATURE, *sorted(set(nodes.loc[split, "feature"]) - {COUNT_FEATURE})]
    number = {name: i for i, name in enumerate(features)}
    row_of = pd.Series(np.arange(len(nodes)), index=pd.MultiIndex.from_frame(nodes[["tree_id", "node_id"]]))
    itself = np.arange(len(nodes))

    def child(side: str) -> np.ndarray:
        target = itself.copy()
        wanted = pd.MultiIndex.from_arrays([nodes.loc[split, "tree_id"], nodes.loc[split, side].astype(int)])
        target[split] = row_of.loc[wanted].to_numpy()
        return target

    feature = nodes["feature"].map(number).fillna(0).to_numpy(int)
    threshold = nodes["threshold"].astype(float).fillna(np.inf).to_numpy()
    left, right = child("left_id"), child("right_id")
    length = (nodes["depth"] + nodes["n_rows"].map(mean_path)).to_numpy(float)
    roots = np.flatnonzero((nodes["node_id"] == ROOT).to_numpy())
    depth = int(nodes["depth"].max())
    remembered, decimals = REMEMBERED, SCORE_DECIMALS
    scale = mean_path(forest.per_tree)
    cuts = np.unique(threshold[split & (feature == 0)])

    def names_after(prefix: str) -> tuple[list[str], np.ndarray]:
        own = [name for name in features if name.startswith(prefix)]
        return [name.removeprefix(prefix) for name in own], np.array([number[n] for n in own] + [-1])

    places, place_number = names_after(PLACE_PREFIX)
    types, type_number = names_after(TYPE_PREFIX)

    def walk(value_of: Callable[[np.ndarray], np.ndarray], n: int) -> np.ndarray:
        total = np.zeros(n)
        for root in roots:
            at = np.full(n, root)
            for _ in range(depth):
                at = np.where(value_of(feature[at]) <= threshold[at], left[at], right[at])
            total += length[at]
        if scale == 0:
            return np.full(n, -0.5)
        return np.round(-(2.0 ** (-total / len(roots) / scale)), decimals)

    def score_rows(known: pd.Series, count: np.ndarray, place: np.ndarray, kind: np.ndarray):
        """Scores of the rows, and the scores per combination known by then."""
        width = len(features) + 1
        cell = (np.searchsorted(cuts, count, side="left") * width + place + 1) * width + kind + 1
        missing = np.flatnonzero(known.index.get_indexer(cell) < 0)
        if len(missing):
            new, first = np.unique(cell[missing], return_index=True)
            c, p, k = (values[missing][first] for values in (count, place, kind))
            once = walk(lambda f: np.where(f == 0, c, (f == p) | (f == k)), len(new))
            known = pd.concat([known, pd.Series(once, index=new)])
        return known.to_numpy()[known.index.get_indexer(cell)], known

    def score_given(rows: np.ndarray, which: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Scores of rows that name all their features: (row, feature, value) entries, others are 0."""
        every, row = np.unique(rows, return_inverse=True)
        code = row * (len(features) + 1) + which
        order = np.argsort(code)
        code, values = code[order], values[order]
        number_of_row = np.arange(len(every))

        def value_of(wanted: np.ndarray) -> np.ndarray:
            wanted = number_of_row * (len(features) + 1) + wanted
            at = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
            return np.where(code[at] == wanted, values[at], 0.0)

        return walk(value_of, len(every))

    def indices(values: pa.Array, names: list[str]) -> np.ndarray:
        """Place of each value in the names, -1 for none."""
        found = pc.index_in(values, value_set=pa.array(names, pa.string()))
        return found.fill_null(-1).to_numpy(zero_copy_only=False)

    def score(batches: Iterator[Tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        nothing = known = pd.Series(dtype=float, index=pd.Index([], dtype="int64"))
        for count, place, kind, *given in batches:
            c = pc.fill_null(count.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
            p = place_number[indices(place, places)]
            k = type_number[indices(kind, types)]
            scores, known = score_rows(known if len(known) <= remembered else nothing, c, p, k)
            if given:
                names, values = given
                sizes = names.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                rows = np.repeat(np.arange(len(sizes)), sizes)
                which = indices(names.flatten(), features)
                value = values.flatten().to_numpy(zero_copy_only=False)
                # Where all the features that the forest asks for are those of the fields, so is the score.
                same = np.where(which == 0, value == c[rows], ((which == p[rows]) | (which == k[rows])) & (value == 1))
                named = np.bincount(rows[(which >= 0) & same], minlength=len(sizes))
                strange = np.bincount(rows[(which >= 0) & ~same], minlength=len(sizes))
                own = np.flatnonzero((sizes > 0) & ((strange > 0) | (named != 1 + (p >= 0) + (k >= 0))))
                if len(own):
                    used = (which >= 0) & np.isin(rows, own)
                    # A row whose names the forest does not know has no feature; one entry of 0 keeps it in.
                    entries = (np.append(rows[used], own), np.append(which[used], np.full(len(own), len(features))),
                               np.append(value[used], np.zeros(len(own))))
                    scores = scores.copy()
                    scores[own] = score_given(*entries)
            yield pa.array(scores)

    return score
