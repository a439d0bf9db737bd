"""Rule statistics of documents, and isolation forests over them with thresholds from labelled rows.

Each tree splits a small sample at random values of random statistics, and documents that end after few splits are
unlike the others. There is a forest for each family of rules, so that what is odd in one family is not drowned by the
others. How odd a document may be is read from labelled rows: a threshold loses at most GOOD_LOSS of those labelled
good, and among such thresholds it has the greatest share of bad rows rejected less GOOD_WEIGHT times that of good
rows. A family in which no threshold gains anything rejects nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.words import mix, rows_of, slices, span_hashes, text_buffer, whole_windows, window_hashes, word_bounds
from tallywatch.operators.forest import DRAWS, OVERSAMPLING, lowest_draws, tree_draws

# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Trees, rows of each tree, bins of scores, the share of good rows that may be lost, and how much more the loss of a good
# row counts.
TREES = 128
TREE_ROWS = 256
BINS = 1000
GOOD_LOSS = 0.002
GOOD_WEIGHT = 20

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
    "n_exclamations",
)
# Families of rules, as pairs of counts that are divided.
FAMILIES = {
    "symbols": (("n_symbols", "n_words"),),
    "repeats": (("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words")),
    "letters": (("n_upper", "n_letters"), ("n_exclamations", "n_words")),
    "words": (("word_chars", "n_words"),),
}

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur at least twice, and which are not the first of their kind."""
    order = np.argsort(keys, kind="stable")
    held = keys[order]
    same = np.zeros(len(keys) + 1, dtype=bool)
    if len(keys):
        same[1:-1] = held[1:] == held[:-1]
    twice, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


def count_rules(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of every text of a column; NULL is an empty text."""
    data, offsets = text_buffer(texts)
    starts, ends, first = word_bounds(data, offsets)
    rows, n = rows_of(first), len(offsets) - 1
    out = {"n_words": np.diff(first)}
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1  # a word may end where the next row's begins
    points = np.cumsum(inside[:-1], dtype=np.int8).astype(bool) & ((data & 0xC0) != 0x80)
    out["word_chars"] = _per_row(points, offsets)
    for name, flags in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_letters", _LETTER)):
        out[name] = _per_row(flags[data], offsets)
    out["n_exclamations"] = _per_row(data == 33, offsets)

    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_ends = np.sort(np.concatenate([offsets[1:], breaks]))
    line_rows = np.sort(np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, side="right") - 1]))
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_rows = line_starts[with_word], line_ends[with_word], line_rows[with_word]
    lines = span_hashes(data, line_starts, line_ends) ^ mix(line_rows.astype(np.uint64), 1)
    out["n_lines"] = np.bincount(line_rows, minlength=n)
    out["n_dup_lines"] = np.bincount(line_rows[_repeated(lines)[1]], minlength=n)

    whole = np.flatnonzero(whole_windows(first, 3))
    threes = window_hashes(span_hashes(data, starts, ends), 3)[whole] ^ mix(rows[whole].astype(np.uint64), 2)
    found = whole[_repeated(threes)[0]]
    covered = np.zeros(len(starts), dtype=bool)
    for step in range(3):
        covered[found + step] = True
    out["n_repeat_words"] = _per_row(covered, first)
    return {name: out[name].astype(np.int64) for name in COUNTS}


def features(counts: dict[str, np.ndarray], family: str) -> np.ndarray:
    """The shares of a family as columns; 0 where there is nothing to divide by."""
    return np.column_stack([counts[part] / np.maximum(counts[whole], 1) for part, whole in FAMILIES[family]])


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    words = counts["n_words"]
    return (words < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * words)


@dataclass
class Forest:
    """Trees as arrays of nodes: the split statistic (-1 in a leaf), its value, the left child, and the path length."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    length: np.ndarray
    roots: np.ndarray
    normal: float
    threshold: float = math.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / expected length): near 1 for anomalies."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                split = self.feature[at]
                inner = split >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(split, 0)] >= self.value[at]
                at = np.where(inner, self.left[at] + right, at)
            total += self.length[at]
        return np.exp2(-total / (len(self.roots) * self.normal))


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search among n values."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow_forest(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 42) -> Forest:
    """An isolation forest of the rows of x; none or equal rows give leaves only."""
    random = np.random.default_rng(seed)
    size = min(tree_rows, len(x))
    return _forest([x[random.choice(len(x), size, replace=False)] if size else x for _ in range(trees)], size, random)


def _forest(samples: list[np.ndarray], size: int, random: np.random.Generator) -> Forest:
    """A tree per sample of `size` rows."""
    deepest = math.ceil(math.log2(max(size, 2)))
    nodes: list[list[float]] = []
    roots = []
    for sample in samples:
        roots.append(len(nodes))
        nodes.append([-1, 0, 0, 0])
        open_nodes = [(roots[-1], sample, 0)]
        while open_nodes:
            node, rows, depth = open_nodes.pop()
            low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(0), np.zeros(0))
            varying = np.flatnonzero(high > low)
            if depth >= deepest or not len(varying):
                nodes[node][3] = depth + _expected(len(rows))
                continue
            split = int(random.choice(varying))
            value = float(high[split] - random.random() * (high[split] - low[split]))  # above low, at most high
            right = rows[:, split] >= value
            nodes[node][:3] = [split, value, len(nodes)]
            open_nodes += [(len(nodes), rows[~right], depth + 1), (len(nodes) + 1, rows[right], depth + 1)]
            nodes += [[-1, 0, 0, 0], [-1, 0, 0, 0]]
    table = np.array(nodes)
    return Forest(
        table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3], np.array(roots),
        max(_expected(size), 1e-9),
    )


def rule_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: its key, COUNTS and base_failed. No shuffle."""
    long = T.LongType()
    schema = T.StructType(
        [T.StructField("key", docs.schema[key].dataType)] + [T.StructField(c, long) for c in COUNTS]
        + [T.StructField("base_failed", T.BooleanType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = count_rules(part["text"])
                yield pa.record_batch(
                    [part["key"], *(pa.array(counts[c]) for c in COUNTS), pa.array(base_failed(counts))],
                    names=["key", *COUNTS, "base_failed"],
                )

    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(count, schema)


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in COUNTS}


def _binned(counts: dict[str, np.ndarray], forests: dict[str, Forest]) -> dict[str, np.ndarray]:
    """The bin of every row's score in each family."""
    return {
        family: np.minimum(forest.score(features(counts, family)) * BINS, BINS - 1).astype(np.int32)
        for family, forest in forests.items()
    }


def with_scores(statistics: DataFrame, forests: dict[str, Forest]) -> DataFrame:
    """The statistics and, per family, the anomaly score in thousandths."""
    schema = T.StructType(statistics.schema.fields + [T.StructField(f"{f}_score", T.IntegerType()) for f in forests])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for family, bins in _binned(_columns(batch), forests).items():
                batch = batch.append_column(f"{family}_score", pa.array(bins))
            yield batch

    return statistics.mapInArrow(score, schema)


def tree_samples(passed: DataFrame, trees: int, tree_rows: int, oversampling: int = OVERSAMPLING) -> list[dict[str, np.ndarray]]:
    """The COUNTS of the rows of each tree, drawn from all rows of `passed`.

    A hash of key and counts gives a row a draw for every tree, and a tree takes the `tree_rows` lowest. Rows above a bound,
    which leaves about `oversampling` times as many, are dropped where they are, so that neither the shuffle nor what comes
    to the driver, trees * tree_rows rows, grows with the documents.
    """
    n_rows = passed.count()
    size = min(tree_rows, n_rows)
    u, v = (F.pmod(F.xxhash64("key", *COUNTS, F.lit(part)), F.lit(DRAWS)).alias(name) for part, name in enumerate("uv"))
    hashed = passed.select(*COUNTS, u, v)
    while True:
        share = oversampling * size / max(n_rows, 1)
        bound = F.lit(int(share * DRAWS)) if share < 1 else None
        drawn = lowest_draws(tree_draws(hashed, trees, bound), trees, size, COUNTS).select("tree_id", "place_in_draw", *COUNTS)
        rows = drawn.toPandas().sort_values(["tree_id", "place_in_draw"])
        if len(rows) == trees * size or share >= 1:
            break
        oversampling *= 8
    by_tree = dict(tuple(rows.groupby("tree_id")))
    return [{c: by_tree[t][c].to_numpy() if t in by_tree else np.zeros(0, np.int64) for c in COUNTS} for t in range(trees)]


def fit(
    statistics: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality",
    trees: int = TREES, tree_rows: int = TREE_ROWS, good_loss: float = GOOD_LOSS, seed: int = 42,
) -> dict[str, Forest]:
    """A forest with its threshold for each family.

    Every tree grows on `tree_rows` rows drawn from all that pass the base rules. The thresholds cover all labelled rows:
    their scores are counted in bins per label. A key labelled twice counts as its lower quality; NULL keys and labels
    are left out. Without labels of both kinds nothing is anomalous.
    """
    passed = statistics.filter(~F.col("base_failed"))
    samples = tree_samples(passed, trees, tree_rows)
    size = len(samples[0][COUNTS[0]])
    forests = {family: _forest([features(sample, family) for sample in samples], size, np.random.default_rng(seed))
               for family in FAMILIES}
    known = labels.select(labels[key].alias("key"), labels[quality].alias("quality")).dropna()
    known = known.groupBy("key").agg(F.min("quality").alias("quality"))
    scored = with_scores(passed, forests).join(known, "key")
    each = F.explode(F.array(*(
        F.struct(F.lit(f).alias("family"), F.col(f"{f}_score").alias("bin")) for f in forests
    ))).alias("e")
    bins = scored.select("quality", each).groupBy("e.family", "e.bin", "quality").count().collect()
    for family, forest in forests.items():
        good, bad = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        for family_, bin_, quality_, n in bins:
            if family_ == family:
                (good if quality_ else bad)[bin_] += n
        forest.threshold = _threshold(good, bad, good_loss)
    return forests


def _threshold(good: np.ndarray, bad: np.ndarray, good_loss: float) -> float:
    """The lowest bin to reject, or infinity."""
    if not (good.sum() and bad.sum()):
        return math.inf
    lost, caught = (np.cumsum(n[::-1])[::-1] / n.sum() for n in (good, bad))
    gain = np.where(lost <= good_loss, caught - GOOD_WEIGHT * lost, -1)
    # Among the best the middle one: as far from the good rows as from the bad.
    best = np.flatnonzero(gain == gain.max())
    return int(best[len(best) // 2]) if gain.max() > 0 else math.inf


def judged(statistics: DataFrame, forests: dict[str, Forest]) -> DataFrame:
    """The statistics, the scores, and whether each row is kept."""
    kept = ~F.col("base_failed")
    for family, forest in forests.items():
        kept &= F.col(f"{family}_score") < F.lit(float(forest.threshold))
    return with_scores(statistics, forests).withColumn("kept", kept)


def keep(docs: DataFrame, forests: dict[str, Forest], text: str = "text") -> DataFrame:
    """The rows of `docs` that the base rules and the forests keep, with all their columns and without a shuffle."""
    names = docs.columns
    at = names.index(text)
    numbered = docs.toDF(*(f"c{i}" for i in range(len(names))))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, f"c{at}"):
                counts = count_rules(part.column(at))
                kept = ~base_failed(counts)
                for family, bins in _binned(counts, forests).items():
                    kept &= bins < forests[family].threshold
                yield part.filter(pa.array(kept))

    return numbered.mapInArrow(select, numbered.schema).toDF(*names)
