"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its shingles of five words: weight = count in the document * idf. The idf of a shingle
is 1 + ln(1 / share), share being the share of documents that have it but at least COMMON: the bulk of shingles, which
few documents have, weigh alike, and only boilerplate weighs less. Shares are exact counts over all documents: a shingle
that at least COMMON of all documents have is found in at least that share of the documents of some task, so each task
names its own candidates, and a second pass counts those.

Improved consistent weighted sampling draws per hash one (shingle, level) of each document, such that two documents draw
the same with a probability equal to their weighted Jaccard similarity. Bands of draws put documents into buckets.
Documents with the same words are one node from the start.

In each bucket all nodes are compared by the agreement of their draws, in the memory of one task, and what leaves it are
a spanning tree of greatest agreement and each node's NEAREST partners. In a bucket of up to NEAREST + 1 nodes these are
all pairs. Their number follows that of the nodes, not its square, and the
tree joins whatever any pair above the same agreement would join, but for pairs whose texts are less similar. The exact weighted Jaccard similarity of the texts
decides on each pair. A bucket of more than TOGETHER nodes is sorted by a longer key and taken in that many at a time, and
each of its nodes is also compared with the bucket's first.

That is a first round. In buckets whose nodes are in several classes after it, nodes outside the bucket's largest class are
then held against all nodes of the bucket in other classes, in cells of about TOGETHER by TOGETHER nodes. A cell
holds the shingles of its nodes, computes the similarity of every pair whose draws agree often enough and whose total
weights allow it, and sends on only links that join two classes: fewer than it has nodes, however many pairs it looked at.
After it every two nodes of a bucket are in one class, or agree too little, or were compared by their shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallywatch.llm.links import classes, scratch
from tallywatch.llm.words import mix, rows_of, signed, slices, span_hashes, text_buffer, whole_windows, window_hashes, word_bounds

SHINGLE = 5
SIMILARITY = 0.8
COMMON = 0.1
BANDS = 14
DRAWS_PER_BAND = 3
# Share of equal draws below which two documents are not compared any further: with 42 draws a pair of similarity 0.8
# falls short of it with a probability below one in a hundred thousand.
AGREEMENT = 0.5
NEAREST = 4
TOGETHER = 2048
# Draws in the longer key.
FINER = 6
# Shingles in a cell, beside its number of nodes, and distinct ones in a matrix.
CELL_SHINGLES = 1 << 21
COLUMNS = 2048
# Rows of a cell that are compared with its others at once.
STRIP = 256

COUNTERS = 1 << 18
BLOCK = 1 << 15

# Quantiles of the Gamma(2, 1) distribution, from its distribution function 1 - (1 + x) exp(-x).
_GRID = np.linspace(0, 30, 300_001)
_GAMMA = np.interp((np.arange(4096) + 0.5) / 4096, 1 - (1 + _GRID) * np.exp(-_GRID), _GRID).astype(np.float32)
_INVERSE_GAMMA = (1 / _GAMMA).astype(np.float32)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts, the first of them per text, and two hashes of its words.

    A text of one to four words is one shingle; a text without words has none.
    """
    data, offsets = text_buffer(texts)
    starts, ends, first = word_bounds(data, offsets)
    words, rows, n_words = span_hashes(data, starts, ends), rows_of(first), np.diff(first)
    whole = np.flatnonzero(whole_windows(first, SHINGLE))
    keys, of = window_hashes(words, SHINGLE)[whole], rows[whole]
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    content = [_folded(words, first, salt) for salt in (1, 2)]
    if len(short):
        at = np.searchsorted(of, short)
        keys, of = np.insert(keys, at, content[0][short]), np.insert(of, at, short)
    mixed = keys ^ mix(of.astype(np.uint64), 3)
    order = np.argsort(mixed, kind="stable")
    held = mixed[order]
    new = np.ones(len(held), dtype=bool)
    new[1:] = held[1:] != held[:-1]
    begins = np.flatnonzero(new)
    counts = np.zeros(len(keys), np.int64)
    counts[order[begins]] = np.diff(np.append(begins, len(held)))
    kept = np.flatnonzero(counts)
    bounds = np.searchsorted(of[kept], np.arange(len(offsets)))
    return keys[kept], counts[kept], bounds, *content


def _folded(words: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    """A hash of the word sequence of every row, 0 for none: the wrapping sum of words mixed with their position."""
    position = np.arange(len(words), dtype=np.uint64) - np.repeat(first[:-1], np.diff(first)).astype(np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(words ^ mix(position, salt), salt), out=sums[1:])
    return mix(sums[first[1:]] - sums[first[:-1]], salt) * (np.diff(first) > 0).astype(np.uint64)


class Weights:
    """idf of shingles: a sorted table of the common ones, one value for the rest."""

    def __init__(self, keys: np.ndarray, shares: np.ndarray, common: float):
        order = np.argsort(keys)
        self.keys, self.idf = keys[order], 1 + np.log(1 / np.maximum(shares[order], common))
        self.usual = 1 + np.log(1 / common)

    def of(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), self.usual)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            out[hit] = self.idf[at[hit]]
        return out


def draw(keys: np.ndarray, weights: np.ndarray, bounds: np.ndarray, draws: int) -> np.ndarray:
    """For every non-empty row of `bounds` its draws, as hashes of (shingle, level): one row per text, one column each."""
    n = len(bounds) - 1
    out = np.zeros((n, draws), np.uint64)
    filled = np.flatnonzero(np.diff(bounds))
    at = 0
    while at < len(filled):  # blocks of whole texts that stay in the cache
        end = max(at + 1, int(np.searchsorted(bounds[filled], bounds[filled[at]] + BLOCK)))
        begin, stop = bounds[filled[at]], bounds[filled[end - 1] + 1]
        k, log_w = keys[begin:stop], np.log(weights[begin:stop]).astype(np.float32)
        begins = bounds[filled[at:end]] - begin
        index = np.arange(stop - begin, dtype=np.int64)
        for j in range(draws):
            u = k * np.uint64(2 * int(_ODD[j]) + 1)
            u ^= u >> np.uint64(32)
            u *= np.uint64(0xD6E8FEB86659FD93)
            u ^= u >> np.uint64(29)
            quantile = (u & np.uint64(4095)).astype(np.int64)
            beta = ((u >> np.uint64(12)) & np.uint64(4095)).astype(np.float32) * np.float32(1 / 4096)
            one = ((u >> np.uint64(24)) & np.uint64(0xFFFFF)).astype(np.float32) + np.float32(0.5)
            two = (u >> np.uint64(44)).astype(np.float32) + np.float32(0.5)
            r = _GAMMA[quantile]
            level = np.floor(log_w * _INVERSE_GAMMA[quantile] + beta)
            c = -np.log(one * two * np.float32(2.0 ** -40))
            order = (np.log(np.maximum(c, np.float32(1e-12))) - r * (level - beta + 1)).view(np.int32)
            order = order ^ ((order >> 31) & np.int32(0x7FFFFFFF))
            least = np.minimum.reduceat((order.astype(np.int64) << 32) | index, begins) & 0xFFFFFFFF
            out[filled[at:end], j] = mix(k[least] + mix(level[least].astype(np.int64).view(np.uint64), j + 1))
        at = end
    return out


_ODD = np.random.default_rng(6).integers(1 << 40, 1 << 62, 512)


def _plain(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(docs[key].alias("id"), docs[text].alias("text"))


def common_shingles(docs: DataFrame, common: float = COMMON) -> Weights:
    """Exact shares of all shingles that at least `common` of the documents have, from `docs` (id, text).

    What comes to the driver is bounded whatever the corpus: first numbers of counters, of which there are COUNTERS,
    then at most (mean shingles per document / common) shingles.
    """

    def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, n = np.zeros(COUNTERS, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                keys = shingles(part["text"])[0]
                counters += np.bincount((keys % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
                n += part.num_rows
        found = np.flatnonzero(counters >= max(1, common * n))
        yield pa.record_batch([pa.array(found, pa.int32()), pa.array(np.full(len(found), n), pa.int64())], names=["counter", "n"])

    texts = docs.select("text")
    some = texts.mapInArrow(heavy, "counter int, n bigint").select("counter").distinct().collect()
    wanted = np.zeros(COUNTERS, dtype=bool)
    wanted[[r.counter for r in some]] = True

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                keys = shingles(part["text"])[0]
                keys = keys[wanted[(keys % np.uint64(COUNTERS)).astype(np.int64)]]
                found, n = np.unique(keys, return_counts=True)
                yield pa.record_batch([pa.array(signed(found)), pa.array(n.astype(np.int64))], names=["key", "n"])

    total = max(1, docs.count())
    rows = texts.mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    rows = rows.filter(F.col("n") > common * total).toPandas()
    return Weights(rows["key"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.float64) / total, common)


def sketches(docs: DataFrame, weights: Weights, bands: int = BANDS, per_band: int = DRAWS_PER_BAND) -> DataFrame:
    """Per document with words: id, two hashes of its words, its draws (two bytes each), its number of shingles, and per band the bucket and a
    longer key that starts with the same draws."""
    draws = bands * per_band
    schema = T.StructType([
        docs.schema["id"], T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
        T.StructField("draws", T.BinaryType()), T.StructField("shingles", T.LongType()), T.StructField("buckets", T.ArrayType(T.LongType(), False)),
        T.StructField("finer", T.ArrayType(T.LongType(), False)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                keys, counts, bounds, k1, k2 = shingles(part["text"])
                drawn = draw(keys, counts * weights.of(keys), bounds, draws)
                some = np.flatnonzero(np.diff(bounds))
                if not len(some):
                    continue
                drawn = drawn[some]
                buckets, finer = (np.zeros((len(some), bands), np.uint64) for _ in range(2))
                for b in range(bands):
                    for step in range(FINER):
                        finer[:, b] = mix(finer[:, b] ^ drawn[:, (b * per_band + step) % draws], b + 1)
                        if step == per_band - 1:
                            buckets[:, b] = finer[:, b]
                ends = pa.array(np.arange(len(some) + 1) * bands, pa.int32())
                short = np.ascontiguousarray((drawn & np.uint64(0xFFFF)).astype("<u2")).tobytes()
                yield pa.RecordBatch.from_arrays([
                    part["id"].take(pa.array(some)), pa.array(signed(k1[some])), pa.array(signed(k2[some])),
                    pa.array([short[i: i + 2 * draws] for i in range(0, len(short), 2 * draws)], pa.binary()),
                    pa.array(np.diff(bounds)[some]),
                    pa.ListArray.from_arrays(ends, pa.array(signed(buckets.ravel()))),
                    pa.ListArray.from_arrays(ends, pa.array(signed(finer.ravel()))),
                ], names=["id", "k1", "k2", "draws", "shingles", "buckets", "finer"])

    return docs.mapInArrow(run, schema)


def partners(draws: np.ndarray, least: int, nearest: int = NEAREST) -> list[tuple[int, int]]:
    """Pairs of rows with `least` equal draws or more: a spanning tree of greatest agreement, and each row's nearest."""
    n = len(draws)
    equal = np.zeros((n, n), np.int16)
    for column in draws.T:
        equal += column[:, None] == column[None, :]
    np.fill_diagonal(equal, -1)
    found = set()
    if n <= nearest + 1:
        close = np.argwhere(np.triu(equal >= least, 1))
        return [(a, b) for a, b in close.tolist()]
    near = np.argpartition(-equal, nearest, axis=1)[:, :nearest]
    for a, row in enumerate(near.tolist()):
        found.update((min(a, b), max(a, b)) for b in row if equal[a, b] >= least)
    outside = np.ones(n, dtype=bool)
    outside[0], reach, via = False, equal[0].copy(), np.zeros(n, np.int64)
    for _ in range(n - 1):
        b = int(np.argmax(np.where(outside, reach, -2)))
        a = int(via[b])
        if reach[b] >= least:
            found.add((min(a, b), max(a, b)))
        outside[b] = False
        closer = outside & (equal[b] > reach)
        reach[closer], via[closer] = equal[b][closer], b
    return list(found)


def _candidates(members: DataFrame, agreement: float, nearest: int) -> DataFrame:
    """Pairs (a, b) of nodes from `members` (bucket, finer, id, draws, centre); centre only in very large buckets."""
    pair = T.StructType([T.StructField(side, members.schema["id"].dataType) for side in ("a", "b")])
    # Only very large buckets may be split between partitions.
    split = [F.when(F.col("centre").isNotNull(), F.col(c)) for c in ("finer", "id")]
    ordered = members.repartitionByRange("bucket", *split).sortWithinPartitions("bucket", "finer", "id")

    def compare(rows: pa.RecordBatch, out: list[tuple]) -> None:
        ids = rows["id"].to_pylist()
        if len(ids) > 1:
            draws = np.frombuffer(b"".join(rows["draws"].to_pylist()), "<u2").reshape(len(ids), -1)
            least = int(np.ceil(agreement * draws.shape[1]))
            out += [(min(ids[a], ids[b]), max(ids[a], ids[b])) for a, b in partners(draws, least, nearest)]
        out += [(c, i) for c, i in zip(rows["centre"].to_pylist(), ids) if c is not None and c != i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            bucket = held["bucket"].to_numpy()
            edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist()]
            cuts = [c for a, b in zip(edges, [*edges[1:], len(bucket)]) for c in range(a, b, TOGETHER)]
            for a, b in zip(cuts, cuts[1:]):  # all but the last, which may go on
                compare(held.slice(a, b - a), out)
            held = held.slice(cuts[-1]) if cuts else None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["a", "b"])
                out = []
        if held is not None:
            compare(held, out)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["a", "b"])

    kinds = [to_arrow_type(f.dataType) for f in pair.fields]
    return ordered.mapInArrow(run, pair).distinct()


def _payloads(texts: DataFrame, *kept: str) -> DataFrame:
    """The shingles of `text` as keys (eight bytes each) and counts (four bytes each), beside the columns kept."""
    schema = T.StructType([*(texts.schema[c] for c in kept), T.StructField("keys", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                keys, counts, bounds, *_ = shingles(part["text"])
                small = counts.astype("<u4")
                ends = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                yield pa.RecordBatch.from_arrays([
                    *(part[c] for c in kept), pa.array([keys[a:b].tobytes() for a, b in ends], pa.binary()),
                    pa.array([small[a:b].tobytes() for a, b in ends], pa.binary())], names=schema.names)

    return texts.mapInArrow(run, schema)


class Profiles:
    """Weighted shingles of the nodes of a cell. A shingle that a node has n times is n entries of one idf each, so that
    the smaller of two weights is the sum over the entries that both nodes have."""

    def __init__(self, keys: list[bytes], counts: list[bytes], weights: Weights):
        n = np.array([len(k) // 8 for k in keys])
        every, times = np.frombuffer(b"".join(keys), "<u8"), np.frombuffer(b"".join(counts), "<u4").astype(np.int64)
        row = np.repeat(np.repeat(np.arange(len(n)), n), times)
        level = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        every = np.repeat(every, times)
        self.weight = weights.of(every)
        self.total = np.bincount(row, self.weight, len(n))
        _, column, holders = np.unique(every ^ mix(level.astype(np.uint64), 5), return_inverse=True, return_counts=True)
        # What one node alone has is in no intersection.
        shared = holders[column] > 1
        self.row, self.weight, self.column = row[shared], self.weight[shared], column[shared]
        self.bounds = np.searchsorted(self.row, np.arange(len(n) + 1))

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of some rows and the place of their row among these."""
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        place = np.repeat(np.arange(len(rows)), sizes)
        return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.bounds[rows], sizes), place

    def similarity(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of every row of `left` with every row of `right`."""
        shared = np.zeros((len(left), len(right)))
        (a, a_place), (b, b_place) = self._entries(left), self._entries(right)
        columns = np.intersect1d(self.column[a], self.column[b])
        for at in range(0, len(columns), COLUMNS):
            some = columns[at: at + COLUMNS]
            sides = []
            for entries, place, n in ((a, a_place, len(left)), (b, b_place, len(right))):
                where = np.minimum(np.searchsorted(some, self.column[entries]), len(some) - 1)
                own = some[where] == self.column[entries]
                side = np.zeros((n, len(some)))
                side[place[own], where[own]] = self.weight[entries[own]] if entries is a else 1
                sides.append(side)
            shared += sides[0] @ sides[1].T
        total = self.total[left][:, None] + self.total[right][None, :] - shared
        return np.divide(shared, total, out=np.zeros(shared.shape), where=total > 0)


def _joining(
    keep: Callable[[DataFrame, str], DataFrame], members: DataFrame, nodes: DataFrame, texts: DataFrame, found: DataFrame, weights: Weights,
    similarity: float, agreement: float,
) -> DataFrame:
    """Links (a, b) that join all similar nodes of a bucket which `found` leaves in different classes.

    `members` has bucket, id and the number of shingles, `nodes` id, draws and buckets.
    """
    id_type = members.schema["id"].dataType
    of = members.join(found, "id", "left").select("bucket", "id", "shingles", F.coalesce("class", "id").alias("class"))
    sizes = of.groupBy("bucket", "class").agg(F.count("*").alias("n"), F.sum("shingles").alias("s")).groupBy("bucket").agg(
        F.max_by("class", F.struct("n", "class")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"), F.sum("s").alias("s"))
    per_cell = F.greatest(F.lit(1), F.least(F.lit(TOGETHER), F.floor(F.lit(CELL_SHINGLES) / F.greatest(F.lit(1), F.col("s") / F.col("all")))))
    sizes = sizes.filter("all > most").select(
        "bucket", "main", F.ceil(F.col("all") / per_cell).alias("columns"),
        F.ceil((F.col("all") - F.col("most")) / per_cell).alias("rows"))
    # Every node stands in one column of cells, those outside the main class also ask in one row of cells.
    of = of.join(sizes, "bucket").withColumn("asks", F.col("class") != F.col("main")).withColumn(
        "column", F.pmod(F.xxhash64("id"), "columns")).withColumn("row", F.pmod(F.xxhash64("id", F.lit(1)), "rows"))
    of = keep(of, "unsure")
    down = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1), lambda r: F.struct(
        F.col("column").alias("x"), r.alias("y"), F.lit(True).alias("stands"), (F.col("asks") & (r == F.col("row"))).alias("asking")))
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("columns") - 1), lambda c: F.col("asks") & (c != F.col("column")))
    along = F.transform(others, lambda c: F.struct(
        c.alias("x"), F.col("row").alias("y"), F.lit(False).alias("stands"), F.lit(True).alias("asking")))
    cells = of.select("bucket", "id", "class", "asks", F.inline(F.concat(down, along)))
    own = of.select("id").distinct()
    profiles = nodes.select("id", "draws", "buckets").join(own, "id").join(_payloads(texts.join(own, "id"), "id"), "id")
    cells = cells.join(keep(profiles, "profiles"), "id")
    kind = to_arrow_type(id_type)
    schema = pa.schema([("a", kind), ("b", kind)])

    def compare(rows: pa.Table) -> pa.Table:
        n = rows.num_rows
        draws = np.frombuffer(b"".join(rows["draws"].to_pylist()), "<u2").reshape(n, -1)
        bands = rows["buckets"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        earlier = bands[:, : int(np.argmax(bands[0] == rows["bucket"][0].as_py()))]
        least = max(1, int(np.ceil(agreement * draws.shape[1])))
        ids, key = np.unique(rows["id"].to_numpy(), return_inverse=True)
        group = np.unique(rows["class"].to_numpy(), return_inverse=True)[1]
        asks, asking, stands = (rows[c].to_numpy() for c in ("asks", "asking", "stands"))
        left, right = np.flatnonzero(asking), np.flatnonzero(stands)
        profiles, out = None, []
        for at in range(0, len(left), STRIP):
            some = left[at: at + STRIP]
            equal = np.zeros((len(some), len(right)), np.int16)
            for column in draws.T:
                equal += column[some][:, None] == column[right][None, :]
            # Of two nodes that both ask, the one with the smaller id does. Two nodes that share a bucket of an earlier
            # band are compared there.
            wanted = (equal >= least) & (~asks[right][None, :] | (key[some][:, None] < key[right][None, :]))
            wanted &= group[some][:, None] != group[right][None, :]
            for column in earlier.T:
                wanted &= column[some][:, None] != column[right][None, :]
            if not wanted.any():
                continue
            profiles = profiles or Profiles(rows["keys"].to_pylist(), rows["counts"].to_pylist(), weights)
            # A similarity is at most the smaller total weight by the larger.
            x, y = profiles.total[some][:, None], profiles.total[right][None, :]
            wanted &= np.minimum(x, y) >= (similarity - 1e-9) * np.maximum(x, y)
            l, r = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
            close = (profiles.similarity(some[l], right[r]) >= similarity - 1e-9) & wanted[np.ix_(l, r)]
            for i, line in zip(some[l], close):
                near = right[r[line]]
                near = near[group[near] != group[i]]
                for first in near[np.unique(group[near], return_index=True)[1]]:
                    out.append((key[i], key[first]))
                    group[group == group[first]] = group[i]
        a, b = (np.array([pair[side] for pair in out], np.int64) for side in (0, 1))
        return pa.table([pa.array(ids[f(a, b)], kind) for f in (np.minimum, np.maximum)], schema=schema)

    return cells.groupBy("bucket", "x", "y").applyInArrow(compare, T.StructType([
        T.StructField("a", id_type), T.StructField("b", id_type)])).distinct()


def similarities(left: pa.Array, right: pa.Array, weights: Weights) -> np.ndarray:
    """Weighted Jaccard similarity of the texts of two columns, row by row; 0 where both have no words."""
    sides = []
    for texts in (left, right):
        keys, counts, bounds, *_ = shingles(texts)
        of = np.repeat(np.arange(len(texts)), np.diff(bounds))
        sides.append((keys ^ mix(of.astype(np.uint64), 3), counts * weights.of(keys), of))
    keys, w, of = (np.concatenate([a, b]) for a, b in zip(*sides))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    first, second = order[:-1][same], order[1:][same]
    shared = np.bincount(of[first], np.minimum(w[first], w[second]), len(left))
    total = np.bincount(of, w, len(left)) - shared
    return np.divide(shared, total, out=np.zeros(len(left)), where=total > 0)


def _similar(pairs: DataFrame, docs: DataFrame, weights: Weights, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    # The first node of a large bucket is `a` in many pairs. Its text comes last, when the rows are large enough for the
    # adaptive plan to split them.
    pairs = pairs.join(docs.toDF("b", "tb"), "b").join(docs.toDF("a", "ta"), "a").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ta"):
                for some in slices(part, "tb"):
                    close = similarities(some["ta"], some["tb"], weights) >= similarity - 1e-9
                    yield some.select(["a", "b"]).filter(pa.array(close))

    return pairs.mapInArrow(run, T.StructType(pairs.schema.fields[:2]))


def near_duplicates(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
    similarity: float = SIMILARITY, common: float = COMMON, agreement: float = AGREEMENT, nearest: int = NEAREST,
) -> DataFrame:
    """One row per row of `docs`: its key as `id` and `class`, the smallest key of its group.

    A group holds the documents that links of similarity `similarity` or more connect; documents with the same words are
    always linked. Rows with one key are versions of one document and share its class. Texts without words and NULL
    texts are their own class, NULL keys have none. Needs an orderable key; other columns are ignored.
    """
    docs = _plain(docs, key, text)
    weights = common_shingles(docs, common)
    with scratch(spark) as keep:
        sketch = keep(sketches(docs.dropna(subset=["id"]), weights), "sketches")
        nodes = sketch.groupBy("k1", "k2").agg(
            F.min("id").alias("id"), *(F.first(c).alias(c) for c in ("draws", "shingles", "buckets", "finer")))
        nodes = keep(nodes, "nodes")
        members = nodes.select("id", "draws", "shingles", F.inline(F.arrays_zip("buckets", "finer")).alias("bucket", "finer"))
        shared = nodes.select("id", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
            F.count("*").alias("size"), F.min("id").alias("first")).filter("size > 1")
        centre = F.when(F.col("size") > TOGETHER, F.col("first"))
        members = members.join(shared, "bucket").select(
            "bucket", "finer", "id", "draws", "shingles", "size", centre.alias("centre"))
        members = keep(members, "members")
        same = sketch.join(nodes.select("k1", "k2", F.col("id").alias("node")), ["k1", "k2"]).select("id", "node")
        versions = same.filter("id != node").select(F.col("id").alias("a"), F.col("node").alias("b"))
        texts = docs.dropna(subset=["text"]).join(members.select("id").distinct(), "id", "left_semi")
        texts = keep(texts, "texts")

        pairs = keep(_candidates(members, agreement, nearest), "pairs")
        found = classes(spark, _similar(pairs, texts, weights, similarity).union(versions))
        unsure = members.filter(F.col("size") > nearest + 1).select("bucket", "id", "shingles")
        links = keep(_joining(keep, unsure, nodes, texts, found, weights, similarity, agreement), "links")
        if not links.isEmpty():
            found = classes(spark, found.select(F.col("id").alias("a"), F.col("class").alias("b")).union(links))
    return docs.select("id").join(found, "id", "left").select("id", F.coalesce("class", "id").alias("class"))
