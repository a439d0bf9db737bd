"""How far the sources of a language are apart in their words.

A term is a run of ASCII letters and bytes above 127, ASCII letters in lower case. Terms are counted by sorting packed
words: up to eight bytes are one uint64, up to sixteen two, in big-endian order; no term holds a byte 0, so the packing
loses nothing. A radix sort by digits of 16 bits, each a stable counting sort in numpy, brings equal terms
together, and runs of the sorted array are the counts. Longer terms are sorted as bytes, in one bucket per power of two of
their length. Tasks count their rows slice by slice and send counts, never words.

A language keeps the terms that enough of its documents have. For a kept term every source of the language has the smoothed share
p = 1 + floor(10^9 * (count + SMOOTHING) / (N + SMOOTHING * V)), in integers by long division. Distances between
sources are sums over blocks of terms, each a matrix of terms by sources in the memory of one task; what a block
sends on are its sums per pair of sources, as many as the result has rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.llm.links import stored
from tallywatch.llm.words import LOWER, slices, text_buffer, word_bounds

LEAST_DOCUMENTS = 30
SMOOTHING = 5
# Digits of 1,000 in the scale of shares, 10^9.
STEP = 1000
SCALE_STEPS = 3
TOP = 50

# Terms of a very long text that are sorted at once, and distinct terms that a task keeps before it sends them on.
BLOCK_TERMS = 1 << 20
HELD_TERMS = 1 << 19
# Cells of a block of terms by sources.
CELLS = 1 << 18

BETWEEN = np.ones(256, dtype=bool)
BETWEEN[0x41:0x5B] = BETWEEN[0x61:0x7B] = BETWEEN[0x80:] = False
_MASKS = np.array([0] + [((1 << 64) - 1) ^ ((1 << (64 - 8 * n)) - 1) for n in range(1, 9)], np.uint64)


def radix_order(*words: np.ndarray) -> np.ndarray:
    """Order of the rows of some uint64 columns, the first the most significant; equal rows stay in their order."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bytes of spans of up to eight bytes, as numbers that sort like them. `data` has eight bytes to spare."""
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)[starts]
    return np.ascontiguousarray(eight).view(">u8").ravel().astype(np.uint64) & _MASKS[lengths]


class Counted:
    """Distinct (term, group) of one width with occurrences and documents; terms are rows of uint64 or byte strings."""

    def __init__(self, terms: list[np.ndarray], group: np.ndarray, n: np.ndarray, docs: np.ndarray):
        self.terms, self.group, self.n, self.docs = terms, group, n, docs

    def __len__(self) -> int:
        return len(self.group)


def runs(terms: list[np.ndarray], group: np.ndarray, n: np.ndarray, docs: np.ndarray, row: np.ndarray | None = None) -> Counted:
    """Equal (term, group) brought together. With `row`, ascending on entry, documents are the distinct rows."""
    if terms[0].dtype.kind == "S":
        order = np.argsort(group, kind="stable")
        order = order[np.argsort(terms[0][order], kind="stable")]
    else:
        order = radix_order(*terms, group.astype(np.uint64))
    terms, group = [t[order] for t in terms], group[order]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = group[1:] != group[:-1]
        for t in terms:
            new[1:] |= t[1:] != t[:-1]
    begins = np.flatnonzero(new)
    if row is None:
        docs = docs[order]
    else:
        row = row[order]
        docs = new.astype(np.int64)
        docs[1:] |= row[1:] != row[:-1]
    if not len(begins):
        return Counted(terms, group, n, docs)
    return Counted([t[begins] for t in terms], group[begins], np.add.reduceat(n[order], begins), np.add.reduceat(docs, begins))


def count_slice(texts: pa.Array, group: np.ndarray) -> dict[int, Counted]:
    """Counts of the terms of some texts per width: 8 and 16 for packed words, powers of two above for long terms."""
    data, offsets = text_buffer(texts)
    starts, ends, first = word_bounds(data, offsets, BETWEEN[data])
    lengths = ends - starts
    row = np.repeat(np.arange(len(group)), np.diff(first))
    data = np.concatenate([LOWER[data], np.zeros(16, np.uint8)])
    if len(group) == 1 and len(starts) > BLOCK_TERMS:
        found: dict[int, Counted] = {}
        for at in range(0, len(starts), BLOCK_TERMS):
            some = slice(at, at + BLOCK_TERMS)
            found = merged(found, _count(data, starts[some], lengths[some], row[some], group))
        for c in found.values():
            c.docs = np.ones(len(c), np.int64)
        return found
    return _count(data, starts, lengths, row, group)


def _count(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, row: np.ndarray, group: np.ndarray) -> dict[int, Counted]:
    width = np.where(lengths <= 8, 8, 16)
    long = np.flatnonzero(lengths > 16)
    width[long] = 1 << np.ceil(np.log2(lengths[long])).astype(np.int64)
    found = {}
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        begin, size = starts[own], lengths[own]
        if w <= 16:
            terms = [packed(data, begin, np.minimum(size, 8))]
            if w == 16:
                terms.append(packed(data, begin + 8, size - 8))
        else:
            cells = np.zeros((len(own), w), np.uint8)
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            of = np.repeat(np.arange(len(own)), size)
            cells[of, at] = data[begin[of] + at]
            terms = [cells.view(f"S{w}").ravel()]
        ones = np.ones(len(own), np.int64)
        found[w] = runs(terms, group[row[own]], ones, ones, row[own])
    return found


def merged(a: dict[int, Counted], b: dict[int, Counted]) -> dict[int, Counted]:
    out = dict(a)
    for w, c in b.items():
        if w in a:
            d = a[w]
            terms = [np.concatenate(t) for t in zip(d.terms, c.terms)]
            c = runs(terms, *(np.concatenate([getattr(d, x), getattr(c, x)]) for x in ("group", "n", "docs")))
        out[w] = c
    return out


def spelled(c: Counted) -> pa.Array:
    """The terms as strings."""
    if c.terms[0].dtype.kind == "S":
        return pa.array(c.terms[0].tolist(), pa.binary()).cast(pa.string())
    cells = np.stack([t.byteswap() for t in c.terms], axis=1).view(np.uint8).reshape(len(c), -1)
    inside = cells != 0
    ends = np.concatenate([[0], np.cumsum(inside.sum(axis=1))]).astype(np.int32)
    flat = np.ascontiguousarray(cells[inside])
    return pa.StringArray.from_buffers(len(c), pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes()))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of `docs` (lang, source, text), partial sums per task. Every group has the term ''
    too, with counts of 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counted] = {}
        number: dict[tuple[str, str], int] = {}
        sent: set[int] = set()

        def batch_of(names: list[tuple[str, str]], group: np.ndarray, term: pa.Array, n: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
            lang, source = (pa.array([name[i] for name in names], pa.string()).take(pa.array(group)) for i in (0, 1))
            return pa.RecordBatch.from_arrays([lang, source, term, pa.array(n), pa.array(d)], names=["lang", "source", "term", "n", "docs"])

        def all_held() -> Iterator[pa.RecordBatch]:
            names = list(number)
            new = np.array(sorted(set(number.values()) - sent), np.int64)
            if len(new):
                zeros = np.zeros(len(new), np.int64)
                yield batch_of(names, new, pa.array([""] * len(new), pa.string()), zeros, zeros)
            sent.update(new.tolist())
            for w in list(held):
                c = held.pop(w)
                step = max(1, (4 << 20) // w)
                for at in range(0, len(c), step):
                    some = slice(at, at + step)
                    part = Counted([t[some] for t in c.terms], c.group[some], c.n[some], c.docs[some])
                    yield batch_of(names, part.group, spelled(part), part.n, part.docs)

        for batch in batches:
            for part in slices(batch, "text"):
                names = zip(part["lang"].to_pylist(), part["source"].to_pylist())
                group = np.array([number.setdefault(name, len(number)) for name in names], np.int64)
                held = merged(held, count_slice(part["text"], group))
                if sum(len(c) * w for w, c in held.items()) > HELD_TERMS * 8:
                    yield from all_held()
        yield from all_held()

    return docs.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(10^9 * (count + SMOOTHING) / (total + SMOOTHING * terms)) of three columns, by long division.

    Exact while the divisor is below 2^63 / 1,000, some 9 * 10^15 occurrences.
    """
    divisor, left, quotient = f"({total} + {SMOOTHING} * {terms})", f"({count} + {SMOOTHING})", "0L"
    for _ in range(SCALE_STEPS):
        more = f"({left} * {STEP})"
        quotient, left = f"({quotient} * {STEP} + {more} div {divisor})", f"({more} % {divisor})"
    return F.expr(f"{quotient} + 1")


def _distances(terms: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums over one block of terms of the distances between every two sources of its language."""
    lang, names = sources["lang"][0], sources["sources"].combine_chunks().flatten()
    without = sources["without"].combine_chunks().flatten().to_numpy()
    place = pc.index_in(terms["source"], value_set=names).to_numpy()
    term = terms["term"].combine_chunks().dictionary_encode()
    shares = np.repeat(without[:, None], len(term.dictionary), axis=1)
    shares[place, term.indices.to_numpy()] = terms["p"].to_numpy()
    first, second = np.triu_indices(len(names), 1)
    sums = [np.abs(shares[i + 1:] - shares[i]).sum(axis=1) for i in range(len(names) - 1)]
    value = np.concatenate([np.zeros(0, np.int64), *sums])
    return pa.table([
        pa.array([lang.as_py()] * len(value), pa.string()), names.take(pa.array(first)), names.take(pa.array(second)),
        pa.array(value)], names=["lang", "a", "b", "value"])


def divergence(
    spark: SparkSession, docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    least_documents: int = LEAST_DOCUMENTS, top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of all sources: `pair` rows give the distance to every other source of the
    language, `term` rows the `top` terms whose share in the source exceeds that in the language most.

    NULL in any of the three columns is the empty string. Rows are documents, so equal rows count as often as they
    stand there. A group without terms has pairs, a language without kept terms has pairs of distance 0, no rows give no
    rows, and a language of one source no pairs. Other columns do not matter, whatever their names.
    """
    plain = docs.select(*(F.coalesce(docs[c], F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    counts = term_counts(plain).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = stored(spark, counts, "counts")

    same = Window.partitionBy("lang", "term")
    kept = counts.filter("term != ''").select(
        "lang", "source", "term", "n", F.sum("n").over(same).alias("lang_n"), F.sum("docs").over(same).alias("documents"),
        (F.row_number().over(same.orderBy("source")) == 1).cast("bigint").alias("once"))
    kept = stored(spark, kept.filter(F.col("documents") >= least_documents).drop("documents"), "kept")

    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("once").alias("terms"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "lang_total", "terms"])
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") * F.count("*").over(Window.partitionBy("lang")) / CELLS))
    groups = stored(spark, groups.withColumn("blocks", blocks.cast("bigint")), "groups")

    placed = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"),
        F.pmod(F.xxhash64("term"), "blocks").alias("block"))
    placed = stored(spark, placed, "shares")
    value, item = F.desc("value"), F.asc("item")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(value, item))
    result = ["lang", "source", "part", "item", "value", "rank"]
    ahead = placed.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("p - q").alias("value"))
    ahead = ahead.withColumn("rank", rank).filter(F.col("rank") <= top)

    without = F.when(F.col("terms") > 0, share("0L", "total", "terms")).otherwise(F.lit(0))
    lists = groups.groupBy("lang", "blocks").agg(F.sort_array(F.collect_list(F.struct("source", without.alias("p")))).alias("s"))
    lists = lists.select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
                         F.col("s.source").alias("sources"), F.col("s.p").alias("without"))
    own = placed.select("lang", "block", "source", "term", "p").groupBy("lang", "block")
    sums = own.cogroup(lists.groupBy("lang", "block")).applyInArrow(_distances, "lang string, a string, b string, value bigint")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = sums.select("lang", F.inline(ways), "value").withColumn("part", F.lit("pair")).withColumn("rank", rank)
    return pairs.select(*result).union(ahead.select(*result))
