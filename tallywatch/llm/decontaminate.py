"""Benchmark passages in training documents by spaced seeds.

A seed is a mask over consecutive words that reads some and ignores the others. Equal hashes under one of MASKS at a
position of a document and of a benchmark item are a hit; around it the two texts are laid beside each other, without
gaps, and the stretch with the best score decides. The masks hit every pair of passages of 15 to 30 words that the rule
for overlaps accepts: they were chosen over all patterns of substitutions where these are at most 20,000 per number of
substitutions, and over 20,000 random ones where they are more; test_decontaminate.py draws further ones.

Words are runs of letters and digits in lower case, so neither case, punctuation nor line breaks matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.links import stored
from tallywatch.llm.packing import pack, unpacked_slices
from tallywatch.llm.words import mix, rows_of, signed, slices, span_hashes, text_buffer, word_bounds

MASKS = (
    "11110111", "1111000111", "110111011", "1110100111",  # seven words
    "1100101011", "1010011011", "101011011", "1111011",  # six: what the others miss
)
SPAN = max(map(len, MASKS))

# An overlap counts with as many equal words, or with the share of the item's words, and with the share of its own.
MIN_EQUAL = 13
ITEM_SHARE = 0.8
EQUAL_SHARE = 0.75
MISMATCH = 2

# Bytes of benchmark text up to which it is sent to every task; a larger one is joined by hash. Its seeds take about
# ten times as much, 16 bytes per word and mask.
SENT_BYTES = 1 << 20

# Pairs of positions, and words of shifted texts, that are looked at at once.
PAIRS = 1 << 20
CELLS = 1 << 20

_SEPARATOR = np.ones(256, dtype=bool)
_SEPARATOR[48:58] = _SEPARATOR[65:91] = _SEPARATOR[97:123] = False
_SEPARATOR[128:] = False

OVERLAP = "begin bigint, item_begin bigint, n_words bigint, n_equal bigint"


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a column in lower case, and the number of words before each row."""
    data, offsets = text_buffer(texts)
    apart = _SEPARATOR[data]
    for lead, seconds, width in ((0xE2, (0x80, 0x81), 3), (0xC2, None, 2)):  # punctuation beyond ASCII
        at = np.flatnonzero(data == lead)
        at = at[at + width <= len(data)]
        if seconds:
            at = at[np.isin(data[at + 1], seconds)]
        for step in range(width):
            apart[at + step] = True
    starts, ends, first = word_bounds(data, offsets, apart)
    return span_hashes(data, starts, ends), first


def seeds(words: np.ndarray, first: np.ndarray, mask: str, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which the mask lies in one row, and the hash of the words it reads there."""
    n = max(0, len(words) - len(mask) + 1)
    hashes = np.zeros(n, np.uint64)
    for step, read in enumerate(mask):
        if read == "1":
            hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + words[step: step + n]
    at = np.flatnonzero(np.arange(n) + len(mask) <= first[1:][rows_of(first)[:n]]) if n else np.zeros(0, np.int64)
    return at, mix(hashes[at], salt)


@dataclass
class Items:
    """Benchmark items: their words in a row, and their seeds in order of hash with the word position of each."""

    first: np.ndarray
    words: np.ndarray
    hashes: np.ndarray
    positions: np.ndarray
    masks: tuple[str, ...]

    @classmethod
    def of(cls, texts: pa.Array) -> Items:
        words, first = plain_words(texts)
        sizes = np.diff(first)
        # An item too short for the masks is found by all its words.
        masks = MASKS + tuple("1" * int(n) for n in np.unique(sizes[(sizes > 0) & (sizes < SPAN)]))
        hashes, positions = [], []
        for salt, mask in enumerate(masks, 1):
            at, found = seeds(words, first, mask, salt)
            if mask not in MASKS:
                whole = sizes[rows_of(first)[at]] == len(mask)
                at, found = at[whole], found[whole]
            hashes.append(found)
            positions.append(at)
        hashes, positions = np.concatenate(hashes), np.concatenate(positions)
        order = np.argsort(hashes, kind="stable")
        return cls(first, words, hashes[order], positions[order], masks)

    def hits(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in `words` with a seed that items have too, where its positions in the items begin, and their number."""
        coarse = np.zeros(1 << 20, dtype=bool)
        coarse[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        found = []
        for salt, mask in enumerate(self.masks, 1):
            at, hashes = seeds(words, first, mask, salt)
            maybe = coarse[(hashes >> np.uint64(44)).astype(np.int64)]
            at, hashes = at[maybe], hashes[maybe]
            low, high = (np.searchsorted(self.hashes, hashes, side) for side in ("left", "right"))
            some = high > low
            found.append((at[some], low[some], (high - low)[some]))
        return tuple(np.concatenate(c) for c in zip(*found))

    def meetings(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Row, item and all distinct shifts between them at which they have a seed in common.

        Pairs of positions are laid out up to PAIRS at a time; a row that alone has more goes item by item.
        """
        at, low, n = self.hits(words, first)
        rows = np.searchsorted(first, at, side="right") - 1
        order = np.argsort(rows, kind="stable")
        at, low, n, rows = at[order], low[order], n[order], rows[order]
        every, begins = np.unique(rows, return_index=True)
        totals = np.add.reduceat(n, begins) if len(n) else n
        begins = np.append(begins, len(rows))
        k = 0
        while k < len(every):
            end = max(k + 1, k + int(np.searchsorted(np.cumsum(totals[k:]), PAIRS, side="right")))
            some = slice(begins[k], begins[end])
            if totals[k:end].sum() > PAIRS:
                yield from self._crowded(int(every[k]), at[some] - first[every[k]], low[some], n[some], int(first[every[k] + 1] - first[every[k]]))
            else:
                theirs = self.positions[_ranges(low[some], n[some])]
                of = np.searchsorted(self.first, theirs, side="right") - 1
                row = np.repeat(rows[some], n[some])
                shift = np.repeat(at[some], n[some]) - first[row] - (theirs - self.first[of])
                triples = np.unique(np.column_stack([row, of, shift]), axis=0)
                cuts = np.flatnonzero(np.any(triples[1:, :2] != triples[:-1, :2], axis=1)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(triples)]):
                    if b > a:
                        yield int(triples[a, 0]), int(triples[a, 1]), triples[a:b, 2]
            k = end

    def _crowded(self, row: int, at: np.ndarray, low: np.ndarray, n: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """The same for one row: every shift is a mark, set for all positions of a seed at once."""
        order = np.argsort(low, kind="stable")
        at, low, n = at[order], low[order], n[order]
        lows, begins = np.unique(low, return_index=True)
        ends = np.append(begins[1:], len(low))
        theirs = _ranges(lows, n[begins])
        seed = np.repeat(np.arange(len(lows)), n[begins])
        of = np.searchsorted(self.first, self.positions[theirs], side="right") - 1
        by_item = np.argsort(of, kind="stable")
        for item in np.unique(of).tolist():
            a, b = np.searchsorted(of[by_item], [item, item + 1])
            item_size = int(self.first[item + 1] - self.first[item])
            marks = np.zeros(size + item_size, dtype=bool)
            for i in by_item[a:b].tolist():
                place = int(self.positions[theirs[i]] - self.first[item])
                marks[at[begins[seed[i]]: ends[seed[i]]] + (item_size - place)] = True
            yield row, item, np.flatnonzero(marks) - item_size


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each beginning on, as many as its size."""
    return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def best_overlap(doc: np.ndarray, item: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int, int] | None:
    """(begin, item_begin, n_words, n_equal) of the best overlap that counts over some shifts, None without one.

    At a shift the two texts lie beside each other, and the stretch taken is the one with the most equal words less MISMATCH
    times the others. The best overlap has the most equal words, then begins first.
    """
    size, needed = len(item), min(MIN_EQUAL, math.ceil(ITEM_SHARE * len(item)))
    around = np.concatenate([np.zeros(size, doc.dtype), doc, np.zeros(size, doc.dtype)])
    views, best = np.lib.stride_tricks.sliding_window_view(around, size), None
    step = max(1, CELLS // size)
    for k in range(0, len(shifts), step):
        some = shifts[k: k + step]
        begin, end = np.maximum(0, -some), np.minimum(size, len(doc) - some)  # in the item
        place = np.arange(size)
        inside = (place >= begin[:, None]) & (place < end[:, None])
        equal = (views[some + size] == item) & inside
        enough = np.flatnonzero(equal.sum(axis=1) >= needed)
        if not len(enough):
            continue
        some, begin, equal, inside = some[enough], begin[enough], equal[enough], inside[enough]
        sums, n_equal = (np.zeros((len(some), size + 1), np.int64) for _ in range(2))
        np.cumsum(np.where(equal, 1, np.where(inside, -MISMATCH, 0)), axis=1, out=sums[:, 1:])
        np.cumsum(equal, axis=1, out=n_equal[:, 1:])
        low = np.minimum.accumulate(sums, axis=1)
        stop = np.argmax(sums - low, axis=1)
        lines = np.arange(len(some))
        start = np.maximum(begin, np.argmax(sums == low[lines, stop][:, None], axis=1))
        n = n_equal[lines, stop] - n_equal[lines, start]
        counts = (n >= needed) & (n >= EQUAL_SHARE * (stop - start))
        for i in np.flatnonzero(counts & (n == np.max(n, where=counts, initial=0))):
            found = (int(n[i]), -int(some[i] + start[i]), -int(start[i]), int(stop[i] - start[i]))
            best = found if best is None else max(best, found)
    return None if best is None else (-best[1], -best[2], best[3], best[0])


def overlaps(words: np.ndarray, first: np.ndarray, known: Items) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Row, item, begin in both, words and equal words of the best overlap of every row and item that have one."""
    for row, item, shifts in known.meetings(words, first):
        doc, other = words[first[row]: first[row + 1]], known.words[known.first[item]: known.first[item + 1]]
        found = best_overlap(doc, other, shifts)
        if found:
            yield row, item, *found


def _lower(frame: DataFrame, key: str, text: str) -> DataFrame:
    return frame.select(frame[key].alias("key"), F.lower(frame[text]).alias("text"))


def leaks(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """One row per document and benchmark item that overlap: doc_key, item_key and the best overlap.

    The overlap is given by `begin` and `item_begin` (words before it), n_words and n_equal. Rows with equal keys are one
    document or item. NULL texts and texts without letters or digits overlap with nothing; rows without a key are left
    out. A benchmark of more than `sent_bytes` is joined by hash instead of being sent to every task.
    """
    items = _lower(benchmark, item_key, item_text).dropna()
    docs = _lower(docs, key, text).dropna()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    found = _sent(docs, items) if size <= sent_bytes else _joined(spark, docs, items)
    best = F.max(F.struct("n_equal", (-F.col("begin")).alias("b"), (-F.col("item_begin")).alias("i"), "n_words")).alias("o")
    return found.groupBy("doc_key", "item_key").agg(best).select(
        "doc_key", "item_key", (-F.col("o.b")).alias("begin"), (-F.col("o.i")).alias("item_begin"),
        F.col("o.n_words").alias("n_words"), F.col("o.n_equal").alias("n_equal"),
    )


def _schema(docs: DataFrame, items: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("doc_key", docs.schema["key"].dataType), T.StructField("item_key", items.schema["key"].dataType),
        *T._parse_datatype_string(OVERLAP).fields,
    ])


def _rows(found: list[tuple], keys: pa.Array, item_keys: pa.Array) -> pa.RecordBatch:
    row, item, *rest = (np.array(c, np.int64) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 6
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(row)), item_keys.take(pa.array(item)), *map(pa.array, rest)],
        names=["doc_key", "item_key", "begin", "item_begin", "n_words", "n_equal"],
    )


def _sent(docs: DataFrame, items: DataFrame) -> DataFrame:
    table = items.toArrow().combine_chunks()
    keys = table["key"].combine_chunks() if table.num_rows else pa.array([], table.schema.field("key").type)
    known = Items.of(table["text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, first = plain_words(part["text"])
                yield _rows(list(overlaps(words, first, known)), part["key"], keys)

    return docs.mapInArrow(run, _schema(docs, items))


def _joined(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The same for any benchmark: seeds meet in a join, and the pairs of texts that share one are compared."""
    def seeded(name: str, short: list[int], whole_only: bool):
        masks = MASKS + tuple("1" * n for n in short)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    words, first = plain_words(part["text"])
                    rows, sizes_ = rows_of(first), np.diff(first)
                    for salt, mask in enumerate(masks, 1):
                        at, found = seeds(words, first, mask, salt)
                        if whole_only and mask not in MASKS:
                            whole = sizes_[rows[at]] == len(mask)
                            at, found = at[whole], found[whole]
                        yield pa.RecordBatch.from_arrays(
                            [part["key"].take(pa.array(rows[at])), pa.array(signed(found))], names=[name, "h"])

        return run

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.diff(plain_words(batch["text"])[1])
            yield pa.record_batch([pa.array(np.unique(n[(n > 0) & (n < SPAN)]))], names=["n"])

    short = sorted(r.n for r in items.select("text").mapInArrow(lengths, "n bigint").distinct().collect())
    key, item = docs.schema["key"].dataType, items.schema["key"].dataType
    long = T.StructField("h", T.LongType())
    mine = docs.mapInArrow(seeded("doc_key", short, False), T.StructType([T.StructField("doc_key", key), long]))
    theirs = items.mapInArrow(seeded("item_key", short, True), T.StructType([T.StructField("item_key", item), long]))
    pairs = stored(spark, mine.distinct().join(theirs.distinct(), "h").select("doc_key", "item_key").distinct(), "pairs")
    texts = pairs.join(pack(docs, "text").withColumnRenamed("key", "doc_key"), "doc_key").join(
        items.toDF("item_key", "item_text"), "item_key").select("doc_key", "text", "item_key", "item_text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, unpacked in unpacked_slices(batch, 1):
                found = []
                for i in range(part.num_rows):
                    words, first = plain_words(unpacked.slice(i, 1))
                    known = Items.of(part["item_text"].slice(i, 1))
                    found += [(i, i, *o[2:]) for o in overlaps(words, first, known)]
                yield _rows(found, part["doc_key"], part["item_key"])

    return texts.mapInArrow(compare, _schema(docs, items))
