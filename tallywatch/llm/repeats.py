"""Passages that documents share, found level by level: windows that repeat at one length are extended to twice that.

The first level looks at windows of half the wanted length, and of these only at anchors: the window with the lowest
hash among those inside a window of the full length. Equal windows hold equal anchors, so nothing is lost, and about one
position in fourteen is compared instead of all. A window of the full length is compared only if its anchor
occurs in several documents, one of twice that length only if both its halves do, and so on until no windows are left.

Windows are compared by 64-bit hashes of their words. Among n windows that are compared, a given one is taken for
another with a probability of n / 2^64.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.links import scratch, stored
from tallywatch.llm.packing import pack, unpacked_slices
from tallywatch.llm.words import mix, rows_of, signed, slices, span_hashes, text_buffer, whole_windows, window_hashes, word_bounds

LENGTH = 50

Keep = Callable[[DataFrame, str], DataFrame]


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and the number of words before each row."""
    data, offsets = text_buffer(texts)
    starts, ends, first = word_bounds(data, offsets)
    return span_hashes(data, starts, ends), first


def windows_of(words: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, rows and hashes of all windows that lie in one row."""
    at = np.flatnonzero(whole_windows(first, length))
    return at, rows_of(first)[at], window_hashes(words, length)[at]


def anchors_of(words: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and rows of all windows, and their anchors: the lowest hash of the windows of half the length inside."""
    half = -(-length // 2)
    lowest, held, want = window_hashes(words, half), 1, length - half + 1
    while held < want:
        step = min(held, want - held)
        lowest = np.minimum(lowest[: max(0, len(lowest) - step)], lowest[step:])
        held += step
    at = np.flatnonzero(whole_windows(first, length))
    return at, rows_of(first)[at], lowest[at]


def _among(rows: np.ndarray, keys: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether each key is in the list of its row."""
    lists = lists.fill_null([]) if lists.null_count else lists
    wanted = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    of = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return np.isin(keys ^ mix(rows.astype(np.uint64), 4), wanted ^ mix(of.astype(np.uint64), 4))


def _shared(keep: Keep, windows: DataFrame) -> DataFrame:
    """Hashes that occur in two documents or more, with the smallest id.

    A table of its own: joined from there, both sides of the join are plain exchanges, and the adaptive plan can split
    the partitions of passages that very many documents share.
    """
    spread = windows.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    return keep(spread.filter("low < high").select("h", "low"), "shared")


def _by_document(windows: DataFrame) -> DataFrame:
    return windows.groupBy("id").agg(F.collect_set("h").alias("hs"))


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, rows, keys = anchors_of(*_hashed(part["text"]), length)
                new = np.ones(len(keys), dtype=bool)
                new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
                yield pa.RecordBatch.from_arrays(
                    [part["id"].take(pa.array(rows[new])), pa.array(signed(keys[new]))], names=["id", "h"])

    return docs.mapInArrow(run, T.StructType([docs.schema["id"], T.StructField("h", T.LongType())]))


def _extended(packed: DataFrame, parts: DataFrame, length: int, anchored: bool) -> DataFrame:
    """(id, h) of the windows of `length` whose anchors, or both halves, are in the lists of `parts` (id, hs)."""
    joined = packed.join(parts, "id").select("id", "text", "hs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in unpacked_slices(batch, 1):
                words, first = _hashed(texts)
                at, rows, keys = windows_of(words, first, length)
                if anchored:
                    kept = _among(rows, anchors_of(words, first, length)[2], part["hs"])
                else:
                    halves_at, halves_rows, halves = windows_of(words, first, length // 2)
                    found = np.zeros(len(words) + length, dtype=bool)
                    found[halves_at] = _among(halves_rows, halves, part["hs"])
                    kept = found[at] & found[at + length // 2]
                yield pa.RecordBatch.from_arrays(
                    [part["id"].take(pa.array(rows[kept])), pa.array(signed(keys[kept]))], names=["id", "h"])

    return joined.mapInArrow(run, T.StructType([packed.schema["id"], T.StructField("h", T.LongType())]))


def shared_windows(keep: Keep, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, h, low) of every window of `length` words that two documents or more have, from `docs` (id, text).

    `keep` stores tables that the result is read from.
    """
    anchors = keep(_anchors(docs, length), "anchors")
    parts = _by_document(anchors.join(_shared(keep, anchors).select("h"), "h", "left_semi"))
    windows = keep(_extended(pack(docs, "text"), parts, length, True), "windows")
    return windows.join(_shared(keep, windows), "h").select("id", "h", "low")


def longer_windows(spark: SparkSession, docs: DataFrame, windows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document the longest of length, 2 * length, 4 * length ... at which it shares a window with another one.

    `docs` is (id, text), `windows` what shared_windows returned for it. Levels go on until no window is shared.
    """
    windows = stored(spark, windows.select("id", "h").distinct(), "windows")
    packed, levels = pack(docs, "text"), []
    while not windows.isEmpty():
        levels.append(windows.select("id", F.lit(length).cast("bigint").alias("longest")).distinct())
        length *= 2
        wider = stored(spark, _extended(packed, _by_document(windows), length, False), "windows")
        windows = stored(spark, wider.join(_shared(partial(stored, spark), wider).select("h"), "h", "left_semi").distinct(), "windows")
    if not levels:
        return spark.createDataFrame([], T.StructType([docs.schema["id"], T.StructField("longest", T.LongType())]))
    found = levels[0]
    for level in levels[1:]:
        found = found.union(level)
    return found.groupBy("id").agg(F.max("longest").alias("longest"))


def without_repeats(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, tidy: bool = False
) -> DataFrame:
    """The rows of `docs` without the words of passages that a document with a smaller key has too.

    A word goes if a window of `length` words covers it whose words also follow each other in a document with a smaller
    key; windows are judged on the input. Columns: those of `docs` with the kept words in place of the text, joined by
    one space (a text that loses nothing stays as it is, unless `tidy`), then n_words and n_removed. NULL texts have no
    words and become empty. Rows with one key never take from each other; rows with a NULL key lose nothing.
    """
    names, at = docs.columns, docs.columns.index(text)
    texts = docs.select(docs[key].alias("id"), docs[text].alias("text")).dropna(subset=["id"])
    with scratch(spark) as keep:
        found = _by_document(shared_windows(keep, texts, length).filter("id > low").select("id", "h"))
        later = stored(spark, found, "later")
    numbered = docs.toDF(*(f"c{i}" for i in range(len(names))))
    joined = pack(numbered, f"c{at}").join(
        later.withColumnRenamed("id", f"c{names.index(key)}"), f"c{names.index(key)}", "left"
    ).select(*(f"c{i}" for i in range(len(names))), "hs")
    long = T.LongType()
    fields = numbered.schema.fields + [T.StructField("n_words", long), T.StructField("n_removed", long)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, unpacked in unpacked_slices(batch, at):
                words, first = _hashed(unpacked)
                position, rows, keys = windows_of(words, first, length)
                found = position[_among(rows, keys, part["hs"])]
                edges = np.zeros(len(words) + length + 1, np.int64)
                np.add.at(edges, found, 1)
                np.add.at(edges, found + length, -1)
                stays = np.cumsum(edges[: len(words)]) == 0
                n_words = np.diff(first)
                sums = np.concatenate([[0], np.cumsum(~stays)])
                n_removed = sums[first[1:]] - sums[first[:-1]]
                kept = [v.as_py() or "" for v in unpacked]
                for i in range(len(kept)):
                    if n_removed[i] or tidy:
                        own = kept[i].encode().split()  # splits at the same six bytes
                        some = stays[first[i]: first[i + 1]]
                        kept[i] = b" ".join(own if not n_removed[i] else [own[k] for k in np.flatnonzero(some)]).decode()
                columns = [pa.array(kept, pa.string()) if i == at else part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n_words), pa.array(n_removed)],
                    names=[f.name for f in fields])

    return joined.mapInArrow(run, T.StructType(fields)).toDF(*names, "n_words", "n_removed")
