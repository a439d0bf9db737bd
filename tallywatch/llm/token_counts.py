"""Token counts: overlap resynchronisation for huge documents, one call of the table of word parts for the rest.

A huge document is encoded in overlapping chunks with offsets. Two neighbouring chunks are spliced at a position where
both begin a pre-token: the pattern of a pre-tokenizer reads on from there without looking back, so from this position
on both give the same ids, up to the end of the earlier chunk. Where the overlap has no such position it is widened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallywatch.llm import tokens
from tallywatch.llm.words import slices, text_buffer

CHUNK = 16_384
OVERLAP = 256


def resynchronised(coder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[int]]:
    """The ids of a text, in pieces, from chunks of `chunk` characters that overlap by `overlap` or more.

    Memory holds two chunks and their encodings, and more only while an overlap without a common boundary grows.
    """
    guard = 1 + max((len(t.content) for t in coder.get_added_tokens_decoder().values()), default=0)
    n, begin, end = len(text), 0, min(chunk, len(text))
    now, at = coder.encode(text[:end], add_special_tokens=False), 0
    spliced = 0  # position of the last splice; the ids of `now` are proven from token `at` on
    while end < n:
        width = overlap
        while True:
            start = max(spliced, end - width)
            stop = min(n, max(start + chunk, end + overlap))
            later = coder.encode(text[start:stop], add_special_tokens=False)
            here = _word_starts(now, begin)
            there = _word_starts(later, start)
            common = [p for p in there if p in here and spliced < p <= end - guard]
            if common:
                p = max(common)
                yield now.ids[at: here[p]]
                now, at, begin, end, spliced = later, there[p], start, stop, p
                break
            if start == spliced:  # nothing further back to look at: let the earlier chunk reach further
                end = min(n, end + width)
                now, at, begin = coder.encode(text[spliced:end], add_special_tokens=False), 0, spliced
                if end == n:
                    break
            width *= 2
    yield now.ids[at:]


def _word_starts(encoding, origin: int) -> dict[int, int]:
    """Token index by position in the text, of the tokens that begin a pre-token."""
    found, previous = {}, None
    for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word is not None and word != previous and origin + start not in found:
            found[origin + start] = i
        previous = word
    return found


def count_tokens(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """One row per row of `docs`: its key, n_bytes (UTF-8) and n_tokens, and n_chunks of texts longer than a chunk.

    The file at `path` is read on every executor. NULL and empty texts have 0 of each, keys may be NULL or repeated,
    and only the two named columns are read, whatever others there are.
    """
    apart = tokens.drops_space(path)
    kind = next(f.dataType for f in docs.schema.fields if f.name == key)
    long = T.LongType()
    schema = T.StructType([
        T.StructField("key", kind), T.StructField("n_bytes", long), T.StructField("n_tokens", long),
        T.StructField("n_chunks", long),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.tokenizer(path)
        for batch in batches:
            for part in slices(batch, "text"):
                _, offsets = text_buffer(part["text"])
                sizes = np.diff(offsets)
                counts, chunks = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
                for i in np.flatnonzero(sizes > chunk):
                    whole = part["text"][int(i)].as_py()
                    if len(whole) > chunk:
                        for ids in resynchronised(coder, whole, chunk, overlap):
                            counts[i] += len(ids)
                            chunks[i] += 1
                rest = np.flatnonzero(chunks == 0)
                others = part["text"].take(pa.array(rest)) if len(rest) < len(sizes) else part["text"]
                if len(rest) and apart:
                    counts[rest] = tokens.part_table(path).count_slice(others)
                elif len(rest):
                    counts[rest] = [len(e) for e in coder.encode_batch_fast(
                        [t or "" for t in others.to_pylist()], add_special_tokens=False)]
                yield pa.record_batch(
                    [part["key"], pa.array(sizes), pa.array(counts), pa.array(chunks)],
                    names=["key", "n_bytes", "n_tokens", "n_chunks"],
                )

    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(count, schema).withColumnRenamed("key", key)
