"""Texts as compressed binary, for shuffles that would otherwise move them as they are."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_codec = None


def codec() -> pa.Codec:
    global _codec
    if _codec is None:
        _codec = pa.Codec("zstd", compression_level=1)
    return _codec


def pack(frame: DataFrame, column: str) -> DataFrame:
    """The frame with a string column as binary: eight bytes of length and the compressed text. NULL stays NULL."""
    at = frame.columns.index(column)
    fields = [T.StructField(f.name, T.BinaryType() if i == at else f.dataType) for i, f in enumerate(frame.schema.fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                packed = []
                for value in part.column(at):
                    raw = value.as_buffer()
                    packed.append(None if raw is None else
                                  raw.size.to_bytes(8, "little") + codec().compress(raw, asbytes=True))
                columns = list(part.columns)
                columns[at] = pa.array(packed, pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return frame.mapInArrow(run, T.StructType(fields))


def unpack(values: pa.Array) -> pa.Array:
    """The texts of a packed column."""
    texts = []
    for value in values:
        raw = value.as_buffer()
        texts.append(None if raw is None else
                     codec().decompress(raw.slice(8), int.from_bytes(raw.slice(0, 8).to_pybytes(), "little"), asbytes=True))
    return pa.array(texts, pa.binary()).cast(pa.string())


def unpacked_slices(batch: pa.RecordBatch, column: int, limit: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Consecutive rows whose packed texts have together at most a quarter of `limit` bytes, with their texts."""
    sizes = [v.as_buffer().size if v.is_valid else 0 for v in batch.column(column)]
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if i > at and held + size > limit // 4:
            yield batch.slice(at, i - at), unpack(batch.column(column).slice(at, i - at))
            at, held = i, 0
        held += size
    if at < len(sizes):
        yield batch.slice(at), unpack(batch.column(column).slice(at))
