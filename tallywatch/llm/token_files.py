"""Token ids in Arrow files: equal-length sequences and masks as fixed-size lists, with an index of the documents.

Documents are range-partitioned by key, so that the files of ascending part numbers hold ascending documents. A part is
two Arrow IPC files. `part-N-*.arrow` holds the ids of its documents in a row, cut into sequences of one length, the
last one padded with 0 and masked; every batch but the last has BATCH_SEQUENCES of them, so sequence s is row
s % BATCH_SEQUENCES of batch s // BATCH_SEQUENCES, and a memory map gives it without a copy. `part-N-*.docs.arrow` says
where each document begins. A task names its files anew at every attempt; the manifest, which Spark commits, names the
files that count, and what a lost attempt left behind is never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm import tokens
from tallywatch.llm.words import slices

LENGTH = 2048
BATCH_SEQUENCES = 256
INDEX_ROWS = 8192

MANIFEST = "part int, name string, n_docs bigint, n_tokens bigint, n_sequences bigint"


def _place(folder: str):
    return pa.fs.FileSystem.from_uri(folder)


class _Writer:
    """The two files of a part, written a batch at a time."""

    def __init__(self, folder: str, name: str, key: pa.DataType, length: int, id_type: pa.DataType):
        self.fs, root = _place(folder)
        self.fs.create_dir(root, recursive=True)
        self.length, self.id_type = length, id_type
        self.schema = pa.schema([("ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index_schema = pa.schema([("key", key), ("begin", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [self.fs.open_output_stream(f"{root}/{name}{end}.arrow") for end in ("", ".docs")]
        self.files = [pa.ipc.new_file(s, x) for s, x in zip(self.sinks, (self.schema, self.index_schema))]
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_tokens = self.n_docs = self.n_sequences = 0

    def add(self, keys: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        begins = self.n_tokens + np.cumsum(counts) - counts
        index = pa.record_batch([keys, pa.array(begins), pa.array(counts)], schema=self.index_schema)
        for at in range(0, index.num_rows, INDEX_ROWS):
            self.files[1].write_batch(index.slice(at, INDEX_ROWS))
        self.n_docs += len(counts)
        self.n_tokens += len(ids)
        self.waiting.append(ids.astype(self.id_type.to_pandas_dtype()))
        self.n_waiting += len(ids)
        if self.n_waiting >= self.length * BATCH_SEQUENCES:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        full = self.length * BATCH_SEQUENCES
        values = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.id_type.to_pandas_dtype())
        end = len(values) if last else len(values) // full * full
        for at in range(0, end, full):
            self._batch(values[at: min(end, at + full)])
        self.waiting, self.n_waiting = [values[end:].copy()], len(values) - end

    def _batch(self, values: np.ndarray) -> None:
        n = -(-len(values) // self.length)
        padded = np.zeros(n * self.length, values.dtype)
        padded[: len(values)] = values
        mask = np.arange(len(padded)) < len(values)
        self.files[0].write_batch(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(padded), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
        ], schema=self.schema))
        self.n_sequences += n

    def close(self) -> None:
        self._flush(True)
        for file, sink in zip(self.files, self.sinks):
            file.close()
            sink.close()


class TokenPart:
    """Random access to the sequences and documents of one part."""

    def __init__(self, folder: str, name: str):
        fs, root = _place(folder)
        local = isinstance(fs, pa.fs.LocalFileSystem)
        self.sources = [
            pa.memory_map(f"{root}/{name}{end}.arrow") if local else fs.open_input_file(f"{root}/{name}{end}.arrow")
            for end in ("", ".docs")
        ]
        self.file, self.index = (pa.ipc.open_file(s) for s in self.sources)

    def values(self, batch: int) -> np.ndarray:
        """Ids of all sequences of a batch in a row, padding included."""
        return self.file.get_batch(batch).column(0).flatten().to_numpy()

    def sequence(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a sequence, without a copy where the file is mapped, and its mask."""
        batch = self.file.get_batch(s // BATCH_SEQUENCES)
        row = s % BATCH_SEQUENCES
        return batch.column(0)[row].values.to_numpy(), batch.column(1)[row].values.to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, list[int]]]:
        """Keys, begins, numbers of ids and crc32 of the ids as little-endian 32-bit, in batches."""
        size = self.file.schema.field(0).type.list_size * BATCH_SEQUENCES
        held, values = -1, None
        for b in range(self.index.num_record_batches):
            batch = self.index.get_batch(b)
            begins, counts = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            sums = []
            for begin, count in zip(begins.tolist(), counts.tolist()):
                crc, at, end = 0, begin, begin + count
                while at < end:
                    if at // size != held:
                        held = at // size
                        values = self.values(held)
                    inside = at - held * size
                    some = values[inside: inside + end - at]
                    crc = zlib.crc32(some.astype("<u4").tobytes(), crc)
                    at += len(some)
                sums.append(crc)
            yield batch.column(0), begins, counts, sums

    def close(self) -> None:
        for source in self.sources:
            source.close()


def write_token_files(
    docs: DataFrame, path: str, folder: str, end_id: int, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> None:
    """Write the ids of all texts, each followed by `end_id`, below `folder`, a new path that all machines share.

    Order is by key, NULL first, then by a hash of the text. NULL and empty texts are just `end_id`. Keys may repeat. An
    empty table writes no part.
    """
    if not tokens.drops_space(path):
        raise ValueError(f"{path} gives no white space up; its texts can't be encoded by words")
    id_type = pa.uint16() if tokens.tokenizer(path).get_vocab_size() <= 1 << 16 else pa.uint32()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, writer = f"part-{part:06d}-{uuid.uuid4().hex}", None
        table = tokens.part_table(path)
        for batch in batches:
            for some in slices(batch, "text"):
                if writer is None:
                    writer = _Writer(folder, name, some["key"].type, length, id_type)
                ids, counts = table.encode_slice(some["text"])
                ends = np.cumsum(counts)
                writer.add(some["key"], np.insert(ids, ends, end_id), counts + 1)
        if writer is not None:
            writer.close()
            yield pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([name]),
                 *(pa.array([n], pa.int64()) for n in (writer.n_docs, writer.n_tokens, writer.n_sequences))],
                names=["part", "name", "n_docs", "n_tokens", "n_sequences"],
            )

    ordered = docs.select(docs[key].alias("key"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("tie"))
    ordered = ordered.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part with `start`, the ids of all parts before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return parts.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(spark: SparkSession, folder: str, key: T.DataType) -> DataFrame:
    """Per document, from the files: key, start (ids of all documents before it), n_tokens and ids_crc32."""
    long = T.LongType()
    schema = T.StructType([
        T.StructField("key", key), T.StructField("start", long), T.StructField("n_tokens", long),
        T.StructField("ids_crc32", long),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch["name"].to_pylist(), batch["start"].to_pylist()):
                part = TokenPart(folder, name)
                for keys, begins, counts, sums in part.documents():
                    yield pa.record_batch(
                        [keys, pa.array(begins + start), pa.array(counts), pa.array(sums, pa.int64())],
                        names=["key", "start", "n_tokens", "ids_crc32"],
                    )
                part.close()

    manifest = read_manifest(spark, folder)
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").count()
    return manifest.select("name", "start").repartition(max(1, files)).mapInArrow(read, schema)
