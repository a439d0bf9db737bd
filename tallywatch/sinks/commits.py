"""Writes that count once: a batch that is written twice, a version that two jobs want.

Both rest on one promise of file systems, that of several attempts to create a file only one succeeds. It holds on local
disks and HDFS; an object store needs a Hadoop connector that creates conditionally.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.session import remove_folder

COMMITS = "_commits"
FOLDER = "written"
DATA = "data"
ENTRY = "batch string, folder string, replaces array<string>"

# Bytes that compaction gives a file.
FILE_BYTES = 128 << 20


def create_file(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file that is not there yet; False if it is. It appears whole or not at all."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if _exists(spark, path):
        return False
    # The attempt is a file of its own, so a writer that dies leaves no half-written file under the name.
    attempt = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(attempt, True)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    no_overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(attempt, target, no_overwrite)
        return True
    except Py4JJavaError as problem:
        system.delete(attempt, False)
        if "FileAlreadyExistsException" in problem.java_exception.getClass().getName():
            return False
        raise


def append_once(
    frame: DataFrame | Mapping[str, DataFrame], path: str, batch: str, fmt: str = "parquet", *partitions: str
) -> bool:
    """Append the rows of a batch to the table at `path`, unless a batch of that name is in it; False if it is.

    The rows go to a folder of their own, which is part of the table once a file named after the batch says so. A writer
    that dies before that leaves a folder that no reader looks at, and of two writers of one batch one wins. Frames by
    name go to several tables, told apart by that name when they are read, and become part of them together.
    """
    frames = frame if isinstance(frame, Mapping) else {DATA: frame}
    spark = next(iter(frames.values())).sparkSession
    if _exists(spark, f"{path}/{COMMITS}/{batch}.json"):
        return False
    return commit(spark, path, batch, write_rows(frames, path, batch, fmt, *partitions))


def write_rows(frames: Mapping[str, DataFrame], path: str, batch: str, fmt: str = "parquet", *partitions: str) -> str:
    """Write rows to new folders, which are not yet part of the tables, and return the name they share."""
    folder = f"{FOLDER}={batch}-{uuid.uuid4().hex}"
    for table, frame in frames.items():
        writer = frame.write.format(fmt)
        (writer.partitionBy(*partitions) if partitions else writer).save(f"{path}/{table}/{folder}")
    return folder


def commit(spark: SparkSession, path: str, batch: str, folder: str, replaces: Iterable[str] = ()) -> bool:
    """Make a folder part of the table as the rows of a batch, and those of the batches it replaces no part of it any more.
    False if the batch has its rows already."""
    entry = {"batch": batch, "folder": folder, "replaces": sorted(replaces)}
    return create_file(spark, f"{path}/{COMMITS}/{batch}.json", json.dumps(entry))


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _entries(spark: SparkSession, path: str) -> list[Row]:
    """What the commits say, one row per batch."""
    if not _exists(spark, f"{path}/{COMMITS}"):
        return []
    return spark.read.schema(ENTRY).json(f"{path}/{COMMITS}").collect()


def _current(entries: list[Row]) -> dict[str, str]:
    gone = {batch for entry in entries for batch in entry["replaces"] or ()}
    return {entry["batch"]: entry["folder"] for entry in entries if entry["batch"] not in gone}


def committed(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of each batch that is part of the table."""
    return _current(_entries(spark, path))


def read_committed(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", table: str = DATA) -> DataFrame:
    """The rows of all batches that are part of the table; `schema` includes the columns it is partitioned by."""
    folders = sorted(f"{path}/{table}/{folder}" for folder in committed(spark, path).values())
    return _read(spark, f"{path}/{table}", folders, schema, fmt)


def _read(spark: SparkSession, base: str, folders: list[str], schema: T.StructType | str, fmt: str) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("basePath", base).load(folders).drop(FOLDER)


def once_per_batch(path: str, query: str, fmt: str = "parquet", *partitions: str) -> Callable[[DataFrame, int], None]:
    """A function for writeStream.foreachBatch that appends each batch of the query once, however often Spark runs it.

    `query` must stay the same over restarts from one checkpoint, as batch numbers do. Spark may run a batch again because
    the sink failed, or because Spark itself did before it noted that the batch was done.
    """

    def write(frame: DataFrame, number: int) -> None:
        append_once(frame, path, batch_name(query, number), fmt, *partitions)

    return write


def batch_name(query: str, number: int) -> str:
    return f"{query}-{number:09d}"


def compact(
    spark: SparkSession, path: str, schema: T.StructType | str, *partitions: str, fmt: str = "parquet", file_bytes: int = FILE_BYTES
) -> bool:
    """Bring the rows of all batches into files of about `file_bytes`, at most bytes / file_bytes + 1 per partition; False if
    there is nothing to bring together or another job has done so meanwhile.

    Readers see either the batches or what replaces them. Batches that are committed meanwhile stay as they are, and a batch
    that has been replaced still counts as written. Compactions are numbered, and only one job can claim a number, so a
    batch is replaced once. The old folders stay for readers that have begun; `remove_replaced` removes them.
    """
    entries = _entries(spark, path)
    held = _current(entries)
    if len(held) < 2:
        return False
    rows = _read(spark, f"{path}/{DATA}", sorted(f"{path}/{DATA}/{folder}" for folder in held.values()), schema, fmt)
    # Only the partition columns and the files' names and sizes are read for this.
    files = rows.select(*partitions, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    n_files = F.ceil(F.sum("size") / file_bytes)
    hashed = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    spread = F.xxhash64(*hashed)
    if partitions:
        # One row per partition of the table.
        sizes = files.groupBy(*(F.col(c).alias(f"of_{c}") for c in partitions)).agg(n_files.alias("n_files"))
        same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in partitions))
        placed = rows.join(F.broadcast(sizes), same).withColumn("spread", F.pmod(spread, "n_files"))
    else:
        placed = rows.withColumn("spread", F.pmod(spread, files.agg(n_files.alias("n_files")).scalar()))
    placed = placed.repartition(*partitions, "spread").select(*rows.columns)
    batch = f"compacted-{sum(bool(e['replaces']) for e in entries):09d}"
    return commit(spark, path, batch, write_rows({DATA: placed}, path, batch, fmt, *partitions), held)


def remove_replaced(spark: SparkSession, path: str) -> int:
    """Remove the folders of batches that a compaction has replaced; how many there were."""
    entries = _entries(spark, path)
    current = _current(entries)
    old = [f"{path}/{DATA}/{e['folder']}" for e in entries if e["batch"] not in current]
    there = [folder for folder in old if _exists(spark, folder)]
    for folder in there:
        remove_folder(spark, folder)
    return len(there)
