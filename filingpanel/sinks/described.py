"""Parquet files whose fields carry their variable's description in their own metadata.

Spark keeps descriptions in its own schema entry of a file, which other readers don't look at. Here the
executors pack rows into whole Parquet files, a bounded piece at a time, with the description in each field's
metadata and Spark's entry beside it. The pieces are stored by Spark's writer, so its commit protocol holds:
of a task that is repeated only one attempt counts, on any file system that the session knows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.session import remove, ship_package
from filingpanel.sources.files import list_files

#: Rows of this many bytes are a row group; a file that has reached this many bytes, compressed, is closed.
GROUP_BYTES, FILE_BYTES = 32 << 20, 512 << 20

#: The mark that ends every Parquet file, and Spark's own schema entry; both are fixed by the formats.
END_MARK = "PAR1"
SPARK_ENTRY = b"org.apache.spark.sql.parquet.row.metadata"


def described_schema(df: DataFrame) -> pa.Schema:
    """The Arrow schema of ``df`` with ``description`` in the metadata of every field that has one."""
    plain = df.limit(0).toArrow().schema
    fields = []
    for own, field in zip(df.schema.fields, plain):
        text = own.metadata.get("description", "")
        fields.append(field.with_metadata({"description": text}) if text else field)
    return pa.schema(fields, {SPARK_ENTRY: df.schema.json().encode()})


class _File:
    """A Parquet file in memory."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.sink, self.held, self.size = schema, pa.BufferOutputStream(), [], 0
        self.writer = pq.ParquetWriter(self.sink, schema, compression="snappy")

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.size += batch.nbytes
        if self.size >= GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.held:
            rows = pa.Table.from_batches(self.held).cast(self.schema)
            self.writer.write_table(rows)
        self.held, self.size = [], 0

    def closed(self) -> pa.Buffer:
        """The file's bytes without the mark at its end."""
        self.flush()
        self.writer.close()
        whole = self.sink.getvalue()
        return whole[: len(whole) - len(END_MARK)]


def _row(data: pa.Buffer) -> pa.RecordBatch:
    """Bytes as a row, without a copy."""
    offsets = pa.array([0, data.size], pa.int32()).buffers()[1]
    return pa.record_batch({"value": pa.Array.from_buffers(pa.binary(), 1, [None, offsets, data])})


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches as rows of bytes, compressed, for another task."""
    for batch in batches:
        if batch.num_rows:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as stream:
                stream.write_batch(batch)
            yield _row(sink.getvalue())


def _received(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column(0):
            yield from pa.ipc.open_stream(value.as_buffer())


def _packed(schema: pa.Schema, file_bytes: int):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file = file or _File(schema)
            file.add(batch)
            if file.sink.tell() >= file_bytes:
                yield _row(file.closed())
                file = None
        if file:
            yield _row(file.closed())

    return packed


def write_described(df: DataFrame, path: str, one_file: bool = False, file_bytes: int = FILE_BYTES) -> None:
    """Replace ``path`` by the rows of ``df`` as Parquet, with descriptions in the fields' own metadata.

    ``path`` becomes a folder of files, or, with ``one_file``, a plain file if the rows fit into one of
    ``file_bytes``; rows that do not are a folder all the same. Rows are prepared beside the old data, which is
    replaced at the end. Without rows there is one file with the schema. Null and empty descriptions are left out.
    """
    spark = df.sparkSession
    ship_package(spark)
    schema = described_schema(df)
    parent, name = os.path.split(path.rstrip("/"))
    beside = os.path.join(parent, f"_{name}-{uuid.uuid4().hex}")
    packed = _packed(schema, file_bytes)
    if one_file:  # one task writes, but others make the rows
        files = df.mapInArrow(_sent, "value binary").repartition(1).mapInArrow(lambda batches: packed(_received(batches)), "value binary")
    else:
        files = df.hint("rebalance").mapInArrow(packed, "value binary")
    _store(files, beside)
    stored = _stored(spark, beside)
    if not stored:
        remove(spark, [beside])
        empty = spark.createDataFrame([(bytearray(_File(schema).closed().to_pybytes()),)], "value binary")
        _store(empty, beside)
        stored = _stored(spark, beside)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    files = paths(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if one_file and len(stored) == 1:
        files.delete(paths(path), True)
        files.rename(paths(stored[0]), paths(path))
        files.delete(paths(beside), True)
        return
    for k, file in enumerate(stored):  # one for each file of ``file_bytes``
        files.rename(paths(file), paths(os.path.join(beside, f"part-{k:05d}.parquet")))
    remove(spark, _stored(spark, beside, least=0))
    files.delete(paths(path), True)
    files.rename(paths(beside), paths(path))


def _store(pieces: DataFrame, folder: str) -> None:
    """One file a row: its bytes, and the mark, which the line writer puts where a line would end."""
    writer = pieces.select(F.col("value").cast("string")).write.option("lineSep", END_MARK).option("compression", "none")
    writer.option("maxRecordsPerFile", 1).text(folder)


def _stored(spark: SparkSession, folder: str, least: int = 1) -> list[str]:
    """The line writer's files in order; tasks without rows may leave an empty one."""
    found = list_files(spark, folder, "*.txt").where(F.col("length") >= least)
    return [r["path"] for r in found.select("path").orderBy("path").collect()]
