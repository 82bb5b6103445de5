"""Token ids as Parquet files in order of document, and reading them back in part."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .runtime import parts_for, scratch_path
from .segments import encoded
from .words import ended, word_encoder

#: Bytes of text that go to one file, about.
FILE_BYTES = 16 << 20
#: Settings of the writer: dictionary pages for the ids, delta encoding for the counters, pages of few rows with an index,
#: so that a reader of some documents skips the other pages, and row groups that a task holds in memory.
FORMAT = {
    "compression": "zstd",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#row": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.writer.version": "PARQUET_2_0",
}
SCHEMA = "part int, row long, doc_id long, n_tokens long, ids array<int>"


def encode_files(docs: DataFrame, tokenizer: str, out: str, file_bytes: int = FILE_BYTES) -> None:
    """Writes the ids of each document, ended by the id ``END``, to Parquet files in ``out``.

    Files hold ranges of ``doc_id`` in ascending order, null first; rows that share an id are in order of their texts.
    ``part`` is the file's place in that order and ``row`` the row's place in its file. Texts are dealt by range before
    they are encoded, so ids are made where they are written. Null counts as the empty text, whose only id is ``END``.
    """
    source = docs.select(F.col("doc_id").cast("long"), "text")
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_for(total, file_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, row = word_encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, ids, at in encoded(batch, "text", encoder):
                n = rows.num_rows
                ids, at = ended(ids, at)
                lists = pa.ListArray.from_arrays(pa.array(at.astype("i4")), pa.array(ids.astype("i4")))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, "i4")), pa.array(np.arange(row, row + n)), rows.column("doc_id"), pa.array(np.diff(at)), lists], ["part", "row", "doc_id", "n_tokens", "ids"])
                row += n

    dealt = source.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(run, SCHEMA).write.options(**FORMAT).parquet(out)


def read_counts(spark: SparkSession, out: str) -> DataFrame:
    """``part, row, doc_id, n_tokens`` without the ids, whose pages are not read."""
    return spark.read.schema(SCHEMA).parquet(out).select("part", "row", "doc_id", "n_tokens")


def read_ids(spark: SparkSession, out: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The rows of documents from ``low`` to ``high``; the bounds reach the files' row group statistics and page indexes."""
    rows = spark.read.schema(SCHEMA).parquet(out)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    return rows if high is None else rows.where(F.col("doc_id") <= high)


def starts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``start``, the number of ids of all rows before, beside the columns of ``rows``: a running sum in each file, on top of
    a running sum over the files, whose sizes are summed from ``counts`` alone."""
    in_file = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    files = counts.groupBy("part").agg(F.sum("n_tokens").alias("file_tokens"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    before = files.select("part", F.coalesce(F.sum("file_tokens").over(over), F.lit(0)).alias("before"))
    return rows.join(before, "part").withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0))).drop("before")


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy() - ids.offsets[0].as_py() if len(ids) else np.zeros(1, "i8")
        raw = memoryview(np.ascontiguousarray(ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"))).cast("B")
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("part", "row", "doc_id")), pa.array(np.diff(offsets).astype("i8")), pa.array(sums, pa.int64())], ["part", "row", "doc_id", "n_tokens", "ids_crc32"])


def file_report(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each row of the files: of its ids as little-endian unsigned 32-bit integers."""
    rows = read_ids(spark, out).select("part", "row", "doc_id", "ids")
    return starts(rows.mapInArrow(_checked, "part int, row long, doc_id long, n_tokens long, ids_crc32 long"), read_counts(spark, out)).select("doc_id", "start", "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the files to the shared folder and reports on what they hold."""
    spark = docs.sparkSession
    out = scratch_path(spark, "token_files")
    encode_files(docs, tokenizer, out)
    return file_report(spark, out)
