"""The source index of a book: its units and blocks under one id, saved and read again with a check of its schema."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocks as B
from .store import json_hash

SCHEMA = "book-source-index-v1"
READER, SPLITTER = "1", "1"
_META = "schema_version string, source_index_id string, book_id string, source_path string, source_format string, source_digest string, unit_count long, block_count long, total_chars long, avg_block_size double"


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """``path, digest`` of files: SHA-256 of their bytes."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("digest"))


def index_id(book_id: str, digest: str, source_format: str) -> str:
    """The name of an index: the same book read and split in the same way has the same."""
    return "source-index-" + json_hash({"schema_version": SCHEMA, "book_id": book_id, "source_digest": digest, "source_format": source_format, "reader": READER, "splitter": SPLITTER})[:16]


def build(units: DataFrame, book_id: str, path: str, digest: str, source_format: str) -> dict[str, Any]:
    """``meta`` and ``blocks`` of a book's units (``unit_id, text``); blocks are numbered through the book and placed in it."""
    ident = index_id(book_id, digest, source_format)
    split = B.source_blocks(units, "unit_id").withColumn("book_id", F.lit(book_id))
    blocks = B.book_blocks(split, "book_id", "unit_id").withColumn("source_index_id", F.lit(ident))
    m = blocks.agg(F.count("*").alias("n"), F.coalesce(F.max("book_end"), F.lit(0)).alias("c"), F.coalesce(F.round(F.avg(F.length("text")), 2), F.lit(0.0)).alias("a")).first()
    meta = {"schema_version": SCHEMA, "source_index_id": ident, "book_id": book_id, "source_path": path, "source_format": source_format, "source_digest": digest, "unit_count": units.select("unit_id").distinct().count(), "block_count": m["n"], "total_chars": m["c"], "avg_block_size": m["a"]}
    return {"meta": meta, "blocks": blocks}


def save(spark: SparkSession, index: dict[str, Any], folder: str) -> str:
    """Writes an index under ``folder``, by book; gives its place."""
    place = f"{folder.rstrip('/')}/{index['meta']['book_id']}"
    index["blocks"].write.mode("overwrite").parquet(f"{place}/blocks")
    names = [c.split()[0] for c in _META.split(", ")]
    spark.createDataFrame([tuple(index["meta"][c] for c in names)], _META).coalesce(1).write.mode("overwrite").json(f"{place}/meta")
    return place


def load(spark: SparkSession, place: str) -> dict[str, Any]:
    """An index that was saved; one of another schema is an error."""
    meta = spark.read.schema(_META).json(f"{place}/meta").first().asDict()
    if meta["schema_version"] != SCHEMA:
        raise ValueError(f"unsupported schema of a source index: {meta['schema_version']!r}")
    return {"meta": meta, "blocks": spark.read.parquet(f"{place}/blocks")}


def blocks_of_unit(blocks: DataFrame, unit_id: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """The blocks of a unit in order, whole ones that overlap a range of it."""
    some = blocks.where(F.col("unit_id") == unit_id)
    if start is not None and end is not None:
        some = some.where((F.col("end") > start) & (F.col("start") < end))
    return some.orderBy("start", "block_id")


def package_blocks(blocks: DataFrame, segment_id: str = "") -> DataFrame:
    """Blocks of an index as packages have them: placed in their unit, with where they come from in their provenance."""
    provenance = F.to_json(F.struct(F.lit("deterministic").alias("grounding"), "source_index_id", "book_start", "book_end"))
    return blocks.select("block_id", "unit_id", F.lit(segment_id).alias("segment_id"), "block_index", "block_type", "start", "end", "text", "text_hash", "source_index_id", provenance.alias("provenance"))


def block_metadata(blocks: DataFrame) -> DataFrame:
    """Blocks without their texts."""
    return blocks.drop("text", "text_hash")


def unit_map(units: DataFrame, *columns: str) -> dict[str, dict[str, Any]]:
    """Units by id; a book has few."""
    return {r["unit_id"]: r.asDict() for r in units.select("unit_id", *columns).toLocalIterator()}


def to_json(index: dict[str, Any], units: DataFrame) -> str:
    """A book's index without its blocks as JSON."""
    return json.dumps({**index["meta"], "units": unit_map(units)}, ensure_ascii=False, sort_keys=True)
