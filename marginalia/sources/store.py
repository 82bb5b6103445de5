"""Stores: registries, the catalogue of runs, cached passes and embeddings."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import Registry, Transaction  # noqa: F401 - part of this module's surface


def text_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def json_hash(value: object) -> str:
    """SHA-256 of the canonical form: sorted keys, no spaces, characters as they are."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def run_hash(**parts: object) -> str:
    return "run-" + json_hash(parts)[:16]


def append_run(spark: SparkSession, folder: str, **run: object) -> None:
    """Adds a run to the catalogue; runs are files of their own, so writers do not meet."""
    spark.createDataFrame([(json_hash(run), json.dumps(run, sort_keys=True))], "run_key string, run string").withColumn("at", F.current_timestamp()).write.mode("append").parquet(folder)


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue, newest first."""
    return spark.read.parquet(folder).orderBy(F.col("at").desc(), "run_key")


def cached(wanted: DataFrame, store: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that the store has, with its columns, and rows that it lacks."""
    return wanted.join(store, key), wanted.join(store.select(key), key, "left_anti")


def pass_key(prompt_hash: Column, payload: Column, model: Column) -> Column:
    return F.sha2(F.concat_ws("|", prompt_hash, F.sha2(payload, 256), model), 256)


def book_id(path: str) -> str:
    """A book's name for its folders: the file's stem and a part of the hash of its place."""
    stem = path.rstrip("/").rpartition("/")[2].rpartition(".")[0] or path.rstrip("/").rpartition("/")[2]
    return re.sub(r"[^0-9A-Za-z_-]+", "-", stem).strip("-") + "-" + hashlib.sha256(path.encode()).hexdigest()[:8]


def folders(root: str, book: str, unit: str | None = None) -> dict[str, str]:
    """The folders of a book, and of a unit of it, under a root."""
    base = f"{root.rstrip('/')}/{book}"
    out = {"book": base, "registry": f"{base}/registry", "index": f"{base}/index", "runs": f"{base}/runs", "embeddings": f"{base}/embeddings", "passes": f"{base}/passes", "digest": f"{base}/digest"}
    return out | ({"unit": f"{base}/units/{unit}"} if unit else {})


def save_pass(spark: SparkSession, folder: str, name: str, key: str, **parts: object) -> None:
    """Adds the parts of a pass (prompt, payload, answer, issues) to the table of passes, as JSON by name."""
    rows = [(key, name, part, value if isinstance(value, str) else json.dumps(value, sort_keys=True, ensure_ascii=False)) for part, value in sorted(parts.items())]
    spark.createDataFrame(rows, "pass_key string, pass string, part string, content string").withColumn("at", F.current_timestamp()).write.mode("append").parquet(folder)


def load_pass(spark: SparkSession, folder: str, key: str) -> dict[str, str]:
    """The parts of a pass that was saved, the latest of each; none if it was not."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return {}
    rows = spark.read.parquet(folder).where(F.col("pass_key") == key).groupBy("part").agg(F.max_by("content", "at").alias("c"))
    return {r["part"]: r["c"] for r in rows.collect()}  # a row for each part


def scalars(config: dict[str, object]) -> dict[str, object]:
    """The entries of a configuration that JSON holds as they are; they go into run hashes."""
    return {k: v for k, v in sorted(config.items()) if v is None or isinstance(v, (str, int, float, bool))}
