"""What the corpus operators share: shipping of this package, lineage cuts and small column helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.text import let  # noqa: F401 - part of this module's surface
from ..storage import scratch_path, ship  # noqa: F401

#: White space of every word and line rule of this package.
SPACE = r"[\x20\x09-\x0D]+"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it again: the lineage ends at files that survive executors."""
    ship(df.sparkSession)
    return storage.written(df, name, **options)


def words(text: Column) -> Column:
    """Maximal runs of characters that are not white space; null counts as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    return max(least, math.ceil(rows / per_part))
