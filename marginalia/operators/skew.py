"""Joins of rows to one row of each key, where a key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written

#: Pieces that the rows of a key are dealt to.
SALTS = 64
_SALT = "__salt"


def salt(*by: Column | str, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")


#: Rows of a piece, about, where what a task sorts must not grow with the table.
PIECE_ROWS = 1_000_000


def in_pieces(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """``rows``, of which there are ``n``, dealt by ``keys`` to more pieces the more there are, so that a task's share is bounded; a key's rows are in one piece."""
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // PIECE_ROWS)), *keys)


def salted_join(rows: DataFrame, per_key: DataFrame, keys: list[str], by: Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``rows`` joined to ``per_key``, which has a row for each value of ``keys`` at most; ``by`` deals the rows of a key to pieces.

    The pieces that exist are found first, summed before the shuffle: a key has as many as it has rows, up to ``salts``. They take
    ``per_key``'s columns, and the rows meet their piece, so no task holds all rows of a key. ``how``: ``inner``, ``left`` or ``left_anti``.
    """
    dealt = rows.withColumn(_SALT, F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    pieces = dealt.select(*keys, _SALT).groupBy(*keys, _SALT).agg(F.lit(1).alias("__one")).drop("__one").join(per_key, keys)
    return dealt.join(pieces, [*keys, _SALT], how).drop(_SALT)


def with_least(rows: DataFrame, key: str, value: str, out: str = "least", more_than: int = 0, salts: int = SALTS, by: str | None = None, count: str | None = None) -> DataFrame:
    """``rows`` of keys with more than ``more_than`` rows, and beside each the least ``value`` of its key, and their number as ``count``, if
    that is named; found and joined by pieces, which rows are dealt to ``by`` a column, else by their value."""
    dealt = rows.withColumn(_SALT, salt(by or value, salts=salts))
    pieces = dealt.groupBy(key, _SALT).agg(F.min(value).alias(out), F.count("*").alias("__n"))
    low = pieces.groupBy(key).agg(F.min(out).alias(out), F.sum("__n").alias("__n")).where(F.col("__n") > more_than)
    low = low.withColumnRenamed("__n", count) if count else low.drop("__n")
    return dealt.join(pieces.select(key, _SALT).join(low, key), [key, _SALT]).drop(_SALT)


def running(rows: DataFrame, key: str | None, order: list[str], value: Column | None = None, number: str = "n", before: str = "before") -> DataFrame:
    """``number``: the place of each row, from 1, among those of its ``key`` (or all) in ``order``; ``before``: the sum of ``value`` over the rows before it.

    Rows are sorted in ranges of key and order, as many as the session has shuffle partitions; inside a range windows run over a key's rows in it, and sums by range and key
    say what lies before the range. So a key that holds most rows is spread over the ranges.
    """
    by = ([key] if key else []) + order
    ranged = rows.withColumn("__v", (value if value is not None else F.lit(0)).cast("long")).repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = written(ranged.withColumn("__part", F.spark_partition_id()).withColumn("__rid", F.monotonically_increasing_id()), "ranges")
    keys = [key] if key else []
    inside = Window.partitionBy("__part", *keys).orderBy("__rid")
    out = ranged.withColumn(number, F.row_number().over(inside).cast("long")).withColumn(before, F.coalesce(F.sum("__v").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    earlier = (Window.partitionBy(*keys) if key else Window.partitionBy()).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sums = ranged.groupBy("__part", *keys).agg(F.count("*").alias("__cnt"), F.sum("__v").alias("__sum"))
    sums = sums.select("__part", *keys, F.coalesce(F.sum("__cnt").over(earlier), F.lit(0)).alias("__cnt"), F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__sum"))
    same = F.col("__part") == F.col("__p")
    if key:
        same &= F.col(key).eqNullSafe(F.col("__k"))
    out = out.join(sums.toDF("__p", *["__k"] * len(keys), "__cnt", "__sum"), same)
    out = out.withColumn(number, F.col(number) + F.col("__cnt")).withColumn(before, F.col(before) + F.col("__sum"))
    return out.drop("__v", "__part", "__rid", "__p", "__k", "__cnt", "__sum")
