"""Sketches as tables: distinct counts and quantiles that are kept by unit and merged for a book.

A sketch is a few rows for each key, so sketches are made, kept and merged by sums and maxima before the shuffle, a hot key's too, and merging those of
parts gives the very rows of a single pass, in any order and also where parts overlap (registers) or are added once (buckets).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Registers of a distinct count: three hexadecimal digits. Its standard error is 1.04 / sqrt(REGISTERS), 1.6 %.
REGISTERS = 4096
#: Relative error of a quantile at most.
ERROR = 0.01


def registers(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """``keys, register, rank``: for each register the longest run of zeros, and one, that a value's hash begins with. Null is no value."""
    h = F.md5(value.cast("string"))
    n = F.conv(F.substring(h, 4, 13), 16, 10).cast("long")  # 52 bits
    rank = F.when(n == 0, 53).otherwise(53 - F.length(F.bin(n)))
    each = rows.where(value.isNotNull()).select(*keys, F.conv(F.substring(h, 1, 3), 16, 10).cast("int").alias("register"), rank.cast("int").alias("rank"))
    return merged_registers(each, keys)


def merged_registers(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The registers by ``keys``, which may be fewer than the parts have."""
    return parts.groupBy(*keys, "register").agg(F.max("rank").alias("rank"))


def distinct(parts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, estimate`` of how many different values the registers have seen; keys without values have no row."""
    m = REGISTERS
    g = parts.groupBy(*keys).agg(F.count("*").alias("__n"), F.sum(F.pow(F.lit(2.0), -F.col("rank"))).alias("__s"))
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (F.col("__s") + m - F.col("__n"))
    few = m * F.log(m / (m - F.col("__n")))
    return g.select(*keys, F.when((raw <= 2.5 * m) & (F.col("__n") < m), few).otherwise(raw).alias("estimate"))


def buckets(rows: DataFrame, keys: list[str], value: Column, error: float = ERROR) -> DataFrame:
    """``keys, sign, bucket, n``: numbers counted by the power of ``(1 + error) / (1 - error)`` that they reach. Null and NaN do not count."""
    v = value.cast("double")
    size = F.ceil(F.log(F.abs(v)) / math.log((1 + error) / (1 - error)))
    sign = F.signum(v).cast("int")
    each = rows.where(v.isNotNull() & ~F.isnan(v)).select(*keys, sign.alias("sign"), F.when(sign == 0, 0).otherwise(size).cast("int").alias("bucket"), F.lit(1).cast("long").alias("n"))
    return merged_buckets(each, keys)


def merged_buckets(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys, "sign", "bucket").agg(F.sum("n").alias("n"))


def quantiles(parts: DataFrame, keys: list[str], at: list[float], error: float = ERROR) -> DataFrame:
    """``keys, q, estimate``: for each share of ``at`` the number that is as far in the order, from below, off by the relative ``error`` at most.

    ``q`` 0 is the least and 1 the greatest. A key has as many buckets as its numbers have sizes, some hundreds, whatever their count.
    """
    gamma = (1 + error) / (1 - error)
    order = Window.partitionBy(*keys).orderBy(F.col("sign") * F.col("bucket") + F.col("sign") * F.lit(100_000))
    w = parts.withColumn("__to", F.sum("n").over(order)).withColumn("__all", F.sum("n").over(Window.partitionBy(*keys)))
    w = w.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in at]))).withColumn("__rank", F.floor(F.col("q") * (F.col("__all") - 1)))
    hit = w.where((F.col("__rank") < F.col("__to")) & (F.col("__rank") >= F.col("__to") - F.col("n")))
    return hit.select(*keys, "q", (F.col("sign") * 2 * F.pow(F.lit(gamma), F.col("bucket")) / (gamma + 1)).alias("estimate"))
