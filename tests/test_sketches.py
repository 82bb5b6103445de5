from __future__ import annotations

import random

from pyspark.sql import functions as F

from marginalia.operators import sketches as K
from tests.conftest import of_spark


def test_merging_equals_one_pass_and_errors_hold(spark):
    rng = random.Random(3)
    numbers = [rng.choice([-1, 1]) * rng.lognormvariate(3, 2) for _ in range(6000)] + [0.0, 0.0, None, float("nan")]
    data = [(f"u{k % 7}", k % 2 or None, v) for k, v in enumerate(numbers)]
    df = spark.createDataFrame(data, "unit string, book int, v double")
    one, parts = K.buckets(df, ["book"], F.col("v")), K.merged_buckets(K.buckets(df, ["unit", "book"], F.col("v")), ["book"])
    assert of_spark(one) == of_spark(parts)
    at = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r.book, r.q): r.estimate for r in K.quantiles(parts, ["book"], at).collect()}
    for book in (1, None):
        real = sorted(v for _, b, v in data if b == book and v is not None and v == v)
        for q in at:
            want = real[int(q * (len(real) - 1))]
            assert abs(got[book, q] - want) <= 0.0101 * abs(want)
    ids = spark.range(50_000).select((F.col("id") % 5).alias("unit"), F.when(F.col("id") % 7 > 0, F.floor(F.col("id") / 2)).alias("v"))
    regs = K.registers(ids, ["unit"], F.col("v"))
    merged = K.merged_registers(regs, [])
    assert of_spark(merged) == of_spark(K.registers(ids, [], F.col("v"))) == of_spark(K.merged_registers(regs.unionByName(regs), []))
    exact = ids.agg(F.countDistinct("v")).first()[0]
    assert abs(K.distinct(merged, []).first()[0] - exact) < 3 * 0.0163 * exact
    few = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("b", None)], "k string, v string")
    assert [(r.k, round(r.estimate)) for r in K.distinct(K.registers(few, ["k"], F.col("v")), ["k"]).collect()] == [("a", 2)]
    none = few.limit(0)
    assert K.distinct(K.registers(none, ["k"], F.col("v")), ["k"]).count() == K.quantiles(K.buckets(none, ["k"], F.col("v")), ["k"], [0.5]).count() == 0
