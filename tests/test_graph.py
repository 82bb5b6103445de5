"""Components and joins on hot keys."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marginalia.operators.graph import components, linked_by_key
from marginalia.operators.skew import salted_join


def _plain(edges):
    root = {}

    def find(v):
        root.setdefault(v, v)
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for v in root}


def test_components_of_random_graphs_chains_and_stars(spark):
    rng = random.Random(5)
    graphs = [[(rng.randrange(60), rng.randrange(60)) for _ in range(40)], [(k, k + 1) for k in range(60)] + [(100, 100)]]
    for edges in graphs:
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == _plain(edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_star_of_many_edges(spark):
    edges = spark.range(1, 1_000_001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    got = components(edges)
    assert got.agg(F.count("*"), F.max("root")).first()[:] == (1_000_001, 0)


def test_rows_of_a_key_are_linked_to_the_smallest(spark):
    rows = spark.createDataFrame([(4, "x"), (2, "x"), (9, "y"), (5, None)], "node long, key string")
    assert sorted(map(tuple, linked_by_key(rows, "node", "key").collect())) == [(2, 2), (2, 4), (9, 9)]


def test_salted_join_gives_what_a_join_gives(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    per_key = spark.createDataFrame([("hot", 1), ("5", 2)], "k string, v int")
    for how in ("inner", "left", "left_anti"):
        want, got = (sorted(map(str, d.select("id", "k").collect())) for d in (rows.join(per_key, "k", how), salted_join(rows, per_key, ["k"], F.col("id"), how)))
        assert want == got


def test_paths_of_deep_and_wide_trees(spark):
    from marginalia.operators.graph import paths

    rng = random.Random(6)
    nodes = [(f"d{k}", f"d{k - 1}" if k else None, str(k)) for k in range(700)] + [(f"w{k}", "d0", "w") for k in range(300)] + [("lost", "nobody", "x"), ("alone", None, None)]
    nodes += [(f"t{k}", f"t{rng.randrange(k)}" if k else None, f"{k}") for k in range(200)]
    up, label = {n: p for n, p, _ in nodes}, {n: x for n, _, x in nodes}

    def plain(n):
        out = [label[n]]
        while up.get(n) in up:
            n = up[n]
            out.insert(0, label[n])
        return out

    df = spark.createDataFrame(nodes, "node string, parent string, label string").repartition(3)
    assert {r.node: r.path for r in paths(df).collect()} == {n: plain(n) for n in up}
    assert paths(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="circles"):
        paths(spark.createDataFrame([("a", "b", "1"), ("b", "a", "2"), ("c", "a", "3")], "node string, parent string, label string"))
