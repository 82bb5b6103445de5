"""Greedy choice of surfaces."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marginalia.operators import needles
from marginalia.operators import spans as S


def plain_greedy(text, surfaces):
    """All places, longest first, then the earlier, then by record; none that overlaps a choice."""
    places = [(-len(s), a, r) for r, s in surfaces if len(s) >= 2 for a in range(len(text)) if text.startswith(s, a)]
    out = []
    for n, a, r in sorted(places):
        if all(a - n <= x or a >= y for x, y, _ in out):
            out.append((a, a - n, r))
    return sorted(out)


def test_greedy_surfaces_against_a_plain_choice(spark):
    rng = random.Random(3)
    units = [(k, "".join(rng.choice("abx 相如") for _ in range(rng.randint(0, 60)))) for k in range(40)] + [(99, None)]
    names = [(f"r{k}", "".join(rng.choice("abx 相如") for _ in range(rng.randint(1, 5)))) for k in range(25)] + [("long", "ab" * 12), ("twin", "ab"), ("twin2", "ab")]
    u, s = spark.createDataFrame(units, "unit_id long, text string"), spark.createDataFrame(names, "record_id string, surface string")
    want = sorted((k, *m) for k, t in units for m in plain_greedy(t or "", names))
    rows = lambda d: sorted(map(tuple, d.select("unit_id", "start", "end", "record_id").collect()))
    assert rows(S.greedy_surfaces(u, s)) == want
    places = {(k, r, a) for k, t in units for r, n in names if len(n) >= 2 for a in range(len(t or "")) if t.startswith(n, a)}
    assert {(r.unit_id, r.record_id, r.start) for r in S.surface_matches(u, s).collect()} == places
    assert S.surface_matches(u, s.limit(0)).count() == S.greedy_surfaces(u.limit(0), s).count() == S.greedy_surfaces(u, s.limit(0)).count() == 0


def test_names_of_several_words_and_without_blanks(spark):
    u = spark.createDataFrame([(1, "相如字长卿，蜀郡成都人也。John Smith met Ada Lovelace in the garden")], "unit_id long, text string")
    s = spark.createDataFrame([("a", "相如"), ("b", "Ada Lovelace"), ("c", "garden"), ("d", "nobody")], "record_id string, surface string")
    got = S.greedy_surfaces(u, s)
    assert {r.record_id for r in got.collect()} == {"a", "b", "c"}
    assert [r.record_id for r in S.unmatched_records(got, u, s).collect()] == ["d"]
    assert {(r.record_id, r.match_count, r.n_unsure) for r in S.scan_report(got).collect()} == {("a", 1, 1), ("b", 1, 0), ("c", 1, 0)}


def test_the_earlier_first():
    assert S.chosen([("a", 0, 3), ("b", 2, 9), ("c", 3, 4), ("d", 3, 5)], longest_first=False) == [("a", 0, 3), ("d", 3, 5)]
    assert S.chosen([("a", 0, 3), ("b", 2, 9)]) == [("b", 2, 9)]


@pytest.mark.parametrize("longest_first", [True, False])
@pytest.mark.parametrize("bits", [0, 2, 16])
def test_choices_in_stretches_that_cross_pieces(spark, monkeypatch, bits, longest_first):
    monkeypatch.setattr(S, "PIECE_BITS", bits)
    rng = random.Random(bits)
    m = [(rng.choice([1, 2, None]), a := rng.randint(0, 150), a + rng.randint(1, 9), f"r{rng.randint(0, 4)}") for _ in range(110)]
    m += [(1, 20, 70, "long"), (3, 5, 6, "alone"), (3, 6, 9, "touches")] + m[:5]
    df = spark.createDataFrame(m, "unit_id long, start int, end int, record_id string")
    want = sorted(((u, a, b, r) for u in (1, 2, 3, None) for r, a, b in S.chosen([(r, a, b) for v, a, b, r in m if v == u], longest_first)), key=repr)
    assert sorted((tuple(r) for r in S.greedy(df, longest_first=longest_first).collect()), key=repr) == want
    islands = {(r.unit_id, r.start, r.end): r.island for r in S.groups_of_overlaps(df).collect()}
    for (u, a, b), i in islands.items():
        assert i <= a and all(islands[v, c, d] == i for v, c, d in islands if v == u and c < b and a < d)
    assert S.greedy(df.limit(0)).count() == 0


def test_covering(spark):
    rng = random.Random(1)
    rows = [(k % 3, f"s{k}", (a := rng.randint(0, 20)), a + rng.randint(0, 9)) for k in range(30)]
    got = S.covering(spark.createDataFrame(rows, "unit_id long, span_id string, start long, end long")).collect()
    at = {(r.unit_id, p): r.covered_by for r in got for p in range(r.start, r.end)}
    want = {}
    for u, i, a, b in rows:
        for p in range(a, b):
            want.setdefault((u, p), []).append(i)
    assert at == {k: sorted(v) for k, v in want.items()}


def test_surface_scan_greedy_has_terms_from_two_letters(spark, tmp_path):
    from marginalia.plans import texts

    spark.createDataFrame([(1, "to be or")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "be or a")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = texts.catalog.queries["surface_scan_greedy"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 3, 5, "r-be"), (1, 6, 8, "r-or")]


def test_no_surfaces_match_nothing(spark):
    u = spark.createDataFrame([(1, "there was none left of it")], "unit_id long, text string")
    none = spark.createDataFrame([], "record_id string, surface string")
    assert S.greedy_surfaces(u, none).count() == S.surface_matches(u, none).count() == S.surface_counts(u, none).count() == 0


@pytest.mark.parametrize("together", [500_000, 40])
def test_places_of_needles_of_all_lengths(spark, monkeypatch, together):
    """Needles shorter and longer than a gram, longer than a list's width, repeated under several names, hot ones and ones that overlap themselves."""
    monkeypatch.setattr(needles, "TOGETHER", together)
    monkeypatch.setattr(needles, "ROWS", 7)
    rng = random.Random(together)
    texts = [(k, "".join(rng.choice("ab é漢😀") for _ in range(rng.choice([0, 3, 30, 400])))) for k in range(30)] + [(77, None), (78, "aaaa" * 90), (79, "x" * 50 + "needle in here" + "y" * 50)]
    long = texts[-1][1]
    names = [(f"n{k}", t[a : a + rng.randint(1, 200)]) for k, t in texts if t for a in [rng.randrange(len(t))]]
    names += [("e", ""), ("z", None), ("one", "a"), ("a8", "a" * 8), ("a9", "a" * 9), ("a6", "aaaaaa"), ("again", "a" * 8), ("whole", long), ("more", long + "y"), ("first", long[:33]), ("last", long[-32:]), ("none", "not there")]
    t = spark.createDataFrame(texts, "unit_id long, text string").repartition(3)
    n = spark.createDataFrame(names, "record_id string, surface string")
    want = sorted((u, r, s, a, a + len(s)) for u, x in texts for r, s in names if s and x for a in range(len(x)) if x.startswith(s, a))
    assert sorted(map(tuple, needles.places(t, "unit_id", n, "record_id", "surface").collect())) == want
    index = needles.gram_index(n.select(F.col("surface").alias("needle"))).collect()
    assert len(index) == len({s for _, s in names if s}) and all(r.list == len(r.needle) if len(r.needle) < 6 else len(r.needle) <= needles.width(r.list) for r in index)


def test_spans_meet_in_bins(spark):
    """Short and very long spans, empty and reversed ones, negative and null places, repeated rows, a hot unit: against all pairs."""
    rng = random.Random(2)

    def spans(n, tag):
        out = [(rng.choice([1, 1, 1, 2, None]), f"{tag}{k % (n - 2)}", (a := rng.randint(-40, 60)), a + rng.choice([-2, 0, 1, 3, 16, 17, 2**20, 2**33, 2**40])) for k in range(n)]
        return [*out, (1, f"{tag}n", None, 4)]

    left, right = spans(60, "a"), spans(50, "b")
    a = spark.createDataFrame(left, "u int, i string, a long, b long")
    b = spark.createDataFrame(right, "u int, j string, c long, d long")
    got = sorted((r.i, r.j, r.a, r.c) for r in S.overlaps(a, b, ["u"], ("a", "b"), ("c", "d")).collect())
    assert got == sorted((i, j, p, r) for u, i, p, q in left for v, j, r, s in right if u is not None and u == v and None not in (p, r) and q > r and p < s and (r <= p < s or p < r < q))
    points = S.points_in(a.select("u", "i", "a"), b, ["u"], "a", "c", "d").collect()
    assert sorted((r.i, r.j, r.a, r.c) for r in points) == sorted((i, j, p, r) for u, i, p, _ in left for v, j, r, s in right if u is not None and u == v and None not in (p, r) and r <= p < s)


def test_within_on_batches_and_streams(spark, tmp_path):
    from datetime import datetime, timedelta

    rng, start = random.Random(4), datetime(2024, 1, 1)
    at = lambda: start + timedelta(seconds=rng.randrange(20_000), microseconds=rng.choice([0, 0, 5]))
    left = [(rng.choice(["h", "h", "k", None]), n, at()) for n in range(80)] + [("h", 500, start), ("h", 500, start), ("h", 501, None)]
    right = [(rng.choice(["h", "h", "k", None]), n, at()) for n in range(60)] + [("h", 700, start + timedelta(hours=1)), ("h", 701, start + timedelta(hours=1, microseconds=1)), ("h", 702, start)]
    a, b = spark.createDataFrame(left, "k string, n long, ts timestamp"), spark.createDataFrame(right, "k string, m long, sold timestamp")
    want = sorted((n, m) for k, n, t in left for j, m, s in right if k and k == j and t and s and t <= s <= t + timedelta(hours=1))
    assert sorted((r.n, r.m) for r in S.within(a, b, ["k"], "ts", "sold", 3600).collect()) == want
    for name, df in (("a", a), ("b", b)):
        df.repartition(2).write.parquet(f"{tmp_path}/{name}")
    read = lambda df, name, ts: spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{name}").withWatermark(ts, "1 day")
    met = S.within(read(a, "a", "ts"), read(b, "b", "sold"), ["k"], "ts", "sold", 3600)
    met.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.n, r.m) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == want


@pytest.mark.parametrize("together", [500_000, 9])
def test_scans_write_texts_and_no_places(spark, monkeypatch, together):
    """Counts and choices of dense surfaces in blocks and windows, against plain ones; what is written is less than the places would be."""
    monkeypatch.setattr(needles, "TOGETHER", together)
    sizes = []
    monkeypatch.setattr(needles, "written", lambda df, name, **o: sizes.append((name, (w := written(df, name, **o)).count())) or w)
    from marginalia.storage import written

    rng = random.Random(together)
    units = [(k, "".join(rng.choice("aab ") for _ in range(rng.choice([0, 5, 80])))) for k in range(25)] + [(80, "ab" * 300), (81, "a" * 301), (82, None)]
    names = [(f"r{x}", x) for x in ("aa", "ab", "aba", "ba a", "a" * 7, "ab" * 9, "ab" * 70, "b")] + [("later", "aa"), ("q", "aa")]
    u, s = spark.createDataFrame(units, "unit_id long, text string"), spark.createDataFrame(names, "record_id string, surface string")
    got = sorted(tuple(r) for r in S.greedy_surfaces(u, s).collect())
    assert got == sorted((k, *m) for k, t in units for m in plain_greedy(t or "", names))
    counted = sorted(tuple(r) for r in S.surface_counts(u, s).collect())
    assert counted == sorted((k, x, t.count(x)) for k, t in units if t for x in {x for _, x in names} if x in t)
    n_places = sum(t.startswith(x, a) for _, t in units if t for _, x in names for a in range(len(t)))
    assert all(n <= 100 < n_places for _, n in sizes)


def test_a_report_counts_where_texts_are_scanned(spark, monkeypatch):
    """The same rows as the report of all places, of texts in several windows, units with the same id and records with several surfaces; places are not shuffled."""
    from marginalia.operators import needles

    units = [(1, "ann ann lee annab " * 40), (1, "lee xx"), (2, None), (3, ""), (4, "xx" + "ann lee " * 30), (5, "none")]
    u = spark.createDataFrame(units, "unit_id long, text string")
    s = spark.createDataFrame([("a", "ann"), ("a", "ann lee"), ("b", "lee"), ("c", "xx"), ("d", "xx"), ("e", "annab"), ("e", "b")], "record_id string, surface string")
    want = sorted(map(tuple, S.scan_report(S.greedy_surfaces(u, s)).collect()))
    for together in (500_000, 20):
        monkeypatch.setattr(needles, "TOGETHER", together)
        got = S.surface_report(u, s)
        assert sorted(map(tuple, got.collect())) == want and len(want) == 6
    single, plain = u.where("unit_id > 1"), spark.createDataFrame([("b", "lee"), ("a", "ann"), ("e", "annab"), ("0", "nn")], s.schema)
    want = sorted(map(tuple, S.scan_report(S.greedy_surfaces(single, plain)).collect()))
    got = S.surface_report(single, plain)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 2
    last = got._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    assert "Exchange" not in last and "Window" not in last
    found = []
    monkeypatch.setattr(S, "_report", lambda rows: found.append(rows.count()) or rows)
    S.surface_report(u, s)
    assert found[0] < S.greedy_surfaces(u, s).count() / 5
