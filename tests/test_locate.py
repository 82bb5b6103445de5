from __future__ import annotations

from marginalia.operators import locate as L
from tests.conftest import of_spark


def test_tiers():
    text = "He said: “Well,[12] it is\nfine”. And then he left."
    assert L.relocate(text, "And then")[:2] == ("exact", "exact")
    status, strategy, start, end, n = L.relocate(text, "Well, it is fine")
    assert (status, strategy, n) == ("relocated", "annotation_whitespace_tolerant", 1) and text[start:end] == "Well,[12] it is\nfine"
    assert L.relocate(text, 'said: "Well, it')[1] == "annotation_whitespace_punctuation_tolerant"
    status, strategy, start, end, n = L.relocate(text, "it is fine And then")
    assert strategy == "annotation_whitespace_punctuation_dropped" and text[start:end] == "it is\nfine”. And then"
    assert L.relocate(text, "nothing of it") == ("missing", "not_found", None, None, 0)
    assert L.relocate("ab ab", "ab")[0] == "ambiguous"
    assert L.relocate(text, "")[0] == "missing"


def test_located_rows(spark):
    df = spark.createDataFrame([(1, 1, "a b", "b"), (1, 2, None, "x"), (2, 1, "aXb", None)], "doc_id long, item_id long, text string, quote string")
    got = {(r.doc_id, r.item_id): (r.status, r.start) for r in L.located(df).collect()}
    assert got == {(1, 1): ("exact", 2), (1, 2): ("missing", None), (2, 1): ("missing", None)}


def test_segments(spark):
    df = spark.createDataFrame([("u", "a", 0, 40, 100), ("u", "b", 30, 60, 100), ("u", "c", None, 80, 100), ("u", "d", None, None, 100)], "unit_id string, segment_id string, start long, end long, unit_chars long")
    got = {r.segment_id: (r.start, r.end) for r in L.resolved_segments(df).collect()}
    assert got == {"a": (0, 30), "b": (30, 60), "c": (60, 100)}
    assert {r.segment_id: r.missing for r in L.segment_hints(df).collect()} == {"c": "start_quote", "d": "start_quote,end_quote"}


def test_short_and_cut_quotes_are_found(spark, tmp_path):
    from marginalia.plans import texts

    docs = [(1, "He said yes to it."), (2, "他说，天下大乱。"), (3, "The extra[12]ordinary men went home"), (4, "nothing"), (5, None)]
    quotes = [(1, "yes"), (2, "said yes"), (3, "天下大乱"), (4, "The extraordinary men"), (5, "The extra ordinary men"), (6, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(quotes, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = lambda name: texts.catalog.queries[name](spark, str(tmp_path)).collect()
    exact = {(1, 1), (1, 2), (2, 3)}
    assert {(r.doc_id, r.item_id) for r in got("evidence_exact")} == exact
    assert {(r.doc_id, r.item_id) for r in got("evidence_normalized")} == exact | {(3, 4), (3, 5)}
    assert {(r.doc_id, r.item_id) for r in got("evidence_locations") if r.status != "missing"} == exact | {(3, 4), (3, 5)}
    assert {(r.unit_id, r.segment_id) for r in got("overview_segments")} == exact
    assert {r.doc_id: r.exact + r.relocated for r in got("evidence_status_histogram") if r.exact + r.relocated} == {1: 2, 2: 1, 3: 2}


def test_cjk_and_short_quotes_and_missing_ones(spark, monkeypatch):
    docs = [(1, "相如字长卿，蜀郡成都人也。少时好读书。John Smith met Ada Lovelace in the garden"), (2, "other"), (3, None)]
    quotes = [(1, "少时好读书"), (2, "蜀郡成都人也。少时好读书"), (3, "John Smith"), (4, "长卿蜀郡"), (5, "not there"), (6, "人")]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(quotes, "item_id long, quote string")
    all_pairs = d.select("doc_id").crossJoin(q.select("item_id"))
    want = {(i, j): L.relocate(t or "", x)[0] for i, t in docs for j, x in quotes}
    assert {(r.doc_id, r.item_id): r.status for r in L.cited(d, q, all_pairs).collect()} == want
    assert want[1, 1] == want[1, 3] == "exact" and want[1, 4] == "relocated" and want[1, 5] == "missing"
    monkeypatch.setattr("marginalia.operators.needles.TOGETHER", 20)
    assert {tuple(r) for r in L.location_pairs(d, q).collect()} == {k for k, s in want.items() if s != "missing"}
    assert L.containing(d, q.limit(0)).count() == 0


def test_needles_paragraphs_and_surfaces():
    assert L.needle_list("  ") == [] and L.needle_list("a") == []
    some = L.needle_list("He invented, the small garden gate")
    assert some[:3] == ["He invented,", "He inven", "He i"] and "garden gate"[:4] not in some[:3] and "invented"[:4] in some
    text = "one\n\ntwo words here\n\nthree"
    assert L.paragraph(text, 9, 14) == "two words here" and L.paragraph("x" * 50 + "hit" + "y" * 50, 50, 53, 20) == "x" * 10 + "hit" + "y" * 10
    assert not L.holds_surface("Miss Smith", ["by Smith, then"]) and L.holds_surface("Smiths", ["by Smith, then"]) and L.holds_surface("长卿", ["字长，卿"])


def test_evidence_locations_against_plain(spark, tmp_path):
    from marginalia.plans import texts

    docs = [(0, "He said: Well,[12] it is fine. It is fine."), (1, "it is\nfine"), (2, "zzz")]
    quotes = [(0, "it is fine"), (1, "Well, it is fine"), (2, "He said Well")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(quotes, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): (r.status, r.strategy, r.start, r.end, r.n_candidates) for r in texts.catalog.queries["evidence_locations"](spark, str(tmp_path)).collect()}
    every = {(i, j): L.relocate(t, x) for i, t in docs for j, x in quotes}
    assert got == {k: v for k, v in every.items() if v[0] != "missing" or k[0] == k[1]}


def test_locations_against_their_sql(spark, duck, tmp_path):
    """Quotes that notes, white space and marks keep from being found exactly, beside exact, ambiguous and missing ones."""
    from marginalia.plans import texts

    docs = [(1, "He said [12] that  all is “well”, and left."), (2, "“Yes”, she said. no more [1234]of it!! then"), (3, "a b a b"), (4, None), (5, "one\ntwo three[9]four"), (6, "then nothing came")]
    quotes = [(1, 'all is "well"'), (2, "no more of it"), (3, "a b"), (4, "nothing"), (5, "two threefour"), (6, "she said, no more"), (7, "He said that all")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d")
    spark.createDataFrame(quotes, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/b")
    for short, name in (("d", "documents"), ("b", "benchmark")):
        next((tmp_path / short).glob("*.parquet")).rename(tmp_path / f"{name}.parquet")
    got = of_spark(texts.catalog.queries["evidence_locations"](spark, str(tmp_path)))
    assert got == duck(texts.catalog.sql["evidence_locations"], str(tmp_path))
    assert {r[5] for r in got[1]} >= {"exact", "relocated", "ambiguous", "missing"} and len(got[1]) >= 8


def test_first_needles_against_plain(spark):
    texts = [(0, "so he invented, the small garden gate; the small garden"), (1, "a garden ga, garden ga"), (2, None), (3, "nothing here at all")]
    quotes = [(0, "He invented, the small garden gate"), (1, " gate of gold "), (2, ""), (3, "aaaa")]
    q = spark.createDataFrame(quotes, "item_id long, quote string")
    rows = sorted(map(tuple, L.needle_rows(q).collect()))
    assert rows == sorted((i, k, x) for i, t in quotes for k, x in enumerate(L.needle_list(t)))
    want = set()
    for d, t in texts:
        for i, x in quotes:
            found = next(((n, s) for n in L.needle_list(x) if (s := L.spans(t or "", n, 1))), None)
            want |= {(d, i, found[0], a) for a, _ in found[1][:3]} if found else set()
    got = L.first_needles(spark.createDataFrame(texts, "doc_id long, text string"), q).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 3
