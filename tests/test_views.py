"""The relational queries behind a viewer, and its pages."""

from __future__ import annotations

from marginalia.operators import views as W


def test_annotations_and_markup(spark):
    blocks = spark.createDataFrame([("b1", "Ann Lee met Ann & <Bo>."), ("b2", "Ann again"), ("b3", "")], "block_id string, text string")
    concepts = spark.createDataFrame([("c1", "Ann", ["Ann Lee", "Ann", "Ann", "A"], ["b1"]), ("c2", "Bo", [], ["b1", "b9"]), ("c3", "Lee met", [], ["b1"])], "concept_id string, surface string, observed_surfaces array<string>, source_block_refs array<string>")
    assert {r.concept_id: r.surfaces for r in W.surfaces(concepts).collect()} == {"c1": ["Ann Lee", "Ann"], "c2": ["Bo"], "c3": ["Lee met"]}
    got = sorted((r.block_id, r.start, r.end, r.record_id) for r in W.annotations(blocks, concepts).collect())
    assert got == [("b1", 0, 7, "c1"), ("b1", 12, 15, "c1"), ("b1", 19, 21, "c2")]  # of the earliest the longer, and nothing that overlaps it
    markup = {r.block_id: r.markup for r in W.annotated(blocks, concepts).collect()}
    assert markup == {"b1": '<mark data-concept="c1">Ann Lee</mark> met <mark data-concept="c1">Ann</mark> &amp; &lt;<mark data-concept="c2">Bo</mark>&gt;.', "b2": "Ann again", "b3": ""}


def test_sources_are_aligned_and_gaps_kept(spark):
    source = spark.createDataFrame([("x", "Front matter.\nThe first block of this.\n\ngap text\nThe second block of it."), ("y", "other")], "book_id string, text string")
    blocks = spark.createDataFrame([("x", "b1", 0, 24, "The first block of this."), ("x", "b2", 35, 58, "The second block of it."), ("y", "b3", 0, 3, "abc")], "book_id string, block_id string, start long, end long, text string")
    assert {r.book_id: r.offset for r in W.source_offsets(blocks, source).collect()} == {"x": 14, "y": 0}
    none = spark.createDataFrame([], "concept_id string, surface string, observed_surfaces array<string>, source_block_refs array<string>")
    page = {r.book_id: r.markup for r in W.source_pages(blocks, none, source).collect()}["x"]
    assert page.index("b1") < page.index("gap text") < page.index("b2") and "Front" not in page
    assert {r.book_id: r.text for r in W.stitched(blocks).collect()}["x"] == "The first block of this." + " " * 11 + "The second block of it."


def test_outline_records_and_segments(spark):
    units = spark.createDataFrame([("a", None, 1, "A"), ("b", "a", 3, "B"), ("c", "a", 2, "C"), ("d", "b", 9, "D"), ("e", "gone", 0, "E")], "unit_id string, parent_id string, ord int, label string")
    assert [r.line for r in W.outline(units).orderBy("path").collect()] == ["E", "A", "  C", "  B", "    D"]
    rows = spark.createDataFrame([('{"x": {"id": "1"}, "y": {"id": "2"}}',), ('[{"id": "3"}]',), (None,)], "j string")
    assert sorted(r.id for r in W.records(rows, "j", "id:string").collect()) == ["1", "2", "3"]
    segments = spark.createDataFrame([("s1", 100, "one two three")], "segment_id string, start long, text string")
    evidence = spark.createDataFrame([("s1", "e1", "two"), ("s1", "e2", "nine")], "segment_id string, evidence_id string, quote string")
    assert sorted(tuple(r) for r in W.segment_offsets(segments, evidence).fillna(-1).collect()) == [("s1", "e1", "exact", 104, 107), ("s1", "e2", "missing", -1, -1)]
    assert W.slim(spark.createDataFrame([("c", "s", 1)], "concept_id string, surface string, secret int")).columns == ["concept_id", "surface"]


def test_page():
    page = W.page("<T>", "<p>x</p>", {"a": "</script>"}, [{"unit_id": "u", "line": "U & V"}], [{"severity": "warning", "code": "w", "path": "p", "message": "m"}, {"severity": "error", "code": "e", "path": "p", "message": "m"}])
    assert "&lt;T&gt;" in page and page.count("</script>") == 1 and page.index("error: e") < page.index("warning: w") and "U &amp; V" in page


def test_block_index_is_dealt_to_bounded_pieces(spark, monkeypatch):
    """The more rows, the more pieces; an owner that names a block twice, or in two rows, stands on it once, and null and empty lists on none."""
    from marginalia.operators import skew

    rows = [(f"o{k:03d}", [f"b{k % 7}", f"b{k % 5}", f"b{k % 5}"]) for k in range(300)] + [("o001", ["b1"]), ("o900", []), ("o901", None)]
    df = spark.createDataFrame(rows, "item_id string, source_block_refs array<string>")
    monkeypatch.setattr(skew, "PIECE_ROWS", 50)
    got = W.block_index(df, "item_id")
    assert got.rdd.getNumPartitions() == -(-901 // 50)
    want = {b: sorted({o for o, refs in rows if b in (refs or ())}) for b in {b for _, refs in rows for b in refs or ()}}
    assert {r.block_id: r.owners for r in got.collect()} == want
