from __future__ import annotations

from marginalia.operators import entities as E
from marginalia.operators import graph as G
from marginalia.operators import registry as R
from marginalia.operators import spans as S
from marginalia.operators import validate as C
from marginalia.sources.store import Registry
from marginalia.streaming import units as U

CONCEPT = "pos long, concept_id string, surface string, concept_type string, canonical_name string, summary string, aliases array<string>, observed_surfaces array<string>, source_block_refs array<string>, grounding string"


def test_unify(spark):
    rows = [
        (1, "s1-c1", "Ann", "Person", "Ann Lee", "", ["A"], ["Ann"], ["b1"], "source_grounded"),
        (2, "s1-c2", "Lee", "person", "Ann Lee", "a poet", ["L", "A"], ["Lee"], ["b2"], "source_grounded"),
        (3, "s2-c1", "Lee", "person", "", "x", [], ["Lee"], ["b1"], "synthesis"),
        (4, "s2-c2", "Lee", "place", "", "", [], ["Lee"], ["b3"], "source_grounded"),
    ]
    merged, ids = E.unify(spark.createDataFrame(rows, CONCEPT))
    got = {r.new_id: r for r in merged.collect()}
    assert sorted(got) == ["concept-0001", "concept-0002"]
    one = got["concept-0001"]
    assert (one.surface, one.summary, one.aliases, one.source_block_refs, one.grounding, one.n_members) == ("Ann Lee", "a poet", ["A", "L"], ["b1", "b2"], "synthesis", 3)
    assert {r.concept_id: r.new_id for r in ids.collect()} == {"s1-c1": "concept-0001", "s1-c2": "concept-0001", "s2-c1": "concept-0001", "s2-c2": "concept-0002"}


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 102), (102, 101), (7, 7)]
    got = {r.node: r.root for r in G.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 100, 101: 100, 102: 100}
    assert G.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_delta_over_two_units(spark, tmp_path):
    columns = U.CONCEPT
    first = [("uc-1", "Ann", "person", "Ann Lee", "one", ["A"], ["Ann"], ["b1"], "source_grounded", "u1"), ("uc-2", "Rome", "place", "", "", [], ["Rome"], ["b2"], "source_grounded", "u1")]
    second = [("uc-1", "Ann", "person", "Ann Lee", "two", ["B"], ["Ann"], ["b7"], "source_grounded", "u2"), ("uc-2", "Rome", "place", "Roma", "", [], ["Rome"], ["b8"], "source_grounded", "u2"), ("uc-3", "Oslo", "place", "", "", [], [], ["b9"], "source_grounded", "u2")]
    store = Registry(spark, str(tmp_path))
    assert store.load("concepts") is None
    assert {r.op_type for r in U.fold_unit(store, spark.createDataFrame(first, columns))[0].collect()} == {"add_concept"}
    ops = {r.unit_ref: r.op_type for r in U.fold_unit(store, spark.createDataFrame(second, columns))[0].collect()}
    assert ops == {"uc-1": "merge_concepts", "uc-2": "ambiguity", "uc-3": "add_concept"}
    got = {r.id: r for r in store.load("concepts").collect()}
    assert sorted(got) == ["rc-000001", "rc-000002", "rc-000003", "rc-000004"]
    assert got["rc-000001"].summary == "[u1]: one [u2]: two" and got["rc-000001"].aliases == ["A", "B"]
    assert store.rollback("concepts", 1) == 3 and store.load("concepts").count() == 2


def test_stream_folds_each_file_once(spark, tmp_path):
    rows = [("uc-1", "Ann", "person", "Ann Lee", "one", ["A"], ["Ann"], ["b1"], "source_grounded", "u1")]
    spark.createDataFrame(rows, U.CONCEPT).write.parquet(f"{tmp_path}/in/a")
    args = (spark, f"{tmp_path}/in/*", f"{tmp_path}/registry", f"{tmp_path}/checkpoint")
    U.follow(*args).awaitTermination()
    U.follow(*args).awaitTermination()
    assert Registry(spark, f"{tmp_path}/registry").load("concepts").count() == 1


def test_links_and_remap(spark):
    units = spark.createDataFrame([("u1", "a", "t", "n"), ("u2", "b", "t", "")], "id string, surface string, concept_type string, canonical_name string")
    book = spark.createDataFrame([("r1", "a", "t", "n"), ("r2", "z", "t", "")], "id string, surface string, concept_type string, canonical_name string")
    links = spark.createDataFrame([("u1", "r2")], "unit_ref string, book_ref string")
    ops = {r.unit_ref: (r.op_type, r.book_ref, r.match_reason) for r in R.concept_operations(units, R.collisions(units, book), links).collect()}
    assert ops == {"u1": ("merge_concepts", "r2", "llm_link_proposal"), "u2": ("add_concept", None, "new")}
    m1 = spark.createDataFrame([("a", "b")], "old_id string, new_id string")
    m2 = spark.createDataFrame([("b", "c")], "old_id string, new_id string")
    assert [tuple(r) for r in E.compose(m1, m2).collect()] == [("a", "c")]


def test_spans(spark):
    m = spark.createDataFrame([(1, 0, 5, "a"), (1, 3, 12, "b"), (1, 12, 14, "c")], "unit_id long, start int, end int, record_id string")
    assert sorted(r.record_id for r in S.greedy(m).collect()) == ["b", "c"]
    assert [(r.start, r.end, r.depth) for r in S.sweep(m).orderBy("start").collect()] == [(0, 3, 1), (3, 5, 2), (5, 12, 1), (12, 14, 1)]
    h = spark.createDataFrame([(1, k, f"c{k % 3}", "chapter") for k in (0, 1, 2)] + [(1, 100 + 50 * k, f"c{k}", "chapter") for k in range(3)], "unit_id long, line long, label string, kind string")
    assert sorted(r.line for r in S.heading_islands(h).collect()) == [100, 150, 200]
    p = spark.createDataFrame([(1, 0, 0, "a"), (1, 1, 1, "b"), (1, 2, 2, "c"), (1, 3, 1, "d"), (1, 4, 2, "e")], "book long, at int, level int, id string")
    assert {r.id: r.parent for r in S.parents_by_level(p, "book", "at", "level", "id", 2).collect()} == {"a": None, "b": "a", "c": "b", "d": "a", "e": "d"}


def test_checks(spark):
    units = spark.createDataFrame([("u", "hello world")], "unit_id string, text string")
    blocks = spark.createDataFrame([("u", "block-000001", 0, 5, "hello"), ("u", "block-000002", 5, 11, " wurld"), ("u", "x", 3, 2, "")], "unit_id string, block_id string, start int, end int, text string")
    issues = C.block_issues(blocks, units)
    assert sorted((r.subject_id, r.code) for r in issues.collect()) == [("block-000002", "source_block_round_trip_mismatch"), ("x", "invalid_source_block_range"), ("x", "legacy_source_block_id"), ("x", "source_block_range_length_mismatch")]
    assert C.passed(issues).first().passed is False
    ops = spark.createDataFrame([("d", "s1", "o1", "new_concept", False), ("d", "s1", "o1", "nonsense", False), ("d", "s0", None, "merge_proposal", True)], "delta_id string, base_snapshot_id string, operation_id string, operation_type string, auto boolean")
    assert sorted(r.code for r in C.delta_issues(ops, "s1").collect()) == ["base_snapshot_mismatch", "destructive_auto_merge", "duplicate_operation_id", "missing_operation_id", "unsupported_delta_operation"]
    edges = spark.createDataFrame([("g", "a", "b", "x"), ("g", "a", "z", "x")], "group_id string, source string, target string, edge_type string")
    nodes = spark.createDataFrame([("g", "a"), ("g", "b")], "group_id string, node_id string")
    clean, bad = C.edge_issues(edges, nodes)
    assert clean.count() == 1 and bad.count() == 1
    merged = spark.createDataFrame([("m", ["p", "q"], [])], "id string, merged_from array<string>, source_block_refs array<string>")
    members = spark.createDataFrame([("p", ["b2", "b1"]), ("q", ["b1", "b3"])], "id string, source_block_refs array<string>")
    assert C.inherited_refs(merged, members).first().source_block_refs == ["b2", "b1", "b3"]


def test_unify_by_unit(spark):
    """Two surfaces with one canonical name are one concept, within their unit only."""
    blank = {"summary": "", "aliases": [], "observed_surfaces": [], "source_block_refs": [], "grounding": "source_grounded"}
    said = [("u1", 0, "he", "Shen Fu"), ("u1", 1, "Sanbai", "Shen Fu"), ("u1", 2, "he", ""), ("u1", 3, "she", ""), ("u2", 0, "he", "Shen Fu"), ("u2", 1, "Sanbai", "")]
    rows = [{"unit_id": u, "pos": k, "concept_id": f"s-{k}", "surface": s, "canonical_name": c, "concept_type": "person"} | blank for u, k, s, c in said]
    merged, ids = E.unify(spark.createDataFrame(rows, "unit_id string, " + CONCEPT), "unit_id")
    assert {(r.unit_id, r.concept_id): r.new_id for r in ids.collect()} == {
        ("u1", "s-0"): "concept-0001", ("u1", "s-1"): "concept-0001", ("u1", "s-2"): "concept-0001", ("u1", "s-3"): "concept-0002", ("u2", "s-0"): "concept-0001", ("u2", "s-1"): "concept-0002",
    }
    assert sorted((r.unit_id, r.new_id, r.n_members) for r in merged.collect()) == [("u1", "concept-0001", 3), ("u1", "concept-0002", 1), ("u2", "concept-0001", 1), ("u2", "concept-0002", 1)]


def test_reports_and_duplicates_hold_no_list_of_all_rows(spark, monkeypatch):
    """Copies are numbered in pieces of bounded size, and a report gathers the first three subjects of a code, not all."""
    from marginalia.operators import skew
    from marginalia.operators import validate as C

    monkeypatch.setattr(skew, "PIECE_ROWS", 50)
    rows = [(k % 90, k // 90, k) for k in range(400)]
    got = C.duplicate_ids(spark.createDataFrame(rows, "a long, b long, v long"), ["a"], ["v"])
    assert got.rdd.getNumPartitions() == 8 and sorted((r.v, r.copy) for r in got.collect()) == [(v, b + 1) for _, b, v in rows]
    issues = [("error", "x", f"s{k % 250:03d}") for k in range(1000)] + [("error", "y", "one"), ("error", "y", "one"), ("warning", "x", None), ("warning", "x", "b"), (None, "x", None)]
    report = C.report(spark.createDataFrame(issues, "severity string, code string, subject_id string"))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_set(" not in plan
    assert sorted(map(tuple, report.collect()), key=repr) == sorted([("error", "x", 1000, "s000,s001,s002"), ("error", "y", 2, "one"), ("warning", "x", 2, "b"), (None, "x", 1, "")], key=repr)
