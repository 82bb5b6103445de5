"""Proposals, deltas of items and groups, candidates, tools and package checks."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from marginalia.operators import entities as E
from marginalia.operators import packages as K
from marginalia.operators import proposals as P
from marginalia.operators import registry as R
from marginalia.operators import search as S
from marginalia.operators.skew import running
from marginalia.operators.tools import Tools, answer_summary, incomplete, proposal_key, result_summary, with_tools


def concept(k, surface, name="", kind="person", **more):
    return {"concept_id": f"concept-{k:04d}", "surface": surface, "canonical_name": name, "concept_type": kind, "aliases": [], "observed_surfaces": [surface], "source_block_refs": [f"block-{k}"]} | more


def merge_risk(targets, changes):
    """The plain version of ``merge_verdicts``, over the records of one merge."""
    surfaces = [t.get("surface", "") for t in targets]
    names = [t["canonical_name"] for t in targets if t.get("canonical_name")]
    proposed = {changes.get("surface", ""), changes.get("canonical_name", "")} - {""}
    if len(set(names)) == 1 or surfaces[0] and len(set(surfaces)) == 1 or proposed & {*surfaces, *names}:
        return None
    told_apart = [k for k in P.DISTINCT_TYPES if any(t.get("concept_type") == k for t in targets)]
    if told_apart:
        return f"merge_rejected: {told_apart[0]} concepts with different surfaces"
    return "merge_rejected: no target has the proposed name" if proposed else "merge_rejected: different surfaces and nothing shared"


def applied(spark, concepts, proposals):
    """Concepts, map of ids and implied items of one unit, unscreened and screened alike."""
    rows = [("u", json.dumps(concepts), json.dumps(proposals), "[]", "[]")]
    got = P.apply_by_unit(spark.createDataFrame(rows, "unit_id string, concepts string, concept_proposals string, groups string, group_proposals string")).first()
    return json.loads(got.concepts), json.loads(got.id_map), json.loads(got.implied), json.loads(got.unresolved)


def test_merge_risk():
    a, b, c = concept(1, "he"), concept(2, "Shen Fu", "Shen Fu"), concept(3, "spring", kind="time_anchor")
    assert merge_risk([a, b], {}) is None  # one name among them
    assert merge_risk([a, concept(4, "he")], {}) is None and merge_risk([a, concept(5, "she")], {"surface": "he"}) is None
    assert "time_anchor" in merge_risk([a, c], {}) and "proposed" in merge_risk([a, concept(5, "she")], {"surface": "people"})
    assert "nothing shared" in merge_risk([a, concept(5, "she")], {}) and merge_risk([concept(6, "x", "A"), concept(7, "y", "B")], {"canonical_name": "B"}) is None


def test_verdicts_of_rows_agree_with_records(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for g in range(120):
        proposed = rng.choice(["", "", "s1", "new"])
        members = [concept(k, rng.choice(["s1", "s2", ""]), rng.choice(["", "", "n1", "s2"]), rng.choice(["person", "place", "other"])) for k in range(rng.randint(1, 3))]
        want[g] = (merge_risk(members, {"surface": proposed}) if len(members) > 1 else None) or "safe"
        rows += [(g, m["surface"], m["canonical_name"], m["concept_type"], proposed) for m in members]
    got = P.merge_verdicts(spark.createDataFrame(rows, "g int, surface string, canonical_name string, concept_type string, proposed string"), "g").collect()
    assert {r.g: r.verdict for r in got} == {g: v.replace("merge_rejected: ", "") for g, v in want.items()}


def test_concept_proposals_in_order(spark):
    cs = [concept(1, "he"), concept(2, "Shen Fu", "Shen Fu", aliases=["Sanbai"]), concept(3, "garden", kind="place"), concept(4, "the two")]
    ps = [
        {"proposal_type": "merge", "target_refs": ["concept-0002", "concept-0001", "gone"], "changes": {"summary": "a man", "aliases": ["he himself"]}},
        {"proposal_type": "split", "target_refs": ["concept-0004"], "changes": {"split_into": [{"surface": "Yun"}, {"surface": "Fu"}]}},
        {"proposal_type": "refine", "target_refs": ["concept-0003"], "changes": {"canonical_name": "Canglang", "surface": "ignored"}},
        {"proposal_type": "reclassify", "target_refs": ["concept-0003"], "changes": {"concept_type": "scene_element"}},
        {"proposal_type": "link", "target_refs": ["concept-0002"], "registry_ref": "rc-000009", "changes": {"surface": "Fu"}, "implicit_refs": ["item-0001"]},
        {"proposal_type": "link", "target_refs": ["concept-0003"], "registry_ref": "rc-000010"},
        {"proposal_type": "new_concept", "target_refs": ["concept-0003"]},
        {"proposal_type": "merge", "target_refs": ["concept-0002", "concept-0001"]},
    ]
    after, renamed, implied, _ = applied(spark, cs, ps)
    got = {c["concept_id"]: c for c in after}
    assert set(got) == {"concept-0002", "concept-0003", "concept-0005", "concept-0006"}
    fu = got["concept-0002"]
    assert (fu["surface"], fu["summary"], fu["aliases"], fu["observed_surfaces"], fu["merged_from"], fu["registry_ref"]) == ("Fu", "a man", ["Sanbai", "he himself"], ["Shen Fu", "he"], ["concept-0002", "concept-0001"], "rc-000009")
    assert (got["concept-0003"]["canonical_name"], got["concept-0003"]["surface"], got["concept-0003"]["concept_type"]) == ("Canglang", "garden", "scene_element") and "registry_ref" not in got["concept-0003"]
    assert got["concept-0005"]["provenance"]["grounding"] == "synthesis" and renamed == {"concept-0002": "concept-0002", "concept-0001": "concept-0002", "concept-0004": "concept-0005"}
    assert implied == [{"concept_id": "concept-0002", "registry_ref": "rc-000009", "item_refs": ["item-0001"]}]


def test_group_proposals():
    gs = [{"group_id": f"group-000{k}", "summary": "", "group_type": "timeline"} for k in range(1, 5)]
    after, edges = P.apply_to_groups(gs, [
        {"proposal_type": "continue", "unit_group_ref": "group-0001", "registry_group_ref": "g9", "changes": {"summary": "s", "group_type": "no"}},
        {"proposal_type": "mutate", "unit_group_ref": "group-0002", "registry_group_ref": "g8", "changes": {"group_type": "theme_set"}},
        {"proposal_type": "new_thread", "unit_group_ref": "group-0003"},
        {"proposal_type": "cross_group_edge", "edge": {"source_group": "group-0001", "target_group": "g8"}},
        {"proposal_type": "merge_groups", "target_refs": ["group-0003", "group-0004"], "changes": {"summary": "both"}},
        {"proposal_type": "merge_groups", "target_refs": ["group-0001"]},
    ])
    got = {g["group_id"]: g for g in after}
    assert set(got) == {"group-0001", "group-0002", "group-0003"} and got["group-0003"]["merged_from"] == ["group-0004"] and got["group-0003"]["summary"] == "both"
    assert (got["group-0001"]["continuation"], got["group-0001"]["group_type"], got["group-0002"]["group_type"]) == ("continue", "timeline", "theme_set")
    assert edges[0]["edge_type"] == "related_to"


def test_units_are_applied_apart(spark):
    cs = [concept(1, "a"), concept(2, "b", kind="place"), concept(3, "a")]
    ps = [{"proposal_type": "merge", "target_refs": ["concept-0001", "concept-0002"], "delta_id": "d1"}, {"proposal_type": "merge", "target_refs": ["concept-0001", "concept-0003"]}]
    rows = [("u1", json.dumps(cs), json.dumps(ps), "[]", None), ("u2", None, None, None, None)]
    got = {r.unit_id: r for r in P.apply_by_unit(spark.createDataFrame(rows, "unit_id string, concepts string, concept_proposals string, groups string, group_proposals string")).collect()}
    assert [c["concept_id"] for c in json.loads(got["u1"].concepts)] == ["concept-0001", "concept-0002"] and json.loads(got["u1"].id_map)["concept-0003"] == "concept-0001"
    left = json.loads(got["u1"].unresolved)
    assert left[0]["item_id"] == "unresolved-0001" and left[0]["delta_id"] == "d1" and left[0]["kind"] == "merge_proposal_rejected" and json.loads(got["u2"].concepts) == []


def test_equivalent_records_and_rows(spark):
    cs = [concept(1, "Fu", "", summary=""), concept(2, "he", "Fu", summary="a man", aliases=["x"]), concept(3, ""), concept(4, "Fu", kind="place")]
    after, renamed = P.equivalent(cs)
    assert [c["concept_id"] for c in after] == ["concept-0001", "concept-0003", "concept-0004"] and renamed == {"concept-0002": "concept-0001"}
    assert (after[0]["summary"], after[0]["canonical_name"], after[0]["aliases"], after[0]["merged_from"]) == ("a man", "Fu", ["x"], ["concept-0001", "concept-0002"])
    rows = [(k, c["concept_id"], c["surface"], c["concept_type"], c["canonical_name"], c.get("summary", ""), c["aliases"], c["observed_surfaces"], c["source_block_refs"]) for k, c in enumerate(cs)]
    m = E.equivalent(spark.createDataFrame(rows, "pos long, concept_id string, surface string, concept_type string, canonical_name string, summary string, aliases array<string>, observed_surfaces array<string>, source_block_refs array<string>"))
    assert {r.concept_id: (r.summary, r.canonical_name) for r in m.collect()}["concept-0001"] == ("a man", "Fu")
    assert [tuple(r) for r in E.equivalence_map(m).collect()] == [("concept-0002", "concept-0001")]


def test_running_sums_over_ranges(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["hot", "hot", "a", None]), k, rng.randint(0, 9)) for k in range(500)]
    rng.shuffle(rows)
    got = running(spark.createDataFrame(rows, "key string, k int, v int"), "key", ["k"], F.col("v")).collect()
    for key in ("hot", "a", None):
        some = sorted((r for r in got if r.key == key), key=lambda r: r.k)
        assert [r.n for r in some] == list(range(1, len(some) + 1)) and [r.before for r in some] == [sum(x.v for x in some[:j]) for j in range(len(some))]


def test_index_of_a_registry_does_not_change():
    assert R.bound_index("", "i1") == "i1" == R.bound_index("i1", "i1")
    for have, unit in (("i1", "i2"), ("i1", "")):
        with pytest.raises(ValueError):
            R.bound_index(have, unit)


def test_small_registries_pass_whole_and_large_ones_do_not(spark):
    schema = "concept_id string, concept_type string, surface string, canonical_name string, summary string, aliases array<string>, observed_surfaces array<string>"
    book = [(f"rc-{k}", "person" if k % 2 else "place", f"name{k}", "", f"walks in garden{k} by the river", [], [f"name{k}"]) for k in range(60)]
    unit = [("u1", "person", "name7", "", "", [], []), ("u2", "person", "stranger", "", "walks in garden9", [], []), ("u3", "place", "spot", "", "zzz", [], [])]
    b, u = spark.createDataFrame(book, schema), spark.createDataFrame(unit, schema)
    some = S.select_concepts(u, b)
    got = {r.unit_concept_id: r for r in some["map"].collect()}
    assert not some["passed"] and got["u1"].candidate_ids == ["rc-7"] and got["u2"].semantic_candidate_ids[0] == "rc-9" and got["u3"].candidate_ids == []
    assert all(int(i[3:]) % 2 for i in got["u2"].candidate_ids)  # of the type's family
    near = lambda rest: rest.where("concept_id = 'u3'").select(F.col("concept_id").alias("query_id"), F.lit("rc-4").alias("doc_id"), F.lit(0.9).alias("score"))
    assert {r.unit_concept_id: r.candidate_ids for r in S.select_concepts(u, b, near)["map"].collect()}["u3"] == ["rc-4"]
    few = S.select_concepts(u, b.limit(5))
    assert few["passed"] and few["candidates"].count() == 5 and all(len(r.candidate_ids) == 5 for r in few["map"].collect())


def test_groups_by_concept_signal_and_type(spark):
    schema = "group_id string, group_type string, summary string, concept_refs array<string>, item_refs array<string>"
    book = spark.createDataFrame([(f"g{k}", "timeline" if k % 2 else "theme_set", f"about river{k}", [f"rc-{k}"], []) for k in range(60)], schema)
    unit = spark.createDataFrame([("ug", "timeline", "river8 story")], "group_id string, group_type string, summary string")
    linked = spark.createDataFrame([("c1", "rc-3"), ("c2", "")], "concept_id string, registry_ref string")
    got = {r.group_id: r.reason for r in S.select_groups(unit, book, linked).collect()}
    assert got["g3"] == "concept" and got["g8"] == "signal"
    nothing = spark.createDataFrame([("ug", "theme_set", "zzz")], "group_id string, group_type string, summary string")
    got = S.select_groups(nothing.withColumn("group_type", F.lit("nowhere")), book, linked.limit(0))
    assert got.count() == 0
    assert S.select_groups(unit, book.limit(3), linked).where("reason = 'all'").count() == 3


@pytest.fixture(scope="module")
def tools(spark):
    concepts = spark.createDataFrame([(f"rc-{k}", "person", f"name{k}", f"Name {k}", f"walks in garden{k}", [], [f"name{k}"]) for k in range(5)], "concept_id string, concept_type string, surface string, canonical_name string, summary string, aliases array<string>, observed_surfaces array<string>")
    groups = spark.createDataFrame([("g1", "timeline", "the river", ["rc-1"], ["i1"])], "group_id string, group_type string, summary string, concept_refs array<string>, item_refs array<string>")
    blocks = spark.createDataFrame([("block-1", "text")], "block_id string, text string")
    return Tools(concepts, groups, blocks, "a book")


def test_tools(tools):
    assert tools.call("get_concept", {"concept_id": "rc-2"})["result"]["canonical_name"] == "Name 2"
    assert tools.call("get_source_block", {"block_id": "block-1"})["result"]["text"] == "text" and tools.call("get_book_summary", {})["result"] == "a book"
    for name, args in (("get_concept", {}), ("get_group", {"group_id": "zz"}), ("nothing", {}), ("search_concepts", {"query": "x", "top_k": "many"})):
        assert "error" in tools.call(name, args)
    found = tools.call("search_concepts", {"query": "garden3", "top_k": 99})
    assert found["result"][0]["concept_id"] == "rc-3" and tools.call("search_concepts", {"query": ""})["result"] == []
    assert tools.call("search_groups", {"query": "river"})["result"][0]["group_id"] == "g1"
    short = result_summary(found)
    assert short["result_count"] == 1 and short["result_ids"] == ["rc-3"] and short["methods"] == ["bm25"] and len(short["top_scores"]) == 1
    assert result_summary({"tool": "x", "error": "e"}) == {"tool": "x", "error": "e"} and result_summary({"tool": "x", "result": "abc"})["result_chars"] == 3
    assert result_summary(tools.call("get_group", {"group_id": "g1"}))["result_id"] == "g1" and len(tools.definitions()) == 6


def test_asking_with_tools(tools):
    key = proposal_key("cross_unit_concept_resolution")
    assert key == "resolution_proposals" and proposal_key("cross_unit_group_resolution") == "group_resolution_proposals"
    assert incomplete({"tool_calls": [1]}, key) and incomplete({}, key) and incomplete({"status": "complete"}, key) and incomplete({"status": "complete", key: {}}, key) and not incomplete({"status": "complete", key: []}, key)

    def ask(payload):
        if payload.get("tools") and not payload["tool_results"]:
            return {"tool_calls": [{"tool": "get_concept", "arguments": {"concept_id": "rc-1"}}]}
        return {"status": "complete", key: [{"registry_ref": payload["tool_results"][0]["result"]["concept_id"]}]}

    answer, log = with_tools(ask, {"task": "cross_unit_concept_resolution"}, tools)
    assert answer[key] == [{"registry_ref": "rc-1"}] and len(log) == 2 and log[0]["tools"][0]["result_id"] == "rc-1"
    answer, log = with_tools(lambda p: {"status": "thinking"} if p.get("tools") else {key: []}, {"task": "x"}, tools, turns=3)
    assert answer == {key: []} and len(log) == 2 and answer_summary(answer, key)["proposal_count"] == 0
    _, log = with_tools(lambda p: {"tool_calls": [{"tool": "zz"}]}, {"task": "x"}, tools, turns=2)
    assert len(log) == 3 and log[0]["tools"][0]["error"]


def unit():
    return {
        "schema_version": K.UNIT_SCHEMA, "unit_id": "u", "source": {"unit_text": "One. Two."}, "unresolved_items": [], "validation": {}, "context_metadata": {},
        "source_blocks": [{"block_id": "block-1", "unit_id": "u", "segment_id": "s", "block_index": 0, "block_type": "paragraph", "start": 0, "end": 4, "text": "One.", "text_hash": "h"}, {"block_id": "block-2", "unit_id": "u", "segment_id": "s", "block_index": 1, "block_type": "paragraph", "start": 5, "end": 9, "text": "Two.", "text_hash": "h"}],
        "concepts": [{"concept_id": "c1", "surface": "One", "concept_type": "other", "source_block_refs": ["block-1"]}],
        "atomic_items": [{"item_id": "i1", "item_type": "event", "summary": "", "source_block_refs": ["block-1"], "concept_refs": ["c1"]}, {"item_id": "i2", "item_type": "event", "summary": "", "source_block_refs": ["block-2"]}],
        "logical_groups": [{"group_id": "g1", "group_type": "timeline", "summary": "", "item_refs": ["i1"], "graph": {"nodes": [{"node_id": "n1", "item_ref": "i1"}, {"node_id": "n2", "item_ref": "i2"}], "edges": [{"source": "n1", "target": "n2", "edge_type": "precedes"}]}}],
    }


def put(path, value):
    def change(u):
        *head, last = path
        for s in head:
            u = u[s]
        if value is KeyError:
            del u[last]
        else:
            u[last] = value

    return change


@pytest.mark.parametrize("change, codes", [
    (put(["source"], KeyError), {"missing_required_field"}), (put(["concepts"], {}), {"wrong_field_type", "unknown_ref"}), (put(["schema_version"], "v0"), {"schema_version_mismatch"}), (put(["timelines"], []), {"stale_core_field"}),
    (put(["atomic_items", 1, "item_id"], "i1"), {"duplicate_object_id", "unknown_ref"}), (put(["source_blocks", 0, "unit_id"], "x"), {"unit_id_mismatch"}), (put(["source_blocks", 0, "start"], -1), {"invalid_source_block_range", "source_block_range_length_mismatch", "source_block_round_trip_mismatch"}),
    (put(["source_blocks", 0, "text"], "one."), {"source_block_round_trip_mismatch"}), (put(["context_metadata", "source_index_id"], "si"), {"source_index_id_mismatch"}), (put(["concepts", 0, "concept_type"], " "), {"invalid_type_string"}),
    (put(["concepts", 0, "source_block_refs"], ["block-9"]), {"unknown_ref", "missing_source_block_refs"}), (put(["concepts", 0, "source_block_refs"], []), {"missing_source_block_refs"}), (put(["concepts", 0, "source_block_refs"], ["prior:1"]), {"prior_context_used_as_evidence", "missing_source_block_refs"}),
    (put(["concepts", 0, "aliases"], ["", 3]), {"empty_string_list_item", "wrong_item_type"}), (put(["concepts", 0, "aliases"], "x"), {"wrong_field_type"}), (put(["concepts", 0, "provenance"], {"grounding": "hm"}), {"invalid_grounding"}),
    (put(["atomic_items", 0, "temporal_attributes"], [{"kind": "", "source_block_ref": "block-9"}, 3]), {"invalid_type_string", "unknown_ref", "wrong_item_type"}), (put(["metrics"], []), {"wrong_field_type"}),
    (put(["logical_groups", 0, "graph", "edges", 0, "target"], "n9"), {"unknown_ref"}), (put(["logical_groups", 0, "graph", "nodes", 0, "item_ref"], "i9"), {"unknown_ref"}), (put(["logical_groups", 0, "graph", "edges", 0, "provenance"], {"grounding": "source_grounded"}), {"missing_source_grounded_evidence"}),
    (put(["logical_groups", 0, "graph", "edges"], 3), {"wrong_field_type"}),
])
def test_one_rule_at_a_time(change, codes):
    u = unit()
    assert K.unit_issues(u) == []
    change(u)
    assert {i["code"] for i in K.unit_issues(u)} == codes


def test_lost_references_and_edges_are_taken_out():
    u = unit()
    u["concepts"][0]["source_block_refs"] = ["block-9", "block-1"]
    u["logical_groups"][0]["graph"]["edges"].append({"source": "n1", "target": "zz", "edge_type": "x"})
    K.unit_issues(u)
    assert u["concepts"][0]["source_block_refs"] == ["block-1"] and len(u["logical_groups"][0]["graph"]["edges"]) == 1
    u["concepts"][0] |= {"source_block_refs": [], "provenance": {"grounding": "llm_inferred"}}
    assert K.unit_issues(u) == [] and {i["code"] for i in K.unit_issues(None)} == {"missing_required_field", "schema_version_mismatch"}


def test_delta_documents():
    d = {"schema_version": "v", "delta_id": "d", "base_snapshot_id": "s", "unit_id": "u", "operations": [{"operation_id": "o", "operation_type": "new_concept"}], "validation": {}}
    assert K.delta_document_issues(d, "s") == []
    d["operations"] += [{"operation_id": "o", "operation_type": "merge", "evidence_refs": [{"ref": ["book_context:1"]}]}, {}, 3]
    assert sorted(i["code"] for i in K.delta_document_issues(d, "t")) == ["base_snapshot_mismatch", "destructive_auto_merge", "duplicate_object_id", "missing_required_field", "prior_context_used_as_evidence", "unsupported_delta_operation", "unsupported_delta_operation", "wrong_item_type"]


def extraction():
    return {"unit_id": "u", "evidence_spans": [{"evidence_id": "e1", "quote": "Ada met John"}], "entity_mentions": [{"mention_id": "m1", "surface": "Ada", "evidence_span_ids": ["e1"]}], "location_mentions": [], "atom_mentions": [{"atom_id": "a1", "evidence_span_ids": ["e1"], "participant_mention_ids": ["m1"], "time_expression_ids": None}], "time_expressions": [], "thread_candidates": [], "warnings": []}


def test_extractions():
    text = "In spring Ada met John.\n\nJohn left. John came."
    issues, found = K.extraction_issues(extraction(), text, "u")
    assert issues == [] and (found[0]["status"], found[0]["start"]) == ("exact", 10)
    bad = extraction()
    bad["evidence_spans"] += [{"evidence_id": "e2", "quote": "John"}, {"evidence_id": "e3", "quote": "Ada met nobody at all"}, {"evidence_id": "e1", "quote": "x" * 700}, {"evidence_id": "", "quote": ""}, 3]
    bad["entity_mentions"] += [{"mention_id": "m1", "surface": "Zoe", "evidence_span_ids": ["e2", "zz"]}, {"surface": "q", "evidence_span_ids": []}]
    bad["atom_mentions"][0] |= {"participant_mention_ids": ["m9"], "location_mention_ids": "x"}
    issues, found = K.extraction_issues(bad, text, "v")
    codes = [i["code"] for i in issues]
    for code in ("unit_id_mismatch", "evidence_quote_ambiguous", "evidence_quote_missing", "evidence_quote_too_long", "duplicate_object_id", "missing_evidence_quote", "missing_object_id", "wrong_object_type", "unresolved_evidence_ref", "missing_evidence_refs", "surface_not_in_evidence_context", "unresolved_object_ref", "wrong_reference_field_type"):
        assert code in codes, code
    hint = next(i for i in issues if i["code"] == "evidence_quote_missing" and i["evidence_id"] == "e3")
    assert hint["source_windows"][0]["start"] == 10
    payload = K.repair_payload("u", issues, found, 3)
    assert len(payload["issues"]) == 3 and payload["quality_summary"]["truncated"] and all(f["status"] in ("ambiguous", "missing") for f in payload["evidence_relocation"]["unresolved"])
    assert "surface_not_in_evidence_context" not in {i["code"] for i in K.repair_payload("u", issues, found)["issues"]}
    done = K.validated(extraction(), *K.extraction_issues(extraction(), text))
    assert done["passed"] and done["data"]["evidence_spans"][0]["source_location"]["status"] == "exact"


def test_overviews_uncertainties_and_bad_json(spark):
    assert K.overview_issues({"unit_id": "u", "overview_segments": [{"start_quote": "a", "end_quote": "b"}], "warnings": []}) == []
    assert [i["path"] for i in K.overview_issues({"unit_id": "u", "overview_segments": [{"start_quote": "a"}, 3], "warnings": []})] == ["overview_segments[0].end_quote", "overview_segments[1]"]
    data = {"concepts": [{"uncertainty": ["a", {"note": "b"}, 3]}], "logical_groups": [{"graph": {"edges": [{"uncertainty": None}]}}]}
    assert K.coerced(data) == {"concepts": [{"uncertainty": ["a", '{"note": "b"}', "3"]}], "logical_groups": [{"graph": {"edges": [{"uncertainty": []}]}}]}
    assert K.index_id_of({"context_metadata": {"source_index_id": "s"}}) == "s" and K.index_id_of({}) == ""
    got = K.issues_of(spark.createDataFrame([("a", "{"), ("b", None), ("c", json.dumps(unit()))], "key string, package string"), K.unit_issues).collect()
    assert sorted((r.key, r.code) for r in got) == [("a", "invalid_json"), ("b", "invalid_json")]


@pytest.mark.parametrize("name", ["registry_apply_remap", "registry_items_added"])
def test_references_to_parts_of_more_than_six_digits(spark, duck, tmp_path, name):
    """The SQL names a part by six characters of its number; so do the queries."""
    from marginalia.plans import entities, resolution
    from tests.conftest import of_spark

    spark.read.parquet("/root/testdata/sf0.001/part.parquet").coalesce(1).write.parquet(f"{tmp_path}/p")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(60)
    more = lines.unionByName(lines.withColumn("l_partkey", F.col("l_partkey") + 1_199_000)).unionByName(lines.withColumn("l_partkey", F.col("l_partkey") + 99_900))
    more.coalesce(1).write.parquet(f"{tmp_path}/l")
    (tmp_path / "sf").mkdir()
    for short, table in (("p", "part"), ("l", "lineitem")):
        next((tmp_path / short).glob("*.parquet")).rename(tmp_path / "sf" / f"{table}.parquet")
    catalog = entities.catalog if name in entities.catalog.queries else resolution.catalog
    assert of_spark(catalog.queries[name](spark, f"{tmp_path}/sf")) == duck(catalog.sql[name], f"{tmp_path}/sf")
