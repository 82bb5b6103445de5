from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from marginalia import cli
from marginalia.operators import context as X
from marginalia.operators import repair as P
from marginalia.plans import reading
from marginalia.sources import backend as K
from marginalia.sources.store import Registry, runs


def test_repair():
    data = {"a": [{"refs": ["x", "", "y"]}, {"refs": []}], "version": "old"}
    assert P.steps("a[0].refs[1]") == ["a", 0, "refs", 1] and P.resolve(data, "a[0].refs[2]") == "y"
    out, failed = P.patched(data, [{"path": "a[0].refs[0]", "operation": "remove"}, {"path": "a[0].refs[1]", "operation": "remove"}, {"path": "a[1].refs", "operation": "append", "value": "z"}, {"path": "b.c", "operation": "remove"}])
    assert out["a"] == [{"refs": ["y"]}, {"refs": ["z"]}] and len(failed) == 1 and data["a"][0]["refs"] == ["x", "", "y"]

    def validate(d):
        found = [{"code": "empty_string_list_item", "path": f"a[0].refs[{k}]"} for k, r in enumerate(d["a"][0]["refs"]) if not r]
        return found + ([{"code": "schema_version_mismatch", "path": "version", "expected": "new"}] if d["version"] != "new" else [])

    fixed, left = P.repaired(data, validate)
    assert fixed["a"][0]["refs"] == ["x", "y"] and fixed["version"] == "new" and left == []
    stuck, left = P.repaired({"q": 1}, lambda d: [] if d["q"] == 2 else [{"code": "odd", "path": "q"}], lambda d, i: [{"path": "q", "operation": "replace", "value": 2}])
    assert stuck == {"q": 2} and left == []


def test_backend():
    assert K.parse_object('Sure: {"a": 1}.') == {"a": 1}
    with pytest.raises(ValueError):
        K.parse_object("[1]")
    assert K.token_estimate("相如" + "a" * 10) == 5 and K.check_budget("abc", 10) == 1
    with pytest.raises(K.BudgetError):
        K.check_budget("abc", 0)
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError
        return "ok"

    assert K.retried(flaky, K.worth_retrying, wait=0) == "ok"
    c = K.Conversation.begin("s", {"x": 1})
    c.say("assistant", "one", ms=3)
    assert K.Conversation.from_dict(json.loads(json.dumps(c.to_dict()))) == c and c.last_answer() == "one"


def test_reading(spark, tmp_path):
    units = spark.createDataFrame([("unit-0001", "Ann went home.\n\nBob stayed there.\n\nAnn slept."), ("unit-0002", "Ann came back.\n\nCy left.")], "unit_id string, text string")
    said = []
    got = reading.run_reading(spark, units, K.RuleBackend(), str(tmp_path), progress=said.append)
    first, second = (r["operations"] for r in got["runs"])
    assert first == {"add_concept": 2, "add_group": 1, "add_item": 3}
    # the stand-in links by type alone; what shares nothing else is refused
    assert second == {"merge_concepts": 1, "merge_rejected": 1, "continue_group": 1, "add_item": 2} and any("link" in x for x in said)
    registry = Registry(spark, f"{tmp_path}/registry")
    assert sorted(r.surface for r in registry.load("concepts").collect()) == ["Ann", "Bob", "Cy"] and runs(spark, f"{tmp_path}/runs").count() == 2
    assert [r.kind for r in registry.load("unresolved").collect()] == ["merge_rejected"] and registry.load("digest").first().digest.startswith("3 concepts")
    groups = {r.group_id: r for r in registry.load("groups").collect()}
    assert groups["group-0002"].registry_group_ref == "group-0001" and groups["group-0002"].item_refs == ["item-0004", "item-0005"]
    items = {r.item_id: r.concept_refs for r in registry.load("items").collect()}
    assert items["item-0001"] == items["item-0003"] == items["item-0004"] == ["rc-000001"]
    run = got["runs"][1]["run_hash"]
    package = reading.load_package(spark, str(tmp_path), "unit-0002", run)
    assert package["validation"]["passed"] and package["logical_groups"][0]["continuation"] == "continue"
    page = reading.view(spark, str(tmp_path), "unit-0002", run)
    assert '<mark data-concept="concept-0001">Ann</mark>' in page and "</script>" in page


def test_a_package_that_cannot_be_mended(spark, tmp_path):
    class Bad(K.RuleBackend):
        def complete(self, prompt, payload):
            if payload.get("task") == "grouping":
                return {"logical_groups": [{"group_id": "g1", "group_type": "", "item_refs": []}]}
            return super().complete(prompt, payload)

    units = spark.createDataFrame([("u", "Ann went home.")], "unit_id string, text string")
    with pytest.raises(reading.ReadingError, match="invalid_type_string"):
        reading.run_reading(spark, units, Bad(), str(tmp_path))


def test_fixes_by_code():
    data = {"concepts": [{"concept_id": "c1", "source_block_refs": ["b1"]}, {"concept_id": "c1", "aliases": [{"x": 1}]}, {"concept_id": "c1_dedup2", "merged_from": ["c1"], "source_block_refs": []}], "start": "x"}
    issues = [
        {"code": "duplicate_object_id", "path": "concepts[1].concept_id"}, {"code": "wrong_item_type", "path": "concepts[1].aliases[0]"}, {"code": "missing_required_field", "path": "concepts[0].surface"}, {"code": "missing_required_field", "path": "concepts[0].odd"},
        {"code": "wrong_field_type", "path": "start", "message": "start must be int"}, {"code": "missing_source_block_refs", "path": "concepts[2].source_block_refs"}, {"code": "unit_id_mismatch", "path": "unit_id"}, {"code": "unknown_ref", "path": "concepts[0].gone[0]"},
    ]
    out, left = P.fixed(data, issues)
    assert out["concepts"][1] == {"concept_id": "c1_dedup3", "aliases": ['{"x": 1}']} and out["concepts"][0]["surface"] == "" and out["start"] == 0 and out["concepts"][2]["source_block_refs"] == ["b1"]
    assert [i["path"] for i in left] == ["concepts[0].odd", "unit_id", "concepts[0].gone[0]"]
    message = json.loads(P.repair_message(left))
    assert message["task"] == "repair_extraction" and message["errors"][1]["code"] == "unit_id_mismatch"
    assert P.synced({"concepts": [1], "x": 2}, {"concepts": [], "y": 3}) == {"concepts": [1], "y": 3} and P.log_line(left, 1).startswith("repair 1: 3 issues")
    c = K.Conversation.begin("s", "u")
    c.say("assistant", "a", ms=1)
    P.record_on_turn(c, [{"code": "x", "severity": "error"}])
    assert c.turns[-1]["validation"] == {"errors": 1, "codes": ["x"]}


def test_http_backend():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    answers = [(500, b""), (200, {"choices": [{"finish_reason": "length", "message": {"content": "{"}}]}), (200, {"choices": [{"message": {"content": "not json"}}]}), (200, {"choices": [{"message": {"content": 'Here: {"a": 1}'}}]}), (400, b"")]
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            code, body = answers[len(asked) - 1]
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body if isinstance(body, bytes) else json.dumps(body).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    b = K.backend_of("http", f"http://127.0.0.1:{server.server_port}/", "m", "k")
    b.tries, b.wait = 5, 0
    assert b.complete("p", {"x": 1}) == {"a": 1} and len(asked) == 4 and asked[0]["response_format"] == {"type": "json_object"} and b.identity() == "http:m:4096"
    with pytest.raises(Exception, match="400"):
        b.complete("p", {})
    server.shutdown()
    for args in (("other",), ("http",)):
        with pytest.raises(ValueError):
            K.backend_of(*args)
    with pytest.raises(K.BudgetError):
        K.HttpBackend("http://x", "m", output=0)
    assert K.RuleBackend().complete("", {"task": "mentions", "text": "Ann came. Bob left."})["evidence_spans"][0]["quote"] == "Ann came."
    assert K.RuleBackend().complete("", {"task": "digest_update", "previous_digest": "old", "concepts": []})["digest"].startswith("old\n0 concepts")


def test_saved_passes_and_folders(spark, tmp_path):
    from marginalia.sources import store

    assert store.load_pass(spark, str(tmp_path / "passes"), "k") == {}
    store.save_pass(spark, str(tmp_path / "passes"), "overview", "k", prompt="p", answer={"a": 1})
    assert store.load_pass(spark, str(tmp_path / "passes"), "k") == {"prompt": "p", "answer": '{"a": 1}'}
    book = store.book_id("/x/My Book.txt")
    assert book.startswith("My-Book-") and store.folders("/c/", book, "u1")["unit"] == f"/c/{book}/units/u1" and store.scalars({"a": 1, "b": [1], "c": None}) == {"a": 1, "c": None}
    r = Registry(spark, str(tmp_path / "r"))
    assert r.tag("t") is None
    r.save("t", spark.range(1), "7")
    assert r.tag("t") == "7" and r.save("t", spark.range(2)) == 2 and r.tag("t") is None


def test_context(spark):
    records = spark.createDataFrame([(1, "u1", "e1", "Ann", ["l1"]), (2, "u1", "e1", "Anne", []), (3, "u2", "e1", "Bob", ["e9"])], "pos int, unit_id string, local_id string, name string, refs array<string>")
    m = X.merged_records(records, "entity")
    assert sorted((r.record_id, r.name, r.refs) for r in m.collect()) == [("u1:e1", "Ann", ["u1:l1"]), ("u2:e1", "Bob", ["u2:e9"])]
    assert X.snapshot_id(m).first() == X.snapshot_id(m.repartition(3)).first()
    hits = spark.createDataFrame([("u3", "u2:e1"), ("u3", "u2:e1"), ("u3", "u1:e1")], "unit_id string, record_id string")
    threads = spark.createDataFrame([("t1", "old", "resolved"), ("t2", "new", "open")], "record_id string, name string, status string")
    pack = X.context_pack(hits, m.select("record_id", "name", "kind"), threads).first()
    assert [r.record_id for r in pack.records] == ["u2:e1", "u1:e1"] and [t.record_id for t in pack.threads] == ["t2", "t1"]


def test_older_packages_and_contexts(spark, tmp_path):
    one = {"unit_id": "u1", "entity_records": [{"entity_id": "e1", "canonical_name": "Ann", "surfaces": ["Ann", "she"], "refs": ["t1"]}], "thread_records": [{"thread_id": "t1", "name": "a trip", "status": "resolved"}]}
    two = {"data": {"unit_id": "u2", "location_records": [{"location_id": "l1", "surfaces": ["Rome"]}], "thread_records": [{"thread_id": "t1", "name": "a search", "status": "open"}]}}
    for name, p in (("a", json.dumps(one)), ("b", json.dumps(two)), ("c", "{")):
        (tmp_path / f"{name}.json").write_text(p)
    rows = X.legacy_records(spark, str(tmp_path))
    assert sorted((r.unit_id, r.kind, r.local_id, r.name, r.status) for r in rows.collect()) == [("u1", "entity", "e1", "Ann", ""), ("u1", "thread", "t1", "a trip", "resolved"), ("u2", "location", "l1", "Rome", ""), ("u2", "thread", "t1", "a search", "open")]
    named = rows.select(X.scoped(F.col("unit_id"), F.col("local_id")).alias("record_id"), "name", "kind", "status")
    pack = X.passive_pack(named).first()
    assert [r.record_id for r in pack.records] == ["u1:e1", "u2:l1"] and [t.name for t in pack.threads] == ["a search", "a trip"]
    X.save_context(str(tmp_path / "out"), records=named, pack=X.passive_pack(named))
    assert spark.read.json(str(tmp_path / "out" / "records")).count() == 4


def test_a_registry_stands_on_one_index(spark, tmp_path):
    r = reading.Reader(spark, K.RuleBackend(), str(tmp_path))
    r.bind("i1")
    r.bind("i1")
    with pytest.raises(ValueError):
        r.bind("i2")


def test_selection_and_text_cleanup(spark):
    from marginalia.functions import text as T

    surfaces = spark.createDataFrame([("r1", "Ann"), ("r2", "Bo"), ("r3", "Cy Lee")], "record_id string, surface string")
    report = {r.matched: (r.n_surfaces, r.n_short) for r in X.selection_report(spark.createDataFrame([("u", "r1")], "unit_id string, record_id string"), surfaces).collect()}
    assert report == {True: (1, 0), False: (2, 1)}
    row = spark.createDataFrame([(" a\xa0&amp;&nbsp; b\r ", "\n x\n\n\n\ny ")], "a string, b string").select(T.collapse_space(F.col("a")), T.cleanup(F.col("b"))).first()
    assert tuple(row) == ("a & b", "x\n\ny")


def test_cli(spark, tmp_path, capsys):
    (tmp_path / "b.txt").write_text("Chapter 1\nOne went.\nChapter 2\nTwo came.")
    assert cli.main(["index", str(tmp_path / "b.txt")], spark) == 0 and "Chapter 2" in capsys.readouterr().out
    assert cli.main(["extract", str(tmp_path / "b.txt"), "unit-0002"], spark) == 0 and "Two came." in capsys.readouterr().out
    assert cli.main(["split-blocks", str(tmp_path / "b.txt"), "unit-0001"], spark) == 0 and capsys.readouterr().out.startswith("unit-0001\t0\t0\t")
    assert cli.main(["extract", str(tmp_path / "b.txt"), "unit-9"], spark) == 1


def test_cli_checks_and_indexes(spark, tmp_path, capsys):
    book = str(tmp_path / "b.txt")
    (tmp_path / "b.txt").write_text("Chapter 1\nAnn went. Bob came.\nChapter 2\nTwo came.")
    data = {"unit_id": "unit-0001", "evidence_spans": [{"evidence_id": "e1", "quote": "Ann went"}], "entity_mentions": [{"mention_id": "m", "surface": "Ann", "evidence_span_ids": ["e1"]}], "location_mentions": [], "atom_mentions": [], "time_expressions": [], "thread_candidates": [], "warnings": []}
    (tmp_path / "x.json").write_text(json.dumps(data))
    assert cli.main(["validate-result", book, "unit-0001", str(tmp_path / "x.json")], spark) == 0 and "passed: 0 errors" in capsys.readouterr().out
    (tmp_path / "x.json").write_text(json.dumps(data | {"unit_id": "u", "evidence_spans": []}))
    assert cli.main(["validate-result", book, "unit-0001", str(tmp_path / "x.json"), "--repair-payload"], spark) == 1
    assert {i["code"] for i in json.loads(capsys.readouterr().out)["issues"]} == {"unit_id_mismatch", "unresolved_evidence_ref"}
    (tmp_path / "x.json").write_text("{")
    assert cli.main(["validate-result", book, "unit-0001", str(tmp_path / "x.json")], spark) == 2
    capsys.readouterr()
    assert cli.main(["source-index", book, "--save", str(tmp_path / "index")], spark) == 0
    place, ident, n = capsys.readouterr().out.split()
    from marginalia.sources import index

    got = index.load(spark, place)
    assert got["meta"]["source_index_id"] == ident and got["blocks"].count() == int(n)
