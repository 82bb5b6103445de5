"""Reading units from end to end: overview, extraction, unification, resolution against the book, grouping, package and registry."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import blocks as B
from ..operators import entities as E
from ..operators import locate as L
from ..operators import registry as R
from ..operators import search as S
from ..operators import views as W
from ..operators.packages import UNIT_SCHEMA, coerced, index_id_of, summary, unit_issues
from ..operators.proposals import apply_by_unit, apply_to_groups, equivalent, listed
from ..operators.repair import repair_message, repaired
from ..operators.tools import Tools, with_tools
from ..sources import store
from ..sources.backend import Backend, answers, prompt_of
from ..storage import written
from ..streaming.units import CONCEPT, GROUP, ITEM, fold_concepts, fold_records

_CONCEPTS = "array<struct<concept_id:string,surface:string,concept_type:string,canonical_name:string,summary:string,aliases:array<string>,observed_surfaces:array<string>,source_block_refs:array<string>,grounding:string>>"
_ITEMS = "array<struct<item_id:string,item_type:string,summary:string,source_block_refs:array<string>,concept_refs:array<string>,grounding:string>>"
_SEGMENTS = "array<struct<segment_id:string,start_quote:string,end_quote:string,title:string,summary:string>>"


def asked(payloads: DataFrame, backend: Backend, task: str, cache: DataFrame | None = None) -> DataFrame:
    """``key, answer`` for rows of ``key, payload``; what a cache (``pass_key, answer``) holds is not asked again."""
    prompt = prompt_of(task)
    keyed = payloads.withColumn("pass_key", store.pass_key(F.lit(store.json_hash(prompt)), F.col("payload"), F.lit(backend.identity())))
    if cache is None:
        return written(answers(payloads, backend, prompt).join(keyed.select("key", "pass_key"), "key"), task)
    hits, misses = store.cached(keyed, cache.select("pass_key", "answer"), "pass_key")
    new = answers(misses, backend, prompt).join(misses.select("key", "pass_key"), "key")
    return written(new.select("key", "answer", "pass_key").unionByName(hits.select("key", "answer", "pass_key")), task)


def overview(units: DataFrame, backend: Backend) -> DataFrame:
    """Segments (``unit_id, segment_id, start, end``) that cover each unit (``unit_id, text``)."""
    payload = F.to_json(F.struct(F.lit("overview").alias("task"), "text"))
    got = asked(units.select(F.col("unit_id").alias("key"), payload.alias("payload")), backend, "overview")
    rows = got.select(F.col("key").alias("unit_id"), F.explode(F.from_json("answer", f"segments {_SEGMENTS}")["segments"]).alias("s")).join(units, "unit_id")
    quotes = rows.select(F.xxhash64("unit_id").alias("doc_id"), F.xxhash64("s.segment_id").alias("item_id"), "unit_id", "s.segment_id", "text", "s.start_quote", "s.end_quote")
    at = lambda c: L.located(quotes.select("doc_id", "item_id", "text", F.col(c).alias("quote"))).select("doc_id", "item_id", F.col("start").alias(f"{c}_a"), F.col("end").alias(f"{c}_b"))
    found = quotes.join(at("start_quote"), ["doc_id", "item_id"]).join(at("end_quote"), ["doc_id", "item_id"])
    return L.resolved_segments(found.select("unit_id", "segment_id", F.col("start_quote_a").alias("start"), F.col("end_quote_b").alias("end"), F.length("text").cast("long").alias("unit_chars")))


def read_units(units: DataFrame, backend: Backend) -> dict[str, DataFrame]:
    """The tables of a batch of units (``unit_id, text``): blocks, segments, items, and concepts before and after those of all segments are one."""
    named = F.format_string("block-%06d", F.col("block_index") + 1)
    blocks = written(B.source_blocks(units, "unit_id").withColumn("block_id", named), "blocks")
    segments = written(overview(units, backend), "segments")
    inside = blocks.join(segments.select("unit_id", "segment_id", F.col("start").alias("range_start"), F.col("end").alias("range_end")), "unit_id").where((F.col("end") > F.col("range_start")) & (F.col("start") < F.col("range_end")))
    lists = inside.groupBy("unit_id", "segment_id").agg(F.array_sort(F.collect_list(F.struct("start", "block_id", "text"))).alias("blocks"))
    key = F.concat_ws("|", "unit_id", "segment_id")
    got = asked(lists.select(key.alias("key"), F.to_json(F.struct(F.lit("extraction").alias("task"), "blocks")).alias("payload")), backend, "extraction")
    parsed = got.select("key", F.from_json("answer", f"concepts {_CONCEPTS}, atomic_items {_ITEMS}").alias("a"))
    unit, segment = F.split("key", r"\|")[0].alias("unit_id"), F.split("key", r"\|")[1].alias("segment_id")
    raw = parsed.select(unit, segment, F.posexplode("a.concepts").alias("p", "c"))
    pos = F.row_number().over(Window.partitionBy("unit_id").orderBy("segment_id", "p"))
    concepts = raw.select("unit_id", "segment_id", pos.alias("pos"), "c.*").withColumn("concept_id", F.concat_ws("-", "segment_id", "concept_id"))
    merged, _ = E.unify(concepts.withColumn("pos", F.col("pos").cast("long")), "unit_id")
    merged = written(merged.withColumnRenamed("new_id", "id").drop("root"), "concepts")
    ids = merged.select("unit_id", "id", F.explode("merged_from").alias("old_id"))
    items = parsed.select(unit, segment, F.posexplode("a.atomic_items").alias("p", "i")).select("unit_id", "segment_id", "p", "i.*")
    n = F.row_number().over(Window.partitionBy("unit_id").orderBy("segment_id", "p"))
    items = items.withColumn("item_id", F.format_string("item-%04d", n)).withColumn("concept_refs", F.transform("concept_refs", lambda r: F.concat_ws("-", F.col("segment_id"), r)))
    refs = items.select("unit_id", "item_id", F.posexplode("concept_refs").alias("k", "old_id")).join(ids, ["unit_id", "old_id"], "left")
    refs = refs.groupBy("unit_id", "item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", F.coalesce("id", "old_id").alias("r")))), lambda x: x["r"]).alias("concept_refs"))
    items = written(items.drop("concept_refs", "p").join(refs, ["unit_id", "item_id"], "left"), "items")
    return {"blocks": blocks, "segments": segments, "concepts": merged, "items": items, "concepts_before": concepts}


def segment_counts(before: DataFrame, after: DataFrame, unresolved: int = 0) -> dict[str, int]:
    """How many concepts segments had, how many are left, and what is open."""
    n, m = before.count(), after.count()
    return {"concepts_before_merge": n, "concepts_after_merge": m, "concept_merge_count": n - m, "unresolved_items": unresolved}


class ReadingError(RuntimeError):
    """A package that is not valid after all repairs; ``issues`` say why."""

    def __init__(self, unit_id: str, issues: list[dict[str, Any]]):
        super().__init__(f"{unit_id}: " + ", ".join(f"{i['code']} at {i['path']}" for i in issues[:5]))
        self.issues = issues


def records_of(rows: DataFrame) -> list[dict[str, Any]]:
    """Rows of one unit as records."""
    return [json.loads(x) for x in rows.toJSON().toLocalIterator()]


class Reader:
    """Reads one unit after another into the registry in a folder. ``progress`` is told of each step."""

    def __init__(self, spark: SparkSession, backend: Backend, folder: str, scope: str = "book", turns: int = 3, progress: Callable[[str], None] | None = None):
        if scope not in ("book", "unit"):
            raise ValueError("a scope is book or unit")
        self.spark, self.backend, self.folder, self.scope, self.turns = spark, backend, folder.rstrip("/"), scope, turns
        self.registry = store.Registry(spark, f"{self.folder}/registry")
        self.progress = progress or (lambda line: None)

    # Passes

    def _ask(self, task: str, payload: dict[str, Any], log: list[Any] | None = None) -> dict[str, Any]:
        """An answer, from the saved passes if they have it; parts of a new one are saved."""
        prompt, body = prompt_of(task), json.dumps(payload, sort_keys=True, ensure_ascii=False)
        key = store.json_hash([task, prompt, body, self.backend.identity()])
        have = store.load_pass(self.spark, f"{self.folder}/passes", key)
        if "answer" in have:
            return json.loads(have["answer"])
        if log is None:
            answer = self.backend.complete(prompt, payload)
        else:
            answer, turns = with_tools(lambda p: self.backend.complete(prompt, p), payload, self.tools())
            log += turns
        store.save_pass(self.spark, f"{self.folder}/passes", task, key, prompt=prompt, payload=body, answer=answer, log=log or [])
        return answer

    def tools(self) -> Tools:
        concepts = self._table("concepts", CONCEPT).withColumnRenamed("id", "concept_id")
        return Tools(concepts, self._table("groups", GROUP), summary=self.digest())

    def _table(self, name: str, schema: str) -> DataFrame:
        rows = self.registry.load(name)
        return self.spark.createDataFrame([], schema) if rows is None else rows

    def resolve_concepts(self, unit_id: str, concepts: list[dict[str, Any]]) -> dict[str, Any]:
        """The unit's concepts after proposals against the book's: ``concepts, id_map, implied, unresolved, log, tallies``."""
        book = self._table("concepts", CONCEPT).withColumnRenamed("id", "concept_id")
        nothing = {"concepts": concepts, "id_map": {}, "implied": [], "unresolved": [], "log": [], "tallies": {}}
        if self.scope == "unit" or book.isEmpty() or not concepts:
            return nothing
        schema = "concept_id string, concept_type string, surface string, canonical_name string, summary string, aliases array<string>, observed_surfaces array<string>"
        columns = [c.split()[0] for c in schema.split(", ")]
        mine = self.spark.createDataFrame([tuple(c.get(k) for k in columns) for c in concepts], schema)
        chosen = S.select_concepts(mine, book.select(*columns))
        some = book.join(chosen["candidates"], "concept_id", "left_semi").orderBy("concept_id")
        log: list[Any] = []
        payload = {"task": "cross_unit_concept_resolution", "unit_id": unit_id, "concepts": concepts, "registry": records_of(S.compact(some)), "candidate_map": records_of(chosen["map"])}
        answer = coerced(self._ask("cross_unit_concept_resolution", payload, log))
        proposals = listed(answer.get("resolution_proposals"))
        row = (unit_id, *[json.dumps(x, ensure_ascii=False) for x in (concepts, proposals, [], [])])
        done = apply_by_unit(self.spark.createDataFrame([row], "unit_id string, concepts string, concept_proposals string, groups string, group_proposals string")).first()
        after, renamed, implied, rejected = (json.loads(done[c]) for c in ("concepts", "id_map", "implied", "unresolved"))
        after, same = equivalent(after)
        renamed = {k: same.get(v, v) for k, v in renamed.items()} | {k: v for k, v in same.items() if k not in renamed}
        unresolved = [*listed(answer.get("unresolved_items")), *rejected]
        refused = [(r["delta_id"], r["target_refs"]) for r in rejected]
        kinds = [p.get("proposal_type", "") for p in proposals if (p.get("delta_id", ""), listed(p.get("target_refs"))) not in refused]
        return {"concepts": after, "id_map": renamed, "implied": implied, "unresolved": unresolved, "log": log, "tallies": {k: kinds.count(k) for k in sorted(set(kinds))}}

    def group(self, unit_id: str, items: list[dict[str, Any]], implied: list[dict[str, Any]]) -> list[dict[str, Any]]:
        """Groups of the unit's items as a package has them: the graph of each has a node for each item that it names."""
        if not items:
            return []
        answer = coerced(self._ask("grouping", {"task": "grouping", "unit_id": unit_id, "items": [{"item_id": i["item_id"], "summary": i.get("summary", "")} for i in items], "implied": implied}))
        out = []
        for g in listed(answer.get("logical_groups")):
            refs = [r for r in listed(g.get("item_refs"))]
            edges = [e for e in listed(g.pop("edges", None))]
            concepts = list(dict.fromkeys(c for i in items if i["item_id"] in refs for c in i.get("concept_refs") or []))
            graph = {"nodes": [{"node_id": r, "item_ref": r} for r in refs], "edges": edges} if edges else {}
            out.append({"summary": "", "concept_refs": concepts} | g | ({"graph": graph} if graph else {}))
        return out

    def resolve_groups(self, unit_id: str, groups: list[dict[str, Any]], concepts: list[dict[str, Any]]) -> dict[str, Any]:
        """The unit's groups after proposals against the book's: ``groups, proposals, edges, log``."""
        book = self._table("groups", GROUP)
        if self.scope == "unit" or book.isEmpty() or not groups:
            return {"groups": groups, "proposals": [], "edges": [], "log": []}
        mine = self.spark.createDataFrame([(g["group_id"], g.get("group_type", "other"), g.get("summary", "")) for g in groups], "group_id string, group_type string, summary string")
        linked = self.spark.createDataFrame([(c["concept_id"], c.get("registry_ref") or "") for c in concepts], "concept_id string, registry_ref string")
        some = book.join(S.select_groups(mine, book, linked).select("group_id"), "group_id", "left_semi").orderBy("group_id")
        log: list[Any] = []
        answer = coerced(self._ask("cross_unit_group_resolution", {"task": "cross_unit_group_resolution", "unit_id": unit_id, "groups": groups, "registry_groups": records_of(S.group_index(some))}, log))
        proposals = listed(answer.get("group_resolution_proposals"))
        after, edges = apply_to_groups(groups, proposals)
        return {"groups": after, "proposals": proposals, "edges": edges, "log": log}

    def digest(self) -> str:
        rows = self.registry.load("digest")
        return "" if rows is None else rows.first()["digest"]

    def new_digest(self, unit_id: str) -> str:
        """What the book is about so far, from the first concepts of the registry; a failure leaves the old one."""
        book = self._table("concepts", CONCEPT)
        n = book.count()
        if not n:
            return ""
        first = book.orderBy("id").limit(DIGEST_CONCEPTS).select(F.coalesce(F.nullif("canonical_name", F.lit("")), "surface").alias("name"), F.col("concept_type").alias("type"), "summary", "aliases")
        payload = {"task": "digest", "unit_id": unit_id, "concepts": records_of(first), "n_omitted": max(0, n - DIGEST_CONCEPTS)}
        try:
            text = str(self._ask("digest", payload | ({"previous_digest": self.digest()} if self.digest() else {})).get("digest", ""))
        except Exception as e:  # noqa: BLE001 - a digest is a help, not a result
            self.progress(f"digest failed: {e}")
            return self.digest()
        if text:
            self.registry.save("digest", self.spark.createDataFrame([(text,)], "digest string"))
        return text

    # A unit

    def package(self, unit_id: str, text: str, tables: dict[str, DataFrame], index_id: str = "") -> dict[str, Any]:
        """A unit's package with all passes made and its issues mended; what is left of them is an error."""
        blocks = records_of(tables["blocks"].orderBy("block_index").withColumn("segment_id", F.lit("")).withColumn("source_index_id", F.lit(index_id)))
        concepts = records_of(tables["concepts"].orderBy("id").select(F.col("id").alias("concept_id"), "surface", "concept_type", "canonical_name", "summary", "aliases", "observed_surfaces", "source_block_refs", "merged_from"))
        items = records_of(tables["items"].orderBy("item_id").select("item_id", "item_type", "summary", "source_block_refs", "concept_refs"))
        resolved = self.resolve_concepts(unit_id, concepts)
        for i in items:
            i["concept_refs"] = list(dict.fromkeys(resolved["id_map"].get(r, r) for r in i.get("concept_refs") or []))
        self.progress(f"{unit_id}: {len(resolved['concepts'])} concepts, {resolved['tallies']}")
        grouped = self.resolve_groups(unit_id, self.group(unit_id, items, resolved["implied"]), resolved["concepts"])
        self.progress(f"{unit_id}: {len(grouped['groups'])} groups")
        data = {
            "schema_version": UNIT_SCHEMA, "unit_id": unit_id, "source": {"unit_text": text}, "source_blocks": blocks, "concepts": resolved["concepts"], "atomic_items": items, "logical_groups": grouped["groups"],
            "unresolved_items": resolved["unresolved"], "validation": {}, "context_metadata": {"source_index_id": index_id}, "cross_group_edges": grouped["edges"], "group_proposals": grouped["proposals"],
            "metrics": {"segment_merge": segment_counts(tables["concepts_before"], tables["concepts"], len(resolved["unresolved"])), "proposals": resolved["tallies"]},
        }
        ask = lambda d, issues: listed(self.backend.complete(prompt_of("repair_extraction"), json.loads(repair_message(issues))).get("repairs"))
        data, issues = repaired(data, unit_issues, ask, self.turns)
        errors = [i for i in issues if i["severity"] == "error"]
        if errors:
            raise ReadingError(unit_id, errors)
        return data | {"validation": summary(issues)}

    def bind(self, index_id: str, t: store.Transaction | None = None) -> None:
        """Holds the registry to one source index: the first unit's."""
        if t is None:
            return self.registry.transact(lambda own: self.bind(index_id, own))
        have = t.load("meta")
        before = "" if have is None else have.first()["source_index_id"]
        if R.bound_index(before, index_id) != before:
            t.replace("meta", self.spark.createDataFrame([(index_id,)], "source_index_id string"))

    def fold(self, data: dict[str, Any]) -> dict[str, int]:
        """Adds a package to the registry in one commit; gives its operations by type."""
        unit = data["unit_id"]
        rows = [(f"{unit}:{c['concept_id']}", c.get("surface", ""), c.get("concept_type", "other"), c.get("canonical_name") or "", c.get("summary", ""), c.get("aliases") or [], c.get("observed_surfaces") or [], c.get("source_block_refs") or [], (c.get("provenance") or {}).get("grounding", "source_grounded"), unit) for c in data["concepts"]]
        links = [(f"{unit}:{c['concept_id']}", c["registry_ref"]) for c in data["concepts"] if c.get("registry_ref")]
        make = self.spark.createDataFrame
        items = make([(i["item_id"], i.get("item_type", "other"), i.get("summary", ""), i.get("source_block_refs") or [], i.get("concept_refs") or [], unit) for i in data["atomic_items"]], ITEM)
        groups = make([(g["group_id"], g.get("group_type", "other"), g.get("summary", ""), g.get("concept_refs") or [], g.get("item_refs") or [], unit) for g in data["logical_groups"]], "group_id string, group_type string, summary string, concept_refs array<string>, item_refs array<string>, source_unit string")
        proposals = make([(p.get("unit_group_ref", ""), p.get("proposal_type", ""), p.get("registry_group_ref", "")) for p in data["group_proposals"]], "group_id string, proposal_type string, registry_group_ref string")

        def work(t: store.Transaction) -> tuple[DataFrame, DataFrame]:
            if index_id_of(data):
                self.bind(index_id_of(data), t)
            operations, mapping = fold_concepts(t, make(rows, CONCEPT), make(links, "unit_ref string, book_ref string"))
            local = mapping.withColumn("old_id", F.regexp_replace("old_id", "^[^:]*:", ""))
            return operations, fold_records(t, items, groups, proposals, local)

        operations, grouped = self.registry.transact(work)
        counts = {r["op_type"]: r["n"] for r in operations.groupBy("op_type").agg(F.count("*").alias("n")).union(grouped.groupBy("op_type").agg(F.count("*"))).collect()}
        return counts | {"add_item": len(data["atomic_items"])}

    def read(self, unit: DataFrame, unit_id: str, index_id: str = "") -> dict[str, Any]:
        """Reads a unit (a row of ``unit_id, text``), writes its package and tables, and folds it into the registry in the scope of a book."""
        began = time.monotonic()
        tables = read_units(unit, self.backend)
        text = unit.first()["text"]
        data = self.package(unit_id, text, tables, index_id)
        run = store.run_hash(unit=unit_id, model=self.backend.identity(), scope=self.scope, text=store.json_hash(text), prompts={t: prompt_of(t) for t in ("overview", "extraction", "grouping")})
        place = f"{self.folder}/units/{unit_id}/{run}"
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{place}/{name}")
        counts = self.fold(data) if self.scope == "book" else {}
        if self.scope == "book":
            self.new_digest(unit_id)
        manifest = {"run_hash": run, "unit_id": unit_id, "scope": self.scope, "model": self.backend.identity(), "validation": data["validation"], "operations": counts, "metrics": data["metrics"], "elapsed_ms": int(1000 * (time.monotonic() - began))}
        for name, value in (("package", data), ("manifest", manifest)):
            self.spark.createDataFrame([(json.dumps(value, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{place}/{name}")
        store.append_run(self.spark, f"{self.folder}/runs", run_hash=run, unit_id=unit_id, operations=counts)
        self.progress(f"{unit_id}: read as {run}")
        return {"unit_id": unit_id, "run_hash": run, "operations": counts}


#: Concepts that a digest is made from.
DIGEST_CONCEPTS = 50


def run_reading(spark: SparkSession, units: DataFrame, backend: Backend, folder: str, scope: str = "book", progress: Callable[[str], None] | None = None) -> dict[str, Any]:
    """Reads units one after another, in order: each is resolved against what those before it left in the registry."""
    reader = Reader(spark, backend, folder, scope, progress=progress)
    ids = [r["unit_id"] for r in units.select("unit_id").orderBy("unit_id").toLocalIterator()]
    done = [reader.read(units.where(F.col("unit_id") == i), i) for i in ids]
    return {"runs": done, "summary": json.dumps(done, sort_keys=True)}


def load_package(spark: SparkSession, folder: str, unit_id: str, run: str) -> dict[str, Any]:
    return json.loads(spark.read.text(f"{folder.rstrip('/')}/units/{unit_id}/{run}/package").first()["value"])


def view(spark: SparkSession, folder: str, unit_id: str, run: str) -> str:
    """A page of a unit that was read: its source marked up, its concepts and items as data, and its issues."""
    data = load_package(spark, folder, unit_id, run)
    rows = spark.createDataFrame([(unit_id, b["block_id"], b["start"], b["end"], b["text"]) for b in data["source_blocks"]], "book_id string, block_id string, start long, end long, text string")
    concepts = spark.createDataFrame([(c["concept_id"], c.get("surface", ""), c.get("observed_surfaces") or [], c.get("source_block_refs") or []) for c in data["concepts"]], "concept_id string, surface string, observed_surfaces array<string>, source_block_refs array<string>")
    source = spark.createDataFrame([(unit_id, data["source"]["unit_text"])], "book_id string, text string")
    first = W.source_pages(rows, concepts, source).first()
    return W.page(unit_id, first["markup"] if first else "", {"concepts": data["concepts"], "items": data["atomic_items"], "groups": data["logical_groups"]}, [{"unit_id": unit_id, "line": unit_id}], unit_issues(data))
