"""Candidates of a registry for a unit's concepts and groups: searchable texts, both signals, gates, the candidate map, and searches."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import retrieval as R

#: A registry of so many rows or fewer is passed on whole.
SMALL = 50
#: Rows that a signal gives a query, and the least cosine.
TOP, LEAST = 20, 0.3
#: Most rows that a search gives.
MOST_FOUND = 50
#: From this share of the registry on a selection is not selective.
WIDE = 0.8

Embed = Callable[[DataFrame], DataFrame]


def _words(head: Column, tail: Column) -> Column:
    """The non-empty texts of ``head``, then the distinct ones of ``tail`` that it lacks, with blanks between."""
    some = F.filter(head, lambda x: x.isNotNull() & (x != ""))
    return F.array_join(F.concat(some, F.array_except(F.filter(tail, lambda x: x.isNotNull() & (x != "")), some)), " ")


def _five(c: str) -> Column:
    return F.slice(F.coalesce(F.col(c), F.array().cast("array<string>")), 1, 5)


def concept_text() -> Column:
    """What a registry concept is found by: name, summary, the first five surfaces and aliases."""
    return _words(F.array("canonical_name", "summary"), F.concat(_five("observed_surfaces"), _five("aliases")))


def unit_concept_text() -> Column:
    """What a unit's concept asks for: surface, another name, summary, the first five aliases."""
    name = F.when(~F.col("canonical_name").eqNullSafe(F.col("surface")), F.col("canonical_name"))
    return _words(F.array(F.col("surface"), name, F.col("summary")), _five("aliases"))


def group_text() -> Column:
    return F.array_join(F.filter(F.array("summary", "group_type"), lambda x: x.isNotNull() & (x != "")), " ")


def cut(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - 3)), F.lit("..."))).otherwise(F.coalesce(text, F.lit("")))


def group_index(groups: DataFrame) -> DataFrame:
    """``group_id, group_type, summary, key_concept_ids, item_count`` of groups: a short summary, the first five concepts."""
    none = F.array().cast("array<string>")
    return groups.select("group_id", F.coalesce("group_type", F.lit("other")).alias("group_type"), cut(F.col("summary"), 120).alias("summary"), F.slice(F.array_distinct(F.coalesce("concept_refs", none)), 1, 5).alias("key_concept_ids"), F.size(F.coalesce("item_refs", none)).cast("long").alias("item_count"))


def compact(concepts: DataFrame) -> DataFrame:
    """Concepts as search results show them: 200 characters of summary, ten surfaces."""
    return concepts.select("concept_id", F.coalesce("canonical_name", F.lit("")).alias("canonical_name"), F.coalesce("concept_type", F.lit("other")).alias("concept_type"), cut(F.col("summary"), 200).alias("summary"), F.slice("observed_surfaces", 1, 10).alias("observed_surfaces"))


def by_id(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.where(F.col(key) == value)


def by_surface(concepts: DataFrame, surfaces: DataFrame) -> DataFrame:
    """``name, concept_id``: for each ``name`` of ``surfaces`` the concepts that have it as surface, alias or observed surface."""
    names = F.array_union(F.array("surface"), F.array_union(F.coalesce("aliases", F.array().cast("array<string>")), F.coalesce("observed_surfaces", F.array().cast("array<string>"))))
    return concepts.select("concept_id", F.explode(names).alias("name")).join(surfaces.select("name").distinct(), "name").distinct()


def by_name(concepts: DataFrame, names: DataFrame) -> DataFrame:
    return concepts.where("canonical_name <> ''").select("concept_id", F.col("canonical_name").alias("name")).join(names.select("name").distinct(), "name")


def dual_signal(texts: DataFrame, queries: DataFrame, near: DataFrame | None = None, top: int = TOP, types: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``query_id, doc_id, rrf, rank, methods, score`` of the ``top`` rows that BM25 and cosine together give each query.

    ``texts``: ``doc_id, text``; ``queries``: ``query_id, query``; ``near``: ``query_id, doc_id, score`` by cosine, absent where there is no
    model: then BM25 alone decides. ``types`` (``query_id, ut`` and ``doc_id, rt``) drop pairs of different type families: from BM25's best after
    they are found, from the cosine's before. The types are put beside the rows that the signals found, so no other pairs are made.
    """

    def related(rows: DataFrame) -> DataFrame:
        return rows.join(types[0], "query_id").join(types[1], "doc_id").where(R.same_family(F.col("ut"), F.col("rt"))).select(*rows.columns)

    words = R.top_k(R.bm25(texts, queries, best=top), top).where("score > 0").select("query_id", "doc_id", "rank", "score", F.lit("bm25").alias("method"))
    if types is not None:
        words = related(words)
        words = words.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank")))
    both = words
    if near is not None:
        some = near.where(F.col("score") > LEAST)
        if types is not None:
            some = related(some)
        both = words.unionByName(R.top_k(some, top).select("query_id", "doc_id", "rank", "score", F.lit("embedding").alias("method")))
    fused = both.groupBy("query_id", "doc_id").agg(F.sum(1.0 / (R.RRF + F.col("rank"))).alias("rrf"), F.array_join(F.sort_array(F.collect_set("method")), "+").alias("methods"), F.max("score").alias("score"))
    return R.top_k(fused, top, score="rrf")


def candidate_map(units: DataFrame, matched: DataFrame, semantic: DataFrame, passed: DataFrame | None = None) -> DataFrame:
    """``unit_concept_id, deterministic_candidate_ids, semantic_candidate_ids, candidate_ids`` of each unit concept: those found by name, by
    signal, and all of a registry that is passed on whole (``doc_id``), each id once, in that order."""
    names = matched.groupBy(F.col("unit_ref").alias("concept_id")).agg(F.sort_array(F.collect_set("book_ref")).alias("d"))
    some = semantic.groupBy(F.col("query_id").alias("concept_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"]).alias("s"))
    rows = units.select("concept_id").join(names, "concept_id", "left").join(some, "concept_id", "left")
    none = F.array().cast(matched.select(F.array("book_ref").alias("x")).schema["x"].dataType)
    d, s = F.coalesce("d", none), F.coalesce("s", none)
    every = F.concat(d, s)
    if passed is not None:  # at most SMALL rows
        rows = rows.crossJoin(F.broadcast(passed.agg(F.sort_array(F.collect_set("doc_id")).alias("p"))))
        every = F.concat(every, F.col("p"))
    return rows.select(F.col("concept_id").alias("unit_concept_id"), d.alias("deterministic_candidate_ids"), s.alias("semantic_candidate_ids"), F.array_distinct(every).alias("candidate_ids"))


def select_concepts(units: DataFrame, registry: DataFrame, embed: Embed | None = None, small: int = SMALL) -> dict[str, Any]:
    """``candidates`` (``concept_id``), ``map`` (see ``candidate_map``), ``passed`` and ``wide`` for a unit's concepts against a registry.

    Both sides: ``concept_id, concept_type, surface, canonical_name, summary, aliases, observed_surfaces``. A registry of ``small`` rows
    or fewer is passed on whole. Else concepts that share a name are candidates, and the concepts without such take those of both signals
    in their type family. ``embed`` gives ``query_id, doc_id, score`` for unit concepts; without it BM25 decides.
    """
    n = registry.count()
    sides = [x.select(F.col("concept_id").alias("id"), "concept_type", "surface", "canonical_name", "aliases", F.col("observed_surfaces").alias("observed")) for x in (units, registry)]
    no_pairs = R.name_candidates(*[x.limit(0) for x in sides])
    no_rows = units.select(F.col("concept_id").alias("query_id"), F.lit(0).alias("rank"), F.col("concept_id").alias("doc_id")).limit(0)
    if n <= small:
        ids = registry.select(F.col("concept_id").alias("doc_id"))
        return {"candidates": registry.select("concept_id"), "map": candidate_map(units, no_pairs, no_rows, ids), "passed": True, "wide": False}
    matched = R.name_candidates(*sides)
    rest = units.join(matched.select(F.col("unit_ref").alias("concept_id")), "concept_id", "left_anti")
    asked = rest.select(F.col("concept_id").alias("query_id"), unit_concept_text().alias("query"))
    near = embed(rest) if embed else None
    types = rest.select(F.col("concept_id").alias("query_id"), F.col("concept_type").alias("ut")), registry.select(F.col("concept_id").alias("doc_id"), F.col("concept_type").alias("rt"))
    found = dual_signal(registry.select(F.col("concept_id").alias("doc_id"), concept_text().alias("text")), asked, near, types=types)
    has = found.withColumn("query_id", F.col("query_id")).withColumn("has_embedding", F.col("methods").contains("embedding"))
    capped = R.capped_candidates(has).select("query_id", "rank", "doc_id", "rrf", "methods")
    ids = matched.select(F.col("book_ref").alias("concept_id")).union(found.select("doc_id")).distinct()
    chosen = registry.select("concept_id").join(ids, "concept_id", "left_semi")
    return {"candidates": chosen, "map": candidate_map(units, matched, capped), "passed": False, "wide": chosen.count() >= int(n * WIDE)}


def select_groups(unit_groups: DataFrame, groups: DataFrame, concepts: DataFrame, embed: Embed | None = None, small: int = SMALL) -> DataFrame:
    """``group_id, reason`` of the registry groups that a unit's groups may continue.

    ``groups``: ``group_id, group_type, summary, concept_refs, item_refs``; ``unit_groups``: ``group_id, group_type, summary``; ``concepts``: the unit's,
    with the ``registry_ref`` that they are linked to. A small registry is passed on whole; else groups that hold a linked concept and
    those of both signals; if there are none at all, those of the unit's types.
    """
    if groups.limit(small + 1).count() <= small:
        return groups.select("group_id", F.lit("all").alias("reason"))
    linked = concepts.where("registry_ref <> ''").select(F.col("registry_ref").alias("c")).distinct()
    overlap = groups.select("group_id", F.explode("concept_refs").alias("c")).join(linked, "c", "left_semi").select("group_id").distinct()
    texts = group_index(groups).select(F.col("group_id").alias("doc_id"), group_text().alias("text"))
    found = dual_signal(texts, unit_groups.select(F.col("group_id").alias("query_id"), group_text().alias("query")), embed(unit_groups) if embed else None)
    both = overlap.withColumn("reason", F.lit("concept")).unionByName(found.select(F.col("doc_id").alias("group_id"), F.lit("signal").alias("reason")))
    both = both.groupBy("group_id").agg(F.min("reason").alias("reason"))
    if not both.isEmpty():
        return both
    types = unit_groups.select("group_type").distinct()
    return groups.join(types, "group_type", "left_semi").select("group_id", F.lit("type").alias("reason"))


def search(texts: DataFrame, query: str, top: int = 10, near: DataFrame | None = None) -> DataFrame:
    """``doc_id, score, method`` of the best rows for one query, at most ``MOST_FOUND``: by cosine (``near``: ``doc_id, score``) where there is
    one and it finds any, else by BM25."""
    top = min(top, MOST_FOUND)
    asked = texts.sparkSession.createDataFrame([(0, query)], "query_id int, query string")
    if near is not None:
        best = R.top_k(near.where(F.col("score") > LEAST).withColumn("query_id", F.lit(0)), top)
        if not best.isEmpty():
            return best.select("doc_id", "rank", F.round("score", 6).alias("score"), F.lit("embedding").alias("method"))
    best = R.top_k(R.bm25(texts, asked), top).where("score > 0")
    return best.select("doc_id", "rank", F.round("score", 6).alias("score"), F.lit("bm25").alias("method"))
