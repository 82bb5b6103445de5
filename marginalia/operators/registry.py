"""A registry of concepts, items and groups that units are folded into by typed deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .entities import compose, merge, remap  # noqa: F401 - part of this module's surface
from .proposals import DISTINCT_TYPES
from .skew import running

#: Prefix of the registry's own concept ids, so that they never meet a unit's.
PREFIX = "rc-"


def collisions(units: DataFrame, registry: DataFrame) -> DataFrame:
    """``unit_ref, book_ref, reason`` of registry concepts that a unit's concept may be.

    Both sides: ``id, surface, concept_type, canonical_name``. Two equi-joins, one on surface and type and one on the canonical name, meet by
    pair: both make an exact match, one of them a surface or a name match.
    """
    r = registry.select(F.col("id").alias("book_ref"), "surface", "concept_type", "canonical_name")
    u = units.select(F.col("id").alias("unit_ref"), "surface", "concept_type", "canonical_name")
    by_surface = u.join(r.drop("canonical_name"), ["surface", "concept_type"]).select("unit_ref", "book_ref", F.lit(1).alias("s"), F.lit(0).alias("n"))
    by_name = u.where("canonical_name <> ''").join(r.drop("surface", "concept_type"), "canonical_name").select("unit_ref", "book_ref", F.lit(0).alias("s"), F.lit(1).alias("n"))
    g = by_surface.unionByName(by_name).groupBy("unit_ref", "book_ref").agg(F.max("s").alias("s"), F.max("n").alias("n"))
    reason = F.when(F.col("s") + F.col("n") == 2, "exact_match").when(F.col("s") == 1, "surface_match").otherwise("cname_match")
    return g.select("unit_ref", "book_ref", reason.alias("reason"))


def concept_operations(units: DataFrame, found: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``unit_ref, op_type, book_ref, match_reason`` for each concept: a link proposal (``unit_ref, book_ref``) comes first, then the smallest exact
    match, then an ambiguity for each other collision, else a new concept."""
    exact = found.where("reason = 'exact_match'").groupBy("unit_ref").agg(F.min("book_ref").alias("exact_ref"))
    other = found.where("reason <> 'exact_match'").select("unit_ref", F.col("book_ref").alias("other_ref"), "reason")
    u = units.select(F.col("id").alias("unit_ref"))
    link = links.groupBy("unit_ref").agg(F.min("book_ref").alias("link_ref")) if links is not None else u.select("unit_ref", F.lit(None).cast("string").alias("link_ref")).limit(0)
    settled = u.join(link, "unit_ref", "left").join(exact, "unit_ref", "left")
    merges = settled.where("link_ref IS NOT NULL OR exact_ref IS NOT NULL").select(
        "unit_ref", F.lit("merge_concepts").alias("op_type"), F.coalesce("link_ref", "exact_ref").alias("book_ref"), F.when(F.col("link_ref").isNotNull(), "llm_link_proposal").otherwise("exact_match").alias("match_reason")
    )
    rest = settled.where("link_ref IS NULL AND exact_ref IS NULL").select("unit_ref").join(other, "unit_ref", "left")
    rest = rest.select("unit_ref", F.when(F.col("other_ref").isNull(), "add_concept").otherwise("ambiguity").alias("op_type"), F.col("other_ref").alias("book_ref"), F.coalesce("reason", F.lit("new")).alias("match_reason"))
    return merges.unionByName(rest)


def operation_stats(operations: DataFrame) -> DataFrame:
    return operations.groupBy("op_type", "match_reason").agg(F.count("*").alias("n_ops"), F.countDistinct("unit_ref").alias("n_concepts"))


def numbered(rows: DataFrame, order: str, out: str, first: int = 1) -> DataFrame:
    """``out``: the place of each row by ``order``, from ``first``."""
    return running(rows, None, [order], number=out, before="__before").withColumn(out, F.col(out) + (first - 1)).drop("__before")


def id_map(units: DataFrame, operations: DataFrame, next_id: int) -> DataFrame:
    """``old_id, new_id`` of a unit's concepts once the operations are applied.

    Merged ones take the book's id. The others, ambiguous ones included, are new: equal surface, type and name make one, whose number follows
    ``next_id`` in order of the smallest id.
    """
    merged = operations.where("op_type = 'merge_concepts'").select(F.col("unit_ref").alias("old_id"), F.col("book_ref").alias("new_id"))
    new = units.join(merged.select(F.col("old_id").alias("id")), "id", "left_anti")
    firsts = new.groupBy("surface", "concept_type", "canonical_name").agg(F.min("id").alias("first_id"))
    same = F.col("surface").eqNullSafe(F.col("s")) & F.col("concept_type").eqNullSafe(F.col("t")) & F.col("canonical_name").eqNullSafe(F.col("c"))
    first = new.select("id", "surface", "concept_type", "canonical_name").join(firsts.toDF("s", "t", "c", "first_id"), same).select("id", "first_id")
    ids = numbered(first.select("first_id").distinct(), "first_id", "n", next_id).select("first_id", F.format_string(f"{PREFIX}%06d", F.col("n")).alias("new_id"))
    return merged.unionByName(first.join(ids, "first_id").select(F.col("id").alias("old_id"), "new_id"))


def merge_bounds(members: DataFrame, key: str = "new_id") -> DataFrame:
    """``key, reason`` of merges of concepts (``id, surface, concept_type, canonical_name, aliases, observed_surfaces``) that are not safe.

    Safe are one type with a canonical name on any side; one canonical name that all have; one surface; one type and a surface or alias
    that two members share.
    """
    name = F.nullif("canonical_name", F.lit(""))
    rows = members.withColumn("concept_type", T.concept_type(F.col("concept_type")))
    none = F.array().cast("array<string>")
    forms = F.array_distinct(F.concat(F.array("surface"), F.coalesce("aliases", none), F.coalesce("observed_surfaces", none)))
    shared = rows.select(key, "id", F.explode(forms).alias("form")).distinct().groupBy(key, "form").agg(F.count("*").alias("n")).groupBy(key).agg((F.max("n") > 1).alias("overlap"))
    g = rows.groupBy(key).agg(
        F.count("*").alias("n"), F.countDistinct("concept_type").alias("types"), F.countDistinct(name).alias("names"), F.count(name).alias("named"), F.countDistinct("surface").alias("surfaces"),
        *[F.max(F.col("concept_type") == k).alias(k) for k in DISTINCT_TYPES],
    )
    g = g.join(shared, key)
    one, named = F.col("types") == 1, F.col("named")
    safe = (F.col("n") < 2) | (one & (named > 0)) | ((F.col("names") == 1) & (named == F.col("n"))) | (F.col("surfaces") == 1) | (one & F.col("overlap"))
    reason = F.when(F.lit(False), "")
    for kind in DISTINCT_TYPES:
        reason = reason.when(F.col(kind), f"{kind} concepts with different surfaces")
    reason = reason.when(F.col("types") > 1, "types differ and no name is shared").otherwise("different surfaces and nothing shared")
    return g.where(~safe).select(key, reason.alias("reason"))


def checked(operations: DataFrame, units: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Operations whose merges are safe, the others as ``merge_rejected``, which makes the unit's concept a new one; and an unresolved row
    (``unit_ref, book_ref, kind, reason``) for each of these. Each merge is judged by itself: the book's concept and the unit's."""
    columns = ["surface", "concept_type", "canonical_name", "aliases", "observed_surfaces"]
    merges = operations.where("op_type = 'merge_concepts'").select("unit_ref", "book_ref")
    one = merges.join(units.select(F.col("id").alias("unit_ref"), *columns), "unit_ref").withColumn("id", F.col("unit_ref"))
    two = merges.join(registry.select(F.col("id").alias("book_ref"), *columns), "book_ref").withColumn("id", F.col("book_ref"))
    bad = merge_bounds(one.unionByName(two), "unit_ref")
    unresolved = merges.join(bad, "unit_ref").select("unit_ref", "book_ref", F.lit("merge_rejected").alias("kind"), "reason")
    marked = operations.join(bad.withColumnRenamed("reason", "why"), "unit_ref", "left")
    return marked.withColumn("op_type", F.when(F.col("why").isNotNull() & (F.col("op_type") == "merge_concepts"), "merge_rejected").otherwise(F.col("op_type"))).drop("why"), unresolved


def apply_concepts(registry: DataFrame, units: DataFrame, mapping: DataFrame) -> DataFrame:
    """The registry after a unit: its concepts and the unit's under their new ids, those with one id merged, the book's first.

    Both sides have ``id, surface, concept_type, canonical_name, summary, aliases, observed_surfaces, source_block_refs, grounding, source_unit``.
    """
    columns = ["surface", "concept_type", "canonical_name", "summary", "aliases", "observed_surfaces", "source_block_refs", "grounding", "source_unit"]
    old = registry.select(F.struct(F.lit(0).alias("side"), F.col("id").alias("x")).alias("pos"), F.col("id").alias("new_id"), F.col("id").alias("concept_id"), *columns)
    new = units.join(mapping.withColumnRenamed("old_id", "id"), "id").select(F.struct(F.lit(1).alias("side"), F.col("id").alias("x")).alias("pos"), "new_id", F.col("id").alias("concept_id"), *columns)
    merged = merge(old.unionByName(new), "new_id", scope="source_unit").withColumnRenamed("new_id", "id")
    return merged.withColumn("surface", F.when(F.col("n_members") == 1, F.col("first_surface")).otherwise(F.col("surface")))


def group_operations(groups: DataFrame, proposals: DataFrame) -> DataFrame:
    """``group_id, op_type, registry_group_ref``: continue before mutate before add. ``proposals``: ``group_id, proposal_type, registry_group_ref``."""
    rank = F.when(F.col("proposal_type") == "continue", 1).when(F.col("proposal_type") == "mutate", 2)
    best = proposals.where(rank.isNotNull()).groupBy("group_id").agg(F.min(F.struct(rank.alias("r"), "registry_group_ref", "proposal_type")).alias("p"))
    joined = groups.select("group_id").join(best, "group_id", "left")
    return joined.select("group_id", F.coalesce(F.concat(F.col("p.proposal_type"), F.lit("_group")), F.lit("add_group")).alias("op_type"), F.col("p.registry_group_ref").alias("registry_group_ref"))


def item_operations(items: DataFrame) -> DataFrame:
    """Items are always new: ``ref, op_type``."""
    return items.select(F.col("item_id").alias("ref"), F.lit("add_item").alias("op_type"))


def unit_operations(concepts: DataFrame, items: DataFrame, groups: DataFrame) -> DataFrame:
    """``ref, op_type, book_ref`` of all operations of a unit from those of its concepts (``unit_ref``), items and groups."""
    none = F.lit(None).cast("string").alias("book_ref")
    c = concepts.select(F.col("unit_ref").alias("ref"), "op_type", F.col("book_ref").cast("string").alias("book_ref"))
    g = groups.select(F.col("group_id").alias("ref"), "op_type", F.col("registry_group_ref").alias("book_ref"))
    return c.unionByName(item_operations(items).select("ref", "op_type", none)).unionByName(g)


def unresolved_rows(unit_unresolved: DataFrame, ambiguities: DataFrame, rejected: DataFrame) -> DataFrame:
    """``unit_id, kind, ref, detail`` of what a unit leaves open: its own unresolved items (``unit_id, item_id, summary``), ambiguous identities
    (``unit_id, unit_ref, book_ref, match_reason``) and rejected merges (``unit_id, unit_ref, book_ref, reason``)."""
    own = unit_unresolved.select("unit_id", F.lit("unit_unresolved").alias("kind"), F.col("item_id").alias("ref"), F.col("summary").alias("detail"))
    two = ambiguities.select("unit_id", F.lit("identity_ambiguity").alias("kind"), F.col("unit_ref").alias("ref"), F.concat_ws(":", "book_ref", "match_reason").alias("detail"))
    three = rejected.select("unit_id", F.lit("merge_rejected").alias("kind"), F.col("unit_ref").alias("ref"), F.concat_ws(":", "book_ref", "reason").alias("detail"))
    return own.unionByName(two).unionByName(three)


def remapped_list(rows: DataFrame, ident: str, refs: str, mapping: DataFrame) -> DataFrame:
    """``rows`` with each reference of the list ``refs`` replaced by its new id (``mapping``: ``old_id, new_id``), once each, in order."""
    each = rows.select(ident, F.posexplode(refs).alias("__p", "old_id")).join(mapping.select("old_id", "new_id"), "old_id", "left")
    new = each.groupBy(ident).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("__p", F.coalesce("new_id", "old_id").alias("r")))), lambda x: x["r"])).alias("__refs"))
    none = F.array().cast("array<string>")
    return rows.join(new, ident, "left").withColumn(refs, F.coalesce("__refs", none)).drop("__refs")


def add_items(items: DataFrame, concepts: DataFrame, next_id: int) -> tuple[DataFrame, DataFrame]:
    """A unit's items (``item_id, concept_refs, …``) under the registry's ids with the registry's concepts, and the map of their ids."""
    ids = numbered(items.select("item_id").distinct(), "item_id", "n", next_id).select(F.col("item_id").alias("old_id"), F.format_string("item-%04d", F.col("n")).alias("new_id"))
    named = remapped_list(items, "item_id", "concept_refs", concepts).join(ids.withColumnRenamed("old_id", "item_id"), "item_id")
    return named.withColumn("item_id", F.col("new_id")).drop("new_id"), ids


def add_groups(groups: DataFrame, operations: DataFrame, concepts: DataFrame, items: DataFrame, next_id: int) -> DataFrame:
    """A unit's groups (``group_id, concept_refs, item_refs, …``) as new ones of the registry, with its concepts and items; ``continuation`` and
    ``registry_group_ref`` say which group each continues or changes."""
    ids = numbered(groups.select("group_id").distinct(), "group_id", "n", next_id).select("group_id", F.format_string("group-%04d", F.col("n")).alias("new_id"))
    rows = remapped_list(remapped_list(groups, "group_id", "concept_refs", concepts), "group_id", "item_refs", items)
    rows = rows.join(operations.select("group_id", F.regexp_replace("op_type", "_group$", "").alias("continuation"), "registry_group_ref"), "group_id").join(ids, "group_id")
    return rows.withColumn("group_id", F.col("new_id")).drop("new_id")


def remap_nodes(nodes: DataFrame, items: DataFrame, groups: DataFrame) -> DataFrame:
    """Nodes of groups' graphs (``group_id, node_id, item_ref``) with the registry's items and groups."""
    return remap(remap(nodes, items, "item_ref"), groups, "group_id")


def top_number(rows: DataFrame, ident: str) -> int:
    """The largest number that an id of ``rows`` ends with; 0 if there is none."""
    return rows.agg(F.max(F.regexp_extract(ident, r"(\d+)$", 1).cast("int"))).first()[0] or 0


def bound_index(registry_index: str, unit_index: str) -> str:
    """The source index that a registry stands on: set by its first unit, the same for all later ones."""
    if not unit_index:
        raise ValueError("a unit must name its source index")
    if registry_index and registry_index != unit_index:
        raise ValueError(f"the registry stands on {registry_index}, the unit on {unit_index}")
    return unit_index


def type_histogram(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """``group_type, n_groups, n_with_graph, n_edges`` of groups (``group_id, group_type``) and their edges (``group_id``)."""
    n = edges.groupBy("group_id").agg(F.count("*").alias("n"))
    return groups.join(n, "group_id", "left").groupBy("group_type").agg(F.count("*").alias("n_groups"), F.count("n").alias("n_with_graph"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_edges"))


#: Items that happen, and what says when.
EVENT_TYPES, TIME_KINDS, TIMELINES = ("event", "action", "scene"), ("explicit", "implicit", "relative"), ("timeline", "temporal_sequence")


def grouping_counts(groups: DataFrame, items: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of counts: ``logical_groups, singleton_groups, timeline_groups, groups_with_graph, graph_edges, items_grouped, items_ungrouped,
    event_items_with_time``. ``groups``: ``group_id, group_type, item_refs``; ``items``: ``item_id, item_type, time_kinds``; ``edges``: ``group_id``."""
    is_in = lambda c, some: F.coalesce(F.col(c).isin(*some), F.lit(False))
    g = groups.agg(F.count("*").alias("logical_groups"), F.count_if(F.size("item_refs") == 1).alias("singleton_groups"), F.count_if(is_in("group_type", TIMELINES)).alias("timeline_groups"))
    e = edges.agg(F.countDistinct("group_id").alias("groups_with_graph"), F.count("*").alias("graph_edges"))
    refs = groups.select(F.explode("item_refs").alias("item_id")).distinct()
    i = items.join(refs.withColumn("grouped", F.lit(1)), "item_id", "left")
    timed = is_in("item_type", EVENT_TYPES) & F.coalesce(F.arrays_overlap("time_kinds", F.array(*[F.lit(k) for k in TIME_KINDS])), F.lit(False))
    i = i.agg(F.countDistinct(F.when(F.col("grouped").isNull(), F.col("item_id"))).alias("items_ungrouped"), F.count_if(timed).alias("event_items_with_time"))
    r = refs.agg(F.count("*").alias("items_grouped"))
    return g.crossJoin(e).crossJoin(r).crossJoin(i)  # a row each


def overlapping_groups(unit_concepts: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups (``group_id, group_type, concept_ref``) that hold a concept of the unit (``concept_ref``)."""
    return groups.join(unit_concepts.select("concept_ref").distinct(), "concept_ref", "left_semi").select("group_id", "group_type").distinct()


def group_candidates(unit_concepts: DataFrame, unit_types: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups that share a concept; if there are none at all, those that share a type (``group_type``)."""
    by_concept = overlapping_groups(unit_concepts, groups)
    if not by_concept.isEmpty():
        return by_concept.withColumn("reason", F.lit("concept"))
    return groups.join(unit_types, "group_type", "left_semi").select("group_id", "group_type").distinct().withColumn("reason", F.lit("type"))
