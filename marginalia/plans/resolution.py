"""Queries of proposals, registry deltas, candidates, packages and views. Parts, orders, events and documents stand for a book's records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import entities as E
from ..operators import packages as K
from ..operators import proposals as P
from ..operators import registry as R
from ..operators import search as S
from ..operators import validate as C
from ..operators import views as W
from . import entities, retrieval, texts
from .registry import Catalog, Tables

catalog = Catalog()

# Merges


def _merges(t: Tables) -> DataFrame:
    """Proposed merges of parts by brand and size: a type for each, names for some, a proposed name for half of the merges."""
    first = F.min("p_name").over(Window.partitionBy("p_brand", "p_size"))
    return t.part.select(
        F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("merge_id"), F.col("p_partkey").alias("id"), F.col("p_name").alias("surface"), F.when(F.col("p_partkey") % 5 == 0, F.col("p_type")).otherwise("").alias("canonical_name"),
        F.when(F.col("p_type") == "SMALL", "place").otherwise(F.col("p_type")).alias("concept_type"), F.when(F.col("p_size") % 4 == 0, first).when(F.col("p_size") % 4 == 1, F.lit("a new name")).otherwise("").alias("proposed"),
        F.array("p_brand").alias("aliases"), F.array(F.when(F.col("p_partkey") % 3 == 0, F.lit("shared")).otherwise(F.col("p_name"))).alias("observed_surfaces"),
    )


_MERGES = """m AS (SELECT p_brand || '/' || p_size AS merge_id, p_partkey AS id, p_name AS surface, CASE WHEN p_partkey % 5 = 0 THEN p_type ELSE '' END AS cname, CASE WHEN p_type = 'SMALL' THEN 'place' ELSE p_type END AS ty,
 CASE WHEN p_size % 4 = 0 THEN min(p_name) OVER (PARTITION BY p_brand, p_size) WHEN p_size % 4 = 1 THEN 'a new name' ELSE '' END AS proposed, p_brand AS al, CASE WHEN p_partkey % 3 = 0 THEN 'shared' ELSE p_name END AS ob FROM part)"""


@catalog.query(f"""WITH {_MERGES}, g AS (SELECT merge_id, count(*) AS n_members, count(DISTINCT nullif(cname, '')) AS names, count(DISTINCT surface) AS surfaces, bool_or(proposed <> '' AND (proposed = surface OR proposed = cname)) AS attested, bool_or(proposed <> '') AS proposes, bool_or(ty = 'place') AS place FROM m GROUP BY merge_id)
SELECT merge_id, n_members, CASE WHEN n_members < 2 OR names = 1 OR surfaces = 1 OR attested THEN 'safe' WHEN place THEN 'place concepts with different surfaces' WHEN proposes THEN 'no target has the proposed name' WHEN surfaces > 1 THEN 'different surfaces and nothing shared' ELSE 'safe' END AS verdict FROM g""")
def merge_safety(t: Tables) -> DataFrame:
    return P.merge_verdicts(_merges(t), "merge_id")


_TYPE = entities._TYPES.format(c="ty")


@catalog.query(f"""WITH {_MERGES}, k AS (SELECT merge_id, id, surface, cname, {_TYPE} AS ty, list_distinct([surface, al, ob]) AS forms FROM m),
o AS (SELECT merge_id, max(n) > 1 AS overlap FROM (SELECT merge_id, form, count(*) AS n FROM (SELECT merge_id, id, unnest(forms) AS form FROM k) GROUP BY ALL) GROUP BY merge_id),
g AS (SELECT merge_id, count(*) AS n, count(DISTINCT ty) AS types, count(DISTINCT nullif(cname, '')) AS names, count(nullif(cname, '')) AS named, count(DISTINCT surface) AS surfaces, bool_or(ty = 'place') AS place FROM k GROUP BY merge_id)
SELECT merge_id, CASE WHEN place THEN 'place concepts with different surfaces' WHEN types > 1 THEN 'types differ and no name is shared' ELSE 'different surfaces and nothing shared' END AS reason
FROM g JOIN o USING (merge_id) WHERE NOT (n < 2 OR (types = 1 AND named > 0) OR (names = 1 AND named = n) OR surfaces = 1 OR (types = 1 AND overlap))""")
def merge_boundary(t: Tables) -> DataFrame:
    """Merges that the registry itself refuses."""
    return R.merge_bounds(_merges(t), "merge_id")


@catalog.query(f"""WITH {_MERGES}, c AS (SELECT id, surface, cname, ob, merge_id, proposed FROM m), t AS (SELECT merge_id AS proposal_id, id AS pos, * EXCLUDE (merge_id) FROM c),
u AS (SELECT proposal_id, string_agg(ob, ',' ORDER BY p) AS observed_surfaces FROM (SELECT proposal_id, ob, min(pos) AS p FROM t GROUP BY ALL) GROUP BY proposal_id)
SELECT proposal_id, min(pos) AS concept_id, arg_min(surface, pos) AS surface, coalesce(max(nullif(proposed, '')), arg_min(cname, pos)) AS canonical_name, observed_surfaces, count(*) AS n_merged FROM t JOIN u USING (proposal_id) GROUP BY proposal_id, observed_surfaces""")
def merge_proposals_applied(t: Tables) -> DataFrame:
    m = _merges(t).withColumnRenamed("id", "concept_id")
    done = P.merged_by_proposal(m.select("concept_id", "surface", "canonical_name", "observed_surfaces"), m.select(F.col("merge_id").alias("proposal_id"), F.col("concept_id").alias("pos"), "concept_id", F.col("proposed").alias("name")))
    return done.select("proposal_id", "concept_id", "surface", "canonical_name", F.array_join("observed_surfaces", ",").alias("observed_surfaces"), F.size("merged_from").cast("long").alias("n_merged"))


@catalog.query("""WITH p AS (SELECT p_brand AS unit_id, p_partkey AS id, p_type AS ty, p_size AS size, p_size % 5 AS z FROM part),
a AS (SELECT unit_id, count(*) AS n0, min(id) AS s0 FROM p WHERE z = 0 GROUP BY unit_id),
b AS (SELECT p.*, coalesce(n0, 0) AS n0, s0 FROM p LEFT JOIN a USING (unit_id) WHERE NOT (z = 0 AND n0 >= 2 AND id <> s0)),
c AS (SELECT unit_id, count(*) AS n2, min(id) AS s2 FROM b WHERE z < 2 GROUP BY unit_id),
d AS (SELECT unit_id, count(*) AS n FROM p WHERE z < 2 GROUP BY unit_id),
e AS (SELECT b.*, coalesce(n2, 0) AS n2, s2, n FROM b LEFT JOIN c USING (unit_id) LEFT JOIN d USING (unit_id) WHERE NOT (z < 2 AND n2 >= 2 AND id <> s2))
SELECT unit_id, id::VARCHAR AS concept_id, CASE WHEN id % 2 = 0 THEN 'theme' ELSE ty END AS concept_type, CASE WHEN size % 3 = 0 THEN 'named' ELSE '' END AS canonical_name, CASE WHEN n0 >= 2 AND id = s0 THEN 'merged' ELSE '' END AS summary,
 CASE WHEN n2 >= 2 AND id = s2 THEN n WHEN n0 >= 2 AND id = s0 THEN n0 ELSE 0 END::BIGINT AS n_merged FROM e""")
def proposals_in_turns(t: Tables) -> DataFrame:
    """A brand's parts under four proposals in order: a merge, a new type, a merge that takes the first one's result in, and names."""
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    ident = F.col("p_partkey").cast("string")
    f = F.create_map(F.lit("concept_id"), quoted(ident), F.lit("concept_type"), quoted(F.col("p_type")), F.lit("canonical_name"), F.lit('""'), F.lit("summary"), F.lit('""'))
    concepts = t.part.select(F.col("p_brand").alias("unit_id"), ident.alias("concept_id"), F.col("p_partkey").cast("long").alias("ord"), f.alias("f"))
    rest, even = F.col("p_size") % 5, F.col("p_partkey") % 2 == 0
    plan = [("merge", rest == 0, {"summary": '"merged"'}), ("reclassify", even, {"concept_type": '"theme"'}), ("merge", rest < 2, {}), ("refine", F.col("p_size") % 3 == 0, {"canonical_name": '"named"'})]
    refs = [t.part.where(some).groupBy(F.col("p_brand").alias("unit_id")).agg(F.array_sort(F.collect_list("p_partkey")).cast("array<string>").alias("refs")).withColumn("pos", F.lit(k)) for k, (_, some, _) in enumerate(plan)]
    proposals = None
    for (kind, _, changes), r in zip(plan, refs, strict=True):
        said = F.create_map(*[F.lit(x) for e in changes.items() for x in e]) if changes else F.expr("cast(map() as map<string,string>)")
        r = r.select("unit_id", "pos", F.lit(kind).alias("kind"), F.lit(False).alias("loose"), "refs", said.alias("changes"), F.lit("").alias("registry_ref"))
        proposals = r if proposals is None else proposals.unionByName(r)
    after, _ = P.apply_proposals(concepts, proposals)
    text = lambda c: F.expr(f"try_variant_get(try_parse_json(f['{c}']), '$', 'string')").alias(c)
    merged = F.expr("coalesce(size(try_variant_get(try_parse_json(f['merged_from']), '$', 'array<string>')), 0)")
    return after.select("unit_id", "concept_id", text("concept_type"), text("canonical_name"), text("summary"), merged.cast("long").alias("n_merged"))


@catalog.query(f"""WITH c AS (SELECT p_partkey AS pos, p_name AS surface, {entities._TYPES.format(c="p_type")} AS ty, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS cname, CASE WHEN p_size % 3 = 0 THEN '' ELSE 'size ' || p_size END AS summary, p_brand AS al FROM part),
k AS (SELECT *, coalesce(nullif(cname, ''), surface) AS name FROM c),
a AS (SELECT name, ty, string_agg(al, ',' ORDER BY p) AS aliases FROM (SELECT name, ty, al, min(pos) AS p FROM k GROUP BY ALL) GROUP BY ALL)
SELECT min(pos) AS pos, name, ty AS concept_type, arg_min(surface, pos) AS surface, coalesce(arg_min(cname, pos) FILTER (WHERE cname <> ''), '') AS canonical_name, coalesce(arg_min(summary, pos) FILTER (WHERE summary <> ''), '') AS summary, aliases, count(*) AS n_merged FROM k JOIN a USING (name, ty) GROUP BY name, ty, aliases""")
def equivalent_concepts(t: Tables) -> DataFrame:
    """Concepts of one name and type as one, blanks filled and lists united."""
    c = entities._mentions(t).withColumn("canonical_name", F.when(F.col("pos") % 2 == 0, F.col("canonical_name")).otherwise(""))
    m = E.equivalent(c)
    empty = lambda x: F.coalesce(x, F.lit(""))
    name = F.coalesce("canonical_name", "surface")
    return m.select("pos", name.alias("name"), "concept_type", "surface", empty(F.col("canonical_name")).alias("canonical_name"), empty(F.col("summary")).alias("summary"), F.array_join("aliases", ",").alias("aliases"), F.size("merged_from").cast("long").alias("n_merged"))


def _proposals(t: Tables) -> DataFrame:
    """Orders as proposals about their lines' parts: the status is the type, the priority names the registry's concept."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_set(F.format_string("c-%d", "l_partkey"))).alias("target_refs"), F.sort_array(F.collect_set(F.format_string("i-%d", "l_suppkey"))).alias("implicit_refs"))
    kind = F.when(F.col("o_orderstatus") == "F", "link").when(F.col("o_orderstatus") == "O", "merge").otherwise("refine")
    return t.orders.join(lines, "o_orderkey").select("o_orderkey", kind.alias("proposal_type"), "target_refs", "implicit_refs", F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("r-"), F.col("o_custkey").cast("string"))).otherwise("").alias("registry_ref"))


_PROPOSALS = """l AS (SELECT l_orderkey AS o_orderkey, list_sort(list(DISTINCT 'c-' || l_partkey)) AS target_refs, list_sort(list(DISTINCT 'i-' || l_suppkey)) AS implicit_refs FROM lineitem GROUP BY 1),
p AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'link' WHEN 'O' THEN 'merge' ELSE 'refine' END AS proposal_type, target_refs, implicit_refs, CASE WHEN o_custkey % 2 = 0 THEN 'r-' || o_custkey ELSE '' END AS registry_ref FROM orders JOIN l USING (o_orderkey))"""


@catalog.query(f"WITH {_PROPOSALS} SELECT proposal_type, count(*) AS n, sum(len(target_refs))::BIGINT AS n_targets FROM p GROUP BY proposal_type")
def proposal_tallies(t: Tables) -> DataFrame:
    return P.proposal_tallies(_proposals(t))


@catalog.query(f"WITH {_PROPOSALS} SELECT registry_ref, target_refs[1] AS unit_concept_ref, unnest(implicit_refs) AS item_ref FROM p WHERE proposal_type = 'link' AND registry_ref <> ''")
def implied_item_refs(t: Tables) -> DataFrame:
    return P.implied_items(_proposals(t))


# Registry deltas


def _delta(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    units, registry = entities._sides(t)
    return units, registry, R.concept_operations(units, R.collisions(units, registry))


def _groups(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A user's events of a type as a group, and proposals to continue or change a group of the registry."""
    key = F.concat_ws(":", F.col("user_id").cast("string"), F.col("event_type"))
    groups = t.events.groupBy(key.alias("group_id"), "user_id", F.col("event_type").alias("group_type")).agg(F.sort_array(F.collect_list(F.format_string("i-%d", "event_id"))).alias("item_refs"))
    kind = F.when(F.col("user_id") % 3 == 0, "continue").when(F.col("user_id") % 3 == 1, "mutate").otherwise("new_thread")
    return groups, groups.select("group_id", kind.alias("proposal_type"), F.concat(F.lit("rg-"), F.col("user_id").cast("string")).alias("registry_group_ref"))


_GROUPS = """g AS (SELECT user_id || ':' || event_type AS group_id, user_id, event_type AS group_type, list_sort(list('i-' || event_id)) AS item_refs FROM events GROUP BY user_id, event_type),
go AS (SELECT group_id, CASE user_id % 3 WHEN 0 THEN 'continue_group' WHEN 1 THEN 'mutate_group' ELSE 'add_group' END AS op_type, CASE WHEN user_id % 3 < 2 THEN 'rg-' || user_id END AS book_ref FROM g)"""


@catalog.query(f"""WITH {entities._OPS}, {_GROUPS} SELECT op_type, count(*) AS n, count(DISTINCT ref) AS n_refs, count(DISTINCT book_ref) AS n_book_refs FROM
(SELECT unit_ref AS ref, op_type, book_ref FROM ops UNION ALL SELECT 'i-' || event_id, 'add_item', NULL FROM events UNION ALL SELECT * FROM go) GROUP BY op_type""")
def registry_delta_all(t: Tables) -> DataFrame:
    """Operations of a unit with concepts, items and groups, by type."""
    _, _, concepts = _delta(t)
    groups, proposals = _groups(t)
    ops = R.unit_operations(concepts, t.events.select(F.format_string("i-%d", "event_id").alias("item_id")), R.group_operations(groups, proposals))
    return ops.groupBy("op_type").agg(F.count("*").alias("n"), F.countDistinct("ref").alias("n_refs"), F.countDistinct("book_ref").alias("n_book_refs"))


@catalog.query(f"""WITH {_GROUPS}, i AS (SELECT 'i-' || event_id AS old_id, printf('item-%04d', row_number() OVER (ORDER BY 'i-' || event_id) + 100) AS new_id FROM events),
gi AS (SELECT group_id, printf('group-%04d', row_number() OVER (ORDER BY group_id) + 7) AS new_id FROM g),
r AS (SELECT group_id, string_agg(i.new_id, ',' ORDER BY pos) AS item_refs FROM (SELECT group_id, unnest(item_refs) AS old_id, generate_subscripts(item_refs, 1) AS pos FROM g) x JOIN i USING (old_id) GROUP BY group_id)
SELECT gi.new_id AS group_id, group_type, r.item_refs, replace(op_type, '_group', '') AS continuation, book_ref AS registry_group_ref FROM g JOIN gi USING (group_id) JOIN go USING (group_id) JOIN r USING (group_id)""")
def registry_groups_added(t: Tables) -> DataFrame:
    """Groups under the registry's ids, with its items."""
    groups, proposals = _groups(t)
    ids = R.add_items(t.events.select(F.format_string("i-%d", "event_id").alias("item_id"), F.array().cast("array<string>").alias("concept_refs")), t.spark.createDataFrame([], "old_id string, new_id string"), 101)[1]
    rows = groups.select("group_id", "group_type", "item_refs", F.array().cast("array<string>").alias("concept_refs"))
    added = R.add_groups(rows, R.group_operations(groups, proposals), t.spark.createDataFrame([], "old_id string, new_id string"), ids, 8)
    return added.select("group_id", "group_type", F.array_join("item_refs", ",").alias("item_refs"), "continuation", "registry_group_ref")


@catalog.query(f"""WITH {entities._OPS}, i AS (SELECT 'i-' || l_orderkey || '-' || l_suppkey || '-' || l_linenumber || '-' || l_partkey AS item_id, 'uc-' || lpad(min(l_partkey)::VARCHAR, 6, '0') AS ref FROM lineitem GROUP BY 1),
mg AS (SELECT unit_ref AS old_id, book_ref AS new_id FROM ops WHERE op_type = 'merge_concepts')
SELECT printf('item-%04d', row_number() OVER (ORDER BY item_id)) AS item_id, coalesce(new_id, ref) AS concept_ref FROM i LEFT JOIN mg ON old_id = ref""")
def registry_items_added(t: Tables) -> DataFrame:
    """Items under the registry's ids, with its concepts where theirs are merged."""
    _, _, ops = _delta(t)
    merged = ops.where("op_type = 'merge_concepts'").select(F.col("unit_ref").alias("old_id"), F.col("book_ref").alias("new_id"))
    ident = F.concat(F.lit("i-"), F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")]))
    items = t.lineitem.groupBy(ident.alias("item_id")).agg(F.array(entities.unit_ref(F.min("l_partkey"))).alias("concept_refs"))
    return R.add_items(items, merged, 1)[0].select("item_id", F.element_at("concept_refs", 1).alias("concept_ref"))


def _lined(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A delta whose merges come from links by the same number modulo fifty, so that some are not safe."""
    units, registry = entities._sides(t)
    more = lambda d: d.withColumn("aliases", F.array("canonical_name")).withColumn("observed_surfaces", F.array("surface")).withColumn("canonical_name", F.when(F.substring("id", -1, 1) == "0", F.col("canonical_name")).otherwise(""))
    units, registry = more(units), more(registry)
    number = lambda c: F.regexp_extract(c, r"(\d+)$", 1).cast("int") % 50
    best = registry.groupBy(number(F.col("id")).alias("n")).agg(F.min("id").alias("book_ref"))
    links = units.select(F.col("id").alias("unit_ref"), number(F.col("id")).alias("n")).join(best, "n").select("unit_ref", "book_ref")
    return units, registry, R.concept_operations(units, R.collisions(units, registry), links), links


_LINKED = (
    entities._SIDES.partition(", b AS")[0].replace("u AS", "u0 AS")
    + f""", b0 AS (SELECT 'rc-' || lpad(k::VARCHAR, 6, '0') AS id, * FROM c WHERE book),
uu AS (SELECT id, k, surface, ty AS rty, {entities._TYPES.format(c="ty")} AS ty, CASE WHEN right(id, 1) = '0' THEN cname ELSE '' END AS cname, list_distinct([surface, cname]) AS forms FROM u0),
bb AS (SELECT id, k, surface, ty AS rty, {entities._TYPES.format(c="ty")} AS ty, CASE WHEN right(id, 1) = '0' THEN cname ELSE '' END AS cname, list_distinct([surface, cname]) AS forms FROM b0),
ln AS (SELECT uu.id AS unit_ref, min(bb.id) AS book_ref FROM uu JOIN bb ON uu.k % 50 = bb.k % 50 GROUP BY uu.id),
pr AS (SELECT unit_ref, book_ref, uu.ty = bb.ty AS one, uu.cname AS c1, bb.cname AS c2, uu.surface = bb.surface AS same, list_has_any(uu.forms, bb.forms) AS overlap, 'place' IN (uu.ty, bb.ty) AS place FROM ln JOIN uu ON uu.id = unit_ref JOIN bb ON bb.id = book_ref),
rj AS (SELECT unit_ref, book_ref, CASE WHEN place THEN 'place concepts with different surfaces' WHEN NOT one THEN 'types differ and no name is shared' ELSE 'different surfaces and nothing shared' END AS reason
       FROM pr WHERE NOT ((one AND (c1 <> '' OR c2 <> '')) OR (c1 <> '' AND c1 = c2) OR same OR (one AND overlap))),
xx AS (SELECT uu.id AS unit_ref, bb.id AS book_ref, uu.surface = bb.surface AND uu.rty = bb.rty AS s, uu.cname <> '' AND uu.cname = bb.cname AS n FROM uu JOIN bb ON (uu.surface = bb.surface AND uu.rty = bb.rty) OR (uu.cname <> '' AND uu.cname = bb.cname))"""
)


@catalog.query(f"WITH {_LINKED} SELECT unit_ref, book_ref, 'merge_rejected' AS kind, reason FROM rj")
def rejected_merges(t: Tables) -> DataFrame:
    units, registry, ops, _ = _lined(t)
    return R.checked(ops, units, registry)[1]


@catalog.query(f"""WITH {_LINKED} SELECT source AS unit_id, 'unit_unresolved' AS kind, 'd-' || doc_id AS ref, lang AS detail FROM documents WHERE doc_id % 10 = 0
UNION ALL SELECT 'u', 'merge_rejected', unit_ref, book_ref || ':' || reason FROM rj
UNION ALL SELECT 'u', 'identity_ambiguity', unit_ref, book_ref || ':' || CASE WHEN s THEN 'surface_match' ELSE 'cname_match' END FROM xx WHERE NOT (s AND n) AND unit_ref NOT IN (SELECT unit_ref FROM ln) AND unit_ref NOT IN (SELECT unit_ref FROM xx WHERE s AND n)""")
def unresolved_items(t: Tables) -> DataFrame:
    """What units leave open: documents as their own items, and merges that were refused."""
    units, registry, ops, _ = _lined(t)
    own = t.documents.where("doc_id % 10 = 0").select(F.col("source").alias("unit_id"), F.format_string("d-%d", "doc_id").alias("item_id"), F.col("lang").alias("summary"))
    open_ = ops.where("op_type = 'ambiguity'").select(F.lit("u").alias("unit_id"), "unit_ref", "book_ref", "match_reason")
    return R.unresolved_rows(own, open_, R.checked(ops, units, registry)[1].withColumn("unit_id", F.lit("u")))


@catalog.query("""WITH g AS (SELECT user_id, event_type, list(event_id) AS items FROM events WHERE event_id % 4 <> 0 GROUP BY ALL), e AS (SELECT user_id, event_type, lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS nxt FROM events WHERE event_id % 4 <> 0)
SELECT count(*) AS logical_groups, count(*) FILTER (WHERE len(items) = 1) AS singleton_groups, count(*) FILTER (WHERE event_type = 'view') AS timeline_groups, (SELECT count(DISTINCT user_id || event_type) FROM e WHERE nxt IS NOT NULL) AS groups_with_graph, (SELECT count(*) FROM e WHERE nxt IS NOT NULL) AS graph_edges,
(SELECT count(*) FROM events WHERE event_id % 4 <> 0) AS items_grouped, (SELECT count(*) FROM events WHERE event_id % 4 = 0) AS items_ungrouped, (SELECT count(*) FROM events WHERE event_type IN ('click', 'error') AND value > 10) AS event_items_with_time FROM g""")
def grouping_counts(t: Tables) -> DataFrame:
    """Counts of groups, items and edges; a user's events of a type are a group, but for every fourth event."""
    some = t.events.where("event_id % 4 <> 0")
    gid = F.concat(F.col("user_id").cast("string"), "event_type")
    kind = F.when(F.col("event_type") == "view", "timeline").otherwise(F.col("event_type"))
    groups = some.groupBy(gid.alias("group_id"), kind.alias("group_type")).agg(F.collect_list("event_id").alias("item_refs"))
    nxt = F.lead("event_id").over(Window.partitionBy("user_id", "event_type").orderBy("event_id"))
    edges = some.select(gid.alias("group_id"), nxt.alias("target")).where("target IS NOT NULL")
    kind = F.when(F.col("event_type").isin("click", "error"), "event").otherwise("claim")
    items = t.events.select(F.col("event_id").alias("item_id"), kind.alias("item_type"), F.array(F.when(F.col("value") > 10, "explicit").otherwise("none")).alias("time_kinds"))
    return R.grouping_counts(groups, items, edges)


@catalog.query("""WITH e AS (SELECT user_id, event_type, event_id, lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS nxt FROM events), g AS (SELECT user_id, event_type, count(nxt) AS n FROM e GROUP BY ALL)
SELECT event_type AS group_type, count(*) AS n_groups, count(*) FILTER (WHERE n > 0) AS n_with_graph, sum(n)::BIGINT AS n_edges FROM g GROUP BY event_type""")
def group_type_histogram(t: Tables) -> DataFrame:
    groups, _ = _groups(t)
    nxt = F.lead("event_id").over(Window.partitionBy("user_id", "event_type").orderBy("event_id"))
    edges = t.events.select(F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("group_id"), nxt.alias("target")).where("target IS NOT NULL")
    return R.type_histogram(groups, edges)


# Candidates and lookups


def _concepts(t: Tables, which: str) -> DataFrame:
    c = retrieval._concepts(t, which)
    return c.select(F.col("id").alias("concept_id"), "concept_type", "surface", "canonical_name", F.concat_ws(" ", F.lit("a"), "surface", F.lit("of"), F.array_join("aliases", " ")).alias("summary"), "aliases", F.col("observed").alias("observed_surfaces"))


_FULL = """WITH cc AS (SELECT min(p_partkey) AS id, CASE WHEN p_type = 'SMALL' THEN 'other' ELSE lower(p_type) END AS ty, p_name AS surface, min(p_brand) AS cname, list_sort(list(DISTINCT p_brand)) AS aliases, p_size < 25 AS book FROM part GROUP BY p_name, p_type, p_size < 25),
ct AS (SELECT *, 'a ' || surface || ' of ' || array_to_string(aliases, ' ') AS summary FROM cc),
tx AS (SELECT id, book, array_to_string(list_concat([cname, summary], list_filter(list_concat([surface], list_filter(aliases[1:5], lambda a: a <> surface)), lambda a: a <> cname AND a <> summary)), ' ') AS btext,
       array_to_string(list_concat(list_concat([surface], CASE WHEN cname <> surface THEN [cname] ELSE [] END), list_concat([summary], list_filter(aliases[1:5], lambda a: a <> surface AND a <> cname AND a <> summary))), ' ') AS utext FROM ct)"""


@catalog.query(f"{_FULL} SELECT id AS concept_id, CASE WHEN book THEN btext ELSE utext END AS searched FROM tx")
def searchable_texts(t: Tables) -> DataFrame:
    """What concepts of the registry are found by, and what a unit's concepts ask for."""
    book = _concepts(t, "p_size < 25").select("concept_id", S.concept_text().alias("searched"))
    return book.unionByName(_concepts(t, "p_size >= 25").select("concept_id", S.unit_concept_text().alias("searched")))


@catalog.query("""WITH c AS (SELECT min(p_partkey) AS concept_id, p_name AS surface, list(DISTINCT p_brand) AS aliases FROM part GROUP BY p_name, p_type), n AS (SELECT concept_id, surface AS name FROM c UNION SELECT concept_id, unnest(aliases) FROM c)
SELECT DISTINCT name, concept_id FROM n WHERE name IN (SELECT DISTINCT p_brand FROM part WHERE p_size = 7 UNION SELECT DISTINCT p_name FROM part WHERE p_size = 8)""")
def lookup_by_surface(t: Tables) -> DataFrame:
    c = t.part.groupBy("p_name", "p_type").agg(F.min("p_partkey").alias("concept_id"), F.collect_set("p_brand").alias("aliases")).withColumn("surface", F.col("p_name")).withColumn("observed_surfaces", F.array("p_name"))
    names = t.part.where("p_size = 7").select(F.col("p_brand").alias("name")).union(t.part.where("p_size = 8").select("p_name"))
    return S.by_surface(c, names)


@catalog.query("SELECT p_partkey AS concept_id, p_brand AS name FROM part WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size = 7)")
def lookup_by_name(t: Tables) -> DataFrame:
    c = t.part.select(F.col("p_partkey").alias("concept_id"), F.col("p_brand").alias("canonical_name"))
    return S.by_name(c, t.part.where("p_size = 7").select(F.col("p_brand").alias("name")))


@catalog.query("SELECT p_partkey AS concept_id, p_name, p_brand FROM part WHERE p_partkey = 17")
def point_lookup(t: Tables) -> DataFrame:
    return S.by_id(t.part.select(F.col("p_partkey").cast("string").alias("k"), F.col("p_partkey").alias("concept_id"), "p_name", "p_brand"), "k", "17").drop("k")


@catalog.query("""WITH g AS (SELECT p_brand AS group_id, min(p_type) AS group_type, string_agg(DISTINCT p_name, ' ' ORDER BY p_name) AS s, list_sort(list(DISTINCT p_type)) AS refs, count(*) AS item_count FROM part GROUP BY p_brand)
SELECT group_id, group_type, CASE WHEN length(s) > 120 THEN left(s, 117) || '...' ELSE s END AS summary, array_to_string(refs[1:5], ',') AS key_concept_ids, item_count FROM g""")
def group_index(t: Tables) -> DataFrame:
    g = t.part.groupBy(F.col("p_brand").alias("group_id")).agg(F.min("p_type").alias("group_type"), F.array_join(F.sort_array(F.collect_set("p_name")), " ").alias("summary"), F.sort_array(F.collect_list("p_type")).alias("concept_refs"), F.collect_list("p_partkey").alias("item_refs"))
    return S.group_index(g).withColumn("key_concept_ids", F.array_join("key_concept_ids", ","))


@catalog.query("""SELECT min(p_partkey)::VARCHAR AS concept_id, p_name AS canonical_name, p_type AS concept_type, CASE WHEN length(string_agg(p_brand, ' ' ORDER BY p_partkey)) > 200 THEN left(string_agg(p_brand, ' ' ORDER BY p_partkey), 197) || '...' ELSE string_agg(p_brand, ' ' ORDER BY p_partkey) END AS summary,
least(10, count(DISTINCT p_brand)) AS n_surfaces FROM part GROUP BY p_name, p_type""")
def search_result_rows(t: Tables) -> DataFrame:
    rows = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_brand"))), lambda x: x["p_brand"])
    c = t.part.groupBy(F.col("p_name").alias("canonical_name"), F.col("p_type").alias("concept_type")).agg(F.min("p_partkey").cast("string").alias("concept_id"), F.array_join(rows, " ").alias("summary"), F.collect_set("p_brand").alias("observed_surfaces"))
    return S.compact(c).select("concept_id", "canonical_name", "concept_type", "summary", F.size("observed_surfaces").cast("long").alias("n_surfaces"))


@catalog.query(f"""WITH {retrieval._CONCEPTS}, un AS (SELECT id FROM cc WHERE NOT book), d AS (SELECT unit_ref, list_sort(list(DISTINCT book_ref)) AS ids FROM pp GROUP BY unit_ref)
SELECT un.id AS unit_concept_id, coalesce(array_to_string(ids, ','), '') AS deterministic, len(list_distinct(list_concat(coalesce(ids, []), (SELECT list(id) FROM cc WHERE book))))::BIGINT AS n_candidates FROM un LEFT JOIN d ON unit_ref = un.id""")
def candidate_map_passed(t: Tables) -> DataFrame:
    """Candidates by name of each unit concept, and all of a registry that is passed on whole."""
    units, registry = _concepts(t, "p_size >= 25"), _concepts(t, "p_size < 25")
    from ..operators import retrieval as Q

    sides = [x.select(F.col("concept_id").alias("id"), "concept_type", "surface", "canonical_name", "aliases", F.col("observed_surfaces").alias("observed")) for x in (units, registry)]
    none = units.select(F.col("concept_id").alias("query_id"), F.lit(0).alias("rank"), F.col("concept_id").alias("doc_id")).limit(0)
    m = S.candidate_map(units, Q.name_candidates(*sides), none, registry.select(F.col("concept_id").alias("doc_id")))
    ids = F.array_join(F.transform("deterministic_candidate_ids", lambda x: x.cast("string")), ",")
    return m.select("unit_concept_id", ids.alias("deterministic"), F.size("candidate_ids").cast("long").alias("n_candidates"))


@catalog.query("""WITH r AS (SELECT DISTINCT p_name FROM part WHERE p_size < 25), n AS (SELECT count(*) AS n FROM r) SELECT 'p_name' AS registry, n AS n_rows, n <= 50 AS passed FROM n
UNION ALL SELECT 'part', count(*), count(*) <= 50 FROM part""")
def candidate_gate(t: Tables) -> DataFrame:
    """Whether registries are small enough to be passed on whole."""
    one = t.part.where("p_size < 25").select("p_name").distinct().agg(F.count("*").alias("n_rows")).select(F.lit("p_name").alias("registry"), "n_rows")
    two = t.part.agg(F.count("*").alias("n_rows")).select(F.lit("part").alias("registry"), "n_rows")
    return one.union(two).withColumn("passed", F.col("n_rows") <= S.SMALL)


@catalog.query()
def concept_candidates(t: Tables) -> DataFrame:
    """Candidates of a unit's concepts: by name, else by both signals in their type family."""
    return S.select_concepts(_concepts(t, "p_size >= 25"), _concepts(t, "p_size < 25"))["map"].select("unit_concept_id", F.array_join(F.transform("candidate_ids", lambda x: x.cast("string")), ",").alias("candidate_ids"))


_SEARCH = retrieval.BM25.replace("FROM documents", "FROM dd")


@catalog.query(f"""WITH g AS (SELECT p_brand || '/' || p_size AS group_id, p_size = 1 AS mine, min(p_type) AS group_type, string_agg(DISTINCT p_name, ' ' ORDER BY p_name) AS s, list(DISTINCT p_name) AS refs FROM part WHERE p_brand || '/' || p_size IS NOT NULL GROUP BY p_brand, p_size),
dd AS (SELECT group_id AS doc_id, '' AS lang, CASE WHEN length(s) > 120 THEN left(s, 117) || '...' ELSE s END || ' ' || group_type AS text FROM g WHERE NOT mine), q AS (SELECT group_id AS query_id, s || ' ' || group_type AS query FROM g WHERE mine), {_SEARCH},
r AS (SELECT doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM bm WHERE score > 0),
l AS (SELECT group_id, 'concept' AS reason FROM g WHERE NOT mine AND len(list_intersect(refs, (SELECT list(DISTINCT p_name) FROM part WHERE p_size = 1))) > 0),
c AS (SELECT doc_id AS group_id, 'signal' AS reason FROM r WHERE rank <= 20 UNION ALL SELECT * FROM l)
SELECT group_id, CASE WHEN (SELECT count(*) FROM dd) <= {S.SMALL} THEN 'all' ELSE reason END AS reason FROM (SELECT group_id, min(reason) AS reason FROM (SELECT * FROM c WHERE (SELECT count(*) FROM dd) > {S.SMALL} UNION ALL SELECT doc_id, 'all' FROM dd WHERE (SELECT count(*) FROM dd) <= {S.SMALL}) GROUP BY group_id)""")
def selected_groups(t: Tables) -> DataFrame:
    """Groups of a registry (parts of a brand and size) that a unit's groups (those of size 1) may continue: by a linked concept, else by words."""
    key = F.concat_ws("/", "p_brand", F.col("p_size").cast("string"))
    g = t.part.where("p_brand IS NOT NULL AND p_size IS NOT NULL").groupBy(key.alias("group_id"), "p_size").agg(F.min("p_type").alias("group_type"), F.array_join(F.sort_array(F.collect_set("p_name")), " ").alias("summary"), F.collect_set("p_name").alias("concept_refs"), F.collect_list("p_partkey").alias("item_refs"))
    linked = t.part.where("p_size = 1").select(F.col("p_name").alias("registry_ref"))
    return S.select_groups(g.where("p_size = 1"), g.where("p_size <> 1"), linked)


@catalog.query(f"WITH dd AS (SELECT item_id AS doc_id, '' AS lang, text FROM benchmark), q AS (SELECT 0 AS query_id, 'the of and to a nation' AS query), {_SEARCH}, r AS (SELECT doc_id, score, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS rank FROM bm WHERE score > 0) SELECT doc_id, rank, round(score, 6) AS score, 'bm25' AS method FROM r WHERE rank <= 10")
def search_tool(t: Tables) -> DataFrame:
    rows = t.benchmark.select(F.col("item_id").alias("doc_id"), "text")
    return S.search(rows, "the of and to a nation", 10).withColumn("rank", F.col("rank").cast("long"))


@catalog.query(f"""WITH dd AS (SELECT item_id AS doc_id, '' AS lang, text FROM benchmark), q AS (SELECT doc_id AS query_id, text AS query FROM documents WHERE doc_id % 20 = 0), {_SEARCH},
r AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM bm WHERE score > 0)
SELECT query_id, doc_id, 'bm25' AS methods, round(1.0 / (60 + rank), 9) AS rrf FROM r WHERE rank <= 20""")
def dual_signal_without_model(t: Tables) -> DataFrame:
    """Both signals where there is no model: words alone decide. Every twentieth document asks for benchmark passages."""
    q = t.documents.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query"))
    found = S.dual_signal(t.benchmark.select(F.col("item_id").alias("doc_id"), "text"), q)
    return found.select("query_id", "doc_id", "methods", F.round("rrf", 9).alias("rrf"))


# Packages


def _delta_documents(t: Tables) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", "new_concept").when(F.col("l_returnflag") == "R", "merge").otherwise("merge_proposal")
    ops = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").cast("string").alias("operation_id"), kind.alias("operation_type"), F.array(F.concat(F.when(F.col("l_linestatus") == "F", "context:").otherwise("block-"), F.col("l_partkey").cast("string"))).alias("evidence_refs")))).alias("operations"))
    snapshot = F.when(F.col("l_orderkey") % 7 == 0, "old").otherwise("now")
    package = F.struct(F.lit("v").alias("schema_version"), F.col("l_orderkey").cast("string").alias("delta_id"), snapshot.alias("base_snapshot_id"), F.lit("u").alias("unit_id"), "operations")
    return ops.select(F.col("l_orderkey").alias("key"), F.to_json(package).alias("package"))


@catalog.query("""WITH l AS (SELECT l_orderkey::VARCHAR AS key, l_linenumber, l_returnflag, l_linestatus, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY 1) AS n, l_orderkey % 7 = 0 AS old FROM lineitem),
i AS (SELECT key, 'duplicate_object_id' AS code FROM l WHERE n > 1 UNION ALL SELECT key, unnest(['unsupported_delta_operation', 'destructive_auto_merge']) FROM l WHERE l_returnflag = 'R' UNION ALL SELECT key, 'prior_context_used_as_evidence' FROM l WHERE l_linestatus = 'F'
UNION ALL SELECT DISTINCT key, 'base_snapshot_mismatch' FROM l WHERE old UNION ALL SELECT DISTINCT key, 'missing_required_field' FROM l)
SELECT key, code, count(*) AS n_issues FROM i GROUP BY ALL""")
def delta_document_issues(t: Tables) -> DataFrame:
    """Issues of orders as delta documents: their lines are operations, some of them repeated, destructive or standing on prior context."""
    found = K.issues_of(_delta_documents(t), lambda d: K.delta_document_issues(d, "now"))
    return found.groupBy("key", "code").agg(F.count("*").alias("n_issues"))


def _unit_packages(t: Tables) -> DataFrame:
    """Conversations as units: turns are blocks, one after another; roles are concepts that cite blocks, some of which do not exist."""
    n = F.length(F.coalesce("text", F.lit("")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    start = F.coalesce(F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = t.conversations.withColumn("start", start).withColumn("k", F.row_number().over(order) - 1)
    block = F.struct("k", F.format_string("block-%d", "k").alias("block_id"), F.when(F.col("turn") % 7 == 6, "other").otherwise(F.col("conv_id").cast("string")).alias("unit_id"), F.lit("s").alias("segment_id"), F.col("k").alias("block_index"), F.when(F.col("role") == "system", "").otherwise("paragraph").alias("block_type"),
        F.col("start"), (F.col("start") + n + F.when(F.col("turn") % 5 == 4, 1).otherwise(0)).alias("end"), F.coalesce("text", F.lit("")).alias("text"), F.lit("h").alias("text_hash"))
    ref = F.when(F.col("role") == "assistant", "block-0").when(F.col("role") == "system", "block-99").otherwise("context:1")
    concept = F.struct("k", F.when(F.col("turn") % 3 == 2, "c-x").otherwise(F.format_string("c-%d", "k")).alias("concept_id"), F.col("role").alias("surface"), F.lit("person").alias("concept_type"), F.array(ref).alias("source_block_refs"), F.array(F.when(F.col("turn") == 0, " ").otherwise("ok")).alias("aliases"),
        F.struct(F.when(F.col("turn") % 4 == 3, "guessed").otherwise("source_grounded").alias("grounding")).alias("provenance"))
    g = rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(block)), lambda b: b.dropFields("k")).alias("source_blocks"), F.transform(F.array_sort(F.collect_list(concept)), lambda c: c.dropFields("k")).alias("concepts"))
    package = F.struct(F.lit(K.UNIT_SCHEMA).alias("schema_version"), F.col("conv_id").cast("string").alias("unit_id"), F.create_map(F.lit("path"), F.lit("x")).alias("source"), "source_blocks", "concepts", F.array().alias("atomic_items"), F.array().alias("logical_groups"), F.array().alias("unresolved_items"), F.create_map(F.lit("ok"), F.lit(True)).alias("validation"), F.create_map(F.lit("a"), F.lit("b")).alias("context_metadata"), F.array().alias("timelines"))
    return g.select(F.col("conv_id").alias("key"), F.to_json(package).alias("package"))


@catalog.query("""WITH c AS (SELECT conv_id::VARCHAR AS key, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS k FROM conversations), x AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY k) AS n FROM c WHERE turn % 3 = 2),
i AS (SELECT DISTINCT key, 'error' AS severity, 'stale_core_field' AS code FROM c UNION ALL SELECT key, 'error', 'unit_id_mismatch' FROM c WHERE turn % 7 = 6 UNION ALL SELECT key, 'error', 'source_block_range_length_mismatch' FROM c WHERE turn % 5 = 4
UNION ALL SELECT key, 'error', 'invalid_type_string' FROM c WHERE role = 'system' UNION ALL SELECT key, 'error', 'duplicate_object_id' FROM x WHERE n > 1 UNION ALL SELECT key, 'warning', 'unknown_ref' FROM c WHERE role = 'system'
UNION ALL SELECT key, 'error', 'prior_context_used_as_evidence' FROM c WHERE role NOT IN ('assistant', 'system') UNION ALL SELECT key, 'error', 'missing_source_block_refs' FROM c WHERE role <> 'assistant' UNION ALL SELECT key, 'error', 'empty_string_list_item' FROM c WHERE turn = 0
UNION ALL SELECT key, 'error', 'invalid_grounding' FROM c WHERE turn % 4 = 3)
SELECT key, severity, code, count(*) AS n_issues FROM i GROUP BY ALL""")
def unit_package_issues(t: Tables) -> DataFrame:
    return K.issues_of(_unit_packages(t), K.unit_issues).groupBy("key", "severity", "code").agg(F.count("*").alias("n_issues"))


def _extractions(t: Tables) -> DataFrame:
    """Documents that cite quotes, as extractions: each quote is evidence, and a mention cites it and something that is none."""
    pairs = texts._locations(t).select("doc_id", "item_id").join(t.benchmark.select("item_id", F.col("text").alias("quote")), "item_id")
    ident = F.concat(F.lit("e"), F.col("item_id").cast("string"))
    mention = F.struct(F.concat(F.lit("m"), F.col("item_id").cast("string")).alias("mention_id"), F.array(ident, F.lit("zz")).alias("evidence_span_ids"))
    g = pairs.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(ident.alias("evidence_id"), "quote"))).alias("evidence_spans"), F.array_sort(F.collect_list(mention)).alias("entity_mentions"))
    empty = [F.array().alias(c) for c in ("location_mentions", "atom_mentions", "time_expressions", "thread_candidates")]
    package = F.struct(F.col("doc_id").cast("string").alias("unit_id"), "evidence_spans", "entity_mentions", *empty)
    return g.select("doc_id", F.to_json(package).alias("package")).join(t.documents.select("doc_id", "text"), "doc_id").select(F.col("doc_id").alias("key"), "package", "text")


@catalog.query(f"""WITH {texts._STATUS}, x AS (SELECT doc_id::VARCHAR AS key, status, length(text) AS n FROM s JOIN benchmark USING (item_id)),
i AS (SELECT key, 'error' AS severity, 'unresolved_evidence_ref' AS code FROM x UNION ALL SELECT key, 'error', 'evidence_quote_missing' FROM x WHERE status = 'missing' UNION ALL SELECT key, 'warning', 'evidence_quote_ambiguous' FROM x WHERE status = 'ambiguous'
UNION ALL SELECT key, 'warning', 'evidence_quote_too_long' FROM x WHERE n > 600 UNION ALL SELECT DISTINCT key, 'error', 'missing_required_field' FROM x)
SELECT key, severity, code, count(*) AS n_issues FROM i GROUP BY ALL""")
def extraction_issues(t: Tables) -> DataFrame:
    return K.issues_of(_extractions(t), lambda d, text: K.extraction_issues(d, text)[0]).groupBy("key", "severity", "code").agg(F.count("*").alias("n_issues"))


@catalog.query("""WITH d AS (SELECT doc_id::VARCHAR AS key, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ls, doc_id FROM documents)
SELECT key, 'missing_required_field' AS code, (1 + CASE WHEN len(ls) = 0 THEN 2 ELSE 0 END + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END)::BIGINT AS n_issues FROM d""")
def overview_package_issues(t: Tables) -> DataFrame:
    """Overviews of one segment from a document's first line to its last; they lack warnings, and some a second segment's end."""
    ls = F.filter(F.split("text", "\n"), lambda x: x != "")
    line = lambda k: F.coalesce(F.get(ls, k), F.lit(""))
    one = F.struct(line(F.lit(0)).alias("start_quote"), line(F.size(ls) - 1).alias("end_quote"))
    more = F.struct(F.lit("x").alias("start_quote"), F.lit("").alias("end_quote"))
    package = F.struct(F.col("doc_id").cast("string").alias("unit_id"), F.when(F.col("doc_id") % 3 == 0, F.array(one, more)).otherwise(F.array(one)).alias("overview_segments"))
    return K.issues_of(t.documents.select(F.col("doc_id").alias("key"), F.to_json(package).alias("package")), K.overview_issues).groupBy("key", "code").agg(F.count("*").alias("n_issues"))


@catalog.query("SELECT o_orderkey::VARCHAR AS subject_id, 'missing_source_block_refs' AS code FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 2) AND o_orderstatus <> 'P' UNION ALL SELECT o_orderkey::VARCHAR, 'invalid_grounding' FROM orders WHERE o_orderstatus = 'F'")
def grounding_issues(t: Tables) -> DataFrame:
    """Orders as records that stand on their later lines; one status is inferred, one is no grounding at all."""
    refs = t.lineitem.where("l_linenumber > 2").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.col("l_linenumber").cast("string")).alias("source_block_refs"))
    g = F.when(F.col("o_orderstatus") == "P", "llm_inferred").when(F.col("o_orderstatus") == "F", "guessed").otherwise("source_grounded")
    return C.grounding_issues(t.orders.join(refs, "o_orderkey", "left").withColumn("grounding", g), "o_orderkey").select("subject_id", "code")


# Views


@catalog.query("SELECT l_partkey::VARCHAR AS block_id, string_agg(DISTINCT 'o' || lpad(l_orderkey::VARCHAR, 9, '0'), ',' ORDER BY 'o' || lpad(l_orderkey::VARCHAR, 9, '0')) AS owners FROM lineitem GROUP BY l_partkey")
def block_index(t: Tables) -> DataFrame:
    """Which orders stand on each part."""
    o = t.lineitem.select(F.format_string("o%09d", "l_orderkey").alias("item_id"), F.array(F.col("l_partkey").cast("string")).alias("source_block_refs"))
    return W.block_index(o, "item_id").select("block_id", F.array_join("owners", ",").alias("owners"))


@catalog.query(f"""WITH {texts._LINES}, s AS (SELECT doc_id, repeat('#', (doc_id % 13)::INT) || text AS text FROM documents), f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY "start") AS n FROM lb),
h AS (SELECT f.doc_id, n, strpos(s.text, f.text) - 1 - "start" AS o FROM f JOIN s USING (doc_id) WHERE n <= 10 AND length(f.text) >= 20 AND contains(s.text, f.text))
SELECT doc_id, coalesce(arg_min(o, n), 0)::BIGINT AS "offset" FROM s LEFT JOIN h USING (doc_id) GROUP BY doc_id""")
def source_offsets(t: Tables) -> DataFrame:
    """Where line blocks lie in texts that have marks before them."""
    src = t.documents.select("doc_id", F.concat(F.expr("repeat('#', cast(doc_id % 13 AS INT))"), "text").alias("text"))
    return W.source_offsets(texts._line_blocks(t), src, "doc_id")


@catalog.query("""WITH n AS (SELECT p_brand AS concept_id, p_name AS s, min(p_partkey) AS k FROM part GROUP BY ALL) SELECT concept_id, string_agg(s, ',' ORDER BY length(s) DESC, k) AS surfaces FROM n WHERE length(s) >= 2 GROUP BY concept_id""")
def concept_surfaces(t: Tables) -> DataFrame:
    seen = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))), lambda x: x["p_name"])
    c = t.part.groupBy(F.col("p_brand").alias("concept_id")).agg(seen.alias("observed_surfaces")).withColumn("surface", F.col("concept_id"))
    return W.surfaces(c).select("concept_id", F.array_join("surfaces", ",").alias("surfaces"))


@catalog.query(f"""WITH {texts._LINES}, k AS (SELECT doc_id, block_index, "start", text, coalesce(lag("start" + length(text)) OVER (PARTITION BY doc_id ORDER BY "start"), 0) AS e FROM lb WHERE block_index % 3 <> 1)
SELECT doc_id, string_agg(repeat(' ', ("start" - e)::INT) || text, '' ORDER BY "start") AS text FROM k GROUP BY doc_id""")
def stitched_texts(t: Tables) -> DataFrame:
    """Texts from two of three lines each, with blanks for the others."""
    return W.stitched(texts._line_blocks(t).where("block_index % 3 <> 1"), "doc_id")


@catalog.query("""WITH c AS (SELECT r_name || '/' || n_name AS path, r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT r_name AS unit_id, 0::BIGINT AS depth, r_name AS line FROM region UNION ALL SELECT path, 1, '  ' || n_name FROM c""")
def outline(t: Tables) -> DataFrame:
    """Regions and their nations as a table of contents."""
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    units = t.region.select(F.col("r_name").alias("unit_id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_regionkey").cast("int").alias("ord"), F.col("r_name").alias("label"))
    units = units.unionByName(n.select(F.concat_ws("/", "r_name", "n_name").alias("unit_id"), F.col("r_name").alias("parent_id"), F.col("n_nationkey").cast("int").alias("ord"), F.col("n_name").alias("label")))
    return W.outline(units).select("unit_id", F.col("depth").cast("long").alias("depth"), "line")


@catalog.query(r"""WITH b AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL), m AS (SELECT doc_id, item_id, strpos(b.text, q.text) AS a, length(q.text) AS n, b.text AS t, (length(b.text) - length(replace(b.text, q.text, ''))) // length(q.text) AS c FROM b JOIN benchmark q ON contains(b.text, q.text)),
o AS (SELECT doc_id, count(*) AS k, any_value(c) AS c, any_value(item_id) AS item_id, any_value(a) AS a, any_value(n) AS n, any_value(t) AS t FROM m GROUP BY doc_id),
e AS (SELECT doc_id, item_id, left(t, a - 1) AS x, substr(t, a, n) AS y, substr(t, a + n) AS z FROM o WHERE k = 1 AND c = 1)
SELECT doc_id::VARCHAR AS block_id, replace(replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '<mark data-concept="q' || item_id || '">' || replace(replace(replace(replace(y, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</mark>' || replace(replace(replace(replace(z, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS markup FROM e""")
def annotated_blocks(t: Tables) -> DataFrame:
    """Documents that hold one benchmark passage once, marked up; the passages are concepts that stand on them."""
    from ..operators import locate as L

    e = L.exact_evidence(t.documents, t.benchmark.select("item_id", F.col("text").alias("quote")))
    one = e.groupBy("doc_id").agg(F.count("*").alias("k"), F.max("n_found").alias("c"), F.max("item_id").alias("item_id")).where("k = 1 AND c = 1")
    refs = one.groupBy("item_id").agg(F.collect_list(F.col("doc_id").cast("string")).alias("source_block_refs"))
    concepts = refs.join(t.benchmark, "item_id").select(F.concat(F.lit("q"), F.col("item_id").cast("string")).alias("concept_id"), F.col("text").alias("surface"), F.array().cast("array<string>").alias("observed_surfaces"), "source_block_refs")
    blocks = t.documents.join(one.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").cast("string").alias("block_id"), "text")
    return W.annotated(blocks, concepts)
