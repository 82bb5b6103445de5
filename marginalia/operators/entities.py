"""Mentions unified into concepts: groups, merges, ambiguities, and the screens that keep merges safe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..storage import written
from .graph import components, linked_by_key

def first_non_empty(value: str, order: str) -> Column:
    return F.min_by(F.when(F.col(value) != "", F.col(value)), F.when(F.col(value) != "", F.col(order)))


def longest(value: Column) -> Column:
    """The longest value of a group, ties by the alphabet; null and empty ones do not count."""
    return F.min(F.when(value != "", F.struct((-F.length(value)).alias("n"), value.alias("v"))))["v"]


def union_in_order(value: Column, order: Column) -> Column:
    """Distinct values of a group in order of first appearance; ``value``: an array, ``order``: what rows are in order of."""
    lists = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_distinct(F.flatten(F.transform(lists, lambda x: x["v"])))


def agreed(value: Column, otherwise: str = "synthesis") -> Column:
    """The value that all rows of a group share, if it is not empty."""
    v = F.coalesce(value, F.lit(""))
    return F.when((F.min(v) == F.max(v)) & (F.min(v) != ""), F.min(v)).otherwise(otherwise)


def merge(concepts: DataFrame, *keys: str, scope: str | None = None) -> DataFrame:
    """One concept for each value of ``keys`` from rows of ``pos, concept_id, surface, concept_type, canonical_name, summary, aliases,
    observed_surfaces, source_block_refs, grounding``.

    The longest canonical name wins and becomes the surface, else the first surface stays; the first summary that is not empty stays; lists are
    united in order; the grounding stays where all agree. With ``scope``, a column that names each row's unit, summaries are
    joined with their units instead, if none is empty, and the units are joined by plus signs.
    """
    pos = F.col("pos")
    lists = [union_in_order(F.col(c), pos).alias(c) for c in ("aliases", "observed_surfaces", "source_block_refs")]
    summary = F.coalesce(first_non_empty("summary", "pos"), F.lit(""))
    if scope:
        labelled = F.when(F.col("summary").startswith("["), F.col("summary")).otherwise(F.concat(F.lit("["), F.col(scope), F.lit("]: "), F.col("summary")))
        said = F.array_sort(F.collect_list(F.struct(pos, labelled.alias("t"))))
        lists.append(F.array_join(union_in_order(F.array(scope), pos), "+").alias(scope))
        summary = F.when(F.bool_and(F.col("summary") != "") & (F.count("*") > 1), F.array_join(F.transform(said, lambda x: x["t"]), " ")).otherwise(summary)
    out = concepts.groupBy(*keys).agg(
        F.min("pos").alias("pos"), F.count("*").alias("n_members"), longest(F.col("canonical_name")).alias("canonical_name"), F.min_by("surface", "pos").alias("first_surface"),
        F.min_by("concept_type", "pos").alias("type"), summary.alias("summary"), *lists, agreed(F.col("grounding")).alias("grounding"), union_in_order(F.array("concept_id"), pos).alias("merged_from"),
    )
    return out.withColumn("surface", F.coalesce("canonical_name", "first_surface")).withColumn("canonical_name", F.coalesce("canonical_name", F.lit(""))).withColumnRenamed("type", "concept_type")


def unify(concepts: DataFrame, unit: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Merged concepts of segment results and the map from old ids to new ones; with ``unit``, a column, those of each unit by themselves.

    Rows with the same surface and type are one group; groups that share a canonical name and a type are joined, transitively. New ids
    are in order of first appearance. ``pos`` (long) must be different for each row of a unit.
    """
    from .registry import numbered  # that module builds on this one

    own = [unit] if unit else []
    rows = written(concepts.withColumn("concept_type", T.concept_type(F.col("concept_type"))).withColumn("__node", F.monotonically_increasing_id()), "mentions")
    key = lambda kind, name: F.struct(F.lit(kind).alias("k"), F.col(name).alias("surface"), "concept_type", *own).alias("key")
    keys = rows.select("__node", key("s", "surface")).unionByName(rows.where("canonical_name <> ''").select("__node", key("n", "canonical_name")))
    roots = components(linked_by_key(keys, "__node", "key"))
    rooted = written(rows.join(roots.select(F.col("node").alias("__node"), "root"), "__node").drop("__node"), "rooted")
    merged = merge(rooted, *own, "root")
    if unit:
        merged = merged.withColumn("n", F.row_number().over(Window.partitionBy(unit).orderBy("pos")))
    else:
        merged = numbered(merged, "pos", "n")
    merged = written(merged.withColumn("new_id", F.format_string("concept-%04d", F.col("n"))).drop("n"), "unified")
    return merged, rooted.select(*own, "concept_id", "root").join(merged.select("root", "new_id"), "root").select(*own, "concept_id", "new_id")


def ambiguous(concepts: DataFrame, surface: str = "surface", kind: str = "concept_type") -> DataFrame:
    """Surfaces seen with several types: the types in order and how many rows."""
    g = concepts.groupBy(surface).agg(F.sort_array(F.collect_set(kind)).alias("types"), F.count("*").alias("n_rows"))
    return g.where(F.size("types") > 1)


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, with ``n_equal``, the rows of that key."""
    w = Window.partitionBy(*keys)
    return rows.withColumn("rn", F.row_number().over(w.orderBy(*order))).withColumn("n_equal", F.count("*").over(w)).where("rn = 1").drop("rn")


def remap(refs: DataFrame, mapping: DataFrame, ref: str) -> DataFrame:
    """``ref`` replaced by its new id (``mapping``: ``old_id, new_id``); ids without one stay."""
    return refs.join(mapping.select(F.col("old_id").alias(ref), "new_id"), ref, "left").withColumn(ref, F.coalesce("new_id", ref)).drop("new_id")


def compose(first: DataFrame, second: DataFrame) -> DataFrame:
    """The mapping that applies ``first``, then ``second``."""
    s = second.select(F.col("old_id").alias("mid"), F.col("new_id").alias("last"))
    return first.join(s, F.col("new_id") == F.col("mid"), "left").select("old_id", F.coalesce("last", "new_id").alias("new_id"))


def equivalent(concepts: DataFrame) -> DataFrame:
    """Concepts (``pos, concept_id, surface, concept_type, canonical_name, summary, aliases, observed_surfaces, source_block_refs``) of one name, else
    surface, and one type as one: the first stays, its blanks take the first value that is not empty, its lists are united in order.
    Rows without a name stay as they are."""
    name = F.trim(F.coalesce(F.nullif("canonical_name", F.lit("")), F.nullif("surface", F.lit("")), F.lit("")))
    kind = T.concept_type(F.col("concept_type"))
    rows = concepts.withColumn("concept_type", kind).withColumn("key", F.when(name != "", F.struct(name.alias("n"), F.lit("").alias("own"))).otherwise(F.struct(F.lit("").alias("n"), F.col("concept_id").alias("own"))))
    pos = F.col("pos")
    filled = [first_non_empty(c, "pos").alias(c) for c in ("canonical_name", "surface", "summary")]
    lists = [union_in_order(F.col(c), pos).alias(c) for c in ("aliases", "observed_surfaces", "source_block_refs")]
    out = rows.groupBy("key", "concept_type").agg(F.min("pos").alias("pos"), F.min_by("concept_id", "pos").alias("concept_id"), *filled, *lists, union_in_order(F.array("concept_id"), pos).alias("merged_from"))
    return out.drop("key")


def equivalence_map(merged: DataFrame) -> DataFrame:
    """``old_id, new_id`` of the concepts that others stand for."""
    return merged.select(F.explode("merged_from").alias("old_id"), F.col("concept_id").alias("new_id")).where("old_id <> new_id")
