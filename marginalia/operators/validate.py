"""Checks that yield issue rows, the cleaned rows beside them, and deterministic repairs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..storage import ship
from .skew import in_pieces

#: Subjects that a report shows of a severity and code.
SAMPLES = 3


def issue(subject: Column, severity: str, code: str, path: Column, message: str) -> list[Column]:
    return [subject.cast("string").alias("subject_id"), F.lit(severity).alias("severity"), F.lit(code).alias("code"), path.cast("string").alias("path"), F.lit(message).alias("message")]


def unknown_refs(refs: DataFrame, ref: str, known: DataFrame, key: str) -> DataFrame:
    """Rows of ``refs`` whose ``ref`` is not among ``known``."""
    return refs.join(known.select(F.col(key).alias(ref)), ref, "left_anti")


def known_refs(refs: DataFrame, ref: str, known: DataFrame, key: str) -> DataFrame:
    """The other rows: the references once the unknown ones are stripped."""
    return refs.join(known.select(F.col(key).alias(ref)), ref, "left_semi")


def duplicate_ids(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``copy`` of each row among those with its id, in order; 1 is clean. Rows are sorted in pieces of bounded size."""
    return in_pieces(rows, rows.count(), *keys).withColumn("copy", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def deduplicated_id(ident: Column, copy: Column) -> Column:
    return F.when(copy > 1, F.concat(ident, F.lit("_dedup"), copy.cast("string"))).otherwise(ident)


def grounding_issues(rows: DataFrame, ident: str) -> DataFrame:
    """Rows (``grounding``, ``source_block_refs``) without block, unless inferred, or with a grounding that no vocabulary has."""
    g = F.coalesce("grounding", F.lit(""))
    missing = rows.where((F.size(F.coalesce("source_block_refs", F.array())) <= 0) & (g != "llm_inferred")).select(*issue(F.col(ident), "error", "missing_source_block_refs", F.lit("source_block_refs"), "no block is cited"))
    invalid = rows.where(~g.isin(*V.PROVENANCE)).select(*issue(F.col(ident), "error", "invalid_grounding", F.lit("provenance.grounding"), "unknown grounding"))
    return missing.unionByName(invalid)


def block_issues(blocks: DataFrame, units: DataFrame) -> DataFrame:
    """Blocks (``unit_id, block_id, start, end, text``) whose bounds, length or text do not fit their unit (``unit_id, text``)."""
    b = blocks.join(units.select("unit_id", F.col("text").alias("unit_text")), "unit_id", "left")
    size = F.col("end") - F.col("start")
    checks = [
        ((F.col("start") < 0) | (F.col("end") < F.col("start")), "invalid_source_block_range"),
        (size != F.length("text"), "source_block_range_length_mismatch"),
        (F.substring(F.col("unit_text"), (F.col("start") + 1).cast("int"), size.cast("int")) != F.col("text"), "source_block_round_trip_mismatch"),
        (~F.col("block_id").startswith("block-"), "legacy_source_block_id"),
    ]
    found = F.filter(F.array(*[F.when(bad, F.lit(code)) for bad, code in checks]), lambda x: x.isNotNull())
    rows = b.select("block_id", F.explode(found).alias("c"))
    return rows.select(F.col("block_id").alias("subject_id"), F.lit("error").alias("severity"), F.col("c").alias("code"), F.lit("source_blocks").alias("path"), F.lit("block does not fit its unit").alias("message"))


def edge_issues(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (``group_id, source, target, edge_type``) with both ends among their group's nodes (``group_id, node_id``), and issues of the others."""
    n = lambda c: nodes.select("group_id", F.col("node_id").alias(c)).distinct()
    clean = edges.join(n("source"), ["group_id", "source"], "left_semi").join(n("target"), ["group_id", "target"], "left_semi")
    bad = edges.join(n("source").withColumn("s", F.lit(1)), ["group_id", "source"], "left").join(n("target").withColumn("t", F.lit(1)), ["group_id", "target"], "left").where("s IS NULL OR t IS NULL")
    return clean, bad.select(*issue(F.col("group_id"), "warning", "unknown_ref", F.concat_ws("->", "source", "target"), "edge ends at no node"))


def delta_issues(operations: DataFrame, base_snapshot: str) -> DataFrame:
    """Operations (``delta_id, base_snapshot_id, operation_id, operation_type, auto``) on another snapshot, of unknown type, without or with a repeated
    id, or that would merge unasked."""
    copy = F.row_number().over(Window.partitionBy("delta_id", "operation_id").orderBy("operation_type"))
    rows = operations.withColumn("copy", copy)
    checks = [
        (F.col("base_snapshot_id") != base_snapshot, "base_snapshot_mismatch"),
        (F.coalesce("operation_id", F.lit("")) == "", "missing_operation_id"),
        ((F.coalesce("operation_id", F.lit("")) != "") & (F.col("copy") > 1), "duplicate_operation_id"),
        (~F.coalesce("operation_type", F.lit("")).isin(*V.DELTA_OPERATIONS), "unsupported_delta_operation"),
        ((F.col("operation_type") == "merge_proposal") & F.col("auto"), "destructive_auto_merge"),
    ]
    found = F.filter(F.array(*[F.when(bad, F.lit(code)) for bad, code in checks]), lambda x: x.isNotNull())
    return rows.select("delta_id", "operation_id", F.explode(found).alias("code"))


def _first_subjects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each severity and code of a task the number of issues and the first subjects."""
    held: dict[tuple, tuple[int, list[str]]] = {}
    for batch in batches:
        same = lambda c, x: pc.is_null(batch.column(c)) if x is None else pc.equal(batch.column(c), x)  # noqa: B023, E731
        for row in pa.Table.from_batches([batch]).group_by(["severity", "code"]).aggregate([([], "count_all")]).to_pylist():
            key = row["severity"], row["code"]
            subjects = batch.column("subject_id").filter(pc.and_(same("severity", key[0]), same("code", key[1]))).drop_null().unique()
            first = subjects.take(pc.bottom_k_unstable(subjects, SAMPLES)).to_pylist()
            n, before = held.get(key, (0, []))
            held[key] = n + row["count_all"], sorted({*before, *first})[:SAMPLES]
    if held:
        columns = [[k[0] for k in held], [k[1] for k in held], [n for n, _ in held.values()], [x for _, x in held.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string())), strict=True)], ["severity", "code", "n", "first"])


def report(issues: DataFrame) -> DataFrame:
    """Issues by severity and code with three sample subjects, the first in order; a task hands on its counts and first subjects only."""
    ship(issues.sparkSession)
    parts = issues.select("severity", "code", "subject_id").mapInArrow(_first_subjects, "severity string, code string, n long, first array<string>")
    first = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("first")))), 1, SAMPLES)
    return parts.groupBy("severity", "code").agg(F.sum("n").alias("n_issues"), F.array_join(first, ",").alias("samples"))


def passed(issues: DataFrame) -> DataFrame:
    e, w = (F.sum((F.col("severity") == s).cast("long")) for s in ("error", "warning"))
    return issues.agg(F.coalesce(e, F.lit(0)).alias("n_errors"), F.coalesce(w, F.lit(0)).alias("n_warnings")).withColumn("passed", F.col("n_errors") == 0)


def inherited_refs(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Block references of merged rows that have none, from the rows they were merged from.

    ``rows``: ``id, merged_from, source_block_refs``; ``members``: ``id, source_block_refs``.
    """
    empty = rows.where(F.size("source_block_refs") <= 0).select("id", F.posexplode("merged_from").alias("p", "m"))
    m = members.select(F.col("id").alias("m"), F.col("source_block_refs").alias("r"))
    got = empty.join(m, "m").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("p", "r"))).alias("x")).select("id", F.array_distinct(F.flatten(F.transform("x", lambda v: v["r"]))).alias("got"))
    return rows.join(got, "id", "left").withColumn("source_block_refs", F.coalesce("got", "source_block_refs")).drop("got")
