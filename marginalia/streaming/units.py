"""Units that arrive over time, folded into a registry; and windows over events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import registry as R
from ..sources.commits import Registry, Transaction
from ..storage import written

CONCEPT = "id string, surface string, concept_type string, canonical_name string, summary string, aliases array<string>, observed_surfaces array<string>, source_block_refs array<string>, grounding string, source_unit string"


ITEM = "item_id string, item_type string, summary string, source_block_refs array<string>, concept_refs array<string>, source_unit string"
GROUP = "group_id string, group_type string, summary string, concept_refs array<string>, item_refs array<string>, continuation string, registry_group_ref string, source_unit string"
UNRESOLVED = "unit_id string, kind string, ref string, detail string"


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _held(t: Transaction, table: str, schema: str) -> DataFrame:
    rows = t.load(table)
    return t.spark.createDataFrame([], schema) if rows is None else rows


def fold_concepts(t: Transaction, units: DataFrame, links: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Folds a batch of concepts into the registry of a transaction; gives the operations and the map of ids.

    ``links`` (``unit_ref, book_ref``) come before matches by name. Merges that the registry refuses make new concepts and unresolved rows.
    What is written are the concepts that the batch makes or changes and its unresolved rows.
    """
    registry = _held(t, "concepts", CONCEPT)
    operations, refused = R.checked(R.concept_operations(units, R.collisions(units, registry), links), units, registry)
    operations, refused = written(operations, "operations"), written(refused, "refused")
    mapping = written(R.id_map(units, operations, R.top_number(registry, "id") + 1), "id_map")
    changed = mapping.select(F.col("new_id").alias("id")).distinct()
    touched = t.lookup("concepts", changed)
    after = R.apply_concepts(registry.limit(0) if touched is None else touched, units, mapping)
    unit_of = written(units.select(F.col("id").alias("unit_ref"), F.coalesce("source_unit", F.lit("")).alias("unit_id")).distinct(), "unit_of")
    nobody = t.spark.createDataFrame([], "unit_id string, item_id string, summary string")
    open_ = operations.where("op_type = 'ambiguity'").join(unit_of, "unit_ref", "left").select(F.coalesce("unit_id", F.lit("")).alias("unit_id"), "unit_ref", "book_ref", "match_reason")
    new = R.unresolved_rows(nobody, open_, refused.join(unit_of, "unit_ref", "left").withColumn("unit_id", F.coalesce("unit_id", F.lit(""))))
    t.upsert("unresolved", new.select(*names(UNRESOLVED)).distinct(), names(UNRESOLVED))
    t.upsert("concepts", after.select(*names(CONCEPT)), ["id"])
    return operations, mapping


def fold_records(t: Transaction, items: DataFrame, groups: DataFrame, proposals: DataFrame, concepts: DataFrame) -> DataFrame:
    """Adds a unit's items and groups under the registry's ids, with its concepts (``concepts``: the map of their ids) and what its groups continue
    (``group_id, proposal_type, registry_group_ref``); gives the groups' operations."""
    operations = written(R.group_operations(groups, proposals), "group_operations")
    new_items, ids = R.add_items(items, concepts, R.top_number(_held(t, "items", ITEM), "item_id") + 1)
    ids = written(ids, "item_ids")
    new_groups = R.add_groups(groups, operations, concepts, ids, R.top_number(_held(t, "groups", GROUP), "group_id") + 1)
    t.upsert("items", new_items.select(*names(ITEM)), ["item_id"])
    t.upsert("groups", new_groups.select(*names(GROUP)), ["group_id"])
    return operations


def fold_unit(store: Registry, units: DataFrame, links: DataFrame | None = None, tag: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``fold_concepts`` as a commit of its own."""
    return store.transact(lambda t: fold_concepts(t, units, links), tag)


def apply_changes(t: Transaction, table: str, changes: DataFrame, keys: list[str], order: list[str], gone: Column) -> DataFrame:
    """Folds changes of keyed rows into a table, in which the newest change of a key by ``order`` wins, whatever order batches come in; ``gone``
    says which changes delete. Gives the changes that took effect.

    The order of each key's last change is kept in ``<table>_order`` and committed with the table, also for deleted keys, so late and repeated
    changes do nothing. Null keys are keys, a null in ``order`` comes first; rows alike in ``order`` are ranked by all their columns.
    """
    columns, last = changes.columns, f"{table}_order"
    ranked = changes.withColumn("__gone", F.coalesce(gone, F.lit(False)))
    newest = ranked.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max_by(F.struct(*columns, "__gone"), F.struct(*order, *[c for c in columns if c not in order])).alias("r")).select("r.*")
    newest = written(newest, "newest")
    held = t.lookup(last, newest.select(*keys))
    if held is not None:
        h = held.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)], F.struct(*order).alias("__held"))
        same = F.lit(True)
        for i, k in enumerate(keys):
            same &= F.col(k).eqNullSafe(F.col(f"__h{i}"))
        newest = written(newest.join(h, same, "left").where(F.col("__held").isNull() | (F.struct(*order) > F.col("__held"))).select(*columns, "__gone"), "newer")
    t.upsert(last, newest.select(*dict.fromkeys([*keys, *order])), keys)
    t.upsert(table, newest.where("NOT __gone").select(*columns), keys)
    t.delete(table, newest.where("__gone").select(*keys), keys)
    return newest


def follow_into(rows: DataFrame, store: Registry, checkpoint: str, writer: str, work: Callable[[Transaction, DataFrame], object]) -> StreamingQuery:
    """Folds a stream into a registry in micro-batches by ``work``. The commit of a batch carries its number under the writer's name, so a
    batch that is repeated after a failure is folded once, whatever other writers commit in between. Streams with checkpoints of their own
    need names of their own."""

    def fold(batch: DataFrame, number: int) -> None:
        def once(t: Transaction) -> None:
            if t.progress.get(writer, -1) < number:
                work(t, batch)
                t.progress[writer] = number

        store.transact(once)

    return rows.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow(spark: SparkSession, incoming: str, folder: str, checkpoint: str, writer: str = "follow") -> StreamingQuery:
    """Folds each new file of concepts under ``incoming`` into the registry in ``folder``, in micro-batches."""
    return follow_into(spark.readStream.schema(CONCEPT).parquet(incoming), Registry(spark, folder), checkpoint, writer, fold_concepts)


def tumbling(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events (``ts, event_type, value``) by window and type; runs on batches and on streams."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n_events"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("window_start"), "event_type", "n_events", F.round("total", 4).alias("total"))


def sliding(events: DataFrame, width: str = "2 days", step: str = "1 day") -> DataFrame:
    w = events.groupBy(F.window("ts", width, step)).agg(F.count("*").alias("n_events"), F.countDistinct("user_id").alias("n_users"))
    return w.select(F.col("window.start").alias("window_start"), "n_events", "n_users")


def sessions(events: DataFrame, gap: str = "6 hours") -> DataFrame:
    w = events.groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n_events"))
    return w.select("user_id", F.col("session_window.start").alias("session_start"), "n_events")


def incremental_counts(events: DataFrame, unit: str, key: str) -> DataFrame:
    """What a fold over units in order would find: for each unit how many keys it brings and how many of these are new."""
    first = Window.partitionBy(key).orderBy(unit)
    seen = events.select(unit, key).distinct().withColumn("new", (F.row_number().over(first) == 1).cast("long"))
    return seen.groupBy(unit).agg(F.count("*").alias("n_keys"), F.sum("new").alias("n_new"))
