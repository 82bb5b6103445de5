"""Records of earlier units: scoped ids, first-seen merges, snapshots and the context that a unit is read with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Lists of an older package, the id of their records, and what kind of record they hold.
LEGACY = {"entity_records": ("entity_id", "entity"), "location_records": ("location_id", "location"), "thread_records": ("thread_id", "thread"), "event_records": ("event_id", "event")}
_FIELDS = "name string, canonical_name string, surfaces array<string>, status string, refs array<string>"


def legacy_records(spark: SparkSession, path: str) -> DataFrame:
    """``unit_id, kind, pos, local_id, name, surfaces, status, refs`` of the records in JSON packages under ``path``, one package a file; a package may
    hold its data under ``data``. Files that are no JSON give none."""
    lists = ", ".join(f"{c} array<struct<{i}:string,{_FIELDS.replace(' ', ':')}>>".replace(",:", ",") for c, (i, _) in LEGACY.items())
    files = spark.read.option("wholetext", True).text(path)
    packages = files.select(F.from_json("value", f"unit_id string, data struct<unit_id:string,{lists.replace(' array', ':array').replace(', ', ',')}>, {lists}").alias("p"))
    parts = []
    for column, (ident, kind) in LEGACY.items():
        rows = packages.select(F.coalesce("p.unit_id", "p.data.unit_id").alias("unit_id"), F.posexplode(F.coalesce(f"p.data.{column}", f"p.{column}")).alias("pos", "r"))
        name = F.coalesce(F.nullif("r.canonical_name", F.lit("")), F.nullif("r.name", F.lit("")), F.get("r.surfaces", F.lit(0)))
        none = F.array().cast("array<string>")
        parts.append(rows.select("unit_id", F.lit(kind).alias("kind"), "pos", F.col(f"r.{ident}").alias("local_id"), name.alias("name"), F.coalesce("r.surfaces", none).alias("surfaces"), F.coalesce("r.status", F.lit("")).alias("status"), F.coalesce("r.refs", none).alias("refs")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def scoped(unit: Column, ident: Column) -> Column:
    return F.concat_ws(":", unit, ident)


def merged_records(records: DataFrame, kind: str) -> DataFrame:
    """Records (``unit_id, local_id, name, refs``) of all units under scoped ids, the first of each kept, their references scoped too."""
    first = Window.partitionBy("unit_id", "local_id").orderBy("pos")
    rows = records.withColumn("rn", F.row_number().over(first)).where("rn = 1")
    return rows.select(scoped(F.col("unit_id"), F.col("local_id")).alias("record_id"), F.lit(kind).alias("kind"), "unit_id", "name", F.transform("refs", lambda r: F.concat_ws(":", F.col("unit_id"), r)).alias("refs"))


def snapshot_id(records: DataFrame) -> DataFrame:
    """One row: how many records there are and a name made of their hashes, the same for the same records."""
    h = records.select(F.xxhash64(*records.columns).alias("a"), F.xxhash64(F.lit(1), *records.columns).alias("b"))
    return h.agg(F.count("*").alias("n_records"), F.concat(F.lit("snapshot-"), F.hex(F.bit_xor("a")), F.hex(F.bit_xor("b"))).alias("snapshot_id"))


def context_pack(matches: DataFrame, records: DataFrame, threads: DataFrame, most_threads: int = 20) -> DataFrame:
    """For each unit the records that its text names, most often named first, and the open threads before the resolved ones.

    ``matches``: ``unit_id, record_id``; ``records``: ``record_id, name, kind``; ``threads``: ``record_id, name, status``.
    """
    named = matches.groupBy("unit_id", "record_id").agg(F.count("*").alias("n")).join(records, "record_id", "left")
    item = F.struct((-F.col("n")).alias("o"), "record_id", "name", "kind", "n")
    packs = named.groupBy("unit_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.dropFields("o")).alias("records"))
    order = [F.col("status") == "resolved", F.col("record_id")]
    top = threads.orderBy(*order).limit(most_threads).agg(F.array_sort(F.collect_list(F.struct((F.col("status") == "resolved").alias("done"), "record_id", "name"))).alias("threads"))
    return packs.crossJoin(F.broadcast(top))  # one row


def selection_report(matches: DataFrame, surfaces: DataFrame) -> DataFrame:
    """Surfaces by whether a text names them, and how many are too short to be sure of."""
    hit = surfaces.join(matches.select("record_id").distinct().withColumn("hit", F.lit(True)), "record_id", "left")
    return hit.groupBy(F.coalesce("hit", F.lit(False)).alias("matched")).agg(F.count("*").alias("n_surfaces"), F.count_if(F.length("surface") < 3).alias("n_short"))


def passive_pack(records: DataFrame, most: int = 200, most_threads: int = 20) -> DataFrame:
    """One row: the first records of a registry by id and its open threads before the resolved ones, without a text to choose by.

    ``records``: ``record_id, name, kind, status``.
    """
    entities = records.where("kind <> 'thread'").orderBy("record_id").limit(most).agg(F.array_sort(F.collect_list(F.struct("record_id", "name", "kind"))).alias("records"))
    done = F.col("status") == "resolved"
    threads = records.where("kind = 'thread'").orderBy(done, "record_id").limit(most_threads).agg(F.array_sort(F.collect_list(F.struct(done.alias("done"), "record_id", "name"))).alias("threads"))
    return entities.crossJoin(F.broadcast(threads))  # a row each


def save_context(folder: str, **tables: DataFrame) -> None:
    """Writes the parts of a context (records, scan, selection, pack) as JSON lines under their names."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").json(f"{folder.rstrip('/')}/{name}")
