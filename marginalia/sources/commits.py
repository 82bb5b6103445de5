"""Registries: several tables under one folder that change together, kept as bases and deltas and merged when they are read."""

from __future__ import annotations

import json
import os
import random
import time
import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any, TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: Deltas of a table that readers merge at most, about; a commit that finds more folds them.
MOST_DELTAS = 12
#: Deltas become a new base once they have this share of its rows; until then they are folded among themselves.
SHARE_OF_BASE = 0.5
#: Rows of a bucket of a base, about.
BUCKET_ROWS = 1_000_000
MOST_BUCKETS = 4096
_ORDER, _GONE, _BUCKET = "__part", "__gone", "__bucket"


class Conflict(RuntimeError):
    """Another writer made the commit that this one was going to make."""


def _same(a: str, b: str, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class Transaction:
    """Changes to tables of a registry on top of one of its versions; none is seen before ``commit``, then all are.

    Rows go to files of their own at once, so what is committed is a short list of names. Data of a transaction that fails or loses stays
    behind unnamed; ``Registry.sweep`` deletes it.
    """

    def __init__(self, registry: Registry):
        self.registry, self.spark = registry, registry.spark
        self.base = registry.version()
        before = registry.manifest(self.base) if self.base else {"tables": {}, "progress": {}}
        self.tables: dict[str, Any] = before["tables"]
        self.progress: dict[str, int] = before["progress"]
        self.changed: set[str] = set()

    def load(self, table: str) -> DataFrame | None:
        """The table as it is with this transaction's own changes; none if it was never saved."""
        entry = self.tables.get(table)
        return None if entry is None else self.registry.merged(entry)

    def lookup(self, table: str, keys: DataFrame) -> DataFrame | None:
        """Rows of the table whose key is among ``keys`` (a small table of the key's columns): of a base only their buckets are read."""
        entry = self.tables.get(table)
        return None if entry is None else self.registry.merged(entry, keys)

    def _write(self, rows: DataFrame, keys: list[str] | None = None) -> dict[str, Any]:
        path = f"data/{uuid.uuid4().hex}"
        if keys is None:
            rows.write.parquet(f"{self.registry.folder}/{path}")
            return {"path": path, "rows": self.spark.read.schema(rows.schema).parquet(f"{self.registry.folder}/{path}").count()}  # from the footers
        flat = f"{self.registry.folder}/data/{uuid.uuid4().hex}"
        rows.write.parquet(flat)
        held = self.spark.read.schema(rows.schema).parquet(flat)
        n = held.count()
        buckets = min(MOST_BUCKETS, 1 + n // BUCKET_ROWS)
        if buckets == 1:
            return {"path": flat.removeprefix(self.registry.folder + "/"), "rows": n, "buckets": 1}
        held.withColumn(_BUCKET, _bucket(keys, buckets)).repartition(buckets, _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.registry.folder}/{path}")
        return {"path": path, "rows": n, "buckets": buckets}

    def replace(self, table: str, rows: DataFrame, keys: list[str] | None = None) -> None:
        """The whole table anew. Without ``keys`` it can only be replaced again; with them, rows must be one for each key."""
        self.tables[table] = {"keys": keys, "schema": json.loads(rows.schema.json()), "base": self._write(rows, keys), "deltas": []}
        self.changed.add(table)

    def upsert(self, table: str, rows: DataFrame, keys: list[str]) -> None:
        """Adds ``rows``, one for each of their keys, in place of those with the same keys. Null is a value of a key like others."""
        self._delta(table, rows.withColumn(_GONE, F.lit(False)), keys)

    def delete(self, table: str, rows: DataFrame, keys: list[str]) -> None:
        """Takes the rows with these keys out; keys that the table lacks are ignored."""
        entry = self.tables.get(table)
        if entry is None:
            return
        fields = self.registry.schema(entry).fields
        gone = rows.select(*keys).distinct()
        self._delta(table, gone.select(*[F.col(f.name) if f.name in keys else F.lit(None).cast(f.dataType).alias(f.name) for f in fields], F.lit(True).alias(_GONE)), keys)

    def _delta(self, table: str, rows: DataFrame, keys: list[str]) -> None:
        entry = self.tables.get(table)
        if entry is None:
            empty = rows.drop(_GONE).limit(0)
            self.replace(table, empty, keys)
            entry = self.tables[table]
        if entry["keys"] != keys:
            raise ValueError(f"{table} has the keys {entry['keys']}, not {keys}")
        part = self._write(rows.select(*self.registry.schema(entry).names, _GONE))
        self.tables[table] = entry | {"deltas": [*entry["deltas"], part]}
        self.changed.add(table)

    def fold(self, table: str) -> bool:
        """Folds a table's deltas, into a new base or, while they are few rows beside it, into one delta. Rows stay what they are.

        A base is written again only when the deltas have a fixed share of its rows, so over a table's life each row is written a number of
        times that grows with the logarithm of the rows, and a commit's own cost with its own rows.
        """
        entry = self.tables[table]
        if not entry["deltas"]:
            return False
        if sum(d["rows"] for d in entry["deltas"]) >= SHARE_OF_BASE * entry["base"]["rows"]:
            self.tables[table] = entry | {"base": self._write(self.registry.merged(entry), entry["keys"]), "deltas": []}
        elif len(entry["deltas"]) > 1:
            self.tables[table] = entry | {"deltas": [self._write(self.registry.newest(entry))]}
        else:
            return False
        self.changed.add(table)
        return True

    def commit(self, tag: str | None = None) -> int:
        """Makes the changes the registry's next version, all at once; ``Conflict`` if another writer made that version first."""
        for table in sorted(self.changed):
            if len(self.tables[table]["deltas"]) > MOST_DELTAS:
                self.fold(table)
        n = self.base + 1
        for table in self.changed:
            self.tables[table] = self.tables[table] | {"version": n, "tag": tag}
        if not self.registry.publish(n, {"tables": self.tables, "progress": self.progress}):
            raise Conflict(f"version {n} is another writer's")
        return n


class Registry:
    """Tables under a folder that change together: ``commits/n.json`` names the files that make up version n of every table.

    A version is put in place by creating its file where none is, so of two writers one wins; the other reads again and repeats its work
    (``transact``). A crash before that leaves the version before as it was. A table is a base and deltas of changed keys with marks for
    deleted ones; where there are no deltas a read is the base's scan, else the base without the deltas' keys and the newest row of each of these.
    Older versions stay readable until ``sweep``.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # Versions

    def _path(self, name: str) -> tuple[Any, Any]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        fs, path = self._path("commits")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int:
        return max(self.versions(), default=0)

    def manifest(self, version: int) -> dict[str, Any]:
        fs, path = self._path(f"commits/{version:012d}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, version: int, manifest: dict[str, Any]) -> bool:
        """Writes a version's file, whole or not at all; false if it is there already."""
        jvm = self.spark._jvm
        fs, path = self._path(f"commits/{version:012d}.json")
        _, draft = self._path(f"commits/.{uuid.uuid4().hex}.draft")
        fs.mkdirs(path.getParent())
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest, sort_keys=True, separators=(",", ":")).encode()))
        out.close()
        try:
            if fs.getScheme() == "file":
                # a rename on a local disk replaces what is there; a link does not
                os.link(draft.toUri().getPath(), path.toUri().getPath())
            else:
                if fs.exists(path):
                    return False
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
                none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
                context.rename(draft, path, none)
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        finally:
            fs.delete(draft, False)
        return True

    def transact(self, work: Callable[[Transaction], T], tag: str | None = None, tries: int = 20) -> T:
        """Commits what ``work`` does with a transaction; if another writer was first, does it anew on what that one left.

        A ``work`` that changes nothing makes no version.
        """
        for left in range(tries - 1, -1, -1):
            t = Transaction(self)
            before = dict(t.progress)
            result = work(t)
            if not t.changed and t.progress == before:
                return result
            try:
                t.commit(tag)
                return result
            except Conflict:
                if not left:
                    raise
                time.sleep(random.uniform(0, 0.2))
        raise AssertionError("tries must be positive")

    # Tables

    def schema(self, entry: dict[str, Any]):
        from pyspark.sql.types import StructType

        return StructType.fromJson(entry["schema"])

    def _part(self, entry: dict[str, Any], part: dict[str, Any], *more: str) -> DataFrame:
        schema = self.schema(entry)
        for column in more:
            schema = schema.add(column, "integer" if column == _BUCKET else "boolean")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{part['path']}")

    def newest(self, entry: dict[str, Any], keys: DataFrame | None = None) -> DataFrame:
        """The newest row of each key that the deltas hold, deleted ones with their mark."""
        names = self.schema(entry).names
        deltas = [self._part(entry, d, _GONE).withColumn(_ORDER, F.lit(k)) for k, d in enumerate(entry["deltas"])]
        rows = reduce(DataFrame.unionByName, deltas)
        if keys is not None:
            rows = rows.alias("a").join(keys.distinct().alias("b"), _same("a", "b", entry["keys"]), "left_semi")
        if len(deltas) == 1:
            return rows.drop(_ORDER)
        last = rows.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(entry["keys"])]).agg(F.max_by(F.struct(*names, _GONE), _ORDER).alias("r"))
        return last.select("r.*")

    def merged(self, entry: dict[str, Any], keys: DataFrame | None = None) -> DataFrame:
        """A table's rows; with ``keys``, those with these keys."""
        by, names = entry["keys"], self.schema(entry).names
        buckets = entry["base"].get("buckets", 1)
        base = self._part(entry, entry["base"], *([_BUCKET] if buckets > 1 else []))
        if keys is not None:
            if buckets > 1:
                wanted = [r["b"] for r in keys.select(_bucket(by, buckets).alias("b")).distinct().collect()]  # at most MOST_BUCKETS
                base = base.where(F.col(_BUCKET).isin(wanted))
            base = base.alias("a").join(keys.distinct().alias("b"), _same("a", "b", by), "left_semi")
        base = base.select(*names)
        if not entry["deltas"]:
            return base
        fresh = self.newest(entry, keys)
        old = base.alias("a").join(fresh.select(*by).alias("b"), _same("a", "b", by), "left_anti")
        return old.unionByName(fresh.where(~F.col(_GONE)).drop(_GONE))

    def snapshots(self, table: str) -> list[int]:
        """Versions that changed the table."""
        return [n for n in self.versions() if self.manifest(n)["tables"].get(table, {}).get("version") == n]

    def load(self, table: str, snapshot: int | None = None) -> DataFrame | None:
        """The table now, or at an older version that changed it; none if it was never saved."""
        if not (now := self.version()):
            return None
        if snapshot is not None and snapshot not in self.snapshots(table):
            raise ValueError(f"{table} has no snapshot {snapshot}")
        entry = self.manifest(snapshot or now)["tables"].get(table)
        return None if entry is None else self.merged(entry)

    def tag(self, table: str) -> str | None:
        """The tag of the version that last changed the table."""
        now = self.version()
        return self.manifest(now)["tables"].get(table, {}).get("tag") if now else None

    def progress(self, writer: str) -> int | None:
        """The last batch that a writer committed; it stays through other writers' versions."""
        now = self.version()
        return self.manifest(now)["progress"].get(writer) if now else None

    def save(self, table: str, rows: DataFrame, tag: str | None = None) -> int:
        """Replaces the whole table; gives the version."""
        self.transact(lambda t: t.replace(table, rows, (t.tables.get(table) or {}).get("keys")), tag)
        return self.snapshots(table)[-1]

    def rollback(self, table: str, snapshot: int) -> int:
        """Makes an older state of a table the present one, by name and without a copy; nothing is deleted."""
        if snapshot not in self.snapshots(table):
            raise ValueError(f"{table} has no snapshot {snapshot}")

        def work(t: Transaction) -> None:
            t.tables[table] = self.manifest(snapshot)["tables"][table]
            t.changed.add(table)

        self.transact(work)
        return self.snapshots(table)[-1]

    def sweep(self, older_than_ms: int, keep: int = 10) -> list[str]:
        """Deletes versions before the last ``keep``, then files that no version left names and that are older than ``older_than_ms``, longer than any
        transaction takes; gives the deleted names."""
        gone = self.versions()[:-keep] if keep else []
        named = {p["path"] for n in self.versions()[-keep:] for e in self.manifest(n)["tables"].values() for p in [e["base"], *e["deltas"]]}
        for n in gone:
            fs, path = self._path(f"commits/{n:012d}.json")
            fs.delete(path, False)
        fs, data = self._path("data")
        limit, out = 1000 * time.time() - older_than_ms, []
        for s in fs.listStatus(data) if fs.exists(data) else []:
            name = f"data/{s.getPath().getName()}"
            if name not in named and s.getModificationTime() < limit:
                fs.delete(s.getPath(), True)
                out.append(name)
        return out
