"""Registries: commits of several tables, deltas merged on read, writers that meet, crashes, folds and sweeps."""

from __future__ import annotations

import random
import threading

import pytest

from marginalia.operators import registry as R
from marginalia.sources import commits
from marginalia.sources.commits import Conflict, Registry, Transaction
from marginalia.streaming import units as U

ROW = "k string, n long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_deltas_equal_a_plain_dict(spark, tmp_path, monkeypatch):
    """Random batches of changed and deleted keys, null keys included, with folds in between, against a dict."""
    monkeypatch.setattr(commits, "MOST_DELTAS", 3)
    rng, want, store = random.Random(5), {}, Registry(spark, str(tmp_path))
    states = {}
    for turn in range(9):
        put = {(rng.choice(["a", "b", None]), rng.randrange(4)): f"v{turn}" for _ in range(3)}
        gone = [(rng.choice(["a", "b", None]), rng.randrange(6)) for _ in range(2)]

        def work(t, put=put, gone=gone):
            t.upsert("t", spark.createDataFrame([(*k, v) for k, v in put.items()], ROW), ["k", "n"])
            t.delete("t", spark.createDataFrame(gone, "k string, n long"), ["k", "n"])

        store.transact(work)
        want.update(put)
        for k in gone:
            want.pop(k, None)
        states[store.version()] = sorted(((*k, v) for k, v in want.items()), key=repr)
        assert rows(store.load("t")) == states[store.version()]
    some = spark.createDataFrame([("a", 1), (None, 2), (None, 2), ("z", 9)], "k string, n long")
    assert rows(Transaction(store).lookup("t", some)) == sorted(((*k, want[k]) for k in {("a", 1), (None, 2)} if k in want), key=repr)
    for n in (1, 4):
        assert rows(store.load("t", n)) == states[n]
    assert len(store.manifest(store.version())["tables"]["t"]["deltas"]) <= 3
    with pytest.raises(ValueError, match="keys"):
        store.transact(lambda t: t.upsert("t", spark.createDataFrame([("a", 1, "x")], ROW), ["k"]))


def test_a_base_in_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "BUCKET_ROWS", 50)
    store = Registry(spark, str(tmp_path))
    store.transact(lambda t: t.replace("t", spark.range(400).selectExpr("id", "id * 2 AS v"), ["id"]))
    store.transact(lambda t: t.upsert("t", spark.range(3).selectExpr("id", "-1L AS v"), ["id"]))
    assert store.manifest(2)["tables"]["t"]["base"]["buckets"] == 9 and store.manifest(2)["tables"]["t"]["deltas"][0]["rows"] == 3
    found = Transaction(store).lookup("t", spark.createDataFrame([(1,), (300,), (999,)], "id long"))
    assert rows(found) == [(1, -1), (300, 600)]
    assert "PartitionFilters: [isnotnull" in found._jdf.queryExecution().toString() or "__bucket" in found._jdf.queryExecution().toString()
    assert store.load("t").count() == 400 and store.load("t").where("v = -1").count() == 3


def test_a_crash_between_tables_leaves_the_old_registry(spark, tmp_path, monkeypatch):
    store = Registry(spark, str(tmp_path))
    one = spark.createDataFrame([("a", 1, "x")], ROW)
    store.transact(lambda t: (t.upsert("t", one, ["k"]), t.upsert("u", one, ["k"])))

    def half(t):
        t.upsert("t", spark.createDataFrame([("a", 2, "y")], ROW), ["k"])
        raise OSError("lost")

    with pytest.raises(OSError):
        store.transact(half)
    monkeypatch.setattr(Registry, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.transact(lambda t: t.upsert("u", spark.createDataFrame([("a", 2, "y")], ROW), ["k"]))
    monkeypatch.undo()
    assert store.version() == 1 and rows(store.load("t")) == rows(store.load("u")) == [("a", 1, "x")]
    left = store.sweep(older_than_ms=-60_000)
    assert len(left) >= 2 and rows(store.load("t")) == rows(store.load("u")) == [("a", 1, "x")] and store.sweep(older_than_ms=-60_000) == []


def test_of_two_writers_one_waits_and_nothing_is_lost(spark, tmp_path):
    store = Registry(spark, str(tmp_path))
    first, second = Transaction(store), Transaction(store)
    for t, k in ((first, "a"), (second, "b")):
        t.upsert("t", spark.createDataFrame([(k, 1, k)], ROW), ["k"])
    assert first.commit() == 1
    with pytest.raises(Conflict):
        second.commit()

    def add(name):
        for n in range(3):
            def work(t, n=n):
                have = t.load("t").where(f"k = '{name}'").count()
                t.upsert("t", spark.createDataFrame([(name, n, str(have))], ROW), ["k", "n"][:1])
            store.transact(work)

    threads = [threading.Thread(target=add, args=(x,)) for x in ("x", "y", "z")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert store.version() == 10 and rows(store.load("t")) == [("a", 1, "a"), ("x", 2, "1"), ("y", 2, "1"), ("z", 2, "1")]
    assert store.transact(lambda t: 5) == 5 and store.version() == 10


def test_progress_stays_and_rollback_names_old_files(spark, tmp_path):
    store = Registry(spark, str(tmp_path))
    assert store.progress("w") is None and store.load("t") is None and store.snapshots("t") == []

    def work(t):
        t.replace("t", spark.range(2))
        t.progress["w"] = 4

    store.transact(work)
    store.save("u", spark.range(1), "tagged")
    store.save("t", spark.range(5))
    assert store.progress("w") == 4 and store.snapshots("t") == [1, 3] and store.tag("u") == "tagged"
    assert store.rollback("t", 1) == 4 and store.load("t").count() == 2 and store.load("u").count() == 1
    with pytest.raises(ValueError, match="no snapshot 2"):
        store.load("t", 2)


def test_a_fold_equals_the_full_rewrite_and_writes_only_its_rows(spark, tmp_path):
    def concept(unit, k, surface, name=""):
        return (f"{unit}:{k}", surface, "person", name, f"{surface} in {unit}", [surface[:1]], [surface], [f"b{k}"], "source_grounded", unit)

    batches = [[concept(f"u{u}", k, f"S{(u * 3 + k) % 11}", f"N{(u * 3 + k) % 11}") for k in range(5)] for u in range(3)]
    store, plain = Registry(spark, str(tmp_path)), spark.createDataFrame([], U.CONCEPT)
    for n, batch in enumerate(batches, 1):
        units = spark.createDataFrame(batch, U.CONCEPT)
        operations, _ = R.checked(R.concept_operations(units, R.collisions(units, plain)), units, plain)
        mapping = R.id_map(units, operations, R.top_number(plain, "id") + 1)
        plain = spark.createDataFrame(R.apply_concepts(plain, units, mapping).select(*U.names(U.CONCEPT)).collect(), U.CONCEPT)
        U.fold_unit(store, units)
        assert rows(store.load("concepts")) == rows(plain)
        assert store.manifest(n)["tables"]["concepts"]["deltas"][-1]["rows"] == 5


def test_changes_that_come_late_or_twice_do_nothing(spark, tmp_path):
    """Changes in shuffled batches, as a stream with a batch that is made again, against a dict in order of the changes."""
    rng, schema = random.Random(8), "k long, seq long, op string, v string"
    changes = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([n, n, None]), rng.choice("IUUD"), f"v{n}") for n in range(60)]
    order = ["seq", "v"]
    last = {}
    for c in sorted(changes, key=lambda c: (c[1] is not None, c[1] or 0, c[3])):
        last[c[0]] = c
    want = sorted((c for c in last.values() if c[2] != "D"), key=repr)
    rng.shuffle(changes)
    for n in range(3):
        spark.createDataFrame(changes[n::3] + changes[:4], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    store = Registry(spark, f"{tmp_path}/registry")
    seen = []

    def work(t, batch):
        seen.append(U.apply_changes(t, "t", batch, ["k"], order, spark_op()).count())

    def spark_op():
        from pyspark.sql import functions as F

        return F.col("op") == "D"

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        query = U.follow_into(stream, store, f"{tmp_path}/{checkpoint}", "w", work)
        query.awaitTermination()

    run("one")
    assert rows(store.load("t")) == want and store.version() == 3 and store.progress("w") == 2 and len(seen) == 3
    run("two")  # the checkpoint is lost: all batches come again under their numbers
    assert rows(store.load("t")) == want and store.version() == 3 and len(seen) == 3
    empty = spark.createDataFrame([], schema)
    store.transact(lambda t: work(t, empty))
    assert rows(store.load("t")) == want and seen[-1] == 0
