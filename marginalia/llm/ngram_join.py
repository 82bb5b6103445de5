"""Near duplicates: an n-gram Jaccard join by MinHash banding, verified on the full n-gram sets."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..operators.skew import salted_join, with_least
from .exact_dedup import without_losers
from .runtime import written
from .segments import blocks

WORDS = 5
#: Least similarity, as a fraction.
LEAST = (4, 5)
RECALL = 0.99999
MOST_HASHES = 256
#: Sets of a block, and hashes in all of its sets, about; two blocks at a time are compared in memory.
BLOCK, BLOCK_HASHES = 256, 1 << 20
#: Steps over bands from a set to its home.
HOPS = 3
_NO_ID = (1 << 63) - 1
_SEED = 20240607
_COLUMNS = 4096
_REMEMBERED = 300_000
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def choose_bands(least: float = LEAST[0] / LEAST[1], recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows a band: the most rows for which, within ``most`` hashes, a pair of similarity ``least`` shares a band with
    probability ``recall`` or more. More rows make chance candidates rarer."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - least)) if least < 1 else 1, 1)
    for rows in range(2, most + 1):
        p = least**rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-p))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """64-bit hashes of the distinct word n-grams of texts, sorted. A text of fewer words has one n-gram, of all its words."""

    def __init__(self, n: int):
        import xxhash

        self.n, self.hash, self.known = n, xxhash.xxh3_64_intdigest, {}

    def _words(self, text: str) -> np.ndarray:
        words = [w for w in _SPACE.split(text) if w]
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), "u8", len(words))
        except KeyError:
            if len(known) > _REMEMBERED:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = self.hash(w.encode())
            return np.fromiter(map(known.__getitem__, words), "u8", len(words))

    def __call__(self, text: str) -> np.ndarray:
        w = self._words(text)
        if not len(w):
            return w
        n = min(self.n, len(w))
        h = np.full(len(w) - n + 1, n, "u8")
        with np.errstate(over="ignore"):
            for k in range(n):
                h = (h ^ w[k : len(w) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
        return np.unique(_mix(h))


class MinHash:
    """Band keys of a set of hashes."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(_SEED)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 63, bands * rows, dtype="u8")[:, None] * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, dtype="u8")[:, None]

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), np.iinfo("u8").max, "u8")
        with np.errstate(over="ignore"):
            for x in range(0, len(hashes), 2048):
                np.minimum(low, (self.a * hashes[None, x : x + 2048] + self.b).min(axis=1), out=low)
            key = np.arange(self.bands, dtype="u8")
            for r in range(self.rows):
                key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + low[r :: self.rows][: self.bands])
        return key.view("i8")


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, text_key, set_key, size, bands`` of each row: the key of its n-gram set, the set's size and its band keys (none for a text
    without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingle, minhash = Shingler(n), MinHash(bands, rows)
        for batch in batches:
            at = 0
            for block in blocks(batch.column("text")):
                sets = [shingle(t) for t in block]
                keys = [minhash.keys(s) if len(s) else s.view("i8") for s in sets]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate(keys)))
                part = batch.slice(at, len(block))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), lists], ["doc_id", "text_key", "set_key", "size", "bands"])
                at += len(block)

    source = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return source.mapInArrow(run, "doc_id long, text_key long, set_key binary, size long, bands array<long>")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingle = Shingler(n)
        for batch in batches:
            for block in blocks(batch.column("text")):
                raw = [shingle(t).tobytes() for t in block]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(x) for x in raw], pa.binary()), pa.array(raw, pa.binary())], ["set_key", "hashes"])

    return docs.select("text").mapInArrow(run, "set_key binary, hashes binary")


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many hashes each two sets share: a product of their incidence matrix with itself, some thousand hashes at a time."""
    m = len(sets)
    of = np.repeat(np.arange(m), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1
    number = np.cumsum(often) - 1
    keep = often[column]
    of, column = of[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    out = np.zeros((m, m), "f4")
    for x in range(0, int(often.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [x, x + _COLUMNS])
        part = np.zeros((m, _COLUMNS), "f4")
        part[of[a:b], column[a:b] - x] = 1
        out += part @ part.T
    out[np.arange(m), np.arange(m)] = [len(s) for s in sets]
    return out


#: A unit of comparison: two blocks, or one with itself.
_UNIT = ("h1", "b1", "h2", "b2")
_LINKS = "id long, text_links long, doc_links long, parent long"


def _verify(least: tuple[int, int]):
    num, den = least

    def unit(two: bool, side: list[int], ids: list[int], copies: list[int], raw: list[bytes]) -> pa.RecordBatch:
        sets = [np.frombuffer(x, "u8") for x in raw]
        size = np.array([len(s) for s in sets], "f8")
        common = shared(sets).astype("f8")
        linked = (den + num) * common >= num * (size[:, None] + size[None, :])
        np.fill_diagonal(linked, False)
        if two:
            of = np.array(side)
            linked &= of[:, None] != of[None, :]
        weight = np.array(copies, "i8")
        root = np.array(ids, "i8")
        while True:  # the smallest id that links reach, inside this unit
            new = np.minimum(root, np.where(linked, root[None, :], np.iinfo("i8").max).min(axis=1))
            if (new == root).all():
                break
            root = new
        some = linked.any(axis=1)
        arrays = [np.array(ids, "i8")[some], linked.sum(axis=1)[some].astype("i8"), (linked @ weight)[some], root[some]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["id", "text_links", "doc_links", "parent"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, ([], [], [], [])
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*_UNIT, "side", "id", "copies", "hashes")]
            for h1, b1, h2, b2, *row in zip(*columns, strict=True):
                if now != (h1, b1, h2, b2):
                    if now:
                        yield unit(now[:2] != now[2:], *rows)
                    now, rows = (h1, b1, h2, b2), ([], [], [], [])
                for have, x in zip(rows, row, strict=True):
                    have.append(x)
        if now:
            yield unit(now[:2] != now[2:], *rows)

    return run


def _blocks(near: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """``id, home, block, in_block, set_key, first_id, copies`` of the classes that share a band with another.

    A class's home is the smallest id that ``HOPS`` steps over bands reach, so sets that are all alike have one home, and a long chain of
    sets has many, each near its own sets. The classes of a home are dealt to blocks of bounded size.
    """
    home = near.groupBy("id").agg(F.min("a").alias("home"))
    for _ in range(1, HOPS):
        reached = with_least(near.select("id", "band").join(home, "id"), "band", "home", "least", by="id")
        home = written(reached.groupBy("id").agg(F.min("least").alias("home")), "homes")
    member = home.join(classes, "id").select("id", "home", "set_key", "first_id", F.col("n_copies").alias("copies"), "size")
    sizes = member.groupBy("home").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("size") / BLOCK_HASHES)).cast("int").alias("n_blocks"))
    dealt = salted_join(member, sizes, ["home"], F.col("id")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
    dealt = written(dealt.drop("n_blocks"), "blocked")
    counts = dealt.groupBy("home", "block").agg(F.count("*").alias("in_block"))
    return written(dealt.join(counts, ["home", "block"]), "members")


def _units(near: DataFrame, member: DataFrame) -> DataFrame:
    """``h1, b1, h2, b2, side, id``: for each two blocks that share a band, the classes of both; and each block of two or more by itself.
    A pair of classes that share a band lies in one unit."""
    cells = near.join(member.select("id", "home", "block"), "id").select("band", "home", "block").distinct()
    several = cells.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    cells = written(cells.join(several, "band"), "cells")
    a, b = (cells.select("band", F.col("home").alias(f"h{k}"), F.col("block").alias(f"b{k}")) for k in (1, 2))
    pairs = a.join(b, "band").where((F.col("h1") < F.col("h2")) | ((F.col("h1") == F.col("h2")) & (F.col("b1") < F.col("b2")))).select(*_UNIT).distinct()
    pairs = written(pairs, "block_pairs")
    ends = pairs.select(*_UNIT, F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("h1").alias("home"), F.col("b1").alias("block")), F.struct(F.lit(1).alias("side"), F.col("h2").alias("home"), F.col("b2").alias("block")))).alias("e")).select(*_UNIT, "e.*")
    two = member.join(ends, ["home", "block"]).select(*_UNIT, "side", "id")
    own = member.where("in_block > 1").select(F.col("home").alias("h1"), F.col("block").alias("b1"), F.col("home").alias("h2"), F.col("block").alias("b2"), F.lit(0).alias("side"), "id")
    return own.unionByName(two)


def near_classes(docs: DataFrame, n: int = WORDS, least: tuple[int, int] = LEAST, recall: float = RECALL, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Rows and classes of ``docs`` (``doc_id``, ``text``).

    Rows: ``doc_id, text_key, set_key, size, rid, ord_id``. Classes, one for each n-gram set: ``set_key, id, n_copies, first_id,
    n_links, n_linked_docs, group_id, group_rid``. ``group_id`` and ``group_rid`` are of the first row of all that links join.

    Classes that share a band are verified on their full sets, block by block: sets are copied only to blocks with which theirs shares
    a band, and each pair is compared once.
    """
    bands, rows = choose_bands(least[0] / least[1], recall)
    sig = written(signatures(docs, n, bands, rows).withColumn("rid", F.monotonically_increasing_id()), "signatures")
    sig = sig.withColumn("ord_id", F.coalesce("doc_id", F.lit(_NO_ID)))
    # Rows with the same set are one class; a text without words is a class by itself.
    key = F.when(F.col("size") > 0, F.col("set_key")).otherwise(F.encode(F.col("rid").cast("string"), "UTF-8"))
    sig = sig.withColumn("set_key", key)
    first = sig.groupBy("set_key").agg(F.min(F.struct("ord_id", "rid")).alias("f"), F.count("*").alias("n_copies"), F.max("size").alias("size"))
    classes = written(first.select("set_key", F.col("f.rid").alias("id"), F.col("f.ord_id").alias("first_id"), "n_copies", "size"), "classes")
    banded = sig.join(classes.select(F.col("id").alias("rid")), "rid", "left_semi").select(F.col("rid").alias("id"), F.explode("bands").alias("band"))
    near = written(with_least(banded, "band", "id", "a", more_than=1).select("id", "band", "a"), "candidates")
    member = _blocks(near, classes, block)
    # The sets of these classes are made again from their texts: only these are shuffled.
    wanted = member.select(F.col("first_id").alias("w")).distinct()
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("w"), "text").join(wanted, "w", "left_semi")
    sets = _sets(texts, n).dropDuplicates(["set_key"]).join(member.select("set_key", "id", "copies"), "set_key")
    units = _units(near, member).join(sets, "id").select(*_UNIT, "side", "id", "copies", "hashes")
    links = units.repartition(*_UNIT).sortWithinPartitions(*_UNIT).mapInArrow(_verify(least), _LINKS)
    links = written(links, "links")
    counts = links.groupBy("id").agg(F.sum("text_links").alias("n_links"), F.sum("doc_links").alias("d"))
    groups = components(links.select(F.col("id").alias("a"), F.col("parent").alias("b"))).select(F.col("node").alias("id"), "root")
    c = classes.join(counts, "id", "left").join(groups, "id", "left").withColumn("root", F.coalesce("root", "id"))
    c = written(c, "linked_classes")
    group = c.groupBy("root").agg(F.min(F.struct(F.col("first_id").alias("o"), F.col("id").alias("r"))).alias("g"))
    c = salted_join(c, group, ["root"], F.col("id"))
    out = c.select("set_key", "id", "n_copies", "first_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), (F.coalesce("d", F.lit(0)) + F.col("n_copies") - 1).alias("n_linked_docs"), F.col("g.o").alias("group_id"), F.col("g.r").alias("group_rid"))
    return sig.select("doc_id", "text_key", "set_key", "size", "rid", "ord_id"), out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, text_class_id, n_copies, n_links, n_linked_docs, kept`` of each row of ``docs`` (``doc_id``, ``text``).

    Two texts are linked when the Jaccard similarity of their sets of five-word n-grams is 0.8 or more. ``class_id`` is the smallest
    ``doc_id`` that links reach, ``text_class_id`` the smallest with the same set, of which there are ``n_copies``; ``n_links`` counts the
    different sets linked, ``n_linked_docs`` the other rows. One row of each class is kept. Texts of fewer words have one n-gram;
    null, empty and blank texts have none and no links. Null ids come last; rows may repeat; an empty table gives none; other
    columns are ignored. A pair at the least similarity is missed with a probability below 0.00001.
    """
    rows, classes = near_classes(docs)
    out = salted_join(rows, classes, ["set_key"], F.col("rid"))
    known = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return out.select("doc_id", known("group_id").alias("class_id"), known("first_id").alias("text_class_id"), "n_copies", "n_links", "n_linked_docs", (F.col("rid") == F.col("group_rid")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The first row of each class that ``near_duplicates`` finds in ``docs``, with all its columns. Of rows that repeat an id and a
    text any one stays."""
    rows, classes = near_classes(docs)
    rows = salted_join(rows, classes.select("set_key", "group_rid"), ["set_key"], F.col("rid"))
    return without_losers(docs, rows.select("ord_id", "text_key", (F.col("rid") == F.col("group_rid")).alias("kept")), F.xxhash64("text"))
