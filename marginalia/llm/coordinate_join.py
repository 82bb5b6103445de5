"""Near duplicates: an inverted join over the coordinates of MinHash signatures, confirmed on the full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..operators.skew import salt, salted_join, with_least
from .ngram_join import _LINKS, _NO_ID, _UNIT, _blocks, _sets, _units, _verify, signatures
from .runtime import written

WORDS = 4
#: Least similarity, as a fraction.
LEAST = (4, 5)
RECALL = 0.99999
COORDINATES = 32
#: Signatures that a task compares at once, in a block.
BLOCK = 256
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fewest_matches(k: int = COORDINATES, least: float = LEAST[0] / LEAST[1], recall: float = RECALL) -> int:
    """The most matches of ``k`` coordinates that a pair of similarity ``least`` reaches with probability ``recall`` or more."""
    below, t = 0.0, 0
    while t < k:
        below += comb(k, t) * least**t * (1 - least) ** (k - t)
        if below > 1 - recall:
            break
        t += 1
    return max(t, 1)


def prefix_posts(posts: DataFrame, k: int, matches: int) -> DataFrame:
    """``id, key`` of the lists that must be read to find every pair with ``matches`` equal coordinates.

    ``posts`` has a row for each of a signature's ``k`` coordinate values. Lists are ordered by their length, over all documents; two signatures
    with so many equal values share one among the ``k - matches + 1`` shortest lists of each. The others, which are the long ones, are skipped:
    they are looked up in the signatures when a pair is counted. Lists of one row join nothing but take their place in the order;
    a signature with fewer shared values than ``matches`` can match none.
    """
    shared = with_least(posts, "key", "id", "least", more_than=1, by="id", count="length")
    lists = shared.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("length", "key"))).alias("lists"))  # k at most
    shortest = F.slice("lists", 1, F.size("lists") - matches + 1)
    return lists.where(F.size("lists") >= matches).select("id", F.explode(shortest).alias("l")).select("id", "l.key")


def _hubs(least: tuple[int, int]):
    """Compares the set of each hub, which comes first, to those dealt to it."""
    num, den = least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub = None, None
        for batch in batches:
            found = []
            hubs, pieces, ids, raw = (batch.column(c) for c in ("hub", "piece", "id", "hashes"))
            for h, p, i, x in zip(hubs.to_pylist(), pieces.to_pylist(), ids.to_pylist(), raw, strict=True):
                own = np.frombuffer(x.as_buffer(), "u8")
                if at != (h, p):
                    at, hub = (h, p), own.copy()
                    continue
                place = np.minimum(np.searchsorted(hub, own), len(hub) - 1)
                common = int((hub[place] == own).sum())
                if (den + num) * common >= num * (len(hub) + len(own)):
                    found.append((i, h))
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _collide(matches: int, least: tuple[int, int]):
    """The rows of each unit that have a partner there: in the other block where there are two, of another component, of a size that can
    reach the least similarity, and with enough equal coordinates."""
    num, den = least
    out = [*_UNIT, "side", "id"]

    def unit(key: tuple, side: list[int], ids: list[int], roots: list[int], sizes: list[int], values: list[list[int]]) -> pa.RecordBatch:
        v, root, size, of = np.array(values, "i8"), np.array(roots, "i8"), np.array(sizes, "i8"), np.array(side)
        equal = np.zeros((len(v), len(v)), "u2")
        for c in range(v.shape[1]):
            equal += v[:, c][:, None] == v[:, c][None, :]
        pair = (equal >= matches) & (root[:, None] != root[None, :]) & (den * np.minimum(size[:, None], size[None, :]) >= num * np.maximum(size[:, None], size[None, :]))
        if key[:2] != key[2:]:
            pair &= of[:, None] != of[None, :]
        some = np.flatnonzero(pair.any(axis=1))
        fixed = [pa.array([x] * len(some), pa.int64() if n in (0, 2) else pa.int32()) for n, x in enumerate(key)]
        return pa.RecordBatch.from_arrays([*fixed, pa.array(of[some], pa.int32()), pa.array(np.array(ids, "i8")[some])], out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, ([], [], [], [], [])
        for batch in batches:
            for *key, s, i, r, z, v in zip(*[batch.column(c).to_pylist() for c in (*_UNIT, "side", "id", "root", "size", "values")], strict=True):
                if now != tuple(key):
                    if now:
                        yield unit(now, *rows)
                    now, rows = tuple(key), ([], [], [], [], [])
                for have, x in zip(rows, (s, i, r, z, v), strict=True):
                    have.append(x)
        if now:
            yield unit(now, *rows)

    return run


def _sets_of(texts: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``id, hashes`` of the wanted classes, made again from the texts of their first rows; ids and texts meet by a sorted merge at any size."""
    some = texts.join(wanted.select(F.col("first_id").alias("w")).distinct().hint("merge"), "w", "left_semi")
    return _sets(some, n).dropDuplicates(["set_key"]).join(wanted.select("set_key", "id"), "set_key").select("id", "hashes")


def near_components(docs: DataFrame, n: int = WORDS, least: tuple[int, int] = LEAST, k: int = COORDINATES, recall: float = RECALL, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Rows (``doc_id, size, set_key, rid``) of ``docs`` and classes of equal sets (``set_key, id, first_id, group_id``).

    Classes are posted under their coordinate values and compared where they share a list of their prefixes: first with the least class of
    each list, which joins most groups, then, in lists that still hold several components, block by block with the classes of other
    components. A pair goes on only with enough equal coordinates, and is linked on its full sets. Classes inside a component are not
    compared again, so a group of many near copies costs its size and not its square.
    """
    num, den = least
    matches = fewest_matches(k, num / den, recall)
    lower = docs.select("doc_id", F.translate("text", _UPPER, _UPPER.lower()).alias("text"))
    sig = written(signatures(lower, n, k, 1).withColumn("rid", F.monotonically_increasing_id()), "coordinates")
    sig = sig.withColumn("ord_id", F.coalesce("doc_id", F.lit(_NO_ID)))
    key = F.when(F.col("size") > 0, F.col("set_key")).otherwise(F.encode(F.col("rid").cast("string"), "UTF-8"))  # without words a row is by itself
    sig = sig.withColumn("set_key", key)
    first = sig.groupBy("set_key").agg(F.min(F.struct("ord_id", "rid")).alias("f"), F.count("*").alias("n_copies"), F.max("size").alias("size"))
    classes = written(first.select("set_key", F.col("f.rid").alias("id"), F.col("f.ord_id").alias("first_id"), "n_copies", "size"), "classes")
    own = sig.join(classes.select(F.col("id").alias("rid")), "rid", "left_semi").where("size > 0").select(F.col("rid").alias("id"), "size", F.col("bands").alias("values"))
    lists = written(prefix_posts(own.select("id", F.explode("values").alias("key")), k, matches), "lists")
    near = written(with_least(lists, "key", "id", "a", more_than=1).select("id", "key", "a"), "candidates")
    some = near.select("id").distinct()
    own = written(own.join(some, "id", "left_semi"), "signatures")
    # The least class of each list against all others there.
    pairs = near.where("id != a").select("id", F.col("a").alias("hub")).distinct().join(own, "id")
    hubs = own.select(F.col("id").alias("hub"), F.col("size").alias("hub_size"), F.col("values").alias("hub_values"))
    pairs = salted_join(pairs, hubs, ["hub"], F.col("id"))
    pairs = pairs.where(den * F.least("size", "hub_size") >= num * F.greatest("size", "hub_size")).where(F.size(F.array_intersect("values", "hub_values")) >= matches)
    pairs = written(pairs.select("id", "hub", salt("id").alias("piece")), "hub_pairs")
    texts = lower.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("w"), "text")
    known = classes.join(some, "id", "left_semi").select("set_key", "id", "first_id")
    wanted = known.join(pairs.select(F.explode(F.array("id", "hub")).alias("id")).distinct(), "id", "left_semi")
    sets = written(_sets_of(texts, wanted, n), "sets")
    heads = pairs.select("hub", "piece").distinct().join(sets.withColumnRenamed("id", "hub"), "hub").select("hub", "piece", F.col("hub").alias("id"), "hashes")
    dealt = heads.unionByName(pairs.join(sets, "id").select("hub", "piece", "id", "hashes"))
    links = written(dealt.repartition("hub", "piece").sortWithinPartitions("hub", "piece", F.col("id") != F.col("hub")).mapInArrow(_hubs(least), "a long, b long"), "hub_links")
    roots = written(components(links).select(F.col("node").alias("id"), "root"), "hub_groups")
    # Lists that still hold several components.
    rooted = near.select("id", "key").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key")
    left = written(with_least(salted_join(near.select("id", "key"), mixed, ["key"], F.col("id")), "key", "id", "a").select("id", F.col("key").alias("band"), "a"), "mixed")
    member = _blocks(left, classes, block)
    rooted = own.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    units = _units(left, member).join(rooted, "id").select(*_UNIT, "side", "id", "root", "size", "values")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in units.schema if f.name in (*_UNIT, "side", "id"))
    met = units.repartition(*_UNIT).sortWithinPartitions(*_UNIT).mapInArrow(_collide(matches, least), types)
    met = written(met, "collided")
    wanted = known.join(met.select("id").distinct(), "id", "left_semi")
    units = met.join(_sets_of(texts, wanted, n), "id").select(*_UNIT, "side", "id", F.lit(1).cast("long").alias("copies"), "hashes")
    more = units.repartition(*_UNIT).sortWithinPartitions(*_UNIT).mapInArrow(_verify(least), _LINKS).select(F.col("id").alias("a"), F.col("parent").alias("b"))
    groups = components(links.unionByName(more)).select(F.col("node").alias("id"), "root")
    c = written(classes.join(groups, "id", "left").withColumn("root", F.coalesce("root", "id")), "linked_classes")
    group = c.groupBy("root").agg(F.min("first_id").alias("group_id"))
    c = salted_join(c, group, ["root"], F.col("id"))
    return sig.select("doc_id", "size", "set_key", "rid"), c.select("set_key", "id", "first_id", "group_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs`` (``doc_id``, ``text``).

    A text's set are its distinct four-word shingles, A to Z in lower case; of fewer words, their whole sequence. Two texts are linked when
    their sets' Jaccard similarity is 0.8 or more; ``component_id`` is the smallest ``doc_id`` that links reach, and its row is kept.
    Null, empty and blank texts have an empty set and no links. A null ``doc_id`` comes last and its ``kept`` is false where another id is
    reached, and where its component has no id its ``component_id`` is null and all its rows are kept; rows that repeat an id share it, and
    are kept together; an empty table gives none; other columns are ignored. A pair at the least similarity is missed with a
    probability below 0.00001. Shingles are compared by 64-bit hashes.
    """
    rows, classes = near_components(docs)
    out = salted_join(rows, classes, ["set_key"], F.col("rid"))
    component = F.when(F.col("group_id") != _NO_ID, F.col("group_id"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
