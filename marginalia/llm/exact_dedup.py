"""Exact duplicates through a minimal perfect hash over the digests of an older delivery."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import salted_join
from .runtime import SPACE, parts_for, written

#: Distinct digests of a bucket, about.
BUCKET_KEYS = 4096
LEAST_BUCKETS = 256
#: Digests that share a displacement, on average.
KEYS_PER_PILOT = 4
_TRIES = 64
_NO_ID = (1 << 63) - 1


def digest(text: Column) -> Column:
    """SHA-256 of a text whose runs of white space became one space each; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ").cast("binary"), 256))


class PerfectHash:
    """A minimal perfect hash of n distinct 32-byte digests: n slots, one pilot for each few digests.

    Digests are dealt to pilots by one word of the digest; a pilot is the first displacement that sends all of its
    digests to free slots. Pilots with most digests choose first.
    """

    def __init__(self, n: int, pilots: np.ndarray):
        self.n, self.pilots = n, pilots

    @staticmethod
    def _words(digests: np.ndarray) -> np.ndarray:
        return digests.view("<u8").reshape(-1, 4)

    @staticmethod
    def _mix(a: np.ndarray, b: np.ndarray, pilot: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = a ^ (b * (2 * pilot.astype("u8") + 1))
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            return x ^ (x >> np.uint64(32))

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        n = len(digests)
        w = cls._words(digests)
        groups = max(1, -(-n // KEYS_PER_PILOT))
        of = (w[:, 1] % np.uint64(groups)).astype("i8")
        order = np.argsort(of, kind="stable")
        counts = np.bincount(of, minlength=groups)
        starts = np.concatenate([[0], np.cumsum(counts)])
        pilots, taken = np.zeros(groups, "u4"), np.zeros(n, bool)
        for g in np.argsort(-counts, kind="stable"):
            if not counts[g]:
                break
            keys = order[starts[g] : starts[g + 1]]
            a, b, first = w[keys, 2][None, :], w[keys, 3][None, :], 0
            while True:
                tries = np.arange(first, first + _TRIES, dtype="u8")[:, None]
                slots = (cls._mix(a, b, tries) % np.uint64(n)).astype("i8")
                free = ~taken[slots].any(axis=1)
                if len(keys) > 1:
                    s = np.sort(slots, axis=1)
                    free &= (s[:, 1:] != s[:, :-1]).all(axis=1)
                if free.any():
                    i = int(free.argmax())
                    pilots[g] = first + i
                    taken[slots[i]] = True
                    break
                first += _TRIES
        return cls(n, pilots)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """A slot for each digest; a digest that the hash was not built from gets any slot."""
        w = self._words(digests)
        p = self.pilots[(w[:, 1] % np.uint64(len(self.pilots))).astype("i8")]
        return (self._mix(w[:, 2], w[:, 3], p) % np.uint64(self.n)).astype("i8")


def _matrix(col: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(col), "u1").reshape(-1, 32)


_INDEX = "bucket long, pilots binary, digests binary, winners binary, rids binary, counts binary"


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    d = _matrix(pdf["digest"])
    h = PerfectHash.build(d)
    at = np.empty(len(d), "i8")
    at[h.slots(d)] = np.arange(len(d))
    values = [pdf[c].to_numpy("i8")[at].tobytes() for c in ("win_id", "win_rid", "n")]
    return pd.DataFrame([[pdf["bucket"].iloc[0], h.pilots.tobytes(), d[at].tobytes(), *values]], columns=["bucket", "pilots", "digests", "winners", "rids", "counts"])


_VERDICT = "digest binary, win_id long, win_rid long, n long"


def _look_up(fresh: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Members take their slot's winner; the rest are groups of their own."""
    new = {"digest": list(fresh["digest"]), "win_id": fresh["win_id"].to_numpy("i8"), "win_rid": fresh["win_rid"].to_numpy("i8"), "n": fresh["n"].to_numpy("i8")}
    if not len(index):
        return pd.DataFrame(new)
    row = index.iloc[0]
    old = np.frombuffer(row["digests"], "u1").reshape(-1, 32)
    winners, rids, counts = (np.frombuffer(row[c], "i8") for c in ("winners", "rids", "counts"))
    total = counts.copy()
    if len(fresh):
        h = PerfectHash(len(old), np.frombuffer(row["pilots"], "u4"))
        d = _matrix(fresh["digest"])
        slot = h.slots(d)
        member = (old[slot] == d).all(axis=1)  # the slot's full digest, byte by byte
        np.add.at(total, slot[member], new["n"][member])
        keep = ~member
        new = {"digest": [x for x, k in zip(new["digest"], keep, strict=True) if k], **{c: new[c][keep] for c in ("win_id", "win_rid", "n")}}
    both = {"digest": [bytes(x) for x in old] + new["digest"], "win_id": np.concatenate([winners, new["win_id"]]), "win_rid": np.concatenate([rids, new["win_rid"]]), "n": np.concatenate([total, new["n"]])}
    return pd.DataFrame(both)


def _winners(keyed: DataFrame, buckets: int) -> DataFrame:
    """One row for each digest; summed before the shuffle, so a hot group sends a row from each task."""
    best = F.min(F.struct("ord_id", "rid"))
    g = keyed.groupBy("digest").agg(best.alias("w"), F.count("*").alias("n"))
    bucket = F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(buckets))
    return g.select("digest", F.col("w.ord_id").alias("win_id"), F.col("w.rid").alias("win_rid"), "n", bucket.alias("bucket"))


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The index of an older delivery (``digest, ord_id, rid``): a row for each bucket of digests, with its perfect hash,
    full digests and winners by slot."""
    return _winners(history, buckets).groupBy("bucket").applyInPandas(_build, _INDEX)


def verdicts(fresh: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """Winner and group size of each digest of the index and of the fresh delivery."""
    return _winners(fresh, buckets).groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(_look_up, _VERDICT)


def _judged(docs: DataFrame) -> DataFrame:
    """``doc_id, ord_id, digest, rid, win_id, win_rid, n`` of each row."""
    d = docs.select(F.col("doc_id").cast("long"), digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("rid"))
    d = written(d.withColumn("ord_id", F.coalesce("doc_id", F.lit(_NO_ID))), "digests")
    low, high, rows = d.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    cut = _NO_ID if low is None else low + (high - low) // 2
    buckets = parts_for(rows, BUCKET_KEYS, LEAST_BUCKETS)
    index = written(build_index(d.where(F.col("ord_id") <= cut), buckets), "digest_index")
    v = verdicts(d.where(F.col("ord_id") > cut), index, buckets)
    return salted_join(d, v, ["digest"], F.col("rid"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of each row of ``docs`` (``doc_id``, ``text``).

    Texts are equal when identical after each run of white space became one space; null counts as empty. Of equal texts
    the row with the smallest ``doc_id`` stays; null ids come last; of rows that repeat an id and a text, one stays. The
    lower half of the range of ids is taken as the older delivery, whose distinct digests the perfect hash holds (their
    winners are smaller than any newer id); the upper half, and rows without id, are looked up in it, and those that are
    no members are grouped by themselves. An empty table gives no rows; other columns are ignored.
    """
    keep = F.when(F.col("win_id") != _NO_ID, F.col("win_id"))
    return _judged(docs).select("doc_id", keep.alias("keep_id"), F.col("n").alias("group_size"), (F.col("rid") == F.col("win_rid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns. Of rows that repeat an id and a text any one stays."""
    rows = _judged(docs).select("ord_id", "digest", (F.col("rid") == F.col("win_rid")).alias("kept"))
    return without_losers(docs, rows, digest(F.col("text")))


def without_losers(docs: DataFrame, rows: DataFrame, key: Column) -> DataFrame:
    """``docs`` without the rows that lost. ``rows`` has a row for each: its id (the largest number for null), its ``key``, and ``kept``.

    The losers' ids and keys are written; texts are dealt once by id and key and meet them, in the same way at all sizes. Where rows repeat an
    id and a key and one of them is kept, one row of that id and key stays.
    """
    ident, value, kept = rows.columns
    keys = rows.groupBy(F.col(ident).alias("__id"), F.col(value).alias("__key")).agg(F.count("*").alias("n"), F.max(kept).alias("__won"))
    lost = written(keys.where("n > 1 OR NOT __won").select("__id", "__key", "__won"), "losers")
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), "__key": key})
    met = keyed.join(lost.hint("merge"), ["__id", "__key"], "left").where("__won IS NULL OR __won")
    twin = F.row_number().over(Window.partitionBy("__id", "__key").orderBy(F.lit(0)))  # where texts already lie
    return met.withColumn("__twin", twin).where("__twin = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
