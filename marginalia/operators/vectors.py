"""A vector index by coarse centroids: every vector lies in the list of its nearest one, and a query meets the lists of a few."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import ship, written
from .retrieval import top_k

#: Vectors of the sample that centroids are fitted to, at most; and rounds of fitting. The index itself holds every vector.
SAMPLE, ROUNDS = 20_000, 12
#: Share of the nearest that a query's lists hold of the sample, and queries that it is measured with.
RECALL, ASKED = 0.95, 1000
#: Vectors of a list that are compared at once: longer lists are dealt to pieces. Queries that meet a piece at once, and rows that leave a task at once.
PIECE, AT_ONCE, ROWS = 16_384, 512, 1000
_SEED = 17


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def _matrix(embeddings: pa.ListArray) -> np.ndarray:
    return embeddings.flatten().to_numpy(zero_copy_only=False).astype("f8", copy=False).reshape(len(embeddings), -1)


def fit(vectors: DataFrame, lists: int, k: int = 10, recall: float = RECALL, sample: int = SAMPLE) -> tuple[np.ndarray, int]:
    """Centroids of ``lists`` groups of directions, and how many lists a query must probe for ``recall`` of its ``k`` nearest.

    Both are fitted to at most ``sample`` vectors (``vec_id, embedding``), those of the smallest hashed ids: the sample bounds what the driver holds;
    which vectors are indexed does not depend on it. There are no more centroids than vectors.
    """
    rows = vectors.where(F.size("embedding") > 0).select("vec_id", F.col("embedding").cast("array<double>").alias("e")).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not rows:
        return np.zeros((1, 0)), 1
    x = _unit(np.array([r["e"] for r in rows]))
    rng = np.random.default_rng(_SEED)
    at = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = (x @ at.T).argmax(axis=1)
        sums = np.zeros_like(at)
        np.add.at(sums, near, x)
        full = np.bincount(near, minlength=len(at)) > 0
        sums[~full] = at[~full]
        at = _unit(sums)
    asked = x[:ASKED]
    scores = asked @ x.T
    np.fill_diagonal(scores, -np.inf)
    nearest = np.argsort(-scores, axis=1)[:, :k]
    own = (x @ at.T).argmax(axis=1)[nearest]
    place = np.argsort(np.argsort(-(asked @ at.T), axis=1), axis=1)  # of each list for a query
    needed = np.sort(np.take_along_axis(place, own, axis=1).ravel())
    return at, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1 if len(needed) else 1


def _lists(vectors: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """``vec_id, embedding, list`` for each of the ``probes`` lists that a vector is nearest to; ``vec_id`` is long."""
    ship(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(x, ROWS) for whole in batches for x in range(0, whole.num_rows, ROWS)):
            m = _unit(_matrix(batch.column("embedding")))
            n = min(probes, len(centroids))
            near = np.argpartition(-(m @ centroids.T), n - 1, axis=1)[:, :n] if n < len(centroids) else np.tile(np.arange(n), (len(m), 1))
            of = np.repeat(np.arange(len(m)), n)
            e = pa.ListArray.from_arrays(pa.array(np.arange(len(of) + 1, dtype="i4") * m.shape[1], pa.int32()), pa.array(m[of].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(of)), e, pa.array(near.ravel().astype("i4"))], ["vec_id", "embedding", "list"])

    some = vectors.where(F.size("embedding") > 0).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return some.mapInArrow(run, "vec_id long, embedding array<double>, list int")


def index(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``list, piece, pieces, vec_id, embedding`` of every vector with numbers, as a unit vector; long lists have several pieces."""
    listed = written(_lists(vectors, centroids, 1), "listed")
    sizes = listed.groupBy("list").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"))  # a row for each centroid
    return written(listed.join(F.broadcast(sizes), "list").withColumn("piece", F.pmod(F.xxhash64("vec_id"), "pieces").cast("int")), "vector_index")


def nearest(held: DataFrame, queries: DataFrame, centroids: np.ndarray, k: int, probes: int) -> DataFrame:
    """``query_id, vec_id, score, rank``: of the vectors in the ``probes`` nearest lists the ``k`` nearest to each query (``query_id, embedding``), scored exactly.

    A query goes to each piece of its lists, where blocks of queries meet the piece as matrices and leave with their ``k`` best; these
    are ranked over all pieces. Neither vectors nor queries go to all tasks; a piece is bounded, and its queries pass by in blocks.
    """
    asked = _lists(queries.withColumnRenamed("query_id", "vec_id"), centroids, probes)
    pieces = held.select("list", "pieces").distinct()  # a row for each centroid
    asked = asked.join(F.broadcast(pieces), "list").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(16)).cast("int"))
    rows = held.select("list", "piece", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("block"), F.lit(0).alias("side"), "vec_id", "embedding").unionByName(asked.select("list", "piece", "block", F.lit(1).alias("side"), "vec_id", "embedding"))

    def best(ids: np.ndarray, piece: np.ndarray, asking: np.ndarray, asked: np.ndarray) -> pa.RecordBatch:
        s = asked @ piece.T
        s[np.isnan(s) | (asking[:, None] == ids[None, :])] = -np.inf
        some = s > -np.inf
        if len(ids) > k:  # ties of the last place stay
            some &= s >= np.partition(s, len(ids) - k, axis=1)[:, len(ids) - k, None] - 2e-9
        r, c = np.nonzero(some)
        score = s[r, c]
        by = np.lexsort((ids[c], -np.round(score, 9), r))
        r, c, score = r[by], c[by], score[by]
        keep = np.arange(len(r)) - np.searchsorted(r, np.arange(len(asking)))[r] < k
        return pa.RecordBatch.from_arrays([pa.array(asking[r[keep]]), pa.array(ids[c[keep]]), pa.array(score[keep])], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, ids, piece = None, [], None, None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("list", "piece", "block", "side")])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if now != tuple(key[:3, a]):
                    now, parts, ids, piece = tuple(key[:3, a]), [], None, None
                part = batch.slice(a, b - a)
                found, m = part.column("vec_id").to_numpy(), _matrix(part.column("embedding"))
                if key[3, a] == 0:
                    parts.append((found.copy(), m.copy()))
                elif parts:
                    if ids is None:
                        ids, piece = (np.concatenate(x) for x in zip(*parts, strict=True))
                    for x in range(0, len(found), AT_ONCE):
                        yield best(ids, piece, found[x : x + AT_ONCE], m[x : x + AT_ONCE])

    key = ["list", "piece", "block"]
    found = rows.repartition(*key).sortWithinPartitions(*key, "side").mapInArrow(run, "query_id long, vec_id long, score double")
    return top_k(found, k, doc="vec_id")
