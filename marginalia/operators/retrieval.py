"""Candidate retrieval: BM25, cosine, rank fusion, and joins by name."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab as V
from ..storage import ship, written

K1, B = 1.5, 0.75
RRF = 60
#: Terms that are compared inside a text; terms of queries up to which others are dropped where a text's terms are counted.
FEW_TERMS, NAMED_TERMS = 200, 20_000
#: Where texts and queries of many terms meet: terms of a piece, about, and the least number of pieces where ids repeat; numbers of its table of frequent terms; scores made at once.
PIECE_TERMS, LEAST_PIECES, DENSE, SCORES = 2_500_000, 16, 8_000_000, 4_000_000
#: Terms of a block of queries, most and least; in how many tasks, about, blocks and groups of pieces meet, most and least; a term is frequent if its texts' square is so many times all texts.
BLOCK_TERMS, LEAST_BLOCK, TASKS, LEAST_TASKS, OFTEN = 1_500_000, 50_000, 512, 32, 15
#: Classes of texts that are alike in a piece, and of how many frequent terms they are made.
CLASSES, FREQUENT = 8, 256
_BLOB = "at long, k long, blob binary"
#: Where all queries are held against all vectors: queries of a block, and how many of them are multiplied at once; vectors of a piece, about, and the least number of pieces.
BLOCK, AT_ONCE, PIECE, PIECES = 4096, 256, 8192, 64


def counted_terms(named: list[str] | None):
    """The different terms of each text with their counts, only ``named`` ones if these are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if named is None else pa.array(named, pa.string())
        for batch in batches:
            tk = batch.column("tk")
            coded = tk.flatten().dictionary_encode()
            width = max(1, len(coded.dictionary))
            code = coded.indices.to_numpy()
            key = np.repeat(np.arange(len(tk)), pc.list_value_length(tk).to_numpy()) * width + code
            if known is not None:
                key = key[pc.is_in(coded.dictionary, value_set=known).to_numpy(zero_copy_only=False)[code]]
            key, f = np.unique(key, return_counts=True)
            at = pa.array(np.searchsorted(key // width, np.arange(len(tk) + 1)).astype("i4"))
            terms = pa.ListArray.from_arrays(at, coded.dictionary.take(pa.array(key % width)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("dl"), terms, pa.ListArray.from_arrays(at, pa.array(f.astype("i8")))], ["doc_id", "dl", "terms", "numbers"])

    return run


def of_one_text(counted: DataFrame) -> DataFrame:
    """Texts with their counted terms, where rows that share an id and a length are one text."""
    rows = counted.select("doc_id", "dl", F.explode_outer(F.arrays_zip("terms", "numbers")).alias("t")).groupBy("doc_id", "dl", "t.terms").agg(F.sum("t.numbers").alias("numbers"))
    pairs = F.collect_list(F.when(F.col("terms").isNotNull(), F.struct("terms", "numbers"))).alias("t")
    return written(rows.groupBy("doc_id", "dl").agg(pairs).select("doc_id", "dl", F.col("t.terms").alias("terms"), F.col("t.numbers").alias("numbers")), "merged_terms", compression="zstd")


def _blob(columns: dict[str, pa.Array]) -> bytes:
    """Arrays of any lengths as one value."""
    one = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in columns.values()], list(columns))
    to = pa.BufferOutputStream()
    with pa.ipc.new_stream(to, one.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(one)
    return to.getvalue().to_pybytes()


def _of_blob(blob: pa.Buffer) -> dict[str, pa.Array]:
    with pa.ipc.open_stream(blob) as stream:
        one = stream.read_next_batch()
    return {c: one.column(c).flatten() for c in one.schema.names}


def _parts(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[pa.Table]:
    """Rows with lists of terms in parts of about ``most`` terms; a last part has from a quarter of them to a quarter more."""
    held, n = [], 0
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy())
        a = 0
        while a < len(ends):
            before = ends[a - 1] if a else 0
            if most is None or n + ends[-1] - before < 1.25 * most:
                held.append(batch.slice(a))
                n += ends[-1] - before
                break
            b = max(a + 1, int(np.searchsorted(ends, before + most - n, "right")))
            yield pa.Table.from_batches([*held, batch.slice(a, b - a)])
            held, n, a = [], 0, b
    if held:
        yield pa.Table.from_batches(held)


def _packed(make, most: int | None):
    """A row for each part of the rows that a task reads, numbered by ``at`` and ``k``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        for k, rows in enumerate(_parts(batches, most)):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([k], pa.int64()), pa.array([_blob(make(rows))], pa.binary())], ["at", "k", "blob"])

    return run


def _lists(rows: pa.Table, *names: str) -> list[pa.Array]:
    one = lambda c: c.combine_chunks() if c.num_chunks != 1 else c.chunk(0)
    return [one(rows.column(c)) for c in names]


def _alike(code: np.ndarray, doc: np.ndarray, m: int) -> np.ndarray:
    """A class for each of ``m`` texts by which of the most frequent terms they have, as texts of one language or kind share these."""
    often = np.argsort(-np.bincount(code), kind="stable")[:FREQUENT]
    place = np.full(int(code.max(initial=0)) + 1, -1, "i4")
    place[often] = np.arange(len(often))
    held = place[code] >= 0
    has = np.zeros((m, len(often)), "f4")
    has[doc[held], place[code[held]]] = 1
    has /= np.maximum(np.sqrt(has.sum(axis=1, keepdims=True)), 1)
    middles = has[np.linspace(0, m - 1, min(m, CLASSES)).astype("i8")]
    for _ in range(6):
        near = (has @ middles.T).argmax(axis=1)
        sums = np.stack([has[near == g].sum(axis=0) for g in range(len(middles))])
        middles = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-9)
    return near


def _texts_by_term(rows: pa.Table) -> dict[str, pa.Array]:
    """Texts of a piece: different ids, by classes of texts that are alike, and for each term the places of its texts, how often they have it, and their lengths."""
    doc_id, dl, terms, numbers = _lists(rows, "doc_id", "dl", "terms", "numbers")
    ids, n = doc_id.dictionary_encode(null_encoding="encode"), pc.list_value_length(terms).to_numpy()
    coded = terms.flatten().dictionary_encode()
    code, doc, m = coded.indices.to_numpy(), ids.indices.to_numpy(), len(ids.dictionary)
    kind = _alike(code, np.repeat(doc, n), m)
    order = np.argsort(kind, kind="stable")
    place = np.empty(m, "i4")
    place[order] = np.arange(m)
    by = np.argsort(code, kind="stable")
    row = np.repeat(np.arange(len(n), dtype=np.min_scalar_type(len(n))), n)[by]
    f, sizes = numbers.flatten().to_numpy(), np.bincount(kind)
    return {"ids": ids.dictionary.take(pa.array(order)), "classes": pa.array(sizes[sizes > 0]), "doc": pa.array(place[doc]), "dl": dl, "terms": coded.dictionary, "sizes": pa.array(np.bincount(code, minlength=len(coded.dictionary))), "row": pa.array(row), "f": pa.array(f[by].astype(np.min_scalar_type(int(f.max(initial=0)))))}


def _queries_by_row(rows: pa.Table) -> dict[str, pa.Array]:
    query_id, terms, weights = _lists(rows, "query_id", "terms", "weights")
    coded = terms.flatten().dictionary_encode()
    return {"ids": query_id, "n": pc.list_value_length(terms), "terms": coded.dictionary, "code": coded.indices, "weight": weights.flatten()}


class _Piece:
    """Texts by term: impacts of terms that are frequent in a class of texts as a matrix of that class, of others as lists."""

    def __init__(self, t: dict[str, pa.Array], mean: float):
        self.ids, self.terms = t["ids"], t["terms"]
        m, n = len(self.ids), len(self.terms)
        self.m, sizes = m, t["classes"].to_numpy()
        self.starts = np.cumsum(sizes) - sizes
        row, impact = t["row"].to_numpy(), t["f"].to_numpy() * (K1 + 1)
        long = (K1 * (1 - B + B * t["dl"].to_numpy() / mean))[row]
        long += t["f"].to_numpy()
        impact /= long
        del long
        doc, code = t["doc"].to_numpy()[row], np.repeat(np.arange(n, dtype="i4"), t["sizes"].to_numpy())
        kind = np.repeat(np.arange(len(sizes), dtype="i1"), sizes)[doc]
        left = np.ones(len(doc), bool)
        self.slots, self.tables, self.single, self.most = [], [], [], []
        for g, (start, size) in enumerate(zip(self.starts, sizes, strict=True)):
            own = np.flatnonzero(kind == g)
            df = np.bincount(code[own], minlength=n)
            often = np.flatnonzero(df * df > OFTEN * size)
            often = often[np.argsort(-df[often], kind="stable")][: max(1, DENSE // max(1, m))]
            slot = np.full(n, -1, "i4")
            slot[often] = np.arange(len(often))
            own = own[slot[code[own]] >= 0]
            left[own] = False
            table = np.bincount(slot[code[own]].astype("i8") * size + (doc[own] - start), impact[own], len(often) * size).reshape(len(often), size)
            self.slots.append(slot)
            self.tables.append(table)
            self.single.append(table.astype("f4"))
            self.most.append(table.max(axis=1, initial=0))
        self.share = 1.2e-7 * (max(map(len, self.tables)) + 9)  # of a score, by which it may be off in single precision
        left = np.flatnonzero(left)
        self.sizes = np.bincount(code[left], minlength=n)
        self.impact, self.first = impact[left], np.cumsum(self.sizes) - self.sizes
        self.both = np.empty(len(left), [("doc", "i4"), ("impact", "f4")])  # side by side, as both are fetched
        self.both["doc"], self.both["impact"] = doc[left], self.impact
        self.both = self.both.view("i8")

    def of_frequent(self, row: np.ndarray, code: np.ndarray, weight: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What frequent terms come to in texts, in single precision, and of what was left out, for queries with few terms that a class has often, the most it can be by class."""
        n = len(least)
        out, more = np.zeros((n, self.m), "f4"), np.zeros((n, len(self.tables)))
        for g, (start, slot, table) in enumerate(zip(self.starts, self.slots, self.single, strict=True)):
            slot = slot[code]
            often = slot >= 0
            r, slot, w = row[often], slot[often], weight[often]
            number = np.bincount(r, minlength=n)
            every = (number > len(table) // 8) | (number > 0) & (least <= 0)
            some = ~every[r]
            more[:, g] = np.bincount(r[some], w[some] * self.most[g][slot[some]], n)
            asked = np.flatnonzero(every)
            if len(asked):
                at = np.cumsum(every) - 1
                q = np.bincount(at[r[~some]] * len(table) + slot[~some], w[~some], len(asked) * len(table)).astype("f4")
                out[asked, start : start + table.shape[1]] = q.reshape(len(asked), len(table)) @ table
        return out, more

    def best(self, code: np.ndarray, weight: np.ndarray, frequent: np.ndarray, more: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of a query's texts that may be among its ``k`` best, ``least`` or more; ``frequent`` and ``more``: what frequent terms come to, and at most beside that."""
        size = self.sizes[code]
        at = np.repeat(self.first[code] - np.cumsum(size) + size, size)
        at += np.arange(len(at))
        both = self.both.take(at)
        doc = both.view("i4")[::2]
        s = frequent + np.bincount(doc, both.view("f4")[1::2] * np.repeat(weight.astype("f4"), size), self.m)
        low = least * (1 - self.share)
        if more.any():
            for g in np.flatnonzero((more > 0) & ((np.maximum.reduceat(s, self.starts) + more) * (1 + self.share) >= low)):
                slot = self.slots[g][code]
                often = slot >= 0
                s[self.starts[g] : self.starts[g] + self.tables[g].shape[1]] += weight[often] @ self.tables[g][slot[often]]
        c = np.flatnonzero(s >= low) if least > 0 else np.flatnonzero(s)
        if len(c) > k:  # ties of the last place stay
            c = c[s[c] >= (np.partition(s[c], len(c) - k)[len(c) - k] - 2e-9) * (1 - 2 * self.share)]
        if not len(c):
            return c, np.zeros(0)
        once = max(1, SCORES // (4 * len(code)))
        return c, np.concatenate([self._exact(c[x : x + once], code, weight, size, at, doc) for x in range(0, len(c), once)])

    def _exact(self, c: np.ndarray, code: np.ndarray, weight: np.ndarray, size: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Scores of the texts at ``c``; their parts are summed from the least to the greatest, so copies score alike in all pieces."""
        wanted = np.zeros(self.m, bool)
        wanted[c] = True
        some = np.flatnonzero(wanted.take(doc))
        term, parts = np.searchsorted(np.cumsum(size), some, "right"), np.zeros((len(c), len(code)))
        np.add.at(parts, (np.searchsorted(c, doc[some]), term), self.impact[at[some]] * weight[term])
        kind = np.searchsorted(self.starts, c, "right") - 1
        for g in np.unique(kind):
            slot = self.slots[g][code]
            often, own = np.flatnonzero(slot >= 0), np.flatnonzero(kind == g)
            parts[own[:, None], often] = self.tables[g][slot[often], c[own, None] - self.starts[g]] * weight[often]
        parts.sort(axis=1)
        return parts.cumsum(axis=1)[:, -1]


class _Asked:
    """A block of queries and their ``k`` best texts so far."""

    def __init__(self, t: dict[str, pa.Array], k: int):
        self.ids, self.terms, self.code, self.weight, self.k = t["ids"], t["terms"], t["code"].to_numpy(), t["weight"].to_numpy(), k
        self.query = np.repeat(np.arange(len(self.ids), dtype="i4"), t["n"].to_numpy())
        self.least = np.zeros(len(self.ids))  # what a text must reach, ties included
        self.row, self.doc, self.score = np.zeros(0, "i8"), None, np.zeros(0)

    def meet(self, piece: _Piece) -> None:
        code = pc.index_in(self.terms, value_set=piece.terms).fill_null(-1).to_numpy()[self.code]
        held = code >= 0
        row, code, weight = self.query[held], code[held], self.weight[held]
        first, once = np.searchsorted(row, np.arange(len(self.ids) + 1)), max(1, SCORES // max(1, piece.m))
        texts, scores = [], []
        for x in range(0, len(self.ids), once):
            y = min(len(self.ids), x + once)
            a, b = first[x], first[y]
            frequent, more = piece.of_frequent(row[a:b] - x, code[a:b], weight[a:b], self.least[x:y])
            for i in range(x, y):
                c, score = piece.best(code[first[i] : first[i + 1]], weight[first[i] : first[i + 1]], frequent[i - x], more[i - x], self.least[i], self.k)
                texts.append(c)
                scores.append(score)
        if any(map(len, texts)):
            self._add(np.repeat(np.arange(len(texts)), [len(c) for c in texts]), piece.ids.take(pa.array(np.concatenate(texts))), np.concatenate(scores))

    def _add(self, row: np.ndarray, doc: pa.Array, score: np.ndarray) -> None:
        row, score, doc = np.append(self.row, row), np.append(self.score, score), doc if self.doc is None else pa.concat_arrays([self.doc, doc])
        by = np.lexsort((pc.rank(doc, tiebreaker="dense").to_numpy(), -np.round(score, 9), row))
        row = row[by]
        rank = np.arange(len(row)) - np.searchsorted(row, np.arange(len(self.ids)))[row]
        keep = rank < self.k
        self.row, self.score, self.doc = row[keep], score[by][keep], doc.take(pa.array(by[keep]))
        last = rank[keep] == self.k - 1
        self.least[self.row[last]] = self.score[last] - 2e-9

    def best(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        if self.doc is not None:
            yield pa.RecordBatch.from_arrays([self.ids.take(pa.array(self.row)), self.doc, pa.array(self.score)], names)


def _ranked(mean: float, k: int, names: list[str]):
    """Of each query the ``k`` best among the pieces that a task reads; pieces come one after the other, each beside all blocks of queries of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, piece, asked = None, None, {}
        for batch in batches:
            for at, number, texts, block, queries in zip(*[batch.column(c) for c in ("at", "k", "texts", "block", "queries")], strict=True):
                if now != (at.as_py(), number.as_py()):
                    now, piece = (at.as_py(), number.as_py()), None
                    piece = _Piece(_of_blob(texts.as_buffer()), mean)
                if block.as_py() not in asked:
                    asked[block.as_py()] = _Asked(_of_blob(queries.as_buffer()), k)
                asked[block.as_py()].meet(piece)
        for block in asked.values():
            yield from block.best(names)

    return run


def _bm25_best(docs: DataFrame, wanted: DataFrame, named: list[str] | None, k: int) -> DataFrame:
    """The ``k`` best of each query. Texts with their counted terms become pieces of bounded size where they are read, queries blocks; each is dealt once to groups, and every group
    of pieces meets every block in a task that reads both again, so copies of neither are written. A task's best rows leave it, and groups are fewer the more blocks there are."""
    ship(docs.sparkSession)
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    query_type = wanted.schema["query_id"].dataType.simpleString()
    tk = docs.select("doc_id", T.tokens(F.coalesce("text", F.lit(""))).alias("tk")).select("doc_id", F.size("tk").cast("long").alias("dl"), "tk")
    counted = written(tk.mapInArrow(counted_terms(named), f"doc_id {doc_type}, dl long, terms array<string>, numbers array<long>"), "counted_terms", compression="zstd")
    n, mean, size = counted.agg(F.count("*"), F.avg("dl"), F.sum(F.size("terms"))).first()
    mean, size, most = max(mean or 0.0, 1.0), size or 0, PIECE_TERMS
    again = counted.groupBy("doc_id").agg(F.count("*").alias("c"), F.count_distinct("dl").alias("d")).where("c > 1").agg(F.max(F.col("c") > F.col("d"))).first()[0]
    if again:  # rows that share an id and a length count as one text
        counted = of_one_text(counted)
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    texts = counted.where(F.size("terms") > 0)
    if again is not None:  # what other rows of an id score is added to its score, so they are in one piece
        pieces = max(LEAST_PIECES, -(-size // PIECE_TERMS))
        texts, most = texts.repartition(pieces, "doc_id"), None
    read_texts = texts.rdd.getNumPartitions()
    parts = max(read_texts, -(-size // PIECE_TERMS))
    weight = F.col("qf") * F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    asked = wanted.join(df, "term").groupBy("query_id").agg(F.collect_list(F.struct("term", weight.alias("w"))).alias("t"))
    asked = written(asked.select("query_id", F.col("t.term").alias("terms"), F.col("t.w").alias("weights")), "weighted_queries", compression="zstd")
    rows = wanted.count()
    block = min(BLOCK_TERMS, max(LEAST_BLOCK, rows * parts // LEAST_TASKS))
    blocks = written(asked.coalesce(-(-rows // block) or 1).mapInArrow(_packed(_queries_by_row, block), _BLOB), "query_blocks", compression="uncompressed")
    n_blocks, read = blocks.agg(F.count("*"), F.max("at") + 1).first()
    groups = max(1, min(parts, -(-TASKS // max(1, n_blocks))))
    # Parts in the order of their numbers go round, so all groups get as many.
    dealt = lambda rows, parts, n: rows.repartitionById(n, F.pmod(F.col("k") * parts + F.col("at"), F.lit(n)).cast("int"))
    pieces = dealt(texts.mapInArrow(_packed(_texts_by_term, most), _BLOB), read_texts, groups).withColumnRenamed("blob", "texts")
    blocks = dealt(blocks, read or 1, max(1, n_blocks)).select((F.col("k") * (read or 1) + F.col("at")).alias("block"), F.col("blob").alias("queries"))
    every = pieces.hint("shuffle_replicate_nl").crossJoin(blocks)
    return every.mapInArrow(_ranked(mean, k, ["query_id", "doc_id", "score"]), f"query_id {query_type}, doc_id {doc_type}, score double")


def bm25(docs: DataFrame, queries: DataFrame, *carry: str, best: int | None = None) -> DataFrame:
    """``query_id, doc_id, score`` (and ``carry``) of every document that shares a term with a query.

    ``queries``: ``query_id, query``; a term that a query repeats counts as often. Texts are tokenised once; only terms of queries
    are counted by document, and the counts are written, so statistics and scores read small rows. A null text counts as empty. Where queries have few terms these are
    taken from each text before it is taken apart, else terms are joined. ``best``: where queries have many terms and nothing is carried, only so many of a query's pairs are made
    rows, by ``top_k``'s order. ``postings`` has an index that is kept.
    """
    wanted = queries.select("query_id", F.explode(T.tokens(F.col("query"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qf"))
    vocabulary = wanted.select("term").distinct()
    t = docs.select("doc_id", *carry, T.tokens(F.coalesce("text", F.lit(""))).alias("tk")).select("doc_id", *carry, F.size("tk").cast("long").alias("dl"), "tk")
    ranked = best is not None and not carry
    few = [r[0] for r in vocabulary.limit((NAMED_TERMS if ranked else FEW_TERMS) + 1).collect()]
    if ranked and len(few) > FEW_TERMS:
        return _bm25_best(docs, written(wanted, "query_terms"), few if len(few) <= NAMED_TERMS else None, best)
    if len(few) <= FEW_TERMS:
        t = t.withColumn("tk", F.filter("tk", lambda x: x.isin(few)))
    # Lengths ride on an empty term, so documents without any term of the queries still count in the averages.
    rows = t.select("doc_id", *carry, "dl", F.explode(F.array_append("tk", F.lit(""))).alias("term"))
    if len(few) > FEW_TERMS:
        rows = rows.join(vocabulary.union(docs.sparkSession.sql("SELECT ''")), "term")
    tf = rows.groupBy("doc_id", *carry, "dl", "term").agg(F.count("*").alias("f"))
    tf = written(tf, "term_counts")
    stats = tf.where("term = ''").agg(F.sum("f").alias("n"), (F.sum(F.col("f") * F.col("dl")) / F.sum("f")).alias("avgdl"))
    df = tf.where("term <> ''").groupBy("term").agg(F.count("*").alias("df"))
    idf = df.crossJoin(F.broadcast(stats)).select("term", "avgdl", F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1).alias("idf"))
    weighted = wanted.join(idf, "term")
    part = F.col("qf") * F.col("idf") * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("dl") / F.greatest("avgdl", F.lit(1.0))))
    return tf.join(weighted, "term").groupBy("query_id", "doc_id", *carry).agg(F.sum(part).alias("score"))


def top_k(scores: DataFrame, k: int, query: str = "query_id", doc: str = "doc_id", score: str = "score") -> DataFrame:
    """The ``k`` best of each query with their rank; ties by smaller id. Scores are compared to nine places."""
    order = Window.partitionBy(query).orderBy(F.round(score, 9).desc(), doc)
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def _meet(names: list[str], least: float, best: int | None):
    """Scores of pairs of rows of queries and vectors as matrices, so many queries at once; of each query's at most its ``best`` ones in a piece."""

    def unpacked(rows: pa.StructArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        m = rows.field("e").flatten().to_numpy().reshape(len(rows), -1)
        return rows.field("id"), m, np.sqrt((m * m).sum(axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (asked, q, qn), (ids, v, vn) = unpacked(batch.column("q")[k].values), unpacked(batch.column("v")[k].values)
                order, every = pc.rank(ids, tiebreaker="dense").to_numpy(), ids.unique()
                same = pc.index_in(asked.cast(ids.type), every).fill_null(-1).to_numpy(), pc.index_in(ids, every).to_numpy()
                for x in range(0, len(q), AT_ONCE):
                    y = slice(x, x + AT_ONCE)
                    s = q[y] @ v.T / (qn[y, None] * vn[None, :] + 1e-8)
                    row, col = np.nonzero(~(s <= least) & (same[0][y, None] != same[1][None, :]))
                    score = s[row, col]
                    if best is not None:
                        first = np.lexsort((order[col], -np.round(score, 9), row))
                        row, col, score = row[first], col[first], score[first]
                        begins = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, "i8")
                        rank = np.arange(len(row)) - np.repeat(begins, np.diff(np.append(begins, len(row))))
                        row, col, score = row[rank < best], col[rank < best], score[rank < best]
                    yield pa.RecordBatch.from_arrays([asked.take(pa.array(row + x)), ids.take(pa.array(col)), pa.array(score)], names)

    return run


def cosine(vectors: DataFrame, queries: DataFrame, least: float = 0.3, best: int | None = None) -> DataFrame:
    """``query_id, vec_id, score`` above ``least``, of each query (``query_id, embedding``) against all other vectors (``vec_id, embedding``).

    Vectors are dealt to pieces of bounded size and stay there; the queries come to each piece in blocks, and a block and a piece meet as matrices, so neither side
    has to fit in one task. ``best``: only so many of a query's pairs leave a piece, by ``top_k``'s order, where no more are wanted. Vectors with nulls, and of other lengths, meet nothing.
    """
    ship(vectors.sparkSession)
    n, m = vectors.count(), queries.count()
    pieces, blocks = max(PIECES, -(-n // PIECE)), max(1, -(-m // BLOCK))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")

    def whole(rows: DataFrame, ident: str) -> DataFrame:
        e = F.col("embedding").cast("array<double>")
        return rows.where(F.col(ident).isNotNull() & (F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull())).select(F.col(ident).alias("id"), e.alias("e"), F.size("embedding").alias("size"))

    packed = lambda c: F.collect_list(F.struct("id", "e")).alias(c)
    v = whole(vectors, "vec_id").withColumn("piece", dealt("id", pieces)).repartition(pieces, "piece").groupBy("piece", "size").agg(packed("v"))
    q = whole(queries, "query_id").withColumn("block", dealt("id", blocks)).groupBy("block", "size").agg(packed("q"))
    q = q.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))).repartition(pieces, "piece")
    kinds = [queries.schema["query_id"].dataType.simpleString(), vectors.schema["vec_id"].dataType.simpleString()]
    names = ["query_id", "vec_id", "score"]
    return v.join(q, ["piece", "size"]).select("q", "v").mapInArrow(_meet(names, least, best), f"query_id {kinds[0]}, vec_id {kinds[1]}, score double")


def fuse(rankings: DataFrame, query: str = "query_id", doc: str = "doc_id", k: int = RRF) -> DataFrame:
    """Reciprocal rank fusion of rows that have a ``rank``: sum of 1 / (k + rank)."""
    return rankings.groupBy(query, doc).agg(F.sum(1.0 / (k + F.col("rank"))).alias("rrf"))


def same_family(unit_type: Column, registry_type: Column) -> Column:
    """Whether a registry type lies in the family of a unit's type; ``other`` matches all."""
    families = F.create_map(*[x for t, f in V.TYPE_FAMILIES.items() for x in (F.lit(t), F.array(*[F.lit(y) for y in f]))])
    return (unit_type == "other") | (unit_type == registry_type) | F.coalesce(F.array_contains(F.element_at(families, unit_type), registry_type), F.lit(False))


def name_candidates(units: DataFrame, registry: DataFrame) -> DataFrame:
    """``unit_ref, book_ref`` of concepts that share a name, as one equi-join instead of a disjunction.

    Both sides: ``id, concept_type, surface, canonical_name, aliases, observed``. Each side's names are exploded with their kind; of the
    pairs of kinds only alias to observed-as-surface of the unit does not exist. Inside a type family any shared name counts; outside,
    the unit's canonical name must be the other's canonical name or alias.
    """

    def names(side: DataFrame, surfaces: Column) -> DataFrame:
        some = F.concat(
            F.transform(surfaces, lambda x: F.struct(F.lit("surface").alias("kind"), F.lower(x).alias("name"))),
            F.array(F.struct(F.lit("cname").alias("kind"), F.lower("canonical_name").alias("name"))),
            F.transform("aliases", lambda x: F.struct(F.lit("alias").alias("kind"), F.lower(x).alias("name"))),
        )
        return side.select("id", "concept_type", F.explode(F.array_distinct(some)).alias("n")).select("id", "concept_type", "n.kind", "n.name").where("name <> ''")

    u = names(units, F.array("surface")).select(F.col("id").alias("unit_ref"), F.col("concept_type").alias("ut"), F.col("kind").alias("uk"), "name")
    r = names(registry, F.array_union(F.array("surface"), "observed")).select(F.col("id").alias("book_ref"), F.col("concept_type").alias("rt"), F.col("kind").alias("rk"), "name")
    in_family = same_family(F.col("ut"), F.col("rt")) & ~((F.col("uk") == "cname") & (F.col("rk") == "surface"))
    any_type = (F.col("uk") == "cname") & F.col("rk").isin("cname", "alias")
    return u.join(r, "name").where(in_family | any_type).select("unit_ref", "book_ref").distinct()


def capped_candidates(scored: DataFrame, embedding_cap: int = 5, bm25_cap: int = 3) -> DataFrame:
    """Of fused candidates (``query_id, doc_id, rrf, has_embedding``) the best few that the embedding found and the best few of the others."""
    order = Window.partitionBy("query_id", "has_embedding").orderBy(F.round("rrf", 9).desc(), "doc_id")
    return scored.withColumn("rn", F.row_number().over(order)).where((F.col("has_embedding") & (F.col("rn") <= embedding_cap)) | (~F.col("has_embedding") & (F.col("rn") <= bm25_cap)))


def recall_at_k(neighbours: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """Of each query's ``k`` nearest the share with its label."""
    a = labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql"))
    hit = top_k(neighbours, k, doc="vec_id").join(a, "query_id").join(labels, "vec_id")
    return hit.groupBy("query_id").agg(F.count("*").alias("n"), F.sum((F.col("ql") == F.col("label")).cast("long")).alias("n_same"))
