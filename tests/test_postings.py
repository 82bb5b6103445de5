"""The inverted index against scores of all documents."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marginalia.operators import postings
from marginalia.operators import retrieval as R


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    words = ["common"] * 30 + [f"w{k}" for k in range(60)]
    texts = [(k * 3, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for k in range(400)] + [(5000, None), (5001, ""), (5002, "rare common"), (5003, "rare " * 40)]
    return spark.createDataFrame(texts, "doc_id long, text string")


QUERIES = [(1, "rare common"), (2, "w1 w2 w2 w3"), (3, "absent"), (4, ""), (5, "common")]


@pytest.mark.parametrize("named", [1000, 1])
def test_top_k_of_an_index_in_parts(spark, docs, tmp_path, monkeypatch, named):
    monkeypatch.setattr(postings, "NAMED", named)
    monkeypatch.setattr(postings, "BLOCK_DOCS", 16)
    path, queries = f"file://{tmp_path}/index", spark.createDataFrame(QUERIES, "query_id int, query string")
    for part in (docs.where("doc_id < 500"), docs.where("doc_id >= 500 AND doc_id < 5000"), docs.where("doc_id < 0"), docs.where("doc_id >= 5000")):
        postings.add(part, path)
    index = postings.Index(spark, path)
    rows = lambda d: sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in d.collect())
    for k in (1, 5, 500):
        assert rows(index.search(queries, k)) == rows(R.top_k(R.bm25(docs, queries), k))


def test_blocks_that_cannot_reach_the_top_are_not_read(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_DOCS", 16)
    path = f"file://{tmp_path}/index"
    postings.add(docs, path)
    read = []
    scores = postings.Index.scores
    monkeypatch.setattr(postings.Index, "scores", lambda self, w, blocks: (read.append(blocks.count()), scores(self, w, blocks))[1])
    postings.Index(spark, path).search(spark.createDataFrame([(1, "rare common")], "query_id int, query string"), 2).collect()
    assert sum(read) <= 3  # of some seventy-five


def test_an_unfinished_addition_is_not_read(spark, docs, tmp_path, monkeypatch):
    path, some = f"file://{tmp_path}/index", docs.where("doc_id < 300")
    postings.add(some, path)
    before = postings.Index(spark, path).n
    folder = f"{path}/postings/unfinished"
    spark.createDataFrame([("common", 0, 1, 1, 1, 0)], "term string, block long, n long, max_f long, min_dl long, bucket int").withColumn("docs", F.lit(None).cast(postings._DOC)).write.partitionBy("bucket").parquet(folder)
    index = postings.Index(spark, path)
    assert index.n == before == some.count() and index.of_terms(spark.createDataFrame([("common",)], "term string"), "n").agg(F.sum("n")).first()[0] <= before


def test_few_terms_and_many_score_alike(spark, docs, monkeypatch):
    queries = spark.createDataFrame(QUERIES, "query_id int, query string")
    few = sorted(map(repr, R.bm25(docs, queries).select("query_id", "doc_id", F.round("score", 9)).collect()))
    monkeypatch.setattr(R, "FEW_TERMS", 1)
    assert sorted(map(repr, R.bm25(docs, queries).select("query_id", "doc_id", F.round("score", 9)).collect())) == few


@pytest.mark.parametrize("named", [20_000, 1])
def test_the_best_of_many_terms_make_no_rows_of_pairs(spark, docs, monkeypatch, named):
    for name, value in (("FEW_TERMS", 1), ("NAMED_TERMS", named), ("PIECE_TERMS", 500), ("LEAST_PIECES", 3), ("DENSE", 900), ("SCORES", 700)):
        monkeypatch.setattr(R, name, value)
    copies = docs.where("doc_id % 30 = 0").selectExpr("doc_id + 7001 AS doc_id", "text")
    every = docs.unionByName(copies).unionByName(docs.where("doc_id < 9").selectExpr("doc_id", "concat(text, ' more') AS text"))
    queries = spark.createDataFrame(QUERIES, "query_id int, query string").unionByName(docs.where("doc_id % 20 = 0").selectExpr("cast(doc_id + 10 AS int) AS query_id", "text AS query"))
    rows = lambda d: sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 8)) for r in R.top_k(d, 7).collect())
    got = R.bm25(every, queries, best=7)
    assert "MapInArrow" in got._jdf.queryExecution().toString()
    assert rows(got) == rows(R.bm25(every, queries))
    twice = docs.unionByName(docs.where("doc_id IN (0, 3, 5001)"))  # such rows are one text
    assert rows(R.bm25(twice, queries, best=7)) == rows(R.bm25(twice, queries))


def test_queries_are_not_copied_for_pieces(spark, docs, monkeypatch):
    """With many pieces and with one, blocks of queries and groups of pieces meet in a product that reads both again; no row is made for each piece and query."""
    queries = docs.where("doc_id % 2 = 0").selectExpr("doc_id AS query_id", "text AS query")
    monkeypatch.setattr(R, "FEW_TERMS", 1)
    want, rows = None, lambda d: sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 8)) for r in R.top_k(d, 3).collect())
    for terms in (300, 10**6):
        monkeypatch.setattr(R, "PIECE_TERMS", terms)
        got = R.bm25(docs, queries, best=3)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Generate" not in plan
        found = rows(got)
        assert want is None or found == want
        want = found


def test_copies_score_alike_in_all_pieces(spark, monkeypatch):
    """Of copies in different pieces those with the smallest ids are the best, however a piece divides their terms into frequent and rare ones."""
    rng = random.Random(7)
    copy = [f"c{k}" for k in range(40) for _ in range(rng.randint(1, 4))]
    others = [" ".join(rng.choice([f"c{k}" for k in range(x % 40 + 1)] + [f"o{x % 7}"]) for _ in range(rng.randint(5, 120))) for x in range(300)]
    docs = spark.createDataFrame([(k * 2 + 1, x) for k, x in enumerate(others)] + [(k * 14, " ".join(copy)) for k in range(40)], "doc_id long, text string").repartition(6)
    queries = spark.createDataFrame([(q, " ".join(rng.sample(copy, 30) + copy)) for q in range(60)], "query_id long, query string")
    for name, value in (("FEW_TERMS", 1), ("PIECE_TERMS", 400), ("OFTEN", 1), ("DENSE", 900), ("LEAST_BLOCK", 300), ("LEAST_TASKS", 1000)):
        monkeypatch.setattr(R, name, value)
    best = R.bm25(docs, queries, best=5).collect()
    of_copies = {(r.query_id, r.score) for r in best if r.doc_id % 14 == 0}
    assert len(of_copies) == 60
    top = R.top_k(R.bm25(docs, queries, best=5), 5).collect()
    assert sorted((r.query_id, r["rank"], r.doc_id) for r in top) == [(q, k + 1, k * 14) for q in range(60) for k in range(5)]


def test_texts_become_postings_where_they_are_read(spark, docs, tmp_path, monkeypatch):
    for name, value in (("BLOCK_DOCS", 16), ("AT_ONCE", 50), ("BATCH", 7), ("LISTED", 2)):
        monkeypatch.setattr(postings, name, value)
    queries = spark.createDataFrame([*QUERIES, (6, "w1 w2 w3 w4 w5 common")], "query_id int, query string")
    rows = lambda d: sorted((r.query_id, r["rank"], -1 if r.doc_id is None else r.doc_id, round(r.score, 9)) for r in d.collect())
    unnamed = docs.unionByName(spark.createDataFrame([(None, "rare w1")], "doc_id long, text string"))
    twice = docs.unionByName(docs.where("doc_id IN (0, 3, 5001, 5002)"))  # such rows are one text
    for k, every in enumerate((docs, unnamed, twice, twice.unionByName(docs.where("doc_id = 6").selectExpr("doc_id", "concat(text, ' w1') AS text")))):
        every = every.coalesce(2)
        postings.add(every, path := f"file://{tmp_path}/{k}")
        assert rows(postings.Index(spark, path).search(queries, 500)) == rows(R.top_k(R.bm25(every, queries), 500))
        assert k > 1 or len(list((tmp_path / str(k) / "postings").rglob("*.parquet"))) <= 2  # a file for each task that reads texts
