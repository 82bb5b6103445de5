"""Queries of candidate retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import postings
from ..operators import retrieval as R
from ..operators import vectors
from ..sources import store
from ..storage import scratch_path
from .registry import Catalog, Tables

catalog = Catalog()

#: Fixed queries of the flagship.
QUERIES = [(0, "the relation of the nation and the motion"), (1, "une question de la lettre et le mot"), (2, "der die und nicht mit der zeit")]
_TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+')"

#: Scores of each query (query_id, query) and document.
BM25 = (
    f"""t AS (SELECT doc_id, lang, {_TOKENS.format("text")} AS tk FROM documents),
st AS (SELECT count(*) AS n, avg(len(tk)) AS avgdl FROM t),
tf AS (SELECT doc_id, lang, dl, term, count(*) AS f FROM (SELECT doc_id, lang, len(tk) AS dl, unnest(tk) AS term FROM t) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
qt AS (SELECT query_id, term, count(*) AS qf FROM (SELECT query_id, unnest({_TOKENS.format("query")}) AS term FROM q) GROUP BY ALL),
bm AS (SELECT query_id, doc_id, any_value(lang) AS lang, sum(qf * ln((n - df + 0.5) / (df + 0.5) + 1) * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * dl / greatest(avgdl, 1.0)))) AS score
       FROM qt JOIN tf USING (term) JOIN df USING (term), st GROUP BY query_id, doc_id)"""
)
_FIXED = "q AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{t}')" for i, t in QUERIES) + ") AS v(query_id, query))"
_RANKED = "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM {})"
_COSINE = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
c AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)) + 1e-8) AS score
      FROM e a, e b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM c WHERE score > 0.3)"""


def _fixed(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(QUERIES, "query_id long, query string")


def _vector_queries(t: Tables) -> DataFrame:
    """The stated query set of similarity search: every twentieth id."""
    return t.embeddings.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@catalog.query(f"WITH {_FIXED}, {BM25}, {_RANKED.format('bm')} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM r WHERE rank <= 20")
def bm25_topk_documents(t: Tables) -> DataFrame:
    scores = R.bm25(t.documents, _fixed(t))
    return R.top_k(scores, 20).select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@catalog.query(f"WITH {_FIXED}, {BM25}, {_RANKED.format('bm')} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM r WHERE rank <= 20")
def bm25_index_topk(t: Tables) -> DataFrame:
    """The same from an index on disk that documents are added to in two parts."""
    path = scratch_path(t.spark, "bm25_index")
    for part in ("en", "other"):
        postings.add(t.documents.where((F.coalesce("lang", F.lit("")) == "en") == F.lit(part == "en")), path)
    top = postings.Index(t.spark, path).search(_fixed(t), 20)
    return top.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@catalog.query(f"WITH q AS (SELECT item_id AS query_id, text AS query FROM benchmark), {BM25}, {_RANKED.format('bm')} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM r WHERE rank <= 5")
def bm25_benchmark_top5(t: Tables) -> DataFrame:
    scores = R.bm25(t.documents, t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("query")), best=5)
    return R.top_k(scores, 5).select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@catalog.query(f"WITH {_FIXED}, {BM25}, {_RANKED.format('bm')} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM r WHERE rank <= 20 AND lang = 'en'")
def bm25_lang_filter_after_topk(t: Tables) -> DataFrame:
    top = R.top_k(R.bm25(t.documents, _fixed(t), "lang"), 20).where("lang = 'en'")
    return top.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@catalog.query(f"WITH {_FIXED}, {BM25}, en AS (SELECT * FROM bm WHERE lang = 'en'), {_RANKED.format('en')} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM r WHERE rank <= 20")
def bm25_lang_filter_before_topk(t: Tables) -> DataFrame:
    top = R.top_k(R.bm25(t.documents, _fixed(t), "lang").where("lang = 'en'"), 20)
    return top.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@catalog.query(f"SELECT doc_id, len(tk)::BIGINT AS n_tokens, len(list_distinct(tk))::BIGINT AS n_terms FROM (SELECT doc_id, {_TOKENS.format('text')} AS tk FROM documents)")
def token_stats(t: Tables) -> DataFrame:
    tk = t.documents.select("doc_id", T.let(T.tokens(F.col("text")), lambda v: F.struct(F.size(v).cast("long").alias("n"), F.size(F.array_distinct(v)).cast("long").alias("d"))).alias("s"))
    return tk.select("doc_id", F.col("s.n").alias("n_tokens"), F.col("s.d").alias("n_terms"))


@catalog.query(
    f"""WITH t AS (SELECT {_TOKENS.format("text")} AS tk FROM documents), n AS (SELECT count(*) AS n FROM t)
SELECT term, count(*) AS df, round(ln((any_value(n) - count(*) + 0.5) / (count(*) + 0.5) + 1), 6) AS idf FROM (SELECT unnest(list_distinct(tk)) AS term, n FROM t, n) GROUP BY term"""
)
def term_idf(t: Tables) -> DataFrame:
    n = t.documents.agg(F.count("*").alias("n"))
    df = t.documents.select(F.explode(F.array_distinct(T.tokens(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("term", "df", F.round(F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1), 6).alias("idf"))


@catalog.query(f"WITH {_COSINE} SELECT query_id, vec_id, rank, round(score, 6) AS score FROM k WHERE rank <= 10")
def cosine_topk_embeddings(t: Tables) -> DataFrame:
    top = R.top_k(R.cosine(t.embeddings, _vector_queries(t), best=10), 10, doc="vec_id")
    return top.select("query_id", "vec_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@catalog.query()
def cosine_index_topk(t: Tables) -> DataFrame:
    """The ten nearest of every vector by an index of lists; the tests measure its recall against all pairs."""
    centroids, probes = vectors.fit(t.embeddings, 64)
    top = vectors.nearest(vectors.index(t.embeddings, centroids), t.embeddings.select(F.col("vec_id").alias("query_id"), "embedding"), centroids, 10, probes)
    return top.select("query_id", "vec_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@catalog.query(f"WITH {_COSINE} SELECT query_id, count(*) AS n, sum((a.label = b.label)::INT)::BIGINT AS n_same FROM k JOIN e a ON a.vec_id = query_id JOIN e b ON b.vec_id = k.vec_id WHERE rank <= 20 GROUP BY query_id")
def recall_at_k(t: Tables) -> DataFrame:
    return R.recall_at_k(R.cosine(t.embeddings, _vector_queries(t), best=20), t.embeddings.select("vec_id", "label"), 20)


@catalog.query(
    f"WITH {_FIXED}, {BM25}, {_RANKED.format('bm')}, f AS (SELECT doc_id, sum(1.0 / (60 + rank)) AS rrf FROM r WHERE rank <= 100 GROUP BY doc_id) SELECT doc_id, round(rrf, 9) AS rrf FROM f"
)
def rrf_fusion(t: Tables) -> DataFrame:
    top = R.top_k(R.bm25(t.documents, _fixed(t)), 100).withColumn("all", F.lit(0))
    return R.fuse(top, "all").select("doc_id", F.round("rrf", 9).alias("rrf"))


@catalog.query(
    f"""WITH {_COSINE}, q AS (SELECT doc_id AS query_id, text AS query FROM documents WHERE doc_id % 20 = 0), {BM25},
b AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM bm),
s AS (SELECT query_id, vec_id AS doc_id, rank, true AS emb FROM k WHERE rank <= 20 UNION ALL SELECT query_id, doc_id, rank, false FROM b WHERE rank <= 20),
f AS (SELECT query_id, doc_id, sum(1.0 / (60 + rank)) AS rrf, bool_or(emb) AS has_embedding, string_agg(CASE WHEN emb THEN 'cosine' ELSE 'bm25' END, '+' ORDER BY emb) AS methods FROM s GROUP BY query_id, doc_id),
g AS (SELECT *, row_number() OVER (PARTITION BY query_id, has_embedding ORDER BY round(rrf, 9) DESC, doc_id) AS rn FROM f)
SELECT query_id, doc_id, methods, round(rrf, 9) AS rrf FROM g WHERE (has_embedding AND rn <= 5) OR (NOT has_embedding AND rn <= 3)"""
)
def dual_signal_candidates(t: Tables) -> DataFrame:
    """Whole texts of every twentieth document against all documents, and vectors where there are any."""
    cos = R.top_k(R.cosine(t.embeddings, _vector_queries(t), best=20), 20, doc="vec_id").select("query_id", F.col("vec_id").alias("doc_id"), "rank", F.lit("cosine").alias("method"))
    q = t.documents.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query"))
    bm = R.top_k(R.bm25(t.documents, q, best=20), 20).select("query_id", "doc_id", "rank", F.lit("bm25").alias("method"))
    both = cos.unionByName(bm)
    f = both.groupBy("query_id", "doc_id").agg(F.sum(1.0 / (R.RRF + F.col("rank"))).alias("rrf"), F.max(F.col("method") == "cosine").alias("has_embedding"), F.array_join(F.sort_array(F.collect_set("method")), "+").alias("methods"))
    return R.capped_candidates(f).select("query_id", "doc_id", "methods", F.round("rrf", 9).alias("rrf"))


@catalog.query(
    """WITH h AS (SELECT doc_id, lang, sha256(coalesce(text, '')) AS text_hash FROM documents), s AS (SELECT DISTINCT text_hash FROM h WHERE lang = 'en')
SELECT lang, count(*) FILTER (WHERE text_hash IN (SELECT text_hash FROM s)) AS n_hits, count(*) FILTER (WHERE text_hash NOT IN (SELECT text_hash FROM s)) AS n_misses FROM h GROUP BY lang"""
)
def embedding_cache_hits_misses(t: Tables) -> DataFrame:
    h = t.documents.select("doc_id", "lang", store.text_hash(F.col("text")).alias("text_hash"))
    hits, misses = store.cached(h, h.where("lang = 'en'").select("text_hash").distinct(), "text_hash")
    both = hits.select("lang", F.lit(1).alias("h"), F.lit(0).alias("m")).unionByName(misses.select("lang", F.lit(0).alias("h"), F.lit(1).alias("m")))
    return both.groupBy("lang").agg(F.sum("h").alias("n_hits"), F.sum("m").alias("n_misses"))


def _concepts(t: Tables, which: str) -> DataFrame:
    """Part names as concepts of either side: a name and type is a concept, its brands are aliases."""
    p = t.part.where(which).groupBy("p_name", "p_type").agg(F.min("p_partkey").alias("id"), F.sort_array(F.collect_set("p_brand")).alias("aliases"))
    return p.select("id", F.when(F.col("p_type") == "SMALL", "other").otherwise(F.lower("p_type")).alias("concept_type"), F.col("p_name").alias("surface"), F.element_at("aliases", 1).alias("canonical_name"), "aliases", F.array("p_name").alias("observed"))


_CONCEPTS = """cc AS (SELECT min(p_partkey) AS id, CASE WHEN p_type = 'SMALL' THEN 'other' ELSE lower(p_type) END AS ty, p_name AS surface, min(p_brand) AS cname, list(DISTINCT p_brand) AS aliases, p_size < 25 AS book FROM part GROUP BY p_name, p_type, p_size < 25),
nn AS (SELECT id, ty, book, 'surface' AS kind, lower(surface) AS name FROM cc UNION SELECT id, ty, book, 'cname', lower(cname) FROM cc UNION SELECT id, ty, book, 'alias', lower(a) FROM (SELECT id, ty, book, unnest(aliases) AS a FROM cc)),
pp AS (SELECT DISTINCT u.id AS unit_ref, r.id AS book_ref FROM nn u JOIN nn r ON u.name = r.name AND NOT u.book AND r.book
       WHERE ((u.ty = 'other' OR u.ty = r.ty) AND NOT (u.kind = 'cname' AND r.kind = 'surface')) OR (u.kind = 'cname' AND r.kind IN ('cname', 'alias')))"""


@catalog.query(f"WITH {_CONCEPTS} SELECT unit_ref, book_ref FROM pp")
def deterministic_candidates(t: Tables) -> DataFrame:
    return R.name_candidates(_concepts(t, "p_size >= 25"), _concepts(t, "p_size < 25"))


@catalog.query("WITH a AS (SELECT DISTINCT p_name, p_brand FROM part WHERE p_size >= 25) SELECT p_name, p_brand FROM a WHERE NOT EXISTS (SELECT 1 FROM part b WHERE b.p_size < 25 AND b.p_name = a.p_name AND b.p_brand = a.p_brand)")
def unmatched_remainder(t: Tables) -> DataFrame:
    unit = t.part.where("p_size >= 25").select("p_name", "p_brand").distinct()
    return unit.join(t.part.where("p_size < 25").select("p_name", "p_brand"), ["p_name", "p_brand"], "left_anti")


@catalog.query("SELECT min(p_partkey) AS concept_id, p_name AS surface, p_type AS concept_type, CASE WHEN length(string_agg(DISTINCT p_brand, ' ' ORDER BY p_brand)) > 120 THEN left(string_agg(DISTINCT p_brand, ' ' ORDER BY p_brand), 117) || '...' ELSE string_agg(DISTINCT p_brand, ' ' ORDER BY p_brand) END AS summary FROM part GROUP BY p_name, p_type")
def registry_index(t: Tables) -> DataFrame:
    g = t.part.groupBy("p_name", "p_type").agg(F.min("p_partkey").alias("concept_id"), F.array_join(F.sort_array(F.collect_set("p_brand")), " ").alias("s"))
    return g.select("concept_id", F.col("p_name").alias("surface"), F.col("p_type").alias("concept_type"), T.cut_summary(F.col("s")).alias("summary"))


@catalog.query("SELECT p_partkey AS concept_id, coalesce(nullif(p_name, ''), p_brand) AS name, (SELECT count(*) FROM part) - 50 AS n_omitted FROM part ORDER BY p_partkey LIMIT 50")
def digest_top50(t: Tables) -> DataFrame:
    n = t.part.agg((F.count("*") - 50).alias("n_omitted"))
    top = t.part.select(F.col("p_partkey").alias("concept_id"), F.coalesce(T.blank_to_null(F.col("p_name")), "p_brand").alias("name")).orderBy("concept_id").limit(50)
    return top.crossJoin(F.broadcast(n))
