"""Queries of blocks, text functions, evidence and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab as V
from ..operators import blocks as B
from ..operators import locate as L
from ..operators import spans as S
from ..sources import index, reader
from ..storage import scratch_path
from .registry import Catalog, Tables

catalog = Catalog()

_LINES = r"""x AS (SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS ls FROM documents),
u AS (SELECT doc_id, source, unnest(ls) AS text, generate_subscripts(ls, 1) - 1 AS block_index FROM x),
b AS (SELECT doc_id, source, block_index, text, coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY block_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "start" FROM u),
lb AS (SELECT doc_id, source, block_index, "start", "start" + length(text) AS "end", text, sha256(text) AS text_hash FROM b)"""


def _line_blocks(t: Tables, *carry: str) -> DataFrame:
    return B.placed(t.documents, B.lines(F.coalesce("text", F.lit(""))), "doc_id", *carry)


@catalog.query(f'WITH {_LINES} SELECT doc_id, block_index, "start", "end" FROM lb')
def line_blocks(t: Tables) -> DataFrame:
    return _line_blocks(t).select("doc_id", "block_index", "start", "end")


@catalog.query(f"WITH {_LINES} SELECT doc_id, block_index, text_hash FROM lb")
def block_hashes(t: Tables) -> DataFrame:
    return _line_blocks(t).select("doc_id", "block_index", "text_hash")


@catalog.query(f'WITH {_LINES} SELECT doc_id, count(*) AS n_blocks, sum("end" - "start")::BIGINT AS chars, round(avg("end" - "start"), 2) AS avg_chars, max("end" - "start") AS max_chars, sum(("end" - "start" > 800)::INT)::BIGINT AS n_oversized FROM lb GROUP BY doc_id')
def block_metrics(t: Tables) -> DataFrame:
    return B.metrics(_line_blocks(t), "doc_id")


@catalog.query(f"""WITH {_LINES}, r AS (SELECT doc_id, length(text) // 4 AS range_start, length(text) // 2 AS range_end FROM documents)
SELECT doc_id, count(*) AS n_blocks, min(block_index) AS first_block, max(block_index) AS last_block FROM lb JOIN r USING (doc_id) WHERE "end" > range_start AND "start" < range_end GROUP BY doc_id""")
def blocks_in_range(t: Tables) -> DataFrame:
    n = F.length("text")
    ranges = t.documents.select("doc_id", F.floor(n / 4).alias("range_start"), F.floor(n / 2).alias("range_end"))
    return B.overlapping(_line_blocks(t).select("doc_id", "block_index", "start", "end"), ranges, "doc_id").groupBy("doc_id").agg(F.count("*").alias("n_blocks"), F.min("block_index").alias("first_block"), F.max("block_index").alias("last_block"))


@catalog.query(f"""WITH {_LINES}, n AS (SELECT *, row_number() OVER w AS k, coalesce(sum("end" - "start") OVER (PARTITION BY source ORDER BY doc_id, block_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS book_start FROM lb WINDOW w AS (PARTITION BY source ORDER BY doc_id, block_index))
SELECT source, doc_id, block_index, 'block-' || lpad(k::VARCHAR, 6, '0') AS block_id, book_start, book_start + "end" - "start" AS book_end FROM n""")
def source_index(t: Tables) -> DataFrame:
    return B.book_blocks(_line_blocks(t, "source"), "source", "doc_id").select("source", "doc_id", "block_index", "block_id", "book_start", "book_end")


@catalog.query(f"""WITH {_LINES} SELECT doc_id, string_agg('{{block-' || lpad(block_index::VARCHAR, 4, '0') || ':paragraph}}' || text || '{{/block-' || lpad(block_index::VARCHAR, 4, '0') || '}}', '' ORDER BY block_index) AS marked_text FROM lb GROUP BY doc_id""")
def block_markers(t: Tables) -> DataFrame:
    return B.marked(_line_blocks(t), "doc_id")


_W = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^{_W}+|{_W}+$', '', 'g')"


_PERIOD = rf"""\.({_W}*)($|[A-Z\x{{3000}}-\x{{303f}}\x{{4e00}}-\x{{9fff}}]|["''‘“（(〔［｛][A-Z\x{{4e00}}-\x{{9fff}}])"""
_ABBREVIATED = rf"'(?i)((?:^|[^\p{{L}}])(?:{'|'.join(sorted(V.ABBREVIATIONS))})\.)' || chr(1)"
#: Paragraphs, and sentences of those that are too long: a mark goes behind each end of a sentence and is taken back after abbreviations; what the marks cut is folded.
_BLOCKS = rf"""units AS (SELECT row_number() OVER () AS u, * FROM documents),
para AS (SELECT u, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (SELECT u, list_filter(string_split(regexp_replace(text, '\n{_W}*\n', '\0' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS ps FROM units)),
core AS (SELECT *, {_strip("p")} AS c, length(p) - length(regexp_replace(p, '^{_W}+', '')) AS lead FROM para),
mark AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(c, '{_PERIOD}', '.' || chr(1) || '\1\2', 'g'), {_ABBREVIATED}, '\1', 'g'), {_ABBREVIATED}, '\1', 'g'), '([。！？；!?])', '\1' || chr(1), 'g') AS m FROM core),
raw AS (SELECT *, CASE WHEN contains(m, chr(1)) THEN list_reduce(list_transform(list_filter(string_split(m, chr(1)), lambda x: x <> ''), lambda x: [x]),
          lambda a, x: CASE WHEN {_strip("x[1]")} = '' OR length({_strip("a[-1]")}) < {V.MIN_FRAGMENT_CHARS} THEN list_append(a[:-2], a[-1] || x[1]) ELSE list_concat(a, x) END)
        ELSE list_transform(range(0, length(c), {V.MAX_BLOCK_CHARS}), lambda k: substr(c, k + 1, {V.MAX_BLOCK_CHARS})) END AS r FROM mark WHERE length(c) > {V.MAX_BLOCK_CHARS}),
cut AS (SELECT u, i, 0 AS j, p AS text FROM core WHERE length(c) <= {V.MAX_BLOCK_CHARS}
        UNION ALL SELECT u, i, j, CASE WHEN j = 1 THEN substr(p, 1, lead) ELSE '' END || t || CASE WHEN j = len(r) THEN substr(p, lead + length(c) + 1) ELSE '' END FROM (SELECT u, i, p, c, lead, r, unnest(r) AS t, generate_subscripts(r, 1) AS j FROM raw)),
blocks AS (SELECT units.doc_id, row_number() OVER w - 1 AS block_index, (coalesce(sum(length(cut.text)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS "start", cut.text FROM cut JOIN units USING (u) WINDOW w AS (PARTITION BY u ORDER BY i, j))"""


@catalog.query(rf"""WITH {_BLOCKS} SELECT doc_id, block_index, "start", "start" + length(text) AS "end", sha256(text) AS text_hash, 'paragraph' AS block_type, regexp_matches(text, '{V.RULE_LINE}') AS is_rule FROM blocks""")
def source_blocks(t: Tables) -> DataFrame:
    return B.source_blocks(t.documents, "doc_id").select("doc_id", "block_index", "start", "end", "text_hash", "block_type", "is_rule")


@catalog.query(rf"""WITH {_BLOCKS}, b AS (SELECT doc_id, count(*) AS n, max("start" + length(text)) AS c FROM blocks GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_blocks, 0::BIGINT AS n_breaks, coalesce(c, 0) AS covered, length(text)::BIGINT AS chars FROM documents LEFT JOIN b USING (doc_id)""")
def source_block_issues(t: Tables) -> DataFrame:
    """Contiguity by document: blocks found, breaks, and whether they make up the text. A document without blocks has a row too."""
    b = B.source_blocks(t.documents, "doc_id").select("doc_id", "block_index", "start", "end")
    nxt = F.lead("start").over(Window.partitionBy("doc_id").orderBy("block_index"))
    g = b.withColumn("broken", (F.coalesce(nxt, F.col("end")) != F.col("end")).cast("long")).groupBy("doc_id").agg(F.count("*").alias("n_blocks"), F.sum("broken").alias("n_breaks"), F.max("end").alias("covered"))
    none = F.lit(0).cast("long")
    chars = t.documents.select("doc_id", F.length("text").cast("long").alias("chars"))
    return chars.join(g, "doc_id", "left").select("doc_id", *[F.coalesce(c, none).alias(c) for c in ("n_blocks", "n_breaks", "covered")], "chars")


@catalog.query(rf"""WITH {_BLOCKS} SELECT doc_id AS unit_id, block_index, format('block-{{:06d}}', row_number() OVER w) AS block_id, (coalesce(sum(length(text)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS book_start, sum(length(text)) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS book_end, sha256(text) AS text_hash,
(SELECT count(DISTINCT doc_id) FROM documents) AS unit_count, (SELECT count(*) FROM blocks) AS block_count, (SELECT sum(length(text))::BIGINT FROM blocks) AS total_chars FROM blocks WINDOW w AS (ORDER BY doc_id, block_index)""")
def source_index_saved(t: Tables) -> DataFrame:
    """The source index of all documents as one book, saved and read again: blocks placed in the book beside the index's counts."""
    built = index.build(t.documents.select(F.col("doc_id").alias("unit_id"), "text"), "documents", t.sf_dir, "", "parquet")
    held = index.load(t.spark, index.save(t.spark, built, scratch_path(t.spark, "source_index")))
    counts = [F.lit(held["meta"][c]).cast("long").alias(c) for c in ("unit_count", "block_count", "total_chars")]
    return held["blocks"].select("unit_id", "block_index", "block_id", "book_start", "book_end", "text_hash", *counts)


@catalog.query(r"""SELECT doc_id, length(text)::BIGINT AS chars, strlen(text)::BIGINT AS utf8_bytes, len(string_split(text, chr(10)))::BIGINT AS n_lines, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S')))::BIGINT AS n_text_lines FROM documents""")
def text_length_stats(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", *T.length_stats(F.col("text")))


@catalog.query(r"""WITH x AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ls FROM documents)
SELECT doc_id, coalesce(ls[1], '') AS first_line, coalesce(ls[-1], '') AS last_line FROM x""")
def first_last_line(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.first_line(F.col("text")).alias("first_line"), T.last_line(F.col("text")).alias("last_line"))


@catalog.query(rf"""WITH x AS (SELECT doc_id, length(text) AS n, length(regexp_replace(text, '[^{V.CJK}]', '', 'g')) AS c FROM documents), e AS (SELECT doc_id, greatest(1, (c * 6 + (n - c) * 3) // 10 + 1)::BIGINT AS tokens FROM x)
SELECT doc_id, tokens, (4096 <= 0 OR 4096 > 384000 OR tokens + 4096 > 850000) AS over_budget FROM e""")
def token_budget(t: Tables) -> DataFrame:
    e = t.documents.select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))
    return e.withColumn("over_budget", T.over_budget(F.col("tokens"), F.lit(4096)))


@catalog.query(r"""WITH x AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS f FROM documents) SELECT doc_id, CASE WHEN length(f) > 120 THEN substr(f, 1, 117) || '...' ELSE f END AS preview FROM x""")
def text_previews(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.preview(F.col("text")).alias("preview"))


@catalog.query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, json_extract_string('{\"k\": 1}', '$.k')::BIGINT AS fallback_k FROM events")
def json_tolerant(t: Tables) -> DataFrame:
    strict = F.try_variant_get(T.tolerant_json(F.col("props")), "$.k", "bigint")
    wrapped = F.try_variant_get(T.tolerant_json(F.lit('Here it is: {"k": 1} - done')), "$.k", "bigint")
    return t.events.select("event_id", strict.alias("k"), wrapped.alias("fallback_k"))


_MARKS = "".join(V.DROPPED_MARKS).replace("'", "''")
_NORM = rf"""translate(translate(regexp_replace(regexp_replace({{}}, '\[\d{{{{1,4}}}}\]', '', 'g'), '[\s　]+', '', 'g'), '{V.FOLD_FROM}', '{V.FOLD_TO.replace("'", "''")}'), '{_MARKS}', '')"""


def _quotes(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", F.col("text").alias("quote"))


@catalog.query("""SELECT doc_id, item_id, CASE WHEN n = 1 THEN 'exact' ELSE 'ambiguous' END AS status, strpos(text, quote) - 1 AS "start", n AS n_found
FROM (SELECT doc_id, item_id, d.text, b.text AS quote, ((length(d.text) - length(replace(d.text, b.text, ''))) // length(b.text))::BIGINT AS n FROM documents d JOIN benchmark b ON contains(d.text, b.text))""")
def evidence_exact(t: Tables) -> DataFrame:
    return L.exact_evidence(t.documents, _quotes(t))


@catalog.query(f"""WITH d AS (SELECT doc_id, {_NORM.format('text')} AS n FROM documents), b AS (SELECT item_id, {_NORM.format('text')} AS q FROM benchmark)
SELECT doc_id, item_id, ((length(n) - length(replace(n, q, ''))) // length(q))::BIGINT AS n_found FROM d JOIN b ON contains(n, q)""")
def evidence_normalized(t: Tables) -> DataFrame:
    """Quotes in the loosest normal form."""
    pairs = L.normal_pairs(t.documents, _quotes(t))
    d = t.documents.select("doc_id", T.normal_form(F.col("text"), 4).alias("n"))
    q = _quotes(t).select("item_id", T.normal_form(F.col("quote"), 4).alias("q"))
    found = pairs.join(d, "doc_id").join(q, "item_id").withColumn("n_found", T.occurrences(F.col("n"), F.col("q")))
    return found.where("n_found > 0").select("doc_id", "item_id", "n_found")


#: Normal forms of the tiers of quote location in SQL.
_NOTES = r"regexp_replace({}, '\[\d{{1,4}}\]', '', 'g')"
_TIER2 = rf"regexp_replace({_NOTES}, '[\s　]+', '', 'g')"
_TIER3 = f"""translate({_TIER2}, '{V.FOLD_FROM}', '{V.FOLD_TO.replace("'", "''")}')"""
_COUNT = "CASE WHEN {q} = '' THEN 0 ELSE (length({t}) - length(replace({t}, {q}, ''))) // length({q}) END"
_STATUS = (
    f"""d AS (SELECT doc_id, coalesce(text, '') AS t1, {_TIER2.format("coalesce(text, '')")} AS t2, {_TIER3.format("coalesce(text, '')")} AS t3, {_NORM.format("coalesce(text, '')")} AS t4 FROM documents),
b AS (SELECT item_id, text AS q1, {_TIER2.format("text")} AS q2, {_TIER3.format("text")} AS q3, {_NORM.format("text")} AS q4 FROM benchmark),
c AS (SELECT * FROM d JOIN b ON contains(t4, q4) OR contains(t1, q1) OR doc_id = item_id),
n AS (SELECT doc_id, item_id, """
    + ", ".join(f"({_COUNT.format(t=f't{k}', q=f'q{k}')})::BIGINT AS n{k}" for k in (1, 2, 3, 4))
    + """ FROM c),
s AS (SELECT doc_id, item_id, CASE WHEN n1 = 1 THEN 'exact' WHEN n1 > 1 THEN 'ambiguous' WHEN n2 = 1 THEN 'relocated' WHEN n2 > 1 THEN 'ambiguous' WHEN n3 = 1 THEN 'relocated' WHEN n3 > 1 THEN 'ambiguous' WHEN n4 = 1 THEN 'relocated' WHEN n4 > 1 THEN 'ambiguous' ELSE 'missing' END AS status,
 CASE WHEN n1 > 0 THEN 'exact' WHEN n2 > 0 THEN 'annotation_whitespace_tolerant' WHEN n3 > 0 THEN 'annotation_whitespace_punctuation_tolerant' WHEN n4 > 0 THEN 'annotation_whitespace_punctuation_dropped' ELSE 'not_found' END AS strategy,
 CASE WHEN n1 > 0 THEN n1 WHEN n2 > 0 THEN n2 WHEN n3 > 0 THEN n3 ELSE n4 END AS n_candidates FROM n)"""
)


def _locations(t: Tables) -> DataFrame:
    """Each document cites the quote that has its own number, and every quote that it holds."""
    own = t.documents.select("doc_id").join(t.benchmark.select("item_id"), F.col("doc_id") == F.col("item_id"))
    return L.cited(t.documents, _quotes(t), L.location_pairs(t.documents, _quotes(t)).union(own).distinct())


#: Notes are put out of the way by as many private characters; what is left of a text has its places in the whole.
_HIDDEN = "coalesce(text, '')"
for _n in (1, 2, 3, 4):
    _HIDDEN = rf"regexp_replace({_HIDDEN}, '\[\d{{{{{_n}}}}}\]', repeat(chr(57344), {_n + 2}), 'g')".replace("{{", "{").replace("}}", "}")
_PLACES = f"""h AS (SELECT doc_id, string_split({_HIDDEN}, '') AS cs FROM documents),
r AS (SELECT s.doc_id, s.item_id, status, strategy, n_candidates, cs, t1, CASE WHEN strategy = 'exact' THEN 1 WHEN strategy LIKE '%dropped' THEN 4 ELSE 2 END AS tier,
 CASE WHEN strategy = 'exact' THEN t1 WHEN strategy LIKE '%dropped' THEN t4 WHEN strategy LIKE '%punctuation_tolerant' THEN t3 ELSE t2 END AS x,
 CASE WHEN strategy = 'exact' THEN q1 WHEN strategy LIKE '%dropped' THEN q4 WHEN strategy LIKE '%punctuation_tolerant' THEN q3 ELSE q2 END AS q FROM s JOIN c USING (doc_id, item_id) JOIN h USING (doc_id)),
k AS (SELECT *, strpos(x, q) AS a, CASE WHEN tier > 1 AND status = 'relocated' THEN list_filter(range(1, len(cs) + 1), lambda i: cs[i] <> chr(57344) AND NOT regexp_matches(cs[i], '[\\s　]') AND (tier < 4 OR NOT contains('{_MARKS}', cs[i]))) END AS kept FROM r),
e AS (SELECT *, CASE WHEN status IN ('exact', 'relocated') THEN CASE WHEN tier = 1 THEN a - 1 ELSE kept[a] - 1 END END AS "start", CASE WHEN status IN ('exact', 'relocated') THEN CASE WHEN tier = 1 THEN a - 1 + length(q) ELSE kept[a + length(q) - 1] END END AS e0 FROM k)
SELECT doc_id, item_id, status, strategy, "start"::BIGINT AS "start", (e0 + CASE WHEN tier = 4 AND e0 IS NOT NULL THEN length(t1) - e0 - length(ltrim(substr(t1, e0 + 1), '{_MARKS}')) ELSE 0 END)::BIGINT AS "end", n_candidates FROM e"""


@catalog.query(f"WITH {_STATUS}, {_PLACES}")
def evidence_locations(t: Tables) -> DataFrame:
    return _locations(t)


@catalog.query(f"WITH {_STATUS} SELECT * FROM s")
def evidence_status(t: Tables) -> DataFrame:
    return _locations(t).select("doc_id", "item_id", "status", "strategy", "n_candidates")


@catalog.query(f"WITH {_STATUS} SELECT doc_id, count(*) FILTER (WHERE status = 'exact') AS exact, count(*) FILTER (WHERE status = 'relocated') AS relocated, count(*) FILTER (WHERE status = 'ambiguous') AS ambiguous, count(*) FILTER (WHERE status = 'missing') AS missing FROM s GROUP BY doc_id")
def evidence_status_histogram(t: Tables) -> DataFrame:
    """Locations by status of each document, with a column for each status."""
    return _locations(t).groupBy("doc_id").pivot("status", ["exact", "relocated", "ambiguous", "missing"]).count().fillna(0)


@catalog.query("""WITH s AS (SELECT doc_id AS unit_id, item_id AS segment_id, strpos(d.text, b.text) - 1 AS a, length(d.text) AS n FROM documents d JOIN benchmark b ON contains(d.text, b.text)),
o AS (SELECT *, lead(a) OVER (PARTITION BY unit_id ORDER BY a, segment_id) AS nxt FROM s)
SELECT unit_id, segment_id, a::BIGINT AS "start", coalesce(nxt, n)::BIGINT AS "end" FROM o WHERE a < coalesce(nxt, n)""")
def overview_segments(t: Tables) -> DataFrame:
    """Documents cut at the passages found in them: each passage starts a segment whose end is open until it is filled."""
    e = L.exact_evidence(t.documents, _quotes(t)).join(t.documents.select("doc_id", F.length("text").cast("long").alias("unit_chars")), "doc_id")
    seg = e.select(F.col("doc_id").alias("unit_id"), F.col("item_id").alias("segment_id"), "start", F.col("unit_chars").alias("end"), "unit_chars")
    return L.resolved_segments(seg)


@catalog.query(rf"""WITH q AS (SELECT item_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM benchmark),
c AS (SELECT item_id, list_concat([t], flatten(list_transform(string_split_regex(t, '{V.CLAUSE_ENDS}'), lambda c: list_transform(list_filter([0, 2, 4, 6], lambda s: length(c) - s >= 4), lambda s: substr(c, s + 1))))) AS parts FROM q),
e AS (SELECT item_id, flatten(list_transform(parts, lambda p: [substr(p, 1, 12), substr(p, 1, 8), substr(p, 1, 4)])) AS es FROM c),
u AS (SELECT item_id, unnest(es) AS needle, generate_subscripts(es, 1) AS k FROM e)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY min(k)) - 1)::INT AS rank, needle FROM u WHERE length(needle) >= 2 GROUP BY item_id, needle""")
def quote_needles(t: Tables) -> DataFrame:
    """By what each passage is looked for where a text does not hold it."""
    return L.needle_rows(_quotes(t))


_STRIP = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', chr(10), 'g'), '(?s)<!--.*?-->', chr(10), 'g'), '(?s)<[^>]*>', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n\s*', chr(10), 'g'), '^\s+|\s+$', '', 'g')"""


@catalog.query(f"SELECT page_id, {_STRIP} AS text FROM pages")
def html_flatten_regex(t: Tables) -> DataFrame:
    return t.pages.select("page_id", reader.strip_tags(F.col("html")).alias("text"))


@catalog.query()
def html_flatten(t: Tables) -> DataFrame:
    flat = reader.flatten_pages(t.pages)
    return flat.select("page_id", "text", "title", F.size("headings").cast("long").alias("n_headings"), "n_anchors")


@catalog.query(r"""WITH h AS (SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')) AS label FROM pages)
SELECT page_id, label, CASE WHEN regexp_matches(lower(label), '\b(part|book)\b') THEN 'part' WHEN regexp_matches(lower(label), '\bchapter\b') THEN 'chapter' ELSE 'section' END AS kind, regexp_matches(lower(label), 'contents') AS is_toc FROM h""")
def page_headings(t: Tables) -> DataFrame:
    label = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1), "<[^>]*>", ""))
    h = t.pages.select("page_id", label.alias("label"))
    return h.select("page_id", "label", T.label_kind(F.col("label")).alias("kind"), F.lower("label").contains("contents").alias("is_toc"))


_SCAN = r"""t AS (SELECT doc_id AS unit_id, lower(text) AS text FROM documents),
f AS (SELECT DISTINCT unnest(tk) AS surface FROM (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS tk FROM benchmark))
SELECT unit_id, surface, ((length(text) - length(replace(text, surface, ''))) // length(surface))::BIGINT AS n_found FROM t JOIN f ON contains(text, surface) WHERE length(surface) >= 2"""


def _surfaces(t: Tables) -> DataFrame:
    """Terms of the benchmark with two or more letters."""
    return t.benchmark.select(F.explode(T.tokens(F.col("text"))).alias("surface")).distinct().where(F.length("surface") >= S.LEAST_SURFACE)


def _records(t: Tables) -> DataFrame:
    return _surfaces(t).withColumn("record_id", F.concat(F.lit("r-"), "surface"))


def _lower_units(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("unit_id"), F.lower("text").alias("text"))


@catalog.query("WITH " + _SCAN)
def surface_scan(t: Tables) -> DataFrame:
    """Terms of the benchmark, and how often each text holds them, inside words too."""
    return S.surface_counts(_lower_units(t), _surfaces(t))


#: All places of the terms, found by length in what follows each place; stretches of overlapping ones; of each stretch, the longest first, those that none before overlaps.
_GREEDY = r"""t AS (SELECT doc_id AS unit_id, lower(text) AS text FROM documents),
f AS (SELECT DISTINCT unnest(tk) AS surface FROM (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS tk FROM benchmark)),
n AS (SELECT DISTINCT length(surface) AS n FROM f WHERE length(surface) >= 2),
p AS (SELECT unit_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) - 1 AS s, (SELECT max(n) FROM n) AS most FROM t),
x AS (SELECT unit_id, s, string_agg(c, '') OVER (PARTITION BY unit_id ORDER BY s ROWS BETWEEN CURRENT ROW AND most FOLLOWING) AS x FROM p),
m AS (SELECT unit_id, s, s + n AS e, surface FROM (SELECT unit_id, s, n, left(x, n) AS g FROM x, n WHERE length(x) >= n) JOIN f ON surface = g),
r AS (SELECT *, max(e) OVER (PARTITION BY unit_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM m),
i AS (SELECT *, count(*) FILTER (WHERE reach IS NULL OR s >= reach) OVER (PARTITION BY unit_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM r),
g AS (SELECT unit_id, list([{s: s, e: e, surface: surface}] ORDER BY e - s DESC, s, surface) AS l FROM i GROUP BY unit_id, island),
w AS (SELECT unit_id, unnest(list_reduce(l, lambda a, x: CASE WHEN len(list_filter(a, lambda y: y.s < x[1].e AND y.e > x[1].s)) > 0 THEN a ELSE list_concat(a, x) END)) AS c FROM g),
c AS (SELECT unit_id, c.s::INT AS "start", c.e::INT AS "end", 'r-' || c.surface AS record_id FROM w)"""


@catalog.query(f"WITH {_GREEDY} SELECT * FROM c")
def surface_scan_greedy(t: Tables) -> DataFrame:
    """Places of the benchmark's terms, longer ones first, none of which overlap."""
    return S.greedy_surfaces(_lower_units(t), _records(t))


@catalog.query(f"""WITH {_GREEDY}, k AS (SELECT unit_id, record_id, count(*) AS match_count, count(*) FILTER (WHERE "end" - "start" <= {S.UNSURE_SURFACE}) AS n_unsure, min("start")::BIGINT AS first_start FROM c GROUP BY unit_id, record_id)
SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY match_count DESC, record_id) AS place FROM k""")
def surface_scan_report(t: Tables) -> DataFrame:
    """Of each text the terms that it names, most often named first."""
    return S.surface_report(_lower_units(t), _records(t))


@catalog.query(r"""WITH f AS (SELECT DISTINCT unnest(tk) AS surface FROM (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS tk FROM benchmark))
SELECT surface AS record_id FROM f WHERE length(surface) >= 2 AND NOT EXISTS (SELECT 1 FROM pages WHERE contains(lower(html), surface))""")
def unmatched_surfaces(t: Tables) -> DataFrame:
    """Terms of the benchmark that no page holds."""
    units = t.pages.select(F.col("page_id").alias("unit_id"), F.lower("html").alias("text"))
    some = _surfaces(t).select(F.col("surface").alias("record_id"), "surface")
    return S.unmatched_records(S.surface_matches(units, some), units, some)


_WORDS = r"""w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\n]*\n|[^\n]+')) AS l, generate_subscripts(regexp_extract_all(text, '[^\n]*\n|[^\n]+'), 1) AS k FROM documents),
o AS (SELECT doc_id, k, coalesce(sum(length(l)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a, length(l) AS n FROM w),
s AS (SELECT doc_id, a AS "start", a + 2 * n AS "end" FROM o),
m AS (SELECT doc_id, p, sum(d) AS d FROM (SELECT doc_id, "start" AS p, 1 AS d FROM s UNION ALL SELECT doc_id, "end", -1 FROM s) GROUP BY doc_id, p),
c AS (SELECT doc_id, p AS "start", lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS "end", sum(d) OVER (PARTITION BY doc_id ORDER BY p) AS depth FROM m)
SELECT doc_id, "start", "end", depth::BIGINT AS depth FROM c WHERE "end" IS NOT NULL AND depth > 0"""


@catalog.query("WITH " + _WORDS)
def boundary_sweep(t: Tables) -> DataFrame:
    """Line blocks, each stretched to twice its length, cut at all their bounds."""
    b = _line_blocks(t)
    spans = b.select("doc_id", "start", (F.col("end") + F.length("text")).alias("end"))
    return S.sweep(spans, "doc_id")
