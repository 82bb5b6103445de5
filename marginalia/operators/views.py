"""What a viewer shows of a registry and its source: inverse indexes, aligned offsets, annotated and stitched texts, outlines, pages."""

from __future__ import annotations

import html
import json
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import ship
from . import spans as S
from .graph import paths
from .skew import in_pieces

Record = dict[str, Any]

#: Blocks that an alignment tries, and how long one must be to be sure of.
TRIED_BLOCKS, SURE_BLOCK = 10, 20
LEAST_SURFACE = 2
_CONCEPT = ("concept_id", "surface", "concept_type", "canonical_name", "summary", "aliases", "observed_surfaces", "source_block_refs", "facets", "uncertainty")
_ITEM = ("item_id", "item_type", "summary", "source_block_refs", "concept_refs", "temporal_attributes", "attributes", "uncertainty")


def slim(rows: DataFrame, kind: str = "concept") -> DataFrame:
    """The columns of concepts, or items, that a page embeds, as far as there are any."""
    return rows.select(*[c for c in (_CONCEPT if kind == "concept" else _ITEM) if c in rows.columns])


def records(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """The objects that a JSON object or list holds, one row each; ``schema``: of an object."""
    as_map, as_list = F.from_json(column, f"map<string,struct<{schema}>>"), F.from_json(column, f"array<struct<{schema}>>")
    some = F.when(F.ltrim(F.col(column)).startswith("["), as_list).otherwise(F.map_values(as_map))
    return rows.select(F.explode(some).alias("r")).where("r IS NOT NULL").select("r.*")


def block_index(owners: DataFrame, ident: str) -> DataFrame:
    """``block_id, owners`` from rows of ``ident, source_block_refs``: which concepts or items stand on each block, in order."""
    rows = owners.select(F.col(ident).alias("o"), F.explode("source_block_refs").alias("block_id"))
    n = owners.agg(F.sum(F.greatest(F.size("source_block_refs"), F.lit(0)))).first()[0] or 0
    return in_pieces(rows, n, "block_id").groupBy("block_id").agg(F.sort_array(F.collect_set("o")).alias("owners"))


def source_offsets(blocks: DataFrame, sources: DataFrame, key: str = "book_id") -> DataFrame:
    """``key, offset``: how far into its source (``key, text``) each book's blocks (``key, start, text``) begin: by the first of the first ten blocks that
    is long enough and that the source holds; 0 if there is none."""
    first = blocks.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy("start"))).where((F.col("__n") <= TRIED_BLOCKS) & (F.length("text") >= SURE_BLOCK))
    held = first.select(key, "__n", "start", F.col("text").alias("__t")).join(sources.select(key, F.col("text").alias("__s")), key)
    at = held.select(key, "__n", (F.instr("__s", F.col("__t")) - 1).alias("at"), "start").where("at >= 0")
    best = at.groupBy(key).agg(F.min_by(F.col("at") - F.col("start"), "__n").cast("long").alias("offset"))
    return sources.select(key).join(best, key, "left").select(key, F.coalesce("offset", F.lit(0)).alias("offset"))


def surfaces(concepts: DataFrame) -> DataFrame:
    """``concept_id, surfaces``: the observed surfaces of a concept, else its surface, of two characters or more, each once, longest first."""
    none = F.array().cast("array<string>")
    some = F.when(F.size(F.coalesce("observed_surfaces", none)) > 0, F.col("observed_surfaces")).otherwise(F.array("surface"))
    kept = F.array_distinct(F.filter(some, lambda x: F.length(x) >= LEAST_SURFACE))
    placed = F.transform(kept, lambda x, k: F.struct((-F.length(x)).alias("n"), k.alias("k"), x.alias("x")))
    return concepts.select("concept_id", F.transform(F.array_sort(placed), lambda x: x["x"]).alias("surfaces")).where(F.size("surfaces") > 0)


def annotations(blocks: DataFrame, concepts: DataFrame) -> DataFrame:
    """``block_id, start, end, record_id`` of the concepts' surfaces in the blocks (``block_id, text``) that they stand on, the earlier first and of
    these the longer, none of which overlap. Each concept meets its own blocks only, by an equi-join."""
    refs = concepts.select("concept_id", F.explode("source_block_refs").alias("block_id")).distinct().join(surfaces(concepts), "concept_id")
    rows = refs.join(blocks.select("block_id", "text"), "block_id").select("block_id", "concept_id", "text", F.explode("surfaces").alias("surface"))
    n = F.length("surface")
    pieces = F.split(F.col("text"), F.concat(F.lit("\\Q"), F.col("surface"), F.lit("\\E")), F.lit(-1))
    # where a piece ends, the surface begins
    ends = F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda k: F.aggregate(F.slice(pieces, F.lit(1), k), F.lit(0), lambda a, p: a + F.length(p)) + (k - 1) * n)
    found = rows.where(F.contains("text", F.col("surface"))).select("block_id", F.col("concept_id").alias("record_id"), F.explode(ends).alias("start"), n.alias("n"))
    return S.greedy(found.select("block_id", "record_id", "start", (F.col("start") + F.col("n")).alias("end")), "block_id", longest_first=False)


def stitched(blocks: DataFrame, key: str = "book_id") -> DataFrame:
    """``key, text`` of blocks (``key, start, text``) that do not overlap, with blanks where there is none."""
    end = F.lag(F.col("start") + F.length("text")).over(Window.partitionBy(key).orderBy("start"))
    gap = F.greatest(F.col("start") - F.coalesce(end, F.lit(0)), F.lit(0)).cast("int")
    rows = blocks.withColumn("__piece", F.concat(F.repeat(F.lit(" "), gap), F.col("text")))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "__piece"))), lambda x: x["__piece"]), "").alias("text"))


def outline(units: DataFrame) -> DataFrame:
    """``unit_id, path, depth, line`` of units (``unit_id, parent_id, ord, label``), parents before their children in order; ``path`` sorts them. Roots have
    no parent among the units."""
    place = F.format_string("%09d/%s", "ord", "unit_id")
    found = paths(units.select(F.col("unit_id").alias("node"), F.col("parent_id").alias("parent"), place.alias("label"), F.col("label").alias("shown")), "shown")
    return found.select(F.col("node").alias("unit_id"), F.array_join("path", "|").alias("path"), (F.size("path") - 1).alias("depth"), F.concat(F.expr("repeat('  ', size(path) - 1)"), "shown").alias("line"))


def segment_offsets(segments: DataFrame, evidence: DataFrame) -> DataFrame:
    """``segment_id, evidence_id, status, start, end``: quotes (``segment_id, evidence_id, quote``) looked for in their own segment (``segment_id, start, text``)
    and placed in the unit."""
    from . import locate as L

    rows = evidence.join(segments.select("segment_id", F.col("start").alias("__at"), "text"), "segment_id")
    keyed = rows.select(F.xxhash64("segment_id").alias("doc_id"), F.xxhash64("evidence_id").alias("item_id"), "segment_id", "evidence_id", "__at", "text", "quote")
    found = L.located(keyed).select("doc_id", "item_id", "status", F.col("start").alias("a"), F.col("end").alias("b"))
    return keyed.join(found, ["doc_id", "item_id"]).select("segment_id", "evidence_id", "status", (F.col("__at") + F.col("a")).alias("start"), (F.col("__at") + F.col("b")).alias("end"))


def marked_up(text: Column, marks: Column) -> Column:
    """A text with its marks (structs ``start, end, record_id`` in order, without overlaps) as HTML; both are escaped."""
    esc = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    piece = lambda a, b: F.substr(text, (a + 1).cast("int"), (b - a).cast("int"))
    begin = F.struct(F.lit("").alias("t"), F.lit(0).alias("at"))
    one = lambda acc, m: F.struct(F.concat(acc["t"], esc(piece(acc["at"], m["start"])), F.lit('<mark data-concept="'), esc(m["record_id"]), F.lit('">'), esc(piece(m["start"], m["end"])), F.lit("</mark>")).alias("t"), m["end"].cast("int").alias("at"))
    return F.aggregate(marks, begin, one, lambda acc: F.concat(acc["t"], esc(piece(acc["at"], F.length(text)))))


def annotated(blocks: DataFrame, concepts: DataFrame) -> DataFrame:
    """``block_id, markup`` of all blocks (``block_id, text``)."""
    marks = annotations(blocks, concepts).groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "record_id"))).alias("marks"))
    none = F.array().cast("array<struct<start:int,end:int,record_id:string>>")
    return blocks.join(marks, "block_id", "left").select("block_id", marked_up(F.col("text"), F.coalesce("marks", none)).alias("markup"))


# Pages

_STYLE = "body{font-family:serif;max-width:50em;margin:auto}mark{background:#fe9}.gap{color:#888}.issue{color:#a00}"


def source_pages(blocks: DataFrame, concepts: DataFrame, sources: DataFrame) -> DataFrame:
    """``book_id, markup`` of books: blocks (``book_id, block_id, start, end, text``) in order of their places, marked up; text of the source (``book_id, text``)
    between blocks is kept. A book is one step of work."""
    placed = blocks.join(source_offsets(blocks, sources), "book_id").join(annotated(blocks, concepts), "block_id")
    rows = placed.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct((F.col("start") + F.col("offset")).alias("a"), (F.col("end") + F.col("offset")).alias("b"), "block_id", "markup"))).alias("bs"))
    both = rows.join(sources.select("book_id", "text"), "book_id")
    ship(blocks.sparkSession)

    def run(batches):
        for pdf in batches:
            out = []
            for text, bs in zip(pdf["text"], pdf["bs"], strict=True):
                parts, at = [], bs[0]["a"] if len(bs) else 0
                for b in bs:
                    gap = text[at : b["a"]] if b["a"] > at else ""
                    if gap.strip():
                        parts.append(f'<p class="gap">{html.escape(gap)}</p>')
                    parts.append(f'<p data-block="{html.escape(b["block_id"])}">{b["markup"]}</p>')
                    at = max(at, b["b"])
                out.append("\n".join(parts))
            yield pd.DataFrame({"book_id": pdf["book_id"], "markup": out})

    kind = both.schema["book_id"].dataType.simpleString()
    return both.mapInPandas(run, f"book_id {kind}, markup string")


def navigation(units: list[Record]) -> str:
    """Links to units (``unit_id, line``), in order."""
    return "\n".join(f'<li><a href="#{html.escape(u["unit_id"])}">{html.escape(u["line"])}</a></li>' for u in units)


def diagnostics(issues: list[Record]) -> str:
    """Issues (``severity, code, path, message``) as a list, errors first."""
    rows = sorted(issues, key=lambda i: (i["severity"] != "error", i["code"], i["path"]))
    return "\n".join(f'<li class="issue">{html.escape(i["severity"])}: {html.escape(i["code"])} at {html.escape(i["path"])} - {html.escape(i["message"])}</li>' for i in rows)


def page(title: str, markup: str, data: Record, units: list[Record] | None = None, issues: list[Record] | None = None) -> str:
    """A page of its own: the marked-up source, links, issues and the data as JSON, in which no tag can end the script."""
    embedded = json.dumps(data, ensure_ascii=False).replace("</", "<\\/")
    return (
        f'<!doctype html><html><head><meta charset="utf-8"><title>{html.escape(title)}</title><style>{_STYLE}</style></head><body><h1>{html.escape(title)}</h1>'
        f"<nav><ul>{navigation(units or [])}</ul></nav><main>{markup}</main><ul>{diagnostics(issues or [])}</ul>"
        f'<script type="application/json" id="data">{embedded}</script></body></html>'
    )
