"""Contiguous, hash-addressed blocks of unit texts."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab as V
from ..storage import ship
from .skew import running
from .spans import overlaps

_BOUNDARY = re.compile(r"""[。！？；!?]|\.(?=\s*(?:\Z|[A-Z　-〿一-鿿]|["'‘“（(〔［｛][A-Z一-鿿]))""")
_WORD_BEFORE = re.compile(r"[^\W\d_]*\Z")


def sentences(text: str, longest: int = V.MAX_BLOCK_CHARS, shortest: int = V.MIN_FRAGMENT_CHARS) -> list[str]:
    """Pieces of a text that end at sentence boundaries and make it up again.

    A period ends a sentence before a capital, a CJK character or the end, unless an abbreviation stands before it. A text without
    boundary is cut every ``longest`` characters. A piece that follows one of fewer than ``shortest`` characters joins it, and so
    does one of white space.
    """
    core = text.strip()
    lead = len(text) - len(text.lstrip())
    ends = [m.end() for m in _BOUNDARY.finditer(core) if m.group() != "." or _WORD_BEFORE.search(core[max(0, m.start() - 16) : m.start()]).group().lower() not in V.ABBREVIATIONS]
    if not ends:
        pieces = [core[k : k + longest] for k in range(0, len(core), longest)] or [""]
    else:
        raw = [core[a:b] for a, b in zip([0, *ends], [*ends, len(core)], strict=True) if a < b]
        pieces = raw[:1]
        for piece in raw[1:]:
            if not piece.strip() or len(pieces[-1].strip()) < shortest:
                pieces[-1] += piece
            else:
                pieces.append(piece)
    pieces[0] = text[:lead] + pieces[0]
    pieces[-1] += text[lead + len(core) :]
    return pieces


#: Characters that are cut before their pieces are packed: of a batch no more are held as Python strings.
_PACKED = 1_000_000


def _lists(counts: list[int], values: pa.Array, null: list[bool]) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype("i4"))
    return pa.ListArray.from_arrays(offsets, values, mask=pa.array(null, pa.bool_()) if null else None)


def _cut(units: pa.Array) -> pa.Array:
    """The sentences of each paragraph of each unit; nulls stay."""
    chunks = units.flatten()
    packed, pieces, size, counts = [], [], 0, []
    for chunk in chunks:
        text = chunk.as_py()
        cut = [] if text is None else sentences(text)
        counts.append(len(cut))
        pieces += cut
        size += len(text or "")
        if size > _PACKED:
            packed.append(pa.array(pieces, pa.string()))
            pieces, size = [], 0
    values = pa.concat_arrays([*packed, pa.array(pieces, pa.string())])
    sizes = units.value_lengths().fill_null(0).to_pylist()
    return _lists(sizes, _lists(counts, values, chunks.is_null().to_pylist()), units.is_null().to_pylist())


@F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _sentences(units: pa.Array) -> pa.Array:
    return _cut(units)


#: Stands behind each blank line while a text is cut; a text that holds it is cut by a slower pattern.
_CUT = "\ue000"


def paragraphs(text: Column) -> Column:
    """Stretches that end with a blank line, which they keep; they make up the text again. Each blank stretch is read once."""
    slow = F.regexp_extract_all(text, F.lit(r"(?s)(?U)\A\n\s*\n|.+?(?:\n\s*\n|\z)"), 0)
    fast = F.filter(F.split(F.regexp_replace(text, r"(?U)\n\s*\n", "$0" + _CUT), _CUT), lambda x: x != "")
    return F.when(F.contains(text, F.lit(_CUT)), slow).otherwise(fast)


def lines(text: Column) -> Column:
    """Lines with their newline; they make up the text again."""
    return F.regexp_extract_all(text, F.lit(r"[^\n]*\n|[^\n]+"), 0)


#: Numbers summed up in one step of ``_before``.
_STEP = 256


def _sums(numbers: Column, first: Column) -> Column:
    zero = F.struct(F.array().cast("array<long>").alias("out"), first.alias("sum"))
    return F.aggregate(numbers, zero, lambda a, x: F.struct(F.concat(a["out"], F.array(a["sum"])).alias("out"), (a["sum"] + x).alias("sum")))["out"]


def _before(parts: Column) -> Column:
    """The sum of the numbers before each, of numbers that come in lists of ``_STEP``: sums inside lists start from sums of lists."""
    zero = F.lit(0).cast("long")
    firsts = _sums(F.transform(parts, lambda p: F.aggregate(p, zero, lambda a, x: a + x)), zero)
    return F.flatten(F.zip_with(parts, firsts, _sums))


def placed(units: DataFrame, chunks: Column, *keys: str) -> DataFrame:
    """A row for each chunk: ``block_index`` from 0, ``start`` and ``end`` in the unit, ``text`` and its SHA-256.

    A unit is a row, and its offsets are summed up in it: nothing is shuffled, and units that share a key stay apart.
    """
    rows = units.select(*keys, chunks.alias("__chunks"))
    steps = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size("__chunks") - 1) / _STEP).cast("int")))
    rows = rows.withColumn("__parts", F.transform(steps, lambda k: F.transform(F.slice("__chunks", k * _STEP + 1, _STEP), lambda c: F.length(c).cast("long"))))
    rows = rows.select(*keys, F.posexplode(F.arrays_zip(F.col("__chunks").alias("text"), _before(F.col("__parts")).alias("start"))).alias("block_index", "__b"))
    start, text = F.col("__b.start"), F.col("__b.text")
    return rows.select(*keys, F.col("block_index").cast("long").alias("block_index"), start.alias("start"), (start + F.length(text)).alias("end"), text.alias("text"), F.sha2(text, 256).alias("text_hash"))


def source_blocks(units: DataFrame, *keys: str) -> DataFrame:
    """Blocks of each unit's ``text``: paragraphs, those over the longest length cut at sentences; rule lines stand alone.

    Texts are cut once, and only paragraphs that are too long leave the JVM. A null or empty text has no blocks.
    """
    ship(units.sparkSession)

    def is_long(p: Column) -> Column:
        return (F.length(p) > V.MAX_BLOCK_CHARS) & (F.length(F.regexp_replace(p, r"(?U)^\s+|\s+$", "")) > V.MAX_BLOCK_CHARS)

    rows = units.select(*keys, paragraphs(F.col("text")).alias("__p"))
    rows = rows.withColumn("__long", F.transform("__p", lambda p: F.when(is_long(p), p)))
    rows = rows.withColumn("__cut", _sentences(F.when(F.exists("__long", lambda p: p.isNotNull()), F.col("__long"))))
    pieces = F.when(F.col("__cut").isNull(), F.col("__p")).otherwise(F.flatten(F.zip_with("__p", "__cut", lambda p, c: F.coalesce(c, F.array(p)))))
    return placed(rows.select(*keys, pieces.alias("__pieces")), F.col("__pieces"), *keys).withColumn("block_type", F.lit("paragraph")).withColumn("is_rule", F.col("text").rlike(V.RULE_LINE))


def contiguity_issues(blocks: DataFrame, *keys: str) -> DataFrame:
    """Blocks whose end is not the next one's start, or whose length is not that of their text."""
    nxt = F.lead("start").over(Window.partitionBy(*keys).orderBy("block_index"))
    bad = F.coalesce(nxt != F.col("end"), F.lit(False)) | (F.col("end") - F.col("start") != F.length("text"))
    return blocks.withColumn("bad", bad).where("bad").drop("bad")


def metrics(blocks: DataFrame, *keys: str, longest: int = V.MAX_BLOCK_CHARS) -> DataFrame:
    size = F.col("end") - F.col("start")
    return blocks.groupBy(*keys).agg(
        F.count("*").alias("n_blocks"), F.sum(size).alias("chars"), F.round(F.avg(size), 2).alias("avg_chars"), F.max(size).alias("max_chars"), F.sum((size > longest).cast("long")).alias("n_oversized")
    )


def book_blocks(blocks: DataFrame, book: str, unit: str) -> DataFrame:
    """Numbers blocks through a book, units in order of ``unit``, and places them in it; a book's blocks are spread over ranges."""
    rows = running(blocks, book, [unit, "block_index"], F.col("end") - F.col("start"), "__n", "book_start")
    return rows.withColumn("block_id", F.format_string("block-%06d", "__n")).withColumn("book_end", F.col("book_start") + F.col("end") - F.col("start")).drop("__n")


def overlapping(blocks: DataFrame, ranges: DataFrame, *keys: str) -> DataFrame:
    """Blocks that overlap a range (``range_start``, ``range_end``) of their unit; they meet in bins of places."""
    return overlaps(blocks, ranges, list(keys), ("start", "end"), ("range_start", "range_end"))


def marked(blocks: DataFrame, *keys: str) -> DataFrame:
    """Each unit's blocks between markers that name them, in one text."""
    name = F.format_string("block-%04d", F.col("block_index"))
    one = F.concat(F.lit("{"), name, F.lit(":paragraph}"), F.col("text"), F.lit("{/"), name, F.lit("}"))
    rows = blocks.select(*keys, F.struct("block_index", one.alias("t")).alias("m"))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("m")), lambda m: m["t"]), "").alias("marked_text"))
