"""Text functions on columns; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V

#: White space as Unicode has it.
_WS = r"(?U)[\s\x{3000}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once: inside a lambda a plain expression would run for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores; a CJK run is one token."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), 0)


def non_empty_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, rf"^{_WS}+|{_WS}+$", "")), lambda x: x != "")


def first_line(text: Column) -> Column:
    return F.coalesce(F.get(non_empty_lines(text), F.lit(0)), F.lit(""))


def last_line(text: Column) -> Column:
    return let(non_empty_lines(text), lambda v: F.coalesce(F.get(v, F.size(v) - 1), F.lit("")))


def length_stats(text: Column) -> list[Column]:
    lines = F.split(text, "\n")
    return [
        F.length(text).cast("long").alias("chars"),
        F.octet_length(text).cast("long").alias("utf8_bytes"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(r"\S"))).cast("long").alias("n_text_lines"),
    ]


def token_estimate(text: Column) -> Column:
    """0.6 a CJK character and 0.3 any other, rounded down, and one; exact in tenths."""
    cjk = F.length(F.regexp_replace(text, f"[^{V.CJK}]", ""))
    return F.greatest(F.lit(1), F.floor((cjk * 6 + (F.length(text) - cjk) * 3) / 10) + 1).cast("long")


def over_budget(tokens_in: Column, tokens_out: Column) -> Column:
    return (tokens_out <= 0) | (tokens_out > V.MAX_OUTPUT) | (tokens_in + tokens_out > V.MAX_CONTEXT)


def preview(text: Column, n: int = 120) -> Column:
    """White space collapsed, cut to ``n`` characters of which the last three are dots."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(flat) > n, F.concat(F.substring(flat, 1, n - 3), F.lit("..."))).otherwise(flat)


def collapse_space(text: Column) -> Column:
    """Non-breaking spaces as spaces, no carriage returns, runs of blanks as one, trimmed. Entities of mark-up are decoded."""
    t = F.regexp_replace(F.regexp_replace(text, "\xa0|&nbsp;|&#160;", " "), "\r", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r"^\s+|\s+$", "")


def cleanup(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def nav_label(label: Column) -> Column:
    return F.regexp_replace(label, f"{_WS}+", "")


def heading(line: Column) -> Column:
    """``label, kind, level`` of a line that is a heading, else null."""
    candidate = F.regexp_replace(line, rf"^[{chr(0xFEFF)}\s\x{{3000}}]+|[{chr(0xFEFF)}\s\x{{3000}}]+$", "")

    def found(c: Column) -> Column:
        out = F.lit(None)
        for pattern, kind in reversed(V.HEADINGS):
            hit = F.struct(F.regexp_extract(c, pattern, 1).alias("label"), F.lit(kind).alias("kind"), F.lit(V.HEADING_LEVEL).alias("level"))
            out = F.when(c.rlike(pattern), hit).otherwise(out)
        return F.when((F.length(c) > 0) & (F.length(c) <= V.HEADING_LENGTH), out)

    return let(candidate, found)


def label_kind(label: Column) -> Column:
    low = F.lower(label)
    return F.when(low.rlike(r"\b(part|book)\b"), "part").when(low.rlike(r"\bchapter\b") | label.rlike(V.CJK_CHAPTER), "chapter").otherwise("section")


def content_kind(label: Column, kind: Column, source_kind: Column) -> Column:
    n = F.lower(nav_label(label))
    return (
        F.when((kind == "book") | (source_kind == "container"), "book")
        .when(source_kind == "fallback_chunk", "unknown")
        .when((n == "目录") | n.contains("contents"), "toc")
        .when(n.rlike("书名页|版权页|出版说明|前言|preface|prologue|introduction"), "front_matter")
        .when(n.rlike("^(卷|册|篇|部|chapter|part|book|第)") | kind.isin("chapter", "part"), "main_text")
        .otherwise("section")
    )


def concept_type(value: Column) -> Column:
    """Lower case, blanks and hyphens as underscores, aliases resolved; ``other`` when empty."""
    raw = F.regexp_replace(F.lower(F.trim(F.coalesce(value, F.lit("")))), r"[\s-]+", "_")
    known = F.create_map(*[F.lit(x) for pair in V.TYPE_ALIASES.items() for x in pair])
    return F.when(raw == "", "other").otherwise(F.coalesce(F.element_at(known, raw), raw))


def fold_marks(text: Column) -> Column:
    return F.translate(text, V.FOLD_FROM, V.FOLD_TO)


def normal_form(text: Column, tier: int) -> Column:
    """The text as tier 2, 3 or 4 of quote location compares it: without note markers and white space, then with marks folded, then
    without marks."""
    t = F.regexp_replace(F.regexp_replace(text, V.NOTE_MARKER, ""), f"{_WS}+", "")
    if tier >= 3:
        t = fold_marks(t)
    return F.translate(t, V.DROPPED_MARKS, "") if tier >= 4 else t


def occurrences(text: Column, needle: Column) -> Column:
    """Occurrences that do not overlap; none of an empty needle."""
    n = F.length(needle)
    return F.when(n > 0, ((F.length(text) - F.length(F.replace(text, needle, F.lit("")))) / n).cast("long")).otherwise(F.lit(0).cast("long"))


def tolerant_json(text: Column) -> Column:
    """The text as JSON, or else what lies from its first brace to its last; null if neither parses."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.regexp_extract(text, r"(?s)\{.*\}", 0)))


def cut_summary(text: Column, n: int = 120) -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n - 3), F.lit("..."))).otherwise(text)
