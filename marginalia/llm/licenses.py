"""Licence scan by sparse TF-IDF cosine to templates, with inheritance along directories (DataFrame functions only)."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import salted_join
from .license_texts import NEGATIONS, NOTICES, STATEMENTS, TAGS, TITLES
from .runtime import let, written

#: Least cosine of a passage to a template.
THRESHOLD = 0.8
#: Names of files that license their directory.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)([._-].*)?$"
#: What a term that disagrees costs, in terms that agree, when templates compete.
DISAGREES = 8
#: Terms of a file before which a title begins that makes the file the licence itself.
TITLE_WITHIN = 40
#: Terms before a statement in which a negation counts.
NEGATED_BEFORE = 3
_SEPARATORS = "".join(chr(c) for c in range(1, 128) if not (chr(c).isalnum() or chr(c) in ".+-'"))
#: Runs that end words, as spaces; made in this order.
_CLEARED = (("--", " "), ("..", " "), (". ", " "), ("- ", " "), (" .", " "), (" -", " "), ("' ", " "), (" '", " "))


@dataclass(frozen=True)
class Template:
    license: str
    kind: str
    terms: tuple[str, ...]


def _terms(text: str) -> list[str]:
    t = " " + text.lower().translate({ord(c): " " for c in _SEPARATORS}) + " "
    for old, new in _CLEARED:
        t = t.replace(old, new)
    return [x for x in t.split(" ") if x]


def terms(text: Column) -> Column:
    """Lower-case terms of a text: what lies between ASCII white space and marks other than dots, plus signs, hyphens and apostrophes, without
    outer dots, hyphens and apostrophes. Only literal replacements, which cost a tenth of a pattern."""
    t = F.concat(F.lit(" "), F.translate(F.lower(text), _SEPARATORS, " " * len(_SEPARATORS)), F.lit(" "))
    for old, new in _CLEARED:
        t = F.replace(t, F.lit(old), F.lit(new))
    return F.array_remove(F.split(t, " "), "")


TEMPLATES = [Template(name, kind, tuple(_terms(text))) for kind, some in (("statement", STATEMENTS), ("notice", NOTICES), ("title", TITLES)) for name, text in some]
TEMPLATES += [Template(name, "tag", tuple(_terms(f"SPDX-License-Identifier: {tag}"))) for tag, name in TAGS.items()]
VOCABULARY = sorted({t for x in TEMPLATES for t in x.terms})


def document_frequencies(files: DataFrame) -> tuple[int, dict[str, int], DataFrame]:
    """Files, files that hold each term of the templates, and the written table ``t, n`` of the files that hold any term."""
    held = files.select(F.explode(F.array_append(F.array_distinct(terms(F.coalesce("text", F.lit("")))), F.lit(""))).alias("t"))
    df = written(held.groupBy("t").agg(F.count("*").alias("n")), "licence_terms")
    n = {r["t"]: r["n"] for r in df.where(F.col("t").isin("", *VOCABULARY)).collect()}  # the templates' terms
    return n.pop("", 0), n, df


class Weights:
    """IDF weights, unit template vectors, and each template's anchors: terms one of which any passage near it must hold.

    A passage's cosine is at most the length of the template's vector over the terms that both hold. If a passage has none of
    the heaviest terms, that is their complement's length; terms are added until it is below the threshold, so looking at
    anchors alone loses nothing.
    """

    def __init__(self, files: int, df: dict[str, int], threshold: float):
        self.files = files
        self.idf = {t: math.log((1 + files) / (1 + df.get(t, 0))) + 1 for t in VOCABULARY}
        self.vectors: list[dict[str, float]] = []
        self.anchors: list[list[str]] = []
        for x in TEMPLATES:
            v = {t: x.terms.count(t) * self.idf[t] for t in dict.fromkeys(x.terms)}
            norm = math.sqrt(sum(w * w for w in v.values()))
            self.vectors.append({t: w / norm for t, w in v.items()})
            some, rest = [], 1.0
            for t, w in sorted(self.vectors[-1].items(), key=lambda p: (-p[1], p[0])):
                if rest < (threshold - 1e-9) ** 2:
                    break
                some.append(t)
                rest -= w * w
            self.anchors.append(some)


def _rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of fixed values, bounded by the templates, without leaving the JVM."""
    one = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r"))
    return F.broadcast(one.select("r.*"))


def candidates(files: DataFrame, weights: Weights) -> DataFrame:
    """``rid, path, w`` (all terms in order) of the files that hold an anchor. Texts that hold none as a part of a word are not cut."""
    anchors = sorted({t for some in weights.anchors for t in some})
    text = F.coalesce("text", F.lit(""))
    some = files.where(let(F.lower(text), lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(x)) for x in anchors])))
    cut = some.select("path", terms(text).alias("w")).where(F.arrays_overlap("w", F.array(*[F.lit(x) for x in anchors])))
    return written(cut.withColumn("rid", F.monotonically_increasing_id()), "licence_candidates")


def passages(cand: DataFrame, weighted: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """``rid, k, start, c``: cosines of windows to template ``k``, above the threshold. ``weighted``: ``rid, t, idf``.

    Templates are first held against the set of a file's terms, which bounds the cosine of any window. A window is as long as its
    template and begins where an anchor's place in the template says, or some terms before or behind; the whole file (start -1)
    is one more.
    """
    spark = cand.sparkSession
    vector = _rows(spark, [{"k": k, "t": t, "v": v} for k, some in enumerate(weights.vectors) for t, v in some.items()], "k int, t string, v double")
    whole = sorted(k for k, x in enumerate(TEMPLATES) if x.kind == "tag")  # tags must hold all of their terms
    bound = weighted.join(vector, "t").groupBy("rid", "k").agg(F.sum(F.col("v") * F.col("v")).alias("b")).where(F.col("b") >= (threshold - 1e-9) ** 2)
    pairs = written(bound.select("rid", "k"), "licence_pairs")
    places = [
        {"k": k, "t": t, "place": p, "n": len(x.terms), "slack": max(2, len(x.terms) // 8), "step": max(1, len(x.terms) // 32)}
        for k, x in enumerate(TEMPLATES) for t in weights.anchors[k] for p, u in enumerate(x.terms) if u == t
    ]
    hits = cand.select("rid", F.size("w").alias("len"), F.posexplode("w").alias("at", "t")).join(_rows(spark, places, "k int, t string, place int, n int, slack int, step int"), "t").join(pairs, ["rid", "k"])
    at = F.col("at") - F.col("place")
    clipped = lambda s: F.greatest(F.lit(0), F.least(s, F.col("len") - F.col("n")))
    starts = hits.select("rid", "k", "n", F.explode(F.array_distinct(F.transform(F.sequence(at - F.col("slack"), at + F.col("slack"), F.col("step")), clipped))).alias("start")).distinct()
    sizes = F.create_map(*[F.lit(v) for k, x in enumerate(TEMPLATES) for v in (k, len(x.terms))])
    starts = starts.unionByName(pairs.select("rid", "k", sizes[F.col("k")].alias("n"), F.lit(-1).alias("start")))
    window = F.when(F.col("start") < 0, F.col("w")).otherwise(F.slice("w", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("n")))
    held = starts.join(cand.select("rid", "w"), "rid").select("rid", "k", "start", F.explode(window).alias("t")).groupBy("rid", "k", "start", "t").agg(F.count("*").alias("f"))
    x = held.join(weighted, ["rid", "t"]).withColumn("x", F.col("f") * F.col("idf")).join(vector, ["k", "t"], "left")
    scored = x.groupBy("rid", "k", "start").agg(F.sum(F.col("x") * F.col("v")).alias("dot"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), F.count("v").alias("shared"))
    needed = F.when(F.col("k").isin(whole), F.lit(2)).otherwise(F.lit(0))
    return scored.where(F.col("shared") >= needed).select("rid", "k", "start", F.least(F.col("dot") / F.col("norm"), F.lit(1.0)).alias("c")).where(F.col("c") >= threshold - 1e-9)


def matches(files: DataFrame, threshold: float) -> DataFrame:
    """``path, license, similarity, grants`` of each file that has a passage near a template.

    Of several templates the one counts that most terms agree with, less ``DISAGREES`` times those that do not, where a share of the cosine
    of all terms agrees; ties by cosine, then name. So a longer form wins over a shorter one inside it only where it fits. A
    statement with a negation among its words or the three before is none. ``grants``: the file as a whole is near the
    template, or begins with the title of a licence.
    """
    n, known, df = document_frequencies(files)
    weights = Weights(n, known, threshold)
    cand = candidates(files, weights)
    held = salted_join(cand.select("rid", F.explode(F.array_distinct("w")).alias("t")), df, ["t"], F.col("rid"))
    weighted = written(held.select("rid", "t", (F.log((1 + F.lit(n)) / (1 + F.col("n"))) + 1).alias("idf")), "licence_weights")
    found = passages(cand, weighted, weights, threshold)
    said = [{"k": k, "license": x.license, "kind": x.kind, "n": len(x.terms), "own": sum(t in NEGATIONS for t in x.terms)} for k, x in enumerate(TEMPLATES)]
    rows = found.join(_rows(cand.sparkSession, said, "k int, license string, kind string, n int, own int"), "k").join(cand, "rid")
    low = F.greatest(F.col("start") - NEGATED_BEFORE, F.lit(0))
    near = F.when(F.col("start") < 0, F.col("w")).otherwise(F.slice("w", low + 1, F.col("start") + F.col("n") - low))
    negated = F.size(F.filter(near, lambda t: t.isin(*NEGATIONS))) > F.col("own")
    rows = rows.where(~((F.col("kind") == "statement") & negated))
    grants = (F.col("start") < 0) | ((F.col("kind") == "title") & (F.col("start") <= TITLE_WITHIN))
    order = F.struct(F.round(F.col("n") * ((1 + DISAGREES) * F.col("c") - DISAGREES), 6), F.round("c", 9), F.col("license"))
    best = rows.groupBy("path").agg(F.max_by(F.struct("license", "c"), order).alias("b"), F.bool_or(grants).alias("grants"))
    return best.select("path", "b.license", F.round("b.c", 6).alias("similarity"), "grants")


def _parent(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.lit(""))


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``path, license, similarity, basis, from_path`` of each distinct path of ``files`` (``path``, ``text``).

    ``basis`` is ``own`` where a passage of the file is near a template, ``inherited`` where the nearest directory above the file
    is licensed, else null. A directory is licensed by a file in it whose name says so, or that is a licence as a whole. Nearest
    directories are found for each directory, not for each file, and a directory's files are dealt to pieces that meet its
    licence. Texts are read whole, null as empty; a file without path has no directory and cannot inherit; rows that repeat a path
    count as one file with all their passages; other columns are ignored; an empty table gives none.
    """
    files = files.select("path", "text")
    own = written(matches(files, threshold), "licences")
    named = F.regexp_extract("path", r"[^/]*$", 0).rlike(LICENCE_FILE)
    granting = own.where("path IS NOT NULL").where(F.col("grants") | named).select(_parent(F.col("path")).alias("dir"), "license", "similarity", F.col("path").alias("from_path"))
    dirs = granting.groupBy("dir").agg(F.max_by(F.struct("license", "similarity", "from_path"), F.struct("similarity", "license", "from_path")).alias("g"))
    dirs = written(dirs, "licensed_directories")
    paths = files.select("path").distinct()
    rest = paths.where("path IS NOT NULL").join(own.select("path"), "path", "left_anti").withColumn("parent", _parent(F.col("path")))
    steps = F.split("parent", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, F.lit(1), k), "/").alias("dir")))
    above = rest.select("parent").distinct().select("parent", F.explode(up).alias("a")).select("parent", "a.depth", "a.dir")
    nearest = salted_join(above, dirs, ["dir"], F.col("parent")).groupBy("parent").agg(F.max_by("g", "depth").alias("g"))
    found = salted_join(rest, nearest, ["parent"], F.col("path"))
    got = own.select("path", "license", "similarity", F.lit("own").alias("basis"), F.col("path").alias("from_path")).unionByName(found.select("path", "g.license", "g.similarity", F.lit("inherited").alias("basis"), "g.from_path"))
    return paths.join(got.withColumnRenamed("path", "p"), F.col("path").eqNullSafe(F.col("p")), "left").drop("p")


def document_licenses(docs: DataFrame) -> DataFrame:
    """The scan over ``docs`` (``doc_id, lang, source, text``), a file for each document at ``source/lang/doc_id``: one row for each
    ``doc_id``. Null parts of the path count as empty."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    path = F.concat_ws("/", part("source"), part("lang"), part("doc_id"))
    found = scan(docs.select(path.alias("path"), "text"))
    doc_id = F.regexp_extract("path", r"[^/]*$", 0)
    return found.select(F.when(doc_id != "", doc_id.cast("long")).alias("doc_id"), "path", "license", "similarity", "basis", "from_path")
