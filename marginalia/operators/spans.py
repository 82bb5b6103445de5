"""Spans over texts: scans for surfaces, overlaps, sweeps, islands and nearest neighbours."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import ship, written
from .needles import places, scanned

#: Shortest surface that is looked for; up to the second length a match is not sure.
LEAST_SURFACE, UNSURE_SURFACE = 2, 2


def _needles(surfaces: DataFrame, least: int) -> DataFrame:
    return surfaces.where(F.length("surface") >= least).select("record_id", "surface")


def surface_matches(units: DataFrame, surfaces: DataFrame, least: int = LEAST_SURFACE) -> DataFrame:
    """``unit_id, record_id, surface, start, end`` of all places of surfaces (``record_id, surface``) of ``least`` characters or more in unit texts
    (``unit_id, text``), inside words, across words and overlapping ones included. Case counts."""
    found = places(units, "unit_id", _needles(surfaces, least), "record_id", "surface")
    return found.select("unit_id", "record_id", "surface", F.col("start").cast("int"), F.col("end").cast("int"))


def _counted(text: np.ndarray, needle: np.ndarray, start: np.ndarray, end: np.ndarray, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A place of each needle in each text, and how many of its places there do not overlap, from the left."""
    order = np.lexsort((start, needle, text))
    t, w, a, b = text[order], needle[order], start[order], end[order]
    new = np.append(True, (t[1:] != t[:-1]) | (w[1:] != w[:-1]))
    hit = np.append(True, new[1:] | (a[1:] >= b[:-1]))
    for k in np.flatnonzero(~hit).tolist():  # from the first overlap on the last place that counts decides, as far as places follow close
        if hit[k - 1]:
            last = b[k - 1]
        if a[k] >= last:
            hit[k] = True
    return order[new], np.add.reduceat(hit.astype("i8"), np.flatnonzero(new))


def surface_counts(units: DataFrame, surfaces: DataFrame) -> DataFrame:
    """``unit_id, surface, n_found`` of the surfaces (``surface``) that texts hold, counted without overlaps from the left."""
    named = surfaces.select(F.lit(0).alias("name"), "surface").distinct()
    return scanned(units, "unit_id", named, "name", "surface", ["ident", "needle", "n"], _counted).toDF("unit_id", "surface", "n_found")


def chosen(matches: list[tuple[str, int, int]], longest_first: bool = True) -> list[tuple[str, int, int]]:
    """Of matches (``record, start, end``) those that no earlier choice overlaps: longer ones choose first, then the earlier, then by record; or
    else the earlier first, of these the longer. Matches that have chosen are marked by place, so a match costs its length."""
    order = sorted(matches, key=lambda m: (m[1] - m[2], m[1], m[0]) if longest_first else (m[1], m[1] - m[2], m[0]))
    first = min((a for _, a, _ in matches), default=0)
    taken = bytearray(max((b for _, _, b in matches), default=0) - first)
    out = []
    for record, start, end in order:
        a, b = start - first, end - first
        # a choice that overlaps this match covers its first or its last place, unless it lies inside, which no longer one does
        if not (taken[a] or taken[b - 1]) and (longest_first or not any(taken[a:b])):
            taken[a:b] = b"\x01" * (b - a)
            out.append((record, start, end))
    return out


#: Width of the pieces of a unit that matches are dealt to, in bits of their start.
PIECE_BITS = 16


def _same_piece(rows: DataFrame, pieces: DataFrame, unit: str) -> DataFrame:
    """Rows with what the table of pieces knows of theirs; the null unit is a unit."""
    other = pieces.select(F.col(unit).alias("__u"), F.col("__piece").alias("__p"), pieces.columns[-1])
    return rows.join(other, F.col(unit).eqNullSafe(F.col("__u")) & (F.col("__piece") == F.col("__p"))).drop("__u", "__p")


def groups_of_overlaps(matches: DataFrame, unit: str = "unit_id") -> DataFrame:
    """Matches with ``island``, the first place of the stretch of overlapping matches that they lie in; spans that only touch do not overlap.

    A unit is dealt to pieces by where matches start. Inside a piece they are in order; how far earlier pieces reach, and where the last stretch of
    earlier pieces began, come from tables with a row for each piece.
    """
    rows = written(matches.withColumn("__piece", F.call_function("shiftright", F.col("start").cast("long"), F.lit(PIECE_BITS))), "matches")
    earlier = Window.partitionBy(unit).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    reach = rows.groupBy(unit, "__piece").agg(F.max("end").alias("e")).select(unit, "__piece", F.max("e").over(earlier).alias("__reach"))
    order = Window.partitionBy(unit, "__piece").orderBy("start", "end")
    before = F.greatest(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.col("__reach"))
    begun = _same_piece(rows, reach, unit).withColumn("__begin", F.when(F.coalesce(F.col("start") >= before, F.lit(True)), F.col("start")))
    begun = begun.withColumn("__last", F.last("__begin", True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = begun.groupBy(unit, "__piece").agg(F.max("__begin").alias("b")).select(unit, "__piece", F.max("b").over(earlier).alias("__before"))
    return _same_piece(begun, last, unit).select(*matches.columns, F.coalesce("__last", "__before").alias("island"))


_CHOICES = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("record_id", T.StringType())]))


@F.pandas_udf(_CHOICES)
def _longest(islands: pd.Series) -> pd.Series:
    return islands.map(lambda x: _chosen_of(x, True))


@F.pandas_udf(_CHOICES)
def _earliest(islands: pd.Series) -> pd.Series:
    return islands.map(lambda x: _chosen_of(x, False))


def _chosen_of(island: list[dict] | None, longest_first: bool) -> list[dict] | None:
    if island is None:
        return None
    return [{"start": a, "end": b, "record_id": r} for r, a, b in chosen([(m["record_id"], m["start"], m["end"]) for m in island], longest_first)]


def greedy(matches: DataFrame, unit: str = "unit_id", longest_first: bool = True) -> DataFrame:
    """``chosen`` of each unit's matches (``start, end, record_id``).

    Only matches that overlap, straight or through others, compete, so a step of work is such a stretch and not a unit; matches that meet no other do
    not leave the JVM.
    """
    ship(matches.sparkSession)
    rows = groups_of_overlaps(matches.select(unit, F.col("start").cast("int"), F.col("end").cast("int"), "record_id"), unit)
    some = rows.groupBy(unit, "island").agg(F.collect_list(F.struct("start", "end", "record_id")).alias("m"))
    won = (_longest if longest_first else _earliest)(F.when(F.size("m") > 1, F.col("m")))
    return some.select(unit, F.explode(F.coalesce(won, "m")).alias("c")).select(unit, "c.start", "c.end", "c.record_id")


def _longest_places(text: np.ndarray, needle: np.ndarray, start: np.ndarray, end: np.ndarray, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``chosen`` of a block's places, all matches of a length at once. Places at one start and of one length are the same surface."""
    first, size = start.min(initial=0), end - start
    taken = np.zeros(end.max(initial=0) - first + 1, bool)
    out = []
    for n in np.unique(size)[::-1].tolist():
        of = np.flatnonzero(size == n)  # by start
        a = start[of] - first
        free = ~(taken[a] | taken[a + n - 1])
        of, a = of[free], a[free]
        if not len(a):
            continue
        close = np.append(False, a[1:] - a[:-1] < n)
        for k in np.flatnonzero(close).tolist():
            if not close[k - 1]:
                last = a[k - 1]
            if a[k] >= last + n:
                close[k] = False
        won = of[~close]
        out.append(won)
        for x in (a[~close] if n > _LONG else ()):
            taken[x : x + n] = True
        for x in range(n if n <= _LONG else 0):
            taken[a[~close] + x] = True
    kept = np.sort(np.concatenate(out)) if out else np.zeros(0, "i8")
    return kept, np.ones(len(kept), "i8")


def _named(text: np.ndarray, needle: np.ndarray, start: np.ndarray, end: np.ndarray, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of ``_longest_places`` the first of each needle in each text, and how many there are."""
    kept, _ = _longest_places(text, needle, start, end, names)
    _, first, n = np.unique(text[kept] * (needle.max(initial=0) + 1) + needle[kept], return_index=True, return_counts=True)
    return kept[first], n.astype("i8")


#: Longer places are marked one by one.
_LONG = 64


def _one_record(surfaces: DataFrame, least: int) -> DataFrame:
    """Surfaces with their record; of equal ones the least record is chosen."""
    return _needles(surfaces, least).groupBy("surface").agg(F.min("record_id").alias("record_id"))


def greedy_surfaces(units: DataFrame, surfaces: DataFrame, least: int = LEAST_SURFACE) -> DataFrame:
    """``greedy`` of ``surface_matches``, chosen where a text is scanned, so that what is not chosen goes nowhere; no surfaces give no rows."""
    found = scanned(units, "unit_id", _one_record(surfaces, least), "record_id", "surface", ["ident", "start", "end", "name"], _longest_places)
    return found.select(F.col("ident").alias("unit_id"), F.col("start").cast("int"), F.col("end").cast("int"), F.col("name").alias("record_id"))


def _report(places: DataFrame) -> DataFrame:
    """Of places, or of the first of several (``unit_id, record_id, start, end, n``)."""
    short = F.when(F.col("end") - F.col("start") <= UNSURE_SURFACE, F.col("n")).otherwise(0)
    counts = places.groupBy("unit_id", "record_id").agg(F.sum("n").alias("match_count"), F.sum(short).alias("n_unsure"), F.min("start").cast("long").alias("first_start"))
    order = Window.partitionBy("unit_id").orderBy(F.col("match_count").desc(), "record_id")
    return counts.withColumn("place", F.row_number().over(order).cast("long"))


def scan_report(choices: DataFrame) -> DataFrame:
    """``unit_id, record_id, match_count, n_unsure, first_start, place`` of the records that units name (``greedy`` matches): how often, how often by a
    match that is too short to be sure, where first, and their place in the unit's report, most often named first, then by id."""
    return _report(choices.withColumn("n", F.lit(1).cast("long")))


def _repeated(rows: DataFrame, key: str) -> bool:
    return not rows.groupBy(key).count().where("count > 1").isEmpty()


def surface_report(units: DataFrame, surfaces: DataFrame, least: int = LEAST_SURFACE) -> DataFrame:
    """``scan_report`` of ``greedy_surfaces``. Places are counted where a text is scanned, so a text and a surface leave as one row, and nothing is shuffled after it; only
    where a unit has several texts, or a record several surfaces, their rows meet in one shuffle."""
    one = written(_one_record(surfaces, least), "surfaces")
    want, short = ["ident", "name", "start", "end", "n"], F.col("end") - F.col("start") <= UNSURE_SURFACE
    if _repeated(one, "record_id") or _repeated(units, "unit_id"):
        found = scanned(units, "unit_id", one, "record_id", "surface", want, _named)
        return _report(found.toDF("unit_id", "record_id", "start", "end", "n").repartition("unit_id"))
    found = scanned(units, "unit_id", one, "record_id", "surface", [*want, "place"], _named)
    unsure = F.when(short, F.col("n")).otherwise(0).alias("n_unsure")
    return found.select(F.col("ident").alias("unit_id"), F.col("name").alias("record_id"), F.col("n").alias("match_count"), unsure, F.col("start").alias("first_start"), "place")


def unmatched_records(choices: DataFrame, units: DataFrame, surfaces: DataFrame, least: int = LEAST_SURFACE) -> DataFrame:
    """``record_id`` of the records that have a surface to look for and that no unit names."""
    return surfaces.where(F.length("surface") >= least).select("record_id").distinct().join(choices.select("record_id"), "record_id", "left_anti")


def sweep(spans: DataFrame, unit: str = "unit_id") -> DataFrame:
    """Each unit cut at all starts and ends of its spans (``start, end``): ``start, end, depth`` of the pieces that spans cover. ``covering`` names them."""
    marks = spans.select(unit, F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("d")))).alias("m"))
    at = marks.groupBy(unit, F.col("m.at").alias("at")).agg(F.sum("m.d").alias("d"))
    order = Window.partitionBy(unit).orderBy("at")
    cut = at.select(unit, F.col("at").alias("start"), F.lead("at").over(order).alias("end"), F.sum("d").over(order).alias("depth"))
    return cut.where("end IS NOT NULL AND depth > 0")


#: Exponents of the widths of bins: powers of sixteen up to four billion, and one for all that is longer.
LEVELS = (0, 4, 8, 12, 16, 20, 24, 28, 32, 63)


def _level(length: Column) -> Column:
    """The smallest level whose bins are no shorter than a length of 1 or more."""
    bits = F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1)))
    level = F.ceil(bits / 4) * 4
    return F.when(level > LEVELS[-2], LEVELS[-1]).otherwise(level).cast("int")


def _bin(at: Column, level: Column) -> Column:
    return F.call_function("shiftright", at.cast("long"), level)


def points_in(points: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str) -> DataFrame:
    """Pairs of rows of ``points`` and ``spans`` with equal ``keys`` where ``start <= at < end``; other columns need different names.

    A span lies in at most two bins of the first level that is no shorter than it; a point asks for its bin of each level. So a unit's rows are
    spread over its bins and every pair meets once. Rows with a null place, and spans that end before they begin, meet nothing.
    """
    length = F.col(end).cast("long") - F.col(start).cast("long")
    s = spans.where(length > 0).withColumn("__level", _level(length))
    s = s.withColumn("__bin", F.explode(F.array_distinct(F.array(_bin(F.col(start), F.col("__level")), _bin(F.col(end) - 1, F.col("__level"))))))
    p = points.withColumn("__level", F.explode(F.array(*[F.lit(k) for k in LEVELS]))).withColumn("__bin", _bin(F.col(at), F.col("__level")))
    met = p.join(s, [*keys, "__level", "__bin"])
    return met.where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("__level", "__bin")


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], left_at: tuple[str, str], right_at: tuple[str, str]) -> DataFrame:
    """Pairs of spans with equal ``keys`` where each begins before the other ends. A pair is found once, at its later start."""
    (a, b), (c, d) = left_at, right_at
    columns = [*keys, *[x for x in (*left.columns, *right.columns) if x not in keys]]
    later_left = points_in(left, right, keys, a, c, d).where(F.col(b) > F.col(c)).select(*columns)
    later_right = points_in(right, left, keys, c, a, b).where((F.col(c) > F.col(a)) & (F.col(a) < F.col(d))).select(*columns)
    return later_left.unionByName(later_right)


def covering(spans: DataFrame, unit: str = "unit_id", ident: str = "span_id") -> DataFrame:
    """The pieces of ``sweep`` with the ids of the spans that cover each, in order: ``start, end, covered_by``. Spans without length cut none.

    A piece is covered by the spans that its start lies in, so pieces and spans meet in bins; a piece's list is as long as its depth.
    """
    some = written(spans.where(F.col("start") < F.col("end")).select(unit, F.col("start").alias("__a"), F.col("end").alias("__b"), ident), "spans")
    pieces = sweep(some.select(unit, F.col("__a").alias("start"), F.col("__b").alias("end")), unit).select(unit, "start", "end")
    return points_in(pieces, some, [unit], "start", "__a", "__b").groupBy(unit, "start", "end").agg(F.array_sort(F.collect_list(ident)).alias("covered_by"))


def within(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, seconds: int) -> DataFrame:
    """Pairs of rows with equal ``keys`` where ``right_at`` is not before ``at`` and at most ``seconds`` after it; other columns need different names.

    Times are binned by that width: a left row stands in its bin and the next, a right row in its own, so every pair meets once and a key's rows are
    spread over its bins. Runs on batches and on two streams with watermarks, whose rows are forgotten once no partner can come.
    """
    binned = lambda c: F.floor(F.unix_timestamp(F.col(c).cast("timestamp")) / seconds).cast("long")
    l_ = left.withColumn("__bin", F.explode(F.array(binned(at), binned(at) + 1)))
    r_ = right.withColumn("__bin", binned(right_at))
    for k in [*keys, "__bin"]:
        r_ = r_.withColumnRenamed(k, f"__r_{k}")
    same = F.lit(True)
    for k in [*keys, "__bin"]:
        same &= F.col(k) == F.col(f"__r_{k}")
    met = l_.join(r_, same & (F.col(right_at) >= F.col(at)) & (F.col(right_at) <= F.col(at) + F.expr(f"INTERVAL {seconds} SECONDS")))
    return met.drop("__bin", *[f"__r_{k}" for k in [*keys, "__bin"]])


def islands(rows: DataFrame, key: str, at: str, gap: Column | int, *, value: Column | None = None) -> DataFrame:
    """``island`` of each row: a new one begins where more than ``gap`` lies between a row and the one before."""
    order = Window.partitionBy(key).orderBy(at)
    v = value if value is not None else F.col(at)
    new = F.coalesce((v - F.lag(v).over(order) > gap).cast("int"), F.lit(1))
    return rows.withColumn("__new", new).withColumn("island", F.sum("__new").over(order)).drop("__new")


def heading_islands(headings: DataFrame, key: str = "unit_id") -> DataFrame:
    """Headings (``line, label, kind``) without repeated tables of contents: an island of at least three headings, at most three lines apart
    and forty in all, goes if at least two, and half, of its labels come again after it."""
    rows = islands(headings, key, "line", 3)
    island = Window.partitionBy(key, "island")
    rows = rows.withColumn("n", F.count("*").over(island)).withColumn("first", F.min("line").over(island)).withColumn("last", F.max("line").over(island))
    again = Window.partitionBy(key, "label", "kind")
    rows = rows.withColumn("again", (F.max("line").over(again) > F.col("last")).cast("int"))
    rows = rows.withColumn("n_again", F.sum("again").over(island))
    toc = (F.col("n") >= 3) & (F.col("last") - F.col("first") <= 40) & (F.col("n_again") >= F.greatest(F.lit(2), F.floor(F.col("n") / 2)))
    return rows.where(~toc).select(*headings.columns)


def ends_by_next(rows: DataFrame, key: str, at: str, close: Column) -> DataFrame:
    """``end``: the next row's start, or ``close`` for the last."""
    return rows.withColumn("end", F.coalesce(F.lead(at).over(Window.partitionBy(key).orderBy(at)), close))


def parents_by_level(rows: DataFrame, key: str, at: str, level: str, ident: str, levels: int) -> DataFrame:
    """``parent``: the nearest earlier row of a smaller level."""
    order = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    last = [F.last(F.when(F.col(level) == k, F.struct(F.col(at).alias("at"), F.col(ident).alias("id"))), ignorenulls=True).over(order) for k in range(levels + 1)]
    rows = rows.withColumn("__last", F.array(*last))
    near = F.array_max(F.filter(F.transform("__last", lambda x, k: F.when(k < F.col(level), x)), lambda x: x.isNotNull()))
    return rows.withColumn("parent", near["id"]).drop("__last")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, right_at: str, *values: str) -> DataFrame:
    """Each left row with the values of the latest right row of its key that is not later: one sort of both sides, no theta join."""
    l_ = left.select(F.col(key).alias("__k"), F.col(at).alias("__t"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__l"), F.lit(None).cast(right.select(F.struct(right_at, *values).alias("v")).schema["v"].dataType).alias("__r"))
    r_ = right.select(F.col(key).alias("__k"), F.col(right_at).alias("__t"), F.lit(0).alias("__side"), F.lit(None).cast(l_.schema["__l"].dataType).alias("__l"), F.struct(right_at, *values).alias("__r"))
    order = Window.partitionBy("__k").orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = l_.unionByName(r_).withColumn("__r", F.last("__r", ignorenulls=True).over(order)).where("__side = 1")
    return both.select("__l.*", *[F.col(f"__r.{c}").alias(c) for c in (right_at, *values)])
