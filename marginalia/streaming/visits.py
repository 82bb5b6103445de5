"""Open units as keyed state: rows of a key gather until a closing row or a silence ends them; and the same over a whole table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.skew import running
from ..storage import ship

CLOSED = "start timestamp, end timestamp, n_rows long, closed_by string"
_STATE = "at array<long>, closes array<boolean>, ident array<string>"


def _rows(rows: DataFrame, key: str, at: str, ident: str, closes: Column) -> DataFrame:
    out = rows.select(F.col(key).alias("__key"), F.col(at).cast("timestamp").alias("__at"), F.coalesce(closes, F.lit(False)).alias("__closes"), F.coalesce(F.col(ident).cast("string"), F.lit("")).alias("__ident"))
    return out.where(F.col("__key").isNotNull() & F.col("__at").isNotNull())


def visits(rows: DataFrame, key: str, at: str, ident: str, closes: Column, gap: int) -> DataFrame:
    """``key, start, end, n_rows, closed_by`` of each stretch of a key's rows that are at most ``gap`` seconds apart, up to a row that ``closes``.

    Rows alike in key, time, ``ident`` and ``closes`` count once; of rows of one time those that close come last; rows without key or time are left out.
    ``closed_by`` is ``end`` or ``silence``. Rows are numbered over ranges and meet their predecessor by number, so no task holds all rows of a hot key.
    """
    once = _rows(rows, key, at, ident, closes).distinct()
    n = running(once, "__key", ["__at", "__closes", "__ident"], number="__n", before="__b").select("__key", "__at", "__closes", "__ident", "__n")
    before = n.select("__key", (F.col("__n") + 1).alias("__n"), F.col("__at").alias("__last"), F.col("__closes").alias("__ended"))
    joined = n.join(before, ["__key", "__n"], "left")
    apart = F.col("__at") > F.col("__last") + F.expr(f"INTERVAL {gap} SECONDS")
    new = F.coalesce(F.col("__ended") | apart, F.lit(False)).cast("long")
    placed = running(joined.withColumn("__new", new), "__key", ["__n"], F.col("__new"), number="__m", before="__before").withColumn("__visit", F.col("__before") + F.col("__new"))
    g = placed.groupBy("__key", "__visit").agg(F.min("__at").alias("start"), F.max("__at").alias("end"), F.count("*").alias("n_rows"), F.max("__closes").alias("c"))
    return g.select(F.col("__key").alias(key), "start", "end", "n_rows", F.when(F.col("c"), "end").otherwise("silence").alias("closed_by"))


def closed(held: list[tuple[int, bool, str]], watermark: int, gap: int) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, bool, str]], int]:
    """What is over among the sorted rows ``held`` of a key once no row before ``watermark`` can come, the rows that stay, and when the next visit may
    be over; times are microseconds."""
    done, first = [], 0
    for k, (at, ends, _) in enumerate(held):
        silent = k + 1 == len(held) or held[k + 1][0] > at + gap
        if not (ends or silent):
            continue
        over = at if ends else at + gap
        if over >= watermark:
            return done, held[first:], over
        done.append((held[first][0], at, k + 1 - first, "end" if ends else "silence"))
        first = k + 1
    return done, [], 0


def follow_visits(rows: DataFrame, key: str, at: str, ident: str, closes: Column, gap: int, delay: str) -> DataFrame:
    """``visits`` of a stream, each given once no row that belongs to it can come: its rows are at most ``delay`` behind the latest.

    State holds the rows of visits that are still open, and a timer of event time ends those that fall silent. Later rows, repeated ones of visits that are over
    among them, are left out.
    """
    one = _rows(rows, key, at, ident, closes).withWatermark("__at", delay)
    kind = one.schema["__key"].dataType.simpleString()
    width = 1_000_000 * gap

    def run(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = 1000 * state.getCurrentWatermarkMs()
        held = set(zip(*state.get, strict=True)) if state.exists else set()
        if not state.hasTimedOut:
            for pdf in batches:
                ats = pdf["__at"].astype("datetime64[us]").astype("int64").tolist()
                held.update(r for r in zip(ats, pdf["__closes"].tolist(), pdf["__ident"].tolist(), strict=True) if r[0] >= watermark)
        done, left, over = closed(sorted(held), watermark, width)
        if left:
            state.update(tuple(list(c) for c in zip(*left, strict=True)))
            state.setTimeoutTimestamp(max(over // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if done:
            out = pd.DataFrame(done, columns=["start", "end", "n_rows", "closed_by"])
            for c in ("start", "end"):
                out[c] = pd.to_datetime(out[c], unit="us")
            out.insert(0, key, keys[0])
            yield out

    ship(rows.sparkSession)
    return one.groupBy("__key").applyInPandasWithState(run, f"{key} {kind}, {CLOSED}", _STATE, "append", GroupStateTimeout.EventTimeTimeout)
