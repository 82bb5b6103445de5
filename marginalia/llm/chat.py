"""Logged conversations: snapshots that a longer log continues are collapsed, the maximal ones are rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import written

#: Marks of the rendered form.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turn_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, h1, h2``: for each turn the rolling hash of its conversation up to it.

    A turn's place, role and text give two 64-bit hashes with different seeds; a prefix's hash is the exclusive or of its
    turns' hashes, which hold the places, so one running pass gives all prefixes. Texts themselves are not shuffled. Turns
    are in order of ``turn``, null first, then of their hashes, so repeated turns have an order too.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    d = turns.select("conv_id", "turn", F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"))
    order = Window.partitionBy("conv_id").orderBy("turn", "a", "b")
    d = d.withColumn("pos", F.row_number().over(order))
    running = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = lambda c: F.bit_xor(F.xxhash64(F.col("pos"), F.col(c))).over(running)
    return d.select("conv_id", "pos", rolled("a").alias("h1"), rolled("b").alias("h2"))


def maximal(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies`` of the conversations that no longer one begins with; of equal ones the smallest id stays
    and ``n_copies`` counts them."""
    h = written(turn_hashes(turns), "turn_hashes")
    last = Window.partitionBy("conv_id")
    marked = h.withColumn("n", F.max("pos").over(last))
    whole = marked.where(F.col("pos") == F.col("n")).groupBy("h1", "h2", "n").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = marked.where(F.col("pos") < F.col("n")).groupBy(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("pos").alias("p")).agg(F.lit(1).alias("one"))
    kept = whole.join(proper, (whole["h1"] == proper["p1"]) & (whole["h2"] == proper["p2"]) & (whole["n"] == proper["p"]), "left_anti")
    return kept.select("conv_id", F.col("n").alias("n_turns"), "n_copies")


def escaped(text: Column) -> Column:
    """A text in which no mark can begin: ``<|`` gets a backslash between, and so does ``<`` before a backslash, so no two texts become one."""
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def rendered(turns: Column) -> Column:
    """The turns (structs that end in role and text) one after another between the marks, which the texts themselves cannot hold. A line break in
    a role is a blank."""
    one = lambda t: F.concat(F.lit(OPEN), escaped(F.replace(t["role"], F.lit("\n"), F.lit(" "))), F.lit("\n"), escaped(t["text"]), F.lit(CLOSE + "\n"))
    return F.array_join(F.transform(turns, one), "")


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies, chat`` of the maximal conversations of ``turns`` (``conv_id, turn, role, text``).

    Null roles and texts count as empty; rows with null ``conv_id`` are one conversation; a turn number that repeats gives a turn
    each; an empty table gives no rows; other columns are ignored. Only turns of maximal conversations are gathered.
    """
    kept = maximal(turns)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = turns.select(F.col("conv_id").alias("c"), F.struct("turn", F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"), role.alias("role"), text.alias("text")).alias("t"))
    chats = t.join(kept, t["c"].eqNullSafe(kept["conv_id"])).groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return chats.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_copies", rendered(F.col("ts")).alias("chat"))
