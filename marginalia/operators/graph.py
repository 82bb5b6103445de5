"""Connected components on data frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import written
from .skew import salted_join, with_least

#: More rounds than any graph needs whose longest path fits in 2**ROUNDS steps.
ROUNDS = 40


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges`` (``a``, ``b``: long); ``root`` is the smallest node of its component.

    Each round lets every node pass its smallest neighbour on, first to its larger neighbours, then to its smaller ones, until
    nothing changes. Minima are taken before rows are shuffled, and a node's edges are dealt to pieces by their other end before
    they meet its minimum, so the root of a large component is no one task's. Each round is written: a lost executor costs
    that round's tasks. Loops and repeated edges are allowed; an empty table gives none.
    """
    all_edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    e, last = all_edges.where("u > v"), None
    for _ in range(ROUNDS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = with_least(both, "u", "v").where("v > u")
        large = near.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()
        small = with_least(large, "u", "v")
        ends = F.array(F.struct("u", F.col("least").alias("v")), F.struct(F.col("v").alias("u"), F.col("least").alias("v")))
        new = written(small.select(F.explode(ends).alias("s")).select("s.u", "s.v").where("u > v").distinct(), "star")
        # Two 64-bit sums over the distinct edges stand for their set.
        mark = new.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first()
        e = new
        if mark == last:
            break
        last = mark
    else:
        raise RuntimeError("components have not settled")
    every = all_edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return every.join(e.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def linked_by_key(rows: DataFrame, node: str, key: str) -> DataFrame:
    """Edges that join all rows of a key: each to the smallest, so their number is that of the rows."""
    return with_least(rows.select(node, key), key, node, "a").select("a", F.col(node).alias("b"))


def ends(links: DataFrame) -> DataFrame:
    """``node, end`` for each node of ``links`` (``node, to``: one row a node, no circles); ``end`` is the last node that links lead to.

    Pointers are doubled: in each round a node takes the pointer of the node it points to, so a chain of n links is done in log2(n)
    rounds. Nodes that many point to are dealt to pieces. Each round is written; an empty table gives none.
    """
    at, open_rows = written(links.select("node", "to", F.lit(True).alias("open")), "pointers"), None
    for _ in range(ROUNDS):
        further = salted_join(at, at.select(F.col("node").alias("to"), F.col("to").alias("further")), ["to"], F.col("node"), "left")
        at = written(further.select("node", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("open")), "pointers")
        open_rows = at.agg(F.count_if("open")).first()[0]
        if not open_rows:
            return at.select("node", F.col("to").alias("end"))
    raise RuntimeError(f"{open_rows} nodes lie on circles")


def paths(nodes: DataFrame, *carry: str) -> DataFrame:
    """``node, path`` (and ``carry``) of each row of ``nodes`` (``node, parent, label``; a row a node): the labels from its root to itself. A node whose
    parent is null or no node is a root.

    Ancestors are joined to ancestors: in each round the path above a node doubles, so a tree of depth d is done in log2(d) rounds, and a
    node with most others below it is dealt to pieces. Each round is written. Circles raise an error, found by a path longer than there are nodes.
    """
    at = written(nodes.select("node", *carry, F.col("parent").alias("up"), F.array("label").alias("path")), "paths")
    most = at.count()
    while True:
        above = at.select(F.col("node").alias("up"), F.col("up").alias("further"), F.col("path").alias("above"))
        met = salted_join(at, above, ["up"], F.col("node"), "left")
        at = written(met.select("node", *carry, F.col("further").alias("up"), F.when(F.col("above").isNull(), F.col("path")).otherwise(F.concat("above", "path")).alias("path")), "paths")
        state = at.agg(F.count("up").alias("open"), F.max(F.size("path")).alias("longest")).first()
        if (state["longest"] or 0) > most:
            raise ValueError("nodes lie on circles")
        if not state["open"]:
            return at.drop("up")
