"""Parity by a tree of digests (J2, A9, A12): two copies of a table are compared by digests, rows move only where they differ.

A row's place in the tree is a hash of its key; the first bits of it are its node, more bits a node
further down. A node's digest can be added up in any order: its rows, and sums of two independent 64-bit hashes of
each row. Source rows count up, target rows count down, so one aggregation with map-side sums finds the nodes in which
the copies differ, and a task sends a row for each node at most. Only those nodes are looked at one level further
down; when a node holds few rows, or a level no longer narrows anything down, the rows of the nodes that
differ are compared by :mod:`reports`.

Defined cases: a null key is found nowhere, so its node always differs (as in the join); columns are compared as
canonical text, null apart from ''; keys are unique on both sides (equal repeated rows on both sides count as equal);
rows that only the target has make a node differ and are counted, but :func:`parity` reports source rows only; an
empty table is a copy without rows. Sums are of 32-bit halves: a node of the first level may hold 2^31 rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions import canonical_of_typed
from changeflow.operators import reports as rp
from changeflow.session import fresh_dir

BITS = 12             # the tree's nodes have 2^BITS nodes below them
LEAF_ROWS = 256       # differing nodes of so few rows, on the average, are compared row by row
DEEPEST = 48
SHARED = 1 << 18      # so many nodes (8 bytes each) are broadcast; more are joined by a shuffle


@dataclass(frozen=True)
class Narrowed:
    """Where two copies differ: ``nodes`` (node) of ``level`` bits, None if all are equal; ``rows_left`` source rows lie there."""
    source_rows: int
    target_rows: int
    level: int
    nodes: DataFrame | None
    n_nodes: int
    rows_left: int


def _place(df: DataFrame, key: str) -> Column:
    return F.xxhash64(canonical_of_typed(F.col(key), df.schema[key].dataType))


def _node(place: Column, level: int) -> Column:
    return F.shiftrightunsigned(place, 64 - level)


def _rows(df: DataFrame, key: str, columns: list[str], side: int) -> DataFrame:
    """(place, sign, halves of both row hashes); a null key's row is told apart by its side."""
    cells = [x for c in (key, *columns) for x in (F.col(c).isNull(), canonical_of_typed(F.col(c), df.schema[c].dataType))]
    lone = F.when(F.col(key).isNull(), F.lit(side)).otherwise(F.lit(0))
    hashes = df.select(_place(df, key).alias("place"), F.xxhash64(F.lit(1), lone, *cells).alias("a"), F.xxhash64(F.lit(2), lone, *cells).alias("b"))
    return hashes.select("place", F.lit(side).cast("long").alias("sign"), *[
        (F.lit(side) * half).alias(f"{h}{i}") for h in "ab"
        for i, half in enumerate((F.shiftrightunsigned(h, 32), F.col(h).bitwiseAND(F.lit((1 << 32) - 1))))])


def _inside(df: DataFrame, place: Column, level: int, nodes: DataFrame, n_nodes: int) -> DataFrame:
    """The rows of ``df`` in the nodes."""
    marks = nodes.withColumnRenamed("node", "_node")
    return df.withColumn("_node", _node(place, level)).join(F.broadcast(marks) if n_nodes <= SHARED else marks, "_node", "left_semi").drop("_node")


def node_digests(source: DataFrame, target: DataFrame, key: str, columns: list[str], level: int, within: Narrowed | None = None) -> DataFrame:
    """(node, source_rows, target_rows, differs) of all nodes of ``level`` bits, or those below the nodes of ``within``."""
    sides = []
    for df, side in ((source, 1), (target, -1)):
        if within is not None:
            df = _inside(df, _place(df, key), within.level, within.nodes, within.n_nodes)
        sides.append(_rows(df, key, columns, side))
    halves = ["a0", "a1", "b0", "b1"]
    sums = sides[0].unionByName(sides[1]).groupBy(_node(F.col("place"), level).alias("node")).agg(
        F.count_if(F.col("sign") > 0).alias("source_rows"), F.count_if(F.col("sign") < 0).alias("target_rows"),
        *[F.sum(h).alias(h) for h in halves])
    differs = F.col("source_rows") != F.col("target_rows")
    for h in halves:
        differs = differs | (F.col(h) != 0)
    return sums.select("node", "source_rows", "target_rows", differs.alias("differs"))


def narrow(source: DataFrame, target: DataFrame, key: str, columns: list[str], bits: int = BITS, leaf_rows: int = LEAF_ROWS) -> Narrowed:
    """Go down the tree where the copies differ. A level is one aggregation of both copies' rows below the nodes found so
    far; the driver gets its four sums. Both copies should be stored tables: each level reads their columns."""
    found, total, level, step = None, None, 0, bits
    while True:
        level += step
        path = fresh_dir(source.sparkSession, "digests")
        node_digests(source, target, key, columns, level, found).write.parquet(path)
        level_rows = source.sparkSession.read.parquet(path)
        bad = F.col("differs")
        s = level_rows.agg(F.coalesce(F.sum("source_rows"), F.lit(0)).alias("s"), F.coalesce(F.sum("target_rows"), F.lit(0)).alias("t"),
                           F.count_if(bad).alias("n"), F.coalesce(F.sum(F.when(bad, F.col("source_rows"))), F.lit(0)).alias("left")).first()
        total = total or (s["s"], s["t"])
        found = Narrowed(*total, level, level_rows.where(bad).select("node") if s["n"] else None, s["n"], s["left"])
        if s["n"] == 0 or s["left"] <= leaf_rows * s["n"] or level == DEEPEST:
            return found
        # no finer than nodes of ``leaf_rows`` rows need: digests stay few also where all rows differ
        step = min(bits, DEEPEST - level, math.ceil(math.log2(s["left"] / (leaf_rows * s["n"]))))


def _left(df: DataFrame, key: str, at: Narrowed) -> DataFrame:
    return df.where(F.lit(False)) if at.nodes is None else _inside(df, _place(df, key), at.level, at.nodes, at.n_nodes)


def parity(source: DataFrame, target: DataFrame, key: str, columns: list[str], at: Narrowed | None = None) -> DataFrame:
    """What :func:`reports.parity` returns, from the rows of the nodes that differ."""
    at = at or narrow(source, target, key, columns)
    return rp.parity(_left(source, key, at), _left(target, key, at), key, columns)


def parity_summary(source: DataFrame, target: DataFrame, key: str, columns: list[str], at: Narrowed | None = None) -> DataFrame:
    """What :func:`reports.parity_summary` returns: rows outside the nodes that differ are found and equal."""
    at = at or narrow(source, target, key, columns)
    equal = F.lit(at.source_rows) - F.col("rows_compared")
    return (rp.parity_summary(_left(source, key, at), _left(target, key, at), key, columns)
            .select("column", F.lit(at.source_rows).cast("long").alias("rows_compared"), "rows_missing",
                    (F.col("rows_matched") + equal).alias("rows_matched"), "rows_mismatched"))


def extra_keys(source: DataFrame, target: DataFrame, key: str, columns: list[str], at: Narrowed | None = None) -> DataFrame:
    """Keys that only the target has, from the nodes that differ."""
    at = at or narrow(source, target, key, columns)
    return rp.missing_keys(_left(target, key, at).select(key), _left(source, key, at), key)
