"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are dealt to blocks of about ``BLOCK``. In a block, every dimension has its list of
components in order. A query reads the lists in step, from the end where its own
component gains, scores every vector it meets in full, and stops when the threshold (the
score that components at the depth reached would give together) is below its k-th
score; an equal score could still win by a smaller vec_id, so the bound must be lower. Blocks
are independent; their k best are merged for each query.

Scale: queries are dealt to chunks of about ``CHUNK``; each (chunk, block) pair is one
task-sized group, so neither side is broadcast or held whole. The merge is a window whose
group limit keeps k rows for each query before the shuffle.

Defined cases: vectors that are null or hold a null or non-finite component take no part,
nor do rows without vec_id; a query meets only vectors of its length and never its own
vec_id; of query rows that repeat a vec_id the least vector asks; repeated candidate rows
count each; fewer than k candidates are all returned; empty tables give an empty result.
Sums are exact for every finite component: in doubles while no sum of a block can reach 2**53, in 64-bit integers
while none can reach 2**63, in Python's integers beyond. Vectors with large components lie in blocks of their own, so
they slow no others. A score beyond a long is ranked by its exact value and shown as the nearest long.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import cut

BLOCK, CHUNK, SCALE = 16384, 1024, 1024


LARGE = 2 ** 20           # from here on a vector lies among the large ones
LONG = 2 ** 63


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: doubles, which hold it exactly, or Python integers where those overflow."""
    with np.errstate(over="ignore"):
        v = np.floor(scale * x)
    if np.isfinite(v).all():
        return v
    return np.array([math.floor(Fraction(c) * scale) for c in x.ravel().tolist()], dtype=object).reshape(x.shape)


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, dim, large, v) of the rows that take part, v the bytes of their doubles."""

    def run(batches):
        for batch in batches:
            ids, out = batch.column(0), []
            for i, x in enumerate(batch.column(1)):
                if not ids[i].is_valid or not x.is_valid or x.values.null_count:
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all():
                    out.append((ids[i].as_py(), len(v), bool(len(v) and np.abs(v).max() >= LARGE / scale), v.astype("<f8").tobytes()))
            vec, dim, large, v = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(vec, pa.int64()), pa.array(dim, pa.int32()), pa.array(large, pa.bool_()), pa.array(v, pa.binary())],
                                             names=["vec_id", "dim", "large", "v"])

    return rows.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "vec_id long, dim int, large boolean, v binary")


def in_form(v: np.ndarray, form: type) -> np.ndarray:
    """Whole numbers as doubles, 64-bit integers or Python integers."""
    if form is object and v.dtype != object:
        return np.array([int(c) for c in v.ravel().tolist()], dtype=object).reshape(v.shape)
    return v.astype(form)


def most(v: np.ndarray) -> int:
    """The greatest magnitude."""
    return int(np.abs(v).max()) if v.size else 0


class Lists:
    """The sorted lists of a block's dimensions; ``x`` of whole numbers (doubles or Python integers)."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids, self.most = x, ids, most(x)
        self.order = np.argsort(x, axis=0, kind="stable").T.copy()
        self.forms: dict[type, tuple[np.ndarray, np.ndarray]] = {}

    def form(self, form: type) -> tuple[np.ndarray, np.ndarray]:
        """The vectors, and the lists' values, in a form in which sums are exact."""
        if form not in self.forms:
            x = in_form(self.x, form)
            self.forms[form] = x, np.take_along_axis(x, self.order.T, axis=0).T
        return self.forms[form]

    def top(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best for ``q``, ties to smaller ids."""
        reach = max(len(q) * self.most * most(q), self.most, most(q))       # no sum, and no part, is larger
        form = np.float64 if reach < 2 ** 53 else np.int64 if reach < LONG else object
        x, value = self.form(form)
        weight = in_form(q, form)
        n = len(self.ids)
        use = np.flatnonzero(weight)
        gain, lose = use[weight[use] > 0], use[weight[use] < 0]
        seen = self.ids == own
        best = np.zeros(0, np.int64)
        score = np.zeros(0, form)
        depth, step = 0, 32
        while depth < n:
            to = min(n, depth + step)
            before = seen.copy()
            seen[self.order[gain, n - to:n - depth].ravel()] = True
            seen[self.order[lose, depth:to].ravel()] = True
            if not len(use):
                seen[:] = True                              # all scores are 0
            new = np.flatnonzero(seen & ~before)
            s = x[new] @ weight if len(new) else np.zeros(0, form)
            if len(score) == k:
                few = s >= score[-1]
                new, s = new[few], s[few]
            best, score = np.concatenate((best, new)), np.concatenate((score, s))
            if form is object:
                keep = sorted(range(len(best)), key=lambda i: (-score[i], self.ids[best[i]]))[:k]
            else:
                keep = np.lexsort((self.ids[best], -score))[:k]
            best, score = best[keep], score[keep]
            depth, step = to, step * 2
            ends = np.concatenate((value[gain, n - to], value[lose, to - 1]))
            bound = (weight[np.concatenate((gain, lose))] * ends).sum() if len(use) else 0
            if seen.all() or len(score) == k and bound < score[-1]:
                break
        return self.ids[best], score


def key_of(score: int) -> bytes:
    """Bytes that sort as the whole numbers do."""
    size = (abs(score).bit_length() + 7) // 8
    plain = size.to_bytes(3, "big") + abs(score).to_bytes(size, "big")
    return b"\x01" + plain if score >= 0 else b"\x00" + bytes(255 - c for c in plain)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``rows`` for each of ``queries`` (vec_id, embedding)."""
    all_ = cut(whole_vectors(rows, scale), "vectors")
    asked = cut(whole_vectors(queries, scale).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("q"))
                .select("vec_id", "q.dim", "q.v"), "queries")
    kinds = F.array(F.lit(False), F.lit(True))
    n, m = all_.count(), asked.count()
    blocks, chunks = max(1, math.ceil(n / BLOCK)), max(1, math.ceil(m / CHUNK))
    deal = lambda c, parts: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    # by place in the written files, so that repeated rows spread over the blocks
    left = all_.withColumn("block", deal(F.monotonically_increasing_id(), blocks)).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = asked.withColumn("chunk", deal("vec_id", chunks)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("large", F.explode(kinds))

    def run(key, have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(have) and len(ask):
            x = whole(np.frombuffer(b"".join(have["v"]), "<f8").reshape(len(have), key[0]), scale)
            lists = Lists(x, have["vec_id"].to_numpy())
            for own, v in zip(ask["vec_id"], ask["v"], strict=True):
                ids, found = lists.top(whole(np.frombuffer(v, "<f8"), scale), own, k)
                exact = [int(c) for c in found.tolist()]
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "by": [key_of(c) for c in exact],
                                         "score": np.array([max(-LONG, min(LONG - 1, c)) for c in exact], dtype=np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "by": [], "score": []})

    keys = ["dim", "large", "chunk", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, by binary, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("by").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
