"""Importance resampling towards a target distribution, on hashed n-grams.

A text's ASCII capitals are lowered and an untrained Regex Split of tokenizers returns its words
with their offsets. Windows over the offset pairs give the features: runs of up to ``orders``
consecutive words. Each feature falls into one of ``buckets`` by its CRC; the counts by bucket of
all documents and of all target texts are the two distributions. What a bucket gains is the
logarithm of their smoothed ratio in thousandths; a document's weight is the sum of its features'
gains. Adding Gumbel noise of the document's own id and taking the highest scores draws without
replacement in proportion to the exponentials of the weights.

Scale: texts are read once; their buckets are written to the shared folder, and counts and weights
are taken from there. Only the ``buckets`` counts pass through the driver. Ranks come from one sort
by range: the number of rows in each range is the rest (a row for each partition).

Defined cases: a null or empty text has no features, weight 0 and takes part with that; so does
a text without words. A null doc_id hashes as the empty string. Repeated rows are documents of their
own. Ties go to the smaller doc_id, null last. An empty table gives an empty result; without target
texts all gains come from the smoothing alone.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut, partitions

#: fixed value: what a word is, after lowering
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, ORDERS, SEED, LEAST_WORDS, PERCENT = 10_000, 1, 2024, 20, 10
KEPT = 1 << 18            # features a worker remembers the bucket of


class Splitter:
    """Words of a text with their offsets, and the buckets of its features."""

    def __init__(self, orders: int, buckets: int):
        from tokenizers import Regex, pre_tokenizers
        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.orders, self.buckets = orders, buckets
        self.known: dict[str, int] = {}

    def words(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return self.split.pre_tokenize_str(text)

    def bucket(self, feature: str) -> int:
        b = self.known.get(feature)
        if b is None:
            if len(self.known) >= KEPT:
                self.known.clear()
            b = self.known[feature] = zlib.crc32(feature.encode("utf-8")) % self.buckets
        return b

    def features(self, text: str | None) -> tuple[int, list[int]]:
        """(words, bucket of each feature) of a whole text."""
        low = (text or "").encode("utf-8").lower().decode("utf-8")          # bytes: A-Z only
        spans = [at for _, at in self.words(low)]
        out = [self.bucket(low[a:b]) for a, b in spans]
        for n in range(2, self.orders + 1):
            out += [self.bucket(" ".join(low[a:b] for a, b in spans[i:i + n])) for i in range(len(spans) - n + 1)]
        return len(spans), out


def hashed(texts: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, features): the bucket of every feature, of rows (doc_id, text)."""

    def run(batches):
        splitter = Splitter(orders, buckets)
        for batch in batches:
            ends, words, flat = [0], [], []
            for t in batch.column(1):
                n, found = splitter.features(t.as_py())
                words.append(n)
                flat.append(np.array(found, dtype=np.int32))
                ends.append(ends[-1] + len(found))
            values = np.concatenate(flat) if flat else np.zeros(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
                names=["doc_id", "n_words", "features"])

    return texts.mapInArrow(run, "doc_id long, n_words long, features array<int>")


def histogram(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket; ``buckets`` rows pass through the driver."""
    rows = features.select(F.explode("features").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket, floor(1000 ln(ratio of the smoothed shares, target over source)), in doubles."""
    size = len(source)
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + size) / ((float(s) + 1) * (t_all + size))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of hashed documents."""
    shared = features.sparkSession.sparkContext.broadcast(gain)              # a number for each bucket

    def run(batches):
        g = shared.value
        for batch in batches:
            found = batch.column(2)
            n = pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(g[found.flatten().to_numpy()])])
            ends = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array((total[ends[1:]] - total[ends[:-1]]).astype(np.int64))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return features.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, of the id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored`` with the rank of the drawn rows: of those with enough words, the given percentage with the
    highest score. One sort by range; a row's number in its range and the rows of the ranges before give its rank."""
    due = F.col("n_words") >= F.lit(least_words)
    order = [due.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    parted = scored.repartitionByRange(partitions(scored), *order).sortWithinPartitions(*order)
    at = cut(parted.withColumn("at", F.monotonically_increasing_id()), "resample-ranges")
    part = F.shiftright("at", 33).cast("int")
    sizes = sorted(at.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count_if(due).alias("due")).collect())
    drawn = sum(r["due"] for r in sizes) * percent // 100
    base, before = [], 0
    for r in sizes:                                                          # a row for each partition
        base.append((r["part"], before))
        before += r["n"]
    known = at.sparkSession.createDataFrame(base, "part int, base long")
    rank = F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(1)
    return (at.withColumn("part", part).join(F.broadcast(known), "part", "left")
            .select(*scored.columns, F.when(rank <= F.lit(drawn), rank).alias("rank")))


def resample(docs: DataFrame, target: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS, seed: int = SEED,
             least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of ``docs`` (doc_id, text), drawn towards
    the distribution of ``target`` (text)."""
    known = cut(hashed(docs.select(F.col("doc_id").cast("long"), "text"), orders, buckets), "resample-features")
    wanted = hashed(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), orders, buckets)
    gain = gains(histogram(known, buckets), histogram(wanted, buckets))
    scored = weighed(known, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return ranked(scored, least_words, percent)
