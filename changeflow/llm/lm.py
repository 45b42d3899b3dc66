"""Stupid-backoff scores of documents under the bigram counts of the whole corpus.

S(w | v) is c(vw) / c(v) if the pair occurs ``least`` times or more in the corpus, else
``alpha`` times c(w) / N; a text's first word is scored by c(w) / N. A document's score is the
mean of ln S over its words.

The log of a score is a sum of terms that need one count each, so the relational plan is: n-grams
with their number in each document, dealt by hash; count tables of each hash partition, joined to
the n-grams there; sums for each document. To let one deal serve all counts, a pair goes
where its rarer words' counts are complete:

* the ``TOP`` most frequent words' counts are a table of bounded size that every task has;
* pairs of two such words are dealt by the pair (their words' counts are known);
* a pair with one rarer word is dealt by that word: all pairs that hold the word in that place
  meet, which gives its count;
* a pair of two rarer words goes to both: at the first word's place c(vw) and c(v) give its part if it
  is frequent, at the second's c(vw) and c(w) give its part if it is not.

Scale: what is dealt is packed, a row for each batch of texts and partition, so a pair costs about 9
bytes; the number of partitions grows with the corpus (``SHARE`` words each). Within a document
equal pairs are one entry with a number, so even a pair found in every document has one entry a
document. Partitions answer with the sums of each batch's documents, which are added batch by batch.

Words are runs of anything but ASCII white space, A-Z folded; they are compared by 48-bit hashes.
Defined cases: null and empty texts have no words, score null; repeated rows count as often as
they occur and get equal scores; rows are told apart by doc_id, so rows that share one (or have
none) are scored as one document together; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut

ALPHA, LEAST, TOP, SHARE = 0.4, 2, 65_000, 2_000_000
_RARE, _SAME, _END, _START = 0xFFFF, 0xFFFE, 0xFFFD, 0xFFFC       # codes above those of the top words
_NO_ID = -(1 << 63)                                             # stands for a null doc_id
_PART = 4_000_000                                               # bytes of text worked on at once


def _mix(h: np.ndarray) -> np.ndarray:
    for shift, mul in ((32, 0xD6E8FEB86659FD93), (32, 0x9FB21C651E98DF25)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mul)
    return h ^ (h >> np.uint64(32))


_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]                                    # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_SPACE] = 0
_PLACE = _rng.integers(1, 1 << 63, 1 << 16, dtype=np.uint64) | np.uint64(1)


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(48-bit hash, text) of each word of the texts whose UTF-8 bytes lie between the offsets."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = _SPACE[data]
    opens = np.ones(len(data), bool)
    opens[1:] = space[:-1]
    begin = offsets[:-1]
    opens[begin[begin < len(data)]] = True
    start = np.flatnonzero(opens & ~space)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = data[start[0]:]
    at = start - start[0]
    place = np.arange(len(data)) - np.repeat(at, np.diff(np.append(at, len(data))))
    h = np.add.reduceat(_BYTE[data] * _PLACE[place & 0xFFFF], at)
    return _mix(h) >> np.uint64(16), np.searchsorted(offsets, start, side="right") - 1


def _parts(texts: pa.Array):
    """(first row, rows, word hashes, row of each word) of the texts, a bounded number of bytes at once."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[:len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _PART, side="right")) - 1)
        h, row = hash_words(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
        yield at, to - at, h, row
        at = to


def word_counts(docs: DataFrame) -> DataFrame:
    """(w, n): how often each word occurs in the corpus."""

    def run(batches):
        for batch in batches:
            found = [h for _, _, h, _ in _parts(batch.column(0))]
            w, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            for i in range(0, len(w), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(w[i:i + 100_000].view(np.int64)), pa.array(n[i:i + 100_000])], names=["w", "n"])

    return docs.select("text").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


class Top:
    """The most frequent words: hashes in order, counts; a word's code is its place."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int):
        order = np.argsort(words)
        self.words, self.log, self.total = words[order], np.log(counts[order].astype(np.float64)), total

    def code(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(h), _RARE, np.uint16)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at, _RARE).astype(np.uint16)


def _six(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = b.reshape(-1, 6)
    return out.view("<u8").ravel()


def _binary(count: np.ndarray, width: int, data: bytes) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(count * width))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def pair_entries(h: np.ndarray, row: np.ndarray, top: Top, parts: int):
    """The packed pairs of some texts, sorted by (partition, text): arrays of
    (partition, text, first code, second code, first hash, second hash, number, whose part)."""
    # <s> w1 w2 ... wn </s>: every word once first and once second in a pair
    code = top.code(h)
    new = np.concatenate(([True], row[1:] != row[:-1]))
    last = np.concatenate((row[1:] != row[:-1], [True]))
    c1 = np.concatenate((np.where(new, _START, np.roll(code, 1)).astype(np.uint16), code[last]))
    h1 = np.concatenate((np.where(new, 0, np.roll(h, 1)), h[last]))
    c2 = np.concatenate((code, np.full(last.sum(), _END, np.uint16)))
    h2 = np.concatenate((h, np.zeros(last.sum(), np.uint64)))
    r = np.concatenate((row, row[last]))
    rare1, rare2 = c1 == _RARE, c2 == _RARE
    known = ~(c2 == _END) | rare1                       # (top, </s>) says nothing new
    pair = _mix(h1 * np.uint64(0x9E3779B97F4A7C15) + h2 + (c1 == _START))
    own1, own2 = _mix(h1 + np.uint64(1)), _mix(h2 + np.uint64(1))
    by = np.where(rare1, own1, np.where(rare2, own2, pair))
    both = rare1 & rare2
    take = np.concatenate((np.flatnonzero(known), np.flatnonzero(both)))
    second = np.concatenate((np.zeros(known.sum(), bool), np.ones(both.sum(), bool)))
    part = (np.where(second, own2[take], by[take]) >> np.uint64(16)) % np.uint64(parts)
    rows = int(r[-1]) + 1 if len(r) else 1
    group = part.astype(np.int64) * rows + r[take]
    bits = max(1, int(parts * rows - 1).bit_length())
    # one sort key; equal pairs of a group come together (if ever split, their numbers still add up)
    key = (group.astype(np.uint64) << np.uint64(64 - bits)) | ((own1[take] >> np.uint64(40)) << np.uint64(24) ^ (pair[take] >> np.uint64(40)) ^ second.astype(np.uint64)) >> np.uint64(max(0, bits - 16))
    order = np.argsort(key, kind="stable")
    take, second, group = take[order], second[order], group[order]
    a1, a2 = h1[take], h2[take]
    k1, k2 = c1[take], c2[take]
    begins = np.concatenate(([True], (group[1:] != group[:-1]) | (a1[1:] != a1[:-1]) | (a2[1:] != a2[:-1])
                             | (second[1:] != second[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))
    at = np.flatnonzero(begins)
    number = np.diff(np.append(at, len(take)))
    times = -(-number // 255)                           # a number over 255 takes more entries
    at, n = np.repeat(at, times), np.repeat(number, times)
    if (times > 1).any():
        nth = np.arange(len(n)) - np.repeat(np.cumsum(times) - times, times)
        n = np.minimum(255, n - 255 * nth)
    return group[at] // rows, group[at] % rows, k1[at], k2[at], a1[at], a2[at], n.astype(np.uint8), second[at]


_ENTRY = ("part int, batch long, ids binary, texts binary, counts binary, pairs binary, number binary, first binary, "
          "second binary")


def _pack(shared, parts: int):
    """Rows of a batch of texts and a partition: the texts' places in the batch, the number of entries of each,
    and the entries. The batch's first row also carries its doc_ids."""

    def run(batches):
        from pyspark import TaskContext
        top, serial = shared.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0)
            for begin, size, h, row in _parts(batch.column(1)):
                if not len(h):
                    continue
                part, text, k1, k2, a1, a2, n, second = pair_entries(h, row, top, parts)
                group = np.concatenate(([True], (part[1:] != part[:-1]) | (text[1:] != text[:-1])))
                at = np.flatnonzero(group)
                count = np.diff(np.append(at, len(part)))
                rare1, rare2 = k1 == _RARE, k2 == _RARE
                # the first hash is given once for entries that follow each other
                same = np.zeros(len(k1), bool)
                same[1:] = rare1[1:] & rare1[:-1] & (a1[1:] == a1[:-1]) & ~group[1:] & ~second[1:] & ~second[:-1]
                new1 = rare1 & ~same
                codes = np.stack([np.where(same, _SAME, k1), k2], axis=1).astype("<u2")
                # a seventh byte marks pairs of rare words that are dealt by the second
                firsts = np.concatenate([np.frombuffer(_six(a1[new1]), np.uint8).reshape(-1, 6), second[new1, None]], axis=1).astype(np.uint8)
                heads = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                per = lambda m: np.add.reduceat(m.astype(np.int64), heads)
                known = np.zeros(len(heads), np.int64)
                known[0] = size
                own = ids.slice(begin, size)
                own = own.fill_null(_NO_ID).to_numpy().tobytes()
                serial += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[heads].astype(np.int32)), pa.array(np.full(len(heads), serial)), _binary(known, 8, own),
                     _binary(per(group), 4, text[at].astype("<u4").tobytes()), _binary(per(group), 4, count.astype("<u4").tobytes()),
                     _binary(per(np.ones(len(part))), 4, codes.tobytes()), _binary(per(np.ones(len(part))), 1, n.tobytes()),
                     _binary(per(new1), 7, firsts.tobytes()), _binary(per(rare2), 6, _six(a2[rare2]))],
                    names=[c.split()[0] for c in _ENTRY.split(", ")])
    return run


def _sums(key: np.ndarray, number: np.ndarray) -> np.ndarray:
    """For each entry, the sum of the numbers of those with its key."""
    order = np.argsort(key)
    k = key[order]
    start = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    total = np.add.reduceat(number[order], start)
    out = np.empty(len(key), np.int64)
    out[order] = np.repeat(total, np.diff(np.append(start, len(k))))
    return out


def score_part(pairs: np.ndarray, number: np.ndarray, first: np.ndarray, second: np.ndarray, top: Top,
               alpha: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(log score, words) that each entry of a partition adds to its document."""
    codes = pairs.view("<u2").reshape(-1, 2)
    c1, c2, n = codes[:, 0], codes[:, 1], number.astype(np.int64)
    size = len(n)
    heads = first.reshape(-1, 7)
    head = c1 == _RARE
    which = np.cumsum(head) - 1
    rare1, rare2 = head | (c1 == _SAME), c2 == _RARE
    far = np.uint64(1 << 20)                            # codes lie below, hashes above
    i1, i2 = c1.astype(np.uint64), c2.astype(np.uint64)
    i1[rare1] = _from_six(heads[:, :6].copy().ravel())[which[rare1]] + far
    i2[rare2] = _from_six(second) + far
    dealt2 = np.zeros(size, bool)                       # a pair of rare words, here for its second
    dealt2[rare1] = heads[:, 6][which[rare1]] == 1
    c12 = _sums(_mix(i1 * np.uint64(0x9E3779B97F4A7C15) + i2) ^ dealt2.astype(np.uint64), n)
    hit = (c12 >= least) & (c1 != _START)
    inner = c2 != _END
    out = np.zeros(size)
    logs = np.concatenate((top.log, np.zeros(0x10000 - len(top.log))))
    # frequent pairs: ln c(vw) - ln c(v), where c(v) is known or complete
    here = hit & inner & ~dealt2
    l1 = np.where(rare1, 0.0, logs[c1])
    own = rare1 & ~dealt2
    if own.any():
        l1[own] = np.log(_sums(i1[own], n[own]))
    out[here] = n[here] * (np.log(c12[here]) - l1[here])
    # others: ln alpha + ln c(w) - ln N; a pair of rare words only where it is dealt by its second
    there = ~hit & inner & ~(rare1 & rare2 & ~dealt2)
    l2 = np.where(rare2, 0.0, logs[c2])
    own = rare2 & (dealt2 | ~rare1)
    if own.any():
        l2[own] = np.log(_sums(i2[own], n[own]))
    back = np.where(c1 == _START, 0.0, math.log(alpha))
    out[there] = n[there] * (back[there] + l2[there] - math.log(max(1, top.total)))
    return out, np.where(inner & ~dealt2, n, 0)


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words of the highest classes of counts (16 to a power of two) that hold ``most`` words or fewer together."""
    of = F.floor(F.log2("n") * 16)
    least, rows = None, 0
    for r in sorted(counts.groupBy(of.alias("class")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        rows += r["words"]
        if rows > most:
            break
        least = r["class"]
    return counts.where(of >= F.lit(least)) if least is not None else counts.where("1 = 0")


def backoff_scores(docs: DataFrame, alpha: float = ALPHA, least: int = LEAST, top_words: int = TOP, share: int = SHARE) -> DataFrame:
    """(doc_id, n_words, log_sum) for each doc_id of ``docs`` (doc_id, text) with words."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    counts = cut(word_counts(docs), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    best = most_frequent(counts, top_words).toPandas()                                # top_words rows at most
    top = Top(best["w"].to_numpy(np.int64).view(np.uint64), best["n"].to_numpy(np.int64), total)
    shared = docs.sparkSession.sparkContext.broadcast(top)
    parts = max(1, math.ceil(total / share))
    packed = docs.mapInArrow(_pack(shared, parts), _ENTRY)

    def score(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        col = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        out, words = score_part(col("pairs", np.uint8), col("number", np.uint8), col("first", np.uint8), col("second", np.uint8),
                                shared.value, alpha, least)
        count = col("counts", "<u4").astype(np.int64)
        start = np.cumsum(count) - count
        texts = pc.binary_length(table.column("texts")).to_numpy().astype(np.int64) // 4
        give = lambda x: _binary(texts, 8, np.add.reduceat(x, start).tobytes())
        return pa.table({"batch": table.column("batch"), "ids": table.column("ids"), "texts": table.column("texts"),
                         "log_sum": give(out), "n_words": give(words)})

    def add(table: pa.Table) -> pa.Table:
        col = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        ids, at = col("ids", np.int64), col("texts", "<u4")
        total = lambda name, kind: np.bincount(at, col(name, kind), len(ids))
        words = total("n_words", np.int64).astype(np.int64)
        some = words > 0
        return pa.table({"doc_id": pa.array(ids[some], mask=ids[some] == _NO_ID), "log_sum": total("log_sum", np.float64)[some],
                         "n_words": words[some]})

    sums = (packed.groupBy("part").applyInArrow(score, "batch long, ids binary, texts binary, log_sum binary, n_words binary")
            .groupBy("batch").applyInArrow(add, "doc_id long, log_sum double, n_words long"))
    return sums.groupBy("doc_id").agg(F.sum("n_words").alias("n_words"), F.sum("log_sum").alias("log_sum"))


def score_documents(docs: DataFrame, alpha: float = ALPHA, least: int = LEAST, top_words: int = TOP, share: int = SHARE) -> DataFrame:
    """(doc_id, n_words, score) for every row of ``docs``; score is the mean ln S, null without words."""
    sums = backoff_scores(docs, alpha, least, top_words, share).withColumnRenamed("doc_id", "_id")
    return (docs.select(F.col("doc_id").cast("long")).join(sums, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
            .select("doc_id", F.coalesce("n_words", F.lit(0)).alias("n_words"),
                    (F.col("log_sum") / F.col("n_words")).alias("score")))
