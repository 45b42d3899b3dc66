"""Best-fit packing of documents into sequences, after Martello-Toth reduction.

Lengths are whole numbers up to the capacity, so a histogram of at most ``capacity``
counts describes the packing problem completely, whatever the number of documents. The
plan is made on that histogram: first, sets that provably dominate every alternative
are fixed (:func:`reduce_counts`), which shrinks the instance, then the rest is packed
best-fit, longest first (:func:`best_fit`). Both work on counts, so the plan is a
bounded table of patterns. The documents never leave the executors: each piece gets its
number among the pieces of its length (block counts and a window inside a block) and
looks up its pattern by that number.

Defined cases: null and empty texts are one end token; longer documents are cut into
full pieces, the first one shorter; equal rows are packed as separate pieces; an empty
table gives an empty result; texts of any size are tokenized whole.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import cut, partitions

CAPACITY = 1024
END = 2

# --- tokens ---------------------------------------------------------------------------

#: Texts of these characters only are encoded by tiktoken, which gives the same ids as
#: the tokenizers file and is five times as fast (tests compare both). All else,
#: and texts with very long runs or a special token's string, goes to tokenizers.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7E¡-¬®-ɏ–-…]*")
_SHORT_RUNS = re.compile(r"\s{0,1999}+(?:\S{1,1999}+\s{1,1999}+)*+\S{0,1999}+")     # one pass, whatever the runs
_SPECIAL = "<|endoftext|>"


def is_plain(text: str) -> bool:
    """Whether tiktoken gives the ids of the tokenizers file for this text (special tokens' strings aside)."""
    return bool(_PLAIN.fullmatch(text) and _SHORT_RUNS.fullmatch(text))


class Encoder:
    """ids of texts as tokenizers gives them for ``byte_bpe_50k.json``."""

    def __init__(self, json_path: str, ranks_path: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if _SPECIAL not in text and is_plain(text):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(json_path: str, ranks_path: str) -> Encoder:
    """One per Python worker."""
    key = (json_path, ranks_path)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, json_path: str, ranks_path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of (doc_id, text)."""

    def run(batches):
        enc = encoder(json_path, ranks_path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            out = []
            for i in range(batch.num_rows):
                tokens = np.array([*enc.ids(texts[i].as_py() or ""), end], dtype="<u4")
                for k, (start, length) in enumerate(cut_points(len(tokens), capacity)):
                    out.append((i, k, start, length, zlib.crc32(tokens[start:start + length].tobytes())))
            if not out:
                continue
            row, k, start, length, crc = (pa.array(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [ids.take(row), k.cast(pa.int32()), start.cast(pa.int64()), length.cast(pa.int64()), crc.cast(pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- the plan, on counts by length -----------------------------------------------------

def _fit(present: list[int], room: int) -> int:
    """The largest length in the ascending list that is at most ``room``; 0 if none."""
    i = int(np.searchsorted(present, room, side="right"))
    return present[i - 1] if i else 0


def _smallest(count: dict[int, int], present: list[int], k: int, floor: int = 0) -> list[int]:
    """The ``k`` smallest lengths above ``floor``, with repeats."""
    out: list[int] = []
    for s in present[int(np.searchsorted(present, floor, side="right")):]:
        out += [s] * min(count[s], k - len(out))
        if len(out) == k:
            break
    return out


def dominating_set(count: dict[int, int], j: int, capacity: int) -> list[int] | None:
    """Partners of a document of length ``j`` in a set that dominates all others that hold
    it, or None if these rules prove none. ``count``: the other documents.

    A set dominates another if the other's members can be dealt to members of the first,
    each taking a total of at most its own length; exchanging them never costs a bin.
    """
    present = sorted(s for s, c in count.items() if c)
    room = capacity - j
    low = _smallest(count, present, 3)
    if not low or low[0] > room:
        return []                                   # nothing fits beside it
    k = _fit(present, room)
    if k == room or len(low) == 1 or low[0] + low[1] > room:
        return [k]                                  # exact fit, or only one other fits: the longest
    if len(low) == 3 and sum(low) <= room:
        return None                                 # three others can fit: no rule
    # at most two others fit: the best pair a + b
    best, pair = 0, (0, 0)
    for a in present:
        left = room - a
        if left < a and left < present[0]:
            break
        count[a] -= 1
        b = _fit([s for s in present if count[s]], left)
        count[a] += 1
        if b and a + b > best:
            best, pair = a + b, (a, b)
    if k >= best:
        return [k]                                  # any pair fits in the place of k
    if k in pair:
        b = best - k
        count[k] -= 1
        two = _smallest(count, [s for s in present if count[s]], 2, floor=b)
        count[k] += 1
        # a pair with both members above b would not fit into (k, b)
        if k <= b or len(two) < 2 or sum(two) > room:
            return [k, b]
    return None


def reduce_counts(count: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Fix dominating sets, longest document first, until none is left to prove.

    Changes ``count`` to what remains. Returns patterns (length -> times, number of
    sequences). One rule covers many equal sets: it stays true while its members last,
    since taking documents away only removes alternatives.
    """
    fixed, progress = [], True
    while progress:
        progress = False
        for j in sorted((s for s, c in count.items() if c), reverse=True):
            while count.get(j):
                count[j] -= 1
                mates = dominating_set(count, j, capacity)
                count[j] += 1
                if mates is None:
                    break
                pattern: dict[int, int] = defaultdict(int)
                for s in [j, *mates]:
                    pattern[s] += 1
                times = min(count[s] // k for s, k in pattern.items())
                for s, k in pattern.items():
                    count[s] -= k * times
                fixed.append((dict(pattern), times))
                progress = True
    return fixed


def best_fit(count: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Longest first, each into the fullest sequence that has room; on counts."""
    open_: dict[int, list[list]] = defaultdict(list)        # room -> [pattern, sequences]
    for s in sorted((s for s, c in count.items() if c), reverse=True):
        n = count[s]
        for room in sorted(r for r in open_ if r >= s):
            kept = []
            for pattern, m in open_.pop(room):
                each = room // s
                full = min(m, n // each)
                part = n - full * each if full < m else 0
                if full:
                    open_[room - each * s].append([pattern | {s: each}, full])
                if part:
                    open_[room - part * s].append([pattern | {s: part}, 1])
                if m - full - bool(part):
                    kept.append([pattern, m - full - bool(part)])
                n -= full * each + part
            if kept:
                open_[room].extend(kept)
            if not n:
                break
        each = capacity // s
        if n // each:
            open_[capacity - each * s].append([{s: each}, n // each])
        if n % each:
            open_[capacity - n % each * s].append([{s: n % each}, 1])
    return [(p, m) for group in open_.values() for p, m in group]


def plan(count: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first number, times per sequence, first sequence, offset): the pieces of
    a length from that number on go, so many to a sequence, to sequences from that one on."""
    count = {int(k): int(v) for k, v in count.items()}
    used: dict[int, int] = defaultdict(int)
    rows, seq = [], 0
    for pattern, m in reduce_counts(count, capacity) + best_fit(count, capacity):
        offset = 0
        for s, times in sorted(pattern.items(), reverse=True):
            rows.append((s, used[s], times, seq, offset))
            used[s] += times * m
            offset += times * s
        seq += m
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, json_path: str, ranks_path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pack (doc_id, text): a row for each piece, with sequence_id and offset.

    The pieces are written once. The plan (at most a few patterns for each of the
    ``capacity`` lengths) is the only thing that passes through the driver.
    """
    cutted = cut(pieces(docs, json_path, ranks_path, capacity, end), "pieces")
    blocks = 4 * partitions(docs)
    numbered = cutted.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(blocks)))
    per_block = numbered.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    base = per_block.withColumn("base", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    count = {r["length"]: r["n"] for r in cutted.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = plan(count, capacity)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (numbered.withColumn("no", F.row_number().over(inside) - 1)
              .join(base.select("length", "block", "base"), ["length", "block"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("no") + F.col("base")).alias("no")))

    def place(batches):
        t = shared.value
        # one sorted key for (length, first number): numbers stay far below 2**52
        starts = t[:, 0].astype(np.float64) * 2.0 ** 42 + t[:, 1]
        for batch in batches:
            length = batch.column(3).to_numpy()
            no = batch.column(5).to_numpy()
            row = t[np.searchsorted(starts, length.astype(np.float64) * 2.0 ** 42 + no, side="right") - 1]
            done = no - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(row[:, 3] + done // row[:, 2]), pa.array(row[:, 4] + done % row[:, 2] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
