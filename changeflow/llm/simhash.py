"""SimHash near-duplicates by anchor-point covering.

Fingerprint: the majority of each bit over the XXH64 hashes of a text's word shingles.
Two fingerprints link at ``DISTANCE`` = 3 or fewer differing bits.

Covering: a 64-bit fingerprint is two blocks of 32 bits; of 3 differing bits at most 1
lies in one of the blocks, so it is enough to find pairs at distance 1 in a block. The
anchors of a block are the words of a covering code: Hamming's perfect [31, 26] code,
whose covering radius is 1, and the free 32nd bit: 2**27 anchors. Every fingerprint goes
to every anchor within covering radius plus threshold, 1 + 1 = 2, of its block: 17 at
most. If x and y are 1 apart, the anchor nearest to x (at 1 at most) is 2 at most from
y, so they meet there, and only there whole fingerprints are compared. The search is
exact.

Scale: equal fingerprints are one node, so copies cost nothing. An anchor's group yields
a spanning forest of its links, never all pairs: small groups are compared by shifted
vectors, large ones (a cluster of near copies) by a search that takes linked members
out. Rows reach the search sorted, as a stream; only one group is held at a time.

Defined cases: null and empty texts have fingerprint 0 and link like any other; a row
without doc_id takes part in linking but cannot name a component (component_id is the
least doc_id reachable, null if none has one); repeated rows stay separate rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut
from changeflow.llm.components import components

SHINGLE = 3
DISTANCE = 3
_STEP = 1 << 16


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash. bytes.lower() folds A-Z only, bytes.split() splits at ASCII
    white space only. Shingles are slices of the space-joined words; votes are counted
    in steps, so that memory does not grow with the text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - k + 1)
    starts, ends = starts[:n].tolist(), ends[min(k, len(words)) - 1:].tolist()
    votes, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, _STEP):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at:at + _STEP], ends[at:at + _STEP], strict=True)], ">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of (doc_id, text); fp is the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), k) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


# --- anchors ---------------------------------------------------------------------------

def _code():
    """For each syndrome, the error patterns of weight 2 or less that lead to a code word of
    the 31-bit Hamming code (bit i has column i + 1), padded with the first."""
    by = [[0]] + [[1 << (s - 1)] for s in range(1, 32)]
    for i in range(1, 32):
        for j in range(i + 1, 32):
            by[i ^ j].append(1 << (i - 1) | 1 << (j - 1))
    home = np.array([x[0] for x in by], np.uint64)
    ball = np.array([(x + x[:1] * 16)[:16] for x in by], np.uint64)
    masks = np.array([sum(1 << (i - 1) for i in range(1, 32) if i >> b & 1) for b in range(5)], np.uint64)
    return home, ball, masks


_HOME, _BALL, _MASKS = _code()


def block_anchors(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For 32-bit blocks: (row, anchor, is the row's nearest) of all anchors within 2."""
    low, top = block & np.uint64(0x7FFFFFFF), block & np.uint64(0x80000000)
    syndrome = np.zeros(len(block), np.int64)
    for b, mask in enumerate(_MASKS):
        syndrome |= (np.bitwise_count(low & mask) & 1).astype(np.int64) << b
    near = low ^ _HOME[syndrome]
    row = np.arange(len(block))
    # nearest; then at distance 2: two flips below, or one below and the free bit
    rows, anchors, home = [row, row], [near | top, near | (top ^ np.uint64(0x80000000))], [np.ones(len(row), bool), np.zeros(len(row), bool)]
    some = np.flatnonzero(syndrome)
    rows.append(np.repeat(some, 15))
    anchors.append(((low[some, None] ^ _BALL[syndrome[some], 1:]) | top[some, None]).ravel())
    home.append(np.zeros(15 * len(some), bool))
    return np.concatenate(rows), np.concatenate(anchors), np.concatenate(home)


def _expand(batches):
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for b in (0, 1):
            row, anchor, home = block_anchors(fp >> np.uint64(32 * b) & np.uint64(0xFFFFFFFF))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.astype(np.int64) | b << 32), pa.array(fp[row].view(np.int64)), pa.array(home)],
                names=["anchor", "fp", "home"])


def forest(fp: np.ndarray, most: int) -> list[np.ndarray]:
    """Links that connect what is connected at ``most`` bits, at most one a member: a search
    from each member that compares it with the members not reached yet."""
    rest, out = fp, []
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(rest ^ x) <= most
            if near.any():
                out.append(np.stack([np.full(near.sum(), x), rest[near]]))
                front.extend(rest[near])
                rest = rest[~near]
    return out


def _group_links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, most: int, small: int = 32) -> np.ndarray:
    """Links (2, n) within equal anchors; the arrays are sorted by anchor and whole."""
    start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    size = np.diff(np.concatenate((start, [len(anchor)])))
    live = (size > 1) & np.logical_or.reduceat(home, start)
    out = []
    few = np.repeat(live & (size <= small), size)
    a, f, h = anchor[few], fp[few], home[few]
    for shift in range(1, small):
        if shift >= len(a):
            break
        same = np.flatnonzero((a[shift:] == a[:-shift]) & (h[shift:] | h[:-shift]))
        if not len(same):
            continue
        x, y = f[same], f[same + shift]
        near = np.bitwise_count(x ^ y) <= most
        out.append(np.stack([x[near], y[near]]))
    for i in np.flatnonzero(live & (size > small)):
        out += forest(fp[start[i]:start[i] + size[i]], most)
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.uint64)


def _links(most: int):
    def run(batches):
        kept = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)]

        def emit(cols):
            pairs = np.unique(_group_links(*cols, most), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in pairs], names=["u", "v"])

        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64),
                   batch.column(2).to_numpy(zero_copy_only=False)]
            cols = [np.concatenate(x) for x in zip(kept, new, strict=True)]
            # the last anchor may go on in the next batch
            at = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0
            if at:
                yield emit([x[:at] for x in cols])
            kept = [x[at:] for x in cols]
        if len(kept[0]):
            yield emit(kept)
    return run


def links(nodes: DataFrame, most: int = DISTANCE) -> DataFrame:
    """(u, v) that connect the distinct fingerprints ``nodes`` (fp) within ``most`` bits; each
    pair found at its anchors, of a large group only a spanning forest. ``most`` is 3 or less."""
    if most > DISTANCE:
        raise ValueError("two blocks and radius 1 find at most 3 differing bits")
    return (nodes.select("fp").mapInArrow(_expand, "anchor long, fp long, home boolean")
            .repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(_links(most), "u long, v long").distinct())


def simhash_groups(docs: DataFrame, k: int = SHINGLE, most: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text)."""
    fps = cut(fingerprints(docs, k), "simhash")
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    root = components(links(nodes, most))
    named = nodes.join(root, nodes.fp == root.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(ids, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def dedup(docs: DataFrame, k: int = SHINGLE, most: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the least
    doc_id stays (one of them, if rows repeat). Rows without doc_id stay as they are."""
    named = docs.where("doc_id is not null")
    kept = (simhash_groups(named, k, most).where("doc_id = component_id")
            .select("doc_id").distinct())
    one = named.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where("doc_id is null"))
