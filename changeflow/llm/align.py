"""Cross-tokenizer alignment by whitespace-token anchors.

Two tokenizers, A and B, encode the same text whole. Where tokens of both end at the same byte and the
next token of both begins with a space, the document is split: such an anchor is a shared end whatever
follows. The windows between anchors, mostly a word each, repeat all over a corpus, so the alignment
of a window is remembered by the tuples of its token ids: the places where tokens of both end cut it into
groups, and each shared end links the A token and the B token that end there.

How often an id pair is linked in the corpus is a count over all documents. To give each document
the counts of its own links, the ``FREQUENT`` most frequent pairs (a bounded table) are looked up where the
document is; all other pairs are joined by pair, and none of them holds more than one
in ``FREQUENT`` of all links, so no task holds a hot pair.

Scale: both tokenizers run once; what is written per document is its distinct pairs with their number. The
memory of windows is bounded (``KEPT`` windows and those of one pass, twice over: when full, the older half goes); windows not
remembered are aligned in one pass over those of ``TOGETHER`` characters of texts.

Defined cases: null and empty texts, and those whose joined tokens of A or B are not space + text
in bytes, have no tokens: zeros, and '' for ``groups_sha256``. Special tokens' strings in a text are plain
text. Repeated rows count each. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut
from changeflow.llm.pack import encoder, is_plain

FREQUENT = 1 << 16
KEPT, LONGEST = 1 << 17, 24      # windows a worker remembers, twice over, and the most tokens of such a window
TOGETHER = 1 << 19               # characters of texts whose unknown windows are aligned in one pass
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def byte_table() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones as themselves, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the windows aligned so far."""

    def __init__(self, json_path: str, ranks_path: str, model_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.exact = Tokenizer.from_file(json_path)
        self.exact.encode_special_tokens = True
        self.fast = encoder(json_path, ranks_path).fast
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model_path)
        table, vocab = byte_table(), self.exact.get_vocab(with_added_tokens=True)
        self.a = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.a[i] = bytes(table[c] for c in entry) if all(c in table for c in entry) else entry.encode("utf-8")
        self.b = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.len_a, self.len_b = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.a, self.b))
        self.space_a, self.space_b = (np.array([t[:1] == b" " for t in x]) for x in (self.a, self.b))
        # an id as it is said inside its group, and as the last of its side there
        self.first_b = len(self.a)
        self.said = [f"{i}{m}" for x, marks in ((self.a, ",|"), (self.b, ",;")) for i in range(len(x)) for m in marks]
        self.known: dict[bytes, tuple] = {}
        self.before: dict[bytes, tuple] = {}         # the windows known when the memory was full last

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(_BYTE.fullmatch(piece)[1], 16)])
        return piece.replace("▁", " ").encode("utf-8")

    def ids(self, text: str) -> tuple[list[int], list[int]] | None:
        """The ids of both, None unless both spell space + text."""
        if not text:
            return None
        said = " " + text
        a = self.fast.encode_ordinary(said) if is_plain(said) else self.exact.encode(said, add_special_tokens=False).ids
        b = self.pieces.encode(text)
        raw = said.encode("utf-8")
        if b"".join([self.a[i] for i in a]) != raw or b"".join([self.b[i] for i in b]) != raw:
            return None
        return a, b

    def windows(self, keys: list[bytes]) -> list[tuple[str, bytes]]:
        """(groups as text, linked pairs) of each window. A window begins and ends together, so windows one after the other
        are aligned in one pass: a group ends where tokens of both end."""
        ids = np.frombuffer(b"".join(keys), np.int32).astype(np.int64)
        if not len(ids):
            return []
        is_b = ids >= self.first_b
        a, b = ids[~is_b], ids[is_b] - self.first_b
        tokens = np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys)) // 4)
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, shared), np.searchsorted(end_b, shared)
        links = ((a[last_a] << 32) | b[last_b]).tobytes()
        # tokens in the order of the text: a group's A ids, then its B ids; the last of either has another mark behind it
        code_a, code_b = a * 2, (b + self.first_b) * 2
        code_a[last_a] += 1
        code_b[last_b] += 1
        order = np.empty(len(ids), np.int64)
        order[np.arange(len(a)) + np.append(0, last_b + 1)[np.searchsorted(shared, end_a)]] = code_a
        order[np.arange(len(b)) + (last_a + 1)[np.searchsorted(shared, end_b)]] = code_b
        said = list(map(self.said.__getitem__, order.tolist()))
        groups = 8 * (np.searchsorted(shared, end_a[np.cumsum(~is_b)[tokens - 1] - 1]) + 1)
        return [("".join(said[i:j])[:-1], links[g:h])
                for (i, j), (g, h) in zip(pairwise([0, *tokens.tolist()]), pairwise([0, *groups.tolist()]), strict=True)]

    def learn(self, keys: set[bytes]) -> dict[bytes, tuple]:
        """The alignments of windows that ``known`` lacks, remembered from now on unless long."""
        before = self.before
        found = {k: before[k] for k in keys if k in before} if before else {}
        new = [k for k in keys if k not in found] if found else list(keys)
        found.update(zip(new, self.windows(new), strict=True))
        if len(self.known) >= KEPT:
            self.before, self.known = self.known, {}
        self.known.update({k: x for k, x in found.items() if len(k) <= 4 * LONGEST})
        return found

    def split(self, text: str | None) -> tuple[int, int, list[bytes]]:
        """(n_a, n_b, windows) of a whole text, cut at its anchors. A window is the tuple of its A ids and its B ids, the
        latter ``first_b`` higher, as the bytes of 32-bit numbers: one key that nothing else shares."""
        both = self.ids(text or "")
        if both is None:
            return 0, 0, []
        ia, ib = (np.array(x, dtype=np.int64) for x in both)
        start_a, start_b = np.cumsum(self.len_a[ia]) - self.len_a[ia], np.cumsum(self.len_b[ib]) - self.len_b[ib]
        at_a, at_b = np.flatnonzero(self.space_a[ia]), np.flatnonzero(self.space_b[ib])
        marked = np.zeros((2, int(max(start_a[-1], start_b[-1])) + 1), dtype=bool)       # bytes of the text
        marked[0, start_a[at_a]] = True
        marked[1, start_b[at_b]] = True
        x, y = at_a[marked[1, start_a[at_a]]], at_b[marked[0, start_b[at_b]]]
        first = 1 if len(x) and x[0] == 0 else 0                                         # the text's own beginning is no cut
        x, y = np.append(x[first:], len(ia)), np.append(y[first:], len(ib))              # ends of the windows
        n_a, n_b = np.diff(x, prepend=0), np.diff(y, prepend=0)
        ids = np.empty(len(ia) + len(ib), np.int32)
        ids[np.arange(len(ia)) + np.repeat(y - n_b, n_a)] = ia
        ids[np.arange(len(ib)) + np.repeat(x, n_b)] = ib + self.first_b
        raw = ids.tobytes()
        return len(ia), len(ib), [raw[i:j] for i, j in pairwise([0, *(4 * (x + y)).tolist()])]

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """(n_a, n_b, n_groups, groups as text, linked pairs in order) of each whole text; the windows of all of them that
        are not known yet are aligned together."""
        docs = [self.split(t) for t in texts]
        known = [list(map(self.known.get, keys)) for *_, keys in docs]
        unknown = {key for (*_, keys), found in zip(docs, known, strict=True) if None in found
                   for key, x in zip(keys, found, strict=True) if x is None}
        learned = self.learn(unknown)
        for (n_a, n_b, keys), found in zip(docs, known, strict=True):
            if None in found:
                found = [x or learned[key] for x, key in zip(found, keys, strict=True)]
            links = np.frombuffer(b"".join([x[1] for x in found]), np.int64)
            yield n_a, n_b, len(links), ";".join([x[0] for x in found]), links       # every group ends in one link


def together(texts: Iterable[str | None], size: int = TOGETHER) -> Iterator[list[str | None]]:
    """Texts in lists of up to ``size`` characters, or of one longer text."""
    out, n = [], 0
    for t in texts:
        if out and n + len(t or "") > size:
            yield out
            out, n = [], 0
        out.append(t)
        n += len(t or "")
    if out:
        yield out


_pairs: dict[tuple[str, str, str], Pair] = {}


def pair(*paths: str) -> Pair:
    """One per Python worker."""
    if paths not in _pairs:
        _pairs[paths] = Pair(*paths)
    return _pairs[paths]


def aligned(docs: DataFrame, json_path: str, ranks_path: str, model_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of (doc_id, text): the document's
    distinct linked pairs (A id * 2^32 + B id) and how often it links each."""

    def run(batches):
        both = pair(json_path, ranks_path, model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, ends, pairs, times = [], [0], [], []
                for n_a, n_b, n, groups, links in chain.from_iterable(map(both.align, together(t.as_py() for t in part.column(1)))):
                    rows.append((n_a, n_b, n, len(links), hashlib.sha256(groups.encode()).hexdigest() if n_a else ""))
                    p, c = np.unique(links, return_counts=True)
                    pairs.append(p)
                    times.append(c.astype(np.int32))
                    ends.append(ends[-1] + len(p))
                offsets = pa.array(ends, pa.int32())
                cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.string()], strict=True)]
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols, *lists], names=[
                    "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): how often the corpus links each pair, and whether no pair of the same B id has more."""
    links = rows.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = cut(links.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")), "align-pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))                 # a row for each entry of B's vocabulary
    best = F.broadcast(most)
    return counts.withColumn("b", b).join(best, "b", "left").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_counts(docs: DataFrame, json_path: str, ranks_path: str, model_path: str, frequent: int = FREQUENT) -> DataFrame:
    """A row for each row of (doc_id, text): its tokens, groups and links, how many of its links are best
    for their B id (``n_best``), and the sum of their counts (``count_sum``)."""
    spark = docs.sparkSession
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = cut(aligned(docs, json_path, ranks_path, model_path).withColumn("row", F.monotonically_increasing_id()), "align-rows")
    counts = cut(pair_counts(rows), "align-counts")
    # the most frequent pairs, at most ``frequent``: the only pairs that pass through the driver
    top = counts.orderBy(F.col("n").desc(), "pair").limit(frequent).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast((top["pair"].to_numpy(), top["n"].to_numpy(), top["best"].to_numpy()))

    def known(batches):
        """Sums over a document's frequent pairs; the others stay as lists."""
        keys, n, best = shared.value
        for batch in batches:
            size = pc.list_value_length(batch.column("pairs")).to_numpy(zero_copy_only=False)
            pairs = batch.column("pairs").flatten().to_numpy()
            times = batch.column("times").flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), size)
            at = np.searchsorted(keys, pairs).clip(0, max(0, len(keys) - 1))
            hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), dtype=bool)

            def total(values: np.ndarray) -> np.ndarray:
                out = np.zeros(batch.num_rows, dtype=np.int64)
                np.add.at(out, doc[hit], values)
                return out
            sums = total(times[hit] * n[at[hit]]), total(times[hit] * best[at[hit]].astype(np.int64))
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc[~hit], minlength=batch.num_rows))]).astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[~hit])) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ["row", *names]), *(pa.array(x) for x in sums), *rest],
                                             names=["row", *names, "sum_f", "best_f", "pair", "times"])

    ddl = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "sum_f long, best_f long, pair array<long>, times array<long>")
    split = cut(rows.mapInArrow(known, ddl), "align-split")
    rare = split.select("row", F.inline(F.arrays_zip("pair", "times")))
    per = (rare.join(counts.hint("shuffle_hash"), "pair").groupBy("row")
           .agg(F.sum(F.col("times") * F.col("n")).alias("sum_r"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_r")))
    zero = F.lit(0).cast("long")
    return split.join(per, "row", "left").select(
        *names[:-1], (F.col("best_f") + F.coalesce("best_r", zero)).alias("n_best"),
        (F.col("sum_f") + F.coalesce("sum_r", zero)).alias("count_sum"), "groups_sha256")
