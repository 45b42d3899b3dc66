"""Language of words in code-switched text: a linear-chain conditional random field.

States are languages. A word's features are its character n-grams with word-edge marks
(those that touch a mark are its affixes), itself, and its place in the languages'
lexicons; transition weights are learned with them. Texts are labelled by
forward-backward over the whole chain of words; a document's language is the one with
the highest mean marginal, its score that mean.

Fitting: on a bounded sample of labelled rows (``SAMPLE`` windows of ``WINDOW`` characters, an
equal share for each language, chosen by hash); labels are given for whole documents, so
training chains are spliced from runs of different documents, which teaches the switches.
The weights are fitted on the driver from that sample alone. Prediction covers every
word of every text, in the executors, and reads nothing but the text.

Defined cases: a text that is null or has no letter is ``und`` with score 0; if no row has
a language to learn from, every text is; repeated rows get equal answers; long texts are
one chain, worked off in groups of bounded size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import uniform

SAMPLE, WINDOW = 2400, 1500
BITS = 17
CHAIN, CHAINS, ROUNDS = 48, 3000, 60
UND = "und"
_WORD = re.compile(r"[^\W\d_]+")
_GROUP = 4_000_000      # characters of texts labelled together
_VOCAB = 15_000         # words whose features are made together


def words(text: str | None) -> list[str]:
    """Runs of letters, lower case; none if there is no letter."""
    found = _WORD.findall((text or "").lower())
    return found if any(c.isalpha() for w in found for c in w) else []


# --- features --------------------------------------------------------------------------

def features(vocab: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(feature, first position of each word): hashed n-grams of 1 to 4 characters of
    ``^word$``, affixes of 4 letters, and the word. A word's features lie together."""
    marked = np.frombuffer("".join(f"^{w}$" for w in vocab).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, vocab), np.int64, len(vocab)) + 2
    start = np.cumsum(size) - size
    word = np.repeat(np.arange(len(vocab)), size)
    at = np.arange(len(marked)) - start[word]
    left = size[word] - at                      # characters from here to the word's end
    mul, found, owner = np.uint64(0x9E3779B97F4A7C15), [], []
    h = np.zeros(len(marked), np.uint64)
    for n in range(1, 6):
        shifted = np.concatenate((marked[n - 1:], np.zeros(min(n - 1, len(marked)), np.uint64)))[:len(marked)]
        h = (h ^ shifted + np.uint64(n)) * mul
        h ^= h >> np.uint64(29)
        keep = left >= n
        if n == 5:
            keep &= (at == 0) | (left == 5)
        found.append(h[keep])
        owner.append(word[keep])
    # the whole word: its characters' hashes with their places
    whole = np.add.reduceat((marked + np.uint64(77)) * (at.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * mul ^ marked << np.uint64(17),
                            start) if len(vocab) else np.zeros(0, np.uint64)
    found.append(whole * mul ^ whole >> np.uint64(31))
    owner.append(np.arange(len(vocab)))
    own = np.concatenate(owner)
    order = np.argsort(own, kind="stable")
    feature = (np.concatenate(found)[order] >> np.uint64(64 - bits)).astype(np.int64)
    count = np.bincount(own, minlength=len(vocab))
    return feature, np.cumsum(count) - count


# --- the chain ---------------------------------------------------------------------------

def forward_backward(emit: np.ndarray, first: np.ndarray, size: np.ndarray, start: np.ndarray, trans: np.ndarray):
    """Marginals of many chains at once. ``emit``: (words, states) log scores; a chain is
    ``size`` words from ``first`` on. Returns (marginals, log partition of each chain, expected
    transitions summed). Chains are sorted by length, so that each step works on those that last."""
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    top = emit.max(axis=1, keepdims=True)
    e = np.exp(emit - top)
    alpha = np.empty_like(e)
    a_ = np.exp(trans)
    live = len(size) - np.searchsorted(size[::-1], np.arange(size[0] if len(size) else 0), side="right")
    logz = np.zeros(len(size))
    scale = np.ones(len(emit))
    a = None
    for t, n in enumerate(live):
        at = first[:n] + t
        a = e[at] * np.exp(start) if t == 0 else (a[:n] @ a_) * e[at]
        s = a.sum(axis=1)
        a /= s[:, None]
        scale[at] = s
        alpha[at] = a
    moves = np.zeros_like(trans)
    b = np.ones((len(size), emit.shape[1]), e.dtype)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        at = first[:n] + t
        eb = e[at] * b[:n]
        alpha_t = alpha[at]
        alpha[at] = alpha_t * b[:n]                      # now the marginal
        if t:
            moves += (alpha_prev := alpha[at - 1]).T @ (eb / scale[at][:, None]) * a_
            b[:n] = eb @ a_.T / scale[at][:, None]
            del alpha_prev
    total = np.log(scale) + top[:, 0]
    if len(size):
        sums = np.concatenate(([0.0], np.cumsum(total)))
        logz = sums[first + size] - sums[first]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return alpha, logz[back], moves


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray             # (features, languages)
    lexicon: dict[str, int]         # word -> language it belongs to
    lex_weights: np.ndarray         # (languages, languages)
    start: np.ndarray
    trans: np.ndarray

    def emissions(self, vocab: list[str]) -> np.ndarray:
        out = np.empty((len(vocab), len(self.langs)), np.float32)
        for i in range(0, len(vocab), _VOCAB):
            part = vocab[i:i + _VOCAB]
            feature, first = features(part, int(np.log2(len(self.weights))))
            out[i:i + _VOCAB] = np.add.reduceat(self.weights[feature], first, axis=0)
            lex = np.fromiter((self.lexicon.get(w, -1) for w in part), np.int64, len(part))
            out[i:i + _VOCAB] += np.where(lex[:, None] >= 0, self.lex_weights[lex], 0)
        return out

    def label(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Marginals (words, languages) of each list of words."""
        ids: dict[str, int] = {}
        index = np.fromiter((ids.setdefault(w, len(ids)) for t in texts for w in t), np.int64)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        if not len(index):
            return [np.zeros((0, len(self.langs)), np.float32) for _ in texts]
        first = np.cumsum(size) - size
        emit = self.emissions(list(ids))[index]
        some = np.flatnonzero(size)
        marginal, _, _ = forward_backward(emit, first[some], size[some], self.start, self.trans.astype(np.float32))
        return [marginal[a:a + n] for a, n in zip(first, size, strict=True)]


def _chains(samples: list[tuple[str, str]], langs: list[str], seed: int = 7):
    """Words and labels of ``CHAINS`` chains, spliced from runs of 3 words or more of sampled texts."""
    rng = np.random.default_rng(seed)
    pool = [(langs.index(lang), w) for text, lang in samples if (w := words(text))]
    out_w, out_y = [], []
    if not pool:
        return out_w, out_y
    for _ in range(CHAINS):
        w, y = [], []
        runs = 1 if rng.random() < 0.4 else int(rng.integers(2, 5))
        for _ in range(runs):
            k, text = pool[int(rng.integers(len(pool)))]
            n = max(3, CHAIN // runs)
            at = int(rng.integers(max(1, len(text) - n + 1)))
            w += text[at:at + n]
            y += [k] * len(text[at:at + n])
        out_w.append(w)
        out_y.append(y)
    return out_w, out_y


def fit(samples: list[tuple[str, str]], bits: int = BITS, rounds: int = ROUNDS, l2: float = 1e-3, rate: float = 0.15) -> Model | None:
    """Fit on (text, language) pairs by Adam on the mean log-likelihood of the chains."""
    langs = sorted({lang for text, lang in samples if words(text)})
    if not langs:
        return None
    k = len(langs)
    chains, labels = _chains(samples, langs)
    ids: dict[str, int] = {}
    index = np.fromiter((ids.setdefault(w, len(ids)) for t in chains for w in t), np.int64)
    y = np.fromiter((v for t in labels for v in t), np.int64)
    size = np.fromiter(map(len, chains), np.int64, len(chains))
    first = np.cumsum(size) - size
    vocab = list(ids)
    feature, at = features(vocab, bits)
    owner = np.repeat(np.arange(len(vocab)), np.diff(np.append(at, len(feature))))
    # lexicon: words seen three times or more, nine tenths of them in one language
    seen = np.zeros((len(vocab), k))
    np.add.at(seen, (index, y), 1)
    best, total = seen.argmax(axis=1), seen.sum(axis=1)
    inside = (total >= 3) & (seen.max(axis=1) >= 0.9 * total)
    lex = np.where(inside, best, -1)
    model = Model(langs, np.zeros((1 << bits, k), np.float32), {w: int(v) for w, v in zip(vocab, lex, strict=True) if v >= 0},
                  np.zeros((k, k), np.float32), np.zeros(k), np.zeros((k, k)))
    gold = np.zeros_like(seen)
    np.add.at(gold, (index, y), 1)
    gold_start = np.bincount(y[first], minlength=k)
    inner = np.ones(len(y), bool)
    inner[first] = False
    gold_moves = np.zeros((k, k))
    np.add.at(gold_moves, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
    params = [model.weights, model.lex_weights, model.start, model.trans]
    m1, m2 = [np.zeros(p.shape, p.dtype) for p in params], [np.zeros(p.shape, p.dtype) for p in params]
    for r in range(1, rounds + 1):
        word = np.add.reduceat(model.weights[feature], at, axis=0) + np.where(lex[:, None] >= 0, model.lex_weights[lex], 0)
        marginal, _, moves = forward_backward(word[index].astype(np.float64), first, size, model.start, model.trans)
        expected = np.stack([np.bincount(index, marginal[:, j], len(vocab)) for j in range(k)], axis=1)
        off = (gold - expected) / len(y)
        grads = [np.stack([np.bincount(feature, off[owner, j], 1 << bits) for j in range(k)], axis=1),
                 np.stack([off[lex == j].sum(axis=0) for j in range(k)]),
                 (gold_start - marginal[first].sum(axis=0)) / len(y), (gold_moves - moves) / len(y)]
        for p, g, u, v in zip(params, grads, m1, m2, strict=True):
            g = g - l2 / len(y) * p
            u += 0.1 * (g - u)
            v += 0.01 * (g * g - v)
            p += (rate * (u / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-9)).astype(p.dtype)
    return model


# --- on Spark ---------------------------------------------------------------------------

def training_sample(docs: DataFrame, where: Column, sample: int = SAMPLE, window: int = WINDOW) -> list[tuple[str, str]]:
    """About ``sample`` (text, lang) windows of the rows that hold ``where``, an equal share for each language.

    Counting reads (doc_id, lang) only; rows are chosen by a hash threshold, so the same rows come each time.
    A doc_id gives one window, however many rows have it; rows without one give none.
    """
    rows = docs.where(where & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    each = max(1, sample // len(counts))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == F.lit(lang), F.lit(min(1.0, each / n))).otherwise(share)
    draw = uniform(F.lit("crf"), F.col("doc_id"))
    n = F.length("text")
    at = F.floor(uniform(F.lit("at"), F.col("doc_id")) * F.greatest(n - window + 1, F.lit(1))).cast("int") + 1
    got = rows.where((draw < share) & F.col("text").isNotNull()).select(
        "doc_id", F.struct(F.substring("text", at, F.lit(window)).alias("text"), "lang").alias("w"))
    got = got.groupBy("doc_id").agg(F.min("w").alias("w")).select("doc_id", "w.*").collect()
    return [(r["text"], r["lang"]) for r in sorted(got, key=lambda r: r["doc_id"])]


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, divided by 5 without rest (a null id: not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predict(texts: list[str | None], model: Model | None) -> list[tuple[str, float]]:
    """(language, score) of each text, whole texts in groups of bounded size."""
    out: list[tuple[str, float]] = [(UND, 0.0)] * len(texts)
    if model is None:
        return out
    group: list[list[str]] = []
    at: list[int] = []
    chars = 0

    def close():
        for i, marginal in zip(at, model.label(group), strict=True):
            if len(marginal):
                mean = marginal.mean(axis=0, dtype=np.float64)
                out[i] = (model.langs[int(mean.argmax())], min(1.0, max(0.0, float(mean.max()))))
        group.clear()
        at.clear()

    # chains of like length together: a group takes as many steps as its longest
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i] or "")):
        group.append(words(texts[i]))
        at.append(i)
        chars += len(texts[i] or "")
        if chars >= _GROUP:
            close()
            chars = 0
    close()
    return out


def learn(docs: DataFrame) -> Model | None:
    """The model of ``docs`` (doc_id, text, lang), from rows that are not held out."""
    return fit(training_sample(docs, ~held_out(F.col("doc_id"))))


def _labelled(model, at: int, keep: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            got = predict(texts, model.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())],
                names=[*batch.schema.names[:keep], "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of ``docs`` (doc_id, text, lang); learns if no model is given."""
    shared = docs.sparkSession.sparkContext.broadcast(model or learn(docs))
    some = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return some.mapInArrow(_labelled(shared, 2, 2), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.5, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is found (not ``und``) with a score of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model or learn(docs))
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            got = predict(batch.column(at).to_pylist(), shared.value)
            yield batch.filter(pa.array([lang != UND and score >= least for lang, score in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
