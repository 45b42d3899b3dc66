"""Importance resampling, personal data and cross-tokenizer alignment against plain versions, and their edges."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from changeflow.llm import align, personal, queries, resample

SF = "/root/testdata/sf0.01"
LONG = "a mail to ann.lee@example.org or 10.0.0.7, card 4111 1111 1111 1111. " * 2000
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "Ann said x"), (5, "Ann said x"), (None, "one two"), (None, None),
         (6, "a😀b <|endoftext|> <0x41> </s> é" + "\x00\x01"), (7, "no▁space ▁ here"), (8, "1" * 30_000), (9, "aé  漢字    ﬁ")]


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, 1, 2, 3, 4, 5, 6, "z") for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, at long, part int, pair long, n long, row long, score long, features string").repartition(3)


# --- resampling -----------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def drawn(docs, target, orders=1, buckets=10_000, least=20, percent=10, seed=2024):
    """(doc_id, n_features, weight, score, rank) by the definition; docs: list of (doc_id, text)."""
    def features(t):
        w = WORD.findall(lowered(t))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, orders + 1) for i in range(len(w) - n + 1)]
    found = [features(t) for _, t in docs]
    s, t = Counter(b for _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = s.total(), t.total()
    gain = [math.floor(1000 * math.log((float(t[b]) + 1) * (s_all + buckets) / ((float(s[b]) + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for (i, _), (n, f) in zip(docs, found, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        rows.append([i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    due = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(due[:len(due) * percent // 100])}
    return sorted(((r[0], r[2], r[3], r[4], rank.get(id(r))) for r in rows), key=str)


def shown(rows):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows), key=str)


def test_resample(spark, texts):
    target = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    assert shown(queries.op11_resample(spark, SF).collect()) == drawn(list(texts.items()), target)


@pytest.mark.parametrize("orders,percent,least", [(2, 50, 1), (3, 100, 0)])
def test_resample_longer_features(spark, texts, orders, percent, least):
    docs, target = list(texts.items())[:120], ["the quick brown fox", None, "Ein Haus"]
    got = resample.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string"),
                            orders=orders, buckets=997, percent=percent, least_words=least)
    assert shown(got.collect()) == drawn(docs, target, orders, 997, least, percent)


def test_resample_edges(spark, edges):
    target = spark.createDataFrame([("one card",)], "text string")
    got = resample.resample(edges, target, least_words=0, percent=100).collect()
    want = drawn(EDGES, ["one card"], least=0, percent=100)
    assert [r[:4] for r in shown(got)] == [r[:4] for r in want]
    assert sorted(r["rank"] for r in got) == list(range(1, len(EDGES) + 1))          # null ids tie: any order among them
    assert resample.resample(edges.limit(0), target).collect() == []
    none = resample.resample(edges, target.limit(0)).collect()
    assert len(none) == len(EDGES) and all(r["rank"] is None or r["n_words"] >= 20 for r in none)


@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
@settings(max_examples=300, deadline=None)
def test_words_and_offsets(text):
    low = lowered(text)
    assert [w for w, _ in resample.Splitter(1, 10).words(low)] == WORD.findall(low)
    assert all(low[a:b] == w for w, (a, b) in resample.Splitter(1, 10).words(low))


# --- personal data --------------------------------------------------------------------

def luhn(digits):
    d = [int(c) for c in digits]
    return (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0


def base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    patterns = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    }
    return [(*m.span(), kind) for kind, (p, ok) in patterns.items() for m in re.finditer(p, text) if ok(m.group())]


def test_personal(spark, texts):
    for r in queries.op12_personal(spark, SF).collect():
        want = base(texts[r["doc_id"]] or "")
        spelled = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert r["base_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
        assert set(filter(None, spelled.split(","))) <= set(r["spans"].split(","))
        assert [r["n_" + k] for k in personal.BASE] == [sum(x[2] == k for x in want) for k in personal.BASE]


@given(st.text(alphabet="a1.@+- ()%_é9", max_size=60))
@settings(max_examples=1500, deadline=None)
def test_base_spans_by_the_patterns(text):
    assert personal.base_spans(text) == base(text)


@given(st.text(alphabet="0123456789 -.@+aGB", max_size=80))
@settings(max_examples=500, deadline=None)
def test_spans_stay_and_do_not_touch(text):
    fixed, every = personal.scan(text)
    plain = [x[:3] for x in every]
    assert set(fixed) <= set(plain) and len(plain) == len(set(plain))
    more = sorted(x for x in plain if x[2] not in personal.BASE)
    assert all(a[1] <= b[0] for a, b in zip(more, more[1:]))
    assert not any(a < y and x < b for a, b, _ in more for x, y, _ in fixed)


@pytest.mark.parametrize("text,kind,found", [
    ("pay to IBAN GB82 WEST 1234 5698 7654 32 today", "iban", "GB82 WEST 1234 5698 7654 32"),
    ("DE89370400440532013000 AND MORE", "iban", "DE89370400440532013000"),
    ("DE89370400440532013001", "iban", None),
    ("his SSN is 123-45-6789.", "ssn", "123-45-6789"), ("part 123-45-6789", "ssn", None), ("SSN 000-45-6789", "ssn", None),
    ("amex card 3782 822463 10005", "short_card", "3782 822463 10005"), ("amex card 3782 822463 10006", "short_card", None),
    ("call (555) 010-4477 now", "tel", "(555) 010-4477"), ("sku 555-010-4477", "tel", None),
])
def test_other_kinds(text, kind, found):
    got = [text[a:b] for a, b, k, _ in personal.scan(text)[1] if k == kind]
    assert got == ([found] if found else [])


def test_context_moves_the_score():
    at = lambda t: personal.scan(t)[1][0][3]
    assert at("server ip 10.0.0.1") > at("see 10.0.0.1") > at("version 10.0.0.1")
    assert at("see 10.0.0.1" + " " * 100 + "version") == at("see 10.0.0.1")


def test_mask(spark, edges):
    assert personal.mask("to a@b.co, 10.0.0.1") == "to <email>, <ip>" and personal.mask(None) is None and personal.mask("") == ""
    masked = personal.mask_documents(edges)
    assert masked.columns == edges.columns and masked.count() == len(EDGES)
    assert personal.scan(next(r["text"] for r in masked.collect() if r["doc_id"] == 4))[1] == []


def test_personal_edges(spark, edges):
    rows = personal.scan_documents(edges).collect()
    assert len(rows) == len(EDGES)
    assert all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows if r["doc_id"] in (1, 2, 3))
    assert next(r for r in rows if r["doc_id"] == 4)["n_card"] == 2000
    assert personal.scan_documents(edges.limit(0)).collect() == []


@pytest.mark.parametrize("unit", ["1", "a", "1.", "1 ", "A", "AB12", "+1", "a.b@", "1-", "@", "(", "AB12 ", "a@b.c%", "123-45-6789 "])
def test_personal_takes_linear_time(unit):
    """A text of a million characters of one pattern is scanned in seconds, not hours."""
    begun = time.time()
    personal.scan(unit * (1_000_000 // len(unit)))
    assert time.time() - begun < 20


# --- alignment ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def both():
    import sentencepiece
    tk = Tokenizer.from_file(queries.JSON)
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    table = align.byte_table()
    assert sorted(table.values()) == list(range(256))

    def spelled(p):
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    def of(text):
        if not text:
            return None
        a, b = tk.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        bytes_a, bytes_b = [bytes(table[c] for c in tk.id_to_token(i)) for i in a], [spelled(sp.id_to_piece(i)) for i in b]
        return (a, b, bytes_a, bytes_b) if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode() else None
    return of


def plain_alignment(docs, both):
    """The rows of link_counts by the definition, without anchors or windows; docs: list of (doc_id, text)."""
    found, count = [], Counter()
    for i, t in docs:
        it = both(t)
        groups, links = [], []
        if it:
            a, b, bytes_a, bytes_b = it
            ends = []
            for tokens in (bytes_a, bytes_b):
                at, out = 0, {}
                for k, x in enumerate(tokens):
                    at += len(x)
                    out[at] = k + 1
                ends.append(out)
            x = y = 0
            for e in sorted(set(ends[0]) & set(ends[1])):
                k, m = ends[0][e], ends[1][e]
                groups.append(",".join(map(str, a[x:k])) + "|" + ",".join(map(str, b[y:m])))
                links.append((a[k - 1], b[m - 1]))
                x, y = k, m
        count.update(links)
        found.append((i, it, groups, links))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted([(i, len(it[0]) if it else 0, len(it[1]) if it else 0, len(groups), len(links), sum(count[p] == most[p[1]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if it else "")
                   for i, it, groups, links in found], key=str)


def test_align(spark, texts, both):
    got = queries.op13_align(spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == plain_alignment(list(texts.items()), both)


@pytest.mark.parametrize("frequent", [0, 7, 1 << 16])
def test_align_edges(spark, edges, both, frequent):
    got = align.link_counts(edges, queries.JSON, queries.RANKS, queries.PIECES, frequent=frequent).collect()
    want = plain_alignment(EDGES, both)
    assert sorted(map(tuple, got), key=str) == want
    assert {r[0]: r[1] for r in want}[7] == 0 and {r[0]: r[7] for r in want}[2] == ""      # U+2581 in the text reads as a space


def test_align_empty_table(edges):
    assert align.link_counts(edges.limit(0), queries.JSON, queries.RANKS, queries.PIECES).collect() == []


@given(st.text(alphabet=st.sampled_from("ab cé漢😀\n\t 1. A'"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_windows_put_together_are_the_whole(both, text):
    """Anchors and windows change nothing: groups and links are those of the whole text."""
    p = align.pair(queries.JSON, queries.RANKS, queries.PIECES)
    n_a, n_b, n, groups, links = next(p.align([text]))
    assert (0, n_a, n_b, n, len(links)) == plain_alignment([(0, text)], both)[0][:5]
    whole = both(text)
    if whole:
        one = np.array([*whole[0], *(i + p.first_b for i in whole[1])], np.int32).tobytes()
        assert p.windows([one]) == [(groups, links.tobytes())] and len(links) == n
