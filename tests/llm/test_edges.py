"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra columns, for every operator
and every stage of the pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from changeflow.llm import chat, crf, lm, mix, pack, queries, secrets, simhash, syncmer, topk, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, size long, spans string, w long, block int"
LONG = "the quick brown fox jumps over the lazy dog and " * 4000


def rows():
    base = [(1, "the cat sat on the mat and the dog", "en"), (2, None, "en"), (3, "", "de"), (4, "   \n\t ", None),
            (5, "der hund und die katze sind nicht da", "de"), (5, "der hund und die katze sind nicht da", "de"),
            (6, LONG, "en"), (7, "the cat sat on the mat and the dog", None), (None, "the dog and the cat", "en"),
            (None, None, None), (8, "1234 5678 !!!", "en"), (9, "é" * 50, "fr"), (10, "x", "en"), (11, "a😀b😀c <|endoftext|> \U0001F600", "en")]
    return [(i, t, lang, s, 3, 1, 1, "x", 2, 4) for n, (i, t, lang) in enumerate(base) for s in [[None, "b", "a"][n % 3]]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


OPS = {
    "mix": lambda d: mix.mix_sizes(d), "mixed": lambda d: mix.mix_documents(d), "pack": lambda d: pack.pack(d, queries.JSON, queries.RANKS),
    "language": lambda d: crf.identify(d), "secrets": lambda d: secrets.scan_documents(d), "syncmer": lambda d: syncmer.fingerprint_documents(d),
    "simhash": lambda d: simhash.simhash_groups(d), "backoff": lambda d: lm.score_documents(d),
}


@pytest.mark.parametrize("name", OPS)
def test_empty_table(none, name):
    assert OPS[name](none).count() == 0


@pytest.mark.parametrize("name", ["mix", "language", "secrets", "syncmer", "simhash", "backoff"])
def test_a_row_for_each_row(docs, name):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in OPS[name](docs).collect())
    assert got == sorted((r[0] is None, r[0] or 0) for r in rows())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, none, name, stage):
    if name != corpus_pipeline.STAGES[-1][0]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, none, "").columns == docs.columns
    assert stage(spark, none, "").count() == 0
    assert stage(spark, docs, "").count() > 0


def test_defined_values(docs):
    lang = {r["doc_id"]: r for r in crf.identify(docs).collect() if r["doc_id"]}
    assert all(lang[i]["lang_pred"] == "und" and lang[i]["score"] == 0 for i in (2, 3, 4, 8))
    assert all(0 <= r["score"] <= 1 for r in lang.values())
    sizes = {r["doc_id"]: r["size"] for r in mix.mix_sizes(docs).collect()}
    assert sizes[2] == sizes[3] == sizes[4] == 0 and sizes[6] == 40000
    sim = {r["doc_id"]: r for r in simhash.simhash_groups(docs).collect() if r["doc_id"]}
    assert sim[2]["fp"] == sim[4]["fp"] == 0 and sim[3]["component_id"] == 2 and sim[7]["component_id"] == 1
    score = {r["doc_id"]: r for r in lm.score_documents(docs).collect()}
    assert score[2]["score"] is None and score[6]["n_words"] == 40000 and score[1]["score"] == score[7]["score"]
    prints = {r["doc_id"]: r for r in syncmer.fingerprint_documents(docs).collect()}
    assert prints[2]["fp"] == [] and len(prints[10]["fp"]) == 1 and prints[1]["fp"] == prints[7]["fp"]


def test_no_language_to_learn_from(docs):
    got = crf.identify(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [r[0] for r in got] == ["und"]


def test_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    have = [(0, [1.0, 0.0], 1), (100, [1.0, float("nan")], 1), (200, None, 1), (300, [None, 1.0], 1), (None, [1.0, 1.0], 1),
            (1, [0.5, 0.5], 1), (2, [0.5, 0.25], 1), (3, [0.5, 0.0], 1), (4, [0.0, 0.0, 1.0], 1), (400, [0.0, 0.0], 1), (500, [], 1)]
    rows = spark.createDataFrame(have, schema)
    got = [tuple(r) for r in topk.top_k(rows, rows.where("vec_id % 100 = 0"), 2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 512 * 1024), (0, 2, 2, 512 * 1024), (400, 1, 0, 0), (400, 2, 1, 0)]
    empty = spark.createDataFrame([], schema)
    assert topk.top_k(empty, empty).count() == 0


def test_repeated_vectors_count_each(spark):
    have = [(7, [1.0, 1.0])] * 400 + [(100, [1.0, 1.0]), (8, [0.5, 0.5])]
    rows = spark.createDataFrame(have, "vec_id long, embedding array<float>")
    old, topk.BLOCK = topk.BLOCK, 16
    try:
        got = [r["vec_id"] for r in topk.top_k(rows, rows.where("vec_id = 100"), 10).collect()]
    finally:
        topk.BLOCK = old
    assert got == [7] * 10


def test_a_sample_has_a_window_for_each_id(spark):
    have = [(1, "the dog and the cat", "en")] * 300 + [(None, "der hund", "de")] * 300 + [(i, "der hund und die katze", "de") for i in range(2, 40)]
    docs = spark.createDataFrame(have, "doc_id long, text string, lang string")
    assert len(crf.training_sample(docs, F.lit(True), sample=2000)) == 39


def test_mix_of_repeated_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(None, "a b c", "s")] * 25 + [(1, "d e", "s")] * 7 + [(2, "f", None)], "doc_id long, text string, source string")
    take = lambda: sorted(map(str, mix.mix_sizes(docs).collect()))
    whole = take()
    assert len(whole) == 33
    monkeypatch.setattr(mix, "STEP", 4)
    assert take() == whole


def test_names_that_clash(spark, docs):
    """Columns that have the name of a helper or of an added column."""
    odd = docs
    for name in ("_kept", "_key", "_row", "_no", "_times", "_copies", "component_id", "copies", "target", "lang_pred", "score", "kept", "root"):
        odd = odd.withColumn(name, F.lit("own"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, odd, "")
        assert got.columns == odd.columns and {r["_kept"] for r in got.collect()} == {"own"}, name
    pages = spark.createDataFrame([(1, "http://b.com/", 20)], "page_id long, url string, fetched long")
    log = spark.createDataFrame([("domain", "b.com", 10, "add")], "kind string, value string, at long, action string")
    for name in ("_id", "_url", "_kind", "blocked", "rule_kind", "kind", "value", "period", "key", "r", "row", "met"):
        pages = pages.withColumn(name, F.lit("own"))
    got = urls.judge(pages, log)
    assert len(got.columns) == len(set(got.columns)) and got.first()["blocked"] is True and got.first()["_kind"] == got.first()["r"] == "own"


def test_captures(spark):
    pages = spark.createDataFrame([(1, "http://a.b.com/x/y", "h"), (1, "http://a.b.com/x/y", "h"), (2, None, "h"), (None, "http://a.b.com", "h"),
                                   (3, "no url", "h"), (4, "", "h")], "page_id long, url string, value string")
    log = spark.createDataFrame([("domain", "b.com", 10, "add"), ("domain", "b.com", 10, "add"), ("domain", "b.com", 200, "remove"),
                                 ("domain", "b.com", 200, "add"), ("domain", "b.com", 300, "add"), (None, "b.com", 1, "add"),
                                 ("url", "no url", 0, "add"), ("prefix", "a.b.com/x", 20, "add")], "kind string, value string, at long, action string")
    at = lambda day: pages.withColumn("fetched", F.lit(day).cast("long"))
    seen = lambda day: {(r["page_id"], r["url"]): (r["rule_kind"], r["rule_since"]) for r in urls.judge(at(day), log).collect()}
    assert urls.judge(at(50), log).count() == 6
    assert seen(9)[1, "http://a.b.com/x/y"] == (None, None)
    assert seen(15)[1, "http://a.b.com/x/y"] == ("domain", 10) and seen(25)[1, "http://a.b.com/x/y"] == ("prefix", 20)
    assert seen(199)[None, "http://a.b.com"] == ("domain", 10) and seen(200)[None, "http://a.b.com"] == (None, None)
    assert seen(300)[None, "http://a.b.com"] == ("domain", 300) and seen(0)[3, "no url"] == ("url", 0) and seen(5)[2, None] == (None, None)
    assert urls.judge(at(50).where("1 = 0"), log).count() == 0 and urls.judge(at(50), log.where("1 = 0")).where("blocked").count() == 0


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, pos long, state int"
    have = [(1, 0, "user", "hello there?\nmore", 0, 0), (1, 1, "assistant", "fine.", 0, 0), (1, 1, "assistant", "fine.", 0, 0), (2, None, "user", None, 0, 0),
            (None, 0, None, "", 0, 0), (None, 1, "user", "x\n" * 200, 0, 0)]
    lines = chat.transcript_lines(spark.createDataFrame(have, schema))
    done = chat.render(chat.decode(lines.select("conv_id", "pos", "line"), chat.learn(lines)))
    assert done.count() == 2 + 1 + 1 + 1 + 1 + 201
    assert set(r["role"] for r in done.collect()) <= set(chat.ROLES)
    empty = chat.transcript_lines(spark.createDataFrame([], schema))
    assert chat.render(chat.decode(empty.select("conv_id", "pos", "line"), chat.learn(empty))).count() == 0


@pytest.mark.parametrize("top", [5.0, 6e4, 3e9, 1e15, 3e38, 1e308])
def test_scores_of_large_components_are_exact(spark, top):
    """Every finite component counts in full, whatever its size; a score beyond a long ranks by its value."""
    import math
    import random
    from fractions import Fraction
    rng = random.Random(int(top))
    rows = [(i, [rng.choice([rng.uniform(-1, 1), top * (2 * rng.random() - 1)]) for _ in range(6)]) for i in range(60)] + [(60, [0.0] * 6), (60, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 20 = 0"), 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = [(i, [math.floor(Fraction(c) * 1024) for c in v]) for i, v in rows]
    for q, v in whole:
        if q % 20 == 0 and (q, v) != whole[-1]:
            every = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q)
            want = [(n + 1, i, max(-2 ** 63, min(2 ** 63 - 1, -s))) for n, (s, i) in enumerate(every[:5])]
            assert [r[0] for r in sorted(got[q])] == [1, 2, 3, 4, 5] and [r[1:] for r in sorted(got[q])] == [w[1:] for w in want]


def test_prefixes_of_any_depth(spark):
    """A listed prefix of several steps holds for what lies below it, step by step."""
    pages = spark.createDataFrame([(1, "http://h.org/a/b/c?x=/q", 5), (2, "http://h.org/a/bc", 5), (3, "http://h.org/a/b/", 5), (4, "http://h.org", 5),
                                   (5, "http://u@H.org:80/a/b/c/d", 5), (6, "/a/b", 5), (7, "http://h.org/" + "a/" * 20_000, 5)], "page_id long, url string, fetched long")
    log = spark.createDataFrame([("prefix", "h.org/a/b", 1, "add"), ("prefix", "h.org/a/b/c", 2, "add"), ("prefix", "h.org/a/b/c/d/e", 1, "add"),
                                 ("prefix", "h.org/a/a/a", 1, "add")], "kind string, value string, at long, action string")
    got = {r["page_id"]: r["rule_value"] for r in urls.judge(pages, log).collect()}
    assert got == {1: "h.org/a/b/c", 2: None, 3: "h.org/a/b", 4: None, 5: "h.org/a/b/c", 6: None, 7: "h.org/a/a/a"}
