"""The driver's queries of the training-data operators: each applies its operator with production
parameters to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import align, chat, crf, lm, mix, pack, personal, resample, secrets, simhash, syncmer, topk, urls
from changeflow.llm.common import read

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix.mix_sizes(docs).select("doc_id", "size", "source_size", "target", "source", "copies",
                                      (F.col("copies") * F.col("size")).alias("taken"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(read(spark, sf_dir, "documents").select("doc_id", "text"), JSON, RANKS)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(rows, rows.where("vec_id % 100 = 0"), k=10)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.identify(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain transcripts are derived from the conversations, the model learned from those whose
    id's crc32 modulo 5 is not 0; every line of every conversation is parsed."""
    lines = chat.transcript_lines(read(spark, sf_dir, "conversations"))
    known = lines.where(~crf.held_out(F.col("conv_id")))
    done = chat.render(chat.decode(lines.select("conv_id", "pos", "line"), chat.learn(known)))
    return done.withColumnRenamed("role", "role_pred").withColumn("held_out", crf.held_out(F.col("conv_id")))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syncmer.fingerprint_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda places, hashes: F.struct(F.col(places).alias("places"), F.col(hashes).alias("hashes"))
    text, edited, nxt = of("places", "fp"), of("edited_places", "edited_fp"), of("next_places", "next_fp")
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       syncmer.seal(F.col("fp")).alias("fingerprint"),
                       syncmer.seal(F.col("edited_fp")).alias("edited_fingerprint"),
                       syncmer.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       syncmer.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
                       "places", F.col("fp").alias("hashes"), syncmer.same_places(text, edited).alias("same_places_edited"),
                       syncmer.matches(text, nxt).alias("matches_next"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(urls.dated_captures(pages), urls.dated_entries(pages))


def op10_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score_documents(docs).withColumn("score", F.round("score", 6))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def op12_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.scan_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.link_counts(read(spark, sf_dir, "documents").select("doc_id", "text"), JSON, RANKS, PIECES)


QUERIES = {f.__name__: f for f in (op1_mix, op2_pack, op3_topk, op4_language, op5_secrets, op6_chat, op7_fingerprints,
                                   op8_simhash, op9_urls, op10_backoff, op11_resample, op12_personal, op13_align)}

ORACLES = {
    "op3_topk": """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
           FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op9_urls": r"""
WITH p AS (SELECT page_id, url, CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 7) AS BIGINT) % 365 AS fetched,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#]*(/[^/?#]*)', 1) AS step,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#]*(/[^/?#]*/[^/?#]*)', 1) AS two FROM pages),
k AS (SELECT *, CASE WHEN step <> '' AND host <> '' THEN host || step ELSE '' END AS prefix,
             CASE WHEN two <> '' AND host <> '' THEN host || two ELSE '' END AS prefix2 FROM p),
vals AS (SELECT DISTINCT 'domain' AS kind, host AS value, 3 AS every, 150 AS span, 60 AS days, 140 AS again FROM k
    UNION SELECT 'prefix', prefix, 8, 250, 45, 100 FROM k UNION SELECT 'prefix', prefix2, 5, 200, 70, 120 FROM k UNION SELECT 'url', url, 10, 300, 30, 50 FROM k),
n AS (SELECT *, CAST('0x' || substr(md5(value), 1, 7) AS BIGINT) AS n FROM vals WHERE value <> ''),
d AS (SELECT kind, value, (n // 64) % span AS day, days, again FROM n WHERE n % every = 0),
i AS (SELECT kind, value, day AS since, day + days AS until FROM d UNION ALL SELECT kind, value, day + again, NULL FROM d),
m AS (SELECT k.page_id, k.url, k.fetched, i.kind, i.value, i.since,
        row_number() OVER (PARTITION BY k.page_id, k.url, k.fetched ORDER BY CASE i.kind WHEN 'url' THEN 1 WHEN 'prefix' THEN 2 ELSE 3 END,
                           length(i.value) DESC, i.value, i.since) AS r
      FROM k JOIN i ON fetched >= since AND (until IS NULL OR fetched < until)
       AND ((i.kind = 'url' AND i.value = url) OR (i.kind = 'prefix' AND i.value IN (prefix, prefix2))
            OR (i.kind = 'domain' AND (i.value = host OR ends_with(host, '.' || i.value)))))
SELECT p.page_id, p.url, p.fetched, m.kind IS NOT NULL AS blocked, m.kind AS rule_kind, m.value AS rule_value, m.since AS rule_since
FROM p LEFT JOIN m ON m.r = 1 AND p.page_id IS NOT DISTINCT FROM m.page_id AND p.url = m.url AND p.fetched = m.fetched""",
    "op10_backoff": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, ws FROM w),
g AS (SELECT doc_id, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS v FROM t),
u AS (SELECT w, count(*) AS n FROM g GROUP BY w), b AS (SELECT v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY v, w),
z AS (SELECT sum(n) AS n FROM u),
s AS (SELECT g.doc_id, CASE WHEN g.v IS NULL THEN ln(uw.n) - ln(z.n) WHEN b.n >= 2 THEN ln(b.n) - ln(uv.n)
             ELSE ln(0.4) + ln(uw.n) - ln(z.n) END AS x
      FROM g CROSS JOIN z JOIN u uw ON uw.w = g.w LEFT JOIN u uv ON uv.w = g.v LEFT JOIN b ON b.v = g.v AND b.w = g.w),
a AS (SELECT doc_id, count(*) AS n_words, avg(x) AS score FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.n_words, 0) AS n_words, round(a.score, 6) AS score FROM documents d LEFT JOIN a USING (doc_id)""",
}
