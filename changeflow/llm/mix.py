"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Each source gets a target in words: weights share out a multiple of all words, no source
above ``cap`` times its size, the excess reshared by weight (water filling). A document
of a source with target T and size S is expected T/S times. The whole part of that is
certain; for the rest, documents are ranked by Pareto's key, random odds divided by
inclusion odds, and taken in that order until the source's remaining words are used.

Scale: the text is read once into (doc_id, source, size). The prefix of the ranking is
found without sorting a source: the key cuts each source into blocks of about
``BLOCK`` documents, block sums locate the one block in which the target falls (two-level
running sums), earlier blocks are taken whole, and only that block is walked in order,
taking what still fits. The words left go on to the blocks after it, of which only documents
that fit count, and so on until none fits: all of a source is walked, a block a round. A source
with a third of all rows has more blocks, not larger ones.

Defined cases: null text has size 0; a null source is a source of its own, last in order;
repeated rows are separate documents; an empty table gives an empty result; a source
whose documents hold no words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import WORD, cut, uniform

BLOCK = 1024
SUPER = 1024
STEP = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, n, target) from (source, size): one row per source.

    The windows below run over one row per source, the units that carry weights. With
    sources in order of ``cap * size / weight``, the level at which the i-th and all
    later sources would share what the earlier, full ones leave is highest at the right
    cut, so the water level is the maximum of those levels.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ranked = per.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("i") % len(weights) + 1)
    per = ranked.select("source", "source_size", "n", weight.alias("w"),
                        (F.lit(cap) * F.col("source_size")).alias("most"))
    all_ = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = ((F.lit(float(share)) * F.sum("source_size").over(all_) - before) / left)
    return (per.withColumn("level", level)
            .withColumn("water", F.max("level").over(all_))
            .select("source", "source_size", "n",
                    F.least(F.col("most"), F.col("w") * F.col("water")).alias("target")))


def pareto_mix(sizes: DataFrame, per_source: DataFrame, seed: int = 42) -> DataFrame:
    """Copies of each document. ``sizes``: (doc_id, source, size); ``per_source`` as from
    :func:`targets`. Returns (doc_id, source, size, source_size, target, copies), a row
    for each row of ``sizes``."""
    r = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    per = (per_source.withColumn("whole", F.floor(r).cast("long"))
           .withColumn("p", r - F.col("whole"))
           .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
           .withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("long")))
    # equal rows are told apart by a number, so that each has a draw of its own
    # (numbered in steps, so that no array grows with how often a row repeats)
    rows = (sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m"))
            .select("doc_id", "source", "size", "m", F.explode(F.sequence(F.lit(1), F.col("m"), F.lit(STEP))).alias("lo"))
            .select("doc_id", "source", "size",
                    F.explode(F.sequence(F.col("lo"), F.least(F.col("m"), F.col("lo") + (STEP - 1)))).alias("no")))
    u = uniform(F.lit(seed), F.col("doc_id"), F.coalesce(F.col("source"), F.lit("")), F.col("size"), F.col("no"))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))  # Pareto's ranking key
    drawn = (rows.withColumn("u", u)
             .join(per.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
             .withColumn("q", F.when(F.col("p") > 0, odds))
             # with one p in a source, this share of the key is again uniform: even blocks
             .withColumn("even", F.col("q") * F.col("p") / (1 - F.col("p") + F.col("q") * F.col("p")))
             .withColumn("block", F.least(F.floor(F.col("even") * F.col("blocks")), F.col("blocks") - 1)))
    drawn = cut(drawn.select("doc_id", "source", "size", "source_size", "target", "whole", "rest", "q", "block"), "mix")

    # a round: of the blocks after ``after``, documents of ``most`` words or fewer are left to take
    ranked = drawn.where("q is not null")
    state = cut(per.select(F.col("source").alias("s"), F.lit(-1).cast("long").alias("after"),
                           F.col("rest").cast("double").alias("most"), F.lit(0).cast("long").alias("least")), "mix-round")
    rounds, walks = [], []
    while True:
        walked = cut(_walk(ranked, state), "mix-walk")
        walks.append(walked)
        ended = walked.groupBy("source").agg(F.first("edge").alias("edge"), F.first("left").alias("left"))
        ended = cut(state.join(ended, F.col("s").eqNullSafe(F.col("source")), "left").drop("source"), "mix-round")
        rounds.append(ended)
        # empty documents need no words: those after the first edge are not gone on for
        state = ended.where("edge is not null").select("s", F.col("edge").alias("after"), F.col("left").alias("most"),
                                                       F.lit(1).cast("long").alias("least"))
        if _open(ranked, state).isEmpty():
            rounds.append(state.withColumn("edge", F.lit(None).cast("long")).withColumn("left", F.col("most")))
            break
    spans = rounds[0]
    for x in rounds[1:]:
        spans = spans.unionByName(x)
    spans = cut(spans, "mix-rounds")
    out = ["doc_id", "source", "size", "source_size", "target"]
    # outside the walked blocks, what fits is taken: without an edge block, to the end of the ranking
    placed = ranked.join(spans, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") > F.col("after"))
                         & (F.col("edge").isNull() | (F.col("block") < F.col("edge"))))
    done = (drawn.where("q is null").select(*out, F.col("whole").alias("copies"))
            .unionByName(placed.select(*out, (F.col("whole") + F.col("size").between(F.col("least"), F.col("most")).cast("long")).alias("copies"))))
    for x in walks:
        done = done.unionByName(x.select(*out, "copies"))
    return done


def _open(ranked: DataFrame, state: DataFrame) -> DataFrame:
    """The ranked documents that a round may still take."""
    return ranked.join(state, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") > F.col("after"))
                       & F.col("size").between(F.col("least"), F.col("most"))).drop("s")


def _walk(ranked: DataFrame, state: DataFrame) -> DataFrame:
    """The documents of each source's edge block, with copies, and the words left after it."""
    sums = (_open(ranked, state).groupBy("source", "block")
            .agg(F.sum("size").alias("words"), F.first("most").alias("rest"))
            .withColumn("super", F.floor(F.col("block") / SUPER)))
    above = (sums.groupBy("source", "super").agg(F.sum("words").alias("all"))
             .withColumn("base", F.coalesce(F.sum("all").over(
                 Window.partitionBy("source").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .select(F.col("source").alias("s"), F.col("super").alias("sup"), "base"))
    inner = Window.partitionBy("source", "super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    edge = (sums.withColumn("before", F.coalesce(F.sum("words").over(inner), F.lit(0)))
            .join(above, F.col("source").eqNullSafe(F.col("s")) & (F.col("super") == F.col("sup"))).drop("s")
            .withColumn("before", F.col("before") + F.col("base"))
            .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
            .join(state, F.col("source").eqNullSafe(F.col("s")))
            .select("s", F.col("block").alias("edge"), "least", (F.col("rest") - F.col("before")).alias("left")))
    # in order of the key: a document is taken if it still fits
    item = F.struct("q", "doc_id", "size")
    fits = lambda acc, x: (x["size"] <= acc["left"]) & (x["size"] >= acc["least"])
    walk = F.aggregate(
        F.array_sort(F.collect_list(item)),
        F.struct(F.first("left").cast("double").alias("left"), F.first("least").alias("least"), F.array().cast("array<int>").alias("took")),
        lambda acc, x: F.struct(
            F.when(fits(acc, x), acc["left"] - x["size"]).otherwise(acc["left"]).alias("left"), acc["least"].alias("least"),
            F.concat(acc["took"], F.array(F.when(fits(acc, x), 1).otherwise(0))).alias("took")))
    blocks = ranked.join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("edge")))
    return (blocks.groupBy("source", "source_size", "target", "whole", "edge")
            .agg(F.array_sort(F.collect_list(item)).alias("items"), walk.alias("walk"))
            .select("source", "source_size", "target", "whole", "edge", F.col("walk.left").alias("left"),
                    F.explode(F.arrays_zip("items", F.col("walk.took").alias("took"))).alias("x"))
            .select(F.col("x.items.doc_id").alias("doc_id"), "source", F.col("x.items.size").alias("size"),
                    "source_size", "target", (F.col("whole") + F.col("x.took")).alias("copies"), "edge", "left"))


def mix_sizes(docs: DataFrame, seed: int = 42, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The mix of ``docs`` (doc_id, source, text): a row for each document, with copies."""
    sizes = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    return pareto_mix(sizes, targets(sizes, weights, share, cap), seed)


def mix_documents(docs: DataFrame, seed: int = 42, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it, with the columns of
    ``docs``. Among rows equal in doc_id, source and size, copies are dealt out in
    order of their text."""
    key = F.struct("doc_id", "source", "size").alias("_key")
    chosen = (mix_sizes(docs, seed, weights, share, cap).select(key, "copies")
              .groupBy("_key").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
              .where("_copies > 0"))
    at = Window.partitionBy("_key").orderBy("_row.text")
    keyed = docs.select(F.struct("doc_id", "source", word_count(F.col("text")).alias("size")).alias("_key"),
                        F.struct(*docs.columns).alias("_row"))
    no = F.row_number().over(at)
    times = F.floor(F.col("_copies") / F.col("_rows")) + F.when(F.col("_no") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    return (keyed.join(chosen, "_key").withColumn("_no", no).withColumn("_times", times.cast("int"))
            .where("_times > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy"))
            .select("_row.*"))
