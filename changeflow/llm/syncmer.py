"""Document fingerprints from closed syncmers (DataFrame functions only).

A text's UTF-8 bytes are cut into all windows of ``K``. A window is a closed syncmer if the
least of the hashes of its ``K - S + 1`` inner substrings of ``S`` bytes lies at its first or
last place. That depends on the window alone: an edit elsewhere neither adds nor removes
it, so kept syncmers are anchors that match by content and place between versions. On
average 2 of K - S + 1 windows are chosen.

The fingerprint is the whole list of syncmers in order, each with the byte it begins at and its hash.
The likeness of two texts is the Jaccard likeness of their whole sets of hashes. Matching by place
pairs the anchors that two texts share, wherever they lie in either; versions are also compared by
the anchors that have the same hash at the same place. As one string, the whole list is sealed by its
sha256 (:func:`seal`); the ``SIZE`` least distinct hashes are a short digest, and nothing is taken from it. Since syncmers are context-free, the syncmers of a
text that is put together from known parts follow from the parts: theirs, and those across the seam.

Scale: everything is per-row expressions; long texts are worked off in steps of ``STEP``
windows, so memory beside the text is that of its syncmers (12 bytes for about every 4 of text). Shared
anchors are found by binary search in the sorted common hashes and paired after a sort. The neighbour in id order is found in ranges of doc_id (an equal-width grid, dense cells
split further), each range with the first row of the next: one shuffle of the texts.

Defined cases: null text is empty; the empty text has the empty fingerprint, like only to
itself (1); a text shorter than K is one syncmer; equal texts have equal fingerprints; rows
that share a doc_id follow each other by text; rows without doc_id come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import let, partitions

K, S, SIZE, STEP = 16, 9, 128, 4096


def _hashes(b: Column, lo: Column, hi: Column, s: int) -> Column:
    """Hashes of the inner substrings that start at bytes lo to hi."""
    return F.transform(F.sequence(lo, hi), lambda i: F.xxhash64(F.substring(b, i + 1, F.lit(s))))


def _chosen(h: Column, lo: Column, k: int, s: int) -> Column:
    """Of consecutive inner hashes, those windows whose least is at an edge: their places, counted from lo, and
    hashes. The first and last inner substring cover the window, so their hashes stand for it."""
    w = k - s + 1

    def edge(i: Column) -> Column:
        def least(x: Column, last: Column) -> Column:
            first_least, last_least = x <= last, last <= x
            for j in range(1, w - 1):
                first_least = first_least & (x <= F.get(h, i + j))
                last_least = last_least & (last <= F.get(h, i + j))
            return first_least | last_least
        return least(F.get(h, i), F.get(h, i + (w - 1)))

    picked = F.filter(F.sequence(F.lit(0), F.size(h) - w), edge)
    return let(picked, lambda at: F.struct(
        F.transform(at, lambda i: lo + i).alias("places"),
        F.transform(at, lambda i: F.xxhash64(F.get(h, i), F.get(h, i + (w - 1)))).alias("hashes")))


def _none() -> Column:
    return F.struct(F.array().cast("array<int>").alias("places"), F.array().cast("array<bigint>").alias("hashes"))


def syncmers(binary: Column, k: int = K, s: int = S, step: int = STEP) -> Column:
    """All syncmers of a binary column in order, a struct of their places (bytes from 0) and hashes.

    Bytes shorter than ``k`` are one syncmer, none if empty.
    """
    def of(b: Column) -> Column:
        n = F.octet_length(b)
        # a step that ends inside a window has no full window beyond; steps overlap by k - s
        parts = F.transform(F.sequence(F.lit(0), n - k, F.lit(step)), lambda lo: let(
            _hashes(b, lo, F.least(lo + (step + k - s - 1), n - s), s), lambda h: _chosen(h, lo, k, s)))
        whole = let(parts, lambda p: F.struct(F.flatten(p["places"]).alias("places"), F.flatten(p["hashes"]).alias("hashes")))
        short = F.struct(F.array(F.lit(0)).alias("places"), F.array(F.xxhash64(b)).alias("hashes"))
        return F.when(n >= k, whole).when(n > 0, short).otherwise(_none())
    return let(binary, of)


def digest(hashes: Column, size: int = SIZE) -> Column:
    """The ``size`` least distinct hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def least_syncmers(binary: Column, k: int = K, s: int = S, size: int = SIZE, step: int = STEP) -> Column:
    """The digest of a binary column."""
    return digest(syncmers(binary, k, s, step)["hashes"], size)


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct hashes of both that both have; of two empty ones 1."""
    return let(F.size(F.array_union(a, b)), lambda u: F.when(u == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / u))


def same_places(a: Column, b: Column) -> Column:
    """How many syncmers (structs of places and hashes) have the same place and hash in both."""
    def keys(x: Column) -> Column:
        return let(x["places"], lambda p: F.transform(x["hashes"], lambda h, i: F.xxhash64(h, F.get(p, i))))
    return F.size(F.array_intersect(keys(a), keys(b)))


def _within(ordered: Column, steps: Column, x: Column) -> Column:
    """Is x in an ascending array? A binary search; steps: the powers of two up to its size, descending."""
    at = F.aggregate(steps, F.lit(0), lambda lo, step: F.when(F.get(ordered, lo + step - 1) <= x, lo + step).otherwise(lo))
    return F.coalesce(F.get(ordered, at - 1) == x, F.lit(False))


def matches(a: Column, b: Column) -> Column:
    """(place, other) for every syncmer of ``a`` whose hash ``b`` also has, by place: where it lies in both.

    Syncmers that occur several times are paired in order; those that b has fewer of, with b's last.
    """
    def side(x: Column, no: int, common: Column, steps: Column) -> Column:
        return let(x["hashes"], lambda h: let(x["places"], lambda p: F.transform(
            F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: _within(common, steps, F.get(h, i))),
            lambda i: F.struct(F.get(h, i).alias("hash"), F.lit(no).alias("side"), F.get(p, i).alias("place")))))

    def pairs(group: Column) -> Column:
        """Of one hash: a's places with b's."""
        places = lambda no: F.filter(group, lambda x: x["side"] == no)["place"]
        return let(places(1), lambda there: F.transform(places(0), lambda p, i: F.struct(
            p.alias("place"), F.get(there, F.least(i, F.size(there) - 1)).alias("other"))))

    def grouped(rows: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(rows) - 1),
                      lambda i: (i == 0) | (F.get(rows, i)["hash"] != F.get(rows, i - 1)["hash"]))
        return let(at, lambda first: F.sort_array(F.flatten(F.transform(first, lambda f, j: let(
            F.slice(rows, f + 1, F.coalesce(F.get(first, j + 1), F.size(rows)) - f), pairs)))))

    def of(common: Column) -> Column:
        n = F.floor(F.log2(F.size(common))).cast("int")
        steps = F.transform(F.sequence(n, F.lit(0), F.lit(-1)), lambda j: F.pow(F.lit(2), j).cast("int"))
        found = let(steps, lambda st: let(F.sort_array(F.concat(side(a, 0, common, st), side(b, 1, common, st))), grouped))
        return F.when(F.size(common) > 0, found).otherwise(F.array().cast("array<struct<place:int,other:int>>"))
    return let(F.sort_array(F.array_intersect(a["hashes"], b["hashes"])), of)


def seal(hashes: Column) -> Column:
    """The sha256 of the whole list of hashes, in order and in decimal, comma-joined."""
    return F.sha2(F.array_join(hashes.cast("array<string>"), ",").cast("binary"), 256)


def spell(hashes: Column) -> Column:
    return F.concat_ws("", F.transform(hashes, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")))


GRID = 4096


def ranges(docs: DataFrame, parts: int) -> DataFrame:
    """(cell, base, split, lo, width): ranges of doc_id that hold about equally many rows.

    An equal-width grid of ``GRID`` cells counts the ids; a cell with more than its share
    is split evenly. The table has ``GRID`` rows at most.
    """
    ids = docs.where("doc_id is not null")
    lo, hi, n = ids.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    if not n:
        lo, hi, n = 0, 0, 0
    width = (hi - lo) // GRID + 1
    share = max(1, n // max(1, parts))
    counts = (ids.groupBy(F.floor((F.col("doc_id") - F.lit(lo)) / F.lit(width)).cast("int").alias("cell"))
              .agg(F.count(F.lit(1)).alias("n")).collect())                   # GRID rows at most
    out, base = [], 1
    for cell, rows in sorted((r["cell"], r["n"]) for r in counts):
        split = min(width, -(-rows // share))
        out.append((cell, base, split, lo, width))
        base += split
    return docs.sparkSession.createDataFrame(out or [(0, 1, 1, 0, 1)], "cell int, base int, split long, lo long, width long")


def with_next(docs: DataFrame, parts: int, made) -> DataFrame:
    """(row, made(row), next) for (doc_id, text): next is the row that follows in descending order
    (after the last: the first), a struct (doc_id, text, made). ``made``: a column made of text."""
    grid = ranges(docs, parts)
    cell = F.floor((F.col("doc_id") - F.col("lo")) / F.col("width")).cast("int")
    first = grid.select("lo", "width").limit(1)
    lo, width = first.first()
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    at = F.col("doc_id") - F.lit(lo)
    placed = (docs.withColumn("c", F.coalesce(F.floor(at / F.lit(width)).cast("int"), F.lit(-1)))
              .join(F.broadcast(grid.select(F.col("cell").alias("c"), "base", "split")), "c", "left"))   # GRID rows at most
    within = F.floor(F.pmod(at, F.lit(width)) * F.col("split") / F.lit(width))
    placed = placed.withColumn("range", F.coalesce(F.col("base") + within, F.lit(0)).cast("int")).select("doc_id", "text", "range")
    # the first row of each range in order also ends the range above it; the first of all ends the lowest
    ids = placed.select("doc_id", "range")
    heads = ids.groupBy("range").agg(F.max("doc_id").alias("head"))
    order = Window.orderBy(F.col("range"))                                     # a row for each range
    heads = heads.withColumn("to", F.coalesce(F.lead("range").over(order), F.first("range").over(order)))
    heads = F.broadcast(heads.select(F.col("range").alias("r"), "head", "to"))   # GRID + parts rows at most
    tops = (placed.join(heads, (F.col("range") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("head")))
            .groupBy("range", "to", "doc_id").agg(F.max("text").alias("text"))
            .select("doc_id", "text", F.col("to").alias("range"), F.lit(True).alias("guest")))
    rows = placed.withColumn("guest", F.lit(False)).unionByName(tops.select("doc_id", "text", "range", "guest"))
    rows = rows.repartition("range").withColumn("made", made(F.col("text")))
    down = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    nxt = F.lead(F.struct("doc_id", "text", "made")).over(down)
    return rows.withColumn("next", nxt).where(~F.col("guest")).select("doc_id", "text", "made", "next")


def fingerprint_documents(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """(doc_id, text, edited, fp, places, edited_fp, edited_places, next_fp, next_places, n_chars) of (doc_id, text): hashes
    and places of all syncmers of each text, of its edited text (the last third replaced by the start of the next document)
    and of the next document.

    The edited text is put together from a kept part and a new part: its syncmers are those of
    the kept part and those of the new part, read from k - 1 bytes before the seam.
    """
    n = F.length("text")
    cut_at = (n - F.floor(n / 3)).cast("int")
    raw = lambda t: t.cast("binary")

    def joined(kept: Column, new: Column, known: Column) -> Column:
        """Syncmers of kept + new, with the kept part's known."""
        have = F.octet_length(kept)
        tail = F.concat(F.substring(kept, F.greatest(have - (k - 2), F.lit(1)), F.lit(k - 1)), new)
        seam = F.when(F.octet_length(tail) >= k, syncmers(tail, k, s)).otherwise(_none())
        # the offset is bound first: inside the lambda it would be evaluated anew for each syncmer
        both = lambda x: let(have - (k - 1), lambda off: F.struct(
            F.concat(known["places"], F.transform(x["places"], lambda p: p + off)).alias("places"),
            F.concat(known["hashes"], x["hashes"]).alias("hashes")))
        return (F.when(have + F.octet_length(new) < k, syncmers(F.concat(kept, new), k, s))
                .when(have < k, seam).otherwise(let(seam, both)))

    def made(text: Column) -> Column:
        """All syncmers, and how many of them are the kept part's, which come first."""
        at = (F.length(text) - F.floor(F.length(text) / 3)).cast("int")
        kept, rest = raw(F.substring(text, F.lit(1), at)), raw(F.substring(text, at + 1, F.length(text)))
        return let(syncmers(kept, k, s), lambda x: F.struct(joined(kept, rest, x).alias("fp"), F.size(x["places"]).alias("kept")))

    rows = with_next(docs.select(F.col("doc_id").cast("long"), "text"), 8 * partitions(docs), made)
    kept = F.substring("text", F.lit(1), cut_at)
    rows = rows.withColumn("kept", kept).withColumn("new", F.substring("next.text", F.lit(1), F.floor(n / 3).cast("int")))
    known = F.struct(*[F.slice(F.col(f"made.fp.{c}"), F.lit(1), F.col("made.kept")).alias(c) for c in ("places", "hashes")])
    rows = rows.withColumn("edited_all", let(known, lambda x: joined(raw(F.col("kept")), raw(F.col("new")), x)))
    return rows.select("doc_id", "text", F.concat("kept", "new").alias("edited"),
                       F.col("made.fp.hashes").alias("fp"), F.col("made.fp.places").alias("places"),
                       F.col("edited_all.hashes").alias("edited_fp"), F.col("edited_all.places").alias("edited_places"),
                       F.col("next.made.fp.hashes").alias("next_fp"), F.col("next.made.fp.places").alias("next_places"),
                       n.cast("long").alias("n_chars"))
