"""URL filters: block lists that change over time, joined as of each capture's fetch time.

A list is a log of dated entries (kind, value, at, action). Entries become validity
intervals [since, until): an entry holds until the next one for its (kind, value). A capture's
URL gives the keys it can be listed under (its URL, each path prefix step by step, as deep as the list
goes, its host and every parent domain); an equi-join on key and period with the interval as condition
finds what was active when it was fetched.

Scale: entries equal in key and time are reduced first; a key with very many entries is
followed period by period, each carrying its last state on, so no window holds all of
it. Intervals are listed under each period they touch, so a capture meets the intervals of one
period only; the join is a plain equi-join that Spark splits where a host is hot. Only captures
that match are reduced to their first rule and joined back to the whole.

Defined cases: at equal times "remove" wins over "add"; an entry or capture without a time
or value matches nothing; a URL without host has its URL as only key; repeated captures are answered
one by one; empty tables are fine (nothing is blocked).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 30
KINDS = ("url", "prefix", "domain")         # in order of precedence
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def depth(value: Column) -> Column:
    """Steps of a listed prefix."""
    return F.size(F.split(value, "/")) - 1


def prefixes(url: Column, deepest: Column) -> Column:
    """Host and the first steps of the path: of one step, two, and so on up to ``deepest``; none without host or path."""
    steps = F.split(F.regexp_extract(url, PATH, 1), "/")
    n = F.least(F.size(steps) - 1, deepest)
    found = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(host(url), F.lit("/"), F.array_join(F.slice(steps, 2, i), "/")))
    return F.when((n > 0) & (host(url) != ""), found).otherwise(F.array().cast("array<string>"))


def prefix(url: Column, steps: int = 1) -> Column:
    """Host and the first steps of the path; empty without as many."""
    return F.coalesce(F.get(prefixes(url, F.lit(steps)), steps - 1), F.lit(""))


def keys(url: Column, deepest: Column) -> Column:
    """The (kind, value) keys a URL can be listed under, prefixes of at most ``deepest`` steps."""
    labels = F.split(host(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pair = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    all_ = F.concat(F.array(pair("url", url)), F.transform(prefixes(url, deepest), lambda p: pair("prefix", p)),
                    F.transform(domains, lambda d: pair("domain", d)))
    return F.array_distinct(F.filter(all_, lambda k: k["value"] != ""))


def intervals(entries: DataFrame, period: int = PERIOD) -> DataFrame:
    """(kind, value, since, until) of the entries (kind, value, at, action); until is null while open.

    Adds that follow adds are joined to one interval, as are removes; the next entry is looked up inside
    a period, and across periods from one row for each.
    """
    last = (entries.where("kind is not null and value is not null and at is not null and action in ('add', 'remove')")
            .groupBy("kind", "value", "at").agg(F.max("action").alias("action"))          # 'remove' > 'add'
            .withColumn("period", F.floor(F.col("at") / F.lit(period))))
    key = ["kind", "value"]
    inside = Window.partitionBy(*key, "period").orderBy("at")
    over = Window.partitionBy(*key).orderBy("period")
    runs = last.withColumn("before", F.lag("action").over(inside))
    # a row stays if the state changes there; the first of a period is judged against the period before
    ends = (last.groupBy(*key, "period").agg(F.max_by("action", "at").alias("final"))
            .withColumn("carried", F.lag("final").over(over)).select(*key, "period", "carried"))
    changes = (runs.join(ends, [*key, "period"])
               .withColumn("before", F.coalesce("before", "carried"))
               .where(F.col("before").isNull() | (F.col("before") != F.col("action")))
               .select(*key, "period", "at", "action"))
    firsts = (changes.groupBy(*key, "period").agg(F.min("at").alias("first"))
              .withColumn("following", F.lead("first").over(over)).select(*key, "period", "following"))
    return (changes.join(firsts, [*key, "period"])
            .withColumn("until", F.coalesce(F.lead("at").over(inside), "following"))
            .where("action = 'add'").select(*key, F.col("at").alias("since"), "until"))


def judge(captures: DataFrame, entries: DataFrame, period: int = PERIOD) -> DataFrame:
    """``captures`` (page_id, url, fetched, ...) with blocked, kind, value and since of the rule that
    held at the time fetched (the most exact kind, then the longest value). Times are whole numbers.
    Columns of captures that have the name of an added one are replaced."""
    spans = intervals(entries, period)
    horizon = captures.agg(F.max("fetched")).scalar()                    # one value, as a subquery
    deepest = spans.where("kind = 'prefix'").agg(F.coalesce(F.max(depth(F.col("value"))), F.lit(0))).scalar()
    listed = (spans.withColumn("h", horizon)
              .where("h is not null and since <= h")
              .withColumn("last", F.floor(F.least(F.coalesce(F.col("until") - 1, F.col("h")), F.col("h")) / F.lit(period)))
              .withColumn("period", F.explode(F.sequence(F.floor(F.col("since") / F.lit(period)), F.col("last"))))
              .select(F.col("kind").alias("k"), F.col("value").alias("v"), F.col("period").alias("p"), "since", "until"))
    cols = ["page_id", "url", "fetched"]
    asked = (captures.select(*cols).where("url is not null and fetched is not null")
             .withColumn("deepest", deepest).withColumn("key", F.explode(keys(F.col("url"), F.col("deepest"))))
             .select(*cols, "key.kind", "key.value", F.floor(F.col("fetched") / F.lit(period)).alias("period")))
    met = asked.join(listed, (F.col("kind") == F.col("k")) & (F.col("value") == F.col("v")) & (F.col("period") == F.col("p"))
                     & (F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    first = F.min(F.struct(place.alias("place"), (-F.length("value")).alias("size"), "value", "kind", "since"))
    # captures are one struct here, so no column of theirs meets a helper's name
    rule = met.groupBy(*cols).agg(first.alias("r")).select(F.struct(*cols).alias("met"), "r")
    added = ["blocked", "rule_kind", "rule_value", "rule_since"]
    own = [F.col("row")[c].alias(c) for c in captures.columns if c not in added]
    rows = captures.select(F.struct(*captures.columns).alias("row"))
    same = (F.col("row.page_id").eqNullSafe(F.col("met.page_id")) & (F.col("row.url") == F.col("met.url"))
            & (F.col("row.fetched") == F.col("met.fetched")))
    return rows.join(rule, same, "left").select(
        *own, F.col("r").isNotNull().alias("blocked"), F.col("r.kind").alias("rule_kind"), F.col("r.value").alias("rule_value"),
        F.col("r.since").alias("rule_since"))


# --- dated captures and entries of the pages table --------------------------------------

def number(value: Column) -> Column:
    """A whole number of a text, the same in Spark and in SQL engines with md5."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 7), 16, 10).cast("long")


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day, 0 to 364, of their id."""
    return pages.select("page_id", "url", (number(F.col("page_id").cast("string")) % 365).alias("fetched"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """A list's log, of the pages: some hosts, prefixes and URLs are listed, taken off, and listed again."""
    urls = pages.select("url").where("url is not null")

    def log(kind: str, value: Column, every: int, first: int, days: int, again: int) -> DataFrame:
        some = urls.select(value.alias("value")).where("value <> ''").distinct().withColumn("n", number(F.col("value")))
        some = some.where(F.col("n") % every == 0).withColumn("day", F.floor(F.col("n") / 64) % first)
        steps = F.array(F.struct(F.col("day").alias("at"), F.lit("add").alias("action")),
                        F.struct((F.col("day") + days).alias("at"), F.lit("remove").alias("action")),
                        F.struct((F.col("day") + again).alias("at"), F.lit("add").alias("action")))
        return some.select(F.lit(kind).alias("kind"), "value", F.explode(steps).alias("s")).select("kind", "value", "s.at", "s.action")

    return (log("domain", host(F.col("url")), 3, 150, 60, 140).unionByName(log("prefix", prefix(F.col("url")), 8, 250, 45, 100))
            .unionByName(log("prefix", prefix(F.col("url"), 2), 5, 200, 70, 120)).unionByName(log("url", F.col("url"), 10, 300, 30, 50)))
