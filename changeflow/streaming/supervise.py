"""Supervised streams (T-11, Q17): restarts with capped back-off, and poison records set aside.

A stream that fails is started again from its checkpoint after a pause that doubles up to a cap; each new
version begins the count of failures anew. A batch that goes on failing is searched for records that make its
work fail: the batch is halved by a hash of its records, halves that work are done with, halves
that fail are halved again, down to single records (equal copies together). Those are committed as
rejects with the error, and all others of the batch are applied, in the batch's one commit.

Work that fails without its records failing (a lost file system, a conflict), or with more than ``MOST`` poison records,
is not the records' fault: the error is raised, nothing is set aside.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 100                                       # poison records of a batch beyond which the batch fails as a whole
AT_ONCE = 8                                      # parts tried side by side
FATAL = ("FeedGap", "DamagedRecord")             # errors that another start cannot mend


class TooManyPoisoned(RuntimeError):
    pass


def pause(failures: int, first: float = 0.5, cap: float = 30.0) -> float:
    """Seconds to wait after so many failures in a row."""
    return min(cap, first * 2 ** min(failures - 1, 30))


def supervise(store, start, attempts: int = 6, isolate_after: int = 2, first: float = 0.5, cap: float = 30.0, sleep=time.sleep):
    """Call ``start(isolate)`` (which runs a stream from its checkpoint) until it ends by itself and return what it returns.
    After ``isolate_after`` failures without a new version, batches set poison records aside; after ``attempts``
    such failures, or one of ``FATAL``, the error is raised."""
    failures = 0
    while True:
        version = store.latest_version()
        try:
            return start(failures >= isolate_after)
        except Exception as e:  # noqa: BLE001 - any failure of the stream
            failures = 1 if store.latest_version() != version else failures + 1
            if failures >= attempts or any(name in str(e) or type(e).__name__ == name for name in FATAL):
                raise
            sleep(pause(failures, first, cap))


def mark(batch: DataFrame) -> Column:
    """What a record is found by: a hash of its text, the same for equal copies."""
    return F.xxhash64(F.coalesce("_raw", F.lit("")))


def cause(error: Exception) -> str:
    """The line of an error that says what happened."""
    lines = [x.strip() for x in str(error).splitlines() if x.strip()]
    said = [x for x in lines if "Error" in x or "Exception" in x or x.startswith("[")] or lines or [type(error).__name__]
    return said[0][:200]


def poisoned(batch: DataFrame, work, most: int = MOST) -> dict[int, str]:
    """mark -> cause of the records of ``batch`` that make ``work(records)`` fail, each by itself. About two runs of
    ``work`` on ever smaller parts for each halving and poison record; the driver holds marks of poison records only."""
    found: dict[int, str] = {}
    marked = batch.withColumn("_mark", mark(batch))

    def halved(bounds: tuple[int, int]) -> list[tuple[int, int]]:
        """Nothing, if the part's work is done; else its halves, or its one record among ``found``."""
        part = marked.where(F.col("_mark").between(*bounds))
        try:
            work(part.drop("_mark"))
            return []
        except Exception as e:  # noqa: BLE001 - what the work raises is what is looked for
            error = e
        least, greatest = part.agg(F.min("_mark"), F.max("_mark")).first()
        if least is None:                                           # fails without records
            raise error
        if least < greatest:
            middle = (least + greatest) // 2
            return [(least, middle), (middle + 1, greatest)]
        found[least] = cause(error)
        if len(found) > most:
            raise TooManyPoisoned(f"more than {most} records make the batch fail, one by: {found[least]}") from error
        return []

    parts = [(-(1 << 63), (1 << 63) - 1)]
    with ThreadPoolExecutor(AT_ONCE) as pool:                       # small parts: their jobs run side by side
        while parts:
            parts = [x for halves in pool.map(halved, parts) for x in halves]
    return found


def without(batch: DataFrame, found: dict[int, str]) -> DataFrame:
    return batch.where(~mark(batch).isin(list(found)))


def poison_rejects(batch: DataFrame, found: dict[int, str]) -> DataFrame:
    """The poison records as rejects, with the cause."""
    said = F.create_map(*[x for m, text in found.items() for x in (F.lit(m), F.lit(text))])
    return batch.where(mark(batch).isin(list(found))).select(
        F.coalesce(F.col("table"), F.lit("")).alias("table"), "lsn", "seq", "action",
        F.concat(F.lit("poison: "), F.element_at(said, mark(batch))).alias("reason"), F.col("_raw").alias("record"))
