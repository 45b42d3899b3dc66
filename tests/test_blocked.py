"""Hot-key-safe operators give the same answer as a plain global window,
including across block boundaries (tiny blocks force the carry path)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from changeflow.operators.images import previous_by_key
from changeflow.plans import feeds as fd

SF = "/root/testdata/sf0.001"


def _events(spark):
    return fd.table(spark, SF, "events", ["event_id", "user_id", "event_type", "value"])


def test_previous_by_key_matches_lag_across_blocks(spark):
    e = _events(spark)
    w = Window.partitionBy("user_id").orderBy("event_id")
    expected = e.select("event_id", F.lag("event_type").over(w).alias("p"),
                        F.lag("event_id").over(w).alias("pe"))
    for width in (7, 64, 1 << 20):
        got = previous_by_key(e, "user_id", "event_id", ["event_type"], block_width=width) \
            .select("event_id", F.col("prev_event_type").alias("p"), F.col("prev_event_id").alias("pe"))
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0

