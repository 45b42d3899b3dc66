"""Previous row per key (before-images), safe for hot keys.

``previous_by_key`` attaches to every row the values of the preceding row of the
same key in ``order`` order. A plain ``lag`` over ``Window.partitionBy(key)`` would
put all rows of a key into one task; here rows are windowed inside
``(key, block)`` partitions only (``block = floor(order / block_width)``), and the
first row of each block takes the last row of the nearest earlier non-empty block
of the same key. That second window runs over one pre-aggregated row per
``(key, block)``, so no task ever holds more than ``block_width`` raw rows of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def previous_by_key(df: DataFrame, key: str, order: str, values: list[str],
                    block_width: int = 1 << 20, prefix: str = "prev_") -> DataFrame:
    blk = F.expr(f"floor(`{order}`) div {int(block_width)}")
    d = df.withColumn("_blk", blk)
    w = Window.partitionBy(key, "_blk").orderBy(order)
    inner = d.select(
        "*",
        F.lag(F.struct(*[F.col(v) for v in values] + [F.col(order).alias("_o")])).over(w).alias("_prev"))
    # last row of every (key, block): partial aggregation before the shuffle
    lasts = (d.groupBy(key, "_blk")
              .agg(F.max_by(F.struct(*[F.col(v) for v in values] + [F.col(order).alias("_o")]),
                            F.col(order)).alias("_last")))
    wb = Window.partitionBy(key).orderBy("_blk")
    carry = lasts.select(key, "_blk", F.lag("_last").over(wb).alias("_carry"))
    joined = inner.join(carry, [key, "_blk"], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[prev[v].alias(prefix + v) for v in values],
        prev["_o"].alias(prefix + order))
