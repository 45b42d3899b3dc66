"""Helpers shared by the operators: reading tables, cutting lineage, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import fresh_dir

#: A word is a run of anything but ASCII white space (Python: bytes.split()).
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts lineage so that later passes read narrow columns instead of repeating the text
    pass, and survives the loss of any executor (the files are in ``spark.checkpoint.dir``).
    """
    path = fresh_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def uniform(*cols: Column) -> Column:
    """A number in (0, 1) that depends on the values only, so reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 12)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
