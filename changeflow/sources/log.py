"""Change log: landed segments with a manifest of positions (S1, P1, P2, T-2, T-3, T-4, T-7).

Layout under ``root``::

    segments/<landing>/table=<t>/kind=<dml|other>/part-*.parquet   (lsn, value): the records as text
    manifest/<landing>-<n>/part-*.json                             one line for each file, written last

A landing holds all records of the positions in ``(after, upto]``: ``after`` is where the landing before it
ended. So the manifest is an interval index: a landing that begins where none ended shows a gap, whatever
the positions between look like. Records of a table, and those that change no rows, lie in files of their
own; a reader opens the files it needs and no others.

The stream of the log is the stream of its manifest: each micro-batch takes up a bounded number of
landings, and a landing a bounded number of records (:meth:`append`). What the store has applied without a gap
(``covered``) is committed with the rows, so a stream with a lost checkpoint passes over what is
applied without opening it, and one that meets a gap stops before anything beyond it is applied.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.functions import lsn_to_int
from changeflow.sources.feed import DML_ACTIONS, fence, parse_feed

MANIFEST_DDL = "landing string, after bigint, upto bigint, file string, `table` string, kind string, lo bigint, hi bigint, records bigint"
SEGMENT_DDL = "lsn bigint, value string"


class FeedGap(RuntimeError):
    """The log lacks the changes after ``after`` up to ``upto``: the tables need a new snapshot."""

    def __init__(self, after: int, upto: int):
        super().__init__(f"the log lacks the changes after position {after} up to {upto}; take a new snapshot")
        self.after, self.upto = after, upto


class ChangeLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ landing
    def append(self, lines: DataFrame, upto: int | None = None, after: int | None = None, records: int = 1_000_000) -> int:
        """Land text records (``value``) as the continuation of the log; returns the position it now reaches.

        ``after`` is the log's end by default (0 for an empty log), ``upto`` the greatest position among the records.
        More than about ``records`` records become several landings by position, published in order. Records
        without a readable position belong to the first.
        """
        head = F.from_json("value", "lsn string, change struct<action: string, `table`: string>")
        rows = fence(lines.select(F.col("value"), head.alias("h")).select(
            "value", lsn_to_int(F.col("h.lsn")).alias("lsn"), F.col("h.change.table").alias("table"),
            F.when(F.col("h.lsn").isNull() | F.col("h.change.action").isNull() | F.col("h.change.action").isin(*DML_ACTIONS), "dml")
            .otherwise("other").alias("kind")))
        after = self.end(0) if after is None else after
        rows = rows.persist()                                                # read up to three times, taken apart once
        try:
            return self._land(rows, upto, after, records)
        finally:
            rows.unpersist()

    def _land(self, rows: DataFrame, upto: int | None, after: int, records: int) -> int:
        n, last = rows.agg(F.count(F.lit(1)), F.max("lsn")).first()
        upto = max(after, last if last is not None else after) if upto is None else upto
        if not n and upto == after:
            return upto
        parts = max(1, -(-n // records))
        cuts = sorted({x for x in rows.agg(F.percentile_approx("lsn", [i / parts for i in range(1, parts)], 10_000)).first()[0]
                       if after < x < upto}) if parts > 1 else []
        ends = [*cuts, upto]                                                 # landing i ends here
        landing = uuid.uuid4().hex
        path = f"{self.root}/segments/{landing}"
        no = F.lit(0) + sum([(F.col("lsn") > F.lit(x)).cast("int") for x in cuts], F.lit(0))
        (rows.withColumn("no", F.coalesce(no, F.lit(0))).select("no", "table", "kind", "lsn", "value")
         .write.option("maxRecordsPerFile", str(records)).partitionBy("no", "table", "kind").parquet(path))
        ddl = f"no int, `table` string, kind string, {SEGMENT_DDL}"
        files = (self.spark.read.schema(ddl).parquet(path)
                 .groupBy("no", "table", "kind", F.col("_metadata.file_path").alias("file"))
                 .agg(F.min("lsn").alias("lo"), F.max("lsn").alias("hi"), F.count(F.lit(1)).alias("records")))
        begins = [after, *cuts]
        for i, (a, b) in enumerate(zip(begins, ends, strict=True)):          # a landing for each ``records`` records
            of = files.where(F.col("no") == i).drop("no")
            empty = self.spark.createDataFrame([(None, "none", None, None, None, 0)],
                                               "`table` string, kind string, file string, lo bigint, hi bigint, records bigint")
            line = of.unionByName(empty).select(F.lit(f"{landing}-{i}").alias("landing"), F.lit(a).cast("long").alias("after"),
                                                F.lit(b).cast("long").alias("upto"), "file", "table", "kind", "lo", "hi", "records")
            line.coalesce(1).write.json(f"{self.root}/manifest/{landing}-{i}", ignoreNullFields=False)
        return upto

    # ------------------------------------------------------------ coverage
    def _exists(self) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def manifest(self) -> DataFrame:
        """A row for each file of each landing, and one (kind ``none``) for the landing itself."""
        if not self._exists():
            return self.spark.createDataFrame([], MANIFEST_DDL)
        return self.spark.read.schema(MANIFEST_DDL).json(f"{self.root}/manifest/*")

    def landings(self) -> DataFrame:
        """(landing, after, upto, files, records, lo, hi) of each landing."""
        return self.manifest().groupBy("landing", "after", "upto").agg(
            F.count("file").alias("files"), F.sum("records").alias("records"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def end(self, default: int | None = None) -> int | None:
        """The position the log reaches."""
        got = self.manifest().agg(F.max("upto")).first()[0]
        return default if got is None else got

    def gaps(self, position: int = 0) -> DataFrame:
        """(after, upto) of the stretches beyond ``position`` that no landing holds: a landing must begin where those
        before it reach. One window over the manifest's landings (a row each, not their records)."""
        before = Window.orderBy("after", "upto").rowsBetween(Window.unboundedPreceding, -1)
        due = self.landings().where(F.col("upto") > F.lit(position)).select("after", "upto")
        reach = F.greatest(F.coalesce(F.max("upto").over(before), F.lit(position)), F.lit(position).cast("long"))
        return (due.withColumn("reach", reach).where(F.col("after") > F.col("reach"))
                .select(F.col("reach").cast("long").alias("after"), F.col("after").alias("upto")))

    def reaches(self, position: int | None) -> bool:
        """T-7: whether the log still follows on ``position`` without a gap."""
        return position is not None and self.gaps(position).isEmpty()

    # ------------------------------------------------------------ reading
    def files(self, tables, position: int = 0) -> DataFrame:
        """The files beyond ``position`` that hold changes of some tables, or records without a table."""
        m = self.manifest()
        wanted = F.col("table").isin(list(tables)) | F.col("table").isNull()
        return m.where((F.col("kind") == "dml") & wanted & (F.col("hi").isNull() | (F.col("hi") > F.lit(position)))).select("file", "table", "records")

    def read(self, files: list[str], position: int = 0) -> DataFrame:
        """Parsed changes of some files, those beyond ``position``."""
        if not files:
            return parse_feed(self.spark.createDataFrame([], "value string"))
        rows = self.spark.read.schema(SEGMENT_DDL).parquet(*files)
        return parse_feed(rows.where(F.col("lsn").isNull() | (F.col("lsn") > F.lit(position))).select("value"))

    def stream(self, landings_per_trigger: int | None = None) -> DataFrame:
        """The manifest as a stream, at most so many landings at once (T-2)."""
        reader = self.spark.readStream.schema(MANIFEST_DDL)
        if landings_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(landings_per_trigger))
        return reader.json(f"{self.root}/manifest/*")
