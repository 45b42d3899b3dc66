"""Table specifications: name, single-column primary key and typed columns.

A spec is the static description of a replicated table. Which of its columns are
*tracked* (replicated) at a given moment is decided by the registry
(:mod:`changeflow.operators.registry`), not by the spec.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Hidden per-field position columns in the target carry this prefix.
FIELD_LSN_PREFIX = "_flsn_"
# ... and the order of the change at that position
FIELD_SEQ_PREFIX = "_fseq_"
PRESENT_PREFIX = "_p_"
DELETED_AT = "deleted_at"
ROW_LSN = "_lsn"


@dataclass(frozen=True)
class TableSpec:
    name: str
    pk: str
    # (column, Spark DDL type) in ordinal order; the primary key is included.
    columns: tuple[tuple[str, str], ...]
    # source-side type names written into change records (defaults from Spark type)
    source_types: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def fields(self) -> list[str]:
        """Non-key columns."""
        return [c for c, _ in self.columns if c != self.pk]

    def spark_type(self, column: str) -> T.DataType:
        for c, t in self.columns:
            if c == column:
                return T._parse_datatype_string(t)
        raise KeyError(f"{self.name}.{column}")

    def source_type(self, column: str) -> str:
        if column in self.source_types:
            return self.source_types[column]
        return default_source_type(self.spark_type(column))

    def with_column(self, name: str, ddl: str, source_type: str | None = None) -> "TableSpec":
        st = dict(self.source_types)
        if source_type:
            st[name] = source_type
        return TableSpec(self.name, self.pk, self.columns + ((name, ddl),), st)


def default_source_type(dt: T.DataType) -> str:
    if isinstance(dt, T.DecimalType):
        return "numeric"
    if isinstance(dt, T.LongType):
        return "bigint"
    if isinstance(dt, (T.IntegerType,)):
        return "integer"
    if isinstance(dt, T.ShortType):
        return "smallint"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp with time zone"
    if isinstance(dt, T.DateType):
        return "date"
    return "text"


# Tables replicated from the driver's test data (see plans/feeds.py).
USERS = TableSpec(
    "users", "user_id",
    (("user_id", "bigint"), ("status", "string"), ("amount", "decimal(12,2)"), ("k", "bigint")),
)
TPCH_ORDERS = TableSpec(
    "tpch_orders", "o_orderkey",
    (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
     ("o_totalprice", "decimal(12,2)"), ("o_orderdate", "timestamp"),
     ("o_orderpriority", "string")),
)
CUSTOMERS = TableSpec(
    "tpch_customer", "c_custkey",
    (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
     ("c_acctbal", "decimal(12,2)"), ("c_mktsegment", "string")),
)
