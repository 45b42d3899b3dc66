"""Canonical type coercion as Spark column expressions (no Python per row).

Change records carry each value as VARIANT (exact decimals survive JSON) together
with the source type name. Coercion picks a *family* from the lower-cased type name
by substring, first match wins, and renders a canonical value:

    decimal    exact decimal            timestamp  UTC instant, ISO-8601 text
    boolean    't'/'true'/'1' -> true   integer    64-bit integer
    text       string form of the value (everything else)

``canonical_text`` gives the canonical value as STRING (used by the generic long
form of ops); ``typed_from_text`` gives a value of a declared Spark type (used by the
wide, typed form). Failing coercions yield NULL; the row goes to the rejects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type-name tests in the order they are applied.
DECIMAL_WORDS = ("numeric", "decimal", "money")        # substring match
TIMESTAMP_WORD = "timestamp"                            # substring match
DATE_NAME = "date"                                      # exact match
BOOLEAN_NAMES = ("boolean", "bool")                     # exact match
INTEGER_NAMES = ("smallint", "integer", "int", "bigint", "int2", "int4", "int8")  # exact
TRUE_TEXTS = ("t", "true", "1")
DEFAULT_TYPE = "text"

_NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def type_family(type_name: Column) -> Column:
    t = F.lower(F.coalesce(type_name, F.lit(DEFAULT_TYPE)))
    is_dec = None
    for w in DECIMAL_WORDS:
        c = t.contains(w)
        is_dec = c if is_dec is None else (is_dec | c)
    return (F.when(is_dec, "decimal")
            .when(t.contains(TIMESTAMP_WORD) | (t == DATE_NAME), "timestamp")
            .when(t.isin(*BOOLEAN_NAMES), "boolean")
            .when(t.isin(*INTEGER_NAMES), "integer")
            .otherwise("text"))


def variant_is_null(v: Column) -> Column:
    """SQL NULL (field missing) and JSON null both count as null."""
    return v.isNull() | F.coalesce(F.is_variant_null(v), F.lit(False))


def variant_text(v: Column) -> Column:
    """String form of a VARIANT value: strings unquoted, numbers with exact digits."""
    return F.when(~variant_is_null(v), F.try_variant_get(v, "$", "string"))


def variant_json(v: Column) -> Column:
    """Null-normalised JSON text of a VARIANT value, for equality tests."""
    return F.when(~variant_is_null(v), F.to_json(v))


def canonical_ts(ts: Column) -> Column:
    """ISO-8601 UTC text: ``yyyy-MM-ddTHH:mm:ss[.ffffff]+00:00``.

    The fraction is printed (always 6 digits) only when it is non-zero. Requires a
    UTC session time zone (see ``session.ensure_utc``).
    """
    frac = F.when(F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1_000_000)) != 0,
                  F.date_format(ts, ".SSSSSS")).otherwise(F.lit(""))
    return F.when(ts.isNotNull(),
                  F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit("+00:00")))


def parse_ts(text: Column) -> Column:
    """Parse timestamp text: space or 'T', 'Z', '+00', '+0000', '+00:00', naive = UTC."""
    return _try_cast(F.trim(text), "timestamp")


def _try_cast(c: Column, ddl: str) -> Column:
    return c.try_cast(ddl)


def parse_bool(text: Column) -> Column:
    return F.when(text.isNotNull(), F.lower(F.trim(text)).isin(*TRUE_TEXTS))


def canonical_text(type_name: Column, v: Column) -> Column:
    """Canonical value as STRING, chosen by the record's type family."""
    s = variant_text(v)
    return canonical_of_text(type_family(type_name), s, parse_ts(s))


def canonical_of_text(fam: Column, s: Column, at: Column) -> Column:
    """Canonical value as STRING from the type family, the raw text and, for timestamps, the instant it names."""
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(fam == "decimal", F.when(s.rlike(_NUMBER_RE), F.trim(s)))
            .when(fam == "timestamp", canonical_ts(at))
            .when(fam == "boolean", parse_bool(s).cast("string"))
            .when(fam == "integer", _try_cast(F.trim(s), "bigint").cast("string"))
            .otherwise(s))


def typed_from_text(s: Column, dt: T.DataType) -> Column:
    """Canonical text -> declared Spark type."""
    if isinstance(dt, T.BooleanType):
        return parse_bool(s)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return parse_ts(s).cast(dt)
    if isinstance(dt, T.StringType):
        return s
    return _try_cast(F.trim(s), dt.simpleString())


def canonical_of_typed(c: Column, dt: T.DataType) -> Column:
    """Canonical text of an already-typed column (snapshot path, reports)."""
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return canonical_ts(c)
    if isinstance(dt, T.BooleanType):
        return c.cast("string")
    return c.cast("string")
