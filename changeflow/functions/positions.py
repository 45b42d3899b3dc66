"""Log positions, write guards and lag arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_MASK = 0xFFFFFFFF


def lsn_to_int(lsn_text: Column) -> Column:
    """``'16/B374D848'`` -> ``(0x16 << 32) | 0xB374D848`` as BIGINT."""
    text = F.trim(lsn_text)
    parts = F.split(text, "/")
    hi = F.conv(F.try_element_at(parts, F.lit(1)), 16, 10).try_cast("bigint")
    lo = F.conv(F.try_element_at(parts, F.lit(2)), 16, 10).try_cast("bigint")
    # anything but two hexadecimal words is no position (and its record a reject)
    return F.when(text.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"), F.shiftleft(hi, 32).bitwiseOR(lo))


def int_to_lsn(lsn: Column) -> Column:
    """BIGINT position -> ``'HI/LO'`` upper-case hex text."""
    return F.concat(F.upper(F.hex(F.shiftright(lsn, 32))), F.lit("/"),
                    F.upper(F.hex(lsn.bitwiseAND(F.lit(LOW_MASK)))))


def guard(new_lsn: Column, stored_lsn: Column) -> Column:
    """Strict write guard: the incoming position must exceed the stored one."""
    return new_lsn > F.coalesce(stored_lsn, F.lit(-1).cast("bigint"))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(1e6)


def event_lag_seconds(read_ts: Column, written_ts: Column) -> Column:
    """Event-time lag of the writer behind the reader, floored at 0; 0 when unknown."""
    return F.when(read_ts.isNull() | written_ts.isNull(), F.lit(0.0)) \
        .otherwise(F.greatest(F.lit(0.0), seconds_between(read_ts, written_ts)))


def backlog(head_lsn: Column, applied_lsn: Column) -> Column:
    """Distance between the newest position in the feed and the applied one."""
    return F.greatest(F.lit(0).cast("bigint"), head_lsn - F.coalesce(applied_lsn, F.lit(0).cast("bigint")))


def rate(n: Column, elapsed_seconds: Column) -> Column:
    """Events per second, rounded to one decimal; elapsed floored at one microsecond."""
    return F.round(n / F.greatest(elapsed_seconds, F.lit(1e-6)), 1)
