from changeflow.functions.canonical import (  # noqa: F401
    canonical_of_text, canonical_of_typed, canonical_text, canonical_ts, parse_bool, parse_ts,
    type_family, typed_from_text, variant_is_null, variant_json, variant_text,
)
from changeflow.functions.positions import (  # noqa: F401
    backlog, event_lag_seconds, guard, int_to_lsn, lsn_to_int, rate, seconds_between,
)
