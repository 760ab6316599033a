"""Column-level functions (all built-in Spark expressions, no UDFs)."""

from tessera.functions.columns import fresh_names, has_map, map_free, qcol, quote_name, resolve
from tessera.functions.dates import truncate_period
from tessera.functions.multivalue import split_values, unnest, values_of
from tessera.functions.nulls import DEFAULT_PLACEHOLDERS, all_null, any_present, placeholder_to_null
from tessera.functions.numeric import null_rate, share
from tessera.functions.timezone import (
    at_time_zone_utc,
    instant_to_utc_wall,
    normalize_utc,
    ntz_micros,
    to_utc_wall,
    utc_wall_to_instant,
)

__all__ = [
    "DEFAULT_PLACEHOLDERS",
    "all_null",
    "any_present",
    "at_time_zone_utc",
    "fresh_names",
    "has_map",
    "instant_to_utc_wall",
    "normalize_utc",
    "map_free",
    "ntz_micros",
    "null_rate",
    "placeholder_to_null",
    "qcol",
    "quote_name",
    "resolve",
    "share",
    "split_values",
    "to_utc_wall",
    "truncate_period",
    "unnest",
    "values_of",
    "utc_wall_to_instant",
]
