"""DataFrame -> DataFrame operators."""

from tessera.operators.aggregates import (
    conditional_count,
    counts_by_period,
    counts_by_periods,
    element_frequency,
    filtered_count,
    key_cardinality,
    numeric_range,
    population,
    value_frequencies,
    value_frequency,
)
from tessera.operators.dedup import latest_per_key, row_number_per_key
from tessera.operators.filters import any_of_present, at_least, equals, not_null
from tessera.operators.profile import column_stats, profile, profile_records, sample_fraction_for
from tessera.operators.projection import (
    SILVER_COLUMNS,
    SPARSE_COLUMNS,
    drop_columns,
    keep_columns,
    passthrough,
    rename_cast,
)
from tessera.operators.quality import output_checks, range_check, reconciliation, schema_check
from tessera.operators.topk import sort_asc, top_k, top_n_other

__all__ = [
    "SILVER_COLUMNS",
    "SPARSE_COLUMNS",
    "any_of_present",
    "at_least",
    "column_stats",
    "conditional_count",
    "counts_by_period",
    "counts_by_periods",
    "drop_columns",
    "element_frequency",
    "equals",
    "filtered_count",
    "keep_columns",
    "key_cardinality",
    "latest_per_key",
    "not_null",
    "numeric_range",
    "output_checks",
    "passthrough",
    "population",
    "profile",
    "profile_records",
    "range_check",
    "reconciliation",
    "rename_cast",
    "row_number_per_key",
    "sample_fraction_for",
    "schema_check",
    "sort_asc",
    "top_k",
    "top_n_other",
    "value_frequencies",
    "value_frequency",
]
