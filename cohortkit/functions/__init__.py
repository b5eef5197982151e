"""Scalar column expressions (all JVM-side) and the one Pandas UDF."""

from cohortkit.functions.columns import (  # noqa: F401
    capitalize_first,
    clean_name,
    dense_cosine,
    lookup_measure,
    pretty_label,
    row_mean,
    row_sum,
    safe_ratio,
    url_key,
)
