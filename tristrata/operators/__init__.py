"""DataFrame operators that aggregate, shuffle, join or lay out data."""

from tristrata.operators.aggregate import agg_metrics, by_group, monthly_trend
from tristrata.operators.audit import null_audit, null_counts
from tristrata.operators.dedup import distinct_keys, latest_per_key
from tristrata.operators.join import heavy_keys, sized_join, skewed_join
from tristrata.operators.layout import (
    cached_view,
    cap_partitions,
    sized_write,
    write_partitions,
)
from tristrata.operators.profiles import add_profile, profile_by_day, united
from tristrata.operators.rank import global_rank
from tristrata.operators.trends import calendar_trend

__all__ = [
    "add_profile",
    "agg_metrics",
    "by_group",
    "cached_view",
    "calendar_trend",
    "cap_partitions",
    "distinct_keys",
    "global_rank",
    "heavy_keys",
    "latest_per_key",
    "monthly_trend",
    "null_audit",
    "null_counts",
    "profile_by_day",
    "sized_join",
    "sized_write",
    "skewed_join",
    "united",
    "write_partitions",
]
