"""Column-level building blocks: cleaning rules and incremental date marks."""

from tristrata.functions.cleaning import (
    apply_rules,
    fill_defaults,
    rejects,
    standardize,
)
from tristrata.functions.marks import (
    after,
    between_dates,
    days_back,
    mark_before_latest,
    parse_mark,
)

__all__ = [
    "after",
    "apply_rules",
    "between_dates",
    "days_back",
    "fill_defaults",
    "mark_before_latest",
    "parse_mark",
    "rejects",
    "standardize",
]
