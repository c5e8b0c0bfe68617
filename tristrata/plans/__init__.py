"""Compositions a user runs: the three layer builds, insights, and the full run."""

from tristrata.plans.advance import advance, fold_loads, gold_from_state, take_files
from tristrata.plans.insights import (
    distribution,
    insight_dict,
    insight_record,
    summary,
    top_group,
    total_revenue,
)
from tristrata.plans.layers import build_gold, build_silver, clean, ingest_bronze, rank_groups
from tristrata.plans.run import RunResult, incremental_run, run

__all__ = [
    "RunResult",
    "advance",
    "build_gold",
    "build_silver",
    "clean",
    "distribution",
    "fold_loads",
    "gold_from_state",
    "incremental_run",
    "ingest_bronze",
    "insight_dict",
    "insight_record",
    "rank_groups",
    "run",
    "summary",
    "take_files",
    "top_group",
    "total_revenue",
]
