"""Delimited visit files, the Parquet layers, and shared scratch tables."""

from tristrata.sources.layers import (
    evolve,
    latest_date,
    read_bronze,
    read_gold,
    read_malformed,
    read_rejects,
    read_silver,
    write_bronze,
    write_gold,
    write_silver,
)
from tristrata.sources.scratch import scratch_path, store
from tristrata.sources.visits_csv import malformed, read_visits

__all__ = [
    "evolve",
    "latest_date",
    "malformed",
    "read_bronze",
    "read_gold",
    "read_malformed",
    "read_rejects",
    "read_silver",
    "read_visits",
    "scratch_path",
    "store",
    "write_bronze",
    "write_gold",
    "write_silver",
]
