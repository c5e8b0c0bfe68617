"""Build each layer from the one below, through storage."""

import datetime as dt
import logging
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.functions.cleaning import apply_rules, fill_defaults, rejects, standardize
from tristrata.functions.marks import Mark, after, given, settled
from tristrata.metrics import StepMetric
from tristrata.operators.aggregate import by_group
from tristrata.operators.audit import null_counts
from tristrata.operators.dedup import latest_per_key
from tristrata.operators.rank import global_rank
from tristrata.schema import GOLD_AT, LOADED_AT, SILVER_AT, VISIT_SCHEMA
from tristrata.sources import versions
from tristrata.sources.layers import (
    LOAD,
    RAW_LINE,
    evolve,
    read_bronze,
    read_gold,
    read_silver,
    write_bronze,
    write_gold,
    write_layer,
    write_silver,
)
from tristrata.sources.versions import Manifest
from tristrata.sources.visits_csv import malformed, read_visits

log = logging.getLogger(__name__)

LATEST = ("visit_date", LOADED_AT)


def ingest_bronze(
    spark: SparkSession,
    source: str | list[str],
    bronze_path: str,
    since: Mark | None = None,
    *,
    schema: T.StructType = VISIT_SCHEMA,
    malformed_path: str | None = None,
    mode: str = "append",
    load_id: str | None = None,
    **write_options,
) -> tuple[DataFrame, StepMetric]:
    """Read visit files, keep those after ``since``, write them to bronze.

    With ``malformed_path`` a second pass adds the lines of any date that do not match
    the schema there, with their text; like bronze itself, a load with an id replaces its
    own lines and mode ``overwrite`` all of them. Returns the (lazy) ingested frame and what
    was written.
    """
    visits = read_visits(spark, source, since, schema=schema)
    metric = write_bronze(visits, bronze_path, mode, load_id=load_id, **write_options)
    if malformed_path:
        lines = read_visits(spark, source, schema=schema, corrupt_column=RAW_LINE)
        how = "overwrite" if mode == "overwrite" else "append"
        if load_id is not None:
            malformed_path, how = f"{malformed_path}/{LOAD}={load_id}", "overwrite"
        kept = write_layer(malformed(lines, RAW_LINE), malformed_path, "malformed", mode=how)
        log.info("kept %d malformed lines", kept.row_count)
    return visits, metric


def clean(df: DataFrame) -> DataFrame:
    """Fill, standardize, then keep valid rows, in that order."""
    return df.transform(fill_defaults).transform(standardize).transform(apply_rules)


def note_load(spark: SparkSession, silver_path: str, since: dt.date | None) -> None:
    """Record that a load after ``since`` goes into bronze and is not in silver yet."""
    manifest = versions.current(spark, silver_path)
    mark = None if since is None else since.isoformat()
    if mark not in manifest.pending:
        pending = [*manifest.pending, mark]
        versions.publish(spark, silver_path, replace(manifest, pending=pending))


def fold_mark(manifest: Manifest, since: dt.date | None) -> dt.date | None:
    """The mark after which bronze is not in silver yet; None if silver must be rebuilt."""
    marks = [since.isoformat() if since else None, *manifest.pending]
    if manifest.folder is None or None in marks:
        return None
    return dt.date.fromisoformat(min(marks))


def build_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    *,
    keys: tuple[str, ...] = ("patient_id",),
    latest: tuple[str, ...] = LATEST,
    unique: bool = False,
    since: Mark | None = None,
    quarantine_path: str | None = None,
    bronze_schema: T.StructType | None = None,
    rebalance: bool = True,
    keep_old: bool = False,
) -> tuple[DataFrame, StepMetric]:
    """Clean and deduplicate all of bronze into a new version of silver.

    With ``since`` only bronze after that mark, or after the earliest mark of a load that
    silver lacks, is read and folded into the version in use. Where bronze only grows that
    gives the same as all of bronze, as the latest of the latest is the latest. Without a
    version to fold into, bronze is taken from its beginning.

    The new version is written once and then named in the manifest, so a write that fails
    leaves the version in use as it was. Older ones are removed, at once or, with
    ``keep_old``, by the caller. NULLs in required fields are counted by the write and
    logged, and the rows stay. With ``quarantine_path`` the rows read that break a rule are
    kept there with their reasons, beside those that earlier folds kept. ``bronze_schema``
    spares merging the schemas of bronze's files, ``rebalance=False`` the shuffle by diagnosis.
    """
    manifest = versions.current(spark, silver_path)
    mark = fold_mark(manifest, settled(spark, since)) if given(since) else None
    version = versions.new_version()
    # The inclusive start prunes folders of either layout; the mark itself is strict.
    bronze = after(read_bronze(spark, bronze_path, mark, schema=bronze_schema), mark)
    silver = clean(bronze)
    if mark is not None:
        silver = evolve([read_silver(spark, silver_path).drop(SILVER_AT), silver])
    silver = silver.transform(latest_per_key, keys, latest, unique)
    silver = silver.withColumn(SILVER_AT, F.current_timestamp())
    folder = f"{silver_path}/{versions.VERSION}={version}"
    metric = write_silver(silver, folder, rebalance=rebalance, observe=null_counts())
    for field, nulls in metric.observed.items():
        if nulls:
            log.warning("silver has %d NULLs (%s)", nulls, field)
    kept = manifest.rejects if mark is not None else []
    if quarantine_path:
        versions.drop_others(spark, quarantine_path, versions.REJECTS, manifest.rejects)
        checked = bronze.transform(fill_defaults).transform(standardize)
        where = f"{quarantine_path}/{versions.REJECTS}={version}"
        rejected = write_layer(rejects(checked), where, "quarantine")
        log.info("quarantined %d rows", rejected.row_count)
        kept = [*kept, version]
    manifest = replace(manifest, folder=version, pending=[], rejects=kept)
    versions.publish(spark, silver_path, manifest)
    if quarantine_path:
        versions.drop_others(spark, quarantine_path, versions.REJECTS, kept)
    if not keep_old:
        drop_old_silver(spark, silver_path)
    return read_silver(spark, silver_path, schema=silver.schema), metric


def drop_old_silver(spark: SparkSession, silver_path: str) -> None:
    """Remove the versions of silver that are not in use."""
    folder = versions.current(spark, silver_path).folder
    versions.drop_others(spark, silver_path, versions.VERSION, [folder] if folder else [])


def rank_groups(grouped: DataFrame, scratch: str | None = None) -> DataFrame:
    """Add ``billing_rank`` by total billing."""
    return global_rank(grouped, "total_billing", "billing_rank", scratch=scratch)


def build_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    silver_schema: T.StructType | None = None,
    scratch: str | None = None,
) -> tuple[DataFrame, StepMetric]:
    """Aggregate silver by diagnosis and rank the groups, replacing gold.

    ``silver_schema`` spares merging the schemas of silver's files; ``scratch`` is a shared
    folder for what the ranking stores, where the session names none.
    """
    grouped = by_group(read_silver(spark, silver_path, schema=silver_schema))
    gold = rank_groups(grouped, scratch).withColumn(GOLD_AT, F.current_timestamp())
    metric = write_gold(gold, gold_path)
    return read_gold(spark, gold_path), metric
