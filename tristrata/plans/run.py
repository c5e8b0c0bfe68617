"""The full run: delimited files to bronze, silver, gold and insights."""

import logging
from contextlib import suppress
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tristrata.functions.marks import Mark, days_back, settled
from tristrata.metrics import StepMetric
from tristrata.plans.insights import insight_dict
from tristrata.plans.layers import (
    LATEST,
    build_gold,
    build_silver,
    drop_old_silver,
    ingest_bronze,
    note_load,
)
from tristrata.sources import versions

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunResult:
    """Outcome of a run; ``gold`` reads the stored layer."""

    spark: SparkSession
    ok: bool
    metrics: list[StepMetric] = field(default_factory=list)
    gold: DataFrame | None = None
    error: Exception | None = None

    def insights(self) -> dict | None:
        """The four insights, patients per group as a frame, or None after a failure."""
        return insight_dict(self.gold) if self.ok else None

    def report(self) -> DataFrame:
        """``(layer, status, record_count)``, one row per layer.

        A layer a failed run did not finish is reported as failed or not run, without
        a count.
        """
        done = [(m.operation, "success", m.row_count) for m in self.metrics]
        missed = [(layer, "not run", None) for layer in ("bronze", "silver", "gold")[len(done) :]]
        if missed and not self.ok:
            missed[0] = (missed[0][0], "failed", None)
        return self.spark.createDataFrame(
            done + missed, "layer string, status string, record_count long"
        )


def run(
    spark: SparkSession,
    source: str | list[str],
    root: str,
    since: Mark | None = None,
    *,
    keys: tuple[str, ...] = ("patient_id",),
    latest: tuple[str, ...] = LATEST,
    unique: bool = False,
    fold: bool = False,
    quarantine: bool = False,
    bronze_schema: T.StructType | None = None,
    mode: str = "append",
    load_id: str | None = None,
    rebalance: bool = True,
    raise_errors: bool = True,
    **ingest_options,
) -> RunResult:
    """Ingest ``source`` after ``since`` into ``root``/bronze, then rebuild silver and gold.

    Silver and gold cover all of bronze, whose schema may be given where it is known.
    ``fold`` spares reading the history again: what silver lacks of bronze is folded into the
    silver that exists, see :func:`build_silver`. It needs a bronze that only grows, so not
    ``mode`` other than ``append`` and no ``load_id``. A mark given as a column is worked
    out once, at the start. ``quarantine`` keeps malformed lines and rows that break a rule in
    folders of their own beside the layers. Intermediate tables lie below ``root`` and go at
    the end. With ``raise_errors=False`` a failure is returned instead of raised. The
    caller's session is never stopped.
    """
    if fold and (mode != "append" or load_id is not None):
        raise ValueError("fold needs loads that only append: no other mode and no load id")
    root = root.rstrip("/")
    bronze_path, silver_path, gold_path, malformed_path, quarantine_path = (
        f"{root}/{name}" for name in ("bronze", "silver", "gold", "malformed", "quarantine")
    )
    scratch = f"{root}/_scratch/{versions.new_version()}"
    metrics: list[StepMetric] = []
    try:
        since = settled(spark, since)
        versions.make_folder(spark, scratch)
        # Until silver has this load, and all of it again where the load replaces rows.
        appends = mode == "append" and load_id is None
        note_load(spark, silver_path, since if appends else None)
        _, metric = ingest_bronze(
            spark,
            source,
            bronze_path,
            since,
            malformed_path=malformed_path if quarantine else None,
            mode=mode,
            load_id=load_id,
            rebalance=rebalance,
            **ingest_options,
        )
        metrics.append(metric)
        silver, metric = build_silver(
            spark,
            bronze_path,
            silver_path,
            keys=keys,
            latest=latest,
            unique=unique,
            since=since if fold else None,
            quarantine_path=quarantine_path if quarantine else None,
            bronze_schema=bronze_schema,
            rebalance=rebalance,
            keep_old=True,
        )
        metrics.append(metric)
        gold, metric = build_gold(spark, silver_path, gold_path, silver.schema, scratch)
        metrics.append(metric)
        drop_old_silver(spark, silver_path)
    except Exception as e:
        if raise_errors:
            raise
        log.exception("run failed")
        return RunResult(spark, False, metrics, error=e)
    finally:
        with suppress(Exception):
            versions.remove(spark, scratch)
    return RunResult(spark, True, metrics, gold)


def incremental_run(
    spark: SparkSession,
    source: str | list[str],
    root: str,
    days: int = 1,
    **options,
) -> RunResult:
    """A run over visits of the last ``days`` days, by the calendar of the session."""
    return run(spark, source, root, since=days_back(days), **options)
