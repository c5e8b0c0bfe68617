"""Row counts and timings that ride on a write instead of a second job."""

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StepMetric:
    """What one write did."""

    operation: str
    row_count: int
    duration_seconds: float
    observed: dict = field(default_factory=dict)

    @property
    def rows_per_second(self) -> float:
        return self.row_count / self.duration_seconds if self.duration_seconds > 0 else 0.0


def observed_write(
    operation: str,
    df: DataFrame,
    write: Callable[[DataFrame], None],
    extra: list[Column] | None = None,
) -> StepMetric:
    """Run ``write(df)`` once and return its row count, duration and ``extra`` aggregates.

    ``df`` must end after its last shuffle: observed values of the stage that writes are
    counted once per partition even when tasks are retried, those of a map stage are not.
    """
    seen = Observation()
    started = time.monotonic()
    write(df.observe(seen, F.count(F.lit(1)).alias("row_count"), *(extra or [])))
    seconds = time.monotonic() - started
    values = dict(seen.get)
    return StepMetric(operation, values.pop("row_count", 0), seconds, values)


def measure_evaluation(operation: str, df: DataFrame) -> StepMetric:
    """Rows and time of evaluating every column of ``df``, keeping nothing."""
    return observed_write(
        operation, df, lambda d: d.write.format("noop").mode("overwrite").save()
    )


def metrics_frame(spark: SparkSession, metrics: list[StepMetric]) -> DataFrame:
    """One row per step: operation, row count, seconds, rows per second."""
    # Result column names.
    return spark.createDataFrame(
        [(m.operation, m.row_count, m.duration_seconds, m.rows_per_second) for m in metrics],
        "operation string, row_count long, duration_seconds double, "
        "throughput_rows_per_sec double",
    )
