"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``.

Queries that write use a fresh folder of the shared scratch space, which stays in place
because the result reads it lazily. Money sums are rounded to cents, since the order of
a floating-point sum is not fixed.
"""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.functions import after, apply_rules, fill_defaults, rejects
from tristrata.functions import standardize
from tristrata.metrics import measure_evaluation, metrics_frame
from tristrata.operators import (
    add_profile,
    agg_metrics,
    by_group,
    cached_view,
    calendar_trend,
    distinct_keys,
    latest_per_key,
    monthly_trend,
    null_audit,
    profile_by_day,
    sized_join,
    sized_write,
    skewed_join,
    united,
)
from tristrata.plans.advance import advance, take_files
from tristrata.plans.insights import (
    distribution,
    insight_record,
    summary,
    top_group,
    total_revenue,
)
from tristrata.plans.layers import clean, rank_groups
from tristrata.plans.run import RunResult, run
from tristrata.plans.run import incremental_run as run_days
from tristrata.plans.visits import (
    COLUMNS,
    NEWEST_VISIT,
    WIDE_SCHEMA,
    table,
    visits,
    write_visit_files,
)
from tristrata.schema import BRONZE_SCHEMA, LOADED_AT, SILVER_AT, SOURCE_FILE
from tristrata.sources import (
    latest_date,
    read_bronze,
    read_malformed,
    read_rejects,
    read_silver,
    read_visits,
    scratch_path,
    store,
    write_bronze,
    write_silver,
)
from tristrata.sources.layers import write_layer
from tristrata.sources.ledger import waiting
from tristrata.sources.versions import children
from tristrata.streaming import stream_bronze

Query = Callable[[SparkSession, str], DataFrame]
MARK = "1998-01-01"
GOLD_COLUMNS = [
    "diagnosis",
    "total_billing",
    "avg_billing",
    "patient_count",
    "min_age",
    "max_age",
    "avg_age",
    "first_visit",
    "last_visit",
]


def cents(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


def silver_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        visits(spark, sf_dir)
        .transform(clean)
        .transform(latest_per_key, latest=NEWEST_VISIT, unique=True)
    )


def gold_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_group(silver_visits(spark, sf_dir))


#: What a run over visit files with a visit id takes.
WIDE_RUN = dict(latest=NEWEST_VISIT, unique=True, schema=WIDE_SCHEMA, layout="month")
WIDE_BRONZE = T.StructType(
    [*WIDE_SCHEMA.fields, *(f for f in BRONZE_SCHEMA if f.name not in WIDE_SCHEMA.names)]
)
WIDE_SILVER = T.StructType([*WIDE_BRONZE.fields, T.StructField(SILVER_AT, T.TimestampType())])
#: What a run by changes over such files takes.
WIDE_ADVANCE = dict(WIDE_RUN, bronze_schema=WIDE_BRONZE, buckets=8)


def until_mark(df: DataFrame) -> DataFrame:
    """Visits not after the mark, those without a date among them."""
    return df.filter(~F.coalesce(F.col("visit_date") > F.lit(MARK).cast("date"), F.lit(False)))


def stored_run(spark: SparkSession, sf_dir: str, since: str | None = None) -> RunResult:
    """Visit files, then all three layers through storage."""
    files = write_visit_files(visits(spark, sf_dir))
    root = scratch_path(spark, "run")
    return run(spark, files, root, since, bronze_schema=WIDE_BRONZE, **WIDE_RUN)


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_visit_files(visits(spark, sf_dir))
    return read_visits(spark, files, schema=WIDE_SCHEMA).select(
        *COLUMNS, F.col("source_file").endswith(".csv").alias("from_csv")
    )


def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return after(visits(spark, sf_dir), MARK)


def incremental_days_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest date comes from names and footers, so the filter is a literal for folders."""
    path = monthly_bronze(spark, sf_dir)
    mark = latest_date(spark, path) - dt.timedelta(30)
    return after(read_bronze(spark, path, mark), mark).select(*COLUMNS)


def monthly_bronze(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "bronze")
    write_bronze(visits(spark, sf_dir), path, layout="month")
    return path


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, monthly_bronze(spark, sf_dir)).select(*COLUMNS)


def bronze_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = monthly_bronze(spark, sf_dir)
    return read_bronze(spark, path, "1997-01-01", "1997-12-31").select(*COLUMNS)


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later visits carry a column the earlier files lack."""
    seen, path = visits(spark, sf_dir), scratch_path(spark, "bronze")
    earlier = until_mark(seen)
    later = after(seen, MARK).withColumn("doctor_id", F.concat(F.lit("DOC"), "patient_id"))
    for batch in (earlier, later):
        write_bronze(batch, path, layout="month")
    return read_bronze(spark, path).select(*COLUMNS, "doctor_id")


def silver_fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_defaults(visits(spark, sf_dir))


def silver_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits(spark, sf_dir).transform(fill_defaults).transform(standardize)


def silver_range_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_standardize(spark, sf_dir).transform(apply_rules)


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = silver_standardize(spark, sf_dir).transform(rejects)
    return rejected.select("visit_id", F.array_join("reject_reasons", ",").alias("reasons"))


def silver_dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits(spark, sf_dir).transform(clean).transform(distinct_keys)


def silver_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_audit(visits(spark, sf_dir))


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    write_silver(silver_visits(spark, sf_dir), path)
    return read_silver(spark, path).select(*COLUMNS)


def gold_by_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(gold_groups(spark, sf_dir), "total_billing")


def gold_billing_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rank_groups(gold_groups(spark, sf_dir).select("diagnosis", "total_billing"))
    return cents(ranked, "total_billing")


def insight_top_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(top_group(gold_groups(spark, sf_dir)), "total_billing")


def insight_total_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(total_revenue(gold_groups(spark, sf_dir)), "total_revenue")


def insight_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution(gold_groups(spark, sf_dir))


def insight_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(summary(gold_groups(spark, sf_dir)), "top_billing", "total_revenue")


def insight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, _ = store(gold_groups(spark, sf_dir), "gold")
    return cents(insight_record(gold), "value")


def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their supplier, which is small enough to send everywhere."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("suppkey"), "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), "s_name", "s_nationkey"
    )
    return sized_join(lines, suppliers, "suppkey", measured=True)


def join_regular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order; how is the optimizer's choice."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_custkey", "o_orderpriority"
    )
    return sized_join(lines, orders, "orderkey")


def join_heavy_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the line items has one part, whose row goes to where they are."""
    most = F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_partkey"))
    lines = table(spark, sf_dir, "lineitem").select(
        most.cast("long").alias("partkey"), "l_orderkey", "l_linenumber", "l_quantity"
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("long").alias("partkey"), "p_brand", "p_size"
    )
    return skewed_join(lines, parts, "partkey")


def join_heavy_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the customers and of the suppliers shares one nation, neither is broadcast."""

    def hot(name: str, key: str, nation: str) -> DataFrame:
        third = F.when(F.col(key) % 3 == 0, F.lit(0)).otherwise(F.col(nation))
        return table(spark, sf_dir, name).select(third.cast("int").alias("nation"), key)

    customers = hot("customer", "c_custkey", "c_nationkey")
    suppliers = hot("supplier", "s_suppkey", "s_nationkey")
    return skewed_join(customers, suppliers, "nation", max_broadcast_bytes=0)


def sized_partition_write(spark: SparkSession, sf_dir: str, rows: int | None = None) -> DataFrame:
    path = scratch_path(spark, "events")
    sized_write(table(spark, sf_dir, "events"), "event_type", path, rows)
    return spark.read.parquet(path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users")
    )


def sized_write_of_known_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row count comes with an earlier step; here the table's footers hold it."""
    return sized_partition_write(spark, sf_dir, table(spark, sf_dir, "events").count())


def metrics_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.nullif("l_quantity", F.lit(1.0)).alias("quantity"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("price"),
    )
    result = agg_metrics(lines, ["l_returnflag", "l_linestatus"], ["quantity", "price"])
    return cents(result, "total_quantity", "avg_quantity", "total_price", "avg_price")


def capped_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "value")
    with cached_view(events) as (view, _):
        counted, _ = store(
            spark.sql(
                "SELECT event_type, count(*) AS events, count(value) AS measured, "
                f"round(sum(value), 2) AS total_value FROM {view} GROUP BY event_type"
            ),
            "events",
        )
    return counted


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_run(spark, sf_dir).report()


def step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the steps of a run and the evaluation of its gold report about themselves."""
    result = stored_run(spark, sf_dir)
    steps = [*result.metrics, measure_evaluation("gold read", result.gold)]
    timed = (F.col("duration_seconds") > 0) & (F.col("throughput_rows_per_sec") >= 0)
    return metrics_frame(spark, steps).select("operation", "row_count", timed.alias("timed"))


def layer_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many silver visits carry file, load time and processing time."""
    files, root = write_visit_files(visits(spark, sf_dir)), scratch_path(spark, "run")
    run(spark, files, root, bronze_schema=WIDE_BRONZE, **WIDE_RUN)
    names = [p for p in children(spark, files) if p.endswith(".csv")]
    stamped = read_silver(spark, f"{root}/silver").agg(
        F.count_if(F.col(SOURCE_FILE).isin(names)).alias("named"),
        F.count(LOADED_AT).alias("loaded"),
        F.count_if(F.col(SILVER_AT) >= F.col(LOADED_AT)).alias("processed"),
    )
    return stamped


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; lines with a text for a number and rows that break a rule, of both."""
    seen = visits(spark, sf_dir)
    text = F.col("age").cast("string")
    broken = F.when(F.col("visit_id") % 97 == 0, F.lit("unknown")).otherwise(text)
    seen, root = seen.withColumn("age", broken), scratch_path(spark, "broken")
    for since, part in ((None, until_mark(seen)), (MARK, after(seen, MARK))):
        advance(spark, write_visit_files(part), root, since, **WIDE_ADVANCE)
    kept = read_malformed(spark, f"{root}/bronze")
    rejected = read_rejects(spark, f"{root}/silver")
    last = F.regexp_extract("raw_line", r"(\d+)\s*$", 1).cast("long")
    return kept.select(last.alias("visit_id"), F.lit("malformed").alias("why")).union(
        rejected.select("visit_id", F.array_join("reject_reasons", ","))
    )


def ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files taken by a run that fails before it notes them, by two more, and with later ones."""
    seen, root = visits(spark, sf_dir), scratch_path(spark, "twice")
    files = write_visit_files(until_mark(seen), f"{root}/files")
    places = (files, f"{root}/bronze", f"{root}/ledger")
    for load in waiting(spark, places[2], files):  # begun, written in part, never noted
        half = read_visits(spark, load.files, schema=WIDE_SCHEMA).where("visit_id % 2 = 0")
        write_layer(
            half.withColumn("kind", F.lit("visit")),
            f"{places[1]}/load_id={load.load_id}",
            "bronze",
            ["kind", "visit_date"],
        )
    for more in (None, None, after(seen, MARK), None):
        if more is not None:
            write_visit_files(more, files)
        take_files(spark, *places, schema=WIDE_SCHEMA, layout="month")
    return read_bronze(spark, places[1]).select(*COLUMNS)


def gold_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads; gold follows the visits that came and went, and never reads silver."""
    seen, root = visits(spark, sf_dir), scratch_path(spark, "changes")
    later = after(seen, MARK)
    odd = F.col("patient_id") % 2 == 1
    for part in (until_mark(seen), later.where(odd), later.where(~odd)):
        result = advance(spark, write_visit_files(part), root, **WIDE_ADVANCE)
    return stored_gold(result)


def evolution_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later files have a column more; it goes on into silver by folding."""
    seen, root = visits(spark, sf_dir), scratch_path(spark, "evolved")
    run(spark, write_visit_files(until_mark(seen)), root, **WIDE_RUN)
    later = after(seen, MARK).withColumn("doctor_id", F.concat(F.lit("DOC"), "patient_id"))
    wider = T.StructType([*WIDE_SCHEMA.fields, T.StructField("doctor_id", T.StringType())])
    files = write_visit_files(later, columns=wider.names)
    run(spark, files, root, MARK, fold=True, **(WIDE_RUN | {"schema": wider}))
    return read_silver(spark, f"{root}/silver").select(*COLUMNS, "doctor_id")


def medallion_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits to ranked gold in one plan up to the ranking."""
    return cents(rank_groups(gold_groups(spark, sf_dir)), "total_billing")


def stored_gold(result: RunResult) -> DataFrame:
    return cents(result.gold.select(*GOLD_COLUMNS, "billing_rank"), "total_billing")


def medallion_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_gold(stored_run(spark, sf_dir))


def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_gold(stored_run(spark, sf_dir, since=MARK))


def incremental_days_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load, then a fold of the visits of as many days as lead back to the mark."""
    seen, root = visits(spark, sf_dir), scratch_path(spark, "days")
    run(spark, write_visit_files(until_mark(seen)), root, **WIDE_RUN)
    later = write_visit_files(after(seen, MARK))
    since = F.datediff(F.current_date(), F.lit(MARK).cast("date"))
    days = spark.range(1).select(since).first()[0]
    return stored_gold(run_days(spark, later, root, days, fold=True, **WIDE_RUN))


def incremental_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load, then later visits folded into the buckets of silver that they touch."""
    seen, root = visits(spark, sf_dir), scratch_path(spark, "fold")
    advance(spark, write_visit_files(until_mark(seen)), root, **WIDE_ADVANCE)
    advance(spark, write_visit_files(after(seen, MARK)), root, **WIDE_ADVANCE)
    gold = by_group(read_silver(spark, f"{root}/silver", schema=WIDE_SILVER))
    return cents(rank_groups(gold).select(*GOLD_COLUMNS, "billing_rank"), "total_billing")


def trend_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(monthly_trend(clean(visits(spark, sf_dir))), "total_billing")


def trend_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group is seen in summer only, so most of its months have no visit."""
    seen = clean(visits(spark, sf_dir))
    summer = F.month("visit_date").between(6, 8) | (F.col("diagnosis") != "BUILDING")
    trend = calendar_trend(seen.where(summer))
    return cents(trend, "total_billing", "trailing_billing", "change_on_year")


def profile_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of two loads, united over three years; estimates are held against exact values."""
    seen, path = visits(spark, sf_dir), scratch_path(spark, "profiles")
    for load in (until_mark(seen), after(seen, MARK)):
        add_profile(profile_by_day(load), path)
    start, end = "1996-06-15", "1999-06-14"
    found = united(spark.read.parquet(path), start, end)
    said = found.first()
    wanted = seen.where(F.col("visit_date").between(start, end))
    ranks = [
        F.avg((F.col("billing_amount") <= F.lit(said[q])).cast("double")).alias(q)
        for q in ("q10", "q50", "q90")
    ]
    exact = wanted.agg(F.count_distinct("patient_id").alias("keys"), *ranks).first()
    near = [abs(said["keys"] - exact["keys"]) <= 0.05 * exact["keys"]]
    near += [abs(exact[f"q{q}"] - q / 100) <= 0.03 for q in (10, 50, 90)]
    counted = ("rows", "null_patient_id", "null_diagnosis", "least", "greatest")
    return found.select(*counted, F.lit(all(near)).alias("near"))


def evolution_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later files have a wider id and ages with a fraction."""
    seen, path = visits(spark, sf_dir), scratch_path(spark, "types")
    narrow = until_mark(seen).withColumn("visit_id", F.col("visit_id").cast("int"))
    half = after(seen, MARK).withColumn("age", F.col("age") + 0.5)
    for batch in (narrow, half):
        write_bronze(batch, path, layout="month")
    return read_bronze(spark, path).select(*COLUMNS)


def streamed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of files and a run that finds nothing new."""
    seen, root = visits(spark, sf_dir), scratch_path(spark, "stream")
    arrivals = [until_mark(seen), after(seen, MARK), None]
    for batch in arrivals:
        if batch is not None:
            write_visit_files(batch, f"{root}/files")
        stream_bronze(
            spark,
            f"{root}/files",
            f"{root}/bronze",
            f"{root}/checkpoint",
            schema=WIDE_SCHEMA,
            layout="month",
        ).awaitTermination()
    return read_bronze(spark, f"{root}/bronze").select(*COLUMNS)


QUERIES: dict[str, Query] = {
    "csv_ingest": csv_ingest,
    "ingest_incremental": ingest_incremental,
    "incremental_days_back": incremental_days_back,
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_date_range": bronze_date_range,
    "schema_evolution": schema_evolution,
    "silver_fill_nulls": silver_fill_nulls,
    "silver_standardize": silver_standardize,
    "silver_range_rules": silver_range_rules,
    "silver_rejects": silver_rejects,
    "silver_dedup_latest": silver_visits,
    "silver_dedup_keys": silver_dedup_keys,
    "silver_null_audit": silver_null_audit,
    "silver_roundtrip": silver_roundtrip,
    "gold_by_diagnosis": gold_by_diagnosis,
    "gold_billing_rank": gold_billing_rank,
    "insight_top_diagnosis": insight_top_diagnosis,
    "insight_total_revenue": insight_total_revenue,
    "insight_distribution": insight_distribution,
    "insight_summary": insight_summary,
    "insight_record": insight_rows,
    "join_broadcast": join_broadcast,
    "join_regular": join_regular,
    "join_heavy_key": join_heavy_key,
    "join_heavy_both": join_heavy_both,
    "sized_partition_write": sized_partition_write,
    "agg_metrics": metrics_by_flag,
    "capped_view": capped_view,
    "run_metrics": run_metrics,
    "medallion_full": medallion_full,
    "medallion_stored": medallion_stored,
    "incremental_run": incremental_run,
    "incremental_fold": incremental_fold,
    "ingest_twice": ingest_twice,
    "gold_from_changes": gold_from_changes,
    "incremental_days_run": incremental_days_run,
    "malformed_lines": malformed_lines,
    "evolution_fold": evolution_fold,
    "step_metrics": step_metrics,
    "layer_stamps": layer_stamps,
    "sized_write_of_known_rows": sized_write_of_known_rows,
    "trend_monthly": trend_monthly,
    "stream_bronze": streamed_bronze,
    "trend_calendar": trend_calendar,
    "profile_range": profile_range,
    "evolution_types": evolution_types,
}
