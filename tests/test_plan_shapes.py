"""The physical plans the queries rely on at scale."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F
from samples import OPENING

import __spark_entry__ as contract
from tristrata.operators import sized_join
from tristrata.plans.catalogue import gold_groups, silver_visits
from tristrata.plans.visits import table, visits
from tristrata.sources import read_bronze, read_visits, scratch_path, write_bronze

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    "ingest_incremental",
    "incremental_days_back",
    "silver_fill_nulls",
    "silver_standardize",
    "silver_range_rules",
    "silver_rejects",
    "silver_dedup_latest",
    "silver_dedup_keys",
    "silver_null_audit",
    "gold_by_diagnosis",
    "insight_top_diagnosis",
    "insight_total_revenue",
    "insight_distribution",
    "insight_summary",
    "join_broadcast",
    "join_regular",
    "agg_metrics",
    "trend_monthly",
]


@contextlib.contextmanager
def conf(spark, **settings):
    """Session settings for one block; ``__`` stands for a dot."""
    keys = {f"spark.sql.{k.replace('__', '.')}": v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_workers_and_no_products(spark, plan, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_dedup_trims_before_its_only_shuffle(spark, plan):
    text = plan(silver_visits(spark, SF_DIR), "simple")
    shuffle = text.index("Exchange hashpartitioning")
    final, partial = (m.start() for m in re.finditer("WindowGroupLimit", text))
    assert final < shuffle < partial
    assert text.count("Exchange hashpartitioning") == 1


def test_gold_is_aggregated_before_its_shuffle(spark, plan):
    text = plan(gold_groups(spark, SF_DIR), "simple")
    assert "partial_sum(" in text
    assert text.count("Exchange hashpartitioning") == 2


def test_top_group_is_a_top_k(spark, plan):
    top = contract.queries()["insight_top_diagnosis"](spark, SF_DIR)
    assert "TakeOrderedAndProject" in plan(top)


def test_null_audit_is_one_pass(spark, plan):
    audit = contract.queries()["silver_null_audit"](spark, SF_DIR)
    assert plan(audit, "simple").count("FileScan") == 2


def test_scans_read_only_the_columns_needed(spark, plan):
    text = plan(contract.queries()["silver_dedup_keys"](spark, SF_DIR))
    schemas = re.findall(r"ReadSchema: (.*)", text)
    assert not any("c_name" in s or "o_orderdate" in s or "c_mktsegment" in s for s in schemas)
    text = plan(contract.queries()["agg_metrics"](spark, SF_DIR))
    assert "l_orderkey" not in text and "l_shipdate" not in text


@pytest.mark.parametrize("layout", ["day", "month"])
def test_date_range_prunes_folders(spark, plan, layout):
    path = scratch_path(spark, "prune")
    few = visits(spark, SF_DIR).filter("visit_date BETWEEN '1996-12-28' AND '1997-01-04'")
    write_bronze(few, path, layout=layout)
    ranged = read_bronze(spark, path, "1997-01-01", "1997-01-02")
    partition = "visit_month" if layout == "month" else "visit_date"
    [filters] = re.findall(r"PartitionFilters: (.*)", plan(ranged))
    assert f"({partition}" in filters and ">= " in filters and "<= " in filters
    if layout == "month":
        [pushed] = re.findall(r"PushedFilters: (.*)", plan(ranged))
        assert "GreaterThanOrEqual(visit_date,1997-01-01)" in pushed
    assert {str(r.visit_date) for r in ranged.collect()} <= {"1997-01-01", "1997-01-02"}


def test_the_regular_join_is_not_forced(spark, plan):
    with conf(spark, autoBroadcastJoinThreshold=-1):
        assert "SortMergeJoin" in plan(contract.queries()["join_regular"](spark, SF_DIR))
        assert "BroadcastHashJoin" in plan(contract.queries()["join_broadcast"](spark, SF_DIR))
        # Nested columns have no simple width, so such a side is never proven small.
        docs = table(spark, SF_DIR, "embeddings")
        assert "SortMergeJoin" in plan(sized_join(docs.select("vec_id"), docs, "vec_id"))


def test_a_hot_customer_is_split_over_join_tasks(spark, plan, tmp_path):
    """One customer has a third of the orders and the customers are not broadcast."""
    hot = F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey"))
    orders = table(spark, "/root/testdata/sf0.01", "orders").withColumn("o_custkey", hot)
    orders.repartition(16).write.parquet(f"{tmp_path}/orders.parquet")
    table(spark, "/root/testdata/sf0.01", "customer").write.parquet(f"{tmp_path}/customer.parquet")
    expected = sorted(map(repr, silver_visits(spark, str(tmp_path)).collect()))
    with conf(
        spark,
        shuffle__partitions=32,
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__advisoryPartitionSizeInBytes="8k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="8k",
    ):
        silver = silver_visits(spark, str(tmp_path))
        assert sorted(map(repr, silver.collect())) == expected
        text = plan(silver, "simple")
    final = text[: text.index("Initial Plan")]
    assert "SortMergeJoin(skew=true)" in final
    assert final.count("WindowGroupLimit") == 2


def test_an_incremental_read_filters_in_the_scan(spark, plan, csv_file):
    df = read_visits(spark, csv_file(OPENING), since="2023-06-11")
    [pushed] = re.findall(r"PushedFilters: (.*)", plan(df))
    assert "GreaterThan(visit_date,2023-06-11)" in pushed
