import datetime as dt

import pytest
from pyspark.sql import functions as F
from samples import BRONZE, LOADED_DDL, REJECTED, frame

from tristrata.functions import (
    after,
    apply_rules,
    between_dates,
    days_back,
    fill_defaults,
    mark_before_latest,
    parse_mark,
    rejects,
    standardize,
)
from tristrata.plans import clean

VISIT = "patient_id int, name string, age int, diagnosis string, billing_amount double"


def test_fill_replaces_null_and_nan(spark):
    rows = [(1, None, None, None, None), (2, "B", 5, "x", float("nan"))]
    filled = fill_defaults(spark.createDataFrame(rows, VISIT)).orderBy("patient_id").collect()
    assert [tuple(r) for r in filled] == [(1, "Unknown", 0, "Unknown", 0.0), (2, "B", 5, "x", 0.0)]


def test_fill_skips_columns_that_are_absent(spark):
    assert fill_defaults(spark.createDataFrame([(None,)], "age int")).first().age == 0


def test_blank_diagnosis_is_missing_but_blank_name_is_not(spark):
    rows = [(1, "  ", 1, "   ", 1.0), (2, "n", 1, "\t", 1.0)]
    done = clean(spark.createDataFrame(rows, VISIT)).orderBy("patient_id").collect()
    assert [(r.name, r.diagnosis) for r in done] == [("", "UNKNOWN"), ("n", "\t")]


def test_standardize_trims_blanks_only(spark):
    df = spark.createDataFrame([(1, " A b ", 1, " x\t ", 1.0)], VISIT)
    assert standardize(df).first()[1:4] == ("A b", 1, "X\t")


def test_rules_keep_the_bounds(spark):
    rows = [(i, "n", age, "d", 0.0) for i, age in enumerate([-1, 0, 150, 151])]
    kept = apply_rules(spark.createDataFrame(rows, VISIT))
    assert sorted(r.age for r in kept.collect()) == [0, 150]


def test_clean_sample(spark):
    done = clean(frame(spark, BRONZE, LOADED_DDL))
    assert done.count() == 10
    for c in ("age", "billing_amount", "diagnosis", "name"):
        assert done.filter(F.col(c).isNull()).count() == 0
    rows = {r.patient_id: (r.name, r.age, r.diagnosis, r.billing_amount) for r in done.collect()}
    assert rows[15] == ("Vic", 0, "SPRAIN", 0.0)
    assert rows[19] == ("Zoe", 0, "UNKNOWN", 0.0)
    assert rows[20] == ("Unknown", 44, "\t", 0.0)


def test_rejects_are_the_complement_with_reasons(spark):
    rows = frame(spark, BRONZE, LOADED_DDL)
    df = rows.transform(fill_defaults).transform(standardize)
    rejected = {r.patient_id: r.reject_reasons for r in rejects(df).collect()}
    assert rejected == REJECTED
    assert apply_rules(df).count() + len(rejected) == df.count()


def test_rejects_catch_values_no_rule_can_decide(spark):
    df = spark.createDataFrame([(1, "n", None, "d", 1.0)], VISIT)
    assert apply_rules(df).count() == 0
    assert rejects(df).first().reject_reasons == ["age_out_of_range"]


@pytest.fixture
def dated(spark):
    days = [None, *(dt.date(2023, 6, d) for d in (11, 12, 13))]
    return spark.createDataFrame([(d,) for d in days], "visit_date date")


@pytest.mark.parametrize("mark", ["2023-06-11", dt.date(2023, 6, 11), dt.datetime(2023, 6, 11, 9)])
def test_after_is_strict(dated, mark):
    assert sorted(r[0].day for r in after(dated, mark).collect()) == [12, 13]


def test_without_a_mark_null_dates_stay(dated):
    assert after(dated, None).count() == after(dated, "").count() == 4


def test_range_is_inclusive_and_each_end_optional(dated):
    def days(**ends):
        return sorted(r[0].day for r in between_dates(dated, **ends).collect())

    assert days(start="2023-06-12") == [12, 13]
    assert days(end="2023-06-12") == [11, 12]
    assert days(start="2023-06-12", end="2023-06-12") == [12]
    assert between_dates(dated).count() == 4


def test_malformed_mark_fails_before_a_job(dated):
    with pytest.raises(ValueError, match="2024-01-31"):
        after(dated, "last tuesday")
    with pytest.raises(ValueError):
        parse_mark(20240101)


def test_mark_before_latest(dated):
    assert sorted(r[0].day for r in after(dated, mark_before_latest(dated, 1)).collect()) == [13]


def test_days_back_counts_from_today(spark):
    row = spark.range(1).select(F.current_date().alias("t"), days_back(3).alias("m")).first()
    assert row.t - row.m == dt.timedelta(days=3)
