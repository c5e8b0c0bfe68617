"""Marks from folder names and footers, files that differ in types, profiles and trends."""

import datetime as dt
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from samples import HEADER, SEQUEL, day

from tristrata.operators import add_profile, calendar_trend, profile_by_day, united
from tristrata.operators.aggregate import exact_sum
from tristrata.plans.insights import summary, total_revenue
from tristrata.sources import latest_date, read_bronze, read_visits, write_bronze
from tristrata.sources.evolution import common_schema, wider
from tristrata.sources.layers import greatest_date


def rows(df):
    return sorted(map(repr, df.collect()))


# --- marks


@pytest.mark.parametrize("layout", ["day", "month"])
@pytest.mark.parametrize("load", [None, "007"])
def test_the_newest_date_of_bronze(spark, csv_file, tmp_path, layout, load):
    path = str(tmp_path / "b")
    assert latest_date(spark, path) is None
    visits = read_visits(spark, csv_file(SEQUEL + "9,A,1,d,,1.0\n8,B,1,d,2023-05-30,1.0\n"))
    write_bronze(visits, path, layout=layout, load_id=load)
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    assert latest_date(spark, path) == day(16)
    jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - before
    assert jobs <= (0 if layout == "day" else 2)


def test_the_newest_date_reads_no_column(spark, csv_file, tmp_path, plan):
    path = str(tmp_path / "b")
    write_bronze(read_visits(spark, csv_file(SEQUEL)), path, layout="month")
    text = plan(greatest_date(spark, [f"{path}/visit_month=2023-06"]))
    assert "PushedAggregation: [MAX(visit_date)]" in text
    assert re.findall(r"ReadSchema: (.*)", text) == ["struct<max(visit_date):date>"]


def test_undated_rows_alone_have_no_newest_date(spark, csv_file, tmp_path):
    for layout in ("day", "month"):
        path = str(tmp_path / layout)
        write_bronze(read_visits(spark, csv_file(HEADER + "1,A,2,d,,3.0\n")), path, layout=layout)
        assert latest_date(spark, path) is None


# --- evolution


def layer(spark, path, *batches):
    for values, kind in batches:
        frame = spark.createDataFrame([(v, day(1 + k)) for k, v in enumerate(values)], f"v {kind}, visit_date date")
        write_bronze(frame, path)
    return read_bronze(spark, path)


@pytest.mark.parametrize(
    "batches, kind, values",
    [
        ([([1, 2], "int"), ([2**40], "long")], "bigint", [1, 2, 2**40]),
        ([([2**40], "long"), ([1], "int"), ([5], "smallint")], "bigint", [1, 5, 2**40]),
        ([([7], "int"), ([0.5], "double")], "double", [0.5, 7.0]),
        ([([1], "int"), ([2**40], "long"), ([3], "int"), ([2**41], "long")], "bigint", [1, 3, 2**40, 2**41]),
    ],
)
def test_files_of_several_types_are_read_as_one(spark, tmp_path, batches, kind, values):
    found = layer(spark, str(tmp_path / "b"), *batches)
    assert dict(found.dtypes)["v"] == kind
    assert sorted(r.v for r in found.collect()) == values
    assert dict(found.dtypes)["visit_date"] == "date"
    ranged = read_bronze(spark, str(tmp_path / "b"), start="2023-06-02")
    assert all(r.visit_date > day(1) for r in ranged.collect())


@pytest.mark.parametrize("other", [("x", "string"), (0.5, "double")])
def test_unsafe_pairs_still_raise(spark, tmp_path, other):
    value, kind = other
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMA"):
        layer(spark, str(tmp_path / "b"), ([2**40], "long"), ([value], kind)).collect()


def test_columns_that_differ_in_type_and_columns_that_are_new(spark, tmp_path):
    path = str(tmp_path / "b")
    write_bronze(spark.createDataFrame([(1, 1, day(1))], "id int, a int, visit_date date"), path)
    write_bronze(spark.createDataFrame([(2, "n", day(1))], "id long, b string, visit_date date"), path)
    found = read_bronze(spark, path).select("id", "a", "b")
    assert rows(found) == ["Row(id=1, a=1, b=None)", "Row(id=2, a=None, b='n')"]


def test_least_common_types():
    assert wider(T.ByteType(), T.ShortType()) == T.ShortType()
    assert wider(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.IntegerType(), T.FloatType()) is None
    assert wider(T.LongType(), T.DoubleType()) is None
    assert wider(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    assert wider(T.IntegerType(), T.DecimalType(5, 2)) == T.DecimalType(12, 2)
    assert wider(T.DecimalType(38, 0), T.DecimalType(38, 10)) is None
    assert wider(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert wider(T.DateType(), T.StringType()) is None
    one = T.StructType([T.StructField("a", T.IntegerType())])
    assert common_schema([one, T.StructType([T.StructField("a", T.StringType())])]) is None


# --- profiles


def test_united_profiles_are_those_of_all_rows(spark, tmp_path):
    rng, path = random.Random(2), str(tmp_path / "p")
    visits = [
        (rng.choice([None, *range(3000)]), "n", rng.choice([None, "d"]), day(rng.randrange(1, 29)), rng.gauss(50, 20))
        for _ in range(20_000)
    ]
    visits += [(1, None, "d", None, None), (2, "n", "d", day(3), float("nan"))]
    ddl = "patient_id int, name string, diagnosis string, visit_date date, billing_amount double"
    frame = spark.createDataFrame(visits, ddl)
    for part in (frame.where("patient_id % 2 = 0"), frame.where("not coalesce(patient_id % 2 = 0, false)")):
        add_profile(profile_by_day(part), path)
    profiles = spark.read.parquet(path)
    for start, end in ((None, None), ("2023-06-05", "2023-06-11"), ("2023-06-28", None)):
        found = united(profiles, start, end).first()
        mine = [v for v in visits if (start is None or (v[3] and str(v[3]) >= start)) and (end is None or (v[3] and str(v[3]) <= end))]
        assert found["rows"] == len(mine)
        assert found["null_diagnosis"] == sum(v[2] is None for v in mine)
        keys = len({v[0] for v in mine if v[0] is not None})
        assert abs(found["keys"] - keys) <= 0.05 * keys
        amounts = sorted(v[4] for v in mine if v[4] is not None and v[4] == v[4])
        assert (found["least"], found["greatest"]) == (amounts[0], amounts[-1])
        for q in (10, 50, 90):
            rank = sum(a <= found[f"q{q}"] for a in amounts) / len(amounts)
            assert abs(rank - q / 100) < 0.03


def test_a_profile_of_nothing(spark, tmp_path):
    ddl = "patient_id int, name string, diagnosis string, visit_date date, billing_amount double"
    profile = profile_by_day(spark.createDataFrame([], ddl))
    row = united(profile).first()
    assert (row["rows"], row["keys"], row["q50"], row["least"]) == (0, 0, None, None)
    only_missing = spark.createDataFrame([(None, None, None, None, None)], ddl)
    row = united(profile_by_day(only_missing)).first()
    assert (row["rows"], row["null_name"], row["keys"], row["q90"]) == (1, 1, 0, None)
    assert united(profile_by_day(only_missing), "2020-01-01").first()["rows"] == 0


# --- trends


def test_months_without_visits_are_zero(spark):
    visits = [
        ("a", dt.date(2021, 11, 3), 10.0),
        ("a", dt.date(2022, 1, 9), 0.1),
        ("a", dt.date(2022, 1, 30), 0.2),
        ("a", dt.date(2022, 11, 1), 4.0),
        ("b", dt.date(2022, 3, 1), None),
        (None, dt.date(2022, 2, 2), 7.0),
        ("b", None, 99.0),
    ]
    frame = spark.createDataFrame(visits, "diagnosis string, visit_date date, billing_amount double")
    found = {(r.diagnosis, r.visit_month): r for r in calendar_trend(frame).collect()}
    assert len(found) == 3 * 13
    january = found["a", dt.date(2022, 1, 1)]
    assert (january.visits, january.total_billing, january.trailing_visits) == (2, 0.3, 3)
    assert january.trailing_billing == pytest.approx(10.3) and january.change_on_year is None
    assert found["a", dt.date(2022, 11, 1)].change_on_year == -6.0
    assert found["b", dt.date(2022, 3, 1)].visits == 1
    empty = found[None, dt.date(2022, 8, 1)]
    assert (empty.visits, empty.total_billing, empty.trailing_billing) == (0, 0.0, 0.0)
    assert calendar_trend(frame.limit(0)).count() == 0


def test_trailing_months_against_sql(spark):
    rng = random.Random(6)
    visits = [
        (rng.choice("xyz"), dt.date(2019 + rng.randrange(3), rng.choice([1, 2, 7, 8, 12]), rng.randrange(1, 28)), rng.randrange(1, 400) / 4)
        for _ in range(300)
    ]
    frame = spark.createDataFrame(visits, "diagnosis string, visit_date date, billing_amount double")
    found = calendar_trend(frame, trailing=5).select("diagnosis", "visit_month", "trailing_billing").collect()
    connection = duckdb.connect()
    connection.register("visits", frame.toPandas())
    for r in found:
        sql = (
            "SELECT coalesce(sum(billing_amount), 0) FROM visits WHERE diagnosis = ? "
            "AND visit_date >= ? - INTERVAL 4 MONTH AND visit_date < ? + INTERVAL 1 MONTH"
        )
        assert connection.execute(sql, [r[0], r[1], r[1]]).fetchone()[0] == pytest.approx(r[2])


# --- totals


def total(spark, values):
    return spark.createDataFrame([(v,) for v in values], "a double").agg(exact_sum("a")).first()[0]


def test_totals_do_not_depend_on_the_order_of_addends(spark):
    assert total(spark, [0.1, 0.2, 0.3]) == total(spark, [0.3, 0.2, 0.1]) == 0.6
    rng = random.Random(1)
    values = [rng.randrange(-(10**9), 10**9) / 10 ** rng.randrange(7) for _ in range(500)]
    values += [rng.randrange(-(10**12), 10**12) / 1e12 for _ in range(100)]
    sums = set()
    for _ in range(3):
        rng.shuffle(values)
        sums.add(total(spark, values))
    assert len(sums) == 1


def test_small_and_odd_amounts_are_not_rounded_away(spark):
    assert total(spark, [4e-7] * 1000) == 0.0004
    assert total(spark, [1e-12, 5.0]) == 5.000000000001
    assert total(spark, [1e300, 1.0]) == 1e300
    assert total(spark, [1 / 3]) == 1 / 3
    assert total(spark, [float("inf"), 1.0]) == float("inf")
    assert str(total(spark, [float("nan"), 1.0])) == "nan"
    assert total(spark, []) is None and total(spark, [None]) is None
    assert total(spark, [-0.25, 0.25]) == 0.0


def test_revenue_does_not_depend_on_the_order_of_groups(spark):
    ddl = "diagnosis string, total_billing double"
    for values in ((0.1, 0.2, 0.3), (0.3, 0.2, 0.1)):
        gold = spark.createDataFrame(list(zip("abc", values, strict=True)), ddl).coalesce(1)
        assert total_revenue(gold).first()[0] == summary(gold).first().total_revenue == 0.6
