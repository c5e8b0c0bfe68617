"""Runs whose work follows the load: ledger, buckets of silver, gold from changes."""

import datetime as dt
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tristrata.operators import by_group
from tristrata.operators.changes import SIGN, groups_of, merged, state_of
from tristrata.plans import advance, build_silver, clean, take_files
from tristrata.plans.catalogue import GOLD_COLUMNS
from tristrata.plans.layers import rank_groups
from tristrata.schema import SILVER_AT, VISIT_SCHEMA
from tristrata.sources import (
    ledger,
    read_bronze,
    read_malformed,
    read_rejects,
    read_silver,
    read_visits,
    versions,
)

DDL = "patient_id int, name string, age int, diagnosis string, visit_date date, billing_amount double"
FIRST = dt.date(2022, 2, 1)


def text_of(rows):
    """Visits as a headered delimited file; None is an empty field."""
    lines = [",".join("" if v is None else str(v) for v in r) for r in rows]
    return "\n".join([",".join(VISIT_SCHEMA.names), *lines]) + "\n"


def made(rng, n, patients, span=60):
    """Visits with missing, blank and refused values, of few patients so that they come back."""
    return [
        (
            rng.choice([None, *range(patients)]),
            rng.choice([None, "Ada ", "Bo"]),
            rng.choice([None, 0, 33, 150, 151, -1]),
            rng.choice([None, "gout", " Flu", "flu "]),
            FIRST + dt.timedelta(rng.randrange(span)),
            rng.choice([None, 0.1, 0.2, 12.35, 4e-7, -2.0]),
        )
        for _ in range(n)
    ]


def rows(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


def stored_bytes(path):
    return sum(p.stat().st_size for p in Path(path).rglob("*.parquet"))


def put(folder, name, visits):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text_of(visits))


def test_layers_equal_a_rebuild_after_every_load(spark, tmp_path):
    """Patients come back, with other groups too; files stay where they are."""
    rng, files, root = random.Random(21), tmp_path / "files", str(tmp_path / "out")
    columns = VISIT_SCHEMA.names
    for load in range(3):
        put(files, f"load{load}.csv", made(rng, 60, 25))
        result = advance(spark, str(files), root, buckets=5)
        assert result.metrics[0].row_count == 60
        bronze = read_bronze(spark, f"{root}/bronze")
        assert bronze.count() == 60 * (load + 1)
        whole = str(tmp_path / f"rebuilt{load}")
        bronze.drop("load_id").write.parquet(f"{whole}/bronze")
        built, _ = build_silver(spark, f"{whole}/bronze", f"{whole}/silver")
        silver = read_silver(spark, f"{root}/silver")
        assert rows(silver, columns) == rows(built, columns)
        gold = rank_groups(by_group(built)).select(*GOLD_COLUMNS, "billing_rank")
        last = rows(result.gold, GOLD_COLUMNS)
        assert rows(result.gold, gold.columns) == rows(gold, gold.columns)
    refused = {r.patient_id for r in read_rejects(spark, f"{root}/silver").collect()}
    valid = bronze.transform(clean).count()
    assert read_rejects(spark, f"{root}/silver").count() == 180 - valid and refused
    again = advance(spark, str(files), root)
    assert [m.row_count for m in again.metrics[:2]] == [0, 0]
    assert rows(again.gold, GOLD_COLUMNS) == last


@pytest.mark.parametrize("step", ["tristrata.sources.ledger.finish", "tristrata.sources.versions.publish"])
def test_a_run_that_fails_is_taken_up_by_the_next(spark, tmp_path, monkeypatch, step):
    rng, files, root = random.Random(4), tmp_path / "files", str(tmp_path / "out")
    first, second, third = (made(rng, 30, 9) for _ in range(3))
    put(files, "a.csv", first)
    advance(spark, str(files), root, buckets=3)
    put(files, "b.csv", second)
    before = rows(read_silver(spark, f"{root}/silver"), VISIT_SCHEMA.names)
    with monkeypatch.context() as patch:
        patch.setattr(step, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            advance(spark, str(files), root)
    assert rows(read_silver(spark, f"{root}/silver"), VISIT_SCHEMA.names) == before
    put(files, "c.csv", third)
    result = advance(spark, str(files), root)
    whole = tmp_path / "whole"
    put(whole, "all.csv", first + second + third)
    expected = advance(spark, str(whole), str(tmp_path / "one"))
    assert rows(result.gold, GOLD_COLUMNS) == rows(expected.gold, GOLD_COLUMNS)
    assert read_bronze(spark, f"{root}/bronze").count() == 90


def test_a_file_is_taken_once_and_a_changed_one_again(spark, tmp_path):
    files, bronze, book = tmp_path / "files", str(tmp_path / "b"), str(tmp_path / "l")
    put(files, "a.csv", [(1, "n", 1, "d", FIRST, 1.0)])
    counts = []
    for _ in range(2):
        counts.append(take_files(spark, str(files), bronze, book).row_count)
    put(files, "a.csv", [(1, "n", 1, "d", FIRST, 1.0), (2, "n", 1, "d", FIRST, 1.0)])
    counts.append(take_files(spark, str(files / "*.csv"), bronze, book).row_count)
    assert counts == [1, 0, 2]
    assert len(ledger.finished(spark, book)) == 2


def test_an_unfinished_load_keeps_its_mark_and_loses_files_that_are_gone(spark, tmp_path, monkeypatch):
    files, bronze, book = tmp_path / "files", str(tmp_path / "b"), str(tmp_path / "l")
    late = FIRST + dt.timedelta(9)
    put(files, "a.csv", [(1, "n", 1, "d", FIRST, 1.0), (2, "n", 1, "d", late, 1.0)])
    put(files, "b.csv", [(3, "n", 1, "d", late, 1.0)])
    with monkeypatch.context() as patch:
        patch.setattr("tristrata.sources.ledger.finish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            take_files(spark, str(files), bronze, book, FIRST.isoformat())
    (files / "b.csv").unlink()
    assert take_files(spark, str(files), bronze, book).row_count == 1
    assert [r.patient_id for r in read_bronze(spark, bronze).collect()] == [2]


def test_bytes_written_follow_the_load(spark, tmp_path):
    """One patient out of 20,000 comes back: one bucket of 32 is written, the rest is kept."""
    files, root = tmp_path / "files", str(tmp_path / "out")
    patients = [(k, f"name {k * 7919}", k % 90, "abcd"[k % 4], FIRST, k / 100) for k in range(20_000)]
    put(files, "all.csv", patients)
    advance(spark, str(files), root, buckets=32)
    table = stored_bytes(f"{root}/silver")
    before = {p: p.stat().st_mtime_ns for p in Path(root, "silver").rglob("*.parquet")}
    put(files, "one.csv", [(77, "other", 5, "z", FIRST + dt.timedelta(1), 5.0)])
    result = advance(spark, str(files), root)
    after = {p: p.stat().st_mtime_ns for p in Path(root, "silver").rglob("*.parquet")}
    new = [p for p in after if before.get(p) != after[p]]
    assert sum(p.stat().st_size for p in new) < table / 10
    silver = read_silver(spark, f"{root}/silver")
    assert silver.count() == 20_000
    assert silver.where("patient_id = 77").first().diagnosis == "Z"
    stamps = silver.groupBy(SILVER_AT).count().collect()
    assert sorted(r["count"] for r in stamps) == [1, 19_999]
    by_name = {r.diagnosis: r.patient_count for r in result.gold.collect()}
    assert by_name == {"A": 5000, "B": 4999, "C": 5000, "D": 5000, "Z": 1}
    advance(spark, str(files), root)
    put(files, "two.csv", [(78, "other", 5, "z", FIRST + dt.timedelta(1), 5.0)])
    advance(spark, str(files), root)  # what the run before last replaced is gone
    folders = versions.current(spark, f"{root}/silver").buckets
    left = [p for p in Path(root, "silver").glob("version=*/kind=silver/bucket=*")]
    assert len(left) <= len(folders) + 1


def scans(plan, kind):
    return plan.count(f"Scan {kind}")


def test_the_source_and_the_load_are_read_once(spark, tmp_path, monkeypatch):
    """Good, malformed and rejected rows: one scan of the files and one of the load."""
    module = sys.modules["tristrata.plans.advance"]
    plain, plans = module.write_layer, {}

    def seen(df, path, operation, *args, **options):
        plans[operation] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, path, operation, *args, **options)

    monkeypatch.setattr(module, "write_layer", seen)
    files, root = tmp_path / "files", str(tmp_path / "out")
    put(
        files,
        "a.csv",
        [
            (1, "n", "old", "d", FIRST, 1.0),  # malformed, and a valid visit of age 0
            (2, "n", 151, "d", FIRST, 1.0),
            (2, "n", 151, "d", FIRST, 1.0),
            (3, "n", 20, "d", "someday", -1.0),
            (4, "n", 20, "d", FIRST, 1.0),
        ],
    )
    advance(spark, str(files), root)
    assert scans(plans["bronze"], "csv") == 1
    assert scans(plans["load"], "parquet") == 1 and "csv" not in plans["load"]
    assert {x for x in plans if "csv" in plans[x].lower()} == {"bronze"}
    lines = [r.raw_line.split(",")[0] for r in read_malformed(spark, f"{root}/bronze").collect()]
    assert sorted(lines) == ["1", "3"]
    refused = [(r.patient_id, r.reject_reasons) for r in read_rejects(spark, f"{root}/silver").collect()]
    assert sorted(refused) == [
        (2, ["age_out_of_range"]),
        (2, ["age_out_of_range"]),
        (3, ["negative_billing"]),
    ]
    assert sorted(r.patient_id for r in read_silver(spark, f"{root}/silver").collect()) == [1, 4]
    put(files, "b.csv", [(5, "n", "x", "d", FIRST, 1.0)])
    advance(spark, str(files), root, since=FIRST)  # not after the mark, but its line stays
    assert read_malformed(spark, f"{root}/bronze").count() == 3
    assert read_silver(spark, f"{root}/silver").count() == 2


def test_empty_sources_and_missing_ones(spark, tmp_path):
    files, root = tmp_path / "files", str(tmp_path / "out")
    files.mkdir()
    result = advance(spark, str(files), root)
    assert result.gold.count() == 0 and read_silver(spark, f"{root}/silver").count() == 0
    put(files, "none.csv", [])
    result = advance(spark, str(files), root)
    assert [m.row_count for m in result.metrics] == [0, 0, 0]
    put(files, "bad.csv", [(1, "n", 151, "d", FIRST, 1.0)])
    assert advance(spark, str(files), root).gold.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        advance(spark, str(tmp_path / "no-such-folder"), root)
    put(files, "good.csv", [(None, None, None, None, None, None)])
    row = advance(spark, str(files), root).gold.first()
    assert (row.diagnosis, row.total_billing, row.patient_count, row.first_visit) == ("UNKNOWN", 0.0, 0, None)


def test_later_files_may_have_a_column_more(spark, tmp_path):
    files, root = tmp_path / "files", str(tmp_path / "out")
    put(files, "a.csv", [(1, "n", 1, "d", FIRST, 1.0), (2, "n", 1, "d", FIRST, 1.0)])
    advance(spark, str(files), root)
    (files / "b.csv").write_text(
        ",".join([*VISIT_SCHEMA.names, "doctor_id"]) + f"\n2,n,1,e,{FIRST + dt.timedelta(1)},1.0,D-4\n"
    )
    schema = read_visits(spark, str(files)).select(*VISIT_SCHEMA.names, F.lit("").alias("doctor_id"))
    advance(spark, str(files), root, schema=schema.schema)
    found = read_silver(spark, f"{root}/silver").select("patient_id", "diagnosis", "doctor_id")
    assert rows(found, found.columns) == sorted(
        map(repr, spark.createDataFrame([(1, "D", None), (2, "E", "D-4")], found.schema).collect())
    )


# --- states


def test_states_take_rows_back(spark):
    rng = random.Random(8)
    visits = [
        (
            rng.choice([None, *range(50)]),
            "n",
            rng.choice([None, *range(0, 90, 7)]),
            rng.choice([None, "a", "b", "c"]),
            rng.choice([None, FIRST, FIRST + dt.timedelta(3), FIRST + dt.timedelta(400)]),
            rng.choice([None, 0.1, 0.2, 0.3, 1e-9, 123456.25, 7.0]),
        )
        for _ in range(400)
    ]
    frame = spark.createDataFrame(visits, DDL)
    kept = frame.where("coalesce(patient_id, 1) % 2 = 0 and diagnosis <> 'c'")
    gone = frame.where("not coalesce(coalesce(patient_id, 1) % 2 = 0 and diagnosis <> 'c', false)")
    came = state_of(frame.withColumn(SIGN, F.lit(1)))
    went = state_of(gone.withColumn(SIGN, F.lit(-1)))
    left = groups_of(merged(came, went))
    expected = by_group(kept)
    assert rows(left, expected.columns) == rows(expected, expected.columns)
    assert dict(left.dtypes) == dict(expected.dtypes)
    assert rows(groups_of(came), expected.columns) == rows(by_group(frame), expected.columns)
    assert groups_of(merged(came, state_of(frame.withColumn(SIGN, F.lit(-1))))).count() == 0


def test_a_state_does_not_grow_with_the_rows(spark):
    visit = spark.range(5000).select(
        (F.col("id") % 997).cast("int").alias("patient_id"),
        F.lit("n").alias("name"),
        (F.col("id") % 10).cast("int").alias("age"),
        F.lit("d").alias("diagnosis"),
        F.lit(FIRST).alias("visit_date"),
        (F.col("id") / 100).alias("billing_amount"),
        F.lit(1).alias(SIGN),
    )
    assert state_of(visit).count() == 1 + 10 + 1
