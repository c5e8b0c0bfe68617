import datetime as dt
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from samples import CORRUPT, OPENING, SEQUEL, WITH_DOCTOR, day

from tristrata.schema import BRONZE_SCHEMA, SILVER_SCHEMA, VISIT_SCHEMA
from tristrata.sources import (
    evolve,
    malformed,
    read_bronze,
    read_silver,
    read_visits,
    scratch_path,
    store,
    write_bronze,
    write_silver,
)
from tristrata.sizes import Size, measure

DOCTOR_SCHEMA = T.StructType(VISIT_SCHEMA.fields + [T.StructField("doctor_id", T.StringType())])


def test_declared_schema():
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in VISIT_SCHEMA] == [
        ("patient_id", "int", True),
        ("name", "string", True),
        ("age", "int", True),
        ("diagnosis", "string", True),
        ("visit_date", "date", True),
        ("billing_amount", "double", True),
    ]


def test_read_visits_adds_lineage(spark, csv_file):
    df = read_visits(spark, csv_file(OPENING, "patients.csv"))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in BRONZE_SCHEMA
    ]
    rows = df.orderBy("patient_id").collect()
    assert [r.patient_id for r in rows] == [127, 315, 488, 760, 902]
    assert rows[4].age is None and rows[2].billing_amount is None
    assert {r.source_file for r in rows} == {"patients.csv"}
    assert rows[0].ingestion_timestamp is not None


def test_source_file_is_right_for_folders_and_globs(spark, csv_file):
    folder = Path(csv_file(OPENING, "in/a.csv")).parent
    csv_file(SEQUEL, "in/b.csv")
    for path in (str(folder), f"{folder}/*.csv"):
        counts = read_visits(spark, path).groupBy("source_file").count()
        assert {tuple(r) for r in counts.collect()} == {("a.csv", 5), ("b.csv", 8)}


def test_incremental_read(spark, csv_file):
    assert read_visits(spark, csv_file(OPENING), since="2023-06-11").count() == 3


def test_missing_file_raises(spark):
    with pytest.raises(AnalysisException):
        read_visits(spark, "/tmp/no-such-file.csv")


def test_malformed_values_become_null(spark, csv_file):
    rows = read_visits(spark, csv_file(CORRUPT)).orderBy("patient_id").collect()
    assert (rows[0].age, rows[0].billing_amount) == (None, 20.0)
    assert (rows[1].visit_date, rows[1].billing_amount) == (None, 15.5)
    assert (rows[2].age, rows[2].billing_amount) == (44, 12.25)
    assert (rows[3].age, rows[3].billing_amount) == (None, None)


def test_short_rows_are_padded_and_extra_values_dropped(spark, csv_file):
    text = "patient_id,name,age,diagnosis,visit_date,billing_amount\n1,A\n2,B,3,D,2023-06-11,4,x\n"
    short, long = read_visits(spark, csv_file(text)).orderBy("patient_id").collect()
    assert (short.name, short.age, short.billing_amount) == ("A", None, None)
    assert long.billing_amount == 4.0


def test_header_order_is_checked_on_request(spark, csv_file):
    text = "name,patient_id,age,diagnosis,visit_date,billing_amount\nA,1,2,D,2023-06-11,3\n"
    path = csv_file(text)
    assert read_visits(spark, path).first().patient_id is None  # bound by position
    with pytest.raises(Exception, match="(?i)header"):
        read_visits(spark, path, strict_header=True).collect()


def test_malformed_lines_can_be_kept(spark, csv_file):
    df = read_visits(spark, csv_file(CORRUPT), corrupt_column="raw_line")
    assert sorted(r.raw_line.split(",")[0] for r in malformed(df, "raw_line").collect()) == [
        "610",
        "611",
        "613",
    ]


@pytest.mark.parametrize("layout", ["day", "month"])
def test_bronze_roundtrip_and_range(spark, csv_file, tmp_path, layout):
    path = str(tmp_path / "bronze")
    visits = read_visits(spark, csv_file(OPENING + "9,Z,1,D,,5\n8,Y,1,D,2024-02-10,5\n"))
    assert write_bronze(visits, path, layout=layout).row_count == 7
    back = read_bronze(spark, path)
    assert back.schema["visit_date"].dataType == T.DateType()
    assert set(back.columns) == set(BRONZE_SCHEMA.names)
    columns = VISIT_SCHEMA.names

    def rows(df):
        return sorted(map(repr, df.select(*columns).collect()))

    assert rows(back) == rows(visits)

    def ids(**ends):
        return sorted(r.patient_id for r in read_bronze(spark, path, **ends).collect())

    assert ids(start="2023-06-12") == [8, 488, 760, 902]
    assert ids(start="2023-06-12", end="2023-06-12") == [902]
    assert ids(end=dt.date(2023, 6, 11)) == [127, 315]
    assert ids(start=F.lit("2024-02-01").cast("date")) == [8]


def test_append_adds_and_overwrite_replaces(spark, csv_file, tmp_path):
    path, visits = str(tmp_path / "b"), read_visits(spark, csv_file(OPENING))
    write_bronze(visits, path)
    write_bronze(visits, path)
    assert read_bronze(spark, path).count() == 10
    write_bronze(visits, path, mode="overwrite")
    assert read_bronze(spark, path).count() == 5


def test_replace_touches_only_the_dates_present(spark, csv_file, tmp_path):
    path, visits = str(tmp_path / "b"), read_visits(spark, csv_file(OPENING))
    write_bronze(visits, path)
    resent = visits.filter("visit_date = '2023-06-11'").withColumn("age", F.lit(99))
    for _ in range(2):
        write_bronze(resent, path, mode="replace")
    ages = {r.patient_id: r.age for r in read_bronze(spark, path).collect()}
    assert ages == {127: 99, 315: 99, 488: 7, 760: 0, 902: None}


def test_undated_rows_of_other_loads_survive_a_replacement(spark, tmp_path):
    path, ddl = str(tmp_path / "b"), "patient_id int, visit_date date"
    write_bronze(spark.createDataFrame([(1, None), (2, day(11))], ddl), path)
    resent = spark.createDataFrame([(3, None), (4, day(11)), (5, day(12))], ddl)
    assert write_bronze(resent, path, mode="replace").row_count == 3
    assert sorted(r.patient_id for r in read_bronze(spark, path).collect()) == [1, 3, 4, 5]


def test_load_ids_stay_text_under_a_given_schema(spark, tmp_path):
    path = str(tmp_path / "b")
    rows = spark.createDataFrame([(1, day(11))], "patient_id int, visit_date date")
    write_bronze(rows, path, load_id="042")
    assert read_bronze(spark, path, schema=rows.schema).first().load_id == "042"


def test_months_are_not_replaced_for_a_single_date(spark, csv_file, tmp_path):
    visits = read_visits(spark, csv_file(OPENING))
    with pytest.raises(ValueError, match="day"):
        write_bronze(visits, str(tmp_path / "b"), mode="replace", layout="month")


def test_overwriting_does_not_depend_on_the_session_default(spark, tmp_path):
    path = str(tmp_path / "s")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        for kinds in ("AB", "A"):
            rows = [(i, kind) for i, kind in enumerate(kinds)]
            write_silver(spark.createDataFrame(rows, "id int, diagnosis string"), path)
    finally:
        spark.conf.set(key, before)
    assert [r.diagnosis for r in read_silver(spark, path).collect()] == ["A"]


def test_a_load_id_makes_reruns_idempotent(spark, csv_file, tmp_path):
    path, visits = str(tmp_path / "b"), read_visits(spark, csv_file(OPENING))
    write_bronze(visits, path, load_id="007")
    write_bronze(visits.filter("patient_id > 400"), path, load_id="008")
    write_bronze(visits.filter("patient_id > 400"), path, load_id="008")
    # A rerun with fewer dates leaves nothing of the first run behind.
    write_bronze(visits.filter("patient_id > 500"), path, load_id="008", mode="replace")
    loads = read_bronze(spark, path).groupBy("load_id").count().collect()
    assert {tuple(r) for r in loads} == {("007", 5), ("008", 2)}
    with pytest.raises(ValueError, match="load id"):
        write_bronze(visits, path, load_id="a/b")


def test_unknown_layout_fails(spark, csv_file, tmp_path):
    with pytest.raises(ValueError, match="layout"):
        write_bronze(read_visits(spark, csv_file(OPENING)), str(tmp_path), layout="year")


def test_schema_evolution_through_storage(spark, csv_file, tmp_path):
    path = str(tmp_path / "bronze")
    write_bronze(read_visits(spark, csv_file(OPENING)), path)
    newer = read_visits(spark, csv_file(WITH_DOCTOR, "new.csv"), schema=DOCTOR_SCHEMA)
    write_bronze(newer, path)
    doctors = {r.patient_id: r.doctor_id for r in read_bronze(spark, path).collect()}
    assert doctors.pop(551) == "house-3"
    assert doctors == dict.fromkeys([127, 315, 488, 760, 902])


def test_schema_evolution_of_frames(spark, csv_file):
    old = read_visits(spark, csv_file(OPENING))
    new = read_visits(spark, csv_file(WITH_DOCTOR, "new.csv"), schema=DOCTOR_SCHEMA)
    merged = evolve([old, new])
    assert merged.count() == 6
    assert merged.filter("doctor_id is not null").count() == 1


def test_conflicting_types_fail(spark, tmp_path):
    path = str(tmp_path / "b")
    for value, kind in ((1, "int"), ("x", "string")):
        df = spark.createDataFrame([(value, dt.date(2023, 6, 11))], f"v {kind}, visit_date date")
        write_bronze(df, path)
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMA"):
        read_bronze(spark, path).collect()


def test_partition_values_stay_text(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(1, "042"), (2, "1e3"), (3, None)], "id int, diagnosis string")
    write_silver(df, path)
    assert {tuple(r) for r in read_silver(spark, path).select("id", "diagnosis").collect()} == {
        (1, "042"),
        (2, "1e3"),
        (3, None),
    }


def test_empty_layers_read_as_empty(spark, tmp_path):
    path = str(tmp_path / "s")
    metric = write_silver(spark.createDataFrame([], SILVER_SCHEMA), path)
    assert metric.row_count == 0
    assert read_silver(spark, path).schema == SILVER_SCHEMA
    with pytest.raises(AnalysisException):
        read_silver(spark, str(tmp_path / "never-written"))


def test_a_known_schema_replaces_merging(spark, csv_file, tmp_path):
    path, visits = str(tmp_path / "b"), read_visits(spark, csv_file(OPENING))
    write_bronze(visits, path)
    narrow = T.StructType([BRONZE_SCHEMA["patient_id"], BRONZE_SCHEMA["visit_date"]])
    df = read_bronze(spark, path, start="2023-06-12", schema=narrow)
    assert df.columns == ["patient_id", "visit_date"]
    assert sorted(r.patient_id for r in df.collect()) == [488, 760, 902]


def test_few_files_per_partition_value(spark, tmp_path):
    """Rows of a value spread over all tasks end in one file, not one per task."""
    path = tmp_path / "b"
    date = F.date_add(F.lit("2023-06-11").cast("date"), (F.col("id") % 4).cast("int"))
    df = spark.range(0, 4000, 1, 16).select("id", date.alias("visit_date"))
    write_bronze(df, str(path))
    assert len(list(path.rglob("*.parquet"))) == 4


def test_only_a_local_session_may_use_a_temporary_folder():
    def session(master, folder=None):
        conf = SimpleNamespace(get=lambda key, default: folder)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    shared = scratch_path(session("spark://host:7077", "hdfs://name/ckpt/"), "x")
    assert shared.startswith("hdfs://name/ckpt/tristrata/x-")
    assert Path(scratch_path(session("local[2]"), "x")).parents[1].is_dir()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://host:7077"), "x")


def test_scratch_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two
    if base:
        assert one.startswith(base.rstrip("/"))


def test_store_counts_and_freezes(spark):
    df = spark.range(100).withColumn("noise", F.rand())
    stored, size = store(df, "noise")
    assert size == measure(stored) and size.rows == 100
    assert stored.agg(F.sum("noise")).first() == stored.agg(F.sum("noise")).first()
    empty, none = store(df.filter("id < 0"), "nothing")
    assert none == Size(0, 0) and empty.count() == 0
