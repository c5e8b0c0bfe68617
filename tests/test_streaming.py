import os
from pathlib import Path

from samples import OPENING, SEQUEL

from tristrata.sources import read_bronze, read_visits
from tristrata.streaming import stream_bronze


def load(spark, root, **options):
    query = stream_bronze(
        spark, f"{root}/in", f"{root}/bronze", f"{root}/checkpoint", **options
    )
    query.awaitTermination()
    return read_bronze(spark, f"{root}/bronze")


def test_each_file_is_ingested_once(spark, csv_file, tmp_path):
    csv_file(OPENING, "in/a.csv")
    assert load(spark, tmp_path).count() == 5
    assert load(spark, tmp_path).count() == 5  # nothing new
    csv_file(SEQUEL, "in/b.csv")
    rows = load(spark, tmp_path)
    assert rows.count() == 13
    assert {r.source_file for r in rows.collect()} == {"a.csv", "b.csv"}
    batch = read_visits(spark, f"{tmp_path}/in")
    assert set(rows.columns) == {*batch.columns, "load_id"}
    ids = sorted(r.patient_id for r in rows.collect())
    assert ids == sorted(r.patient_id for r in batch.collect())


def test_micro_batches_can_be_bounded(spark, csv_file, tmp_path):
    for i in range(3):
        csv_file(OPENING, f"in/{i}.csv")
    assert load(spark, tmp_path, max_files=1, layout="month").count() == 15
    assert read_bronze(spark, f"{tmp_path}/bronze", start="2023-06-12").count() == 9


def test_files_that_are_older_than_the_newest_are_taken(spark, csv_file, tmp_path):
    csv_file(OPENING, "in/a.csv")
    load(spark, tmp_path)
    late = csv_file(SEQUEL, "in/b.csv")
    os.utime(late, (1_000_000_000, 1_000_000_000))
    assert load(spark, tmp_path).count() == 13


def test_a_repeated_batch_replaces_itself(spark, csv_file, tmp_path):
    csv_file(OPENING, "in/a.csv")
    load(spark, tmp_path)
    for state in (tmp_path / "checkpoint/commits").iterdir():  # as if it had failed at the end
        state.unlink()
    assert load(spark, tmp_path).count() == 5
    files = [p for p in Path(tmp_path, "bronze").rglob("*.parquet")]
    assert len(files) == 3  # one for each date


def test_loads_are_named_by_the_checkpoint_or_the_caller(spark, csv_file, tmp_path):
    csv_file(OPENING, "in/a.csv")
    [(named,)] = load(spark, tmp_path).select("load_id").distinct().collect()
    kept = (tmp_path / "checkpoint/load_name").read_text()
    assert named == f"stream-{kept}-0"
    csv_file(SEQUEL, "in/b.csv")
    loads = {r.load_id for r in load(spark, tmp_path, name="evening").collect()}
    assert loads == {named, "stream-evening-1"}
