"""A run whose work follows its load, not the layers: files once, some buckets, gold by changes.

1. Files that the ledger does not have become one load of bronze. One write routes each row of
   the source: visits after the mark, and lines that do not match the schema with their text.
2. The load's visits are cleaned, those that break a rule tagged, and the latest of each patient
   kept: one scan of the load and one write, by bucket of the patient id, rejects beside.
3. Only buckets that the load has a patient in are read from silver, merged with the load's
   visits and written anew. The same write keeps what changed: visits that came, with sign 1,
   and the ones they replace, with sign -1.
4. The changes are added to the state of the aggregates, and gold is made from the state.

A manifest names the version of each bucket, the loads in silver and the state together, so a
failed run changes nothing and the next one takes up its loads. Folders that a run replaces
stay until the next run is through, for readers that still use them.

Bronze only grows here, and silver equals a rebuild from all of bronze: the latest of the latest
is the latest. The number of buckets is fixed by the first run.
"""

import logging
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.functions.cleaning import fill_defaults, range_rules, standardize
from tristrata.functions.marks import Mark, settled
from tristrata.metrics import StepMetric
from tristrata.operators.audit import null_counts
from tristrata.operators.changes import SIGN, groups_of, merged, state_of
from tristrata.operators.dedup import latest_per_key, newest_first
from tristrata.plans.layers import LATEST, rank_groups
from tristrata.plans.run import RunResult
from tristrata.schema import BRONZE_SCHEMA, GOLD_AT, SILVER_AT, VISIT_SCHEMA
from tristrata.sources import ledger, versions
from tristrata.sources.layers import (
    BUCKET,
    KIND,
    LOAD,
    MONTH,
    RAW_LINE,
    by_date_layout,
    read_buckets,
    read_folders,
    read_gold,
    write_gold,
    write_layer,
)
from tristrata.sources.versions import VERSION, Manifest
from tristrata.sources.visits_csv import read_visits

log = logging.getLogger(__name__)

BUCKETS = 64
REASONS = "reject_reasons"
FRESH = "_fresh"
OWN = "_own"
ROW = "_row"


def routed(lines: DataFrame, since: str | None) -> DataFrame:
    """Each row once for every table it goes to, which ``kind`` names."""
    later = F.lit(True) if since is None else F.col("visit_date") > F.lit(since).cast("date")
    kinds = F.array(
        F.when(later, F.lit("visit")), F.when(F.col(RAW_LINE).isNotNull(), F.lit("malformed"))
    )
    rows = lines.withColumn(KIND, F.explode(F.array_compact(kinds)))
    return rows.withColumn(RAW_LINE, F.when(F.col(KIND) == "malformed", F.col(RAW_LINE)))


def take_files(
    spark: SparkSession,
    source: str | list[str],
    bronze_path: str,
    ledger_path: str,
    since: str | None = None,
    *,
    schema: T.StructType = VISIT_SCHEMA,
    layout: str = "day",
    rebalance: bool = True,
) -> StepMetric:
    """Take the files that the ledger does not have into bronze, each load in one pass.

    A load that a failed run began is taken again, with the mark of that run.
    """
    rows, seconds, malformed = 0, 0.0, 0
    for load in ledger.waiting(spark, ledger_path, source, since):
        lines = read_visits(spark, load.files, schema=schema, corrupt_column=RAW_LINE)
        table, date = by_date_layout(routed(lines, load.since), layout)
        count = [F.count_if(F.col(KIND) == k).alias(k) for k in ("visit", "malformed")]
        path = f"{bronze_path}/{LOAD}={load.load_id}"
        done = write_layer(
            table, path, "bronze", [KIND, date], "overwrite", rebalance, observe=count
        )
        ledger.finish(spark, ledger_path, load)
        rows, seconds = rows + done.observed.get("visit", 0), seconds + done.duration_seconds
        malformed += done.observed.get("malformed", 0)
    return StepMetric("bronze", rows, seconds, {"malformed": malformed})


def checked(visits: DataFrame) -> DataFrame:
    """Filled and standardized visits with the reasons to reject them; none for valid ones."""
    clean = visits.transform(fill_defaults).transform(standardize)
    failed = [
        F.when(~F.coalesce(valid, F.lit(False)), F.lit(reason))
        for reason, valid in range_rules().items()
    ]
    return clean.withColumn(REASONS, F.array_compact(F.array(*failed)))


def bucket_of(keys: tuple[str, ...], size: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(size)).cast("int")


def latest_of_load(
    visits: DataFrame, keys: tuple[str, ...], latest: tuple[str, ...], unique: bool, size: int
) -> DataFrame:
    """Valid visits, the latest of each key, and all others, told apart by ``kind``.

    A rejected row is a key of its own, so one pass keeps all of them and trims the valid ones
    before the shuffle.
    """
    valid = F.size(REASONS) == 0
    single = F.when(~valid, F.monotonically_increasing_id())
    tagged = checked(visits).withColumn(OWN, single)
    kept = latest_per_key(tagged, (*keys, OWN), latest, unique).drop(OWN)
    kinds = {
        KIND: F.when(valid, F.lit("latest")).otherwise(F.lit("rejected")),
        BUCKET: F.when(valid, bucket_of(keys, size)).otherwise(F.lit(-1)),
    }
    return kept.withColumns(kinds)


def with_changes(
    old: DataFrame, fresh: DataFrame, keys: tuple[str, ...], latest: tuple[str, ...], unique: bool
) -> DataFrame:
    """Rows of the merged silver and of its changes, told apart by ``kind``.

    ``old`` and ``fresh`` have one row for each key, so a key has two rows at most.
    """
    both = old.withColumn(FRESH, F.lit(False)).unionByName(
        fresh.withColumn(FRESH, F.lit(True)), allowMissingColumns=True
    )
    order = newest_first(both.drop(FRESH, SILVER_AT), keys, latest, unique)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.col(FRESH).asc()))
    first, new = F.col(ROW) == 1, F.col(FRESH)
    came, went = first & new, ~first & ~new
    kinds = F.array(
        F.when(first, F.lit("silver")), F.when(came | went, F.lit("change"))
    )
    rows = both.withColumn(ROW, place).withColumn(KIND, F.explode(F.array_compact(kinds)))
    sign = F.when(F.col(KIND) == "change", F.when(came, 1).otherwise(-1))
    return rows.withColumns({
        SIGN: sign,
        SILVER_AT: F.coalesce(F.col(SILVER_AT), F.current_timestamp()),
        BUCKET: F.when(F.col(KIND) == "change", F.lit(-1)).otherwise(F.col(BUCKET)),
    }).drop(ROW, FRESH)


def fold_loads(
    spark: SparkSession,
    bronze_path: str,
    ledger_path: str,
    silver_path: str,
    *,
    keys: tuple[str, ...] = ("patient_id",),
    latest: tuple[str, ...] = LATEST,
    unique: bool = False,
    buckets: int = BUCKETS,
    bronze_schema: T.StructType | None = None,
    rebalance: bool = True,
) -> tuple[Manifest, StepMetric]:
    """Fold the loads that bronze has and silver lacks into the buckets that they touch."""
    manifest = versions.current(spark, silver_path)
    if manifest.folder is not None:
        raise ValueError(f"{silver_path} holds a silver without buckets")
    size = manifest.size or buckets
    todo = [x for x in ledger.finished(spark, ledger_path) if x not in set(manifest.loads)]
    folders = [
        f"{bronze_path}/{LOAD}={x}/{KIND}=visit"
        for x in todo
        if f"{KIND}=visit" in versions.children(spark, f"{bronze_path}/{LOAD}={x}")
    ]
    if not folders:
        manifest = replace(manifest, size=size, loads=[*manifest.loads, *todo])
        if todo or not manifest.number:
            manifest = versions.publish(spark, silver_path, manifest)
        return manifest, StepMetric("silver", 0, 0.0)
    version = versions.new_version()
    root = f"{silver_path}/{VERSION}={version}"
    known = bronze_schema is not None
    visits = read_folders(spark, bronze_path, folders, bronze_schema or BRONZE_SCHEMA, known)
    visits = visits.drop(KIND, MONTH, LOAD, RAW_LINE)
    load = latest_of_load(visits, keys, latest, unique, size)
    kinds = [F.count_if(F.col(KIND) == k).alias(k) for k in ("latest", "rejected")]
    taken = write_layer(load, root, "load", [KIND, BUCKET], rebalance=rebalance, observe=kinds)
    if taken.observed.get("rejected"):
        log.info("quarantined %d rows", taken.observed["rejected"])

    stored = spark.read.schema(load.schema).parquet(root)
    fresh = stored.where(F.col(KIND) == "latest").drop(KIND, REASONS)
    names = versions.children(spark, f"{root}/{KIND}=latest")
    touched = [n.removeprefix(f"{BUCKET}=") for n in names if n.startswith(f"{BUCKET}=")]
    replaced = [b for b in touched if b in manifest.buckets]
    if replaced:
        old = read_buckets(spark, silver_path, manifest, replaced)
    else:
        stamp = T.StructField(SILVER_AT, T.TimestampType())
        fields = fresh.drop(BUCKET).schema.fields
        old = spark.createDataFrame([], T.StructType([*fields, stamp]))
    merge = with_changes(old.withColumn(BUCKET, bucket_of(keys, size)), fresh, keys, latest, unique)
    kinds = [F.count_if(F.col(KIND) == k).alias(k) for k in ("silver", "change")]
    nulls = null_counts(only=F.col(KIND) == "silver")
    metric = write_layer(
        merge, root, "silver", [KIND, BUCKET], "append", rebalance, observe=[*kinds, *nulls]
    )
    for name, count in metric.observed.items():
        if name.startswith("null_") and count:
            log.warning("silver has %d NULLs (%s)", count, name)

    changes = spark.read.schema(merge.schema).parquet(root).where(F.col(KIND) == "change")
    state = state_of(changes)
    if manifest.state:
        before = spark.read.schema(state.schema).parquet(f"{silver_path}/_state/{manifest.state}")
        state = merged(before, state)
    state.write.parquet(f"{silver_path}/_state/{version}")

    retired = [f"{VERSION}={manifest.buckets[b]}/{KIND}=silver/{BUCKET}={b}" for b in replaced]
    retired += [f"_state/{manifest.state}"] if manifest.state else []
    after = replace(
        manifest,
        size=size,
        loads=[*manifest.loads, *todo],
        rejects=[*manifest.rejects, version] if taken.observed.get("rejected") else manifest.rejects,
        buckets={**manifest.buckets, **dict.fromkeys(touched, version)},
        state=version,
        retired=retired,
    )
    after = versions.publish(spark, silver_path, after)
    inner = [f"{VERSION}={version}/{KIND}={k}" for k in ("latest", "change")]
    for path in [*manifest.retired, *inner]:
        versions.remove(spark, f"{silver_path}/{path}")
    rows = metric.observed.get("silver", 0)
    return after, StepMetric("silver", rows, metric.duration_seconds, metric.observed)


def gold_from_state(
    spark: SparkSession, silver_path: str, gold_path: str, scratch: str | None = None
) -> tuple[DataFrame, StepMetric]:
    """Gold, ranked, from the state that silver's changes have left; silver is not read."""
    manifest = versions.current(spark, silver_path)
    state = state_of(spark.createDataFrame([], EMPTY_CHANGES))
    if manifest.state:
        state = spark.read.schema(state.schema).parquet(f"{silver_path}/_state/{manifest.state}")
    gold = rank_groups(groups_of(state), scratch).withColumn(GOLD_AT, F.current_timestamp())
    metric = write_gold(gold, gold_path)
    return read_gold(spark, gold_path), metric


EMPTY_CHANGES = T.StructType([*VISIT_SCHEMA.fields, T.StructField(SIGN, T.IntegerType())])


def advance(
    spark: SparkSession,
    source: str | list[str],
    root: str,
    since: Mark | None = None,
    *,
    schema: T.StructType = VISIT_SCHEMA,
    layout: str = "day",
    rebalance: bool = True,
    **fold_options,
) -> RunResult:
    """Take new files of ``source`` into the layers below ``root``; files taken before are not.

    Raises on failure; the next call takes up what is missing.
    """
    root = root.rstrip("/")
    names = ("bronze", "ledger", "silver", "gold")
    bronze, book, silver, gold_path = (f"{root}/{n}" for n in names)
    mark = settled(spark, since)
    text = None if mark is None else mark.isoformat()
    options = {"schema": schema, "layout": layout, "rebalance": rebalance}
    loaded = take_files(spark, source, bronze, book, text, **options)
    _, folded = fold_loads(spark, bronze, book, silver, rebalance=rebalance, **fold_options)
    scratch = f"{root}/_scratch/{versions.new_version()}"
    versions.make_folder(spark, scratch)
    try:
        gold, ranked = gold_from_state(spark, silver, gold_path, scratch)
    finally:
        versions.remove(spark, scratch)
    return RunResult(spark, True, [loaded, folded, ranked], gold)
