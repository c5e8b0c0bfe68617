"""Joins on one key: one that broadcasts only a side measured to be small, one for heavy keys."""

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.sizes import Size, least_row_bytes, measure

MAX_BROADCAST_BYTES = 64 << 20
SMALL_SIDE_RATIO = 0.1  # fixed value: the small side has under a tenth of the rows
#: A key with this share of a side's rows is heavy, so there are at most 256 heavy keys.
HEAVY_SHARE = 1 / 256
#: Keys that the sketch of one task follows.
TRACKED = 8192
#: Cells of all heavy keys for each task that can run at once, which evens out their hashes.
CELLS_PER_TASK = 8


def sized_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    *,
    small_size: Size | None = None,
    large_rows: int | None = None,
    measured: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    ratio: float = SMALL_SIDE_RATIO,
) -> DataFrame:
    """Inner join on the column ``key`` of both sides; the result has it once, in front.

    The small side is broadcast when its size, given or measured, is within
    ``max_broadcast_bytes`` and, where ``large_rows`` is known, its row count is under
    ``ratio`` of that. A row ratio alone would not do: a tenth of a huge table is still
    too large to send everywhere. Otherwise the join is left to the optimizer, which shuffles
    both sides and splits skewed keys at run time; by default that is so without any job.
    ``measured=True`` reads the small side, but no more rows than could fit.
    """
    size = small_size
    if size is None and measured:
        most = max_broadcast_bytes // least_row_bytes(small.schema)
        if large_rows is not None:
            most = min(most, int(ratio * large_rows))
        size = measure(small.limit(most + 1))
        size = size if size.rows <= most else None
    fits = (
        size is not None
        and size.within(max_broadcast_bytes)
        and (large_rows is None or size.rows < ratio * large_rows)
    )
    return large.join(F.broadcast(small) if fits else small, key)


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> dict:
    """Keys that hold about ``share`` of the rows with a key, or more, and their rows.

    A frequent-items sketch over that one column finds them: its size does not depend on the
    table, and it may be wrong by a small part of ``share``, so this decides how to run, not
    what the result is. There are at most ``1 / share`` keys.
    """
    most = math.floor(1 / share)
    top = F.expr(f"approx_top_k(`{key}`, {most}, {max(TRACKED, 8 * most)})")
    keyed = df.select(key).where(F.col(key).isNotNull())
    found = keyed.agg(top.alias("top"), F.count(F.lit(1)).alias("rows")).first()
    least = max(2, share * found["rows"])
    return {x["item"]: x["count"] for x in found["top"] or [] if x["count"] >= least}


def skewed_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    *,
    how: str = "inner",
    share: float = HEAVY_SHARE,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join on ``key``, of which single values may hold a large part of either side.

    If the rows of ``small`` for the keys that are heavy in ``large`` are within
    ``max_broadcast_bytes`` they go to where the heavy rows are, which then are not shuffled.
    Otherwise each heavy key that is too much for one task, by its pairs or its rows, has a grid
    of cells: both sides' rows are dealt into pieces and every pair of pieces meets in a cell of
    its own (with ``how="left"`` each piece of ``large`` meets all of ``small``), always by a
    sort-merge join, in which all other rows meet by key. Cells are as many as the tasks that can
    run at once ask for and shared out by pairs of rows, so how often a row is copied follows
    neither the number of heavy keys nor that of shuffle partitions. Both sides are read once for
    each way, so they should be stored tables or cheap to work out. Keys are text, whole numbers,
    dates or others that the sketch can follow; NULL keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is 'inner' or 'left', got {how!r}")
    heavy = heavy_keys(large, key, share)
    if not heavy:
        return large.join(small, key, how)
    chosen = one_of(key, heavy)
    many, few = large.where(chosen), small.where(chosen)
    most = max_broadcast_bytes // least_row_bytes(small.schema)
    size = measure(few.limit(most + 1))
    if size.rows <= most and size.within(max_broadcast_bytes):
        light = large.where(~chosen).join(small.where(~chosen), key, how)
        return light.unionByName(many.join(F.broadcast(few), key, how))
    others = {k: n for k, n in few.groupBy(key).count().collect()}
    partitions = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = tasks_at_once(large.sparkSession, partitions)
    cut = grids(heavy, others, tasks, how)
    # the planner knows nothing of the copies and would broadcast them by the way of the driver
    if not cut:
        return large.join(small.hint("merge"), key, how)
    chosen = one_of(key, cut)
    down = by_key(key, {k: pieces for k, (pieces, _) in cut.items()})
    across = by_key(key, {k: pieces for k, (_, pieces) in cut.items()})
    piece, other = F.col("_piece"), F.col("_other")

    def celled(df: DataFrame, pieces: Column, copies: Column, most: int, cell: Column) -> DataFrame:
        parts = 1 << (max(tasks, most) - 1).bit_length()  # any number of pieces divides it
        rows = dealt(df.where(chosen), parts, pieces, copies, cell)
        rows = df.where(~chosen).withColumn("_cell", F.lit(0)).unionByName(rows)
        # by number, or cells that have few bytes but make many pairs would be put into one task
        return rows.repartition(partitions, key, "_cell")

    downs, widths = zip(*cut.values(), strict=True)
    rows = celled(large, down, across, max(downs), piece * across + other)
    copied = celled(small, across, down, max(widths), other * across + piece)
    return rows.join(copied.hint("merge"), [key, "_cell"], how).drop("_cell")


def one_of(key: str, keys) -> Column:
    return F.coalesce(F.col(key).isin(list(keys)), F.lit(False))


def by_key(key: str, values: dict) -> Column:
    """The value that a row's key has in ``values``, where many keys share a value."""
    keys = defaultdict(list)
    for k, value in values.items():
        keys[value].append(k)
    return F.coalesce(*(F.when(F.col(key).isin(some), F.lit(v)) for v, some in keys.items()))


def tasks_at_once(spark: SparkSession, partitions: int) -> int:
    """Tasks of a shuffle that can run at once; where executors come and go, all of them."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return partitions
    return min(partitions, spark.sparkContext.defaultParallelism)


def grids(heavy: dict, others: dict, tasks: int, how: str = "inner") -> dict:
    """Pieces of either side for each key of ``heavy`` that needs more than one cell.

    ``heavy`` and ``others`` have the rows of each key on either side. A key's cells are its share
    of all pairs, but enough that of neither side a cell alone has more rows than a task's share.
    """
    pairs = {k: n * max(1, others.get(k, 0)) for k, n in heavy.items()}
    all_pairs, all_rows = sum(pairs.values()), sum(heavy.values())
    all_others = max(1, sum(others.values()))
    found = {}
    for k, n in heavy.items():
        m = others.get(k, 0)
        share = max(CELLS_PER_TASK * pairs[k] / all_pairs, n / all_rows, m / all_others)
        down, across = grid(n, m, tasks * share)
        found[k] = (down, across) if how == "inner" else (down * across, 1)
    return {k: x for k, x in found.items() if x != (1, 1)}


def grid(rows: int, others: int, cells: float) -> tuple[int, int]:
    """Pieces of either side, ``cells`` pairs of them or more, so that the fewest rows are copied.

    They are powers of two, so that rows dealt for one grid are dealt evenly for a smaller one.
    """
    halvings = math.ceil(math.log2(max(1, cells)))
    more = math.log2(max(1, rows) / max(1, others))
    down = min(max(0, round((halvings + more) / 2)), halvings)
    return 1 << down, 1 << (halvings - down)


def dealt(df: DataFrame, parts: int, pieces: Column, copies: Column, cell: Column) -> DataFrame:
    """Rows in ``pieces`` even pieces, each once for every one of ``copies`` pieces across.

    Rows are dealt in turn, after a sort, so a repeated task deals them alike and rows that
    are equal do not stay together. ``pieces`` divides ``parts``.
    """
    parted = df.repartition(parts).withColumn("_piece", F.spark_partition_id() % pieces)
    other = F.explode(F.sequence(F.lit(0), copies - 1))
    return parted.withColumn("_other", other).withColumn("_cell", cell).drop("_piece", "_other")
