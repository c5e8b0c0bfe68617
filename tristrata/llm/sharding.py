"""Sharding by a permutation-filled lookup table.

Shards take turns: each claims the first free slot of its own preference order, a walk
``(offset + k * skip) mod size`` over a prime-sized table, until all slots are taken. Every
shard gets ``size / shards`` slots, give or take one, and when a shard leaves, few rows of
the others move. The table's size is a parameter, so it can be broadcast; a row finds its
shard with one hash and one lookup, without a shuffle.

The key's text is hashed. A null key falls back to the columns of ``fallback`` so that rows
without a key do not all meet in one shard; with those null too, the row goes by the empty
text. Equal keys go to one shard. Output columns replace input columns of the same name.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm.blocks import renamed, restored

#: A prime; a hundred slots for each of up to about forty shards.
TABLE_SIZE = 4093
MOST_SLOTS = 1_000_003
DIGITS = 13


def number(text: Column) -> Column:
    """52 bits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def preferences(spark: SparkSession, shards: list[str], size: int) -> list[tuple[str, int, int]]:
    """Name, offset and skip of each shard, in order of name."""
    names = spark.createDataFrame([(x,) for x in sorted(set(shards))], "shard string")
    found = names.select(
        "shard",
        (number(F.concat(F.lit("offset:"), "shard")) % size).alias("offset"),
        (number(F.concat(F.lit("skip:"), "shard")) % (size - 1) + 1).alias("skip"),
    )
    return [tuple(r) for r in found.orderBy("shard").collect()]


def fill(preference: list[tuple[str, int, int]], size: int) -> list[str]:
    """Owner of each slot: the shards claim in turn until none is free."""
    owner: list[str | None] = [None] * size
    walked = [0] * len(preference)
    free = size
    while free:
        for k, (shard, offset, skip) in enumerate(preference):
            if not free:
                break
            slot = (offset + walked[k] * skip) % size
            while owner[slot] is not None:
                walked[k] += 1
                slot = (offset + walked[k] * skip) % size
            owner[slot] = shard
            free -= 1
    return owner


def lookup_table(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """Rows ``slot, shard``. ``size`` must be a prime of at most a million slots."""
    if not shards:
        raise ValueError("there is no shard")
    if size > MOST_SLOTS or size < 2 or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table needs a prime number of slots, {MOST_SLOTS} at most")
    owner = fill(preferences(spark, shards, size), size)
    return spark.createDataFrame(list(enumerate(owner)), "slot long, shard string")


def place(
    df: DataFrame,
    table: DataFrame,
    key: str,
    fallback: tuple[str, ...] = (),
    size: int = TABLE_SIZE,
) -> DataFrame:
    """``df`` with the ``slot`` and ``shard`` of each row; ``table`` must come from ``size``."""
    whole = F.coalesce(*(F.md5(F.col(f"`{c}`").cast("string")) for c in fallback), F.lit(""))
    text = F.coalesce(F.col(f"`{key}`").cast("string"), whole)
    kept = [c for c in df.columns if c not in ("slot", "shard")]
    placed = renamed(df, kept, at=number(text) % size)
    slots = F.broadcast(table.select("slot", "shard"))
    joined = placed.join(slots, F.col("at") == F.col("slot"))
    return restored(joined, kept, "slot", "shard")


def placed_sql(shards: list[str], size: int = TABLE_SIZE) -> str:
    """The same for whole ``documents`` in DuckDB: the claims as a recursion over the turns."""
    names = sorted(set(shards))
    values = ", ".join(f"({k}, '{x}')" for k, x in enumerate(names))
    return f"""
WITH RECURSIVE names(k, shard) AS (VALUES {values}),
walks AS (
  SELECT k, shard, list_transform(range(0, {size}), lambda j: (
      ('0x' || substr(md5('offset:' || shard), 1, {DIGITS}))::BIGINT % {size}
      + j * (('0x' || substr(md5('skip:' || shard), 1, {DIGITS}))::BIGINT % {size - 1} + 1)
    ) % {size}) AS walk
  FROM names),
claims(turn, slot, taken) AS (
  SELECT -1::BIGINT, NULL::BIGINT, list_transform(range(0, {size}), lambda j: false)
  UNION ALL
  SELECT turn, slot, list_concat(list_concat(taken[1:slot], [true]), taken[slot + 2:])
  FROM (SELECT turn + 1 AS turn, taken, list_filter(walk, lambda s: NOT taken[s + 1])[1] AS slot
        FROM claims JOIN walks ON k = (turn + 1) % {len(names)} WHERE turn + 1 < {size})
),
slots AS (
  SELECT slot, shard FROM claims JOIN walks ON k = turn % {len(names)} WHERE turn >= 0)
SELECT documents.*, slots.slot, shard
FROM documents JOIN slots ON slots.slot =
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(text), '')), 1, {DIGITS}))::BIGINT % {size}"""
