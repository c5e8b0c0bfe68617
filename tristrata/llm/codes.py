"""Vector code compression: a byte for each part of a vector, by integer codebooks.

Components become integers ``floor(256 * x)``, vectors are cut into ``parts`` equal consecutive
parts, and each part position has a codebook of at most ``entries`` entries that begins as
that part of the vectors with the least ids. A round assigns every part to its nearest
entry and moves each entry to the floor of the mean of its parts; an unused one stays.

The nearest entry is found by equal-average search: entries are sorted by the sum of their
components, and a part looks at them outward from its own sum. The squared gap of two sums,
divided by the number of components, is at most their squared distance, so a direction ends
once that strictly exceeds the best distance; entries at equal distance are all seen, and the
first of them is taken.

One task reduces its vectors to a sum and a count for each entry, so a round shuffles a
fixed number of rows for each task, and the codebooks themselves, of fixed size, are all that
comes to the driver. Vectors are read anew by each round: they should be a stored table.

Rows whose vector is null, or holds a null or a non-finite component, are dropped. So are empty
vectors, ones that ``parts`` does not divide and ones of another length than that of the least id
among the rest. Null ids come last, and equal ids are ordered by their vectors. Repeated
rows count as often as they occur. With fewer vectors than entries the codebooks are
smaller; without any, they are empty. Integers beyond ``2**28`` divided by the components of a
part are held at that, so that sums of squares fit into 64 bits. Extra columns stay;
columns with the name of an output are replaced.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.blocks import renamed, restored
from tristrata.operators.join import skewed_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
OUTPUTS = ("code", "error")


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]`` as 64-bit integers."""

    entries: np.ndarray

    @property
    def dimension(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        """SHA-256 of all components as decimal numbers with commas between."""
        line = ",".join(map(str, self.entries.reshape(-1).tolist()))
        return hashlib.sha256(line.encode()).hexdigest()

    def nearest(self, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each part of vectors of integers."""
        parts, _, width = self.entries.shape
        cut = whole.reshape(len(whole), parts, width)
        index = np.empty((len(whole), parts), np.int64)
        away = np.empty((len(whole), parts), np.int64)
        for p in range(parts):
            index[:, p], away[:, p] = nearest(np.ascontiguousarray(cut[:, p]), self.entries[p])
        return index, away


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest of ``entries``, the first of equal ones."""
    n, width = points.shape
    total, sums = points.sum(axis=1), entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    best = np.full(n, np.iinfo(np.int64).max // width)
    index = np.full(n, len(entries))
    right = np.searchsorted(sums, total)
    sides = [[np.arange(n), right, 1], [np.arange(n), right - 1, -1]]
    while len(sides[0][0]) or len(sides[1][0]):
        for side in sides:
            who, at, step = side
            inside = (at >= 0) & (at < len(sums))
            who, at = who[inside], at[inside]
            gap = total[who] - sums[at]
            open_ = gap * gap <= best[who] * width
            who, at = who[open_], at[open_]
            entry = order[at]
            apart = points[who] - entries[entry]
            away = np.einsum("ij,ij->i", apart, apart)
            better = (away < best[who]) | ((away == best[who]) & (entry < index[who]))
            best[who[better]], index[who[better]] = away[better], entry[better]
            side[0], side[1] = who, at + step
    return index, best


def integers(column: pa.Array, parts: int, dimension: int | None = None):
    """Which vectors can be coded, and ``floor(SCALE * x)`` of those, held within bounds."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    fits = (size > 0) & (size % parts == 0) if dimension is None else size == dimension
    flat = column.filter(pa.array(fits)).flatten()
    values = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False).astype(np.float64)
    sizes, finite = size[fits], np.isfinite(values)
    starts = np.cumsum(sizes) - sizes
    fine = np.logical_and.reduceat(finite, starts) if len(starts) else np.empty(0, bool)
    kept = fits.copy()
    kept[fits] = fine
    values = values[np.repeat(fine, sizes)]
    most = float((1 << 28) // max(1, (dimension or int(sizes.max(initial=parts))) // parts))
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(SCALE * values), -most, most).astype(np.int64)
    return kept, whole


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the least ids; ``vectors`` has columns ``id, vector``."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            kept, _ = integers(batch.column("vector"), parts)
            usable = batch.filter(pa.array(kept))
            last = np.iinfo(np.int64).max
            ids = pc.fill_null(usable.column("id"), last).to_numpy()
            sizes = pc.list_value_length(usable.column("vector")).to_numpy()
            for size in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == size)
                rows = held.get(size, [])
                if len(rows) == entries and not rows[-1][0]:  # only what may come before
                    mine = mine[ids[mine] <= rows[-1][1]]
                if len(mine) > entries:
                    mine = mine[ids[mine] <= np.partition(ids[mine], entries - 1)[entries - 1]]
                for r in usable.take(pa.array(mine)).to_pylist():
                    rows.append((r["id"] is None, r["id"], r["vector"]))
                rows.sort(key=lambda r: (r[0], r[1] or 0, r[2]))
                held[size] = rows[:entries]
        found = [(r[1], r[2]) for rows in held.values() for r in rows]
        yield pa.record_batch(
            {
                "id": pa.array([r[0] for r in found], pa.int64()),
                "vector": pa.array([r[1] for r in found], pa.list_(pa.float64())),
            }
        )

    best = vectors.mapInArrow(least, "id long, vector array<double>")
    best = stored_order(best)
    lead = best.first()
    if lead is None:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    dimension = len(lead["vector"])
    chosen = stored_order(best.where(F.size("vector") == dimension)).limit(entries).collect()
    column = pa.array([r["vector"] for r in chosen], pa.list_(pa.float64()))
    whole = integers(column, parts, dimension)[1].reshape(len(chosen), parts, -1)
    return Codebooks(np.ascontiguousarray(whole.transpose(1, 0, 2)))


def stored_order(best: DataFrame) -> DataFrame:
    return best.orderBy(F.col("id").asc_nulls_last(), "vector")


def moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round."""
    parts, entries, width = books.entries.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        for batch in batches:
            whole = integers(batch.column("vector"), parts, books.dimension)[1]
            cut = whole.reshape(-1, parts, width)
            index, _ = books.nearest(whole.reshape(-1, books.dimension))
            for p in range(parts):
                np.add.at(sums[p], index[:, p], cut[:, p])
                counts[p] += np.bincount(index[:, p], minlength=entries)
        slot = np.flatnonzero(np.repeat(counts.reshape(-1) > 0, width))
        yield pa.record_batch(
            {
                "slot": pa.array(slot.astype(np.int32)),
                "total": pa.array(sums.reshape(-1)[slot]),
                "n": pa.array(np.repeat(counts.reshape(-1), width)[slot]),
            }
        )

    found = vectors.select("vector").mapInArrow(summed, "slot int, total long, n long")
    found = found.groupBy("slot").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    line = books.entries.reshape(-1).copy()
    for r in found.collect():
        line[r["slot"]] = r["total"] // r["n"]
    return Codebooks(line.reshape(books.entries.shape))


def with_id_and_vector(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    return vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )


def fit(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    *,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks after ``rounds`` rounds over all ``vectors``; at most 256 ``entries``."""
    if not 0 < entries <= 256:
        raise ValueError(f"an entry is one byte: from 1 to 256 entries, got {entries}")
    plain = with_id_and_vector(vectors, vec_id, vector)
    books = first_codebooks(plain, parts, entries)
    for _ in range(rounds if books.dimension else 0):
        books = moved(plain, books)
    return books


def encode(vectors: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """``vectors`` that can be coded, without ``vector``, with ``code`` and ``error``.

    ``code`` has the index of each part's entry as a byte; ``error`` is the sum of the squared
    distances.
    """
    parts = books.entries.shape[0]
    kept = [c for c in vectors.columns if c not in OUTPUTS and c != vector]
    inner = renamed(vectors, kept, vector=F.col(f"`{vector}`").cast("array<double>"))
    out = renamed(vectors, kept, code=F.lit(b""), error=F.lit(0).cast("long")).schema

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable, whole = integers(batch.column("vector"), parts, books.dimension)
            index, away = books.nearest(whole.reshape(-1, books.dimension))
            code = [row.tobytes() for row in index.astype(np.uint8)]
            left = batch.filter(pa.array(usable)).drop_columns(["vector"])
            yield pa.RecordBatch.from_arrays(
                [*left.columns, pa.array(code, pa.binary()), pa.array(away.sum(axis=1))],
                names=[*left.schema.names, "code", "error"],
            )

    if not books.dimension:
        inner = inner.where("false")
    return restored(inner.mapInArrow(coded, out), kept, *OUTPUTS)


def decode(coded: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """``coded`` with ``vector``: the entries that a code names, put together and scaled back."""
    parts, _, width = books.entries.shape
    kept = [c for c in coded.columns if c != "vector"]
    inner = renamed(coded, kept, code=F.col(f"`{code}`"))
    out = renamed(coded, kept, vector=F.array().cast("array<double>")).schema

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = []
            for x in batch.column("code"):
                index = np.frombuffer(x.as_py() or b"", np.uint8)
                found = books.entries[np.arange(parts), index] / SCALE if len(index) else None
                vectors.append(None if found is None else found.reshape(parts * width).tolist())
            left = batch.drop_columns(["code"])
            yield pa.RecordBatch.from_arrays(
                [*left.columns, pa.array(vectors, pa.list_(pa.float64()))],
                names=[*left.schema.names, "vector"],
            )

    return restored(inner.mapInArrow(put_together, out), kept, "vector")


def with_group_error(coded: DataFrame, group: str = "label", name: str = "label_error") -> DataFrame:
    """``coded`` with the errors summed over rows of equal ``group``; nulls are one group.

    The sums have one row for each group; a group of very many rows is not gathered.
    """
    kept = [c for c in coded.columns if c != name]
    text = F.col(f"`{group}`").cast("string")
    key = F.coalesce(F.concat(F.lit("="), text), F.lit("-"))
    inner = renamed(coded, kept, g=key, e=F.col("`error`"))
    sums = inner.groupBy("g").agg(F.sum("e").alias("total"))
    joined = skewed_join(inner.drop("e"), sums, "g")
    return restored(joined, kept, F.col("total").alias(name))


def coded_sql(
    table: str = "embeddings", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> str:
    """Codes and errors of all vectors of ``table``, as DuckDB SQL that looks at every entry."""
    ctes = [
        f"""vectors AS (
  SELECT row_number() OVER (ORDER BY vec_id ASC NULLS LAST, embedding) AS r, vec_id, label,
         embedding, len(embedding) // {parts} AS width
  FROM {table}
  WHERE len(embedding) > 0 AND len(embedding) % {parts} = 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""cut AS (
  SELECT r, i // width AS p, i % width AS j,
         CAST(floor({SCALE} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, embedding, width, unnest(range(len(embedding))) AS i FROM vectors)
)""",
        f"books0 AS (SELECT p, r - 1 AS e, j, x AS y FROM cut WHERE r <= {entries})",
    ]
    for k in range(rounds + 1):
        ctes.append(
            f"""chosen{k} AS (
  SELECT r, p, min(away * {entries} + e) % {entries} AS e, min(away * {entries} + e) // {entries} AS away
  FROM (
    SELECT r, cut.p, e, CAST(sum((x - y) * (x - y)) AS BIGINT) AS away
    FROM cut JOIN books{k} AS b ON cut.p = b.p AND cut.j = b.j GROUP BY r, cut.p, e
  ) GROUP BY r, p
)"""
        )
        if k < rounds:
            ctes.append(
                f"""means{k} AS (
  SELECT cut.p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM cut JOIN chosen{k} AS c ON cut.r = c.r AND cut.p = c.p GROUP BY cut.p, e, j
)"""
            )
            ctes.append(
                f"""books{k + 1} AS (
  SELECT b.p, b.e, b.j, coalesce((s - ((s % n) + n) % n) // n, y) AS y
  FROM books{k} AS b LEFT JOIN means{k} AS m ON b.p = m.p AND b.e = m.e AND b.j = m.j
)"""
            )
    ctes.append(
        f"""coded AS (
  SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(away) AS BIGINT) AS error
  FROM chosen{rounds} GROUP BY r
)"""
    )
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, j)) FROM books{rounds})
         AS codebooks_sha256
FROM coded JOIN vectors USING (r)
"""
