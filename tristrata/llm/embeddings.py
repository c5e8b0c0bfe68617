"""Embedding near-duplicates with randomised-rotation binary codes.

Unit vectors are turned by a seeded random rotation; the signs of the turned vector are its
code, and the inner product of vector and code, ``f``, is stored as correction. For another
vector ``y`` the value ``<code, y> / f`` is an unbiased estimate of the cosine, with an error
below ``EPSILON * sqrt(1 - f * f) / (f * sqrt(d - 1))`` but for one in some ten thousand. A pair
whose estimate and bound stay below the threshold is passed over; all others are computed
exactly in double precision, and only that decides.

Candidates are pairs that agree on all bits of one of several groups of signs. The bits of a
group grow with the logarithm of the input, and there are so many groups that a pair right at
the threshold is missed in ``MISS`` of cases; there is no cap on partners or on candidates. With
``exact`` all classes are one bucket, which is cut, and every pair is computed.

1. For each group a class sends its code, its correction and its turned vector in bytes, whose
   rounding is part of the bound. A task takes many buckets in one pass and names the
   classes of each that have an open pair.
2. Only these fetch their vectors, meet again by bucket, and are computed.

Equal vectors are one class and count as links of each other. A pair is counted in the first group
where it meets, so buckets send sums and the edges of a spanning forest, never pairs. Buckets
beyond ``BUCKET`` classes are cut, and each two cuts meet in a group of their own.

Vectors that are null or zero, or hold null or non-finite components, link with nothing and
are their own component; vectors of different lengths do not link. Vectors may be as small
or large as doubles go: they are scaled by their largest component first. Rows with equal keys
keep their own rows. Extra columns stay, output columns replace. An empty table gives an empty
result.
"""

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.llm.blocks import renamed, restored, rows
from tristrata.llm.components import connected
from tristrata.llm.storage import stored

THRESHOLD = 0.95
EPSILON = 4.0
MISS = 2e-4
#: Classes that share a bucket of one group on average, and at most in one task.
MEAN, BUCKET = 256, 2000
SEED = 20


@cache
def rotation(d: int, number: int) -> np.ndarray:
    """An orthogonal matrix, the same in every process."""
    gauss = np.random.default_rng([SEED, d, number]).standard_normal((d, d))
    q, r = np.linalg.qr(gauss)
    return q * np.sign(np.diag(r))


def plan(classes: int) -> tuple[int, int]:
    """Bits of a group and number of groups for so many classes."""
    bits = max(2, round(math.log2(max(1, classes) / MEAN)))
    meet = (1 - math.acos(THRESHOLD) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - meet))


def group_keys(unit: np.ndarray, bits: int, groups: int) -> np.ndarray:
    """Sign bits of each group as one number: a row for each vector."""
    d = unit.shape[1]
    turns = -(-bits * groups // d)
    signs = np.concatenate([unit @ rotation(d, k + 1) > 0 for k in range(turns)], axis=1)
    whole = signs[:, : bits * groups].reshape(len(unit), groups, bits).astype(np.int64)
    return whole @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled by powers of two first, so that no square overflows."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    scaled = np.ldexp(vectors, -power)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the turned vectors and their correction factors."""
    turned = unit @ rotation(unit.shape[1], 0)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])


def in_bytes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Turned vectors as signed bytes, and the size of one step of each."""
    step = np.abs(turned).max(axis=1) / 127
    return np.rint(turned / step[:, None]).astype(np.int8), step


def open_pairs(
    signs: np.ndarray, factor: np.ndarray, rough: np.ndarray, step: np.ndarray
) -> np.ndarray:
    """Pairs, by rows of codes and columns of rough vectors, that bounds do not settle."""
    d = signs.shape[1]
    estimate = (signs @ rough.T) * step[None, :].astype(np.float32)
    estimate = estimate / (math.sqrt(d) * factor[:, None])
    chance = EPSILON * np.sqrt(np.maximum(0, 1 - factor**2)) / (factor * math.sqrt(max(1, d - 1)))
    rounding = math.sqrt(d) * step[None, :] / (2 * factor[:, None]) + 1e-4
    return estimate + chance[:, None] + rounding >= THRESHOLD


def linked(a: np.ndarray, b: np.ndarray, code: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Which unit vectors of ``a`` (with codes) and ``b`` have a cosine of ``THRESHOLD`` or more."""
    signs = np.unpackbits(code, axis=1, count=a.shape[1]).astype(np.float32) * 2 - 1
    rough, step = in_bytes(b @ rotation(b.shape[1], 0))
    wanted = open_pairs(signs, factor, rough.astype(np.float32), step)
    i, j = np.nonzero(wanted)
    out = np.zeros(wanted.shape, bool)
    out[i, j] = np.einsum("ij,ij->i", a[i], b[j]) >= THRESHOLD
    return out


BINARY = [(c, pa.binary()) for c in ("cid", "vector", "code")]
CLASS = pa.schema([*BINARY, ("factor", pa.float64())])


def classified(df: DataFrame, vector: str, kept: list[str]) -> DataFrame:
    """``kept`` as ``k0, ...`` with ``cid, vector, code, factor`` (null for invalid vectors)."""
    frame = renamed(df, kept, v=F.col(f"`{vector}`"))
    schema = T.StructType(
        frame.schema.fields[:-1]
        + [T.StructField(c, T.BinaryType()) for c in ("cid", "vector", "code")]
        + [T.StructField("factor", T.DoubleType())]
    )

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            n = batch.num_rows
            out = {f.name: np.full(n, None, object) for f in CLASS}
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            for d in np.unique(size[size > 0]).tolist():
                at = np.flatnonzero(size == d)
                flat = pc.fill_null(column.take(pa.array(at)).flatten(), math.nan)
                v = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
                good = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
                at, unit = at[good], units(v[good] + 0.0)
                code, factor = codes(unit)
                raw = [u.tobytes() for u in unit]
                out["vector"][at] = raw
                out["cid"][at] = [hashlib.blake2b(r, digest_size=16).digest() for r in raw]
                out["code"][at] = [c.tobytes() for c in code]
                out["factor"][at] = factor
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(out[f.name], f.type) for f in CLASS)],
                names=schema.names,
            )

    return frame.mapInArrow(coded, schema)


WHERE = ["d", "grp", "key"]
GROUP = [*WHERE, "one", "two"]
#: What a class sends to each of its buckets; ``bits`` are all its signs in all groups.
SENT = pa.schema(
    [("d", pa.int32()), ("grp", pa.int32()), ("key", pa.int64()), ("num", pa.int64())]
    + [(c, pa.binary()) for c in ("code", "rough", "bits")]
    + [("factor", pa.float64()), ("step", pa.float64())]
)
SENT_DDL = (
    "d int, grp int, key long, num long, code binary, rough binary, bits binary, "
    "factor double, step double"
)


def keyed(classes: DataFrame, bits: int, groups: int, whole: bool = False) -> DataFrame:
    """A row of each class for each group, as ``SENT``; with ``whole`` a group is one bucket."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.frombuffer(x.as_py()) for x in batch.column("vector")]
            sizes = np.array([len(v) for v in vectors])
            for d in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == d)
                unit = np.stack([vectors[k] for k in mine])
                keys = group_keys(unit, bits, groups)
                part = batch.take(pa.array(mine))
                rough, step = in_bytes(unit @ rotation(d, 0))
                same = {c: part.column(c) for c in ("num", "code", "factor")}
                same |= {
                    "rough": pa.array([x.tobytes() for x in rough], pa.binary()),
                    "bits": pa.array([k.tobytes() for k in packed(keys, bits)], pa.binary()),
                    "step": step,
                    "d": np.full(len(mine), d),
                }
                for g in range(groups):
                    yield rows(SENT, key=keys[:, g] * (not whole), grp=np.full(len(mine), g), **same)

    return classes.select("num", "vector", "code", "factor").mapInArrow(spread, SENT_DDL)


def packed(keys: np.ndarray, bits: int) -> np.ndarray:
    """Keys of all groups as bytes, ``bits`` bits for each."""
    each = (keys[:, :, None] >> np.arange(bits, dtype=np.int64)) & 1
    return np.packbits(each.reshape(len(keys), -1).astype(np.uint8), axis=1)


def unpacked(rows_of_bits: np.ndarray, bits: int, groups: int) -> np.ndarray:
    """The keys that :func:`packed` took."""
    each = np.unpackbits(rows_of_bits, axis=1, count=bits * groups).astype(np.int64)
    return each.reshape(len(each), groups, bits) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def by_group(step, names: list[str] = GROUP):
    """``step`` for each run of rows that agree in ``names``, of input in that order."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy() for c in names], axis=1).astype(np.int64)
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(marks)], strict=True):
                mark = tuple(marks[a].tolist())
                if held and mark != last:
                    yield from step(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = mark
        if held:
            yield from step(pa.Table.from_batches(held))

    return solve


def stacked(column: pa.ChunkedArray, kind) -> np.ndarray:
    """Binary values of one length as rows of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


OPEN = [*GROUP, "cut", "num"]
OPEN_DDL = "d int, grp int, key long, one int, two int, cut int, num long, bits binary"


def first_met(keys: np.ndarray, i: np.ndarray, j: np.ndarray, group: int) -> np.ndarray:
    """Pairs that meet in no group before ``group``."""
    return (keys[i, :group] != keys[j, :group]).all(axis=1) if group else np.ones(len(i), bool)


def open_classes(bits: int, groups: int):
    """Classes of a bucket, or of two cuts of it, that have a pair which bounds do not settle."""

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        cut, num = table.column("cut").to_numpy(), table.column("num").to_numpy()
        one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        d, group = table.column("d")[0].as_py(), table.column("grp")[0].as_py()
        signs = np.unpackbits(stacked(table.column("code"), np.uint8), axis=1, count=d)
        signs = signs.astype(np.float32) * 2 - 1
        rough = stacked(table.column("rough"), np.int8).astype(np.float32)
        factor, step = table.column("factor").to_numpy(), table.column("step").to_numpy()
        keys = unpacked(stacked(table.column("bits"), np.uint8), bits, groups)
        left, right = np.flatnonzero(cut == one), np.flatnonzero(cut == two)
        part = np.zeros(len(num), bool)
        for at in range(0, len(left), 512):
            mine = left[at : at + 512]
            i, j = np.nonzero(open_pairs(signs[mine], factor[mine], rough[right], step[right]))
            i, j = mine[i], right[j]
            good = (num[i] < num[j]) if one == two else num[i] != num[j]
            i, j = i[good], j[good]
            good = first_met(keys, i, j, group)
            part[i[good]] = part[j[good]] = True
        if part.any():
            yield from table.filter(pa.array(part)).select([*OPEN, "bits"]).to_batches()

    return found


LINKS = pa.schema([("num", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])


def bucket_links(bits: int, groups: int):
    """Links found in one bucket, or between two cuts of it: ``num, n, root`` of linked classes."""

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        cut, num = table.column("cut").to_numpy(), table.column("num").to_numpy()
        m = table.column("m").to_numpy()
        vectors = stacked(table.column("vector"), np.float64)
        keys = unpacked(stacked(table.column("bits"), np.uint8), bits, groups)
        one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        group = table.column("grp")[0].as_py()
        left, right = np.flatnonzero(cut == one), np.flatnonzero(cut == two)
        n, root, edges = np.zeros(len(num), np.int64), np.arange(len(num)), []
        for at in range(0, len(left), 256):
            mine = left[at : at + 256]
            i, j = np.nonzero(vectors[mine] @ vectors[right].T >= THRESHOLD - 1e-9)
            i, j = mine[i], right[j]
            good = (num[i] < num[j]) if one == two else num[i] != num[j]
            i, j = i[good], j[good]
            good = first_met(keys, i, j, group)
            i, j = i[good], j[good]
            for k in range(0, len(i), 1 << 16):  # the exact value decides
                a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                near = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= THRESHOLD
                a, b = a[near], b[near]
                np.add.at(n, a, m[b])
                np.add.at(n, b, m[a])
                edges.append(forest(np.stack([a, b]), len(num)))
        if not edges:
            return
        edges = np.concatenate(edges, axis=1)
        while True:
            low = np.minimum(root[edges[0]], root[edges[1]])
            new = root.copy()
            np.minimum.at(new, edges[0], low)
            np.minimum.at(new, edges[1], low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero(n)
        yield rows(LINKS, num=num[some], n=n[some], root=num[root[some]])

    return found


def forest(edges: np.ndarray, size: int) -> np.ndarray:
    """Fewer edges that join the same nodes: each node with the least it is linked to."""
    low = np.arange(size)
    for _ in range(2):
        least = np.minimum(low[edges[0]], low[edges[1]])
        np.minimum.at(low, edges[0], least)
        np.minimum.at(low, edges[1], least)
    apart = low[edges[0]] != low[edges[1]]
    joined = np.flatnonzero(low != np.arange(size))
    return np.concatenate([edges[:, apart], np.stack([joined, low[joined]])], axis=1)


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", *, exact: bool = False
) -> DataFrame:
    """``df`` without ``vector``, with ``n_links``, ``component_id`` and ``kept``.

    ``exact`` compares every two vectors, which no pair escapes and which takes time by the
    square of the table.
    """
    outputs = ("n_links", "component_id", "kept", vector)
    kept = [c for c in df.columns if c not in outputs]
    members = stored(classified(df, vector, kept), "embedding-codes")
    once = (
        members.where("cid is not null")
        .groupBy("cid")
        .agg(F.count("*").alias("m"), *(F.first(c).alias(c) for c in ("vector", "code", "factor")))
    )
    classes = stored(once.withColumn("num", F.monotonically_increasing_id()), "embedding-classes")
    bits, groups = (1, 1) if exact else plan(classes.count())
    spread = stored(keyed(classes, bits, groups, exact), "embedding-keys")
    sizes = spread.groupBy(*WHERE).agg(F.count("*").alias("size"))
    large = sizes.where(F.col("size") > BUCKET)
    cuts = F.coalesce(F.ceil(F.col("size") / BUCKET), F.lit(1)).cast("int")
    cut = spread.join(large, WHERE, "left").withColumn("cuts", cuts)
    cut = cut.withColumn("cut", F.pmod(F.xxhash64("num"), "cuts").cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).select(
        *WHERE,
        F.least("cut", "other").alias("one"),
        F.greatest("cut", "other").alias("two"),
        "cut", "num", "code", "rough", "bits", "factor", "step",
    )
    if exact:
        wanted = met.select(*OPEN, "bits")
    else:
        dealt = met.repartition(*GROUP).sortWithinPartitions(*GROUP)
        wanted = stored(
            dealt.mapInArrow(by_group(open_classes(bits, groups)), OPEN_DDL), "embedding-open"
        )
    whole = wanted.join(classes.select("num", "m", "vector"), "num")
    dealt = whole.repartition(*GROUP).sortWithinPartitions(*GROUP)
    found = stored(
        dealt.mapInArrow(by_group(bucket_links(bits, groups)), "num long, n long, root long"),
        "embedding-links",
    )
    links = found.groupBy("num").agg(F.sum("n").alias("n"))
    roots = connected(found.select(F.col("num").alias("a"), F.col("root").alias("b")))
    placed = (
        classes.select("cid", "num", "m")
        .join(links, "num", "left")
        .join(roots.withColumnRenamed("node", "num"), "num", "left")
        .withColumn("root", F.coalesce("root", "num"))
        .drop("num")
    )
    named = members.drop("vector", "code", "factor").join(placed, "cid", "left")
    own = F.col(f"k{kept.index(key)}")
    least = named.where("root is not null").groupBy("root").agg(F.min(own).alias("least"))
    component = F.coalesce("least", own)
    others = F.coalesce(F.col("m") - 1, F.lit(0))
    return restored(
        named.join(least, "root", "left"),
        kept,
        (F.coalesce("n", F.lit(0)) + others).cast("long").alias("n_links"),
        component.alias("component_id"),
        own.eqNullSafe(component).alias("kept"),
    )
