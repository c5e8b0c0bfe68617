"""Vector codes against plain loops over Python integers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tristrata.llm import codes
from tristrata.llm.queries import QUERIES

DDL = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Codes, errors and codebooks; every entry is looked at."""
    fine = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    fine = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in fine]
    width = len(fine[0][1]) // parts if fine else 0
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in fine]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            found = []
            for p in range(parts):
                away = [sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)) for e in books[p]]
                found.append((min(away), away.index(min(away))))
            out.append(found)
        return out

    for _ in range(rounds):
        chosen = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[k][p] for k in range(len(cut)) if chosen[k][p][1] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    line = ",".join(str(x) for part in books for e in part for x in e)
    digest = hashlib.sha256(line.encode()).hexdigest()
    out = []
    for (i, _, label), found in zip(fine, assign(), strict=True):
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    totals = {}
    for _, _, error, label in out:
        totals[label] = totals.get(label, 0) + error
    return sorted((i, c, e, totals[label], digest) for i, c, e, label in out)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4), st.integers(1, 12), st.integers(0, 2**32 - 1), st.integers(1, 40))
def test_equal_average_search_sees_every_nearest_entry(width, entries, seed, spread):
    rng = np.random.default_rng(seed)
    book = rng.integers(-spread, spread + 1, (entries, width))
    points = rng.integers(-spread, spread + 1, (50, width))
    away = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    index, best = codes.nearest(points, book)
    assert index.tolist() == away.argmin(axis=1).tolist()
    assert best.tolist() == away.min(axis=1).tolist()


def test_query_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = QUERIES["op13_codes"](spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    wanted = brute([(r.vec_id, list(r.embedding), r.label) for r in table])
    columns = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(tuple(r[c] for c in columns) for r in got) == wanted


ODD = [
    (5, [0.5] * 32, 1),
    (5, [0.5] * 32, 1),
    (2, [float(k) / 7 for k in range(32)], None),
    (3, [-float(k) / 9 for k in range(32)], None),
    (None, [0.1] * 32, 2),
    (7, None, 1),
    (8, [], 1),
    (9, [float("nan")] + [0.0] * 31, 1),
    (10, [float("inf")] + [0.0] * 31, 1),
    (11, [None] + [0.0] * 31, 1),
    (12, [1e-300] * 32, 4),
]


def test_odd_rows(spark):
    frame = spark.createDataFrame(ODD, DDL)
    books = codes.fit(frame)
    coded = codes.with_group_error(codes.encode(frame, books))
    got = [
        (r.vec_id, bytes(r.code).hex(), r.error, r.label_error, books.digest())
        for r in coded.collect()
    ]
    assert sorted(got, key=repr) == sorted(wanted_odd(), key=repr)


def wanted_odd():
    # a null id comes last, so a large one stands for it
    named = [(10**9 if i is None else i, v, label) for i, v, label in ODD]
    return [(None if r[0] == 10**9 else r[0], *r[1:]) for r in brute(named)]


def test_many_rounds_unused_entries_and_a_hot_label(spark):
    rng = np.random.default_rng(3)
    rows = [
        (int(k), rng.integers(-4, 5, 32).astype(float).tolist(), 0 if k % 3 else int(k))
        for k in rng.permutation(900)
    ]
    frame = spark.createDataFrame(rows, DDL).repartition(7)
    books = codes.fit(frame)
    coded = codes.with_group_error(codes.encode(frame, books))
    got = sorted(
        (r.vec_id, bytes(r.code).hex(), r.error, r.label_error, books.digest())
        for r in coded.collect()
    )
    assert got == brute(rows)


def test_other_lengths_empty_tables_and_clashing_names(spark):
    rows = [(1, [0.25] * 32, 1), (2, [0.5] * 16, 1), (3, [0.5] * 33, 1), (0, [0.1] * 7, 1)]
    frame = spark.createDataFrame(rows, DDL)
    books = codes.fit(frame)
    assert books.dimension == 32
    assert [r.vec_id for r in codes.encode(frame, books).collect()] == [1]
    for empty in (frame.limit(0), frame.where("vec_id = 0")):
        none = codes.fit(empty)
        assert codes.with_group_error(codes.encode(empty, none)).count() == 0
    names = ("code", "error", "label_error", "vector", "id", "k0", "g", "e", "a.b", "total")
    clashing = frame.withColumns({c: F.lit(f"own {c}") for c in names})
    coded = codes.with_group_error(codes.encode(clashing, books))
    row = coded.first()
    assert (row["vector"], row["k0"], row["total"], row["a.b"]) == (
        "own vector", "own k0", "own total", "own a.b"
    )
    assert row["label_error"] == row["error"] and sorted(coded.columns) == sorted(
        {*clashing.columns} - {"embedding"}
    )


def test_decoded_vectors_are_near(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    books = codes.fit(table)
    coded = codes.encode(table, books)
    both = codes.decode(coded, books).join(table.select("vec_id", "embedding"), "vec_id").collect()
    for r in both[:50]:
        x = np.floor(256 * np.array(r.embedding, float))
        assert int(((x - 256 * np.array(r.vector)) ** 2).sum()) == r.error


def test_more_entries_than_a_byte_raise(spark):
    with pytest.raises(ValueError):
        codes.fit(spark.createDataFrame(ODD, DDL), entries=257)
