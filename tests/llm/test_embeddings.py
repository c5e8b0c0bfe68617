import numpy as np
import pytest

from tristrata.llm import embeddings


def brute(rows):
    good = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for _, v in rows
    ]
    links = [0] * len(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if good[i] and good[j] and len(a) == len(b):
                a, b = (np.array(x, float) / np.abs(np.array(x, float)).max() for x in (a, b))
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.95:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    least = {}
    for k, (key, _) in enumerate(rows):
        least[find(k)] = min(key, least.get(find(k), key))
    return sorted((key, links[k], least[find(k)], key == least[find(k)]) for k, (key, _) in enumerate(rows))


@pytest.mark.parametrize("bucket, mean, exact", [(7, 16, False), (2000, 256, False), (60, 256, True)])
def test_links_equal_brute_force(spark, monkeypatch, bucket, mean, exact):
    monkeypatch.setattr(embeddings, "BUCKET", bucket)
    monkeypatch.setattr(embeddings, "MEAN", mean)
    rng = np.random.default_rng(1)
    rows = []
    for scale in (0.01, 0.03, 0.05):
        centre = rng.standard_normal(32)
        rows += [(centre + scale * rng.standard_normal(32) * 3).tolist() for _ in range(40)]
    rows += [rng.standard_normal(32).tolist() for _ in range(150)]
    rows += [rows[0]] * 5 + [[2 * x for x in rows[1]], [0.0] * 32, None, [], [1.0, None], [float("nan")] * 32]
    rows += [[float("inf")] + [0.0] * 31, [1.0, 0.0], [1.0, 0.01]]
    rows += [[1e-200, 0.0], [2e-200, 0.0], [1e200, 1e200], [2e200, 2e200], [5e-324, 0.0]]
    rows += [[1.7e308, 1.7e308, 1.0], [1.7e308, 1.7e308, -1.0], [7.0], [9.0], [-9.0]]
    rows = list(enumerate(rows))
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    got = embeddings.near_duplicates(frame, exact=exact).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_recall_over_all_rows_of_a_table(spark):
    """The whole table, and two noisy copies of every row on either side of the threshold."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    base = np.array([r.embedding for r in table.orderBy("vec_id").collect()], float)
    noise = np.random.default_rng(5).standard_normal((2, *base.shape)) / 8
    size = np.linalg.norm(base, axis=1, keepdims=True)
    copies = [base + size * share * n for share, n in zip((0.25, 0.33), noise, strict=True)]
    rows = list(enumerate(np.concatenate([base, *copies]).tolist()))
    unit = embeddings.units(np.array([v for _, v in rows]))
    near = unit @ unit.T >= embeddings.THRESHOLD
    wanted = near.sum(axis=1) - 1
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<double>").repartition(4)
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(frame).collect()}
    assert len(got) == len(rows) and wanted.sum() > 3000
    assert all(got[k] <= wanted[k] for k in got)
    assert sum(got.values()) >= 0.999 * wanted.sum()


def test_bounds_hold_for_the_estimate():
    rng = np.random.default_rng(2)
    unit = embeddings.units(rng.standard_normal((400, 64)))
    near = embeddings.units(unit + 0.03 * rng.standard_normal(unit.shape))
    code, factor = embeddings.codes(unit)
    exact = unit @ near.T >= embeddings.THRESHOLD
    assert exact.sum() > 300
    assert (embeddings.linked(unit, near, code, factor) == exact).all()


def test_other_columns_and_empty_tables(spark):
    frame = spark.createDataFrame(
        [(1, [1.0, 2.0], "x", "y"), (None, None, "x", "y")], "vec_id int, embedding array<float>, kept string, cid string"
    )
    got = embeddings.near_duplicates(frame)
    assert sorted(got.columns) == ["cid", "component_id", "kept", "n_links", "vec_id"]
    assert sorted(map(repr, got.select("vec_id", "n_links", "kept", "cid").collect()))
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0
