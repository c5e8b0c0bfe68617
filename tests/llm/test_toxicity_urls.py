import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tristrata.llm import toxicity, urls
from tristrata.llm.queries import URL_RULES, op5_toxicity, op7_urls

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = op5_toxicity(spark, SF_DIR).join(labels, "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.8
    assert n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.95


@pytest.mark.parametrize("sf, recall, precision", [("0.001", 0.5, 0.8), ("0.01", 0.65, 0.8), ("0.1", 0.9, 0.75)])
def test_recall_and_precision_over_all_folds(sf, recall, precision):
    """Labels of 11, 51 and 450 toxic texts, each judged by a fit that has not seen it."""
    connection = duckdb.connect()
    folder = f"/root/testdata/sf{sf}"
    texts = connection.execute(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    labels = f"SELECT doc_id, max(toxic) FROM '{folder}/labels.parquet' GROUP BY doc_id"
    labels = dict(connection.execute(labels).fetchall())
    sets = {
        key: sorted({f for w in set((text or "").lower().split()) for f in toxicity.features(w)})
        for key, text in texts
    }
    hits = {(mark, guess): 0 for mark in (0, 1) for guess in (False, True)}
    for k in range(5):
        held = {key for key in sets if zlib.crc32(str(key).encode()) % 5 == k}
        train = [key for key in sets if key not in held]
        marks = [mark for key, mark in labels.items() if key not in held]
        positive = [sets[key] for key in train if labels.get(key) == 1]
        unlabelled = [sets[key] for key in train][: toxicity.MOST_UNLABELLED]
        weights = toxicity.fit(positive, unlabelled, sum(marks) / len(marks))
        for key in held & labels.keys():
            score = weights[-1] + sum(weights.get(f, 0.0) for f in sets[key])
            hits[labels[key], score >= 0] += 1
    assert hits[1, True] / (hits[1, True] + hits[1, False]) >= recall
    assert hits[1, True] / (hits[1, True] + hits[0, True]) >= precision


def test_unlabelled_positives_do_not_count_as_clean():
    rng = np.random.default_rng(0)
    noise = lambda: sorted(rng.choice(300, 20, replace=False).tolist())
    positive = [sorted({*noise(), 1000}) for _ in range(300)]
    unlabelled = [sorted({*noise(), 1000} if k % 3 == 0 else noise()) for k in range(900)]
    weights = toxicity.fit(positive, unlabelled, 1 / 3)
    assert weights[1000] + weights[-1] > 1 and weights[-1] < 0


def test_labels_of_held_out_rows_are_not_read(spark, odd_docs):
    held_out = F.col("doc_id") == 1
    scores = []
    for mark in (0, 1):
        labels = spark.createDataFrame([(1, mark), (2, 0), (7, 1), (None, 1)], "doc_id long, toxic int")
        scores.append(sorted(map(repr, toxicity.classify(odd_docs, labels, held_out).collect())))
    assert scores[0] == scores[1]


def test_toxicity_odd_rows(spark, clashing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.classify(clashing, labels, F.lit(False))
    assert got.count() == clashing.count() and got.where("text is null").count() == 2
    assert {r.predicted for r in got.collect()} == {0}
    assert toxicity.classify(clashing.limit(0), labels, F.lit(False)).count() == 0


@pytest.mark.parametrize("key", ["if(id % 3 = 0, null, id)", "if(id % 3 = 0, 7, id)"])
def test_sample_of_the_fit_is_bounded_and_even(spark, monkeypatch, key):
    monkeypatch.setattr(toxicity, "MOST_UNLABELLED", 600)
    monkeypatch.setattr(toxicity, "MOST_POSITIVE", 300)
    sizes, fit = spark.sparkContext.accumulator(0), toxicity.fit
    hot = spark.sparkContext.accumulator(0)
    mark = toxicity.features("hot")[0]

    def counted(positive, unlabelled, prior):
        sizes.add(len(unlabelled) + 10_000 * len(positive))
        hot.add(sum(mark in x for x in unlabelled))
        return fit(positive, unlabelled, prior)

    monkeypatch.setattr(toxicity, "fit", counted)
    text = "if(id % 3 = 0, 'hot', concat('cold ', id)) as text"
    docs = spark.range(30_000).selectExpr(f"{key} as doc_id", text)
    labels = spark.range(1000, 3000).selectExpr("id as doc_id", "cast(id % 3 > 0 as int) as toxic")
    assert toxicity.classify(docs, labels, F.lit(False)).count() == 30_000
    assert sizes.value == 600 + 10_000 * 300 and abs(hot.value - 200) < 60


@pytest.mark.parametrize("kind", [np.ndarray.tolist, lambda x: x.astype(toxicity.NUMBER)])
def test_memory_of_the_fit(kind):
    """The fit takes a few bytes for a feature number, and no table of floats over all numbers."""
    rng = np.random.default_rng(1)
    draw = lambda mark: kind(np.unique(np.append(rng.integers(0, toxicity.FEATURES, 500), mark)))
    positive, unlabelled = [draw([5]) for _ in range(300)], [draw([]) for _ in range(600)]
    tracemalloc.start()
    try:
        weights = toxicity.fit(positive, unlabelled, 0.2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert weights[5] > 0 and peak < 100e6


def test_sets_travel_as_bytes_in_the_order_of_their_numbers(spark):
    texts = ["b a a", "alphabet", "", None, "Alphabet soup", "a"]
    frame = spark.createDataFrame([(t, True, 1) for t in texts], "text string, mark boolean, turn long")
    rows = toxicity.feature_sets(frame, "text", "mark", "turn").collect()
    got = [np.frombuffer(r.features, toxicity.NUMBER).tolist() for r in rows]
    wanted = [
        sorted({f for w in (t or "").lower().split() for f in toxicity.features(w)}) for t in texts
    ]
    assert sorted(got) == sorted(wanted)
    ordered = sorted(bytes(r.features) for r in rows)
    assert [np.frombuffer(x, toxicity.NUMBER).tolist() for x in ordered] == sorted(wanted)


def test_logits_sum_the_distinct_features_of_a_text():
    texts = ["", "no such", "bad bad badly BAD", "a bad  end", " \n", "badge"]
    model = {f: 0.1 * k for k, f in enumerate(sorted({*toxicity.features("badly"), *toxicity.features("end")}), 1)}
    model[-1] = -0.7
    for few in (texts, texts[:1], []):
        got = toxicity.logits(pa.array(few, pa.string()), model)
        wanted = [
            sum((model.get(f, 0.0) for f in sorted({f for w in t.lower().split() for f in toxicity.features(w)})), -0.7)
            for t in few
        ]
        assert got.tolist() == wanted


def test_rules_and_parts(spark):
    rows = [
        (1, "HTTPS://A.Example.ORG/es/1?x#y"),
        (2, "http://org"),
        (3, "http://org/"),
        (4, "http://notexample.org/es/"),
        (5, "http://x.com/de/a"),
        (6, "x.com/de/a"),
        (7, None),
        (8, "a://b.example.org/en/1#z"),
        (9, "http://x.com?u=://y.org/"),
    ]
    frame = spark.createDataFrame(rows, "page_id int, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(frame, URL_RULES).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[2][:3] == ("org", "", None)
    assert got[3] == ("org", "/", "org/", "allow")
    assert got[4] == ("notexample.org", "/es/", "org/", "allow")
    assert got[5][2:] == ("com/de/", "block")
    assert got[6][:3] == got[7][:3] == ("", "", None)
    assert got[8][2:] == ("example.org/en/1", "block")
    assert got[9][:3] == ("x.com", "", None)
    assert urls.judge(frame.limit(0), URL_RULES).count() == 0


def test_log_ratios_equal_a_plain_model(spark):
    sf = "/root/testdata/sf0.001"
    got = op7_urls(spark, sf).collect()
    texts = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    frame = spark.createDataFrame([(u,) for u in texts.values()], "u string").select(
        "u", (F.pmod(F.xxhash64("u"), F.lit(5)) == 0).alias("apart")
    )
    apart = {r.u for r in frame.where("apart").collect()}
    taught = {True: [], False: []}
    for r in got:
        if r.rule and texts[r.page_id] not in apart:
            taught[r.verdict == "allow"].append(texts[r.page_id])

    def symbols(url):
        return [0] * urls.ORDER + [int(urls.CLASS[b]) for b in (url or "").encode()] + [0]

    def model(side):
        seen = {}
        for url in side:
            line = symbols(url)
            for k in range(urls.ORDER, len(line)):
                for j in range(urls.ORDER + 1):
                    context = seen.setdefault(tuple(line[k - j : k]), {})
                    context[line[k]] = context.get(line[k], 0) + 1
        return seen

    def log_p(seen, line, k):
        p = 1 / urls.SYMBOLS
        for j in range(urls.ORDER + 1):
            c = seen.get(tuple(line[k - j : k]), {})
            kinds = max(1, len(c))
            p = (c.get(line[k], 0) + kinds * p) / (sum(c.values()) + kinds)
        return np.log(p)

    good, bad = model(taught[True]), model(taught[False])
    for r in got:
        line = symbols(texts[r.page_id])
        mean = np.mean([log_p(good, line, k) - log_p(bad, line, k) for k in range(urls.ORDER, len(line))])
        assert r.log_ratio == pytest.approx(mean, abs=1e-5)


def test_feature_numbers():
    assert toxicity.features("abcd")[0] == zlib.crc32(b"abcd ") % toxicity.FEATURES
    assert len(toxicity.features("ab")) == 1
