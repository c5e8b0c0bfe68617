"""Each stage on a small corpus, against brute force where it decides."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from test_jaccard import brute
from test_repeats import brute_across
from tristrata.llm import bpe
from tristrata.llm.storage import stored

SF_DIR = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    """The real stages, each on what the one before kept, against brute force."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_copies", "repeats", "mixing", "encoding"]
    stages = dict(pipeline.STAGES)

    def stage(name, before):
        return stored(stages[name](spark, before, SF_DIR), name)

    clean = stage("toxicity", docs)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    left = {r.toxic: r["count"] for r in clean.join(labels, "doc_id").groupBy("toxic").count().collect()}
    whole = {r.toxic: r["count"] for r in labels.join(docs, "doc_id").groupBy("toxic").count().collect()}
    assert left.get(1, 0) <= 0.4 * whole[1] and left[0] >= 0.97 * whole[0]

    single = stage("near_copies", clean)
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    firsts = {eval(x)[0] for x in brute(rows) if eval(x)[0] == eval(x)[2]}
    assert {r.doc_id for r in single.collect()} == firsts < {key for key, _ in rows}

    cut = stage("repeats", single)
    before = sorted((r.doc_id, r.text or "") for r in single.collect())
    wanted = brute_across([t.encode() for _, t in before], 200, 50, ordered=True)
    expected = {
        key: text for (key, old), text in zip(before, wanted, strict=True) if text or not old
    }
    got = {r.doc_id: r for r in cut.collect()}
    assert {key: r.text or "" for key, r in got.items()} == expected
    assert all(r.n_chars == len(r.text or "") for r in got.values())

    mixed = stage("mixing", cut)
    assert mixed.columns == pipeline.COLUMNS
    texts = {key: r.text for key, r in got.items()}
    assert all(texts[r.doc_id] == r.text for r in mixed.collect())
    encoded = stage("encoding", mixed)
    assert encoded.columns == ["doc_id", "lang", "source", "n_chars", "ids", "n_tokens"]
    path = public_tokenizers.path(pipeline.VOCABULARY)
    back = sorted((r.doc_id, bytes(r.decoded).decode()) for r in bpe.decode(encoded, path).collect())
    assert back == sorted((r.doc_id, r.text or "") for r in mixed.collect())


def test_passages_of_over_fifty_words_go_and_short_ones_stay(spark):
    """Planted passages at either side of the bound, among documents of their own."""
    rng = np.random.default_rng(12)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdefghijkl"), rng.integers(2, 9))) for _ in range(n))

    long, short = [prose(51) for _ in range(4)], [prose(40) for _ in range(4)]
    texts = []
    for k in range(4):
        texts += [f"{prose(30)} {long[k]} {prose(60)}" for _ in range(3)]
        texts += [f"{prose(30)} {short[k]} {prose(60)}" for _ in range(3)]
    own = prose(55)
    texts += [prose(100) for _ in range(30)] + [f"{own} {own} {prose(9)}", "was " * 300]
    docs = spark.createDataFrame(
        [(k, t, "en", "a", len(t)) for k, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    left = {r.doc_id: r.text for r in pipeline.without_repeats(spark, docs, SF_DIR).collect()}
    for k, text in enumerate(texts):
        planted = [p for p in long if p in text]
        assert (left[k] == text) == (not planted)
        assert not any(p in left[k] for p in planted)


def test_whole_run(spark):
    out = pipeline.run(spark, SF_DIR)
    assert out.count() > 0 and out.where(F.col("n_tokens") == 0).count() == 0


def test_one_row_of_repeated_rows_null_keys_and_keys_of_two_texts(spark):
    texts = [" ".join(f"{name}{k}" for k in range(120)) for name in "abcd"]
    rows = [(1, texts[0]), (1, texts[0])]  # a row that occurs twice
    rows += [(None, texts[1])] * 2 + [(2, texts[1])]
    rows += [(None, texts[2])] * 3
    rows += [(3, texts[0]), (3, texts[3])]  # one text is a copy, the other is not
    rows += [(4, None), (None, ""), (None, "")]
    docs = spark.createDataFrame([(k, t, "en", "a", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    single = pipeline.one_of_near_copies(spark, docs, SF_DIR)
    left = sorted(((r.doc_id, r.text) for r in single.collect()), key=repr)
    wanted = [(1, texts[0]), (2, texts[1]), (None, texts[2]), (3, texts[3])] + rows[-3:]
    assert left == sorted(wanted, key=repr)
    whole = pipeline.without_repeats(spark, single, SF_DIR)
    assert {r.text for r in whole.collect() if r.text} == set(texts)
