"""Ranked search against a plain score of every document."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tristrata.llm import search

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return PATTERN.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    bags = [(i, terms(t)) for i, t in docs]
    total_docs = sum(1 for _, b in bags if b)
    total = sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            score = 0
            for t in set(terms(text)):
                tf = b.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * total_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 90 + (90 * len(b) * total_docs) // total
                    score += w * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        found.sort(key=lambda x: x[:3])
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(found[:k])]
    return sorted(out, key=repr)


def answers(spark, docs, items, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    queries = spark.createDataFrame(items, "item_id long, text string")
    found = search.search(search.build_index(frame), queries, **options).collect()
    return sorted((tuple(r) for r in found), key=repr)


ODD = [
    (1, "The quick BROWN fox, the lazy dog."),
    (2, "the quick brown fox the lazy dog"),
    (2, "the quick brown fox the lazy dog"),
    (3, None),
    (4, ""),
    (5, " .,;:!? \t\n\x00\x7f[]{}"),
    (6, "Ünïcode ÄPFEL äpfel 中文字 🌊wave  x"),
    (None, "fox fox fox dog"),
    (None, "fox fox fox dog"),
    (-7, "fox fox fox dog"),
    (8, "a " * 30_000 + "rare"),
    (9, "İstanbul KK 0x1F a_b-c"),
]
ITEMS = [
    (1, "fox dog"),
    (2, "Äpfel äpfel ÄPFEL"),
    (3, None),
    (4, "... ,,,"),
    (5, "zzz"),
    (6, "the a rare 中文字 🌊wave"),
    (6, "lazy"),
    (7, "kK c b 0X1f"),
    (None, "quick"),
]


def test_odd_rows(spark):
    assert answers(spark, ODD, ITEMS) == brute(ODD, ITEMS)
    assert answers(spark, ODD, ITEMS, k=1) == brute(ODD, ITEMS, 1)
    assert answers(spark, ODD, []) == [] and answers(spark, [], ITEMS) == []
    assert answers(spark, [(1, ""), (2, None)], ITEMS) == []


@pytest.mark.parametrize("leaf, wide, pairs", [(1, 1, 10), (24, 8, 1 << 20)])
def test_many_documents_in_small_blocks(spark, monkeypatch, leaf, wide, pairs):
    for name, value in (("LEAF", leaf), ("WIDE", wide), ("PAIRS", pairs), ("GROUP_BYTES", 300)):
        monkeypatch.setattr(search, name, value)
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(60)]
    weight = 1 / np.arange(1, 61)
    weight /= weight.sum()
    docs = [
        (int(k), " ".join(rng.choice(words, rng.integers(0, 30), p=weight))) for k in range(400)
    ]
    docs += [(int(k), docs[5][1]) for k in rng.integers(0, 2000, 120)]  # many equal scores
    items = [(k, " ".join(rng.choice(words, rng.integers(1, 12)))) for k in range(25)]
    items.append((99, docs[5][1]))
    assert answers(spark, docs, items) == brute(docs, items)


def test_a_block_is_searched_without_scoring_every_document(monkeypatch):
    """A passage that a few documents hold: most documents are never scored."""
    rng = np.random.default_rng(4)
    words = np.array([f"w{k}" for k in range(3000)])
    texts = [" ".join(rng.choice(words, 60)) for _ in range(4000)]
    passage = " ".join(f"p{k}" for k in range(20))
    for k in range(12):
        texts[300 * k] += " " + passage
    row = search.block_row(pa.chunked_array([pa.array(range(4000))]), pa.array(texts))
    _, found = search.terms_of(pa.array([passage + " w1 w2 w3 w4 w5 w6 w7 w8"]))
    names = found.dictionary
    weights = np.full(len(names), 500)
    lists = search.Postings(row["lexicon"], row["postings"], names, weights, 4000, row["terms"])
    scored = []
    plain = search.summed
    monkeypatch.setattr(search, "summed", lambda w, v, n: scored.append(n) or plain(w, v, n))
    best = search.Best(1, 10)
    search.search_block(lists, np.array([0, len(names)]), np.arange(len(names)), best)
    assert set(best.id[0] % 300) == {0} and sum(scored) < 400


def test_clashing_names_and_other_columns(spark):
    docs = spark.createDataFrame(ODD, "key long, body string")
    names = ("id", "text", "score", "rank", "query", "part", "doc_id", "docs", "a.b")
    docs = docs.withColumns({c: F.lit(f"own {c}") for c in names})
    queries = spark.createDataFrame(ITEMS, "qid long, body string")
    queries = queries.withColumns({c: F.lit(f"own {c}") for c in names})
    index = search.build_index(docs, "key", "body")
    found = search.search(index, queries, "qid", "body").collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(ODD, ITEMS)


def test_summed_is_exact_beyond_doubles():
    values = np.array([(1 << 60) + 1, 3, 5])
    assert search.summed(np.array([1, 1, 0]), values, 3).tolist() == [5, (1 << 60) + 4, 0]
