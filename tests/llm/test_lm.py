import collections
import math

import pytest
from pyspark.sql import functions as F

from tristrata.llm import lm
from tristrata.llm.storage import stored


def model(texts, order):
    """Counts of each symbol after each context."""
    found = collections.defaultdict(collections.Counter)
    for text in texts:
        line = [lm.END] * order + list(text) + [lm.END]
        for k in range(order, len(line)):
            for j in range(order + 1):
                found[tuple(line[k - j : k])][line[k]] += 1
    return found


def log_probability(found, line, k, order):
    out, total = set(), 0.0
    for j in range(order, -1, -1):
        left = {s: n for s, n in found.get(tuple(line[k - j : k]), {}).items() if s not in out}
        if left:
            whole = sum(left.values()) + len(left)
            if line[k] in left:
                return total + math.log10(left[line[k]] / whole)
            total += math.log10(len(left) / whole)
            out |= set(left)
    return total - math.log10(lm.SYMBOLS - len(out))


@pytest.mark.parametrize("order", [2, lm.ORDER])
def test_scores_equal_a_plain_trie(odd_docs, order):
    held_out = F.col("doc_id").isin(3, 9, 11)
    got = lm.score(odd_docs.where("doc_id <> 12"), held_out, order=order).collect()
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd_docs.where("doc_id <> 12").collect()]
    train = [t for k, t in rows if k not in (3, 9, 11)]
    found = model(train, order)
    words = collections.Counter(w for t in train for w in t.lower().split())
    words[None] = len(train)
    whole = math.log10(sum(words.values()) + 0.5 * (len(words) + 1))
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        line = [lm.END] * order + list(texts[r.doc_id]) + [lm.END]
        score = sum(log_probability(found, line, k, order) for k in range(order, len(line)))
        tokens = [*texts[r.doc_id].lower().split(), None]
        base = sum(math.log10(words[w] + 0.5) - whole for w in tokens)
        assert r.score == pytest.approx(score, rel=1e-5)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.n_tokens, r.n_known) == (len(tokens), sum(words[w] > 0 for w in tokens))
        assert r.train_tokens == sum(words.values())


def test_probabilities_sum_to_one():
    found = model([b"abracadabra", b"abrade"], 3)
    for context in (b"abr", b"bra", b"zzz", b"\xff\xff\xff"):
        total = sum(
            10 ** log_probability(found, [*context, s], 3, 3) for s in range(lm.SYMBOLS)
        )
        assert total == pytest.approx(1)


def test_other_columns_nothing_to_learn_from_and_empty_tables(clashing):
    alone = lm.score(clashing.where("doc_id in (4, 7)"), F.lit(True))
    assert {"a.b", "k0", "n", "block"} <= set(alone.columns) and "text" not in alone.columns
    scores = {r.doc_id: (r.score, r.n_known) for r in alone.collect()}
    assert scores[4] == (pytest.approx(-math.log10(256)), 0)
    assert scores[7][0] == pytest.approx(-11 * math.log10(256), rel=1e-6)
    assert lm.score(clashing.limit(0), F.lit(False)).count() == 0


def test_small_partitions_share_blocks_and_levels_are_worked_out_once(spark, monkeypatch):
    kept = {}

    def store(df, label):
        kept.setdefault(label, []).append(stored(df, label))
        return kept[label][-1]

    monkeypatch.setattr(lm, "stored", store)
    text = F.concat_ws(" ", F.lit("one and the same line"), F.col("id") % 7)
    docs = spark.range(60).select(F.col("id").alias("doc_id"), text.alias("text"))
    docs = stored(docs.repartition(20), "docs")
    scored = lm.score(docs, F.col("doc_id") % 5 == 1)
    assert scored.count() == 60
    assert kept["lm-requests"][0].select("block").distinct().count() == 1
    assert len(kept["lm-level"]) == lm.ORDER
    level = kept["lm-level"][0]
    assert level.count() == level.select("g").distinct().count()
