import collections

import numpy as np
import pytest

from tristrata.llm import jaccard


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows):
    """Size and least key linked, by comparing all rows that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owners = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            owners[x].append(k)
    pairs = {(i, j) for o in owners.values() for i in o for j in o if i < j}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            parent[find(i)] = find(j)
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[find(k)] = min(key, least.get(find(k), key))
    return sorted(
        repr((key, len(sets[k]), least.get(find(k), key) if sets[k] else key))
        for k, (key, _) in enumerate(rows)
    )


def found(frame):
    rows = jaccard.components(frame).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(repr(tuple(r)) for r in rows)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert found(odd_docs.select("doc_id", "text")) == brute(rows)


@pytest.mark.parametrize("rare", [1, 3, jaccard.RARE])
def test_groups_chains_and_shared_passages(spark, monkeypatch, rare):
    monkeypatch.setattr(jaccard, "RARE", rare)
    rng = np.random.default_rng(3)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 100_000, n)]
    texts, passage = [], word(30)
    for _ in range(12):
        base = word(int(rng.integers(8, 90)))
        for _ in range(int(rng.integers(1, 9))):
            copy = list(base)
            for at in rng.integers(0, len(base), int(rng.integers(0, 4))):
                copy[at] = f"new{rng.integers(0, 9)}"
            texts.append(copy)
    texts += [word(int(rng.integers(0, 40))) + passage + word(int(rng.integers(0, 12))) for _ in range(25)]
    chain = word(60)
    texts += [chain[k : k + 40] for k in range(0, 20, 3)]  # only neighbours are alike
    texts += [word(n) for n in (0, 1, 2, 3, 4, 5)] + [["same", "words"]] * 4
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    assert found(spark.createDataFrame(rows, "doc_id int, text string")) == brute(rows)


def test_prefixes_share_enough_tokens():
    for n in range(1, 400):
        for m in range(jaccard.least_overlap(n), n + 1):
            groups = jaccard.groups_for(m)
            assert groups in jaccard.levels(n) and groups in jaccard.levels(m)
            assert groups == 1 or groups + 1 <= jaccard.least_overlap(n)


def test_one_of_each_group_and_other_columns(clashing):
    kept = jaccard.one_each(clashing)
    assert set(kept.columns) == set(clashing.columns)
    keys = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert keys == [1, 4, 5, 6, 7, 8, 10, 11, 12, 12]
    assert kept.where("doc_id is null").count() == 2
    assert jaccard.components(clashing.limit(0)).count() == 0
