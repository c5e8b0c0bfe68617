import collections
import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tristrata.llm import queries, repeats
from tristrata.llm.storage import stored
from tristrata.llm.suffixes import Row, suffix_array


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=80), st.integers(1, 3))
def test_suffixes_are_in_order(symbols, times):
    line = (symbols * times)[:160]
    row = Row(np.array(line, np.uint16), 200)
    order = suffix_array(row)
    assert [line[p:] for p in order] == sorted(line[p:] for p in range(len(line)))
    assert sorted(order.tolist()) == list(range(len(line)))
    some = np.arange(len(line)) % 3 == 1
    part = [p for p in suffix_array(row, some).tolist() if some[p]]
    assert [line[p:] for p in part] == sorted(line[p:] for p in range(len(line)) if some[p])
    assert sorted(part) == np.flatnonzero(some).tolist()


def brute(texts, length=400):
    starts = [range(len(t) - length + 1) for t in texts]
    seen = collections.Counter(
        t[p : p + length] for t, places in zip(texts, starts, strict=True) for p in places
    )
    out = []
    for t, places in zip(texts, starts, strict=True):
        gone = np.zeros(len(t), bool)
        for p in places:
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        left = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def counts(frame, **options):
    found = repeats.repeat_counts(frame, **options).collect()
    return sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)


def test_odd_rows(odd_docs):
    assert counts(odd_docs) == brute([(r.text or "").encode() for r in odd_docs.collect()])


@pytest.mark.parametrize("group", [3, repeats.GROUP])
def test_shared_passages_in_small_and_large_groups(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rng = np.random.default_rng(5)

    def noise(n):
        return "".join(rng.choice(list("abcdefgh "), n))

    passage, other = noise(700), noise(450)
    texts = [noise(200) + passage[k % 5 :] + noise(300) for k in range(25)]
    texts += [other + noise(500), noise(90) + other, "xy" * 700, "z" * 400, "z" * 399]
    texts += [texts[0], passage[:399] + "Q", noise(1000)]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    whole = [t.encode() for t in texts]
    assert counts(frame) == brute(whole)
    for length in (128, 200, 450, 701):
        assert counts(frame, length=length) == brute(whole, length)
    with pytest.raises(ValueError):
        counts(frame, length=100)


@pytest.mark.parametrize("across", [False, True])
def test_a_common_passage_sends_few_digests(spark, monkeypatch, across):
    """Of an anchor in many texts, most windows are not shared and need no digest of their own."""
    rng = np.random.default_rng(7)

    def noise(n):
        return "".join(rng.choice(list("abcdefgh "), n))

    passage = noise(600)
    texts = [noise(380) + passage + noise(370) + "é" for _ in range(120)]
    texts += [texts[0], texts[1] + noise(30), passage[100:] + noise(420), noise(9) + passage[:450]]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    kept = {}

    def noted(df, label):
        kept[label] = stored(df, label)
        return kept[label]

    monkeypatch.setattr(repeats, "GROUP", 30)
    monkeypatch.setattr(repeats, "stored", noted)
    whole = [t.encode() for t in texts]
    if across:
        left = repeats.remove_repeats(frame, across=True).collect()
        assert sorted(r.text for r in left) == brute_across(whole, 400, 0)
    else:
        assert counts(frame) == brute(whole)
    # of about 2 * 400 windows in each text that reach over an end of the passage
    assert kept["repeat-windows"].count() < 40 * len(texts)


def brute_across(texts, length, words, ordered=False):
    """What is left of each text: runs of ``words`` words or more that another text starts too."""
    owners = collections.defaultdict(set)
    for k, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            owners[t[p : p + length]].add(k)
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - length + 1):
            if len(owners[t[p : p + length]]) > 1:
                gone[p + 1 : p + 1 + length] = True
        edges = np.flatnonzero(np.diff(gone.astype(int)))
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            starts = [m.span() for m in re.finditer(rb"\S+", t)]
            if sum(a <= x and y <= b for x, y in starts) < words:
                gone[a + 1 : b + 1] = False
        out.append(np.frombuffer(t, np.uint8)[~gone[1:-1]].tobytes().decode(errors="ignore"))
    return out if ordered else sorted(out)


@pytest.mark.parametrize("group", [2, repeats.GROUP])
def test_passages_of_other_texts_only(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rng = np.random.default_rng(9)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(1, 9))) for _ in range(n))

    long, short, own, words = prose(60), "x" * 30 + " " + "y" * 300, prose(70), prose(49)
    texts = [prose(30) + " " + long + " " + prose(20) for _ in range(7)]
    texts += [prose(40) + " " + short + " " + prose(9), short, short + prose(5)]
    texts += [own + " / " + own + " " + prose(10), "was " * 400, long + long, long[3:] + "x" + prose(8)]
    texts += [words + prose(30), prose(12) + words, texts[0], "is " * 300, "is " * 300, "", "short"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    for least in (0, 50):
        left = repeats.remove_repeats(frame, length=200, across=True, words=least).collect()
        assert sorted(r.text for r in left) == brute_across([t.encode() for t in texts], 200, least)


@pytest.mark.parametrize("group", [2, repeats.GROUP])
def test_the_query_counts_passages_of_fifty_words_that_it_leaves(spark, monkeypatch, tmp_path, group):
    """Passages below 400 bytes stay in the text, as they must, but are counted."""
    monkeypatch.setattr(repeats, "GROUP", group)
    rng = np.random.default_rng(11)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(n))

    planted, few, long, own = prose(58)[:390], "w" * 150 + " " + prose(30)[:200], prose(150), prose(60)
    assert len(planted) < 400 and len(planted.split()) > 50
    texts = [f"{prose(40)} {planted} {prose(30)}" for _ in range(4)]
    texts += [f"{prose(9)} {few} {prose(60)}", f"{few} {prose(9)}", prose(300), prose(300), f"{own} / {own}"]
    texts += [f"{prose(5)} {long} {planted}", f"{long} {prose(60)}", f"{planted} {planted} {prose(3)}"]
    texts += [texts[6], texts[0], "é " * 300, f"{'é ' * 300}u", None, "", "is " * 66, "is " * 66]
    rows = [(k, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in queries.op3_repeats(spark, str(tmp_path)).collect()}
    whole = [(t or "").encode() for t in texts]
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.values())
    assert got == brute(whole)
    left = brute_across(whole, 200, 50, ordered=True)
    lost = [len(t) - len(x.encode()) for t, x in zip(whole, left, strict=True)]
    assert [found[k].n_passage_bytes for k in range(len(texts))] == lost
    assert [found[k].n_passages for k in range(12)] == [1, 1, 1, 1, 0, 0, 1, 0, 0, 1, 1, 1]
    assert all(found[k].n_passages == (lost[k] > 0) for k in range(12, len(texts)))
    with pytest.raises(ValueError):
        repeats.repeat_counts(frame, passage={"length": 400, "across": True, "words": 50})


def test_texts_without_their_repeats(odd_docs, clashing):
    left = {r.doc_id: r.text for r in repeats.remove_repeats(odd_docs).collect() if r.doc_id}
    assert left[4] is None and left[7] == "short text"
    assert left[10].startswith("in front ") and "heron" not in left[11]
    assert left[11].endswith("ähnlich — 中文  zwei\n\n drei")
    assert set(repeats.remove_repeats(clashing).columns) == set(clashing.columns)
    assert repeats.repeat_counts(clashing.limit(0)).count() == 0
