"""Quality rules, sharding and mixing on odd rows."""

import collections

import pytest

from tristrata.llm import mixing, quality, queries, sharding

SHARDS = [f"s{k}" for k in range(5)]


def test_quality_counts(odd_docs):
    found = {r.doc_id: r for r in quality.judge(odd_docs).collect() if r.doc_id}
    assert (found[1].n_words, found[1].word_chars, found[1].n_repeat_words) == (7, 27, 0)
    assert found[12].n_repeat_words == 20 and found[12].base_failed
    assert found[4].n_words == found[5].n_words == found[6].n_words == 0
    assert found[4].failed == ["too_few_words"] and not found[4].kept


def test_quality_lines_and_symbols(spark):
    text = "a # line\nother\na # line\n\n  \nother \n"
    row = quality.judge(spark.createDataFrame([(text,)], "text string")).first()
    assert (row.n_dup_lines, row.n_symbols, row.n_lines) == (1, 2, 4)


def test_quality_windows_overlap(spark):
    words = "p q r s t u p q r s t u v".split()
    row = quality.judge(spark.createDataFrame([(" ".join(words),)], "text string")).first()
    assert row.n_repeat_words == 12


def test_quality_keeps_columns_and_empty_tables(clashing):
    judged = quality.judge(clashing)
    assert set(clashing.columns) <= set(judged.columns) and judged.first()["a.b"] == "own a.b"
    assert quality.judge(clashing.limit(0)).count() == 0
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_shards_are_even_and_stable(spark):
    table = [r.shard for r in sharding.lookup_table(spark, SHARDS, 251).orderBy("slot").collect()]
    sizes = collections.Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    fewer = [r.shard for r in sharding.lookup_table(spark, SHARDS[:-1], 251).orderBy("slot").collect()]
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != SHARDS[-1])
    assert moved < 251 * 0.2
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, SHARDS, 250)
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, [])


def test_every_row_has_a_shard(spark, clashing):
    table = sharding.lookup_table(spark, SHARDS, 251)
    placed = sharding.place(clashing, table, "doc_id", ("text",), 251)
    assert placed.count() == clashing.count()
    assert placed.where("shard is null").count() == 0
    twelve = {r.shard for r in placed.where("doc_id = 12").collect()}
    assert len(twelve) == 1
    assert sharding.place(clashing.limit(0), table, "doc_id", (), 251).count() == 0


def test_mixing_reaches_its_shares(spark):
    df = spark.range(20_000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then 'hot' when id < 40 then 'tiny' else 'rest' end as source"
    )
    mixed = mixing.mix(df, {"hot": 0.1, "tiny": 0.2}).collect()
    share = collections.Counter(r.source for r in mixed)
    assert abs(len(mixed) - 20_000) < 900
    assert abs(share["hot"] / len(mixed) - 0.1) < 0.01
    assert abs(share["tiny"] / len(mixed) - 0.2) < 0.02
    assert [r.position for r in mixed] == sorted(r.position for r in mixed)
    assert len({(r.doc_id, r.copy) for r in mixed}) == len(mixed)


def test_mixing_odd_rows(clashing):
    mixed = mixing.mix(clashing, {"a": 0.5, "absent": 0.1})
    assert set(mixed.columns) == set(clashing.columns)
    again = mixing.mix(clashing, {"a": 0.5, "absent": 0.1})
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, again.collect()))
    assert mixing.mix(clashing.limit(0), {"a": 0.5}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(clashing, {"a": 1.5})


@pytest.mark.parametrize("key", ["cast(null as long)", "5L"])
def test_mixing_draws_for_rows_of_one_key_apart(spark, key):
    same = "case when id % 2 = 0 then 'the same text' else concat('text ', id) end as text"
    df = spark.range(4000).selectExpr(f"{key} as doc_id", same, "if(id < 3000, 'hot', 'rest') as source")
    mixed = mixing.mix(df, {"hot": 0.15}).collect()
    share = collections.Counter(r.source for r in mixed)
    assert abs(share["hot"] - 600) < 120 and abs(len(mixed) - 4000) < 350
    assert len({r.position for r in mixed}) == len(mixed)
    equal = [r for r in mixed if r.source == "hot" and r.text == "the same text"]
    assert abs(len(equal) - 300) < 90
    assert mixed == mixing.mix(df, {"hot": 0.15}).collect()


def test_mixing_query_mixes_whole_documents(spark, monkeypatch):
    sf, kept = "/root/testdata/sf0.001", []
    keep = lambda df, label: kept.append(queries_stored(df, label)) or kept[-1]
    queries_stored = queries.stored
    monkeypatch.setattr(queries, "stored", keep)
    result = queries.op9_mixing(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    (mixture,) = kept
    assert set(mixture.columns) == {*docs.columns, "copy", "position"}
    assert mixture.select(docs.columns).exceptAll(docs.crossJoin(spark.range(64)).drop("id")).count() == 0
    assert mixture.select(result.columns).exceptAll(result).count() == 0 < result.count() == mixture.count()
