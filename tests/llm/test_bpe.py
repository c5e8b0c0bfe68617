import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tristrata.llm import bpe
from tristrata.llm.queries import VOCABULARY, op10_bpe

PATH, PATTERN = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
PIECES = ["a", "B", "é", "12", "'s", " ", "  ", "\n", "\t", "\u3000", "\xa0", "\x1c", "!", "中", "\x85"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=6))
def test_cuts_never_change_the_ids(texts):
    tool = bpe.encoder(PATH, PATTERN)
    n, flat, words = bpe.pretokens(pa.array(texts, pa.string()))
    words, ends = words.to_pylist(), np.cumsum(n)
    for text, a, b in zip(texts, ends - n, ends, strict=True):
        units = [words[k] for k in flat[a:b]]
        assert "".join(units) == text
        assert [i for u in units for i in tool.encode_ordinary(u)] == tool.encode_ordinary(text)


def test_ids_and_bytes_of_odd_rows(odd_docs):
    tool = bpe.encoder(PATH, PATTERN)
    encoded = bpe.encode(odd_docs.withColumnRenamed("text", "words"), PATH, PATTERN, text="words")
    decoded = bpe.decode(encoded, PATH)
    got = sorted((repr(r.doc_id), r.ids, r.n_tokens, bytes(r.decoded)) for r in decoded.collect())
    texts = [(repr(r.doc_id), r.text or "") for r in odd_docs.collect()]
    ids = [(k, tool.encode_ordinary(t), t.encode()) for k, t in texts]
    assert got == sorted((k, x, len(x), raw) for k, x, raw in ids)


def test_packed_ids_and_other_columns(clashing):
    encoded = bpe.encode(clashing, PATH, PATTERN, packed=True, decoded="k0")
    assert set(encoded.columns) == set(clashing.columns) - {"text"}
    row = encoded.where("doc_id = 7").first()
    assert row["a.b"] == "own a.b" and bytes(row["k0"]) == b"short text"
    again = bpe.decode(encoded, PATH, decoded="d").where("doc_id = 7").first()
    assert bytes(again.d) == b"short text"
    assert bpe.encode(clashing.limit(0), PATH, PATTERN).count() == 0


def test_query_equals_whole_text_encoding(spark):
    tool = bpe.encoder(PATH, PATTERN)
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op10_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = np.array(tool.encode_ordinary(d.text or ""), "<u4")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
