"""Ranked lexical search: best-first document intervals bounded by range maxima.

The index is a table of blocks of documents, made by map tasks. A block has its documents in
order of their ids and, for each of its terms, the list of documents that hold it with the
occurrences. Counts over all blocks (documents, terms, documents of each term asked for) are
sums of what the blocks say.

A search task takes blocks one by one. The impact of a term in a document does not depend on
the query, so each posting list gets a sparse table, of the place of the greatest impact in
every stretch of a power of two, that answers the maximum over any stretch at once. For a
query an interval of documents is bounded by the sum over its terms of the greatest impact
within. Intervals are taken best bound first; one is split at the document with the greatest
impact of all terms, which is scored, and what lies on either side is bounded anew. Where one
side keeps most of the interval that side is halved too, so equal impacts do not make long
chains, and an interval of ``LEAF`` documents is scored whole. A query ends in a block once
no bound reaches the last of its best documents so far. All queries of a block take their steps
together, and the best documents of a task go on as bounds into its next blocks.

Every task gives its best documents for each query; they are ranked by parts of the documents
first and then over all, so no task ranks more than ``k`` times the number of parts.

A term is a maximal match of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lowered. With
``N`` documents that have a term, ``L`` terms, ``n`` terms in a document, ``df`` documents with a term
and ``tf`` occurrences, a term weighs ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and a document
scores the sum of ``w * (1000000000 * tf div (1000 * tf + 8 * m))``, ``m = 10 + 90 * n * N div L``,
over the distinct terms of the query.

Null and empty texts have no term and are never found; a query without one finds nothing. Equal
scores go by ascending id, null ids last. Rows are documents: one that occurs twice is ranked
twice, and a query row that occurs twice is answered once for each row's id and text.
``documents`` should be a stored table of bounded blocks; queries are read in groups of ``GROUP_BYTES``.
"""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tristrata.llm.blocks import (
    blocks,
    pack_numbers,
    pack_strings,
    strings,
    unpack_numbers,
    unpack_strings,
    words_of,
)
from tristrata.llm.storage import stored

K = 10
#: Documents of an interval that is scored whole.
LEAF = 24
#: Intervals that one query takes in a step.
WIDE = 8
#: Pairs of an interval and a term that one step works on.
PAIRS = 1 << 20
#: Bytes of query texts that are searched together.
GROUP_BYTES = 1 << 20
#: Parts of the documents that are ranked apart before the last ranking.
RANK_PARTS = 64

#: Bytes of a term as they are: digits, lower-case letters and all beyond ASCII; A-Z lowered.
_TABLE = np.full(256, 0x20, np.uint8)
_TABLE[0x30:0x3A] = np.arange(0x30, 0x3A)
_TABLE[0x41:0x5B] = np.arange(0x61, 0x7B)
_TABLE[0x61:0x7B] = np.arange(0x61, 0x7B)
_TABLE[0x80:] = np.arange(0x80, 0x100)

INDEX = "docs long, terms long, lexicon binary, postings binary"


def terms_of(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Number of terms of each text and all terms in order."""
    offsets, data = strings(texts)
    plain = pa.StringArray.from_buffers(
        len(texts), pa.py_buffer(offsets), pa.py_buffer(_TABLE[data])
    )
    return words_of(plain)


def build_index(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of the inverted index, rows of ``INDEX``, stored."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table, texts in blocks(batches, "text"):
            yield pa.RecordBatch.from_pylist([block_row(table.column("id"), texts)], schema=_INDEX)

    plain = documents.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")
    )
    return stored(plain.mapInArrow(indexed, INDEX), "search-index")


_INDEX = pa.schema(
    [("docs", pa.int64()), ("terms", pa.int64())]
    + [("lexicon", pa.binary()), ("postings", pa.binary())]
)


def block_row(ids: pa.ChunkedArray, texts: pa.Array) -> dict:
    """One block: documents with a term in order of their ids, lists by term."""
    counts, words = terms_of(texts)
    null = pc.is_null(ids).to_numpy().astype(bool)
    plain = pc.fill_null(ids, 0).to_numpy()
    order = np.lexsort((plain, null))
    order = order[counts[order] > 0]
    rank = np.zeros(len(counts), np.int64)
    rank[order] = np.arange(len(order))
    key = words.indices.to_numpy().astype(np.int64) * max(1, len(order))
    key += rank[np.repeat(np.arange(len(counts)), counts)]
    posting, tf = np.unique(key, return_counts=True)
    term, doc = np.divmod(posting, max(1, len(order)))
    sizes = np.bincount(term, minlength=len(words.dictionary))
    return {
        "docs": len(order),
        "terms": int(counts.sum()),
        "lexicon": pack_strings(words.dictionary),
        "postings": pack_numbers(
            plain[order],
            null[order].astype(np.uint8),
            counts[order].astype(np.uint32),
            sizes.astype(np.uint32),
            doc.astype(np.uint32),
            tf.astype(np.uint32),
        ),
    }


class Postings:
    """Lists of the ``terms`` asked for in one block, with impacts and sparse tables."""

    def __init__(self, lexicon: bytes, postings: bytes, terms: pa.Array, weights, docs, total):
        ids, null, n, sizes, doc, tf = unpack_numbers(postings)
        self.ids, self.null, self.docs = ids, null.astype(bool), len(ids)
        found = pc.index_in(terms, value_set=unpack_strings(lexicon))
        asked = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        sizes = np.where(asked >= 0, np.diff(starts)[asked] if len(sizes) else 0, 0)
        at = spread(np.where(asked >= 0, starts[asked], 0), sizes)
        owner = np.repeat(np.arange(len(terms)), sizes)
        self.doc, tf = doc[at].astype(np.int64), tf[at].astype(np.int64)
        m = 10 + 90 * n[self.doc].astype(np.int64) * docs // total
        self.impact = weights[owner] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        self.key = owner * self.docs + self.doc
        self.tables = [np.arange(len(at), dtype=np.int32)]
        span, most = 1, int(sizes.max(initial=0))
        while 2 * span <= most:
            low = self.tables[-1][:-span]
            high = self.tables[-1][span:]
            self.tables.append(np.where(self.impact[high] > self.impact[low], high, low))
            span *= 2

    def stretch(self, term: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Where the list of ``term`` has documents from ``low`` to before ``high``."""
        base = term * self.docs
        return np.searchsorted(self.key, base + low), np.searchsorted(self.key, base + high)

    def greatest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the greatest impact from ``a`` to before ``b``, for stretches that are not empty."""
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            mine = level == k
            low, high = self.tables[k][a[mine]], self.tables[k][b[mine] - (1 << k)]
            out[mine] = np.where(self.impact[high] > self.impact[low], high, low)
        return out


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...``, ``sizes[i]`` of them, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Best:
    """The ``k`` best documents of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.zeros((queries, k), np.int64)
        self.id = np.zeros((queries, k), np.int64)
        self.null = np.ones((queries, k), bool)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        good = (score > 0) & (score >= self.score[query, -1])
        query, score, ids, null = query[good], score[good], ids[good], null[good]
        who = np.unique(query)
        query = np.concatenate([query, np.repeat(who, self.k)])
        score = np.concatenate([score, self.score[who].reshape(-1)])
        ids = np.concatenate([ids, self.id[who].reshape(-1)])
        null = np.concatenate([null, self.null[who].reshape(-1)])
        order = np.lexsort((ids, null, -score, query))
        first = np.searchsorted(query[order], who)
        taken = order[first[:, None] + np.arange(self.k)]
        self.score[who], self.id[who], self.null[who] = score[taken], ids[taken], null[taken]

    def open(self, query: np.ndarray, bound: np.ndarray, ids: np.ndarray, null: np.ndarray):
        """Whether an interval with this bound, whose least id is ``ids``, may hold a better one."""
        last, number, unnamed = self.score[query, -1], self.id[query, -1], self.null[query, -1]
        before = (null < unnamed) | ((null == unnamed) & (ids < number))
        return (bound > last) | ((bound == last) & (bound > 0) & before)


def summed(where: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of ``values`` by place; the halves of a number are added as doubles."""
    high = np.bincount(where, values >> 24, size).astype(np.int64)
    return (high << 24) + np.bincount(where, values & 0xFFFFFF, size).astype(np.int64)


def search_block(lists: Postings, offsets: np.ndarray, term: np.ndarray, best: Best) -> None:
    """Add the best documents of a block; query ``q`` has ``term[offsets[q] : offsets[q + 1]]``."""
    sizes = np.diff(offsets)

    def pairs(query, *columns):
        n = sizes[query]
        return (spread(offsets[query], n), np.repeat(np.arange(len(query)), n)) + tuple(
            np.repeat(c, n) for c in columns
        )

    def bounded(query, low, high):
        """Bounds of intervals, and the document of the greatest single impact."""
        bound, split = np.zeros(len(query), np.int64), low.copy()
        for part in chunks(sizes[query], PAIRS):
            at, row, lo, hi = pairs(query[part], low[part], high[part])
            a, b = lists.stretch(term[at], lo, hi)
            some = b > a
            place, row = lists.greatest(a[some], b[some]), row[some]
            impact = lists.impact[place]
            if len(row):
                first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                who = row[first] + part.start
                bound[who] = np.add.reduceat(impact, first)
                top = np.repeat(
                    np.maximum.reduceat(impact, first), np.diff(np.append(first, len(row)))
                )
                is_top = np.flatnonzero(impact == top)
                lead = is_top[np.searchsorted(is_top, first)]
                split[who] = lists.doc[place[lead]]
        return bound, split

    def score_all(query, low, high):
        """Score every document of the intervals."""
        for part in chunks(sizes[query] * (high - low), PAIRS):
            q, lo, hi = query[part], low[part], high[part]
            at, row, l2, h2 = pairs(q, lo, hi)
            a, b = lists.stretch(term[at], l2, h2)
            place = spread(a, b - a)
            width = hi - lo
            cell = np.cumsum(width) - width
            where = np.repeat(cell[row] - l2, b - a) + lists.doc[place]
            score = summed(where, lists.impact[place], int(width.sum()))
            doc = spread(lo, width)
            best.add(np.repeat(q, width), score, lists.ids[doc], lists.null[doc])

    query = np.flatnonzero(sizes > 0)
    if not lists.docs or not len(query):
        return
    low, high = np.zeros(len(query), np.int64), np.full(len(query), lists.docs)
    bound, split = bounded(query, low, high)
    while len(query):
        fine = best.open(query, bound, lists.ids[low], lists.null[low])
        query, low, high, bound, split = (x[fine] for x in (query, low, high, bound, split))
        order = np.lexsort((-bound, query))
        query, low, high, bound, split = (x[order] for x in (query, low, high, bound, split))
        turn = np.arange(len(query)) - np.searchsorted(query, query)
        now = turn < WIDE
        leaf = now & (high - low <= LEAF)
        score_all(query[leaf], low[leaf], high[leaf])
        cut = now & ~leaf
        q, lo, hi, mid = query[cut], low[cut], high[cut], split[cut]
        score_all(q, mid, mid + 1)
        # the sides of the document, the larger one halved where it keeps most
        left, right = mid - lo, hi - mid - 1
        half_left = np.where(left > 0.75 * (hi - lo), lo + left // 2, lo)
        half_right = np.where(right > 0.75 * (hi - lo), mid + 1 + right // 2, mid + 1)
        sides = [(lo, half_left), (half_left, mid), (mid + 1, half_right), (half_right, hi)]
        new_q = np.concatenate([q] * 4)
        new_low = np.concatenate([s[0] for s in sides])
        new_high = np.concatenate([s[1] for s in sides])
        real = new_high > new_low
        new_q, new_low, new_high = new_q[real], new_low[real], new_high[real]
        new_bound, new_split = bounded(new_q, new_low, new_high)
        later = ~now
        query = np.concatenate([query[later], new_q])
        low = np.concatenate([low[later], new_low])
        high = np.concatenate([high[later], new_high])
        bound = np.concatenate([bound[later], new_bound])
        split = np.concatenate([split[later], new_split])


def chunks(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of about ``most`` in total, each of one element at least."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield slice(start, stop)
        start = stop


def grouped_queries(queries: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, list]]:
    """Ids and texts of distinct queries, in groups of about ``GROUP_BYTES``."""
    plain = queries.select(
        F.col(f"`{item_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")
    ).distinct()
    total = plain.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = -(-total // GROUP_BYTES)
    for g in range(groups):
        mine = plain.where(F.pmod(F.xxhash64("id", "text"), F.lit(groups)) == g)
        rows = mine.where(F.col("text").isNotNull()).collect()
        if rows:
            yield [r["id"] for r in rows], [r["text"] for r in rows]


RESULT = "query int, id long, score long"
CANDIDATES = pa.schema([("query", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def search(
    index: DataFrame,
    queries: DataFrame,
    item_id: str = "item_id",
    text: str = "text",
    *,
    k: int = K,
) -> DataFrame:
    """The ``k`` best documents of each query: ``item_id, rank, doc_id, score``."""
    docs, total = index.agg(F.sum("docs"), F.sum("terms")).first()
    answers = [
        search_group(index, ids, texts, docs, total, k)
        for ids, texts in (grouped_queries(queries, item_id, text) if docs else ())
    ]
    spark = index.sparkSession
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, answers, empty)


def search_group(
    index: DataFrame, ids: list, texts: list, docs: int, total: int, k: int
) -> DataFrame:
    """Answers to a group of queries small enough to be sent to all tasks."""
    spark = index.sparkSession
    counts, words = terms_of(pa.array(texts, pa.string()))
    pairs = np.repeat(np.arange(len(texts)), counts) * max(1, len(words.dictionary))
    distinct = np.unique(pairs + words.indices.to_numpy().astype(np.int64))
    query, term = np.divmod(distinct, max(1, len(words.dictionary)))
    offsets = np.searchsorted(query, np.arange(len(texts) + 1))
    names = words.dictionary
    df = np.zeros(len(names), np.int64)
    for r in document_counts(index, names).collect():
        df[r["term"]] = r["df"]
    weights = [math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for n in df.tolist()]
    weights = np.array(weights, np.int64)

    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(texts), k)
        for batch in batches:
            for lexicon, postings in zip(
                batch.column("lexicon"), batch.column("postings"), strict=True
            ):
                args = (lexicon.as_py(), postings.as_py(), names, weights, docs, total)
                search_block(Postings(*args), offsets, term, best)
        who, place = np.nonzero(best.score)
        found = pa.array(best.id[who, place], mask=best.null[who, place])
        yield pa.RecordBatch.from_arrays(
            [pa.array(who.astype(np.int32)), found, pa.array(best.score[who, place])],
            schema=CANDIDATES,
        )

    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    best = index.select("lexicon", "postings").mapInArrow(best_of, RESULT)
    best = best.withColumn("part", F.pmod(F.xxhash64("id", "score"), F.lit(RANK_PARTS)))
    for keys in (["query", "part"], ["query"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        best = best.withColumn("rank", place).where(F.col("rank") <= k)
    rows = [(i, x) for i, x in enumerate(ids)]
    items = spark.createDataFrame(rows, "query int, item_id long")
    return best.join(F.broadcast(items), "query").select(
        "item_id", "rank", F.col("id").alias("doc_id"), "score"
    )


def document_counts(index: DataFrame, names: pa.Array) -> DataFrame:
    """Rows ``term, df`` for the places in ``names`` of terms that some document holds."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(names), np.int64)
        for batch in batches:
            for lexicon, postings in zip(
                batch.column("lexicon"), batch.column("postings"), strict=True
            ):
                sizes = unpack_numbers(postings.as_py())[3].astype(np.int64)
                found = pc.index_in(names, value_set=unpack_strings(lexicon.as_py()))
                at = pc.fill_null(found, -1).to_numpy().astype(np.int64)
                df[at >= 0] += sizes[at[at >= 0]]
        term = np.flatnonzero(df)
        yield pa.record_batch({"term": pa.array(term.astype(np.int32)), "df": pa.array(df[term])})

    found = index.select("lexicon", "postings").mapInArrow(counted, "term int, df long")
    return found.groupBy("term").agg(F.sum("df").alias("df"))


def ranked_sql(k: int = K) -> str:
    """The answers over all ``documents`` for each item of ``benchmark``, as DuckDB SQL."""

    def terms(text: str) -> str:
        upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
        plain = f"translate({text}, '{upper}', '{lower}')"
        return f"regexp_extract_all({plain}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

    return f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
tokens AS (SELECT r, unnest({terms("text")}) AS term FROM numbered),
lengths AS (SELECT r, count(*) AS n FROM tokens GROUP BY r),
totals AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
tfs AS (SELECT r, term, count(*) AS tf FROM tokens GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term, big_n
),
asked AS (SELECT DISTINCT item_id, unnest({terms("text")}) AS term FROM benchmark),
scored AS (
  SELECT item_id, r, CAST(sum(
    w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l)))
  ) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (r), totals
  GROUP BY item_id, r
),
ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST
  ) AS INTEGER) AS rank
  FROM scored JOIN numbered USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}
"""
