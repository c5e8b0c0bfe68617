"""Byte-level BPE encoding and decoding over a global shuffle of distinct words.

Texts are cut into pre-tokens (words with the space before them) that the tokenizer's
split pattern never joins. Each block of texts keeps its pre-tokens by position, as numbers
of its distinct words; the distinct words go to buckets by hash, where each is encoded once
for all blocks, and the ids come back and are put in place by position. Decoding looks up
the bytes of each id in the token table, whose size the vocabulary fixes.

Null and empty texts have no ids. Rows may repeat and keep all their columns; an input
column with the name of an output is replaced. An empty table gives an empty result.
"""

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.llm.blocks import (
    blocks,
    by_part,
    hashes,
    pack,
    pack_lists,
    pack_numbers,
    pack_strings,
    parts_for,
    renamed,
    restored,
    unpack,
    unpack_numbers,
    unpack_strings,
)

#: Unicode's white space, as the split pattern takes it.
SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
#: A space between white space and white space (or the end), where a cut would be wrong.
INNER_SPACE = f"[{SPACES}] (?:[{SPACES}]|\\z)"
HEADER = -1
PACKED = "block string, part int, payload binary"


@cache
def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


@cache
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=vocabulary(path), special_tokens={}
    )


@cache
def token_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Beginnings and lengths of the tokens by id, and their bytes in one row."""
    ranks = vocabulary(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    sizes = np.array([len(x) for x in tokens], np.int64)
    return np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(tokens), np.uint8)


def spliced(number: np.ndarray, starts: np.ndarray, sizes: np.ndarray, row: np.ndarray):
    """Pieces ``number`` of ``row``, one after the other; piece ``k`` is ``sizes[k]`` long."""
    size = sizes[number]
    before = np.cumsum(size) - size
    return row[np.repeat(starts[number] - before, size) + np.arange(size.sum())]


def bytes_of(ids: np.ndarray, path: str) -> bytes:
    return spliced(ids, *token_table(path)).tobytes()


def joined_cuts(text: str) -> list[str]:
    """Pre-tokens of a text with white space on both sides of some space."""
    first, *rest = text.split(" ")
    units = [first]
    for piece in rest:
        if units[-1][-1:] in SPACES and units[-1] and (not piece or piece[0] in SPACES):
            units[-1] += " " + piece
        else:
            units.append(" " + piece)
    return units


def pretokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Pre-tokens of each text: how many, their word numbers in text order, and the words."""
    odd = pc.match_substring_regex(texts, INNER_SPACE).to_numpy(zero_copy_only=False)
    split = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
    counts = np.diff(split.offsets.to_numpy())
    later = split.flatten().dictionary_encode()
    number = later.indices.to_numpy().astype(np.int32)
    spaced = pc.binary_join_element_wise("", later.dictionary, " ")
    # the first of each text has no space before it
    leads = np.cumsum(counts) - counts
    first = pc.take(later.dictionary, pa.array(number[leads])).dictionary_encode()
    number[leads] = len(spaced) + first.indices.to_numpy()
    words = [spaced, first.dictionary]
    odd_units = [joined_cuts(x) for x in texts.filter(pa.array(odd)).to_pylist()]
    rest = pa.array([u for units in odd_units for u in units], pa.string()).dictionary_encode()
    words.append(rest.dictionary)
    # back to the order of the texts
    n = np.zeros(len(texts), np.int64)
    n[~odd], n[odd] = counts, [len(u) for u in odd_units]
    flat = np.empty(n.sum(), np.int32)
    at = np.repeat(odd, n)
    flat[~at] = number
    flat[at] = len(spaced) + len(first.dictionary) + rest.indices.to_numpy()
    return n, flat, pa.concat_arrays(words)


def bucketed(words: pa.Array, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, the order that groups buckets, and the borders in that order."""
    part = (hashes(words) % np.uint64(parts)).astype(np.uint32)
    return part, *by_part(part, parts)


def encode(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    count: str = "n_tokens",
    packed: bool = False,
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` without ``text``, with the token ids of the text and their number.

    The result equals encoding every text on its own without special tokens. ``packed`` gives
    the ids as little-endian 32-bit numbers in one binary, else they are an array. ``decoded``
    names a column for the bytes that the ids decode to, as ``decode`` would find them.
    """
    extra = (decoded,) if decoded else ()
    kept = [c for c in docs.columns if c not in (text, ids, count, *extra)]
    docs = renamed(docs, kept, text=F.col(f"`{text}`"))
    inner = docs.columns[:-1]
    parts = parts_for(docs, "text")

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in blocks(batches, "text"):
            words = pretokens(texts)[2]
            _, order, borders = bucketed(words, parts)
            words = words.take(pa.array(order))
            for part in np.flatnonzero(np.diff(borders)).tolist():
                mine = words.slice(borders[part], borders[part + 1] - borders[part])
                yield packed_row(name, part, pack_strings(mine))

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table, texts in blocks(batches, "text"):
            n, flat, words = pretokens(texts)
            part, _, _ = bucketed(words, parts)
            head = pack(**{c: table.column(c) for c in inner}, n=n)
            yield packed_row(name, HEADER, head, pack_numbers(flat), pack_numbers(part))

    def answer(table: pa.Table) -> pa.Table:
        asked = [unpack_strings(x.as_py()) for x in table.column("payload")]
        words = pa.concat_arrays(asked).dictionary_encode()
        tool = encoder(vocabulary_path, pattern)
        ids_of = pa.array(
            (tool.encode_ordinary(w.as_py()) for w in words.dictionary), pa.list_(pa.int32())
        )
        ends = np.cumsum([len(x) for x in asked])
        out = [
            pack_lists(ids_of.take(words.indices.slice(end - len(x), len(x))))
            for x, end in zip(asked, ends, strict=True)
        ]
        return pa.table(
            {"block": table.column("block"), "part": table.column("part"), "payload": out}
        )

    def assemble(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        part = table.column("part").to_pylist()
        if part[:1] != [HEADER] or part[1:2] == [HEADER]:
            raise RuntimeError("a block lacks its texts: the input changed between two reads")
        head = unpack(table.column("payload")[0].as_py())
        got = [unpack_numbers(x.as_py()) for x in table.column("payload")[1:]]
        order, _ = by_part(*unpack_numbers(table.column("parts")[0].as_py()), parts)
        answered = np.concatenate([x for x, _ in got] or [np.empty(0, np.uint32)])
        if len(order) != len(answered):
            raise RuntimeError("a block lacks words: the input changed between two reads")
        values = np.concatenate([x for _, x in got] or [np.empty(0, np.uint32)]).astype(np.int32)
        sizes, starts = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        sizes[order] = answered
        starts[order] = np.cumsum(answered, dtype=np.int64) - answered
        (flat,) = unpack_numbers(table.column("positions")[0].as_py())
        ends = np.concatenate([[0], np.cumsum(head.column("n").to_numpy())])
        spans, back = [], []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            spans.append(spliced(flat[a:b], starts, sizes, values))
            if decoded:
                back.append(bytes_of(spans[-1], vocabulary_path))
        lengths = np.array([len(x) for x in spans], np.int64)
        if packed:
            tokens = pa.array([x.astype("<u4").tobytes() for x in spans], pa.binary())
        else:
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            flat_ids = np.concatenate(spans) if spans else np.empty(0, np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat_ids))
        columns = [head.column(c) for c in inner] + [tokens, pa.array(lengths)]
        if decoded:
            columns.append(pa.array(back, pa.binary()))
        names = [*inner, "ids", "count", *("decoded" for _ in extra)]
        return pa.Table.from_arrays(columns, names=names)

    wide = f"{PACKED}, positions binary, parts binary"
    asked = docs.mapInArrow(requests, wide).select("block", "part", "payload")
    answers = asked.groupBy("part").applyInArrow(answer, PACKED)
    whole = docs.mapInArrow(headers, wide).unionByName(answers, allowMissingColumns=True)
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [docs.schema[c] for c in inner]
        + [T.StructField("ids", kind), T.StructField("count", T.LongType())]
        + [T.StructField("decoded", T.BinaryType()) for _ in extra]
    )
    found = whole.groupBy("block").applyInArrow(assemble, schema)
    outputs = [F.col("ids").alias(ids), F.col("count").alias(count)]
    return restored(found, kept, *outputs, *(F.col("decoded").alias(c) for c in extra))


def packed_row(
    name: str, part: int, payload: bytes, positions: bytes | None = None, parts: bytes | None = None
) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "block": pa.array([name]),
            "part": pa.array([part], pa.int32()),
            "payload": pa.array([payload], pa.binary()),
            "positions": pa.array([positions], pa.binary()),
            "parts": pa.array([parts], pa.binary()),
        }
    )


def decode(
    encoded: DataFrame, vocabulary_path: str, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encoded`` with the bytes of its ids, packed or not; none or null ones give no bytes."""
    kept = [c for c in encoded.columns if c != decoded]
    frame = renamed(encoded, kept, ids=F.col(f"`{ids}`"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):  # a hundred rows' bytes at a time
                part = batch.slice(at, 100)
                found = [x.as_py() or b"" for x in part.column("ids")]
                numbers = [
                    np.frombuffer(x, "<u4") if isinstance(x, bytes) else np.array(x) for x in found
                ]
                out = pa.array([bytes_of(x, vocabulary_path) for x in numbers], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], out], names=[*part.schema.names[:-1], "decoded"]
                )

    schema = T.StructType([*frame.schema.fields[:-1], T.StructField("decoded", T.BinaryType())])
    return restored(frame.mapInArrow(joined, schema), kept, F.col("decoded").alias(decoded))
