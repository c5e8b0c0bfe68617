"""Blocks of whole rows inside map tasks, and payloads that travel through shuffles.

Several operators need a number for every distinct word or byte string of a text, which
one shuffled row for each occurrence would make far larger than the text. They work on
blocks instead: a map task cuts its rows into blocks of about ``BLOCK_BYTES`` of text,
reduces each block to its distinct keys, and sends these, packed, to ``parts`` buckets by
the hash of the key. A bucket sees each distinct key of all blocks together, answers each
block in the order of its keys, and the answers meet the block again by its name.

A block's name holds its partition, its number there and a digest of its texts. Inputs
should be stored tables, whose partitions have the same rows in the same order whenever a
task is repeated; where an unstable input gives other blocks, names differ and the
operators raise rather than mix them.
"""

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 60_000
PART_BYTES = 16 << 20
LEAST_PARTS = 64


def renamed(df: DataFrame, kept: list[str], **inner: Column) -> DataFrame:
    """Columns ``kept`` as ``k0, k1, ...`` beside ``inner`` ones: names that cannot clash."""
    return df.select(
        *(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)),
        *(column.alias(name) for name, column in inner.items()),
    )


def restored(df: DataFrame, kept: list[str], *others: str | Column) -> DataFrame:
    """The columns ``kept`` under their own names again, and ``others``."""
    return df.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(kept)), *others)


def row_digest(columns: list[str]) -> Column:
    """MD5 of all ``columns`` of a row: equal for rows that are equal."""
    texts = (F.col(f"`{c}`").cast("string") for c in columns)
    return F.md5(F.concat_ws("", *(
        F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts
    )))


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def parts_of(total: int) -> int:
    """Buckets for the keys of ``total`` bytes: one for every ``PART_BYTES``, at least 64."""
    return max(LEAST_PARTS, -(-total // PART_BYTES))


def parts_for(docs: DataFrame, text: str) -> int:
    return parts_of(text_bytes(docs, text))


def blocks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES
) -> Iterator[tuple[str, pa.Table, pa.Array]]:
    """Name, rows and texts (empty for null) of each block; a longer text is its own block."""
    at, held, size = TaskContext.get().partitionId(), [], 0
    made = 0

    def close() -> tuple[str, pa.Table, pa.Array]:
        nonlocal held, size, made
        table = pa.Table.from_batches(held)
        whole = as_array(pc.fill_null(table.column(text), ""))
        name = f"{at}-{made}-{digest(whole)}"
        held, size, made = [], 0, made + 1
        return name, table, whole

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy())
        start, rows = 0, sum(b.num_rows for b in held)
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + limit - size, side="right"))
            stop = min(max(stop, start + 1), start + BLOCK_ROWS - rows)
            held.append(batch.slice(start, stop - start))
            size, rows, start = size + ends[stop - 1] - before, rows + stop - start, stop
            if start < len(ends) or size >= limit or rows >= BLOCK_ROWS:
                yield close()
                pa.default_memory_pool().release_unused()
                rows = 0
    if held:
        yield close()
    pa.default_memory_pool().release_unused()


def digest(texts: pa.Array) -> str:
    """Of strings and their borders."""
    offsets, data = strings(texts)
    return hashlib.blake2b(np.diff(offsets).tobytes() + data.tobytes(), digest_size=12).hexdigest()


def strings(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from zero and bytes of a string or binary array without nulls."""
    if len(array) == 0:
        return np.zeros(1, np.int32), np.empty(0, np.uint8)
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return bounds - bounds[0], whole[bounds[0] : bounds[-1]]


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Words between white space (space and 9 to 13) and how many each text has."""
    split = pc.ascii_split_whitespace(texts)
    split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
    flat = split.flatten()
    filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
    counts = np.bincount(owner[filled], minlength=len(split))
    return counts, flat.filter(pa.array(filled)).dictionary_encode()


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each string, the same in every process."""
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD1B54A32D192ED03)
    return x ^ (x >> np.uint64(32))


def by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts keys of one bucket together, and where each bucket begins and ends."""
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def pack(**columns) -> bytes:
    """Columns of equal length as compressed Arrow."""
    batch = pa.record_batch({k: as_array(v) for k, v in columns.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(
        sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")
    ) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def as_array(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return column.combine_chunks()
    return column if isinstance(column, pa.Array) else pa.array(column)


def pack_numbers(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers by the weight of their bytes, as slow-changing ones compress well.

    Unlike Arrow this costs few bytes for a short array.
    """
    tool = zstandard.ZstdCompressor(level=3)
    head, body = [struct.pack("<B", len(arrays))], []
    for array in arrays:
        array = np.ascontiguousarray(array)
        whole = array.view(np.uint8).reshape(len(array), array.itemsize)
        parts = [tool.compress(np.ascontiguousarray(whole[:, k])) for k in range(array.itemsize)]
        head.append(struct.pack("<3sI", array.dtype.str[1:].encode(), len(array)))
        head.append(struct.pack(f"<{len(parts)}I", *map(len, parts)))
        body += parts
    return b"".join([*head, *body])


def unpack_numbers(payload: bytes) -> list[np.ndarray]:
    tool = zstandard.ZstdDecompressor()
    (count,), at, found = struct.unpack_from("<B", payload), 1, []
    for _ in range(count):
        kind, n = struct.unpack_from("<3sI", payload, at)
        dtype = np.dtype("<" + kind.rstrip(b"\x00").decode())
        sizes = struct.unpack_from(f"<{dtype.itemsize}I", payload, at + 7)
        found.append((dtype, n, sizes))
        at += 7 + 4 * dtype.itemsize
    out = []
    for dtype, n, sizes in found:
        whole = np.empty((n, dtype.itemsize), np.uint8)
        for k, size in enumerate(sizes):
            whole[:, k] = np.frombuffer(tool.decompress(payload[at : at + size]), np.uint8)
            at += size
        out.append(whole.reshape(-1).view(dtype))
    return out


def pack_strings(array: pa.Array) -> bytes:
    """Strings as their lengths and their bytes."""
    offsets, data = strings(array)
    return pack_numbers(np.diff(offsets).astype(np.uint32), data)


def unpack_strings(payload: bytes) -> pa.Array:
    sizes, data = unpack_numbers(payload)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data))


def pack_lists(array: pa.ListArray) -> bytes:
    """Lists of numbers below 2**32 as their lengths and their numbers."""
    sizes = np.diff(array.offsets.to_numpy()).astype(np.uint32)
    return pack_numbers(sizes, array.flatten().to_numpy().astype(np.uint32))


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch for Spark in the order and types of ``schema``."""
    return pa.RecordBatch.from_arrays(
        [as_array(columns[f.name]).cast(f.type) for f in schema], schema=schema
    )
