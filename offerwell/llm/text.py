"""Shared helpers: rows through Arrow in bounded slices, words of a slice, bounded caches.

A slice of rows is at most ``SLICE_BYTES`` of text (one longer document is a slice of its own), so the memory of a
Python worker does not depend on the number of rows in a batch or partition.
"""

from __future__ import annotations

import ctypes
import gc
import json
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 6 << 20
#: Most rows of a slice, so that a row number fits in 16 bits.
SLICE_ROWS = 1 << 16
CACHE_ENTRIES = 800_000
CACHE_BYTES = 96 << 20
#: Longer byte strings (encoded blobs, unspaced text) are computed each time they occur.
CACHED_LENGTH = 256

#: A-Z to a-z, every other byte unchanged.
LOWER = bytes(range(256)).lower()
#: A-Z to a-z, digits and bytes of non-ASCII letters unchanged, everything else to a space.
LOWER_WORDS = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 0x20 for b in LOWER)


def text_array(column: pa.Array) -> pa.Array:
    """``column`` as plain strings, null as the empty text."""
    return pc.fill_null(column.cast(pa.string()), "")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each text in them)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def words(texts: pa.Array, table: bytes | None = None) -> tuple[pa.Array, np.ndarray]:
    """(all words as one binary array, position of each text's first word, with the end).

    Words are the longest runs without ASCII white space (0x20, 0x09-0x0D), after the byte map ``table``.
    """
    data, offsets = raw(texts)
    buffer = data.tobytes() if table is None else data.tobytes().translate(table)
    plain = pa.Array.from_buffers(
        pa.string(), len(texts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(buffer)]
    )
    split = pc.ascii_split_whitespace(plain)
    ends = np.asarray(split.offsets).astype(np.int64)
    values = split.flatten()
    full = np.asarray(pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False), dtype=bool)
    before = np.concatenate([[0], np.cumsum(full)])
    return values.filter(pa.array(full)).cast(pa.binary()), before[ends - ends[0]]


def coded(values: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """(code of every value, the distinct values)."""
    if not len(values):
        return np.empty(0, np.int64), []
    found = values.dictionary_encode()
    data, offsets = raw(found.dictionary)
    buffer, ends = data.tobytes(), offsets.tolist()
    return np.asarray(found.indices).astype(np.int64), [buffer[a:b] for a, b in zip(ends, ends[1:])]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, ... of every (start, length) run, one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def list_array(values: pa.Array, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values)


def text_from_bytes(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Strings from UTF-8 bytes; bytes that are no UTF-8 become replacement characters."""
    buffer = data.tobytes()
    try:
        buffer.decode("utf-8")
        whole = True
    except UnicodeDecodeError:
        whole = False
    if whole and offsets[-1] < 2**31 and not np.any((data[offsets[(offsets > 0) & (offsets < len(data))]] & 0xC0) == 0x80):
        return pa.Array.from_buffers(
            pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(buffer)]
        )
    return pa.array([buffer[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])], pa.string())


def slices(batch: pa.RecordBatch, text: int, limit: int | None = None):
    """Consecutive parts of ``batch`` with at most ``limit`` bytes in column ``text``, one row at least."""
    limit = limit or SLICE_BYTES
    if not batch.num_rows:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, done = 0, 0
    while start < batch.num_rows:
        end = min(max(start + 1, int(np.searchsorted(size, done + limit, side="right"))), start + SLICE_ROWS)
        yield batch.slice(start, end - start)
        start, done = end, int(size[end - 1])


def release() -> None:
    """Give the memory that a worker has freed back to the system; it would keep it while it waits for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def attach(df: DataFrame, fn, fields: str, limit: int | None = None, **columns: str) -> DataFrame:
    """``df`` with the columns of ``fields`` (DDL), which ``fn`` computes from slices of rows with at most ``limit`` bytes of text.

    ``fn`` gets the Arrow arrays of ``columns`` (argument name = column of ``df``; ``text`` bounds the slices) and
    returns one array per field. A column of ``df`` with the name of a new field is replaced by it; all others, whatever
    their names, pass through.
    """
    names, new = df.columns, T.StructType.fromDDL(fields)
    at = {k: names.index(v) for k, v in columns.items()}
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    schema = T.StructType([*plain.schema.fields, *[T.StructField(f"r{i}", f.dataType) for i, f in enumerate(new.fields)]])
    labels = schema.names

    def run(batches):
        for batch in batches:
            for part in slices(batch, at["text"], limit):
                made = fn(**{k: part.column(i) for k, i in at.items()})
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=labels)

    rows = plain.mapInArrow(run, schema)
    kept = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in new.names]
    return rows.select(*kept, *[F.col(f"r{i}").alias(n) for i, n in enumerate(new.names)])


class Cache:
    """Values of byte strings, computed in batches and kept in two generations of bounded number and size.

    The bound counts the bytes of keys and values; keys above ``CACHED_LENGTH`` are not kept at all.
    """

    def __init__(self, compute, entries: int = CACHE_ENTRIES, room: int = CACHE_BYTES):
        self.compute, self.entries, self.room, self.held, self.young, self.old = compute, entries, room, 0, {}, {}

    def many(self, keys: list[bytes]) -> list:
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        if None in found:
            fresh = []
            for i in [i for i, v in enumerate(found) if v is None]:
                value = old.get(keys[i])
                if value is None:
                    fresh.append(i)
                else:
                    found[i] = young[keys[i]] = value
            if fresh:
                for i, value in zip(fresh, self.compute([keys[i] for i in fresh])):
                    found[i] = value
                    if len(keys[i]) <= CACHED_LENGTH:
                        young[keys[i]] = value
                        self.held += len(keys[i]) + (len(value) if isinstance(value, bytes) else 8)
            if len(young) > self.entries // 2 or self.held > self.room // 2:
                self.old, self.young, self.held = young, {}, 0
        return found


class Shared:
    """A broadcast value with an identity that is the same in every task."""

    def __init__(self, spark: SparkSession, value):
        self.id, self.broadcast = uuid.uuid4().hex, spark.sparkContext.broadcast(value)


_MADE: dict[str, object] = {}


def forget() -> None:
    """Drop what an earlier operator left in this worker, with its memory; caches refer back to their owner, so they are collected."""
    if _MADE:
        _MADE.clear()
        gc.collect()
        release()


def made(shared: Shared, make):
    """``make`` of the shared value, once per worker, so that its caches outlive a task."""
    if shared.id not in _MADE:
        forget()
        _MADE[shared.id] = make(shared.broadcast.value)
    return _MADE[shared.id]


def read_tokenizer(path: str) -> dict:
    """The tokenizer file as a dictionary; read once on the driver and sent to the tasks (a few MB at most)."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def byte_symbols() -> dict[str, int]:
    """Character of each byte in byte-level vocabularies: printable bytes stand for themselves, others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
