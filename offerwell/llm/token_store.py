"""Token ids of a corpus as one concatenated array with Elias-Fano encoded document boundaries.

File format: a folder of Parquet files in ascending document order. Each row is a segment of consecutive documents: their ids
as little-endian integers of ``width`` bytes, and the ends of its documents as an Elias-Fano sequence (low bits packed, high
bits in unary, the position of every ``SAMPLE``-th set bit for select). ``n`` boundaries below ``u`` take about
``n * (2 + log2(u / n))`` bits. The folder ``parts`` beside it holds the first position of each file's ids, one row per
file. Any reader of Parquet can open the files from any store; a segment covers at most ``text.SLICE_BYTES`` of text
or one longer document.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwell.llm import text as tx

SAMPLE = 256
SEGMENT = (
    "part int, seq int, base bigint, n_ids bigint, doc_ids array<bigint>, width int, ids binary, "
    "low_bits int, low binary, high binary, samples binary"
)


class EliasFano:
    """A non-decreasing sequence of integers in near-minimal space, with select."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        values = values.astype(np.uint64)
        low_bits = max(0, int(int(values[-1]) // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(at[-1]) + 1, np.uint8)
        unary[at] = 1
        high = np.packbits(unary, bitorder="little")
        return cls(n, low_bits, low.tobytes(), high.tobytes(), at[::SAMPLE].astype("<u4").tobytes())

    def parts(self) -> tuple[int, bytes, bytes, bytes]:
        return self.low_bits, self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()

    def _lows(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, np.int64)
        start, end = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self.low[start // 8 : (end + 7) // 8], bitorder="little")
        bits = bits[start % 8 : start % 8 + end - start].reshape(count, self.low_bits).astype(np.int64)
        return bits @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """Value ``i``, read from the sampled position before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        k, at = divmod(i, SAMPLE)
        first = int(self.samples[k])
        last = int(self.samples[k + 1]) if k + 1 < len(self.samples) else len(self.high) * 8 - 1
        bits = np.unpackbits(self.high[first // 8 : last // 8 + 1], bitorder="little")
        position = first - first % 8 + int(np.flatnonzero(bits[first % 8 :])[at]) + first % 8
        return ((position - i) << self.low_bits) | int(self._lows(i, 1)[0])

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little")) - np.arange(self.n)
        return (at << self.low_bits) | self._lows(0, self.n)


class LibraryEncoder:
    """Ids of whole texts with the tokenizers library; distinct words are encoded about once per worker.

    Only for tokenizers whose normalizer and split never look across ASCII white space and drop it, as lower-casing BPE with
    word ends does: there a text's ids are the ids of its words in order. Where a trial shows that the tokenizer also ignores case and
    splits letters from closing punctuation, words of ASCII and Latin-1 letters are encoded without both, many in one call, and told
    apart by the tokens that end a word; every other word goes to the library as it stands.
    """

    PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+[.,;:!?]*$"
    RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
    CLOSING = ".,;:!?"

    def __init__(self, tokenizer: dict):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json.dumps(tokenizer))
        suffix, names = tokenizer["model"].get("end_of_word_suffix"), tokenizer["model"]["vocab"]
        self.ends = np.zeros(max(names.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for name, i in names.items() if name.endswith(suffix)]] = True
        stems, closing = [b"Ab", "\u00c9t\u00e9".encode(), b"z"], [b"", b".", b"?!", b",;:"]
        whole = self._each([t + c for t in stems for c in closing])
        self.splits = bool(suffix) and whole == [b"".join(self._each([t.lower(), c])) for t in stems for c in closing]
        self.units = tx.Cache(self._encode)

    def _each(self, found: list[bytes]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in found], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in made]

    def _encode(self, units: list[bytes]) -> list[bytes]:
        if not self.splits:
            return self._each(units)
        run = [self.RUN(u) is not None for u in units]
        runs, rest = self._joined([u for u, r in zip(units, run) if r]), self._each([u for u, r in zip(units, run) if not r])
        runs, rest = iter(runs), iter(rest)
        return [next(runs if r else rest) for r in run]

    def _joined(self, runs: list[bytes]) -> list[bytes]:
        """Ids of words that are one run of letters each."""
        out = []
        for at in range(0, len(runs), 512):
            part = runs[at : at + 512]
            whole = self.tokenizer.encode_batch_fast([b" ".join(part).decode("utf-8")], add_special_tokens=False)[0]
            ids = np.array(whole.ids, "<u4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(part):
                out += self._each(part)
                continue
            data, cut = ids.tobytes(), [0, *(4 * cut).tolist()]
            out += [data[a:b] for a, b in zip(cut, cut[1:])]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, position of each text's first id, with the end)."""
        values, bounds = tx.words(texts)
        if not len(values):
            return np.empty(0, "<u4"), np.zeros(len(bounds), np.int64)
        found = values.dictionary_encode()
        codes, units, per_word = np.asarray(found.indices).astype(np.int64), found.dictionary, 1
        if self.splits:
            words, per_word = units.cast(pa.string()), 2
            plain = pc.match_substring_regex(words, self.PLAIN)
            stems = pc.if_else(plain, pc.ascii_lower(pc.ascii_rtrim(words, self.CLOSING)), words)
            closing = pc.if_else(plain, pc.replace_substring_regex(words, f"^[^{self.CLOSING}]+", ""), "")
            units = pa.concat_arrays([stems, closing]).cast(pa.binary())
            codes = np.column_stack([codes, codes + len(words)]).ravel()
        unit, distinct = tx.coded(units)
        known = self.units.many(distinct)
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        start = np.cumsum(size) - size
        at = unit[codes]
        ids = np.frombuffer(b"".join(known), "<u4")[tx.ragged(start[at], size[at])]
        return ids, np.concatenate([[0], np.cumsum(size[at])])[per_word * bounds]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all whole texts, each followed by ``end_id``, in ascending order of ``key`` below ``path``.

    Documents are dealt by ranges of ``key``; only the number of ids of each file (one per shuffle partition) comes to the
    driver. A null text is empty: it has the end id alone. Null keys come first; rows with equal keys stay separate documents,
    ordered by their text. Other columns are not read. An empty table gives an empty store.
    """
    spark = docs.sparkSession
    shared = tx.Shared(spark, tx.read_tokenizer(tokenizer))

    def run(batches):
        encoder, part, seq, base = tx.made(shared, LibraryEncoder), TaskContext.get().partitionId(), 0, 0
        width = 2 if max(encoder.tokenizer.get_vocab_size(True) - 1, end_id) < 1 << 16 else 4
        for batch in batches:
            for rows in tx.slices(batch, 1):
                ids, bounds = encoder.encode(tx.text_array(rows.column(1)))
                n = rows.num_rows
                whole = np.full(len(ids) + n, end_id, f"<u{width}")
                ends = bounds[1:] + np.arange(1, n + 1)
                inside = np.ones(len(whole), bool)
                inside[ends - 1] = False
                whole[inside] = ids
                low_bits, low, high, samples = EliasFano.of(ends).parts()
                columns = [
                    [part], [seq], [base], [len(whole)], None, [width], [whole.tobytes()], [low_bits], [low], [high], [samples]
                ]
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), None, pa.int32(), pa.binary(), pa.int32()]
                kinds += [pa.binary()] * 3
                made = [None if c is None else pa.array(c, k) for c, k in zip(columns, kinds)]
                made[4] = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows.column(0).cast(pa.int64()))
                yield pa.RecordBatch.from_arrays(made, names=[f.split()[0] for f in SEGMENT.split(", ")])
                seq, base = seq + 1, base + len(whole)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).cast("string").alias("t"))
    # The start of the text deals out rows of one key (null keys too) that would otherwise be one task; the order is that of key and text.
    rows = rows.repartitionByRange(parts, "k", F.substring("t", 1, 64)).sortWithinPartitions("k", "t")
    rows.mapInArrow(run, SEGMENT).write.option("compression", "zstd").parquet(f"{path}/segments")
    counts = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    first, at = [], 0
    for part, n in sorted(map(tuple, counts)):
        first.append((part, at))
        at += n
    spark.createDataFrame(first, "part int, first bigint").coalesce(1).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Segments of a store with ``first``, the position of their first id in the whole array."""
    parts = spark.read.schema("part int, first bigint").parquet(f"{path}/parts")  # one row per file
    segments = spark.read.schema(SEGMENT).parquet(f"{path}/segments")
    return segments.join(F.broadcast(parts), "part").withColumn("first", F.col("first") + F.col("base"))


def documents(segments: DataFrame) -> DataFrame:
    """One row per stored document: doc_id, start (ids before it), n_tokens and ids_crc32, read through the boundaries."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                first, ids, low_bits, low, high, samples, width = (batch.column(i)[row].as_py() for i in range(1, 8))
                doc_ids = batch.column(0)[row].values
                ends = EliasFano(len(doc_ids), low_bits, low, high, samples).all()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                data = memoryview(np.frombuffer(ids, f"<u{width}").astype("<u4")).cast("B")
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [doc_ids, pa.array(first + starts), pa.array((ends - starts).astype(np.int64)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    columns = segments.select("doc_ids", "first", "ids", "low_bits", "low", "high", "samples", "width")
    return columns.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
