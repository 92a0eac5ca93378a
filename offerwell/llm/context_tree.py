"""Code length of texts under a context-tree-weighted byte model (Willems, Shtarkov and Tjalkens, 1995), with a unigram word base.

Every byte is eight binary decisions, and every decision has a context tree over the ``depth`` bytes before it. A node holds
the Krichevsky-Trofimov estimate of the bits seen in its context, and mixes it half and half with the product of its children; the
weights follow bottom-up from the counts of the training documents alone, so they can be computed from a table of byte grams, and the
mixed prediction of a gram follows top-down. The model is that table: it grows with the corpus and is never held in one place.

Distribution: gram and word counts are pre-aggregated per partition. The levels from two bytes on are computed per group of whole two-byte
contexts, one decision after another, the two levels above them from at most 65,280 rows. Documents are dealt into chunks of bounded size; each
chunk asks for its distinct grams and words only, which are joined with the tables and come back to the chunk's documents.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.llm import text as tx
from offerwell.session import cut_lineage

DEPTH = 5
CHUNK_BYTES = 16 << 20
GROUP_GRAMS = 1 << 16
SLICE = 1 << 18
HALF = math.log(0.5)
END = 0xFF  # never a byte of UTF-8


def grams(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(gram, text) of every byte and of each text's end: the byte below the ``depth`` bytes before it, 0 where there are none."""
    data, offsets = tx.raw(texts)
    size = np.diff(offsets)
    text = np.repeat(np.arange(len(size)), size)
    padded = np.zeros(len(data) + len(size) * (depth + 1), np.uint8)
    lower = np.frombuffer(tx.LOWER, np.uint8)
    padded[np.arange(len(data)) + text * (depth + 1) + depth] = lower[data]
    ends = np.cumsum(size + depth + 1) - 1
    padded[ends] = END
    buffer = np.concatenate([np.zeros(8, np.uint8), padded])
    last = np.ndarray((len(padded),), ">u8", buffer, offset=1, strides=(1,))  # the eight bytes up to each position
    out = last[depth:].astype(np.uint64) & np.uint64((1 << 8 * (depth + 1)) - 1)
    return out[_inside(size, depth)], np.repeat(np.arange(len(size)), size + 1)


def _inside(size: np.ndarray, depth: int) -> np.ndarray:
    """Which of the shifted positions are bytes or ends and not the padding between two texts."""
    lengths = np.empty(2 * len(size), np.int64)
    lengths[0::2], lengths[1::2] = size + 1, depth
    return np.repeat(np.tile([True, False], len(size)), lengths)[: int(lengths[:-1].sum())]


def gammaln(x: np.ndarray) -> np.ndarray:
    """log Gamma of positive numbers, by Stirling's series from 10 on."""
    shift = np.zeros_like(x)
    x = x.copy()
    for _ in range(10):
        low = x < 10
        if not low.any():
            break
        shift[low] -= np.log(x[low])
        x[low] += 1
    square = 1 / (x * x)
    series = (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680 - square / 1188)))) / x
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series + shift


TABLED = 1 << 14  # counts up to this have their logs of Gamma in a table; nearly all are small


@lru_cache(maxsize=2)
def _table(shift: float) -> np.ndarray:
    return gammaln(np.arange(TABLED) + shift)


def _log_gamma(count: np.ndarray, shift: float) -> np.ndarray:
    """``gammaln(count + shift)`` of whole counts."""
    at = count.astype(np.int64)
    out = _table(shift)[np.minimum(at, TABLED - 1)]
    large = np.flatnonzero(at >= TABLED)
    if len(large):
        out[large] = gammaln(count[large] + shift)
    return out


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a bit sequence with these counts."""
    return _log_gamma(zeros, 0.5) + _log_gamma(ones, 0.5) - _log_gamma(zeros + ones, 1.0) - math.log(math.pi)


def decision(gram: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    """(prefix, bit) of decision ``j`` (0 to 7) on each gram's last byte; a prefix starts with a 1."""
    byte = (gram & np.uint64(255)).astype(np.int64)
    return (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1


class Levels:
    """Nodes of one decision for all contexts of two bytes and more that the grams of whole two-byte groups have.

    Level d has contexts of d bytes; the trees of different decisions are independent.
    """

    def __init__(self, gram: np.ndarray, count: np.ndarray, depth: int, j: int):
        self.prefix, self.bit = decision(gram, j)
        key, self.at = np.unique((gram >> np.uint64(8)).astype(np.int64) << 8 | self.prefix, return_inverse=True)
        ones = np.bincount(self.at, count * self.bit, len(key))
        zeros = np.bincount(self.at, count, len(key)) - ones
        own = kt(zeros, ones)
        self.level = {depth: (key, zeros, ones, own, own, None)}
        for d in range(depth - 1, 1, -1):
            below, z, o, _, mixed, _ = self.level[d + 1]
            parent = (below >> 8 & (1 << 8 * d) - 1) << 8 | below & 255
            key, up = np.unique(parent, return_inverse=True)
            zeros, ones = np.bincount(up, z, len(key)), np.bincount(up, o, len(key))
            own, product = kt(zeros, ones), np.bincount(up, mixed, len(key))
            self.level[d] = (key, zeros, ones, own, np.logaddexp(HALF + own, HALF + product), up)
        self.depth = depth

    def predict(self) -> np.ndarray:
        """Mixed probability of the decision on each gram by the levels from two bytes on."""
        at, p = self.at, None
        for d in range(self.depth, 1, -1):
            _, zeros, ones, own, mixed, up = self.level[d]
            if d < self.depth:
                at = up[at]
            seen = (np.where(self.bit == 1, ones[at], zeros[at]) + 0.5) / (zeros[at] + ones[at] + 1.0)
            if p is None:
                p = seen
            else:
                stop = np.exp(HALF + own[at] - mixed[at])
                p = stop * seen + (1 - stop) * p
        return p


HELD = 1 << 20  # grams or words that a task gathers before it hands them on


def _parts(batches):
    for batch in batches:
        for part in tx.slices(batch, 0, SLICE):
            yield tx.text_array(part.column(0)), part.column(1).to_numpy(zero_copy_only=False).astype(bool)


def _count_grams(depth: int):
    """Distinct grams of a partition with their training counts (0 where only other documents have them)."""

    def merged(parts):
        gram, count = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        order = np.argsort(gram)
        gram, count = gram[order], count[order]
        first = _firsts(gram)
        return (gram[first], np.add.reduceat(count, first)) if len(gram) else (gram, count)

    def rows(gram, count):
        return pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(count)], names=["gram", "n"])

    def run(batches):
        held, size = [], 0
        for texts, train in _parts(batches):
            gram, text = grams(texts, depth)
            for use in (True, False):
                found, n = np.unique(gram[train[text] == use], return_counts=True)
                held.append((found, n if use else np.zeros(len(n), np.int64)))
                size += len(found)
            if size > 2 * HELD:
                held = [merged(held)]
                size = len(held[0][0])
                if size > HELD:
                    yield rows(*held[0])
                    held, size = [], 0
        if held:
            yield rows(*merged(held))
        tx.release()

    return run


def _firsts(values: np.ndarray) -> np.ndarray:
    """Positions of the first of each run of equal values."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in their order; ``np.unique`` would hash them, which takes several times as long as sorting."""
    values = np.sort(values)
    return values[_firsts(values)]


def _count_words(batches):
    """Distinct words of a partition with their training counts; the empty word is the end of a text."""

    def merged(parts):
        table = pa.concat_tables(parts)
        parts.clear()
        return table.group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    held, size = [], 0
    for texts, train in _parts(batches):
        values, bounds = tx.words(texts, tx.LOWER)
        found = values.dictionary_encode()
        weight = np.repeat(train.astype(np.float64), np.diff(bounds))
        count = np.bincount(np.asarray(found.indices), weight, len(found.dictionary)).astype(np.int64)
        for word, n in ((found.dictionary, count), (pa.array([b""], pa.binary()), [int(train.sum())])):
            held.append(pa.table([word, pa.array(n, pa.int64())], names=["word", "n"]))
            size += len(word)
        if size > 2 * HELD:
            held = [merged(held)]
            size = held[0].num_rows
            if size > HELD:
                yield from held[0].to_batches()
                held, size = [], 0
    if held:
        yield from merged(held).to_batches()
    tx.release()


def _arrays(table: pa.Table, *names):
    return [table.column(c).to_numpy().astype(np.int64) for c in names]


def _second_level(depth: int):
    def run(table: pa.Table) -> pa.Table:
        gram, count = _arrays(table, "gram", "n")
        parts = []
        for j in range(8):
            key, zeros, ones, _, mixed, _ = Levels(gram.astype(np.uint64), count, depth, j).level[2]
            parts.append([key >> 8 & 255, key & 255, zeros, ones, mixed])
        names = ["byte", "prefix", "zeros", "ones", "mixed"]
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)

    return run


def _predict(depth: int, shared):
    def run(table: pa.Table) -> pa.Table:
        gram, count = _arrays(table, "gram", "n")
        byte, total = gram >> 8 & 255, np.zeros(len(gram))
        for j in range(8):
            levels = Levels(gram.astype(np.uint64), count, depth, j)
            p = levels.predict()
            for at, (stop, one) in ((byte * 256 + levels.prefix, shared.value[1]), (levels.prefix, shared.value[0])):
                p = stop[at] * np.where(levels.bit == 1, one[at], 1 - one[at]) + (1 - stop[at]) * p
            total += np.log10(p)
        return pa.table([pa.array(gram), pa.array(total)], names=["gram", "value"])

    return run


def _top(second: DataFrame):
    """Weights and predictions of the contexts of no byte and of one byte, from at most 256 x 255 rows."""
    rows = second.groupBy("byte", "prefix").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "mixed")]).toPandas()
    tables, mixed, size = {}, None, (256 * 256, 256)
    at = (rows["byte"] * 256 + rows["prefix"]).to_numpy(np.int64)
    zeros, ones, product = (np.bincount(at, rows[c], size[0]) for c in ("zeros", "ones", "mixed"))
    for level in (1, 0):
        own = kt(zeros, ones)
        mixed = np.logaddexp(HALF + own, HALF + product)
        tables[level] = (np.exp(HALF + own - mixed), (ones + 0.5) / (zeros + ones + 1.0))
        zeros, ones, product = (x.reshape(-1, 256).sum(axis=0) for x in (zeros, ones, mixed))
    return tables


def fit(rows: DataFrame, depth: int):
    """(gram table with the log10 probability of each, word table with training counts) of (text, train) rows."""
    spark = rows.sparkSession
    plain = rows.select("text", "train")
    by_gram = plain.mapInArrow(_count_grams(depth), "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    by_gram = cut_lineage(by_gram, "grams")
    by_word = plain.mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    by_word = cut_lineage(by_word, "words")
    groups = max(1, by_gram.count() // GROUP_GRAMS)  # a group holds whole two-byte contexts
    dealt = by_gram.withColumn("g", F.pmod(F.xxhash64(F.col("gram").bitwiseAND(F.lit(0xFFFF00))), F.lit(groups)))
    dealt = dealt.select("g", "gram", "n").groupBy("g")
    second = dealt.applyInArrow(_second_level(depth), "byte bigint, prefix bigint, zeros double, ones double, mixed double")
    shared = spark.sparkContext.broadcast(_top(second))  # four arrays of at most 65,536 numbers
    return cut_lineage(dealt.applyInArrow(_predict(depth, shared), "gram bigint, value double"), "model"), by_word


def _unified(slices: list) -> tuple[list[np.ndarray], pa.Array, np.ndarray]:
    """(codes of each slice's words, distinct words of all slices, their order) of dictionary-encoded words."""
    if not slices:
        return [], pa.array([], pa.binary()), np.empty(0, np.int64)
    found = pa.chunked_array(slices).unify_dictionaries()
    distinct = found.chunk(0).dictionary
    return [np.asarray(c.indices) for c in found.chunks], distinct, pc.array_sort_indices(distinct).to_numpy()


def _asked_words(table: pa.Table) -> pa.Table:
    """(chunk, number, word) of the chunk's distinct words in their order, the empty word (a text's end) first."""
    chunk = table.column("chunk")[0].as_py()
    _, distinct, order = _unified([tx.words(texts, tx.LOWER)[0].dictionary_encode() for _, texts in _slices(table)])
    names = pa.concat_arrays([pa.array([b""], pa.binary()), distinct.take(pa.array(order))])
    return pa.table([pa.array(np.full(len(names), chunk, np.int32)), pa.array(np.arange(len(names))), names], names=["chunk", "i", "word"])


def _asked_grams(depth: int):
    def run(table: pa.Table) -> pa.Table:
        found, held, size = np.empty(0, np.uint64), [], 0
        for part in _slices(table):
            held.append(_distinct(grams(part[1], depth)[0]))
            size += len(held[-1])
            if size > HELD:
                found, held, size = _distinct(np.concatenate([found, *held])), [], 0
        found = _distinct(np.concatenate([found, *held]))
        del held
        tx.release()
        chunk = pa.array(np.full(len(found), table.column("chunk")[0].as_py(), np.int32))
        return pa.table([chunk, pa.array(found.astype(np.int64))], names=["chunk", "gram"])

    return run


def _slices(table: pa.Table):
    for batch in table.to_batches():
        for part in tx.slices(batch, batch.schema.get_field_index("text"), SLICE):
            yield part, tx.text_array(part.column(part.schema.get_field_index("text")))


def _score(depth: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        key, value = answers.column("key").to_numpy(), answers.column("value").to_numpy()
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        del order
        split = int(np.searchsorted(key, 0))
        known = value[:split][::-1]  # count of the chunk's word number 0, 1, ...
        key, value = key[split:].astype(np.uint64), value[split:]
        parts, found, starts = list(_slices(docs)), [], []
        for _, texts in parts:
            values, bounds = tx.words(texts, tx.LOWER)
            found.append(values.dictionary_encode())
            starts.append(bounds)
        found, distinct, order = _unified(found)
        last = len(distinct)  # the code of a text's end
        count = np.empty(last + 1)
        count[order], count[last] = known[1 : last + 1], known[0] if len(known) else 0.0
        del distinct, order
        log, seen_before = np.log10(count + 0.1), (count > 0).astype(np.float64)
        out = []
        for (part, texts), codes, bounds in zip(parts, found, starts):
            n = part.num_rows
            token, text = np.concatenate([codes, np.full(n, last)]), np.concatenate([np.repeat(np.arange(n), np.diff(bounds)), np.arange(n)])
            base = np.bincount(text, log[token], n)
            seen = np.bincount(text, seen_before[token], n)
            gram, text = grams(texts, depth)
            packed = np.sort(gram << np.uint64(16) | text.astype(np.uint64))
            gram = packed >> np.uint64(16)
            first = _firsts(gram)
            each = np.repeat(value[np.searchsorted(key, gram[first])], np.diff(np.concatenate([first, [len(gram)]])))
            total = np.bincount((packed & np.uint64(0xFFFF)).astype(np.int64), each, n)
            columns = [part.column("doc_id"), part.column("train"), pa.array(np.diff(bounds).astype(np.int64) + 1)]
            columns += [pa.array(seen.astype(np.int64)), pa.array(base), pa.array(total), pa.array(np.diff(tx.raw(texts)[1]))]
            out.append(pa.RecordBatch.from_arrays(columns, names=SCORED_NAMES))
        del key, value, known, found, starts, count, log, seen_before
        tx.release()
        return pa.Table.from_batches(out)

    return run


SCORED = "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, base double, score double, n_bytes bigint"
SCORED_NAMES = [c.split()[0] for c in SCORED.split(", ")]


def score_texts(docs: DataFrame, train, depth: int = DEPTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) of every row.

    ``train`` is a column that is true for the documents to learn from. ``score`` is the log10 probability of the lower-cased (A-Z) text and
    its end by the byte model with contexts of ``depth`` (2 to 5) bytes. ``base_score`` is the sum over the words, and one end for each text, of
    log10((c + 0.1) / (N + 0.1 (V + 1))), where c, N and V count the training words and ends. A null text is empty and has its end only;
    a null ``train`` counts as false. Repeated rows are scored each for itself and counted as often as they occur; an empty table
    gives an empty table. Other columns are not read.
    """
    if not 2 <= depth <= 5:
        raise ValueError("depth is 2 to 5")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), body.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    chunks = max(1, math.ceil(total / CHUNK_BYTES))
    model, words = fit(rows, depth)
    # All three uses of the dealt documents share one exchange.
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    dealt = dealt.select("chunk", "doc_id", "train", "text")
    by_chunk = dealt.groupBy("chunk")
    asked_words = by_chunk.applyInArrow(_asked_words, "chunk int, i bigint, word binary")
    asked_grams = by_chunk.applyInArrow(_asked_grams(depth), "chunk int, gram bigint")
    answers = asked_grams.join(model, "gram").select("chunk", F.col("gram").alias("key"), "value")
    answers = answers.unionByName(
        asked_words.join(words, "word").select("chunk", (-F.col("i") - 1).alias("key"), F.col("n").cast("double").alias("value"))
    )
    scored = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_score(depth), SCORED)
    size = words.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("train_tokens"), F.count("*").alias("v")).first()
    n, v = int(size["train_tokens"]), int(size["v"])
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(math.log10(n + 0.1 * (v + 1)))).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") * F.lit(math.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
