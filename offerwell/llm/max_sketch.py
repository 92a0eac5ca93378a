"""Ranked lexical search over hashed max-sketches.

The index has a row per document: its distinct terms with the impact of each (the part of a term's score that depends on the document), and a sketch. Two
hashes send every term to two coordinates of the sketch, where the largest impact of all terms that land there is kept. For any term, the smaller
of its two coordinates is therefore no less than its impact, and the weighted sum over the terms of a query no less than the document's score. A sketch
has about four coordinates per distinct term, so that bounds are as tight for long documents as for short ones.

A search looks up the terms of a whole batch of queries in the sketches at once, takes the documents of each query by falling bound, scores them
exactly from their terms, and stops where the next bound is below the score of rank ``k`` so far. Every task keeps ``k`` documents a query; the
ranks are settled among those. All documents take part; nothing but statistics and queries, in blocks of bounded size, passes through the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerwell.llm import text as tx

#: Impacts are kept in 16 bits of a sketch, rounded up to this unit.
UNIT = 16
#: Most distinct terms and queries of a block that is broadcast and looked up at once (a longer query is a block of its own).
BLOCK_TERMS, BLOCK_QUERIES = 1 << 13, 1 << 10
#: Most cells of a (documents, terms) or (documents, queries) array in a task.
CELLS = 1 << 22
INDEX = "key bigint, size bigint, words string, impacts binary, sketch binary"
#: What stands between terms.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def impact(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Document part of the score of a term that occurs ``tf`` times among ``n``: at most 1,000,000."""
    m = 50 + (50 * n * documents) // max(terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _coordinates(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return (h & np.uint64(0xFFFFFFFF)).astype(np.int64), (h >> np.uint64(32)).astype(np.int64)


def _width(distinct: np.ndarray) -> np.ndarray:
    """Coordinates of a sketch: four to eight per distinct term, a power of two."""
    return 1 << np.ceil(np.log2(np.maximum(4 * distinct, 8))).astype(np.int64)


def statistics(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(documents with a term, terms of all documents)."""

    def run(batches):
        full = total = 0
        for batch in batches:
            for rows in tx.slices(batch, 0):
                data, offsets = tx.raw(tx.text_array(rows.column(0)))
                inside = np.frombuffer(data.tobytes().translate(tx.LOWER_WORDS), np.uint8) != 0x20
                starts = inside.copy()
                starts[1:] &= ~inside[:-1]
                first = offsets[:-1][offsets[:-1] < offsets[1:]]
                starts[first] = inside[first]  # words end with their text
                n = np.diff(np.concatenate([[0], np.cumsum(starts)])[offsets])
                full, total = full + int((n > 0).sum()), total + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array([full]), pa.array([total])], names=["n", "total"])

    found = docs.select(F.col(text).cast("string")).mapInArrow(run, "n bigint, total bigint").agg(F.sum("n"), F.sum("total")).first()
    return found[0] or 0, found[1] or 0


def write_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the index of all whole texts below ``path``: (key, size, words, impacts, sketch) rows, and the statistics beside them.

    Terms are runs of letters, digits and non-ASCII characters, only A-Z lower-cased. Documents without any term (null and empty texts) are in no
    result and have no row. Rows of one key are documents of their own. Other columns are not read.
    """
    spark = docs.sparkSession
    documents, terms = statistics(docs, text)

    def run(batches):
        for batch in batches:
            for rows in tx.slices(batch, 1):
                values, bounds = tx.words(tx.text_array(rows.column(1)), tx.LOWER_WORDS)
                if not len(values):
                    continue
                codes, distinct = tx.coded(values)
                n = np.diff(bounds)
                pair = np.repeat(np.arange(len(n)), n) * len(distinct) + codes
                pair.sort()
                first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
                tf = np.diff(np.concatenate([first, [len(pair)]]))
                doc, term = np.divmod(pair[first], len(distinct))
                value = impact(tf, n[doc], documents, terms)
                per_doc = np.bincount(doc, minlength=len(n))
                kept = np.flatnonzero(n > 0)
                width = np.where(n > 0, _width(per_doc), 0)
                base = np.cumsum(width) - width
                sketch = np.zeros(int(width.sum()), np.uint16)
                up = (-(-value // UNIT)).astype(np.uint16)
                for h in _coordinates(distinct):
                    np.maximum.at(sketch, base[doc] + (h[term] & (width[doc] - 1)), up)
                ends = np.concatenate([[0], np.cumsum(per_doc)])
                words = pa.array(distinct, pa.binary()).take(pa.array(term))
                words = pc.binary_join(tx.list_array(words.cast(pa.string()), ends), " ")
                parts = [memoryview(value.astype("<u4")).cast("B"), memoryview(sketch).cast("B")]
                impacts = [bytes(parts[0][4 * ends[i] : 4 * ends[i + 1]]) for i in kept]
                sketches = [bytes(parts[1][2 * base[i] : 2 * (base[i] + width[i])]) for i in kept]
                at = pa.array(kept)
                columns = [rows.column(0).take(at), pa.array(n[kept]), words.take(at), pa.array(impacts, pa.binary()), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in INDEX.split(", ")])

    rows = docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")).mapInArrow(run, INDEX)
    rows.write.option("compression", "zstd").parquet(f"{path}/documents")
    spark.createDataFrame([(documents, terms)], "documents bigint, terms bigint").coalesce(1).write.parquet(f"{path}/statistics")


class Queries:
    """A block of queries: distinct terms, and the terms of each query as numbers."""

    def __init__(self, ids: list, terms: list[list[bytes]]):
        self.ids = ids
        self.words = sorted({w for found in terms for w in found})
        number = {w: i for i, w in enumerate(self.words)}
        self.terms = [np.array(sorted(number[w] for w in set(found)), np.int64) for found in terms]
        self.one, self.two = _coordinates(self.words)
        self.weights: list[np.ndarray] = []

    def weigh(self, df: dict[int, int], documents: int) -> None:
        known = np.array([weight(df.get(i, 0), documents) for i in range(len(self.words))], np.float64)
        self.weights = [known[t] for t in self.terms]


def blocks(items: DataFrame, key: str, text: str):
    """The queries in blocks of bounded size. Rows of one id are one query with the terms of all of them."""
    lower = F.translate(F.col("t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = items.select(F.col(key).alias("id"), F.col(text).cast("string").alias("t"))
    rows = rows.select("id", F.explode(F.split(lower, BETWEEN)).alias("w")).where("w <> ''").distinct()
    rows = rows.groupBy("id").agg(F.collect_list("w").alias("w"))  # distinct terms of one query
    ids, terms, seen = [], [], set()
    for name, found in rows.toLocalIterator():
        found = [w.encode("utf-8") for w in found]
        if ids and (len(seen | set(found)) > BLOCK_TERMS or len(ids) >= BLOCK_QUERIES):
            yield Queries(ids, terms)
            ids, terms, seen = [], [], set()
        ids.append(name)
        terms.append(found)
        seen.update(found)
    if ids:
        yield Queries(ids, terms)


def _document_frequencies(index: DataFrame, shared) -> dict[int, int]:
    """Documents that hold each term of the block; one row per term and task is shuffled, one per term comes to the driver."""

    def run(batches):
        queries = shared.value
        vocabulary = pa.array(queries.words, pa.binary())
        total = np.zeros(len(queries.words), np.int64)
        for batch in batches:
            for rows in tx.slices(batch, 0):
                values, _ = tx.words(rows.column(0))
                at = pc.drop_null(pc.index_in(values, vocabulary)).to_numpy()
                total += np.bincount(at, minlength=len(total))
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(total[term])], names=["term", "df"])

    found = index.select("words").mapInArrow(run, "term bigint, df bigint")
    return dict(map(tuple, found.groupBy("term").agg(F.sum("df")).collect()))


class Ranks:
    """The ``k`` best documents of every query so far: highest score first, then smallest key (null last)."""

    def __init__(self, queries: Queries, k: int):
        self.queries, self.k = queries, k
        self.score = [np.empty(0, np.int64) for _ in queries.ids]
        self.key = [np.empty(0, np.int64) for _ in queries.ids]
        self.null = [np.empty(0, bool) for _ in queries.ids]

    def floor(self, q: int) -> int:
        """Documents below this score cannot rank."""
        return int(self.score[q][-1]) if len(self.score[q]) == self.k else 1

    def add(self, q: int, score: np.ndarray, key: np.ndarray, null: np.ndarray) -> None:
        good = score > 0
        score = np.concatenate([self.score[q], score[good]])
        key, null = np.concatenate([self.key[q], key[good]]), np.concatenate([self.null[q], null[good]])
        order = np.lexsort((key, null, -score))[: self.k]
        self.score[q], self.key[q], self.null[q] = score[order], key[order], null[order]

    def search(self, key: np.ndarray, null: np.ndarray, bound_of: np.ndarray, exact) -> None:
        """Take the documents of a slice; ``bound_of`` has a row per query, ``exact`` gives the impacts of documents by term."""
        todo = {}
        for q in range(len(self.queries.ids)):
            near = np.flatnonzero(bound_of[q] >= self.floor(q))
            if len(near):
                todo[q] = near[np.argsort(-bound_of[q][near], kind="stable")]
        step = 16
        while todo:
            parts = {q: order[:step] for q, order in todo.items()}
            docs = np.unique(np.concatenate(list(parts.values())))
            impacts = exact(docs)
            for q, part in parts.items():
                score = impacts[np.searchsorted(docs, part)][:, self.queries.terms[q]] @ self.queries.weights[q]
                self.add(q, score.astype(np.int64), key[part], null[part])
            for q in list(todo):
                rest = todo[q][step:]
                end = np.searchsorted(-bound_of[q][rest], -self.floor(q), side="right")  # bounds fall
                todo[q] = rest[:end]
                if not end:
                    del todo[q]
            step *= 2


def _search(index: DataFrame, shared, k: int) -> DataFrame:
    fields = "query int, key bigint, score bigint"

    def run(batches):
        queries = shared.value
        ranks, n_terms = Ranks(queries, k), max(len(queries.words), len(queries.ids), 1)
        vocabulary = pa.array(queries.words, pa.binary())
        for batch in batches:
            limit = max(1, CELLS // n_terms)
            for start in range(0, batch.num_rows, limit):
                for rows in tx.slices(batch.slice(start, limit), 1):
                    keys = rows.column(0)
                    null = np.asarray(pc.is_null(keys).to_numpy(zero_copy_only=False), bool)
                    key = pc.fill_null(keys, 0).to_numpy()
                    bounds = _bounds(queries, rows.column(3))
                    known = np.zeros((rows.num_rows, len(queries.words)), np.float64)
                    have = np.zeros(rows.num_rows, bool)

                    def exact(docs, rows=rows, known=known, have=have):
                        fresh = docs[~have[docs]]
                        if len(fresh):
                            part = rows.take(pa.array(fresh))
                            values, ends = tx.words(part.column(1))
                            value = np.frombuffer(b"".join(part.column(2).to_pylist()), "<u4")
                            at = pc.index_in(values, vocabulary)
                            hit = np.flatnonzero(np.asarray(at.is_valid()))
                            owner = np.searchsorted(ends, hit, side="right") - 1
                            known[fresh[owner], at.drop_null().to_numpy()] = value[hit]
                            have[fresh] = True
                        return known[docs]

                    ranks.search(key, null, bounds, exact)
        for q in range(len(queries.ids)):
            n = len(ranks.score[q])
            if n:
                keys = pa.array(ranks.key[q], mask=ranks.null[q])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, q, np.int32)), keys, pa.array(ranks.score[q])], names=["query", "key", "score"])

    found = index.select("key", "words", "impacts", "sketch").mapInArrow(run, fields)
    # k rows a query and task: ranked in parts first, so that no task gets those of all tasks.
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.col("key").asc_nulls_last()))
    found = found.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(32))).withColumn("r", rank("query", "part")).where(F.col("r") <= k)
    return found.withColumn("rank", rank("query")).where(F.col("rank") <= k).select("query", "rank", "key", "score")


def _bounds(queries: Queries, sketches: pa.Array) -> np.ndarray:
    """Upper bound of the score of every document (column) for every query (row)."""
    data, offsets = tx.raw(sketches.cast(pa.binary()))
    width = np.diff(offsets) // 2
    out = np.zeros((len(queries.ids), len(width)))
    for w in np.unique(width):
        docs = np.flatnonzero(width == w)
        flat = data.view("<u2") if not offsets[0] % 2 else np.frombuffer(data.tobytes(), "<u2")
        sketch = flat[(offsets[docs] // 2)[:, None] + np.arange(w)] if len(docs) < len(width) else flat.reshape(len(docs), w)
        most = np.minimum(sketch[:, queries.one & (w - 1)], sketch[:, queries.two & (w - 1)]).T.astype(np.float64) * UNIT
        for q, (terms, weights) in enumerate(zip(queries.terms, queries.weights)):
            out[q, docs] = weights @ most[terms]
    return out


def search(spark: SparkSession, path: str, items: DataFrame, k: int = 50, key: str = "item_id", text: str = "text", doc_key: str = "doc_id") -> DataFrame:
    """The ``k`` documents of an index with the highest score above 0 for every query: (item, rank, document, score).

    Scores are whole numbers; equal ones rank by ascending document key, null last. A query without terms, like an empty index, gives no rows. Items of
    one id are one query.
    """
    index = spark.read.schema(INDEX).parquet(f"{path}/documents")
    documents = spark.read.schema("documents bigint, terms bigint").parquet(f"{path}/statistics").first()[0]
    kind = items.schema[key].dataType.simpleString()
    out = None
    for queries in blocks(items, key, text):
        counting = spark.sparkContext.broadcast(queries)  # at most BLOCK_TERMS terms, or one query
        queries.weigh(_document_frequencies(index, counting), documents)
        found = _search(index, spark.sparkContext.broadcast(queries), k)
        names = spark.createDataFrame(list(enumerate(queries.ids)), f"query int, `{key}` {kind}")
        found = found.join(names, "query").select(F.col(key), "rank", F.col("key").alias(doc_key), "score")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], f"`{key}` {kind}, rank int, `{doc_key}` bigint, score bigint")
