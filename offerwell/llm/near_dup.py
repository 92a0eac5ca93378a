"""Near-duplicate classes with DartMinHash signatures (Christiani, "DartMinHash: fast sketching for weighted sets", 2020).

A document is the weighted set of its five-word shingles, the weight being the number of times a shingle occurs. Every unit of weight is a
column into which darts are thrown: the rank axis is cut into cells, the number of darts of a (shingle, unit, cell) is
Poisson distributed and, like the rank and the coordinate of each dart, a function of its hash alone. For each coordinate the dart of
lowest rank is kept; the rank limit follows from the document's weight, so a signature takes about ``k ln k`` darts however long the
text. Two documents agree on a coordinate with a probability that is their weighted Jaccard similarity.

Bands of the signature are joined. Documents with equal word sequences are one class before that, so copies never meet in a bucket; in a
bucket every member is compared with the bucket's first member, so a group of near copies costs one comparison for each of them and band.
Buckets that still hold several classes are decided block by block: their documents are ordered and cut into blocks of bounded size, and
blocks of one loose group are compared inside a task. Links are decided exactly on the shingles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.llm import text as tx
from offerwell.llm.components import components
from offerwell.session import cut_lineage

SHINGLE, BANDS, ROWS = 5, 40, 6
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Darts beyond ``k ln k`` for each coordinate; a document with an empty coordinate gets a higher rank limit.
SLACK = 3.0
#: Cells of the rank axis: [0, 1/16), then each as long as all before it up to 1, then of length 1.
FIRST_CELLS = np.array([0, 1 / 16, 1 / 8, 1 / 4, 1 / 2])
FIRST_WIDTH = np.array([1 / 16, 1 / 16, 1 / 8, 1 / 4, 1 / 2])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(distinct: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))


def shingles(texts: pa.Array, size: int = SHINGLE):
    """(text, element) of every shingle occurrence, ordered by text, and the fingerprint of each text's words (null without words).

    The m-th occurrence of a shingle in a text is an element of its own, so plain Jaccard on elements is weighted Jaccard on shingles. A
    text of fewer than ``size`` words has one shingle of all its words.
    """
    values, bounds = tx.words(texts, tx.LOWER)
    codes, distinct = tx.coded(values)
    word = hashes(distinct)[codes] if distinct else np.empty(0, np.uint64)
    count = np.diff(bounds)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    owner = np.repeat(np.arange(len(count)), n)
    start = tx.ragged(bounds[:-1], n)
    length = np.minimum(size, count[owner])
    made = np.full(len(start), np.uint64(size))
    with np.errstate(over="ignore"):
        for j in range(size):
            inside = length > j
            made[inside] = mix(made[inside] * MULTIPLIER + word[start[inside] + j])
    raw = values.buffers()[2] if len(values) else None
    prints: list = [None] * len(count)
    if raw is not None:
        data, offsets = tx.raw(values)
        ends = np.frombuffer(offsets.astype("<i8").tobytes(), np.int64)
        buffer, spread = data.tobytes(), np.diff(ends).astype("<u4")
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if a < b:  # the words and where each ends
                prints[i] = xxhash.xxh3_128_digest(buffer[ends[a] : ends[b]] + spread[a:b].tobytes())
    # The same text's equal shingles side by side: number of the text above, 44 bits of the shingle below.
    packed = np.sort((owner.astype(np.uint64) << np.uint64(44)) | (made >> np.uint64(20)))
    fresh = np.ones(len(packed), bool)
    fresh[1:] = packed[1:] != packed[:-1]
    first = np.flatnonzero(fresh)
    nth = np.arange(len(packed)) - np.repeat(first, np.diff(np.concatenate([first, [len(packed)]])))
    with np.errstate(over="ignore"):
        element = mix((packed & np.uint64((1 << 44) - 1)) * MULTIPLIER + nth.astype(np.uint64))
    return (packed >> np.uint64(44)).astype(np.int64), element, prints, n


def _poisson(width: float) -> np.ndarray:
    """Chance of at most 0, 1, 2, ... darts in a cell, on the scale of 32-bit hashes."""
    p, total, out = math.exp(-width), 0.0, []
    for i in range(16):
        total += p
        out.append(total)
        p *= width / (i + 1)
    return (np.array(out) * 2.0**32).astype(np.uint64)


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """(texts, k) lowest darts; rows of texts without weight are meaningless."""
    n = len(weight)
    lowest = np.full(n * k, np.iinfo(np.uint64).max, np.uint64)
    limit = k * (math.log(k) + SLACK) / np.maximum(weight, 1)
    done = np.zeros(n)  # rank up to which all darts of a text are thrown
    active = weight > 0
    while active.any():
        rows = np.flatnonzero(active[owner])
        who, what = owner[rows], element[rows]
        cell = 0
        while len(rows):
            if cell < len(FIRST_CELLS):
                begin, width = FIRST_CELLS[cell], FIRST_WIDTH[cell]
            else:
                begin, width = float(cell - len(FIRST_CELLS) + 1), 1.0
            use = limit[who] > begin
            if not use.all():
                who, what, rows = who[use], what[use], rows[use]
            fresh = done[who] <= begin
            if fresh.any():
                _throw(lowest, who[fresh], what[fresh], cell, begin, width, k)
            cell += 1
        done = np.where(active, _cell_end(limit), done)
        empty = (lowest.reshape(n, k) == np.iinfo(np.uint64).max).any(axis=1)
        active &= empty
        limit = np.where(active, np.maximum(limit, done) * 1.5, limit)
    return (lowest & np.uint64(0xFFFFFFFF)).reshape(n, k)


def _cell_end(limit: np.ndarray) -> np.ndarray:
    ends = FIRST_CELLS + FIRST_WIDTH
    return np.where(limit <= 1, ends[np.minimum(np.searchsorted(ends, limit), len(ends) - 1)], np.ceil(limit))


def _throw(lowest, who, what, cell, begin, width, k) -> None:
    """Throw the darts of one cell for all elements and keep the lowest of each coordinate."""
    with np.errstate(over="ignore"):
        base = mix(what + np.uint64(cell + 1) * MULTIPLIER)
        chance = base >> np.uint64(32)
        table = _poisson(width)
        hit = np.flatnonzero(chance >= table[0])
        count = np.searchsorted(table, chance[hit], side="right")
        dart = np.repeat(base[hit], count)
        first = np.repeat(np.cumsum(count) - count, count)
        dart = mix(dart + (np.arange(len(dart)) - first + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        rank = (begin + width * ((dart >> np.uint64(32)).astype(np.float64) / 2.0**32)).astype(np.float32)
        name = mix(dart)
    slot = np.repeat(who[hit], count) * k + (name >> np.uint64(32)).astype(np.int64) % k
    packed = (rank.view(np.uint32).astype(np.uint64) << np.uint64(32)) | (name & np.uint64(0xFFFFFFFF))
    np.minimum.at(lowest, slot, packed)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.zeros((len(signature), bands), np.uint64)
    key += np.arange(1, bands + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(rows):
            key = mix(key * MULTIPLIER + signature[:, j::rows][:, :bands])
    return key.view(np.int64)


def _sign(bands: int, rows: int):
    def run(text):
        owner, element, prints, weight = shingles(tx.text_array(text))
        keys = band_keys(signatures(owner, element, weight, bands * rows), bands, rows)
        keys = keys[weight > 0]
        starts = np.concatenate([[0], np.cumsum(np.where(weight > 0, bands, 0))])
        return [pa.array(prints, pa.binary()), pa.array(weight.astype(np.int64)), tx.list_array(pa.array(keys.ravel()), starts)]

    return run


def _elements(text):
    owner, element, _, weight = shingles(tx.text_array(text))
    return [tx.list_array(pa.array(element.view(np.int64)), np.concatenate([[0], np.cumsum(weight)]))]


def near_duplicates(
    docs: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(key, class_id, kept) of every row: class_id is the smallest id that links of similar texts reach, kept is key = class_id.

    Two texts are linked when the weighted Jaccard similarity of their five-word shingles (lower-cased A-Z, words without ASCII white
    space) is at least ``threshold``; a text of fewer words has one shingle of them all. With 40 bands of 6 rows a pair at 0.8
    is missed with a chance below 1e-5. Null and empty texts link with nothing and are kept. Rows of one id count as one document; a null id
    has no class and is kept. An empty table gives an empty table; other columns are not read.
    """
    plain = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    signed = tx.attach(plain, _sign(bands, rows), "print binary, n bigint, bands array<bigint>", text="text").drop("text")
    signed = cut_lineage(signed, "signatures")
    usable = signed.where("print IS NOT NULL AND id IS NOT NULL")
    first = usable.groupBy("print").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.min_by("bands", "id").alias("bands"))
    first = cut_lineage(first, "texts")  # one document of each word sequence
    spread = first.select("id", "n", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("bucket")
    members = cut_lineage(spread.join(cut_lineage(shared, "shared"), "bucket"), "buckets")
    wanted = members.select("id").distinct()
    texts = plain.join(wanted, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    elements = tx.attach(texts, _elements, "elements array<bigint>", text="text").select("id", "elements")
    elements = cut_lineage(elements, "elements")
    labels = _classes(members, elements, threshold, bands, rows)
    named = first.select("print", "id").join(labels, "id", "left")
    named = named.select("print", F.coalesce("component", "id").alias("component"))
    out = signed.select("id", "print").join(cut_lineage(named, "named"), "print", "left")
    out = out.select("id", F.coalesce("component", "id").alias("class_id"))
    return out.select(F.col("id").alias(key), "class_id", F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("kept"))


def _similar(a, b, threshold: float):
    both = F.size(F.array_intersect(a, b))
    return both >= threshold * (F.size(a) + F.size(b) - both)


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, id, label) of the buckets that hold documents of several classes."""
    named = members.join(labels, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("label"))
    state = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    state = cut_lineage(state.where("low < high").select("bucket"), "open-buckets")
    return cut_lineage(named.join(state, "bucket"), "open")


def _classes(members: DataFrame, elements: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame:
    """(id, component) over the links of documents that share a bucket."""
    leaders = cut_lineage(members.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("x")).select("bucket", "x.*"), "leaders")
    leaders = leaders.toDF("bucket", "a", "m")
    close = F.least("n", "m") >= threshold * F.greatest("n", "m")  # no pair of other sizes can reach the threshold
    pairs = members.join(leaders, "bucket").where((F.col("a") < F.col("id")) & close).select("a", F.col("id").alias("b")).distinct()
    both = cut_lineage(pairs, "pairs").join(elements.toDF("a", "x"), "a").join(elements.toDF("b", "y"), "b")
    links = cut_lineage(both.where(_similar("x", "y", threshold)).select("a", "b"), "links")
    labels = components(links)
    left = _open(members, labels)
    if left.isEmpty():
        return labels
    loose = components(left.join(left.groupBy("bucket").agg(F.min("id").alias("a")), "bucket").select("a", F.col("id").alias("b")))
    more = _block_links(left, loose, elements, threshold, bands, rows)
    return components(links.unionAll(more))


BLOCK_ROWS = 256
BLOCK = "block bigint, ids binary, labels binary, keys binary, sketch binary, sizes binary, elements binary"
PARTS = [("ids", "<i8"), ("labels", "<i8"), ("keys", "<i8"), ("sketch", "u1"), ("sizes", "<i8"), ("elements", "<i8")]


def _block_links(left: DataFrame, loose: DataFrame, elements: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame:
    """Links between documents of different classes that share a bucket of ``left``, found block by block.

    Documents are dealt into blocks of about ``BLOCK_ROWS``: small loose groups (what buckets connect) whole, large groups by class, large classes by
    id. Only blocks of one group meet, and blocks that hold one and the same class of it do not; a block pair returns
    links that join its classes, not its pairs.
    """
    spark = left.sparkSession
    docs = cut_lineage(left.select("id", "label").distinct().join(loose.toDF("id", "grp"), "id"), "loose")
    groups = cut_lineage(docs.groupBy("grp").agg(F.count("*").alias("in_group")), "groups")
    classes = cut_lineage(docs.groupBy("grp", "label").agg(F.count("*").alias("in_class")), "group-classes")
    small, each = max(1, math.ceil(docs.count() / BLOCK_ROWS)), float(BLOCK_ROWS)
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.ceil(F.col(n) / each))
    block = (
        F.when(F.col("in_group") <= BLOCK_ROWS // 4, F.xxhash64(F.lit("s"), F.pmod(F.xxhash64("grp"), F.lit(small))))
        .when(F.col("in_class") > BLOCK_ROWS // 2, F.xxhash64(F.lit("c"), "grp", "label", deal("id", "in_class")))
        .otherwise(F.xxhash64(F.lit("g"), "grp", deal("label", "in_group")))
    )
    docs = docs.join(groups, "grp").join(classes, ["grp", "label"]).withColumn("block", block)
    docs = cut_lineage(docs.select("block", "grp", "label", "id"), "dealt")
    made = docs.join(elements, "id").select("block", "label", "id", "elements").groupBy("block").applyInArrow(_block(bands, rows), BLOCK)
    blocks = cut_lineage(made, "blocks")
    spots = cut_lineage(docs.groupBy("block", "grp").agg(F.min("label").alias("low"), F.max("label").alias("high")), "spots")
    a, b = (spots.select(*[F.col(c).alias(f"{c}_{s}") for c in ("block", "low", "high")], "grp") for s in ("a", "b"))
    several = "NOT (low_a = high_a AND low_b = high_b AND low_a = low_b)"
    pairs = cut_lineage(a.join(b, "grp").where(f"block_a <= block_b AND {several}").select("block_a", "block_b").distinct(), "block-pairs")
    for s in ("a", "b"):
        body = blocks.select(F.col("block").alias(f"block_{s}"), *[F.col(c).alias(f"{c}_{s}") for c, _ in PARTS])
        pairs = pairs.join(body, f"block_{s}")
    names = ["block_a", "block_b", *[f"{c}_{s}" for s in ("a", "b") for c, _ in PARTS]]
    return cut_lineage(pairs.select(names).mapInArrow(_compare(threshold, bands, rows), "a bigint, b bigint"), "block-links")


def _block(bands: int, rows: int):
    """One row with the packed documents of a block and their signatures, which follow from the elements."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lists = table.column("elements").chunk(0)
        sizes = np.diff(np.asarray(lists.offsets)).astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sign = signatures(np.repeat(np.arange(len(sizes)), sizes), flat.view(np.uint64), sizes, bands * rows)
        ids, labels = (table.column(c).to_numpy().astype(np.int64) for c in ("id", "label"))
        data = [ids, labels, band_keys(sign, bands, rows), sign.astype(np.uint8), sizes, flat]
        packed = {c: pa.array([x.tobytes()], pa.binary()) for (c, _), x in zip(PARTS, data)}
        return pa.table({"block": table.column("block").slice(0, 1).combine_chunks()} | packed)

    return run


def _compare(threshold: float, bands: int, rows: int):
    """Links that join classes of two blocks: candidates share a band key and are decided exactly, the likeliest first.

    Candidates whose signatures agree on fewer coordinates than a pair at the threshold has within five standard deviations are not decided.
    """
    k = bands * rows
    least = threshold - 5 * math.sqrt(threshold * (1 - threshold) / k)

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(i)[r].as_py() for i, name in enumerate(batch.schema.names)}
                same = row["block_a"] == row["block_b"]
                (ids, label, key, sketch, size, flat), (ids_b, label_b, key_b, sketch_b, size_b, flat_b) = (
                    [np.frombuffer(row[f"{c}_{s}"], kind) for c, kind in PARTS] for s in ("a", "b")
                )
                key, key_b = key.reshape(-1, bands), key_b.reshape(-1, bands)
                share = np.zeros((len(ids), len(ids_b)), bool)
                for j in range(bands):
                    share |= key[:, j][:, None] == key_b[:, j][None, :]
                share &= label[:, None] != label_b[None, :]
                share &= np.minimum(size[:, None], size_b[None, :]) >= threshold * np.maximum(size[:, None], size_b[None, :])
                p, q = np.nonzero(np.triu(share) if same else share)
                agree = np.zeros(len(p))
                x, y = sketch.reshape(-1, k), sketch_b.reshape(-1, k)
                for i in range(0, len(p), 4096):
                    agree[i : i + 4096] = (x[p[i : i + 4096]] == y[q[i : i + 4096]]).mean(axis=1)
                start, start_b = np.cumsum(size) - size, np.cumsum(size_b) - size_b
                parent, found = {}, []

                def root(n):
                    while parent.get(n, n) != n:
                        n = parent[n]
                    return n

                for i in np.argsort(-agree, kind="stable"):
                    if agree[i] < least:
                        break
                    m, n = int(p[i]), int(q[i])
                    one, other = root(int(label[m])), root(int(label_b[n]))
                    if one == other:
                        continue
                    u, v = flat[start[m] : start[m] + size[m]], flat_b[start_b[n] : start_b[n] + size_b[n]]
                    both = len(np.intersect1d(u, v))
                    if both >= threshold * (len(u) + len(v) - both):
                        parent[max(one, other)] = min(one, other)
                        found.append((int(ids[m]), int(ids_b[n])))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return run
