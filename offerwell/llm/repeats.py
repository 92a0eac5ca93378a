"""Removal of long passages that an earlier document already has, by seed and extend on winnowed anchors.

Every window of ``length`` words names one anchor: the leftmost of its lowest-hashed word grams (winnowing, Schleimer and others,
2003). Equal windows name equal anchors at equal distances, so documents are joined on anchors only, about one row for eighteen words. The
context of an anchor is the stretch of all windows that name it, the anchor extended both ways. Where all occurrences of an anchor
share one context, the whole stretch is decided at once; where contexts differ, the matches are extended window by window, once for each
distinct context, to find the first document that has each. A word goes when a window over it also starts in a
document with a smaller id, so what is removed is the union of the maximal repeats of at least ``length`` words.

Hot anchors are pre-aggregated before every shuffle, and no pairs of occurrences are built.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.llm import text as tx
from offerwell.llm.near_dup import hashes, mix
from offerwell.session import cut_lineage

LENGTH = 50
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
RANGE = pa.struct([("first", pa.int32()), ("words", pa.int32())])


class Spans:
    """Hashes of word spans by prefix sums of a polynomial in ``BASE``."""

    def __init__(self, word: np.ndarray):
        n = len(word)
        with np.errstate(over="ignore"):
            one = np.ones(1, np.uint64)
            power = np.cumprod(np.concatenate([one, np.full(n, BASE, np.uint64)]), dtype=np.uint64)
            self.back = np.cumprod(np.concatenate([one, np.full(n, INVERSE, np.uint64)]), dtype=np.uint64)
            self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * power[:n], dtype=np.uint64)])

    def hash(self, start: np.ndarray, words) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.prefix[start + words] - self.prefix[start]) * self.back[start])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _words(texts: pa.Array):
    values, bounds = tx.words(texts)
    codes, distinct = tx.coded(values)
    return hashes(distinct)[codes] if distinct else np.empty(0, np.uint64), bounds


def anchors(texts: pa.Array, length: int):
    """(text, anchor hash, context hash, anchor position, words before it, windows) of every anchor occurrence."""
    word, bounds = _words(texts)
    gram = max(1, length // 3)
    windows = np.maximum(np.diff(bounds) - length + 1, 0)
    start = tx.ragged(bounds[:-1], windows)
    if not len(start):
        return [np.empty(0, np.int64)] * 6
    spans = Spans(word)
    grams = spans.hash(np.arange(len(word) - gram + 1), gram)
    order = (mix(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_min(order, length - gram + 1)[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fresh = np.ones(len(start), bool)
    fresh[1:] = place[1:] != place[:-1]
    first = np.flatnonzero(fresh)
    count = np.diff(np.concatenate([first, [len(start)]]))
    place, start = place[first], start[first]
    doc = np.searchsorted(bounds, start, side="right") - 1
    with np.errstate(over="ignore"):
        shape = ((place - start) * 65536 + count).astype(np.uint64) * np.uint64(BASE)
        context = mix(spans.hash(start, count - 1 + length) ^ shape)
    return doc, grams[place].view(np.int64), context.view(np.int64), place - bounds[doc], place - start, count


def _find_anchors(length: int):
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, 1):
                doc, anchor, context, place, left, count = anchors(tx.text_array(part.column(1)), length)
                row = pa.array(doc)
                at = part.column(2).take(row).to_numpy(zero_copy_only=False).astype(np.int64) << 31 | place
                columns = [pa.array(anchor), pa.array(context), part.column(0).take(row), pa.array(at)]
                columns += [pa.array(x.astype(np.int16)) for x in (left, count)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "c", "d", "at", "l", "n"])

    return run


def _extend(length: int):
    """Hashes of all windows of the asked contexts."""

    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, 0):
                word, bounds = _words(tx.text_array(part.column(0)))
                spans, asked = Spans(word), part.column(1)
                starts = np.asarray(asked.offsets).astype(np.int64)
                flat = asked.flatten()
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(starts))
                place, left, count = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("p", "l", "n"))
                made = spans.hash(tx.ragged(bounds[doc] + place - left, count), length).view(np.int64)
                lists = tx.list_array(pa.array(made), np.concatenate([[0], np.cumsum(count)]))
                columns = [flat.field("a"), flat.field("c"), flat.field("d"), flat.field("l"), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "c", "d", "l", "hashes"])

    return run


def _remove(text, ranges):
    texts = tx.text_array(text)
    values, bounds = tx.words(texts)
    gone = np.zeros(len(values) + 1, np.int64)
    ranges = ranges if ranges.null_count == 0 else pc.if_else(ranges.is_valid(), ranges, pa.scalar([], ranges.type))
    flat, starts = ranges.flatten(), np.asarray(ranges.offsets).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(starts))
    first = bounds[doc] + flat.field("first").to_numpy(zero_copy_only=False).astype(np.int64)
    np.add.at(gone, first, 1)
    np.add.at(gone, first + flat.field("words").to_numpy(zero_copy_only=False).astype(np.int64), -1)
    keep = np.cumsum(gone[:-1]) == 0
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    kept = tx.list_array(values.filter(pa.array(keep)).cast(pa.string()), kept_before[bounds])
    total, left = np.diff(bounds).astype(np.int64), np.diff(kept_before[bounds]).astype(np.int64)
    return [pa.array(total), pa.array(total - left), pc.binary_join(kept, " ").cast(pa.string())]


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(d, v, ranges) for each document of ``docs`` (d: order, v: check sum, text) that repeats an earlier one.

    ``ranges`` are word ranges (first, words) covered by windows that start in a document of smaller ``d``; they may overlap.
    """
    rows = docs.select("d", "text", "v").where("v IS NOT NULL")
    found = cut_lineage(rows.mapInArrow(_find_anchors(length), "a bigint, c bigint, d bigint, at bigint, l smallint, n smallint"), "anchors")
    # Written first, like the other sides below: a join of two plain exchanges is one whose hot keys Spark can split.
    repeated = found.groupBy("a").agg(F.min("d").alias("low"), F.max("d").alias("high")).where("low < high").select("a")
    repeated = cut_lineage(repeated, "repeated")
    seen = cut_lineage(found.join(repeated, "a"), "seeds")
    contexts = seen.groupBy("a", "c").agg(
        F.min("d").alias("d"), F.min_by("at", "d").alias("at"), F.first("l").alias("l"), F.first("n").alias("n")
    )
    contexts = cut_lineage(contexts, "contexts")
    many = cut_lineage(contexts.groupBy("a").agg(F.min("c").alias("low"), F.max("c").alias("high")), "anchors-of-contexts")
    contexts = cut_lineage(contexts.join(many, "a").withColumn("many", F.expr("low <> high")).drop("low", "high"), "contexts")
    alone = contexts.where("NOT many").select("a", "c", "d", F.lit(None).cast("array<bigint>").alias("firsts"))
    asked = contexts.where("many").select(
        "a", "c", "d", F.shiftright("at", 31).alias("v"), F.expr("CAST(at & 2147483647 AS int) AS p"), "l", "n"
    )
    asked = asked.groupBy("d", "v").agg(F.collect_list(F.struct("a", "c", "d", "p", "l", "n")).alias("asked"))
    windows = (
        docs.select("d", "v", "text").join(asked, ["d", "v"]).dropDuplicates(["d", "v"]).select("text", "asked")
        .mapInArrow(_extend(length), "a bigint, c bigint, d bigint, l smallint, hashes array<bigint>")
    )
    windows = windows.select("a", "c", "d", "l", F.posexplode("hashes").alias("o", "w"))
    windows = cut_lineage(windows.withColumn("r", F.col("o") - F.col("l")).drop("l"), "windows")
    first = cut_lineage(windows.groupBy("a", "r", "w").agg(F.min("d").alias("f")), "first")
    firsts = windows.join(first, ["a", "r", "w"]).groupBy("a", "c").agg(F.collect_list(F.struct("o", "f")).alias("firsts"))
    firsts = firsts.select("a", "c", F.lit(None).cast("bigint").alias("e"), "firsts")
    alone = alone.select("a", "c", F.col("d").alias("e"), F.lit(None).cast(firsts.schema["firsts"].dataType).alias("firsts"))
    start = F.expr("CAST((at & 2147483647) - l AS int)")
    whole = F.array(F.struct(start.alias("first"), (F.col("n") + F.lit(length - 1)).cast("int").alias("words")))
    each = F.transform(
        F.filter("firsts", lambda x: x["f"] < F.col("d")),
        lambda x: F.struct((start + x["o"]).cast("int").alias("first"), F.lit(length).alias("words")),
    )
    hit = seen.join(cut_lineage(alone.unionByName(firsts), "decided"), ["a", "c"]).withColumn("v", F.shiftright("at", 31))
    hit = hit.select("d", "v", F.when(F.col("firsts").isNotNull(), each).when(F.col("e") < F.col("d"), whole).alias("ranges"))
    return hit.where(F.size("ranges") > 0).groupBy("d", "v").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def _check(text):
    """31-bit check sum that tells apart rows of one id."""
    return F.crc32(text).bitwiseAND(F.lit(0x7FFFFFFF))


def remove_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed and kept: the words that are in no repeat of an earlier document, joined by one space.

    Words are the longest runs without ASCII white space, unchanged. Windows are judged on the input. A null or empty text has no words and an
    empty ``kept``. Equal ids are one place in the order, so rows of one id never remove each other's words; a null id comes
    after all others. An empty table gives an empty table; extra columns pass through unless they bear a result's name.
    """
    names = docs.columns
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(2**63 - 1))
    plain = docs.select(order.alias("d"), _check(F.col(text)).alias("v"), F.col(text).alias("text"))
    ranges = repeated_ranges(plain, length)
    rows = docs.select(F.struct(*[F.col(n) for n in names]).alias("row"), order.alias("d"), _check(F.col(text)).alias("v"))
    rows = rows.join(ranges, ["d", "v"], "left").select(*[F.col("row")[n].alias(f"c{i}") for i, n in enumerate(names)], "ranges")
    at = f"c{names.index(text)}"
    out = tx.attach(rows, _remove, "n_words bigint, n_removed bigint, kept string", text=at, ranges="ranges").drop("ranges")
    new = ["n_words", "n_removed", "kept"]
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in new], *new)
