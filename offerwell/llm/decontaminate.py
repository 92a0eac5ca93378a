"""Benchmark decontamination with suffix arrays of the training text.

Every bounded slice of documents is a shard. Its suffix array orders the word positions of the shard that can start a match (runs of
words that all occur in the benchmark and are long enough to hold a window) by the text that follows them, with prefix doubling up to the
length of the longest item. Every suffix of every benchmark item is searched in every shard by binary search, one word
deeper at a time, which gives the places of each window and of the longest verbatim matches. Nothing is shuffled: the benchmark goes to the
documents in blocks of at most ``BLOCK_WORDS`` words, one pass for each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.llm import text as tx

#: Most words of the benchmark that are broadcast at once (a longer single item is a block of its own).
BLOCK_WORDS = 1 << 20
MATCHES = "array<struct<item_id:string,item_start:int,doc_start:int,length:int>>"
_MATCH = pa.struct(
    [("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())]
)


class Items:
    """Words of a block of benchmark items as numbers from 1; ``start`` has the first word of each item, with the end."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        values, start = tx.words(pa.array(texts, pa.string()), tx.LOWER_WORDS)
        codes, distinct = tx.coded(values)
        self.ids, self.number = np.array(ids, object), {w: i + 1 for i, w in enumerate(distinct)}
        self.tokens, self.start, size = codes + 1, start, np.diff(start)
        self.window = np.minimum(size, window)
        self.shortest = int(self.window[size > 0].min()) if size.any() else 0
        self.longest = int(size.max()) if len(size) else 0
        self.item = np.repeat(np.arange(len(ids)), size)
        self.left = start[1:][self.item] - np.arange(len(self.tokens))  # words of the item from here on


def blocks(items: DataFrame, key: str, text: str, window: int, limit: int = BLOCK_WORDS):
    """The items in blocks of at most ``limit`` words; items without words are left out, a null id counts as the empty string."""
    ids, texts, size = [], [], 0
    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit("")))
    for name, body in rows.toLocalIterator():
        n = len(body) // 2 + 1  # no text has more words
        if ids and size + n > limit:
            yield Items(ids, texts, window)
            ids, texts, size = [], [], 0
        ids.append(name)
        texts.append(body)
        size += n
    if ids:
        yield Items(ids, texts, window)


def suffix_array(tokens: np.ndarray, shortest: int, longest: int) -> np.ndarray:
    """Positions in runs of at least ``shortest`` known words (not 0), ordered by their next ``longest`` words at least."""
    known = np.concatenate([[0], (tokens > 0).astype(np.int8), [0]])
    edge = np.flatnonzero(np.diff(known))
    first, end = edge[0::2], edge[1::2]
    long = end - first >= shortest
    at = tx.ragged(first[long], (end - first)[long])
    if not len(at):
        return at
    rank = np.zeros(len(tokens) + 1, np.int64)
    rank[at] = tokens[at]
    depth = 1
    while True:
        ahead = rank[np.minimum(at + depth, len(tokens))]
        if depth >= longest:
            return at[np.argsort(rank[at], kind="stable")]
        _, order = np.unique(rank[at] * (int(rank.max()) + 1) + ahead, return_inverse=True)
        rank[at] = order + 1
        depth *= 2


def bound(tokens: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray, upper: bool):
    """First place in ``order[low:high]`` whose word at ``depth`` is not below (or, for ``upper``, above) ``word``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        seen = tokens[np.minimum(order[np.minimum(middle, len(order) - 1)] + depth, len(tokens) - 1)]
        right = open_ & ((seen <= word) if upper else (seen < word))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


def search(items: Items, tokens: np.ndarray, order: np.ndarray):
    """Places of all windows in the suffix array: (item position, word position) of each occurrence."""
    query = np.flatnonzero(items.left >= items.window[items.item])
    low, high = np.zeros(len(query), np.int64), np.full(len(query), len(order))
    found_q, found_p = [], []
    for depth in range(int(items.window.max(initial=0))):
        word = items.tokens[query + depth]
        a = bound(tokens, order, low, high, depth, word, False)
        b = bound(tokens, order, a, high, depth, word, True)
        alive = a < b
        query, low, high = query[alive], a[alive], b[alive]
        whole = items.window[items.item[query]] == depth + 1
        if whole.any():
            count = (high - low)[whole]
            found_q.append(np.repeat(query[whole], count))
            found_p.append(order[tx.ragged(low[whole], count)])
            query, low, high = query[~whole], low[~whole], high[~whole]
        if not len(query):
            break
    if not found_q:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_p)


def find(items: Items, texts: pa.Array):
    """(first word of each text, with the end; text, item, item word, text word and length of each longest verbatim match)."""
    values, bounds = tx.words(texts, tx.LOWER_WORDS)
    codes, distinct = tx.coded(values)
    none = [np.empty(0, np.int64)] * 5
    if not distinct or not len(items.tokens):
        return bounds, none
    number = np.array([items.number.get(w, 0) for w in distinct], np.int64)
    n = len(bounds) - 1
    tokens = np.zeros(len(codes) + n + 1, np.int64)  # a 0 after every text: no match runs on into the next one
    owner = np.repeat(np.arange(n), np.diff(bounds))
    tokens[np.arange(len(codes)) + owner] = number[codes]
    order = suffix_array(tokens, items.shortest, items.longest)
    if not len(order):
        return bounds, none
    query, place = search(items, tokens, order)
    doc = np.searchsorted(bounds[1:] + np.arange(1, n + 1), place, side="right")
    place = place - doc - bounds[doc]
    item, offset = items.item[query], query - items.start[items.item[query]]
    # Windows that follow each other at the same distance are one longer match.
    sort = np.lexsort((place, place - offset, item, doc))
    doc, item, offset, place = doc[sort], item[sort], offset[sort], place[sort]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(place) != 1) | (np.diff(offset) != 1)
    first = np.flatnonzero(fresh)
    windows = np.diff(np.concatenate([first, [len(doc)]]))
    return bounds, [doc[first], item[first], offset[first], place[first], items.window[item[first]] + windows - 1]


def match_items(
    docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside a match) and matches: the longest verbatim matches with the benchmark.

    Texts are lower-cased (A-Z) and read as runs of letters, digits and non-ASCII characters. A match covers at least ``window``
    words, or a whole item of fewer words; it has the item, the places of its first word in item and document and its number
    of words. A null or empty text has no words and no match; items without words match nothing; an item with a null id has the empty id.
    Repeated items and documents are matched each for itself; an empty table on either side gives no matches. Extra columns pass through unless
    they bear a result's name.
    """
    spark, out = docs.sparkSession, docs
    fields = f"n_words bigint, n_hit bigint, matches {MATCHES}"
    done = False
    for block in blocks(items, item_key, item_text, window):
        shared = spark.sparkContext.broadcast(block)  # at most BLOCK_WORDS words
        out = tx.attach(out, _matcher(shared), fields, text=text, **({"matches": "matches"} if done else {}))
        done = True
    if not done:
        shared = spark.sparkContext.broadcast(Items([], [], window))
        out = tx.attach(out, _matcher(shared), fields, text=text)
    return out


def _matcher(shared):
    def run(text, matches=None):
        items = shared.value
        texts = tx.text_array(text)
        bounds, (doc, item, offset, place, length) = find(items, texts)
        size = np.diff(bounds)
        names = items.ids[item] if len(item) else np.empty(0, object)
        if matches is not None:  # of earlier blocks
            flat, starts = matches.flatten(), np.asarray(matches.offsets).astype(np.int64)
            old = np.repeat(np.arange(len(size)), np.diff(starts))
            doc = np.concatenate([doc, old])
            names = np.concatenate([names, np.array(flat.field("item_id").to_pylist(), object)])
            offset, place, length = (
                np.concatenate([x, flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64)])
                for x, k in ((offset, "item_start"), (place, "doc_start"), (length, "length"))
            )
            sort = np.argsort(doc, kind="stable")
            doc, names, offset, place, length = (x[sort] for x in (doc, names, offset, place, length))
        change = np.zeros(len(text) + int(size.sum()) + 1, np.int64)
        start = bounds[doc] + doc + place
        np.add.at(change, start, 1)
        np.add.at(change, start + length, -1)
        hit = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
        at = bounds + np.arange(len(bounds))
        found = pa.StructArray.from_arrays(
            [pa.array(list(names), pa.string()), *(pa.array(x.astype(np.int32)) for x in (offset, place, length))],
            fields=list(_MATCH),
        )
        counts = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(size)))])
        return [pa.array(size.astype(np.int64)), pa.array(np.diff(hit[at]).astype(np.int64)), tx.list_array(found, counts)]

    return run


def without_matches(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark, with the columns of ``docs``."""
    found = match_items(docs.select(F.struct("*").alias("row"), F.col(options.pop("text", "text")).alias("text")), items, **options)
    return found.where("n_hit = 0").select("row.*")
