"""Packing of token sequences by vector best-fit.

Every sequence (bin) has three capacities: tokens, number of documents, and attention cost (the sum of the squared lengths of its pieces, the
work of attention inside documents). A piece demands its length, one document and its squared length. Pieces are taken by falling weighted demand;
each goes to the open bin that has room in every dimension and either the smallest weighted residual norm after the piece is in, or the largest weighted dot
product of demand and residual. Weights are those given, or else the mean demand of a group's pieces over the capacity.

Pieces are dealt at random into groups of about ``GROUP_ROWS``, which are packed on their own. The worst-filled sixteenth of each group's bins is
opened again and its pieces are dealt anew in the next round, until one group holds all that is left: the number of rounds is
logarithmic, no task ever holds more than a group, and what the groups' last bins waste comes together in the end.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.llm import text as tx
from offerwell.llm.token_store import LibraryEncoder
from offerwell.session import cut_lineage

GROUP_ROWS = 1 << 14
#: One in so many bins of a group is opened again.
REOPENED = 16
PIECE = "key bigint, piece int, start bigint, length bigint, ids_crc32 bigint, uid bigint"


def pieces(docs: DataFrame, tokenizer: str, longest: int, end_id: int = 1, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32, uid and, with ``ids``, the ids as 32-bit integers) of all whole texts.

    A document's ids are those of its text, then ``end_id``; one of more than ``longest`` ids is cut into pieces of that length, the last may be
    shorter. ``uid`` tells pieces apart, also those of repeated rows. A null text is empty and has the end id alone.
    """
    shared = tx.Shared(docs.sparkSession, tx.read_tokenizer(tokenizer))
    schema = PIECE + (", ids binary" if ids else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        encoder, part, made = tx.made(shared, LibraryEncoder), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in tx.slices(batch, 1):
                found, bounds = encoder.encode(tx.text_array(rows.column(1)))
                n = rows.num_rows
                ends = bounds[1:] + np.arange(1, n + 1)
                whole = np.full(len(found) + n, end_id, "<u4")
                inside = np.ones(len(whole), bool)
                inside[ends - 1] = False
                whole[inside] = found
                first = np.concatenate([[0], ends[:-1]])
                count = -(-(ends - first) // longest)
                row = np.repeat(np.arange(n), count)
                piece = tx.ragged(np.zeros(n, np.int64), count)
                start = piece * longest
                length = np.minimum(longest, (ends - first)[row] - start)
                data = memoryview(whole).cast("B")
                at = (first[row] + start).tolist()
                cut = [data[4 * a : 4 * (a + b)] for a, b in zip(at, length.tolist())]
                uid = (part << 33) + made + np.arange(len(row))
                made += len(row)
                columns = [
                    rows.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(list(map(zlib.crc32, cut)), pa.int64()), pa.array(uid),
                ]
                if ids:
                    columns.append(pa.array([bytes(c) for c in cut], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")).mapInArrow(run, schema)


def best_fit(length: np.ndarray, capacity: tuple[int, int, int], choice: str = "norm", weights: tuple | None = None) -> np.ndarray:
    """Bin of every piece. ``capacity`` is (tokens, documents, attention cost); ``choice`` is "norm" or "dot"."""
    demand = np.stack([length, np.ones(len(length)), length.astype(np.float64) ** 2]).astype(np.float64)
    most = np.array(capacity, np.float64)
    weight = demand.mean(axis=1) / most if weights is None else np.array(weights, np.float64)
    scale = weight / most**2  # of products of unscaled numbers, which stay exact integers
    order = np.argsort(-(weight / most) @ demand, kind="stable")
    smallest = np.minimum.accumulate(demand[:, order[::-1]], axis=1)[:, ::-1]  # of the pieces from here on
    room, name, opened = np.empty((3, 64)), np.empty(64, np.int64), 0
    out, bins = np.empty(len(length), np.int64), 0
    for at, i in enumerate(order):
        if at % 1024 == 0 and opened:  # bins too full for any piece to come are closed
            open_ = np.flatnonzero((room[:, :opened] >= smallest[:, at, None]).all(axis=0))
            room[:, : len(open_)], name[: len(open_)] = room[:, open_], name[open_]
            opened = len(open_)
        need = demand[:, i]
        left = room[:, :opened] - need[:, None]
        fits = left.min(axis=0) >= 0 if opened else np.empty(0, bool)
        if fits.any():
            cost = scale @ (left * left) if choice == "norm" else -((scale * need) @ room[:, :opened])
            best = int(np.argmin(np.where(fits, cost, np.inf)))
            room[:, best] = left[:, best]
        else:
            if opened == room.shape[1]:
                room, name = np.concatenate([room, np.empty_like(room)], axis=1), np.concatenate([name, np.empty_like(name)])
            best, name[opened], room[:, opened] = opened, bins, most - need
            opened, bins = opened + 1, bins + 1
        out[i] = name[best]
    return out


def _placer(capacity: tuple, choice: str, weights: tuple | None, turn: int, last: bool):
    columns = [f.split()[0] for f in PIECE.split(", ")]

    def place(key, table):
        table = table.sort_by("uid")
        length = table.column("length").to_numpy()
        bins = best_fit(length, capacity, choice, weights)
        order = np.argsort(bins, kind="stable")
        fill = np.bincount(bins, weights=length)
        ends = np.cumsum(length[order])
        offset = np.empty(len(bins), np.int64)
        offset[order] = ends - length[order] - (np.cumsum(fill) - fill)[bins[order]].astype(np.int64)
        poor = np.argsort(fill, kind="stable")[: 0 if last else -(-len(fill) // REOPENED)]
        poor = poor[fill[poor] < capacity[0]]
        ids = (turn << 57) + (key[0].as_py() << 24) + bins
        extra = [pa.array(ids), pa.array(offset), pa.array(~np.isin(bins, poor))]
        return pa.Table.from_arrays([*(table.column(c) for c in columns), *extra], names=[*columns, "sequence_id", "offset", "settled"])

    return place


def pack(rows: DataFrame, tokens: int = 4096, documents: int | None = None, cost: int | None = None, choice: str = "norm", weights: tuple | None = None) -> DataFrame:
    """``rows`` of ``pieces`` with sequence_id and offset: the place of every piece, gapless from 0 within its sequence.

    ``documents`` and ``cost`` default to what ``tokens`` implies, so that they bind only where asked. A piece that exceeds a capacity alone is an error:
    cut pieces to ``longest_piece``. Pieces as long as a sequence are a sequence each. Equal pieces are packed like others; an empty table gives none.
    """
    capacity = (tokens, tokens if documents is None else documents, tokens**2 if cost is None else cost)
    if longest_piece(*capacity) < 1:
        raise ValueError("a capacity has no room for any piece")
    columns = [f.split()[0] for f in PIECE.split(", ")]
    schema = f"{PIECE}, sequence_id bigint, offset bigint, settled boolean"
    too_long = F.raise_error(F.lit("a piece is longer than a sequence holds"))
    rows = rows.select(*columns[:3], F.when(F.col("length") <= longest_piece(*capacity), F.col("length")).otherwise(too_long).alias("length"), *columns[4:])
    rows = cut_lineage(rows, "pieces")
    done = [rows.where(F.col("length") == tokens).select("*", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))]
    loose, turn = rows.where(F.col("length") < tokens), 0
    left = loose.count()
    while left:
        turn += 1
        groups = max(1, round(left / GROUP_ROWS))
        dealt = loose.withColumn("grp", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups)))
        placed = cut_lineage(dealt.groupBy("grp").applyInArrow(_placer(capacity, choice, weights, turn, groups == 1), schema), "packed")
        done.append(placed.where("settled").drop("settled"))
        loose = placed.where("NOT settled").select(*columns)
        left = 0 if groups == 1 else loose.count()
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def longest_piece(tokens: int, documents: int | None = None, cost: int | None = None) -> int:
    """Most tokens of a piece that fits an empty sequence."""
    if documents is not None and documents < 1:
        return 0
    return tokens if cost is None else min(tokens, math.isqrt(cost))


def pack_documents(docs: DataFrame, tokenizer: str, tokens: int = 4096, documents: int | None = None, cost: int | None = None, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All documents packed: rows of ``pieces`` with sequence_id and offset, the key under its own name.

    A null key and repeated rows keep their pieces; a null text is empty. Other columns are not read.
    """
    rows = pieces(docs, tokenizer, longest_piece(tokens, documents, cost), key=key, text=text)
    rows = pack(rows, tokens, documents, cost, **options)
    return rows.select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "uid")


def sequences(placed: DataFrame, encoded: DataFrame) -> DataFrame:
    """(sequence_id, ids as 32-bit integers, ends of its pieces) from placed pieces and the written rows of ``pieces`` with ids."""
    rows = placed.select("uid", "sequence_id", "offset", "length").join(encoded.select("uid", "ids"), "uid")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))  # one sequence: bounded by its capacities
    rows = rows.groupBy("sequence_id").agg(ordered.alias("p"))
    binary = F.expr("unhex(array_join(transform(p, x -> hex(x.ids)), ''))")
    return rows.select("sequence_id", binary.alias("ids"), F.transform("p", lambda x: x["offset"] + x["length"]).alias("ends"))
