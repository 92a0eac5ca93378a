"""Packing: the pieces against the tokenizers library, the bins against their capacities and a plain best-fit loop."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from offerwell.llm import packing
from offerwell.session import cut_lineage


def plain_best_fit(length, capacity, choice, weights):
    demand = [(n, 1, n * n) for n in length]
    w = weights or [sum(d[k] for d in demand) / len(demand) / capacity[k] for k in range(3)]
    order = sorted(range(len(length)), key=lambda i: -sum(w[k] * demand[i][k] / capacity[k] for k in range(3)))
    room, out = [], [None] * len(length)
    for i in order:
        fits = [b for b, r in enumerate(room) if all(r[k] >= demand[i][k] for k in range(3))]
        if choice == "norm":
            cost = {b: sum(w[k] * ((room[b][k] - demand[i][k]) / capacity[k]) ** 2 for k in range(3)) for b in fits}
        else:
            cost = {b: -sum(w[k] * room[b][k] * demand[i][k] / capacity[k] ** 2 for k in range(3)) for b in fits}
        best = min(fits, key=lambda b: (cost[b], b)) if fits else len(room)
        if not fits:
            room.append(list(capacity))
        room[best] = [r - d for r, d in zip(room[best], demand[i])]
        out[i] = best
    return out


@pytest.mark.parametrize("choice", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [(100, 100, 10_000), (100, 4, 10_000), (100, 100, 3_000)])
def test_best_fit_equals_plain_loop(choice, capacity):
    rng = random.Random(5)
    length = [rng.randint(1, 50) for _ in range(300)]
    got = packing.best_fit(np.array(length), capacity, choice, (3.0, 2.0, 1.0))
    want = plain_best_fit(length, capacity, choice, (3.0, 2.0, 1.0))
    # Costs that differ only by rounding may fall to another bin, so bins are compared by what matters: number and capacities.
    assert abs(got.max() - max(want)) <= 1
    for b in range(got.max() + 1):
        inside = [n for n, x in zip(length, got) if x == b]
        assert sum(inside) <= capacity[0] and 0 < len(inside) <= capacity[1] and sum(n * n for n in inside) <= capacity[2]


def rows(spark, length):
    data = [(i % 50, 0, 0, n, 1, i) for i, n in enumerate(length)]
    return spark.createDataFrame(data, "key long, piece int, start long, length long, ids_crc32 long, uid long")


def bins_of(placed, tokens):
    seq = {}
    for r in placed:
        seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens
    return seq


@pytest.mark.parametrize("limits", [{}, {"documents": 3}, {"cost": 2_000}, {"choice": "dot", "weights": (1.0, 0.5, 0.5)}])
def test_rounds_keep_every_piece(spark, monkeypatch, limits):
    monkeypatch.setattr(packing, "GROUP_ROWS", 64)
    rng = random.Random(9)
    length = [rng.choice([1, 1, 7, 13, 22, 40, 44]) for _ in range(1_000)] + ([] if "cost" in limits else [100, 100])
    placed = packing.pack(rows(spark, length), tokens=100, **limits).collect()
    assert sorted(r["uid"] for r in placed) == list(range(len(length)))
    seq = bins_of(placed, 100)
    for parts in seq.values():
        assert len(parts) <= limits.get("documents", 100) and sum(n * n for _, n in parts) <= limits.get("cost", 10_000)
    if not limits:
        assert len(seq) <= -(-sum(length) // 100) * 1.02 + 1


def test_equal_pieces_and_empty(spark):
    assert packing.pack(rows(spark, [])).collect() == []
    seq = bins_of(packing.pack(rows(spark, [60] * 40 + [100] * 3 + [1] * 7), tokens=100).collect(), 100)
    assert len(seq) == 43


def test_a_piece_that_fits_nowhere(spark):
    assert packing.longest_piece(100, None, 50) == 7 and packing.longest_piece(100) == 100
    with pytest.raises(Exception, match="longer than a sequence"):
        packing.pack(rows(spark, [8]), tokens=100, cost=50).collect()
    with pytest.raises(ValueError):
        packing.pack(rows(spark, [8]), tokens=100, documents=0)


def test_documents_of_the_library(spark, docs, word_bpe):
    library = Tokenizer.from_file(word_bpe)
    texts = [(1, "Que, it's a test. " * 60), (2, None), (3, ""), (None, "é.!? <|endoftext|>"), (4, "same"), (4, "same"), (5, "x" * 900)]
    placed = packing.pack_documents(docs(texts), word_bpe, tokens=64).collect()
    want = []
    for key, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), 64):
            part = ids[at : at + 64]
            want.append((key, at // 64, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted([tuple(r)[:5] for r in placed], key=str) == sorted(want, key=str)
    bins_of(placed, 64)


def test_sequences_hold_the_ids(spark, docs, word_bpe):
    encoded = cut_lineage(packing.pieces(docs([(i, "lorem ipsum dolor " * i) for i in range(30)]), word_bpe, 32, ids=True), "t")
    placed = cut_lineage(packing.pack(encoded.drop("ids"), tokens=32), "t")
    ids = {r["uid"]: np.frombuffer(r["ids"], "<u4").tolist() for r in encoded.collect()}
    order = {}
    for r in placed.orderBy("sequence_id", "offset").collect():
        order.setdefault(r["sequence_id"], []).append(ids[r["uid"]])
    got = {r["sequence_id"]: (np.frombuffer(r["ids"], "<u4").tolist(), r["ends"]) for r in packing.sequences(placed, encoded).collect()}
    assert got == {s: ([i for p in parts for i in p], np.cumsum([len(p) for p in parts]).tolist()) for s, parts in order.items()}
