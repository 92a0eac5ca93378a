"""Memory and repeated work of the operators that run many small jobs or hold large tables."""

import gc
import math
import weakref
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from offerwell.llm import bpe, context_tree, quality
from offerwell.llm import text as tx


def test_logs_of_gamma_of_counts():
    counts = np.array([0.0, 1, 7, 100, context_tree.TABLED - 1, context_tree.TABLED, 3e6])
    for shift in (0.5, 1.0):
        found = context_tree._log_gamma(counts, shift)
        assert np.allclose(found, [math.lgamma(c + shift) for c in counts], rtol=1e-12, atol=1e-12)


def test_counts_come_from_the_table(monkeypatch):
    context_tree.kt(np.zeros(1), np.zeros(1))
    monkeypatch.setattr(context_tree, "gammaln", None)
    assert np.allclose(context_tree.kt(np.array([1.0]), np.array([0.0])), math.log(0.5))


def test_scores_do_not_depend_on_slices_and_held_entries(spark, docs, monkeypatch):
    rows = docs([(i, f"word {i % 7} and {'more ' * (i % 5)}é" if i % 11 else None) for i in range(60)])

    def scored():
        found = context_tree.score_texts(rows, F.col("doc_id") % 10 != 0).collect()
        return sorted((r["doc_id"], r["n_tokens"], r["n_known"], round(r["score"], 9), round(r["base_score"], 9)) for r in found)

    before = scored()
    monkeypatch.setattr(context_tree, "SLICE", 50)
    monkeypatch.setattr(context_tree, "HELD", 20)
    assert scored() == before


def test_driver_is_collected_before_every_fit(spark, docs, monkeypatch):
    calls = []
    monkeypatch.setattr(quality, "release", calls.append)
    rows = docs([(i, "good text here" if i % 2 else "bad words there") for i in range(80)], extra=False)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    quality.fit(rows, labels, quality.Settings(least_documents=1, iterations=2, page_iterations=2, rounds=1))
    assert len(calls) >= 4


def test_a_worker_drops_the_coder_of_an_earlier_operator(byte_bpe):
    name = lambda i: SimpleNamespace(id=i, broadcast=SimpleNamespace(value=i))
    coder = bpe.ByteBpe(tx.read_tokenizer(byte_bpe))
    coder.encode(pa.array(["some words"]))
    gone = weakref.ref(coder)
    gc.disable()  # the coder and its cache refer to each other
    try:
        tx.made(name("t-first"), lambda _: coder)
        del coder
        assert tx.made(name("t-first"), None) is gone()
        tx.made(name("t-second"), str)
        assert gone() is None
        tx.forget()
        assert not tx._MADE
    finally:
        gc.enable()


def test_slices_have_the_bytes_that_their_operator_asks_for(docs):
    rows = docs([(i, "x" * 1000) for i in range(60)], extra=False).coalesce(1)
    found = tx.attach(rows, lambda text: [pa.array([len(text)] * len(text), pa.int64())], "n bigint", limit=5000, text="text")
    assert {r["n"] for r in found.select("n").collect()} == {5}


def test_ids_do_not_depend_on_slices_and_held_units(byte_bpe, monkeypatch):
    texts = pa.array([f"word{i % 9} naïve  {i}\n<|x|> more{i} " * 3 for i in range(80)])
    coder = bpe.ByteBpe(tx.read_tokenizer(byte_bpe))
    want = coder.encode(texts)[0].tolist()
    monkeypatch.setattr(bpe, "UNITS_HELD", 6)
    monkeypatch.setattr(bpe, "PIECES_HELD", 6)
    small = bpe.ByteBpe(tx.read_tokenizer(byte_bpe))
    assert small.units.entries == 6 and sum((small.encode(texts.slice(i, 7))[0].tolist() for i in range(0, 80, 7)), []) == want
