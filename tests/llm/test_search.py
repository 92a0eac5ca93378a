"""Ranked search against scores of all pairs."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from offerwell.llm import max_sketch
from offerwell.session import work_dir

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k):
    docs = [(i, terms(t)) for i, t in docs]
    docs = [(i, t) for i, t in docs if t]
    n_docs, total, df = len(docs), sum(len(t) for _, t in docs), {}
    for _, t in docs:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in queries.items():
        scored = []
        for i, t in docs:
            m = 100 - 50 + (50 * len(t) * n_docs) // total
            hits = [(w, t.count(w)) for w in words if w in t]
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * tf) // (1000 * tf + 20 * m)) for w, tf in hits)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, k):
    path = work_dir(spark, "t")
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score long, words string")
    q = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, query int")
    max_sketch.write_index(d.repartition(3), path)
    return sorted([tuple(r) for r in max_sketch.search(spark, path, q, k).select("item_id", "rank", "doc_id", "score").collect()], key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "x1", "ÀB"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 10, 40])))) for i in range(300)]
    docs += [(500 + i, "w1 w2-w3") for i in range(30)] + [(7, "w5 again"), (7, "w5 again"), (None, "w50 w9"), (None, None), (901, ""), (902, " ..,")]
    docs += [(903, "w7 " * 3000 + "long")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 12])))) for i in range(25)] + [(100, None), (101, "nowhere"), (102, "W1 w1"), (103, ""), (3, "w44"), (None, "w9")]
    return docs, items


@pytest.mark.parametrize("k", [1, 7, 50])
def test_equals_all_pairs(spark, corpus, k):
    assert run(spark, *corpus, k) == brute(*corpus, k)


def test_blocks_of_queries(spark, corpus, monkeypatch):
    monkeypatch.setattr(max_sketch, "BLOCK_QUERIES", 7)
    assert run(spark, *corpus, 5) == brute(*corpus, 5)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert run(spark, [], items, 5) == [] and run(spark, docs, [], 5) == [] and run(spark, [(1, None)], items, 5) == []


def test_bounds_hold():
    """No document scores above its bound, whatever collides."""
    rng = np.random.default_rng(1)
    words = [f"t{i}".encode() for i in range(400)]
    queries = max_sketch.Queries([0, 1], [words[:30], words[200:260]])
    queries.weigh({}, 1000)
    one, two = max_sketch._coordinates(words)
    for n in (3, 50, 400):
        known = rng.choice(400, n, replace=False)
        value = rng.integers(1, 1_000_000, n)
        width = int(max_sketch._width(np.array([n]))[0])
        sketch = np.zeros(width, np.uint16)
        for h in (one, two):
            np.maximum.at(sketch, h[known] & (width - 1), -(-value // max_sketch.UNIT))
        bound = max_sketch._bounds(queries, pa.array([sketch.tobytes()], pa.binary()))
        impacts = dict(zip([words[i] for i in known], value.tolist()))
        for q, weights in enumerate(queries.weights):
            exact = sum(w * impacts.get(queries.words[t], 0) for w, t in zip(weights, queries.terms[q]))
            assert bound[q, 0] >= exact
