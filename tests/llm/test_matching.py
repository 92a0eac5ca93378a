"""Near-duplicates, repeats, decontamination, components and the vector join against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from offerwell.llm import decontaminate, grid_join, near_dup, repeats
from offerwell.llm import text as tx
from offerwell.llm.components import components


def roots(n, pairs):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(a) for a in range(n)]


def sentence(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    n = 60
    pairs = {
        "chain": [(i, i + 1) for i in range(n - 1)],
        "star": [(30, i) for i in range(n) if i != 30],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(40)],
        "none": [],
    }[kind]
    links = spark.createDataFrame(pairs + [(None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    want = roots(n, pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: want[x] for x in linked}


def weighted(text):
    w = (text or "").encode().translate(tx.LOWER).split()
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def classes(rows, threshold=0.8):
    sets = [weighted(t) for _, t in rows]
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            both, any_ = sum((sets[a] & sets[b]).values()), sum((sets[a] | sets[b]).values())
            if any_ and both >= threshold * any_:
                pairs.append((b, a))
    return roots(len(rows), pairs)


def near_rows():
    rng = random.Random(5)
    base = sentence(rng, 200)
    texts = ["", None, "   ", "one", "ONE", "two words", "two  words\n", " ".join(base)]
    for k in range(25):  # a group of near copies, some of them further than 0.8 from the first
        w = list(base)
        for _ in range(k % 5):
            w[rng.randrange(len(w))] = "x"
        texts.append(" ".join(w))
    texts += [" ".join(base).upper()] * 6
    half = " ".join(base[:100])
    texts += [half + " " + " ".join(sentence(rng, 100)) for _ in range(12)]  # share a half only
    texts += ["spam " * 500, "spam " * 480, "spam " * 100]
    texts += [" ".join(sentence(rng, rng.randint(1, 60))) for _ in range(30)]
    texts.append(" ".join(sentence(rng, 30_000)))
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [near_dup.BLOCK_ROWS, 4])
def test_near_duplicates_equal_brute_force(docs, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", block)
    rows = near_rows()
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_dup.near_duplicates(docs(rows)).collect()}
    want = classes(rows)
    assert got == {i: (want[i], want[i] == i) for i, _ in rows}


@pytest.mark.parametrize("block", [near_dup.BLOCK_ROWS, 3])
def test_chains_of_near_copies(docs, monkeypatch, block):
    """Neighbours are similar, the ends are not, and the first member of a bucket often is too far away."""
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", block)
    rng = random.Random(7)
    rows = []
    for c in range(3):
        words = sentence(rng, 120)
        for i in range(14):
            rows.append((100 * c + (i * 5) % 14, " ".join(words)))
            words = list(words)
            words[(i * 9 + 4) % 120] = f"n{c}-{i}"
    rows.sort()
    want = classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(docs(rows)).collect()}
    assert got == {rows[k][0]: rows[want[k]][0] for k in range(len(rows))}


def test_near_duplicates_edge_rows(docs):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "a b c d e f"), (4, None)]
    got = sorted(map(tuple, near_dup.near_duplicates(docs(rows)).collect()), key=str)
    assert got == sorted([(None, 3, True), (3, 3, True), (3, 3, True), (9, 3, False), (4, 4, True)], key=str)
    assert near_dup.near_duplicates(docs([])).collect() == []
    assert [r["kept"] for r in near_dup.near_duplicates(docs([(1, None), (2, "")])).collect()] == [True, True]


def test_signature_agreement_is_weighted_jaccard():
    rng = random.Random(8)
    a = sentence(rng, 300, 50)
    b = a[:260] + sentence(rng, 60, 50)
    texts = [" ".join(a), " ".join(b)]
    owner, element, _, weight = near_dup.shingles(pa.array(texts))
    sign = near_dup.signatures(owner, element, weight, 4000)
    x, y = weighted(texts[0]), weighted(texts[1])
    true = sum((x & y).values()) / sum((x | y).values())
    assert abs((sign[0] == sign[1]).mean() - true) < 4 * (true * (1 - true) / 4000) ** 0.5
    assert not (sign == 0xFFFFFFFF).all()


def test_every_coordinate_has_a_dart():
    texts = ["a", "a b", " ".join(f"w{i}" for i in range(20_000))]
    owner, element, _, weight = near_dup.shingles(pa.array(texts))
    lowest = near_dup.signatures(owner, element, weight, 240)
    assert lowest.shape == (3, 240) and all(len(set(row.tolist())) > 150 for row in lowest)


def kept_words(rows, length):
    seen = {}
    order = lambda i: float("inf") if i is None else i
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            seen[key] = min(seen.get(key, float("inf")), order(i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k : k + length])] < order(i):
                gone |= set(range(k, k + length))
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out


@pytest.mark.parametrize("length", [2, 7, 50])
def test_repeats_equal_brute_force(docs, length):
    rng = random.Random(length)
    passage = [sentence(rng, n) for n in (length - 1, length, length + 1, 3 * length, 6 * length)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "a " * 400), (4, "a " * 300 + "b"), (5, "a b " * 100)]
    for i in range(6, 60):
        words = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passage)
            cut = rng.randint(0, len(p) // 2)
            words += sentence(rng, rng.randint(0, length)) + p[cut:]
        rows.append((i, ("\t" if i % 2 else "  ").join(words)))
    rows += [(None, rows[20][1]), (20, rows[20][1]), (21, rows[30][1]), (90, " ".join(sentence(rng, 40_000)))]
    rng.shuffle(rows)
    got = repeats.remove_repeats(docs(rows), length).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(kept_words(rows, length), key=str)


def test_repeats_of_nothing(docs):
    assert repeats.remove_repeats(docs([])).collect() == []
    got = repeats.remove_repeats(docs([(1, None), (2, "short")])).select("n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got)) == [(0, 0, ""), (1, 0, "short")]


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hits(rows, items, window):
    wins = defaultdict(set)
    for i, t in items:
        w = WORD.findall((t or "").encode().translate(tx.LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[k : k + n])].add("" if i is None else str(i))
    out = []
    for i, t in rows:
        w, hit, names = WORD.findall((t or "").encode().translate(tx.LOWER)), set(), set()
        for n in {len(k) for k in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    names |= wins[tuple(w[k : k + n])]
                    hit |= set(range(k, k + n))
        out.append((i, len(w), len(hit), ",".join(sorted(names))))
    return out


@pytest.mark.parametrize("limit", [decontaminate.BLOCK_WORDS, 30])
def test_matches_equal_brute_force(spark, docs, monkeypatch, limit):
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", (limit,))
    rng = random.Random(4)
    texts = [sentence(rng, n, 12) for n in (3, 9, 10, 11, 25, 40, 40)]
    items = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(7, None), (8, "..."), (None, "null id item of six words"), (10, "x " * 15), (1, "x " * 15)]
    rows = [(0, None), (1, ""), (2, "!? ."), (3, "X-x " * 300), (4, " ".join(texts[3]).upper().replace(" ", ", ")), (5, "null ID: item of six words")]
    for i in range(6, 40):
        words = sentence(rng, rng.randint(0, 30), 12)
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(texts)
            a = rng.randrange(len(t))
            words += t[a : a + rng.randint(1, 30)] + sentence(rng, rng.randint(0, 5), 12)
        rows.append((i, " ".join(words)))
    rows += [(9, rows[9][1]), (99, " ".join(sentence(rng, 20_000, 12)))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.match_items(docs(rows), table).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], ",".join(sorted({m["item_id"] for m in r["matches"]}))) for r in got) == sorted(
        hits(rows, items, 10)
    )
    words = {i: WORD.findall((t or "").encode().translate(tx.LOWER)) for i, t in rows}
    named = defaultdict(list)
    for i, t in items:
        named["" if i is None else str(i)].append(WORD.findall((t or "").encode().translate(tx.LOWER)))
    for r in got:
        for m in r["matches"]:
            part = words[r["doc_id"]][m["doc_start"] : m["doc_start"] + m["length"]]
            assert any(part == w[m["item_start"] : m["item_start"] + m["length"]] for w in named[m["item_id"]])


def test_no_matches_without_items(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_hit"], r["matches"]) for r in decontaminate.match_items(docs([(1, "a b")]), none).collect()] == [(0, [])]
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.match_items(docs([]), one).collect() == []
    kept = decontaminate.without_matches(docs([(1, "x a b y"), (2, "b a")]), one).collect()
    assert [r["doc_id"] for r in kept] == [2] and "n_hit" in kept[0].asDict() and kept[0]["n_hit"] == 2


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 4, 3_000)
    order = decontaminate.suffix_array(tokens, 3, 20)
    suffix = [tuple(tokens[i : i + 20]) for i in order]
    runs = [tuple(s[: s.index(0)]) if 0 in s else s for s in suffix]
    assert runs == sorted(runs) and len(set(order.tolist())) == len(order)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "vec_id AS id", "label AS unit")


@pytest.mark.parametrize("interval", [8, 1024])
def test_vector_join_equals_brute_force(spark, monkeypatch, interval):
    monkeypatch.setattr(grid_join, "LEAF", 4)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(6, 16))
    points = [centre[i % 6] + rng.normal(0, 0.1 + 0.1 * (i % 3), 16) for i in range(150)]
    points += [points[3]] * 20 + [2 * points[4], -points[5]]
    rows = [(i, [float(x) for x in p], i % 2) for i, p in enumerate(points)]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, None] + [0.5] * 14, [1.0, 2.0], [2.0, 4.0]]
    rows += [(200 + i, v, 0) for i, v in enumerate(odd)]
    rows += [(300, rows[3][1], None), (301, rows[3][1], None)]
    got = {r["vec_id"]: tuple(r)[1:] for r in grid_join.similar_vectors(vectors(spark, rows), 0.93, interval=interval).collect()}
    pairs, degree = [], Counter()
    ids = [r[0] for r in rows]
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a], rows[b]
            good = all(v[1] and None not in v[1] and np.isfinite(v[1]).all() and any(v[1]) and v[2] is not None for v in (x, y))
            if good and x[2] == y[2] and len(x[1]) == len(y[1]):
                p, q = (np.array(v[1], "float32").astype(float) for v in (x, y))
                if p @ q / np.sqrt(p @ p) / np.sqrt(q @ q) >= 0.93:
                    pairs.append((b, a))
                    degree[a] += 1
                    degree[b] += 1
    root = roots(len(rows), pairs)
    assert got == {ids[i]: (degree[i], ids[root[i]], root[i] == i) for i in range(len(rows))}


def test_vector_join_edges(spark):
    assert grid_join.similar_vectors(vectors(spark, [])).collect() == []
    got = grid_join.similar_vectors(vectors(spark, [(None, [1.0], 1), (2, None, 1), (3, [1.0], 1)])).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 0, None, True), (2, 0, 2, True), (3, 0, 3, True)], key=str)


def test_sha_of_no_items_is_that_of_the_empty_string():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
