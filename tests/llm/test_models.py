"""Context-tree weighting against its recursive definition, the classifier on held-out labels, the fixity audit, the stages."""

import hashlib
import math
import os
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from check_queries import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from offerwell.llm import context_tree, fixity, quality, queries
from offerwell.llm import text as tx

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


class Tree:
    """Context-tree weighting by its definition, node by node."""

    def __init__(self, texts, depth):
        self.depth, self.count = depth, defaultdict(lambda: [0, 0])
        for t in texts:
            for context, prefix, bit in self.decisions(t):
                for k in range(depth + 1):
                    self.count[context[depth - k :], prefix][bit] += 1
        below, self.mixed = defaultdict(list), {}
        for context, prefix in self.count:
            if context:
                below[context[1:], prefix].append((context, prefix))
        for node in sorted(self.count, key=lambda n: -len(n[0])):
            own = self.kt(*self.count[node])
            if len(node[0]) < depth:
                product = sum(self.mixed[c] for c in below[node])
                top = max(own, product)
                self.mixed[node] = math.log(0.5) + top + math.log(math.exp(own - top) + math.exp(product - top))
            else:
                self.mixed[node] = own

    @staticmethod
    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def decisions(self, text):
        whole = bytes(self.depth) + text + b"\xff"
        for i in range(self.depth, len(whole)):
            for j in range(8):
                yield whole[i - self.depth : i], (1 << j) | (whole[i] >> (8 - j)), (whole[i] >> (7 - j)) & 1

    def chance(self, context, prefix, bit, k=0):
        node = context[self.depth - k :], prefix
        if node not in self.count:
            return 0.5
        n = self.count[node]
        own = (n[bit] + 0.5) / (sum(n) + 1)
        if k == self.depth:
            return own
        stop = math.exp(math.log(0.5) + self.kt(*n) - self.mixed[node])
        return stop * own + (1 - stop) * self.chance(context, prefix, bit, k + 1)

    def score(self, text):
        return sum(math.log10(self.chance(*d)) for d in self.decisions(text))


def lowered(text):
    return (text or "").encode().translate(tx.LOWER)


def some_texts():
    rng = random.Random(6)
    syllables = ["the", "on", "er", "ing", " ", " ", ". ", "É", "\n", "A", "日"]
    texts = ["", None, "a", "THE end", "the end", "\x00\x00x", "zzz"]
    texts += ["".join(rng.choices(syllables, k=rng.randint(1, 60))) for _ in range(40)]
    return texts + [texts[9], texts[9]]


@pytest.mark.parametrize("depth,limit", [(2, 1 << 30), (5, 200)])
def test_context_tree_equals_definition(docs, monkeypatch, depth, limit):
    monkeypatch.setattr(context_tree, "CHUNK_BYTES", max(limit, 1))
    monkeypatch.setattr(context_tree, "GROUP_GRAMS", limit)
    rows = list(enumerate(some_texts())) + [(None, "no id")]
    train = F.col("doc_id") % 4 != 0
    got = context_tree.score_texts(docs(rows), train, depth).collect()
    used = [lowered(t) for i, t in rows if i is not None and i % 4]
    tree, counts = Tree(used, depth), Counter()
    for t in used:
        counts.update(t.split() + [b""])
    n, v = sum(counts.values()), len(counts)
    want = {}
    for i, t in rows:
        words = lowered(t).split() + [b""]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        want[i] = (not (i is not None and i % 4), len(words), sum(counts[w] > 0 for w in words), n, base, tree.score(lowered(t)))
    assert len(got) == len(rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9) and r["score"] == pytest.approx(w[5], rel=1e-9)


def test_context_tree_of_nothing(docs):
    assert context_tree.score_texts(docs([]), F.lit(True)).collect() == []
    row = context_tree.score_texts(docs([(1, "ab")]), F.lit(None).cast("boolean"), 3).first()
    assert row["train_tokens"] == 0 and row["held_out"] and row["score"] == pytest.approx(-24 * math.log10(2))


def test_words_and_grams_of_a_chunk_are_not_python_objects(monkeypatch):
    texts = [t or "" for t in some_texts()] * 3
    train = [i % 3 > 0 for i in range(len(texts))]
    used, known = Counter(), set()
    for t, use in zip(texts, train):
        words = lowered(t).split() + [b""]
        used.update(words if use else [])
        known.update(words)
    monkeypatch.setattr(context_tree, "SLICE", 100)
    monkeypatch.setattr(context_tree, "HELD", 20)  # several merges
    monkeypatch.setattr(context_tree.tx, "coded", None)  # makes a Python object of every word
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(train)], names=["text", "train"])
    counted, seen = Counter(), set()
    for part in context_tree._count_words([batch]):
        for word, n in zip(*(c.to_pylist() for c in part.columns)):
            counted[word] += n
            seen.add(word)
    assert seen == known and +counted == used
    table = pa.table({"chunk": pa.array([7] * len(texts), pa.int32()), "text": texts})
    asked = context_tree._asked_words(table).to_pydict()
    assert asked == {"chunk": [7] * len(known), "i": list(range(len(known))), "word": sorted(known)}
    monkeypatch.setattr(context_tree.np, "unique", None)  # hashes, and takes several times as long as sorting
    grams = context_tree._asked_grams(5)(table).column("gram").to_pylist()
    assert grams == sorted(set(context_tree.grams(pa.array(texts), 5)[0].tolist()))


def test_model_beats_a_uniform_byte(spark):
    rows = context_tree.score_texts(queries.table(spark, FOLDER, "documents"), F.col("doc_id") % 10 != 0)
    held = rows.where("held_out").agg(F.sum(F.col("bits_per_byte") * F.col("n_bytes")) / F.sum("n_bytes")).first()[0]
    assert held < 3.5


def labelled(spark, n=600):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(20, 120))]
        kind = rng.choice(["good", "good", "good", "toxic", "junk"])
        if kind == "toxic":
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["nasty", "vile", "awful"])
        text = " ".join(words)
        docs.append((i, text.upper() + "!!!" if kind == "junk" else text, rng.choice(["en", "fr", None]), f"s{rng.randrange(9)}", i))
        labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, id long"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_co_training_on_held_out_labels(spark):
    docs, labels = labelled(spark)
    model = quality.fit(docs, labels.where("doc_id % 3 < 2"), quality.Settings(least_documents=2))
    rows = quality.score(docs, model).join(labels, "doc_id").where("doc_id % 3 = 2").collect()
    right = sum(r["rejected"] == (r["quality"] == 0 or r["toxic"] == 1) for r in rows)
    assert right >= 0.93 * len(rows)
    good = [r for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(r["rejected"] for r in good) <= 0.05 * len(good)


def test_co_training_uses_all_unlabelled_documents(spark):
    """Documents far back in hash order bring terms and pseudo-labels of their own, also behind thousands of others."""
    rng = random.Random(4)
    plain = lambda *more: " ".join([*(f"w{rng.randrange(50)}" for _ in range(6)), *more])
    order = [r["id"] for r in spark.range(1000, 7000).orderBy(F.xxhash64("id")).collect()]
    bad = [i % 4 == 0 for i in range(400)]
    # One labelled document in five has no telling word, so that its text decides nothing and its source does.
    rows = [(i, plain(*(["vile" if b else "fine"] if i % 5 else [])), "en", "bad" if b else f"s{i % 3}") for i, b in enumerate(bad)]
    rows += [(i, plain("fine"), "en", f"s{i % 3}") for i in order[:5500]] + [(i, plain("outlier"), "en", "bad") for i in order[5500:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1, int(b)) for i, b in enumerate(bad)], "doc_id long, quality int, toxic int")
    terms, text = quality.fit(docs, labels, quality.Settings(rounds=1, iterations=10, page_iterations=10)).text.stages
    assert "outlier" in terms.vocabulary
    assert text.coefficients[terms.vocabulary.index("outlier")] > 0


def test_views_are_calibrated(spark):
    docs, labels = labelled(spark)
    known = labels.where("doc_id % 3 < 2")
    rows = quality.classify(docs, known).join(known, "doc_id").withColumn("id", F.col("doc_id"))
    rows = rows.where(quality._fold(None, 1, 5) == 0).collect()
    share = sum(r["quality"] == 0 or r["toxic"] == 1 for r in rows) / len(rows)
    for view in ("text_score", "page_score"):  # on the held-out fold a calibrated score has the mean of the labels
        assert sum(r[view] for r in rows) / len(rows) == pytest.approx(share, abs=1e-3)


def test_classifier_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = docs([(1, None), (2, ""), (2, "x"), (None, "y")])
    assert [r["rejected"] for r in quality.classify(some, none).collect()] == [False] * 4
    one = spark.createDataFrame([(1, 0, None), (2, None, 1), (77, 1, 0)], "doc_id long, quality int, toxic int")
    assert [r["rejected"] for r in quality.classify(some, one).collect()] == [True] * 4
    both = spark.createDataFrame([(1, 0, None), (2, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    scored = quality.classify(some, both).collect()
    assert len(scored) == 4 and all(0 <= r["bad_score"] <= 1 for r in scored) and scored[0]["row"] == scored[0]["doc_id"]
    assert quality.classify(docs([]), both).collect() == []


def archive(spark, rows):
    return spark.createDataFrame(rows, "page_id long, record string").selectExpr("*", "page_id AS slot", "record AS file")


def offsets(rows):
    by, out = defaultdict(list), {}
    for i, t in rows:
        if i is not None and t is not None:
            by[i].append(t)
    for i in sorted(by):
        first = sum(out[j][1] for j in out if j // fixity.SLOTS == i // fixity.SLOTS)
        out[i] = (first, sum(len(t.encode()) for t in by[i]), sorted(by[i]))
    return out


def test_fixity_finds_every_difference(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randint(0, 40) + str(i)) for i in rng.sample(range(-300, 9_000), 700)] + [(None, "a"), (5_001, None)]
    rows += [(7, "é"), (7, "é"), (7, "b"), (10**9, "far")]
    other = dict.fromkeys(range(0))
    copy = []
    for i, t in rows:
        kind = rng.randrange(60)
        if kind == 0:
            continue
        copy.append((i, t if kind != 1 or t is None else t[:-1] + "#"))
    copy += [(12_345, "extra"), (7, "b")]
    rng.shuffle(copy)
    a, b = offsets(rows), offsets(copy)
    want = {}
    for i in a.keys() | b.keys():
        if a.get(i) != b.get(i):
            status = "missing" if i not in b else "extra" if i not in a else "changed" if a[i][2] != b[i][2] else "moved"
            want[i] = (status, *(a.get(i) or (None, None))[:2], *(b.get(i) or (None, None))[:2])
    got = fixity.audit(archive(spark, rows), archive(spark, copy)).collect()
    assert {r["page_id"]: (r["status"], r["offset_a"], r["length_a"], r["offset_b"], r["length_b"]) for r in got} == want
    assert len(got) == len(want) and other == {}


def test_fixity_of_equal_archives(spark):
    rows = [(i, str(i)) for i in range(50)] * 2
    assert fixity.audit(archive(spark, rows), archive(spark, rows[::-1])).collect() == []
    assert fixity.audit(archive(spark, []), archive(spark, [])).collect() == []
    got = fixity.audit(archive(spark, []), archive(spark, [(1, "a")])).collect()
    assert [(r["page_id"], r["status"], r["sha256_b"]) for r in got] == [(1, "extra", hashlib.sha256(b"a").hexdigest())]


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_sql(spark, name):
    assert compare(duck(FOLDER), queries.CHECKS[name], queries.QUERIES[name](spark, FOLDER)) == ""


def test_entry_registers_every_operator():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in names} and "pipeline" in names


def test_stage_quality_drops_planted_documents(spark, docs, tmp_path):
    """Toxic and junk documents that no label names go, clean ones stay as they are; the columns are those of the input."""
    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("mo", "ra", "ti", "ke", "lu", "so") for b in ("ban", "rel", "tin", "dor", "mas", "lek", "vo")]
    toxic = ["scumlike", "idiotic", "worthlessly", "vilest"]
    rows, labels, fate = [], [], {}
    for i in range(1_200):
        text = rng.choices(words, k=rng.randint(30, 120))
        kind = ("toxic", "junk", *["clean"] * 6)[i % 8]
        if kind == "toxic":
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(toxic))
        body = " ".join(text) + "." if kind != "junk" else "$$$ CLICK!!! >>> " * rng.randint(10, 40)
        rows.append((i, body))
        fate[i] = kind
        if rng.random() < 0.5:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    rows.append((5_000, None))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    whole = docs(rows, extra=False)
    kept = corpus_pipeline.keep_quality(spark, whole, str(tmp_path))
    assert kept.columns == whole.columns
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    texts, named = dict(rows), {i for i, *_ in labels}
    lost = lambda kind: [i not in got for i, k in fate.items() if k == kind and i not in named]
    assert all(got[i] == texts[i] for i in got)
    assert sum(lost("toxic")) >= 0.9 * len(lost("toxic")) and sum(lost("junk")) >= 0.9 * len(lost("junk"))
    assert sum(lost("clean")) <= 0.01 * len(lost("clean"))


def test_pipeline_stages(spark, docs, byte_bpe):
    """Every stage on what the one before it kept, with cases whose fate is known."""
    rng = random.Random(4)
    table = queries.table(spark, FOLDER, "documents")
    items = [r["text"] for r in queries.table(spark, FOLDER, "benchmark").orderBy("item_id").collect()]
    words = lambda n: [f"q{rng.randrange(5_000)}" for _ in range(n)]
    passage, long = " ".join(words(80)), words(300)
    near = list(long)
    near[150] = "changed"
    rows = [
        (10_000, " ".join(long)), (10_001, " ".join(near)), (10_002, " ".join(long)),
        (10_003, " ".join(words(60)) + " " + passage), (10_004, " ".join(words(70)) + " " + passage),
        (10_005, " ".join(words(50)) + " " + items[0]), (10_006, None), (10_007, ""),
    ]
    whole = table.unionByName(docs(rows, extra=False))
    kept = corpus_pipeline.STAGES[1][1](spark, whole, FOLDER)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert {10_000, 10_003, 10_004, 10_005, 10_006, 10_007} <= ids and not {10_001, 10_002} & ids
    assert kept.columns == table.columns
    cut = corpus_pipeline.STAGES[2][1](spark, kept, FOLDER)
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
    assert set(texts) == ids and texts[10_004][0] == rows[4][1][: -len(passage) - 1] and texts[10_004][1] == len(texts[10_004][0])
    assert texts[10_003][0] == rows[3][1] and texts[10_006][0] is None
    clean = corpus_pipeline.STAGES[3][1](spark, cut, FOLDER)
    left = {r["doc_id"] for r in clean.select("doc_id").collect()}
    assert 10_005 not in left and {10_000, 10_003, 10_004, 10_006, 10_007} <= left
    out = corpus_pipeline.STAGES[4][1](spark, clean, FOLDER).collect()
    assert {r["doc_id"] for r in out} == left and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in out)


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and all(r["round_trip"] for r in rows)


def test_every_stage_collects_the_driver_first(spark, monkeypatch):
    class Collected(Exception):
        pass

    def release(spark):
        raise Collected

    monkeypatch.setattr(corpus_pipeline, "release", release)
    rows = queries.table(spark, FOLDER, "documents")
    for _, stage in corpus_pipeline.STAGES:
        with pytest.raises(Collected):
            stage(spark, rows, FOLDER)
