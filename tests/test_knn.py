"""Exact neighbour join against brute force, through several cells and blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerwell.operators import knn
from offerwell.operators.knn import knn_join, knn_predict


@pytest.mark.parametrize("block", [16, 64])
def test_knn_equals_brute_force(spark, block):
    rng = np.random.default_rng(11)
    points = np.concatenate([rng.normal(0, 0.2, (90, 4)), rng.normal(5, 1.0, (60, 4))]).astype("float32")
    points[7] = points[3]  # an exact copy
    df = spark.createDataFrame(
        [(i, [float(x) for x in p], i % 2) for i, p in enumerate(points)],
        "vec_id long, embedding array<float>, label int",
    )
    found = knn_join(df, df, 5, block=block).cache()
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append((r["position"], r["vec_id"], r["distance"]))
    wide = points.astype("float64")
    for i in range(len(points)):
        d = np.round(np.sqrt(((wide - wide[i]) ** 2).sum(axis=1)), 9)
        order = [j for j in np.lexsort((np.arange(len(d)), d)) if j != i][:5]
        assert [(v, x) for _, v, x in sorted(got[i])] == [(j, d[j]) for j in order]
    predicted = {r["query_id"]: r["prediction"] for r in knn_predict(found, df, "label").collect()}
    assert len(predicted) == len(points) and predicted[3] == 1.0


def brute(asked, points, k, skip):
    out = []
    for i, x in enumerate(asked):
        d = np.round(np.sqrt(((x - points) ** 2).sum(axis=1)), 9)
        out += [(i, j, d[j]) for j in [j for j in np.lexsort((np.arange(len(d)), d)) if np.isfinite(d[j]) and j not in skip(i)][:k]]
    return out


@pytest.mark.parametrize("case", ["plain", "copies", "far", "huge", "tiny", "near_ties", "few"])
def test_product_bounds_lose_no_neighbour(case, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_CELLS", 5000)  # several steps
    rng = np.random.default_rng(3)
    points = rng.normal(0, 1, (900, 6))
    if case == "copies":
        points[100:400] = points[0]
    elif case == "far":
        points += 1e7
    elif case == "huge":
        points *= 1e20
    elif case == "tiny":
        points *= 1e-25
    elif case == "near_ties":  # apart by less than single precision sees, some by less than is compared
        points = np.repeat(rng.normal(0, 1, (30, 6)), 30, axis=0) + rng.normal(0, 1e-9, (900, 6))
    elif case == "few":
        points = points[:4]
    asked = np.concatenate([points[:150], rng.normal(0, 1, (20, 6))])
    first = np.minimum(np.arange(len(asked)), len(points))
    end = np.minimum(first + 2, len(points))  # a key that two vectors have
    row, at, d = knn._nearest(asked, points, 5, (first, end))
    want = brute(asked, points, 5, lambda i: range(first[i], end[i]))
    assert list(zip(row.tolist(), at.tolist(), d.tolist())) == want


def test_vectors_are_copied_to_few_blocks():
    """Every vector goes to every block of queries: their number has a bound, where the old one grew with the input up to the largest blocks."""
    for n in (10_000, 100_000, 262_000):
        assert -(-n // knn._block(n, 64)) <= knn.BLOCKS
    assert knn._block(10**9, 64) * 64 <= knn.BLOCK_CELLS and knn._block(500, 64) == knn.BLOCK and knn._block(10**9, 10**7) == 1


def test_odd_keys_and_numbers(spark):
    rows = [(i, [float(i), 0.0]) for i in range(12)] + [(None, [50.0, 0.0]), (3, [3.5, 0.0]), (20, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["distance"]) for r in knn_join(df, df, 1).collect()}
    # A key that two vectors have excludes both; a missing key is like no other; what is not finite is near nothing.
    assert (3, 0.5) in got and (3, 0.0) not in got and (None, 0.0) in got and 20 not in {q for q, _ in got}


@pytest.mark.parametrize("block", [None, 16])
def test_lsh_pairs_are_those_of_sparks_join(spark, block):
    """Clusters, equal rows, equal keys with different vectors, null keys, and fewer pairs compared than Spark hands on."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 5)) * 4
    rows = [(int(k), [float(x) for x in centres[k % 6] + rng.normal(size=5) * 0.4]) for k in range(150)]
    rows += rows[:7] + [(3, [0.5] * 5), (None, [0.5] * 5), (200, [float("nan")] * 5), (201, [float("inf")] + [0.0] * 4), (202, [0.5] * 5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = knn.knn_join_lsh(df, df, "vec_id", "embedding", 1.0, block=block)

    def featured(name):
        return df.select(F.col("vec_id").alias(name), array_to_vector("embedding").alias("features"))

    left, right = featured("query_id"), featured("vec_id")
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=2.0, numHashTables=4, seed=42).fit(right)
    pairs = model.approxSimilarityJoin(left, right, 1.0, "distance").select("datasetA.query_id", "datasetB.vec_id", "distance").where("query_id <> vec_id")
    listed = lambda x: sorted((r[0], r[1], round(r[2], 9)) for r in x.collect())
    assert listed(found) == listed(pairs) and len(listed(found)) > 1000
    # All meeting pairs, once per table, were rows of a join before; now only near ones leave a task.
    plans = [x._jdf.queryExecution().sparkPlan().toString() for x in (found, pairs)]
    assert ["CoGroupsInArrow" in p for p in plans] == [True, False]
