"""Exact k-nearest-neighbour join without a cross join or a full pair list.

Reference vectors are cut into cells around a bounded set of pivots (Lu, Shen, Chen, Ooi: "Efficient processing of k
nearest neighbor joins using MapReduce", VLDB 2012). A query can only find one of its k nearest vectors in cells whose
distance bound reaches its k-th upper bound, so it is sent to those cells alone; a hot cell is cut into blocks of bounded
size. A task holds one block of queries and one block of vectors and emits only k rows per query; the k best over all blocks are
then chosen by rank. Within two blocks one matrix product in single precision bounds all distances; those that its error leaves
open are computed in double precision. The triangle inequality and the error bound make the result exact.

Vectors that do not cluster need all pairs. Their number grows with the square of the input; a block grows with the input up to
``BLOCK_CELLS`` numbers, so that a vector is copied to few blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerwell.session import cut_lineage

BLOCK = 1024
#: Most numbers of a block of vectors, and most distances that a task bounds at once.
BLOCK_CELLS = 1 << 21
#: Blocks that all vectors are cut into at least, from ``BLOCK`` vectors a block.
BLOCKS = 8
MAX_PIVOTS = 64
#: Hashes of a vector in the approximate join.
LSH_TABLES = 4
#: Distances are compared as rounded to so many digits.
DIGITS = 9


def _pivots(vectors: DataFrame, key: str, vec: str, n: int):
    """At most ``n`` pivot vectors, chosen by hash; a fixed small array on the driver."""
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    rows = vectors.orderBy(digest, key).limit(n).select(vec).collect()
    return np.array([r[0] for r in rows], dtype="float64")


def _distances(points, pivots):
    out = np.empty((len(points), len(pivots)))
    for i in range(0, len(points), 1024):
        diff = points[i : i + 1024, None, :] - pivots[None, :, :]
        out[i : i + 1024] = np.sqrt((diff * diff).sum(axis=2))
    return out


def _assign(df: DataFrame, key: str, vec: str, pivots) -> DataFrame:
    """Nearest pivot and its distance for every vector."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)  # at most MAX_PIVOTS vectors

    @F.pandas_udf("struct<cell int, reach double>")
    def nearest(v: pd.Series) -> pd.DataFrame:
        d = _distances(np.array(v.tolist(), dtype="float64").reshape(len(v), -1), shared.value)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": d[np.arange(len(v)), cell]})

    return df.select(F.col(key).alias("id"), F.col(vec).alias("vec"), nearest(F.col(vec)).alias("n")).select(
        "id", "vec", "n.cell", "n.reach"
    )


def _block(vectors: int, width: int) -> int:
    """Vectors of a block: an eighth of all, within ``BLOCK`` and ``BLOCK_CELLS`` numbers."""
    return max(1, min(max(BLOCK, -(-vectors // BLOCKS)), max(1, BLOCK_CELLS // max(width, 1))))


def _finite(table: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """(ids, matrix) of the rows whose numbers are all finite."""
    vecs, ids = (table.column(c).combine_chunks() for c in ("vec", "id"))
    flat = pc.list_flatten(vecs).to_numpy(zero_copy_only=False).astype("float64")
    points = flat.reshape(len(vecs), -1) if len(vecs) else flat.reshape(0, 0)
    good = np.isfinite(points).all(axis=1)
    return ids.filter(pa.array(good)).cast(pa.int64()), points[good]


def _hashed(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(ids, matrix, hashes) of the rows whose numbers are all finite."""
    ids, vecs, codes = (table.column(c).combine_chunks() for c in ("id", "vec", "codes"))
    points, codes = (
        pc.list_flatten(x).to_numpy(zero_copy_only=False).astype("float64").reshape(len(x), -1 if len(x) else 0) for x in (vecs, codes)
    )
    good = np.isfinite(points).all(axis=1)
    return ids.filter(pa.array(good)), points[good], codes[good]


def _same(qid: pa.Array, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For every query the first and the end of the vectors with its key; ``ids`` ascend, nulls last and like no key."""
    known = ids.drop_null().to_numpy()
    wanted, null = qid.fill_null(0).to_numpy(), qid.is_null().to_numpy(zero_copy_only=False)
    first = np.searchsorted(known, wanted)
    return first, np.where(null, first, np.searchsorted(known, wanted, side="right"))


def _up_to(squares: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the numbers that do not exceed their row's limit."""
    return np.divmod(np.flatnonzero(squares <= limit[:, None]), squares.shape[1])


def _open(squares: np.ndarray, k: int, limit_of) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the numbers within ``limit_of`` a bound per row that at least ``k`` of its numbers do not exceed.

    Of long rows only the least of every 32 numbers are looked at first.
    """
    stride = squares.shape[1] // 32
    if stride < 4 * k:
        return _up_to(squares, limit_of(np.partition(squares, k - 1, axis=1)[:, k - 1]))
    least = squares[:, : 32 * stride].reshape(len(squares), 32, stride).min(axis=1)
    limit = limit_of(np.partition(least, k - 1, axis=1)[:, k - 1])
    row, column = _up_to(least, limit)
    at = column[:, None] + stride * np.arange(32)
    near = squares[row[:, None], at] <= limit[row][:, None]
    row_rest, at_rest = _up_to(squares[:, 32 * stride :], limit)
    return np.concatenate([np.repeat(row, 32)[near.ravel()], row_rest]), np.concatenate([at[near], at_rest + 32 * stride])


def _nearest(asked: np.ndarray, points: np.ndarray, k: int, same=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of the ``k`` nearest points of every query, of equal distances the first points; ``same`` are left out."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    if not len(asked) or not len(points):
        return found[0]
    n, width = points.shape
    middle = points.mean(axis=0)
    y, x = points - middle, asked - middle
    yy, xx = (y * y).sum(axis=1), (x * x).sum(axis=1)
    top = max(yy.max(), xx.max())
    kind = np.float32 if top < 1e30 else np.float64
    # |x - y|^2 - |x|^2 = |y|^2 - 2xy as one product; every sum of ``width + 1`` products is off by at most this much.
    length = np.sqrt(yy.max())
    off = (width + 16) * float(np.finfo(kind).eps) * length * (2 * np.sqrt(xx) + length) + 1e-30
    right = np.vstack([y.T, yy]).astype(kind)
    step = min(len(x), max(1, BLOCK_CELLS // n))
    held = np.empty((step, n), kind)  # new memory for every step costs more than the product

    def limit_of(bound, xx, off):
        # The k-th distance is at most ``reach``; distances that round to the same number are as near.
        reach = np.sqrt(np.maximum(xx + bound + off, 0.0)) * (1 + 1e-12) + 2 * 10.0**-DIGITS
        return np.nextafter((reach * reach * (1 + 1e-12) - xx * (1 - 1e-12) + off).astype(kind), kind(np.inf))

    for i in range(0, len(x), step):
        part = x[i : i + step]
        m = len(part)
        if n > k and np.isfinite(top):
            squares = np.matmul(np.hstack([-2 * part, np.ones((m, 1))]).astype(kind), right, out=held[:m])
            if same is not None:
                first, size = same[0][i : i + m], (same[1] - same[0])[i : i + m]
                row = np.repeat(np.arange(m), size)
                squares[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + first[row]] = np.inf
            row, at = _open(squares, k, lambda bound, at=slice(i, i + m): limit_of(bound, xx[at], off[at]))
        else:
            row, at = np.divmod(np.arange(m * n), n)
        if same is not None:
            own = (at >= same[0][i + row]) & (at < same[1][i + row])
            row, at = row[~own], at[~own]
        d = np.empty(len(row))
        for j in range(0, len(row), 1 << 15):
            diff = asked[i + row[j : j + (1 << 15)]] - points[at[j : j + (1 << 15)]]
            d[j : j + (1 << 15)] = np.round(np.sqrt((diff * diff).sum(axis=1)), DIGITS)
        order = np.lexsort((at, d, row))
        row, at, d = row[order], at[order], d[order]
        start = np.searchsorted(row, np.arange(m))
        kept = (np.arange(len(row)) - start[row] < k) & np.isfinite(d)
        found.append((i + row[kept], at[kept], d[kept]))
    return tuple(np.concatenate(c) for c in zip(*found))


def knn_join(
    queries: DataFrame, vectors: DataFrame, k: int, key: str = "vec_id", vec: str = "embedding",
    block: int | None = None, exclude_same_key: bool = True,
) -> DataFrame:
    """The ``k`` nearest vectors of every query by Euclidean distance, ties by key, with 1/d weights.

    Returns (query_id, vec_id, distance, position, weight).
    """
    count = vectors.count()
    if block is None:
        first = vectors.select(F.size(vec).alias("n")).where("n > 0").first()
        block = _block(count, first["n"] if first else 1)
    # A pivot per half block of vectors, at most MAX_PIVOTS.
    centre = _pivots(vectors, key, vec, max(1, min(MAX_PIVOTS, count * 2 // block)))
    # A stored file can be one split: the work on its rows is dealt to all tasks.
    queries, vectors = queries.select(key, vec).repartition(key), vectors.select(key, vec).repartition(key)
    need = k + 1 if exclude_same_key else k
    assigned = _assign(vectors, key, vec, centre)
    # One row per cell: bounded by the number of pivots.
    cells = assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("reach")).collect()
    cell_no = np.array([c["cell"] for c in cells], dtype="int64")
    size = np.array([c["n"] for c in cells], dtype="int64")
    radius = np.array([c["reach"] for c in cells], dtype="float64")
    blocks = {int(c): int(-(-n // block)) for c, n in zip(cell_no, size)}
    shared = queries.sparkSession.sparkContext.broadcast((centre[cell_no], cell_no, size, radius))

    @F.pandas_udf("array<int>")
    def candidate_cells(v: pd.Series) -> pd.Series:
        points, numbers, sizes, reach = shared.value
        d = _distances(np.array(v.tolist(), dtype="float64").reshape(len(v), -1), points)
        upper = d + reach
        order = np.argsort(upper, axis=1)
        filled = np.cumsum(sizes[order], axis=1) >= need
        at = np.where(filled.any(axis=1), filled.argmax(axis=1), len(numbers) - 1)
        bound = np.take_along_axis(upper, order, axis=1)[np.arange(len(v)), at]
        near = d - reach <= (bound * (1 + 1e-9))[:, None]
        return pd.Series([numbers[row].astype("int32").tolist() for row in near])

    def block_of(n: int):
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    split = F.create_map(*[F.lit(x) for c, n in blocks.items() for x in (c, n)])
    q = queries.select(F.col(key).alias("id"), F.col(vec).alias("vec"))
    q = q.withColumn("cell", F.explode(candidate_cells(F.col("vec"))))
    # Queries of one cell are cut into blocks as well; their number follows the counted load of the cell.
    loads = {r["cell"]: r["n"] for r in q.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    q_split = F.create_map(*[F.lit(x) for c, n in loads.items() for x in (c, int(-(-n // block)))])
    q = q.withColumn("q_block", F.pmod(F.xxhash64("id"), q_split[F.col("cell")]).cast("int"))
    q = q.withColumn("v_block", F.explode(F.sequence(F.lit(0), split[F.col("cell")] - 1)))
    v = assigned.drop("reach").withColumn("v_block", F.pmod(F.xxhash64("id"), split[F.col("cell")]).cast("int"))
    v = v.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.coalesce(q_split[F.col("cell")], F.lit(0)) - 1)))

    def nearest_in_block(left: pa.Table, right: pa.Table) -> pa.Table:
        # A stable sort by distance then breaks ties by id. Vectors with numbers that are missing or not finite have no distance.
        (qid, asked), (ids, points) = _finite(left), _finite(right.sort_by("id"))
        row, at, d = _nearest(asked, points, k, _same(qid, ids) if exclude_same_key else None)
        return pa.table({"query_id": qid.take(row), "vec_id": ids.take(at), "distance": d})

    keys = ["cell", "v_block", "q_block"]
    found = (
        q.select("id", "vec", *keys).groupBy(*keys)
        .cogroup(v.select("id", "vec", *keys).groupBy(*keys))
        .applyInArrow(nearest_in_block, "query_id bigint, vec_id bigint, distance double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    best = found.withColumn("position", rank).where(F.col("position") <= k)
    weight = F.when(F.col("distance") > 0, 1.0 / F.col("distance"))
    return best.withColumn("weight", weight)


def knn_predict(neighbours: DataFrame, labels: DataFrame, label: str, key: str = "vec_id") -> DataFrame:
    """Distance-weighted mean label; an exact match (distance 0) decides alone."""
    rows = neighbours.join(labels.select(F.col(key).alias("vec_id"), F.col(label).cast("double").alias("_y")), "vec_id")
    exact = F.col("distance") == 0
    out = rows.groupBy("query_id").agg(
        F.avg(F.when(exact, F.col("_y"))).alias("_same"),
        F.sum(F.col("weight") * F.col("_y")).alias("_wy"),
        F.sum("weight").alias("_w"),
    )
    return out.select("query_id", F.coalesce("_same", F.try_divide("_wy", "_w")).alias("prediction"))


def _within(asked: np.ndarray, points: np.ndarray, radius: float):
    """(query, point, distance) of all pairs nearer than ``radius``, part by part; a product in single precision leaves few to compute."""
    if not len(asked) or not len(points):
        return
    n, width = points.shape
    middle = points.mean(axis=0)
    y, x = points - middle, asked - middle
    yy, xx = (y * y).sum(axis=1), (x * x).sum(axis=1)
    kind = np.float32 if max(yy.max(), xx.max()) < 1e30 else np.float64
    length = np.sqrt(yy.max())
    off = (width + 16) * float(np.finfo(kind).eps) * length * (2 * np.sqrt(xx) + length) + 1e-30
    limit = np.nextafter((radius * radius * (1 + 1e-9) - xx * (1 - 1e-12) + off).astype(kind), kind(np.inf))
    right = np.vstack([y.T, yy]).astype(kind)
    step = max(1, BLOCK_CELLS // n)
    for i in range(0, len(x), step):
        part = x[i : i + step]
        squares = np.matmul(np.hstack([-2 * part, np.ones((len(part), 1))]).astype(kind), right)
        row, at = np.divmod(np.flatnonzero(~(squares > limit[i : i + step, None])), n)
        for j in range(0, len(row), 1 << 15):
            r, a = i + row[j : j + (1 << 15)], at[j : j + (1 << 15)]
            diff = asked[r] - points[a]
            d = np.sqrt((diff * diff).sum(axis=1))
            near = d < radius
            if near.any():
                yield r[near], a[near], d[near]


def knn_join_lsh(
    queries: DataFrame, vectors: DataFrame, key: str, vec: str, radius: float, bucket: float = 2.0, block: int | None = None
) -> DataFrame:
    """Approximate pairs within a radius by random projections; for loads where the exact join costs too much.

    The pairs are those of ``BucketedRandomProjectionLSH.approxSimilarityJoin``: two vectors meet if one of their ``LSH_TABLES`` hashes is equal, and a pair
    of rows counts once. Buckets are cut into blocks of bounded size on both sides; a task bounds the distances of two blocks with one product and
    hands on only near pairs, from the first table whose hashes are equal. Vectors with numbers that are not finite are near to none.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket, numHashTables=LSH_TABLES, seed=42)
    model = lsh.fit(vectors.select(array_to_vector(vec).alias("features")))
    codes = F.array(*[F.get(vector_to_array(F.col("hashes")[k]), F.lit(0)) for k in range(LSH_TABLES)])

    def hashed(rows: DataFrame, name: str) -> DataFrame:
        # A stored file can be one split: the work on its rows is dealt to all tasks. Equal rows are one.
        rows = rows.select(F.col(key).alias("id"), F.col(vec).alias("vec")).distinct()
        rows = model.transform(rows.withColumn("features", array_to_vector("vec")))
        return cut_lineage(rows.select("id", "vec", codes.alias("codes")), name)

    left, right = hashed(queries, "lsh-queries"), hashed(vectors, "lsh-vectors")
    if block is None:
        first = right.select(F.size("vec").alias("n")).where("n > 0").first()
        block = _block(right.count(), first["n"] if first else 1)

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        sizes = rows.select(F.posexplode("codes").alias("t", "h")).groupBy("t", "h").agg(F.count("*").alias("n"))
        return sizes.select("t", "h", F.ceil(F.col("n") / block).cast("int").alias(name))

    cells = cut_lineage(blocks(left, "q_n").join(blocks(right, "v_n"), ["t", "h"]), "lsh-buckets")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        each = rows.select("id", "vec", "codes", F.posexplode("codes").alias("t", "h")).join(cells, ["t", "h"])
        each = each.withColumn(f"{own}_block", F.pmod(F.xxhash64("id"), F.col(f"{own}_n")).cast("int"))
        return each.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_n") - 1)))

    def near(left: pa.Table, right: pa.Table):
        (qid, asked, mine), (ids, points, theirs) = _hashed(left), _hashed(right)
        earlier = left.column("t")[0].as_py() if left.num_rows else 0
        out = [(qid[:0], ids[:0], np.empty(0))]
        for row, at, d in _within(asked, points, radius):
            new = ~(mine[row, :earlier] == theirs[at, :earlier]).any(axis=1)
            out.append((qid.take(row[new]), ids.take(at[new]), d[new]))
        columns = [pa.concat_arrays([o[0] for o in out]), pa.concat_arrays([o[1] for o in out]), np.concatenate([o[2] for o in out])]
        return pa.table(columns, names=["query_id", "vec_id", "distance"])

    keys, kind = ["t", "h", "q_block", "v_block"], lambda rows: rows.schema["id"].dataType.simpleString()
    q, v = dealt(left, "q", "v").select("id", "vec", "codes", *keys), dealt(right, "v", "q").select("id", "vec", "codes", *keys)
    schema = f"query_id {kind(left)}, vec_id {kind(right)}, distance double"
    return q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInArrow(near, schema).where("query_id <> vec_id")
