"""Similarity join of vectors with the epsilon grid order (Böhm, Braunmüller, Krebs and Kriegel, 2001).

Vectors of length one have a cosine of at least ``t`` exactly when they are at most ``e = sqrt(2 - 2 t)`` apart. They are rotated to their
principal axes, ordered by label and by their grid cells of side ``e`` on the leading axes, and cut into sequence intervals of
bounded size. Two intervals are joined only when their boxes are at most ``e`` apart; inside a join, both intervals are halved again and again, and
halves that are provably distant are skipped, down to blocks that are compared in double precision.

Equal vectors of one label are one point with a multiplicity. An interval pair returns one row per linked point: the number of its links and
a neighbour that spans them, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.llm.components import components
from offerwell.session import cut_lineage

INTERVAL = 1024  # points of a sequence interval
LEAF = 128  # points of a block that is compared directly
AXES = 12
MARGIN = 1e-6  # rounding of projections; boxes count as distant only beyond it


def _points(vectors: DataFrame, key: str, vec: str, label: str) -> DataFrame:
    """(id, label, unit) of every row; unit is null where it can have no links: id or label null, or a vector without a finite direction."""
    rows = vectors.select(
        F.col(key).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"), F.col(vec).cast("array<double>").alias("v")
    )
    finite = F.expr("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    top = F.array_max(F.transform("v", F.abs))
    rows = rows.withColumn("top", F.when(F.col("id").isNotNull() & F.col("label").isNotNull() & finite, top))
    scaled = rows.withColumn("v", F.when(F.col("top") > 0, F.transform("v", lambda x: x / F.col("top"))))  # squares stay in range
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return scaled.withColumn("norm", norm).select("id", "label", F.transform("v", lambda x: x / F.col("norm")).alias("unit"))


def _axes(points: DataFrame, axes: int) -> np.ndarray:
    """Leading principal axes (columns), from the covariance of all points; unit axes where there are too few points."""
    dims = points.select(F.size("unit").alias("n")).groupBy().agg(F.max("n").alias("n"), F.count("*").alias("rows")).first()
    d = dims["n"] or 0
    k = min(axes, d)
    if (dims["rows"] or 0) < 2 or k == 0:
        return np.eye(d)[:, :k]
    full = points.where(F.size("unit") == d).select(array_to_vector("unit").alias("unit"))
    return PCA(k=k, inputCol="unit", outputCol="p").fit(full).pc.toArray()


def _project(axes: np.ndarray, width: float):
    """Cells of the leading axes as an order-preserving string, and the projections."""

    def run(batches):
        for batch in batches:
            unit = batch.column(2)
            size = np.diff(np.asarray(unit.offsets))
            flat = unit.flatten().to_numpy(zero_copy_only=False)
            at = np.cumsum(size) - size
            where = np.zeros((len(size), axes.shape[1]))
            for n in np.unique(size):  # vectors of other lengths use the axes they have
                rows = np.flatnonzero(size == n)
                x = flat[at[rows][:, None] + np.arange(n)[None, :]]
                m = min(int(n), len(axes))
                where[rows] = x[:, :m] @ axes[:m]
            cell = np.floor(where / width).astype(np.int64) + 0x8000
            order = cell.astype(">u2").view(np.uint8).reshape(len(size), -1) if axes.shape[1] else np.zeros((len(size), 0), np.uint8)
            spots = pa.ListArray.from_arrays(
                pa.array(np.arange(len(size) + 1, dtype=np.int32) * axes.shape[1]), pa.array(where.ravel())
            )
            columns = [*batch.columns, pa.array([r.tobytes() for r in order], pa.binary()), spots]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cells", "spot"])

    return run


def _intervals(interval: int):
    """Cut the ordered points of a partition into intervals of one label and one vector length."""

    def run(batches):
        from pyspark import TaskContext

        part, held, last, number = TaskContext.get().partitionId(), [], None, 0

        def out():
            nonlocal number
            ids, label, units, weight, spots = zip(*held)
            spots = np.array(spots)
            number += 1
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([part << 32 | number], pa.int64()), "label": pa.array([label[0]], pa.string()),
                    "ids": pa.array([list(ids)], pa.list_(pa.int64())), "weight": pa.array([list(weight)], pa.list_(pa.int64())),
                    "data": pa.array([np.array(units, "<f8").tobytes()], pa.binary()),
                    "spots": pa.array([spots.astype("<f8").tobytes()], pa.binary()),
                    "low": pa.array([spots.min(axis=0).tolist()], pa.list_(pa.float64())),
                    "high": pa.array([spots.max(axis=0).tolist()], pa.list_(pa.float64())),
                }
            )

        for batch in batches:
            at = {c: batch.column(batch.schema.get_field_index(c)) for c in ("id", "label", "unit", "weight", "spot")}
            lists = []
            for c in ("unit", "spot"):
                ends = np.asarray(at[c].offsets) - at[c].offsets[0].as_py()
                lists.append(np.split(at[c].flatten().to_numpy(zero_copy_only=False), ends[1:-1]))
            for row in zip(at["id"].to_pylist(), at["label"].to_pylist(), lists[0], at["weight"].to_pylist(), lists[1]):
                kind = (row[1], len(row[2]))
                if held and (kind != last or len(held) >= interval):
                    yield out()
                    held = []
                held.append(row)
                last = kind
        if held:
            yield out()

    return run


BLOCK = "block bigint, label string, ids array<bigint>, weight array<bigint>, data binary, spots binary, low array<double>, high array<double>"


def _join(a, b, spot_a, spot_b, least: float, reach: float, same: bool, found) -> None:
    """Recursive join of two intervals; ``found`` gets (row of a, row of b) arrays of all links."""
    stack = [(0, len(a), 0, len(b))]
    while stack:
        i, j, k, m = stack.pop()
        if same and m <= i:  # the mirrored half
            continue
        x, y = spot_a[i:j], spot_b[k:m]
        gap = np.maximum(0, np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0)))
        if gap @ gap > reach * reach:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            p, q = np.nonzero(a[i:j] @ b[k:m].T >= least)
            p, q = p + i, q + k
            if same:
                p, q = p[p < q], q[p < q]
            found(p, q)
        elif j - i >= m - k:
            h = (i + j) // 2
            stack += [(i, h, k, m), (h, j, k, m)]
        else:
            h = (k + m) // 2
            stack += [(i, j, k, h), (i, j, h, m)]


def _roots(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Smallest index that the links (p, q) reach, for each of n nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[p], root[q])
        new = root.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        np.minimum.at(new, root[p], low)
        np.minimum.at(new, root[q], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(least: float, reach: float):
    """(id, links, other): number of links of every linked point in an interval pair, and one point that spans them."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(i)[r].as_py() for i, c in enumerate(batch.schema.names)}
                same = row["block_a"] == row["block_b"]
                sides = []
                for s in ("a", "b"):
                    n = len(row[f"ids_{s}"])
                    data = (np.frombuffer(row[f"{c}_{s}"], "<f8").reshape(n, -1) for c in ("data", "spots"))
                    sides.append((np.array(row[f"ids_{s}"]), np.array(row[f"weight_{s}"]), *data))
                (ids_a, weight_a, a, spot_a), (ids_b, weight_b, b, spot_b) = sides
                base = 0 if same else len(ids_a)
                ids = ids_a if same else np.concatenate([ids_a, ids_b])
                count, parts = np.zeros(len(ids), np.int64), []

                def found(p, q):
                    np.add.at(count, p, weight_b[q])
                    np.add.at(count, base + q, weight_a[p])
                    if len(p):
                        root = _roots(len(ids), p, base + q)
                        use = np.flatnonzero(root != np.arange(len(ids)))
                        parts.append((use, root[use]))

                _join(a, b, spot_a, spot_b, least, reach, same, found)
                if not parts:
                    continue
                root = _roots(len(ids), *(np.concatenate(x) for x in zip(*parts)))
                use = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[use]), pa.array(count[use]), pa.array(ids[root[use]])], names=["id", "links", "other"]
                )

    return run


def _near(boxes: DataFrame, reach: float, cells: int) -> DataFrame:
    """Pairs of intervals of one label whose boxes are at most ``reach`` apart, found through the cells of their first axis.

    Labels are joined on the cell of the first axis where the overlap of two boxes, widened by ``reach``, begins, so each pair is found once.
    """
    side = F.lit(max(reach, 1e-9))
    first = lambda c, wide: F.floor((F.col(c)[0] + wide) / side).cast("bigint")
    wide = boxes.withColumn("c", F.explode(F.sequence(first("low", -reach / 2 - MARGIN), first("high", reach / 2 + MARGIN))))
    a = wide.select(*[F.col(c).alias(f"{c}_a") for c in boxes.columns], "c", F.col("label").alias("l"))
    b = wide.select(*[F.col(c).alias(f"{c}_b") for c in boxes.columns], "c", F.col("label").alias("l"))
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y),
            lambda x, y: F.greatest(F.lit(0.0), x, y),
        ),
        F.lit(0.0),
        lambda s, x: s + x * x,
    )
    start = F.greatest(first("low_a", -reach / 2 - MARGIN), first("low_b", -reach / 2 - MARGIN))
    pairs = a.join(b, ["l", "c"]).where("block_a <= block_b AND length_a = length_b").where(F.col("c") == start)
    return pairs.where(gap <= (reach + MARGIN) ** 2).select("block_a", "block_b")


def similar_vectors(
    vectors: DataFrame, least: float = 0.93, key: str = "vec_id", vec: str = "embedding", label: str = "label",
    axes: int = AXES, interval: int = INTERVAL,
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row of ``vectors``.

    Two vectors are linked when their labels are equal and not null and their cosine, in double precision, is at least ``least``.
    n_links counts the other rows linked directly, component_id is the smallest id that links reach and kept is key = component_id. Vectors that
    are null, empty, zero or hold null or non-finite components, and rows with a null label or id, link with nothing and are kept; vectors of
    different lengths do not link. Every row counts as a vector; rows of one id share its component. An empty table gives an
    empty table; other columns are not read.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * least))
    points = cut_lineage(_points(vectors, key, vec, label), "points")
    usable = points.where("unit IS NOT NULL")
    equal = cut_lineage(usable.groupBy("label", "unit").agg(F.min("id").alias("rep"), F.count("*").alias("weight")), "equal")
    rotation = _axes(equal, axes)
    distinct = equal.select(F.col("rep").alias("id"), "label", "unit", "weight")
    columns = "id bigint, label string, unit array<double>, weight bigint, cells binary, spot array<double>"
    placed = distinct.mapInArrow(_project(rotation, max(reach, 1e-9)), columns)
    ordered = placed.repartitionByRange("label", F.size("unit"), "cells").sortWithinPartitions("label", F.size("unit"), "cells", "id")
    blocks = cut_lineage(ordered.mapInArrow(_intervals(interval), BLOCK), "intervals")
    boxes = blocks.select("block", "label", "low", "high", (F.length("data") / F.size("ids")).alias("length"))
    pairs = cut_lineage(_near(boxes, reach, axes), "interval-pairs")
    body = blocks.select("block", "ids", "weight", "data", "spots")
    both = pairs
    for s in ("a", "b"):
        both = both.join(body.select(*[F.col(c).alias(f"{c}_{s}") for c in body.columns]), f"block_{s}")
    names = [f"{c}_{s}" for s in ("a", "b") for c in body.columns]
    both = both.select(*names).repartition(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block_a", "block_b")
    linked = cut_lineage(both.mapInArrow(_links(least, reach + MARGIN), "id bigint, links bigint, other bigint"), "links")
    labels = components(linked.select(F.col("id").alias("a"), F.col("other").alias("b")))
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    found = equal.join(counts, equal["rep"] == counts["id"], "left").drop("id").join(labels, F.col("rep") == labels["id"], "left")
    n_links = F.coalesce("links", F.lit(0)) + F.col("weight") - 1  # equal vectors link with each other
    found = found.select("label", "unit", n_links.alias("n_links"), F.coalesce("component", "rep").alias("component"))
    rows = points.join(cut_lineage(found, "decided"), ["label", "unit"], "left")
    component = F.coalesce("component", "id")
    return rows.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
