"""Merkle manifest of a dataset, with a proof for every row, by butterfly exchange.

Rows are leaves, ordered within their group; every ``fanout`` consecutive nodes become one, up to a subroot for each group and, over the ordered
groups, one root. A partition of the tree is an aligned run of ``fanout ** levels`` leaves. It hashes its own subtree; then the
partitions go up together. In round ``r`` the partitions below one node form aligned sets of ``fanout`` subtrees of ``fanout ** r``
partitions, and every partition asks its counterpart in each other subtree (same place; in a shorter last subtree the place modulo its size)
for that subtree's root. With the answers it hashes the common ancestor itself, as all others of the set do. After the last
round every partition holds the root and has seen each sibling on its way up, so proofs need no pass down the tree.

Only digests are shuffled, and a task never holds more than one partition of the tree beside a batch. The exchange works on one row per
partition, ``fanout ** levels`` times fewer than leaves; each round is written, so that a lost executor repeats one round at most.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwell.llm import text as tx
from offerwell.session import cut_lineage

FANOUT = 3
LEVELS = 7
#: Rows of an output batch.
OUT_ROWS = 1 << 13


def row_digest(*fields: Column) -> Column:
    """SHA-256 of a row in lowercase hex: every field as its byte count, a colon and its text, null as ``-``."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their place in their group, groups with index and size): ``g`` and ``at`` follow the order of (name, key, leaf)."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def count(batches):
        tx.forget()
        part, name, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            names = batch.column(0)
            codes = np.asarray(names.dictionary_encode().indices)
            cut = np.flatnonzero(np.diff(codes)) + 1
            first = np.concatenate([[0], cut, [len(codes)]]).astype(np.int64)
            place = np.arange(len(codes)) - np.repeat(first[:-1], np.diff(first))
            if names[0].as_py() == name:
                place[: first[1]] += at
            name, at = names[-1].as_py(), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.full(len(codes), part, np.int32)), pa.array(place.astype(np.int64))], names=names_out
            )

    columns = "name string, key bigint, leaf string, other string"
    names_out = ["name", "key", "leaf", "other", "part", "place"]
    # Rows that are equal in everything may take any order among themselves; their number in the file lets ranges cut between them.
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    order = ["name", F.col("key").asc_nulls_first(), "leaf", "other", "tie"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = cut_lineage(rows.mapInArrow(count, f"{columns}, part int, place bigint"), "manifest-order")

    runs = rows.groupBy("name", "part").agg(F.count("*").alias("n"))  # at most a row per partition besides one per group
    earlier = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("name")
    runs = runs.select(
        "name", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("n_leaves"), F.min("part").over(whole).alias("opens")
    )
    runs = cut_lineage(runs, "manifest-runs")
    groups = runs.where("part = opens").select("name", "n_leaves", "opens")
    opened = groups.groupBy("opens").agg(F.count("*").alias("n"))  # a row per partition
    opened = opened.select("opens", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(1)).orderBy("opens").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    groups = groups.withColumn("rank", F.row_number().over(Window.partitionBy("opens").orderBy("name")) - 1).join(opened, "opens")
    groups = cut_lineage(groups.select("name", (F.col("base") + F.col("rank")).alias("g"), "n_leaves"), "manifest-groups")
    starts = runs.select("name", "part", "before").join(groups, "name")
    rows = rows.join(starts, ["name", "part"])
    return rows.select("g", (F.col("before") + F.col("place")).alias("at"), "n_leaves", "name", "key", "leaf", "other"), groups


def _whole(batches, n_keys: int = 2):
    """(key values, columns as lists) of every run of rows with equal first columns, across batches."""
    held_key, held = None, None
    for batch in batches:
        keys = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)])
        if not len(keys):
            continue
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        columns = [c.to_pylist() for c in batch.columns[n_keys:]]
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)]):
            key = tuple(keys[a].tolist())
            if key == held_key:
                for old, new in zip(held, columns):
                    old += new[a:b]
                continue
            if held is not None:
                yield held_key, held
            held_key, held = key, [c[a:b] for c in columns]
    if held is not None:
        yield held_key, held


def subtree(leaves: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """Nodes of every level above and with the leaves: ``levels`` more, or (None) until one node is left."""
    out = [leaves]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([_hash("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return out


def _exchange(state: DataFrame, own: str, count: Column, width: int, fanout: int, counterpart) -> DataFrame:
    """One round: every partition of ``state`` gets the roots of the other subtrees of its set and hashes their parent.

    ``own`` is its place, ``count`` the number of places, ``width`` those of a whole subtree; ``counterpart`` gives the (g, b) to ask.
    """
    node = F.floor(F.col(own) / width)
    total = F.ceil(count / width)
    first = node - node % fanout
    others = F.sequence(first, F.least(first + fanout - 1, total - 1))
    rows = state.withColumn("node", node).withColumn("open", total > 1)
    ask = rows.where("open").select("g", "b", own, count.alias("count"), "node", F.explode(others).alias("c")).where("c <> node")
    size = F.least(F.lit(width), F.col("count") - F.col("c") * width)
    to_g, to_b = counterpart(F.col("c") * width + (F.col(own) % width) % size)
    answers = state.select(F.col("g").alias("to_g"), F.col("b").alias("to_b"), F.col("digest").alias("root"))
    heard = ask.select("g", "b", "c", "node", to_g.cast("bigint").alias("to_g"), to_b.cast("bigint").alias("to_b")).join(answers, ["to_g", "to_b"])
    heard = heard.groupBy("g", "b").agg(F.array_sort(F.collect_list(F.struct("c", "root"))).alias("heard"))  # fanout - 1 at most
    rows = rows.join(heard, ["g", "b"], "left")
    heard = F.coalesce("heard", F.array().cast("array<struct<c:bigint,root:string>>"))
    side = lambda test: F.array_join(F.transform(F.filter(heard, test), lambda x: x["root"]), "")
    rows = rows.withColumn("left", side(lambda x: x["c"] < F.col("node"))).withColumn("right", side(lambda x: x["c"] > F.col("node")))
    step = F.array(F.struct("left", "right"))
    return rows.select(
        "g",
        "b",
        "n_blocks",
        F.when(F.col("open"), F.sha2(F.concat("left", "digest", "right").cast("binary"), 256)).otherwise(F.col("digest")).alias("digest"),
        "subroot",
        F.when(F.col("open"), F.concat("path", step)).otherwise(F.col("path")).alias("path"),
    )


def manifest(
    rows: DataFrame, group: str = "source", key: str = "doc_id", leaf: str = "leaf", check: str | None = None, fanout: int = FANOUT, levels: int = LEVELS, proofs: bool = False
) -> DataFrame:
    """One row per row: key, group, position in the group, leaf, subroot, root, proof_sha256, folded_root, verified (and proof).

    ``rows`` has an integer ``key``, a ``group`` and the digest ``leaf`` (``row_digest``). ``check`` is the digest of the row as found now; null
    or not given, the leaf itself is checked. The leaf is folded with its siblings up to folded_root, verified says whether that is the
    root; proof_sha256 is the hash of all siblings from the leaf upwards, left to right, and ``proof`` (with ``proofs``) holds them as one
    (left, right) pair of joined digests per level.

    Groups are ordered bytewise with null first, rows by key with null first, then by leaf: rows of one key keep separate leaves. A
    group of one row has that leaf as subroot, a single group's subroot is the root. An empty table gives an empty one. Other columns are
    not read, so their names do not matter.
    """
    given = F.lit(None).cast("string") if check is None else F.when(F.col(check) != F.col(leaf), F.col(check))
    name = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))  # null sorts first
    rows = rows.select(name.alias("name"), F.col(key).cast("bigint").alias("key"), F.col(leaf).alias("leaf"), given.alias("other"))
    rows, groups = _numbered(cut_lineage(rows, "manifest-leaves"))
    block = fanout**levels
    rows = rows.select("g", F.floor(F.col("at") / block).alias("b"), "at", "n_leaves", "name", "key", "leaf", "other")
    rows = cut_lineage(rows, "manifest-blocks")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def roots(batches):
        tx.forget()
        out = []
        for (g, b), (_, n, leaves) in _whole(batches):
            top = subtree(leaves, fanout, levels if n[0] > block else None)[-1][0]
            out.append((g, b, -(-n[0] // block), top))
        for i in range(0, len(out), OUT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out[i : i + OUT_ROWS])], names=["g", "b", "n_blocks", "digest"])

    own = rows.select("g", "b", "at", "n_leaves", "leaf").repartition(parts, "g", "b").sortWithinPartitions("g", "b", "at")
    state = own.mapInArrow(roots, "g bigint, b bigint, n_blocks bigint, digest string")
    path = F.array().cast("array<struct<left:string,right:string>>")
    state = cut_lineage(state.select("*", F.lit(None).cast("string").alias("subroot"), path.alias("path")), "manifest-state")
    most, n_groups = state.agg(F.max("n_blocks"), F.max("g") + 1).first()
    width = 1
    while width < (most or 0):
        state = cut_lineage(_exchange(state, "b", F.col("n_blocks"), width, fanout, lambda at: (F.col("g"), at)), "manifest-round")
        width *= fanout
    state, width = state.withColumn("subroot", F.col("digest")), 1
    while width < (n_groups or 0):
        state = cut_lineage(_exchange(state, "g", F.lit(n_groups), width, fanout, lambda at: (at, F.lit(0))), "manifest-round")
        width *= fanout

    def prove(batches):
        tx.forget()
        out = []
        for _, (tag, at, n, names, keys, leaves, others, subroots, tops, paths) in _whole(batches):
            above = [(p["left"], p["right"]) for p in paths[0]]
            upper = "".join(a + b for a, b in above)
            at, n, names, keys, leaves, others = (c[1:] for c in (at, n, names, keys, leaves, others))
            levels_ = subtree(leaves, fanout, levels if n[0] > block else None)[:-1]
            sides = []
            for nodes in levels_:
                runs = [i - i % fanout for i in range(len(nodes))]
                sides.append([("".join(nodes[r:i]), "".join(nodes[i + 1 : r + fanout])) for i, r in enumerate(runs)])
            for i, own_leaf in enumerate(leaves):
                steps, place = [], i
                for side in sides:
                    steps.append(side[place])
                    place //= fanout
                folded = others[i] or own_leaf
                for left, right in steps:
                    folded = _hash(left + folded + right)
                for left, right in above:
                    folded = _hash(left + folded + right)
                digest = _hash("".join(a + b for a, b in steps) + upper)
                row = (keys[i], names[i][1:] if names[i] else None, at[i], own_leaf, subroots[0], tops[0], digest, folded, folded == tops[0])
                out.append((*row, [{"left": a, "right": b} for a, b in [*steps, *above]]) if proofs else row)
            if len(out) >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names_out)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names_out)

    schema = f"{key} bigint, {group} string, position bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    kinds = [pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 5, pa.bool_()]
    if proofs:
        schema += ", proof array<struct<left:string,right:string>>"
        kinds.append(pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))
    names_out = [f.split()[0] for f in schema.split(", ")]
    tagged = rows.select("g", "b", F.lit(1).alias("tag"), "at", "n_leaves", "name", "key", "leaf", "other")
    met = tagged.unionByName(state.select("g", "b", F.lit(0).alias("tag"), "subroot", F.col("digest").alias("top"), "path"), allowMissingColumns=True)
    met = met.repartition(parts, "g", "b").sortWithinPartitions("g", "b", "tag", "at")  # the partition's proof comes before its leaves
    return met.mapInArrow(prove, schema)
