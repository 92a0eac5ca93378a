"""Merkle audit of web archive replicas.

The records of an archive are numbered slots, ``FAN ** FILE_LEVELS`` to a file. A leaf hashes a slot's records with the offset range they take in
their file; every node above hashes the ordered digests and the range of its ``FAN`` children, through the files up to one
root. Two replicas are equal when their roots are. Otherwise the audit goes down level by level and reads only children of nodes that differ, until
it has the slots that do, and says what happened to them.

Only digests and lengths are shuffled, never record bodies; a group holds at most ``FAN`` nodes or the slots of one file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwell.session import cut_lineage

FAN = 16
FILE_LEVELS = 2
SLOTS = FAN**FILE_LEVELS


def warc_record(key: Column, url: Column, body: Column) -> Column:
    """A WARC response record as text; null url and body are empty."""
    body, url = F.coalesce(body, F.lit("")), F.coalesce(url, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), key.cast("string"),
        F.lit(">\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def leaves(records: DataFrame, key: str = "page_id", record: str = "record") -> DataFrame:
    """(slot, file, first, length, content, digest) of every slot of an archive.

    ``first`` is the offset in the file, ``content`` the SHA-256 of the slot's records, ``digest`` that of range and content. Several
    records of one number share its slot, ordered by their hash. Records without a number or body are in no file.
    """
    hashed = records.where(F.col(key).isNotNull() & F.col(record).isNotNull()).select(
        F.col(key).cast("bigint").alias("slot"), F.octet_length(record).cast("bigint").alias("n"), F.sha2(F.col(record).cast("binary"), 256).alias("h")
    )
    # Equal records are counted before they meet, so a number that is repeated without end stays small.
    hashed = hashed.groupBy("slot", "h", "n").agg(F.count("*").alias("times"))
    same = F.array_sort(F.collect_list(F.struct("h", "times")))
    slots = hashed.groupBy("slot").agg(F.sum(F.col("n") * F.col("times")).alias("length"), same.alias("all"))
    only = F.when((F.size("all") == 1) & (F.col("all")[0]["times"] == 1), F.col("all")[0]["h"])
    slots = slots.withColumn("content", F.coalesce(only, F.sha2(F.to_json("all"), 256)))
    slots = slots.withColumn("file", F.floor(F.col("slot") / SLOTS).cast("bigint"))
    before = Window.partitionBy("file").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # at most SLOTS rows
    slots = slots.withColumn("first", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint"))
    digest = F.sha2(F.concat_ws(":", "first", "length", "content"), 256)
    return slots.select("slot", "file", "first", "length", "content", digest.alias("digest"))


def _above(level: DataFrame) -> DataFrame:
    """Parents of (node, digest, first, end) rows."""
    children = F.array_sort(F.collect_list(F.struct("node", "digest", "first", "end")))
    up = level.groupBy(F.floor(F.col("node") / FAN).cast("bigint").alias("node")).agg(children.alias("c"))
    names = F.transform("c", lambda x: F.concat_ws(":", x["node"], x["digest"], x["first"], x["end"]))
    return up.select("node", F.sha2(F.array_join(names, "\n"), 256).alias("digest"), F.array_min("c.first").alias("first"), F.array_max("c.end").alias("end"))


def tree(slots: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes (node, digest, first, end) of every level, leaves first; written level by level."""
    level = slots.select(F.col("slot").alias("node"), "digest", "first", (F.col("first") + F.col("length")).alias("end"))
    out = [level]
    for _ in range(levels):
        level = cut_lineage(_above(level), "tree")
        out.append(level)
    return out


def _height(*archives: DataFrame) -> int:
    """Levels above the leaves until one node is left; ids below 0 have a tree of their own beside the others."""
    height = FILE_LEVELS
    for slots in archives:
        low, high = slots.agg(F.min("slot"), F.max("slot")).first()
        for edge in (x for x in (low, high) if x is not None):
            n = 0
            while edge not in (0, -1):
                edge, n = edge // FAN, n + 1
            height = max(height, n)
    return height


def audit(primary: DataFrame, replica: DataFrame, key: str = "page_id", record: str = "record") -> DataFrame:
    """One row for each slot that differs between two archives of (key, record) rows.

    Columns: key, file, status (changed: other content; moved: same content at another offset; missing: not in the replica;
    extra: only there), and offset, length and sha256 on both sides. Equal archives, and two empty ones, give no rows. Other columns are not
    read.
    """
    a, b = (cut_lineage(leaves(x, key, record), "leaves") for x in (primary, replica))
    height = _height(a, b)
    trees = [tree(x, height) for x in (a, b)]
    differ = None
    for level in range(height, -1, -1):
        sides = []
        for nodes, name in zip((t[level] for t in trees), ("x", "y")):
            nodes = nodes.select("node", F.col("digest").alias(name))
            if differ is not None:  # only below nodes that differ
                parents = differ.select(F.col("node").alias("parent"))
                nodes = nodes.withColumn("parent", F.floor(F.col("node") / FAN).cast("bigint")).join(parents, "parent", "left_semi")
            sides.append(nodes.select("node", name))
        differ = sides[0].join(sides[1], "node", "full_outer").where("NOT (x <=> y)").select("node")
        differ = cut_lineage(differ, "differ")
    found = differ.withColumnRenamed("node", "slot")
    for name, slots in (("a", a), ("b", b)):
        part = slots.select("slot", F.col("first").alias(f"offset_{name}"), F.col("length").alias(f"length_{name}"), F.col("content").alias(f"sha256_{name}"))
        found = found.join(part, "slot", "left")
    status = (
        F.when(F.col("sha256_b").isNull(), "missing").when(F.col("sha256_a").isNull(), "extra")
        .when(F.col("sha256_a") != F.col("sha256_b"), "changed").otherwise("moved")
    )
    sides = [f"{c}_{s}" for s in ("a", "b") for c in ("offset", "length", "sha256")]
    return found.select(F.col("slot").alias(key), F.floor(F.col("slot") / SLOTS).cast("bigint").alias("file"), status.alias("status"), *sides)
