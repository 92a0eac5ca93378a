"""Duplicate flags, first-row selection and set operations with an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerwell.operators.ordered import null_safe_join, scan


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the first in ``order``.

    The ``rank = 1`` filter lets Spark cut every key to one row per task before the shuffle, so a key that holds a
    large share of the table sends next to nothing.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def flag_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "is_duplicate") -> DataFrame:
    """True for all but the first row of a key; missing key parts count as equal.

    The first row is found by aggregation (one row per key and task before the shuffle) and joined back, because
    adaptive execution splits a hot join key where a window keeps it in one task. ``order`` must be a total order.
    """
    at = F.struct(*order)
    firsts = df.groupBy(*keys).agg(F.min(at).alias("_first"))
    return null_safe_join(df, firsts, keys, "inner").withColumn(out, at > F.col("_first")).drop("_first")


def drop_flagged(df: DataFrame, order: Sequence[str], key: str = "id", flag: str = "is_duplicate") -> DataFrame:
    """Drop flagged rows, then repeats of the id."""
    return keep_first(df.where(~F.col(flag)), [key], order)


def unseen(batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Batch rows whose key is not stored; rows without a key are not new."""
    return batch.where(F.col(key) != "").join(seen.select(key), key, "left_anti")


def merge_new(existing: DataFrame, batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Append the batch rows with a new key; inside the batch the first sighting wins."""
    fresh = keep_first(unseen(batch, existing, key), [key], order)
    return existing.unionByName(fresh, allowMissingColumns=True)


def tag_union(frames: dict[str, DataFrame], tag: str = "_src") -> DataFrame:
    """Stack frames, each tagged with its name; missing columns are null."""
    return union_all([df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def distinct_agent_offers(messages: DataFrame) -> DataFrame:
    """Distinct positive agent prices per negotiation, newest first (by their first sighting)."""
    prices = (
        messages.where((F.col("sender") == "AGENT") & (F.col("price") > 0))
        .groupBy("negotiation", "price")
        .agg(F.min("turn").alias("turn"))
    )
    # Counted from the first sighting on, so a long negotiation is not one task.
    rows = scan(prices, ["negotiation"], ["turn", "price"], sums={"_upto": F.lit(1)})
    total = prices.groupBy("negotiation").agg(F.count("*").alias("_all"))
    rows = null_safe_join(rows, total, ["negotiation"])
    return rows.withColumn("position", (F.col("_all") - F.col("_upto") + 1).cast("int")).drop("_upto", "_all")
