"""Filters, quality rules and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.functions.numbers import clip
from offerwell.operators.dedup import keep_first

PRICES = ["price_initial", "price_offre", "price_initial_mad", "price_offre_mad"]
DEDUP_KEYS = ["title_clean", "price_offre", "source"]


def drop_untitled(df: DataFrame, col: str = "title_clean") -> DataFrame:
    return df.where(F.length(col) > 0)


def drop_unpriced(df: DataFrame, cols: Sequence[str] = PRICES) -> DataFrame:
    return df.where(F.coalesce(*[F.col(c) for c in cols]).isNotNull())


def cap_prices(df: DataFrame, low: float = 0.0, high: float = 1e6, cols: Sequence[str] = PRICES) -> DataFrame:
    """Out-of-range prices become missing; the row stays."""
    return df.withColumns({c: F.when(F.col(c).between(low, high), F.col(c)) for c in cols})


def clip_discount(df: DataFrame, low: float = 0.0, high: float = 99.0, col: str = "discount_pct") -> DataFrame:
    return df.withColumn(col, clip(F.col(col), low, high))


def search(df: DataFrame, text: str, cols: Sequence[str]) -> DataFrame:
    """Case-insensitive substring in any of the columns."""
    found = F.lit(False)
    for c in cols:
        found = found | F.coalesce(F.lower(F.col(c)).contains(text.lower()), F.lit(False))
    return df.where(found)


def by_source(df: DataFrame, source: str) -> DataFrame:
    """``all`` or sources whose name contains the text."""
    return df if source == "all" else df.where(F.lower("source").contains(source.lower()))


def by_price_state(df: DataFrame, state: str, price: str = "price_offre", offer_type: str = "offre_type") -> DataFrame:
    """Rows with a stated price, without one, or with an offer."""
    stated = F.coalesce(F.col(price).cast("string"), F.lit(""))
    missing = stated.isin("", "Prix non indiqué")
    if state == "offer":
        return df.where(F.coalesce(F.col(offer_type), F.lit("")) != "")
    return df.where(missing if state == "unstated" else ~missing)


def offer_rows(df: DataFrame) -> DataFrame:
    """Rows with a discount and a known offer type."""
    return df.where(F.col("discount_pct").isNotNull() & F.col("offre_type").isin("pourcentage", "forfaite"))


def clean_rows(df: DataFrame) -> DataFrame:
    """All rules up to the duplicate drop."""
    return clip_discount(cap_prices(drop_unpriced(drop_untitled(df))))


def apply_quality_rules(df: DataFrame, order: Sequence[str], keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Clean rows with duplicates removed, ready for the unified table."""
    return keep_first(clean_rows(df), keys, order).withColumn("is_duplicate", F.lit(False))


def qa_report(df: DataFrame, order: Sequence[str], keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Per source: raw, kept, dropped, single price, discount and duplicate rows (full outer over sources)."""
    raw = df.groupBy("source").agg(F.count("*").alias("raw_rows"))
    clean = clean_rows(df).groupBy("source").agg(F.count("*").alias("clean_rows"))
    kept = (
        apply_quality_rules(df, order, keys)
        .groupBy("source")
        .agg(
            F.count("*").alias("kept"),
            F.count_if(F.col("price_offre").isNull()).alias("no_offer_price"),
            F.count("discount_pct").alias("with_discount"),
        )
    )
    joined = raw.join(clean, "source", "full_outer").join(kept, "source", "full_outer").fillna(0)
    return joined.select(
        "source",
        "raw_rows",
        "kept",
        (F.col("raw_rows") - F.col("kept")).alias("dropped"),
        "no_offer_price",
        "with_discount",
        (F.col("clean_rows") - F.col("kept")).alias("duplicates"),
    )


def check_lifecycle(history: DataFrame, allowed: DataFrame, key: str = "offer_id") -> DataFrame:
    """Status moves that the allowed-moves table does not list.

    ``history`` has one row per (offer, status change); a repeated status is no move. Each step names its
    predecessor by ``seq``, so the previous status comes from an equi-join and no task sorts a whole history.
    """
    before = history.select(F.col(key), (F.col("seq") + 1).alias("seq"), F.col("status").alias("from_status"))
    moves = history.join(before, [key, "seq"]).where("status <> from_status")
    return moves.withColumnRenamed("status", "to_status").join(allowed, ["from_status", "to_status"], "left_anti")
