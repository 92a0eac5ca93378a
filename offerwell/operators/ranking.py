"""Sorts and top-k reports with explicit tie breaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_deals(df: DataFrame, n: int = 10, ties: Sequence[str] = ("link",)) -> DataFrame:
    return df.where(F.col("discount_pct") > 0).orderBy(F.desc("discount_pct"), *ties).limit(n)


def sort_price(df: DataFrame, price: Column, ascending: bool = True, ties: Sequence[str] = ()) -> DataFrame:
    """Rows without a readable price come last in both directions."""
    return df.orderBy(price.asc_nulls_last() if ascending else price.desc_nulls_last(), *ties)


def sort_title_fr(df: DataFrame, title: str = "title") -> DataFrame:
    """French collation order."""
    return df.orderBy(F.collate(F.coalesce(F.col(title), F.lit("")), "fr"))


def sort_rating(df: DataFrame, rating: str = "rating", ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.coalesce(F.col(rating).try_cast("double"), F.lit(0.0)).desc(), *ties)


def latest_orders(orders: DataFrame, date: str = "order_date", ties: Sequence[str] = ()) -> DataFrame:
    return orders.orderBy(F.desc(date), *ties)


def leaderboard(metrics: DataFrame, n: int = 15) -> DataFrame:
    """Best models first: MAE, then RMSE, then R2."""
    return metrics.orderBy("mae", "rmse", F.desc("r2"), "model").limit(n)
