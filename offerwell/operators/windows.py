"""Histories, running scores, allocation, sampling and top-n per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwell.functions.numbers import clip, exact_mean, half_up
from offerwell.operators.ordered import attach_one, scan


def price_history(snapshots: DataFrame, keys=("product_id", "source"), order=("day",), price="price") -> DataFrame:
    """Previous price and percent change per product and source, in a total order."""
    rows = scan(snapshots, keys, order, previous={"previous_price": F.col(price)})
    change = F.try_divide(F.col(price) - F.col("previous_price"), F.col("previous_price")) * 100.0
    return rows.withColumn("pct_change", half_up(change))


def bid_rounds(bids: DataFrame, markup: float = 1.2, floor_share: float = 0.6) -> DataFrame:
    """Bids with round number, previous bid and the prices of their negotiation.

    The asking price is ``markup`` times the best bid and the floor a share of it.
    """
    keys, order = ["negotiation"], ["ts", "event_id"]
    ask = bids.groupBy("negotiation").agg(
        (F.max("bid") * markup).alias("current"), F.count("*").alias("rounds_max")
    )
    rows = scan(bids, keys, order, sums={"round": F.lit(1)}, previous={"previous_bid": F.col("bid")})
    return rows.join(ask, "negotiation").withColumn("floor_price", F.col("current") * floor_share)


def offer_trend(rounds: DataFrame) -> DataFrame:
    """Change from the previous bid relative to the asking price, clamped to [-1, 1]; 0 for a first bid."""
    step = F.try_divide(F.col("bid") - F.col("previous_bid"), F.col("current"))
    return rounds.withColumn("trend", F.coalesce(clip(step, -1.0, 1.0), F.lit(0.0)))


def cooperation_step(bid: Column, previous: Column, current: Column) -> Column:
    """Hundredths earned by one bid: 5 up, -2 flat (within 0.1 % of the price), -4 down."""
    delta, tol = bid - previous, current * 0.001
    return F.when(delta > tol, 5).when(F.abs(delta) <= tol, -2).when(delta.isNotNull(), -4).otherwise(0)


def cooperation_score(rounds: DataFrame) -> DataFrame:
    """Running cooperation score, clamped to +-0.15 after the sum."""
    step = cooperation_step(F.col("bid"), F.col("previous_bid"), F.col("current"))
    rows = scan(rounds, ["negotiation"], ["ts", "event_id"], sums={"_points": step})
    return rows.withColumn("cooperation", clip(F.col("_points") / 100.0, -0.15, 0.15)).drop("_points")


def stagnation_bonus(bids: DataFrame) -> DataFrame:
    """Length of the trailing run of bids within 0.01 of the last one, and its bonus, per negotiation.

    The run starts after the last bid that differs, so two aggregations find it without sorting a negotiation.
    """
    at = F.struct("ts", "event_id")
    last = bids.groupBy("negotiation").agg(F.max_by("bid", at).alias("last_bid"))
    rows = bids.join(last, "negotiation")
    differs = F.abs(F.col("bid") - F.col("last_bid")) >= 0.01
    breaks = rows.groupBy("negotiation").agg(F.max(F.when(differs, at)).alias("_break"))
    tail = rows.join(breaks, "negotiation").where(F.col("_break").isNull() | (at > F.col("_break")))
    run = tail.groupBy("negotiation", "last_bid").agg(F.count("*").alias("run_length"))
    bonus = F.when(F.col("run_length") >= 3, F.least(F.lit(0.20), (F.col("run_length") - 2) * 0.05)).otherwise(0.0)
    return run.withColumn("bonus", bonus)


def round_number(messages: DataFrame) -> DataFrame:
    """Round (buyer messages so far) and current price (last positive price) after each message."""
    bought = F.when(F.col("sender") == "ACHETEUR", 1).otherwise(0)
    price = F.when(F.col("price") > 0, F.col("price"))
    return scan(messages, ["negotiation"], ["turn"], sums={"round": bought}, last={"current_price": price})


def allocate_stock(orders: DataFrame, stock: DataFrame, order: Sequence[str], quantity: Column) -> DataFrame:
    """First come, first served: accepted while the running quantity fits the stock."""
    known = orders.where(F.col("product_id").isNotNull())
    rows = scan(known, ["product_id"], order, sums={"running_quantity": quantity})
    rows = rows.join(stock.select("product_id", "stock"), "product_id")
    return rows.withColumn("accepted", F.col("running_quantity") <= F.col("stock"))


def stock_after(allocated: DataFrame, quantity: Column) -> DataFrame:
    """Remaining stock and status per product after allocation."""
    used = F.coalesce(F.sum(F.when(F.col("accepted"), quantity)), F.lit(0))
    out = allocated.groupBy("product_id").agg(F.max("stock").alias("stock"), used.alias("sold"))
    left = F.col("stock") - F.col("sold")
    return out.withColumns(
        {"remaining": left, "product_status": F.when(left <= 0, "VENDU").otherwise("DISPONIBLE")}
    )


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Best ``n`` rows per group; the rank filter limits each task to ``n`` rows per group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("position", rank).where(F.col("position") <= n)


def sample_per_group(df: DataFrame, by: Sequence[str], n: int, key: Sequence[str]) -> DataFrame:
    """Up to ``n`` rows per group, chosen by the md5 of the row key so that reruns agree."""
    digest = F.md5(F.concat_ws("|", *key).cast("binary"))
    return top_n_per_group(df.withColumn("_digest", digest), by, [F.col("_digest")], n).drop("_digest", "position")


def days_since_first(df: DataFrame, date: str, out: str = "days_since_first") -> DataFrame:
    """Days since the earliest date of the table; 0 when missing."""
    rows = attach_one(df, df.agg(F.min(date).alias("_first")))
    return rows.withColumn(out, F.coalesce(F.datediff(F.col(date), F.col("_first")), F.lit(0))).drop("_first")


def moving_score(scores: DataFrame, key: str = "seller_id", days: int = 7) -> DataFrame:
    """Mean daily score and its moving average over the last ``days`` scored days.

    Rows are first reduced to one per (key, day), which bounds the window by the number of days.
    """
    daily = scores.groupBy(key, F.to_date("ts").alias("day")).agg(
        half_up(exact_mean(F.col("score")), 6).alias("_avg")
    )
    frame = Window.partitionBy(key).orderBy("day").rowsBetween(-(days - 1), 0)
    total = F.sum(F.col("_avg").cast("decimal(28,6)")).over(frame).cast("double")
    return daily.select(
        key,
        "day",
        half_up(F.col("_avg"), 4).alias("score"),
        half_up(total / F.count("_avg").over(frame), 4).alias("moving"),
    )


def share_of_total(df: DataFrame, by: str) -> DataFrame:
    """Rows per group and their share of all rows in percent."""
    counts = df.groupBy(by).agg(F.count("*").alias("n"))
    rows = attach_one(counts, counts.agg(F.sum("n").alias("_all")))
    return rows.select(by, "n", half_up(F.col("n") * 100.0 / F.col("_all")).alias("share"))
