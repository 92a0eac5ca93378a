"""Lookups, chains, interval and as-of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwell import constants as K
from offerwell.operators.dedup import keep_first
from offerwell.operators.ordered import null_safe_join, scan


def with_product(negotiations: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """Every negotiation with its product, if there is one."""
    return negotiations.join(products, key, "left")


def first_offer_per_product(products: DataFrame, offers: DataFrame, order) -> DataFrame:
    """Every product with its first offer, if there is one."""
    return products.join(keep_first(offers, ["product_id"], order), "product_id", "left")


def without_offer(products: DataFrame, offers: DataFrame, key: str = "product_id") -> DataFrame:
    return products.join(offers.select(key), key, "left_anti")


def with_offer(products: DataFrame, offers: DataFrame, key: str = "product_id") -> DataFrame:
    return products.join(offers.select(key), key, "left_semi")


def order_chain(offers: DataFrame, products: DataFrame, payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Offer, product, order and payment of every settled offer."""
    return (
        offers.join(products, "product_id").join(orders, "offer_id").join(payments, "order_ref")
    )


def orders_for(orders: DataFrame, who: DataFrame, key: str) -> DataFrame:
    """Orders of the buyers or sellers listed in ``who``."""
    return orders.join(who.select(key), key, "left_semi")


def messages_of(negotiations: DataFrame, messages: DataFrame) -> DataFrame:
    """Messages of the given negotiations in time order."""
    return messages.join(negotiations.select("negotiation"), "negotiation", "left_semi").orderBy("negotiation", "turn")


def category_map(spark: SparkSession) -> DataFrame:
    """Leaf category to group: a fixed table of a few dozen rows."""
    rows = [(g, c) for g, leaves in K.CATEGORY_GROUPS.items() for c in leaves]
    return spark.createDataFrame(rows, "group_label string, category string")


def category_groups(df: DataFrame) -> DataFrame:
    """Rows of the mapped categories with their group; the map is fixed, so it is broadcast."""
    return df.join(F.broadcast(category_map(df.sparkSession)), "category")


PARAM_NAMES = ["base", "alpha", "beta", "tau", "delta", "kappa", "low", "high"]


def source_key(source: Column) -> Column:
    """Name of the first priced source contained in the text."""
    low, out = F.lower(source), None
    for name in K.PRICING_PARAMS:
        found = low.contains(name.lower())
        out = F.when(found, F.lit(name)) if out is None else out.when(found, F.lit(name))
    return out


def source_params(df: DataFrame) -> DataFrame:
    """Pricing constants of the row's source; unknown sources get the default row.

    The constants are a fixed table of five rows and are broadcast.
    """
    rows = [(n, *v) for n, v in K.PRICING_PARAMS.items()]
    params = df.sparkSession.createDataFrame(rows, "_key string, " + ", ".join(f"{n} double" for n in PARAM_NAMES))
    joined = df.withColumn("_key", source_key(F.col("source"))).join(F.broadcast(params), "_key", "left").drop("_key")
    return joined.withColumns(
        {n: F.coalesce(F.col(n), F.lit(d)) for n, d in zip(PARAM_NAMES, K.DEFAULT_PARAMS)}
    )


def similar_prices(products: DataFrame, by: str = "category", price: str = "price") -> DataFrame:
    """Mean price and number of the other products of the category."""
    totals = products.groupBy(by).agg(F.sum(price).alias("_sum"), F.count(price).alias("_n"))
    rows = null_safe_join(products, totals, [by], "inner")
    others = F.col("_n") - F.when(F.col(price).isNotNull(), 1).otherwise(0)
    rest = F.col("_sum") - F.coalesce(F.col(price), F.lit(0.0))
    return rows.withColumns(
        {"similar_count": others, "similar_price": F.when(others > 0, F.try_divide(rest, others))}
    ).drop("_sum", "_n")


def offers_valid_at(events: DataFrame, offers: DataFrame, max_days: int = 7, key: str = "product_id") -> DataFrame:
    """Events inside ``[created, expires)`` of an offer of the same product.

    Offers last at most ``max_days``, so each covers at most two time buckets of that length; the join is an
    equi-join on (product, bucket) and the interval is only tested inside the bucket.
    """
    width = max_days * 86400

    def bucket(c: Column) -> Column:
        return F.floor(F.unix_timestamp(c) / F.lit(width))

    spread = offers.withColumn("_b", F.explode(F.sequence(bucket(F.col("created")), bucket(F.col("expires")))))
    at = events.withColumn("_b", bucket(F.col("ts")))
    return at.join(spread, [key, "_b"]).where("ts >= created AND ts < expires").drop("_b")


def score_as_of(offers: DataFrame, scores: DataFrame) -> DataFrame:
    """Latest score of the seller at or before each offer.

    Both frames have ``seller_id``, ``ts`` and ``event_id``; scores come first at equal times.
    """
    both = scores.select(
        "seller_id", "ts", "event_id", F.lit(0).alias("_offer"), F.col("score").alias("_score")
    ).unionByName(
        offers.select("seller_id", "ts", "event_id", F.lit(1).alias("_offer")), allowMissingColumns=True
    )
    rows = scan(both, ["seller_id"], ["ts", "_offer", "event_id"], last={"score_t0": F.col("_score")})
    return rows.where("_offer = 1").select("seller_id", "ts", "event_id", "score_t0")


def star_lookup(fact: DataFrame, dims: dict[str, tuple[DataFrame, list[str], str]]) -> DataFrame:
    """Replace natural keys by surrogate keys: ``dims`` maps a name to (dimension, natural key, surrogate column)."""
    out = fact
    for dim, natural, surrogate in dims.values():
        out = null_safe_join(out, dim.select(*natural, surrogate), natural, "left")
    return out
