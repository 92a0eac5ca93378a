"""Discount formulas, generated offers, price suggestion, anomaly checks and settlement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwell import constants as K
from offerwell.functions.numbers import clip, half_up
from offerwell.functions.offers import category_factor
from offerwell.functions.text import short_label
from offerwell.operators.joins import PARAM_NAMES, similar_prices, source_params
from offerwell.operators.ordered import number_rows
from offerwell.operators.windows import allocate_stock, sample_per_group
from offerwell.session import cut_lineage


def _positive(c: Column, default: float) -> Column:
    """The value when present and positive, else the default."""
    return F.when(c > 0, c).otherwise(F.lit(default))


def _factor(source: Column, category: Column) -> Column:
    """Category factor; the digital game store has none."""
    return F.when(F.lower(source).contains("steam"), F.lit(1.0)).otherwise(category_factor(category))


def source_discount(df: DataFrame, price: str = "price", rating: str = "rating", out: str = "discount") -> DataFrame:
    """Per-source discount percent; a rating above the target lowers it."""
    p, r = _positive(F.col(price), 1.0), _positive(F.col(rating), 3.5)
    raw = (
        F.col("base")
        + F.col("alpha") * F.log10(p + 1.0)
        + F.col("beta") * (F.col("tau") - r)
        + F.col("delta") / (p + F.col("kappa"))
    )
    value = clip(raw * _factor(F.col("source"), F.col("category")), F.col("low"), F.col("high"))
    return source_params(df).withColumn(out, value).drop(*PARAM_NAMES)


def master_discount(df: DataFrame, price: str = "price", rating: str = "rating", out: str = "discount") -> DataFrame:
    """Unified form of the source formulas: a rating above the target changes nothing."""
    p, r = _positive(F.col(price), 1.0), _positive(F.col(rating), 3.5)
    raw = (
        F.col("base")
        + F.col("alpha") * F.log10(p + 1.0)
        + F.col("beta") * F.greatest(F.col("tau") - r, F.lit(0.0))
        + F.col("delta") / (p + F.col("kappa"))
    )
    value = clip(raw * _factor(F.col("source"), F.col("category")), F.col("low"), F.col("high"))
    return source_params(df).withColumn(out, value).drop(*PARAM_NAMES)


def universal_discount(price: Column, rating: Column, category: Column) -> Column:
    """One formula for every source, 8 to 60 percent."""
    p, r = _positive(price, 1.0), _positive(rating, 3.5)
    raw = 10.0 + 4.0 * F.log10(p + 1.0) + 3.0 * F.greatest(4.5 - r, F.lit(0.0)) + 250.0 / (p + 10.0)
    return clip(raw * category_factor(category), 8.0, 60.0)


def simple_discount(price: Column, rating: Column) -> Column:
    """Price and rating only, 5 to 50 percent; missing rating counts as 2.5, missing price gives no discount."""
    raw = 10.0 + 5.0 * F.log10(price + 1.0) + 3.0 * (5.0 - F.coalesce(rating, F.lit(2.5)))
    return clip(raw, 5.0, 50.0)


def simple_offer(price: Column, rating: Column) -> Column:
    """``simple_discount`` as an offer in whole percent."""
    pct = half_up(simple_discount(price, rating), 0).cast("int")
    return F.when(
        pct.isNotNull(),
        F.struct(F.lit("pourcentage").alias("type_offre"), F.concat(pct.cast("string"), F.lit("%")).alias("valeur_offre")),
    )


def generate_offers(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """Offer report for up to ``n`` priced listings per source."""
    priced = df.withColumn("price", F.coalesce("price_initial", "price_offre")).where(F.col("price").isNotNull())
    rows = source_discount(sample_per_group(priced, ["source"], n, key))
    return rows.select(
        *key,
        "source",
        "category",
        short_label(F.col("title_clean"), 50, "...", keep=50).alias("product"),
        half_up(F.col("price")).alias("price"),
        F.col("rating"),
        half_up(F.col("discount"), 0).alias("offer_pct"),
        half_up(F.col("price") * (1.0 - F.col("discount") / 100.0)).alias("offer_price"),
    )


def suggest_price(products: DataFrame) -> DataFrame:
    """Suggested price from the formula, the floor price and the other products of the category.

    Needs ``price``, ``price_min``, ``category`` and ``rating``.
    """
    rows = similar_prices(products)
    p, floor_price = F.col("price"), F.col("price_min")
    cf = category_factor(F.col("category"), K.SUGGEST_HIGH_VALUE_WORDS, K.SUGGEST_ACCESSORY_WORDS)
    r = _positive(F.col("rating"), 3.5)
    rows = rows.withColumn("cf", cf)
    rows = rows.withColumn("_d", clip((10.0 + 4.0 * F.log10(p + 1.0) + 3.0 * (4.5 - r)) * F.col("cf"), 5.0, 50.0))
    rows = rows.withColumns(
        {
            "_base": F.greatest(floor_price, p * (1.0 - F.col("_d") / 100.0)),
            "_market": F.when(F.col("similar_count") > 0, F.try_divide(F.col("similar_price"), p)).otherwise(1.0),
        }
    )
    moved = F.col("_base") * F.when(F.col("_market") < 0.9, 0.95).when(F.col("_market") > 1.1, 1.03).otherwise(1.0)
    suggested = F.when(F.col("similar_count") > 0, F.greatest(floor_price, moved)).otherwise(F.col("_base"))
    return rows.withColumns(
        {
            "suggested_price": half_up(suggested),
            "discount": half_up(F.col("_d"), 1),
            "market_factor": half_up(F.col("_market")),
        }
    ).drop("_d", "_base", "_market", "similar_price", "similar_count")


def anomaly_columns(offer: Column, price: Column, threshold: float = 0.30) -> dict[str, Column]:
    """Suspect flag, ratio and reason; the first rule that holds wins."""
    ratio = F.when(price > 0, F.try_divide(F.abs(price - offer), price)).otherwise(0.0)
    reason = (
        F.when(
            ratio > threshold,
            F.concat(
                F.lit("Price deviation of "), F.floor(ratio * 100.0 + 0.5).cast("string"), F.lit("% exceeds threshold")
            ),
        )
        .when(offer <= 0, F.lit("Price is zero or negative"))
        .when(offer > price * 2.0, F.lit("Price is more than double the base price (unlikely luxury markup)"))
        .when(offer < price * 0.1, F.lit("Price is less than 10% of base price (suspiciously low)"))
        .otherwise(F.lit("None"))
    )
    return {"is_suspect": reason != "None", "anomaly_ratio": half_up(ratio), "reason": reason}


def flag_anomalies(offers: DataFrame, threshold: float = 0.30) -> DataFrame:
    """Offers (``price_proposed`` against the product ``price``) with the anomaly columns."""
    return offers.withColumns(anomaly_columns(F.col("price_proposed"), F.col("price"), threshold))


def safe_alternatives(flagged: DataFrame) -> DataFrame:
    """Three safer prices for every suspect offer, one row each."""
    prices = F.array(*[half_up(F.col("price") * k) for k in (0.85, 0.75, 0.60)])
    rows = flagged.where(F.col("is_suspect") & (F.col("price") > 0))
    return rows.select("*", F.posexplode(prices).alias("choice", "alternative"))


def accept_offers(offers: DataFrame) -> DataFrame:
    """Pending offers become valid; a final price of zero falls back to the proposed price."""
    pending = F.col("status") == "EN_ATTENTE"
    return offers.withColumns(
        {
            "status": F.when(pending, F.lit("VALIDEE")).otherwise(F.col("status")),
            "price_final": F.when(pending & (F.col("price_final") <= 0), F.col("price_proposed")).otherwise(
                F.col("price_final")
            ),
        }
    )


def settle_offers(offers: DataFrame, products: DataFrame, order: Sequence[str]) -> DataFrame:
    """Order and payment fields of every accepted offer that the stock can serve, first come first served.

    References carry a sequence number in md5 order of the offer id, so a rerun gives the same numbers and no task
    numbers the whole table.
    """
    valid = accept_offers(offers).where("status = 'VALIDEE'")
    paid = allocate_stock(valid, products, order, F.lit(1)).where("accepted")
    # Numbering reads its input twice, so the allocation is written once.
    keep = ["offer_id", "product_id", "buyer_id", "seller_id", "created", "price_final"]
    paid = cut_lineage(paid.select(keep), "paid")
    numbered = number_rows(paid.withColumn("_digest", F.md5(F.col("offer_id").cast("binary"))), ["_digest"], "_seq")
    number = F.format_string("%06d", F.col("_seq"))
    day = F.date_format("created", "yyyyMMdd")
    return numbered.select(
        "offer_id",
        "product_id",
        "buyer_id",
        "seller_id",
        F.concat_ws("-", F.lit("CMD"), day, number).alias("order_ref"),
        F.concat_ws("-", F.lit("PAY"), day, number).alias("payment_ref"),
        "price_final",
        F.lit("PAYEE").alias("order_status"),
        F.lit("CONFIRME").alias("payment_status"),
    )


def expire(orders: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Unpaid orders past their payment time become expired."""
    late = (F.col("status") == "EN_ATTENTE_PAIEMENT") & (
        F.col("created") + F.make_dt_interval(hours=F.lit(hours)) < as_of
    )
    return orders.withColumn("status", F.when(late, F.lit("EXPIREE")).otherwise(F.col("status")))
