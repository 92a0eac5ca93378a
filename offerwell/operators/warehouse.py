"""Dimensions, facts and marts of the listing and offer warehouses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwell.functions.numbers import exact_mean, half_up
from offerwell.operators.joins import category_map, similar_prices, star_lookup
from offerwell.operators.ordered import attach_one, number_rows
from offerwell.operators.windows import price_history
from offerwell.session import cut_lineage


def build_dim(df: DataFrame, natural_key: Sequence[str], key: str, attrs: dict[str, Column] | None = None) -> DataFrame:
    """One row per natural key with a dense surrogate key in md5 order of the natural key.

    Attributes take their smallest value per key.
    """
    aggs = [F.min(c).alias(n) for n, c in (attrs or {}).items()]
    rows = df.groupBy(*natural_key).agg(*aggs) if aggs else df.select(*natural_key).distinct()
    digest = F.unhex(F.md5(F.concat_ws("|", *natural_key).cast("binary")))  # the order of the hex digits in half the bytes
    rows = rows.withColumn("_digest", digest)
    return number_rows(rows, ["_digest", *natural_key], key, drop=["_digest"])


def hashed_dim(df: DataFrame, natural_key: Sequence[str], key: str) -> DataFrame:
    """Same with a 64-bit hash as the surrogate key: no numbering pass at all, for very large dimensions."""
    return df.select(*natural_key).distinct().withColumn(key, F.xxhash64(*natural_key))


def _date_parts(day: Column) -> dict[str, Column]:
    return {
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "year": F.year(day),
        "day_of_week": F.weekday(day) + 1,
        "quarter": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
    }


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def build_date_dim(df: DataFrame, col: str) -> DataFrame:
    """Every day between the first and the last date of the column."""
    span = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    days = span.select(F.explode(F.sequence(F.col("_lo"), F.col("_hi"))).alias("full_date"))
    day = F.col("full_date")
    return days.select(date_key(day).alias("date_id"), "full_date", *[c.alias(n) for n, c in _date_parts(day).items()])


def build_hour_dim(df: DataFrame, ts: str) -> DataFrame:
    """Every hour seen in the column with its six-hour window and market session."""
    hours = df.select(F.date_trunc("hour", F.col(ts)).alias("_h")).distinct()
    h, hour = F.col("_h"), F.hour("_h")
    start = F.floor(hour / 6) * 6
    window = F.format_string("%02d-%02d", start, start + 6)
    session = F.when(hour < 9, "pre").when(hour < 18, "open").otherwise("post")
    return hours.select(
        (date_key(F.to_date(h)).cast("bigint") * 100 + hour).alias("hour_id"),
        hour.alias("hour"),
        F.dayofmonth(h).alias("day"),
        F.month(h).alias("month"),
        F.year(h).alias("year"),
        window.alias("time_window"),
        session.alias("market_session"),
    )


def snowflake(df: DataFrame) -> dict[str, DataFrame]:
    """Normalised dimensions: category > super category, location > region > country, seller > source,
    product > currency. Needs ``category, location, region, country, seller, source, link, title, currency``.

    The rows are read twice: for the products, and for the distinct combinations of all other keys, which are written once.
    """
    supers = category_map(df.sparkSession).withColumnRenamed("group_label", "super_category")
    small = ("category", "location", "region", "country", "seller", "source", "currency")
    keys = cut_lineage(df.select(*small).distinct(), "natural-keys")
    mapped = keys.join(F.broadcast(supers), "category", "left").withColumn(
        "super_category", F.coalesce("super_category", F.lit("Other"))
    )
    out = {
        "super_category": build_dim(mapped, ["super_category"], "super_category_id"),
        "country": build_dim(keys, ["country"], "country_id"),
        "source": build_dim(keys, ["source"], "source_id"),
        "currency": build_dim(keys, ["currency"], "currency_id"),
    }

    def child(rows, natural, key, parent, parent_natural, parent_key):
        dim = build_dim(rows, [natural, parent_natural], key)
        return star_lookup(dim, {parent: (out[parent], [parent_natural], parent_key)}).drop(parent_natural)

    out["category"] = child(mapped, "category", "category_id", "super_category", "super_category", "super_category_id")
    out["region"] = child(keys, "region", "region_id", "country", "country", "country_id")
    places = star_lookup(keys.select("location", "region").distinct(), {"r": (out["region"], ["region"], "region_id")})
    out["location"] = build_dim(places, ["location"], "location_id", {"region_id": F.col("region_id")})
    out["seller"] = child(keys, "seller", "seller_id", "source", "source", "source_id")
    products = build_dim(df, ["link"], "product_id", {"title": F.col("title"), "currency": F.col("currency")})
    out["product"] = star_lookup(products, {"c": (out["currency"], ["currency"], "currency_id")}).drop("currency")
    return out


def star_dims(df: DataFrame) -> dict[str, tuple[DataFrame, list[str], str]]:
    """Flat dimensions of the listing star as (dimension, natural key, surrogate key).

    ``df`` is read twice, for the products and for the distinct combinations of the other keys; every dimension is written once,
    however often it is looked up.
    """
    flat = ("source", "seller", "category", "location")
    keys = cut_lineage(df.select(*flat).distinct(), "natural-keys")
    dims = {"product": build_dim(df, ["link"], "product_id", {"title": F.col("title_clean")})}
    dims |= {n: build_dim(keys, [n], f"{n}_id") for n in flat}
    return {n: (cut_lineage(d, f"dim-{n}"), ["link"] if n == "product" else [n], f"{n}_id") for n, d in dims.items()}


def load_fact_listing(df: DataFrame, dims: dict, day: str = "day") -> DataFrame:
    # Products come last: the shuffle by link carries the other keys as numbers.
    rows = star_lookup(df, dict(sorted(dims.items(), key=lambda d: d[0] == "product")))
    return rows.select(
        *[key for _, _, key in dims.values()],
        date_key(F.col(day)).alias("date_id"),
        "price_initial",
        "price_offre",
        "discount_pct",
        "rating",
        F.col("offre_type").alias("offer_type"),
    )


def load_price_snapshots(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Last price of each product, source and day with the percent change from the previous day seen."""
    daily = df.groupBy("product_id", "source", "day").agg(F.max_by("price", F.struct(*order)).alias("price"))
    return price_history(daily).withColumn("date_id", date_key(F.col("day")))


def load_offer_events(df: DataFrame, day: str = "day") -> DataFrame:
    """Listings with an offer type and the amount saved."""
    saved = F.coalesce(half_up(F.col("price_initial_mad") - F.col("price_offre_mad")), F.lit(0.0))
    return df.where("offre_type <> ''").select(
        "id", date_key(F.col(day)).alias("date_id"), "offre_type", "discount_pct", saved.alias("estimated_savings")
    )


def market_gap(offers: DataFrame, products: DataFrame) -> DataFrame:
    """Proposed price against the mean price of similar products, in percent, and the offer's total value."""
    market = similar_prices(products).select("product_id", F.col("similar_price").alias("market_price"))
    rows = offers.join(market, "product_id")
    gap = F.try_divide(F.col("price_proposed") - F.col("market_price"), F.col("market_price")) * 100.0
    return rows.withColumns({"gap_pct": gap, "total_value": F.col("price_proposed") * F.col("quantity")})


def offer_kpis(offers: DataFrame, tx: DataFrame, negotiations: DataFrame) -> DataFrame:
    """One row of priority metrics.

    ``offers`` carries ``status, gap_pct, total_value, is_suspect``; ``tx`` has ``offer_id, done``;
    ``negotiations`` has ``rounds``.
    """
    # The join shuffles every offer: it carries what the metrics add up and no texts.
    narrow = offers.select(
        "offer_id",
        "created",
        "gap_pct",
        (F.col("status") == "VALIDEE").alias("accepted"),
        "is_suspect",
        F.when(F.col("status") == "EN_ATTENTE", F.col("total_value")).alias("open_value"),
    )
    rows = narrow.join(tx.select("offer_id", "done"), "offer_id", "left")
    one = rows.agg(
        F.count("*").alias("offers"),
        half_up(F.count_if("accepted") / F.count("*"), 4).alias("acceptance_rate"),
        half_up(F.avg(F.datediff("done", "created")), 4).alias("avg_days_to_deal"),
        half_up(F.avg("gap_pct"), 4).alias("avg_gap_pct"),
        F.count_if("is_suspect").alias("suspended"),
        half_up(F.sum("open_value")).alias("open_value"),
        half_up(F.count("done") / F.count("*"), 4).alias("conversion_rate"),
    )
    return attach_one(one, negotiations.agg(half_up(F.avg("rounds"), 4).alias("avg_rounds")))


def agent_mart(offers: DataFrame, key: str = "seller_id") -> DataFrame:
    """Volume, negotiated against initial price, suspension rate and savings per agent."""
    deal = F.col("status") == "VALIDEE"
    return offers.groupBy(key).agg(
        F.count_if(deal).alias("deals"),
        half_up(exact_mean(F.when(deal, F.col("price_proposed")))).alias("avg_negotiated"),
        half_up(exact_mean(F.when(deal, F.col("price")))).alias("avg_initial"),
        half_up(F.count_if("is_suspect") / F.count("*"), 4).alias("suspension_rate"),
        half_up(F.sum(F.when(deal, F.greatest(F.col("price") - F.col("price_proposed"), F.lit(0.0))))).alias("savings"),
    )


def supervisor_mart(scores: DataFrame, alerts: DataFrame, flows: DataFrame, key: str = "seller_id") -> DataFrame:
    """Trust, alerts and suspicious content per seller; each side is reduced before it is joined."""
    trust = scores.groupBy(key).agg(half_up(exact_mean(F.col("score")), 4).alias("avg_trust"))
    open_ = F.col("alert_open")
    alarm = alerts.groupBy(key).agg(F.count_if(open_).alias("alerts_open"), F.count_if(~open_).alias("alerts_closed"))
    flow = flows.groupBy(key).agg(F.count_if("suspicious").alias("suspicious_items"))
    rows = trust.join(alarm, key, "full_outer").join(flow, key, "full_outer")
    return rows.fillna(0, ["alerts_open", "alerts_closed", "suspicious_items"])


def content_mart(flows: DataFrame) -> DataFrame:
    """Items, flagged share and mean sentiment by source and language, with subtotals per source."""
    return flows.rollup("source", "lang").agg(
        F.count("*").alias("items"),
        half_up(F.count_if("flagged") / F.count("*"), 4).alias("flagged_share"),
        half_up(F.avg("sentiment"), 4).alias("avg_sentiment"),
    )


def campaigns(flows: DataFrame, window: str = "1 day", at_least: int = 3, key: str = "entity") -> DataFrame:
    """Entities with many flagged items inside one time window."""
    hits = flows.where("flagged").groupBy(key, F.window("ts", window).alias("w")).agg(F.count("*").alias("flagged_items"))
    return hits.where(F.col("flagged_items") >= at_least).select(
        key, F.col("w.start").alias("window_start"), "flagged_items"
    )


def rank_risk(
    scores: DataFrame,
    weights: tuple[float, float, float] = (0.5, 0.3, 0.2),
    threshold: float = 0.5,
    levels: tuple[float, float] = (0.4, 0.7),
) -> DataFrame:
    """Final trust score from veracity, sentiment and (inverted) anomaly, risk level and alert flag."""
    final = (
        F.col("veracity") * weights[0] + F.col("sentiment") * weights[1] + (1.0 - F.col("anomaly")) * weights[2]
    )
    rows = scores.withColumn("final_score", half_up(final, 4))
    s = F.col("final_score")
    return rows.withColumns(
        {
            "risk": F.when(s < levels[0], "HIGH").when(s < levels[1], "MEDIUM").otherwise("LOW"),
            "alert": s < threshold,
        }
    )


def cube_sales(df: DataFrame, by: Sequence[str], amount: str) -> DataFrame:
    """Sub-totals over every combination of the grouping columns."""
    return df.cube(*by).agg(
        F.grouping_id().alias("level"), F.count("*").alias("n"), half_up(F.sum(amount)).alias("amount")
    )
