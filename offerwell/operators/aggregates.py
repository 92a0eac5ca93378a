"""Dashboard and report aggregates: each is one pass with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwell.functions.numbers import clip, half_up, ratio_pct
from offerwell.operators.joins import category_groups
from offerwell.operators.ordered import attach_one, exact_quantiles, null_safe_join


def _shown_price() -> Column:
    return F.coalesce(F.nullif(F.col("price_offre_mad"), F.lit(0.0)), F.col("price_initial_mad"))


def _discount() -> Column:
    return F.when(F.col("discount_pct") > 0, F.col("discount_pct"))


def _sane_price() -> Column:
    p = _shown_price()
    return F.when((p > 0) & (p < 1e6), p)


def _mean(total: Column, n: Column, digits: int = 1) -> Column:
    return F.coalesce(half_up(F.try_divide(total, n), digits), F.lit(0.0))


def no_offer_rollup(df: DataFrame) -> DataFrame:
    """Rows without an offer by source and category, with subtotals and a grand total."""
    category = F.coalesce(F.nullif(F.trim("category"), F.lit("")), F.lit("Unknown"))
    rows = df.select("source", category.alias("category"), (F.col("offre_type") == "").alias("_none"))
    out = rows.rollup("source", "category").agg(
        F.grouping_id().alias("level"), F.count_if("_none").alias("no_offer"), F.count("*").alias("total")
    )
    return out.withColumn("pct", ratio_pct(F.col("no_offer"), F.col("total")))


def kpis(df: DataFrame) -> DataFrame:
    rating = F.when(F.col("rating") > 0, F.col("rating"))
    return df.agg(
        F.count("*").alias("products"),
        half_up(F.avg(_sane_price()), 0).alias("avg_price"),
        half_up(F.avg(_discount()), 1).alias("avg_discount"),
        half_up(F.avg(rating), 1).alias("avg_rating"),
    )


def by_platform(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count("*").alias("n"))


def price_by_category(df: DataFrame, n: int = 8) -> DataFrame:
    p = _shown_price()
    rows = df.where(p > 0).groupBy(F.coalesce("category", F.lit("Uncategorized")).alias("category"))
    return rows.agg(half_up(F.avg(p), 0).alias("avg_price")).orderBy(F.desc("avg_price"), "category").limit(n)


def _stats() -> list[Column]:
    return [
        F.count("*").alias("total"),
        F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"),
        F.count(_discount()).alias("with_offer"),
        F.sum(_discount()).alias("_disc"),
        F.max(_discount()).alias("_max"),
        F.sum(_sane_price()).alias("_price"),
        F.count(_sane_price()).alias("_priced"),
    ]


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "coverage": ratio_pct(F.col("with_offer"), F.col("total"), 0),
            "avg_discount": _mean(F.col("_disc"), F.col("with_offer")),
            "max_discount": F.coalesce(F.col("_max"), F.lit(0.0)),
            "avg_price": _mean(F.col("_price"), F.col("_priced"), 0),
        }
    ).drop("_disc", "_max", "_price", "_priced")


def category_stats(df: DataFrame) -> DataFrame:
    return _finish(df.groupBy(F.coalesce("category", F.lit("Other")).alias("category")).agg(*_stats()))


def category_tree(df: DataFrame) -> DataFrame:
    """Group rows (null category) and their categories in one result; groups without data drop out."""
    rows = category_groups(df)
    sets = [[F.col("group_label")], [F.col("group_label"), F.col("category")]]
    return _finish(rows.groupingSets(sets, "group_label", "category").agg(*_stats()))


def offer_depth(df: DataFrame, source: str = "all", n: int = 10) -> DataFrame:
    from offerwell.operators.quality import by_source

    rows = by_source(df, source).groupBy(F.coalesce("category", F.lit("Other")).alias("category"))
    out = rows.agg(
        F.count("*").alias("total"),
        F.count(_discount()).alias("with_offer"),
        F.sum(_discount()).alias("_disc"),
        F.coalesce(F.max(_discount()), F.lit(0.0)).alias("max_discount"),
    )
    out = out.withColumns(
        {
            "coverage": ratio_pct(F.col("with_offer"), F.col("total"), 0),
            "avg_discount": _mean(F.col("_disc"), F.col("with_offer")),
        }
    ).drop("_disc")
    return out.orderBy(F.desc("with_offer"), "category").limit(n)


def offer_mix(df: DataFrame) -> DataFrame:
    """Percent of percentage, flat and no offers per source."""
    kind = F.col("offre_type")
    out = df.groupBy(F.coalesce("source", F.lit("Unknown")).alias("source")).agg(
        F.count("*").alias("total"),
        F.count_if(kind == "pourcentage").alias("_p"),
        F.count_if(kind == "forfaite").alias("_f"),
    )
    n = F.col("total")
    return out.select(
        "source",
        ratio_pct(F.col("_p"), n).alias("pourcentage"),
        ratio_pct(F.col("_f"), n).alias("forfaite"),
        ratio_pct(n - F.col("_p") - F.col("_f"), n).alias("none"),
    )


def run_summary(df: DataFrame) -> DataFrame:
    """Per source and unified (null source): total, unique, discount, offer and duplicate rows."""
    return df.rollup("source").agg(
        F.count("*").alias("total"),
        F.count_if(~F.col("is_duplicate")).alias("unique_rows"),
        F.count("discount_pct").alias("with_discount"),
        F.count("price_offre").alias("with_offer"),
        F.count_if("is_duplicate").alias("duplicates"),
    )


def severity_counts(audits: DataFrame) -> DataFrame:
    return audits.groupBy("severity").agg(
        F.count("*").alias("n"), F.count_if(F.col("severity") == "CRITICAL").alias("critical")
    )


def cart_totals(items: DataFrame, cart: str = "cart_id") -> DataFrame:
    """Total price and item count per cart; a quantity is capped by the stock."""
    qty = F.least(F.col("quantity"), F.col("stock"))
    return items.groupBy(cart).agg(
        half_up(F.sum(F.col("price") * qty)).alias("total_price"), F.sum(qty).alias("item_count")
    )


def describe_col(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation and exact quartiles."""
    basic = df.groupBy(*by).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))
    q = exact_quantiles(df, by, col, [0.25, 0.5, 0.75])
    out = null_safe_join(basic, q, by, "inner")
    return out.select(
        *by,
        F.col("n").alias("count"),
        half_up(F.col("mean"), 4).alias("mean"),
        half_up(F.col("std"), 4).alias("std"),
        F.col("low").alias("min"),
        *[half_up(F.col(f"q{i}"), 4).alias(n) for i, n in enumerate(["p25", "p50", "p75"])],
        F.col("high").alias("max"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed, empty bins have 0 rows."""
    known = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("_x"))
    span = known.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    rows = attach_one(known, span)
    at = F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * float(bins))
    at = F.when(F.col("_hi") > F.col("_lo"), F.least(at, F.lit(bins - 1))).otherwise(F.lit(0))
    counts = rows.groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = attach_one(df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")), span)
    width = (F.col("_hi") - F.col("_lo")) / float(bins)
    return every.join(counts, "bin", "left").select(
        "bin",
        half_up(F.col("_lo") + F.col("bin") * width, 4).alias("bin_from"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and outlier count."""
    q = exact_quantiles(df, by, col, [0.25, 0.5, 0.75]).withColumn("_iqr", F.col("q2") - F.col("q0"))
    q = q.select(
        *by, "q0", "q1", "q2", (F.col("q0") - F.col("_iqr") * 1.5).alias("_lo"),
        (F.col("q2") + F.col("_iqr") * 1.5).alias("_hi"),
    )
    x = F.col(col)
    rows = null_safe_join(df.where(x.isNotNull()).select(*by, col), q, by, "inner")
    inside = x.between(F.col("_lo"), F.col("_hi"))
    return rows.groupBy(*by).agg(
        *[half_up(F.max(f"q{i}"), 4).alias(n) for i, n in enumerate(["q1", "median", "q3"])],
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def group_median(df: DataFrame, col: str, by: Sequence[str], out: str = "median") -> DataFrame:
    """Exact median of the group attached to every row."""
    q = exact_quantiles(df, by, col, [0.5]).select(*by, F.col("q0").alias(out))
    return null_safe_join(df, q, by, "left")


def formula_agreement(df: DataFrame, stored: str, tol: float = 1.0) -> DataFrame:
    """Stored percentages within ``tol`` points of the percentage computed from both prices."""
    p0, p1, s = F.col("price_initial"), F.col("price_offre"), F.col(stored)
    both = s.isNotNull() & (p0 > 0) & (p1 > 0)
    gap = F.abs(s - F.try_divide(p0 - p1, p0) * 100.0)
    return df.groupBy("source").agg(
        F.count(s).alias("with_offer"),
        F.count_if(both).alias("with_both_prices"),
        F.count_if(both & (gap <= tol)).alias("agreeing"),
    )


def mae_by(df: DataFrame, by: str, truth: str, pred: str) -> DataFrame:
    known = df.where(F.col(truth).isNotNull() & F.col(pred).isNotNull())
    out = known.groupBy(by).agg(half_up(F.avg(F.abs(F.col(truth) - F.col(pred))), 4).alias("mae"))
    return out.orderBy("mae", by)


#: Rank error of a quantile sketch with so many items a level, as a share of the rows (about 99 of 100 ranks are closer).
PROFILE_ITEMS, PROFILE_ERROR = 2048, 0.0027
#: Registers of a distinct sketch are 2 ** 12: a standard error of 1.6 %.
PROFILE_REGISTERS = 12


def profile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Mergeable profile of numeric columns per group: n, and for each column a distinct and a quantile sketch as binaries.

    The rows are small and are meant to be stored, say one set a day.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.hll_sketch_agg(F.col(c).cast("string"), PROFILE_REGISTERS).alias(f"{c}_distinct_sketch"),
            F.kll_sketch_agg_double(x, PROFILE_ITEMS).alias(f"{c}_quantile_sketch"),
        ]
    return df.groupBy(*by).agg(F.count("*").alias("n"), *aggs)


def merge_profiles(sketches: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Profiles of several sets of rows as one per group, without the rows."""
    aggs = []
    for c in cols:
        aggs += [
            F.hll_union_agg(f"{c}_distinct_sketch").alias(f"{c}_distinct_sketch"),
            F.kll_merge_agg_double(f"{c}_quantile_sketch", PROFILE_ITEMS).alias(f"{c}_quantile_sketch"),
        ]
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), *aggs)


def read_profiles(sketches: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Row count, approximate distinct counts and quartiles from stored sketches."""
    out = [*by, "n"]
    for c in cols:
        quartiles = [F.kll_sketch_get_quantile_double(f"{c}_quantile_sketch", F.lit(p)) for p in (0.25, 0.5, 0.75)]
        out += [F.hll_sketch_estimate(f"{c}_distinct_sketch").alias(f"{c}_distinct"), F.array(*quartiles).alias(f"{c}_quartiles")]
    return sketches.select(*out)


def approx_profile(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """Approximate distinct counts and quartiles for very large loads, in one pass."""
    return read_profiles(profile_sketches(df, cols, [by]), cols, [by])


def clipped_predictions(df: DataFrame, pred: str, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, clip(F.col(pred), 0.0, 99.0))
