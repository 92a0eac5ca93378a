"""Ingest, quality, duplicate, set and report queries over the listing views."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerwell import constants as K
from offerwell.functions import offers as O
from offerwell.operators import aggregates as G
from offerwell.operators import dedup as E
from offerwell.operators import ingest, quality as D, ranking as I
from offerwell.session import cut_lineage
from offerwell.plans.registry import query, r2, r4
from offerwell.sources.views import LISTING_ORDER

ORDER = ", ".join(LISTING_ORDER)


def rnd(x: str, digits: int) -> str:
    scale = f"{float(10**digits):.1f}"
    return f"floor(({x})*{scale}+0.5)/{scale}"


def pct(part: str, whole: str, digits: int = 1) -> str:
    return f"coalesce({rnd(f'{part}*100.0/nullif({whole}, 0)', digits)}, 0.0)"


# --- ingest -------------------------------------------------------------------------------------------------------


@query(
    "tag_union",
    """SELECT 'catalogue' AS _src, p_name AS title, p_retailprice AS price, p_brand AS brand, NULL AS location FROM part
    UNION ALL SELECT 'shops', s_name, s_acctbal, NULL, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT 'orders', o_orderpriority, o_totalprice, NULL, NULL FROM orders""",
)
def _(t):
    shops = t.supplier.join(t.nation, F.expr("s_nationkey = n_nationkey"))
    return E.tag_union(
        {
            "catalogue": t.part.selectExpr("p_name AS title", "p_retailprice AS price", "p_brand AS brand"),
            "shops": shops.selectExpr("s_name AS title", "s_acctbal AS price", "n_name AS location"),
            "orders": t.orders.selectExpr("o_orderpriority AS title", "o_totalprice AS price"),
        }
    )


_FIRST = f"row_number() OVER (PARTITION BY link ORDER BY {ORDER})"


@query(
    "merge_new",
    f"""WITH stored AS (SELECT link, title, cents, day FROM (SELECT *, {_FIRST} AS rn FROM listings
      WHERE day < DATE '1998-01-01') WHERE rn = 1), fresh AS (SELECT link, title, cents, day FROM (
      SELECT *, {_FIRST} AS rn FROM listings WHERE day >= DATE '1998-01-01' AND link NOT IN (SELECT link FROM stored))
      WHERE rn = 1) SELECT link, title, cents, cast(day AS STRING) AS day FROM (SELECT * FROM stored UNION ALL
      SELECT * FROM fresh)""",
)
def _(t):
    cut = F.lit("1998-01-01").cast("date")
    stored = E.keep_first(t.listings.where(F.col("day") < cut), ["link"], LISTING_ORDER)
    merged = E.merge_new(stored, t.listings.where(F.col("day") >= cut), "link", LISTING_ORDER)
    return merged.select("link", "title", "cents", F.col("day").cast("string").alias("day"))


@query(
    "ingest_report",
    """SELECT count(*) AS total_rows, count(*) FILTER (offre_type = 'pourcentage') AS percentage,
    count(*) FILTER (offre_type = 'forfaite') AS flat, count(*) FILTER (offre_type = '') AS no_offer FROM listings""",
)
def _(t):
    offer = F.struct(F.col("offre_type").alias("type_offre"), F.col("cents").cast("string").alias("valeur_offre"))
    rows = t.listings.withColumn(
        "offre", F.when(F.col("offre_type") != "", F.array(offer)).otherwise(F.array().cast(O.OFFER_TYPE))
    )
    return ingest.ingest_report(rows)


@query("row_count", "SELECT count(*) AS total_rows, 17 AS total_columns FROM listings")
def _(t):
    return ingest.row_count(t.listings)


_COUNTED = ["category", "price_initial", "price_offre", "rating", "title", "link"]


@query(
    "completeness",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS present FROM listings" for c in _COUNTED),
)
def _(t):
    return ingest.completeness(t.listings.select(_COUNTED))


# --- quality ------------------------------------------------------------------------------------------------------

_BLANKED = "CASE WHEN linenumber = 6 THEN '' ELSE title_clean END"


def _blanked(t):
    """Unified rows where one line in seven lost its title and cheap rows lost their prices."""
    cheap = F.col("cents") < 500000
    rows = t.unified.withColumn(
        "title_clean", F.when(F.col("linenumber") == 6, F.lit("")).otherwise(F.col("title_clean"))
    )
    return rows.withColumns({c: F.when(~cheap, F.col(c)) for c in D.PRICES})


_BLANKED_SQL = (
    f"SELECT * EXCLUDE (title_clean, {', '.join(D.PRICES)}), {_BLANKED} AS title_clean, "
    + ", ".join(f"CASE WHEN cents >= 500000 THEN {c} END AS {c}" for c in D.PRICES)
    + " FROM unified"
)


@query("drop_untitled", f"SELECT id, title_clean FROM ({_BLANKED_SQL}) WHERE length(title_clean) > 0")
def _(t):
    return D.drop_untitled(_blanked(t)).select("id", "title_clean")


@query(
    "drop_unpriced",
    f"SELECT id, price_initial FROM ({_BLANKED_SQL}) WHERE coalesce({', '.join(D.PRICES)}) IS NOT NULL",
)
def _(t):
    return D.drop_unpriced(_blanked(t)).select("id", "price_initial")


@query(
    "cap_prices",
    "SELECT id, "
    + ", ".join(f"CASE WHEN {c} BETWEEN 1000 AND 500000 THEN {c} END AS {c}" for c in D.PRICES)
    + " FROM unified",
)
def _(t):
    return D.cap_prices(t.unified, 1000.0, 500000.0).select("id", *D.PRICES)


@query(
    "clip_discount",
    "SELECT id, CASE WHEN discount_pct IS NOT NULL THEN greatest(6.5, least(discount_pct, 8.5)) END AS discount_pct "
    "FROM unified",
)
def _(t):
    return D.clip_discount(t.unified, 6.5, 8.5).select("id", "discount_pct")


@query(
    "search",
    """SELECT id, title_clean, category, source FROM unified WHERE contains(lower(title_clean), 'au')
    OR contains(lower(coalesce(category, '')), 'au') OR contains(lower(source), 'au')""",
)
def _(t):
    found = D.search(t.unified, "Au", ["title_clean", "category", "source"])
    return found.select("id", "title_clean", "category", "source")


@query("by_source", "SELECT source, id FROM unified WHERE contains(lower(source), 'ama')")
def _(t):
    return D.by_source(t.unified, "Ama").select("source", "id")


@query(
    "by_price_state",
    """SELECT 'stated' AS state, id FROM unified WHERE price_offre IS NOT NULL UNION ALL
    SELECT 'unstated', id FROM unified WHERE price_offre IS NULL UNION ALL
    SELECT 'offer', id FROM unified WHERE offre_type <> ''""",
)
def _(t):
    rows = t.unified
    return E.union_all(
        [D.by_price_state(rows, s).select(F.lit(s).alias("state"), "id") for s in ("stated", "unstated", "offer")]
    )


@query(
    "offer_rows",
    "SELECT id, offre_type, discount_pct FROM unified WHERE discount_pct IS NOT NULL AND offre_type <> ''",
)
def _(t):
    return D.offer_rows(t.unified).select("id", "offre_type", "discount_pct")


_CAP = ", ".join(f"CASE WHEN {c} BETWEEN 0 AND 1000000 THEN {c} END AS {c}" for c in D.PRICES)
_CLEAN = (
    f"SELECT * EXCLUDE ({', '.join(D.PRICES)}, discount_pct), {_CAP}, CASE WHEN discount_pct IS NOT NULL THEN "
    f"greatest(0.0, least(discount_pct, 99.0)) END AS discount_pct FROM ({_BLANKED_SQL}) "
    f"WHERE length(title_clean) > 0 AND coalesce({', '.join(D.PRICES)}) IS NOT NULL"
)
_KEPT = (
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY title_clean, price_offre, source "
    f"ORDER BY {ORDER}) AS rn FROM ({_CLEAN})) WHERE rn = 1"
)


@query(
    "apply_quality_rules",
    f"SELECT id, source, title_clean, {', '.join(D.PRICES)}, discount_pct, false AS is_duplicate FROM ({_KEPT})",
)
def _(t):
    kept = D.apply_quality_rules(_blanked(t), LISTING_ORDER)
    return kept.select("id", "source", "title_clean", *D.PRICES, "discount_pct", "is_duplicate")


@query(
    "qa_report",
    f"""WITH raw AS (SELECT source, count(*) AS raw_rows FROM unified GROUP BY 1), c AS (SELECT source, count(*) AS n
    FROM ({_CLEAN}) GROUP BY 1), k AS (SELECT source, count(*) AS kept, count(*) FILTER (price_offre IS NULL) AS
    no_offer_price, count(discount_pct) AS with_discount FROM ({_KEPT}) GROUP BY 1) SELECT raw.source, raw_rows, kept,
    raw_rows - kept AS dropped, no_offer_price, with_discount, n - kept AS duplicates FROM raw JOIN c USING (source)
    JOIN k USING (source)""",
)
def _(t):
    return D.qa_report(_blanked(t), LISTING_ORDER)


@query(
    "check_lifecycle",
    """WITH h AS (SELECT o_orderkey AS offer_id, 0 AS seq, 'EN_ATTENTE' AS status FROM orders UNION ALL
      SELECT o_orderkey, 1, CASE o_orderstatus WHEN 'F' THEN 'VALIDEE' WHEN 'P' THEN 'REJETEE' ELSE 'EN_ATTENTE' END
      FROM orders UNION ALL SELECT o_orderkey, 2, 'PAYEE' FROM orders WHERE o_orderpriority = '1-URGENT'),
    m AS (SELECT offer_id, seq, status AS to_status, lag(status) OVER (PARTITION BY offer_id ORDER BY seq) AS
      from_status FROM h)
    SELECT offer_id, from_status, to_status FROM m WHERE from_status <> to_status AND NOT (
      (from_status = 'EN_ATTENTE' AND to_status IN ('VALIDEE', 'REJETEE')) OR
      (from_status = 'VALIDEE' AND to_status = 'PAYEE'))""",
)
def _(t):
    moved = F.expr("CASE o_orderstatus WHEN 'F' THEN 'VALIDEE' WHEN 'P' THEN 'REJETEE' ELSE 'EN_ATTENTE' END")
    steps = F.array(
        F.struct(F.lit(0).alias("seq"), F.lit("EN_ATTENTE").alias("status")),
        F.struct(F.lit(1).alias("seq"), moved.alias("status")),
        F.struct(F.lit(2).alias("seq"), F.when(F.col("o_orderpriority") == "1-URGENT", "PAYEE").alias("status")),
    )
    history = t.orders.select(F.col("o_orderkey").alias("offer_id"), F.inline(steps)).where("status IS NOT NULL")
    allowed = t.spark.createDataFrame(
        [("EN_ATTENTE", "VALIDEE"), ("EN_ATTENTE", "REJETEE"), ("VALIDEE", "PAYEE")],
        "from_status string, to_status string",
    )
    return D.check_lifecycle(history, allowed).select("offer_id", "from_status", "to_status")


# --- duplicates and sets ------------------------------------------------------------------------------------------


def _flag_sql(keys: str, source: str) -> str:
    return f"(row_number() OVER (PARTITION BY {keys} ORDER BY {ORDER}) > 1) AS is_duplicate FROM {source}"


@query("flag_duplicates", f"SELECT id, orderkey, {_flag_sql('title_clean, price_offre, source', 'unified')}")
def _(t):
    return E.flag_duplicates(t.unified, D.DEDUP_KEYS, LISTING_ORDER).select("id", "orderkey", "is_duplicate")


@query("flag_unified", f"SELECT id, orderkey, {_flag_sql('title_clean, price_offre_mad, source', 'unified')}")
def _(t):
    flagged = E.flag_duplicates(t.unified, ["title_clean", "price_offre_mad", "source"], LISTING_ORDER)
    return flagged.select("id", "orderkey", "is_duplicate")


@query(
    "drop_flagged",
    f"""SELECT id, cents FROM (SELECT id, cents, row_number() OVER (PARTITION BY id ORDER BY {ORDER}) AS rn FROM (
    SELECT *, {_flag_sql('title_clean, price_offre, source', 'unified')}) WHERE NOT is_duplicate) WHERE rn = 1""",
)
def _(t):
    flagged = E.flag_duplicates(t.unified, D.DEDUP_KEYS, LISTING_ORDER)
    return E.drop_flagged(flagged, LISTING_ORDER).select("id", "cents")


@query("dedup_keep_first", f"SELECT link, cents FROM (SELECT *, {_FIRST} AS rn FROM listings) WHERE rn = 1")
def _(t):
    return E.keep_first(t.listings, ["link"], LISTING_ORDER).select("link", "cents")


@query("distinct_values", "SELECT DISTINCT category FROM listings")
def _(t):
    return E.distinct_values(t.listings, "category")


@query(
    "distinct_agent_offers",
    """SELECT negotiation, price, turn, row_number() OVER (PARTITION BY negotiation ORDER BY turn DESC) AS position
    FROM (SELECT negotiation, price, min(turn) AS turn FROM messages WHERE sender = 'AGENT' AND price > 0
    GROUP BY 1, 2)""",
)
def _(t):
    return E.distinct_agent_offers(t.messages)


@query(
    "union_all",
    "SELECT price AS amount, 'product' AS kind FROM products UNION ALL SELECT price_proposed, 'offer' FROM offers",
)
def _(t):
    return E.union_all(
        [
            t.products.select(F.col("price").alias("amount"), F.lit("product").alias("kind")),
            t.offers.select(F.col("price_proposed").alias("amount"), F.lit("offer").alias("kind")),
        ]
    )


@query(
    "unseen",
    """SELECT link, orderkey FROM listings WHERE linenumber > 1 AND link NOT IN
    (SELECT replace(link, '?ref=1', '?ref=4') FROM listings WHERE linenumber = 1)""",
)
def _(t):
    rows = t.listings
    seen = rows.where("linenumber = 1").select(
        F.replace(F.col("link"), F.lit("?ref=1"), F.lit("?ref=4")).alias("link")
    )
    return E.unseen(rows.where("linenumber > 1"), seen, "link").select("link", "orderkey")


# --- aggregates ---------------------------------------------------------------------------------------------------

SHOWN = "coalesce(nullif(price_offre_mad, 0.0), price_initial_mad)"
DISC = "CASE WHEN discount_pct > 0 THEN discount_pct END"
SANE = f"CASE WHEN {SHOWN} > 0 AND {SHOWN} < 1000000 THEN {SHOWN} END"


@query(
    "no_offer_rollup",
    f"""SELECT source, category, level, no_offer, total, {pct('no_offer', 'total')} AS pct FROM (
    SELECT source, category, grouping(source, category) AS level, count(*) FILTER (none) AS no_offer, count(*) AS total
    FROM (SELECT source, coalesce(category, 'Unknown') AS category, offre_type = '' AS none FROM listings)
    GROUP BY ROLLUP (source, category))""",
)
def _(t):
    return G.no_offer_rollup(t.listings)


@query(
    "kpis",
    f"""SELECT count(*) AS products, {rnd(f'avg({SANE})', 0)} AS avg_price, {rnd(f'avg({DISC})', 1)} AS avg_discount,
    {rnd('avg(CASE WHEN rating > 0 THEN rating END)', 1)} AS avg_rating FROM unified""",
)
def _(t):
    return G.kpis(t.unified)


@query("by_platform", "SELECT source, count(*) AS n FROM listings GROUP BY 1")
def _(t):
    return G.by_platform(t.listings)


@query(
    "price_by_category",
    f"""SELECT coalesce(category, 'Uncategorized') AS category, {rnd(f'avg({SHOWN})', 0)} AS avg_price FROM unified
    WHERE {SHOWN} > 0 GROUP BY 1 ORDER BY avg_price DESC, category LIMIT 8""",
)
def _(t):
    return G.price_by_category(t.unified)


_STATS = f"""count(*) AS total, string_agg(DISTINCT source, ',' ORDER BY source) AS sources,
    count({DISC}) AS with_offer, {pct(f'count({DISC})', 'count(*)', 0)} AS coverage,
    coalesce({rnd(f'sum({DISC})/nullif(count({DISC}), 0)', 1)}, 0.0) AS avg_discount,
    coalesce(max({DISC}), 0.0) AS max_discount,
    coalesce({rnd(f'sum({SANE})/nullif(count({SANE}), 0)', 0)}, 0.0) AS avg_price"""


@query("category_stats", f"SELECT coalesce(category, 'Other') AS category, {_STATS} FROM unified GROUP BY 1")
def _(t):
    return G.category_stats(t.unified)


_MAP = ", ".join(
    f"('{g}', '{c}')" for g, leaves in K.CATEGORY_GROUPS.items() for c in leaves
)


@query(
    "category_tree",
    f"""SELECT group_label, category, {_STATS} FROM (SELECT u.*, m.group_label FROM unified u
    JOIN (VALUES {_MAP}) m(group_label, leaf) ON u.category = m.leaf) x
    GROUP BY GROUPING SETS ((group_label), (group_label, category))""",
)
def _(t):
    return G.category_tree(t.unified)


@query(
    "category_groups",
    f"""SELECT m.group_label, u.category, count(*) AS n FROM listings u
    JOIN (VALUES {_MAP}) m(group_label, leaf) ON u.category = m.leaf GROUP BY 1, 2""",
)
def _(t):
    from offerwell.operators.joins import category_groups

    return category_groups(t.listings).groupBy("group_label", "category").agg(F.count("*").alias("n"))


@query(
    "offer_depth",
    f"""SELECT coalesce(category, 'Other') AS category, count(*) AS total, count({DISC}) AS with_offer,
    coalesce(max({DISC}), 0.0) AS max_discount, {pct(f'count({DISC})', 'count(*)', 0)} AS coverage,
    coalesce({rnd(f'sum({DISC})/nullif(count({DISC}), 0)', 1)}, 0.0) AS avg_discount FROM unified
    WHERE contains(lower(source), 'jumia') GROUP BY 1 ORDER BY with_offer DESC, category LIMIT 10""",
)
def _(t):
    return G.offer_depth(t.unified, "jumia")


@query(
    "offer_mix",
    f"""SELECT source, {pct("count(*) FILTER (offre_type = 'pourcentage')", 'count(*)')} AS pourcentage,
    {pct("count(*) FILTER (offre_type = 'forfaite')", 'count(*)')} AS forfaite,
    {pct("count(*) FILTER (offre_type = '')", 'count(*)')} AS "none" FROM listings GROUP BY 1""",
)
def _(t):
    return G.offer_mix(t.listings)


@query(
    "run_summary",
    f"""SELECT source, count(*) AS total, count(*) FILTER (NOT is_duplicate) AS unique_rows, count(discount_pct) AS
    with_discount, count(price_offre) AS with_offer, count(*) FILTER (is_duplicate) AS duplicates FROM (
    SELECT *, {_flag_sql('title_clean, price_offre_mad, source', 'unified')}) GROUP BY ROLLUP (source)""",
)
def _(t):
    return G.run_summary(
        E.flag_duplicates(t.unified, ["title_clean", "price_offre_mad", "source"], LISTING_ORDER)
    )


@query(
    "severity_counts",
    "SELECT severity, count(*) AS n, count(*) FILTER (severity = 'CRITICAL') AS critical FROM audits GROUP BY 1",
)
def _(t):
    return G.severity_counts(t.audits)


@query(
    "cart_totals",
    f"""SELECT order_id AS cart_id, {r2('sum(price_proposed * least(quantity, stock))')} AS total_price,
    cast(sum(least(quantity, stock)) AS BIGINT) AS item_count FROM offers JOIN products USING (product_id)
    GROUP BY 1""",
)
def _(t):
    items = t.offers.join(t.products.select("product_id", "stock"), "product_id")
    return G.cart_totals(
        items.select(F.col("order_id").alias("cart_id"), F.col("price_proposed").alias("price"), "quantity", "stock")
    )


@query(
    "describe_col",
    f"""SELECT source, count(price_initial_mad) AS "count", {r4('avg(price_initial_mad)')} AS mean,
    {r4('stddev_samp(price_initial_mad)')} AS std, min(price_initial_mad) AS "min",
    {r4('quantile_cont(price_initial_mad, 0.25)')} AS p25, {r4('quantile_cont(price_initial_mad, 0.5)')} AS p50,
    {r4('quantile_cont(price_initial_mad, 0.75)')} AS p75, max(price_initial_mad) AS "max" FROM unified GROUP BY 1""",
)
def _(t):
    return G.describe_col(t.unified, "price_initial_mad", ["source"])


@query("value_counts", "SELECT category, count(*) AS n FROM listings GROUP BY 1 ORDER BY n DESC, category")
def _(t):
    return G.value_counts(t.listings, "category")


@query(
    "histogram",
    f"""WITH s AS (SELECT min(price_initial_mad) AS lo, max(price_initial_mad) AS hi FROM unified),
    c AS (SELECT cast(least(floor((price_initial_mad - lo) / (hi - lo) * 30.0), 29) AS INT) AS bin, count(*) AS n
      FROM unified, s WHERE price_initial_mad IS NOT NULL GROUP BY 1)
    SELECT cast(b.i AS INT) AS bin, {r4('lo + b.i * ((hi - lo) / 30.0)')} AS bin_from, coalesce(n, 0) AS n
    FROM range(30) b(i) CROSS JOIN s LEFT JOIN c ON c.bin = b.i""",
)
def _(t):
    return G.histogram(t.unified, "price_initial_mad", 30)


@query(
    "box_stats",
    f"""WITH q AS (SELECT source, quantile_cont(price_initial_mad, 0.25) AS a, quantile_cont(price_initial_mad, 0.5)
      AS b, quantile_cont(price_initial_mad, 0.75) AS c FROM unified GROUP BY 1)
    SELECT source, {r4('max(a)')} AS q1, {r4('max(b)')} AS median, {r4('max(c)')} AS q3,
    min(price_initial_mad) FILTER (price_initial_mad BETWEEN a-(c-a)*1.5 AND c+(c-a)*1.5) AS whisker_low,
    max(price_initial_mad) FILTER (price_initial_mad BETWEEN a-(c-a)*1.5 AND c+(c-a)*1.5) AS whisker_high,
    count(*) FILTER (NOT price_initial_mad BETWEEN a-(c-a)*1.5 AND c+(c-a)*1.5) AS outliers
    FROM unified JOIN q USING (source) GROUP BY 1""",
)
def _(t):
    return G.box_stats(t.unified, "price_initial_mad", ["source"])


@query(
    "group_median",
    """SELECT id, rating, median FROM unified JOIN (SELECT source, quantile_cont(rating, 0.5) AS median FROM unified
    GROUP BY 1) USING (source)""",
)
def _(t):
    return G.group_median(t.unified, "rating", ["source"]).select("id", "rating", "median")


_STORED = "try_cast(nullif(regexp_extract(badge, '(\\d+)\\s*%', 1), '') AS DOUBLE)"


@query(
    "formula_agreement",
    f"""SELECT source, count(s) AS with_offer, count(*) FILTER (s IS NOT NULL AND price_initial > 0 AND
    price_offre > 0) AS with_both_prices, count(*) FILTER (s IS NOT NULL AND price_initial > 0 AND price_offre > 0 AND
    abs(s - (price_initial-price_offre)/price_initial*100.0) <= 0.001) AS agreeing FROM (
    SELECT *, {_STORED} AS s FROM raw_listings) GROUP BY 1""",
)
def _(t):
    stored = F.regexp_extract("badge", r"(\d+)\s*%", 1).try_cast("double")
    return G.formula_agreement(t.raw_listings.withColumn("stored", stored), "stored", tol=0.001)


@query(
    "mae_by",
    f"SELECT source, {r4('avg(abs(discount_pct - rating*2.0))')} AS mae FROM unified WHERE discount_pct IS NOT NULL "
    "AND rating IS NOT NULL GROUP BY 1 ORDER BY mae, source",
)
def _(t):
    return G.mae_by(t.unified.withColumn("guess", F.col("rating") * 2.0), "source", "discount_pct", "guess")


_PROFILED = ["price_initial_mad", "cents"]


@query(
    "approx_profile",
    f"SELECT source, count(*) AS n, {', '.join(f'true AS {c}_distinct_near, true AS {c}_quartiles_near' for c in _PROFILED)} "
    "FROM unified GROUP BY 1",
)
def _(t):
    """Whether distinct counts are within five standard errors (8 %) and quartiles within twice the rank error and one rank.

    The profile is merged from one sketch set per product type and source, as daily ones would be.
    """
    parts = G.profile_sketches(t.unified, _PROFILED, ["source", "category"])
    found = G.read_profiles(G.merge_profiles(cut_lineage(parts, "profiles"), _PROFILED, ["source"]), _PROFILED, ["source"])
    aggs, near = [], []
    for c in _PROFILED:
        aggs += [F.count_distinct(c).alias(f"_{c}"), F.max(f"{c}_distinct").alias(f"_d{c}")]
        near.append((F.abs(F.col(f"_{c}") - F.col(f"_d{c}")) <= 0.08 * F.col(f"_{c}")).alias(f"{c}_distinct_near"))
        inside, off = F.lit(True), 2 * G.PROFILE_ERROR + 1 / F.max("n")
        for i, p in enumerate((0.25, 0.5, 0.75)):
            q = F.col(f"{c}_quartiles")[i]
            below, upto = F.avg((F.col(c) < q).cast("int")) - off, F.avg((F.col(c) <= q).cast("int")) + off
            aggs += [below.alias(f"_l{c}{i}"), upto.alias(f"_u{c}{i}")]
            inside = inside & (F.col(f"_l{c}{i}") <= p) & (F.col(f"_u{c}{i}") >= p)
        near.append(inside.alias(f"{c}_quartiles_near"))
    rows = t.unified.join(found, "source").groupBy("source").agg(F.max("n").alias("n"), *aggs)
    return rows.select("source", "n", *near)


# --- sorts --------------------------------------------------------------------------------------------------------


@query(
    "top_deals",
    f"""SELECT source, link, title_clean, discount_pct, {SHOWN} AS price FROM unified WHERE discount_pct > 0
    ORDER BY discount_pct DESC, link, {ORDER} LIMIT 10""",
)
def _(t):
    deals = I.top_deals(t.unified, 10, ["link", *LISTING_ORDER])
    return deals.select("source", "link", "title_clean", "discount_pct", G._shown_price().alias("price"))


@query(
    "sort_price",
    f"""SELECT price_initial, id, orderkey FROM unified ORDER BY price_initial DESC NULLS LAST, {ORDER}""",
)
def _(t):
    rows = I.sort_price(t.unified, F.col("price_initial"), ascending=False, ties=LISTING_ORDER)
    return rows.select("price_initial", "id", "orderkey")


# The check covers the rows; their order follows the French collation and is tested in the unit tests.
@query("sort_title_fr", "SELECT title, link FROM listings")
def _(t):
    return I.sort_title_fr(t.listings).select("title", "link")


@query("sort_rating", f"SELECT rating, id, orderkey FROM unified ORDER BY coalesce(rating, 0) DESC, {ORDER}")
def _(t):
    return I.sort_rating(t.unified, ties=LISTING_ORDER).select("rating", "id", "orderkey")


@query(
    "latest_orders",
    "SELECT o_orderkey, cast(cast(o_orderdate AS DATE) AS STRING) AS order_date FROM orders "
    "ORDER BY o_orderdate DESC, o_orderkey",
)
def _(t):
    rows = I.latest_orders(t.orders, "o_orderdate", ["o_orderkey"])
    return rows.select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("order_date"))


# --- flagship -----------------------------------------------------------------------------------------------------


@query(
    "category_overview",
    f"""WITH d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY title_clean, price_offre,
    source ORDER BY {ORDER}) AS rn FROM unified) WHERE rn = 1)
    SELECT coalesce(category, 'Other') AS category, {_STATS} FROM d GROUP BY 1""",
)
def _(t):
    return G.category_stats(D.apply_quality_rules(t.unified, LISTING_ORDER))
