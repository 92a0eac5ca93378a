"""Join, window, pricing and settlement queries over products, offers and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerwell import constants as K
from offerwell.operators import joins as J
from offerwell.operators import pricing as P
from offerwell.operators import windows as W
from offerwell.plans.listings import ORDER, rnd
from offerwell.plans.registry import mean, query, r2, r4
from offerwell.sources.views import LISTING_ORDER, OFFER_ORDER

O_ORDER = ", ".join(OFFER_ORDER)

# --- joins --------------------------------------------------------------------------------------------------------


@query(
    "with_product",
    """SELECT conv_id AS negotiation, conv_id * 7 AS product_id, title, price FROM (SELECT DISTINCT conv_id
    FROM conversations) LEFT JOIN products ON product_id = conv_id * 7""",
)
def _(t):
    nego = t.conversations.select(F.col("conv_id").alias("negotiation")).distinct()
    nego = nego.withColumn("product_id", F.col("negotiation") * 7)
    return J.with_product(nego, t.products.select("product_id", "title", "price"))


@query(
    "first_offer_per_product",
    f"""SELECT p.product_id, title, offer_id, price_proposed FROM products p LEFT JOIN (SELECT *, row_number() OVER
    (PARTITION BY product_id ORDER BY {O_ORDER}) AS rn FROM offers) o ON o.product_id = p.product_id AND rn = 1""",
)
def _(t):
    offers = t.offers.select("product_id", *OFFER_ORDER, "price_proposed")
    rows = J.first_offer_per_product(t.products.select("product_id", "title"), offers, OFFER_ORDER)
    return rows.select("product_id", "title", "offer_id", "price_proposed")


@query(
    "order_chain",
    """SELECT offer_id, title, concat('CMD-', offer_id) AS order_ref, price_final AS paid FROM offers
    JOIN products USING (product_id) WHERE status = 'VALIDEE' AND price_final > 0""",
)
def _(t):
    valid = t.offers.where("status = 'VALIDEE'")
    orders = valid.select("offer_id", F.concat(F.lit("CMD-"), F.col("offer_id")).alias("order_ref"))
    payments = valid.where("price_final > 0").select(
        F.concat(F.lit("CMD-"), F.col("offer_id")).alias("order_ref"), F.col("price_final").alias("paid")
    )
    offers = t.offers.select("offer_id", "product_id")
    rows = J.order_chain(offers, t.products.select("product_id", "title"), payments, orders)
    return rows.select("offer_id", "title", "order_ref", "paid")


@query(
    "orders_for",
    """SELECT 'buyer' AS side, offer_id FROM offers WHERE buyer_id IN (SELECT c_custkey FROM customer
    WHERE c_mktsegment = 'MACHINERY') UNION ALL SELECT 'seller', offer_id FROM offers WHERE seller_id IN (
    SELECT s_suppkey FROM supplier WHERE s_acctbal > 9000)""",
)
def _(t):
    buyers = t.customer.where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("buyer_id"))
    sellers = t.supplier.where("s_acctbal > 9000").select(F.col("s_suppkey").alias("seller_id"))
    bought = J.orders_for(t.offers, buyers, "buyer_id").select(F.lit("buyer").alias("side"), "offer_id")
    return bought.union(J.orders_for(t.offers, sellers, "seller_id").select(F.lit("seller").alias("side"), "offer_id"))


@query(
    "messages_of",
    """SELECT negotiation, turn, sender, price FROM messages WHERE negotiation IN (SELECT conv_id FROM conversations
    WHERE role = 'system') ORDER BY negotiation, turn""",
)
def _(t):
    nego = t.conversations.where("role = 'system'").select(F.col("conv_id").alias("negotiation")).distinct()
    return J.messages_of(nego, t.messages).select("negotiation", "turn", "sender", "price")


def _param(i: int) -> str:
    cases = " ".join(f"WHEN source = '{s}' THEN {v[i]}" for s, v in K.PRICING_PARAMS.items())
    return f"CASE {cases} ELSE {K.DEFAULT_PARAMS[i]} END"


@query(
    "source_params",
    "SELECT id, source, " + ", ".join(f"{_param(i)} AS {n}" for i, n in enumerate(J.PARAM_NAMES)) + " FROM unified",
)
def _(t):
    return J.source_params(t.unified).select("id", "source", *J.PARAM_NAMES)


@query(
    "similar_prices",
    f"""SELECT product_id, n - 1 AS similar_count, CASE WHEN n > 1 THEN {r4('(s - price) / (n - 1)')} END AS
    similar_price FROM (SELECT product_id, price, sum(price) OVER (PARTITION BY category) AS s,
    count(*) OVER (PARTITION BY category) AS n FROM products)""",
)
def _(t):
    from offerwell.functions.numbers import half_up

    rows = J.similar_prices(t.products)
    return rows.select("product_id", "similar_count", half_up(F.col("similar_price"), 4).alias("similar_price"))


@query(
    "offers_valid_at",
    """SELECT e.event_id, o.event_id AS offer_id FROM events e JOIN events o ON e.user_id = o.user_id
    AND e.event_type = 'purchase' AND o.event_type = 'signup' AND e.ts >= o.ts AND e.ts < o.ts + INTERVAL 7 DAY""",
)
def _(t):
    buys = t.events.where("event_type = 'purchase'").select("event_id", F.col("user_id").alias("product_id"), "ts")
    offers = t.events.where("event_type = 'signup'").select(
        F.col("event_id").alias("offer_id"),
        F.col("user_id").alias("product_id"),
        F.col("ts").alias("created"),
        F.expr("ts + INTERVAL 7 DAYS").alias("expires"),
    )
    return J.offers_valid_at(buys, offers).select("event_id", "offer_id")


@query(
    "score_as_of",
    """SELECT o.event_id, o.user_id AS seller_id, s.value AS score_t0 FROM (SELECT * FROM events
    WHERE event_type = 'purchase') o ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') s
    ON o.user_id = s.user_id AND o.ts >= s.ts""",
)
def _(t):
    offers = t.events.where("event_type = 'purchase'").select(F.col("user_id").alias("seller_id"), "ts", "event_id")
    scores = t.events.where("event_type = 'view'").select(
        F.col("user_id").alias("seller_id"), "ts", "event_id", F.col("value").alias("score")
    )
    return J.score_as_of(offers, scores).select("event_id", "seller_id", "score_t0")


@query(
    "without_offer",
    "SELECT product_id, title FROM products WHERE product_id NOT IN (SELECT product_id FROM offers WHERE status = "
    "'VALIDEE')",
)
def _(t):
    some = t.offers.where("status = 'VALIDEE'")
    return J.without_offer(t.products, some).select("product_id", "title")


@query(
    "with_offer",
    "SELECT product_id, title FROM products WHERE product_id IN (SELECT product_id FROM offers WHERE status = "
    "'VALIDEE')",
)
def _(t):
    some = t.offers.where("status = 'VALIDEE'")
    return J.with_offer(t.products, some).select("product_id", "title")


# --- windows ------------------------------------------------------------------------------------------------------

_HISTORY = f"""SELECT *, lag(price) OVER (PARTITION BY partkey, source ORDER BY day, {ORDER}) AS previous_price FROM (
    SELECT *, coalesce(price_offre, price_initial) AS price FROM listings)"""


def snapshots(t):
    return t.listings.withColumn("price", F.coalesce("price_offre", "price_initial")).withColumnRenamed(
        "partkey", "product_id"
    )


SNAPSHOT_ORDER = ["day", *[c if c != "partkey" else "product_id" for c in LISTING_ORDER if c != "day"]]


@query(
    "price_history",
    f"""SELECT partkey AS product_id, source, cast(day AS STRING) AS day, price, previous_price,
    {r2('(price - previous_price) / previous_price * 100.0')} AS pct_change FROM ({_HISTORY})""",
)
def _(t):
    rows = W.price_history(snapshots(t), order=SNAPSHOT_ORDER)
    return rows.select(
        "product_id", "source", F.col("day").cast("string").alias("day"), "price", "previous_price", "pct_change"
    )


ROUNDS_SQL = """SELECT *, current * 0.6 AS floor_price FROM (SELECT negotiation, event_id, ts, bid,
    max(bid) OVER w * 1.2 AS current, count(*) OVER w AS rounds_max,
    row_number() OVER (PARTITION BY negotiation ORDER BY ts, event_id) AS round,
    lag(bid) OVER (PARTITION BY negotiation ORDER BY ts, event_id) AS previous_bid FROM bids
    WINDOW w AS (PARTITION BY negotiation))"""
TREND_SQL = "greatest(-1.0, least(1.0, coalesce((bid - previous_bid) / current, 0.0)))"


@query("offer_trend", f"SELECT event_id, round, {r4(TREND_SQL)} AS trend FROM ({ROUNDS_SQL})")
def _(t):
    from offerwell.functions.numbers import half_up

    rows = W.offer_trend(W.bid_rounds(t.bids))
    return rows.select("event_id", "round", half_up(F.col("trend"), 4).alias("trend"))


STEP_SQL = """CASE WHEN bid - previous_bid > current * 0.001 THEN 5 WHEN abs(bid - previous_bid) <= current * 0.001
    THEN -2 WHEN previous_bid IS NOT NULL THEN -4 ELSE 0 END"""
COOP_SQL = f"""greatest(-0.15, least(0.15, sum({STEP_SQL}) OVER (PARTITION BY negotiation ORDER BY ts, event_id)
    / 100.0))"""


@query("cooperation_score", f"SELECT event_id, {r4(COOP_SQL)} AS cooperation FROM ({ROUNDS_SQL})")
def _(t):
    from offerwell.functions.numbers import half_up

    rows = W.cooperation_score(W.bid_rounds(t.bids))
    return rows.select("event_id", half_up(F.col("cooperation"), 4).alias("cooperation"))


@query(
    "stagnation_bonus",
    """WITH b AS (SELECT negotiation, ts, event_id, floor(bid / 40) AS bid FROM bids),
    l AS (SELECT negotiation, arg_max(bid, event_id) AS last_bid FROM b GROUP BY 1),
    x AS (SELECT b.*, last_bid FROM b JOIN l USING (negotiation)),
    k AS (SELECT negotiation, max(event_id) FILTER (abs(bid - last_bid) >= 0.01) AS brk FROM x GROUP BY 1)
    SELECT negotiation, last_bid, count(*) AS run_length, CASE WHEN count(*) >= 3 THEN least(0.20, (count(*) - 2) * 0.05)
    ELSE 0.0 END AS bonus FROM x JOIN k USING (negotiation) WHERE brk IS NULL OR event_id > brk GROUP BY 1, 2""",
)
def _(t):
    return W.stagnation_bonus(t.bids.withColumn("bid", F.floor(F.col("bid") / 40).cast("double")))


@query(
    "round_number",
    """SELECT negotiation, turn, sum(CASE WHEN sender = 'ACHETEUR' THEN 1 ELSE 0 END) OVER w AS round,
    last_value(CASE WHEN price > 0 THEN price END IGNORE NULLS) OVER w AS current_price FROM messages
    WINDOW w AS (PARTITION BY negotiation ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def _(t):
    return W.round_number(t.messages).select("negotiation", "turn", "round", "current_price")


_ALLOCATED = f"""SELECT o.*, stock, row_number() OVER (PARTITION BY product_id ORDER BY {O_ORDER}) AS running_quantity
    FROM offers o JOIN products USING (product_id)"""


@query(
    "allocate_stock",
    f"SELECT offer_id, running_quantity, running_quantity <= stock AS accepted FROM ({_ALLOCATED})",
)
def _(t):
    rows = W.allocate_stock(t.offers, t.products, OFFER_ORDER, F.lit(1))
    return rows.select("offer_id", "running_quantity", "accepted")


@query(
    "stock_after",
    f"""SELECT product_id, max(stock) AS stock, count(*) FILTER (running_quantity <= stock) AS sold,
    max(stock) - count(*) FILTER (running_quantity <= stock) AS remaining, CASE WHEN max(stock) - count(*) FILTER (
    running_quantity <= stock) <= 0 THEN 'VENDU' ELSE 'DISPONIBLE' END AS product_status FROM ({_ALLOCATED})
    GROUP BY 1""",
)
def _(t):
    return W.stock_after(W.allocate_stock(t.offers, t.products, OFFER_ORDER, F.lit(1)), F.lit(1))


_SAMPLE_KEY = ["id", *LISTING_ORDER]
_SAMPLE_MD5 = (
    "md5(concat_ws('|', id, cast(orderkey AS STRING), cast(linenumber AS STRING), cast(partkey AS STRING), "
    "cast(suppkey AS STRING), cast(day AS STRING), cast(cents AS STRING)))"
)


@query(
    "sample_per_group",
    f"""SELECT source, id, cents FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_SAMPLE_MD5}) AS rn
    FROM unified) WHERE rn <= 3""",
)
def _(t):
    return W.sample_per_group(t.unified, ["source"], 3, _SAMPLE_KEY).select("source", "id", "cents")


@query(
    "top_n_per_group",
    f"""SELECT source, category, id, discount_pct, rn AS position FROM (SELECT *, row_number() OVER (
    PARTITION BY source, category ORDER BY discount_pct DESC, {ORDER}) AS rn FROM unified WHERE discount_pct > 0)
    WHERE rn <= 5""",
)
def _(t):
    best = [F.desc("discount_pct"), *[F.col(c) for c in LISTING_ORDER]]
    rows = W.top_n_per_group(t.unified.where("discount_pct > 0"), ["source", "category"], best, 5)
    return rows.select("source", "category", "id", "discount_pct", "position")


@query(
    "days_since_first",
    """SELECT orderkey, coalesce(date_diff('day', (SELECT min(d) FROM (SELECT CASE WHEN linenumber < 7 THEN day END AS d
    FROM listings)), CASE WHEN linenumber < 7 THEN day END), 0) AS days_since_first FROM listings""",
)
def _(t):
    rows = t.listings.withColumn("seen", F.when(F.col("linenumber") < 7, F.col("day")))
    return W.days_since_first(rows, "seen").select("orderkey", "days_since_first")


@query(
    "moving_score",
    f"""WITH d AS (SELECT user_id AS seller_id, cast(ts AS DATE) AS day, {rnd(mean('value'), 6)} AS a FROM events
    GROUP BY 1, 2) SELECT seller_id, cast(day AS STRING) AS day, {r4('a')} AS score,
    {r4('sum(cast(a AS DECIMAL(28,6))) OVER w::DOUBLE / count(*) OVER w')} AS moving FROM d
    WINDOW w AS (PARTITION BY seller_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def _(t):
    scores = t.events.select(F.col("user_id").alias("seller_id"), "ts", F.col("value").alias("score"))
    return W.moving_score(scores).withColumn("day", F.col("day").cast("string"))


@query(
    "share_of_total",
    f"SELECT source, count(*) AS n, {r2('count(*) * 100.0 / (SELECT count(*) FROM listings)')} AS share "
    "FROM listings GROUP BY 1",
)
def _(t):
    return W.share_of_total(t.listings, "source")


# --- pricing ------------------------------------------------------------------------------------------------------

_P = "coalesce(price_initial, price_offre)"
_PP = f"CASE WHEN {_P} > 0 THEN {_P} ELSE 1 END"
_RR = "CASE WHEN rating > 0 THEN rating ELSE 3.5 END"


def _contains(words: list[str], col: str = "category") -> str:
    return f"regexp_matches(lower(coalesce({col}, '')), '{'|'.join(words)}')"


_CF = f"CASE WHEN {_contains(K.HIGH_VALUE_WORDS)} THEN 0.8 WHEN {_contains(K.ACCESSORY_WORDS)} THEN 1.3 ELSE 1.0 END"
_SRC_CF = f"CASE WHEN source = 'Steam' THEN 1.0 ELSE {_CF} END"


def _formula(rating_term: str) -> str:
    raw = (
        f"(({_param(0)}) + ({_param(1)}) * log10({_PP} + 1.0) + ({_param(2)}) * {rating_term} + "
        f"({_param(4)}) / ({_PP} + ({_param(5)}))) * ({_SRC_CF})"
    )
    return f"greatest(least(({raw})::DOUBLE, ({_param(7)})::DOUBLE), ({_param(6)})::DOUBLE)"


_SOURCE_D = _formula(f"(({_param(3)}) - {_RR})")
_MASTER_D = _formula(f"greatest(({_param(3)}) - {_RR}, 0.0)")


def _priced(t):
    return t.unified.withColumn("price", F.coalesce("price_initial", "price_offre"))


def _rounded(rows, col="discount"):
    from offerwell.functions.numbers import half_up

    return rows.select("id", "orderkey", half_up(F.col(col), 4).alias("discount"))


@query("source_discount", f"SELECT id, orderkey, {r4(_SOURCE_D)} AS discount FROM unified")
def _(t):
    return _rounded(P.source_discount(_priced(t)))


@query("master_discount", f"SELECT id, orderkey, {r4(_MASTER_D)} AS discount FROM unified")
def _(t):
    return _rounded(P.master_discount(_priced(t)))


@query(
    "universal_discount",
    f"""SELECT id, orderkey, {r4(f'greatest(8.0, least(60.0, (10.0 + 4.0 * log10({_PP} + 1.0) + 3.0 * greatest(4.5 - {_RR}, 0.0) + 250.0 / ({_PP} + 10.0)) * {_CF}))')}
    AS discount FROM unified""",
)
def _(t):
    rows = _priced(t)
    return _rounded(
        rows.withColumn("discount", P.universal_discount(F.col("price"), F.col("rating"), F.col("category")))
    )


_SIMPLE = "greatest(5.0, least(50.0, 10.0 + 5.0 * log10(price_offre + 1.0) + 3.0 * (5.0 - coalesce(rating, 2.5))))"


@query(
    "simple_discount",
    f"""SELECT id, orderkey, CASE WHEN price_offre IS NOT NULL THEN concat(cast(cast(floor({_SIMPLE} + 0.5) AS INT) AS
    STRING), '%') END AS valeur_offre FROM unified""",
)
def _(t):
    offer = P.simple_offer(F.col("price_offre"), F.col("rating"))
    return t.unified.select("id", "orderkey", offer["valeur_offre"].alias("valeur_offre"))


@query(
    "generate_offers",
    f"""SELECT id, source, category, title_clean AS product, {r2(_P)} AS price, rating, {rnd(_SOURCE_D, 0)} AS offer_pct,
    {r2(f'{_P} * (1.0 - {_SOURCE_D} / 100.0)')} AS offer_price FROM (SELECT *, row_number() OVER (PARTITION BY source
    ORDER BY {_SAMPLE_MD5}) AS rn FROM unified WHERE {_P} IS NOT NULL) WHERE rn <= 3""",
)
def _(t):
    rows = P.generate_offers(t.unified, 3, _SAMPLE_KEY)
    return rows.select("id", "source", "category", "product", "price", "rating", "offer_pct", "offer_price")


_RATED = "SELECT *, CASE WHEN stock % 5 > 0 THEN stock % 5 + 0.5 END AS rating FROM products"
_SCF = (
    f"CASE WHEN {_contains(K.SUGGEST_HIGH_VALUE_WORDS)} THEN 0.8 WHEN {_contains(K.SUGGEST_ACCESSORY_WORDS)} THEN 1.3 "
    "ELSE 1.0 END"
)


@query(
    "suggest_price",
    f"""WITH a AS (SELECT product_id, price, price_min, {_SCF} AS cf, greatest(5.0, least(50.0, (10.0 + 4.0 *
      log10(price + 1.0) + 3.0 * (4.5 - {_RR})) * ({_SCF}))) AS d, (sum(price) OVER (PARTITION BY category) - price) /
      nullif(count(*) OVER (PARTITION BY category) - 1, 0) / price AS m FROM ({_RATED})),
    b AS (SELECT *, greatest(price_min, price * (1.0 - d / 100.0)) AS base FROM a)
    SELECT product_id, cf, {rnd('d', 1)} AS discount, {r2('coalesce(m, 1.0)')} AS market_factor,
    {r2('CASE WHEN m IS NULL THEN base ELSE greatest(price_min, base * CASE WHEN m < 0.9 THEN 0.95 WHEN m > 1.1 THEN 1.03 ELSE 1.0 END) END')}
    AS suggested_price FROM b""",
)
def _(t):
    stars = F.col("stock") % 5
    rated = t.products.withColumn("rating", F.when(stars > 0, stars + 0.5))
    return P.suggest_price(rated).select("product_id", "cf", "discount", "market_factor", "suggested_price")


def _anomaly_sql(threshold: float) -> str:
    return f"""SELECT offer_id, price, {r2('ratio')} AS anomaly_ratio, reason, reason <> 'None' AS is_suspect FROM (
    SELECT *, CASE WHEN ratio > {threshold} THEN concat('Price deviation of ', cast(cast(floor(ratio * 100.0 + 0.5) AS
      BIGINT) AS STRING), '% exceeds threshold') WHEN price_proposed <= 0 THEN 'Price is zero or negative'
      WHEN price_proposed > price * 2.0 THEN 'Price is more than double the base price (unlikely luxury markup)'
      WHEN price_proposed < price * 0.1 THEN 'Price is less than 10% of base price (suspiciously low)' ELSE 'None' END
      AS reason FROM (SELECT offer_id, price, price_proposed, CASE WHEN price > 0 THEN abs(price - price_proposed) /
      price ELSE 0.0 END AS ratio FROM offers JOIN products USING (product_id)))"""


def _offer_prices(t):
    return t.offers.join(t.products.select("product_id", "price"), "product_id")


@query("flag_anomalies", _anomaly_sql(0.30))
def _(t):
    return P.flag_anomalies(_offer_prices(t)).select("offer_id", "price", "anomaly_ratio", "reason", "is_suspect")


@query(
    "safe_alternatives",
    f"""SELECT offer_id, c.choice, {r2('price * c.k')} AS alternative FROM ({_anomaly_sql(0.30)}) CROSS JOIN
    (VALUES (0, 0.85), (1, 0.75), (2, 0.60)) c(choice, k) WHERE is_suspect AND price > 0""",
)
def _(t):
    return P.safe_alternatives(P.flag_anomalies(_offer_prices(t))).select("offer_id", "choice", "alternative")


_ACCEPTED = """SELECT * EXCLUDE (status, price_final), CASE WHEN status = 'EN_ATTENTE' THEN 'VALIDEE' ELSE status END AS
    status, CASE WHEN status = 'EN_ATTENTE' AND price_final <= 0 THEN price_proposed ELSE price_final END AS price_final
    FROM offers"""


@query("accept_offers", f"SELECT offer_id, status, price_final FROM ({_ACCEPTED})")
def _(t):
    return P.accept_offers(t.offers).select("offer_id", "status", "price_final")


@query(
    "settle_offers",
    f"""WITH a AS (SELECT o.*, stock, row_number() OVER (PARTITION BY product_id ORDER BY {O_ORDER}) AS rn
      FROM ({_ACCEPTED}) o JOIN products USING (product_id) WHERE status = 'VALIDEE'),
    n AS (SELECT *, lpad(cast(row_number() OVER (ORDER BY md5(offer_id)) AS STRING), 6, '0') AS seq FROM a
      WHERE rn <= stock)
    SELECT offer_id, product_id, buyer_id, seller_id, concat('CMD-', strftime(created, '%Y%m%d'), '-', seq) AS order_ref,
    concat('PAY-', strftime(created, '%Y%m%d'), '-', seq) AS payment_ref, price_final, 'PAYEE' AS order_status,
    'CONFIRME' AS payment_status FROM n""",
)
def _(t):
    return P.settle_offers(t.offers, t.products, OFFER_ORDER)


@query(
    "expire",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderdate + INTERVAL 24 HOUR < TIMESTAMP '1998-08-02'
    THEN 'EXPIREE' WHEN o_orderstatus = 'O' THEN 'EN_ATTENTE_PAIEMENT' ELSE 'PAYEE' END AS status FROM orders""",
)
def _(t):
    status = F.when(F.col("o_orderstatus") == "O", "EN_ATTENTE_PAIEMENT").otherwise("PAYEE")
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").alias("created"), status.alias("status"))
    return P.expire(orders, F.lit("1998-08-02").cast("timestamp")).select("o_orderkey", "status")


@query(
    "sql_functions",
    f"""SELECT id, orderkey, {r2('price_initial')} AS rounded, CASE WHEN price_offre IS NOT NULL AND price_initial >
    price_offre AND {r2('(price_initial-price_offre)/price_initial*100')} > 0 THEN
    {r2('(price_initial-price_offre)/price_initial*100')} END AS off, {r4(_SOURCE_D)} AS discount FROM unified""",
)
def _(t):
    from offerwell.functions.sql import register

    register(t.spark)
    return t.unified.selectExpr(
        "id",
        "orderkey",
        "offer_round_half_up(price_initial) AS rounded",
        "offer_discount_pct(price_initial, price_offre) AS off",
        "floor(offer_source_discount(source, price_initial, rating, category) * 10000D + 0.5D) / 10000D AS discount",
    )
