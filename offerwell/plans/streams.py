"""Streaming queries over the stored events; the checks are their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerwell.functions.numbers import half_up
from offerwell.operators.negotiation import first_bids
from offerwell.plans.negotiation import _replay_sql, scaled_bids
from offerwell.plans.registry import query, r2
from offerwell.session import cut_lineage
from offerwell.sources.views import AUDIT, OFFER, STORED, _items
from offerwell.streaming import jobs as S


def events(t):
    rows = S.read_files(t.spark, t.folder, STORED["events"], "events.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def kind(t, name: str, id_name: str):
    rows = events(t).where(F.col("event_type") == name)
    return rows.select(F.col("user_id").alias("buyer_id"), F.col("event_id").alias(id_name), "ts")


def minute(col: str):
    return F.date_format(col, "yyyy-MM-dd HH:mm").alias(col)


@query("stream_merge_new", "SELECT DISTINCT user_id FROM events")
def _(t):
    return S.append_to_files(S.merge_new(events(t), "user_id").select("user_id"), "merge-new")


@query(
    "stream_window_kpis",
    f"""SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M') AS window_start, event_type, count(*) AS n,
    {r2('sum(value)')} AS total, max(value) AS highest FROM events GROUP BY 1, 2""",
)
def _(t):
    rows = S.latest_results(
        S.window_kpis(events(t), ["event_type"], "value", "6 hours"), "window-kpis", ["window_start", "event_type"]
    )
    return rows.select(minute("window_start"), "event_type", "n", half_up(F.col("total")).alias("total"), "highest")


@query(
    "stream_sliding_kpis",
    f"""SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts) - to_hours(6 * k), '%Y-%m-%d %H:%M') AS window_start,
    count(*) AS n, {r2('sum(value)')} AS total, max(value) AS highest FROM events CROSS JOIN range(4) r(k) GROUP BY 1""",
)
def _(t):
    rows = S.latest_results(
        S.window_kpis(events(t), [], "value", "24 hours", "6 hours"), "sliding-kpis", ["window_start"]
    )
    return rows.select(minute("window_start"), "n", half_up(F.col("total")).alias("total"), "highest")


_SESSIONS = """SELECT user_id, min(ts) AS s, max(ts) + INTERVAL 2 HOUR AS e, count(*) AS n FROM (SELECT *,
    sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (
    PARTITION BY user_id ORDER BY ts) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, g"""


def arrivals(rows, name: str, key: str = "event_id", mixed: bool = False):
    """(stream, arrivals): ``rows`` in four parts that arrive one after another, each a quarter of the ids or (mixed) every fourth id."""
    source = S.Arrivals(rows.sparkSession, name)
    last = rows.agg(F.max(key)).first()[0] or 0
    part = F.col(key) % 4 if mixed else F.least(F.floor(F.col(key) * 4 / (last + 1)), F.lit(3))
    return source.stream(rows.schema), [source.part(rows.where(part == i)) for i in range(4)]


@query(
    "stream_sessions",
    f"""SELECT user_id, strftime(s, '%Y-%m-%d %H:%M') AS session_start, strftime(e, '%Y-%m-%d %H:%M') AS session_end, n
    FROM ({_SESSIONS})""",
)
def _(t):
    end = S.Closing(t.spark, "sessions")
    rows = S.append_to_files(S.sessions(end.attach(events(t)), "user_id"), "sessions", [None, end.close])
    return rows.select("user_id", minute("session_start"), minute("session_end"), "n")


@query("stream_negotiate", _replay_sql())
def _(t):
    end = S.Closing(t.spark, "negotiate")
    bids = t.events.selectExpr(
        "user_id AS negotiation", "event_id AS seq", "cast(ts AS timestamp) AS ts", "value * 0.2D + 90.0D + event_id % 7 AS bid"
    )
    rows, parts = arrivals(bids, "negotiate", "seq")
    # Opening prices are known when a negotiation starts; here they are the stored table of the batch twin.
    # They are written, as every micro-batch reads them.
    opening = cut_lineage(first_bids(scaled_bids(t)).select("negotiation", "current", "floor_price"), "opening")
    spark = t.spark
    before = spark.conf.get(S.STATE_PROVIDER)
    spark.conf.set(S.STATE_PROVIDER, S.ROCKSDB)
    try:
        states = S.append_to_files(S.negotiate(end.attach(rows), opening), "negotiate", [*parts, end.close])
    finally:
        spark.conf.set(S.STATE_PROVIDER, before)
    return S.negotiated_prices(states)


@query(
    "stream_anomalies",
    """SELECT offer_id, reason FROM (SELECT offer_id, price, price_proposed, CASE WHEN abs(price - price_proposed) / price
    > 0.3 THEN concat('Price deviation of ', cast(cast(floor(abs(price - price_proposed) / price * 100.0 + 0.5) AS BIGINT)
    AS STRING), '% exceeds threshold') WHEN price_proposed <= 0 THEN 'Price is zero or negative' ELSE 'None' END AS
    reason FROM offers JOIN products USING (product_id)) WHERE reason <> 'None'""",
)
def _(t):
    lines = S.read_files(t.spark, t.folder, STORED["lineitem"], "lineitem.parquet")
    offers = lines.selectExpr(*_items({n: OFFER[n] for n in ("offer_id", "product_id", "price_proposed")}))
    alerts = S.anomalies(offers, t.products)
    return S.append_to_files(alerts.select("offer_id", "reason"), "anomalies")


_PAID = """SELECT o.event_id AS offer_id, p.event_id AS payment_id FROM events o JOIN events p ON o.user_id = p.user_id
    AND o.event_type = 'signup' AND p.event_type = 'purchase' AND p.ts >= o.ts AND p.ts <= o.ts + INTERVAL 24 HOUR"""


@query(
    "stream_expiry",
    f"""SELECT offer_id, payment_id, 'PAYEE' AS status FROM ({_PAID}) UNION ALL
    SELECT event_id, NULL, 'EXPIREE' FROM events WHERE event_type = 'signup' AND event_id NOT IN (SELECT offer_id FROM ({_PAID}))""",
)
def _(t):
    end = S.Closing(t.spark, "expiry")
    offers = end.attach(kind(t, "signup", "offer_id"), buyer_id=-1)
    payments = end.attach(kind(t, "purchase", "payment_id"), buyer_id=-2)
    rows = S.append_to_files(S.expiry(offers, payments), "expiry", [None, end.close])
    return rows.select("offer_id", "payment_id", "status")


@query(
    "stream_severity",
    """SELECT strftime(cast(ts AS DATE), '%Y-%m-%d 00:00') AS window_start, severity, count(*) AS n FROM audits
    GROUP BY 1, 2""",
)
def _(t):
    audits = events(t).selectExpr(*_items({n: AUDIT[n] for n in ("ts", "severity")}))
    rows = S.latest_results(S.severity_counts(audits), "severity", ["window_start", "severity"])
    return rows.select(minute("window_start"), "severity", "n")


@query(
    "late_rows",
    "SELECT event_id, ts < (SELECT max(ts) FROM events) - INTERVAL 10 DAY AS is_late FROM events",
)
def _(t):
    return S.late_rows(t.events, "10 DAYS").select("event_id", "is_late")


# Four arrivals: every fourth event, so that all but the first hold rows behind the time reached.
@query(
    "stream_late_split",
    """WITH m AS (SELECT event_id % 4 AS part, max(ts) AS reached FROM events GROUP BY 1)
    SELECT event_id, coalesce(ts < (SELECT max(reached) FROM m WHERE part < event_id % 4) - INTERVAL 10 DAY, false) AS is_late FROM events""",
)
def _(t):
    rows, parts = arrivals(t.events, "late", mixed=True)
    return S.late_split(rows, "10 DAYS", "late", arrivals=parts).select("event_id", "is_late")


@query(
    "stream_offer_to_deal",
    """SELECT o.event_id AS offer_id, p.event_id AS deal_id FROM events o JOIN events p ON o.user_id = p.user_id
    AND o.event_type = 'signup' AND p.event_type = 'purchase' AND p.ts >= o.ts AND p.ts < o.ts + INTERVAL 3 DAY""",
)
def _(t):
    rows = S.offer_to_deal(kind(t, "signup", "offer_id"), kind(t, "purchase", "deal_id"))
    return S.append_to_files(rows.select("offer_id", "deal_id"), "deals")


@query("stream_upsert", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def _(t):
    rows, parts = arrivals(t.events.select("user_id", "event_id", "ts"), "upsert")
    return S.upsert_sink(rows, "user_id", ["ts", "event_id"], "upsert", parts).select("user_id", "event_id")
