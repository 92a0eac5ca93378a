"""Negotiation scoring and replay queries over the bids.

The check samples the fuzzy output set on its 501 grid points; the library uses the closed form of the same sums.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from offerwell import constants as K
from offerwell.functions.fuzzy import activations, fallback_rate, membership, with_concession_rate
from offerwell.functions.numbers import half_up
from offerwell.operators import negotiation as N
from offerwell.operators import windows as W
from offerwell.plans.marketplace import ROUNDS_SQL, TREND_SQL
from offerwell.plans.registry import query, r2, r4


def trapezoid(x: str, corners) -> str:
    a, b, c, d = (f"{float(v)!r}e0" for v in corners)  # exponents make the literals doubles
    up = f"WHEN {x} < {b} THEN ({x} - ({a})) / ({b} - ({a})) " if corners[1] > corners[0] else ""
    down = f"WHEN {x} > {c} THEN (({d}) - {x}) / ({d} - ({c})) " if corners[3] > corners[2] else ""
    return f"CASE WHEN {x} < {a} OR {x} > {d} THEN 0.0 {up}{down}ELSE 1.0 END"


def act_sql() -> dict[str, str]:
    fired: dict[str, list[str]] = {}
    for conditions, term in K.FUZZY_RULES:
        fired.setdefault(term, []).append(
            "least(" + ", ".join(trapezoid(var, K.FUZZY_INPUTS[(var, t)]) for var, t in conditions) + ")"
        )
    return {term: "greatest(" + ", ".join(fired[term]) + ")" for term in K.FUZZY_OUTPUTS}


_ACTS = ", ".join(f"{c} AS act_{t}" for t, c in act_sql().items())
_HEIGHT = (
    "greatest("
    + ", ".join(f"least(act_{t}, {trapezoid('g.i', corners)})" for t, corners in K.FUZZY_OUTPUTS.items())
    + ")"
)
RATE = f"""CASE WHEN greatest({', '.join(f'act_{t}' for t in K.FUZZY_OUTPUTS)}) <= 0 THEN {K.DEFAULT_RATE} ELSE
    (SELECT sum(g.i / 1000.0 * ({_HEIGHT})) / sum({_HEIGHT}) FROM range(501) g(i)) END"""
INPUTS = f"""SELECT event_id, negotiation, bid, current, round, (current - bid) / current * 100.0 AS gap,
    round / rounds_max::DOUBLE AS progress, {TREND_SQL} AS trend FROM ({ROUNDS_SQL})"""


def inputs(t):
    return N.fuzzy_inputs(W.offer_trend(W.bid_rounds(t.bids)))


def four(rows, *names):
    return rows.select("event_id", *[half_up(F.col(n), 4).alias(n) for n in names])


_GUARDS = """CASE WHEN floor_price >= current THEN {0} WHEN round > 5 THEN {1} WHEN bid <= 0 THEN {2}
    WHEN bid < floor_price - 0.05 THEN {3} WHEN bid <= floor_price + 0.05 THEN {4}
    WHEN current - floor_price <= 0.05 THEN {5} WHEN bid >= current THEN {6} WHEN round >= 5 THEN {7} {8} END"""
_BEH = "CASE WHEN {g} > 30 THEN 'AGGRESSIVE' WHEN {g} >= 10 THEN 'SERIOUS' ELSE 'CLOSE' END"
_TRL = "CASE WHEN trend > 0.05 THEN 'IMPROVING' WHEN trend < -0.05 THEN 'DECLINING' ELSE 'STABLE' END"
_GAP = "((current - bid) / current * 100.0)"


def outcome_sql(extra: str = "") -> str:
    return _GUARDS.format(
        "'INVALID_CONFIG'", "'TIMEOUT'", "'INVALID'", "'AGGRESSIVE'", "'ACCEPTED_AT_FLOOR'", "'FLOOR_REACHED'",
        "'ACCEPTED'", _BEH.format(g=_GAP), extra,
    )


def price_sql(extra: str = "") -> str:
    low = "floor_price"
    return _GUARDS.format("current", low, "current", low, low, low, "bid", low, extra)


def given_sql(extra: str = "") -> str:
    gave = "current - floor_price"
    return _GUARDS.format("0.0", gave, "0.0", gave, gave, "0.0", "0.0", gave, extra)


def trend_sql(extra: str = "") -> str:
    return _GUARDS.format(
        "'STABLE'", "'STABLE'", "'STABLE'", "'DECLINING'", "'IMPROVING'", "'STABLE'", "'IMPROVING'", "'FINAL'", extra
    )


def final_sql(extra: str = "") -> str:
    return _GUARDS.format("true", "true", "false", "false", "true", "true", "true", "true", extra)


@query(
    "guards",
    f"""SELECT event_id, {outcome_sql()} AS outcome, {r2(price_sql())} AS new_price, {r2(given_sql())} AS concession,
    {trend_sql()} AS trend_label, {final_sql()} AS final FROM ({ROUNDS_SQL})""",
)
def _(t):
    rows = N.guards(W.bid_rounds(t.bids).withColumn("rounds_max", F.lit(K.MAX_ROUNDS)))
    return rows.select("event_id", "outcome", "new_price", "concession", "trend_label", "final")


@query(
    "fuzzy_inputs",
    f"SELECT event_id, {r4('gap')} AS gap, {r4('progress')} AS progress, {r4('trend')} AS trend FROM ({INPUTS})",
)
def _(t):
    return four(inputs(t), "gap", "progress", "trend")


@query("negotiation_labels", f"SELECT event_id, {_BEH.format(g='gap')} AS behaviour, {_TRL} AS trend_label FROM ({INPUTS})")
def _(t):
    return N.labels(inputs(t)).select("event_id", "behaviour", "trend_label")


@query(
    "membership",
    "SELECT event_id, "
    + ", ".join(f"{r4(trapezoid(v, c))} AS {v}_{t}" for (v, t), c in K.FUZZY_INPUTS.items())
    + f" FROM ({INPUTS})",
)
def _(t):
    return inputs(t).select(
        "event_id",
        *[half_up(F.expr(membership(v, c)), 4).alias(f"{v}_{n}") for (v, n), c in K.FUZZY_INPUTS.items()],
    )


@query(
    "rule_activation",
    "SELECT event_id, " + ", ".join(f'{r4(c)} AS "{t}"' for t, c in act_sql().items()) + f" FROM ({INPUTS})",
)
def _(t):
    return inputs(t).select("event_id", *[half_up(F.expr(c), 4).alias(n) for n, c in activations().items()])


@query("defuzzify", f"SELECT event_id, {r4(RATE)} AS rate FROM (SELECT *, {_ACTS} FROM ({INPUTS})) x")
def _(t):
    return four(with_concession_rate(inputs(t)), "rate")


@query(
    "fallback_rate",
    f"""SELECT event_id, {r4('CASE WHEN progress > 0.7 THEN least(0.5, r + 0.1) ELSE r END')} AS rate FROM (SELECT *,
    CASE WHEN gap > 45 THEN 0.02 WHEN gap > 30 THEN 0.06 WHEN gap > 15 THEN 0.18 WHEN gap > 5 THEN 0.32 ELSE 0.45 END
    AS r FROM ({INPUTS}))""",
)
def _(t):
    return four(inputs(t).selectExpr("event_id", f"{fallback_rate()} AS rate"), "rate")


@query(
    "negotiation_params",
    f"""SELECT negotiation, {r2('coalesce(nullif(first_price, 0), last_price) * 0.6')} AS floor_price,
    rounds + 1 AS next_round, 5 AS rounds_max FROM (SELECT negotiation, min(price) AS first_price, max(price) AS
    last_price, count(*) FILTER (sender = 'ACHETEUR') AS rounds FROM messages GROUP BY 1)""",
)
def _(t):
    nego = t.messages.groupBy("negotiation").agg(
        F.min("price").cast("double").alias("initial_price"),
        F.max("price").cast("double").alias("final_price"),
        F.count_if(F.col("sender") == "ACHETEUR").alias("rounds"),
    )
    rows = N.negotiation_params(nego)
    return rows.select("negotiation", half_up(F.col("floor_price")).alias("floor_price"), "next_round", "rounds_max")


# Bids scaled so that they fall on both sides of the floor, most of them above it.
def scaled_bids(t):
    return t.bids.withColumn("bid", F.col("bid") * 0.2 + 90.0 + F.col("event_id") % 7)


_SCALED = "SELECT negotiation, event_id, ts, bid * 0.2 + 90.0 + event_id % 7 AS bid FROM bids"
_WIDE = f"""SELECT *, current * 0.6 AS floor_price FROM (SELECT negotiation, max(all_max) * 1.2 AS current,
    {', '.join(f'max(bid) FILTER (rn = {i}) AS h{i}' for i in range(1, 6))} FROM (SELECT *, max(bid) OVER (PARTITION BY
    negotiation) AS all_max, row_number() OVER (PARTITION BY negotiation ORDER BY ts, event_id) AS rn FROM ({_SCALED}))
    GROUP BY 1)"""


def round_sql(source: str, k: str, bids: list[str]) -> str:
    """SELECT adding the counter offer of one round to ``source`` (columns current, bid, floor_price, bids)."""
    step = " + ".join(
        f"(CASE WHEN {b} - {a} > current * 0.001 THEN 5 WHEN abs({b} - {a}) <= current * 0.001 THEN -2 "
        f"WHEN {b} IS NOT NULL THEN -4 ELSE 0 END)"
        for a, b in zip(bids, bids[1:])
    ) or "0"
    last = " ".join(f"WHEN {k} = {i + 1} THEN {bids[i - 1]}" for i in range(1, len(bids)))
    prev = f"CASE {last} END" if last else "NULL::DOUBLE"
    differ = ", ".join(f"CASE WHEN abs({b} - bid) >= 0.01 THEN {i} ELSE 0 END" for i, b in enumerate(bids, 1))
    acts = ", ".join(f"{c} AS act_{t}" for t, c in act_sql().items())
    return f"""SELECT * EXCLUDE (act_none, act_weak, act_normal, act_strong), {outcome_sql('ELSE ' + _BEH.format(g='gap'))} AS outcome,
      {r2(price_sql('ELSE price'))} AS new_price, {r2(given_sql('ELSE current - price'))} AS concession,
      {trend_sql('ELSE ' + _TRL)} AS trend_label, {final_sql('ELSE price >= current')} AS final FROM (
      SELECT *, least(current, greatest(floor_price, bid, CASE WHEN cand <= bid THEN (current + bid) / 2.0 ELSE cand
        END)) AS price FROM (
      SELECT *, current - greatest(0.01, least(0.5, {RATE} + coop + stall)) * (current - floor_price) AS cand FROM (
      SELECT *, {acts} FROM (
      SELECT *, {k} AS round, (current - bid) / current * 100.0 AS gap, {k} / 5.0 AS progress,
        greatest(-1.0, least(1.0, coalesce((bid - ({prev})) / current, 0.0))) AS trend,
        greatest(-0.15, least(0.15, ({step}) / 100.0)) AS coop,
        CASE WHEN {k} - greatest({differ}) >= 3 THEN least(0.20, ({k} - greatest({differ}) - 2) * 0.05) ELSE 0.0 END
        AS stall FROM ({source}) WHERE bid IS NOT NULL)) x))"""


_LONG = f"""SELECT * EXCLUDE (h1, h2, h3, h4, h5), {', '.join(f'CASE WHEN rnd >= {i} THEN h{i} END AS h{i}' for i in range(1, 6))}
    FROM (SELECT *, CASE rnd WHEN 1 THEN h1 WHEN 2 THEN h2 WHEN 3 THEN h3 WHEN 4 THEN h4 ELSE h5 END AS bid
    FROM ({_WIDE}) CROSS JOIN (SELECT i AS rnd FROM range(1, 6) r(i)))"""


@query(
    "counter_price",
    f"""SELECT negotiation, round, new_price, concession, outcome, trend_label, final FROM
    ({round_sql(_LONG, 'rnd', ['h1', 'h2', 'h3', 'h4', 'h5'])})""",
)
def _(t):
    rows = N.counter_price(N.round_rows(N.first_bids(scaled_bids(t))))
    return rows.select("negotiation", "round", "new_price", "concession", "outcome", "trend_label", "final")


def _replay_sql() -> str:
    parts = [f"r0 AS (SELECT negotiation, current, floor_price, h1, h2, h3, h4, h5 FROM ({_WIDE}))"]
    for k in range(1, 6):
        source = f"SELECT *, h{k} AS bid FROM r{k - 1}" + ("" if k == 1 else " WHERE NOT final")
        if k > 1:
            source = (
                f"SELECT negotiation, new_price AS current, floor_price, h1, h2, h3, h4, h5, h{k} AS bid FROM r{k - 1} "
                "WHERE NOT final"
            )
        parts.append(f"r{k} AS ({round_sql(source, str(k), [f'h{i}' for i in range(1, k + 1)])})")
    union = " UNION ALL ".join(
        f"SELECT negotiation, round, bid, new_price AS price, outcome, final FROM r{k}" for k in range(1, 6)
    )
    return f"WITH {', '.join(parts)} {union}"


@query("replay", _replay_sql())
def _(t):
    return N.replay(N.first_bids(scaled_bids(t)))


@query(
    "round2",
    f"SELECT l_orderkey, {r2('l_extendedprice*(1-l_discount)*(1+l_tax)')} AS charged FROM lineitem",
)
def _(t):
    charged = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return t.lineitem.select("l_orderkey", half_up(charged).alias("charged"))
