"""Negotiation scoring and replay with native expressions.

A round knows the asking price (``current``), the floor (``floor_price``), the bid, its number, the number of rounds
allowed and the bids so far. The number of rounds is small by contract, so the bids so far are plain columns
``h1..hN`` and replay is a fixed chain of projections: no sort, join or Python per round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerwell import constants as K
from offerwell.functions.fuzzy import fallback_rate, num, with_concession_rate

OUTCOME = ["new_price", "concession", "outcome", "trend_label", "final"]
GAP = "try_divide(current - bid, current) * 100D"


def cents(x: str) -> str:
    return f"floor(({x}) * 100D + 0.5D) / 100D"


def behaviour(gap: str = "gap") -> str:
    return f"CASE WHEN {gap} > 30 THEN 'AGGRESSIVE' WHEN {gap} >= 10 THEN 'SERIOUS' ELSE 'CLOSE' END"


def trend_label(trend: str = "trend") -> str:
    return f"CASE WHEN {trend} > 0.05D THEN 'IMPROVING' WHEN {trend} < -0.05D THEN 'DECLINING' ELSE 'STABLE' END"


def fuzzy_inputs(rounds: DataFrame) -> DataFrame:
    """Gap percent and progress; the trend is expected as a column."""
    return rounds.selectExpr("*", f"{GAP} AS gap", "round / cast(rounds_max AS double) AS progress")


def labels(rounds: DataFrame) -> DataFrame:
    return rounds.selectExpr("*", f"{behaviour()} AS behaviour", f"{trend_label()} AS trend_label")


# Ordered guards: condition, outcome, price, concession, trend, final.
_EPS = num(K.PRICE_EPSILON)
_GUARDS = [
    ("floor_price >= current", "'INVALID_CONFIG'", "current", "0D", "'STABLE'", "true"),
    ("round > rounds_max", "'TIMEOUT'", "floor_price", "current - floor_price", "'STABLE'", "true"),
    ("bid <= 0", "'INVALID'", "current", "0D", "'STABLE'", "false"),
    (f"bid < floor_price - {_EPS}", "'AGGRESSIVE'", "floor_price", "current - floor_price", "'DECLINING'", "false"),
    (f"bid <= floor_price + {_EPS}", "'ACCEPTED_AT_FLOOR'", "floor_price", "current - floor_price", "'IMPROVING'", "true"),
    (f"current - floor_price <= {_EPS}", "'FLOOR_REACHED'", "floor_price", "0D", "'STABLE'", "true"),
    ("bid >= current", "'ACCEPTED'", "bid", "0D", "'IMPROVING'", "true"),
    ("round >= rounds_max", behaviour(f"({GAP})"), "floor_price", "current - floor_price", "'FINAL'", "true"),
]


def guard_columns(otherwise: dict[str, str] | None = None) -> list[str]:
    """Result columns of the first guard that holds; ``otherwise`` gives them when none does (default null)."""
    out = []
    for name, i in (("outcome", 1), ("new_price", 2), ("concession", 3), ("trend_label", 4), ("final", 5)):
        cases = " ".join(f"WHEN {g[0]} THEN {g[i]}" for g in _GUARDS)
        sql = f"CASE {cases} ELSE {otherwise[name] if otherwise else 'NULL'} END"
        out.append(f"{cents(sql) if i in (2, 3) else sql} AS {name}")
    return out


def guards(rounds: DataFrame) -> DataFrame:
    return rounds.selectExpr("*", *guard_columns())


def first_bids(bids: DataFrame, rounds_max: int = K.MAX_ROUNDS, markup: float = 1.2, floor_share: float = 0.6):
    """One row per negotiation: the first bids as ``h1..hN``, the opening price and the floor.

    The rank filter keeps at most N bids of a negotiation per task before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("negotiation").orderBy("ts", "event_id"))
    early = bids.withColumn("_round", rank).where(F.col("_round") <= rounds_max)
    wide = early.groupBy("negotiation").agg(
        *[F.expr(f"max(bid) FILTER (WHERE _round = {i}) AS h{i}") for i in range(1, rounds_max + 1)]
    )
    ask = bids.groupBy("negotiation").agg((F.max("bid") * markup).alias("current"))
    return wide.join(ask, "negotiation").withColumn("floor_price", F.col("current") * floor_share)


def round_rows(opening: DataFrame, rounds_max: int = K.MAX_ROUNDS) -> DataFrame:
    """Long form of ``first_bids``: one row per round, bids after the round are null."""
    names = [f"h{i}" for i in range(1, rounds_max + 1)]
    rows = opening.selectExpr("*", f"posexplode(array({', '.join(names)})) AS (_pos, bid)").where("bid IS NOT NULL")
    others = [c for c in opening.columns if c not in names]
    return rows.selectExpr(
        *others,
        "bid",
        "_pos + 1 AS round",
        f"{rounds_max} AS rounds_max",
        *[f"CASE WHEN _pos + 1 >= {i} THEN {n} END AS {n}" for i, n in enumerate(names, 1)],
    )


def _history(bids: Sequence[str]) -> list[str]:
    """Trend, cooperation score and stagnation bonus of the bids so far (null after the round)."""
    steps = [
        f"CASE WHEN {b} - {a} > current * 0.001D THEN 5 WHEN abs({b} - {a}) <= current * 0.001D THEN -2 "
        f"WHEN {b} - {a} IS NOT NULL THEN -4 ELSE 0 END"
        for a, b in zip(bids, bids[1:])
    ]
    points = " + ".join(f"({s})" for s in steps) or "0"
    before = " ".join(f"WHEN round = {i + 1} THEN {bids[i - 1]}" for i in range(1, len(bids)))
    previous = f"CASE {before} END" if before else "cast(NULL AS double)"
    differing = ", ".join(f"if(abs({b} - bid) >= 0.01D, {i}, 0)" for i, b in enumerate(bids, 1))
    run = f"(round - greatest(0, {differing}))"
    return [
        f"greatest(-1D, least(1D, coalesce(try_divide(bid - ({previous}), current), 0D))) AS trend",
        f"greatest(-0.15D, least(0.15D, ({points}) / 100D)) AS _coop",
        f"CASE WHEN {run} >= 3 THEN least(0.20D, ({run} - 2) * 0.05D) ELSE 0D END AS _stall",
    ]


def counter_offer(rows: DataFrame, bids: Sequence[str]) -> DataFrame:
    """Add the outcome columns of one round.

    Reads ``current``, ``floor_price``, ``bid``, ``round``, ``rounds_max`` and the bids so far.
    """
    kept = rows.columns
    rows = rows.selectExpr("*", *_history(bids), f"{GAP} AS gap", "round / cast(rounds_max AS double) AS progress")
    rows = with_concession_rate(rows, "_fuzzy")
    rate = f"greatest(0.01D, least(0.5D, coalesce(_fuzzy, {fallback_rate()}) + _coop + _stall))"
    rows = rows.selectExpr("*", f"current - {rate} * (current - floor_price) AS _candidate")
    met = "CASE WHEN _candidate <= bid THEN (current + bid) / 2D ELSE _candidate END"
    rows = rows.selectExpr("*", f"least(current, greatest(floor_price, bid, {met})) AS _price")
    normal = {
        "outcome": behaviour(),
        "new_price": "_price",
        "concession": "current - _price",
        "trend_label": trend_label(),
        "final": "_price >= current",
    }
    return rows.selectExpr(*kept, *guard_columns(normal))


def counter_price(rounds: DataFrame, rounds_max: int = K.MAX_ROUNDS) -> DataFrame:
    """Counter offer of every round, each against the opening price."""
    return counter_offer(rounds, [f"h{i}" for i in range(1, rounds_max + 1)])


def negotiation_params(negotiations: DataFrame) -> DataFrame:
    """Floor price, next round and round cap sent with a bid."""
    return negotiations.selectExpr(
        "*",
        "coalesce(nullif(initial_price, 0D), final_price) * 0.6D AS floor_price",
        "coalesce(rounds, 0) + 1 AS next_round",
        f"{K.MAX_ROUNDS} AS rounds_max",
    )


def replay(opening: DataFrame, rounds_max: int = K.MAX_ROUNDS) -> DataFrame:
    """Play every bid in order: the price of a round is the asking price of the next, a final round ends it.

    One row per played round: price, outcome, final flag.
    """
    bids = [f"h{i}" for i in range(1, rounds_max + 1)]
    state = ["negotiation", "floor_price", *bids]
    rows = opening.selectExpr(*state, "current", "false AS ended")
    played = []
    for k, bid in enumerate(bids, 1):
        rows = rows.selectExpr("*", f"{bid} AS bid", f"{k} AS round", f"{rounds_max} AS rounds_max")
        rows = counter_offer(rows, bids[:k])
        active = f"(NOT ended AND {bid} IS NOT NULL)"
        step = (
            f"CASE WHEN {active} THEN named_struct('round', {k}, 'bid', bid, 'price', new_price, 'outcome', outcome, "
            f"'final', final) END AS _round_{k}"
        )
        rows = rows.selectExpr(
            *state,
            *played,
            step,
            f"CASE WHEN {active} THEN new_price ELSE current END AS current",
            f"ended OR ({active} AND final) AS ended",
        )
        played.append(f"_round_{k}")
    return rows.selectExpr("negotiation", f"inline(array_compact(array({', '.join(played)})))")
