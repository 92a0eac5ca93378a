"""Closed-form concession rate against the sampled output set, guards and replay."""

import numpy as np
import pandas as pd

from offerwell import constants as K
from offerwell.functions.fuzzy import with_concession_rate
from offerwell.operators import negotiation as N


def trapezoid(x, corners):
    a, b, c, d = corners
    up = np.ones_like(x) if b == a else (x - a) / (b - a)
    down = np.ones_like(x) if d == c else (d - x) / (d - c)
    return np.where((x < a) | (x > d), 0.0, np.clip(np.minimum(up, down), 0.0, 1.0))


def sampled_rate(gap, progress, trend):
    value = {"gap": gap, "progress": progress, "trend": trend}
    act = dict.fromkeys(K.FUZZY_OUTPUTS, 0.0)
    for conditions, term in K.FUZZY_RULES:
        fire = min(float(trapezoid(np.array(value[v]), K.FUZZY_INPUTS[(v, t)])) for v, t in conditions)
        act[term] = max(act[term], fire)
    grid = np.arange(501.0)
    height = np.max([np.minimum(act[t], trapezoid(grid, c)) for t, c in K.FUZZY_OUTPUTS.items()], axis=0)
    return K.DEFAULT_RATE if max(act.values()) <= 0 else float((grid / 1000 * height).sum() / height.sum())


def test_closed_form_equals_the_grid(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(
        {"gap": rng.uniform(-5, 105, 400), "progress": rng.uniform(0, 1.1, 400), "trend": rng.uniform(-0.3, 0.3, 400)}
    )
    pdf.loc[0] = [105.0, 0.55, 0.0]
    got = with_concession_rate(spark.createDataFrame(pdf)).toPandas()
    want = [sampled_rate(*r) for r in got[["gap", "progress", "trend"]].itertuples(index=False)]
    np.testing.assert_allclose(got.rate, want, rtol=0, atol=1e-9)


def play(spark, current, floor_price, bids):
    row = (1, current, floor_price, *[bids[i] if i < len(bids) else None for i in range(5)])
    names = "negotiation int, current double, floor_price double, " + ", ".join(f"h{i} double" for i in range(1, 6))
    return [r.asDict() for r in N.replay(spark.createDataFrame([row], names)).orderBy("round").collect()]


def test_guards_in_order(spark):
    rows = [
        (50.0, 60.0, 55.0, 1, "INVALID_CONFIG", True), (100.0, 60.0, 55.0, 6, "TIMEOUT", True),
        (100.0, 60.0, 0.0, 1, "INVALID", False), (100.0, 60.0, 59.9, 1, "AGGRESSIVE", False),
        (100.0, 60.0, 60.03, 1, "ACCEPTED_AT_FLOOR", True), (60.04, 60.0, 80.0, 1, "FLOOR_REACHED", True),
        (100.0, 60.0, 100.0, 1, "ACCEPTED", True), (100.0, 60.0, 95.0, 5, "CLOSE", True),
        (100.0, 60.0, 80.0, 1, None, None),
    ]
    schema = "current double, floor_price double, bid double, round int, want string, want_final boolean"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "5 AS rounds_max")
    for r in N.guards(df).collect():
        assert (r["outcome"], r["final"]) == (r["want"], r["want_final"])


def test_replay_carries_the_price(spark):
    rounds = play(spark, 100.0, 60.0, [70.0, 75.0, 80.0])
    assert [r["round"] for r in rounds] == [1, 2, 3]
    prices = [100.0] + [r["price"] for r in rounds]
    assert all(a > b for a, b in zip(prices, prices[1:]))
    assert all(r["price"] >= r["bid"] for r in rounds)


def test_bid_below_the_floor_ends_the_next_round(spark):
    rounds = play(spark, 100.0, 60.0, [50.0, 80.0, 90.0])
    assert [(r["outcome"], r["final"]) for r in rounds] == [("AGGRESSIVE", False), ("INVALID_CONFIG", True)]


def test_last_round_is_final(spark):
    rounds = play(spark, 100.0, 60.0, [61.0, 62.0, 63.0, 64.0, 65.0])
    assert rounds[-1]["final"] and rounds[-1]["price"] == 60.0
