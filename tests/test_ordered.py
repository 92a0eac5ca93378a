"""Running values of prefix scans against plain pandas, with a hot key and missing keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from offerwell.operators import dedup as E
from offerwell.operators import ordered as R
from offerwell.operators.windows import stagnation_bonus


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 600
    key = np.where(rng.random(n) < 0.4, 1, rng.integers(2, 9, n)).astype(float)
    key[rng.random(n) < 0.1] = np.nan
    pdf = pd.DataFrame({"i": np.arange(n), "k": key, "t": rng.permutation(n), "v": rng.integers(0, 9, n).astype(float)})
    pdf.loc[rng.random(n) < 0.2, "v"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "i long, k double, t long, v double")
    return pdf, df


def by_i(df, col):
    return {r["i"]: r[col] for r in df.select("i", col).collect()}


def test_running_sums(rows):
    pdf, df = rows
    got = by_i(R.scan(df, ["k"], ["t"], sums={"s": F.col("v"), "n": F.lit(1)}), "s")
    ordered = pdf.sort_values("t")
    want = ordered.v.fillna(0).groupby(ordered.k, dropna=False).cumsum()
    assert got == dict(zip(ordered.i, want))


def test_last_and_previous(rows):
    pdf, df = rows
    ordered = pdf.sort_values("t")
    last = by_i(R.scan(df, ["k"], ["t"], last={"x": F.col("v")}), "x")
    want = ordered.groupby("k", dropna=False).v.ffill()
    assert last == {i: (None if pd.isna(v) else v) for i, v in zip(ordered.i, want)}
    before = by_i(R.scan(df, ["k"], ["t"], previous={"x": F.col("v")}), "x")
    want = ordered.groupby("k", dropna=False).v.shift()
    assert before == {i: (None if pd.isna(v) else v) for i, v in zip(ordered.i, want)}


def test_number_rows(rows):
    _, df = rows
    got = by_i(R.number_rows(df, ["t"], "no"), "no")
    t = by_i(df, "t")
    assert all(got[i] == t[i] + 1 for i in got)


def test_exact_quantiles(rows):
    pdf, df = rows
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = R.exact_quantiles(df, ["k"], "v", probs).collect()
    for r in got:
        part = pdf[pdf.k.isna() if r["k"] is None else pdf.k == r["k"]].v.dropna()
        assert r["n"] == len(part)
        np.testing.assert_allclose([r[f"q{j}"] for j in range(5)], part.quantile(probs))
    whole = R.exact_quantiles(df, [], "v", [0.5]).first()
    assert whole["q0"] == pdf.v.median()


def test_flag_duplicates_is_independent_of_row_order(spark):
    data = [("a", None, 1), ("a", None, 2), ("a", 1.0, 3), (None, 1.0, 4), (None, 1.0, 5), ("b", 2.0, 6)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "title string, p double, i int").repartition(3)
        flags = by_i(E.flag_duplicates(df, ["title", "p"], ["i"]), "is_duplicate")
        assert flags == {1: False, 2: True, 3: False, 4: False, 5: True, 6: False}
        assert E.keep_first(df, ["title", "p"], ["i"]).count() == 4


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS k", "id AS i")
    plan = E.keep_first(df, ["k"], ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_stagnation_run_compares_with_the_last_bid(spark):
    # A slow drift is no run: each step is below 0.01 but the run ends once the distance to the last bid reaches it.
    bids = [10.0, 10.006, 10.012, 10.018, 10.018]
    df = spark.createDataFrame([(1, i, i, b) for i, b in enumerate(bids)], "negotiation int, ts int, event_id int, bid double")
    row = stagnation_bonus(df).first()
    assert row["run_length"] == 3 and abs(row["bonus"] - 0.05) < 1e-12


def test_french_title_order(spark):
    from offerwell.operators.ranking import sort_title_fr

    titles = ["Zèbre", "étui", "Eau", "écran", None, "abri"]
    rows = sort_title_fr(spark.createDataFrame([(t,) for t in titles], "title string")).collect()
    assert [r["title"] for r in rows] == [None, "abri", "Eau", "écran", "étui", "Zèbre"]


def test_quantiles_of_a_heavy_tail(spark):
    values = [float(i % 300) / 100 for i in range(6_000)] + [10.0**k for k in range(3, 9)] + [-0.0, 0.0, -1e-300, -7.5, -1e300]
    df = spark.createDataFrame([(1, v) for v in values], "k int, x double")
    got = R.exact_quantiles(df, ["k"], "x", [0.0, 0.25, 0.5, 0.99, 1.0]).first()
    assert [got[f"q{i}"] for i in range(5)] == pytest.approx(list(np.quantile(values, [0.0, 0.25, 0.5, 0.99, 1.0])))


def test_many_columns_in_one_selection(spark, monkeypatch):
    from offerwell.operators import features

    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({c: np.where(rng.random(500) < 0.3, np.nan, rng.normal(0, 10.0**k, 500)) for k, c in enumerate("abcd")})
    pdf["e"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, d double, e double")
    got = {r["column"]: r for r in R.column_quantiles(df, [], list("abcde"), [0.1, 0.5]).collect()}
    assert set(got) == set("abcd")
    for c in "abcd":
        assert [got[c]["q0"], got[c]["q1"]] == pytest.approx(pdf[c].quantile([0.1, 0.5]).tolist())
    written = []
    monkeypatch.setattr(R, "cut_lineage", lambda d, name, cut=R.cut_lineage: written.append(name) or cut(d, name))
    for columns in ("a", "abcd"):
        written.clear()
        filled = features.impute_median(df, list(columns)).collect()
        assert written == ["numbers", *["digits"] * 5]  # the same steps for any number of columns
    assert [r["a"] for r in filled] == pytest.approx(pdf["a"].fillna(pdf["a"].median()).tolist())


def test_a_hot_key_is_dealt_evenly(spark):
    """One key holds 90 % of the rows, all of them within one hour."""
    n = 20_000
    df = spark.range(n).selectExpr(
        "id", "CASE WHEN id % 10 = 0 THEN id ELSE -1 END AS k", "timestamp_micros(1700000000000000 + (id * 7919) % 3600000000) AS ts", "id % 13 AS v"
    )
    sizes = [r["n"] for r in R.ranged(df, ["k"], ["ts", "id"]).groupBy(R.PART).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / 4  # four ranges in the tests' session
    got = R.scan(df, ["k"], ["ts", "id"], sums={"s": F.col("v")}, last={"w": F.col("v")}, previous={"p": F.col("v")})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan.split("BroadcastExchange")[0]  # rows meet by range only
    pdf = got.toPandas().sort_values(["ts", "id"])
    assert (pdf.s == pdf.groupby("k").v.cumsum()).all() and (pdf.w == pdf.v).all()
    before = pdf.groupby("k").v.shift()
    assert ((pdf.p == before) | (pdf.p.isna() & before.isna())).all()


def test_distinct_offers_of_a_long_negotiation(spark):
    rows = [(1, t, "AGENT" if t % 3 else "ACHETEUR", t % 40) for t in range(1_000)] + [(None, 5, "AGENT", 9), (2, 1, "AGENT", 0)]
    df = spark.createDataFrame(rows, "negotiation long, turn long, sender string, price long")
    got = {(r["negotiation"], r["price"]): r["position"] for r in E.distinct_agent_offers(df).collect()}
    seen = {}
    for n, t, who, p in rows:
        if who == "AGENT" and p > 0:
            seen.setdefault((n, p), t)
    order = sorted((k for k in seen if k[0] == 1), key=lambda k: -seen[k])
    assert got == {k: i + 1 for i, k in enumerate(order)} | {(None, 9): 1}


def test_stratified_split_is_exact(spark):
    from offerwell.operators.features import split

    df = spark.range(1_000).selectExpr("id", "CASE WHEN id < 30 THEN 'rare' WHEN id < 990 THEN 'often' END AS kind")
    held = split(df, ["id"], 0.2, strata=["kind"]).where("is_test").groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in held} == {"rare": 6, "often": 192, None: 2}
