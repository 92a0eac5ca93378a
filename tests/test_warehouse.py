"""Dimensions and facts: results, how often the rows are read and what is carried with them."""

import datetime

import pytest
from pyspark.sql import functions as F

from offerwell.operators import ordered as R
from offerwell.operators import warehouse as L

CITIES = [("Fes", "AFRICA", "Maroc"), ("Lyon", "EUROPE", "France"), ("Pune", "ASIA", "Maroc")]


@pytest.fixture(scope="module")
def listings(spark):
    rows = []
    for i in range(240):
        city, region, country = CITIES[i % 3]
        category = [None, "Audio", "Smartphones"][i % 5 % 3]
        rows.append((f"l{i % 90}", f"title {i % 90}", f"s{i % 7}", ["Jumia", "Steam"][i % 2], ["MAD", "EUR"][i % 2], category, city, region, country))
    return spark.createDataFrame(rows, "link string, title string, seller string, source string, currency string, category string, location string, region string, country string")


def test_numbering_shuffles_the_rows_once(spark):
    rows = spark.range(500).select(F.col("id").alias("i"), (F.col("id") * 7 % 500).alias("t"))
    out = R.number_rows(rows, ["t"], "no", drop=["t"])
    assert out.columns == ["i", "no"]
    assert all(r["no"] == r["i"] * 7 % 500 + 1 for r in out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("BroadcastExchange")[0]  # the written rows are read in place


def test_numbering_of_equal_rows_and_of_none(spark):
    rows = spark.createDataFrame([(None,), ("a",), ("a",), (None,), ("b",)], "t string")
    got = sorted(((r["no"], r["t"]) for r in R.number_rows(rows, ["t"], "no").collect()))
    assert got == [(1, None), (2, None), (3, "a"), (4, "a"), (5, "b")]
    assert R.number_rows(rows.where("t = 'z'"), ["t"], "no").count() == 0


def test_snowflake_reads_the_rows_twice(spark, listings):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    dims = L.snowflake(listings.mapInArrow(count, listings.schema))
    got = {n: d.collect() for n, d in dims.items()}
    assert read.value == 2 * 240
    assert {n: len(r) for n, r in got.items()} == {
        "super_category": len({r["super_category"] for r in got["super_category"]}), "country": 2, "source": 2, "currency": 2, "category": 3, "region": 3,
        "location": 3, "seller": 14, "product": 90,
    }
    assert sorted(r["product_id"] for r in got["product"]) == list(range(1, 91))
    by_currency = {r["currency_id"]: r["currency"] for r in got["currency"]}
    want = {r["link"]: r["c"] for r in listings.groupBy("link").agg(F.min("currency").alias("c")).collect()}
    assert {r["link"]: by_currency[r["currency_id"]] for r in got["product"]} == want


def test_fact_carries_numbers_to_the_product_lookup(spark, listings, monkeypatch):
    rows = listings.selectExpr(
        "*", "title AS title_clean", "DATE '2024-01-05' AS day", "1.0D AS price_initial", "0.5D AS price_offre", "50.0D AS discount_pct", "4.0D AS rating", "'' AS offre_type"
    )
    written, order = {}, []
    cut, lookup = L.cut_lineage, L.star_lookup
    monkeypatch.setattr(L, "cut_lineage", lambda df, name: written.update({name: df.columns}) or cut(df, name))
    monkeypatch.setattr(L, "star_lookup", lambda fact, dims: order.extend(dims) or lookup(fact, dims))
    dims = L.star_dims(rows)
    got = L.load_fact_listing(rows, dims)
    assert "link" not in written["natural-keys"] and order[-1] == "product"
    assert got.columns[:5] == ["product_id", "source_id", "seller_id", "category_id", "location_id"]
    names = {n: {r[f"{n}_id"]: r[0] for r in d.collect()} for n, (d, _, _) in dims.items()}
    shown = sorted((names["product"][r[0]], names["source"][r[1]], names["seller"][r[2]], str(names["category"][r[3]]), names["location"][r[4]]) for r in got.collect())
    assert shown == sorted((r["link"], r["source"], r["seller"], str(r["category"]), r["location"]) for r in rows.collect())


def test_offer_kpis_join_carries_no_texts(spark, monkeypatch):
    day = datetime.date(2024, 1, 1)
    rows = [("a", "VALIDEE", day, 10.0, 5.0, False), ("a", "VALIDEE", day, 10.0, 5.0, False), ("b", "EN_ATTENTE", day, -4.0, 7.5, True),
            (None, "EN_ATTENTE", day, None, None, None), ("c", None, None, 2.0, 1.0, True)]
    offers = spark.createDataFrame(rows, "offer_id string, status string, created date, gap_pct double, total_value double, is_suspect boolean")
    tx = spark.createDataFrame([("a", datetime.date(2024, 1, 5)), ("a", datetime.date(2024, 1, 3)), (None, day)], "offer_id string, done date")
    plans, attach = [], L.attach_one
    monkeypatch.setattr(L, "attach_one", lambda df, one: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or attach(df, one))
    got = L.offer_kpis(offers, tx, spark.createDataFrame([(2,), (5,)], "rounds int")).collect()
    assert [tuple(r) for r in got] == [(7, 0.5714, 3.0, 6.3333, 2, 7.5, 0.5714, 3.5)]
    above = plans[0].split("Join")[0]
    assert "status" not in above and "total_value" not in above


def test_offer_kpis_ids_are_sixteen_bytes(spark, monkeypatch):
    from offerwell.plans import warehouse as plans
    from offerwell.plans.registry import QUERIES
    from offerwell.sources.views import Tables

    seen = []
    monkeypatch.setattr(plans.L, "offer_kpis", lambda offers, tx, rounds: seen.extend([offers, tx]))
    QUERIES["offer_kpis"](Tables(spark, "/root/testdata/sf0.001"))
    for rows in seen:
        assert rows.schema["offer_id"].dataType.typeName() == "binary"
        assert rows.select(F.max(F.length("offer_id"))).first()[0] == 16
