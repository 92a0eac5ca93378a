"""Golden rows of the parsers and formulas."""

import pytest
from pyspark.sql import functions as F

from offerwell.functions import offers as O
from offerwell.functions import text as T
from offerwell.functions.numbers import clip, discount_pct, half_up
from offerwell.operators import pricing as P


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, price",
    [
        ("95,66 €", 95.66), ("1 715,06 €", 1715.06), ("1 715,06 €", 1715.06), ("1 500 DH", 1500.0),
        ("9 727 DH / mois DH", 9727.0), ("", None), (None, None), ("1.299,00", None), ("gratuit", None),
    ],
)
def test_parse_price(spark, text, price):
    assert one(spark, text, T.parse_price) == price


def test_price_to_float(spark):
    assert one(spark, "1.299,00 Dhs", T.price_to_float) == 1299.0
    assert one(spark, "1 299,5", T.price_to_float) == 1299.5
    assert one(spark, "Gratuit", T.parse_store_price) == 0.0
    assert one(spark, "12,99€", T.parse_store_price) == 12.99


def test_ratings(spark):
    assert one(spark, "très positives 91%", T.percent_rating) == 4.55
    assert one(spark, "width:84%", T.percent_rating) == 4.2
    assert one(spark, "84%", T.parse_rating) is None
    assert one(spark, " 4.5 ", T.parse_rating) == 4.5
    assert one(spark, "5.1", T.parse_rating) is None


def test_dates(spark):
    day = lambda v: one(spark, v, lambda c: T.parse_date(c, "2026-04-01").cast("string"))
    assert day("2026-03-29") == "2026-03-29"
    assert day("1774656000000") == "2026-03-28"
    assert day("il y a 1 heure") == "2026-04-01"
    assert day("hier") is None


def test_links_and_labels(spark):
    link = lambda v: one(spark, v, lambda c: T.canonical_link(c, "https://x.fr"))
    assert link("/gp/dp/B012345678?ref=1") == "https://x.fr/dp/B012345678"
    assert link("https://y.fr/a.html?x=1#z") == "https://y.fr/a.html"
    assert one(spark, "abcdef", lambda c: T.short_label(c, 5)) == "abcd…"
    assert one(spark, "4.2", lambda c: F.struct(*T.star_parts(c).values())) == (4, 0, 1)


def test_row_id_and_currency(spark):
    key = spark.range(1).select(T.row_id(F.lit("amazon"), F.lit("l")).alias("y")).first()["y"]
    assert key.startswith("AMA_") and len(key) == 16
    assert one(spark, 95.66, lambda c: O.to_mad(c, F.lit("EUR")), "double") == 1037.91


def test_rounding_and_clamps_keep_missing(spark):
    assert one(spark, 2.675, half_up, "double") == 2.68
    assert one(spark, None, lambda c: clip(c, 0.0, 1.0), "double") is None
    assert one(spark, None, lambda c: discount_pct(c, F.lit(1.0)), "double") is None
    assert one(spark, 0.0, lambda c: discount_pct(c, F.lit(1.0)), "double") is None


@pytest.mark.parametrize(
    "source, badge, p0, p1, want",
    [
        ("Jumia", "-38%", None, None, ("pourcentage", 38.0, None)),
        ("Jumia", "50 DH", None, None, ("forfaite", 50.0, None)),
        ("Jumia", "Offre", 10.0, 5.0, ("forfaite", 0.0, None)),
        ("Avito", "Promo", None, None, ("forfaite", None, "Promo")),
        ("Avito", "", 10.0, 5.0, None),
        ("CDiscount", "Promo", 30.0, 20.0, ("pourcentage", 33.0, None)),
        ("Amazon", None, 30.0, 20.0, ("pourcentage", 33.33, None)),
        ("Electroplanet", None, 1000.0, 999.5, None),
        ("Steam", "-75%", None, None, ("pourcentage", 75.0, None)),
    ],
)
def test_badges(spark, source, badge, p0, p1, want):
    row = spark.createDataFrame([(source, badge, p0, p1)], "s string, b string, p0 double, p1 double")
    got = row.select(O.badge_offer_by_source(*[F.col(c) for c in ("s", "b", "p0", "p1")]).alias("o")).first()["o"]
    assert (tuple(got) if got else None) == want


def test_offer_field_shapes(spark):
    rows = [
        ('[{"type_offre": "pourcentage", "valeur_offre": "24%"}]', 24.0, "pourcentage"),
        ('{"type_offre": "forfaite", "valeur_offre": "50 DH"}', None, "forfaite"),
        ('[{"typeOffre": "forfaite", "valeurOffre": 5.0}, {"typeOffre": "Pourcentage", "valeurOffre": 12.5}]', 12.5, "forfaite"),
        ("[]", None, ""),
        (None, None, ""),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "x string").withColumn("o", O.offers_from_json(F.col("x")))
    got = df.select(O.offer_discount_pct(F.col("o")), O.first_offer_type(F.col("o"))).collect()
    assert [tuple(g) for g in got] == [r[1:] for r in rows]


@pytest.mark.parametrize(
    "source, price, rating, category, pct, offer",
    [
        ("Steam", 59.99, 3.45, "Steam Top Sellers", 42, 34.77),
        ("Steam", 1.94, 4.5, "Steam Specials", 85, 0.29),
        ("CDiscount", 111.0, None, "Téléphones & Tablettes", 25, 83.25),
        ("Amazon", 186.21, 4.0, "Smartphones", 13, 162.65),
        ("Jumia", 587.0, None, "Informatique", 25, 442.73),
    ],
)
def test_source_discount(spark, source, price, rating, category, pct, offer):
    schema = "source string, price double, rating double, category string"
    row = P.source_discount(spark.createDataFrame([(source, price, rating, category)], schema)).first()
    assert round(row["discount"]) == pct
    assert round(price * (1 - row["discount"] / 100), 2) == offer


@pytest.mark.parametrize("price, rating, want", [(800.0, 4.8, 25.1), (50.0, 2.5, 26.0), (15.0, 5.0, 16.0)])
def test_simple_discount(spark, price, rating, want):
    got = spark.range(1).select(P.simple_discount(F.lit(price), F.lit(rating)).alias("d")).first()["d"]
    assert abs(got - want) < 0.1


def test_anomaly_rules(spark):
    rows = [(50.0, 100.0), (0.0, 100.0), (100.0, 100.0), (250.0, 100.0)]
    df = P.flag_anomalies(spark.createDataFrame(rows, "price_proposed double, price double"))
    assert [r["is_suspect"] for r in df.orderBy("price_proposed").collect()] == [True, True, False, True]
    assert P.safe_alternatives(df).where("price_proposed = 50").select("alternative").orderBy("choice").collect() == [
        (85.0,), (75.0,), (60.0,)
    ]


def test_a_tiny_discount_is_zero_and_not_missing(spark):
    pct = lambda a, b: spark.range(1).select(discount_pct(F.lit(a), F.lit(b)).alias("y")).first()["y"]
    assert pct(10000.0, 9999.9) == 0.0 and pct(10.0, 10.0) is None and pct(10.0, 12.0) is None


def test_css_width_is_no_percent_rating(spark):
    assert one(spark, "width:84", lambda c: T.percent_rating(c, css=False)) is None
    assert one(spark, "width:84", T.percent_rating) == 4.2


def test_offer_label_keeps_fifty_characters(spark):
    rows = spark.createDataFrame(
        [("1", "S", "Jeux", "x" * 60, 100.0, 4.0)], "id string, source string, category string, title_clean string, "
        "price_initial double, rating double"
    ).withColumn("price_offre", F.lit(None).cast("double"))
    label = P.generate_offers(rows, 5, ["id"]).first()["product"]
    assert label == "x" * 50 + "..."


def test_accents_of_all_latin_letters(spark):
    assert one(spark, "Żółw čaj İĞüş ßéñ é Ṽ", T.strip_accents) == "Zołw caj IGus ßen e V"


def test_merged_profiles_are_near_those_of_all_rows(spark):
    from offerwell.operators import aggregates as G

    df = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN id % 3 END AS g", "id % 7 AS day", "CASE WHEN id % 11 > 0 THEN cast((id * 7919) % 30011 AS double) END AS x", "cast(NULL AS double) AS z"
    )
    merged = G.merge_profiles(G.profile_sketches(df, ["x", "z"], ["g", "day"]), ["x", "z"], ["g"])
    got = {r["g"]: r for r in G.read_profiles(merged, ["x"], ["g"]).collect()}
    pdf = df.toPandas()
    for g, r in got.items():
        x = pdf[pdf.g.isna() if g is None else pdf.g == g].x
        assert r["n"] == len(x) and abs(r["x_distinct"] - x.nunique()) <= 0.08 * x.nunique()
        for p, q in zip((0.25, 0.5, 0.75), r["x_quartiles"]):
            assert abs((x.dropna() <= q).mean() - p) <= 2 * G.PROFILE_ERROR + 1 / x.count()
