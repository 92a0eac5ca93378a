"""Page extraction and file round-trip queries.

The stored pages hold no shop markup, so the card queries read shop pages that Spark writes from every stored listing;
the link, block and profile queries and the generic cards read the stored pages themselves.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from offerwell import constants as K
from offerwell.functions.numbers import half_up
from offerwell.operators import extract as B
from offerwell.operators import quality as D
from offerwell.operators.dedup import union_all
from offerwell.operators.normalise import normalise
from offerwell.plans.listings import ORDER
from offerwell.plans.parsing import P0, P1, _BADGE_PCT, _flat, _flat_value, number
from offerwell.plans.registry import query, r2, r4
from offerwell.session import work_dir
from offerwell.sources import listings as A
from offerwell.sources.views import LISTING_ORDER

GENERIC = B.CardRules(cards=("article",), title=("h1",), source="Jumia")
NAVIGATION = B.CardRules(cards=("nav li", "li"), title=("a",), link=("a[href]@href",), source="Jumia")


@query(
    "page_cards",
    "SELECT page_id, trim(replace(regexp_extract(html, '<article><h1>([^<]*)</h1>', 1), '&amp;', '&')) AS titre FROM pages",
)
def _(t):
    return B.extract_cards(t.pages, GENERIC).select("page_id", "titre")


@query(
    "page_navigation",
    """SELECT page_id, trim(replace(a[1], '&amp;', '&')) AS title, a[2] AS link FROM (SELECT page_id, unnest(list_zip(
    regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1), regexp_extract_all(html,
    '<li><a href="([^"]*)">', 1))) AS a FROM pages)""",
)
def _(t):
    return B.card_texts(t.pages, NAVIGATION).select("page_id", "title", "link")


def shop_pages(t, page=None):
    """One page per listing, in the markup of two shops; the listings are dealt to all tasks, because parsing pages costs most."""
    rows = t.dealt().raw_listings
    new = F.coalesce(F.nullif("price_offre_text", F.lit("")), "price_initial_text")
    badge = F.coalesce("badge", F.lit(""))
    link = F.concat(F.lit("/p-"), F.col("partkey").cast("string"), F.lit(".html?x="), F.col("suppkey").cast("string"))
    boxed = F.concat(
        F.lit('<html><body><ul><li>menu</li></ul><article class="prd _fb"><a class="core" href="'), link,
        F.lit('"><h3 class="name"> '), F.col("title"), F.lit('</h3><div class="prc">'), new,
        F.lit('</div><div class="old">'), F.col("price_initial_text"), F.lit('</div><div class="bdg _dsct">'), badge,
        F.lit('</div><div class="stars _s" style="width:'), (F.col("partkey") % 101).cast("string"),
        F.lit('%"></div><p class="aut">'), F.col("seller"), F.lit("</p></a></article></body></html>"),
    )
    plain = F.concat(
        F.lit('<ul><li><a href="'), link, F.lit('"><img alt="'), F.col("seller"), F.lit(" "), F.col("title"),
        F.lit('"></a><span>'), new, F.lit(" €</span><i>"), F.col("price_initial_text"), F.lit(" €</i><b>"),
        (F.col("partkey") % 5).cast("string"), F.lit(",5/5</b><p>Vendu par</p><p>"), F.col("location"),
        F.lit('</p></li><li><a href="/aide.html">Aide</a></li></ul>'),
    )
    page = F.col("orderkey") if page is None else page
    return rows.select(page.alias("page_id"), boxed.alias("boxed"), plain.alias("plain"))


_NEW = "coalesce(price_offre, price_initial)"
_OFF = r2(f"(price_initial-{_NEW})/price_initial*100")
_UNITS = "dhs?|mad"


@query(
    "extract_cards",
    f"""SELECT orderkey AS page_id, title AS titre, price_initial AS "prixInitial", {_NEW} AS "prixOffre",
    CASE WHEN {_BADGE_PCT} IS NOT NULL THEN 'pourcentage' WHEN trim(badge) <> '' THEN 'forfaite'
      WHEN price_initial > {_NEW} AND {_OFF} >= 1 THEN 'pourcentage' END AS "typeOffre",
    CASE WHEN {_BADGE_PCT} IS NOT NULL THEN {_BADGE_PCT} WHEN {_flat(_UNITS)} <> '' THEN {_flat_value(_UNITS)}
      WHEN trim(badge) <> '' THEN 0.0 WHEN price_initial > {_NEW} AND {_OFF} >= 1 THEN {_OFF} END AS "valeurOffre",
    seller, concat(cast(partkey % 101 AS STRING), '%') AS rating,
    concat('https://www.jumia.ma/p-', cast(partkey AS STRING), '.html?x=', cast(suppkey AS STRING)) AS link
    FROM raw_listings""",
)
def _(t):
    cards = B.extract_cards(shop_pages(t).select("page_id", F.col("boxed").alias("html")), B.CARD_RULES["jumia"])
    return cards.select(
        "page_id", "titre", "prixInitial", "prixOffre", "typeOffre", "valeurOffre", "seller", "rating", "link"
    )


@query(
    "extract_cards_heuristic",
    f"""SELECT concat(seller, ' ', title) AS title, concat(cast(partkey % 5 AS STRING), '.5') AS rating,
    location AS seller, concat('https://www.cdiscount.com/p-', cast(partkey AS STRING), '.html') AS link,
    CASE WHEN price_initial > price_offre AND floor((price_initial-price_offre)/price_initial*100+0.5) >= 1
    THEN 'pourcentage' END AS type_offre FROM raw_listings""",
)
def _(t):
    # Order numbers repeat, so a page is known by (order, line, part) folded into one number.
    page = F.xxhash64(*LISTING_ORDER)
    pages = shop_pages(t, page).select("page_id", F.col("plain").alias("html"))
    cards = B.extract_cards_heuristic(pages, "https://www.cdiscount.com", "cdiscount.com")
    return cards.select("title", "rating", "seller", "link", "type_offre")


@query(
    "product_links",
    """SELECT page_id, href FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"', 1))
    AS href FROM pages) WHERE contains(href, 'e') AND NOT contains(href, 'th') AND NOT contains(href, '/d')""",
)
def _(t):
    return B.product_links(t.pages, must_contain="e", skip=["th", "/d"])


@query(
    "flag_blocked",
    """SELECT page_id, contains(lower(html), 'track(1') OR contains(lower(html), 'captcha') OR contains(lower(html),
    'enable javascript') AS is_blocked FROM pages""",
)
def _(t):
    return B.flag_blocked(t.pages, ["track(1", "captcha", "enable javascript"]).select("page_id", "is_blocked")


@query(
    "page_profile",
    """WITH w AS (SELECT unnest(regexp_extract_all(html, '<([a-z0-9]+)', 1)) AS w FROM pages),
    k AS (SELECT substr(w, 1, 50) AS item, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, item LIMIT 10)
    SELECT 'token' AS kind, item, n FROM k UNION ALL
    SELECT 'keyword', 'article', sum(len(regexp_extract_all(html, 'article')))::BIGINT FROM pages UNION ALL
    SELECT 'keyword', 'track(', sum(len(regexp_extract_all(html, 'track\\(')))::BIGINT FROM pages UNION ALL
    SELECT 'keyword', 'price', sum(len(regexp_extract_all(html, '€\\s*[\\d,.]+')))::BIGINT FROM pages""",
)
def _(t):
    return B.page_profile(t.pages, r"<([a-z0-9]+)", 10, ["article", "track("])


# --- raw records to the unified table -----------------------------------------------------------------------------


def raw_records(t):
    """Raw records of five shops as they are stored: text or numbers, offers as a list, an object or nothing."""
    rows = t.raw_listings
    offer = F.struct(F.lit("pourcentage").alias("type_offre"), F.col("badge").alias("valeur_offre"))
    typed = F.struct(F.lit("pourcentage").alias("typeOffre"), F.col("rating").alias("valeurOffre"))
    shared = ["seller", "link", F.col("date_text").alias("date")]
    text = [
        F.col("raw_title").alias("title"), F.col("price_initial_text").alias("price_initial"),
        F.col("price_offre_text").alias("price_offre"), "category", F.col("rating_text").alias("rating"), *shared,
    ]
    number_ = [
        F.col("raw_title").alias("titre"), F.col("price_initial").alias("prixInitial"),
        F.col("price_offre").alias("prixOffre"), F.col("currency").alias("monnaie"), *shared,
    ]
    has = F.col("offre_type") != ""
    return {
        "amazon": rows.where("source = 'Amazon'").select(*text, F.when(has, F.array(offer)).alias("offre")),
        "cdiscount": rows.where("source = 'CDiscount'").select(*text, F.when(has, F.array(offer)).alias("offre")),
        "avito": rows.where("source = 'Avito'").select(*text, "location", F.when(has, offer).alias("offre")),
        "jumia": rows.where("source = 'Jumia'").select(
            *number_, F.col("price_initial").alias("prixBase"), F.col("category").alias("categorie"),
            F.col("rating_text").alias("rating"), F.when(has, F.array(typed)).alias("offre"),
        ),
        "steam": rows.where("source = 'Steam'").select(
            *number_, F.col("rating_text").alias("rating"), F.lit("Specials").alias("source"),
            F.col("rating").alias("discountPercentage"), F.when(has, F.array(typed)).alias("offre"),
        ),
    }


_TEXT = "source IN ('Amazon', 'CDiscount', 'Avito')"
_STRICT = f"CASE WHEN try_cast(rating_text AS DOUBLE) BETWEEN 0 AND 5 THEN {r2('try_cast(rating_text AS DOUBLE)')} END"
_PERCENT = r2(number("regexp_extract(rating_text, '(\\d+)\\s*%', 1)") + "*5.0/100.0")
_WIDTH = r2(number("regexp_extract(rating_text, 'width:\\s*(\\d+(?:\\.\\d+)?)', 1)") + "*5.0/100.0")
_STORED = (
    "CASE WHEN source = 'Steam' THEN rating WHEN offre_type = '' THEN NULL WHEN source = 'Jumia' THEN rating ELSE "
    + number("regexp_replace(badge, '[^0-9.]', '', 'g')") + " END"
)
_JUMIA_P1 = "CASE WHEN source = 'Jumia' THEN coalesce(price_offre, price_initial) ELSE price_offre END"
_RAW_UNIFIED = f"""WITH a AS (SELECT *, CASE WHEN {_TEXT} THEN {P0} ELSE price_initial END AS p0,
      CASE WHEN {_TEXT} THEN {P1} ELSE {_JUMIA_P1} END AS p1, {_STORED} AS pct,
      CASE WHEN source = 'Steam' THEN {_PERCENT} ELSE {_STRICT} END AS stars,
      cast(CASE WHEN regexp_matches(date_text, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_cast(date_text AS DATE)
        WHEN regexp_matches(date_text, '^\\d{{10,}}$') THEN cast(epoch_ms(cast(CASE WHEN regexp_matches(date_text,
        '^\\d{{10,}}$') THEN date_text END AS BIGINT)) AS DATE) WHEN regexp_matches(lower(date_text),
        'il y a|heure|minute|jour') THEN DATE '2026-04-01' END AS STRING) AS seen FROM raw_listings),
    b AS (SELECT *, coalesce(p0, p1) AS c0, CASE WHEN p0 <> p1 THEN p1 END AS c1, CASE WHEN p0 IS NULL AND p1 IS NOT NULL
      OR p0 = p1 THEN NULL ELSE coalesce(pct, CASE WHEN p0 > 0 AND p1 <> 0 AND p0 > p1 THEN
      {r2('(p0-p1)/p0*100')} END) END AS off FROM a)
    SELECT concat(upper(substr(source, 1, 3)), '_', substr(md5(concat(lower(source), '|', link)), 1, 12)) AS id, source,
    trim(regexp_replace(raw_title, '\\s+', ' ', 'g')) AS title_clean, c0 AS price_initial, c1 AS price_offre, currency,
    CASE WHEN currency = 'EUR' THEN {r2('c0*10.85')} ELSE c0 END AS price_initial_mad,
    CASE WHEN currency = 'EUR' THEN {r2('c1*10.85')} ELSE c1 END AS price_offre_mad,
    CASE WHEN currency = 'EUR' THEN 10.85 END AS eur_to_mad_rate, off AS discount_pct, seller,
    CASE source WHEN 'Amazon' THEN 'Amazon.fr' WHEN 'CDiscount' THEN 'France' WHEN 'Steam' THEN 'Steam' ELSE 'Maroc' END
    AS location, CASE WHEN source = 'Steam' THEN 'Steam Specials' ELSE coalesce(category, '') END AS category,
    stars AS rating, seen AS date, link, CASE WHEN offre_type = '' THEN '' ELSE 'pourcentage' END AS offre_type FROM b"""


@query("normalise", _RAW_UNIFIED)
def _(t):
    parts = [normalise(df, name, as_of="2026-04-01") for name, df in raw_records(t).items()]
    return union_all(parts).withColumn("date", F.col("date").cast("string"))


@query("read_raw", _RAW_UNIFIED)
def _(t):
    """The same from JSON files on disk, packed because plain text is most of what the job stores; the listings are joined once for all shops."""
    base, parts = work_dir(t.spark, "raw"), []
    for name, df in raw_records(t.written()).items():
        df.write.json(f"{base}/{name}", compression="gzip")
        parts.append(normalise(A.read_raw(t.spark, f"{base}/{name}", multiline=False), name, as_of="2026-04-01"))
    return union_all(parts).withColumn("date", F.col("date").cast("string"))


_KEPT = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY title_clean, price_offre, source
    ORDER BY {ORDER}) AS rn FROM unified) WHERE rn = 1"""
_CAPPED = ", ".join(f"CASE WHEN {c} BETWEEN 0 AND 1000000 THEN {c} END AS {c}" for c in D.PRICES)
_CLEAN_SQL = f"""SELECT id, source, title_clean, currency, {_CAPPED}, eur_to_mad_rate, discount_pct, seller, location, category, rating, cast(day AS STRING) AS date,
    link, offre_type, false AS is_duplicate FROM ({_KEPT})"""


def _written(t, fmt: str) -> str:
    kept = D.apply_quality_rules(t.unified, LISTING_ORDER).withColumn("date", F.col("day"))
    return A.write_clean(kept, work_dir(t.spark, "clean"), [fmt], compression="gzip" if fmt in ("csv", "json") else None)[fmt]


def _shown(df):
    """Text cells that are empty come back from CSV as missing."""
    return df.withColumns({"date": F.col("date").cast("string"), "offre_type": F.coalesce("offre_type", F.lit(""))})


@query("write_clean_csv", _CLEAN_SQL)
def _(t):
    return _shown(A.read_clean_csv(t.spark, _written(t, "csv")))


@query("write_clean_parquet", _CLEAN_SQL)
def _(t):
    return _shown(t.spark.read.parquet(_written(t, "parquet"))).select(K.FINAL_COLUMNS)


@query("write_clean_json", _CLEAN_SQL)
def _(t):
    return _shown(A.read_clean_json(t.spark, _written(t, "json")))


_METRICS_SQL = f"""SELECT source, count(*) AS n, {r4('avg(abs(discount_pct - rating*2.0))')} AS mae FROM unified
    WHERE discount_pct IS NOT NULL AND rating IS NOT NULL GROUP BY 1"""


def _metric_files(t):
    known = t.unified.where("discount_pct IS NOT NULL AND rating IS NOT NULL")
    rows = known.groupBy("source").agg(
        F.count("*").alias("n"), half_up(F.avg(F.abs(F.col("discount_pct") - F.col("rating") * 2.0)), 4).alias("mae")
    )
    return A.write_metrics(rows, work_dir(t.spark, "metrics"))


@query("write_metrics", _METRICS_SQL)
def _(t):
    return t.spark.read.schema("source string, n bigint, mae double").json(_metric_files(t)["json"])


@query("write_metrics_csv", _METRICS_SQL)
def _(t):
    return t.spark.read.schema("source string, n bigint, mae double").option("header", True).csv(_metric_files(t)["csv"])
