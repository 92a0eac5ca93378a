"""Offers as columns: badges, offer arrays, price cases, currency, category factor."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerwell import constants as K
from offerwell.functions.numbers import discount_pct, half_up
from offerwell.functions.text import BLANK, clean_text, price_to_float

OFFER_TYPE = "array<struct<type_offre:string,valeur_offre:string>>"


@dataclass(frozen=True)
class BadgeRule:
    """How one source turns a badge and two prices into an offer.

    ``units``: currency words of a flat badge (None: flat badges unknown); ``other``: what any other badge text
    means (``zero`` flat offer of 0, ``raw`` flat offer keeping the text, ``skip`` no offer);
    ``threshold``: least computed percentage (None: never compute); ``digits``: its rounding.
    """

    units: str | None
    other: str
    threshold: float | None
    digits: int = 2


BADGE_RULES = {
    "Jumia": BadgeRule("dhs?|mad", "zero", 1.0),
    "Amazon": BadgeRule("eur|€", "zero", 1.0),
    "AmazonDeals": BadgeRule(None, "skip", 1.0),
    "CDiscount": BadgeRule("eur|€", "skip", 1.0, 0),
    "Avito": BadgeRule("dhs?|mad", "raw", None),
    "Electroplanet": BadgeRule(None, "skip", 0.1),
    "Steam": BadgeRule(None, "skip", None),
}


def badge_to_offer(badge: Column, initial: Column, offer: Column, rule: BadgeRule) -> Column:
    """struct<type_offre, valeur, texte> of a badge, or null when there is no offer."""

    def entry(kind: str, value: Column, text: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("type_offre"), value.cast("double").alias("valeur"), text.cast("string").alias("texte")
        )

    none = F.lit(None)
    text = F.trim(badge)
    pct = F.regexp_extract(text, r"(\d+)" + BLANK + "*%", 1).try_cast("double")
    branch = F.when(pct.isNotNull(), entry("pourcentage", pct, none))
    if rule.units:
        flat = F.regexp_extract(text, rf"(?i)(\d[\d\s\u00A0\u202F,.]*?){BLANK}*(?:{rule.units})", 1)
        branch = branch.when(flat != "", entry("forfaite", F.coalesce(price_to_float(flat), F.lit(0.0)), none))
    if rule.other == "zero":
        branch = branch.when(text != "", entry("forfaite", F.lit(0.0), none))
    elif rule.other == "raw":
        branch = branch.when(text != "", entry("forfaite", none, text))
    if rule.threshold is not None:
        off = half_up(F.try_divide(initial - offer, initial) * 100.0, rule.digits)
        computed = (initial > offer) & (offer != 0) & (off >= rule.threshold)
        branch = branch.when(computed, entry("pourcentage", off, none))
    return branch


def badge_offer_by_source(source: Column, badge: Column, initial: Column, offer: Column) -> Column:
    """``badge_to_offer`` with the rule of the row's source."""
    out = None
    for name, rule in BADGE_RULES.items():
        value = badge_to_offer(badge, initial, offer, rule)
        out = F.when(source == name, value) if out is None else out.when(source == name, value)
    return out


def normal_offers(c: Column, dtype) -> Column:
    """Offer field of any raw shape (object or array, either naming) as ``OFFER_TYPE``."""
    from pyspark.sql.types import ArrayType

    is_array = isinstance(dtype, ArrayType)
    names = set((dtype.elementType if is_array else dtype).names)

    def pick(o: Column, *keys: str) -> Column:
        found = [o[k].cast("string") for k in keys if k in names]
        return F.coalesce(*found, F.lit(None).cast("string"))

    def shape(o: Column) -> Column:
        return F.struct(
            pick(o, "type_offre", "typeOffre").alias("type_offre"),
            pick(o, "valeur_offre", "valeurOffre").alias("valeur_offre"),
        )

    return F.transform(c, shape) if is_array else F.when(c.isNotNull(), F.array(shape(c)))


def offers_from_json(c: Column) -> Column:
    """Offer field kept as JSON text, an array or one object, in either naming, as ``OFFER_TYPE``."""
    text = F.trim(c)
    listed = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    entry = "struct<type_offre:string,typeOffre:string,valeur_offre:string,valeurOffre:string>"
    return F.transform(
        F.from_json(listed, f"array<{entry}>"),
        lambda o: F.struct(
            F.coalesce(o["type_offre"], o["typeOffre"]).alias("type_offre"),
            F.coalesce(o["valeur_offre"], o["valeurOffre"]).alias("valeur_offre"),
        ),
    )


def offer_discount_pct(offers: Column) -> Column:
    """Value of the first percentage entry that holds a number."""
    values = F.transform(
        F.filter(offers, lambda o: F.lower(o["type_offre"]) == "pourcentage"),
        lambda o: F.regexp_replace(o["valeur_offre"], r"[^0-9.]", "").try_cast("double"),
    )
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def first_offer_type(offers: Column) -> Column:
    """Type of the first entry or the empty string."""
    return F.coalesce(F.trim(F.get(offers, F.lit(0))["type_offre"]), F.lit(""))


def has_offer_kind(offers: Column, kind: str) -> Column:
    return F.coalesce(F.exists(offers, lambda o: o["type_offre"] == kind), F.lit(False))


def price_cases(initial: Column, offer: Column, pct: Column) -> dict[str, Column]:
    """One-price rows keep it as the initial price, equal prices are no offer, real offers get their percent."""
    promote = initial.isNull() & offer.isNotNull()
    equal = initial == offer
    return {
        "price_initial": F.coalesce(initial, offer),
        "price_offre": F.when(~promote & ~F.coalesce(equal, F.lit(False)), offer),
        "discount_pct": F.when(promote | F.coalesce(equal, F.lit(False)), F.lit(None)).otherwise(
            F.coalesce(pct, discount_pct(initial, offer))
        ),
    }


def to_mad(amount: Column, currency: Column, rate: float = K.EUR_TO_MAD) -> Column:
    return F.when(currency == "EUR", half_up(amount * rate)).otherwise(amount)


def category_factor(category: Column, high=K.HIGH_VALUE_WORDS, accessory=K.ACCESSORY_WORDS) -> Column:
    """0.8 for high-value goods, 1.3 for accessories, 1.0 otherwise; the first list wins."""
    low = F.lower(F.coalesce(category, F.lit("")))
    return F.when(low.rlike("|".join(high)), 0.8).when(low.rlike("|".join(accessory)), 1.3).otherwise(1.0)


# --- text nodes of one card -------------------------------------------------------------------------------------


def pick_prices(nodes: Column) -> dict[str, Column]:
    """First currency text is the current price, the next different one the old price."""
    money = F.transform(
        F.filter(nodes, lambda t: t.contains("€") | t.contains("EUR")), lambda t: clean_text(t)
    )
    # The second distinct text; a filter that compares with the first text would read all texts again for each.
    return {"price_new": F.get(money, F.lit(0)), "price_old": F.coalesce(F.get(F.array_distinct(money), F.lit(1)), F.lit(""))}


def pick_badge(nodes: Column) -> Column:
    short = F.filter(nodes, lambda t: t.contains("%") & (F.length(F.trim(t)) < 15))
    return F.coalesce(F.trim(F.get(short, F.lit(0))), F.lit(""))


def pick_rating(nodes: Column, aria: Column) -> Column:
    """``N/5`` or ``N étoiles`` in the texts, else the aria label, with a decimal dot."""
    marked = F.filter(nodes, lambda t: t.contains("/5") | t.contains("étoiles"))  # the pattern is costly and needs one of them
    hits = F.filter(F.transform(marked, lambda t: F.regexp_extract(t, r"([\d,.]+)(?:/5|\s*étoiles)", 1)), lambda v: v != "")
    label = F.coalesce(
        F.nullif(F.regexp_extract(aria, r"(?i)([\d,.]+)\s*(?:sur|étoile|star|out)", 1), F.lit("")),
        F.regexp_extract(F.when(F.lower(aria).contains("étoile"), aria), r"([\d,.]+)", 1),
    )
    return F.replace(F.coalesce(F.get(hits, F.lit(0)), label, F.lit("")), F.lit(","), F.lit("."))


def pick_seller(nodes: Column, title: Column, default: str) -> Column:
    """Text after "vendu par", or the tail of "vendu et expédié par", else the leading brand of the title."""
    phrase = "vendu et expédié par"

    def named(t: Column, i: Column) -> Column:
        low = F.lower(t)
        after = F.when(i + 1 < F.size(nodes), F.get(nodes, i + 1))
        return F.when(low.contains(phrase), F.trim(F.regexp_extract(t, "^.*par(.*)$", 1))).when(
            F.trim(low) == "vendu par", after
        )

    seller = F.get(F.filter(F.transform(nodes, named), lambda s: s.isNotNull()), F.lit(0))
    brand = F.regexp_extract(title, r"^([A-Z][A-Z0-9\-]{2,})", 1)
    return F.coalesce(F.nullif(seller, F.lit("")), F.nullif(brand, F.lit("")), F.lit(default))
