"""Raw listings of any source to the unified columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from offerwell import constants as K
from offerwell.functions import offers as O
from offerwell.functions import text as T


@dataclass(frozen=True)
class SourceFields:
    """Field names of one source, in order of preference, and its defaults."""

    name: str
    title: tuple[str, ...] = ("title", "titre")
    initial: tuple[str, ...] = ("price_initial", "prixInitial")
    offer: tuple[str, ...] = ("price_offre", "prixOffre")
    category: tuple[str, ...] = ("category", "categorie")
    currency: tuple[str, ...] = ()
    default_currency: str = "EUR"
    default_location: str = ""
    fixed_location: bool = False
    default_seller: str = ""
    percent_rating: bool = False
    stored_discount: str | None = None
    category_from_source: str | None = None


# Both naming conventions are accepted for every source; the preferred spelling comes first.
SOURCES = {
    "amazon": SourceFields("Amazon", default_location="Amazon.fr"),
    "cdiscount": SourceFields("CDiscount", default_location="France"),
    "avito": SourceFields("Avito", default_currency="MAD", default_location="Maroc", fixed_location=True),
    "jumia": SourceFields(
        "Jumia",
        title=("titre", "title"),
        initial=("prixInitial", "price_initial"),
        offer=("prixOffre", "prixBase", "price_offre"),
        category=("categorie", "category"),
        currency=("monnaie",),
        default_currency="MAD",
        default_location="Maroc",
    ),
    "steam": SourceFields(
        "Steam",
        title=("titre", "title"),
        initial=("prixInitial", "price_initial"),
        currency=("monnaie",),
        default_location="Steam",
        default_seller="Valve",
        percent_rating=True,
        stored_discount="discountPercentage",
        category_from_source="source",
    ),
    "electroplanet": SourceFields(
        "Electroplanet",
        title=("titre", "title"),
        initial=("prixInitial", "price_initial"),
        category=("categorie", "category"),
        currency=("monnaie",),
        default_currency="MAD",
        default_location="Electroplanet.ma",
        default_seller="Electroplanet",
    ),
}


def _first(df: DataFrame, names, default: str | None = None) -> Column:
    found = [F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*found, F.lit(default).cast("string"))


def _price(df: DataFrame, names) -> Column:
    values = []
    for n in names:
        if n in df.columns:
            if isinstance(df.schema[n].dataType, NumericType):
                value = F.col(n).cast("double")
                values.append(F.when(~F.isnan(value), value))
            elif n.startswith("prix"):  # numbers of the numeric convention, read as text
                values.append(F.coalesce(F.col(n).try_cast("double"), T.parse_price(F.col(n))))
            else:
                values.append(T.parse_price(F.col(n)))
    # A later spelling (a base price) is used when the earlier one is missing or zero.
    out = values[0] if values else F.lit(None).cast("double")
    for v in values[1:]:
        out = F.when(out.isNull() | (out == 0), F.coalesce(v, out)).otherwise(out)
    return out


def normalise(df: DataFrame, source: str, as_of: str, rate: float = K.EUR_TO_MAD) -> DataFrame:
    """Unified listing columns (without the duplicate flag) of one source's raw rows."""
    f = SOURCES[source]
    offers = None
    if "offre" in df.columns:
        dtype = df.schema["offre"].dataType
        is_text = dtype.typeName() == "string"
        offers = O.offers_from_json(F.col("offre")) if is_text else O.normal_offers(F.col("offre"), dtype)
    link = _first(df, ["link"], "")
    rating = _first(df, ["rating"])
    pct = O.offer_discount_pct(offers) if offers is not None else F.lit(None).cast("double")
    if f.stored_discount:
        stored = F.col(f.stored_discount) if f.stored_discount in df.columns else F.lit(None)
        pct = stored.cast("string").try_cast("double")
    category = _first(df, f.category, "")
    if f.category_from_source:
        category = F.concat(F.lit(f.name + " "), _first(df, [f.category_from_source], "Games"))
    location = F.lit(f.default_location) if f.fixed_location else _first(df, ["location"], f.default_location)
    rows = df.select(
        T.row_id(F.lit(source), link).alias("id"),
        F.lit(f.name).alias("source"),
        T.clean_title(_first(df, f.title)).alias("title_clean"),
        _price(df, f.initial).alias("p0"),
        _price(df, f.offer).alias("p1"),
        _first(df, f.currency, f.default_currency).alias("currency"),
        pct.alias("pct"),
        _first(df, ["seller"], f.default_seller).alias("seller"),
        location.alias("location"),
        category.alias("category"),
        (T.percent_rating(rating, css=False) if f.percent_rating else T.parse_rating(rating)).alias("rating"),
        T.parse_date(_first(df, ["date"]), as_of).alias("date"),
        link.alias("link"),
        (O.first_offer_type(offers) if offers is not None else F.lit("")).alias("offre_type"),
    )
    return unify(rows, "p0", "p1", "pct", rate)


def unify(rows: DataFrame, initial: str, offer: str, pct: str, rate: float = K.EUR_TO_MAD) -> DataFrame:
    """Apply the price cases and add the MAD columns."""
    cases = O.price_cases(F.col(initial), F.col(offer), F.col(pct))
    currency = F.col("currency")
    rows = rows.withColumns({"_" + n: c for n, c in cases.items()}).drop(initial, offer, pct)
    rows = rows.withColumnsRenamed({"_" + n: n for n in cases})
    return rows.withColumns(
        {
            "price_initial_mad": O.to_mad(F.col("price_initial"), currency, rate),
            "price_offre_mad": O.to_mad(F.col("price_offre"), currency, rate),
            "eur_to_mad_rate": F.when(currency == "EUR", F.lit(rate)),
        }
    )


def swap_prices(df: DataFrame) -> DataFrame:
    """Repair job: exchange initial and offer price."""
    return df.withColumns({"price_initial": F.col("price_offre"), "price_offre": F.col("price_initial")})


def link_category(df: DataFrame, rules=K.LINK_CATEGORIES, icons=K.CATEGORY_ICONS) -> DataFrame:
    """Viewer label: catalogue sources by category, the others by the first matching link pattern."""
    pairs = [F.lit(v) for s, m in icons.items() for c, i in m.items() for v in (f"{s}|{c}", i)]
    category = F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit("Autres"))
    source = F.lower(F.col("source"))
    icon = F.coalesce(F.create_map(*pairs)[F.concat(source, F.lit("|"), category)], F.lit(K.DEFAULT_ICON))
    label = F.when(source.isin(list(icons)), F.concat(icon, F.lit(" "), category))
    for pattern, name in rules:
        label = label.when(F.col("link").rlike(pattern), F.lit(name))
    return df.withColumn("label", label.otherwise(F.concat(F.lit(K.DEFAULT_ICON + " "), category)))
