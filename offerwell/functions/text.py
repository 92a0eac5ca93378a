"""Parsers for scraped text: prices, ratings, dates, titles, links, labels."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerwell.functions.numbers import half_up

# Spark's \s is ASCII only; scraped prices use no-break and narrow no-break spaces.
BLANK = r"[\s\u00A0\u202F]"


def _none_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def _to_double(c: Column) -> Column:
    return _none_if_empty(c).try_cast("double")


def _digits_and_dots(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit(","), F.lit(".")), r"[^0-9.]", "")


def clean_text(c: Column) -> Column:
    """Collapse every run of blanks to one space and trim."""
    return F.trim(F.regexp_replace(c, BLANK + "+", " "))


def clean_title(c: Column) -> Column:
    """``clean_text`` with the empty string for a missing title."""
    return F.coalesce(clean_text(c), F.lit(""))


def parse_price(c: Column) -> Column:
    """Listing price: text after ``/`` dropped, decimal comma, no number means null."""
    return _to_double(_digits_and_dots(F.regexp_extract(c, r"^[^/]*", 0)))


def price_to_float(c: Column) -> Column:
    """Card price: of several dots only the last one is the decimal point."""
    return half_up(_to_double(F.regexp_replace(_digits_and_dots(c), r"\.(?=.*\.)", "")))


def parse_store_price(c: Column) -> Column:
    """Game-store price: words for "free" are 0."""
    free = F.lower(c).rlike("gratuit|free|offert")
    return F.when(free, F.lit(0.0)).otherwise(half_up(_to_double(_digits_and_dots(c))))


def ensure_suffix(c: Column, suffix: str = "DH") -> Column:
    """Append the currency word to non-empty text that lacks it."""
    return F.when((c != "") & ~c.endswith(suffix), F.concat(c, F.lit(" " + suffix))).otherwise(c)


def parse_rating(c: Column) -> Column:
    """Strict number in 0..5."""
    v = F.trim(c.cast("string")).try_cast("double")
    return F.when(v.between(0, 5), half_up(v))


def percent_rating(c: Column, css: bool = True) -> Column:
    """``NN%``, or with ``css`` also ``width:NN``, on a five point scale."""
    pct = _to_double(F.regexp_extract(c, r"(\d+)" + BLANK + "*%", 1))
    if css:
        pct = F.coalesce(pct, _to_double(F.regexp_extract(c, r"width:\s*(\d+(?:\.\d+)?)", 1)))
    return half_up(pct * 5.0 / 100.0)


def parse_date(c: Column, as_of: str) -> Column:
    """ISO date, epoch milliseconds (UTC) or a French relative phrase, which means ``as_of``."""
    t = F.trim(c)
    days = F.floor(F.when(t.rlike(r"^\d{10,}$"), t).try_cast("bigint") / 86400000.0).cast("int")
    return (
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t.try_cast("date"))
        .when(t.rlike(r"^\d{10,}$"), F.date_add(F.lit("1970-01-01").cast("date"), days))
        .when(F.lower(t).rlike("il y a|heure|minute|jour"), F.lit(as_of).cast("date"))
    )


def row_id(source: Column, link: Column) -> Column:
    """Stable listing id: three letters of the source and twelve hex digits of an md5."""
    key = F.lower(source)
    digest = F.md5(F.concat(key, F.lit("|"), link).cast("binary"))
    return F.concat(F.upper(F.substring(key, 1, 3)), F.lit("_"), F.substring(digest, 1, 12))


def canonical_link(c: Column, base: str, item_base: str | None = None) -> Column:
    """Absolute link without query or fragment; ``/dp/<10 chars>`` links reduce to the item page."""
    absolute = F.when(c.startswith("http"), c).otherwise(F.concat(F.lit(base), c))
    plain = F.regexp_replace(absolute, r"[?#].*$", "")
    item = F.regexp_extract(plain, r"/dp/([A-Z0-9]{10})", 1)
    return F.when(item != "", F.concat(F.lit((item_base or base) + "/dp/"), item)).otherwise(plain)


def short_label(c: Column, n: int, mark: str = "…", keep: int | None = None) -> Column:
    """Text longer than ``n`` cut to ``keep`` (by default ``n - 1``) characters and a mark."""
    kept = n - 1 if keep is None else keep
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, kept), F.lit(mark))).otherwise(c)


def display_price(source: Column, price: Column, price_offer: Column) -> Column:
    """Price shown by the viewer: one source keeps it in another field."""
    raw = F.coalesce(F.when(F.lower(source) == "avito", price).otherwise(price_offer), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(raw, BLANK, ""), "(?i)dhs?|dh|mad|€", "")
    return _to_double(F.regexp_extract(F.regexp_replace(bare, "^([^,]*),", "$1."), r"^[0-9]*\.?[0-9]+", 0))


def star_parts(c: Column) -> dict[str, Column]:
    """Full, half and empty stars of a rating; the half star starts at a fraction of 0.3."""
    n = c.try_cast("double")
    full = F.floor(n).cast("int")
    half = F.when(n - full >= 0.3, 1).when(n.isNotNull(), 0)
    return {"full_stars": full, "half_star": half, "empty_stars": 5 - full - half}


def _accent_table() -> tuple[str, str]:
    """Every letter that decomposes into one basic letter and marks, and that letter."""
    pairs = []
    for point in range(0xC0, 0x2000):
        parts = unicodedata.normalize("NFD", chr(point))
        if len(parts) > 1 and parts[0].isalpha() and all(unicodedata.combining(m) for m in parts[1:]):
            pairs.append((chr(point), parts[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def strip_accents(c: Column) -> Column:
    """Fold accented letters to their basic letters and drop combining marks."""
    accented, plain = _accent_table()
    folded = F.regexp_replace(F.translate(c, accented, plain), r"\p{Mn}", "")
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(folded)  # as many bytes as characters: nothing to fold
