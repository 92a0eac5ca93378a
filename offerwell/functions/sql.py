"""The main parsers and formulas as temporary SQL functions for SQL users."""

from __future__ import annotations

from pyspark.sql import SparkSession

from offerwell import constants as K


def _any(words: list[str]) -> str:
    return "|".join(words)


def _params(i: int) -> str:
    cases = " ".join(
        f"WHEN contains(lower(source), '{n.lower()}') THEN {float(v[i])!r}D" for n, v in K.PRICING_PARAMS.items()
    )
    return f"(CASE {cases} ELSE {float(K.DEFAULT_PARAMS[i])!r}D END)"


def definitions() -> dict[str, str]:
    """Signature and body of every function."""
    base, alpha, beta, tau, delta, kappa, low, high = (_params(i) for i in range(8))
    p = "(CASE WHEN price > 0 THEN price ELSE 1D END)"
    r = "(CASE WHEN rating > 0 THEN rating ELSE 3.5D END)"
    factor = (
        f"(CASE WHEN contains(lower(source), 'steam') THEN 1D "
        f"WHEN rlike(lower(coalesce(category, '')), '{_any(K.HIGH_VALUE_WORDS)}') THEN 0.8D "
        f"WHEN rlike(lower(coalesce(category, '')), '{_any(K.ACCESSORY_WORDS)}') THEN 1.3D ELSE 1D END)"
    )
    raw = f"({base} + {alpha} * log10({p} + 1) + {beta} * ({tau} - {r}) + {delta} / ({p} + {kappa})) * {factor}"
    off = "floor(try_divide(initial - offer, initial) * 100D * 100D + 0.5D) / 100D"
    return {
        "round_half_up(x DOUBLE) RETURNS DOUBLE": "floor(x * 100D + 0.5D) / 100D",
        "parse_price(raw STRING) RETURNS DOUBLE": "try_cast(nullif(regexp_replace(replace(regexp_extract(raw, '^[^/]*', "
        "0), ',', '.'), '[^0-9.]', ''), '') AS DOUBLE)",
        "discount_pct(initial DOUBLE, offer DOUBLE) RETURNS DOUBLE": f"CASE WHEN initial > 0 AND offer <> 0 AND initial > offer "
        f"THEN {off} END",
        "source_discount(source STRING, price DOUBLE, rating DOUBLE, category STRING) RETURNS DOUBLE": f"greatest(least("
        f"{raw}, {high}), {low})",
    }


def register(spark: SparkSession, prefix: str = "offer_") -> list[str]:
    """Create the functions in the session; returns their names."""
    names = []
    for signature, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{signature} RETURN {body}")
        names.append(prefix + signature.split("(")[0])
    return names
