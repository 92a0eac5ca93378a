"""Load reports and table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.functions.offers import has_offer_kind


def ingest_report(df: DataFrame, offers: str = "offre") -> DataFrame:
    """Rows with a percentage offer, a flat offer and no offer."""
    o = F.col(offers)
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(has_offer_kind(o, "pourcentage")).alias("percentage"),
        F.count_if(has_offer_kind(o, "forfaite")).alias("flat"),
        F.count_if(o.isNull() | (F.size(o) == 0)).alias("no_offer"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"), F.lit(len(df.columns)).alias("total_columns"))


def completeness(df: DataFrame) -> DataFrame:
    """Non-missing values of every column, from one pass."""
    one = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column_name", "present")
