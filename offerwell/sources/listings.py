"""Raw listing files, the clean listing table and metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwell.constants import FINAL_COLUMNS
from offerwell.session import cut_lineage

# Both naming conventions; every field as text, because the same field is a number in one shop and text in another.
RAW_FIELDS = (
    "title titre price_initial price_offre prixInitial prixBase prixOffre category categorie seller location link date "
    "rating monnaie statut discountPercentage app_id image source offre"
).split()

CLEAN_TYPES = {
    **dict.fromkeys(
        ["price_initial", "price_offre", "price_initial_mad", "price_offre_mad", "eur_to_mad_rate", "discount_pct", "rating"],
        "double",
    ),
    "date": "date",
    "is_duplicate": "boolean",
}


def read_raw(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Raw records of one shop: one record per line, or a JSON array per file (``multiline``, one task reads a whole file)."""
    schema = ", ".join(f"{f} string" for f in RAW_FIELDS)
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    """Unified CSV with header and optional byte order mark, one record per line; unreadable cells become null."""
    schema = ", ".join(f"{c} string" for c in FINAL_COLUMNS)
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    # Empty text cells are legal values of text columns; only missing cells are null.
    rows = reader.option("nullValue", None).csv(path)
    return rows.select(
        *[F.col(c).try_cast(CLEAN_TYPES[c]).alias(c) if c in CLEAN_TYPES else F.col(c) for c in FINAL_COLUMNS]
    )


def write_clean(df: DataFrame, path: str, formats=("csv", "json", "parquet"), compression: str | None = None) -> dict[str, str]:
    """The fixed columns in every format, partitioned by source where the reader can prune; returns the paths.

    The rows are evaluated once for all formats. Line breaks inside text become spaces in CSV, so its files can be split.
    ``compression`` (``gzip``) packs the CSV and JSON files; a packed file is read by one task, and a task of the rows writes one.
    """
    packed = {"compression": compression} if compression else {}
    rows = df.select(FINAL_COLUMNS)
    if len(formats) > 1:
        rows = cut_lineage(rows, "clean")
    flat = [F.regexp_replace(c, r"[\r\n]+", " ").alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes]
    out = {}
    for fmt in formats:
        out[fmt] = f"{path}/{fmt}"
        writer = rows.write.mode("overwrite")
        if fmt == "csv":
            rows.select(flat).write.mode("overwrite").options(**packed, header=True, escape='"').csv(out[fmt])
        elif fmt == "json":
            writer.options(**packed, ignoreNullFields=False).json(out[fmt])
        else:
            writer.partitionBy("source").parquet(out[fmt])
    return out


def read_clean_json(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{c} {CLEAN_TYPES.get(c, 'string')}" for c in FINAL_COLUMNS)
    return spark.read.schema(schema).json(path)


def write_metrics(df: DataFrame, path: str) -> dict[str, str]:
    """Metrics or leaderboard table as JSON and CSV."""
    df = cut_lineage(df, "metrics")
    df.write.mode("overwrite").json(f"{path}/json")
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    return {"json": f"{path}/json", "csv": f"{path}/csv"}
