"""Feature columns, scaling, text weights, splits and rebalancing as DataFrame jobs."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerwell.functions.numbers import clip
from offerwell.functions.text import strip_accents
from offerwell.operators.ordered import attach_one, column_quantiles, exact_quantiles, null_safe_join, number_rows, scan
from offerwell.operators.windows import days_since_first
from offerwell.session import cut_lineage

NUMERIC = ["price_initial_mad", "log_price_initial_mad", "rating_filled", "rating_gap_to_5", "rating_missing"]
TEMPORAL = ["day_of_week", "month", "days_since_earliest"]
CATEGORICAL = ["source", "category", "currency", "location", "source_category", "seller_source"]


def _plain(df: DataFrame) -> DataFrame:
    filled = df.fillna("unknown", ["seller", "category", "source", "currency", "location"]).fillna(
        "", ["title_clean", "offre_type"]
    )
    return filled.withColumns(
        {
            "price_initial_mad": F.col("price_initial_mad").cast("string").try_cast("double"),
            "rating": clip(F.col("rating").cast("string").try_cast("double"), 0.0, 5.0),
        }
    )


def rating_medians(df: DataFrame) -> DataFrame:
    """(source, _median): the exact median rating of every source, for ``base_features``."""
    return exact_quantiles(_plain(df), ["source"], "rating", [0.5]).select("source", F.col("q0").alias("_median"))


def base_features(df: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Filled texts, clipped rating, log price, rating filled by the source median (then 4.0), crossed keys, target.

    ``medians`` are those of ``rating_medians`` on the rows of a fit; without them they are taken from ``df``.
    """
    rows = _plain(df)
    medians = rating_medians(df) if medians is None else medians
    rows = null_safe_join(rows, medians, ["source"], "left")
    rows = rows.withColumn("rating_filled", F.coalesce("rating", "_median", F.lit(4.0)))
    return rows.withColumns(
        {
            "log_price_initial_mad": F.log1p(clip(F.col("price_initial_mad"), 0.0, None)),
            "rating_missing": F.col("rating").isNull().cast("int"),
            "rating_gap_to_5": clip(5.0 - F.col("rating_filled"), 0.0, None),
            "source_category": F.concat_ws(" :: ", "source", "category"),
            "seller_source": F.concat_ws(" :: ", "seller", "source"),
            "has_offer": F.col("discount_pct").isNotNull().cast("int"),
        }
    ).drop("_median")


def cap_quantile(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """Cap a column at its exact quantile."""
    cap = exact_quantiles(df, [], col, [q]).select(F.col("q0").alias("_cap"))
    rows = attach_one(df, cap)
    return rows.withColumn(col, F.when(F.col(col).isNotNull(), F.least(F.col(col), F.col("_cap")))).drop("_cap")


def temporal_features(df: DataFrame, date: str = "day") -> DataFrame:
    """Weekday (Monday 0), month and days since the first date; missing dates give -1, -1 and 0."""
    rows = days_since_first(df, date, "days_since_earliest")
    return rows.withColumns(
        {
            "day_of_week": F.coalesce(F.weekday(date), F.lit(-1)),
            "month": F.coalesce(F.month(date), F.lit(-1)),
        }
    )


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values become the exact median of their column; all medians come from one selection."""
    medians = column_quantiles(df, [], cols, [0.5]).agg(F.map_from_entries(F.collect_list(F.struct("column", "q0"))).alias("_m"))
    rows = attach_one(df, medians)  # one number per column
    return rows.withColumns({c: F.coalesce(F.col(c), F.col("_m")[c]) for c in cols}).drop("_m")


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value, the smallest of equally frequent ones."""
    for c in cols:
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n"))
        top = counts.orderBy(F.desc("_n"), c).limit(1).select(F.col(c).alias("_m"))
        df = attach_one(df, top).withColumn(c, F.coalesce(F.col(c), F.col("_m"))).drop("_m")
    return df


def scale_standard(df: DataFrame, col: str, out: str) -> DataFrame:
    """Divide by the population deviation, without centring."""
    rows = attach_one(df, df.agg(F.stddev_pop(col).alias("_sd")))
    return rows.withColumn(out, F.col(col) / F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(1.0)).drop("_sd")


def scale_robust(df: DataFrame, col: str, out: str) -> DataFrame:
    """Divide by the interquartile range, without centring."""
    q = exact_quantiles(df, [], col, [0.25, 0.75]).select((F.col("q1") - F.col("q0")).alias("_iqr"))
    rows = attach_one(df, q)
    return rows.withColumn(out, F.col(col) / F.when(F.col("_iqr") > 0, F.col("_iqr")).otherwise(1.0)).drop("_iqr")


def tokens(text: Column) -> Column:
    """Lower-cased, accent-free words of two or more letters or digits."""
    return F.regexp_extract_all(strip_accents(F.lower(text)), F.lit(r"[\p{L}\p{N}_]{2,}"), 0)


def ngrams(words: Column) -> Column:
    """Words followed by pairs of neighbours."""
    pairs = F.transform(
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.concat(F.get(words, i), F.lit(" "), w),
    )
    return F.concat(words, pairs)


_COUNTED = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]))
_WEIGHTED = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())]))
#: Largest vocabulary that is sent to every task; weights of larger ones come from a join.
LOCAL_TERMS = 1 << 18


def _lists(owner: np.ndarray, rows: int, names: list[str], *columns: pa.Array) -> pa.Array:
    """Lists of structs from entries in row order."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays(columns, names=names))


@F.arrow_udf(_COUNTED)
def _counted(terms: pa.Array) -> pa.Array:
    """(term, tf) of every distinct term of a row; none for a null row."""
    size = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    found = terms.flatten().dictionary_encode()
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(len(found.dictionary), 1)
    pairs, tf = np.unique(np.repeat(np.arange(len(terms)), size) * width + codes, return_counts=True)
    row, code = np.divmod(pairs, width)
    return _lists(row, len(terms), ["term", "tf"], found.dictionary.take(pa.array(code)), pa.array(tf))


def tfidf(df: DataFrame, key: str, text: str, max_terms: int, min_df: int = 2) -> DataFrame:
    """Sparse rows (key, term, weight): smoothed idf plus one, unit length per document, which is a row of ``df``.

    Terms are counted inside their row and written, so that only term counts, summed up in every task, are shuffled. The kept vocabulary has at
    most ``max_terms`` rows and is broadcast up to ``LOCAL_TERMS``.
    """
    words = df.select(F.col(key).alias("key"), tokens(F.col(text)).alias("w"))  # split once, not for every pair
    rows = words.select("key", _counted(ngrams(F.col("w"))).alias("t"))
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()), "term-counts")
    each = rows.select("key", "row", F.explode("t").alias("t")).select("key", "row", "t.term", "t.tf")
    terms = each.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("_all"))
    vocabulary = terms.where(F.col("df") >= min_df).orderBy(F.desc("_all"), "term").limit(max_terms)
    idf = attach_one(vocabulary, rows.agg(F.count("*").alias("_docs"))).select(
        "term", (F.log((F.col("_docs") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf")
    )
    if max_terms > LOCAL_TERMS:
        weighted = each.join(idf, "term").withColumn("_x", F.col("tf") * F.col("idf"))
        norm = F.sqrt(F.sum(F.col("_x") * F.col("_x")).over(Window.partitionBy("row")))
        return weighted.select(F.col("key").alias(key), "term", (F.col("_x") / norm).alias("weight"))
    known = idf.collect()  # at most LOCAL_TERMS rows
    shared = df.sparkSession.sparkContext.broadcast(([r["term"] for r in known], [r["idf"] for r in known]))

    @F.arrow_udf(_WEIGHTED)
    def weigh(counted: pa.Array) -> pa.Array:
        names, factors = pa.array(shared.value[0], pa.string()), np.array(shared.value[1], np.float64)
        flat, n = counted.flatten(), len(counted)
        size = pc.fill_null(pc.list_value_length(counted), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = pc.index_in(flat.field("term"), names)
        kept = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        row, at = np.repeat(np.arange(n), size)[kept], at.drop_null().to_numpy()
        x = flat.field("tf").to_numpy()[kept] * factors[at] if len(kept) else np.empty(0)
        norm = np.sqrt(np.bincount(row, weights=x * x, minlength=n))
        return _lists(row, n, ["term", "weight"], names.take(pa.array(at)), pa.array(x / norm[row]))

    return rows.select(F.col("key").alias(key), F.explode(weigh("t")).alias("w")).select(key, "w.term", "w.weight")


def bucket(key: Sequence[str], buckets: int, seed: int = 42) -> Column:
    """Bucket 0..buckets-1 of a row from the first eight hex digits of an md5; reruns and engines agree."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *key).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def split(
    df: DataFrame, key: Sequence[str], test_share: float = 0.2, seed: int = 42, out: str = "is_test",
    strata: Sequence[str] | None = None,
) -> DataFrame:
    """Hold-out flag from a hash of the row key.

    Without ``strata`` every row is decided by its own hash. With them exactly the share of every stratum, rounded half up, is held out:
    its first rows in hash order, which a prefix scan numbers.
    """
    if not strata:
        return df.withColumn(out, bucket(key, 10000, seed) < int(test_share * 10000))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *key).cast("binary"))
    rows = df.withColumn("_digest", digest)
    rows = scan(rows, list(strata), ["_digest", *key], sums={"_at": F.lit(1)})
    sizes = df.groupBy(*strata).agg(F.floor(F.count("*") * test_share + 0.5).alias("_held"))
    return null_safe_join(rows, sizes, list(strata)).withColumn(out, F.col("_at") <= F.col("_held")).drop("_digest", "_at", "_held")


def upsample_minority(df: DataFrame, label: str, key: Sequence[str]) -> DataFrame:
    """Repeat minority rows until both classes have the same size.

    Every row is repeated by the whole ratio and the rest goes to the first rows in hash order, which a distributed
    numbering finds.
    """
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    minority = sizes.orderBy("_n", label).limit(1).select(F.col(label).alias("_minor"), F.col("_n").alias("_small"))
    rows = attach_one(df, minority)
    rows = attach_one(rows, sizes.agg(F.max("_n").alias("_large")))
    minor = F.col(label) == F.col("_minor")
    digest = F.md5(F.concat_ws("|", *key).cast("binary"))
    numbered = number_rows(rows.where(minor).withColumn("_digest", digest), ["_digest", *key], "_pos")
    whole = F.floor(F.col("_large") / F.col("_small"))
    extra = F.when(F.col("_pos") <= F.col("_large") % F.col("_small"), 1).otherwise(0)
    copies = numbered.withColumn("copy", F.explode(F.sequence(F.lit(1), (whole + extra).cast("int"))))
    return (
        rows.where(~minor)
        .withColumn("copy", F.lit(1))
        .unionByName(copies.drop("_digest", "_pos"))
        .drop("_minor", "_small", "_large")
    )


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weight of a row: all rows / (classes * rows of its class).

    The weights, one row per class, are written once and sent to every task: the rows stay where they are and no class is one task.
    """
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    totals = sizes.agg(F.sum("_n").alias("_all"), F.count("*").alias("_k"))
    weights = attach_one(sizes, totals).select(
        label, (F.col("_all") / (F.col("_k") * F.col("_n"))).alias(out)
    )
    return null_safe_join(df, F.broadcast(cut_lineage(weights, "class-weights")), [label], "inner")
