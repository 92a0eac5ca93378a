"""Model metrics and leaderboards as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.functions.numbers import half_up
from offerwell.operators.dedup import keep_first
from offerwell.operators.ordered import attach_one


def regression_metrics(df: DataFrame, truth: str, pred: str, by: str | None = None) -> DataFrame:
    """MAE, RMSE and R2, per group when ``by`` is given; rows without a truth or prediction do not count."""
    y, p = F.col(truth), F.col(pred)
    known = df.where(y.isNotNull() & p.isNotNull())
    groups = known.groupBy(by) if by else known.groupBy()
    err = y - p
    out = groups.agg(
        F.avg(F.abs(err)).alias("_mae"),
        F.avg(err * err).alias("_mse"),
        F.var_pop(y).alias("_var"),
        F.count("*").alias("n"),
    )
    return out.select(
        *([by] if by else []),
        "n",
        half_up(F.col("_mae"), 4).alias("mae"),
        half_up(F.sqrt("_mse"), 4).alias("rmse"),
        half_up(1.0 - F.try_divide(F.col("_mse"), F.col("_var")), 4).alias("r2"),
    )


def with_absolute_error(df: DataFrame, truth: str, pred: str, out: str = "abs_error") -> DataFrame:
    return df.withColumn(out, F.abs(F.col(truth) - F.col(pred)))


def classification_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means; 0 on division by zero.

    The confusion table (classes squared) is the only thing that is regrouped.
    """
    cells = df.groupBy(F.col(truth).cast("string").alias("t"), F.col(pred).cast("string").alias("p")).agg(
        F.count("*").alias("n")
    )
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("t").alias("label"), F.lit(1).alias("is_truth")),
                F.struct(F.col("p").alias("label"), F.lit(0).alias("is_truth")),
            )
        ).alias("s"),
        "n",
        (F.col("t") == F.col("p")).alias("hit"),
    ).select("s.label", "s.is_truth", "n", "hit")
    truth_side = F.col("is_truth") == 1
    per = sides.groupBy("label").agg(
        F.coalesce(F.sum(F.when(truth_side & F.col("hit"), F.col("n"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(truth_side, F.col("n"))), F.lit(0)).alias("support"),
        F.coalesce(F.sum(F.when(~truth_side, F.col("n"))), F.lit(0)).alias("predicted"),
    )
    zero = F.lit(0.0)
    per = per.withColumns(
        {
            "precision": F.coalesce(F.try_divide("tp", "predicted"), zero),
            "recall": F.coalesce(F.try_divide("tp", "support"), zero),
        }
    )
    both = F.col("precision") + F.col("recall")
    per = per.withColumn("f1", F.coalesce(F.try_divide(F.col("precision") * F.col("recall") * 2.0, both), zero))
    names = ["precision", "recall", "f1"]
    weight = F.col("support")
    macro = per.agg(*[F.avg(n).alias(n) for n in names], F.sum("support").alias("support"))
    weighted = per.agg(
        *[F.try_divide(F.sum(F.col(n) * weight), F.sum(weight)).alias(n) for n in names],
        F.sum("support").alias("support"),
    )
    accuracy = per.agg(F.try_divide(F.sum("tp"), F.sum("support")).alias("a"), F.sum("support").alias("support"))
    parts = [
        per.select("label", *names, "support"),
        macro.select(F.lit("macro avg").alias("label"), *names, "support"),
        weighted.select(F.lit("weighted avg").alias("label"), *names, "support"),
        accuracy.select(F.lit("accuracy").alias("label"), *[F.col("a").alias(n) for n in names], "support"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("label", *[half_up(F.col(n), 4).alias(n) for n in names], "support")


def merge_leaderboards(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union, best row per model, and the overall winner flagged."""
    best = keep_first(a.unionByName(b), ["model"], ["mae", "rmse", F.desc("r2")])
    first = best.orderBy("mae", "rmse", F.desc("r2"), "model").limit(1).select(F.col("model").alias("_winner"))
    return attach_one(best, first).withColumn("is_winner", F.col("model") == F.col("_winner")).drop("_winner")


def melt_metrics(df: DataFrame, names=("mae", "rmse", "r2")) -> DataFrame:
    return df.unpivot(["model"], list(names), "metric", "value")
