"""Discount models on Spark ML: pipelines, per-source ensemble, stacking, search and two-stage scoring."""

from __future__ import annotations

import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    ElementwiseProduct,
    Imputer,
    Normalizer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.functions.numbers import clip
from offerwell.operators.features import CATEGORICAL, NUMERIC, base_features, bucket, class_weights, ngrams, rating_medians, tokens
from offerwell.operators.persist import SavedStage
from offerwell.operators.trees import TreeRegressor
from offerwell.session import cut_lineage


class ListingFeatures(Estimator):
    """``base_features`` as a pipeline stage, plus the word and word-pair column of the title.

    The fit keeps the median rating of every source, so that a row's features do not depend on the batch it is scored in.
    """

    def __init__(self, text: str = "title_clean", out: str = "terms"):
        super().__init__()
        self.text, self.out = text, out

    def _fit(self, dataset: DataFrame) -> ListingFeaturesModel:
        return ListingFeaturesModel(cut_lineage(rating_medians(dataset), "medians"), self.text, self.out)


class ListingFeaturesModel(SavedStage, Model):
    def __init__(self, medians: DataFrame, text: str, out: str):
        super().__init__()
        self.medians, self.text, self.out = medians, text, out

    def fields(self) -> dict:
        return {"text": self.text, "out": self.out}

    def parts(self) -> dict:
        return {"medians": self.medians}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = base_features(dataset, self.medians).withColumn("_words", tokens(F.col(self.text)))  # split once, not for every pair
        return rows.withColumn(self.out, ngrams(F.col("_words"))).drop("_words")


class SmoothIdf(Estimator):
    """Term counts times the smoothed inverse document frequency plus one, as in ``features.tfidf``."""

    def __init__(self, inputCol: str, outputCol: str):
        super().__init__()
        self.inputCol, self.outputCol = inputCol, outputCol

    def _fit(self, dataset: DataFrame) -> ElementwiseProduct:
        idf = IDF(inputCol=self.inputCol, outputCol=self.outputCol).fit(dataset).idf.toArray()
        return ElementwiseProduct(scalingVec=Vectors.dense(idf + 1.0), inputCol=self.inputCol, outputCol=self.outputCol)


def preprocessor(
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    terms: str | None = "terms",
    max_terms: int = 1000,
    out: str = "features",
) -> list:
    """Stages: median imputing, scaling without centring, one-hot (unknown is all zeros), term weights, one vector."""
    numeric, categorical = list(numeric), list(categorical)
    stages = [
        Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}_num" for c in numeric]),
        VectorAssembler(inputCols=[f"{c}_num" for c in numeric], outputCol="_numbers"),
        StandardScaler(withMean=False, withStd=True, inputCol="_numbers", outputCol="_scaled"),
        StringIndexer(
            inputCols=categorical, outputCols=[f"{c}_idx" for c in categorical], handleInvalid="keep",
            stringOrderType="frequencyDesc",
        ),
        OneHotEncoder(
            inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_hot" for c in categorical],
            handleInvalid="keep", dropLast=True,
        ),
    ]
    parts = ["_scaled", *[f"{c}_hot" for c in categorical]]
    if terms:
        stages += [
            CountVectorizer(inputCol=terms, outputCol="_counts", vocabSize=max_terms, minDF=2.0),
            SmoothIdf(inputCol="_counts", outputCol="_idf"),
            Normalizer(inputCol="_idf", outputCol="_text"),
        ]
        parts.append("_text")
    return [*stages, VectorAssembler(inputCols=parts, outputCol=out)]


def one_hot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-hot vectors; an unseen category is all zeros."""
    stages = [
        StringIndexer(inputCols=list(cols), outputCols=[f"{c}_idx" for c in cols], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_hot" for c in cols]),
    ]
    return Pipeline(stages=stages).fit(df).transform(df)


def reduce_dims(df: DataFrame, key: str, features: str, k: int):
    """Truncated singular value decomposition without centring.

    Returns (rows with the projected ``svd`` array, singular values). Every task sums its part of the Gram matrix, so
    the driver sees features x features numbers however many rows there are.
    """

    def partial_gram(batches):
        gram = None
        for pdf in batches:
            x = np.array(pdf["v"].tolist(), dtype="float64")
            gram = x.T @ x if gram is None else gram + x.T @ x
        if gram is not None:
            yield pd.DataFrame({"i": np.arange(len(gram), dtype="int32"), "row": gram.tolist()})

    rows = df.select(key, vector_to_array(features).alias("v"))
    grams = rows.select("v").mapInPandas(partial_gram, "i int, row array<double>")
    cells = grams.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    size = max(c["i"] for c in cells) + 1
    gram = np.zeros((size, size))
    for c in cells:
        gram[c["i"], c["j"]] = c["x"]
    values, axes = np.linalg.eigh(gram)
    best = np.argsort(values)[::-1][:k]
    axes = axes[:, best]

    @F.pandas_udf("array<double>")
    def project(v: pd.Series) -> pd.Series:
        return pd.Series((np.array(v.tolist(), dtype="float64") @ axes).tolist())

    singular = [float(s) for s in np.sqrt(np.maximum(values[best], 0.0))]
    return rows.select(key, project("v").alias("svd")), singular


def linear(kind: str, label: str = "discount_pct", features: str = "features") -> LinearRegression:
    """Ridge, lasso, elastic net, plain or Huber regression."""
    common = dict(labelCol=label, featuresCol=features)
    return {
        "ridge": lambda: LinearRegression(regParam=0.01, elasticNetParam=0.0, **common),
        "lasso": lambda: LinearRegression(regParam=0.001, elasticNetParam=1.0, **common),
        "elastic_net": lambda: LinearRegression(regParam=0.001, elasticNetParam=0.5, **common),
        "ols": lambda: LinearRegression(regParam=0.0, **common),
        "huber": lambda: LinearRegression(loss="huber", epsilon=1.35, regParam=0.0001, **common),
    }[kind]()


def tree(kind: str, label: str = "discount_pct", features: str = "features", size: int | None = None):
    """Decision tree, random forest (also for extra trees) and gradient boosting (all boosting libraries)."""
    common = dict(labelCol=label, featuresCol=features, seed=42)
    forest = dict(numTrees=size or 100, maxDepth=10, minInstancesPerNode=2, featureShare=1 / 3, **common)
    return {
        "decision_tree": lambda: TreeRegressor(maxDepth=10, minInstancesPerNode=4, **common),
        "random_forest": lambda: TreeRegressor(**forest),
        "extra_trees": lambda: TreeRegressor(subsamplingRate=1.0, **forest),
        "boosting": lambda: TreeRegressor(maxIter=size or 60, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, **common),
    }[kind]()


def clipped(df: DataFrame, col: str = "prediction") -> DataFrame:
    return df.withColumn(col, clip(F.col(col), 0.0, 99.0))


def fit_has_offer(train: DataFrame, stages: list, max_iter: int = 50) -> PipelineModel:
    """Balanced logistic regression for "has an offer"."""
    weighted = class_weights(train, "has_offer")
    lr = LogisticRegression(
        labelCol="has_offer", featuresCol="features", weightCol="weight", maxIter=max_iter, regParam=1e-4,
        predictionCol="pred_has_offer", probabilityCol="has_offer_prob", rawPredictionCol="has_offer_raw",
    )
    return Pipeline(stages=[*stages, lr]).fit(weighted)


def fit_offer_type(train: DataFrame, stages: list, max_iter: int = 50) -> PipelineModel:
    """Logistic regression for the offer type, on rows already rebalanced."""
    target = SQLTransformer(
        statement="SELECT *, CASE WHEN offre_type = 'forfaite' THEN 1.0D ELSE 0.0D END AS is_flat FROM __THIS__"
    )
    lr = LogisticRegression(
        labelCol="is_flat", featuresCol="features", maxIter=max_iter, regParam=1e-4,
        predictionCol="pred_is_flat", probabilityCol="is_flat_prob", rawPredictionCol="is_flat_raw",
    )
    return Pipeline(stages=[target, *stages, lr]).fit(train)


class PerSourceRegressor(Estimator):
    """One regressor of any kind per source with enough rows and a global fallback.

    For a handful of sources: their fits run as concurrent Spark jobs on filtered frames. ``regression.PerSourceRidge`` fits any
    number of them in one pass.
    """

    def __init__(self, base: Estimator, source: str = "source", min_rows: int = 30, parallelism: int = 4):
        super().__init__()
        self.base, self.source, self.min_rows, self.parallelism = base, source, min_rows, parallelism

    def _fit(self, dataset: DataFrame) -> PerSourceModel:
        sizes = dataset.groupBy(self.source).agg(F.count("*").alias("n")).where(F.col("n") >= self.min_rows)
        names = sorted(r[self.source] for r in sizes.collect())
        with ThreadPoolExecutor(self.parallelism) as pool:
            fallback = pool.submit(self.base.fit, dataset)
            fits = {n: pool.submit(self.base.fit, dataset.where(F.col(self.source) == n)) for n in names}
            return PerSourceModel({n: f.result() for n, f in fits.items()}, fallback.result(), self.source)


class PerSourceModel(SavedStage, Model):
    """Predictions of the source's model, of the fallback for other sources, clipped to 0..99."""

    def __init__(self, models: dict, fallback, source: str):
        super().__init__()
        self.models, self.fallback, self.source = models, fallback, source

    def fields(self) -> dict:
        return {"source": self.source, "names": list(self.models)}

    def parts(self) -> dict:
        return {"fallback": self.fallback} | {f"model-{k}": m for k, m in enumerate(self.models.values())}

    @classmethod
    def restored(cls, fields: dict, parts: dict) -> PerSourceModel:
        return cls({n: parts[f"model-{k}"] for k, n in enumerate(fields["names"])}, parts["fallback"], fields["source"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """All models score in one pass over the rows; each row takes the prediction of its source."""
        out = self.fallback.transform(dataset).withColumnRenamed("prediction", "_fallback")
        chosen = None
        for i, (name, model) in enumerate(self.models.items()):
            out = model.transform(out).withColumnRenamed("prediction", f"_own{i}")
            mine = F.col(self.source) == name
            chosen = F.when(mine, F.col(f"_own{i}")) if chosen is None else chosen.when(mine, F.col(f"_own{i}"))
        own = F.lit(None).cast("double") if chosen is None else chosen
        rows = out.withColumn("prediction", F.coalesce(own, "_fallback"))
        return clipped(rows.drop("_fallback", *[f"_own{i}" for i in range(len(self.models))]))


def select_features(train: DataFrame, features: str = "features", out: str = "selected", label: str = "discount_pct"):
    """Slicer keeping the components whose tree importance is at least the mean."""
    forest = tree("random_forest", label, features).fit(train)
    weights = forest.featureImportances.toArray()
    keep = [int(i) for i in (weights >= weights.mean()).nonzero()[0]]
    return VectorSlicer(inputCol=features, outputCol=out, indices=keep), keep


def stack(train: DataFrame, test: DataFrame, bases: dict, key: Sequence[str], folds: int = 5, label="discount_pct"):
    """Out-of-fold base predictions feed a ridge model; returns clipped test predictions."""
    names = list(bases)
    folded = train.withColumn("_fold", bucket(key, folds, seed=7))

    def level_one(models: dict, rows: DataFrame) -> DataFrame:
        for n in names:
            rows = models[n].transform(rows).withColumnRenamed("prediction", f"base_{n}")
        return rows

    parts = []
    for i in range(folds):
        models = {n: bases[n].fit(folded.where(F.col("_fold") != i)) for n in names}
        parts.append(level_one(models, folded.where(F.col("_fold") == i)))
    out_of_fold = parts[0]
    for p in parts[1:]:
        out_of_fold = out_of_fold.unionByName(p)
    assembler = VectorAssembler(inputCols=[f"base_{n}" for n in names], outputCol="_stacked")
    meta = LinearRegression(labelCol=label, featuresCol="_stacked", regParam=0.01).fit(assembler.transform(out_of_fold))
    final = level_one({n: bases[n].fit(train) for n in names}, test)
    return clipped(meta.transform(assembler.transform(final)))


def mae_evaluator(label: str = "discount_pct") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="mae")


def _fold_errors(est: Estimator, settings: list[dict], df: DataFrame, key: Sequence[str], folds: int, seed: int, label: str) -> list[float]:
    """Mean MAE of every setting over hash folds.

    The folds are filters on ``df`` and are fitted one after the other, while models that are ready are scored: nothing but what a fit itself holds
    is kept on the executors. A fold without rows to learn from or to predict is an error.
    """
    rows = df.withColumn("_fold", bucket(key, folds, seed=seed).cast("int"))
    sizes = {r["_fold"]: r["n"] for r in rows.groupBy("_fold").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < max(folds, 2):
        raise ValueError("a fold has no rows")
    evaluator, scored = mae_evaluator(label), []
    with ThreadPoolExecutor(4) as pool:
        for i in range(folds):
            held = rows.where(F.col("_fold") == i)
            for k, model in est.fitMultiple(rows.where(F.col("_fold") != i), settings):
                scored.append((k, pool.submit(lambda m, h, s: evaluator.evaluate(m.transform(h, s)), model, held, settings[k])))
    total = [0.0] * len(settings)
    for k, error in scored:
        total[k] += error.result()
    return [t / folds for t in total]


def cross_validate(est: Estimator, df: DataFrame, key: Sequence[str], folds: int = 5, label: str = "discount_pct") -> float:
    """Mean MAE over hash folds."""
    return _fold_errors(est, [{}], df, key, folds, 11, label)[0]


def random_search(est: Estimator, space: dict, n: int, df: DataFrame, key: Sequence[str], folds: int = 3, seed: int = 42,
                  label: str = "discount_pct"):
    """``n`` random settings of ``space`` (param -> values), best by MAE; returns (model, best MAE, settings)."""
    rng = random.Random(seed)
    grids = []
    for _ in range(n):
        builder = ParamGridBuilder()
        for param, values in space.items():
            builder = builder.baseOn({param: rng.choice(values)})
        grids.append(builder.build()[0])
    errors = _fold_errors(est, grids, df, key, folds, 13, label)
    best = min(range(n), key=lambda i: errors[i])
    return est.fit(df, grids[best]), float(errors[best]), {p.name: v for p, v in grids[best].items()}


class LogTargetRegressor(Estimator):
    """Fit on log1p of the label and predict on the original scale."""

    def __init__(self, base: Estimator, label: str = "discount_pct"):
        super().__init__()
        self.base, self.label = base, label

    def _fit(self, dataset: DataFrame) -> LogTargetModel:
        rows = dataset.withColumn("_log_label", F.log1p(self.label))
        return LogTargetModel(self.base.copy({self.base.labelCol: "_log_label"}).fit(rows))


class LogTargetModel(SavedStage, Model):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def parts(self) -> dict:
        return {"model": self.model}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model.transform(dataset).withColumn("prediction", F.expm1("prediction"))


def score_two_stage(df: DataFrame, has_offer: Model, offer_type: Model, discount: Model) -> DataFrame:
    """Predicted offer flag for every row; type and discount only where an offer is predicted."""
    keep = [c for c in df.columns]
    one = has_offer.transform(df).select(*keep, "pred_has_offer")
    two = offer_type.transform(one).select(*keep, "pred_has_offer", "pred_is_flat")
    three = clipped(discount.transform(two))
    yes = F.col("pred_has_offer") == 1
    return three.select(
        *keep,
        F.col("pred_has_offer").cast("int").alias("pred_has_offer"),
        F.when(yes, F.when(F.col("pred_is_flat") == 1, "forfaite").otherwise("pourcentage")).alias("pred_offer_type"),
        F.when(yes, F.col("prediction")).alias("pred_discount_pct"),
    )


def score_subset(model: Model, df: DataFrame, chosen: DataFrame, key: str = "id") -> DataFrame:
    """Clipped predictions for the chosen keys."""
    return clipped(model.transform(df.join(chosen.select(key).distinct(), key, "left_semi")))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
