"""Model queries at the library's own settings: train on the stored listings and hold the result against plain SQL.

What SQL can compute (rows, ids, positions, presence rules) is compared exactly. Errors are held against the mean absolute error of the
training mean of each source on the same held-out rows, as a boolean column.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from offerwell.functions.numbers import half_up
from offerwell.operators import features as M
from offerwell.operators import models as X
from offerwell.operators import regression as R
from offerwell.operators.ordered import attach_one
from offerwell.plans.features import _BUCKET, KEY
from offerwell.plans.registry import query, r4
from offerwell.session import cut_lineage, work_dir

#: Largest accepted error in parts of the baseline's; the discounts of the stored listings do not depend on their features.
SLACK = 1.1
_HELD = f"{_BUCKET} % 10000 < 2000"
_TEST = f"SELECT count(*) AS n FROM unified WHERE discount_pct IS NOT NULL AND {_HELD}"


def board_sql(*names: str) -> str:
    models = ", ".join(f"('{n}')" for n in names)
    return f"SELECT model, n, true AS near_baseline FROM (VALUES {models}) AS m(model), ({_TEST})"


#: Columns of ``unified`` that features, targets, hold-out flags and results are made of.
INPUTS = [
    *KEY, "source", "category", "currency", "location", "seller", "title_clean", "price_initial_mad", "rating", "discount_pct",
    "offre_type",
]
USED = [*KEY, *dict.fromkeys([*M.NUMERIC, *M.CATEGORICAL]), "terms", "discount_pct", "offre_type", "has_offer"]


def dataset(t):
    """Feature rows with a hold-out flag, written once because every fit reads them several times.

    The listings are joined once, for the medians and the features, and dealt to all tasks; only what a fit reads is written.
    """
    listings = t.written().unified.select(INPUTS)
    rows = X.ListingFeatures().fit(listings).transform(listings).select(USED)
    return cut_lineage(M.split(rows, KEY), "features")


def vectors(rows):
    """(train, test) with a feature vector, for rows with a discount."""
    offers = rows.where(F.col("discount_pct").isNotNull())
    model = Pipeline(stages=X.preprocessor()).fit(offers.where(~F.col("is_test")))
    ready = cut_lineage(model.transform(offers).select(*KEY, "source", "discount_pct", "features", "is_test"), "vectors")
    return ready.where(~F.col("is_test")), ready.where(F.col("is_test"))


def held_against(name: str, scored, train):
    """(model, n, near_baseline): held-out rows, and whether the error is near that of the source means."""
    means = train.groupBy("source").agg(F.avg("discount_pct").alias("_mean"))
    rows = X.clipped(scored).join(means, "source", "left")
    error = lambda c: F.avg(F.abs(F.col("discount_pct") - F.col(c)))
    out = rows.agg(F.count("prediction").alias("n"), error("prediction").alias("_mae"), error("_mean").alias("_base"))
    return out.select(F.lit(name).alias("model"), "n", (F.col("_mae") <= F.col("_base") * SLACK).alias("near_baseline"))


def board(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _rank(col: str) -> str:
    return f"SELECT {col}, row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS at FROM l GROUP BY 1"


@query(
    "one_hot",
    f"""WITH l AS (SELECT link, source, coalesce(category, 'unknown') AS category FROM listings),
    s AS ({_rank('source')}), c AS ({_rank('category')})
    SELECT link, s.at AS source_at, c.at AS category_at FROM l JOIN s USING (source) JOIN c USING (category)""",
)
def _(t):
    rows = X.one_hot(t.listings.fillna("unknown", ["category"]), ["source", "category"])
    at = lambda c: (F.array_position(vector_to_array(c), 1.0) - 1).cast("bigint")
    return rows.select("link", at("source_hot").alias("source_at"), at("category_hot").alias("category_at"))


# With all 64 axes kept the projection preserves the length of every vector.
@query(
    "reduce_dims",
    f"SELECT vec_id, {r4('list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))')} AS energy, 64 AS axes, "
    "true AS shortened FROM embeddings",
)
def _(t):
    """All axes keep every length; the first eight keep what their singular values say, and no vector grows."""
    rows = t.embeddings.select("vec_id", array_to_vector("embedding").alias("features"))
    projected, singular = X.reduce_dims(rows, "vec_id", "features", 64)
    energy = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)
    cut, few = X.reduce_dims(rows, "vec_id", "features", 8)
    kept = cut.select("vec_id", energy("svd").alias("_cut"))
    total = kept.agg(F.sum("_cut").alias("_sum"))
    out = attach_one(projected.join(kept, "vec_id"), total)
    right = F.abs(F.col("_sum") - sum(s * s for s in few)) <= 1e-6 * F.col("_sum")
    same = all(abs(a - b) <= 1e-6 * a for a, b in zip(singular, few))
    short = right & F.lit(same) & (F.col("_cut") <= energy("svd") * (1 + 1e-9))
    return out.select("vec_id", half_up(energy("svd"), 4).alias("energy"), F.size("svd").alias("axes"), short.alias("shortened"))


def balanced(scored, truth: str, pred: str):
    """(n, balanced): rows, and whether the mean recall of both classes is not below that of chance by more than 0.05."""
    hit = (F.col(truth).cast("int") == F.col(pred).cast("int")).cast("double")
    recall = [F.avg(F.when(F.col(truth).cast("int") == k, hit)) for k in (0, 1)]
    return scored.agg(F.count(pred).alias("n"), ((recall[0] + recall[1]) / 2 >= 0.45).alias("balanced"))


@query("fit_has_offer", f"SELECT count(*) AS n, true AS balanced FROM unified WHERE {_HELD}")
def _(t):
    rows = dataset(t)
    model = X.fit_has_offer(rows.where(~F.col("is_test")), X.preprocessor())
    return balanced(model.transform(rows.where(F.col("is_test"))), "has_offer", "pred_has_offer")


@query("fit_offer_type", f"SELECT count(*) AS n, true AS balanced FROM unified WHERE discount_pct IS NOT NULL AND offre_type <> '' AND {_HELD}")
def _(t):
    rows = dataset(t).where("discount_pct IS NOT NULL AND offre_type <> ''")
    upsampled = cut_lineage(M.upsample_minority(rows.where(~F.col("is_test")), "offre_type", KEY), "upsampled")
    scored = X.fit_offer_type(upsampled, X.preprocessor()).transform(rows.where(F.col("is_test")))
    return balanced(scored.withColumn("flat", F.col("offre_type") == "forfaite"), "flat", "pred_is_flat")


LINEAR = ["ridge", "lasso", "elastic_net", "ols", "huber"]
TREES = ["decision_tree", "random_forest", "extra_trees", "boosting"]


@query("fit_linear", board_sql(*LINEAR))
def _(t):
    train, test = vectors(dataset(t))
    return board([held_against(k, X.linear(k).fit(train).transform(test), train) for k in LINEAR])


@query("fit_tree", board_sql(*TREES))
def _(t):
    train, test = vectors(dataset(t))
    return board([held_against(k, X.tree(k).fit(train).transform(test), train) for k in TREES])


@query(
    "fit_per_source",
    f"SELECT source, count(*) AS n, true AS near_baseline FROM unified WHERE discount_pct IS NOT NULL AND {_HELD} GROUP BY 1",
)
def _(t):
    train, test = vectors(dataset(t))
    scored = R.PerSourceRidge().fit(train).transform(test)
    means = train.groupBy("source").agg(F.avg("discount_pct").alias("_mean"))
    off = lambda c: F.abs(F.col("discount_pct") - F.col(c))
    out = scored.join(means, "source").groupBy("source").agg(
        F.count("prediction").alias("n"), F.avg(off("prediction")).alias("_mae"), F.avg(off("_mean")).alias("_base"), F.stddev_pop(off("_mean")).alias("_sd")
    )
    # Errors of few rows are uncertain: three standard errors are allowed besides.
    near = F.col("_mae") <= F.col("_base") * SLACK + 3 * F.col("_sd") / F.sqrt("n")
    return out.select("source", "n", near.alias("near_baseline"))


# Two features without penalty have a closed form: the normal equations of the centred sums.
@query(
    "per_source_coefficients",
    f"""
    WITH l AS (SELECT source, ln(1 + price_initial_mad) AS x, coalesce(rating, 0) AS z, discount_pct AS y FROM unified
        WHERE discount_pct IS NOT NULL AND price_initial_mad IS NOT NULL),
    m AS (SELECT source, count(*) AS n, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS xx, var_pop(z) AS zz, covar_pop(x, z) AS xz,
        covar_pop(x, y) AS xy, covar_pop(z, y) AS zy FROM l GROUP BY GROUPING SETS ((source), ())),
    c AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS c FROM m)
    SELECT source, n, {r4('b')} AS price_slope, {r4('c')} AS rating_slope, {r4('my - b * mx - c * mz')} AS intercept FROM c
    """,
)
def _(t):
    rows = t.unified.where("discount_pct IS NOT NULL AND price_initial_mad IS NOT NULL")
    pair = F.array(F.log1p("price_initial_mad"), F.coalesce(F.col("rating").cast("double"), F.lit(0.0)))
    rows = rows.select("source", "discount_pct", array_to_vector(pair).alias("features"))
    fits = R.PerSourceRidge(reg=0.0, min_rows=1).fit(rows).fits
    slope = lambda k: half_up(F.get("coefficients", F.lit(k)), 4)
    return fits.select(F.col("name").alias("source"), "n", slope(0).alias("price_slope"), slope(1).alias("rating_slope"), half_up(F.col("intercept"), 4).alias("intercept"))


@query("select_features", board_sql("selected"))
def _(t):
    train, test = vectors(dataset(t))
    slicer, _ = X.select_features(train)
    model = X.linear("ridge", features="selected").fit(slicer.transform(train))
    return held_against("selected", model.transform(slicer.transform(test)), train)


@query("stack", board_sql("stack"))
def _(t):
    train, test = vectors(dataset(t))
    bases = {"ridge": X.linear("ridge"), "tree": X.tree("decision_tree")}
    return held_against("stack", X.stack(train, test, bases, KEY), train)


@query(
    "cross_validate",
    f"SELECT count(*) AS n, true AS near_baseline FROM unified WHERE discount_pct IS NOT NULL AND NOT ({_HELD})",
)
def _(t):
    train, _ = vectors(dataset(t))
    mae = X.cross_validate(X.linear("ridge"), train, KEY)
    means = train.groupBy("source").agg(F.avg("discount_pct").alias("_mean"))
    base = train.join(means, "source").agg(
        F.count("*").alias("n"), F.avg(F.abs(F.col("discount_pct") - F.col("_mean"))).alias("_base")
    )
    return base.select("n", (F.lit(mae) <= F.col("_base") * SLACK).alias("near_baseline"))


@query("random_search", board_sql("tuned"))
def _(t):
    train, test = vectors(dataset(t))
    est = X.tree("decision_tree")
    space = {est.maxDepth: [2, 4, 6, 8, 10], est.minInstancesPerNode: [2, 4, 8, 16]}
    model, _, _ = X.random_search(est, space, 15, train, KEY)
    return held_against("tuned", model.transform(test), train)


@query("log_target", board_sql("log_ridge"))
def _(t):
    train, test = vectors(dataset(t))
    return held_against("log_ridge", X.LogTargetRegressor(X.linear("ridge")).fit(train).transform(test), train)


@query("score_two_stage", f"SELECT id, true AS consistent FROM unified WHERE {_HELD}")
def _(t):
    """Type and discount are there exactly where an offer is predicted, and the discount is in 0..99."""
    rows = dataset(t)
    train, test = rows.where(~F.col("is_test")), rows.where(F.col("is_test"))
    has_offer = X.fit_has_offer(train, X.preprocessor())
    typed = train.where("discount_pct IS NOT NULL AND offre_type <> ''")
    upsampled = cut_lineage(M.upsample_minority(typed, "offre_type", KEY), "upsampled")  # every stage of the fit reads it
    kind = X.fit_offer_type(upsampled, X.preprocessor())
    discount = Pipeline(stages=[*X.preprocessor(), X.linear("ridge")]).fit(train.where(F.col("discount_pct").isNotNull()))
    scored = X.score_two_stage(test, has_offer, kind, discount)
    yes, off = F.col("pred_has_offer") == 1, F.col("pred_discount_pct")
    there = F.col("pred_offer_type").isin("forfaite", "pourcentage") & off.between(0.0, 99.0)
    none = F.col("pred_offer_type").isNull() & off.isNull()
    return scored.select("id", F.when(yes, there).otherwise(none).alias("consistent"))


@query("save_load_model", f"SELECT id, discount_pct, true AS same FROM unified WHERE discount_pct IS NOT NULL AND {_HELD}")
def _(t):
    """The whole pipeline, from listings to the fits of every source, predicts the same after it was saved and loaded."""
    offers = t.dealt().unified.select(INPUTS).where(F.col("discount_pct").isNotNull())
    rows = cut_lineage(M.split(offers, KEY), "offers")
    path = work_dir(t.spark, "model")
    # The pipeline is fitted in three parts, so that features and vectors are computed once and not for every later stage.
    train = rows.where(~F.col("is_test"))
    listing = X.ListingFeatures().fit(train)
    train = cut_lineage(listing.transform(train).select(*USED), "features")
    prepared = Pipeline(stages=X.preprocessor()).fit(train)
    train = cut_lineage(prepared.transform(train).select("source", "discount_pct", "features"), "vectors")
    model = PipelineModel([listing, *prepared.stages, R.PerSourceRidge().fit(train)])
    X.save_model(model, path)
    chosen = rows.where(F.col("is_test")).select("id")
    before = model.transform(rows.where(F.col("is_test"))).select(*KEY, F.col("prediction").alias("_before"))
    after = X.score_subset(X.load_model(path), rows, chosen).where(F.col("is_test"))
    same = F.abs(F.col("prediction") - F.col("_before")) < 1e-9
    return after.join(before, KEY).select("id", "discount_pct", same.alias("same"))
