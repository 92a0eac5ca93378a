"""Feature, split, metric and neighbour queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerwell.functions.numbers import half_up
from offerwell.operators import features as M
from offerwell.operators import knn, metrics, ranking
from offerwell.operators.aggregates import clipped_predictions
from offerwell.plans.registry import query, r2, r4
from offerwell.sources.views import LISTING_ORDER

KEY = ["id", *LISTING_ORDER]
_KEY_SQL = (
    "id, cast(orderkey AS STRING), cast(linenumber AS STRING), cast(partkey AS STRING), cast(suppkey AS STRING), "
    "cast(day AS STRING), cast(cents AS STRING)"
)


def q4(rows, *names):
    return [half_up(F.col(n), 4).alias(n) for n in names]


_BASE = """SELECT u.*, coalesce(rating, median, 4.0) AS rating_filled FROM unified u LEFT JOIN (SELECT source,
    quantile_cont(rating, 0.5) AS median FROM unified GROUP BY 1) m USING (source)"""


@query(
    "base_features",
    f"""SELECT id, {r4('price_initial_mad')} AS price_initial_mad, {r4('ln(1 + greatest(price_initial_mad, 0.0))')} AS
    log_price_initial_mad, cast(rating IS NULL AS INT) AS rating_missing, {r4('rating_filled')} AS rating_filled,
    {r4('greatest(5.0 - rating_filled, 0.0)')} AS rating_gap_to_5,
    concat(source, ' :: ', coalesce(category, 'unknown')) AS source_category,
    concat(seller, ' :: ', source) AS seller_source, cast(discount_pct IS NOT NULL AS INT) AS has_offer FROM ({_BASE})""",
)
def _(t):
    rows = M.base_features(t.unified)
    four = q4(rows, "price_initial_mad", "log_price_initial_mad", "rating_filled", "rating_gap_to_5")
    return rows.select("id", *four, "rating_missing", "source_category", "seller_source", "has_offer")


@query(
    "cap_p99",
    f"""SELECT id, {r4('least(price_initial_mad, (SELECT quantile_cont(price_initial_mad, 0.99) FROM unified))')} AS
    price_initial_mad FROM unified""",
)
def _(t):
    return M.cap_quantile(t.unified, "price_initial_mad", 0.99).select("id", *q4(None, "price_initial_mad"))


@query(
    "temporal_features",
    """SELECT orderkey, coalesce(isodow(d) - 1, -1) AS day_of_week, coalesce(month(d), -1) AS month, coalesce(date_diff(
    'day', (SELECT min(day) FROM listings WHERE linenumber < 7), d), 0) AS days_since_earliest FROM (SELECT orderkey,
    CASE WHEN linenumber < 7 THEN day END AS d FROM listings)""",
)
def _(t):
    rows = t.listings.withColumn("day", F.when(F.col("linenumber") < 7, F.col("day")))
    return M.temporal_features(rows).select("orderkey", "day_of_week", "month", "days_since_earliest")


@query(
    "impute",
    f"""SELECT id, {r4('coalesce(rating, (SELECT quantile_cont(rating, 0.5) FROM unified))')} AS rating,
    coalesce(category, (SELECT category FROM unified WHERE category IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1
    LIMIT 1)) AS category FROM unified""",
)
def _(t):
    rows = M.impute_mode(M.impute_median(t.unified, ["rating"]), ["category"])
    return rows.select("id", *q4(None, "rating"), "category")


@query(
    "scale",
    f"""SELECT id, {r4('price_initial / (SELECT stddev_pop(price_initial) FROM unified)')} AS standard,
    {r4('price_initial / (SELECT quantile_cont(price_initial, 0.75) - quantile_cont(price_initial, 0.25) FROM unified)')}
    AS robust FROM unified""",
)
def _(t):
    rows = M.scale_robust(M.scale_standard(t.unified, "price_initial", "standard"), "price_initial", "robust")
    return rows.select("id", *q4(None, "standard", "robust"))


@query(
    "tfidf",
    f"""WITH w AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w
      FROM documents), g AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)),
      lambda i: concat(w[i], ' ', w[i + 1])))) AS term FROM w),
    c AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2),
    v AS (SELECT term, count(*) AS df, sum(tf) AS a FROM c GROUP BY 1 HAVING count(*) >= 2 ORDER BY a DESC, term
      LIMIT 100),
    x AS (SELECT doc_id, term, tf * (ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) + 1.0) AS x FROM c
      JOIN v USING (term))
    SELECT doc_id, term, {r4('x / sqrt(sum(x * x) OVER (PARTITION BY doc_id))')} AS weight FROM x""",
)
def _(t):
    return M.tfidf(t.documents, "doc_id", "text", 100).select("doc_id", "term", *q4(None, "weight"))


_BUCKET = f"cast(concat('0x', substr(md5(concat_ws('|', '42', {_KEY_SQL})), 1, 8)) AS BIGINT)"


@query("split", f"SELECT id, offre_type, {_BUCKET} % 10000 < 2000 AS is_test FROM unified")
def _(t):
    return M.split(t.unified, KEY).select("id", "offre_type", "is_test")


@query(
    "upsample_minority",
    f"""WITH o AS (SELECT *, md5(concat_ws('|', {_KEY_SQL})) AS h FROM unified WHERE discount_pct IS NOT NULL AND
      offre_type <> ''),
    s AS (SELECT offre_type AS k, count(*) AS n FROM o GROUP BY 1),
    m AS (SELECT k AS minor, n AS small, (SELECT max(n) FROM s) AS large FROM s ORDER BY n, k LIMIT 1),
    r AS (SELECT o.*, row_number() OVER (ORDER BY h) AS pos, small, large FROM o, m WHERE offre_type = minor)
    SELECT offre_type, id, 1 AS copy FROM o, m WHERE offre_type <> minor UNION ALL
    SELECT offre_type, id, unnest(range(1, 1 + large // small + CASE WHEN pos <= large % small THEN 1 ELSE 0 END))
    FROM r""",
)
def _(t):
    rows = t.unified.where("discount_pct IS NOT NULL AND offre_type <> ''")
    return M.upsample_minority(rows, "offre_type", KEY).select("offre_type", "id", "copy")


@query(
    "class_weights",
    f"""SELECT toxic, n, {r4('a / (k * n)')} AS weight FROM (SELECT toxic, count(*) AS n, (SELECT count(*) FROM labels)
    AS a, (SELECT count(DISTINCT toxic) FROM labels) AS k FROM labels GROUP BY 1)""",
)
def _(t):
    rows = M.class_weights(t.labels, "toxic")
    return rows.groupBy("toxic", half_up(F.col("weight"), 4).alias("weight")).agg(F.count("*").alias("n"))


_GUESS = "SELECT source, discount_pct AS y, rating * 2.0 AS p FROM unified WHERE discount_pct IS NOT NULL AND rating IS NOT NULL"
_REG = f"""count(*) AS n, {r4('avg(abs(y - p))')} AS mae, {r4('sqrt(avg((y - p) * (y - p)))')} AS rmse,
    {r4('1.0 - avg((y - p) * (y - p)) / var_pop(y)')} AS r2"""


def guesses(t, factor: float = 2.0):
    return t.unified.withColumn("guess", F.col("rating") * factor)


@query("regression_metrics", f"SELECT {_REG} FROM ({_GUESS})")
def _(t):
    return metrics.regression_metrics(guesses(t), "discount_pct", "guess")


@query(
    "classification_report",
    f"""WITH d AS (SELECT quality AS t, toxic AS p FROM labels), c AS (SELECT cast(l AS STRING) AS label,
      (SELECT count(*) FROM d WHERE t = l AND p = l) AS tp, (SELECT count(*) FROM d WHERE t = l) AS support,
      (SELECT count(*) FROM d WHERE p = l) AS predicted FROM (SELECT t AS l FROM d UNION SELECT p FROM d)),
    m AS (SELECT label, support, tp, coalesce(tp / nullif(predicted, 0), 0) AS precision,
      coalesce(tp / nullif(support, 0), 0) AS recall FROM c),
    f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM m)
    SELECT label, {r4('precision')} AS precision, {r4('recall')} AS recall, {r4('f1')} AS f1, support FROM f UNION ALL
    SELECT 'macro avg', {r4('avg(precision)')}, {r4('avg(recall)')}, {r4('avg(f1)')}, sum(support)::BIGINT FROM f
    UNION ALL SELECT 'weighted avg', {r4('sum(precision*support)/sum(support)')},
      {r4('sum(recall*support)/sum(support)')}, {r4('sum(f1*support)/sum(support)')}, sum(support)::BIGINT FROM f
    UNION ALL SELECT 'accuracy', {r4('sum(tp)/sum(support)')}, {r4('sum(tp)/sum(support)')},
      {r4('sum(tp)/sum(support)')}, sum(support)::BIGINT FROM f""",
)
def _(t):
    return metrics.classification_report(t.labels, "quality", "toxic")


def _board(t, factor: float):
    return metrics.regression_metrics(guesses(t, factor), "discount_pct", "guess", by="source").withColumnRenamed(
        "source", "model"
    )


def _board_sql(factor: float) -> str:
    return f"SELECT source AS model, {_REG} FROM ({_GUESS.replace('2.0', str(factor))}) GROUP BY 1"


_BOTH = f"SELECT * FROM ({_board_sql(2.0)}) UNION ALL SELECT * FROM ({_board_sql(1.5)})"


@query("leaderboard", f"SELECT * FROM ({_BOTH}) ORDER BY mae, rmse, r2 DESC, model LIMIT 15")
def _(t):
    return ranking.leaderboard(_board(t, 2.0).unionByName(_board(t, 1.5)))


@query(
    "merge_leaderboards",
    f"""WITH b AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mae, rmse,
    r2 DESC) AS rn FROM ({_BOTH})) WHERE rn = 1) SELECT *, model = (SELECT model FROM b ORDER BY mae, rmse, r2 DESC,
    model LIMIT 1) AS is_winner FROM b""",
)
def _(t):
    return metrics.merge_leaderboards(_board(t, 2.0), _board(t, 1.5))


@query(
    "melt_metrics",
    "SELECT model, m.metric, CASE m.metric WHEN 'mae' THEN mae WHEN 'rmse' THEN rmse ELSE r2 END AS value FROM "
    f"({_board_sql(2.0)}) CROSS JOIN (VALUES ('mae'), ('rmse'), ('r2')) m(metric)",
)
def _(t):
    return metrics.melt_metrics(_board(t, 2.0))


@query(
    "clip_predictions",
    f"""SELECT id, CASE WHEN rating IS NOT NULL THEN greatest(0.0, least(99.0, {r4('rating * 40.0 - 100.0')})) END AS
    prediction FROM unified""",
)
def _(t):
    rows = t.unified.withColumn("raw", half_up(F.col("rating") * 40.0 - 100.0, 4))
    return clipped_predictions(rows, "raw").select("id", "prediction")


_PAIRS = """SELECT a.vec_id AS query_id, b.vec_id, b.label, round(sqrt(list_sum(list_transform(
    list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))), 9)
    AS distance FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id"""
_NEAR = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS position
    FROM ({_PAIRS})) WHERE position <= 5"""


@query(
    "knn_join",
    f"""SELECT query_id, vec_id, {r4('distance')} AS distance, position, CASE WHEN distance > 0 THEN {r4('1.0/distance')}
    END AS weight FROM ({_NEAR})""",
)
def _(t):
    rows = knn.knn_join(t.embeddings, t.embeddings, 5)
    return rows.select("query_id", "vec_id", *q4(None, "distance"), "position", *q4(None, "weight"))


@query(
    "knn_predict",
    f"""SELECT query_id, {r4('coalesce(avg(label) FILTER (distance = 0), sum(label / nullif(distance, 0)) / sum(1.0 / nullif(distance, 0)))')}
    AS prediction FROM ({_NEAR}) GROUP BY 1""",
)
def _(t):
    near = knn.knn_join(t.embeddings, t.embeddings, 5)
    return knn.knn_predict(near, t.embeddings, "label").select("query_id", *q4(None, "prediction"))


# On the stored vectors the projections find every pair, so the check is the exact join.
@query(
    "knn_join_lsh",
    f"""WITH d AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
      list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS distance FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
    SELECT query_id, vec_id, {r4('distance')} AS distance FROM d WHERE distance < 1.0""",
)
def _(t):
    rows = knn.knn_join_lsh(t.embeddings, t.embeddings, "vec_id", "embedding", 1.0)
    return rows.select("query_id", "vec_id", half_up(F.col("distance"), 4).alias("distance"))
