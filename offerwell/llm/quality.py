"""Quality and toxicity classifier trained by co-training (Blum and Mitchell, 1998).

Two views of a document have a classifier each: its text (which terms occur) and its page metadata (language, source, size, line and
character statistics). Both are fitted on the labelled training fold; in every round each one labels the unlabelled
documents it is surest of, and these become training rows of the other. Each view is then calibrated on a held-out labelled fold, and a
logistic combination of both calibrated views scores every document.

Fitting uses at most ``max_labelled`` labelled documents, chosen by a hash of their id and weighted to stand for all labelled ones.
Terms are counted over all documents, and every unlabelled document is scored in every round and can become a training row. The features
of all documents are computed and written once, for fitting and scoring.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwell.session import cut_lineage, release

#: A term is a run of letters (lower-cased), digits, or of one other mark.
TERM = r"[\p{L}\p{M}]+|\p{N}+|[^\p{L}\p{M}\p{N}\s]{1,8}"
ALWAYS = " "  # a term of every document
NUMBERS = ["size", "line_length", "upper_share", "mark_share", "space_share", "word_length", "distinct", "repeated"]


@dataclass(frozen=True)
class Settings:
    max_labelled: int = 16_000
    terms: int = 1 << 16  # the most frequent ones of all documents
    least_documents: int = 10
    buckets: int = 1 << 10
    rounds: int = 2
    share: float = 0.1  # of the unlabelled documents that a view may label in a round, for each class
    sure: float = 0.95  # least confidence of a pseudo-label
    iterations: int = 40  # of the text view
    page_iterations: int = 40
    penalty: float = 3e-4  # L1 for the terms, so that chance words of long texts get no weight; L2 for the page view
    reject: float = 0.5  # a document is rejected from this probability on


@dataclass
class Classifier:
    """Fitted views; ``constant`` is the score of all documents where the labels hold one class only."""

    text: PipelineModel | None = None
    page: PipelineModel | None = None
    calibrated: PipelineModel | None = None
    combined: PipelineModel | None = None
    constant: float | None = None
    settings: Settings = field(default_factory=Settings)


def views(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """``docs`` in the column doc (a struct), with the inputs of both views: null texts are empty, null language and source are 'none'."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    n = F.length("body")
    kept = lambda pattern: F.length(F.regexp_replace("body", pattern, ""))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), body.alias("body"), *[
        F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(name) for name, c in (("lang", lang), ("source", source))
    ])
    least = F.greatest(n, F.lit(1))
    words = n - kept(r"\s+") + 1
    rows = rows.withColumn("all", F.regexp_extract_all(F.lower("body"), F.lit(TERM), F.lit(0)))
    rows = rows.withColumn("terms", F.array_distinct("all"))
    return rows.select(
        "doc",
        "lang",
        "source",
        F.concat(F.array(F.lit(ALWAYS)), "terms").alias("terms"),
        F.log1p(F.size("terms")).alias("distinct"),
        (F.size("terms") / F.greatest(F.size("all"), F.lit(1))).alias("repeated"),
        F.log1p(n).alias("size"),
        F.log1p(n / (n - kept(r"\n") + 1)).alias("line_length"),
        ((n - kept(r"\p{Lu}")) / least).alias("upper_share"),
        ((n - kept(r"[^\p{L}\p{M}\p{N}\s]")) / least).alias("mark_share"),
        ((n - kept(r"\s")) / least).alias("space_share"),
        F.log1p(n / words).alias("word_length"),
    )


def _fold(rows: DataFrame, n: int, buckets: int):
    return F.pmod(F.xxhash64("id", F.lit(n)), F.lit(buckets))


def _logistic(view: str, settings: Settings) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=view, labelCol="y", weightCol="w", probabilityCol=f"{view}_p", rawPredictionCol=f"{view}_r", predictionCol=f"{view}_y",
        maxIter=settings.iterations if view == "text_v" else settings.page_iterations, regParam=settings.penalty, elasticNetParam=1.0 if view == "text_v" else 0.0,
    )


def _vectorizers(docs: DataFrame, text: str, settings: Settings) -> tuple:
    """Feature stages of both views, with the terms that most of all documents have (ties at the bound are left out)."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(TERM), F.lit(0)))
    counts = docs.select(F.explode(found).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    counts = cut_lineage(counts.where(F.col("n") >= settings.least_documents), "term-counts")
    least, total = None, 0
    for r in sorted(counts.groupBy("n").agg(F.count("*").alias("terms")).collect(), key=lambda r: -r["n"]):
        total += r["terms"]
        if total >= settings.terms:  # ALWAYS takes one place
            break
        least = r["n"]
    always = docs.sparkSession.createDataFrame([(ALWAYS,)], "term string")  # in every document, so no vocabulary is empty
    vocabulary = always.unionAll(counts.where(F.col("n") >= least if least else F.lit(False)).select("term"))
    terms = CountVectorizer(inputCol="terms", outputCol="text_v", vocabSize=settings.terms, minDF=1.0, binary=True)
    page = FeatureHasher(inputCols=["lang", "source", *NUMBERS], outputCol="page_v", numFeatures=settings.buckets)
    return terms.fit(vocabulary.select(F.array("term").alias("terms"))), page


def _step(view: str):
    """Margin of a scored view in hundredths."""
    return F.round(F.greatest(F.lit(-40.0), F.least(F.lit(40.0), vector_to_array(f"{view}_r")[1])) * 100).cast("int")


def _cuts(free: DataFrame, models: dict, settings: Settings) -> dict:
    """(step, part) of each view for surely bad and surely good documents, the surest share of all of ``free``: all
    above the step, and of the step itself a part by a hash of the id."""
    scored = free
    for model in models.values():
        scored = model.transform(scored)
    steps = scored.select(F.explode(F.array(*[F.struct(F.lit(v).alias("view"), _step(v).alias("step")) for v in models])).alias("s"))
    counts = [(r["view"], r["step"], r["n"]) for r in steps.groupBy("s.view", "s.step").agg(F.count("*").alias("n")).collect()]
    sure = math.ceil(100 * math.log(settings.sure / (1 - settings.sure)))
    cuts = {}
    for view in models:
        for sign in (1, -1):
            mine = sorted(((sign * step, n) for v, step, n in counts if v == view), reverse=True)
            wanted, cut = settings.share * sum(n for _, n in mine), (1 << 20, 0.0)  # beyond all steps: none
            for step, n in mine:
                if step < sure or wanted <= 0:
                    break
                cut = step, min(1.0, wanted / n)
                wanted -= n
            cuts[view, sign] = cut
    return cuts


def _pseudo(free: DataFrame, model: LogisticRegressionModel, view: str, cuts: dict) -> DataFrame:
    """Training rows of the other view: the documents of ``free`` that ``view`` is surest of."""
    place = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 20)) / (1 << 20)

    def beyond(sign: int):
        step, part = cuts[view, sign]
        mine = sign * _step(view)
        return (mine > step) | ((mine == step) & (place < part))

    y = F.when(beyond(1), 1.0).when(beyond(-1), 0.0)
    return model.transform(free).select(y.alias("y"), F.lit(1.0).alias("w"), "text_v", "page_v").where("y IS NOT NULL")


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text",
        lang: str = "lang", source: str = "source") -> Classifier:
    """Classifier of documents to reject: quality 0 or toxic 1 in ``labels`` (key, quality, toxic).

    A null label counts as good (quality) or clean (toxic); of several labels for one id any bad one counts. Labels without a document are not used.
    Without labels, or with labels of one class, every document gets that class (kept where there are none).
    """
    return _fit(docs, labels, settings, key, text, lang, source, [])[0]


def _fit(docs: DataFrame, labels: DataFrame, settings: Settings | None, key: str, text: str, lang: str, source: str, keep: list) -> tuple:
    """(classifier, features of all documents with the columns ``keep`` in doc; none where the classifier is constant)."""
    settings = settings or Settings()
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(bad.cast("double")).alias("y"))
    known = cut_lineage(docs.select(F.col(key).alias("id")).distinct().join(marks, "id"), "labelled-ids")
    # The sample's ids are bounded by the settings, so they can go to every task.
    chosen = cut_lineage(known.orderBy(F.xxhash64("id"), "id").limit(settings.max_labelled), "sample-ids")
    classes = [r["y"] for r in chosen.select("y").distinct().collect()]  # at most two
    if len(classes) < 2:
        return Classifier(constant=classes[0] if classes else 0.0, settings=settings), None
    terms, page = _vectorizers(docs, text, settings)

    inputs = views(docs.select(*dict.fromkeys([key, text, lang, source, *keep])), text, lang, source)
    passed = F.struct(*[F.col(f"doc.`{c}`").alias(c) for c in keep or [key]]).alias("doc")
    inputs = inputs.select(F.col(f"doc.`{key}`").alias("id"), passed, "lang", "source", "terms", *NUMBERS)
    table = cut_lineage(page.transform(terms.transform(inputs)).select("id", "doc", "text_v", "page_v"), "features")
    numbers = table.select("id", "text_v", "page_v")
    sample = numbers.join(F.broadcast(chosen), "id").dropDuplicates(["id"])
    ready = sample.withColumn("w", F.lit(known.count() / chosen.count()))
    ready = cut_lineage(ready.coalesce(max(1, docs.sparkSession.sparkContext.defaultParallelism)), "views")
    # Documents without an id have no label and need no join.
    free = numbers.where("id IS NOT NULL").join(known, "id", "left_anti").unionAll(numbers.where("id IS NULL"))
    free = cut_lineage(free, "unlabelled")
    fold = _fold(ready, 1, 5)
    train, held = (cut_lineage(x, "fold") for x in (ready.where(fold > 0), ready.where(fold == 0)))
    if train.select("y").distinct().count() < 2 or held.select("y").distinct().count() < 2:
        train = held = ready
    train = train.select("y", "w", "text_v", "page_v")
    own = {"text_v": train, "page_v": train}
    models = {}
    for turn in range(settings.rounds + 1):
        models = {}
        for view, rows in own.items():
            release(docs.sparkSession)  # a fit is dozens of jobs
            models[view] = _logistic(view, settings).fit(rows)
        if turn == settings.rounds:
            break
        cuts = _cuts(free, models, settings)
        for view, other in (("text_v", "page_v"), ("page_v", "text_v")):
            # Labels of the last round replace those of the round before.
            own[other] = cut_lineage(train.unionAll(_pseudo(free, models[view], view, cuts)), "round")
    text_model, page_model = PipelineModel([terms, models["text_v"]]), PipelineModel([page, models["page_v"]])
    scored = held
    for model in models.values():
        scored = model.transform(scored)
    release(docs.sparkSession)
    scored = _log_odds(scored, text_m="text_v", page_m="page_v")
    calibrated = Pipeline(stages=[*_logistic_of("text_c", "text_m"), *_logistic_of("page_c", "page_m")]).fit(scored)
    scored = _log_odds(calibrated.transform(scored), text_l="text_c", page_l="page_c")
    release(docs.sparkSession)
    combined = Pipeline(stages=_logistic_of("both", "text_l", "page_l")).fit(scored)
    release(docs.sparkSession)
    return Classifier(text_model, page_model, calibrated, combined, None, settings), table


def _logistic_of(name: str, *inputs: str) -> list:
    """Stages of a logistic model of a few numbers."""
    fit = LogisticRegression(featuresCol=f"{name}_in", labelCol="y", probabilityCol=f"{name}_p", rawPredictionCol=f"{name}_r",
                             predictionCol=f"{name}_y", maxIter=40, regParam=1e-3)
    return [VectorAssembler(inputCols=list(inputs), outputCol=f"{name}_in"), fit]


def _log_odds(scored: DataFrame, **models: str) -> DataFrame:
    """Margins of models as numbers, bounded so that one view alone cannot drown the other."""
    margin = lambda m: F.greatest(F.lit(-12.0), F.least(F.lit(12.0), vector_to_array(f"{m}_r")[1]))
    return scored.withColumns({name: margin(m) for name, m in models.items()})


def score(docs: DataFrame, model: Classifier, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` with text_score, page_score and bad_score (probabilities to be bad) and rejected.

    All columns of ``docs`` pass through, unless they bear a result's name. Null texts are scored as empty ones, null metadata as a value of its own.
    """
    if model.constant is None:
        rows = views(docs, text, lang, source)
        for part in (model.text, model.page):
            rows = part.stages[0].transform(rows)
        return _scored(rows, model, docs.columns)
    value = F.lit(float(model.constant))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"))
    return rows.select(*_passed(docs.columns), *[value.alias(n) for n in NEW[:3]], (value >= model.settings.reject).alias("rejected"))


NEW = ["text_score", "page_score", "bad_score", "rejected"]


def _passed(columns: list) -> list:
    return [F.col(f"doc.`{c}`").alias(c) for c in columns if c not in NEW]


def _scored(rows: DataFrame, model: Classifier, columns: list) -> DataFrame:
    """Scores of rows with the features of both views and the struct doc of ``columns``."""
    for part in (model.text, model.page):
        rows = part.stages[1].transform(rows)
    rows = model.calibrated.transform(_log_odds(rows, text_m="text_v", page_m="page_v"))
    rows = model.combined.transform(_log_odds(rows, text_l="text_c", page_l="page_c"))
    scores = [vector_to_array(c)[1] for c in ("text_c_p", "page_c_p", "both_p")]
    return rows.select(*_passed(columns), *[s.alias(n) for s, n in zip(scores, NEW)], (scores[2] >= model.settings.reject).alias("rejected"))


def classify(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text",
             lang: str = "lang", source: str = "source", keep: list | None = None) -> DataFrame:
    """Fit on ``labels`` and score all ``docs`` (see :func:`fit` and :func:`score`); ``keep`` names the columns that pass through, all by default."""
    keep = docs.columns if keep is None else keep
    model, table = _fit(docs, labels, settings, key, text, lang, source, keep)
    if table is None:
        return score(docs, model, text, lang, source).select(*[c for c in keep if c not in NEW], *NEW)
    return _scored(table, model, keep)
