"""Fitting, scoring, comparing and keeping models; neighbours and SMOTE."""

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators import validation
from larkspur.operators.encode import Preprocessor
from larkspur.operators.evaluate import classification_metrics
from larkspur.operators.joins import Lookup
from larkspur.operators.models import (
    CLASSIFIERS,
    ModelFolder,
    ModelPlan,
    feature_importance,
    score_in_batches,
    score_with_lookups,
)
from larkspur.operators.neighbours import nearest, neighbour_vote, smote
from larkspur.operators.splits import random_split
from larkspur.plans import booking, training
from larkspur.plans.inputs import SALES, SCORED, sales, scored
from larkspur.plans.registry import query
from larkspur.workspace import materialize, new_path, scratch_database

KEYS = ["o_orderkey"]
#: The declared model is fitted with its declared numbers, all others with the defaults.
PARAMS = {
    **{name: {"random_state": 42} for name in ("random_forest", "decision_tree", "gradient_boosting", "xgboost", "catboost")},
    booking.MODEL: booking.MODEL_PARAMS,
}


def orders_with_label(t):
    """Orders with their customer; the label says whether an order is above the middle price and urgent or recent."""
    label = ((F.col("o_totalprice") > 250000) & (F.col("order_year") >= 1998)).cast("int")
    # Splits, folds, fits and scores read the rows several times: joined once.
    return materialize(sales(t).withColumn("label", label).drop("o_orderdate"), "orders")


LABEL = "CAST(o_totalprice > 250000 AND order_year >= 1998 AS INT)"
PREPARATION = Preprocessor(
    numeric=["o_totalprice", "c_acctbal", "order_year", "order_month"],
    categorical=["o_orderpriority", "c_mktsegment"],
    drop=["rest"],
)


def plan(name: str, **options) -> ModelPlan:
    return ModelPlan(name, PREPARATION, PARAMS.get(name, {}), **options)


# The numbers of most fits are not SQL's to give; those of naive Bayes and of a tree of depth one are. tests/ hold the others
# against closed forms, Spark's evaluators and what must hold of any fit.
SPLIT = f"""{SALES}, ranked AS (
  SELECT *, {LABEL} AS label, row_number() OVER (ORDER BY md5(concat_ws(':', o_orderkey, 42))) AS r,
         count(*) OVER () AS n FROM sales),
train AS (SELECT * FROM ranked WHERE r > ceil(n * 0.2)), tested AS (SELECT * FROM ranked WHERE r <= ceil(n * 0.2))"""

_NUMBERS = PREPARATION.numeric
_SCALED = ", ".join(f"({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_pop({c}) FROM train) AS z_{c}" for c in _NUMBERS)
# Features in long form: scaled numbers, and a flag for each category that training rows have.
_LONG = " UNION ALL ".join(
    [f"SELECT o_orderkey, learned, label, '{c}' AS feature, z_{c} AS v FROM scaled" for c in _NUMBERS]
    + [
        f"SELECT o_orderkey, learned, label, '{c}:' || k, CAST(scaled.{c} = k AS DOUBLE) "
        f"FROM scaled, (SELECT DISTINCT {c} AS k FROM train)"
        for c in PREPARATION.categorical
    ]
)
NAIVE_BAYES = f"""WITH {SPLIT}, rows_of AS (SELECT *, true AS learned FROM train UNION ALL SELECT *, false FROM tested),
  scaled AS (SELECT *, {_SCALED} FROM rows_of), long AS ({_LONG}),
  floor AS (SELECT 1e-9 * max(v) AS e FROM (SELECT var_pop(v) AS v FROM long WHERE learned GROUP BY feature)),
  fit AS (SELECT label AS class, feature, avg(v) AS m, var_pop(v) + any_value(e) AS s FROM long, floor WHERE learned
          GROUP BY 1, 2),
  prior AS (SELECT label AS class, ln(count(*) / (SELECT count(*) FROM train)) AS p FROM train GROUP BY 1),
  odds AS (SELECT o_orderkey, any_value(label) AS label, class,
                  sum(-0.5 * (v - m) * (v - m) / s - 0.5 * ln(s)) + any_value(p) AS l
           FROM long JOIN fit USING (feature) JOIN prior USING (class) WHERE NOT learned GROUP BY o_orderkey, class),
  pair AS (SELECT o_orderkey, any_value(label) AS label, sum(l) FILTER (class = 1) - sum(l) FILTER (class = 0) AS d
           FROM odds GROUP BY 1)
  SELECT o_orderkey, label, CAST(d > 0 AS DOUBLE) AS prediction, round(1 / (1 + exp(-d)), 6) AS probability FROM pair"""


def _scores(scores):
    return scores.select(*KEYS, "label", "prediction", F.round("probability", 6).alias("probability"))


@query("score_batch")
def _(t):
    train, test = random_split(orders_with_label(t), KEYS)
    return _scores(plan("logistic").fit(train, "label", KEYS).score(test))


for _name in CLASSIFIERS:

    @query(f"fit_{_name}", NAIVE_BAYES if _name == "naive_bayes" else None)
    def _(t, name=_name):
        """One classifier, fitted and scored: prediction and probability of every test row."""
        train, test = random_split(orders_with_label(t), KEYS)
        return _scores(plan(name).fit(train, "label", KEYS).score(test, KEYS))


STUMP = Preprocessor(numeric=["order_year", "order_month"], numeric_strategy="none", missing_strategy="none", drop=["rest"])


@query(
    "fit_tree_of_depth_one",
    f"""WITH {SPLIT}, values_of AS (
          SELECT 'order_year' AS f, order_year AS v, label FROM train UNION ALL SELECT 'order_month', order_month, label FROM train),
        cuts AS (SELECT DISTINCT f, v AS cut FROM values_of),
        sides AS (
          SELECT f, cut, v <= cut AS low, count(*) AS n, avg(label) AS p FROM cuts JOIN values_of USING (f) GROUP BY 1, 2, 3),
        best AS (
          SELECT f, cut FROM sides GROUP BY f, cut HAVING count(*) = 2 ORDER BY sum(n * p * (1 - p)), f DESC, cut LIMIT 1),
        leaves AS (SELECT f, cut, low, p FROM sides JOIN best USING (f, cut))
        SELECT o_orderkey, label, CAST(p > 0.5 AS DOUBLE) AS prediction, round(p, 6) AS probability
        FROM tested JOIN leaves ON low = (CASE f WHEN 'order_year' THEN order_year ELSE order_month END <= cut)""",
)
def _(t):
    """A tree of one cut, over columns with few values: the cut of least impurity, and the share of each side."""
    train, test = random_split(orders_with_label(t), KEYS)
    model = ModelPlan("decision_tree", STUMP, {"max_depth": 1, "random_state": 42}).fit(train, "label", KEYS)
    return _scores(model.score(test))


@query("fit_metrics")
def _(t):
    """Every metric of the models that are quick to fit, as a table."""
    train, test = random_split(orders_with_label(t), KEYS)
    parts = []
    for name in ("logistic", "naive_bayes", "decision_tree"):
        scores = materialize(plan(name).fit(train, "label", KEYS).score(test, KEYS), "scores")
        found = classification_metrics(scores, "label", "prediction", "probability")
        parts.append(found.select(F.lit(name).alias("model"), "*"))
    return reduce(DataFrame.unionByName, parts)


for _strategy in ("random_over", "random_under", "smote"):

    @query(f"fit_balanced_{_strategy}")
    def _(t, strategy=_strategy):
        train, test = random_split(orders_with_label(t), KEYS)
        return _scores(plan("logistic", resampling=strategy).fit(train, "label", KEYS).score(test))


@query("score_with_feature_lookup")
def _(t):
    """Base rows hold key and order columns; customer columns are looked up before scoring."""
    train, _ = random_split(orders_with_label(t), KEYS)
    model = plan("decision_tree").fit(train, "label", KEYS)
    base = t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.year("o_orderdate").alias("order_year"),
        F.month("o_orderdate").alias("order_month"),
        "o_orderpriority",
    )
    lookup = Lookup(t.customer, ["c_acctbal", "c_mktsegment"], ["c_custkey"], ["o_custkey"])
    scored_rows = score_with_lookups(model, base, [lookup])
    return scored_rows.select(*KEYS, "prediction", F.round("probability", 6).alias("probability"))


@query(
    "saved_model_round_trip",
    "SELECT count(*) AS rows, count(*) AS same, 2 AS latest FROM orders",
)
def _(t):
    """Two versions are saved; the newest gives the same predictions after loading."""
    rows = orders_with_label(t)
    first = plan("decision_tree").fit(rows, "label", KEYS)
    second = plan("logistic").fit(rows, "label", KEYS)
    folder = ModelFolder(t.spark, new_path(t.spark, "models"))
    folder.register(first)
    latest = folder.register(second)
    before = second.score(rows).select(*KEYS, F.col("prediction").alias("before"))
    after = folder.load().score(rows).select(*KEYS, F.col("prediction").alias("after"))
    return before.join(after, KEYS).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("before") == F.col("after")).alias("same"),
        F.lit(latest).alias("latest"),
    )


@query(
    "score_foreign_model",
    "SELECT o_orderkey, CAST(o_totalprice / 500000 AS DOUBLE) AS probability FROM orders",
)
def _(t):
    """A model that is not Spark's, called on Arrow batches."""

    def predict(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"o_orderkey": batch["o_orderkey"], "probability": batch["o_totalprice"] / 500000})

    rows = t.orders.select("o_orderkey", "o_totalprice")
    return score_in_batches(rows, predict, "o_orderkey long, probability double")


@query("feature_importance")
def _(t):
    """All importances of a forest, the largest first."""
    model = plan("random_forest").fit(orders_with_label(t), "label", KEYS)
    return feature_importance(t.spark, model)


@query("feature_importance_coefficients")
def _(t):
    model = plan("logistic").fit(orders_with_label(t), "label", KEYS)
    return feature_importance(t.spark, model)


FOLDED = f"""{SCORED}, folded AS (SELECT *, month % 5 AS fold FROM scored),
counted AS (
  SELECT fold, count_if(y = 1 AND prediction = 1) AS tp, count_if(y = 0 AND prediction = 1) AS fp,
         count_if(y = 1 AND prediction = 0) AS fn, avg(CAST(y = prediction AS INT)) AS accuracy FROM folded GROUP BY 1),
by_score AS (SELECT fold, score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM folded GROUP BY 1, 2),
running AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY score DESC) AS tp FROM by_score),
areas AS (SELECT fold, sum(neg * (2.0 * tp - pos) / 2.0) / (sum(pos) * sum(neg)) AS auc FROM running GROUP BY 1),
fold_scores AS (
  SELECT fold, 'accuracy' AS metric, accuracy AS value FROM counted
  UNION ALL SELECT fold, 'precision', tp / (tp + fp) FROM counted
  UNION ALL SELECT fold, 'recall', tp / (tp + fn) FROM counted
  UNION ALL SELECT fold, 'f1', 2 * tp / (2 * tp + fp + fn) FROM counted
  UNION ALL SELECT fold, 'roc_auc', auc FROM areas)"""


def _folded(t):
    return scored(t).withColumn("fold", F.col("month") % 5)


@query("fold_scores", f"WITH {FOLDED} SELECT CAST(fold AS INT) AS fold, metric, round(value, 6) AS value FROM fold_scores")
def _(t):
    scores = validation.fold_scores(_folded(t), "y", "prediction", "score")
    return scores.withColumn("value", F.round("value", 6))


@query(
    "fold_score_summary",
    f"""WITH {FOLDED} SELECT metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
              count(*) AS folds FROM fold_scores GROUP BY 1""",
)
def _(t):
    summary = validation.summarize(validation.fold_scores(_folded(t), "y", "prediction", "score"))
    return summary.select(
        "metric",
        F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
        F.size("values").cast("long").alias("folds"),
    )


@query(
    "regression_fold_scores",
    f"""WITH {SCORED}, folded AS (SELECT *, month % 5 AS fold, o_orderkey FROM scored),
        m AS (SELECT fold, avg((score - y) ** 2) AS mse, avg(abs(score - y)) AS mae,
                     1 - sum((score - y) ** 2) / (count(*) * var_pop(y)) AS r2 FROM folded GROUP BY 1)
        SELECT CAST(fold AS INT) AS fold, metric, round(value, 6) AS value FROM (
          SELECT fold, 'r2' AS metric, r2 AS value FROM m UNION ALL SELECT fold, 'neg_mean_squared_error', -mse FROM m
          UNION ALL SELECT fold, 'neg_mean_absolute_error', -mae FROM m UNION ALL SELECT fold, 'rmse', sqrt(mse) FROM m)""",
)
def _(t):
    scores = validation.fold_scores(_folded(t), "y", "score", task="regression")
    return scores.withColumn("value", F.round("value", 6))


@query(
    "compare_predictions",
    f"""WITH {SCORED}, tall AS (
          SELECT 'price' AS model, month % 5 AS fold, y, prediction AS p FROM scored
          UNION ALL SELECT 'priority', month % 5, y, rival FROM scored),
        counted AS (
          SELECT model, fold, avg(CAST(y = p AS INT)) AS accuracy, count_if(y = 1 AND p = 1) AS tp,
                 count_if(y = 1) + count_if(p = 1) AS both_sides FROM tall GROUP BY 1, 2)
        SELECT model, round(avg(accuracy), 6) AS accuracy_mean, round(stddev_pop(accuracy), 6) AS accuracy_std,
               round(avg(2 * tp / both_sides), 6) AS f1_mean, round(stddev_pop(2 * tp / both_sides), 6) AS f1_std
        FROM counted GROUP BY 1""",
)
def _(t):
    rows = _folded(t)
    tall = rows.select("y", "fold", F.lit("price").alias("model"), F.col("prediction").alias("p")).unionByName(
        rows.select("y", "fold", F.lit("priority").alias("model"), F.col("rival").alias("p"))
    )
    scores = validation.fold_scores(tall, "y", "p", by=["model", "fold"], metrics=["accuracy", "f1"])
    table = validation.compare_scores(scores)
    return table.withColumns({c: F.round(c, 6) for c in table.columns if c != "model"})


@query("cross_validate")
def _(t):
    return validation.cross_validate(plan("decision_tree"), orders_with_label(t), "label", KEYS)


@query("compare_models")
def _(t):
    plans = [("tree", plan("decision_tree")), ("logistic", plan("logistic"))]
    return validation.compare_models(plans, orders_with_label(t), "label", KEYS)


@query("learning_curve")
def _(t):
    return validation.learning_curve(plan("decision_tree"), orders_with_label(t), "label", KEYS)


@query("train_and_promote")
def _(t):
    """Feature table, lookup, fit, evaluation, verdict and promotion, twice: the second equal model is not better."""
    rows = orders_with_label(t)
    train, test = random_split(rows, KEYS)
    job = training.TrainingJob(
        spark=t.spark,
        feature_table=f"{scratch_database(t.spark)}.features",
        models=ModelFolder(t.spark, new_path(t.spark, "models")),
        plan=plan("decision_tree"),
        keys=KEYS,
        label="label",
    )
    outcomes = [job.run(train, test).withColumn("run", F.lit(i)) for i in (1, 2)]
    return outcomes[0].unionByName(outcomes[1])


NEAR = """pairs AS (
  SELECT a.vec_id AS id, b.vec_id AS neighbour, a.label AS own_label, b.label AS other_label,
         sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
              lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) ** 2))) AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS rank FROM pairs)"""


def _points(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))


@query(
    "nearest_neighbours",
    f"""WITH {NEAR} SELECT id, neighbour, round(distance, 6) AS distance, CAST(rank AS INT) AS rank FROM ranked
        WHERE rank <= 5""",
)
def _(t):
    return nearest(_points(t), _points(t), 5, same=True).withColumn("distance", F.round("distance", 6))


@query(
    "neighbour_vote",
    """WITH train AS (SELECT * FROM embeddings WHERE label < 7), asked AS (SELECT * FROM embeddings WHERE label >= 7),
       pairs AS (
         SELECT a.vec_id, b.label, b.vec_id AS other, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
                lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) ** 2))) AS distance
         FROM asked a CROSS JOIN train b),
       near AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, other) <= 5),
       votes AS (SELECT vec_id, label, count(*) AS n FROM near GROUP BY 1, 2)
       SELECT vec_id, CAST(arg_min(label, label - 100 * n) AS DOUBLE) AS prediction,
              sum(CASE WHEN label = 1 THEN n ELSE 0 END) / sum(n) AS probability FROM votes GROUP BY 1""",
)
def _(t):
    rows = t.embeddings
    return neighbour_vote(rows.where("label < 7"), rows.where("label >= 7"), "vec_id", "embedding", "label", 5)


@query(
    "smote",
    """WITH sizes AS (SELECT label, count(*) AS n, max(count(*)) OVER () AS top FROM embeddings GROUP BY 1),
       indexed AS (
         SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', vec_id, 42))) - 1
                AS r FROM embeddings),
       near AS (
         SELECT a.vec_id, b.vec_id AS neighbour, b.embedding AS other,
                row_number() OVER (PARTITION BY a.vec_id ORDER BY sqrt(list_sum(list_transform(
                  list_zip(a.embedding, b.embedding), lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) ** 2))),
                  b.vec_id) AS rank
         FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
       drawn AS (
         SELECT label,
                CAST('0x' || substr(md5(concat_ws(':', label, d, 42, 'row')), 1, 15) AS BIGINT) % n AS r,
                CAST('0x' || substr(md5(concat_ws(':', label, d, 42, 'near')), 1, 15) AS BIGINT) % 5 + 1 AS rank,
                CAST('0x' || substr(md5(concat_ws(':', label, d, 42, 'gap')), 1, 15) AS BIGINT) / 1152921504606846976.0::DOUBLE
                AS share
         FROM sizes, LATERAL (SELECT unnest(range(top - n)) AS d))
       SELECT label, vec_id, neighbour, round(share, 6) AS share,
              round(embedding[1]::DOUBLE + share * (other[1]::DOUBLE - embedding[1]::DOUBLE), 6) AS first_value,
              round(embedding[64]::DOUBLE + share * (other[64]::DOUBLE - embedding[64]::DOUBLE), 6) AS last_value,
              64 AS dimensions
       FROM drawn JOIN indexed USING (label, r) JOIN near USING (vec_id, rank)""",
)
def _(t):
    made = smote(t.embeddings, "label", "vec_id", "embedding", 5, 42)
    return made.select(
        "label",
        "vec_id",
        "neighbour",
        F.round("share", 6).alias("share"),
        F.round(F.get("embedding", F.lit(0)), 6).alias("first_value"),
        F.round(F.get("embedding", F.lit(63)), 6).alias("last_value"),
        F.size("embedding").alias("dimensions"),
    )
