"""Metrics, curves, thresholds and verdicts."""

from pyspark.sql import functions as F

from larkspur.operators import curves, evaluate
from larkspur.plans.inputs import SCORED, scored
from larkspur.plans.registry import query


def _rounded(df, *names, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in names})


# Counts per class of column `y` against `prediction`, one row per class.
PER_CLASS = """per_class AS (
  SELECT c.class, count_if(s.y = c.class AND s.p = c.class) AS tp, count_if(s.y <> c.class AND s.p = c.class) AS fp,
         count_if(s.y = c.class AND s.p <> c.class) AS fn, count_if(s.y = c.class) AS support
  FROM pairs s CROSS JOIN (SELECT DISTINCT y AS class FROM pairs UNION SELECT DISTINCT p FROM pairs) c GROUP BY c.class),
per_metric AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS pr,
         CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS re,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f
  FROM per_class)"""

# Running totals over the scores from the highest down.
CURVE = """counted AS (
  SELECT threshold, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM points GROUP BY 1),
running AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM counted WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
areas AS (
  SELECT sum(neg * (2.0 * tp - pos) / 2.0) / (max(p) * max(n)) AS roc_auc,
         sum(pos * (tp / (tp + fp))) / max(p) AS average_precision FROM running)"""


@query(
    "class_metrics",
    f"""WITH {SCORED}, pairs AS (SELECT status AS y, guess AS p FROM scored), {PER_CLASS}
        SELECT class, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
               CAST(support AS BIGINT) AS support, round(pr, 6) AS precision, round(re, 6) AS recall, round(f, 6) AS f1
        FROM per_metric""",
)
def _(t):
    return _rounded(evaluate.class_metrics(scored(t), "status", "guess"), "precision", "recall", "f1")


@query(
    "weighted_metrics",
    f"""WITH {SCORED}, pairs AS (SELECT status AS y, guess AS p FROM scored), {PER_CLASS}
        SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(support * pr) / sum(support), 6) AS precision,
               round(sum(support * re) / sum(support), 6) AS recall, round(sum(support * f) / sum(support), 6) AS f1
        FROM per_metric""",
)
def _(t):
    return _rounded(evaluate.classification_metrics(scored(t), "status", "guess"), *evaluate.METRICS)


@query(
    "macro_metrics",
    f"""WITH {SCORED}, pairs AS (SELECT status AS y, guess AS p FROM scored), {PER_CLASS}
        SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(pr), 6) AS precision,
               round(avg(re), 6) AS recall, round(avg(f), 6) AS f1 FROM per_metric""",
)
def _(t):
    return _rounded(
        evaluate.classification_metrics(scored(t), "status", "guess", average="macro"), *evaluate.METRICS
    )


@query(
    "metrics_with_areas",
    f"""WITH {SCORED}, pairs AS (SELECT y, prediction AS p FROM scored), {PER_CLASS},
        points AS (SELECT y, score AS threshold FROM scored), {CURVE}
        SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(support * pr) / sum(support), 6) AS precision,
               round(sum(support * re) / sum(support), 6) AS recall, round(sum(support * f) / sum(support), 6) AS f1,
               round((SELECT roc_auc FROM areas), 6) AS roc_auc,
               round((SELECT average_precision FROM areas), 6) AS average_precision
        FROM per_metric""",
)
def _(t):
    result = evaluate.classification_metrics(scored(t), "y", "prediction", "score")
    return _rounded(result, *evaluate.METRICS, "roc_auc", "average_precision")


@query(
    "binary_metrics",
    f"""WITH {SCORED}, c AS (
          SELECT count_if(y = 1 AND prediction = 1) AS tp, count_if(y = 0 AND prediction = 1) AS fp,
                 count_if(y = 1 AND prediction = 0) AS fn, avg(CAST(y = prediction AS INT)) AS accuracy FROM scored)
        SELECT round(accuracy, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
               round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""",
)
def _(t):
    result = evaluate.classification_metrics(scored(t), "y", "prediction", average="binary")
    return _rounded(result, *evaluate.METRICS)


@query(
    "confusion_matrix",
    f"""WITH {SCORED}, counts AS (SELECT status, guess, count(*) AS n FROM scored GROUP BY 1, 2),
        classes AS (SELECT DISTINCT status AS c FROM scored UNION SELECT DISTINCT guess FROM scored)
        SELECT a.c AS label, b.c AS prediction, coalesce(n, 0) AS n,
               round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY a.c), 6) AS share
        FROM classes a CROSS JOIN classes b LEFT JOIN counts ON status = a.c AND guess = b.c""",
)
def _(t):
    return _rounded(evaluate.confusion_matrix(scored(t), "status", "guess", dense=True), "share")


@query(
    "confusion_pairs",
    f"""WITH {SCORED}, counts AS (SELECT status, guess, count(*) AS n FROM scored GROUP BY 1, 2)
        SELECT status AS label, guess AS prediction, n, round(n / sum(n) OVER (PARTITION BY status), 6) AS share FROM counts""",
)
def _(t):
    return _rounded(evaluate.confusion_matrix(scored(t), "status", "guess"), "share")


@query(
    "roc_points",
    f"""WITH {SCORED}, points AS (SELECT y, score AS threshold FROM scored), {CURVE}
        SELECT threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM running
        UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""",
)
def _(t):
    return _rounded(curves.roc_points(scored(t), "y", "score"), "fpr", "tpr")


@query(
    "curve_areas",
    f"""WITH {SCORED}, points AS (SELECT y, fine_score AS threshold FROM scored), {CURVE}
        SELECT round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM areas""",
)
def _(t):
    return _rounded(curves.curve_summary(scored(t), "y", "fine_score"), "roc_auc", "average_precision")


@query(
    "curve_areas_per_group",
    f"""WITH {SCORED}, counted AS (
          SELECT month, score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM scored GROUP BY 1, 2),
        running AS (
          SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM counted
          WINDOW w AS (PARTITION BY month ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
        SELECT month, round(sum(neg * (2.0 * tp - pos) / 2.0) / (sum(pos) * sum(neg)), 6) AS roc_auc,
               round(sum(pos * (tp / (tp + fp))) / sum(pos), 6) AS average_precision FROM running GROUP BY 1""",
)
def _(t):
    result = curves.curve_summary(scored(t), "y", "score", ["month"])
    return _rounded(result, "roc_auc", "average_precision")


@query(
    "precision_recall_points",
    f"""WITH {SCORED}, points AS (SELECT y, score AS threshold FROM scored), {CURVE}
        SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM running
        UNION ALL SELECT NULL, 1.0, 0.0""",
)
def _(t):
    return _rounded(curves.precision_recall_points(scored(t), "y", "score"), "precision", "recall")


SWEEP = f"""{SCORED}, tried AS (
  SELECT i AS position, CASE WHEN i = 99 THEN 0.99 ELSE CAST(0.01 AS DOUBLE) + i * (CAST(0.98 AS DOUBLE) / 99) END
         AS threshold FROM range(100) r(i)),
by_threshold AS (
  SELECT position, threshold, count_if(score >= threshold AND y = 1) AS tp, count_if(score >= threshold AND y = 0) AS fp,
         count_if(y = 1) AS p, count_if(y = 0) AS n FROM scored CROSS JOIN tried GROUP BY 1, 2),
swept AS (
  SELECT position, threshold, CASE WHEN tp + fp + p = 0 THEN 0 ELSE 2 * tp / (tp + fp + p) END AS f1,
         (tp + n - fp) / (p + n) AS accuracy, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN p = 0 THEN 0 ELSE tp / p END AS recall FROM by_threshold)"""


@query(
    "threshold_sweep",
    f"""WITH {SWEEP} SELECT CAST(position AS INT) AS position, round(threshold, 6) AS threshold, round(f1, 6) AS f1,
              round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall FROM swept""",
)
def _(t):
    return _rounded(
        curves.threshold_sweep(scored(t), "y", "score"), "threshold", "f1", "accuracy", "precision", "recall"
    )


for _metric in curves.SWEEP_METRICS:

    @query(
        f"best_threshold_{_metric}",
        f"""WITH {SWEEP} SELECT round(threshold, 6) AS threshold, round({_metric}, 6) AS {_metric}_score FROM swept
            ORDER BY {_metric} DESC, position LIMIT 1""",
    )
    def _(t, metric=_metric):
        return _rounded(
            curves.best_threshold(scored(t), "y", "score", metric), "threshold", f"{metric}_score"
        )


@query(
    "champion_verdict",
    f"""WITH {SCORED}, tall AS (SELECT 'challenger' AS model, y, prediction AS p FROM scored
          UNION ALL SELECT 'champion', y, rival FROM scored),
        per_class AS (
          SELECT model, c.class, count_if(y = c.class AND p = c.class) AS tp, count_if(y = c.class) AS support,
                 count_if(p = c.class) AS predicted FROM tall CROSS JOIN (VALUES (0), (1)) c(class) GROUP BY 1, 2),
        scores AS (
          SELECT model, sum(support * CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted) END)
                 / sum(support) AS f1 FROM per_class GROUP BY 1),
        verdict AS (
          SELECT max(CASE WHEN model = 'challenger' THEN f1 END) AS challenger,
                 max(CASE WHEN model = 'champion' THEN f1 END) AS champion FROM scores)
        SELECT round(challenger, 6) AS challenger, round(champion, 6) AS champion, challenger > champion AS improved
        FROM verdict""",
)
def _(t):
    return _rounded(
        evaluate.champion_verdict(scored(t), "y", "prediction", "rival"), "challenger", "champion"
    )


@query(
    "champion_verdict_auc",
    f"""WITH {SCORED}, points AS (SELECT y, score AS threshold FROM scored), {CURVE},
        rival AS (
          SELECT 0.5 * (1 + count_if(y = 1 AND rival = 1) / count_if(y = 1)
                          - count_if(y = 0 AND rival = 1) / count_if(y = 0)) AS auc FROM scored)
        SELECT round(roc_auc, 6) AS challenger, round(auc, 6) AS champion, roc_auc > auc AS improved FROM areas, rival""",
)
def _(t):
    return _rounded(
        evaluate.champion_verdict(scored(t), "y", "score", "rival", score=True), "challenger", "champion"
    )


@query(
    "champion_verdict_first_model",
    f"""WITH {SCORED}, pairs AS (SELECT y, prediction AS p FROM scored), {PER_CLASS}
        SELECT round(sum(support * f) / sum(support), 6) AS challenger, CAST(NULL AS DOUBLE) AS champion, true AS improved
        FROM per_metric""",
)
def _(t):
    return _rounded(evaluate.champion_verdict(scored(t), "y", "prediction"), "challenger", "champion")
