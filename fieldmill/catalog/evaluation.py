"""Ranking, threshold and regression metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..learn import evaluate as E
from .base import Tables, register, rounded
from .standins import EVENT_SCORES_SQL, SCORES_SQL, event_scores, scores

_CURVE = """c AS (SELECT {k}score, sum(label) AS pos, sum(1 - label) AS neg FROM {src} GROUP BY ALL),
r AS (SELECT *, sum(pos) OVER (PARTITION BY {p} ORDER BY score DESC) AS tp, sum(neg) OVER (PARTITION BY {p} ORDER BY score DESC) AS fp,
  sum(pos) OVER (PARTITION BY {p}) AS np, sum(neg) OVER (PARTITION BY {p}) AS nn FROM c)"""
_AUC = "round(sum(pos * (nn - fp + neg / 2.0::DOUBLE)) / max(np::DOUBLE * nn), 6)"
_AP = "round(sum(pos * (tp / (tp + fp))) / max(np), 6)"


def _curve(src: str, key: str | None = None) -> str:
    return _CURVE.format(src=src, k=f"{key}, " if key else "", p=key or "1")


@register("p1_roc_auc", f"WITH {EVENT_SCORES_SQL}, {_curve('event_scores')} SELECT {_AUC} AS roc_auc FROM r")
def roc_auc(t: Tables) -> DataFrame:
    return rounded(E.roc_auc(event_scores(t), "score", "label"), "roc_auc")


@register("p1_roc_auc_of_labels", f"WITH {SCORES_SQL}, {_curve('scores')} SELECT {_AUC} AS roc_auc FROM r")
def label_auc(t: Tables) -> DataFrame:
    return rounded(E.roc_auc(scores(t), "score", "label"), "roc_auc")


@register(
    "p2_pr_auc",
    f"""WITH {SCORES_SQL}, {_curve('scores')}, q AS (SELECT pos, np, tp / (tp + fp) AS pr,
      lag(tp / (tp + fp)) OVER (ORDER BY score DESC) AS before FROM r)
    SELECT round(sum(pos * (pr + coalesce(before, pr)) / 2) / max(np), 6) AS pr_auc FROM q""",
)
def pr_auc(t: Tables) -> DataFrame:
    return rounded(E.pr_auc(scores(t), "score", "label"), "pr_auc")


@register(
    "p3_average_precision",
    f"WITH {SCORES_SQL}, {_curve('scores')} SELECT {_AP} AS average_precision FROM r",
)
def average_precision(t: Tables) -> DataFrame:
    return rounded(E.average_precision(scores(t), "score", "label"), "average_precision")


@register(
    "p3_average_precision_of_events",
    f"WITH {EVENT_SCORES_SQL}, {_curve('event_scores')} SELECT {_AP} AS average_precision FROM r",
)
def event_precision(t: Tables) -> DataFrame:
    return rounded(E.average_precision(event_scores(t), "score", "label"), "average_precision")


@register(
    "p4_rmse",
    """SELECT l_returnflag, round(sqrt(avg(power(l_extendedprice - l_quantity * 1000, 2))), 3) AS rmse FROM lineitem GROUP BY 1""",
)
def rmse(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("guess", F.col("l_quantity") * 1000)
    return rounded(E.rmse(df, "l_extendedprice", "guess", ["l_returnflag"]), "rmse", digits=3)


_GRID = """g AS (SELECT i * 0.01::DOUBLE AS threshold FROM range(0, 101) t(i)),
tt AS (SELECT threshold, count(*) FILTER (WHERE score >= threshold) AS flagged,
  count(*) FILTER (WHERE score >= threshold AND label = 1) AS hits, count(*) AS n, sum(label) AS positives FROM g, {src} GROUP BY 1),
m AS (SELECT threshold, CASE WHEN flagged = 0 THEN 0 ELSE hits / flagged END AS "precision", hits / positives AS recall,
  2 * hits / (flagged + positives) AS f1, flagged / n AS alert_rate FROM tt)"""


@register(
    "p5_threshold_table",
    f"""WITH {SCORES_SQL}, {_GRID.format(src='scores')} SELECT round(threshold, 4) AS threshold, 'F1' AS metric, round(f1, 6) AS score FROM m
    UNION ALL SELECT round(threshold, 4), 'Recall', round(recall, 6) FROM m UNION ALL SELECT round(threshold, 4), 'Precision', round("precision", 6) FROM m
    UNION ALL SELECT round(threshold, 4), 'Alert rate', round(alert_rate, 6) FROM m""",
)
def threshold_table(t: Tables) -> DataFrame:
    table = E.threshold_table(scores(t), "score", "label")
    return rounded(rounded(E.long_thresholds(table), "score"), "threshold", digits=4)


@register(
    "p6_best_threshold",
    f"""WITH {SCORES_SQL}, {_GRID.format(src='scores')} SELECT round(threshold, 4) AS threshold, round("precision", 6) AS "precision",
    round(recall, 6) AS recall, round(f1, 6) AS f1, round(alert_rate, 6) AS alert_rate FROM m ORDER BY m.f1 DESC, m.threshold LIMIT 1""",
)
def best_threshold(t: Tables) -> DataFrame:
    best = E.best_threshold(E.threshold_table(scores(t), "score", "label"))
    return rounded(
        rounded(best, "precision", "recall", "f1", "alert_rate"), "threshold", digits=4
    )


@register(
    "p7_rule_f1",
    f"""WITH {EVENT_SCORES_SQL}, x AS (SELECT CAST(floor(score) AS BIGINT) AS v, label, split FROM event_scores),
    cand AS (SELECT DISTINCT v FROM x WHERE split = 'train'), test AS (SELECT v, sum(label) AS pos, count(*) AS n FROM x WHERE split = 'test' GROUP BY 1),
    f AS (SELECT c.v AS threshold, coalesce(sum(t.pos), 0) AS hits, coalesce(sum(t.n), 0) AS flagged FROM cand c LEFT JOIN test t ON t.v <= c.v GROUP BY 1)
    SELECT threshold, round(2 * hits / (flagged + (SELECT sum(pos) FROM test)), 6) AS f1 FROM f""",
)
def rule_f1(t: Tables) -> DataFrame:
    df = event_scores(t).withColumn("v", F.floor("score"))
    out = E.rule_f1(df.where("split = 'train'"), df.where("split = 'test'"), "v", "label")
    return rounded(out, "f1")


@register(
    "p8_false_positives",
    f"WITH {SCORES_SQL} SELECT doc_id, score FROM scores WHERE label = 0 AND score >= 0.29",
)
def false_positives(t: Tables) -> DataFrame:
    return E.false_positives(scores(t), "score", "label", 0.29).select("doc_id", "score")


@register(
    "p8_false_negatives",
    f"WITH {SCORES_SQL} SELECT doc_id, score FROM scores WHERE label = 1 AND score < 0.29",
)
def false_negatives(t: Tables) -> DataFrame:
    return E.false_negatives(scores(t), "score", "label", 0.29).select("doc_id", "score")


@register(
    "p10_metrics_by_split",
    f"WITH {EVENT_SCORES_SQL}, {_curve('event_scores', 'split')} SELECT split, {_AUC} AS roc_auc, {_AP} AS average_precision FROM r GROUP BY 1",
)
def metrics_by_split(t: Tables) -> DataFrame:
    out = E.ranking_metrics(event_scores(t), "score", "label", ["split"])
    return rounded(out, "roc_auc", "average_precision")
