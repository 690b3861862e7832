"""H: evaluation metrics on the stored score table."""

from pyspark.sql import functions as F

from checks import frames
from checks.registry import check, rounded
from creditloom.operators import metrics
from creditloom.functions.numeric import ratio

T = frames.PREP

CURVE = """,
pts AS (SELECT pd AS score, count(*) FILTER ("default" = 1) AS pos, count(*) FILTER ("default" = 0) AS neg FROM test GROUP BY pd),
tot AS (SELECT CAST(sum(pos) AS DOUBLE) AS pp, CAST(sum(neg) AS DOUBLE) AS nn FROM pts),
curve AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pp, nn
          FROM pts CROSS JOIN tot WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
gaps AS (SELECT *, tp / pp - fp / nn AS gap FROM curve)
"""


@check("h1_roc_auc", T + CURVE + "SELECT round(sum(neg * (tp - pos + pos / 2.0::DOUBLE)) / (max(pp) * max(nn)), 9) AS roc_auc FROM curve")
def h1(spark, d):
    return rounded(metrics.roc_auc(frames.test_scores(spark, d)), 9, "roc_auc")


@check("h2_average_precision", T + CURVE + "SELECT round(sum(pos / pp * tp / (tp + fp)), 9) AS average_precision FROM curve")
def h2(spark, d):
    return rounded(metrics.average_precision(frames.test_scores(spark, d)), 9, "average_precision")


@check("h3_brier", T + 'SELECT round(avg((pd - "default") * (pd - "default")), 9) AS brier FROM test')
def h3(spark, d):
    return rounded(metrics.probability_metrics(frames.test_scores(spark, d)).select("brier"), 9, "brier")


def _log_loss(p: str, clip: str) -> str:
    p = f"least(1 - {clip}, greatest({clip}, {p}))"
    return f'avg(CASE WHEN "default" = 1 THEN -ln({p}) ELSE -ln(1 - {p}) END)'


@check("h4_log_loss", T + f"SELECT round({_log_loss('pd', '2.220446049250313e-16::DOUBLE')}, 9) AS log_loss, "
       f"round({_log_loss('floor(pd * 10) / 10', '1e-6::DOUBLE')}, 9) AS clipped_log_loss FROM test")
def h4(spark, d):
    df = frames.test_scores(spark, d)
    return df.agg(
        F.round(metrics.log_loss_term(F.col("pd"), F.col("default")), 9).alias("log_loss"),
        F.round(metrics.log_loss_term(F.floor(F.col("pd") * 10) / 10, F.col("default"),
                                      metrics.COMPARISON_CLIP), 9).alias("clipped_log_loss"))


@check("h5_ks", T + CURVE + "SELECT round(gap, 9) AS ks_stat, score AS ks_threshold FROM gaps ORDER BY gap DESC, score DESC LIMIT 1")
def h5(spark, d):
    out = metrics.rank_metrics(frames.test_scores(spark, d)).select("ks_stat", "ks_threshold")
    return rounded(out, 9, "ks_stat")


@check("h6_roc_points", T + CURVE + "SELECT round(fp / nn, 9) AS fpr, round(tp / pp, 9) AS tpr, score AS threshold FROM curve "
       "UNION ALL SELECT 0, 0, 'Infinity'::DOUBLE")
def h6(spark, d):
    return rounded(metrics.roc_points(frames.test_scores(spark, d)), 9, "fpr", "tpr")


@check("h7_pr_points", T + CURVE + "SELECT round(CAST(tp AS DOUBLE) / (tp + fp), 9) AS precision, round(tp / pp, 9) AS recall, "
       "score AS threshold FROM curve UNION ALL SELECT 1, 0, NULL")
def h7(spark, d):
    return rounded(metrics.pr_points(frames.test_scores(spark, d)), 9, "precision", "recall")


def counts_sql(t: str, frame: str = "test") -> str:
    return (f'SELECT {t} AS threshold, count(*) FILTER (pd >= {t} AND "default" = 1) AS tp, '
            f'count(*) FILTER (pd >= {t} AND "default" = 0) AS fp, '
            f'count(*) FILTER (pd < {t} AND "default" = 1) AS fn, '
            f'count(*) FILTER (pd < {t} AND "default" = 0) AS tn FROM {frame}')


def _over(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0::DOUBLE END"


RATES = {"precision": _over("tp", "tp + fp"), "recall": _over("tp", "tp + fn"),
         "specificity": _over("tn", "tn + fp"), "f1": _over("2 * tp", "2 * tp + fp + fn")}


def rates(digits: int) -> str:
    return ", ".join(f"round({e}, {digits}) AS {n}" for n, e in RATES.items())


@check("h8_confusion", T + f", c AS ({counts_sql('0.25::DOUBLE')}) SELECT tp, fp, fn, tn FROM c")
def h8(spark, d):
    return metrics.confusion_at(frames.test_scores(spark, d), 0.25)


@check("h9_rates_at_threshold", T + f", c AS ({counts_sql('0.25::DOUBLE')}) SELECT threshold, tp, fp, fn, tn, {rates(4)} FROM c")
def h9(spark, d):
    return metrics.metrics_at(frames.test_scores(spark, d), 0.25)


def grid_sql(start: str, stop: str, n: int) -> str:
    return (f"grid AS (SELECT CASE WHEN i = {n - 1} THEN {stop}::DOUBLE ELSE i * (({stop}::DOUBLE - {start}::DOUBLE) / {n - 1}) + {start}::DOUBLE END AS t "
            f"FROM range({n}) r(i))")


def sweep_sql(start="0.001", stop="0.999", n=500, frame="test") -> str:
    """Plain join of grid and rows; the oracle may be slow where Spark must not be."""
    return f""", {grid_sql(start, stop, n)},
counted AS (SELECT t AS threshold, count(*) FILTER (pd >= t AND "default" = 1) AS tp, count(*) FILTER (pd >= t AND "default" = 0) AS fp,
  count(*) FILTER (pd < t AND "default" = 1) AS fn, count(*) FILTER (pd < t AND "default" = 0) AS tn
  FROM grid CROSS JOIN {frame} GROUP BY t),
sweep AS (SELECT threshold, tp, fp, fn, tn, {", ".join(f"{e} AS {n_}" for n_, e in RATES.items())} FROM counted)
"""


@check("h10_threshold_sweep", T + sweep_sql() + f"SELECT round(threshold, 9) AS threshold, tp, fp, fn, tn, {rates(9)} FROM sweep")
def h10(spark, d):
    return rounded(metrics.threshold_sweep(frames.test_scores(spark, d)), 9,
                   "threshold", "precision", "recall", "specificity", "f1")


@check("h10_unscored", T + """, grid AS (SELECT unnest([0.1, 0.25, 0.5]::DOUBLE[]) AS t),
l AS (SELECT "default" AS y, CASE WHEN loan_id % 7 <> 0 THEN pd END AS p FROM test)
SELECT t AS threshold, count(*) FILTER (p >= t AND y = 1) AS tp, count(*) FILTER (p >= t AND y = 0) AS fp,
  count(*) FILTER (p < t AND y = 1) AS fn, count(*) FILTER (p < t AND y = 0) AS tn,
  count(*) FILTER (p IS NULL) AS unscored FROM grid CROSS JOIN l GROUP BY t""")
def h10_unscored(spark, d):
    df = frames.test_scores(spark, d)
    df = df.withColumn("pd", F.when(F.col("loan_id") % 7 != 0, F.col("pd")))
    swept = metrics.threshold_sweep(df, [0.1, 0.25, 0.5], count_unscored=True)
    return swept.select("threshold", "tp", "fp", "fn", "tn", "unscored")


@check("h11_classification_report", T + f""", c AS ({counts_sql('0.25::DOUBLE')}),
r AS (SELECT 'paid' AS class, {_over('tn', 'tn + fn')} AS precision, {_over('tn', 'tn + fp')} AS recall,
        {_over('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM c
      UNION ALL SELECT 'default', {RATES['precision']}, {RATES['recall']}, {RATES['f1']}, tp + fn FROM c),
n AS (SELECT sum(support) AS n FROM r),
f AS (SELECT class, precision, recall, f1, support FROM r
  UNION ALL SELECT 'accuracy', NULL, NULL, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), tp + fp + fn + tn FROM c
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM r
  UNION ALL SELECT 'weighted avg', sum(precision * support) / any_value(n), sum(recall * support) / any_value(n),
    sum(f1 * support) / any_value(n), CAST(sum(support) AS BIGINT) FROM r CROSS JOIN n)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM f""")
def h11(spark, d):
    return rounded(metrics.classification_report(frames.test_scores(spark, d), 0.25), 9,
                   "precision", "recall", "f1")


_BINNED = """SELECT bin, round(avg(pd), 9) AS mean_predicted, round(avg("default"), 9) AS observed_rate, count(*) AS "rows"
FROM binned GROUP BY bin"""


@check("h12_calibration_uniform", T + f""", edges AS (SELECT i, i * (1.0::DOUBLE / 15) AS e FROM range(1, 15) r(i)),
binned AS (SELECT pd, "default", (SELECT CAST(count(*) AS INTEGER) FROM edges WHERE e < pd) AS bin FROM test)
{_BINNED}""")
def h12(spark, d):
    return rounded(metrics.calibration_uniform(frames.test_scores(spark, d), 15), 9, "mean_predicted", "observed_rate")


@check("h13_calibration_quantile", T + f""", q AS (SELECT unnest(quantile_cont(pd, {[i / 20 for i in range(1, 20)]})) AS e FROM test),
binned AS (SELECT pd, "default", (SELECT CAST(count(*) AS INTEGER) FROM q WHERE e < pd) AS bin FROM test)
{_BINNED}""")
def h13(spark, d):
    return rounded(metrics.calibration_quantile(frames.test_scores(spark, d), 20), 9, "mean_predicted", "observed_rate")


@check("h14_score_histogram", T + """, lim AS (SELECT "default" AS y, min(pd) AS low, max(pd) AS high, count(*) AS n FROM test GROUP BY 1),
e AS (SELECT y, i, low + i * ((high - low) / 80) AS a, CASE WHEN i = 79 THEN high ELSE low + (i + 1) * ((high - low) / 80) END AS b,
      (high - low) / 80 AS width, n FROM lim CROSS JOIN range(80) r(i))
SELECT y AS "default", CAST(i AS INTEGER) AS bin, round(a, 9) AS bin_start, count(*) AS "rows", round(count(*) / (any_value(n) * any_value(width)), 6) AS density
FROM test JOIN e ON "default" = y AND pd >= a AND (pd < b OR (i = 79 AND pd <= b)) GROUP BY y, i, a""")
def h14(spark, d):
    out = metrics.score_histogram(frames.test_scores(spark, d), 80, group="default")
    return rounded(rounded(out, 9, "bin_start"), 6, "density")


@check("h15_base_rate", T + 'SELECT round(avg("default"), 9) AS base_rate, round(avg("default") * (1 - avg("default")), 9) AS no_skill_brier FROM test')
def h15(spark, d):
    return rounded(metrics.base_rate(frames.test_scores(spark, d)), 9, "base_rate", "no_skill_brier")
