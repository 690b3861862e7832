"""I: threshold strategies."""

from checks import frames
from checks.registry import check, rounded
from checks.section_metrics import CURVE, RATES, counts_sql, rates, sweep_sql
from creditloom.operators import thresholds

T = frames.PREP
SWEEP = T + sweep_sql()
_COLS = "round(threshold, 4) AS threshold, tp, fp, fn, tn, " + rates(4)


def _pick(name: str, order: str, where: str = "TRUE", constraint: str = "NULL", objective: str = "NULL") -> str:
    return (f"(SELECT '{name}' AS strategy, {constraint}::VARCHAR AS \"constraint\", {objective}::DOUBLE AS objective, {_COLS} "
            f"FROM sweep WHERE {where} ORDER BY {order}, threshold LIMIT 1)")


PICKS = {
    "max_f1": _pick("max_f1", "sweep.f1 DESC"),
    "max_precision": _pick("max_precision", "sweep.precision DESC", "sweep.recall >= 0.5", "'recall ≥ 0.50'"),
    "max_recall": _pick("max_recall", "sweep.recall DESC", "sweep.precision >= 0.35", "'precision ≥ 0.35'"),
    "youden": _pick("youden", "sweep.recall + sweep.specificity - 1 DESC",
                    objective="round(sweep.recall + sweep.specificity - 1, 4)"),
    "cost_sensitive": _pick("cost_sensitive", "fp * 1.0 + fn * 5.0", objective="round(CAST(fp + fn * 5 AS DOUBLE), 1)"),
}
_KS = f"""(SELECT 'max_ks' AS strategy, NULL::VARCHAR AS "constraint", round(gap, 4) AS objective, {_COLS} FROM
  (SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(pp - tp AS BIGINT) AS fn,
   CAST(nn - fp AS BIGINT) AS tn, gap FROM gaps ORDER BY gap DESC, score DESC LIMIT 1))"""


@check("i1_best_f1_200_points", T + sweep_sql("0.01", "0.99", 200) +
       "SELECT round(threshold, 9) AS threshold, round(f1, 9) AS f1 FROM sweep ORDER BY sweep.f1 DESC, threshold LIMIT 1")
def i1(spark, d):
    return rounded(thresholds.best_f1(frames.test_scores(spark, d)), 9, "threshold", "f1")


def _single(key: str, name: str, sql: str) -> None:
    check(key, sql)(lambda s, d: thresholds.strategy(frames.test_scores(s, d), name))


_single("i1_max_f1", "max_f1", SWEEP + "SELECT * FROM " + PICKS["max_f1"])
_single("i2_max_precision", "max_precision", SWEEP + "SELECT * FROM " + PICKS["max_precision"])
_single("i3_max_recall", "max_recall", SWEEP + "SELECT * FROM " + PICKS["max_recall"])
_single("i4_youden", "youden", SWEEP + "SELECT * FROM " + PICKS["youden"])
_single("i5_cost_sensitive", "cost_sensitive", SWEEP + "SELECT * FROM " + PICKS["cost_sensitive"])
_single("i6_max_ks", "max_ks", T + CURVE + "SELECT * FROM " + _KS)


@check("i7_compare_all", T + CURVE + sweep_sql() + " UNION ALL ".join(
    f"SELECT *, {i} AS position FROM {sql}" for i, sql in enumerate([*PICKS.values(), _KS], 1)))
def i7(spark, d):
    return thresholds.compare_all(frames.test_scores(spark, d))


@check("i8_current_vs_saved", T + f", c AS ({counts_sql('0.3::DOUBLE')}), s AS ({counts_sql('0.2::DOUBLE')}), "
       f"cr AS (SELECT {', '.join(f'{e} AS {n}' for n, e in RATES.items())} FROM c), "
       f"sr AS (SELECT {', '.join(f'{e} AS {n}' for n, e in RATES.items())} FROM s) " + " UNION ALL ".join(
           f"SELECT '{m}' AS metric, round(cr.{m}, 9) AS \"current\", round(sr.{m}, 9) AS saved, "
           f"round(cr.{m} - sr.{m}, 9) AS delta FROM cr CROSS JOIN sr" for m in RATES))
def i8(spark, d):
    return rounded(thresholds.compare_thresholds(frames.test_scores(spark, d), 0.3, 0.2), 9,
                   "current", "saved", "delta")
