"""Decision-threshold strategies on a sweep.

A sweep has one row per grid point, so every strategy is one small aggregate
that keeps the best row. Equal values go to the lowest threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions import bins
from creditloom.operators import metrics
from creditloom.operators.prefix import score_table

STRATEGIES = ("max_f1", "max_precision", "max_recall", "youden", "cost_sensitive", "max_ks")
_COUNTS = ("tp", "fp", "fn", "tn")


class Infeasible(ValueError):
    """No threshold on the grid meets the constraint."""


def _youden() -> Column:
    return F.col("recall") + F.col("specificity") - 1


def _cost(fp_cost: float, fn_cost: float) -> Column:
    return F.col("fp") * F.lit(float(fp_cost)) + F.col("fn") * F.lit(float(fn_cost))


def _best(value: Column, allowed: Column | None = None) -> Column:
    """Row (counts, threshold, value) with the highest value, lowest threshold first."""
    row = F.struct("threshold", *_COUNTS, value.alias("value"))
    order = F.struct(value, -F.col("threshold"))
    if allowed is None:
        return F.max_by(row, order)
    return F.max_by(F.when(allowed, row), F.when(allowed, order))


def _picks(min_recall: float, min_precision: float, fp_cost: float, fn_cost: float) -> dict[str, Column]:
    return {
        "max_f1": _best(F.col("f1")),
        "max_precision": _best(F.col("precision"), F.col("recall") >= F.lit(float(min_recall))),
        "max_recall": _best(F.col("recall"), F.col("precision") >= F.lit(float(min_precision))),
        "youden": _best(_youden()),
        "cost_sensitive": _best(-_cost(fp_cost, fn_cost)),
    }


def _detail(name: str, min_recall: float, min_precision: float) -> Column:
    texts = {"max_precision": f"recall ≥ {min_recall:.2f}",
             "max_recall": f"precision ≥ {min_precision:.2f}"}
    return F.lit(texts.get(name)).cast("string")


def _row(name: str, source: str, detail: Column) -> Column:
    row = F.col(source)
    extra = {"youden": F.round(row["value"], 4), "cost_sensitive": F.round(-row["value"], 1),
             "max_ks": F.round(row["value"], 4)}
    return F.struct(F.lit(name).alias("strategy"), detail.alias("constraint"),
                    extra.get(name, F.lit(None).cast("double")).alias("objective"),
                    F.round(row["threshold"], 4).alias("threshold"),
                    *[row[c].alias(c) for c in _COUNTS])


def best_f1(df: DataFrame, grid: Sequence[float] | None = None, score: str = "pd",
            label: str = "default") -> DataFrame:
    """Threshold with the highest F1 and that F1, unrounded."""
    grid = grid if grid is not None else bins.linear_grid(*bins.SEARCH_GRID)
    return (metrics.threshold_sweep(df, grid, score, label).agg(_best(F.col("f1")).alias("b"))
            .select(F.col("b.threshold").alias("threshold"), F.col("b.value").alias("f1")))


def strategy(df: DataFrame, name: str, grid: Sequence[float] | None = None, score: str = "pd",
             label: str = "default", min_recall: float = 0.5, min_precision: float = 0.35,
             fp_cost: float = 1.0, fn_cost: float = 5.0) -> DataFrame:
    """One strategy's row (I1 to I6); an unmet constraint raises ``Infeasible``."""
    if name not in STRATEGIES:
        raise ValueError(f"Unknown strategy: {name!r}. Choose from {STRATEGIES}")
    if name == "max_ks":
        return max_ks(df, score, label)
    pick = _picks(min_recall, min_precision, fp_cost, fn_cost)[name]
    best = metrics.threshold_sweep(df, grid, score, label).agg(pick.alias("b"))
    if name in ("max_precision", "max_recall") and best.first()["b"] is None:
        limit = (f"recall ≥ {min_recall:.2f}" if name == "max_precision"
                 else f"precision ≥ {min_precision:.2f}")
        raise Infeasible(f"{limit} is out of reach at every threshold of the grid")
    rows = best.select(_row(name, "b", _detail(name, min_recall, min_precision)).alias("r")).select("r.*")
    return metrics.rounded_rates(rows)


def max_ks(df: DataFrame, score: str = "pd", label: str = "default") -> DataFrame:
    """Threshold of the largest gap between the class distributions."""
    curve = score_table(df, score, label).withColumn("value", metrics.ks_gap())
    row = F.struct(F.col("score").alias("threshold"), "tp", "fp",
                   (F.col("positives") - F.col("tp")).alias("fn"),
                   (F.col("negatives") - F.col("fp")).alias("tn"), "value")
    best = curve.agg(F.max_by(row, F.struct("value", "score")).alias("b"))
    rows = best.select(_row("max_ks", "b", F.lit(None).cast("string")).alias("r")).select("r.*")
    return metrics.rounded_rates(rows)


def compare_all(df: DataFrame, grid: Sequence[float] | None = None, score: str = "pd",
                label: str = "default", min_recall: float = 0.5, min_precision: float = 0.35,
                fp_cost: float = 1.0, fn_cost: float = 5.0) -> DataFrame:
    """All six strategies in fixed order, one sweep for the first five."""
    picks = _picks(min_recall, min_precision, fp_cost, fn_cost)
    best = metrics.threshold_sweep(df, grid, score, label).agg(
        *[pick.alias(name) for name, pick in picks.items()])
    missing = [F.when(F.col(n).isNull(), F.raise_error(F.lit(f"No threshold satisfies {n}")))
               for n in ("max_precision", "max_recall")]
    rows = best.filter(F.coalesce(*missing, F.lit("ok")) == "ok").select(F.inline(F.array(
        *[_row(name, name, _detail(name, min_recall, min_precision)) for name in picks])))
    swept = metrics.rounded_rates(rows)
    out = swept.unionByName(max_ks(df, score, label))
    position = F.array_position(F.array(*[F.lit(s) for s in STRATEGIES]), F.col("strategy"))
    return out.withColumn("position", position.cast("int"))


def compare_thresholds(df: DataFrame, current: float, saved: float, score: str = "pd",
                       label: str = "default") -> DataFrame:
    """Metric by metric: current against saved threshold and the difference (I8)."""
    y = F.col(label)
    aggs = []
    for tag, t in (("c", current), ("s", saved)):
        hit = F.col(score) >= F.lit(float(t))
        aggs += [F.count_if(hit & (y == 1)).alias(f"{tag}tp"), F.count_if(hit & (y == 0)).alias(f"{tag}fp"),
                 F.count_if(~hit & (y == 1)).alias(f"{tag}fn"), F.count_if(~hit & (y == 0)).alias(f"{tag}tn")]

    def rates(tag: str) -> dict[str, Column]:
        tp, fp, fn, tn = (F.col(f"{tag}{c}") for c in _COUNTS)
        return {"precision": metrics.ratio(tp, tp + fp), "recall": metrics.ratio(tp, tp + fn),
                "f1": metrics.ratio(2 * tp, 2 * tp + fp + fn), "specificity": metrics.ratio(tn, tn + fp)}

    now, before = rates("c"), rates("s")
    return df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), now[m].alias("current"), before[m].alias("saved"),
                 (now[m] - before[m]).alias("delta")) for m in now])))
