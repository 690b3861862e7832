"""Model quality from (label, score) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom.functions import bins
from creditloom.functions.numeric import missing, present, ratio
from creditloom.operators.prefix import score_table
from creditloom.operators.quantiles import exact_quantiles

EPSILON = 2.220446049250313e-16   # double precision
COMPARISON_CLIP = 1e-6


def _curve(df: DataFrame, score: str, label: str, group: str | None) -> DataFrame:
    return score_table(df, score, label, group)


def auc_term() -> Column:
    """Share of (positive, negative) pairs ordered rightly, ties half, per score row; NULL without any pair."""
    won = F.col("neg") * ((F.col("tp") - F.col("pos")) + F.col("pos") / 2)
    return F.try_divide(F.sum(won), F.max("positives").cast("double") * F.max("negatives").cast("double"))


def average_precision_term() -> Column:
    """NULL without a positive label."""
    step = F.try_divide(F.col("pos"), F.col("positives"))
    return F.sum(step * F.col("tp") / (F.col("tp") + F.col("fp")))


def ks_gap() -> Column:
    """NULL where one of the classes is absent."""
    return F.try_divide(F.col("tp"), F.col("positives")) - F.try_divide(F.col("fp"), F.col("negatives"))


def rank_metrics(df: DataFrame, score: str = "pd", label: str = "default",
                 group: str | None = None) -> DataFrame:
    """ROC-AUC, average precision, KS and its threshold from one ordered table (H1, H2, H5).

    On equal gaps the highest score wins; when no score separates at all the
    gap is 0 at an infinite threshold. A group with one class alone has no
    ROC-AUC and no KS (NULL), one without positives no average precision.
    """
    keys = [group] if group else []
    best = F.max_by(F.struct("gap", "score"), F.struct(F.col("gap"), F.col("score")))
    out = (_curve(df, score, label, group).withColumn("gap", ks_gap()).groupBy(*keys)
           .agg(auc_term().alias("roc_auc"), average_precision_term().alias("pr_auc"), best.alias("b")))
    none = F.col("b.gap") <= 0
    return out.select(*keys, "roc_auc", "pr_auc",
                      F.when(none, F.lit(0.0)).otherwise(F.col("b.gap")).alias("ks_stat"),
                      F.when(none, F.lit(float("inf"))).otherwise(F.col("b.score")).alias("ks_threshold"))


def roc_auc(df: DataFrame, score: str = "pd", label: str = "default") -> DataFrame:
    return _curve(df, score, label, None).agg(auc_term().alias("roc_auc"))


def average_precision(df: DataFrame, score: str = "pd", label: str = "default") -> DataFrame:
    return _curve(df, score, label, None).agg(average_precision_term().alias("average_precision"))


def brier_term(p: Column, y: Column) -> Column:
    return F.avg((p - y) * (p - y))


def log_loss_term(p: Column, y: Column, clip: float = EPSILON) -> Column:
    bounded = F.least(F.lit(1 - clip), F.greatest(F.lit(clip), p.cast("double")))
    return F.avg(F.when(y == 1, -F.log(bounded)).otherwise(-F.log(1 - bounded)))


def probability_metrics(df: DataFrame, score: str = "pd", label: str = "default",
                        group: str | None = None, clip: float = EPSILON) -> DataFrame:
    """Brier score and log loss (H3, H4). A NULL or NaN score fails the job."""
    keys = [group] if group else []
    p, y = present(F.col(score).cast("double"), f"Score {score}"), F.col(label)
    return df.groupBy(*keys).agg(brier_term(p, y).alias("brier"),
                                 log_loss_term(p, y, clip).alias("log_loss"))


def all_metrics(df: DataFrame, score: str = "pd", label: str = "default",
                group: str | None = None, clip: float = EPSILON) -> DataFrame:
    """Rank and probability metrics side by side, one row per group."""
    ranked = rank_metrics(df, score, label, group)
    fitted = probability_metrics(df, score, label, group, clip)
    if group:
        return ranked.join(F.broadcast(fitted), group)
    one = F.lit(1).alias("_one")
    return (ranked.withColumn("_one", F.lit(1))
            .join(F.broadcast(fitted.select("*", one)), "_one").drop("_one"))


def roc_points(df: DataFrame, score: str = "pd", label: str = "default") -> DataFrame:
    """(fpr, tpr, threshold), from (0, 0) at infinity on (H6)."""
    points = _curve(df, score, label, None).select(
        F.try_divide("fp", "negatives").alias("fpr"),
        F.try_divide("tp", "positives").alias("tpr"), F.col("score").alias("threshold"))
    start = df.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold"))
    return start.unionByName(points)


def pr_points(df: DataFrame, score: str = "pd", label: str = "default") -> DataFrame:
    """(precision, recall, threshold) and the end point (1, 0) (H7)."""
    points = _curve(df, score, label, None).select(
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "positives").alias("recall"), F.col("score").alias("threshold"))
    end = df.sparkSession.range(1).select(
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"))
    return points.unionByName(end)


def confusion_at(df: DataFrame, threshold: float, score: str = "pd", label: str = "default") -> DataFrame:
    """TP, FP, FN, TN when score >= threshold counts as positive (H8). A NULL or NaN score fails the job."""
    hit, y = present(F.col(score).cast("double"), f"Score {score}") >= F.lit(float(threshold)), F.col(label)
    return df.agg(F.count_if(hit & (y == 1)).alias("tp"), F.count_if(hit & (y == 0)).alias("fp"),
                  F.count_if(~hit & (y == 1)).alias("fn"), F.count_if(~hit & (y == 0)).alias("tn"))


def rate_columns() -> dict[str, Column]:
    """Precision, recall, specificity and F1 from confusion counts, 0 on empty denominators."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn),
            "specificity": ratio(tn, tn + fp), "f1": ratio(2 * tp, 2 * tp + fp + fn)}


def rounded_rates(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(v, digits) for c, v in rate_columns().items()})


def metrics_at(df: DataFrame, threshold: float, score: str = "pd", label: str = "default",
               digits: int = 4) -> DataFrame:
    """Confusion counts and rates at one threshold (H9)."""
    counts = confusion_at(df, threshold, score, label)
    return rounded_rates(counts, digits).withColumn("threshold", F.round(F.lit(float(threshold)), digits))


def threshold_sweep(df: DataFrame, grid: Sequence[float] | None = None, score: str = "pd",
                    label: str = "default", extra: dict[str, Column] | None = None,
                    count_unscored: bool = False) -> DataFrame:
    """Confusion counts and rates at every grid point.

    Each row finds its grid interval by binary search; the rest is a running
    sum over one row per interval, however many rows came in. ``extra`` adds
    sums (of columns) over the rows at or above each threshold. A NULL or NaN
    score fails the job; with ``count_unscored`` such rows are counted in a
    column ``unscored`` instead, so that it and the four counts give all rows.
    """
    grid = sorted(grid if grid is not None else bins.linear_grid(*bins.SWEEP_GRID))
    extra = extra or {}
    y = F.col(label)
    value = F.col(score).cast("double")
    known = F.when(~missing(value), value) if count_unscored else present(value, f"Score {score}")
    counted = (bins.grid_bucket(df.withColumn("_s", known), "_s", grid, "_b")
               .withColumn("_b", F.coalesce("_b", F.lit(-1))).groupBy("_b")
               .agg(F.count_if(y == 1).alias("p"), F.count_if(y == 0).alias("n"),
                    *[F.sum(v).alias(f"x_{c}") for c, v in extra.items()]))
    spine = df.sparkSession.range(-1, len(grid) + 1).select(F.col("id").cast("int").alias("_b"))
    filled = spine.join(F.broadcast(counted), "_b", "left").na.fill(0)
    at_or_above = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(F.desc("_b")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    points = F.array(*[F.lit(float(t)) for t in grid])
    scored = F.col("_b") >= 0
    swept = filled.select(
        "_b", F.sum("p").over(at_or_above).alias("tp"), F.sum("n").over(at_or_above).alias("fp"),
        F.sum(F.when(scored, F.col("p")).otherwise(0)).over(everything).alias("all_p"),
        F.sum(F.when(scored, F.col("n")).otherwise(0)).over(everything).alias("all_n"),
        F.sum(F.when(scored, 0).otherwise(F.col("p") + F.col("n"))).over(everything).alias("unscored"),
        *[F.sum(f"x_{c}").over(at_or_above).alias(c) for c in extra],
        *[F.sum(f"x_{c}").over(everything).alias(f"all_{c}") for c in extra])
    kept = ["tp", "fp", *extra, *[f"all_{c}" for c in extra], *(["unscored"] if count_unscored else [])]
    return (swept.filter(F.col("_b") > 0)
            .select(F.element_at(points, F.col("_b")).alias("threshold"), *kept,
                    (F.col("all_p") - F.col("tp")).alias("fn"),
                    (F.col("all_n") - F.col("fp")).alias("tn"))
            .withColumns(rate_columns()))


def classification_report(df: DataFrame, threshold: float, score: str = "pd",
                          label: str = "default") -> DataFrame:
    """Per-class, accuracy and averaged rows."""
    c = confusion_at(df, threshold, score, label)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))

    def line(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), support.cast("bigint").alias("support"))

    p0, r0, f0 = ratio(tn, tn + fn), ratio(tn, tn + fp), ratio(2 * tn, 2 * tn + fn + fp)
    p1, r1, f1 = ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(2 * tp, 2 * tp + fp + fn)
    n0, n1 = tn + fp, tp + fn
    n = n0 + n1
    accuracy = ratio(tp + tn, n)

    def weighted(a: Column, b: Column) -> Column:
        return ratio(a * n0 + b * n1, n)

    return c.select(F.inline(F.array(
        line("paid", p0, r0, f0, n0), line("default", p1, r1, f1, n1),
        line("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), accuracy, n),
        line("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        line("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), n))))


def _scored(df: DataFrame, score: str) -> DataFrame:
    return df.withColumn(score, present(F.col(score).cast("double"), f"Score {score}"))


def _calibration(binned: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    return (binned.groupBy(*keys, "bin")
            .agg(F.avg(score).alias("mean_predicted"), F.avg(F.col(label)).alias("observed_rate"),
                 F.count(F.lit(1)).alias("rows")))


def calibration_uniform(df: DataFrame, n_bins: int = 10, score: str = "pd", label: str = "default",
                        group: str | None = None) -> DataFrame:
    """Mean prediction against observed rate in equal-width, right-closed bins (H12). A NULL or NaN score fails the job."""
    df = _scored(df, score)
    binned = df.withColumn("bin", bins.right_closed_bin(F.col(score), 0.0, 1.0, n_bins))
    return _calibration(binned, [group] if group else [], score, label)


def calibration_quantile(df: DataFrame, n_bins: int = 20, score: str = "pd",
                         label: str = "default") -> DataFrame:
    """The same in bins of equal row count."""
    df = _scored(df, score)
    fractions = [i / n_bins for i in range(1, n_bins)]
    found = exact_quantiles(df, {score: fractions}).get(score, {})
    edges = [found[q].value for q in fractions if q in found]
    binned = df.withColumn("bin", bins.count_edges_below(F.col(score), edges))
    return _calibration(binned, [], score, label)


def score_histogram(df: DataFrame, n_bins: int = 50, score: str = "pd",
                    group: str | None = None) -> DataFrame:
    """Density histogram over each group's own range, last bin closed (H14). A NULL or NaN score fails the job.

    The limits stay a table, one row per group, that the scores are joined with: many groups cost neither driver memory
    nor a longer plan. A group whose scores are all the same has one bin of density 1 per row.
    """
    key = F.col(group) if group else F.lit(0)
    scored = _scored(df, score).select(key.alias("_g"), F.col(score).alias("_x"))
    limits = (scored.groupBy("_g").agg(F.min("_x").alias("low"), F.max("_x").alias("high"), F.count("_x").alias("n"))
              .select(F.col("_g").alias("_key"), "low", "n", "high",
                      ((F.col("high") - F.col("low")) / n_bins).alias("width")))
    joined = scored.join(limits, F.col("_g").eqNullSafe(F.col("_key")))
    low, width, x = F.col("low"), F.col("width"), F.col("_x")

    def edge(i: Column) -> Column:
        return F.when(i >= n_bins, F.col("high")).otherwise(i * width + low)

    guess = F.greatest(F.lit(0), F.least(F.lit(n_bins - 1), F.floor(F.try_divide(x - low, width)).cast("int")))
    # The guess by division is checked against the edges themselves.
    placed = joined.withColumn("bin", F.when(width == 0, F.lit(0)).otherwise(guess))
    down, up = x < edge(F.col("bin")), (F.col("bin") < n_bins - 1) & (x >= edge(F.col("bin") + 1))
    placed = placed.withColumn("bin", F.when(width == 0, F.col("bin")).when(down, F.col("bin") - 1)
                               .when(up, F.col("bin") + 1).otherwise(F.col("bin")))
    counted = placed.groupBy("_g", "bin", "low", "width", "n").agg(F.count(F.lit(1)).alias("rows"))
    area = F.when(width == 0, F.lit(1.0)).otherwise(F.col("n") * width)
    return counted.select(*([F.col("_g").alias(group)] if group else []), "bin", (low + F.col("bin") * width).alias("bin_start"),
                          "rows", (F.col("rows") / area).alias("density"))


def base_rate(df: DataFrame, label: str = "default") -> DataFrame:
    """Default rate and the Brier score of always predicting it."""
    rate = F.avg(F.col(label))
    return df.agg(rate.alias("base_rate"), (rate * (1 - rate)).alias("no_skill_brier"))
