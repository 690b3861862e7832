"""From contributions to readable explanations.

Per-loan steps work inside the loan's own driver array: no shuffle, no window.
Global steps pre-aggregate per feature on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import policy
from creditloom.functions.risk import risk_band
from creditloom.functions.wording import driver_sentence, feature_meaning
from creditloom.operators.attribution import to_long

# Direction notes and headings.
UNSTABLE = "Direction is not stable in this sample."
VARIES = "Effect varies by borrower context."
RAISES = "Higher values tend to increase predicted default risk."
LOWERS = "Higher values tend to reduce predicted default risk."
HIGHER_HEADING = "This loan is predicted as higher risk mainly because:"
LOWER_HEADING = "Risk is partially reduced because:"
WEAK_CORRELATION = 0.05


def global_importance(attributed: DataFrame, top: int = 30) -> DataFrame:
    """Mean absolute contribution per feature with direction and meaning.

    One row per model feature comes out of the aggregation, so ranking it is a
    top-k over a table as small as the feature list.
    """
    value, part = F.col("value"), F.col("contribution")
    varied = (F.min(value) < F.max(value)) | ((F.count(value) > 0) & (F.count(value) < F.count(F.lit(1))))
    both = value.isNotNull() & part.isNotNull()
    x, y = F.when(both, value), F.when(both, part)
    link = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    per = (to_long(attributed).groupBy("feature")
           .agg(F.avg(F.abs(part)).alias("mean_abs_contribution"), varied.alias("varied"), link.alias("link")))
    note = (F.when(~F.col("varied"), F.lit(UNSTABLE))
            .when(F.col("link").isNull() | (F.abs("link") < WEAK_CORRELATION), F.lit(VARIES))
            .when(F.col("link") > 0, F.lit(RAISES)).otherwise(F.lit(LOWERS)))
    ranked = per.orderBy(F.desc("mean_abs_contribution"), "feature").limit(top)
    listed = ranked.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("mean_abs_contribution")).alias("order"), "feature", "mean_abs_contribution",
        note.alias("direction_note")))).alias("l"))
    return (listed.select(F.posexplode("l").alias("place", "e"))
            .select("e.feature", "e.mean_abs_contribution", (F.col("place") + 1).alias("rank"), "e.direction_note",
                    feature_meaning(F.col("e.feature")).alias("business_interpretation")))


def _sorted_drivers(positive: bool, top: int) -> Column:
    """Strongest contributions of one sign; equal ones by feature name."""
    sign = -1.0 if positive else 1.0
    kept = F.filter("drivers", lambda d: d["contribution"] > 0 if positive else d["contribution"] < 0)
    keyed = F.transform(kept, lambda d: F.struct((d["contribution"] * sign).alias("order"), d["feature"].alias("feature"),
                                                 d["value"].alias("value"), d["contribution"].alias("contribution")))
    best = F.slice(F.array_sort(keyed), 1, top)
    return F.transform(best, lambda d: F.struct(
        d["feature"].alias("feature"), d["value"].alias("value"), d["contribution"].alias("contribution"),
        driver_sentence(d["feature"], d["value"], d["contribution"]).alias("explanation")))


def local_drivers(attributed: DataFrame, top: int = 5) -> DataFrame:
    """Top risk-raising and risk-lowering drivers per loan (L6) with sentences."""
    keep = [c for c in attributed.columns if c != "drivers"]
    return attributed.select(*keep, _sorted_drivers(True, top).alias("top_positive_drivers"),
                             _sorted_drivers(False, top).alias("top_negative_drivers"))


def drivers_long(local: DataFrame) -> DataFrame:
    """One row per loan, direction and place."""
    def side(column: str, name: str) -> DataFrame:
        return (local.select(policy.KEY, F.posexplode(column).alias("place", "d"))
                .select(policy.KEY, F.lit(name).alias("direction"), (F.col("place") + 1).alias("place"), "d.*"))
    return side("top_positive_drivers", "raises").unionByName(side("top_negative_drivers", "lowers"))


def _numbered(column: str) -> Column:
    return F.transform(F.col(column), lambda d, i: F.concat((i + 1).cast("string"), F.lit(". "), d["explanation"]))


def explanation_text(local: DataFrame) -> DataFrame:
    """The two numbered lists under their headings as one text."""
    up, down = F.size("top_positive_drivers") > 0, F.size("top_negative_drivers") > 0
    none = F.array().cast("array<string>")
    lines = F.concat(
        F.when(up, F.concat(F.array(F.lit(HIGHER_HEADING)), _numbered("top_positive_drivers"))).otherwise(none),
        F.when(up & down, F.array(F.lit(""))).otherwise(none),
        F.when(down, F.concat(F.array(F.lit(LOWER_HEADING)), _numbered("top_negative_drivers"))).otherwise(none))
    return local.withColumn("explanation_text", F.array_join(lines, "\n"))


def example_loan(explained: DataFrame, pd: str = "pd", label: str = policy.TARGET,
                 threshold: float | None = None) -> DataFrame:
    """The loan with the highest probability, or the first true positive.

    ``explained`` carries key, label, probability and the explanation columns.
    """
    order = F.struct(F.col(pd), -F.col(policy.KEY))
    if threshold is not None:
        hit = (F.col(label) == 1) & (F.col(pd) >= F.lit(float(threshold)))
        order = F.when(hit, F.struct(-F.col(policy.KEY)))
    row = F.struct(*explained.columns)
    picked = explained.agg(F.max_by(row, order).alias("r"), F.avg(pd).alias("base_value"))
    return picked.select("r.*", "base_value").withColumn("risk_label", risk_band(F.col(pd)))


def strongest_drivers(attributed: DataFrame, top: int = 10) -> DataFrame:
    """Chart data: per loan the largest contributions of either sign."""
    keyed = F.transform("drivers", lambda d: F.struct(
        (-F.abs(d["contribution"])).alias("order"), d["feature"].alias("feature"),
        d["value"].alias("value"), d["contribution"].alias("contribution")))
    best = F.slice(F.array_sort(keyed), 1, top)
    return (attributed.select(policy.KEY, F.posexplode(best).alias("place", "d"))
            .select(policy.KEY, (F.col("place") + 1).alias("place"), "d.feature", "d.value", "d.contribution"))


def dependence_pairs(attributed: DataFrame, importance: DataFrame, top: int = 4) -> DataFrame:
    """Chart data: value against contribution for the leading features."""
    leading = importance.filter(F.col("rank") <= top).select("feature")
    return (to_long(attributed).join(F.broadcast(leading), "feature", "left_semi")
            .select(policy.KEY, "feature", "value", "contribution"))
