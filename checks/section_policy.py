"""C: column policy, shown as small tables over the columns of the loan view."""

from pyspark.sql import functions as F

from checks import frames
from checks.registry import check
from creditloom import policy
from creditloom.operators import cleaning, scoring

_SHOWN = frames.ALL_COLUMNS
_LEAKS = {"recoveries", "last_pymnt_amnt", "hardship_flag", "last_fico_range_low", "loan_status"}
_FEATURES = {*_SHOWN} - _LEAKS - {"loan_id", "funded_amnt", "fico_range_high", "emp_title"}


def _verdicts(chosen: set, word: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {i}::INTEGER AS position, {str(c in chosen).upper()} AS {word}, "
        f'count("{c}") AS filled FROM raw' for i, c in enumerate(_SHOWN))


def _table(spark, d, chosen, word):
    df = frames.raw(spark, d, *_SHOWN)
    counted = df.agg(*[F.count(c).alias(f"n_{c}") for c in _SHOWN])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"),
                 F.lit(c in chosen).alias(word), F.col(f"n_{c}").alias("filled"))
        for i, c in enumerate(_SHOWN)])))


@check("c1_feature_columns", f"WITH {frames.RAW} {_verdicts(_FEATURES, 'is_feature')}")
def c1(spark, d):
    names = frames.raw(spark, d, *_SHOWN).columns
    return _table(spark, d, set(policy.having("feature", names)), "is_feature")


@check("c2_leakage_present", f"WITH {frames.RAW} {_verdicts(_LEAKS, 'is_leakage')}")
def c2(spark, d):
    names = frames.raw(spark, d, *_SHOWN).columns
    return _table(spark, d, set(policy.having("leakage", names)), "is_leakage")


def _refused(action) -> bool:
    try:
        action()
    except policy.PolicyError:
        return True
    return False


@check("c3_refuse_leakage", f"WITH {frames.RAW} "
       "SELECT 'raw' AS frame, TRUE AS refused, count(*) AS \"rows\" FROM raw "
       "UNION ALL SELECT 'after drop', FALSE, count(*) FROM raw")
def c3(spark, d):
    raw = frames.raw(spark, d, "loan_amnt", "recoveries")
    tables = {"raw": raw, "after drop": cleaning.drop_unusable(raw)}
    parts = [t.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("frame"),
        F.lit(_refused(lambda t=t: policy.refuse_leakage(t.columns))).alias("refused"), "rows")
        for name, t in tables.items()]
    return parts[0].unionByName(parts[1])


@check("c4_require_features", f"WITH {frames.RAW} "
       "SELECT 'loan_amnt,dti' AS needed, FALSE AS refused, count(*) AS \"rows\" FROM raw "
       "UNION ALL SELECT 'loan_amnt,missing_feature', TRUE, count(*) FROM raw")
def c4(spark, d):
    raw = frames.raw(spark, d, "loan_amnt", "dti")
    parts = [raw.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(",".join(need)).alias("needed"),
        F.lit(_refused(lambda need=need: policy.require_features(raw.columns, need))).alias("refused"),
        "rows") for need in (["loan_amnt", "dti"], ["loan_amnt", "missing_feature"])]
    return parts[0].unionByName(parts[1])


@check("c5_align_to_model", frames.PREP + "SELECT loan_id, CAST(coalesce(dti, 0) AS FLOAT) AS dti, "
       "CAST(0 AS FLOAT) AS tax_liens, CAST(loan_amnt AS FLOAT) AS loan_amnt FROM prep")
def c5(spark, d):
    df = frames.prepared(spark, d, "loan_amnt", "dti")
    return scoring.align_features(df, ["dti", "tax_liens", "loan_amnt"], keep=["loan_id"])
