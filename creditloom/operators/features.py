"""Cleaned loans to the numeric feature table (E1 to E25), for training and serving.

One set of expressions serves both: training leaves an unknown label NULL, so
that validation reports it, while serving fills in agreed fallbacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import policy
from creditloom.functions import encode, numeric
from creditloom.operators.comoments import correlation_with
from creditloom.operators.encoding import (FREQUENCY_ENCODINGS, TARGET_ENCODINGS, Encodings,
                                           fit_encodings)

# Skewed amounts that get a log twin.
LOG_COLUMNS = ("annual_inc", "revol_bal", "tot_coll_amt", "delinq_amnt", "total_rev_hi_lim",
               "tot_hi_cred_lim", "total_bal_ex_mort", "total_bc_limit",
               "total_il_high_credit_limit")
COLLINEAR = ("funded_amnt", "funded_amnt_inv", "fico_range_high")
REPLACED_TEXT = ("grade", "sub_grade", "verification_status", "home_ownership", "purpose",
                 "addr_state", "emp_title", "initial_list_status", "application_type",
                 "disbursement_method", "term")

# What serving assumes for a raw field that is absent or empty.
SERVING_DEFAULTS = {"term": 36.0, "initial_list_status": "w", "application_type": "Individual",
                    "disbursement_method": "Cash", "grade": "", "sub_grade": "",
                    "verification_status": "", "home_ownership": "", "purpose": "",
                    "addr_state": "", "emp_title": ""}
RATIO_INPUTS = ("loan_amnt", "annual_inc", "installment", "revol_bal", "tot_hi_cred_lim",
                "total_bc_limit", "bc_open_to_buy", "int_rate", "fico_range_low", "dti", "pub_rec",
                "collections_12_mths_ex_med", "total_acc", "inq_last_6mths", "open_acc",
                "total_bal_ex_mort")


def ordinal_features(columns: list[str], serving: bool = False) -> dict[str, Column]:
    """Closed label sets and flags."""
    fall = encode.SERVING_FALLBACK if serving else {}
    out: dict[str, Column] = {}
    if "grade" in columns:
        out["grade_enc"] = encode.grade_value(F.col("grade"), fall.get("grade"))
    if "sub_grade" in columns:
        out["sub_grade_enc"] = encode.sub_grade_value(F.col("sub_grade"), fall.get("sub_grade"))
    if "verification_status" in columns:
        out["verification_status_enc"] = encode.verification_value(
            F.col("verification_status"), fall.get("verification_status"))
    if "home_ownership" in columns:
        out["home_ownership_enc"] = encode.home_ownership_value(F.col("home_ownership"))
    if "term" in columns:
        out["term_60"] = encode.flag(F.col("term"), 60)
    for source, (name, value) in encode.FLAG_VALUES.items():
        if source in columns:
            out[name] = encode.flag(F.col(source), value)
    return out


def log_features(columns: list[str]) -> dict[str, Column]:
    """E12."""
    return {f"{c}_log": numeric.log1p_floor0(F.col(c)) for c in LOG_COLUMNS if c in columns}


def ratio_features(columns: list[str]) -> dict[str, Column]:
    """E14 to E19. A ratio appears when all its inputs do."""
    def d(name: str) -> Column:
        return F.col(name).cast("double")

    have = set(columns)
    out: dict[str, Column] = {}

    def add(name: str, needs: tuple[str, ...], build) -> None:
        if have.issuperset(needs):
            out[name] = build()

    add("loan_to_income", ("loan_amnt", "annual_inc"),
        lambda: numeric.safe_div(d("loan_amnt"), d("annual_inc")))
    add("installment_to_income", ("installment", "annual_inc"),
        lambda: numeric.safe_div(d("installment"), d("annual_inc") / 12))
    add("credit_util_total", ("revol_bal", "tot_hi_cred_lim"),
        lambda: numeric.safe_div(d("revol_bal"), d("tot_hi_cred_lim") + 1))
    add("bc_util_ratio", ("total_bc_limit", "bc_open_to_buy"),
        lambda: numeric.safe_div(
            numeric.clip(d("total_bc_limit") - d("bc_open_to_buy"), low=0), d("total_bc_limit") + 1))
    add("int_rate_x_term", ("int_rate", "term"), lambda: d("int_rate") * d("term"))
    add("fico_dti_score", ("fico_range_low", "dti"),
        lambda: numeric.safe_div(d("fico_range_low"), d("dti") + 1))
    collections = (F.coalesce(d("collections_12_mths_ex_med"), F.lit(0.0))
                   if "collections_12_mths_ex_med" in have else F.lit(0.0))
    add("derog_ratio", ("pub_rec", "total_acc"),
        lambda: numeric.safe_div(F.coalesce(d("pub_rec"), F.lit(0.0)) + collections,
                                 d("total_acc") + 1))
    add("inq_per_acc", ("inq_last_6mths", "open_acc"),
        lambda: numeric.safe_div(d("inq_last_6mths"), d("open_acc") + 1))
    add("revolving_debt_share", ("revol_bal", "total_bal_ex_mort"),
        lambda: numeric.safe_div(d("revol_bal"), d("total_bal_ex_mort") + 1))
    return out


def drop_redundant(df: DataFrame) -> DataFrame:
    """Collinear twins, text replaced by encodings, and any leakage column."""
    return df.drop(*COLLINEAR, *REPLACED_TEXT, *policy.LEAKAGE_COLUMNS)


def fill_serving_defaults(df: DataFrame) -> DataFrame:
    """Absent or empty raw fields get their serving default."""
    numbers = {*LOG_COLUMNS, *RATIO_INPUTS}
    defaults = {**{c: 0.0 for c in numbers}, **SERVING_DEFAULTS}
    # Income divides: absent income leaves the numerator as it is.
    defaults["annual_inc"] = None
    new = {}
    for c, value in defaults.items():
        if value is None:
            if c not in df.columns:
                new[c] = F.lit(None).cast("double")
        elif c in df.columns:
            new[c] = F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType))
        else:
            new[c] = F.lit(value)
    return df.withColumns(new)


def build_features(df: DataFrame, encodings: Encodings, serving: bool = False) -> DataFrame:
    """Apply learned and fixed encodings, logs and ratios; drop what they replace."""
    if serving:
        df = fill_serving_defaults(df)
    for source, name in {**{c: n for c, (n, _) in TARGET_ENCODINGS.items()},
                         **FREQUENCY_ENCODINGS}.items():
        if source in df.columns:
            df = encodings.apply(df, source, name)
    columns = df.columns
    ratios = ratio_features(columns)
    if serving:
        income = F.col("annual_inc").cast("double")
        ratios["loan_to_income"] = numeric.safe_div(
            F.col("loan_amnt"), F.coalesce(income, F.lit(1.0)))
        ratios["installment_to_income"] = numeric.safe_div(
            F.col("installment"), F.coalesce(income, F.lit(12.0)) / 12)
    logs = log_features(columns)
    if serving:
        logs["annual_inc_log"] = F.coalesce(logs["annual_inc_log"], F.lit(0.0))
    df = df.withColumns({**ordinal_features(columns, serving), **logs, **ratios})
    return df.transform(drop_redundant).transform(to_float)


def to_float(df: DataFrame) -> DataFrame:
    """Numbers become float, as stored feature tables have them."""
    keep = {policy.KEY, policy.TARGET}
    return df.withColumns({f.name: F.col(f.name).cast("float") for f in df.schema
                           if isinstance(f.dataType, T.NumericType) and f.name not in keep
                           and not isinstance(f.dataType, T.FloatType)})


def validate_features(df: DataFrame) -> None:
    """Raise unless all columns are numeric, complete, finite and allowed."""
    allowed = (policy.KEY, policy.SPLIT_COLUMN, "split", "is_fit")
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in allowed]
    if text:
        raise policy.PolicyError(f"Text columns remain after encoding: {text}")
    policy.refuse_leakage(df.columns, "Feature table")
    checks = []
    for f in df.schema:
        value = F.col(f.name)
        fractional = isinstance(f.dataType, T.FractionalType)
        missing = (value.isNull() | F.isnan(value)) if fractional else value.isNull()
        checks.append(F.count_if(missing).alias(f"null:{f.name}"))
        if fractional:
            checks.append(F.count_if(F.abs(value) == float("inf")).alias(f"inf:{f.name}"))
    if policy.TARGET in df.columns:
        checks.append(F.count_if(~F.col(policy.TARGET).isin(0, 1)).alias("target:values"))
    row = df.agg(*checks).first().asDict()
    bad = {name: n for name, n in row.items() if n}
    if bad:
        raise policy.PolicyError(f"Feature table is not clean: {bad}")


def engineer_features(df: DataFrame, encodings: Encodings | None = None,
                      check: bool = True) -> tuple[DataFrame, Encodings]:
    """Cleaned loans (with ``is_fit``) to features and the encodings learned."""
    if encodings is None:
        fit_on = df if "is_fit" in df.columns else df.withColumn("is_fit", F.lit(True))
        encodings = fit_encodings(fit_on)
    out = build_features(df, encodings)
    if check:
        validate_features(out)
    return out, encodings


def correlation_with_target(df: DataFrame, columns: list[str],
                            target: str = policy.TARGET) -> DataFrame:
    """Pearson correlation of many columns with the target, one scan; NULL where a side does not vary."""
    return correlation_with(df, columns, target)


def engineered_report(df: DataFrame, columns: list[str], top: int = 15) -> DataFrame:
    """Engineered features with the strongest link to the target."""
    return (correlation_with_target(df, columns)
            .orderBy(F.desc_nulls_last(F.abs("correlation")), "feature").limit(top))
