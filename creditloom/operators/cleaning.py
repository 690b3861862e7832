"""Raw loans to cleaned loans.

Every step is a narrow projection. The only aggregates are the capping and
imputation values, which are learned once (``fit_cleaning``) and then applied
as constants, so new data can be cleaned with the values learned before.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import policy
from creditloom.functions import numeric, parse
from creditloom.operators.quantiles import exact_quantiles
from creditloom.session import materialise

# Labelled loan statuses and their target value.
LABELLED_STATUS = {
    "Fully Paid": 0,
    "Does not meet the credit policy. Status:Fully Paid": 0,
    "Charged Off": 1,
    "Default": 1,
    "Does not meet the credit policy. Status:Charged Off": 1,
    "Late (31-120 days)": 1,
}

# Columns mostly missing in the raw table.
MOSTLY_MISSING = (
    "member_id", "hardship_flag", "hardship_type", "hardship_reason", "hardship_status",
    "deferral_term", "hardship_amount", "hardship_start_date", "hardship_end_date",
    "payment_plan_start_date", "hardship_length", "hardship_dpd", "hardship_loan_status",
    "orig_projected_additional_accrued_interest", "hardship_payoff_balance_amount",
    "hardship_last_payment_amount", "debt_settlement_flag", "debt_settlement_flag_date",
    "settlement_status", "settlement_date", "settlement_amount", "settlement_percentage",
    "settlement_term", "sec_app_mths_since_last_major_derog", "sec_app_revol_util",
    "revol_bal_joint", "sec_app_mort_acc", "sec_app_fico_range_low",
    "sec_app_fico_range_high", "sec_app_earliest_cr_line", "sec_app_inq_last_6mths",
    "sec_app_open_acc", "sec_app_open_act_il", "sec_app_num_rev_accts",
    "sec_app_chargeoff_within_12_mths", "sec_app_collections_12_mths_ex_med",
    "verification_status_joint", "dti_joint", "annual_inc_joint", "desc",
    "mths_since_last_record", "mths_since_recent_bc_dlq", "mths_since_last_major_derog",
    "mths_since_recent_revol_delinq", "next_pymnt_d", "mths_since_last_delinq",
)

# Identifiers, free text and constants.
ADMINISTRATIVE = ("id", "url", "title", "zip_code", "policy_code", "pymnt_plan")

# Fixed values: (low, high) bounds; None means the 99th percentile.
CLIP_BOUNDS = {
    "annual_inc": (0.0, None),
    "dti": (0.0, 100.0),
    "revol_util": (0.0, 100.0),
    "revol_bal": (0.0, None),
}
CAP_QUANTILE = 0.99
REFERENCE_DATE = "2019-01-01"
UNKNOWN = "Unknown"


def keep_labelled(df: DataFrame) -> DataFrame:
    """Rows with a known outcome (B1)."""
    return df.filter(F.col("loan_status").isin(*LABELLED_STATUS))


def status_target(status: Column) -> Column:
    """1 for the defaulted statuses, 0 for the paid ones (B2)."""
    bad = [s for s, v in LABELLED_STATUS.items() if v == 1]
    good = [s for s, v in LABELLED_STATUS.items() if v == 0]
    return F.when(status.isin(*bad), F.lit(1)).when(status.isin(*good), F.lit(0))


def add_target(df: DataFrame) -> DataFrame:
    return df.withColumn(policy.TARGET, status_target(F.col("loan_status")))


def columns_to_drop(columns: list[str]) -> list[str]:
    barred = {*MOSTLY_MISSING, *policy.LEAKAGE_COLUMNS, *ADMINISTRATIVE}
    return [c for c in columns if c in barred]


def drop_unusable(df: DataFrame) -> DataFrame:
    """Drop the three column groups; absent names are ignored."""
    return df.drop(*columns_to_drop(df.columns))


def keep_usable(raw: DataFrame) -> DataFrame:
    """The raw rows and columns that cleaning goes on with, as raw as they are: what is worth storing before it."""
    return keep_labelled(raw).drop(*[c for c in columns_to_drop(raw.columns) if c != "loan_status"])


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def parse_columns(df: DataFrame, reference_date: str | None = REFERENCE_DATE) -> DataFrame:
    """Parse the text cells.

    ``reference_date=None`` measures credit history to the issue date instead of
    to one fixed day.
    """
    new: dict[str, Column] = {}
    for name, parser in (("term", parse.parse_term), ("emp_length", parse.parse_emp_length),
                         ("int_rate", parse.parse_percent), ("revol_util", parse.parse_percent),
                         ("issue_d", parse.parse_month)):
        if name in df.columns and _is_text(df, name):
            new[name] = parser(F.col(name))
    if "earliest_cr_line" in df.columns:
        until = (new.get("issue_d", F.col("issue_d")) if reference_date is None
                 else F.lit(reference_date).cast("date"))
        new["cr_history_months"] = parse.months_between_days(
            parse.parse_month(F.col("earliest_cr_line")), until)
    return df.withColumns(new).drop("earliest_cr_line")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)
            and f.name not in (policy.KEY, policy.TARGET)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)
            and f.name != policy.KEY]


@dataclass(frozen=True)
class CleaningFit:
    """Upper bounds and medians learned from data."""

    caps: dict[str, float] = field(default_factory=dict)
    medians: dict[str, float] = field(default_factory=dict)


def fit_cleaning(parsed: DataFrame, fit_rows: Column | None = None) -> CleaningFit:
    """Learn caps (B10) and medians (B11) from parsed loans, over all rows by default.

    The medians are those of the clipped columns. Clipping keeps the order of
    values, so caps and medians come out of one quantile search.
    """
    rows_used = parsed if fit_rows is None else parsed.filter(fit_rows)
    names = numeric_columns(parsed)
    possible = {c: [0.5] + ([CAP_QUANTILE] if CLIP_BOUNDS.get(c, (0, 0))[1] is None else []) for c in names}
    counted = rows_used.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(names)]).first()
    counts = {c: counted[f"n{i}"] for i, c in enumerate(names)}
    # Only what has gaps needs a median; a sketch of every column costs far more than this scan.
    wanted = {c: [q for q in qs if q != 0.5 or counts[c] < counted["rows"]] for c, qs in possible.items()}
    found = exact_quantiles(rows_used, {c: qs for c, qs in wanted.items() if qs}, counts)
    caps = {c: q[CAP_QUANTILE].value for c, q in found.items() if CAP_QUANTILE in q}
    medians = {}
    for c, q in found.items():
        if 0.5 in q:
            low, high = CLIP_BOUNDS.get(c, (None, None))
            medians[c] = q[0.5].clipped(low, caps.get(c, high)).value
    return CleaningFit(caps, medians)


def clip_fixed(df: DataFrame) -> DataFrame:
    """Bounds that are known beforehand."""
    return df.withColumns({c: numeric.clip(F.col(c), low, high)
                           for c, (low, high) in CLIP_BOUNDS.items()
                           if high is not None and c in df.columns})


def clip_learned(df: DataFrame, fit: CleaningFit) -> DataFrame:
    """Bounds learned from data."""
    return df.withColumns({c: numeric.clip(F.col(c), CLIP_BOUNDS[c][0], cap)
                           for c, cap in fit.caps.items() if c in df.columns})


def impute_numeric(df: DataFrame, fit: CleaningFit) -> DataFrame:
    """Missing numbers become the learned median."""
    new = {}
    for c, median in fit.medians.items():
        if c in df.columns:
            kind = df.schema[c].dataType
            value = F.lit(median)
            if isinstance(kind, T.IntegralType):
                value = F.bround(value).cast(kind)
            new[c] = F.coalesce(F.col(c), value)
    return df.withColumns(new)


def impute_text(df: DataFrame) -> DataFrame:
    """Missing text becomes 'Unknown' (B12)."""
    names = text_columns(df)
    return df.fillna(UNKNOWN, subset=names) if names else df


def downcast(df: DataFrame) -> DataFrame:
    """Double columns become float."""
    return df.withColumns({f.name: F.col(f.name).cast("float") for f in df.schema
                           if isinstance(f.dataType, T.DoubleType)})


def prepare(raw: DataFrame, reference_date: str | None = REFERENCE_DATE) -> DataFrame:
    """The steps before anything has to be learned: B1 to B9."""
    return (raw.transform(keep_labelled).transform(add_target).transform(drop_unusable)
            .transform(parse_columns, reference_date).transform(clip_fixed))


def finish(prepared: DataFrame, fit: CleaningFit) -> DataFrame:
    """The steps that use learned values: B10 to B13."""
    return (prepared.transform(clip_learned, fit).transform(impute_numeric, fit)
            .transform(impute_text).transform(downcast))


def clean(raw: DataFrame, reference_date: str | None = REFERENCE_DATE,
          fit: CleaningFit | None = None) -> DataFrame:
    """The whole cleaning chain (B16); with a stored ``fit``, one narrow pass.

    Without one the prepared loans are written once, so the raw source is read once and the few scans that learn the
    fit go over the far smaller table.
    """
    prepared = prepare(raw, reference_date)
    if fit is None:
        prepared = materialise(prepared, "prepared")
        fit = fit_cleaning(prepared)
    return finish(prepared, fit)


_FIT = "column_name string, cap double, median double"


def save_cleaning(fit: CleaningFit, spark: SparkSession, path: str) -> None:
    """The learned values as a table, one row a column."""
    rows = [(c, fit.caps.get(c), fit.medians.get(c)) for c in sorted({*fit.caps, *fit.medians})]
    spark.createDataFrame(rows, _FIT).coalesce(1).write.mode("overwrite").parquet(path)


def load_cleaning(spark: SparkSession, path: str) -> CleaningFit:
    """What ``save_cleaning`` stored, to clean raw loans that came later with it."""
    rows = spark.read.schema(_FIT).parquet(path).collect()
    return CleaningFit({r["column_name"]: r["cap"] for r in rows if r["cap"] is not None},
                       {r["column_name"]: r["median"] for r in rows if r["median"] is not None})


def null_audit(df: DataFrame) -> DataFrame:
    """Missing cells and type per column, one scan."""
    names = df.columns
    types = dict(df.dtypes)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                                 F.col(f"n{i}").alias("null_count"))
                        for i, c in enumerate(names)])
    return counted.select(F.inline(entries))


def cleaning_summary(raw: DataFrame, reference_date: str | None = REFERENCE_DATE) -> DataFrame:
    """Rows, columns and default rate per cleaning stage, one scan."""
    target = status_target(F.col("loan_status"))
    prepared_columns = len(prepare(raw, reference_date).columns)
    has_key = int(policy.KEY in raw.columns)
    counted = raw.agg(F.count(F.lit(1)).alias("all_rows"), F.count(target).alias("kept"),
                      F.avg(target).alias("rate"))

    def stage(name: str, rows: str, width: int, rate: Column) -> Column:
        return F.struct(F.lit(name).alias("stage"), F.col(rows).alias("rows"),
                        F.lit(width).cast("bigint").alias("columns"), rate.alias("default_rate"))

    return counted.select(F.inline(F.array(
        stage("raw", "all_rows", len(raw.columns) - has_key, F.lit(None).cast("double")),
        stage("labelled", "kept", len(raw.columns) + 1 - has_key, F.col("rate")),
        stage("cleaned", "kept", prepared_columns - has_key, F.col("rate")))))
