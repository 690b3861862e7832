"""Input frames of the checks, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.loan_sql import RAW
from creditloom.operators import cleaning, splitting
from creditloom.session import materialise
from creditloom.sources.loan_view import (COLUMNS, REFERENCE_DATE, TRAIN_END, VALIDATION_END, loan_view)

CUTOFFS = splitting.Cutoffs(TRAIN_END, VALIDATION_END)

NUMERIC = ["loan_amnt", "funded_amnt", "term", "int_rate", "installment", "emp_length", "annual_inc",
           "dti", "delinq_2yrs", "fico_range_low", "fico_range_high", "inq_last_6mths", "open_acc",
           "pub_rec", "revol_bal", "revol_util", "total_acc", "tot_coll_amt", "delinq_amnt",
           "total_rev_hi_lim", "tot_hi_cred_lim", "total_bal_ex_mort", "total_bc_limit",
           "total_il_high_credit_limit", "bc_open_to_buy", "collections_12_mths_ex_med", "mort_acc"]
TEXT = ["grade", "sub_grade", "emp_title", "home_ownership", "verification_status", "purpose",
        "addr_state", "initial_list_status", "application_type", "disbursement_method"]


def raw(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return loan_view(spark, folder, columns or None)


def prepared(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Labelled, parsed and range-clipped loans with the given columns."""
    wanted = ["loan_status", *columns] if columns else None
    return cleaning.prepare(loan_view(spark, folder, wanted), REFERENCE_DATE)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned loans; what cleaning uses of the raw table is joined together and stored once beforehand."""
    return cleaning.clean(materialise(cleaning.keep_usable(loan_view(spark, folder)), "raw"), REFERENCE_DATE)


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """loan_id, default, pd, ead, split: a stored score table without any model."""
    df = prepared(spark, folder, "issue_d", "loan_amnt", "pd")
    return (splitting.add_split(df, CUTOFFS)
            .select("loan_id", "default", "pd", F.col("loan_amnt").alias("ead"), "split"))


def test_scores(spark: SparkSession, folder: str) -> DataFrame:
    return scores(spark, folder).filter(F.col("split") == "test")


_STATUSES = ", ".join("'" + s + "'" for s in cleaning.LABELLED_STATUS)
_BAD = ", ".join("'" + s + "'" for s, v in cleaning.LABELLED_STATUS.items() if v)

LAB = f"""WITH {RAW},
lab AS (SELECT *, CASE WHEN loan_status IN ({_BAD}) THEN 1 ELSE 0 END AS "default"
        FROM raw WHERE loan_status IN ({_STATUSES}))
"""


def _digits(c: str) -> str:
    return f"try_cast(regexp_extract({c}, '[0-9]+') AS DOUBLE)"


def _pct(c: str) -> str:
    return f"try_cast(replace({c}, '%', '') AS DOUBLE)"


def _within(x: str, low: str, high: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN greatest({low}, least({high}, {x})) END"


PARSED = {
    "term": _digits("term"),
    "emp_length": f"CASE WHEN contains(emp_length, '< 1') THEN 0.0::DOUBLE ELSE {_digits('emp_length')} END",
    "int_rate": _pct("int_rate"),
    "revol_util": _within(_pct("revol_util"), "0.0::DOUBLE", "100.0::DOUBLE"),
    "dti": _within("dti", "0.0::DOUBLE", "100.0::DOUBLE"),
}
ISSUE_DATE = "CAST(try_strptime(issue_d, '%b-%Y') AS DATE)"
HISTORY = (f"CAST(round(date_diff('day', CAST(try_strptime(earliest_cr_line, '%b-%Y') AS DATE), "
           f"DATE '{REFERENCE_DATE}') / 30.44::DOUBLE) AS INTEGER)")
WINDOW = (f"CASE WHEN issue_d < DATE '{TRAIN_END}' THEN 'train' "
          f"WHEN issue_d < DATE '{VALIDATION_END}' THEN 'validation' ELSE 'test' END")

PREP = LAB + f""",
prep AS (SELECT loan_id, "default", {ISSUE_DATE} AS issue_d, {HISTORY} AS cr_history_months,
  {", ".join(f"{PARSED.get(c, c)} AS {c}" for c in NUMERIC)}, {", ".join(TEXT)}, pd FROM lab),
fit AS (SELECT *, issue_d < DATE '{TRAIN_END}' AS is_fit, {WINDOW} AS split FROM prep),
scores AS (SELECT loan_id, "default", pd, loan_amnt AS ead, split FROM fit),
test AS (SELECT * FROM scores WHERE split = 'test')
"""

_CAPPED = ("annual_inc", "revol_bal")
CLEANED = PREP + f""",
caps AS (SELECT {", ".join(f"quantile_cont({c}, 0.99) AS cap_{c}" for c in _CAPPED)} FROM prep),
capped AS (SELECT prep.* REPLACE ({", ".join(_within(c, "0.0::DOUBLE", "cap_" + c) + f" AS {c}" for c in _CAPPED)})
           FROM prep CROSS JOIN caps),
med AS (SELECT {", ".join(f"median({c}) AS m_{c}" for c in NUMERIC)} FROM capped),
cleaned AS (SELECT loan_id, "default", issue_d, cr_history_months,
  {", ".join(f"CAST(coalesce({c}, m_{c}) AS FLOAT) AS {c}" for c in NUMERIC)},
  {", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in TEXT)},
  issue_d < DATE '{TRAIN_END}' AS is_fit FROM capped CROSS JOIN med)
"""
ALL_COLUMNS = COLUMNS
