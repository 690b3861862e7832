"""B: cleaning."""

from pyspark.sql import functions as F

from checks import frames
from checks.registry import check, rounded
from creditloom.functions import numeric, parse
from creditloom.operators import cleaning

REF = frames.REFERENCE_DATE


@check("b1_keep_labelled", frames.LAB + "SELECT loan_id, loan_status FROM lab")
def b1(spark, d):
    return cleaning.keep_labelled(frames.raw(spark, d, "loan_status"))


@check("b2_status_target", frames.LAB + 'SELECT loan_id, loan_status, "default" FROM lab')
def b2(spark, d):
    return cleaning.add_target(cleaning.keep_labelled(frames.raw(spark, d, "loan_status")))


_KEPT = ["loan_id", "issue_d", *[c for c in frames.ALL_COLUMNS if c in (*frames.NUMERIC, *frames.TEXT)],
         "earliest_cr_line"]


@check("b3_drop_columns", f"WITH {frames.RAW} SELECT {', '.join(_KEPT)} FROM raw")
def b3(spark, d):
    return cleaning.drop_unusable(frames.raw(spark, d))


@check("b4_parse_term", f"WITH {frames.RAW} SELECT loan_id, {frames.PARSED['term']} AS term FROM raw")
def b4(spark, d):
    return frames.raw(spark, d, "term").withColumn("term", parse.parse_term(F.col("term")))


@check("b5_parse_emp_length",
       f"WITH {frames.RAW} SELECT loan_id, {frames.PARSED['emp_length']} AS emp_length FROM raw")
def b5(spark, d):
    return frames.raw(spark, d, "emp_length").withColumn("emp_length", parse.parse_emp_length(F.col("emp_length")))


@check("b6_parse_percent", f"WITH {frames.RAW} SELECT loan_id, "
       "try_cast(replace(int_rate, '%', '') AS DOUBLE) AS int_rate, "
       "try_cast(replace(revol_util, '%', '') AS DOUBLE) AS revol_util FROM raw")
def b6(spark, d):
    return frames.raw(spark, d, "int_rate", "revol_util").withColumns({
        c: parse.parse_percent(F.col(c)) for c in ("int_rate", "revol_util")})


@check("b7_parse_issue_month", f"WITH {frames.RAW} SELECT loan_id, {frames.ISSUE_DATE} AS issue_d FROM raw")
def b7(spark, d):
    return frames.raw(spark, d, "issue_d").withColumn("issue_d", parse.parse_month(F.col("issue_d")))


@check("b8_credit_history_months",
       f"WITH {frames.RAW} SELECT loan_id, {frames.HISTORY} AS cr_history_months FROM raw")
def b8(spark, d):
    return cleaning.parse_columns(frames.raw(spark, d, "earliest_cr_line"), REF)


@check("b9_clip_fixed", frames.PREP + "SELECT loan_id, dti, revol_util FROM prep")
def b9(spark, d):
    return frames.prepared(spark, d, "dti", "revol_util").select("loan_id", "dti", "revol_util")


@check("b10_clip_p99", frames.CLEANED + "SELECT loan_id, round(annual_inc, 6) AS annual_inc, "
       "round(revol_bal, 6) AS revol_bal FROM capped")
def b10(spark, d):
    df = frames.prepared(spark, d, "annual_inc", "revol_bal")
    out = cleaning.clip_learned(df, cleaning.fit_cleaning(df))
    return rounded(out.select("loan_id", "annual_inc", "revol_bal"), 6, "annual_inc", "revol_bal")


_IMPUTED = ("term", "emp_length", "dti", "revol_bal", "mort_acc", "open_acc")


@check("b11_impute_median", frames.CLEANED + "SELECT loan_id, " + ", ".join(
    f"round(coalesce({c}, m_{c}), 6) AS {c}" for c in _IMPUTED) + " FROM capped CROSS JOIN med")
def b11(spark, d):
    df = frames.prepared(spark, d, *_IMPUTED)
    fit = cleaning.fit_cleaning(df)
    out = cleaning.impute_numeric(cleaning.clip_learned(df, fit), fit)
    return rounded(out.select("loan_id", *_IMPUTED), 6, *_IMPUTED)


@check("b12_impute_unknown", f"WITH {frames.RAW} SELECT loan_id, coalesce(emp_title, 'Unknown') AS emp_title, "
       "grade FROM raw")
def b12(spark, d):
    return cleaning.impute_text(frames.raw(spark, d, "emp_title", "grade"))


_DOUBLES = [c for c in frames.NUMERIC if c not in ("term", "int_rate", "emp_length", "revol_util")]


@check("b13_downcast", f"WITH {frames.RAW} SELECT loan_id, " + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in _DOUBLES) + " FROM raw")
def b13(spark, d):
    return cleaning.downcast(frames.raw(spark, d, *_DOUBLES)).select("loan_id", *_DOUBLES)


_AUDITED = (*frames.NUMERIC, *frames.TEXT)
_AUDIT_TYPES = {c: "string" for c in frames.TEXT}


@check("b14_null_audit", frames.PREP + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{_AUDIT_TYPES.get(c, 'double')}' AS data_type, "
    f"count(*) - count({c}) AS null_count FROM prep" for c in _AUDITED))
def b14(spark, d):
    return cleaning.null_audit(frames.prepared(spark, d, *_AUDITED).select(*_AUDITED))


_RAW_COLUMNS = len(frames.ALL_COLUMNS) - 1
_CLEAN_COLUMNS = len(frames.NUMERIC) + len(frames.TEXT) + 3


@check("b15_cleaning_summary", frames.LAB + f"""
SELECT 'raw' AS stage, count(*) AS "rows", {_RAW_COLUMNS}::BIGINT AS "columns", NULL::DOUBLE AS default_rate FROM raw
UNION ALL SELECT 'labelled', count(*), {_RAW_COLUMNS + 1}, round(avg("default"), 9) FROM lab
UNION ALL SELECT 'cleaned', count(*), {_CLEAN_COLUMNS}, round(avg("default"), 9) FROM lab""")
def b15(spark, d):
    return rounded(cleaning.cleaning_summary(frames.raw(spark, d), REF), 9, "default_rate")


_CLEAN_OUT = ("loan_id, \"default\", issue_d, cr_history_months, " + ", ".join(frames.NUMERIC)
              + ", " + ", ".join(frames.TEXT))


_STORED = frames.PREP + f""",
caps AS (SELECT {", ".join(f"quantile_cont({c}, 0.99) AS cap_{c}" for c in frames._CAPPED)} FROM fit WHERE is_fit),
capped AS (SELECT fit.* REPLACE ({", ".join(frames._within(c, "0.0::DOUBLE", "cap_" + c) + f" AS {c}" for c in frames._CAPPED)})
           FROM fit CROSS JOIN caps),
med AS (SELECT {", ".join(f"median({c}) AS m_{c}" for c in frames.NUMERIC)},
        {", ".join(f"count({c}) < count(*) AS gaps_{c}" for c in frames.NUMERIC)} FROM capped WHERE is_fit),
cleaned AS (SELECT loan_id, "default", issue_d, cr_history_months,
  {", ".join(f"CAST(coalesce({c}, CASE WHEN gaps_{c} THEN m_{c} END) AS FLOAT) AS {c}" for c in frames.NUMERIC)},
  {", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in frames.TEXT)} FROM capped CROSS JOIN med WHERE NOT is_fit)
"""


@check("b16_apply_stored", _STORED + f"SELECT {_CLEAN_OUT} FROM cleaned")
def b16_apply_stored(spark, d):
    """A fit learned on the training window, stored, and applied to raw loans that came later."""
    from creditloom.session import fresh_path
    path, early = fresh_path(spark, "cleaning-fit"), F.col("issue_d") < F.lit(frames.TRAIN_END).cast("date")
    raw = frames.raw(spark, d)
    cleaning.save_cleaning(cleaning.fit_cleaning(cleaning.prepare(raw, frames.REFERENCE_DATE), early), spark, path)
    later = cleaning.clean(raw, frames.REFERENCE_DATE, cleaning.load_cleaning(spark, path))
    return later.filter(~early)


@check("b16_clean", frames.CLEANED + f"SELECT {_CLEAN_OUT} FROM cleaned")
def b16(spark, d):
    return frames.cleaned(spark, d)
