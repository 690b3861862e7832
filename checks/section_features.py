"""E: encodings and features."""

from pyspark.sql import functions as F

from checks import frames
from checks.registry import check, rounded
from creditloom.functions import encode, numeric
from creditloom.operators import encoding, features, splitting

P = frames.PREP
ORD = {
    "grade_enc": "CAST(CASE WHEN length(grade) = 1 AND grade BETWEEN 'A' AND 'G' THEN ascii(grade) - 64 END AS DOUBLE)",
    "sub_grade_enc": "CAST((ascii(sub_grade) - 65) * 5 + CAST(substr(sub_grade, 2, 1) AS INT) AS DOUBLE)",
    "verification_status_enc": "CASE verification_status WHEN 'Not Verified' THEN 0.0::DOUBLE "
                               "WHEN 'Source Verified' THEN 1 WHEN 'Verified' THEN 2 END",
    "home_ownership_enc": "CASE home_ownership WHEN 'MORTGAGE' THEN 3.0::DOUBLE WHEN 'OWN' THEN 2 "
                          "WHEN 'RENT' THEN 1 ELSE 0 END",
    "term_60": "CASE WHEN term = 60 THEN 1.0::DOUBLE ELSE 0 END",
    "initial_list_status_enc": "CASE WHEN initial_list_status = 'w' THEN 1.0::DOUBLE ELSE 0 END",
    "application_type_joint": "CASE WHEN application_type = 'Joint App' THEN 1.0::DOUBLE ELSE 0 END",
    "disbursement_direct": "CASE WHEN disbursement_method = 'DirectPay' THEN 1.0::DOUBLE ELSE 0 END",
}


def _div(a: str, b: str) -> str:
    return f"coalesce(CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) END, 0.0::DOUBLE)"


def _d(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


RATIO = {
    "loan_to_income": _div(_d("loan_amnt"), _d("annual_inc")),
    "installment_to_income": _div(_d("installment"), f"{_d('annual_inc')} / 12"),
    "credit_util_total": _div(_d("revol_bal"), f"{_d('tot_hi_cred_lim')} + 1"),
    "bc_util_ratio": _div(f"CASE WHEN total_bc_limit IS NOT NULL AND bc_open_to_buy IS NOT NULL "
                          f"THEN greatest({_d('total_bc_limit')} - {_d('bc_open_to_buy')}, 0.0::DOUBLE) END",
                          f"{_d('total_bc_limit')} + 1"),
    "int_rate_x_term": f"{_d('int_rate')} * {_d('term')}",
    "fico_dti_score": _div(_d("fico_range_low"), f"{_d('dti')} + 1"),
    "derog_ratio": _div(f"coalesce({_d('pub_rec')}, 0) + coalesce({_d('collections_12_mths_ex_med')}, 0)",
                        f"{_d('total_acc')} + 1"),
    "inq_per_acc": _div(_d("inq_last_6mths"), f"{_d('open_acc')} + 1"),
    "revolving_debt_share": _div(_d("revol_bal"), f"{_d('total_bal_ex_mort')} + 1"),
}
LOGS = {f"{c}_log": f"CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest({_d(c)}, 0.0::DOUBLE)) END"
        for c in features.LOG_COLUMNS}


def _sql(frame: str, exprs: dict, names) -> str:
    return f"SELECT loan_id, {', '.join(f'round({exprs[n]}, 6) AS {n}' for n in names)} FROM {frame}"


def _ordinals(spark, d, columns, names):
    df = frames.prepared(spark, d, *columns)
    made = features.ordinal_features(df.columns)
    return df.select("loan_id", *[F.round(made[n], 6).alias(n) for n in names])


def _ordinal_check(key, columns, names):
    check(key, P + _sql("prep", ORD, names))(lambda s, d: _ordinals(s, d, columns, names))


_ordinal_check("e1_grade", ["grade"], ["grade_enc"])
_ordinal_check("e2_sub_grade", ["sub_grade"], ["sub_grade_enc"])
_ordinal_check("e3_verification", ["verification_status"], ["verification_status_enc"])
_ordinal_check("e4_home_ownership", ["home_ownership"], ["home_ownership_enc"])
_ordinal_check("e5_flags", ["term", "initial_list_status", "application_type", "disbursement_method"],
               ["term_60", "initial_list_status_enc", "application_type_joint", "disbursement_direct"])


def _fit_rows(spark, d, *columns):
    return splitting.add_fit_flag(frames.prepared(spark, d, "issue_d", *columns), frames.CUTOFFS)


@check("e6_global_rate", P + 'SELECT round(avg("default"), 9) AS rate FROM fit WHERE is_fit')
def e6(spark, d):
    df = _fit_rows(spark, d)
    return df.filter("is_fit").agg(F.round(F.avg("default"), 9).alias("rate"))


def _rates(source: str, k: int) -> str:
    return f"""g AS (SELECT avg("default") AS g FROM fit WHERE is_fit),
keys AS (SELECT {source} AS key, count(*) FILTER (is_fit) AS fit_n,
         coalesce(sum("default") FILTER (is_fit), 0) AS fit_y
         FROM fit WHERE {source} IS NOT NULL GROUP BY 1),
rates AS (SELECT key, fit_n, (fit_y + {k} * g) / (fit_n + {k}) AS value FROM keys CROSS JOIN g)"""


@check("e7_smoothed_encoding", P + f", {_rates('emp_title', 100)} SELECT key, fit_n, round(value, 9) AS value FROM rates")
def e7(spark, d):
    df = _fit_rows(spark, d, "emp_title")
    return rounded(encoding.smoothed_rates(df, "emp_title", 100.0, encoding.fit_rate(df)), 9, "value")


def _apply_sql(source: str, k: int, name: str) -> str:
    return P + (f", {_rates(source, k)} SELECT loan_id, round(coalesce(value, g), 9) AS {name} "
                f"FROM fit CROSS JOIN g LEFT JOIN rates ON {source} = key")


def _applied(spark, d, source, name):
    df = _fit_rows(spark, d, source)
    out = encoding.fit_encodings(df).apply(df, source, name)
    return rounded(out.select("loan_id", name), 9, name)


@check("e8_purpose_rate", _apply_sql("purpose", 300, "purpose_rate_enc"))
def e8(spark, d):
    return _applied(spark, d, "purpose", "purpose_rate_enc")


@check("e9_state_rate", _apply_sql("addr_state", 500, "state_default_rate"))
def e9(spark, d):
    return _applied(spark, d, "addr_state", "state_default_rate")


_MAP_SQL = P + f""", {_rates('purpose', 300)}
SELECT 'global_default_rate' AS encoding, NULL::VARCHAR AS key, 0::BIGINT AS fit_n, round(g, 9) AS value,
       'time_based_issue_d' AS strategy FROM g
UNION ALL SELECT 'purpose_rate_enc', NULL, 0, round(g, 9), 'time_based_issue_d' FROM g
UNION ALL SELECT 'purpose_rate_enc', key, fit_n, round(value, 9), 'time_based_issue_d' FROM rates"""


@check("e10_encoding_map", _MAP_SQL)
def e10(spark, d):
    return rounded(encoding.fit_encodings(_fit_rows(spark, d, "purpose")).table, 9, "value")


_FREQ = """f AS (SELECT emp_title AS key, count(*) AS n FROM fit WHERE is_fit AND emp_title IS NOT NULL GROUP BY 1),
t AS (SELECT sum(n) AS total, min(n) AS least FROM f)"""


@check("e11_title_frequency", P + f", {_FREQ} SELECT loan_id, "
       "round(ln(1 + CAST(CAST(coalesce(n, least) / total::DOUBLE AS FLOAT) AS DOUBLE)), 9) AS emp_title_log_freq "
       "FROM fit CROSS JOIN t LEFT JOIN f ON emp_title = key")
def e11(spark, d):
    return _applied(spark, d, "emp_title", "emp_title_log_freq")


@check("e12_log_features", P + _sql("prep", LOGS, LOGS))
def e12(spark, d):
    df = frames.prepared(spark, d, *features.LOG_COLUMNS)
    made = features.log_features(df.columns)
    return df.select("loan_id", *[F.round(v, 6).alias(n) for n, v in made.items()])


@check("e13_safe_division", P + "SELECT loan_id, round(coalesce(CASE WHEN inq_last_6mths <> 0 THEN "
       "dti / inq_last_6mths END, -1), 6) AS quotient FROM prep")
def e13(spark, d):
    df = frames.prepared(spark, d, "dti", "inq_last_6mths")
    return df.select("loan_id", F.round(numeric.safe_div(
        F.col("dti"), F.col("inq_last_6mths"), -1.0), 6).alias("quotient"))


def _ratio_check(key, columns, names):
    def run(spark, d):
        df = frames.prepared(spark, d, *columns)
        made = features.ratio_features(df.columns)
        return df.select("loan_id", *[F.round(made[n], 6).alias(n) for n in names])
    check(key, P + _sql("prep", RATIO, names))(run)


_ratio_check("e14_loan_to_income", ["loan_amnt", "annual_inc"], ["loan_to_income"])
_ratio_check("e15_installment_to_income", ["installment", "annual_inc"], ["installment_to_income"])
_ratio_check("e16_utilisation", ["revol_bal", "tot_hi_cred_lim", "total_bc_limit", "bc_open_to_buy"],
             ["credit_util_total", "bc_util_ratio"])
_ratio_check("e17_rate_times_term", ["int_rate", "term"], ["int_rate_x_term"])
_ratio_check("e18_score_and_inquiries",
             ["fico_range_low", "dti", "inq_last_6mths", "open_acc", "revol_bal", "total_bal_ex_mort"],
             ["fico_dti_score", "inq_per_acc", "revolving_debt_share"])
_ratio_check("e19_derogatory", ["pub_rec", "collections_12_mths_ex_med", "total_acc"], ["derog_ratio"])


@check("e20_drop_redundant", P + "SELECT loan_id, \"default\", loan_amnt, dti FROM prep")
def e20(spark, d):
    return features.drop_redundant(frames.prepared(
        spark, d, "loan_amnt", "funded_amnt", "fico_range_high", "dti", "grade", "term", "purpose"))


FLOATS = [c for c in frames.NUMERIC if c not in ("funded_amnt", "fico_range_high", "term")]
FEATURES_SQL = frames.CLEANED + f""",
g AS (SELECT avg("default") AS g FROM cleaned WHERE is_fit),
pr AS (SELECT purpose AS pk, (coalesce(sum("default") FILTER (is_fit), 0) + 300 * any_value(g)) / (count(*) FILTER (is_fit) + 300) AS pv
       FROM cleaned CROSS JOIN g GROUP BY 1),
sr AS (SELECT addr_state AS sk, (coalesce(sum("default") FILTER (is_fit), 0) + 500 * any_value(g)) / (count(*) FILTER (is_fit) + 500) AS sv
       FROM cleaned CROSS JOIN g GROUP BY 1),
tf AS (SELECT emp_title AS tk, count(*) AS n FROM cleaned WHERE is_fit GROUP BY 1),
tt AS (SELECT sum(n) AS total, min(n) AS least FROM tf),
features AS (SELECT loan_id, "default", issue_d, is_fit, CAST(cr_history_months AS FLOAT) AS cr_history_months, {", ".join(FLOATS)},
  {", ".join(f"CAST({e} AS FLOAT) AS {n}" for n, e in {**ORD, **LOGS, **RATIO}.items())},
  CAST(pv AS FLOAT) AS purpose_rate_enc, CAST(sv AS FLOAT) AS state_default_rate,
  CAST(ln(1 + CAST(CAST(coalesce(n, least) / total::DOUBLE AS FLOAT) AS DOUBLE)) AS FLOAT) AS emp_title_log_freq
  FROM cleaned CROSS JOIN tt LEFT JOIN pr ON purpose = pk LEFT JOIN sr ON addr_state = sk LEFT JOIN tf ON emp_title = tk)
"""
MADE = [*ORD, *LOGS, *RATIO, "purpose_rate_enc", "state_default_rate", "emp_title_log_freq"]


def features_of(spark, d):
    df = splitting.add_fit_flag(frames.cleaned(spark, d), frames.CUTOFFS)
    return features.engineer_features(df, check=False)[0]


@check("e21_validate_features", P + " SELECT count(*) AS clean_rows FROM fit")
def e21(spark, d):
    out = features_of(spark, d)
    features.validate_features(out)
    return out.agg(F.count(F.lit(1)).alias("clean_rows"))


@check("e22_label_index", P + """,
c AS (SELECT DISTINCT emp_title AS label FROM fit WHERE is_fit AND emp_title IS NOT NULL),
i AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS place FROM c)
SELECT loan_id, CAST(coalesce(place, 0) AS FLOAT) AS emp_title FROM fit LEFT JOIN i ON emp_title = label""")
def e22(spark, d):
    df = _fit_rows(spark, d, "emp_title")
    indexes = encoding.label_indexes(df.filter("is_fit"), ["emp_title"])
    return encoding.apply_label_indexes(df, indexes, ["emp_title"]).select("loan_id", "emp_title")


@check("e23_class_weights", P + """,
c AS (SELECT count(*) FILTER ("default" = 0) AS n0, count(*) FILTER ("default" = 1) AS n1 FROM fit WHERE is_fit)
SELECT loan_id, round(CASE WHEN "default" = 1 THEN (n0 + n1) / (2.0::DOUBLE * n1) ELSE (n0 + n1) / (2.0::DOUBLE * n0) END, 9) AS class_weight,
  round(n0 / n1::DOUBLE, 9) AS imbalance FROM fit CROSS JOIN c WHERE is_fit""")
def e23(spark, d):
    df = _fit_rows(spark, d).filter("is_fit")
    weights = encoding.class_weights(df)
    out = encoding.add_class_weight(df, weights).withColumn("imbalance", F.lit(weights.imbalance))
    return rounded(out.select("loan_id", "class_weight", "imbalance"), 9, "class_weight", "imbalance")


_E24 = ["cr_history_months", *FLOATS, *MADE]


@check("e24_engineer_features", FEATURES_SQL + 'SELECT loan_id, "default", issue_d, is_fit, '
       + ", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in _E24) + " FROM features")
def e24(spark, d):
    return rounded(features_of(spark, d), 4, *_E24)


def _corr_sql(frame: str, names, label='"default"') -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CASE WHEN stddev_pop({_d(c)}) > 0 THEN corr({_d(c)}, {label}) END AS correlation "
        f"FROM {frame}" for c in names)


@check("e25_engineered_report", FEATURES_SQL + f", r AS ({_corr_sql('features', MADE)}) "
       "SELECT feature, round(correlation, 9) AS correlation FROM r "
       "ORDER BY abs(correlation) DESC NULLS LAST, feature LIMIT 15")
def e25(spark, d):
    return rounded(features.engineered_report(features_of(spark, d), MADE), 9, "correlation")
