"""F: scoring of applications."""

from pyspark.sql import functions as F

from checks import frames, learned
from checks.registry import check, rounded
from checks.section_features import LOGS, ORD, RATIO
from creditloom.operators import contract, features, models, scoring
from creditloom.session import fresh_path
from creditloom.streaming.scoring import application_stream, score_stream

_PLAIN = [c for c in (*frames.NUMERIC, *frames.TEXT)
          if c in {f.name for f in contract.CONTRACT} - {"loan_amnt", "term", "grade", "sub_grade", "purpose"}]


def applications(spark, d):
    """The loan view as applications, with some that break the contract."""
    k = F.col("loan_id")
    df = frames.prepared(spark, d)
    return df.select(
        "loan_id", F.when(k % 43 != 0, F.col("loan_amnt")).alias("loan_amnt"),
        F.when(k % 29 == 0, F.lit(48.0)).otherwise(F.col("term")).alias("term"),
        F.when(k % 31 == 0, F.lit("Z")).otherwise(F.col("grade")).alias("grade"),
        F.when(k % 37 == 0, F.lit("B9")).otherwise(F.col("sub_grade")).alias("sub_grade"),
        F.when(k % 47 == 0, F.lit("NOVEL")).otherwise(F.col("purpose")).alias("purpose"),
        F.col("cr_history_months").cast("double").alias("cr_history_months"), *_PLAIN)


APPS = frames.PREP + f""", apps AS (SELECT loan_id, CASE WHEN loan_id % 43 <> 0 THEN loan_amnt END AS loan_amnt,
  CASE WHEN loan_id % 29 = 0 THEN 48 ELSE term END AS term, CASE WHEN loan_id % 31 = 0 THEN 'Z' ELSE grade END AS grade,
  CASE WHEN loan_id % 37 = 0 THEN 'B9' ELSE sub_grade END AS sub_grade,
  CASE WHEN loan_id % 47 = 0 THEN 'NOVEL' ELSE purpose END AS purpose, cr_history_months, {', '.join(_PLAIN)} FROM prep)
"""
_RULES = ("CASE WHEN loan_amnt IS NULL THEN 'loan_amnt: required' END",
          "CASE WHEN term IS NULL THEN 'term: required' END",
          "CASE WHEN term NOT IN (36, 60) THEN 'term: must be one of 36, 60' END",
          "CASE WHEN grade NOT IN ('A','B','C','D','E','F','G') THEN 'grade: must be one of A, B, C, D, E, F, G' END",
          "CASE WHEN NOT regexp_matches(sub_grade, '^[A-G][1-5]$') THEN 'sub_grade: must match ^[A-G][1-5]$' END",
          "CASE WHEN dti IS NULL THEN 'dti: required' END")


@check("f1_validate", APPS + f"SELECT loan_id, array_to_string([x FOR x IN [{', '.join(_RULES)}] IF x IS NOT NULL], '; ') AS reasons FROM apps")
def f1(spark, d):
    valid, rejects = contract.split_valid(applications(spark, d))
    return (valid.select("loan_id", F.lit("").alias("reasons"))
            .unionByName(rejects.select("loan_id", F.array_join("violations", "; ").alias("reasons"))))


_HAVE = {"loan_amnt", "term", "grade", "sub_grade", "purpose", "cr_history_months", *_PLAIN}


def _filled(field):
    default = "NULL" if field.required else f"'{field.default}'" if field.text else f"{field.default}::DOUBLE"
    value = f"CAST({field.name} AS {'VARCHAR' if field.text else 'DOUBLE'})" if field.name in _HAVE else "NULL"
    return f"coalesce({value}, {default}) AS {field.name}"


_FIELDS = [f for f in contract.CONTRACT if f.name in _HAVE or not f.required]


@check("f2_fill_defaults", APPS + f"SELECT loan_id, {', '.join(map(_filled, _FIELDS))} FROM apps")
def f2(spark, d):
    """Every field of the contract that the applications hold or a default fills."""
    return contract.fill_defaults(applications(spark, d)).select("loan_id", *[f.name for f in _FIELDS])


def _div(a, b):
    return f"coalesce(CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) END, 0.0::DOUBLE)"


_ZERO = {*features.LOG_COLUMNS, *features.RATIO_INPUTS} - {"annual_inc"}
_FLAGS = {"initial_list_status": "w", "application_type": "Individual", "disbursement_method": "Cash"}
_SERVED = {
    **{n: e for n, e in {**ORD, **LOGS, **RATIO}.items() if "annual_inc" not in e},
    "grade_enc": "CAST(CASE WHEN grade BETWEEN 'A' AND 'G' THEN ascii(grade) - 64 ELSE 4 END AS DOUBLE)",
    "sub_grade_enc": "CAST(CASE WHEN regexp_matches(sub_grade, '^[A-G][1-5]$') THEN (ascii(sub_grade) - 65) * 5 + "
                     "CAST(substr(sub_grade, 2, 1) AS INT) ELSE 18 END AS DOUBLE)",
    "loan_to_income": _div("loan_amnt", "coalesce(annual_inc, 1)"),
    "installment_to_income": _div("installment", "coalesce(annual_inc, 12) / 12"),
    "annual_inc_log": "coalesce(ln(1 + greatest(annual_inc, 0.0::DOUBLE)), 0)",
}
SERVED_SQL = f""", served AS (SELECT apps.* REPLACE ({", ".join(f"coalesce({c}, 0.0::DOUBLE) AS {c}" for c in sorted(_ZERO))},
  coalesce(term, 36) AS term, {", ".join(f"coalesce({c}, '{v}') AS {c}" for c, v in _FLAGS.items())}) FROM apps)"""


@check("f3_serving_features", frames.CLEANED + "," + APPS[len(frames.PREP):].lstrip(" ,") + f""",
g AS (SELECT avg("default") AS g FROM cleaned WHERE is_fit),
pr AS (SELECT purpose AS pk, (coalesce(sum("default") FILTER (is_fit), 0) + 300 * any_value(g)) / (count(*) FILTER (is_fit) + 300) AS pv
       FROM cleaned CROSS JOIN g GROUP BY 1),
sr AS (SELECT addr_state AS sk, (coalesce(sum("default") FILTER (is_fit), 0) + 500 * any_value(g)) / (count(*) FILTER (is_fit) + 500) AS sv
       FROM cleaned CROSS JOIN g GROUP BY 1){SERVED_SQL}
SELECT loan_id, {', '.join(f'round(CAST(CAST({e} AS FLOAT) AS DOUBLE), 4) AS {n}' for n, e in _SERVED.items())},
  round(CAST(CAST(coalesce(pv, g) AS FLOAT) AS DOUBLE), 4) AS purpose_rate_enc,
  round(CAST(CAST(coalesce(sv, g) AS FLOAT) AS DOUBLE), 4) AS state_default_rate
FROM served CROSS JOIN g LEFT JOIN pr ON purpose = pk LEFT JOIN sr ON addr_state = sk""")
def f3(spark, d):
    names = [*_SERVED, "purpose_rate_enc", "state_default_rate"]
    out = features.build_features(applications(spark, d), learned.encodings(spark, d), serving=True)
    return rounded(out.select("loan_id", *names), 4, *names)


_REASONS = f"array_to_string([x FOR x IN [{', '.join(_RULES)}] IF x IS NOT NULL], '; ')"


def _holds(threshold, probability="default_probability", tier="risk_tier"):
    """A decision follows from its probability and the threshold; a rejected application has none."""
    p = F.col(probability)
    band = F.when(p < 0.10, "Low").when(p < 0.20, "Medium").when(p < 0.35, "High").otherwise("Very High")
    decided = p.between(0, 1) & (F.col("prediction") == (p >= F.lit(threshold)).cast("int")) & (F.col(tier) == band)
    none = p.isNull() & F.col("prediction").isNull() & F.col(tier).isNull()
    return F.coalesce(F.when(F.col("violations") == "", decided).otherwise(none), F.lit(False)).alias("decision_holds")


def _as_text(df):
    return df.withColumn("violations", F.array_join("violations", "; "))


@check("f4_decide", APPS + f"SELECT loan_id, {_REASONS} AS violations, 'lr-1' AS model_version, true AS decision_holds, true AS threshold_is_the_models FROM apps")
def f4(spark, d):
    model = learned.logistic(spark, d)
    exact = scoring.judge_and_score(applications(spark, d), model, learned.encodings(spark, d))
    out = _as_text(scoring.score_applications(applications(spark, d), model, learned.encodings(spark, d)))
    # responses are rounded to six digits, so a decision is held against the exact probability
    both = out.join(exact.select("loan_id", F.col("default_probability").alias("exact"), "risk_tier"), "loan_id")
    both = both.withColumns({"default_probability": F.when(
        F.col("default_probability") == F.round("exact", 6), F.col("exact")), "same": F.col("risk_label").eqNullSafe(F.col("risk_tier"))})
    return both.select("loan_id", "violations", "model_version", (_holds(model.threshold) & F.col("same")).alias("decision_holds"),
                       (F.col("threshold") == model.threshold).alias("threshold_is_the_models"))


@check("f5_score_table", APPS + "SELECT loan_id, loan_amnt, term, grade, sub_grade, purpose, true AS decision_holds FROM apps")
def f5(spark, d):
    model = learned.logistic(spark, d)
    out = scoring.score_table(applications(spark, d), model, learned.encodings(spark, d)).withColumn("violations", F.lit(""))
    return out.select("loan_id", "loan_amnt", "term", "grade", "sub_grade", "purpose", _holds(model.threshold))


@check("f6_batch_kpis", frames.PREP + "SELECT count(*) FILTER (pd >= 0.25) AS flagged, round(avg(pd), 9) AS mean_probability, "
       "count(*) FILTER (pd >= 0.20) AS high_risk FROM scores")
def f6(spark, d):
    df = frames.scores(spark, d).withColumnRenamed("pd", "default_probability")
    df = df.withColumns(scoring.decisions(F.col("default_probability"), 0.25))
    return rounded(scoring.batch_kpis(df), 9, "mean_probability")


@check("f7_model_info", frames.PREP + "SELECT 'logistic_regression' AS model_type, 'lr-1' AS model_version, count(*) AS \"rows\", "
       "true AS threshold_as_stored, true AS feature_count_holds, true AS figures_hold FROM fit")
def f7(spark, d):
    """What the stored model says of itself, held against its scores."""
    live, path = learned.logistic(spark, d), fresh_path(spark, "served")
    scoring.save_scoring_model(live, spark, path)
    model, features = scoring.load_scoring_model(spark, path), learned.features(spark, d)
    info = scoring.model_info(features, model)
    row, own = info.first(), models.evaluate(scoring.predict(features.filter("split = 'test'"), model, keep=["default"]), model.threshold)
    same = all(abs(row[n] - own[m]) < 1e-9 for n, m in (("test_roc_auc", "roc_auc"), ("test_avg_precision", "pr_auc"),
                                                       ("test_f1", "f1"), ("test_brier", "brier")))
    return info.select("model_type", "model_version", "rows", (F.col("threshold") == live.threshold).alias("threshold_as_stored"),
                       (F.col("n_features") == len(learned.columns(spark, d))).alias("feature_count_holds"), F.lit(same).alias("figures_hold"))


def _arriving(spark, d, parts):
    folder, schema = fresh_path(spark, "arriving"), contract.application_schema()
    contract.fill_defaults(applications(spark, d)).select(*schema.names).repartition(parts, "loan_id").write.parquet(folder)
    return folder


#: Reasons after defaults are filled in: what a default replaces is no longer missing.
@check("f8_score_stream", APPS + f"SELECT loan_id, {_REASONS} AS violations, true AS decision_holds FROM apps")
def f8(spark, d):
    out, state = (fresh_path(spark, n) for n in ("scored", "stream-state"))
    model = learned.logistic(spark, d)
    query = score_stream(application_stream(spark, _arriving(spark, d, 6), 2), model, learned.encodings(spark, d), out, state)
    query.awaitTermination()
    return _as_text(spark.read.parquet(out)).select("loan_id", "violations", _holds(model.threshold))


_KPI_TIME = "TIMESTAMP '2020-01-01' + to_seconds(loan_id % 40000)"


@check("f8_kpi_stream", frames.PREP + f"""SELECT date_trunc('hour', {_KPI_TIME}) AS window_start, count(*) AS scored,
  count(*) FILTER (pd >= 0.25) AS flagged, round(avg(pd), 9) AS mean_probability, count(*) FILTER (pd >= 0.20) AS high_risk
FROM scores GROUP BY 1""")
def f8_kpis(spark, d):
    """KPIs per hour of a stream that is stopped in the middle and started again, against the whole table."""
    from creditloom.streaming.kpis import kpi_stream, kpi_table, scored_stream
    folder, out, state = (fresh_path(spark, n) for n in ("scored", "kpis", "kpi-state"))
    df = frames.scores(spark, d).withColumnRenamed("pd", "default_probability")
    df = df.withColumns(scoring.decisions(F.col("default_probability"), 0.25)).withColumn(
        "scored_at", F.timestamp_seconds(F.unix_timestamp(F.lit("2020-01-01 00:00:00")) + F.col("loan_id") % 40000))
    early = F.col("loan_id") % 40000 < 15000
    for part in (df.filter(early), df.filter(~early)):
        part.repartitionByRange(4, "scored_at").write.mode("append").parquet(folder)
        kpi_stream(scored_stream(spark, folder, df.schema, 1), "1 hour", "12 hours", out, state).awaitTermination()
    return rounded(kpi_table(spark, out), 9, "mean_probability").drop("window_end")
