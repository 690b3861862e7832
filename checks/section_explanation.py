"""L: attribution and explanation of a linear score with fixed weights."""

from pyspark.sql import functions as F

from checks import frames, learned
from checks.registry import check, rounded
from checks.section_models import _kept, _promise
from creditloom.functions import wording
from creditloom.operators import attribution, explanation, scoring

WEIGHTS = {"int_rate": 0.05, "fico_range_low": -0.01, "dti": 0.008, "annual_inc": -0.000004, "loan_amnt": 0.00003,
           "inq_last_6mths": 0.1, "delinq_2yrs": 0.02}


def attributed(spark, d):
    df = frames.prepared(spark, d, "issue_d", "pd", *WEIGHTS).fillna(0.0, ["dti"])
    row = df.agg(*[F.avg(c).alias(c) for c in WEIGHTS]).first()
    return attribution.linear_contributions(df, WEIGHTS, {c: row[c] for c in WEIGHTS}, keep=["loan_id", "default", "pd"])


_QUOTE = "'"


def _case(table, pick, default):
    cases = " ".join(f"WHEN '{f}' THEN '{pick(v)}'" for f, v in table.items())
    return f"CASE feature {cases} ELSE {default} END"


LABEL = _case(wording.LABELS, str, "replace(feature, '_', ' ')")
_VALUE = """CASE WHEN abs(value) >= 1000 THEN format('{:,.0f}', value) WHEN abs(value) >= 10 THEN printf('%.1f', value)
  ELSE printf('%.3g', value) END"""
SENTENCE = (f"concat({LABEL}, ' is ', CASE WHEN contribution > 0 THEN {_case(wording.HINTS, lambda h: h[0], repr(wording.DEFAULT_HINTS[0]))} "
            f"ELSE {_case(wording.HINTS, lambda h: h[1], repr(wording.DEFAULT_HINTS[1]))} END, ' (', {_VALUE}, '), which ', "
            "CASE WHEN contribution > 0 THEN 'increases' ELSE 'reduces' END, ' predicted default risk.')")

LONG = frames.PREP + f""",
x AS (SELECT loan_id, "default", pd, {', '.join('coalesce(dti, 0) AS dti' if c == 'dti' else c for c in WEIGHTS)} FROM prep),
m AS (SELECT {', '.join(f'avg({c}) AS m_{c}' for c in WEIGHTS)} FROM x),
long AS ({' UNION ALL '.join(f"SELECT loan_id, {i} AS position, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, CAST({w:.10f} AS DOUBLE) * ({c} - m_{c}) AS contribution FROM x CROSS JOIN m" for i, (c, w) in enumerate(WEIGHTS.items()))}),
sided AS (SELECT *, CASE WHEN contribution > 0 THEN 'raises' ELSE 'lowers' END AS direction,
          row_number() OVER (PARTITION BY loan_id, contribution > 0 ORDER BY abs(contribution) DESC, feature) AS place
          FROM long WHERE contribution <> 0),
told AS (SELECT loan_id, direction, CAST(place AS INTEGER) AS place, feature, value, contribution, {SENTENCE} AS explanation FROM sided WHERE place <= 5),
imp AS (SELECT feature, avg(abs(contribution)) AS a, CASE WHEN stddev_pop(value) > 0 THEN corr(value, contribution) END AS r, min(value) < max(value) AS varied FROM long GROUP BY feature),
ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY a DESC, feature) AS INTEGER) AS rank FROM imp)
"""


@check("l1_linear_attribution", LONG + "SELECT loan_id, feature, round(value, 6) AS value, round(contribution, 9) AS contribution FROM long")
def l1(spark, d):
    out = attribution.to_long(attributed(spark, d)).select("loan_id", "feature", "value", "contribution")
    return rounded(rounded(out, 6, "value"), 9, "contribution")


@check("l2_tree_attribution", frames.PREP + "SELECT loan_id, true AS margin_is_rebuilt, true AS groups_add_up FROM fit WHERE split = 'test'")
def l2(spark, d):
    """Base value and contributions give the model's probability, and walking the trees in groups changes nothing."""
    model = learned.boosted(spark, d)
    test = learned.features(spark, d).filter("split = 'test'")

    def margins(name, **how):
        out, base = attribution.tree_contributions(test, model.pipeline, model.features, **how)
        return out.select("loan_id", F.aggregate("drivers", F.lit(base), lambda s, x: s + x["contribution"]).alias(name))
    pd = scoring.predict(test, model, keep=["loan_id"])
    both = margins("whole").join(margins("grouped", most=400), "loan_id").join(pd, "loan_id")
    return both.select("loan_id", (F.abs(1 / (1 + F.exp(-2 * F.col("whole"))) - F.col("pd")) < 1e-9).alias("margin_is_rebuilt"),
                       (F.abs(F.col("whole") - F.col("grouped")) < 1e-9).alias("groups_add_up"))


@check("l3_trained_importance", _promise("importance_is_the_mean", "ranks_follow", "all_features_explained"))
def l3_trained(spark, d):
    """The ranked features of a trained model, against the mean of its contributions taken one by one."""
    done = learned.explained(spark, d)
    rows = done.importance.collect()
    plain = {r["feature"]: r["a"] for r in attribution.to_long(done.attributed).groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("a")).collect()}
    order = sorted(plain, key=lambda f: (-plain[f], f))[:30]
    return _kept(learned.features(spark, d).filter("split = 'test'"),
                 importance_is_the_mean=all(abs(r["mean_abs_contribution"] - plain[r["feature"]]) < 1e-12 for r in rows),
                 ranks_follow=[r["feature"] for r in sorted(rows, key=lambda r: r["rank"])] == order,
                 all_features_explained=all(r["business_interpretation"] and r["direction_note"] for r in rows))


@check("l8_trained_text", frames.PREP + "SELECT loan_id, \"default\", true AS drivers_are_strongest, true AS text_tells_them FROM fit WHERE split = 'test'")
def l8_trained(spark, d):
    """Every test loan's text of a trained model: its drivers are the strongest of their side, and all of them are told."""
    done = learned.explained(spark, d)
    side = lambda sign: F.slice(F.reverse(F.array_sort(F.transform(F.filter(
        "drivers", lambda x: x["contribution"] * sign > 0), lambda x: F.abs(x["contribution"])))), 1, 5)
    shown = lambda c: F.transform(c, lambda x: F.abs(x["contribution"]))
    told = F.concat(F.transform("top_positive_drivers", lambda x: x["explanation"]),
                    F.transform("top_negative_drivers", lambda x: x["explanation"]))
    both = done.loans.join(done.attributed.select("loan_id", side(1).alias("up"), side(-1).alias("down")), "loan_id")
    return both.select("loan_id", "default", ((shown("top_positive_drivers") == F.col("up")) & (shown("top_negative_drivers") == F.col("down")))
                       .alias("drivers_are_strongest"),
                       F.forall(told, lambda t: F.contains(F.col("explanation_text"), t)).alias("text_tells_them"))


def _importance(spark, d):
    return explanation.global_importance(attributed(spark, d))


@check("l3_global_importance", LONG + "SELECT feature, rank, round(a, 9) AS mean_abs_contribution FROM ranked")
def l3(spark, d):
    return rounded(_importance(spark, d).select("feature", "rank", "mean_abs_contribution"), 9, "mean_abs_contribution")


@check("l4_direction_notes", LONG + f"""SELECT feature, CASE WHEN NOT varied THEN '{explanation.UNSTABLE}'
  WHEN r IS NULL OR abs(r) < 0.05 THEN '{explanation.VARIES}' WHEN r > 0 THEN '{explanation.RAISES}' ELSE '{explanation.LOWERS}' END AS direction_note FROM ranked""")
def l4(spark, d):
    return _importance(spark, d).select("feature", "direction_note")


_MEANING = _case(wording.MEANINGS, str, f"concat({LABEL}, ' is an important model signal; review its contribution direction and distribution.')")


@check("l5_business_meaning", LONG + f"SELECT feature, {_MEANING} AS business_interpretation FROM ranked")
def l5(spark, d):
    return _importance(spark, d).select("feature", "business_interpretation")


@check("l6_local_drivers", LONG + "SELECT loan_id, direction, place, feature, round(contribution, 9) AS contribution FROM told")
def l6(spark, d):
    out = explanation.drivers_long(explanation.local_drivers(attributed(spark, d)))
    return rounded(out.select("loan_id", "direction", "place", "feature", "contribution"), 9, "contribution")


@check("l7_driver_sentences", LONG + "SELECT loan_id, direction, place, explanation FROM told")
def l7(spark, d):
    out = explanation.drivers_long(explanation.local_drivers(attributed(spark, d)))
    return out.select("loan_id", "direction", "place", "explanation")


_TEXT = f"""texts AS (SELECT loan_id,
  string_agg(concat(place, '. ', explanation), chr(10) ORDER BY place) FILTER (direction = 'raises') AS up,
  string_agg(concat(place, '. ', explanation), chr(10) ORDER BY place) FILTER (direction = 'lowers') AS down FROM told GROUP BY loan_id),
full_text AS (SELECT loan_id, concat_ws(chr(10) || chr(10), CASE WHEN up IS NOT NULL THEN '{explanation.HIGHER_HEADING}' || chr(10) || up END,
  CASE WHEN down IS NOT NULL THEN '{explanation.LOWER_HEADING}' || chr(10) || down END) AS explanation_text FROM texts)
"""


@check("l8_explanation_text", LONG + "," + _TEXT + "SELECT loan_id, explanation_text FROM full_text")
def l8(spark, d):
    out = explanation.explanation_text(explanation.local_drivers(attributed(spark, d)))
    return out.select("loan_id", "explanation_text")


@check("l9_example_loan", LONG + "," + _TEXT + """SELECT loan_id, "default", pd, (SELECT round(avg(pd), 9) FROM x) AS base_value,
  CASE WHEN pd < 0.10 THEN 'Low' WHEN pd < 0.20 THEN 'Medium' WHEN pd < 0.35 THEN 'High' ELSE 'Very High' END AS risk_label, explanation_text
FROM x JOIN full_text USING (loan_id) ORDER BY pd DESC, loan_id LIMIT 1""")
def l9(spark, d):
    out = explanation.explanation_text(explanation.local_drivers(attributed(spark, d)))
    return rounded(explanation.example_loan(out).select(
        "loan_id", "default", "pd", "base_value", "risk_label", "explanation_text"), 9, "base_value")


@check("l9_true_positive_example", LONG + """SELECT loan_id, "default", pd FROM x WHERE "default" = 1 AND pd >= 0.4 ORDER BY loan_id LIMIT 1""")
def l9_tp(spark, d):
    out = explanation.local_drivers(attributed(spark, d))
    return explanation.example_loan(out, threshold=0.4).select("loan_id", "default", "pd")


@check("l10_strongest_drivers", LONG + """SELECT loan_id, CAST(place AS INTEGER) AS place, feature, round(contribution, 9) AS contribution FROM
  (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY abs(contribution) DESC, feature) AS place FROM long) WHERE place <= 10""")
def l10(spark, d):
    out = explanation.strongest_drivers(attributed(spark, d))
    return rounded(out.select("loan_id", "place", "feature", "contribution"), 9, "contribution")


@check("l10_dependence_pairs", LONG + "SELECT loan_id, feature, round(value, 6) AS value, round(contribution, 9) AS contribution "
       "FROM long JOIN ranked USING (feature) WHERE rank <= 4")
def l10_pairs(spark, d):
    df = attributed(spark, d)
    out = explanation.dependence_pairs(df, explanation.global_importance(df))
    return rounded(rounded(out, 6, "value"), 9, "contribution")
