import math

import pytest
from pyspark.sql import functions as F

from creditloom import policy
from creditloom.operators import encoding, features, lookup

BASE = dict(
    loan_id=1, loan_amnt=10000.0, funded_amnt=10000.0, funded_amnt_inv=10000.0, term=36.0, int_rate=12.5,
    installment=335.0, grade="B", sub_grade="B3", emp_length=5.0, emp_title="Manager", home_ownership="RENT",
    verification_status="Verified", annual_inc=60000.0, dti=15.0, purpose="debt_consolidation", addr_state="CA",
    delinq_2yrs=0.0, inq_last_6mths=1.0, open_acc=8.0, pub_rec=0.0, total_acc=20.0, fico_range_low=700.0,
    fico_range_high=704.0, revol_bal=5000.0, revol_util=30.0, initial_list_status="w", application_type="Individual",
    disbursement_method="Cash", cr_history_months=120.0, tot_coll_amt=0.0, delinq_amnt=0.0, total_rev_hi_lim=10000.0,
    tot_hi_cred_lim=50000.0, total_bal_ex_mort=5000.0, total_bc_limit=5000.0, total_il_high_credit_limit=10000.0,
    bc_open_to_buy=2000.0, collections_12_mths_ex_med=0.0, bc_util=40.0, default=0)


def frame(spark, *overrides):
    rows = [{**BASE, "loan_id": i, **o} for i, o in enumerate(overrides or ({},), 1)]
    kinds = {k: ("long" if k == "loan_id" else "int" if k == "default" else
                 "string" if isinstance(v, str) else "double") for k, v in BASE.items()}
    return spark.createDataFrame([tuple(r[k] for k in BASE) for r in rows],
                                 ", ".join(f"{k} {t}" for k, t in kinds.items()))


def one(spark, **override):
    return features.engineer_features(frame(spark, override))[0].first()


def test_reference_row(spark):
    row = one(spark)
    expected = dict(grade_enc=2, sub_grade_enc=8, verification_status_enc=2, home_ownership_enc=1, term_60=0,
                    loan_to_income=1 / 6, installment_to_income=0.067, bc_util_ratio=3000 / 5001, int_rate_x_term=450,
                    fico_dti_score=43.75, derog_ratio=0, inq_per_acc=1 / 9, revolving_debt_share=5000 / 5001,
                    annual_inc_log=math.log(60001), initial_list_status_enc=1, application_type_joint=0)
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, rel=1e-6), name
    for gone in (*features.COLLINEAR, *features.REPLACED_TEXT):
        assert gone not in row.asDict()


@pytest.mark.parametrize("override, name, value", [
    ({"grade": "G"}, "grade_enc", 7), ({"sub_grade": "G5"}, "sub_grade_enc", 35), ({"sub_grade": "A1"}, "sub_grade_enc", 1),
    ({"home_ownership": "MORTGAGE"}, "home_ownership_enc", 3), ({"home_ownership": "castle"}, "home_ownership_enc", 0),
    ({"term": 60.0}, "term_60", 1), ({"annual_inc": 0.0}, "loan_to_income", 0), ({"bc_open_to_buy": 9000.0}, "bc_util_ratio", 0),
    ({"tot_coll_amt": -5.0}, "tot_coll_amt_log", 0), ({"application_type": "Joint App"}, "application_type_joint", 1),
    ({"disbursement_method": "DirectPay"}, "disbursement_direct", 1), ({"pub_rec": 2.0, "total_acc": 3.0}, "derog_ratio", 0.5)])
def test_overrides(spark, override, name, value):
    assert one(spark, **override)[name] == pytest.approx(value)


def test_unknown_grade_fails_training_but_not_serving(spark):
    df = frame(spark, {"grade": "Z"})
    with pytest.raises(policy.PolicyError, match="null:grade_enc"):
        features.engineer_features(df)
    learned = features.engineer_features(frame(spark))[1]
    served = features.build_features(df, learned, serving=True).first()
    assert served["grade_enc"] == 4


def test_serving_without_fields(spark):
    learned = features.engineer_features(frame(spark))[1]
    df = frame(spark).select("loan_id", "loan_amnt", "installment")
    row = features.build_features(df, learned, serving=True).first()
    assert (row["grade_enc"], row["sub_grade_enc"], row["term_60"]) == (4, 18, 0)
    assert row["loan_to_income"] == 10000 and row["installment_to_income"] == 335
    assert row["annual_inc_log"] == 0 and row["purpose_rate_enc"] == pytest.approx(learned.global_rate)


def test_smoothing(spark):
    rows = [("A", int(i < 99)) for i in range(999)] + [("B", 1)]
    df = spark.createDataFrame(rows, "key string, default int").withColumn("is_fit", F.lit(True))
    g = encoding.fit_rate(df)
    rate = {r["key"]: r["value"] for r in encoding.smoothed_rates(df, "key", 500, g).collect()}
    assert 0.5 * g < rate["B"] < 1
    assert rate["A"] == pytest.approx((99 + 500 * g) / 1499)


def test_encodings_ignore_later_rows(spark):
    rows = [("x", 0, True), ("x", 1, True), ("y", 0, True), ("x", 1, False), ("z", 1, False)]
    df = spark.createDataFrame(rows, "purpose string, default int, is_fit boolean")
    learned = encoding.fit_encodings(df)
    table = {r["key"]: r["value"] for r in learned.table.filter("encoding = 'purpose_rate_enc'").collect()}
    g = 1 / 3
    assert learned.global_rate == pytest.approx(g)
    assert table["x"] == pytest.approx((1 + 300 * g) / 302)
    assert table["z"] == pytest.approx(g) and table[None] == pytest.approx(g)


def test_title_frequency_unseen_gets_the_least(spark):
    rows = [("a", 0, True)] * 3 + [("b", 1, True), ("new", 1, False)]
    df = spark.createDataFrame(rows, "emp_title string, default int, is_fit boolean")
    out = encoding.fit_encodings(df).apply(df, "emp_title", "emp_title_log_freq")
    got = {r["emp_title"]: r["emp_title_log_freq"] for r in out.collect()}
    assert got["a"] == pytest.approx(math.log1p(0.75)) and got["new"] == got["b"] == pytest.approx(math.log1p(0.25))


def test_lookup_beyond_broadcast_with_a_hot_key(spark):
    df = spark.range(3000).select(F.col("id").alias("loan_id"), F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 900).cast("string"))).alias("key_in"))
    counts = df.filter("key_in is not null and key_in <> 'k5'").groupBy(F.col("key_in").alias("key")).agg(
        F.count("*").alias("fit_n"), F.count("*").cast("double").alias("value"))
    counts = counts.cache()
    small = lookup.attach(df, counts, 900, "key_in", "v", -1.0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup.attach(df, counts, 900, "key_in", "v", -1.0, broadcast_rows=5)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert large.count() == 3000 and small.exceptAll(large).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_label_indexes(spark):
    train = spark.createDataFrame([("b", "y"), ("a", "x"), ("c", "x")], "p string, q string")
    indexes = encoding.label_indexes(train, ["p", "q"])
    assert {(r[0], r[1]): r[2] for r in indexes.collect()} == {
        ("p", "a"): 0, ("p", "b"): 1, ("p", "c"): 2, ("q", "x"): 0, ("q", "y"): 1}
    other = spark.createDataFrame([("c", "new")], "p string, q string")
    assert tuple(encoding.apply_label_indexes(other, indexes, ["p", "q"]).first()) == (2.0, 0.0)


def test_validation_names_the_columns(spark):
    df = spark.createDataFrame([(1, float("inf"), 1)], "loan_id long, x double, default int")
    with pytest.raises(policy.PolicyError, match="inf:x"):
        features.validate_features(df)
    with pytest.raises(policy.PolicyError, match="Text columns"):
        features.validate_features(df.withColumn("t", F.lit("a")))
    with pytest.raises(policy.PolicyError, match="leakage"):
        features.validate_features(df.withColumn("recoveries", F.lit(1.0)))


def test_policy():
    names = ["loan_id", "loan_amnt", "grade", "default", "recoveries", "emp_title", "loan_age_months"]
    assert policy.having("feature", names, ["grade"]) == ["loan_amnt"]
    assert sorted(policy.having("leakage", names)) == ["loan_age_months", "recoveries"]
    with pytest.raises(policy.PolicyError, match="missing 1 feature"):
        policy.require_features(names, ["loan_amnt", "missing_feature"])
    with pytest.raises(policy.PolicyError):
        policy.refuse_leakage(["loan_age_months"])
