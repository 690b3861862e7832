"""D: time windows and sampling."""

from pyspark.sql import functions as F

from checks import frames
from checks.registry import check, rounded
from creditloom.operators import splitting

CUT = frames.CUTOFFS


def _dated(spark, d):
    return frames.prepared(spark, d, "issue_d", "loan_amnt").select("loan_id", "default", "issue_d", "loan_amnt")


@check("d1_undated_rows", frames.PREP + "SELECT count(*) FILTER (issue_d IS NULL) AS undated, "
       "count(*) AS \"rows\" FROM prep")
def d1(spark, d):
    df = _dated(spark, d)
    splitting.check_split(splitting.add_split(df, CUT))
    return df.agg(F.count_if(F.col("issue_d").isNull()).alias("undated"), F.count(F.lit(1)).alias("rows"))


@check("d2_time_windows", frames.PREP + "SELECT loan_id, split FROM fit")
def d2(spark, d):
    return splitting.add_split(_dated(spark, d), CUT).select("loan_id", "split")


@check("d3_split_frames", frames.PREP + "SELECT loan_id, loan_amnt, \"default\", split AS part FROM fit")
def d3(spark, d):
    parts = splitting.time_split(_dated(spark, d), CUT)
    out = None
    for name, part in zip(splitting.WINDOWS, parts):
        part = part.select("loan_id", "loan_amnt", "default", F.lit(name).alias("part"))
        out = part if out is None else out.unionByName(part)
    return out


@check("d4_split_summary", frames.PREP + 'SELECT split, count(*) AS "rows", '
       'round(avg("default"), 9) AS default_rate, min(issue_d) AS start_date, max(issue_d) AS end_date '
       'FROM fit GROUP BY split')
def d4(spark, d):
    return rounded(splitting.split_summary(_dated(spark, d), CUT), 9, "default_rate")


@check("d5_fit_flag", frames.PREP + "SELECT loan_id, is_fit FROM fit")
def d5(spark, d):
    return splitting.add_fit_flag(_dated(spark, d), CUT).select("loan_id", "is_fit")


@check("d6_sample_exact", frames.PREP + "SELECT loan_id, \"default\", loan_amnt FROM prep "
       "ORDER BY CAST('0x' || substr(md5('42:' || loan_id), 1, 15) AS BIGINT), loan_id LIMIT 700")
def d6(spark, d):
    return splitting.sample_rows(_dated(spark, d).drop("issue_d"), 700)


@check("d7_train_and_validation", frames.PREP + "SELECT loan_id, split FROM fit WHERE split <> 'test'")
def d7(spark, d):
    return splitting.train_and_validation(_dated(spark, d), CUT).select("loan_id", "split")
