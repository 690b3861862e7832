"""A: sources and sinks. Each check writes to a fresh folder and reads back."""

from pyspark.sql import functions as F

from checks import frames
from checks.registry import check, rounded
from creditloom.operators import encoding, splitting
from creditloom.session import fresh_path
from creditloom.sources import tables

_BROKEN = "CASE WHEN {k} % 20 = 0 THEN concat('first, \"quoted\"', chr(10), 'line ', {k}) END"


@check("a1_read_gzip_csv", f"WITH {frames.RAW} SELECT raw.* EXCLUDE (pd) REPLACE ({_BROKEN.format(k='loan_id')} AS \"desc\") FROM raw")
def a1(spark, d):
    """All columns, with line breaks and quotes in the description."""
    path = fresh_path(spark, "raw-csv")
    raw = frames.raw(spark, d, *frames.ALL_COLUMNS)
    tables.write_csv(raw.withColumn("desc", F.expr(_BROKEN.format(k="loan_id"))), path)
    return tables.read_raw_csv(spark, path, partitions=8)


#: Every 13th record lacks two cells, every 17th has one more, every 19th has text for its amount.
_KINDS = "CASE WHEN loan_id % 13 = 0 THEN {} WHEN loan_id % 17 = 0 THEN {} WHEN loan_id % 19 = 0 THEN {} ELSE {} END"
_CELLS = ("loan_id", "loan_amnt", "grade", "emp_title")


def _broken_file(spark, d, compression):
    """CSV files of which a part of the records is malformed, each with its header."""
    title = "concat('\"', 'chief', chr(10), coalesce(emp_title, ''), '\"')"
    line = _KINDS.format(f"concat(loan_id, ',', loan_amnt)", f"concat(loan_id, ',', loan_amnt, ',', grade, ',', {title}, ',more')",
                         f"concat(loan_id, ',much,', grade, ',', {title})", f"concat(loan_id, ',', loan_amnt, ',', grade, ',', {title})")
    path = fresh_path(spark, "broken-csv")

    def with_header(frames_):
        first = True
        for frame in frames_:
            if first and len(frame):
                frame, first = type(frame)({"value": [",".join(_CELLS), *frame["value"]]}), False
            yield frame
    lines = frames.raw(spark, d, *_CELLS).select(F.expr(line).alias("value"))
    lines.mapInPandas(with_header, "value string").write.option("compression", compression).text(path)
    return path


_CHECKED = (f"WITH {frames.RAW} SELECT loan_id, " + _KINDS.format("NULL", "NULL", "NULL", "loan_amnt") + " AS loan_amnt, "
            + _KINDS.format("NULL", "NULL", "NULL", "concat('chief', chr(10), coalesce(emp_title, ''))") + " AS emp_title, "
            + _KINDS.format("'not 4 cells'", "'not 4 cells'", "'not a number: loan_amnt'", "NULL") + " AS reason FROM raw")


def _accounted(read):
    """Rows and rejects side by side: together they are all records."""
    rejected = read.rejects.select(F.substring_index("record", ",", 1).cast("long").alias("loan_id"),
                                   F.lit(None).cast("double").alias("loan_amnt"), F.lit(None).cast("string").alias("emp_title"),
                                   "reason")
    return read.rows.select("loan_id", "loan_amnt", "emp_title", F.lit(None).cast("string").alias("reason")).unionByName(rejected)


@check("a1_rejects", _CHECKED)
def a1_rejects(spark, d):
    return _accounted(tables.read_raw(spark, _broken_file(spark, d, "gzip")))


@check("a2_prefer_features", frames.PREP + "SELECT 'cleaned' AS source, count(*) AS \"rows\" FROM prep "
       "UNION ALL SELECT 'features', count(*) FROM fit WHERE is_fit")
def a2(spark, d):
    cleaned, features = fresh_path(spark, "cleaned"), fresh_path(spark, "features")
    order = [("features", features), ("cleaned", cleaned)]
    df = frames.prepared(spark, d, "issue_d", "dti")
    parts = []
    for path, table in ((cleaned, df), (features, splitting.add_fit_flag(df, frames.CUTOFFS).filter("is_fit"))):
        tables.write_table(table, path)
        found, source = tables.read_first_existing(spark, order)
        parts.append(found.agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("rows")))
    return parts[0].unionByName(parts[1])


@check("a3_pruned_read", frames.PREP + "SELECT loan_id, fico_range_low, grade FROM prep")
def a3(spark, d):
    path = fresh_path(spark, "cleaned")
    tables.write_table(frames.prepared(spark, d, "fico_range_low", "grade", "dti", "purpose"), path)
    return tables.read_columns(spark, path, ["loan_id", "fico_range_low", "grade"])


@check("a4_write_table", frames.PREP + "SELECT split, count(*) AS \"rows\", round(sum(loan_amnt), 2) AS amount FROM fit GROUP BY split")
def a4(spark, d):
    path = fresh_path(spark, "features")
    df = splitting.add_split(frames.prepared(spark, d, "issue_d", "loan_amnt"), frames.CUTOFFS)
    tables.write_table(df, path, partition_by=["split"])
    return spark.read.parquet(path).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("loan_amnt"), 2).alias("amount"))


@check("a5_encoding_table", frames.PREP + """, g AS (SELECT avg("default") AS g FROM fit WHERE is_fit),
k AS (SELECT addr_state AS key, count(*) FILTER (is_fit) AS fit_n, sum("default") FILTER (is_fit) AS y FROM fit GROUP BY 1)
SELECT 'state_default_rate' AS encoding, key, fit_n, round((y + 500 * g) / (fit_n + 500), 9) AS value, 'time_based_issue_d' AS strategy FROM k CROSS JOIN g
UNION ALL SELECT 'state_default_rate', NULL, 0, round(g, 9), 'time_based_issue_d' FROM g
UNION ALL SELECT 'global_default_rate', NULL, 0, round(g, 9), 'time_based_issue_d' FROM g""")
def a5(spark, d):
    path = fresh_path(spark, "encodings")
    df = splitting.add_fit_flag(frames.prepared(spark, d, "issue_d", "addr_state"), frames.CUTOFFS)
    encoding.fit_encodings(df).save(path)
    return rounded(encoding.load_encodings(spark, path).table, 9, "value")


_BY_GRADE = "SELECT grade, count(*) AS \"rows\", round(avg(\"default\"), 9) AS rate FROM prep GROUP BY grade"


def _by_grade(spark, d):
    return frames.prepared(spark, d, "grade").groupBy("grade").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("default"), 9).alias("rate"))


@check("a6_report_csv", frames.PREP + _BY_GRADE)
def a6(spark, d):
    path = fresh_path(spark, "report-csv")
    tables.write_small_csv(_by_grade(spark, d), path)
    return spark.read.schema("grade string, rows bigint, rate double").option("header", True).csv(path)


@check("a7_report_json", frames.PREP + _BY_GRADE)
def a7(spark, d):
    path = fresh_path(spark, "report-json")
    tables.write_json(_by_grade(spark, d), path)
    return spark.read.schema("grade string, rows bigint, rate double").json(path)


@check("a8_model_round_trip", frames.PREP + "SELECT count(*) AS loans, CAST(0 AS BIGINT) AS differ FROM fit "
       "WHERE split = 'test'")
def a8(spark, d):
    from checks import learned
    from creditloom.operators import scoring
    model, path = learned.logistic(spark, d), fresh_path(spark, "model")
    scoring.save_scoring_model(model, spark, path)
    again = scoring.load_scoring_model(spark, path)
    test = learned.features(spark, d).filter("split = 'test'")
    both = scoring.predict(scoring.predict(test, model, "live"), again, "stored", keep=["live"])
    decide = (F.col("live") >= model.threshold) != (F.col("stored") >= again.threshold)
    apart = F.coalesce((F.abs(F.col("live") - F.col("stored")) > 1e-9) | decide, F.lit(True))
    return both.agg(F.count(F.lit(1)).alias("loans"), F.count_if(apart).alias("differ"))


_APPLIED = [c for c in frames.ALL_COLUMNS if c in (*frames.NUMERIC, *frames.TEXT)]
_TITLE = "('chief' || chr(10) || emp_title)"


@check("a9_read_applications", f"WITH {frames.RAW} SELECT loan_id, " + ", ".join(
    f"{_TITLE} AS emp_title" if c == "emp_title" else f"{frames.PARSED.get(c, c)} AS {c}" if c != "dti" else c for c in _APPLIED) + " FROM raw")
def a9(spark, d):
    """All columns of an application, with line breaks in the title."""
    from creditloom.operators import cleaning
    path = fresh_path(spark, "applications")
    df = frames.raw(spark, d, *_APPLIED).withColumn("emp_title", F.expr(_TITLE))
    parsed = cleaning.parse_columns(df).withColumn("revol_util", F.least(F.lit(100.0), "revol_util"))
    tables.write_csv(parsed.select("loan_id", *_APPLIED), path, "none")
    return tables.read_applications(spark, path)


@check("a9_rejects", _CHECKED)
def a9_rejects(spark, d):
    return _accounted(tables.read_application_file(spark, _broken_file(spark, d, "none")))
