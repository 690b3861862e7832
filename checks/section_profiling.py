"""M: exploratory tables."""

from pyspark.sql import functions as F

from checks import frames
from checks.registry import check, rounded
from creditloom.operators import profiling
from creditloom.session import fresh_path

P = frames.PREP
NUM = ("loan_amnt", "int_rate", "annual_inc", "dti", "open_acc", "revol_bal", "fico_range_low", "emp_length")
WIDE = tuple(frames.NUMERIC)
TXT = ("grade", "home_ownership", "purpose", "addr_state", "emp_title")


def _d(c):
    return f"CAST({c} AS DOUBLE)"


@check("m1_column_profile", P + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{'string' if c in TXT else 'double'}' AS data_type, count({c}) AS non_null, "
    f"round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 6) AS null_pct, count(DISTINCT {c}) AS \"distinct\" FROM prep"
    for c in (*WIDE, *TXT)))
def m1(spark, d):
    return rounded(profiling.column_profile(frames.prepared(spark, d, *WIDE, *TXT), [*WIDE, *TXT]), 6, "null_pct")


@check("m1_merged_profile", P + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS \"rows\", count({c}) AS non_null, count(DISTINCT {c}) AS exact, true AS within_error FROM prep"
    for c in (*WIDE, *TXT)))
def m1_merged(spark, d):
    """Sketches of each month, written, merged and held against the exact counts: four standard errors at most."""
    df = frames.prepared(spark, d, "issue_d", *WIDE, *TXT)
    month = F.date_trunc("month", "issue_d").alias("month")
    path = fresh_path(spark, "sketches")
    profiling.profile_sketches(df.withColumn("month", month), [*WIDE, *TXT], ["month"]).write.parquet(path)
    merged = profiling.merged_profile(spark.read.parquet(path))
    exact = profiling.column_profile(df, [*WIDE, *TXT]).select("feature", F.col("distinct").alias("exact"))
    close = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col("exact"))
    return merged.join(exact, "feature").select("feature", "rows", "non_null", "exact", close.alias("within_error"))


_Q = {"p1": .01, "p5": .05, "p25": .25, "p50": .5, "p75": .75, "p95": .95, "p99": .99}


@check("m2_describe", P + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(min({c}), 6) AS min, " + ", ".join(f"round(quantile_cont({c}, {q}), 6) AS {n}" for n, q in _Q.items())
    + f", round(max({c}), 6) AS max FROM prep" for c in WIDE))
def m2(spark, d):
    return rounded(profiling.describe(frames.prepared(spark, d, *WIDE), WIDE), 6,
                   "mean", "std", "min", "max", *_Q)


@check("m3_target_counts", P + """, t AS (SELECT count(*) AS n FROM prep)
SELECT "default", count(*) AS "rows", round(count(*) / CAST(any_value(n) AS DOUBLE), 9) AS share,
  round(any_value(n) / CAST(count(*) AS DOUBLE), 9) AS one_in FROM prep CROSS JOIN t GROUP BY "default" """)
def m3(spark, d):
    return rounded(profiling.target_counts(frames.prepared(spark, d)), 9, "share", "one_in")


@check("m4_rate_by_year", P + 'SELECT CAST(year(issue_d) AS INTEGER) AS period, count(*) AS "rows", '
       'round(avg("default") * 100, 9) AS default_rate FROM prep GROUP BY 1')
def m4(spark, d):
    df = frames.prepared(spark, d, "issue_d")
    return rounded(profiling.rate_by_period(df, F.year("issue_d")), 9, "default_rate")


@check("m5_missing_table", P + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 6) AS missing_pct FROM prep"
    for c in (*WIDE, *TXT)) + ") WHERE missing_pct > 1")
def m5(spark, d):
    return rounded(profiling.missing_table(frames.prepared(spark, d, *WIDE, *TXT), [*WIDE, *TXT], 1.0), 6, "missing_pct")


def _hist(c):
    return f"""SELECT '{c}' AS feature, CAST(i AS INTEGER) AS bin, round(a, 6) AS bin_start, count(*) AS "rows",
  (SELECT round(median({c}), 6) FROM prep) AS median
FROM (SELECT i, low + i * ((high - low) / 50) AS a, CASE WHEN i = 49 THEN high ELSE low + (i + 1) * ((high - low) / 50) END AS b
      FROM (SELECT min({c}) AS low, max({c}) AS high FROM prep) CROSS JOIN range(50) r(i))
JOIN prep ON {c} >= a AND ({c} < b OR (i = 49 AND {c} <= b)) GROUP BY i, a"""


@check("m6_histograms", P + " UNION ALL ".join(map(_hist, NUM)))
def m6(spark, d):
    return rounded(profiling.histograms(frames.prepared(spark, d, *NUM), NUM), 6, "bin_start", "median")


def _box(c):
    return f"""SELECT '{c}' AS feature, p."default", count({c}) AS "rows", round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median,
  round(any_value(q3), 6) AS q3, round(least(any_value(q1), min({c}) FILTER ({c} >= q1 - 1.5 * (q3 - q1))), 6) AS whisker_low,
  round(greatest(any_value(q3), max({c}) FILTER ({c} <= q3 + 1.5 * (q3 - q1))), 6) AS whisker_high,
  count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
FROM prep p JOIN (SELECT "default" AS y, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3
                  FROM prep GROUP BY 1) ON p."default" = y GROUP BY p."default" """


@check("m7_box_plots", P + " UNION ALL ".join(map(_box, NUM)))
def m7(spark, d):
    return rounded(profiling.box_plots(frames.prepared(spark, d, *NUM), NUM), 6,
                   "q1", "median", "q3", "whisker_low", "whisker_high")


@check("m8_category_rates", P + """SELECT emp_title AS category, CAST(sum("default") AS BIGINT) AS defaults, count(*) AS "rows",
  round(100.0::DOUBLE * sum("default") / count(*), 9) AS default_rate FROM prep WHERE emp_title IS NOT NULL
  GROUP BY 1 ORDER BY "rows" DESC, category LIMIT 20""")
def m8(spark, d):
    return rounded(profiling.category_rates(frames.prepared(spark, d, "emp_title"), "emp_title"), 9, "default_rate")


def _corr(x, y):
    """NULL where one of the two does not vary over the rows that have both."""
    both = f"FILTER ({x} IS NOT NULL AND {y} IS NOT NULL)"
    return (f"CASE WHEN max({x}) {both} > min({x}) {both} AND max({y}) {both} > min({y}) {both} "
            f"THEN round(corr({_d(x)}, {_d(y)}), 9) END")


@check("m9_top_correlates", P + "SELECT * FROM (SELECT unnest([" + ", ".join(
    f"{{'feature': '{c}', 'correlation': {_corr(c, chr(34) + 'default' + chr(34))}}}" for c in frames.NUMERIC)
    + "], recursive := true) FROM prep) ORDER BY abs(correlation) DESC NULLS LAST, feature LIMIT 30")
def m9(spark, d):
    return rounded(profiling.top_correlates(frames.prepared(spark, d, *frames.NUMERIC), frames.NUMERIC), 9, "correlation")


_WIDE = frames.NUMERIC[:20]


@check("m10_correlation_pairs", P + "SELECT unnest([" + ", ".join(
    f"{{'feature': '{a}', 'other': '{b}', 'correlation': {_corr(a, b)}}}" for i, a in enumerate(_WIDE) for b in _WIDE[:i])
    + "], recursive := true) FROM prep")
def m10(spark, d):
    return rounded(profiling.correlation_pairs(frames.prepared(spark, d, *_WIDE), _WIDE), 9, "correlation")


@check("m11_rate_by_bin", P + """, lim AS (SELECT min(annual_inc) AS low, max(annual_inc) AS high FROM prep),
e AS (SELECT i, CASE WHEN i = 0 THEN low - 0.001 * (high - low) ELSE low + i * ((high - low) / 20) END AS a,
      CASE WHEN i = 19 THEN high ELSE low + (i + 1) * ((high - low) / 20) END AS b FROM lim CROSS JOIN range(20) r(i))
SELECT CAST(i AS INTEGER) AS bin, round(a, 6) AS lower, round(b, 6) AS upper, round(avg("default") * 100, 9) AS default_rate, count(*) AS "rows"
FROM prep JOIN e ON annual_inc > a AND annual_inc <= b GROUP BY i, a, b""")
def m11(spark, d):
    out = profiling.rate_by_bin(frames.prepared(spark, d, "annual_inc"), "annual_inc")
    return rounded(rounded(out, 6, "lower", "upper"), 9, "default_rate")


_DENSE = ("int_rate", "dti", "loan_amnt", "revol_util", "fico_range_low")


def _kde(c, v):
    """Linearly binned: 64 nodes to a kernel width, each value shared between the two nodes around it."""
    return f"""SELECT '{c}' AS feature, {v} AS "default", CAST(i AS INTEGER) AS point, round(x, 6) AS x,
  round(sum(weight * exp(-0.5 * ((x - place) / h) * ((x - place) / h))) / (any_value(total) * any_value(h) * sqrt(2 * pi())), 11) AS density,
  round(any_value(gap * gap / (8 * sqrt(2 * pi()) * h * h * h)), 11) AS error_bound
FROM (SELECT i, i * (((high + 0.5 * (high - low)) - (low - 0.5 * (high - low))) / 999) + (low - 0.5 * (high - low)) AS x
      FROM lim_{c} CROSS JOIN range(1000) r(i) WHERE y = {v})
CROSS JOIN (SELECT low + gap * node AS place, sum(weight) AS weight, any_value(h) AS h, any_value(gap) AS gap, any_value(total) AS total
  FROM (SELECT low, gap, h, total, unnest([floor(p), floor(p) + 1]) AS node, unnest([1 - (p - floor(p)), p - floor(p)]) AS weight
        FROM (SELECT *, ({c} - low) / gap AS p FROM prep JOIN lim_{c} ON "default" = y WHERE {c} IS NOT NULL AND y = {v}))
  GROUP BY low, gap, node) GROUP BY i, x"""


_LIMITS = "".join(f""", lim_{c} AS (SELECT *, greatest(h / 64, (high - low) / 262144) AS gap FROM (
  SELECT "default" AS y, min({c}) AS low, max({c}) AS high, 0.3 * stddev_samp({c}) AS h, count({c}) AS total FROM prep GROUP BY 1))"""
                  for c in _DENSE)


@check("m12_binned_density", P + _LIMITS + " " + " UNION ALL ".join(_kde(c, v) for c in _DENSE for v in (0, 1)))
def m12_binned(spark, d):
    out = profiling.density_by_class(frames.prepared(spark, d, *_DENSE), _DENSE, most=0)
    return rounded(rounded(out, 6, "x"), 11, "density", "error_bound")


def _direct(c, v):
    return f"""SELECT '{c}' AS feature, {v} AS "default", CAST(i AS INTEGER) AS point, round(x, 6) AS x,
  round(sum(n * exp(-0.5 * ((x - {c}) / h) * ((x - {c}) / h))) / (any_value(total) * any_value(h) * sqrt(2 * pi())), 11) AS density,
  0.0::DOUBLE AS error_bound
FROM (SELECT i, i * (((high + 0.5 * (high - low)) - (low - 0.5 * (high - low))) / 999) + (low - 0.5 * (high - low)) AS x, h, total
      FROM lim_{c} CROSS JOIN range(1000) r(i) WHERE y = {v})
CROSS JOIN (SELECT {c}, count(*) AS n FROM prep WHERE "default" = {v} AND {c} IS NOT NULL GROUP BY 1) GROUP BY i, x"""


@check("m12_density_by_class", P + _LIMITS + " " + " UNION ALL ".join(_direct(c, v) for c in _DENSE for v in (0, 1)))
def m12(spark, d):
    out = profiling.density_by_class(frames.prepared(spark, d, *_DENSE), _DENSE)
    return rounded(rounded(out, 6, "x"), 11, "density", "error_bound")


@check("m13_skewness", P + "SELECT feature, round(skewness, 6) AS skewness FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, skewness({_d(c)}) AS skewness FROM prep" for c in NUM) + ") ORDER BY skewness DESC, feature LIMIT 5")
def m13(spark, d):
    return rounded(profiling.skewness_ranking(frames.prepared(spark, d, *NUM), NUM), 6, "skewness")


@check("m14_cardinality", P + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS \"distinct\" FROM prep" for c in TXT))
def m14(spark, d):
    return profiling.cardinality(frames.prepared(spark, d, *TXT), TXT)
