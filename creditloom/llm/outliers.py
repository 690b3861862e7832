"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Counts of words, characters, symbols, repeated lines and repeated word windows are taken of whole texts within their rows.
Their transformed vectors are judged per language and source by the minimum covariance determinant: concentration steps
take the SHARE of rows nearest to the present centre, estimate centre and covariance from them, and repeat; each
step lowers the determinant. Rows with a large Mahalanobis distance from the final estimate are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.session import materialise

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[^#*$%&|<>]+"
LEAST_WORDS = 50
#: Share of rows that an estimate is made from, and what makes their covariance right for normal data in five dimensions
#: (share / P(chi2_7 <= chi2_5 quantile of the share)).
SHARE, CONSISTENCY = 0.75, 1.41
STEPS = 5
#: Rows that a group needs for an estimate of its own; smaller sources are pooled by language, then all together.
LEAST_ROWS = 50
#: Squared distance beyond which a row is rejected. Chi-square with five degrees exceeds it with probability 1e-9.
CUTOFF = 50.0
#: Name -> (expression, least standard deviation). Most texts have no symbols and repeat nothing, so without a floor a group
#: would have no spread there and any text that has some would be an outlier.
VECTOR = {
    "x1": ("ln(n_words)", 0.5),
    "x2": ("word_chars / n_words", 0.4),
    "x3": ("n_symbols / word_chars", 0.01),
    "x4": ("n_dup_lines / n_lines", 0.08),
    "x5": ("n_repeat_words / n_words", 0.08),
}
_N = len(VECTOR)


def _covered(hashes: Column) -> Column:
    """Words in 3-word windows whose hash occurs twice or more."""
    s = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def with_sorted(s: Column) -> Column:
        marked = F.transform(s, lambda e, j: F.when(
            F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)), e["i"]))
        return F.sort_array(F.array_compact(marked))

    def count(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.when(j == 0, 3).otherwise(
            F.least(F.lit(3), p - F.coalesce(F.get(places, j - 1), F.lit(0)))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    # a lambda over a one-element array binds a value once
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    return once(s, lambda v: once(with_sorted(v), count))


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` without text, with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (longs).

    A null text has none of them. Windows are compared by 64-bit hashes within one text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("__text")).withColumns({
        "__words": F.filter(F.split(F.col("__text"), SPACE), lambda w: w != ""),
        "__lines": F.filter(F.split(F.col("__text"), "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))})
    n = F.size("__words")
    rows = rows.withColumn("__hashes", F.when(n >= 4, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
            F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)))))
    repeated = F.when(F.size(F.array_distinct("__hashes")) < F.size("__hashes"), _covered(F.col("__hashes"))).otherwise(0)
    return rows.select(
        "doc_id", "lang", "source", n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("__text", SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("__text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeated, F.lit(0)).cast("long").alias("n_repeat_words"))


def _grouped(stats: DataFrame, least_rows: int) -> DataFrame:
    """``stats`` with the vector and the group (level, g_lang, g_source) of each row that the base rules keep."""
    rows = stats.withColumns({k: F.when(~F.col("base_failed"), F.expr(e)) for k, (e, _) in VECTOR.items()})
    rows = rows.withColumns({"__lang": F.coalesce("lang", F.lit("\0")), "__source": F.coalesce("source", F.lit("\0"))})
    sizes = (rows.where("not base_failed").groupBy("__lang", "__source").agg(F.count("*").alias("n"))
             .withColumn("own", F.col("n") >= least_rows))
    pools = sizes.where("not own").groupBy("__lang").agg((F.sum("n") >= least_rows).alias("pooled"))
    groups = materialise(sizes.join(pools, "__lang", "left").select(
        "__lang", "__source",
        F.when(F.col("own"), F.concat_ws("\1", "__lang", "__source"))
        .when(F.col("pooled"), F.concat("__lang", F.lit("\1"))).otherwise("").alias("group")), "groups")
    return rows.join(groups, ["__lang", "__source"], "left").drop("__lang", "__source")


def _factor(estimates: DataFrame) -> DataFrame:
    """Cholesky factor l{i}{j} of each group's covariance with floors on its diagonal."""
    floors = [sd * sd for _, sd in VECTOR.values()]
    out = estimates
    for i in range(1, _N + 1):
        for j in range(1, i + 1):
            known = F.col(f"c{j}{i}")
            if i == j:
                known = known + floors[i - 1]
            for k in range(1, j):
                known = known - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(known, F.lit(1e-12))) if i == j
                                 else known / F.col(f"l{j}{j}"))
    return out


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution, as nested column arithmetic."""
    solved: list[Column] = []
    for i in range(1, _N + 1):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(1, i):
            rest = rest - F.col(f"l{i}{k}") * solved[k - 1]
        solved.append(rest / F.col(f"l{i}{i}"))
    return sum((z * z for z in solved[1:]), solved[0] * solved[0])


def _moments(rows: DataFrame, consistency: float) -> DataFrame:
    """Centre and covariance per group, from sums that each task makes first."""
    pairs = [(i, j) for i in range(1, _N + 1) for j in range(i, _N + 1)]
    sums = rows.groupBy("group").agg(
        F.count("*").alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(1, _N + 1)],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i, j in pairs])
    return sums.withColumns({f"c{i}{j}": F.col(f"c{i}{j}") * consistency for i, j in pairs})


def robust_estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Final centre and factor of each group (one small row a group)."""
    names = list(VECTOR)
    quartiles = rows.groupBy("group").agg(*[
        F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000).alias(f"q_{x}") for x in names])
    start = quartiles.select("group", *[F.col(f"q_{x}")[1].alias(f"m{i}") for i, x in enumerate(names, 1)], *[
        (F.pow((F.col(f"q_{x}")[2] - F.col(f"q_{x}")[0]) / 1.349, 2) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
        for i, x in enumerate(names, 1) for j in range(i, _N + 1)])
    estimate = materialise(_factor(start), "estimate")
    for _ in range(steps):
        near = rows.join(estimate, "group").select("group", *names, _distance().alias("d2"))
        # written, so that its true size is known: a small one is broadcast and no row is dealt out by its group
        limit = materialise(near.groupBy("group").agg(F.percentile_approx("d2", SHARE, 10_000).alias("limit")), "limit")
        nearest = near.join(limit, "group").where("d2 <= limit")
        estimate = materialise(_factor(_moments(nearest, CONSISTENCY)), "estimate")
    return estimate


def judge(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS) -> DataFrame:
    """doc_id, the statistics, base_failed, distance and kept for each row of ``docs`` (doc_id, text, lang, source).

    Null language and source are values of their own. A group too small even when pooled rejects nothing. distance is null
    where no estimate applies.
    """
    stats = text_statistics(docs).withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    rows = materialise(_grouped(materialise(stats, "statistics"), least_rows), "vectors")
    enough = rows.where("not base_failed")
    sizes = materialise(enough.groupBy("group").agg(F.count("*").alias("n_group")).where(
        F.col("n_group") >= least_rows).select("group"), "sizes")
    estimate = robust_estimates(enough.join(sizes, "group"))
    far = rows.join(estimate.drop("n"), "group", "left")
    distance = F.when(~F.col("base_failed"), _distance())
    return far.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", distance.alias("distance"),
        (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= cutoff)).alias("kept"))
