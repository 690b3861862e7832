"""Personal data by weak supervision, in DataFrame functions only.

Spans of four kinds are found by strict rules (these always count) and by loose ones. Five labelers vote on every span,
strict or loose: the rule itself, a gazetteer, the words before it, its shape or check digit, and its borders.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is for each kind and how
likely each pattern is personal data; a logistic regression on the votes, weighted with these, is the final classifier.
Loose spans that it accepts and that overlap no strict one are added.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
VOTES = ("rule", "gazetteer", "context", "shape", "border")
ACCEPT = 0.9
ROUNDS = 60
CONTEXT_CHARS = 32

# Strict rules. Runs begin where no run is going on (or where the last match ended) and never give back: the matches are
# those of the plain patterns, found without trying each place of a long run.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
STRICT = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a rule to be worth trying.
_HINT = {"email": "@", "phone": "+"}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63} ?"
             r"(?:\[dot\]|\(dot\)|\.) ?[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: Gazetteer: ends of mail domains, and calling codes of countries.
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "info", "biz", "de", "fr", "es", "uk", "it", "nl", "eu", "us")
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47",
           "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84",
           "86", "90", "91", "92", "98")
NEAR = {"email": "mail|contact|write to|schreib|correo", "ip": r"\bip\b|host|address|server|logged",
        "card": "card|visa|credit|payment|karte|carte|tarjeta", "phone": "phone|call|mobile|\\btel|fax|telefon|teléfono"}
NOT_NEAR = r"token|version|isbn|order|invoice|\bref|\bid\b|serial|build"

_SPAN = "array<struct<kind: string, start: int, end: int, value: string, strict: boolean>>"


def located(text: Column, pattern: str, kind: str, strict: bool) -> Column:
    """Matches of ``pattern`` as (kind, start, end, value, strict); places count code points, the end excluded."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPAN})").alias("spans"))

    def add(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + pair["gap"]
        end = begin + F.length(pair["value"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"),
                        pair["value"].alias("value"), F.lit(strict).alias("strict"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)),
                       lambda v, g: F.struct(v.alias("value"), g.alias("gap")))
    return F.aggregate(pairs, start, add, lambda acc: acc["spans"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a run of digits ends in the right check digit."""
    each = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), 0), lambda c, i: F.when(
        i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def _octets_fit(value: Column) -> Column:
    """Whether all parts are at most 255; leading zeros don't count."""
    short = F.transform(F.split(value, "\\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(short, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _passes(kind: str) -> Callable[[Column], Column]:
    if kind == "ip":
        return lambda s: _octets_fit(s["value"])
    if kind == "card":
        return lambda s: (F.length(_digits(s["value"])) <= 19) & luhn(_digits(s["value"]))
    if kind == "phone":
        return lambda s: F.length(_digits(s["value"])).between(8, 15)
    return lambda s: F.lit(True)


def strict_spans(text: Column) -> Column:
    """Spans of the strict rules, by kind as listed, then start; none for a null text."""
    nothing = F.expr(f"cast(array() as {_SPAN})")
    per_kind = []
    for kind in KINDS:
        worth = F.instr(text, _HINT[kind]) > 0 if kind in _HINT else text.rlike("[0-9]")
        per_kind.append(F.when(worth, F.filter(located(text, STRICT[kind], kind, True), _passes(kind))).otherwise(nothing))
    return F.concat(*per_kind)


def _apart(span: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def _filter_apart(spans: Column, others: Column) -> Column:
    return F.filter(spans, lambda s: _apart(s, others))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def loose_spans(text: Column, strict: Column) -> Column:
    """Spans of the loose rules that overlap none of ``strict``."""
    nothing = F.expr(f"cast(array() as {_SPAN})")
    per_kind = []
    for kind in KINDS:
        worth = text.rlike(r"[\[(]at[\])]") if kind == "email" else text.rlike(
            "[0-9A-Fa-f]:[0-9A-Fa-f]" if kind == "ip" else "[0-9]{3}")
        per_kind.append(F.when(worth, F.filter(located(text, LOOSE[kind], kind, False),
                                               lambda s: _apart(s, strict))).otherwise(nothing))
    # of loose spans that overlap each other the first kind in the list stays
    kept = per_kind[0]
    for more in per_kind[1:]:
        kept = F.concat(kept, _filter_apart(more, kept))
    return kept


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(span: Column, text: Column) -> Column:
    """The labelers' votes on a span: 1 personal data, -1 not, 0 abstains."""
    kind, value = span["kind"], span["value"]
    digits = _digits(value)
    before = F.lower(F.substring(text, F.greatest(span["start"] - CONTEXT_CHARS + 1, F.lit(1)),
                                 F.least(span["start"], F.lit(CONTEXT_CHARS))))
    left = F.when(span["start"] > 0, F.substring(text, span["start"], F.lit(1))).otherwise(" ")
    right = F.substring(text, span["end"] + 1, F.lit(1))
    by_kind = lambda table: F.coalesce(*[F.when(kind == k, v) for k, v in table.items()])
    near = by_kind({k: before.rlike(p) for k, p in NEAR.items()})
    gazetteer = by_kind({
        "email": _vote(F.lower(F.regexp_extract(value, "([A-Za-z]+)$", 1)).isin(*DOMAINS), F.lit(True)),
        "ip": _vote(value.rlike("^(?:0|127|255)\\."), F.lit(False)) * -1,
        "card": _vote(digits.rlike("^(?:3[0-9]|4|5[1-5]|2[2-7]|6)"), F.lit(True)),
        "phone": _vote(value.startswith("+") & F.regexp_extract(digits, f"^({'|'.join(sorted(CALLING, key=len, reverse=True))})", 1)
                       .isin(*CALLING), value.startswith("+"))})
    shape = by_kind({
        "email": _vote(value.rlike("^[A-Za-z0-9]") & (F.length(value) <= 254), F.lit(True)),
        "ip": _vote(value.contains(":") | _octets_fit(value), F.lit(True)),
        "card": _vote(luhn(digits) & F.length(digits).between(13, 19), F.lit(True)),
        "phone": _vote(F.length(digits).between(10, 13), F.lit(True))})
    return F.struct(
        _vote(span["strict"], F.lit(True)).alias("rule"), gazetteer.alias("gazetteer"),
        _vote(near & ~before.rlike(NOT_NEAR), before.rlike(NOT_NEAR)).alias("context"), shape.alias("shape"),
        _vote(left.rlike(r"[^\p{L}\p{N}_]") & (~right.rlike(r"[\p{L}\p{N}_]")), F.lit(True)).alias("border"))


def vote_patterns(docs: DataFrame) -> DataFrame:
    """kind, the votes and n: how many spans of the table got these votes. At most 4 x 3**5 rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = docs.select(text.alias("text")).withColumn("strict", strict_spans(F.col("text"))).select(
        "text", F.concat("strict", loose_spans(F.col("text"), F.col("strict"))).alias("spans"))
    voted = spans.select(F.explode(F.transform("spans", lambda s: F.struct(
        s["kind"].alias("kind"), votes(s, F.col("text")).alias("v")))).alias("c"))
    return voted.groupBy("c.kind", *[F.col(f"c.v.{v}").alias(v) for v in VOTES]).agg(F.count("*").alias("n"))


def estimate(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = ROUNDS):
    """EM over (kind, votes, count): reliability of each labeler by kind, and the probability of each pattern.

    A labeler's reliability is how likely it is right when it votes; abstaining says nothing.
    """
    right = {(k, i): 0.8 for k in KINDS for i in range(len(VOTES))}
    prior = {k: 0.5 for k in KINDS}
    chance: dict[tuple[str, tuple[int, ...]], float] = {}
    for _ in range(rounds):
        for kind, vote, _ in patterns:
            odds = math.log(prior[kind]) - math.log(1 - prior[kind])
            for i, v in enumerate(vote):
                odds += v * (math.log(right[kind, i]) - math.log(1 - right[kind, i]))
            chance[kind, vote] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for kind in KINDS:
            own = [(v, n, chance[k, v]) for k, v, n in patterns if k == kind]
            total = sum(n for _, n, _ in own)
            if not total:
                continue
            prior[kind] = min(0.99, max(0.01, sum(n * p for _, n, p in own) / total))
            for i in range(len(VOTES)):
                cast = [(v[i], n, p) for v, n, p in own if v[i]]
                good = sum(n * (p if v > 0 else 1 - p) for v, n, p in cast)
                # four votes in favour of 0.75 keep a labeler from being trusted or damned on little
                right[kind, i] = min(0.99, max(0.51, (good + 3) / (sum(n for _, n, _ in cast) + 4)))
    return right, prior, chance


def _features(kind: str, vote) -> list[float]:
    return [float(k == kind) for k in KINDS] + [float(v) * (k == kind) for k in KINDS for v in vote]


def fit_classifier(docs: DataFrame) -> list[float] | None:
    """Weights of the span classifier (bias of each kind, then each vote by kind); None without any span."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    rows = [(r.kind, tuple(r[v] for v in VOTES), r.n) for r in vote_patterns(docs).collect()]
    if not rows:
        return None
    _, _, chance = estimate(sorted(rows))
    cases = [(_features(k, v), float(y), math.log1p(n) * (chance[k, v] if y else 1 - chance[k, v]))
             for k, v, n in sorted(rows) for y in (1, 0)]
    table = docs.sparkSession.createDataFrame(cases, "x array<double>, label double, weight double").coalesce(1)
    model = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=0.01,
                               fitIntercept=False, standardization=False).fit(
        table.withColumn("features", array_to_vector("x")))
    return [float(c) for c in model.coefficients]


def _probability(span: Column, text: Column, weights: list[float]) -> Column:
    vote = votes(span, text)
    n = len(VOTES)
    scores = [F.when(span["kind"] == kind, sum(
        (vote[v] * weights[len(KINDS) + k * n + i] for i, v in enumerate(VOTES)), F.lit(weights[k])))
        for k, kind in enumerate(KINDS)]
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.coalesce(*scores)))


def _with_spans(docs: DataFrame, weights: list[float] | None, accept: float) -> DataFrame:
    """``docs`` with columns __text, __strict and __added."""
    rows = docs.withColumn("__text", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.withColumn("__strict", strict_spans(F.col("__text")))
    if weights is None:
        return rows.withColumn("__added", F.expr(f"cast(array() as {_SPAN})"))
    return rows.withColumn("__added", F.filter(
        loose_spans(F.col("__text"), F.col("__strict")),
        lambda s: _probability(s, F.col("__text"), weights) >= accept))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for each row of ``docs`` (doc_id, text).

    The counts and the digest are those of the strict rules; ``spans`` lists all. A null text counts as empty.
    """
    rows = _with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit_classifier(docs), accept)
    every = F.concat("__strict", "__added")
    ordered = F.concat(*[F.array_sort(_of_kind(every, k), lambda a, b: a["start"] - b["start"]) for k in KINDS])
    return rows.select("doc_id", *[F.size(_of_kind(F.col("__strict"), k)).cast("long").alias(f"n_{k}") for k in KINDS],
                       F.sha2(_listed(F.col("__strict")), 256).alias("base_sha256"), _listed(ordered).alias("spans"),
                       F.size("__added").cast("long").alias("n_added"))


def redact(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets and n_chars, if there, counted anew.

    Overlapping spans become one gap under the name of the first. Null texts stay null, texts without spans as they are.
    """
    rows = _with_spans(docs, fit_classifier(docs), accept)
    every = F.array_sort(F.concat("__strict", "__added"), lambda a, b: F.when(
        a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("__text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] >= acc["at"], F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, mark).alias("out"))

    clean = F.aggregate(every, start, step,
                        lambda acc: F.concat(acc["out"], F.substring(F.col("__text"), acc["at"] + 1, 2_147_483_647)))
    touched = (F.size("__strict") + F.size("__added")) > 0
    text = F.when(F.col("text").isNull() | ~touched, F.col("text")).otherwise(clean)
    out = rows.withColumn("__clean", text)
    columns = []
    for f in docs.schema.fields:
        if f.name == "text":
            columns.append(F.col("__clean").alias("text"))
        elif f.name == "n_chars":
            columns.append(F.when(F.col("text").isNull() | ~touched, F.col("n_chars"))
                           .otherwise(F.length("__clean")).cast(f.dataType).alias("n_chars"))
        else:
            columns.append(F.col(f"`{f.name}`"))
    return out.select(*columns)
