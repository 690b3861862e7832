"""Exact quantiles with bounded memory at any row count.

Spark's exact ``percentile`` keeps every distinct value of a column in one
aggregation buffer, which no longer fits once a column has billions of them.
Here each wanted rank is narrowed instead: a sketch gives a bracket around the
rank, one aggregation counts exactly how many rows lie below, on and between
the bracket's ends, and the open interval between them becomes the next, far
smaller search range. When few enough rows are left, ``percentile`` finishes
on those. Every pass is a map-side aggregation with a constant-size result; no
row is shuffled and heavily repeated values cost nothing extra.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINISH_VALUES = 4_000_000      # values that all finishing states together may hold
SKETCH_ACCURACY = 10_000


@dataclass
class _Search:
    """One rank being narrowed inside the open interval (low, high)."""

    column: str
    rank: int            # 0-based rank inside the interval
    rows: int            # rows inside the interval
    low: float | None = None
    high: float | None = None
    value: float | None = None

    @property
    def interval(self) -> tuple:
        return self.column, self.low, self.high

    def inside(self) -> Column:
        value = F.col(self.column)
        keep = value.isNotNull()
        if self.low is not None:
            keep = keep & (value > F.lit(self.low))
        if self.high is not None:
            keep = keep & (value < F.lit(self.high))
        return F.when(keep, value.cast("double"))


def _by_interval(searches: list[_Search]) -> list[list[_Search]]:
    """Ranks searched in the same interval share one state."""
    groups: dict[tuple, list[_Search]] = {}
    for s in searches:
        groups.setdefault(s.interval, []).append(s)
    return list(groups.values())


def _fraction(rank: int, rows: int) -> float:
    """A fraction f whose position f * (rows - 1) is the integer rank itself."""
    if rows <= 1:
        return 0.0
    f = rank / (rows - 1)
    for candidate in (f, math.nextafter(f, 2.0), math.nextafter(f, -1.0)):
        if 0.0 <= candidate <= 1.0 and candidate * (rows - 1) == rank:
            return candidate
    return min(max(f, 0.0), 1.0)


def _finish(df: DataFrame, groups: list[list[_Search]]) -> None:
    """Solve the searches of intervals that hold few rows."""
    row = df.agg(*[F.percentile(g[0].inside(), F.array(*[F.lit(_fraction(s.rank, s.rows)) for s in g]))
                   .alias(f"g{i}") for i, g in enumerate(groups)]).first()
    for i, group in enumerate(groups):
        for s, value in zip(group, row[i]):
            s.value = float(value)


SLACK = 2.0 / SKETCH_ACCURACY


def _narrow(df: DataFrame, groups: list[list[_Search]]) -> None:
    """Shrink every search interval to the part that holds its rank."""
    slack = SLACK
    sketch = []
    for i, g in enumerate(groups):
        ends = [end for s in g for end in (max(s.rank / max(s.rows - 1, 1) - slack, 0.0),
                                           min(s.rank / max(s.rows - 1, 1) + slack, 1.0))]
        sketch.append(F.percentile_approx(g[0].inside(), F.array(*[F.lit(e) for e in ends]),
                                          F.lit(SKETCH_ACCURACY)).alias(f"s{i}"))
    found = df.agg(*sketch).first()
    _settle(df, [(s, found[i][2 * j], found[i][2 * j + 1]) for i, g in enumerate(groups) for j, s in enumerate(g)])


def _counts_between(df: DataFrame, searched: Sequence[tuple]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each (value, bounds): how many values lie below, on and between the sorted bounds, and these; one scan.

    Place 2 i + 1 counts values equal to bound i, place 2 i those before it and after the bound before. A task sends its
    counts only; as many aggregates over one row would be too wide to compile.
    """
    sorted_bounds = [np.unique(np.array(list(bounds), dtype=float)) for _, bounds in searched]

    def count(batches):
        totals = [np.zeros(2 * len(b) + 1, dtype=np.int64) for b in sorted_bounds]
        for batch in batches:
            for total, bounds, column in zip(totals, sorted_bounds, batch.columns):
                values = column.drop_null().to_numpy(zero_copy_only=False)
                place = np.searchsorted(bounds, values, "left") + np.searchsorted(bounds, values, "right")
                total += np.bincount(place, minlength=len(total))
        yield pa.RecordBatch.from_pydict({
            "search": np.repeat(np.arange(len(totals), dtype=np.int32), [len(t) for t in totals]),
            "place": np.concatenate([np.arange(len(t), dtype=np.int32) for t in totals]), "n": np.concatenate(totals)})

    values = df.select(*[value.cast("double").alias(f"v{i}") for i, (value, _) in enumerate(searched)])
    out = [(np.zeros(2 * len(b) + 1, dtype=np.int64), b) for b in sorted_bounds]
    for r in values.mapInArrow(count, "search int, place int, n long").groupBy("search", "place").agg(F.sum("n").alias("n")).collect():
        out[r["search"]][0][r["place"]] = r["n"]
    return out


def _settle(df: DataFrame, bracketed: list[tuple[_Search, float, float]]) -> None:
    """Count around each search's bracket and go on in the part that holds its rank."""
    # Searches with equal brackets share one count.
    brackets: dict[tuple, list[_Search]] = {}
    for s, low, high in bracketed:
        brackets.setdefault((s.interval, low, high), []).append(s)
    # One scan counts around all ends of an interval.
    ends: dict[tuple, tuple[Column, set[float]]] = {}
    for (interval, low, high), members in brackets.items():
        ends.setdefault(interval, (members[0].inside(), set()))[1].update((low, high))
    counted = dict(zip(ends, _counts_between(df, list(ends.values()))))

    for (interval, low, high), members in brackets.items():
        counts, bounds = counted[interval]
        i, j = (int(np.searchsorted(bounds, end)) for end in (low, high))
        below, on_low, between = int(counts[:2 * i + 1].sum()), int(counts[2 * i + 1]), int(counts[2 * i + 2:2 * j + 1].sum())
        on_high = 0 if low == high else int(counts[2 * j + 1])
        for s in members:
            parts = [(below, s.low, low, None), (on_low, low, low, low), (between, low, high, None),
                     (on_high, high, high, high),
                     (s.rows - below - on_low - between - on_high, high, s.high, None)]
            for size, part_low, part_high, exact in parts:
                if s.rank < size:
                    s.low, s.high, s.rows, s.value = part_low, part_high, size, exact
                    break
                s.rank -= size


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]],
                     rows: Mapping[str, int], finish_values: int = FINISH_VALUES,
                     brackets: Mapping[tuple[str, int], tuple[float, float]] | None = None,
                     ) -> dict[tuple[str, int], float]:
    """Exact value at each 0-based rank of the non-null values of each column.

    ``brackets`` are first guesses (low, high) around ranks, from a sketch made in an earlier scan; a wrong one costs a
    further step, nothing else.
    """
    searches = {(c, r): _Search(c, r, rows[c]) for c, rs in ranks.items() for r in set(rs)}
    open_ = list(searches.values())
    if brackets and sum({s.interval: s.rows for s in open_}.values()) > finish_values:
        _settle(df, [(s, *brackets[key]) for key, s in searches.items() if key in brackets])
        open_ = [s for s in open_ if s.value is None]
    while open_:
        groups = sorted(_by_interval(open_), key=lambda g: g[0].rows)
        small, room = [], finish_values
        while groups and groups[0][0].rows <= room:
            room -= groups[0][0].rows
            small.append(groups.pop(0))
        if small:
            _finish(df, small)
        if groups:
            _narrow(df, groups)
        open_ = [s for s in open_ if s.value is None]
    return {key: s.value for key, s in searches.items()}


@dataclass(frozen=True)
class Quantile:
    """Linear interpolation between two neighbouring order statistics."""

    lower: float
    upper: float
    weight: float

    @property
    def value(self) -> float:
        return self.lower + (self.upper - self.lower) * self.weight

    def clipped(self, low: float | None, high: float | None) -> "Quantile":
        """The same quantile after clipping: clipping keeps the order."""
        def clip(v: float) -> float:
            v = v if high is None else min(v, high)
            return v if low is None else max(v, low)
        return Quantile(clip(self.lower), clip(self.upper), self.weight)


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]],
                    rows: Mapping[str, int] | None = None,
                    finish_values: int = FINISH_VALUES) -> dict[str, dict[float, Quantile]]:
    """Linear-interpolated quantiles per column; a column without values is left out.

    Without ``rows`` one scan counts the values and brackets every quantile with a sketch.
    """
    if not wanted:
        return {}
    sketched = None
    if rows is None:
        rows, sketched = counts_and_brackets(df, wanted)
    return settled_quantiles(df, wanted, rows, sketched or {}, finish_values)


def counts_and_brackets(df: DataFrame, wanted: Mapping[str, Sequence[float]],
                        ) -> tuple[dict[str, int], dict[tuple[str, float], tuple[float, float]]]:
    """Non-null values per column, and (low, high) around each quantile: one scan, constant-size mergeable states."""
    names, aggs = list(wanted), []
    for i, c in enumerate(names):
        ends = [end for q in wanted[c] for end in (max(q - SLACK, 0.0), min(q + SLACK, 1.0))]
        aggs += [F.count(F.col(c)).alias(f"n{i}"),
                 F.percentile_approx(F.col(c).cast("double"), F.array(*[F.lit(e) for e in ends]), F.lit(SKETCH_ACCURACY))
                 .alias(f"s{i}")]
    row = df.agg(*aggs).first()
    rows = {c: row[f"n{i}"] for i, c in enumerate(names)}
    return rows, {(c, q): tuple(row[f"s{i}"][2 * j:2 * j + 2]) for i, c in enumerate(names) if rows[c]
                  for j, q in enumerate(wanted[c])}


def settled_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], rows: Mapping[str, int],
                      sketched: Mapping[tuple[str, float], tuple[float, float]],
                      finish_values: int = FINISH_VALUES) -> dict[str, dict[float, Quantile]]:
    """The exact quantiles, given the counts and brackets of an earlier scan."""
    ranks: dict[str, list[int]] = {}
    brackets: dict[tuple[str, int], tuple[float, float]] = {}
    places: dict[str, dict[float, tuple[int, int, float]]] = {}
    for c, qs in wanted.items():
        if rows[c] == 0:
            continue
        for q in qs:
            position = q * (rows[c] - 1)
            low = math.floor(position)
            high = min(low + 1, rows[c] - 1)
            places.setdefault(c, {})[q] = (low, high, position - low)
            ranks.setdefault(c, []).extend((low, high))
            if (c, q) in sketched:
                brackets[c, low] = brackets[c, high] = sketched[c, q]
    values = order_statistics(df.select(*ranks), ranks, rows, finish_values, brackets)
    return {c: {q: Quantile(values[c, low], values[c, high], weight)
                for q, (low, high, weight) in per.items()}
            for c, per in places.items()}
