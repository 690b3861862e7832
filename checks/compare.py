"""Run checks against the oracle engine: python -m checks.compare [folder] [name-prefix ...]"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
         "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None and v == v else 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(df, con, sql: str) -> list[str]:
    problems = []
    names = sorted(df.columns)
    got_types = dict(df.dtypes)
    result = con.sql(sql)
    want_types = dict(zip(result.columns, map(str, result.types)))
    if names != sorted(want_types):
        return [f"columns {names} / {sorted(want_types)}"]
    for n in names:
        if TYPES.get(got_types[n], got_types[n]) != want_types[n]:
            problems.append(f"type {n}: {got_types[n]} / {want_types[n]}")
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_sort_key)
    at = [result.columns.index(n) for n in names]
    want = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=_sort_key)
    if len(got) != len(want):
        return [*problems, f"rows {len(got)} / {len(want)}"]
    diffs = [(g, w) for g, w in zip(got, want) if not all(map(_same, g, w))]
    if diffs:
        problems.append(f"{len(diffs)} of {len(got)} rows differ in {names}, e.g. {diffs[0]}")
    return problems or ([] if got else ["no rows"])


def main(argv: list[str]) -> int:
    from checks import load_all
    from creditloom.session import build_session
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:])
    queries, oracles = load_all()
    spark = build_session("checks", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, fn in queries.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            built = time.time() - start
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                n = len(df.collect())
                problems = [] if n else ["no rows"]
        except Exception as error:  # a report must go on to the next check
            problems, built = [f"{type(error).__name__}: {str(error)[:700]}"], 0
        bad += bool(problems)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {name:36s} {time.time() - start:6.1f}s "
              f"(plan {built:.1f}s) {'; '.join(problems)}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
