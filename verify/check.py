"""Compare every registered query with its SQL: ``python -m verify.check [folder] [name prefix ...]``."""

from __future__ import annotations

import math
import sys
import time
import warnings


def normalised(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return value + 0.0
    return value


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    result = [tuple(normalised(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(result, key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


def compare(spark, connection, case, folder):
    """None when equal (or without SQL), otherwise a description of the difference."""
    frame = case.build(spark, folder)
    got = rows_by_name(frame.columns, [tuple(r) for r in frame.collect()])
    if case.sql is None:
        return None, len(got[1])
    answer = connection.execute(case.sql)
    want = rows_by_name([d[0] for d in answer.description], answer.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1])
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, expected {len(want[1])}", len(got[1])
    wrong = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got[1])} rows differ, first: {wrong[0][0]} != {wrong[0][1]}", len(got[1])
    if got[1]:
        for name, a, b in zip(got[0], got[1][0], want[1][0]):
            if type(a) is not type(b):
                return f"type of {name}: {type(a)} != {type(b)}", len(got[1])
    return None, len(got[1])


def connect(folder):
    import duckdb

    connection = duckdb.connect()
    for name in (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
        "labels conversations"
    ).split():
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def main(folder="/root/testdata/sf0.01", *parts):
    from verify.registry import CASES as all_cases
    from verify.session import local_session

    warnings.simplefilter("ignore")
    spark, connection = local_session(), connect(folder)
    bad = 0
    chosen = [c for c in all_cases if not parts or c.name.startswith(parts)]
    for case in chosen:
        started = time.time()
        try:
            problem, rows = compare(spark, connection, case, folder)
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:700]}", -1
        bad += problem is not None
        mark = "FAIL" if problem else "ok" if case.sql else "ok (rows only)"
        if problem or rows == 0 or time.time() - started > 3 or case.sql is None:
            print(f"{mark:15s} {case.name:40s} {rows:7d} rows {time.time() - started:6.2f}s  {problem or ''}", flush=True)
    print(f"{len(chosen)} cases, {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
