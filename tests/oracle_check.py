"""Run registered queries in Spark and their SQL in DuckDB, and compare all values.

    python tests/oracle_check.py [sf_dir] [query …]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def _sortable(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def _tie(actual, expected) -> bool:
    """Rounded numbers may differ by one in their last digit where the exact value lies half-way."""
    return all(
        a == e or (isinstance(a, float) and isinstance(e, float) and abs(a - e) <= 1.0001e-6)
        for a, e in zip(actual, expected)
    )


def compare(frame, con, sql: str) -> str:
    """Empty if equal, else what differs."""
    names = sorted(frame.columns)
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    if sorted(described) != names:
        return f"columns {names} != {sorted(described)}"
    types = dict(frame.dtypes)
    wrong = {n: (types[n], described[n]) for n in names if TYPES.get(types[n]) != described[n]}
    if wrong:
        return f"types {wrong}"
    order = [d[0] for d in result.description]
    expected = sorted(
        (tuple(_cell(row[order.index(n)]) for n in names) for row in result.fetchall()), key=_sortable
    )
    actual = sorted((tuple(_cell(row[n]) for n in names) for row in frame.select(*[f"`{n}`" for n in names]).collect()), key=_sortable)
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e or str(a) != str(e)]
    ties = [pair for pair in bad if _tie(*pair)]
    if ties:
        print(f"     {len(ties)} rows differ by a rounding tie in the last digit", flush=True)
    bad = [pair for pair in bad if not _tie(*pair)]
    if bad:
        return f"{len(bad)} of {len(actual)} rows differ, first {dict(zip(names, bad[0][0]))} != {dict(zip(names, bad[0][1]))}"
    return ""


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tideline.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = local_session("oracle-check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    failures = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in oracles:
                problem = compare(frame, con, oracles[name])
                rows = "oracle"
            else:
                problem, rows = "", f"{len(frame.collect())} rows, no oracle"
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", ""
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {time.time() - started:6.1f}s {rows} {problem}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
