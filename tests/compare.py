"""Run registered queries against DuckDB: ``python tests/compare.py SF_DIR [name …]``."""

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations""".split()


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(df, con, sql: str) -> str:
    """Empty when both results hold the same names and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    actual = rows_of(df.columns, df.collect())
    if not expected:
        return "no rows expected"
    if actual == expected:
        return ""
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(actual.values())} rows for {sum(expected.values())}; "
        f"missing {list(missing)[:2]} extra {list(extra)[:2]}"
    )


def main() -> None:
    import __spark_entry__ as entry
    from tests.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in wanted or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else ""
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
