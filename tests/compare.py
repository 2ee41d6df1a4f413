"""Run queries and their DuckDB statements side by side and compare results.

    python -m tests.compare [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

SPARK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Problems found, none if the results agree in names, types and values."""
    cursor = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    ours = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema}
    problems = []
    if ours != theirs:
        problems.append(f"columns {set(ours.items()) ^ set(theirs.items())}")
        if set(ours) != set(theirs):
            return problems
    names = sorted(ours)
    order = [list(theirs).index(n) for n in names]
    right = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_key)
    left = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} vs {len(right)}")
    for a, b in zip(left, right):
        if not all(_same(x, y) for x, y in zip(a, b)):
            diff = [(n, x, y) for n, x, y in zip(names, a, b) if not _same(x, y)]
            problems.append(f"values {str(diff)[:600]}")
            break
    return problems


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from pulseboard.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        begin = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                problems = differences(df, con, sql[name])
                rows = len(con.execute(sql[name]).fetchall())
            else:
                problems, rows = [], df.count()
        except Exception as error:  # report and go on with the next query
            problems, rows = [f"{type(error).__name__}: {str(error)[:700]}"], 0
        failed += bool(problems)
        mark = "FAIL" if problems else "ok" if name in sql else "rows only"
        print(f"{name:28s} {mark} rows={rows} {time.time() - begin:.1f}s", *problems,
              sep="\n    " if problems else " ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
