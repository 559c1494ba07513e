"""Run registered queries against their SQL on the same tables and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows sorted; floats are compared exactly, -0.0 as 0.0."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    names, got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    wanted_names, wanted = canonical([c[0] for c in cursor.description], cursor.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if got == wanted:
        return None
    only_got = sorted(set(got) - set(wanted))[:2]
    only_wanted = sorted(set(wanted) - set(got))[:2]
    return f"rows {len(got)} vs {len(wanted)}; only spark {only_got}; only sql {only_wanted}"


def main(folder: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from yieldstone.session import build_session

    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failures = oracle_connection(folder), 0
    sql = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            found = difference(run(spark, folder), con, sql[name]) if name in sql else "no sql"
        except Exception as err:  # report and go on with the next query
            found = f"{type(err).__name__}: {str(err)[:600]}"
        failures += found is not None
        print(f"{name:40s} {time.time() - began:6.1f}s {found or 'ok'}", flush=True)
    print("failures", failures)
    return failures


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
