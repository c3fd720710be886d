"""Compare a registered query with its DuckDB twin on the given tables."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    return str(value)


def _kind(data_type: str) -> str:
    data_type = data_type.lower().replace(" ", "")
    names = {
        "bigint": "int64", "int": "int32", "integer": "int32", "string": "text",
        "varchar": "text", "timestamp_ntz": "timestamp",
    }
    return names.get(data_type, data_type)


def differences(spark_rows, spark_types, duck) -> list[str]:
    """Human-readable differences in columns, types and values, row order aside."""
    names = [c[0] for c in duck.description]
    types = {c[0]: _kind(str(c[1])) for c in duck.description}
    mine = {n: _kind(t) for n, t in spark_types}
    if sorted(names) != sorted(mine):
        return [f"columns {sorted(mine)} != {sorted(names)}"]
    found = [f"type of {n}: {mine[n]} != {types[n]}" for n in sorted(mine) if mine[n] != types[n]]
    order = sorted(names)
    left = sorted(tuple(_cell(r[n]) for n in order) for r in spark_rows)
    picks = [names.index(n) for n in order]
    right = sorted(tuple(_cell(r[i]) for i in picks) for r in duck.fetchall())
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [f"{n}: {x} != {y}" for n, x, y in zip(order, a, b) if x != y]
        found.append(f"{len(wrong)} rows differ, first: {cells}")
    return found


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tillgrain.session import build_session

    spark = build_session(
        master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1]
    con, sql = connection(folder), entry.oracle_sql()
    for name, build in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            rows = df.collect()
            took = time.time() - start
            if name not in sql:
                print(f"rows {name} {len(rows)} {took:.1f}s", flush=True)
                continue
            found = differences(rows, df.dtypes, con.sql(sql[name]))
            print("OK  " if not found else "DIFF", name, len(rows), f"{took:.1f}s", *found, flush=True)
        except Exception as error:
            print("FAIL", name, str(error)[:1500], flush=True)
