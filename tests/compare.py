"""Run queries and their SQL side by side:  python tests/compare.py [names...] [--sf DIR]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if type(value).__name__ == "Decimal":
        return float(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(
        plain, key=lambda r: [(x is None, type(x).__name__ if not isinstance(x, (int, float)) else "n", x if x is not None else 0) for x in r]
    )


def differences(spark_df, con, sql: str, tolerance: float = 0.0) -> list[str]:
    """What differs, empty when both results hold the same rows."""
    left_names, left = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    right_names, right = _rows([c[0] for c in result.description], result.fetchall())
    if left_names != right_names:
        return [f"columns {left_names} / {right_names}"]
    if len(left) != len(right):
        return [f"rows {len(left)} / {len(right)}", str(left[:2]), str(right[:2])]
    found = []
    for a, b in zip(left, right):
        for name, x, y in zip(left_names, a, b):
            same = x == y or (
                isinstance(x, float) and isinstance(y, (int, float))
                and abs(x - y) <= tolerance * max(1.0, abs(x))
            )
            if not same or (x is not None and type(x) is not type(y)):
                found.append(f"{name}: {x!r} / {y!r} in {a}")
                break
    return found


def main(argv: list[str]) -> int:
    from ledgerloom.session import build_session

    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    if "--sf" in argv:
        at = argv.index("--sf")
        sf = argv[at + 1]
        del argv[at : at + 2]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = connect(sf), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv or list(queries):
        start = time.time()
        try:
            if name in oracles:
                found = differences(queries[name](spark, sf), con, oracles[name])
            else:
                n = queries[name](spark, sf).count()
                found = [] if n else ["no rows"]
                name += f" [rows {n}]"
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        if found:
            print(f"     {len(found)} differences")
            for line in found[:3]:
                print("     ", line[:1200], flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
