"""Run registered queries against their twins: python tools/compare.py [folder] [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cauce.queries import QUERIES, TWINS  # noqa: E402
from cauce.session import build_session  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, in a reproducible order; floats exactly as they are."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark, con, folder: str, name: str) -> str:
    """Empty when both engines agree exactly on column names, value types and rows."""
    df = QUERIES[name](spark, folder)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name not in TWINS:
        return "" if got else "no rows"
    result = con.execute(TWINS[name])
    columns = [d[0] for d in result.description]
    want = canonical(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for g, w in zip(got, want):
        for column, a, b in zip(sorted(columns), g, w):
            if a != b or (type(a) is not type(b) and {type(a), type(b)} != {int, float}):
                return f"{column}: {a!r} / {b!r} in {g}"
    return "" if got else "both empty"


def main() -> None:
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in args or QUERIES:
        start = time.time()
        try:
            problem = differences(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        kind = "" if name in TWINS else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{kind} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{failed} failed")
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
