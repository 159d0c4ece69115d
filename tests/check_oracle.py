"""Run registered queries against their SQL counterparts in DuckDB.

    python tests/check_oracle.py [data folder] [query ...]
"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from folioscope.plans.oracle import ORACLE  # noqa: E402
from folioscope.plans.registry import QUERIES  # noqa: E402
from folioscope.session import build_session  # noqa: E402


def canonical(rows) -> list[tuple]:
    return sorted((tuple(map(str, row)) for row in rows))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, folder: str, key: str) -> tuple[bool, str]:
    """Whether names, types and values of a query agree with its SQL, and a note."""
    result = QUERIES[key](spark, folder)
    columns = sorted(result.columns)
    table = result.select(*columns).toArrow()
    if key not in ORACLE:
        return True, f"rows only: {table.num_rows}"
    expected = con.sql(ORACLE[key])
    if sorted(expected.columns) != columns:
        return False, f"columns {columns} != {sorted(expected.columns)}"
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = con.sql(f"SELECT {quoted} FROM ({ORACLE[key]}) q").to_arrow_table()
    types = [str(t).replace("large_", "") for t in table.schema.types]
    wanted = [str(t).replace("large_", "") for t in expected.schema.types]
    got_rows = canonical(zip(*[c.to_pylist() for c in table.columns], strict=True))
    want_rows = canonical(zip(*[c.to_pylist() for c in expected.columns], strict=True))
    if got_rows != want_rows:
        off = [pair for pair in zip(got_rows, want_rows, strict=False) if pair[0] != pair[1]][:2]
        return False, f"{len(got_rows)} vs {len(want_rows)} rows, first differences {str(off)[:900]}"
    if types != wanted:
        return False, f"types {types} != {wanted}"
    return True, f"{len(got_rows)} rows"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for key in keys:
        begin = time.perf_counter()
        try:
            good, note = compare(spark, con, folder, key)
        except Exception as error:  # report and go on with the other queries
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {key:28s} {time.perf_counter() - begin:6.2f}s  {note}", flush=True)
    print(f"{len(keys) - failed} of {len(keys)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
