"""Run the registered queries beside their SQL and compare all rows.

``python tests/compare.py SF_DIR [QUERY ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def sql_rows(sf_dir: str, statement: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for table in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {table.stem} as select * from '{table}'")
    result = connection.execute(statement)
    return [column[0] for column in result.description], result.fetchall()


def _ordered(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    ordered = [tuple(row[i] for i in order) for row in rows]
    return sorted(ordered, key=lambda row: tuple((value is None, str(value)) for value in row))


def _same(left, right) -> bool:
    if isinstance(left, float) and isinstance(right, float):
        return left == right or (math.isnan(left) and math.isnan(right))
    return left == right and type(left) is type(right)


def difference(frame, sf_dir: str, statement: str) -> str | None:
    """None if the frame equals the SQL result, else what differs first."""
    names, rows = sql_rows(sf_dir, statement)
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    ours = _ordered(frame.columns, [tuple(row) for row in frame.collect()])
    theirs = _ordered(names, rows)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for mine, other in zip(ours, theirs, strict=True):
        if not all(map(_same, mine, other)):
            pairs = zip(sorted(names), mine, other, strict=True)
            return str([pair for pair in pairs if not _same(*pair[1:])])
    return None


def main() -> None:
    from conftest import local_session

    import __spark_entry__ as entry

    sf_dir, *chosen = sys.argv[1:]
    spark = local_session(8)
    oracle = entry.oracle_sql()
    failures = 0
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.perf_counter()
        frame = query(spark, sf_dir)
        if name in oracle:
            found = difference(frame, sf_dir, oracle[name])
            failures += found is not None
            state = "same" if found is None else f"DIFFERENT {found[:600]}"
        else:
            state = f"{frame.count()} rows"
        print(f"{name}: {state} ({time.perf_counter() - started:.2f} s)", flush=True)
    sys.exit(failures)


if __name__ == "__main__":
    main()
