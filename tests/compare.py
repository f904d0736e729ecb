"""Runs registered queries next to their SQL in DuckDB; also usable as a script.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows: list, columns: list[str]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr([_plain(row[i]) for i in order]) for row in rows)
    return [columns[i] for i in order], lines


def _plain(value):
    if isinstance(value, float):
        return repr(round(value, 9))
    return f"{type(value).__name__}:{value}" if value is not None else None


def digest(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:12]


def compare(spark, con, name, query, sql, sf_dir) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    got_columns, got = canonical(rows, df.columns)
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want_columns, want = canonical(cursor.fetchall(), columns)
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    if got != want:
        extra = [x for x in got if x not in set(want)][:2]
        lost = [x for x in want if x not in set(got)][:2]
        return False, f"{len(got)} rows vs {len(want)}; only here {extra}; only there {lost}"
    return True, f"{len(got)} rows {digest(got)}"


def main() -> int:
    sys.path.insert(0, ROOT)
    from tests.conftest import build_session

    import __spark_entry__ as registry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = build_session(), connect(sf_dir)
    oracle, failed = registry.oracle_sql(), 0
    chosen = sys.argv[2:] or list(registry.queries())
    for name in chosen:
        start = time.time()
        try:
            ok, note = compare(
                spark, con, name, registry.queries()[name], oracle.get(name), sf_dir
            )
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34} {time.time() - start:6.2f}s  {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
