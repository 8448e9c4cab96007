"""Compare registered queries with their SQL twins: ``python tests/oracle_check.py [names]``."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    return repr(value) if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


# Types that stand for each other.
_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def compare(spark, con, name, query, sql, sf_dir) -> str | None:
    """``None`` when equal, else what differs."""
    frame = query(spark, sf_dir)
    left_cols, left = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    right_cols, right = rows_of([d[0] for d in result.description], result.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    for field in frame.schema:
        want = _TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if types[field.name] != want:
            return f"type of {field.name}: {want} != {types[field.name]}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        return f"{len(different)} of {len(left)} rows differ, e.g. {different[0]}"
    if not left:
        return "no rows"
    return None


def main(names: list[str]) -> int:
    import __spark_entry__ as entry
    from tonescape.session import build_session

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions=8,
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, name, query, oracle[name], sf_dir)
            else:
                n = len(query(spark, sf_dir).collect())
                problem = None if n else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        kind = "sql" if name in oracle else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} [{kind}] "
              f"{time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
