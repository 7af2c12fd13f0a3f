"""Run every query on Spark and its text on DuckDB, and compare the rows.

    python -m checks.compare [folder] [query ...]
"""

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

from checks.duckdb_sql import ORACLE


def connect(folder):
    db = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def difference(df, db, text):
    """None if both sides give the same columns, types and rows, else a short description."""
    result = db.execute(text)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(set(columns) ^ set(df.columns))}"
    expected_types = {d[0]: str(d[1]).upper() for d in result.description}
    types = {c: TYPES.get(t, t.upper()) for c, t in df.dtypes}
    if types != expected_types:
        return f"types {[(c, types[c], expected_types[c]) for c in types if types[c] != expected_types[c]]}"
    expected = rows_of(columns, result.fetchall())
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(expected) != len(found):
        return f"rows {len(found)} instead of {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(folder="/root/testdata/sf0.01", *names):
    from auditloom.plans.catalogue import QUERIES
    from auditloom.session import build_session
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLE:
                state = difference(df, db, ORACLE[name])
            else:
                state = f"unchecked, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            state = "ERROR " + str(error).split("\n")[0][:400]
        bad += state is not None and not state.startswith("unchecked")
        print(f"{name:32s} {time.time() - started:6.2f}s  {state or 'ok'}", flush=True)
    print("queries without a text:", sorted(set(QUERIES) - set(ORACLE)))
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
