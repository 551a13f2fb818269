"""Run registered queries beside their SQL: ``python -m checks.compare sf_dir [name ...]``."""

from __future__ import annotations

import datetime
import sys
import time

import duckdb

from webglean.session import local_session

from .oracle import SQL
from .queries import REGISTERED

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _cell(value: object) -> str:
    if isinstance(value, float):
        return f"{value:.6f}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, db, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = REGISTERED[name](spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    answer = db.execute(SQL[name])
    names = [d[0] for d in answer.description]
    theirs = rows_of(names, answer.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            pairs = [(a[:200], b[:200]) for a, b in zip(mine, other) if a != b]
            return f"first difference {pairs}"
    return None


def main() -> None:
    sf_dir, chosen = sys.argv[1], sys.argv[2:] or sorted(REGISTERED)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    for name in chosen:
        started = time.time()
        try:
            problem = compare(spark, db, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)


if __name__ == "__main__":
    main()
