"""Compare every registered query with its SQL: python tests/check_oracle.py SF_DIR [NAME ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from ratewell.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def canonical(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return None
        return repr(float(value)) if isinstance(value, float) else str(value)

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, sf_dir: str, name: str) -> str:
    """'' if both sides agree, else what differs."""
    df = queries()[name](spark, sf_dir)
    ours = canonical([tuple(r) for r in df.collect()], df.columns)
    relation = connection.sql(oracle_sql()[name])
    theirs = canonical(relation.fetchall(), relation.columns)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} vs {sorted(relation.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}" if wrong else ""


if __name__ == "__main__":
    sf = sys.argv[1]
    session = local_session()
    db = duck(sf)
    for query in sys.argv[2:] or queries():
        started = time.time()
        try:
            problem = compare(session, db, sf, query) if query in oracle_sql() else "no SQL"
        except Exception as e:  # report every query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{query:28s} {time.time() - started:6.1f}s {problem or 'ok'}", flush=True)
