"""Run registered queries next to their SQL oracles: ``python tests/compare.py <sf_dir> [query ...] [spark setting=value ...]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, types and rows; empty when all agree."""
    problems = []
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field, kind in df.dtypes:
        if SPARK_TO_DUCK.get(kind, kind) != types[field]:
            problems.append(f"type of {field}: {kind} != {types[field]}")
    order = sorted(names)
    want = Counter(tuple(_plain(row[names.index(c)]) for c in order) for row in result.fetchall())
    got = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    if want != got:
        extra, missing = got - want, want - got
        problems.append(
            f"rows {sum(got.values())} vs {sum(want.values())}; only spark {list(extra)[:2]}; only oracle {list(missing)[:2]}"
        )
    return problems


def main() -> int:
    import __spark_entry__ as driver
    from plumbline.session import local_session

    sf_dir = sys.argv[1]
    wanted = [a for a in sys.argv[2:] if "=" not in a]
    conf = dict(a.split("=", 1) for a in sys.argv[2:] if "=" in a)
    spark, con = local_session(**conf), duck(sf_dir)
    oracles, failed = driver.oracle_sql(), []
    for name, query in driver.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problems = compare(df, con, oracles[name]) if name in oracles else [f"no oracle, rows {df.count()}"]
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        if problems:
            failed.append(name)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", *problems, sep="\n     ", flush=True)
    print(f"{len(failed)} failed: {failed}")
    spark.stop()
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
