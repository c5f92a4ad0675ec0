"""Compare catalogue queries with their SQL in DuckDB."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(df, con, sql: str) -> str | None:
    """What differs between a DataFrame and a query, or None."""
    relation = con.sql(sql)
    names = sorted(df.columns)
    if sorted(relation.columns) != names:
        return f"columns {names} and {sorted(relation.columns)}"
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    duck_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    same = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
            "double": "DOUBLE"}
    for n in names:
        if same.get(spark_types[n]) != duck_types[n]:
            return f"type of {n}: {spark_types[n]} and {duck_types[n]}"
    ours = Counter(tuple(row[n] for n in names) for row in df.collect())
    order = [relation.columns.index(n) for n in names]
    theirs = Counter(tuple(row[i] for i in order) for row in relation.fetchall())
    if ours == theirs:
        return None
    extra, missing = ours - theirs, theirs - ours
    return (f"{sum(ours.values())} and {sum(theirs.values())} rows; only Spark: "
            f"{list(extra.items())[:3]}; only SQL: {list(missing.items())[:3]}")


def main() -> int:
    """``compare.py SF_DIR [name part]``: report every query."""
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as spark_entry
    from quadspark.session import build_session

    sf_dir = sys.argv[1]
    part = sys.argv[2] if len(sys.argv) > 2 else ""
    spark = build_session(8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    con = connect(sf_dir)
    sql = spark_entry.oracle_sql()
    failed = 0
    for name, fn in spark_entry.queries().items():
        if part not in name:
            continue
        started = time.time()
        try:
            df = fn(spark, sf_dir)
            result = difference(df, con, sql[name]) if name in sql else f"rows only: {len(df.collect())}"
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        ok = result is None or result.startswith("rows only")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.2f}s {result or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
