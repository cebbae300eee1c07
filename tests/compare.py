"""Run registered queries beside their SQL in DuckDB and compare all values."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def rows_of(frame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(r) for r in frame.astype(object).where(frame.notna(), None).itertuples(index=False)), key=repr)


def difference(spark_frame, sql_frame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} against {sorted(sql_frame.columns)}"
    left, right = rows_of(spark_frame), rows_of(sql_frame)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} against {b}"
    for name in spark_frame.columns:
        if spark_frame[name].dtype != sql_frame[name].dtype and not spark_frame[name].isna().any():
            return f"{name}: {spark_frame[name].dtype} against {sql_frame[name].dtype}"
    return None


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from __spark_entry__ import oracle_sql, queries
    from verbatlas.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = run(spark, folder).toPandas()
            spent = time.time() - start
            start = time.time()
            verdict = "rows only" if name not in sql else difference(got, con.execute(sql[name]).df()) or "ok"
            other = time.time() - start
        except Exception as error:  # noqa: BLE001
            got, spent, other, verdict = [], time.time() - start, 0.0, f"ERROR {str(error)[:600]}"
        bad += verdict not in ("ok", "rows only")
        print(f"{name:28s} {len(got):7d} rows {spent:7.2f}s sql {other:6.2f}s  {verdict}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
