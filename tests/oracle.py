"""Compare registered queries with their SQL twins in DuckDB.

    python -m tests.oracle [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, plain values, rows sorted."""
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        values = frame[c]
        if pd.api.types.is_float_dtype(values) or pd.api.types.is_integer_dtype(values):
            frame[c] = values.astype("float64")
        elif pd.api.types.is_bool_dtype(values):
            frame[c] = values.astype("float64")
        elif pd.api.types.is_datetime64_any_dtype(values):
            frame[c] = values.astype("datetime64[us]").astype("int64").astype("float64")
        else:
            frame[c] = [None if v is None or v != v else v if isinstance(v, (int, float)) else str(v) for v in values]
    return frame.sort_values(list(frame.columns), na_position="first", key=lambda s: s.map(repr)
                             if s.dtype == object else s).reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} rows != {len(sql_frame)} rows"
    a, b = canonical(spark_frame), canonical(sql_frame)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"{(~same).sum()} rows differ in {c}, e.g. {a.loc[i].to_dict()} != {b.loc[i].to_dict()}"
    return None


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def type_difference(df, relation) -> str | None:
    """Columns whose types do not correspond."""
    sql = dict(zip(relation.columns, map(str, relation.types)))
    odd = {c: (kind, sql.get(c)) for c, kind in df.dtypes if KINDS.get(kind) != sql.get(c)}
    return f"types {odd}" if odd else None


def check(spark, con, name: str, sf_dir: str, queries, oracles) -> tuple[str, float, float]:
    start = time.time()
    df = queries[name](spark, sf_dir)
    got = df.toPandas()
    spent = time.time() - start
    if name not in oracles:
        return ("rows only: %d" % len(got) if len(got) else "EMPTY"), spent, 0.0
    start = time.time()
    relation = con.sql(oracles[name])
    verdict = difference(got, relation.df()) or type_difference(df, relation) or f"ok {len(got)}"
    return verdict, spent, time.time() - start


def main() -> None:
    from veristar.plans.catalog import ORACLES, QUERIES
    from veristar.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        try:
            verdict, a, b = check(spark, con, name, sf_dir, QUERIES, ORACLES)
        except Exception as error:
            verdict, a, b = "ERROR " + "".join(traceback.format_exception_only(error))[:1500], 0.0, 0.0
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:26s} {a:6.2f}s {b:6.2f}s  {verdict[:900]}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
