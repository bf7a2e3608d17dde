"""Run queries and their SQL counterparts side by side: ``python tests/compare.py SF [name ...]``."""

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(df):
    """Rows as sorted text, columns in name order; floats rounded."""
    df = df[sorted(df.columns)]

    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return "<null>"
        if isinstance(v, float):
            return str(int(v)) if v == int(v) else f"{v:.9g}"
        return str(v)

    rows = [tuple(text(v) for v in row) for row in df.astype(object).itertuples(index=False)]
    return sorted(rows)


def kinds(schema):
    """Coarse type per column, for comparing schemas across engines."""
    families = {
        "int": "int", "bigint": "int", "smallint": "int", "integer": "int", "hugeint": "hugeint",
        "string": "text", "varchar": "text", "double": "float", "float": "float", "boolean": "bool", "date": "date",
    }
    return {name: families.get(str(kind).lower(), str(kind).lower()) for name, kind in schema}


def difference(spark, con, name, query, sql, sf_dir):
    """None when both engines agree, else what differs."""
    df = query(spark, sf_dir)
    ours_schema = kinds(df.dtypes)
    result = con.sql(sql)
    theirs_schema = kinds(zip(result.columns, result.types))
    if ours_schema != theirs_schema:
        diff = {c: (ours_schema.get(c), theirs_schema.get(c)) for c in {**ours_schema, **theirs_schema}}
        return f"schema {({c: d for c, d in diff.items() if d[0] != d[1]})}"
    ours = canonical(pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns))
    theirs = canonical(pd.DataFrame(result.fetchall(), columns=result.columns))
    if ours != theirs:
        a, b = set(ours), set(theirs)
        return (
            f"rows {len(ours)} / {len(theirs)}; only ours {len(a - b)}: {sorted(a - b)[:2]}; "
            f"only theirs {len(b - a)}: {sorted(b - a)[:2]}"
        )
    return None


def main():
    import __spark_entry__ as entry
    from jobsieve.session import get_session

    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{DATA}/sf{sys.argv[1]}"
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            diff = difference(spark, con, name, queries[name], oracle[name], sf_dir) if name in oracle else "no sql"
        except Exception as e:  # report and go on
            diff = f"{type(e).__name__}: {str(e)[:700]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.1f}s {str(diff or '')[:900]}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree; without sql: {sorted(set(queries) - set(oracle))}")


if __name__ == "__main__":
    main()
