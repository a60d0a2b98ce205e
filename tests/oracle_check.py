"""Run registered queries against DuckDB: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    cols = sorted(frame.columns)

    def cell(v):
        if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and getattr(v, "ndim", 0):
            return str([cell(x) for x in v])
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "~"
        if isinstance(v, float):
            return repr(round(v + 0.0, 9))
        if hasattr(v, "item"):
            return cell(v.item())
        return str(v).removesuffix(" 00:00:00")

    return sorted(tuple(cell(v) for v in row) for row in frame[cols].astype(object).itertuples(index=False, name=None))


_SAME = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT"}


def compare(spark_df, con, sql: str) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    left = pd.DataFrame([r.asDict() for r in spark_df.collect()], columns=spark_df.columns, dtype=object)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    right = pd.DataFrame(cur.fetchall(), columns=names, dtype=object)
    types = {n: str(d[1]) for n, d in zip(names, cur.description)}
    if sorted(left.columns) != sorted(names):
        return f"columns differ: {sorted(left.columns)} / {sorted(names)}"
    off = [f"{c}:{kinds[c]}/{types[c]}" for c in names if _SAME.get(kinds[c]) and _SAME[kinds[c]] != types[c]]
    a, b = canonical(left), canonical(right)
    if a == b:
        return "ok" if not off else "ok, types " + " ".join(off)
    only_a = [x for x in a if x not in set(b)][:2]
    only_b = [x for x in b if x not in set(a)][:2]
    return f"values differ ({len(a)}/{len(b)} rows): spark {only_a} sql {only_b} {off}"


def main() -> int:
    import __spark_entry__ as contract
    from millrace.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(8, 8)
    con = connect(folder)
    queries, sqls = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in chosen or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sqls:
                verdict = compare(df, con, sqls[name])
            else:
                verdict = f"rows only: {len(df.collect())}"
        except Exception as exc:  # report and go on with the next query
            verdict = f"FAILED {type(exc).__name__}: {str(exc)[:600]}"
        if not verdict.startswith(("ok", "rows only")):
            bad += 1
        print(f"{name:28s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
