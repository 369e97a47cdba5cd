"""Run registered queries beside their reference SQL and report differences.

    python tests/oracle_check.py [name-prefix ...]     (CHECK_SF_DIR picks the data)
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def normal_form(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(float)
        elif pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].dt.strftime("%Y-%m-%d")
        elif df[c].dtype == object:
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT else
                              (v if isinstance(v, (float, bool)) else str(v)[:10]
                               if hasattr(v, "isoformat") else str(v)))
    texts = [c for c in df.columns if not pd.api.types.is_float_dtype(df[c])]
    whole = [c for c in df.columns if c not in texts and (df[c].dropna() % 1 == 0).all()]
    rest = [c for c in df.columns if c not in texts and c not in whole]
    return df.sort_values(texts + whole + rest, na_position="first").reset_index(drop=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame, tol: float = 1e-12) -> list[str]:
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}"]
    a, b = normal_form(ours), normal_form(theirs)
    out = []
    for c in a.columns:
        x, y = a[c], b[c]
        if pd.api.types.is_numeric_dtype(x) and pd.api.types.is_numeric_dtype(y):
            fx, fy = x.astype(float), y.astype(float)
            bad = ~((fx == fy) | (fx.isna() & fy.isna())
                    | ((fx - fy).abs() <= tol * fy.abs().clip(lower=1e-30)))
        else:
            bad = ~((x.astype(str) == y.astype(str)) | (x.isna() & y.isna()))
        if bad.any():
            i = bad.idxmax()
            out.append(f"{c}: {int(bad.sum())} differ, first {x[i]!r} != {y[i]!r}")
    return out


def oracle_frame(text: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute("set threads to 8")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    try:
        return con.execute(text).df()
    finally:
        con.close()


def main(prefixes: list[str]) -> int:
    from tests.session import local_session

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    queries, oracles = entry.queries(), entry.oracle_sql()
    wrong = 0
    for name, fn in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        started = time.time()
        try:
            ours = fn(spark, sf_dir).toPandas()
            took = time.time() - started
            if name not in oracles:
                print(f"rows-only {name}: {len(ours)} rows {took:.1f}s", flush=True)
                continue
            started = time.time()
            theirs = oracle_frame(oracles[name], sf_dir)
            problems = differences(ours, theirs)
            print(f"{'DIFF ' if problems else 'ok   '} {name}: {len(ours)} rows "
                  f"{took:.1f}s sql {time.time() - started:.1f}s {'; '.join(problems)}", flush=True)
            wrong += bool(problems)
        except Exception as error:
            wrong += 1
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:600]}", flush=True)
    print(f"{wrong} wrong")
    return wrong


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
