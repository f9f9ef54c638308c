"""Run every registered query next to its SQL and report the differences.

usage: python tools/check_oracle.py [sf_dir] [query ...]
"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from assayline.session import local_session  # noqa: E402
from registry import ORACLES, QUERIES  # noqa: E402


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame.reindex(sorted(frame.columns), axis=1)
    rows = [
        tuple(None if v is None or v != v else v for v in row)
        for row in frame.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session("8", "check")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            types = dict(df.dtypes)
            mine = df.toPandas()
        except Exception as problem:  # noqa: BLE001
            print(f"FAIL {name}: {str(problem)[:1500]}", flush=True)
            bad += 1
            continue
        took = time.time() - start
        if name not in ORACLES:
            print(f"rows {name}: {len(mine)} {took:.1f}s", flush=True)
            continue
        try:
            relation = con.sql(ORACLES[name])
            other_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
            theirs = pd.DataFrame(relation.fetchall(), columns=relation.columns)
        except Exception as problem:  # noqa: BLE001
            print(f"SQL  {name}: {str(problem)[:1500]}", flush=True)
            bad += 1
            continue
        a, b = normal(mine), normal(theirs)
        if sorted(mine.columns) != sorted(theirs.columns):
            bad += 1
            print(f"COLS {name}: {sorted(mine.columns)} vs {sorted(theirs.columns)}", flush=True)
        elif a != b:
            bad += 1
            only_a = [r for r in a if r not in set(b)][:3]
            only_b = [r for r in b if r not in set(a)][:3]
            print(f"DIFF {name}: {len(a)} vs {len(b)}\n  {only_a}\n  {only_b}", flush=True)
            print("  ", types, other_types, flush=True)
        else:
            kinds = {c: (types[c], other_types[c]) for c in types}
            odd = {
                c: k for c, k in kinds.items()
                if k not in {
                    ("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"),
                    ("string", "VARCHAR"), ("boolean", "BOOLEAN"),
                }
            }
            print(f"ok   {name}: {len(a)} rows {took:.1f}s {odd or ''}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
