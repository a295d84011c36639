"""Run queries and their SQL side by side: python tools/check_queries.py FOLDER [NAME ...]"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pathkin.session import local_session
from pathkin.workload.oracles import ORACLES
from pathkin.workload.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def as_rows(frame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(rows.itertuples(index=False, name=None), key=repr)


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), connect(folder)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, folder).toPandas()
            middle = time.time()
            want = con.execute(ORACLES[name]).df()
            a, b = as_rows(got), as_rows(want)
            same = sorted(got.columns) == sorted(want.columns) and a == b
        except Exception as error:
            print(f"{name:30} ERROR {str(error)[:1500]}", flush=True)
            bad += 1
            continue
        times = f"spark {middle - start:6.2f}s sql {time.time() - middle:6.2f}s"
        print(f"{name:30} {'ok  ' if same else 'DIFF'} rows {len(a):8} {len(b):8} {times}", flush=True)
        types = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns if c in want}
        apart = {c: t for c, t in types.items() if t[0] != t[1]}
        if apart:
            print("   types", apart)
        if not same:
            bad += 1
            left, right = set(a), set(b)
            print("   only spark", list(left - right)[:3])
            print("   only sql  ", list(right - left)[:3])
    return bad


if __name__ == "__main__":
    sys.exit(main())
