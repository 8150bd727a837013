"""Run registered queries against their SQL: `python -m workload.verify [sf] [name ...]`."""

from __future__ import annotations

import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def plain(v):
        if isinstance(v, float):
            return round(v, 6)
        if isinstance(v, (list, tuple)):
            return tuple(plain(x) for x in v)
        return v
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr), [columns[i] for i in order]


def main(argv):
    import duckdb

    from placeledger.session import build_session
    from workload.catalog import ORACLES, QUERIES

    sf = argv[0] if argv else "0.01"
    names = argv[1:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    spark = build_session("verify", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = []
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            got, cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
            spent = time.time() - t0
            if name not in ORACLES:
                print(f"{name:26s} {spent:6.2f}s rows={len(got)} (no SQL)", flush=True)
                continue
            res = con.execute(ORACLES[name])
            want, wcols = rows_of([d[0] for d in res.description], res.fetchall())
            ok = got == want and cols == wcols
            print(f"{name:26s} {spent:6.2f}s rows={len(got)} {'ok' if ok else 'DIFFERENT'}", flush=True)
            if not ok:
                bad.append(name)
                print("   cols", cols, wcols, "n", len(got), len(want))
                only_got = [r for r in got if r not in set(want)][:2]
                only_want = [r for r in want if r not in set(got)][:2]
                print("   got ", only_got, "\n   want", only_want)
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"{name:26s} FAILED {type(e).__name__}: {str(e)[:700]}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
