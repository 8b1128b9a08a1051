"""Compare large answers with their DuckDB oracle by aggregate fingerprint
(row count, sum of every column, a mixed sum) instead of collecting rows.

    python tools/check_fingerprint.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

import duckdb
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LARGE = {"relation_pairs": ["a", "b", "tag", "n"], "common_friend_weight": ["a", "b", "weight"]}


def main():
    from roadlens.registry import ORACLE_SQL, QUERIES
    from roadlens.session import build_session
    from tools.check_oracle import TABLES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, cols in LARGE.items():
        mix_s = (F.col("a") * 31 + F.col("b") * 17 + F.col(cols[-1])).cast("decimal(38,0)")
        s = QUERIES[name](spark, sf).agg(
            F.count(F.lit(1)), *[F.sum(F.col(c).cast("decimal(38,0)")) for c in cols], F.sum(mix_s)).first()
        sums = ", ".join(f"sum(CAST({c} AS HUGEINT))" for c in cols)
        mix_d = f"sum(CAST(a AS HUGEINT) * 31 + CAST(b AS HUGEINT) * 17 + {cols[-1]})"
        d = con.execute(f"SELECT count(*), {sums}, {mix_d} FROM ({ORACLE_SQL[name]})").fetchone()
        ok = [int(x) for x in s] == [int(x) for x in d]
        bad += not ok
        print(name, "OK" if ok else "BAD", [int(x) for x in s], [int(x) for x in d])
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
