"""Run registered queries next to their SQL on DuckDB and compare rows.

usage: python tools/check_queries.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from corpusweave.plans.registry import load_all  # noqa: E402
from corpusweave.session import get_spark  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, int):
        return value
    return str(value)


def canonical(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def compare(spark, con, query, sf_dir) -> str:
    start = time.time()
    df = query.run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = f"spark {time.time() - start:.1f}s"
    if query.sql is None:
        return f"rows-only {len(rows)} {took}"
    result = con.execute(query.sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} against {sorted(names)}"
    got, want = canonical(df.columns, rows), canonical(names, expected)
    kinds = {
        n: (t.simpleString())
        for n, t in ((f.name, f.dataType) for f in df.schema.fields)
    }
    odd = {
        d[0]: (kinds[d[0]], str(d[1]))
        for d in result.description
        if not same_type(kinds[d[0]], str(d[1]))
    }
    note = f" TYPES {odd}" if odd else ""
    if got == want:
        return f"ok {len(got)} {took}{note}"
    bad = [(g, w) for g, w in zip(got, want) if g != w][:2]
    return f"FAIL rows {len(got)} against {len(want)}{note}\n     spark {bad and bad[0][0]}\n     sql   {bad and bad[0][1]}"


def same_type(spark_type: str, duck_type: str) -> bool:
    pairs = {
        "bigint": {"BIGINT", "NUMBER"}, "int": {"INTEGER", "NUMBER"}, "double": {"DOUBLE", "NUMBER"},
        "string": {"VARCHAR", "STRING"}, "boolean": {"BOOLEAN", "bool"}, "float": {"FLOAT", "NUMBER"},
        "binary": {"BLOB", "BINARY"}, "timestamp": {"TIMESTAMP"}, "timestamp_ntz": {"TIMESTAMP"},
    }
    return duck_type in pairs.get(spark_type, {duck_type})


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = get_spark("check"), connect(sf_dir)
    spark.conf.set("spark.sql.ui.explainMode", "formatted")
    failed = 0
    for name, query in load_all().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, query, sf_dir)
        except Exception as error:  # noqa: BLE001
            verdict = "FAIL " + (str(error)[:1500] or traceback.format_exc()[-1500:])
        failed += verdict.startswith("FAIL")
        print(f"{name:42s} {time.time() - start:6.1f}s {verdict}", flush=True)
    print("failed", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
