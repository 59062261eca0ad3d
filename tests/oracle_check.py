"""Run registered queries in Spark and their oracle SQL in DuckDB and
compare row count, column names/types and the multiset of row values.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from gridlens.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK2DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
              "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
              "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
              "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(round(v, 6) + 0.0))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (4, repr(v))


def compare(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    stypes = [SPARK2DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields]
    if sql is None:
        return f"ROWS {key}: rows={len(srows)} (not compared, no SQL) spark={t1 - t0:.1f}s"
    rel = con.sql(sql)
    dcols = rel.columns
    dtypes = [str(t) for t in rel.types]
    drows = rel.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"cols spark={scols} duck={dcols}")
    else:
        smap = dict(zip(scols, stypes))
        dmap = dict(zip(dcols, dtypes))
        bad = {c: (smap[c], dmap[c]) for c in scols if smap[c] != dmap[c]}
        if bad:
            problems.append(f"types {bad}")
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        sset = sorted(tuple(_norm(r[i]) for i in si) for r in srows)
        dset = sorted(tuple(_norm(r[i]) for i in di) for r in drows)
        if len(sset) != len(dset):
            problems.append(f"rows spark={len(sset)} duck={len(dset)}")
        elif sset != dset:
            diff = [(a, b) for a, b in zip(sset, dset) if a != b]
            problems.append(f"values differ in {len(diff)} rows, e.g. {diff[:2]}")
    status = "OK " if not problems else "BAD"
    return f"{status} {key}: rows={len(srows)} spark={t1 - t0:.1f}s {'; '.join(problems)}"


def main():
    args = sys.argv[1:]
    plain = "--plain" in args
    no_aqe = "--no-aqe" in args
    args = [a for a in args if a not in ("--plain", "--no-aqe")]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    if plain:  # a bare session, as a caller without our defaults would have
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    elif no_aqe:  # static plans, many shuffle partitions (cluster-like)
        spark = get_session(master="local[8]", shuffle_partitions=200,
                            extra={"spark.sql.adaptive.enabled": "false"})
    else:
        spark = get_session(master="local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = compared = 0
    for k in (keys or list(qs)):
        try:
            line = compare(spark, con, sf_dir, k, qs[k], sqls.get(k))
        except Exception as exc:  # report and go on
            line = f"ERR {k}: {type(exc).__name__}: {str(exc)[:400]}"
        bad += line.startswith(("BAD", "ERR"))
        compared += line.startswith("OK")
        print(line, flush=True)
    print(f"done: {compared} equal, {bad} not, of {len(keys or qs)}; the others have no SQL")


if __name__ == "__main__":
    main()
