"""Run registered queries and their SQL side by side.

``python -m orderdw.checks.compare DIR [name prefix ...] [--spread]``. With ``--spread`` nothing is
broadcast and no partitions are merged, so that the plans are those of a large cluster.
"""

from __future__ import annotations

import datetime
import decimal
import sys
import time

from orderdw.session import build_session, drop_stages

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def normal(v):
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, decimal.Decimal):
        return f"{v:f}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def duck(folder: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder, build, sql):
    df = build(spark, folder)
    got = df.collect()
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    rel = con.sql(sql)
    want = rel.fetchall()
    mine, theirs = rows_of(df.columns, got), rows_of(rel.columns, want)
    if sorted(df.columns) != sorted(rel.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(rel.columns)}"
    if mine != theirs:
        a, b = [r for r in mine if r not in set(theirs)], [r for r in theirs if r not in set(mine)]
        return False, f"{len(mine)} / {len(theirs)} rows, e.g. {a[:2]} / {b[:2]}"
    kinds = [(c, t, str(k)) for (c, t), k in zip(sorted(df.dtypes), [
        rel.types[i] for i in sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])])]
    return True, f"{len(mine)} rows {kinds}"


def main(folder: str, only: list[str]) -> int:
    from orderdw.checks import ORACLE, QUERIES
    spread = {"spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    settings = spread if "--spread" in only else {}
    only = [o for o in only if o != "--spread"]
    spark = build_session("compare", master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="8g", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name, build in QUERIES.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        started = time.time()
        try:
            ok, told = compare(spark, con, folder, build, ORACLE.get(name))
        except Exception as e:  # keep going: the list of all failures is what is wanted
            ok, told = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name} {time.time() - started:.1f}s {told}", flush=True)
    drop_stages(spark)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
