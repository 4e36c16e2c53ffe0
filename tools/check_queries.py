"""Run registered queries beside their SQL twins and report differences.

python tools/check_queries.py [--sf 0.01] [name-part ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tidemark.queries.all import REGISTRY  # noqa: E402
from tidemark.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def plain(value):
    """A comparable form; numbers keep their kind so that type slips show."""
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return f"dec:{value}"
    if isinstance(value, int):
        return f"int:{value}"
    if isinstance(value, float):
        return "None" if math.isnan(value) else f"num:{value!r}"
    if isinstance(value, (dt.datetime, dt.date)):
        return f"{type(value).__name__}:{value.isoformat()}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return f"{type(value).__name__}:{value}"


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in records)


def compare(name, spark, connection, folder):
    q = REGISTRY[name]
    began = time.time()
    df = q.run(spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - began
    if q.sql is None:
        return f"rows only ({len(ours[1])})", spent
    result = connection.execute(q.sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"COLUMNS {ours[0]} != {theirs[0]}", spent
    if len(ours[1]) != len(theirs[1]):
        extra = sorted(set(ours[1]) - set(theirs[1]))[:2]
        missing = sorted(set(theirs[1]) - set(ours[1]))[:2]
        return f"COUNT {len(ours[1])} != {len(theirs[1])}\n   ours {extra}\n   sql  {missing}", spent
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(ours[0], a, b) if x != y]
            bad = sum(x != y for x, y in zip(ours[1], theirs[1]))
            return f"VALUES ({bad} rows) {diff[:4]}\n   row {a}", spent
    if not ours[1]:
        return "EMPTY on both sides", spent
    return f"ok {len(ours[1])}", spent


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    spark = local_session(8)
    failed = []
    for name in REGISTRY:
        if args.names and not any(part in name for part in args.names):
            continue
        try:
            outcome, spent = compare(name, spark, connection, folder)
        except Exception as error:  # report and go on with the next query
            outcome, spent = "ERROR " + str(error).split("\n\n")[0][:600], 0.0
        fine = outcome.startswith(("ok", "rows only"))
        if not fine:
            failed.append(name)
        print(f"{'  ' if fine else '!!'} {name}: {outcome} [{spent:.1f}s]", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
