"""Run registered queries beside their checking SQL and report differences."""

import math
import sys
import tempfile
import time

import duckdb


def _norm(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        number = float(value)
        if math.isnan(number):
            return None
        return repr(0.0 if number == 0 else number)
    return str(value)


def checker(folder, tables):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def difference(spark, con, folder, run, sql):
    """Empty text when the query and its checking SQL agree."""
    df = run(spark, folder)
    names = df.columns
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return f"ok, no SQL ({len(got)} rows)" if got else "EMPTY, no SQL"
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns differ: {sorted(set(names) ^ set(want_names))}"
    order = sorted(names)
    ours = sorted((tuple(map(_norm, (r[names.index(c)] for c in order))) for r in got), key=str)
    theirs = sorted((tuple(map(_norm, (r[want_names.index(c)] for c in order))) for r in want), key=str)
    if not ours:
        return "EMPTY"
    if ours == theirs:
        return ""
    set_ours, set_theirs = set(ours), set(theirs)
    only_ours = [r for r in ours if r not in set_theirs][:3]
    only_theirs = [r for r in theirs if r not in set_ours][:3]
    return f"rows {len(ours)} / {len(theirs)}; columns {order}\n  ours   {only_ours}\n  theirs {only_theirs}"


def main():
    sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from ledgerloom.plans.adapters import TABLES
    from ledgerloom.session import local_session

    folder = "/root/testdata/sf0.01"
    args = sys.argv[1:]
    if args and args[0].startswith("/"):
        folder = args.pop(0)
    spark = local_session(scratch=tempfile.mkdtemp(prefix="spark-"))
    con = checker(folder, TABLES)
    checks, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            result = difference(spark, con, folder, run, checks.get(name))
        except Exception as error:
            result = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        if result and not result.startswith("ok"):
            bad += 1
        print(f"{name:38s} {time.time() - start:6.2f}s {result or 'same'}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
