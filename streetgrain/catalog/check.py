"""Compare registered queries with their check SQL on one data folder.

    python -m streetgrain.catalog.check <folder> [name prefix ...]
"""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    """One Python form for equal values of both engines."""
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "asDict"):
        return tuple((k, plain(v)) for k, v in value.asDict().items())
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float):
        return None if math.isnan(value) else ("f", repr(value))
    return value


def compare(spark, con, name: str, builder, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = builder(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    relation = con.sql(sql)
    wanted_names = sorted(relation.columns)
    if names != wanted_names:
        return f"columns {names} / {wanted_names}"
    at = [relation.columns.index(n) for n in names]
    wanted = sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)
    if len(got) != len(wanted):
        return f"{len(got)} rows / {len(wanted)} rows"
    for g, w in zip(got, wanted):
        if g != w:
            return f"row {dict(zip(names, g))}\n        / {dict(zip(names, w))}"
    if not got:
        return "no rows on either side"
    return None


def main(argv: list[str]) -> int:
    from streetgrain import catalog
    from streetgrain.session import local_session

    spark = local_session("8")
    sf_dir, prefixes = argv[0], argv[1:]
    con = connect(sf_dir)
    bad = 0
    for name, builder in catalog.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            sql = catalog.check_sql().get(name)
            if sql is None:
                rows = builder(spark, sf_dir).count()
                result = None if rows else "no rows"
                note = f"{rows} rows, no check SQL"
            else:
                result, note = compare(spark, con, name, builder, sql, sf_dir), "equal"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        if result:
            bad += 1
        print(f"{'FAIL' if result else 'ok  '} {name} {time.time() - start:.1f}s {result or note}", flush=True)
    print(f"{bad} failures")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
