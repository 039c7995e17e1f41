"""Side-by-side run of registered queries and their SQL oracles."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None and not (
        isinstance(v, float) and math.isnan(v)) else 0) for v in row)


def compare(spark_df, con, sql: str) -> str | None:
    """None where columns, types and all values agree, else what differs."""
    schema = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    cursor = con.execute(sql)
    expected = {d[0]: str(d[1]) for d in cursor.description}
    rows = cursor.fetchall()
    if sorted(schema) != sorted(expected):
        return f"columns {sorted(schema)} != {sorted(expected)}"
    types = [(c, schema[c], expected[c]) for c in schema if _TYPES.get(schema[c]) != expected[c]]
    if types:
        return f"types {types}"
    columns = sorted(schema)
    position = {c: i for i, c in enumerate(expected)}
    want = sorted((tuple(r[position[c]] for c in columns) for r in rows), key=_key)
    got = sorted((tuple(r[c] for c in columns) for r in spark_df.collect()), key=_key)
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, e) for g, e in zip(got, want) if g != e]
    if bad:
        return f"{len(bad)} of {len(want)} values differ, e.g. {columns} {bad[:3]}"
    return None if want else "no rows"


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from obsflow.session import build_session

    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        begun = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        mark = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {mark} {name} {time.time() - begun:.1f}s {problem or ''}",
              flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
