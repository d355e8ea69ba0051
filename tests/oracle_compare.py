"""Run a registered Spark query and its DuckDB oracle; compare results.

Both sides are fetched as Python values (no pandas dtype coercion),
columns sorted by name, rows sorted, values normalised (NaN to None,
dates and timestamps to ISO text) and compared exactly. Column type
families (int, float, date, ...) must agree as well.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


SPARK_FAMILY = {"bigint": "int", "int": "int", "smallint": "int", "tinyint": "int",
                "double": "float", "float": "float", "date": "date", "timestamp": "ts",
                "timestamp_ntz": "ts", "boolean": "bool", "string": "str"}
DUCK_FAMILY = {"BIGINT": "int", "INTEGER": "int", "HUGEINT": "int", "SMALLINT": "int",
               "DOUBLE": "float", "FLOAT": "float", "DATE": "date", "TIMESTAMP": "ts",
               "TIMESTAMP WITH TIME ZONE": "ts", "BOOLEAN": "bool", "VARCHAR": "str"}


def _sorted_rows(names: list[str], records) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple("" if x is None else x for x in r))


def compare(spark_df, sql: str, con) -> dict:
    s_names = spark_df.columns
    s_types = {f.name: SPARK_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in spark_df.schema.fields}
    s_rows = spark_df.collect()
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_types = {d[0]: DUCK_FAMILY.get(str(d[1]), str(d[1])) for d in cur.description}
    d_rows = cur.fetchall()
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_names) == sorted(d_names)}
    if not res["columns_match"]:
        res["only_spark"] = sorted(set(s_names) - set(d_names))
        res["only_oracle"] = sorted(set(d_names) - set(s_names))
        res["match"] = False
        return res
    type_diff = {c: (s_types[c], d_types[c]) for c in s_names if s_types[c] != d_types[c]}
    if type_diff:
        res["type_diff"] = type_diff
    rs, rd = _sorted_rows(s_names, s_rows), _sorted_rows(d_names, d_rows)
    res["match"] = rs == rd and not type_diff
    if rs != rd:
        cols = sorted(s_names)
        bad = {}
        for i, c in enumerate(cols):
            a = sorted((r[i] or "") for r in rs)
            b = sorted((r[i] or "") for r in rd)
            if a != b:
                bad[c] = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["bad_columns"] = bad
    return res
