"""Line dedup: SQL parity, a plain version, hot lines and edge rows."""

import hashlib
import random

import pytest

from oracle_compare import compare, duck
from tidemark.llm import linededup

SF = "/root/testdata/sf0.01"


def plain(rows):
    """(id, text) rows -> (id, kept, n_lines, n_dropped), by a dictionary."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders.get(key(line), set())
            keeper = max((d for d in ids if d is not None), default=None)
            if len(ids) < 3 or doc == keeper:
                kept.append(line)
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def dropped(spark, rows, schema="doc_id long, text string"):
    got = linededup.drop_lines(spark.createDataFrame(rows, schema))
    return [(r["row"]["doc_id"], r["kept"], r["n_lines"], r["n_dropped"]) for r in got.collect()]


def same(a, b):
    assert sorted(a, key=str) == sorted(b, key=str)


def test_matches_sql(spark):
    result = compare(linededup.op11_linededup(spark, SF), linededup.OP11_SQL, duck(SF))
    assert result["match"], result


def test_query_digests_the_kept_text(spark):
    small = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, k, n, g in plain(rows)]
    same([tuple(r) for r in linededup.op11_linededup(spark, small).collect()], want)


LONG = "A line of more than Twenty characters"


@pytest.mark.parametrize("rows", [
    [(1, LONG), (2, f"\t {LONG.upper()} \r"), (3, f"x\n{LONG}\n{LONG}\n"), (4, "x\nx"), (5, None), (6, "")],
    [(1, LONG), (1, LONG), (1, LONG), (2, LONG)],                       # two documents only
    [(None, LONG), (None, f"{LONG}\nown"), (7, LONG), (9, LONG)],       # no id: one document, the lowest
    [(None, LONG), (None, LONG), (None, LONG)],
    [(1, "É" + "x" * 19), (2, "é" + "x" * 19), (3, "É" + "X" * 19), (4, "É" + "x" * 19)],   # É is not A-Z
    [(i, "y" * 19 + "\x0b") for i in range(5)],                         # 19 code points after stripping
    [(i, "\n".join([LONG, "short", LONG + str(i % 2)] * 3)) for i in range(9)],
])
def test_small_cases(spark, rows):
    same(dropped(spark, rows), plain(rows))


def test_random_texts_and_hot_lines(spark, monkeypatch):
    monkeypatch.setattr(linededup, "PIECES", 7)   # several hot lines, dealt into pieces
    rnd = random.Random(1)
    pool = [f"{'common line number':<20}{k}" for k in range(12)]
    rows = [(rnd.randrange(150), "\n".join(rnd.choice(pool[:1 + rnd.randrange(12)]) if rnd.random() < 0.7
                                           else f"unique {rnd.random():.12f} line" for _ in range(rnd.randrange(12))))
            for _ in range(400)]
    same(dropped(spark, rows), plain(rows))


def test_long_text_is_linear(spark):
    text = "\n".join(f"a line that occurs in all of them {k}" for k in range(60_000))
    rows = [(k, text) for k in range(3)]
    got = {d: (len(k), n, g) for d, k, n, g in dropped(spark, rows)}
    assert got == {0: (0, 60_000, 60_000), 1: (0, 60_000, 60_000), 2: (len(text), 60_000, 0)}


def test_clashing_columns_and_empty_table(spark):
    rows = [(k, LONG, 1, "a", "b", "c") for k in range(4)]
    schema = "doc_id long, text string, doc long, gone string, `h1` string, `a.b` string"
    df = spark.createDataFrame(rows, schema)
    got = linededup.drop_lines(df)
    assert got.select("row.*").columns == df.columns
    assert sorted((r["row"]["doc_id"], r["kept"]) for r in got.collect()) == [(0, ""), (1, ""), (2, ""), (3, LONG)]
    assert linededup.drop_lines(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = linededup.op11_linededup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
