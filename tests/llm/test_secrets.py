"""Secret scans: against the regular expression engine, automaton by automaton."""

import random
import re
import tracemalloc

import pytest
from pyspark.sql import functions as F

from tidemark.llm import secrets
from tidemark.llm.automaton import compile_rules

SF = "/root/testdata/sf0.01"
# The contract's rules as they are written, with the length checks after matching.
PLAIN = {
    "assign": (re.compile("(?:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                          re.I | re.A), 1, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def plain_base(text):
    return sorted((m.start(), list(PLAIN).index(kind), kind, m.end())
                  for kind, (rx, group, least) in PLAIN.items() for m in rx.finditer(text)
                  if len(m.group(group)) >= least)


def plain_added(text):
    return sorted((m.start(), n, r.kind, m.end()) for n, r in enumerate(secrets.RULES) if n >= 3
                  for m in re.finditer(r.expression, text) if m.end() - m.start() >= r.least)


def base_spans(text):
    kinds = list(PLAIN)
    return [(a, kinds.index(k), k, b) for k, a, b in secrets.scanner().spans(text) if k in kinds]


def test_query_against_expressions(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in secrets.op4_secrets(spark, SF).collect()}
    found = 0
    for r in rows:
        want = [(k, a, b) for a, _, k, b in sorted(plain_base(r["text"]) + plain_added(r["text"]))]
        assert got[r["doc_id"]] == secrets.digest_of(want)
        found += len(want)
    assert found > 20 and len(got) == len(rows)


def test_random_texts():
    rnd = random.Random(7)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "=", ":", "==", " ", "  ", "'", '"',
            "AKIA", "AKIAAKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "deadbeef", "abc", "x", "é", "\U0001f600",
            "\n", "_", "-", "ghp_", "a" * 36, "xoxb-", "eyJ", ".", "-----BEGIN RSA PRIVATE KEY-----", "AIza"]
    for _ in range(6000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        assert base_spans(text) == plain_base(text), text
        got = [(a, k, b) for k, a, b in secrets.scanner().spans(text) if k not in PLAIN]
        assert got == [(a, k, b) for a, _, k, b in plain_added(text)], text


@pytest.mark.parametrize("expression", ["a|ab|abc", "(?:ab)*c", "[^a-y]{2,3}", "a{2}b?", "x.y", "(a|b)+\\.c", "a{0,2}b{1,}"])
def test_automata_find_every_start(expression):
    machine = compile_rules([(expression, False)], reverse=True)
    plain = re.compile(expression.replace("(a|b)", "(?:a|b)"))
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choice("abcxyz.\n") for _ in range(rnd.randint(0, 9)))
        state, starts = 0, []
        for at in range(len(text) - 1, -1, -1):
            state = machine.moves[state, machine.byte_class[ord(text[at])]]
            if machine.accepts[state]:
                starts.append(at)
        assert sorted(starts) == [i for i in range(len(text)) if plain.match(text, i) and plain.match(text, i).end() > i
                                  ], (expression, text)


def test_minimal_and_small():
    machine = secrets.scanner().automaton
    rows = {(tuple(m), a) for m, a in zip(machine.moves.tolist(), machine.accepts.tolist())}
    assert len(rows) == len(machine.moves) < 5000


def test_blocks(monkeypatch):
    text = "é token=abcdefgh and " * 50 + "0123456789abcdef" * 40
    want = plain_base(text)
    monkeypatch.setattr(secrets, "BLOCK_BYTES", 7)
    assert base_spans(text) == want


def test_edge_rows_and_redaction(spark):
    key = "AKIA" + "Z" * 16
    rows = [(1, None), (2, ""), (3, f"é {key} end"), (3, f"é {key} end"), (None, "token: abcdef0123456789abcdef0123")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash"))
    out = (docs.withColumn("found", secrets.spans_column(F.col("text")))
           .withColumn("clean", secrets.redacted_column(F.col("text"))).collect())
    assert [len(r["found"]) for r in out] == [0, 0, 1, 1, 2]
    assert [r["clean"] for r in out] == [None, "", "é <access> end", "é <access> end", "<assign>"]
    assert docs.limit(0).withColumn("found", secrets.spans_column(F.col("text"))).count() == 0


def test_long_runs_take_little_memory():
    scan, run = secrets.scanner(), b"0123456789abcdef" * 20_000
    data = run + b" password=" + run
    tracemalloc.start()
    spans = scan.byte_spans(data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    kinds = [scan.rules[n].kind for _, n, _ in spans]
    assert (0, len(run)) in {(a, b) for a, _, b in spans} and {"assign", "hex"} <= set(kinds)
    assert peak < 4 * len(data)
