"""Operator 4: secret scans by one combined automaton.

All rules are compiled into one minimal automaton of the reversed
expressions. It reads a text's bytes once, from the end, and is in an
accepting state of a rule exactly where some match of that rule begins. From
those starts the rule's own anchored automaton gives the longest match; the
next match of the rule begins after it (leftmost, non-overlapping). So all
bytes are read once for all rules, and again only inside matches. Matches
whose value is too short are dropped after that, as the base rules ask.

The three base rules come first; the others are added by this operator and
never change a base rule's spans. Offsets count code points, end exclusive.
Automata are compiled once per worker.

Defined results: a null text counts as empty and has no spans; an empty text
too; texts of any length are read in blocks; repeated rows are scanned each.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.automaton import Automaton, compile_rules
from tidemark.llm.common import bounded_batches, table, texts_of

BLOCK_BYTES = 1 << 20


@dataclass(frozen=True)
class Rule:
    """``least``: shortest accepted length of the match, or with ``head`` of
    what follows the longest match of ``head`` at its start."""

    kind: str
    expression: str
    least: int = 0
    head: str | None = None
    ignore_case: bool = False


# The rules. A run of 24 or more hexadecimal digits is the same as
# a run of any length that is dropped if shorter, so the bound is in the expression.
_HEAD = "(?:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
BASE = (
    Rule("assign", _HEAD + "[A-Za-z0-9+/_.=-]+", 6, _HEAD, True),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24,}"),
)
ADDED = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 40),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + ADDED


def _linked_rows(automaton: Automaton) -> list[list]:
    """Every state as the list of the states its columns lead to, with its
    rules' mask as last item: one list lookup per byte."""
    rows: list[list] = [[] for _ in automaton.moves]
    for row, moves, mask in zip(rows, automaton.moves.tolist(), automaton.accepts.tolist()):
        row.extend(rows[t] for t in moves)
        row.append(mask)
    return rows


class _Longest:
    """Longest match of one expression at a given place."""

    def __init__(self, expression: str, ignore_case: bool):
        automaton = compile_rules([(expression, ignore_case)], anchored=True)
        rows = _linked_rows(automaton)
        self.start, self.dead = rows[0], rows[automaton.dead] if automaton.dead >= 0 else None
        self.column = automaton.byte_class

    def end(self, data: bytes, start: int) -> int:
        state, column, end, at = self.start, self.column, -1, start
        size = len(data)
        while at < size:
            state = state[column[data[at]]]
            if state is self.dead:
                break
            at += 1
            if state[-1]:
                end = at
        return end


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.automaton = compile_rules([(r.expression, r.ignore_case) for r in rules], reverse=True)
        self.start = _linked_rows(self.automaton)[0]
        self.longest = [_Longest(r.expression, r.ignore_case) for r in rules]
        self.heads = [_Longest(r.head, r.ignore_case) if r.head else None for r in rules]

    def _starts(self, data: bytes) -> list[list[int]]:
        """[first offset, last offset, rules' mask] of the runs of adjacent match
        beginnings with the same mask, last one first."""
        found, state, size = [], self.start, len(data)
        for stop in range(size, 0, -BLOCK_BYTES):
            block = data[max(0, stop - BLOCK_BYTES):stop].translate(self.automaton.byte_class)[::-1]
            for n, column in enumerate(block):
                state = state[column]
                if state[-1]:
                    at = stop - 1 - n
                    if found and found[-1][0] == at + 1 and found[-1][2] == state[-1]:
                        found[-1][0] = at
                    else:
                        found.append([at, at, state[-1]])
        return found

    def byte_spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule's number, end) in bytes, in order."""
        starts = self._starts(data)
        spans, free = [], [0] * len(self.rules)
        for first, last, mask in reversed(starts):
            for n, rule in enumerate(self.rules):
                while mask >> n & 1 and (at := max(first, free[n])) <= last:
                    end = free[n] = self.longest[n].end(data, at)
                    value = self.heads[n].end(data, at) if self.heads[n] else at
                    if end - value >= rule.least:
                        spans.append((at, n, end))
        return sorted(spans)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then kind as listed."""
        data = text.encode()
        spans = self.byte_spans(data)
        if spans and not data.isascii():
            first_bytes = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
            points = np.r_[0, np.cumsum(first_bytes)]
            spans = [(int(points[a]), n, int(points[b])) for a, n, b in spans]
        return [(self.rules[n].kind, a, b) for a, n, b in spans]


@functools.lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def redacted(text: str, rules: tuple[Rule, ...] = RULES) -> str:
    """The text with every span replaced by its kind; overlapping spans are
    replaced together, by the kind of the first."""
    out, at = [], 0
    merged: list[list] = []
    for kind, start, end in scanner(rules).spans(text):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"<{kind}>"]
        at = end
    return "".join([*out, text[at:]])


def spans_column(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """array<struct<kind, start, end>> of a text column."""
    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scan = scanner(rules)
        for batch in batches:
            yield pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in scan.spans(t)]
                             for t in texts_of(batch)], dtype=object)

    return find(text)


def redacted_column(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The texts without their secrets (null stays null)."""
    @F.pandas_udf("string")
    def redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([redacted(t, rules) if isinstance(t, str) else None for t in batch], dtype=object)

    return redact(text)


def digest_of(spans: list[tuple[str, int, int]]) -> tuple[int, int, int, str, str]:
    shown = [(k, f"{k}:{a}:{b}") for k, a, b in spans]
    base = [r.kind for r in BASE]
    counts = [sum(k == kind for k, _ in shown) for kind in base]
    joined = ",".join(x for k, x in shown if k in base)
    return (*counts, hashlib.sha256(joined.encode()).hexdigest(), ",".join(x for _, x in shown))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scan = scanner(RULES)
        for batch in batches:
            yield pd.DataFrame([digest_of(scan.spans(t)) for t in texts_of(batch)],
                               columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.withColumn("found", digest(F.col("text"))).select("doc_id", "found.*")
