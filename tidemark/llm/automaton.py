"""Byte automata from regular expressions: subset construction, minimisation.

Supported: literals, ``.``, classes with ranges and negation, escapes,
groups (all non-capturing), ``|``, ``* + ?`` and ``{m}``, ``{m,}``, ``{m,n}``.
Expressions are over ASCII; a negated class or ``.`` stands for any other byte.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v"}
_SETS = {"d": "0123456789", "w": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz",
         "s": " \t\n\r\f\v"}


class _Parser:
    """Expression text -> tree of ("set", frozenset of bytes), ("cat", [..]),
    ("alt", [..]) and ("repeat", tree, least, most or None)."""

    def __init__(self, text: str, ignore_case: bool):
        self.text, self.at, self.ignore_case = text, 0, ignore_case

    def parse(self):
        tree = self._alternatives()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at} in {self.text!r}")
        return tree

    def _peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def _next(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def _alternatives(self):
        out = [self._sequence()]
        while self._peek() == "|":
            self.at += 1
            out.append(self._sequence())
        return out[0] if len(out) == 1 else ("alt", out)

    def _sequence(self):
        out = []
        while self._peek() not in ("", "|", ")"):
            out.append(self._repeated(self._atom()))
        return ("cat", out)

    def _repeated(self, tree):
        while True:
            c = self._peek()
            if c in ("*", "+", "?") and c:
                self.at += 1
                tree = ("repeat", tree, 1 if c == "+" else 0, 1 if c == "?" else None)
            elif c == "{":
                end = self.text.index("}", self.at)
                least, _, most = self.text[self.at + 1:end].partition(",")
                closed = "," not in self.text[self.at:end]
                self.at = end + 1
                tree = ("repeat", tree, int(least), int(least) if closed else int(most) if most else None)
            else:
                return tree

    def _atom(self):
        c = self._next()
        if c == "(":
            if self.text.startswith("?:", self.at):
                self.at += 2
            tree = self._alternatives()
            if self._next() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            return tree
        if c == "[":
            return ("set", self._class())
        if c == ".":
            return ("set", frozenset(range(256)) - {10})
        if c == "\\":
            return ("set", self._cased(self._escape()))
        return ("set", self._cased({ord(c)}))

    def _escape(self) -> set[int]:
        c = self._next()
        if c == "x":
            self.at += 2
            return {int(self.text[self.at - 2:self.at], 16)}
        if c in _SETS:
            return {ord(x) for x in _SETS[c]}
        return {ord(_ESCAPES.get(c, c))}

    def _class(self) -> frozenset[int]:
        out: set[int] = set()
        negated = self._peek() == "^"
        self.at += negated
        first = True
        while self._peek() != "]" or first:
            first = False
            c = self._next()
            chars = self._escape() if c == "\\" else {ord(c)}
            if self._peek() == "-" and self.text[self.at + 1:self.at + 2] not in ("]", "") and len(chars) == 1:
                self.at += 1
                d = self._next()
                high = self._escape() if d == "\\" else {ord(d)}
                chars = set(range(min(chars), max(high) + 1))
            out |= chars
        self.at += 1
        cased = self._cased(out)
        return frozenset(range(256)) - cased if negated else cased

    def _cased(self, chars: set[int]) -> frozenset[int]:
        if self.ignore_case:
            chars = chars | {b ^ 32 for b in chars if 65 <= (b & ~32) <= 90}
        return frozenset(chars)


def _reverse(tree):
    kind = tree[0]
    if kind == "cat":
        return ("cat", [_reverse(t) for t in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [_reverse(t) for t in tree[1]])
    if kind == "repeat":
        return ("repeat", _reverse(tree[1]), *tree[2:])
    return tree


@dataclass
class _Nfa:
    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, tree, start: int) -> int:
        """Builds the tree from ``start``; returns its end state."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((tree[1], end))
            return end
        if kind == "cat":
            for t in tree[1]:
                start = self.add(t, start)
            return start
        end = self.state()
        if kind == "alt":
            for t in tree[1]:
                self.empty[self.add(t, start)].append(end)
            return end
        _, inner, least, most = tree
        for _ in range(least):
            start = self.add(inner, start)
        if most is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(inner, loop)].append(loop)
            self.empty[loop].append(end)
        else:
            for _ in range(most - least):
                self.empty[start].append(end)
                start = self.add(inner, start)
            self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass
class Automaton:
    """``byte_class[b]``: column of byte b; ``moves[state, column]``: next
    state; ``accepts[state]``: bit mask of the rules that end in the state.
    State 0 is the start. In an anchored automaton ``dead`` is the state
    without a way to any rule (-1 if there is none)."""

    byte_class: bytes
    moves: np.ndarray
    accepts: np.ndarray
    dead: int


def compile_rules(expressions: list[tuple[str, bool]], *, reverse: bool = False,
                  anchored: bool = False) -> Automaton:
    """One minimal automaton for all (expression, ignore case) rules.

    Not anchored: it runs over a text once and is in a state that accepts a
    rule wherever some match of that rule ends (with ``reverse``, run from
    the text's end: wherever some match begins).
    """
    nfa = _Nfa()
    start = nfa.state()
    ends = {}
    for n, (text, ignore_case) in enumerate(expressions):
        tree = _Parser(text, ignore_case).parse()
        first = nfa.state()
        nfa.empty[start].append(first)
        ends[nfa.add(_reverse(tree) if reverse else tree, first)] = 1 << n
    if not anchored:
        nfa.moves[start].append((frozenset(range(256)), start))

    # bytes that no set tells apart share a column
    sets = list({chars for moves in nfa.moves for chars, _ in moves})
    kinds: dict[tuple, int] = {}
    byte_class = bytes(kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256))
    members = [byte_class.index(k) for k in range(len(kinds))]

    # subset construction
    first = nfa.closure([start])
    names, order, moves = {first: 0}, [first], []
    for subset in order:  # grows while it is read
        row = []
        for byte in members:
            to = nfa.closure({t for s in subset for chars, t in nfa.moves[s] if byte in chars})
            if to not in names:
                names[to] = len(order)
                order.append(to)
            row.append(names[to])
        moves.append(row)
    table = np.array(moves, dtype=np.int64)
    accepts = np.array([sum({ends[s] for s in subset if s in ends}) for subset in order], dtype=np.int64)

    # minimisation: split blocks until all states of a block move alike
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    number: dict[int, int] = {}
    for b in block:
        number.setdefault(int(b), len(number))  # the start's block becomes 0
    renamed = np.array([number[int(b)] for b in block])
    _, one = np.unique(renamed, return_index=True)
    small, marks = renamed[table[one]], accepts[one]
    stuck = np.flatnonzero((small == np.arange(len(small))[:, None]).all(axis=1) & (marks == 0))
    return Automaton(byte_class, small, marks, int(stuck[0]) if anchored and len(stuck) else -1)
