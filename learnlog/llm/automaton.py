"""Byte automata: rule expressions, subset construction, minimisation, scanning.

Expressions are built from ``chars``, ``seq``, ``alt``, ``opt`` and ``many``; a
``Dfa`` is a transition array (state x byte) with a bit mask of accepted rules
per state. ``starts`` runs one automaton for all rules over a byte array.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Expr = tuple


def chars(text: bytes | str) -> Expr:
    """One byte out of these; ``a-z`` is a range, a final ``-`` is itself."""
    b = text.encode() if isinstance(text, str) else text
    found, i = set(), 0
    while i < len(b):
        if i + 2 < len(b) and b[i + 1] == 0x2D:
            found |= set(range(b[i], b[i + 2] + 1))
            i += 3
        else:
            found.add(b[i])
            i += 1
    return ("chars", frozenset(found))


def seq(*parts: Expr) -> Expr:
    return ("seq", *parts)


def alt(*parts: Expr) -> Expr:
    return ("alt", *parts)


def opt(part: Expr) -> Expr:
    return ("alt", part, ("seq",))


def many(part: Expr) -> Expr:
    """Any number of them, none included."""
    return ("many", part)


def word(text: str, any_case: bool = False) -> Expr:
    """These letters, in either case if asked."""
    return seq(*(("chars", frozenset({ord(c.lower()), ord(c.upper())} if any_case else {ord(c)})) for c in text))


def reverse(e: Expr) -> Expr:
    if e[0] == "chars":
        return e
    parts = [reverse(x) for x in e[1:]]
    return (e[0], *(parts[::-1] if e[0] == "seq" else parts))


class _Nfa:
    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.step: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append(None)
        return len(self.empty) - 1

    def add(self, e: Expr, begin: int) -> int:
        """Add ``e`` from ``begin``; its end state."""
        if e[0] == "chars":
            mid, end = self.state(), self.state()
            self.empty[begin].append(mid)
            self.step[mid] = (e[1], end)
            return end
        if e[0] == "seq":
            for part in e[1:]:
                begin = self.add(part, begin)
            return begin
        if e[0] == "alt":
            end = self.state()
            for part in e[1:]:
                at = self.state()
                self.empty[begin].append(at)
                self.empty[self.add(part, at)].append(end)
            return end
        loop = self.state()
        self.empty[begin].append(loop)
        self.empty[self.add(e[1], loop)].append(loop)
        return loop

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(x for x in seen if self.step[x] or x in self.final)

    final: dict[int, int] = {}


@dataclass
class Dfa:
    """``table[state * 256 + byte]`` is the next state; state 0 is the start."""

    table: np.ndarray
    accepts: np.ndarray       # bit mask of rules per state

    @property
    def states(self) -> int:
        return len(self.accepts)


def compile_rules(rules: list[Expr], anywhere: bool) -> Dfa:
    """Minimal automaton that accepts each rule; ``anywhere``: after any bytes."""
    nfa = _Nfa()
    nfa.final = {}
    begin = nfa.state()
    if anywhere:
        nfa.add(("many", ("chars", frozenset(range(256)))), begin)
        begin_of_rules = nfa.empty[begin][0]
    else:
        begin_of_rules = begin
    for k, rule in enumerate(rules):
        at = nfa.state()
        nfa.empty[begin_of_rules].append(at)
        nfa.final[nfa.add(rule, at)] = k
    # bytes that every expression treats alike are one column
    sets = [s[0] for s in nfa.step if s]
    kinds = sorted({tuple(b in s for s in dict.fromkeys(sets)) for b in range(256)})
    kind = np.array([kinds.index(tuple(b in s for s in dict.fromkeys(sets))) for b in range(256)])
    sample = [int(np.flatnonzero(kind == k)[0]) for k in range(len(kinds))]
    start = nfa.closure([begin])
    number, todo, rows = {start: 0}, [start], []
    for here in todo:
        row = []
        for b in sample:
            to = nfa.closure([nfa.step[x][1] for x in here if nfa.step[x] and b in nfa.step[x][0]])
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    accept = np.array([sum(1 << k for k in {nfa.final[x] for x in s if x in nfa.final}) for s in todo], np.int64)
    table = np.array(rows, np.int64)
    # minimisation: split the states by what they accept, then by where they lead, until nothing splits
    _, part = np.unique(accept, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == part.max():
            break
        part = finer
    # number the classes: the start first, accepting ones last
    least = np.full(part.max() + 1, -1)
    least[part[::-1]] = np.arange(len(part))[::-1]
    order = sorted(range(len(least)), key=lambda p: (p != part[0], accept[least[p]] != 0, p))
    new = np.empty(len(order), np.int64)
    new[order] = np.arange(len(order))
    small = new[part[table[least[order]]]]
    return Dfa(small[:, kind].astype(np.int32).ravel(), accept[least[order]])


#: Bytes of a segment: all segments of a batch step together.
SEGMENT = 256


def run(dfa: Dfa, data: np.ndarray) -> np.ndarray:
    """State after each byte of ``data``.

    Segments run side by side, each from the start state; a segment whose
    predecessor ended elsewhere runs again from there, until none is left.
    """
    n = len(data)
    lanes = -(-n // SEGMENT)
    columns = np.ascontiguousarray(np.pad(data, (0, lanes * SEGMENT - n)).reshape(lanes, SEGMENT).T)
    states = np.empty((SEGMENT, lanes), np.int32)
    begun = np.zeros(lanes, np.int32)
    todo = np.arange(lanes)
    while len(todo):
        s, part = begun[todo], columns[:, todo]
        out = np.empty((SEGMENT, len(todo)), np.int32)
        for j in range(SEGMENT):
            s = dfa.table[(s << 8) | part[j]]
            out[j] = s
        states[:, todo] = out
        want = np.concatenate([np.zeros(1, np.int32), states[-1, :-1]]) if lanes else begun
        todo = np.flatnonzero(want != begun)
        begun = want
    return states.T.ravel()[:n]


def starts(reversed_dfa: Dfa, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a rule's match starts, rising, and the mask of those rules.

    The automaton of the reversed rules reads the bytes from the last to the
    first: it accepts at the positions from which a rule matches.
    """
    states = run(reversed_dfa, data[::-1])[::-1]
    first = int((reversed_dfa.accepts == 0).sum()) if reversed_dfa.accepts[0] == 0 else 0
    at = np.flatnonzero(states >= first)
    return at, reversed_dfa.accepts[states[at]]


def longest(dfa: Dfa, rows: list[list[int]], data: bytes, at: int) -> int:
    """End of the longest match that starts at ``at``, -1 if none. ``rows``: the table as lists."""
    s, end = 0, at if dfa.accepts[0] else -1
    good = dfa.accepts
    for i in range(at, len(data)):
        s = rows[s][data[i]]
        if good[s]:
            end = i + 1
        elif rows[s] is _DEAD or (i - at) % 64 == 63 and all(x == s for x in rows[s]):
            break
    return end


_DEAD: list[int] = []


def as_rows(dfa: Dfa) -> list[list[int]]:
    """The table as lists for byte-by-byte steps; a state that leads nowhere else ends the match."""
    rows = dfa.table.reshape(-1, 256).tolist()
    return [_DEAD if not dfa.accepts[k] and all(x == k for x in r) else r for k, r in enumerate(rows)]
