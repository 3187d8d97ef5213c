"""License scan by matching statistics over a generalised suffix automaton.

The words of all licence templates (and of the base phrases) make one suffix
automaton. A text is streamed through it word by word, which gives at each word
the longest run of words, ending there, that some template holds, and along
suffix links the longest for every single template (its matching statistics).
Only stretches whose neighbouring words stand side by side in a template go
through the automaton: elsewhere the statistics are 0 or 1.

* A base phrase stands where its own statistic is its whole length.
* Matches of ``MIN_MATCH`` words or more that can't go on are chained, per
  template, while both sides rise and at most ``GAP`` words of the text lie
  between two of them. A chain's share is the part of the template it covers;
  from ``COVER`` on it is a span of the template's label, unless it overlaps one
  of a larger share (then of more words): licences quote each other.

``score`` is the largest share of all chains, 1 where a base phrase stands.

Words are runs outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, A-Z in lower case,
counted from 0.

Result for special rows: NULL, empty and wordless text has no words, labels ""
and score 0; of equal chains the one that ends first counts; repeated rows and
ids are scanned each by itself; an empty table gives an empty result. Other
columns are not read unless named in ``carry``, so their names can't clash.
"""

from __future__ import annotations

import bisect
import functools
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlog.llm import text as X
from learnlog.llm.license_templates import BASE_PHRASES, TEMPLATES

#: Words of a match that counts in a chain.
MIN_MATCH = 4
#: Words of the text that may lie between two matches of a chain.
GAP = 30
#: Share of a template that a span covers.
COVER = 0.7

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def split_words(texts: list[bytes]) -> X.Words:
    """Words of a slice of texts, A-Z in lower case."""
    data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    edge = np.diff(np.concatenate([[0], _INSIDE[data].view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in texts]))
    return X.Words(data, start, end, np.repeat(np.arange(len(texts)), np.diff(first)), first)


class SuffixAutomaton:
    """All runs of items of several sequences; state 0 is the empty run."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: Where a state's runs end: (sequence, items up to the end).
        self.ends: list[set[tuple[int, int]]] = [set()]
        for k, sequence in enumerate(sequences):
            last = 0
            for n, item in enumerate(sequence, 1):
                last = self._extend(last, item)
                self.ends[last].add((k, n))
        for v in sorted(range(1, len(self.link)), key=lambda v: -self.length[v]):
            if self.link[v]:
                self.ends[self.link[v]] |= self.ends[v]

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, item: int) -> int:
        """The state of the longest run of ``p`` and then ``item``, made if a longer one stood for it."""
        q = self.next[p][item]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1)
        self.next[clone], self.link[clone] = dict(self.next[q]), self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(item) == q:
            self.next[p][item] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, item: int) -> int:
        if item in self.next[last]:
            return self._split(last, item)
        new, p = self._state(self.length[last] + 1), last
        while p >= 0 and item not in self.next[p]:
            self.next[p][item] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, item)
        return new

    def stream(self, items: list[int]) -> tuple[list[int], list[int]]:
        """State and length of the longest run that ends at each item."""
        states, lengths, state, length = [], [], 0, 0
        for item in items:
            while state and item not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if item in self.next[state]:
                state, length = self.next[state][item], length + 1
            states.append(state)
            lengths.append(length)
        return states, lengths

    def holders(self, sequences: int) -> np.ndarray:
        """For each state and sequence the state of the longest suffix that the sequence holds."""
        out = np.zeros((len(self.link), sequences), np.int32)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            out[v] = out[self.link[v]]
            out[v, [k for k, _ in self.ends[v]]] = v
        return out


@dataclass(frozen=True)
class Match:
    """Words ``start`` to ``end`` of a text that are words up to ``to`` of a template."""

    start: int
    end: int
    to: int


def disjoint(spans: list[tuple]) -> list[tuple]:
    """Those of ``(..., start, end)`` that overlap none that is kept before them."""
    kept, taken = [], []
    for span in spans:
        start, end = span[-2:]
        place = bisect.bisect_left(taken, (start, end))
        if (place == 0 or taken[place - 1][1] <= start) and (place == len(taken) or end <= taken[place][0]):
            taken.insert(place, (start, end))
            kept.append(span)
    return kept


def chains(matches: list[Match]) -> list[tuple[int, int, int]]:
    """``(covered words, start, end)`` of disjoint chains of one template's matches, best first.

    ``matches`` come by their ends. A match goes on from the chain that gains
    most by it, of those that end less than ``GAP`` words before it and earlier
    in the template; what both cover counts once.
    """
    near: deque[tuple[Match, int, int]] = deque()
    ended = []
    for m in matches:
        while near and near[0][0].end + GAP < m.start:
            near.popleft()
        size = m.end - m.start
        covered, start = size, m.start
        for before, had, since in near:
            gain = min(size, m.to - before.to, m.end - before.end)
            if gain > 0 and had + gain > covered:
                covered, start = had + gain, since
        near.append((m, covered, start))
        ended.append((covered, start, m.end))
    ended.sort(key=lambda c: (-c[0], c[2], -c[1]))
    return disjoint(ended)


class Scanner:
    """The automaton of some templates and what is looked up beside it."""

    def __init__(self, templates: dict[str, list[str]], phrases: dict[str, list[str]]) -> None:
        named = [(label, text, base) for base, group in ((True, phrases), (False, templates)) for label, texts in group.items() for text in texts]
        self.labels, self.base = [n[0] for n in named], [n[2] for n in named]
        words = split_words([text.encode() for _, text, _ in named])
        self.sizes = words.count.astype(np.int64)
        self.vocabulary, ids = np.unique(words.hashes(), return_inverse=True)
        sequences = np.split(ids, words.first[1:-1])
        self.automaton = SuffixAutomaton([s.tolist() for s in sequences])
        self.holder = self.automaton.holders(len(named))
        self.length = np.array(self.automaton.length, np.int64)
        self.pairs = np.unique(np.concatenate([self._pair(s[:-1], s[1:]) for s in sequences]))
        self.ends = [{k: [n for j, n in sorted(ends) if j == k] for k in {k for k, _ in ends}} for ends in self.automaton.ends]

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * len(self.vocabulary) + b

    def scan(self, texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]], list[tuple[int, int, int, int]]]]:
        """Of each text: number of words, places of base phrases (template, start, end), chains (template, covered, start, end)."""
        for a, b in X.slices(texts):
            words = split_words(texts[a:b])
            places, found = self._slice(words)
            yield from zip(words.count.tolist(), places, found, strict=True)

    def _slice(self, words: X.Words) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int, int]]]]:
        n = len(words.first) - 1
        places, found = [[] for _ in range(n)], [[] for _ in range(n)]
        h = words.hashes()
        known = np.flatnonzero(X.contains(self.vocabulary, h))
        ids = np.searchsorted(self.vocabulary, h[known])
        # words that stand side by side in the text and in a template
        pair = (np.diff(known) == 1) & (words.doc[known[1:]] == words.doc[known[:-1]]) & X.contains(self.pairs, self._pair(ids[:-1], ids[1:]))
        if not pair.any():
            return places, found
        edge = np.diff(np.concatenate([[0], pair.view(np.int8), [0]]))
        states, lengths = [], []
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        for x, y in zip(begins.tolist(), ends.tolist(), strict=True):
            s, m = self.automaton.stream(ids[x:y].tolist())
            states += s
            lengths += m
        state, longest = np.array(states), np.array(lengths)
        size = ends - begins
        at = known[np.arange(len(state)) + np.repeat(begins - (np.cumsum(size) - size), size)]
        last = np.zeros(len(state), bool)
        last[np.cumsum(size) - 1] = True
        doc, position = words.doc[at], at - words.first[words.doc[at]]
        for k, base in enumerate(self.base):
            own = np.minimum(longest, self.length[self.holder[state, k]])
            if base:
                for i in np.flatnonzero(own == self.sizes[k]).tolist():
                    places[doc[i]].append((k, int(position[i] - self.sizes[k] + 1), int(position[i]) + 1))
                continue
            ended = last.copy()
            ended[:-1] |= own[1:] <= own[:-1]
            hits = np.flatnonzero(ended & (own >= min(MIN_MATCH, self.sizes[k])))
            for group in np.split(hits, np.flatnonzero(np.diff(doc[hits])) + 1) if len(hits) else []:
                matches = [Match(int(position[i] + 1 - own[i]), int(position[i]) + 1, to)
                           for i in group.tolist() for to in self.ends[self.holder[state[i], k]][k]]
                found[doc[group[0]]] += [(k, *chain) for chain in chains(matches)]
        return places, found


@functools.lru_cache(maxsize=4)
def _scanner(templates: tuple, phrases: tuple) -> Scanner:
    return Scanner({k: list(v) for k, v in templates}, {k: list(v) for k, v in phrases})


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                 templates: dict[str, list[str]] = TEMPLATES, phrases: dict[str, list[str]] = BASE_PHRASES) -> DataFrame:
    """``(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans, carry...)``, a row per row of ``docs``.

    ``first_word`` and ``last_word`` are the smallest and largest start of a base
    phrase; ``spans`` are the covered stretches of templates, in words, by start.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    carry = list(carry or [])
    counts, texts = ("n_words", "n_base", "first_word", "last_word"), ("base_labels", "labels")
    if clash := {id_col, *counts, *texts, "score", "spans"} & set(carry):
        raise ValueError(f"carried columns clash with the result's: {sorted(clash)}")
    schema = T.StructType([docs.schema[id_col], *(T.StructField(c, T.LongType()) for c in counts),
                           *(T.StructField(c, T.StringType()) for c in texts), T.StructField("score", T.DoubleType()),
                           T.StructField("spans", T.ArrayType(T.StructType.fromDDL("label string, start bigint, end bigint, share double"))),
                           *(docs.schema[c] for c in carry)])
    arrow = to_arrow_schema(schema)
    key = tuple((k, tuple(v)) for k, v in templates.items()), tuple((k, tuple(v)) for k, v in phrases.items())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(*key)
        for batch in batches:
            rows = []
            for n, places, found in scanner.scan(X.as_bytes(batch["_text"])):
                share = sorted((-covered / int(scanner.sizes[k]), -covered, scanner.labels[k], start, end) for k, covered, start, end in found)
                spans = sorted((start, end, label, -s) for s, _, label, start, end in disjoint([x for x in share if -x[0] >= COVER]))
                base = {scanner.labels[k] for k, _, _ in places}
                starts = [start for _, start, _ in places]
                rows.append((n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                             ",".join(sorted(base | {label for _, _, label, _ in spans})),
                             1.0 if places else -share[0][0] if share else 0.0,
                             [{"label": label, "start": start, "end": end, "share": s} for start, end, label, s in spans]))
            columns = zip(*rows, strict=True) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], *(pa.array(c, arrow.field(i + 1).type) for i, c in enumerate(columns)),
                 *(batch[f"_c{k}"] for k in range(len(carry)))], schema=arrow)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"),
                       *(F.col(c).alias(f"_c{k}") for k, c in enumerate(carry))).mapInArrow(scan, schema)
