"""Secret scan with one automaton for all rules.

Each rule is a head and a run of tail bytes with a least length. The rules are
compiled by subset construction and minimised into one transition array, which
reads the bytes of a batch of texts once, from the last to the first, and tells
where matches of each rule start. There the rule's own automaton (the same
construction) finds the longest match. Matches of a kind are leftmost and do
not overlap; one whose tail is too short is dropped but still takes its place.
A rule can have a rest, which a match takes in where it follows: of a private
key, the lines to its END line, or without one the long base64 words.

Kinds ``assign``, ``access`` and ``hex`` are the base; the others are added.
Spans are in code points, the end exclusive.

Result for special rows: NULL or empty text has no span; repeated rows and ids
are scanned each by itself; an empty table gives an empty result. Other columns
are not read unless named in ``carry``, so their names can't clash.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnlog.llm import automaton as A
from learnlog.llm import text as X
from learnlog.llm.automaton import alt, chars, many, opt, seq, word

MASK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    kind: str
    head: tuple
    tail: str
    least: int                # bytes of the tail
    #: Tail bytes that the search asks for; above 1 only where a shorter run can't hide a match (no head).
    seek: int = 1
    #: What a match goes on with after the tail, if it is there.
    rest: tuple | None = None


_QUOTE, _SPACES = opt(chars("\"'")), many(chars(" "))
_URL64 = "A-Za-z0-9_-"
_KEY64 = chars("A-Za-z0-9+/=")
# line ends can be written as in a JSON string; a hyphen of the key's own header lines has a letter or digit after it
_BREAK = alt(chars(" \t\r\n"), seq(chars("\\"), chars("nr")))
_KEY_LINES = seq(many(alt(_KEY64, _BREAK, chars(":,"), seq(chars("-"), chars("A-Za-z0-9")))),
                 word("-----END "), many(chars("A-Z ")), word("PRIVATE KEY-----"))
_KEY_WORDS = many(seq(_BREAK, many(_BREAK), *[_KEY64] * 20, many(_KEY64)))
RULES = (
    Rule("assign", seq(alt(word("password", True), word("passwd", True), word("secret", True), word("token", True),
                           seq(word("api", True), opt(chars("_")), word("key", True))),
                       _QUOTE, _SPACES, chars(":="), _SPACES, _QUOTE), "A-Za-z0-9+/_.=-", 6),
    Rule("access", word("AKIA"), "A-Z0-9", 16),
    Rule("hex", seq(), "0-9a-f", 24, 24),
    Rule("github", seq(word("gh"), chars("pousr"), word("_")), "A-Za-z0-9", 36),
    Rule("slack", seq(word("xox"), chars("abeoprs"), word("-")), "A-Za-z0-9-", 10),
    Rule("google", word("AIza"), _URL64, 35),
    Rule("stripe", seq(chars("rs"), word("k_"), alt(word("live"), word("test")), word("_")), "A-Za-z0-9", 16),
    Rule("jwt", seq(word("eyJ"), many(chars(_URL64)), word(".eyJ"), many(chars(_URL64)), word(".")), _URL64, 10),
    Rule("pem", seq(word("-----BEGIN "), many(chars("A-Z ")), word("PRIVATE KEY")), "-", 5, rest=alt(_KEY_LINES, _KEY_WORDS)),
)
BASE = 3


@functools.lru_cache(maxsize=1)
def _compiled(rules: tuple[Rule, ...]):
    backward = A.compile_rules([A.reverse(seq(r.head, *[chars(r.tail)] * r.seek)) for r in rules], anywhere=True)
    heads = [A.compile_rules([r.head], anywhere=False) for r in rules]
    tails = [bytes(b in chars(r.tail)[1] for b in range(256)) for r in rules]
    rests = [A.compile_rules([r.rest], anywhere=False) if r.rest else None for r in rules]
    return backward, [(h, A.as_rows(h)) for h in heads], tails, [r and (r, A.as_rows(r)) for r in rests]


def find(texts: list[bytes], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """``(start, rule, end)`` in code points of each text, in order."""
    backward, heads, tails, rests = _compiled(rules)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in X.slices(texts):
        raw = b"\xff".join([*texts[a:b], b""])        # no byte of a text, so no match runs on into the next one
        data = np.frombuffer(raw, np.uint8)
        at, mask = A.starts(backward, data)
        if not len(at):
            continue
        spans = []
        for k, rule in enumerate(rules):
            over = 0
            head, rows = heads[k]
            for i in at[(mask >> k) & 1 == 1].tolist():
                if i < over:
                    continue
                begin = end = A.longest(head, rows, raw, i)
                while tails[k][raw[end]]:
                    end += 1
                if end - begin >= rule.least:
                    if rests[k]:
                        end = max(end, A.longest(*rests[k], raw, end))
                    spans.append((i, k, end))
                over = end
        if not spans:
            continue
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[a:b]])
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        for i, k, end in sorted(spans):
            doc = int(np.searchsorted(begins, i, side="right")) - 1
            zero = points[begins[doc]]
            found[a + doc].append((int(points[i] - zero), k, int(points[end] - zero)))
    return found


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by one mask."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``(id, n_assign, n_access, n_hex, base_spans, spans, clean_text, carry...)``, a row per row of ``docs``.

    Spans are ``kind:start:end`` by start, then kind, joined by commas;
    ``clean_text`` is the text (NULL: NULL) with the spans masked.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    carry = list(carry or [])
    names = [f"n_{r.kind}" for r in RULES[:BASE]]
    if clash := {id_col, *names, "base_spans", "spans", "clean_text"} & set(carry):
        raise ValueError(f"carried columns clash with the result's: {sorted(clash)}")
    schema = T.StructType([docs.schema[id_col], *(T.StructField(n, T.LongType()) for n in names),
                           *(T.StructField(n, T.StringType()) for n in ("base_spans", "spans", "clean_text")),
                           *(docs.schema[c] for c in carry)])
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(spans):
            return ",".join(f"{RULES[k].kind}:{s}:{e}" for s, k, e in spans)

        for batch in batches:
            column = batch["_text"]
            found = find(X.as_bytes(column))
            if any(found):
                column = pa.array([redact(t, s) if s else t for t, s in zip(column.to_pylist(), found, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], *(pa.array([sum(x[1] == k for x in s) for s in found], pa.int64()) for k in range(BASE)),
                 pa.array([joined([x for x in s if x[1] < BASE]) for s in found], pa.string()),
                 pa.array([joined(s) for s in found], pa.string()), column.cast(pa.string()),
                 *(batch[f"_c{k}"] for k in range(len(carry)))], schema=arrow)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"),
                       *(F.col(c).alias(f"_c{k}") for k, c in enumerate(carry))).mapInArrow(scan, schema)
