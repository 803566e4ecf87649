"""Personal data: base patterns, and a skip-chain conditional random field over each document.

The patterns find spans that are certain.  The field then decides about what they
leave: number-like and address-like candidates whose form no pattern accepts (other
separators, a country code left out, no full domain).  Its variables are all base spans,
clamped to their kind, and all candidates, with the labels "none" and the four kinds.

* Unary potentials score a candidate's form; alone they always favour "none".
* Chain potentials join neighbouring variables.
* Skip potentials join distant variables that repeat or resemble each other: the same
  digits, the same last digits, or the same local part of an address.  Each variable
  is linked to the next one with its key, so a number repeated n times costs n edges.
  Candidates support each other, so a repeated one can become a span without any base span.

Loopy sum-product message passing runs over all documents of a batch at once, as one
graph of separate parts.  A candidate whose most probable label is a kind becomes a span.

Tokens without a digit or ``@`` have no form that any kind allows; their label is
certain, so leaving them out of the graph does not change the others.  The potentials are
fixed and stated in :class:`Potentials`; there are no labelled spans to learn them from.

Defined results: a null text is empty and has no spans.  Offsets are code points, ends
exclusive.  Base spans of different kinds may overlap; added ones never overlap a base
span.  A result column named like an input column replaces it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import text_slices, without

# The kinds in the order in which they are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
# The local part before an "@" is found from the "@" on, so that texts without one cost a search for one character.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always takes whole runs of digits, so starts inside a run and giving digits back are ruled out beforehand.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# What the field may decide about: 7 to 19 digits with up to two separators between them, or something before an "@".
_NUMBER = re.compile(r"(?<![A-Za-z0-9])[+(]?[0-9](?:[ ().\-_/]{0,2}[0-9])*(?![A-Za-z0-9])")
_LEAST, _MOST, _TAIL = 7, 19, 7


@dataclass(frozen=True)
class Potentials:
    """Logarithms of the field's potentials."""

    none: float = 3.0  # any candidate: in favour of no label
    card_form: float = 1.0  # 12 to 19 digits
    phone_form: float = 1.0  # 7 to 15 digits
    ip_form: float = 1.0  # four groups of digits, none above 255
    email_form: float = 1.0  # a local part before an "@"
    impossible: float = -30.0  # a label whose form does not fit
    chain: float = 0.2  # neighbours with the same kind
    same: float = 6.0  # repeated content with the same kind
    similar: float = 4.5  # the same last digits with the same kind, phones only
    rounds: int = 12
    near: int = 3  # characters between neighbours


Span = tuple[int, int, int]  # start, end, number of the kind


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns that pass their checks, by start, then kind."""
    found: list[Span] = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            last = match.end()
            found.append((start, last, 0))
        at = text.find("@", max(at + 1, last))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(_small(part) for part in m[0].split(".")):
                found.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), 2))
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, bool]]:
    """Unmatched number-like (False) and address-like (True) stretches, apart from the base spans."""
    out, gaps, last = [], [], 0
    for start, end, _ in sorted(base):
        if start > last:
            gaps.append((last, start))
        last = max(last, end)
    gaps.append((last, len(text)))
    for a, b in gaps:
        for m in _NUMBER.finditer(text, a, b):
            if _LEAST <= m.end() - m.start() and _LEAST <= sum(c.isdigit() for c in m[0]) <= _MOST:
                out.append((m.start(), m.end(), False))
        at = text.find("@", a, b)
        while at >= 0:
            start, end = at, at + 1
            while start > a and text[start - 1] in _LOCAL:
                start -= 1
            while end < b and text[end] in _LOCAL:
                end += 1
            if start < at:
                out.append((start, end, True))
            at = text.find("@", end, b)
    return sorted(out)


def _unary(text: str, address: bool, p: Potentials) -> list[float]:
    if address:
        return [p.none, p.email_form, p.impossible, p.impossible, p.impossible]
    groups = _DIGIT.search(text) and [g for g in _NOT_DIGIT.split(text) if g]
    n = sum(len(g) for g in groups)
    ip = len(groups) == 4 and all(_small(g) for g in groups)
    return [
        p.none, p.impossible, p.ip_form if ip else p.impossible, p.card_form if 12 <= n <= 19 else p.impossible,
        p.phone_form if 7 <= n <= 15 else p.impossible,
    ]


def _keys(text: str, address: bool) -> list[tuple[str, bool]]:
    """What makes two variables alike: (key, whether it only is a similar one)."""
    if address:
        return [("@" + text.partition("@")[0].lower(), False)]
    digits = _NOT_DIGIT.sub("", text)
    return [(digits, False), ("~" + digits[-_TAIL:], True)] if len(digits) >= _LEAST else []


class Field:
    """Graph of one batch: variables with unary potentials, edges with a weight per label."""

    def __init__(self, potentials: Potentials) -> None:
        self.p = potentials
        self.unary: list[list[float]] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.weights: list[list[float]] = []

    def add_document(self, text: str, base: list[Span], open_: list[tuple[int, int, bool]]) -> int:
        """Number of the first variable; they are in order: base spans, then candidates."""
        p, first = self.p, len(self.unary)
        spots = []
        for start, end, kind in base:
            self.unary.append([0.0 if y == kind + 1 else p.impossible for y in range(5)])
            spots.append((start, end, len(self.unary) - 1, kind == 0))
        for start, end, address in open_:
            self.unary.append(_unary(text[start:end], address, p))
            spots.append((start, end, len(self.unary) - 1, address))
        spots.sort()
        for (_, end, i, _), (start, _, j, _) in zip(spots, spots[1:], strict=False):
            if 0 <= start - end <= p.near:
                self._edge(i, j, [0.0, *[p.chain] * 4])
        seen: dict[str, int] = {}
        for start, end, i, address in spots:
            for key, similar in _keys(text[start:end], address):
                if key in seen:
                    self._edge(seen[key], i, [0.0, 0.0, 0.0, 0.0, p.similar] if similar else [0.0, *[p.same] * 4])
                seen[key] = i
        return first

    def _edge(self, i: int, j: int, weights: list[float]) -> None:
        self.left.append(i)
        self.right.append(j)
        self.weights.append(weights)

    def labels(self) -> np.ndarray:
        """Most probable label of each variable after message passing."""
        unary = np.array(self.unary, dtype=np.float64).reshape(-1, 5)
        if not self.left:
            return unary.argmax(axis=1)
        source = np.array(self.left + self.right)
        target = np.array(self.right + self.left)
        gain = np.expm1(np.array(self.weights * 2))
        n = len(self.left)
        back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
        message = np.zeros((2 * n, 5))
        for _ in range(self.p.rounds):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = belief[source] - message[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            sent = np.log(out.sum(axis=1, keepdims=True) + out * gain)
            message = 0.5 * message + 0.5 * (sent - sent.max(axis=1, keepdims=True))
        belief = unary.copy()
        np.add.at(belief, target, message)
        return belief.argmax(axis=1)


def _batch_spans(texts: list[str], potentials: Potentials) -> Iterator[list[tuple[int, int, int, bool]]]:
    """All spans per text: start, end, kind, whether it is a base span."""
    field, work = Field(potentials), []
    for text in texts:
        base = base_spans(text)
        # Every candidate has a digit or an "@".  A base span is not needed: repeated candidates support each other.
        open_ = candidates(text, base) if "@" in text or _DIGIT.search(text) else []
        work.append((base, open_, field.add_document(text, base, open_) if open_ else -1))
    labels = field.labels()
    for base, open_, first in work:
        spans = [(*s, True) for s in base]
        for k, (start, end, _) in enumerate(open_):
            label = int(labels[first + len(base) + k])
            if label:
                spans.append((start, end, label - 1, False))
        yield sorted(spans, key=lambda s: (s[0], s[2]))


SPAN_TYPE = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find_personal_data(docs: DataFrame, *, text: str = "text", potentials: Potentials = Potentials()) -> DataFrame:
    """Add ``spans``: kind, start, end and whether a base pattern found it, by start, then kind."""
    kind_of = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    @F.arrow_udf(SPAN_TYPE)
    def find(texts: pa.Array) -> pa.Array:
        out = []
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        for part in text_slices(batch, "text"):
            for spans in _batch_spans(part.column(0).to_pylist(), potentials):
                out.append([{"kind": KINDS[k], "start": a, "end": b, "base": known} for a, b, k, known in spans])
        return pa.array(out, type=pa.list_(kind_of))

    return without(docs, "spans").withColumn("spans", find(F.coalesce(docs[text], F.lit(""))))


def describe(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, *, text: str = "text", mask: str = "[{}]") -> DataFrame:
    """Replace every span of :func:`find_personal_data` by its masked kind; of overlapping spans the first counts."""

    @F.pandas_udf("string")
    def cut(texts, spans):
        out = []
        for value, found in zip(texts, spans, strict=True):
            if value is None:
                out.append(None)
                continue
            parts, last = [], 0
            for s in found:
                if s["start"] >= last:
                    parts += [value[last:s["start"]], mask.format(s["kind"])]
                    last = s["end"]
            out.append("".join([*parts, value[last:]]))
        import pandas as pd

        return pd.Series(out, dtype=object)

    return find_personal_data(docs, text=text).withColumn(text, cut(text, "spans")).drop("spans")
