"""Secrets in texts: patterns, and windows of high entropy over candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, id_and_text

# Kinds of the patterns, in the order in which equal starts are listed.
BASE_KINDS = ("assign", "access", "hex")
SPANS = "array<struct<kind:string,start:long,end:long>>"
ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_KEYS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class CharacterClass:
    """A class of characters; windows of ``size`` of them are reported from ``bits`` per character on.

    Each alphabet has its own bound, which random strings of that size reach and words joined to one do not. What is
    reported must hold a match of every pattern in ``needs``, since words rarely mix digits and both cases.
    """

    kind: str
    run: str
    size: int
    bits: float
    needs: tuple[str, ...] = ("[0-9]", "[A-Za-z]")


CLASSES = (
    CharacterClass("entropy_hex", r"[0-9a-f]{20,}|[0-9A-F]{20,}", 20, 3.1),
    CharacterClass("entropy_mixed", r"[A-Za-z0-9+/_=-]{20,}", 20, 3.6, ("[0-9]", "[A-Z]", "[a-z]")),
    CharacterClass("entropy_base36", r"[0-9a-z]{20,}|[0-9A-Z]{20,}", 20, 3.4, ("[0-9].*[0-9]", "[A-Za-z].*[A-Za-z]")),
    CharacterClass("entropy_base32", r"[2-7A-Z]{20,}|[2-7a-z]{20,}", 20, 3.4),
)

#: Parts of candidates that are no secrets: UUIDs, dates and times, sample words and sample runs, a published sample
#: key, and whole candidates that are paths of plain words. What lies around such a part is still searched.
ALLOWED = (
    r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])",
    r"(?<![0-9A-Za-z])[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T_-][0-9A-Z_-]+)?(?![0-9A-Za-z])",
    r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
    r"EXAMPLE|example|0123456789|abcdefghij|[Xx]{8,}",
    r"\A/?(?:[a-z0-9_-]{1,15}/)+[a-z0-9_-]{0,15}\Z",
)


def high_entropy(text: str, size: int, bits: float) -> list[tuple[int, int]]:
    """Joined windows of ``size`` characters with at least ``bits`` of Shannon entropy.

    The sum of c * log2(c) over the characters' counts changes by one entering and one
    leaving character per step, so a text of any length takes a constant time per character.
    """
    weight = [0.0] + [c * math.log2(c) for c in range(1, size + 1)]
    most = (math.log2(size) - bits) * size + 1e-9
    counts: dict[str, int] = {}
    total, found = 0.0, []
    for i, new in enumerate(text):
        if i >= size:
            old = text[i - size]
            counts[old] -= 1
            total += weight[counts[old]] - weight[counts[old] + 1]
        c = counts.get(new, 0)
        counts[new] = c + 1
        total += weight[c + 1] - weight[c]
        if i + 1 >= size and total <= most:
            start = i + 1 - size
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """Matches of the three patterns, leftmost and without overlap within a kind."""
    low = text.lower()
    spans = []
    if any(k in low for k in ASSIGN_KEYS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return spans + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


class Scanner:
    """Finds spans in one text. Made once per task."""

    def __init__(self, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED):
        self.classes = [(c, re.compile(c.run), [re.compile(n) for n in c.needs]) for c in classes]
        self.allowed = re.compile("|".join(f"(?:{p})" for p in allowed)) if allowed else None
        self.rank = {k: i for i, k in enumerate((*BASE_KINDS, *(c.kind for c in classes)))}

    def __call__(self, text: str) -> list[tuple[int, int, str]]:
        spans = pattern_spans(text)
        base = list(spans)
        for candidate in CANDIDATE.finditer(text):
            for begin, end_ in self._searched(candidate[0]):
                piece, offset = candidate[0][begin:end_], candidate.start() + begin
                for kind, run, needs in self.classes:
                    for part in run.finditer(piece):
                        at = offset + part.start()
                        for start, end in high_entropy(part[0], kind.size, kind.bits):
                            found = part[0][start:end]
                            if not all(n.search(found) for n in needs):
                                continue
                            if not any(s <= at + start and at + end <= e for s, e, _ in base):
                                spans.append((at + start, at + end, kind.kind))
                                base.append(spans[-1])
        return sorted(spans, key=lambda s: (s[0], self.rank[s[2]], s[1]))


    def _searched(self, run: str) -> list[tuple[int, int]]:
        """The parts of a candidate that the allow-list leaves, of 20 and more characters."""
        parts, at = [], 0
        for m in self.allowed.finditer(run) if self.allowed else ():
            parts.append((at, m.start()))
            at = m.end()
        return [(a, b) for a, b in (*parts, (at, len(run))) if b - a >= 20]


def secret_spans(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """Secrets of every text: (doc_id, secrets), code points, end exclusive, by start, then kind.

    Three patterns (assignments to a password-like name, access keys, long hexadecimal runs), then
    strings of 20 or more key characters: within them every window of a character class whose
    Shannon entropy reaches the class's bound is reported, joined with windows it touches. Windows
    inside a span found before add nothing; parts on the allow-list are cut out first, of pattern matches never. Strings
    of letters alone are not reported, nor are shorter ones than 20 characters.

    One row per input row, so repeated rows stay repeated. A null or empty text has no spans, a null id
    stays null, an empty table gives an empty one, and other columns are not read. Memory: one text.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        scan = Scanner(classes, allowed)
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e} for s, e, k in scan(text)] for text in batch.column(1).to_pylist()
            ]
            yield {"doc_id": batch.column(0), "secrets": found}

    return arrow_map(id_and_text(df, id_col, text_col), f"doc_id long, secrets {SPANS}", rows)


def redact(
    df: DataFrame,
    text_col: str = "text",
    mask: str = "[SECRET]",
    classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """The same rows and columns with every secret span (overlapping ones joined) replaced by ``mask``.

    A null text stays null; a text without secrets is unchanged.
    """
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(classes, allowed)
        for batch in batches:
            clean = [None if t is None else _masked(t, scan(t), mask) for t in batch.column(place).to_pylist()]
            arrays = [*batch.columns]
            arrays[place] = pa.array(clean, type=batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return df.mapInArrow(run, df.schema)


def _masked(text: str, spans: list[tuple[int, int, str]], mask: str) -> str:
    parts, at = [], 0
    joined: list[list[int]] = []
    for start, end, _ in spans:
        if joined and start < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    for start, end in joined:
        parts += [text[at:start], mask]
        at = end
    return "".join([*parts, text[at:]])


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
