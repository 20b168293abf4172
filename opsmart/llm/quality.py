"""Quality of texts: statistics, fixed rules and gradient-boosted trees over the statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import arrow_map, bounded_sample, id_and_text
from .words import SPACE, Texts, Words, slices

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
DIGITS = np.zeros(256, dtype=bool)
DIGITS[list(b"0123456789")] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[list(range(ord("A"), ord("Z") + 1))] = True
ENDS = np.zeros(256, dtype=bool)
ENDS[list(b".!?")] = True
STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80  # not a continuation byte of UTF-8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_digits",
          "n_upper", "n_ends", "n_long_words", "n_short_words", "n_marks")
#: Features of a text, and the direction in which the score may move with each: 1 never down, -1 never up, 0 free.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "line_words": 0,
    "distinct_share": 0, "digit_share": 0, "upper_share": 0, "sentence_share": 0, "long_share": -1, "short_share": 0,
    "mark_share": 0, "distinct_root": 0,
}


def _repeat_words(codes: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """Words of each text inside a three-word window that the text has twice or more."""
    out = np.zeros(n_texts, np.int64)
    if len(codes) < 3:
        return out
    pair, _ = pd.factorize(codes[:-1].astype(np.int64) << 32 | codes[1:])
    whole = owner[:-2] == owner[2:]
    window, _ = pd.factorize(pair[:-1].astype(np.int64) << 32 | codes[2:])
    key, _ = pd.factorize(window.astype(np.int64) << 32 | owner[:-2])
    key[~whole] = -1
    times = np.bincount(key[whole], minlength=1) if whole.any() else np.zeros(1, np.int64)
    repeated = whole & (times[np.maximum(key, 0)] >= 2)
    covered = np.zeros(len(codes), dtype=bool)
    for shift in range(3):
        covered[shift:len(codes) - 2 + shift] |= repeated
    return np.bincount(owner[covered], minlength=n_texts)


def text_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The numbers in ``COUNTS`` for each text of an Arrow column."""
    texts = Texts.of(column)
    words, data = Words.of(texts), texts.data
    owner, n = words.owner, len(texts)
    codes, _ = pd.factorize(words.hashes(data))
    distinct = pd.unique(owner.astype(np.int64) << 32 | codes) >> 32 if len(codes) else np.zeros(0, np.int64)
    lengths = words.ends - words.starts
    solid = ~SPACE[data]
    lines, repeats = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, text in enumerate(column.to_pylist()):
        kept = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
        lines[i], repeats[i] = len(kept), len(kept) - len(set(kept))
    last = data[words.ends - 1] if len(owner) else np.zeros(0, np.uint8)
    count = lambda mask: np.bincount(owner[mask], minlength=n)
    return {
        "n_words": words.counts, "word_chars": texts.total(solid & STARTS_CHAR[data]),
        "n_symbols": texts.total(SYMBOLS[data]), "n_dup_lines": repeats,
        "n_repeat_words": _repeat_words(codes, owner, n), "n_lines": lines,
        "n_distinct": np.bincount(distinct, minlength=n), "n_digits": texts.total(DIGITS[data]),
        "n_upper": texts.total(UPPER[data]), "n_ends": count(ENDS[last]), "n_long_words": count(lengths > 20),
        "n_short_words": count(lengths <= 3), "n_marks": count(last == ord(",")),
    }


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """One row per input row: (doc_id, the columns in ``COUNTS``, and the columns named in ``more``).

    A null text has no words; repeated rows stay; whole texts are read, one slice of a batch at a time.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, 1):
                yield text_counts(part.column(1)) | {c: part.column(c) for c in ("doc_id", *more)}

    kinds = {n: t for n, t in df.dtypes}
    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"`{c}` {kinds[c]}" for c in more)])
    return arrow_map(id_and_text(df, id_col, text_col, *more), schema, rows)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rows of ``FEATURES`` from the numbers of ``text_counts``."""
    c = {k: np.asarray(counts[k], dtype=float) for k in COUNTS}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    lines = np.maximum(c["n_lines"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_words"] / lines, c["n_distinct"] / words, c["n_digits"] / chars,
        c["n_upper"] / chars, c["n_ends"] / words, c["n_long_words"] / words, c["n_short_words"] / words,
        c["n_marks"] / words, c["n_distinct"] / np.sqrt(words),
    ])


@dataclass
class Trees:
    """Trees as flat arrays: node i of a tree goes left (to ``left``) where feature <= threshold.

    A leaf has itself as both children, so all rows take ``depth`` steps without a branch.
    """

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        row = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[row, self.feature[at]] <= self.threshold[at]
                at = np.where(low, self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


@dataclass
class _Growing:
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def leaf(self) -> int:
        i = len(self.value)
        self.feature.append(0)
        self.threshold.append(np.inf)
        self.left.append(i)
        self.right.append(i)
        self.value.append(0.0)
        return i


def fit_trees(
    x: np.ndarray, y: np.ndarray, directions: list[int], rounds: int = 60, depth: int = 4, rate: float = 0.15,
    bins: int = 64, smooth: float = 1.0, least: int = 8,
) -> Trees:
    """Boosted trees for the logistic loss on binned features.

    A split on a feature with a direction is taken only if its two values are in that order, and the middle of
    the two bounds all values below either side; so the score never moves against a direction.
    """
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for col in x.T]
    binned = np.column_stack([np.searchsorted(e, col, "left") for e, col in zip(edges, x.T)]) if len(x) else x
    grown, roots = _Growing(), []
    margin = np.full(len(y), base)
    for _ in range(rounds if len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, p * (1 - p)
        root = grown.leaf()
        roots.append(root)
        open_nodes = [(root, np.arange(len(y)), -np.inf, np.inf, depth)]
        while open_nodes:
            node, rows, low, high, steps = open_nodes.pop()
            g, h = slope[rows], bend[rows]
            mean = float(np.clip(g.sum() / (h.sum() + smooth), low, high))
            best = _best_split(binned[rows], g, h, edges, directions, smooth, least, low, high) if steps else None
            if best is None:
                grown.value[node] = rate * mean
                margin[rows] += rate * mean
                continue
            f, cut, v_left, v_right = best
            goes_left = binned[rows, f] <= cut
            grown.feature[node], grown.threshold[node] = f, float(edges[f][cut])
            grown.left[node], grown.right[node] = grown.leaf(), grown.leaf()
            middle = (v_left + v_right) / 2
            left_bounds, right_bounds = (low, high), (low, high)
            if directions[f] > 0:
                left_bounds, right_bounds = (low, min(high, middle)), (max(low, middle), high)
            elif directions[f] < 0:
                left_bounds, right_bounds = (max(low, middle), high), (low, min(high, middle))
            open_nodes.append((grown.left[node], rows[goes_left], *left_bounds, steps - 1))
            open_nodes.append((grown.right[node], rows[~goes_left], *right_bounds, steps - 1))
    arrays = (np.array(roots, np.int64), np.array(grown.feature, np.int64), np.array(grown.threshold),
              np.array(grown.left, np.int64), np.array(grown.right, np.int64), np.array(grown.value))
    return Trees(base, depth, *arrays)


def _best_split(binned, g, h, edges, directions, smooth, least, low, high):
    """Feature, last bin of the left side and both sides' values of the most useful allowed split."""
    best, found = 1e-6, None
    parent = g.sum() ** 2 / (h.sum() + smooth)
    for f, cuts in enumerate(edges):
        if not len(cuts):
            continue
        column = binned[:, f]
        n = np.cumsum(np.bincount(column, minlength=len(cuts) + 1))[:-1]
        gl = np.cumsum(np.bincount(column, weights=g, minlength=len(cuts) + 1))[:-1]
        hl = np.cumsum(np.bincount(column, weights=h, minlength=len(cuts) + 1))[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        left, right = np.clip(gl / (hl + smooth), low, high), np.clip(gr / (hr + smooth), low, high)
        gain = 2 * (gl * left + gr * right) - (hl + smooth) * left**2 - (hr + smooth) * right**2 - parent
        allowed = (n >= least) & (len(g) - n >= least) & (directions[f] * (right - left) >= 0)
        gain = np.where(allowed, gain, -np.inf)
        cut = int(gain.argmax())
        if gain[cut] > best:
            best, found = gain[cut], (f, cut, float(left[cut]), float(right[cut]))
    return found


def fit_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = 20_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> Trees:
    """Trees fitted on the statistics of about ``sample`` labelled texts at most (``common.bounded_sample``).

    Without any labelled text the score is 0.5 throughout.
    """
    chosen = bounded_sample(docs, labels, label_col, sample, id_col, text_col)
    rows = text_statistics(chosen, "doc_id", "text", "y").toPandas().sort_values(["doc_id", "y"])
    x = features({c: rows[c].to_numpy() for c in COUNTS})
    return fit_trees(x, rows["y"].to_numpy().astype(float), list(FEATURES.values()))


def judge(
    df: DataFrame, trees: Trees, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
    min_words: int = 50, max_repeat_percent: int = 50,
) -> DataFrame:
    """(doc_id, the numbers in ``COUNTS``, quality, base_failed, kept) for every row.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` in a hundred of them repeated.
    ``kept``: the fixed rules hold and the trees' quality is at least ``threshold``. A null or empty text
    fails by its length; repeated rows are judged alike; a null id stays null.
    """
    model = df.sparkSession.sparkContext.broadcast(trees)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, 1):
                c = text_counts(part.column(1))
                quality = model.value.score(features(c))
                failed = (c["n_words"] < min_words) | (100 * c["n_repeat_words"] > max_repeat_percent * c["n_words"])
                kept = ~failed & (quality >= threshold)
                yield c | {"doc_id": part.column(0), "quality": quality, "base_failed": failed, "kept": kept}

    counts = ", ".join(f"{c} long" for c in COUNTS)
    schema = f"doc_id long, {counts}, quality double, base_failed boolean, kept boolean"
    return arrow_map(id_and_text(df, id_col, text_col), schema, rows)
