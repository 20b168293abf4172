"""How filters of documents interact: what each removes in every order, and its exact Shapley value."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, id_and_text

FILTERS = "ABCDE"
UPPER, SYMBOLS, LATER_BYTES = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))
COPY = 1 << FILTERS.index("E")
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails: few words, repeated words, capitals, symbols."""
    words = text.split()  # of bytes: space and \\t to \\r part words
    n, chars = len(words), len(text.translate(None, LATER_BYTES))
    capitals = len(text) - len(text.translate(None, UPPER))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return (n < 200) | (100 * len(set(words)) < 50 * n) << 1 | (100 * capitals > 3 * chars) << 2 | (symbols > 0) << 3


def failing_texts(df: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(doc_id, part, fails, digest): failed filters A to D and a digest of the text, one row per input row."""
    docs = id_and_text(df, id_col, text_col, part_col)
    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit(""))
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("text"), part.alias("part"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            fails, digests = [], []
            for value in batch.column("text"):  # one text at a time
                text = value.as_buffer().to_pybytes()
                fails.append(failures(text))
                digests.append(hashlib.blake2b(text, digest_size=16).digest())
            yield {"doc_id": batch.column("doc_id"), "part": batch.column("part"), "fails": fails, "digest": digests}

    return arrow_map(docs, "doc_id long, part string, fails int, digest binary", rows)


def _labelled(labels: DataFrame, id_col: str) -> DataFrame:
    """(doc_id, good, toxic), one row per id: 1 where any of its labels says so."""
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), "quality", "toxic").filter("doc_id IS NOT NULL")
    return known.groupBy("doc_id").agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))


def failure_counts(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """(part, fails, docs, good, toxic): documents by the exact set of filters A to E that they fail.

    Rows of one text are counted together per part and labels before they meet, with the smallest id and its rows, so
    a text with very many copies is a few rows: all rows but those of the text's smallest id are later copies.
    """
    same = ("digest", "fails", "part")
    rows = failing_texts(documents, id_col, text_col, part_col).groupBy("doc_id", *same).agg(F.count("*").alias("n"))
    rows = rows.join(_labelled(labels, id_col), "doc_id", "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in ("good", "toxic")}
    )
    known = F.col("doc_id").isNotNull()
    groups = rows.groupBy(*same, "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("with_id"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
    )
    # A text has at most four of these rows per part.
    texts = groups.withColumn("first_id", F.min("first.doc_id").over(Window.partitionBy("digest")))
    originals = F.when(F.col("first.doc_id") == F.col("first_id"), F.col("first.n")).otherwise(0)
    copies = F.col("with_id") - originals
    either = F.array(
        F.struct(F.col("fails").alias("fails"), (F.col("n") - copies).alias("docs")),
        F.struct(F.col("fails").bitwiseOR(COPY).alias("fails"), copies.alias("docs")),
    )
    counted = texts.select("part", "good", "toxic", F.inline(either))
    return counted.groupBy("part", "fails").agg(
        F.sum("docs").alias("docs"), F.sum(F.col("docs") * F.col("good")).alias("good"), F.sum(F.col("docs") * F.col("toxic")).alias("toxic"),
    )


def coalition_removals(counts: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """(part, coalition, docs, removed, good, toxic): what each of the 32 sets of filters removes, as a bit set each."""
    sets = F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))
    hit = F.col("fails").bitwiseAND(F.col("coalition")) != 0
    each = counts.withColumn("coalition", F.explode(sets))
    removed = lambda c: F.sum(F.when(hit, F.col(c)).otherwise(0))
    return each.groupBy("part", "coalition").agg(
        F.sum("docs").alias("docs"), removed("docs").alias("removed"), removed("good").alias("good"), removed("toxic").alias("toxic"),
    )


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Solution of a regular system of linear equations, in rationals."""
    rows = [[*m, r] for m, r in zip(matrix, right)]
    n = len(rows)
    for i in range(n):
        pivot = next(j for j in range(i, n) if rows[j][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [v / rows[i][i] for v in rows[i]]
        for j in range(n):
            if j != i and rows[j][i]:
                rows[j] = [a - rows[j][i] * b for a, b in zip(rows[j], rows[i])]
    return [row[-1] for row in rows]


def shapley_values(removed: list[int]) -> list[Fraction]:
    """Shapley values from the values of all coalitions (index: bit set), by constrained least squares.

    They are the additive model that fits the coalitions best under the kernel weights, among those whose values add
    up to that of all filters. The normal equations carry that constraint with a multiplier; solved in rationals they
    are exact. A coalition's value is relative to that of the empty one.
    """
    n = len(removed).bit_length() - 1
    if n == 1:
        return [Fraction(removed[1] - removed[0])]
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [Fraction(0)] * (n + 1)
    for s in range(1, (1 << n) - 1):
        size = s.bit_count()
        weight = Fraction(n - 1, comb(n, size) * size * (n - size))
        members = [i for i in range(n) if s >> i & 1]
        for i in members:
            right[i] += weight * (removed[s] - removed[0])
            for j in members:
                matrix[i][j] += weight
    for i in range(n):
        matrix[i][n] = matrix[n][i] = Fraction(1)
    right[n] = Fraction(removed[-1] - removed[0])
    return solve(matrix, right)[:n]


def audit_part(part: str, docs: int, removed: list[int], good: list[int], toxic: list[int], filters: str = FILTERS) -> list[tuple]:
    """Every step of every order of the filters, from the values of all coalitions. Rows as in ``STEPS``."""
    n, everyone = len(filters), (1 << len(filters)) - 1
    shares = [int(v * factorial(n)) for v in shapley_values(removed)]  # n! orders: whole numbers
    rows = []
    for order in permutations(range(n)):
        name, before = "".join(filters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after, alone = before | 1 << i, 1 << i
            here = removed[after] - removed[before]
            rows.append((
                part, name, step, docs - removed[after], here, removed[alone] - here,
                removed[everyone] - removed[everyone & ~alone], good[after] - good[before], toxic[after] - toxic[before], shares[i],
            ))
            before = after
    return rows


def audit(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """Kept and removed documents of every step in all 120 orders of the filters A to E, for each part.

    One row per part, order and step, zeros included: (part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley). ``shapley`` is the filter's removals summed over all orders. A null text is empty
    and a null part is the empty one; equal rows count each. A row without an id is neither an earlier nor a later copy
    and has no labels; rows of the same id and text are no copies of each other. Of several labels of an id any 1 counts.
    Without documents there are no parts and no rows.
    """
    tables = coalition_removals(failure_counts(documents, labels, id_col, text_col, part_col))
    each = F.struct("coalition", "removed", "good", "toxic")
    parts = tables.groupBy("part").agg(F.max("docs").alias("docs"), F.sort_array(F.collect_list(each)).alias("sets"))  # 32 a part

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, docs, sets in frame.itertuples(index=False):
                values = [[int(s[c]) for s in sets] for c in ("removed", "good", "toxic")]
                yield pd.DataFrame(audit_part(part, int(docs), *values), columns=[c.split()[0] for c in STEPS.split(", ")])

    return parts.mapInPandas(rows, STEPS)
