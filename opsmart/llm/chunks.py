"""Passages that several documents share, found with content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_map, id_and_text, materialize
from .words import SPACE, Texts, Words, mix, slices

GEAR_WINDOW = 32
GEAR = np.random.default_rng(2024).integers(0, 1 << 32, 256, dtype=np.uint32)
GEAR[0] = 0  # fills the gaps between texts


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash h = 2 * h + gear[byte] at every byte, in 32 bits: the last 32 bytes decide it.

    Sums over 1, 2, 4, 8, 16 and 32 bytes are built from each other, for all bytes at once.
    """
    h = GEAR[data]
    width = 1
    while width < GEAR_WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h, width = longer, 2 * width
    return h


def chunk_arrays(texts: Texts, share: float = 1 / 3, least_words: int = 3, max_words: int = 24) -> dict[str, np.ndarray]:
    """Chunks of all texts: a chunk ends with a word at which the rolling hash is small, or with the text.

    A ``share`` of the words has a small hash; one is passed over if another stands less than ``least_words``
    before it, so a chunk has at least so many words, and 6.75 on average with the given values.
    The hash sees the bytes of the words with one space between them, so the ends follow the content: an
    insertion moves the ends near it and no others. Where none comes for ``max_words`` words, as in a word said over
    and over, a chunk ends there too.
    """
    words, n = Words.of(texts), len(texts)
    lengths, owner = words.ends - words.starts, words.owner
    starts = np.cumsum(lengths + 1) - lengths - 1 + GEAR_WINDOW * (owner + 1)
    spaced = np.zeros((int(starts[-1] + lengths[-1]) if len(starts) else 0) + 1, np.uint8)
    solid = np.cumsum(np.bincount(starts, minlength=len(spaced) + 1) - np.bincount(starts + lengths, minlength=len(spaced) + 1))
    spaced[solid[:-1] > 0] = texts.data[~SPACE[texts.data]]
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    spaced[starts[inner] + lengths[inner]] = 0x20
    at_end = gear_hashes(spaced)[starts + lengths - 1]
    small = (at_end < np.uint32(share * (1 << 32))).astype(np.int8)
    closes = small > 0
    for back in range(1, least_words):
        same = owner[back:] == owner[:-back]
        closes[back:] &= ~(same & (small[:-back] > 0))
    closes[words.bounds[1:][words.counts > 0] - 1] = True
    last = np.flatnonzero(closes)
    since = np.arange(len(owner)) - np.repeat(np.concatenate([[0], last[:-1] + 1]), np.diff(last, prepend=-1)) if len(last) else last
    closes |= since % max_words == max_words - 1
    last = np.flatnonzero(closes)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    size = last - first + 1
    place = np.arange(len(owner)) - np.repeat(first, size)
    h = words.hashes(texts.data)
    one = np.add.reduceat(mix(h ^ mix(place.astype(np.uint64))), first) if len(first) else h
    two = np.add.reduceat(mix(h + mix(place.astype(np.uint64) + np.uint64(1 << 40))), first) if len(first) else h
    points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    of = owner[first]
    base = points[texts.offsets[of]]
    many = np.bincount(of, minlength=n)
    return {
        "owner": of, "digest": one.astype(np.int64), "check": (two >> np.uint64(32)).astype(np.uint32).view(np.int32),
        "number": np.arange(len(of)) - (np.cumsum(many) - many)[of], "words": size,
        "start": points[words.starts[first]] - base, "end": points[words.ends[last]] - base,
    }


def chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per chunk: (doc_id, row, number, digest, check, words, start, end), positions in code points.

    ``row`` tells apart rows with the same id, ``digest`` and ``check`` are 96 bits of the chunk's words. Rows without an id
    take no part; null and empty texts have no chunks.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 1):
                c = chunk_arrays(Texts.of(part.column(1)))
                row = seen + c["owner"]
                seen += part.num_rows
                yield c | {"doc_id": part.column(0).take(pa.array(c["owner"])), "row": row}

    schema = "doc_id long, row long, number int, digest long, check int, words int, start int, end int"
    known = id_and_text(df, id_col, text_col).filter("doc_id IS NOT NULL")
    return arrow_map(known, schema, rows)


def repeated_passages(
    df: DataFrame, min_words: int = 15, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Passages that more than one document has: (doc_id, row, start, end, words, chunks, first_doc_id, later).

    A chunk is repeated if another document has one with the same digest. Runs of repeated chunks with at
    least ``min_words`` words are passages. The chunks around a passage's ends reach beyond it, so of the passages of 51 words
    one or two in a thousand fall below ``min_words``, of those of 60 words one in ten thousand. ``later`` marks what to
    remove: chunks that a document with a smaller id has. A passage has a row for each stretch of chunks that are alike in
    that, so every chunk stays in its first document. A stretch to remove may be shorter than ``min_words``; one that stays,
    as where other words end the copies, has a row from ``min_words`` on. ``first_doc_id`` is the smallest id of the stretch.

    Repeats inside one document do not count, nor do copies of its row under the same id; whole texts are chunked. Digests are
    counted before the shuffle, written, and joined back, so a passage that a third of all documents share is
    only a skewed join, which Spark splits. An empty table gives an empty one.
    """
    found = chunks(df, id_col, text_col)
    ends = found.groupBy("digest", "check").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("__last"))
    shared = materialize(ends.filter(F.col("first_doc_id") < F.col("__last")).drop("__last"))
    hits = found.join(shared, ["digest", "check"])
    in_order = W.partitionBy("doc_id", "row").orderBy("number")
    later = F.col("first_doc_id") < F.col("doc_id")
    runs = hits.withColumn("later", later).withColumn("__run", F.col("number") - F.row_number().over(in_order))
    turns = F.sum(F.coalesce(F.col("later") != F.lag("later").over(in_order), F.lit(False)).cast("int"))
    stretch = turns.over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow))
    stretches = runs.withColumn("__stretch", stretch).groupBy("doc_id", "row", "__run", "__stretch").agg(
        F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"),
        F.sum("words").alias("words"), F.count("*").alias("chunks"), F.min("first_doc_id").alias("first_doc_id"),
        F.first("later").alias("later"),
    )
    whole = F.sum("words").over(W.partitionBy("doc_id", "row", "__run"))
    return stretches.withColumn("__whole", whole).filter(F.when(F.col("later"), F.col("__whole")).otherwise(F.col("words")) >= min_words).select(
        "doc_id", "row", "start", "end", "words", "chunks", "first_doc_id", "later"
    )


def without_repeats(df: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with the ``later`` passages of each document cut out; ids must be unique."""
    cuts = passages.filter("later").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    texts = id_and_text(df, id_col, text_col).join(cuts, "doc_id", "left")
    kept = F.aggregate(
        "cuts", F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at")),
        lambda s, c: F.struct(
            F.concat(s["kept"], F.substr("text", s["at"] + 1, c["start"] - s["at"])).alias("kept"), c["end"].alias("at")
        ),
        lambda s: F.concat(s["kept"], F.substr("text", s["at"] + 1, F.length("text"))),
    )
    return texts.select("doc_id", F.coalesce(kept, "text").alias("text"))
