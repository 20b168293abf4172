"""Benchmark passages in documents: latent semantic search, then word order and answers are checked."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, id_and_text, materialize
from .words import Texts, Words, mix, ragged, slices

CLOSING = np.zeros(256, dtype=bool)
CLOSING[list(b".,;:!?")] = True
BLOCKS_AT_ONCE = 1500
FEATURES_AT_ONCE = 4096


@dataclass(frozen=True)
class Settings:
    """``stride``: words of half a passage. ``items`` bounds the benchmark passages of one latent space (a long item has
    several), ``indexes`` is how many spaces a pass has.

    A latent space has at most ``rank`` passages and a dimension for each of them, so that none of them is lost in it.
    Terms in more than ``common`` of the documents, outside of copies of items, have no weight, unless an item has fewer
    than ``least_terms`` others.
    """

    stride: int = 24
    rank: int = 512
    extra: int = 16
    rounds: int = 2
    cosine: float = 0.2
    share: float = 0.8
    paraphrase_share: float = 0.6
    answer_words: int = 5
    items: int = 256
    indexes: int = 8
    common: float = 0.1
    least_terms: int = 8


def word_hashes(texts: Texts) -> tuple[Words, np.ndarray]:
    """Words of lower-cased texts and their hashes, without one closing mark."""
    words = Words.of(texts)
    ends = words.ends - (CLOSING[texts.data[words.ends - 1]] & (words.ends - words.starts > 1)) if len(words.ends) else words.ends
    words = Words(words.starts, ends, words.bounds)
    return words, words.hashes(texts.data)


@dataclass
class Passage:
    """A benchmark item or a part of a long one: its words and answer as hashes."""

    item: int
    words: list[int]
    answer: list[int]
    masks: dict[int, int]


def lcs_length(passage: Passage, words: list[int]) -> int:
    """Longest common subsequence of the passage's words and others, all of the passage's words at once in the bits of a number."""
    full = (1 << len(passage.words)) - 1
    v = full
    for w in words:
        if (mask := passage.masks.get(w)) is not None:
            u = v & mask
            v = ((v + u) | (v - u)) & full
    return len(passage.words) - v.bit_count()


def _passages(rows: list, settings: Settings) -> list[Passage]:
    out = []
    size = 2 * settings.stride
    for item, text, answer in rows:
        words, answer_words = (word_hashes(Texts.of(pa.array([t]), lower=True))[1].tolist() for t in (text, answer))
        parts = [words[i:i + size] for i in range(0, len(words), size)] if len(words) > 2 * size else [words]
        if len(parts) > 1 and len(parts[-1]) < settings.stride:
            parts[-2:] = [parts[-2] + parts[-1]]
        for part in parts:
            if part:
                own = answer_words if answer_words else part[-settings.answer_words:]
                out.append(_passage(item, part, own))
    return out


def _passage_table(items: DataFrame, settings: Settings) -> DataFrame:
    """(item, words, answer) of each passage of (doc_id, text, __answer): hashes as signed numbers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, 1):
                found = _passages(list(zip(*(c.to_pylist() for c in part.columns))), settings)
                signed = lambda lists: [np.array(x, np.uint64).view(np.int64) for x in lists]
                yield {"item": [p.item for p in found], "words": signed(p.words for p in found), "answer": signed(p.answer for p in found)}

    return arrow_map(items, "item long, words array<long>, answer array<long>", rows)


def _passage(item: int, words: list[int], answer: list[int]) -> Passage:
    masks: dict[int, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return Passage(item, words, answer, masks)


@dataclass
class Index:
    """Some benchmark passages in the latent space: ``terms`` to rows of ``latent``, and unit vectors of passages.

    ``unseen`` is the weight of a word that no item has; it counts in the length of a passage's vector. ``squares`` are
    the products of the benchmark passages' vectors with themselves, by the lengths that ``vectors`` are divided by.
    """

    settings: Settings
    passages: list[Passage]
    terms: np.ndarray
    weights: np.ndarray
    latent: np.ndarray
    vectors: np.ndarray
    squares: np.ndarray
    unseen: float

    def places(self, hashes: np.ndarray) -> np.ndarray:
        return _places(self.terms, hashes)

    @property
    def bounds(self) -> np.ndarray:
        """Least cosine for each passage; one shorter than two halves fills less of the vector, as the root of its length."""
        lengths = np.array([len(p.words) for p in self.passages])
        return self.settings.cosine * np.sqrt(np.minimum(lengths / (2 * self.settings.stride), 1)).astype(np.float32)

    @property
    def held(self) -> np.ndarray:
        """Least product with each passage of one that holds it, whatever words stand around it.

        Some of the disjoint passages over a copy has its part of the weight, of which a paraphrase keeps ``paraphrase_share``.
        """
        s = self.settings
        over = -(-np.array([len(p.words) + s.stride - 1 for p in self.passages]) // (2 * s.stride))
        return (0.99 * s.paraphrase_share * self.squares / over).astype(np.float32)


def _places(terms: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Index of each hash in sorted ``terms``, -1 for others."""
    codes, distinct = pd.factorize(hashes)
    at = np.minimum(np.searchsorted(terms, distinct), len(terms) - 1)
    return np.where(terms[at] == distinct, at, -1)[codes] if len(codes) else np.zeros(0, np.int64)


def _half_passages(bounds: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word (exclusive) of each run of ``stride`` words of each text, and the text."""
    counts = np.diff(bounds)
    many = -(-counts // stride)
    owner = np.repeat(np.arange(len(counts)), many)
    first = bounds[:-1][owner] + ragged(np.zeros(len(many), np.int64), many) * stride
    return first, np.minimum(first + stride, bounds[1:][owner]), owner


def _sums(rows: np.ndarray, places: np.ndarray, inside: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sum over each run of words of the rows of their terms; ``inside``: the words that are terms."""
    a, b = np.searchsorted(inside, first), np.searchsorted(inside, last)
    out = np.zeros((len(first), rows.shape[1]), np.float32)
    some = np.flatnonzero(b > a)
    if len(some):
        lo, hi = a[some[0]], b[some[-1]]
        out[some] = np.add.reduceat(rows[places[inside[lo:hi]]], a[some] - lo, axis=0)
    return out


def _runs_of_three(hashes: np.ndarray) -> np.ndarray:
    """One hash for every three words in a row."""
    return mix(hashes[:-2] ^ mix(hashes[1:-1] ^ mix(hashes[2:])))


def _document_counts(docs: DataFrame, terms: Broadcast, runs: Broadcast) -> DataFrame:
    """(term, n): in how many documents each term is; added up in tasks first.

    Words in three in a row that an item has (``runs``, sorted) do not count, so copies of an item do not make its words common.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(len(terms.value), np.int64)
        for batch in batches:
            for part in slices(batch, 1):
                words, hashes = word_hashes(Texts.of(part.column(1), lower=True))
                places, owner = _places(terms.value, hashes), words.owner
                inside, copied = places >= 0, np.zeros(len(places), bool)
                if len(places) > 2 and len(runs.value):
                    at = np.flatnonzero(inside[:-2] & inside[1:-1] & inside[2:] & (owner[:-2] == owner[2:]))
                    at = at[_places(runs.value, _runs_of_three(hashes)[at]) >= 0]
                    for shift in range(3):
                        copied[at + shift] = True
                seen = pd.unique((owner.astype(np.int64) << 32 | places)[inside & ~copied])
                total += np.bincount(seen & 0xFFFFFFFF, minlength=len(total))
        found = np.flatnonzero(total)
        yield {"term": found, "n": total[found]}

    return arrow_map(docs, "term long, n long", rows).groupBy("term").agg(F.sum("n").alias("n"))


def _gram_product(passages: DataFrame, terms: np.ndarray, idf: np.ndarray, v: np.ndarray) -> np.ndarray:
    """A' A v for the TF-IDF rows A of all ``passages`` (words); tasks add up their rows, Spark adds up tasks."""
    shared = passages.sparkSession.sparkContext.broadcast((terms, idf, v))
    width = v.shape[1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        terms, idf, v = shared.value
        weighted = (v * idf[:, None]).astype(np.float32)
        total = np.zeros(v.shape)
        for batch in batches:
            column = batch.column(0)
            places = _places(terms, column.flatten().to_numpy().view(np.uint64))
            last = np.cumsum(pc.list_value_length(column).to_numpy())
            first = np.concatenate([[0], last[:-1]])
            y = _sums(weighted, places, np.flatnonzero(places >= 0), first, last)
            run = np.repeat(np.arange(len(first)), last - first)[places >= 0]
            own = places[places >= 0]
            order = np.argsort(own, kind="stable")
            starts = np.flatnonzero(np.diff(own[order], prepend=-1))
            if len(starts):
                total[own[order][starts]] += np.add.reduceat(y[run[order]], starts, axis=0)
        total *= idf[:, None]
        blocks = range(0, len(total), FEATURES_AT_ONCE)
        yield {"block": list(blocks), "values": [total[i:i + FEATURES_AT_ONCE].tobytes() for i in blocks]}

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x) for x in table.column("values").to_pylist())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "values": pa.array([total.tobytes()], pa.binary())})

    parts = arrow_map(passages, "block long, values binary", rows).groupBy("block").applyInArrow(add, "block long, values binary")
    out = np.zeros(v.shape)
    for r in parts.collect():  # terms of one block of items times the rank
        values = np.frombuffer(r["values"]).reshape(-1, width)
        out[r["block"]:r["block"] + len(values)] = values
    return out


def fit_index(spark: SparkSession, passages: list[Passage], terms: np.ndarray, idf: np.ndarray, unseen: float, s: Settings) -> Index:
    """Latent space of at most ``rank`` benchmark passages by randomised SVD.

    The matrix has a row for each passage, with the TF-IDF weights of its terms. Its leading right
    singular vectors come from subspace iteration on a random start; each product is summed over tasks.
    """
    weights = idf.copy()
    for p in passages:  # an item of common terms only keeps its rarest ones
        own = np.searchsorted(terms, np.unique(np.array(p.words, np.uint64)))
        if (weights[own] > 0).sum() < s.least_terms:
            rarest = own[np.argsort(-np.abs(idf[own]))[:s.least_terms]]
            weights[rarest] = np.abs(idf[rarest])
    weights = np.maximum(weights, 0)
    used = np.flatnonzero(weights)
    terms, weights = terms[used], weights[used]
    rank = min(len(passages), len(terms))
    words = [(np.array(p.words, np.uint64).view(np.int64).tolist(),) for p in passages]
    rows = spark.createDataFrame(words, "words array<long>")
    width = min(rank + s.extra, len(terms))
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((len(terms), width)))[0]
    for _ in range(s.rounds):
        basis = np.linalg.qr(_gram_product(rows, terms, weights, basis))[0]
    small = basis.T @ _gram_product(rows, terms, weights, basis)
    _, turn = np.linalg.eigh((small + small.T) / 2)
    latent = ((basis @ turn[:, ::-1][:, :rank]) * weights[:, None]).astype(np.float32)
    vectors, products = np.zeros((len(passages), rank)), np.zeros(len(passages))
    for i, p in enumerate(passages):
        at = _places(terms, np.array(p.words, np.uint64))
        at = at[at >= 0]
        length = max(np.sqrt((weights[at] ** 2).sum()), 1e-9)
        vectors[i] = latent[at].sum(axis=0) / length
        products[i] = (np.bincount(at, minlength=len(terms)) ** 2 * weights**2).sum() / length
    return Index(s, passages, terms, weights, latent, vectors.astype(np.float32), products, unseen)


def find_matches(index: Index, column: pa.Array) -> list[tuple[int, int, float, float, bool]]:
    """(text, passage, cosine, share, answer) of each text of a slice and passage that is found in it.

    Every passage of two half passages is compared with all benchmark passages in the latent space; pairs from the
    cosine bound on are candidates, and so are those in which the benchmark passage's own weight is found (``Index.held``). ``share`` is the part of the passage's words in the longest common
    subsequence with the words around the candidate. Found: from ``share`` on, or from ``paraphrase_share`` on
    if the answer's words stand there together.
    """
    s = index.settings
    words, hashes = word_hashes(Texts.of(column, lower=True))
    places = index.places(hashes)
    inside = np.flatnonzero(places >= 0)
    squares = np.concatenate([[0], np.cumsum(np.append(index.weights**2, index.unseen**2)[places])])
    first, last, owner = _half_passages(words.bounds, s.stride)
    best: dict[tuple[int, int], tuple[float, float, bool]] = {}
    bounds, held = index.bounds, index.held
    for at in range(0, len(first), BLOCKS_AT_ONCE):
        stop = min(at + BLOCKS_AT_ONCE + 1, len(first))
        halves = _sums(index.latent, places, inside, first[at:stop], last[at:stop])
        own = owner[at:stop]
        paired = np.append(own[:-1] == own[1:], False)
        whole = halves.copy()
        whole[:-1][paired[:-1]] += halves[1:][paired[:-1]]
        # the last half of a text is in the passage before, unless it is the only one
        lead = np.append(at == 0 or owner[at - 1] != own[0], own[1:] != own[:-1])
        use = np.flatnonzero((paired | lead) & (np.arange(len(own)) + at < at + BLOCKS_AT_ONCE))
        half_square = squares[last[at:stop]] - squares[first[at:stop]]
        square = half_square.copy()
        square[:-1][paired[:-1]] += half_square[1:][paired[:-1]]
        norm = np.sqrt(np.maximum(square[use], 1e-9))[:, None].astype(np.float32)
        products = whole[use] @ index.vectors.T
        cosines = products / norm
        for i, j in zip(*np.nonzero((cosines >= bounds) | (products >= held))):
            half, passage = at + use[i], index.passages[j]
            text = int(owner[half])
            reach = len(passage.words)
            low = max(words.bounds[text], first[half] - reach)
            high = min(words.bounds[text + 1], first[half] + 2 * s.stride + reach)
            around = hashes[low:high].tolist()
            share = lcs_length(passage, around) / reach
            if share < s.paraphrase_share:
                continue
            answer = _stands_in(passage.answer, around)
            if share >= s.share or answer:
                key = (text, int(j))
                best[key] = max(best.get(key, (0.0, 0.0, False)), (share, float(cosines[i, j]), answer))
    return [(t, j, cosine, share, answer) for (t, j), (share, cosine, answer) in best.items()]


def _stands_in(words: list[int], around: list[int]) -> bool:
    n = len(words)
    return any(around[i] == words[0] and around[i:i + n] == words for i in range(len(around) - n + 1))


def _indexes(
    docs: DataFrame, benchmark: DataFrame, settings: Settings, item_col: str, text_col: str, answer_col: str | None
) -> Iterator[list[Index]]:
    """Indexes of all items, as many at a time as go through the documents together."""
    s = settings
    answer = F.coalesce(F.col(f"`{answer_col}`").cast("string"), F.lit("")) if answer_col else F.lit("")
    items = id_and_text(benchmark.withColumn("__answer", answer), item_col, text_col, "__answer").dropna(subset=["doc_id"])
    table = materialize(_passage_table(items.distinct(), s))
    size = min(s.items, s.rank)
    passes = -(-table.count() // (size * s.indexes))
    texts = docs.count() if passes else 0
    spark = docs.sparkSession
    for number in range(passes):
        own = table.filter(F.pmod(F.xxhash64("item", "words"), F.lit(passes)) == number)
        known = [
            _passage(r["item"], *(np.array(r[c], np.int64).view(np.uint64).tolist() for c in ("words", "answer")))
            for r in own.orderBy("item", "words", "answer").collect()
        ]
        if not known:
            continue
        parts = np.array_split(np.arange(len(known)), -(-len(known) // size))
        parts = [[known[i] for i in part] for part in parts]
        terms = np.unique(np.array([w for p in known for w in p.words], np.uint64))
        runs = np.unique(np.concatenate([_runs_of_three(np.array(p.words, np.uint64)) for p in known]))
        share = spark.sparkContext.broadcast
        found = _document_counts(docs, share(terms), share(runs)).toPandas()
        n = np.zeros(len(terms))
        n[found["term"].to_numpy(np.int64)] = found["n"].to_numpy()
        idf = np.log((texts + 1) / (n + 1)) + 0.1
        idf = np.where(n > s.common * texts, -idf, idf)  # below zero: common
        unseen = float(np.log(texts + 1) + 0.1)
        indexes = []
        for passages in parts:
            at = np.searchsorted(terms, np.unique(np.array([w for p in passages for w in p.words], np.uint64)))
            indexes.append(fit_index(spark, passages, terms[at], idf[at], unseen, s))
        yield indexes


def contaminations(
    docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None,
) -> DataFrame:
    """(doc_id, item_id, cosine, share, answer) for each document and benchmark item found in it, once each.

    The answer of an item is ``answer_col``, or else its last ``answer_words`` words. All passages of all whole texts are
    searched; the benchmark is a stated set of queries, taken in blocks of ``items`` passages, so that what is broadcast is
    bounded. Items of more than twice a passage are searched in parts, and a part that is found counts. Null and empty texts hold nothing, items without id or
    words are left out, rows with a null id are reported with it, repeated rows once.
    """
    known = id_and_text(docs, id_col, text_col)
    schema = "doc_id long, item_id long, cosine double, share double, answer boolean"
    out = None
    for indexes in _indexes(known, benchmark, settings, item_col, item_text_col, answer_col):
        shared = known.sparkSession.sparkContext.broadcast(indexes)

        def rows(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[dict]:
            for batch in batches:
                for part, index in ((p, i) for p in slices(batch, 1, 1 << 20) for i in shared.value):
                    found = find_matches(index, part.column(1))
                    yield {
                        "doc_id": part.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                        "item_id": [index.passages[f[1]].item for f in found], "cosine": [f[2] for f in found],
                        "share": [f[3] for f in found], "answer": [f[4] for f in found],
                    }

        part = arrow_map(known, schema, rows)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = known.sparkSession.createDataFrame([], schema)
    best = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("share", "cosine", "answer")).alias("x"))
    return best.select("doc_id", "item_id", "x.cosine", "x.share", "x.answer")


def drop_contaminated(
    df: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", answer_col: str | None = None,
) -> DataFrame:
    """The rows in whose text no benchmark item is found, with all their columns."""
    place = df.columns.index(text_col)
    texts = df.select(F.lit(0).cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    out = df
    for indexes in _indexes(texts, benchmark, settings, item_col, item_text_col, answer_col):
        shared = df.sparkSession.sparkContext.broadcast(indexes)

        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, place, 1 << 20):
                    kept = np.ones(part.num_rows, bool)
                    for index in shared.value:
                        kept[[f[0] for f in find_matches(index, part.column(place))]] = False
                    if kept.any():
                        yield part.filter(pa.array(kept))

        out = out.mapInArrow(run, df.schema)
    return out
