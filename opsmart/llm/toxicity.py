"""Toxicity of texts by compression distance: how much shorter a window gets with a dictionary of toxic text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, bounded_sample, id_and_text, materialize
from .words import Texts, Words, ragged, slices

STEMS = (4, 5, 6, 8)
SHARES = (1, 2, 3, 5)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled texts that are learned from; the other sizes bound what the driver gets from them."""

    sample: int = 20_000
    window_words: int = 16
    level: int = 3
    ordinary_bytes: int = 65_536
    toxic_bytes: int = 1_536
    ordinary_windows: int = 20_000
    stems: int = 4_096
    toxic_words: int = 8_192


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionaries; the toxic one holds the ordinary one too, so only toxic content shortens a window."""

    settings: Settings
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    center: np.ndarray
    spread: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.prior)
        z = self.weights[0] + ((x - self.center) / self.spread * self.weights[1:]).sum(axis=1)  # alike rows, alike sums
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last byte of each run of ``size`` words, and the index of its text."""
    many = -(-words.counts // size)
    owner = np.repeat(np.arange(len(many)), many)
    first = words.bounds[:-1][owner] + ragged(np.zeros(len(many), np.int64), many) * size
    last = np.minimum(first + size, words.bounds[1:][owner]) - 1
    return words.starts[first], words.ends[last], owner


class Compressor:
    """Compressed lengths of windows with one raw dictionary."""

    def __init__(self, content: bytes, level: int):
        parameters = zstandard.ZstdCompressionParameters.from_level(
            level, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        if content:
            kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            kept.precompute_compress(compression_params=parameters)
            self.run = zstandard.ZstdCompressor(dict_data=kept, compression_params=parameters)
        else:
            self.run = zstandard.ZstdCompressor(compression_params=parameters)

    def lengths(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.int64)
        segments = np.column_stack([starts, ends - starts]).astype("<u8").tobytes()
        out = self.run.multi_compress_to_buffer(zstandard.BufferWithSegments(data, segments), threads=1)
        return np.fromiter((len(out[i]) for i in range(len(out))), np.int64, len(out))


class Margins:
    """Features of texts: by how much their windows shrink with the toxic dictionary. Made once per task."""

    def __init__(self, model: ToxicityModel):
        self.settings = model.settings
        self.ordinary = Compressor(model.ordinary, model.settings.level)
        self.toxic = Compressor(model.toxic, model.settings.level)

    def __call__(self, column: pa.Array) -> np.ndarray:
        texts = Texts.of(column, lower=True)
        starts, ends, owner = _windows(Words.of(texts), self.settings.window_words)
        data, n = texts.data.tobytes(), len(texts)
        m = (self.ordinary.lengths(data, starts, ends) - self.toxic.lengths(data, starts, ends)).astype(float)
        count = np.bincount(owner, minlength=n)
        order = np.lexsort((-m, owner))
        first = np.cumsum(count) - count
        top = [np.where(count > k, m[order][np.minimum(first + k, len(m) - 1)] if len(m) else 0, 0.0) for k in (0, 1, 3)]
        many = np.maximum(count, 1)
        mean = np.bincount(owner, weights=m, minlength=n) / many
        shares = [np.bincount(owner, weights=m >= k, minlength=n) / many for k in SHARES]
        return np.column_stack([*top, mean, *shares, np.log1p(count)])


def _stem_rows(chosen: DataFrame) -> DataFrame:
    """(stem, toxic texts, ordinary texts): how many labelled texts have a word that begins with the stem."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, 1):
                texts = Texts.of(part.column(1), lower=True)
                words = Words.of(texts)
                y = part.column(2).to_numpy(zero_copy_only=False)
                owner, heads = words.owner, _heads(texts, words)
                for length in STEMS:
                    codes, stems = pd.factorize(heads(length))
                    seen = pd.unique(owner.astype(np.int64) << 32 | codes)
                    toxic = y[seen >> 32] == 1
                    codes = seen & 0xFFFFFFFF
                    yield {
                        "size": np.full(len(stems), length), "stem": stems.astype(np.int64),
                        "toxic": np.bincount(codes[toxic], minlength=len(stems)),
                        "ordinary": np.bincount(codes[~toxic], minlength=len(stems)),
                    }

    schema = "size int, stem long, toxic long, ordinary long"
    return arrow_map(chosen, schema, rows).groupBy("size", "stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")
    )


def _surprise(a: Column, of_a: int, b: Column, of_b: int) -> Column:
    """Root of the likelihood ratio of two shares against a common one: about a normal deviate, also for rare stems."""
    part = lambda x, n: F.when(x > 0, x * F.log(x * (of_a + of_b) / n)).otherwise(0.0)
    both, rest = a + b, of_a + of_b - a - b
    ratio = part(a, both * of_a) + part(b, both * of_b) + part(of_a - a, rest * of_a) + part(of_b - b, rest * of_b)
    return F.sqrt(F.greatest(2 * ratio, F.lit(0.0)))


def _heads(texts: Texts, words: Words):
    """A function from a length to the first so many bytes of each word, as numbers."""
    padded = np.concatenate([texts.data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(texts.data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    lengths = words.ends - words.starts
    return lambda n: eight[words.starts] & _MASKS[np.minimum(lengths, n)]


def _dictionary(samples: list[bytes], size: int, segment: int) -> bytes:
    """A trained zstandard dictionary; of too few samples, the samples themselves."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", settings: Settings = Settings(),
    id_col: str = "doc_id", text_col: str = "text",
) -> ToxicityModel:
    """Dictionaries and calibration from at most about ``settings.sample`` labelled texts.

    Toxic texts are mostly ordinary words, so a dictionary of whole toxic texts tells little. The toxic
    dictionary is trained on those words of toxic texts whose stems are clearly more frequent in toxic than in
    ordinary texts (different texts count once), the ordinary one on windows of ordinary texts. A logistic
    model of the windows' shortening, fitted on the same texts, calibrates the score.
    Without labels of both kinds the score is the share of label 1.
    """
    s = settings
    chosen = bounded_sample(docs, labels, label_col, s.sample, id_col, text_col)
    chosen = materialize(chosen)
    distinct = chosen.groupBy(F.sha2("text", 256).alias("__digest")).agg(F.min(F.struct("doc_id", "text", "y")).alias("x"))
    distinct = materialize(distinct.select("x.*"))
    sizes = {r["y"]: (r["n"], r["c"] or 0) for r in distinct.groupBy("y").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("c")).collect()}
    toxic, ordinary = sizes.get(1.0, (0, 0)), sizes.get(0.0, (0, 0))
    prior = toxic[0] / max(toxic[0] + ordinary[0], 1)
    empty = ToxicityModel(s, b"", b"", np.zeros(0), np.zeros(0), np.zeros(0), prior)
    if not toxic[0] or not ordinary[0]:
        return empty
    odds = F.log((F.col("toxic") + 0.5) / (toxic[0] + 1)) - F.log((F.col("ordinary") + 0.5) / (ordinary[0] + 1))
    surprise = _surprise(F.col("toxic"), toxic[0], F.col("ordinary"), ordinary[0])
    told = _stem_rows(distinct).filter((odds > np.log(8)) & (surprise > 5))
    told = told.orderBy(surprise.desc(), "size", "stem").limit(s.stems).collect()
    stems = {n: np.sort(np.array([r["stem"] for r in told if r["size"] == n], np.int64).astype(np.uint64)) for n in STEMS}
    every = max(1, ordinary[1] // (s.window_words * 6 * s.ordinary_windows))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, 1):
                texts = Texts.of(part.column(1), lower=True)
                words, y = Words.of(texts), part.column(2).to_numpy(zero_copy_only=False)
                data, heads = texts.data.tobytes(), _heads(texts, words)
                hit = np.any([np.isin(heads(n), stems[n]) for n in STEMS], axis=0) & (y[words.owner] == 1)
                first, last, owner = _windows(words, s.window_words)
                pick = np.flatnonzero((y[owner] == 0) & (np.arange(len(owner)) % every == 0))
                found = [(1, data[words.starts[i]:words.ends[i]]) for i in np.flatnonzero(hit)]
                found += [(0, data[first[i]:last[i]]) for i in pick]
                yield {"y": [f[0] for f in found], "sample": [f[1] for f in found]}

    samples = arrow_map(distinct, "y int, sample binary", rows).groupBy("y", "sample").agg(F.count("*").alias("n"))
    ordinary_samples = samples.filter("y = 0").orderBy(F.xxhash64("sample"), "sample").limit(s.ordinary_windows).collect()
    toxic_words = samples.filter("y = 1").orderBy(F.desc("n"), "sample").limit(s.toxic_words).collect()
    share = max(1.0, sum(r["n"] for r in toxic_words) / 60_000)
    repeated = [bytes(r["sample"]) for r in toxic_words for _ in range(max(1, round(r["n"] / share)))]
    repeated = [repeated[i] for i in np.random.default_rng(5).permutation(len(repeated))]
    lines = [b" " + b" ".join(repeated[i:i + 12]) + b" " for i in range(0, len(repeated), 12)]
    common = _dictionary([bytes(r["sample"]) for r in ordinary_samples], s.ordinary_bytes, 64)
    own = _dictionary(lines, s.toxic_bytes, 16)
    model = ToxicityModel(s, common, common + own, np.zeros(0), np.zeros(0), np.zeros(0), prior)
    table = _feature_rows(distinct, model).toPandas().sort_values("doc_id")
    x = np.array(table["x"].to_list(), dtype=float)
    center, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    weights = _logistic((x - center) / spread, table["y"].to_numpy())
    return ToxicityModel(s, common, common + own, weights, center, spread, prior)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights (constant first) of a logistic model by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -35, 35)))
        bend = a.T @ (a * (p * (1 - p))[:, None]) + penalty
        w += np.linalg.solve(bend, a.T @ (y - p) - penalty @ w)
    return w


def _feature_rows(chosen: DataFrame, model: ToxicityModel) -> DataFrame:
    shared = chosen.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        margins = Margins(shared.value)
        for batch in batches:
            for part in slices(batch, 1):
                yield {"doc_id": part.column(0), "y": part.column(2), "x": list(margins(part.column(1)))}

    return arrow_map(chosen, "doc_id long, y double, x array<double>", rows)


def score_toxicity(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row: the probability of label 1, from all windows of the whole text.

    A null or empty text has no windows and gets the score of a text without toxic windows. Repeated rows
    score alike, a null id stays null, other columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        margins = Margins(shared.value)
        for batch in batches:
            for part in slices(batch, 1):
                yield {"doc_id": part.column(0), "score": shared.value.score(margins(part.column(1)))}

    return arrow_map(id_and_text(df, id_col, text_col), "doc_id long, score double", rows)


def drop_toxic(df: DataFrame, model: ToxicityModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows whose score is below ``threshold``, with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = Margins(shared.value)
        for batch in batches:
            for part in slices(batch, place):
                kept = part.filter(pa.array(shared.value.score(margins(part.column(place))) < threshold))
                if kept.num_rows:
                    yield kept

    return df.mapInArrow(run, df.schema)
