"""Language-model scores of texts from a log-frequency Bloom filter of n-gram counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, id_and_text, materialize
from .words import Texts, Words, mix, slices

END, BEGIN = np.uint64(0xE9D), np.uint64(0xBE617)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``head_words`` and ``block_bytes`` bound what a task and the driver hold at once, ``score_bytes`` the texts that wait for a block."""

    head_words: int = 1 << 18
    block_bytes: int = 48 << 20
    shard_tokens: int = 1 << 17
    flush_tokens: int = 1_000_000
    bits_per_entry: int = 12
    score_bytes: int = 8 << 20
    probes: int = 6
    weight: float = 30.0


@dataclass
class Tokens:
    """Hashes of the words of a slice of texts, each text followed by ``END``."""

    ids: np.ndarray
    before: np.ndarray
    owner: np.ndarray
    n_texts: int

    @classmethod
    def of(cls, column: pa.Array) -> Tokens:
        texts = Texts.of(column, lower=True)
        words, n = Words.of(texts), len(texts)
        owner = words.owner
        ids = np.full(len(owner) + n, END, np.uint64)
        ids[np.arange(len(owner)) + owner] = words.hashes(texts.data)
        before = np.concatenate([[BEGIN], ids[:-1]]).astype(np.uint64)
        before[words.bounds[:-1] + np.arange(n)] = BEGIN
        return cls(ids, before, np.repeat(np.arange(n), words.counts + 1), n)

    @property
    def pairs(self) -> np.ndarray:
        return pair_keys(self.before, self.ids)


def pair_keys(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return mix(mix(before + _STEP) ^ ids)


def level_of(count: np.ndarray) -> np.ndarray:
    """Quantised count: 1 for 1, 2 from 2 on, 3 from 4 on, and so on."""
    return np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1


@dataclass
class Filters:
    """Bloom filters of consecutive shards; an n-gram with level q has q entries, (key, 1) to (key, q).

    The shard of a key is its remainder; shard s has ``sizes[s - first]`` bits from ``starts[s - first]`` on.
    """

    first: int
    sizes: np.ndarray
    starts: np.ndarray
    bits: np.ndarray
    probes: int

    def levels(self, keys: np.ndarray, shards: int) -> np.ndarray:
        """Level of each key in these shards, 0 for others: probe 1, 2, ... until one is absent."""
        at = (keys % np.uint64(shards)).astype(np.int64) - self.first
        active = np.flatnonzero((at >= 0) & (at < len(self.sizes)))
        active = active[self.sizes[at[active]] > 0]
        out = np.zeros(len(keys), np.int64)
        level = 1
        while len(active):
            size, start = self.sizes[at[active]], self.starts[at[active]]
            present = np.ones(len(active), bool)
            for place in _places(keys[active], level, size, self.probes):
                place += start
                present &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            active = active[present]
            out[active] = level
            level += 1
        return out


def _places(keys: np.ndarray, level: int, size: np.ndarray, probes: int) -> Iterator[np.ndarray]:
    """Bit positions of the entry (key, level) in a filter of ``size`` bits."""
    h = mix(keys + np.uint64(level * int(_STEP) & (1 << 64) - 1))
    a, b = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    for i in range(probes):
        yield ((a + np.uint64(i) * b) % size.astype(np.uint64)).astype(np.int64)


@dataclass
class NgramModel:
    """``vocabulary`` is a table (token, n) of exact counts; ``head`` its most frequent tokens, ``blocks`` the filters."""

    settings: Settings
    vocabulary: DataFrame
    tokens: int
    distinct: int
    texts: int
    shards: int
    head: Broadcast
    blocks: list[Broadcast] = field(default_factory=list)


def _packed_counts(texts: DataFrame, shards: int, flush: int) -> DataFrame:
    """Counts of n-grams as (shard, keys, counts), packed per shard and some millions of tokens, before any shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for part in slices(batch, 1):
                t = Tokens.of(part.column(1))
                held += [t.ids, t.pairs]
                size += len(t.ids)
                if size >= flush:
                    yield _pack(np.concatenate(held), shards)
                    held, size = [], 0
        if held:
            yield _pack(np.concatenate(held), shards)

    return arrow_map(texts, "shard long, keys binary, counts binary", rows)


def _pack(keys: np.ndarray, shards: int) -> dict:
    keys, counts = np.unique(keys, return_counts=True)
    shard = (keys % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    keys, counts, shard = keys[order], counts[order].astype(np.uint32), shard[order]
    first = np.flatnonzero(np.diff(shard, prepend=-1))
    ends = np.append(first[1:], len(keys))
    return {
        "shard": shard[first], "keys": [keys[a:b].tobytes() for a, b in zip(first, ends)],
        "counts": [counts[a:b].tobytes() for a, b in zip(first, ends)],
    }


def fit_ngrams(texts: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> NgramModel:
    """Counts of tokens and pairs of tokens of all ``texts``, the latter quantised into Bloom filters.

    Exact token counts are a table. Counts of n-grams are added up by shard (the remainder of the n-gram's hash, so
    shards are even whatever is frequent) and every shard becomes a filter sized for what it holds. All filters
    together grow with the corpus; they are broadcast in blocks of at most about ``settings.block_bytes``.
    """
    s, spark = settings, texts.sparkSession
    known = id_and_text(texts, id_col, text_col)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, 1):
                held.append(Tokens.of(part.column(1)).ids)
                size += len(held[-1])
                if size >= s.flush_tokens:
                    yield dict(zip(("token", "n"), _counted(held)))
                    held, size = [], 0
        if held:
            yield dict(zip(("token", "n"), _counted(held)))

    vocabulary = arrow_map(known, "token long, n long", tokens).groupBy("token").agg(F.sum("n").alias("n"))
    vocabulary = materialize(vocabulary)
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["p"]: (r["v"], r["n"]) for r in vocabulary.groupBy(power.alias("p")).agg(
        F.count("*").alias("v"), F.sum("n").alias("n")).collect()}  # at most 63 rows
    distinct, total = sum(v for v, _ in sizes.values()), sum(n for _, n in sizes.values())
    least, held = 63, 0
    while least > 0 and held + sizes.get(least - 1, (0, 0))[0] <= s.head_words:
        least -= 1
        held += sizes.get(least, (0, 0))[0]
    head = vocabulary.filter(F.col("n") >= F.lit(1 << least).cast("long") if least < 63 else F.lit(False)).toPandas()
    head_tokens = head["token"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(head_tokens)
    ends = vocabulary.filter(F.col("token") == int(END)).select("n").first()
    shards = max(1, total // s.shard_tokens)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()])
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()])
        code, keys = pd.factorize(keys)
        levels = level_of(np.bincount(code, weights=counts))
        size = 8 * max(1, -(-int(levels.sum()) * s.bits_per_entry // 8))
        bits = np.zeros(size // 8, np.uint8)
        for level in range(1, int(levels.max()) + 1):
            own = keys[levels >= level]
            for place in _places(own, level, np.full(len(own), size), s.probes):
                np.bitwise_or.at(bits, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    filters = materialize(
        _packed_counts(known, shards, s.flush_tokens).groupBy("shard").applyInArrow(build, "shard long, bits binary")
    )
    model = NgramModel(s, vocabulary, total, distinct, ends["n"] if ends else 0, shards,
                       spark.sparkContext.broadcast((head_tokens[order], head["n"].to_numpy(np.int64)[order])))
    held_bytes = filters.agg(F.sum(F.length("bits"))).first()[0] or 0
    # shards are about equally large, so equal numbers of them are blocks of about equal size
    step = max(1, shards * s.block_bytes // max(held_bytes, 1))
    for first in range(0, shards, step):
        rows = filters.filter((F.col("shard") >= first) & (F.col("shard") < first + step)).toPandas()
        if len(rows):
            model.blocks.append(spark.sparkContext.broadcast(_block(rows, first, min(step, shards - first), s.probes)))
    return model


def _counted(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, distinct = pd.factorize(np.concatenate(held))
    return distinct.astype(np.int64), np.bincount(codes)


def _read(block: Broadcast) -> Filters:
    """A block of filters in a task. ``value`` would keep every block in the worker; this one goes when it is not used any more."""
    path = getattr(block, "_path", None)
    return block.load_from_path(path) if path else block.value


def _block(rows: pd.DataFrame, first: int, many: int, probes: int) -> Filters:
    rows = rows.sort_values("shard")
    sizes = np.zeros(many, np.int64)
    sizes[rows["shard"].to_numpy() - first] = 8 * rows["bits"].map(len).to_numpy()
    bits = np.frombuffer(b"".join(rows["bits"]), np.uint8)
    return Filters(first, sizes, np.cumsum(sizes) - sizes, bits, probes)


def _scored(model: NgramModel, column: pa.Array, shards: int, head: tuple, blocks: list[Filters]) -> dict:
    """Sums for each text of a slice, the probability of each token, and the tokens outside the head."""
    s = model.settings
    t = Tokens.of(column)
    code, ids = pd.factorize(np.concatenate([t.ids, t.before]))
    code, before = code[:len(t.ids)], code[len(t.ids):]
    tokens, counts = head
    place = np.minimum(np.searchsorted(tokens, ids), max(len(tokens) - 1, 0))
    in_head = tokens[place] == ids if len(tokens) else np.zeros(len(ids), bool)
    exact = np.where(in_head, counts[place] if len(tokens) else 0, 0)
    pair_code, pairs = pd.factorize(t.pairs)
    one, two = np.zeros(len(ids), np.int64), np.zeros(len(pairs), np.int64)
    for block in blocks:
        one = np.maximum(one, block.levels(ids, shards))
        two = np.maximum(two, block.levels(pairs, shards))
    # A level stands for the counts from ``least`` to ``most``: followers count the least, their context the most.
    least = lambda level: np.where(level > 0, 2.0 ** (level - 1), 0.0)
    most = lambda level: np.where(level > 0, 2.0**level - 1, 0.0)
    context = np.where(ids == BEGIN, model.texts, np.where(in_head, exact, most(one)))[before]
    single = np.where(ids == BEGIN, 0, np.where(in_head, exact, least(one)))[code]
    joint = np.minimum(least(two)[pair_code], context)
    lower = (single + 1) / (model.tokens + model.distinct + 1)
    p = (joint + s.weight * lower) / (context + s.weight)
    add = lambda x: np.bincount(t.owner, weights=x, minlength=t.n_texts)
    known = in_head[code]
    tail = np.flatnonzero(~known)
    key, rare = pd.factorize(t.owner[tail].astype(np.int64) << 32 | code[tail])
    return {
        "n_tokens": np.bincount(t.owner, minlength=t.n_texts), "known": add(known).astype(np.int64),
        "logs": add(np.where(known, np.log10(exact[code] + 1), 0)), "score": add(np.log10(p)), "each": p,
        "tail_owner": rare >> 32, "tail_token": ids[rare & 0xFFFFFFFF].astype(np.int64), "tail_times": np.bincount(key, minlength=len(rare)),
    }


def score_texts(df: DataFrame, model: NgramModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row.

    ``base_score``: sum over tokens of log10((c + 1) / (N + V + 1)) with exact counts. Tokens of the head
    are looked up in each task, the others are joined with the vocabulary: the head has all frequent ones, so no
    key of the join is frequent. ``score``: log10 probability of the text, each token given the one before it,
    (f(pair) + w * p1) / (f(before) + w), with p1 the add-one probability of the token. Counts are exact for tokens of
    the head; from the filters a pair and a token count the least that their level allows and the context the most, so
    the tokens that follow a context in training have probabilities that add up to one at most. A filter never loses an
    n-gram; it reports one in some hundred absent ones as seen once.

    A null or empty text is the end token alone; repeated rows score alike; a null id stays null. A task gathers
    texts of some million tokens, then reads one block of filters after the other for all of them and lets it go again, so
    its memory holds one block and those texts, however many blocks there are.
    """
    frozen = NgramModel(model.settings, None, model.tokens, model.distinct, model.texts, model.shards, None)
    head, blocks, shards = model.head, model.blocks, model.shards
    wait = model.settings.score_bytes if len(blocks) > 1 else 0  # a single block is kept, so nothing is gained by waiting

    def scored(parts: list[pa.RecordBatch], row: int) -> dict:
        texts, of = (pa.concat_arrays([p.column(i) for p in parts]) for i in (1, 0))
        x = _scored(frozen, texts, shards, head.value, (_read(b) if wait else b.value for b in blocks))
        n, tail = len(of), len(x["tail_owner"])
        ids = np.arange(n) + row
        none, blank = pa.nulls(tail, pa.int64()), pa.nulls(n, pa.int64())
        joined = lambda a, b, kind: pa.concat_arrays([pa.array(a, kind) if not isinstance(a, pa.Array) else a.cast(kind), b])
        return {
            "row": np.concatenate([ids, ids[x["tail_owner"]]]),
            "doc_id": joined(of, none, pa.int64()),
            "n_tokens": joined(x["n_tokens"], none, pa.int64()), "known": joined(x["known"], none, pa.int64()),
            "logs": joined(x["logs"], pa.nulls(tail, pa.float64()), pa.float64()),
            "score": joined(x["score"], pa.nulls(tail, pa.float64()), pa.float64()),
            "token": pa.concat_arrays([blank, pa.array(x["tail_token"], pa.int64())]),
            "times": pa.concat_arrays([blank, pa.array(x["tail_times"], pa.int64())]),
        }

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        row, held, size = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            for part in slices(batch, 1):
                held.append(part)
                size += part.column(1).nbytes
                if size >= wait:
                    yield scored(held, row)
                    row, held, size = row + sum(p.num_rows for p in held), [], 0
        if held:
            yield scored(held, row)

    schema = "row long, doc_id long, n_tokens long, known long, logs double, score double, token long, times long"
    parts = materialize(arrow_map(id_and_text(df, id_col, text_col), schema, rows))
    rare = parts.filter("token IS NOT NULL").select("row", "token", "times").join(model.vocabulary, "token")
    rare = rare.groupBy("row").agg(F.sum("times").alias("k"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("l"))
    joined = parts.filter("token IS NULL").select("row", "doc_id", "n_tokens", "known", "logs", "score").join(rare, "row", "left")
    whole = float(np.log10(model.tokens + model.distinct + 1))
    return joined.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("l", F.lit(0.0)) - F.col("n_tokens") * whole).alias("base_score"), "score",
    )
