"""Token pieces of documents, and packing them into sequences of a fixed length."""

from __future__ import annotations

import os
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_map, id_and_text, materialize
from .words import LOWER, Texts, Words, ragged, slices

PLAIN_WORD = re.compile("([a-zß-öø-ÿ]+)([.,;:!?]?)")
KNOWN_WORDS = 1_000_000
ENCODE_AT_ONCE = 1000
#: Marks that make a token of their own behind a letter.
CLOSING = np.zeros(256, dtype=bool)
CLOSING[list(b".,;:!?")] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True


@lru_cache(maxsize=1)
def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies, for ``str.translate``."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    """Token ids of words, remembered by the words' hash.

    The vocabulary must drop white space and treat each word by itself, as word-end BPE does; then a
    text's ids are those of its words one after the other, and a word is encoded once per task. Words of
    small Latin letters skip the tokenizer's own normalising and splitting, which leave them as they are.
    Memory is bounded: beyond ``KNOWN_WORDS`` words the store starts afresh.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads only hold more memory
        self.full = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.full.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._forget()

    def _forget(self) -> None:
        self.known = pd.Index(np.zeros(0, np.uint64))
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and for each word where its ids start and how many it has."""
        matches = [PLAIN_WORD.fullmatch(w.lower()) for w in words]
        plain = np.array([m is not None for m in matches], dtype=bool)
        letters = _byte_letters()
        shown, owner = [], []
        for i, m in enumerate(matches):
            if m:
                shown += [m[1] if m[1].isascii() else m[1].encode().decode("latin-1").translate(letters), *m[2]]
                owner += [i] * (1 + len(m[2]))
        owner = np.array(owner, np.int64)
        flat, of_word = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(shown), ENCODE_AT_ONCE):
            code = self.bare.encode(" ".join(shown[at:at + ENCODE_AT_ONCE]), add_special_tokens=False)
            flat.append(np.array(code.ids, np.uint32))
            of_word.append(owner[np.array(code.word_ids, np.int64) + at])
        rest = np.flatnonzero(~plain)
        for i, code in zip(rest, self.full.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            flat.append(np.array(code.ids, np.uint32))
            of_word.append(np.full(len(code.ids), i))
        lengths = np.bincount(np.concatenate(of_word), minlength=len(words))
        in_order = np.concatenate([np.flatnonzero(plain), rest])
        starts = np.empty(len(words), np.int64)
        starts[in_order] = np.cumsum(lengths[in_order]) - lengths[in_order]
        return np.concatenate(flat), starts, lengths

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        flat, starts, lengths = self.encode_words(words)
        self.starts = np.concatenate([self.starts, len(self.pool) + starts])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.pool = np.concatenate([self.pool, flat])
        self.known = pd.Index(np.concatenate([self.known.to_numpy(), hashes]))

    def __call__(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many belong to each text."""
        words = Words.of(texts)
        starts, ends, owner = words.starts, words.ends, words.owner
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        closed = CLOSING[texts.data[ends - 1]] & (ends - starts > 1) & LETTER[texts.data[np.maximum(ends - 2, 0)]]
        cut = np.flatnonzero(closed)
        place = np.arange(len(starts)) + np.cumsum(closed) - closed
        many = len(starts) + len(cut)
        all_starts, all_ends = np.empty(many, np.int64), np.empty(many, np.int64)
        all_starts[place], all_ends[place] = starts, ends - closed
        all_starts[place[cut] + 1], all_ends[place[cut] + 1] = ends[cut] - 1, ends[cut]
        all_owner = np.repeat(owner, 1 + closed)
        hashes = Words(all_starts, all_ends, words.bounds).hashes(LOWER[texts.data])
        codes, distinct = pd.factorize(hashes)
        if len(self.known) + len(distinct) > KNOWN_WORDS:
            self._forget()
        new = np.flatnonzero(self.known.get_indexer(distinct) < 0)
        if len(new):
            first = np.full(len(distinct), -1, np.int64)
            first[codes[::-1]] = np.arange(many)[::-1]
            raw = texts.data.tobytes()
            spelled = [raw[all_starts[i]:all_ends[i]].decode() for i in first[new]]
            self._learn(distinct[new], spelled)
        at = self.known.get_indexer(distinct)[codes]
        lengths = self.lengths[at]
        ids = self.pool[ragged(self.starts[at], lengths)]
        return ids, np.bincount(all_owner, weights=lengths, minlength=len(texts)).astype(np.int64)


def token_pieces(
    df: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens of every text and ``end_id``, cut into pieces of ``size`` where they are more.

    Rows (doc_id, piece, start, length, ids); ids are unsigned 32-bit little-endian numbers. A null or
    empty text is the end token alone; repeated rows give repeated pieces; a null id stays null; other
    columns are not read. ``tokenizer`` is a file on every worker, of a vocabulary that drops white space.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode = WordTokenizer(tokenizer)
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                ids, counts = encode(Texts.of(part.column(1)))
                ends = np.cumsum(counts)
                out: dict[str, list] = {k: [] for k in ("row", "piece", "start", "length", "ids")}
                for i, (end, count) in enumerate(zip(ends.tolist(), counts.tolist())):
                    own = np.append(ids[end - count:end], np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), size)):
                        cut = own[start:start + size]
                        for key, value in zip(out, (i, piece, start, len(cut), cut.tobytes())):
                            out[key].append(value)
                yield out | {"doc_id": part.column(0).take(pa.array(out["row"]))}

    schema = "doc_id long, piece int, start long, length long, ids binary"
    return arrow_map(id_and_text(df, id_col, text_col), schema, rows)


def _take(counts: dict[int, int], *lengths: int) -> None:
    for length in lengths:
        counts[length] -= 1


def reduce_by_dominance(counts: dict[int, int], size: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sets that some optimal packing contains (Martello and Toth), with how often, and what is left.

    For the longest piece j of an instance a set with j dominates another one if the other's pieces can
    be exchanged for its own without more sequences. Such sets are fixed for good:
    j alone if nothing fits beside it; j and the longest fitting piece if the two fill the sequence,
    if no two pieces fit beside j, or if that piece is at least as long as any two that fit and no three fit;
    j and two pieces a >= b, if no three fit beside j, a is the longest that fits and b is at least as long as
    the shorter one of any fitting pair. Pieces of a length are alike, so one step fixes many sets.
    """
    left = {k: v for k, v in counts.items() if v > 0}
    fixed: list[tuple[tuple[int, ...], int]] = []
    changed = True
    while changed:
        changed = False
        for longest in sorted(left, reverse=True):
            while left.get(longest, 0) > 0:
                found = _dominating(left, longest, size)
                if not found:
                    break
                need: dict[int, int] = defaultdict(int)
                for length in found:
                    need[length] += 1
                times = min(left[k] // n for k, n in need.items())
                # alike sets stay dominating while their pieces last; equal lengths inside one are taken singly
                times = times if len(need) == len(found) else min(times, max(1, times))
                for k, n in need.items():
                    left[k] -= n * times
                    if not left[k]:
                        del left[k]
                fixed.append((found, times))
                changed = True
    return fixed, left


def _dominating(left: dict[int, int], longest: int, size: int) -> tuple[int, ...] | None:
    room = size - longest
    free = lambda k: left.get(k, 0) - (k == longest)
    if room > 0 and free(room) > 0:
        return longest, room
    order = sorted(k for k in left if free(k) > 0)
    fitting = order[:bisect_left(order, room + 1)]
    if not fitting:
        return (longest,)
    least, k = [], 0
    for length in fitting:
        least += [length] * min(3 - len(least), free(length))
        if len(least) == 3:
            break
    if len(least) == 3 and sum(least) <= room:
        return None
    best = fitting[-1]
    if len(least) < 2 or least[0] + least[1] > room:
        return longest, best
    pair_sum, shorter = 0, 0
    for s in fitting:
        r_most = room - s
        if r_most < s:
            break
        i = bisect_left(fitting, r_most + 1) - 1
        if fitting[i] == s and free(s) < 2:
            continue
        pair_sum, shorter = max(pair_sum, s + fitting[i]), s
    if best >= pair_sum:
        return longest, best
    i = bisect_left(fitting, room - best + 1) - 1
    while i >= 0 and fitting[i] == best and free(best) < 2:
        i -= 1
    if i >= 0 and fitting[i] >= shorter:
        return longest, best, fitting[i]
    return None


def best_fit(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Best fit in falling order over counts of lengths: what sequences hold, and how many are alike."""
    groups: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n > 0:
            room = next((r for r in range(length, size) if groups.get(r)), size)
            holds, many = groups[room].pop() if groups.get(room) else ({}, n)
            each = room // length
            full = min(many, n // each)
            last = n - full * each if many > full and n - full * each < each else 0
            if full:
                groups[room - each * length].append((holds | {length: each}, full))
            if last:
                groups[room - last * length].append((holds | {length: last}, 1))
            if (same := many - full - bool(last)) and holds:
                groups[room].append((holds, same))
            n -= full * each + last
    return [g for k in sorted(groups) for g in groups[k]]


def plan(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Which lengths share a sequence: dominating sets first, best fit for the rest."""
    fixed, left = reduce_by_dominance(counts, size)
    sets = [({k: found.count(k) for k in found}, times) for found, times in fixed]
    return sets + best_fit(left, size)


def _slots(sets: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each length, the ranks of its pieces that go to each kind of sequence."""
    rows, used, base = [], defaultdict(int), 0
    for holds, many in sets:
        offset = 0
        for length in sorted(holds, reverse=True):
            rows.append((length, used[length], holds[length], base, offset))
            used[length] += holds[length] * many
            offset += length * holds[length]
        base += many
    table = np.array(sorted(rows) or np.zeros((0, 5)), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "each", "sequence", "offset"), table.T))


def pack(df: DataFrame, size: int = 2048, length_col: str = "length") -> DataFrame:
    """The same rows with ``sequence_id`` and ``offset``: gapless sequences of at most ``size`` tokens.

    Pieces of one length are interchangeable, so the packing is decided on the number of pieces per
    length: at most ``size`` rows, whatever the table holds. Its result, at most a few kinds of sequences
    per length, is handed to all tasks, where a piece finds its place from its rank among those of its length.
    Ranks are counted within tasks and shifted by the counts of the tasks before, so a length that a third
    of all pieces share costs no more than any other. Repeated rows get places of their own.
    Lengths that are null or below 1 or above ``size`` are an error. Columns called ``sequence_id`` and ``offset`` are replaced. An empty table gives an empty one.
    """
    spark = df.sparkSession
    df = materialize(df.drop("sequence_id", "offset"))  # so that no task holds the workers of this and of what made the pieces
    at = df.columns.index(length_col)
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", __part int, __place long"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            if batch.column(at).null_count:
                raise ValueError("a piece has no length")
            lengths = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            if len(lengths) and (lengths.min() < 1 or lengths.max() > size):
                raise ValueError(f"a piece has a length outside 1 to {size}")
            within = pd.Series(lengths).groupby(lengths).cumcount().to_numpy() + seen[lengths]
            seen += np.bincount(lengths, minlength=size + 1)
            parts = pa.array(np.full(len(lengths), part, np.int32))
            names = [*batch.schema.names, "__part", "__place"]
            yield pa.RecordBatch.from_arrays([*batch.columns, parts, pa.array(within)], names=names)

    pieces = materialize(df.mapInArrow(number, schema))
    length = F.col(f"`{length_col}`")
    per_task = pieces.groupBy("__part", length.cast("long").alias("__length")).agg(F.count("*").alias("__n"))
    before = W.partitionBy("__length").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    shifts = materialize(per_task.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))))
    totals = shifts.groupBy("__length").agg(F.sum("__n").alias("n")).collect()  # at most ``size`` rows
    slots = spark.sparkContext.broadcast(_slots(plan({r["__length"]: r["n"] for r in totals}, size)))
    shift = shifts.select("__part", F.col("__length").alias("__l"), "__before")
    ranked = pieces.join(shift, (pieces["__part"] == shift["__part"]) & (length == F.col("__l"))).select(
        *(pieces[f"`{c}`"] for c in df.columns), (F.col("__place") + F.col("__before")).alias("__rank")
    )
    out = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        keys = (s["length"] << 44) + s["rank"]
        for batch in batches:
            lengths = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            ranks = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            i = np.searchsorted(keys, (lengths << 44) + ranks, "right") - 1
            nth = ranks - s["rank"][i]
            sequence = s["sequence"][i] + nth // s["each"][i]
            offset = s["offset"][i] + nth % s["each"][i] * lengths
            names = [*batch.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=names)

    return ranked.mapInArrow(place, out)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids: one row (sequence_id, doc_ids, ids) for each sequence, pieces by offset."""
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return held.select(
        "sequence_id",
        F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
        F.aggregate("p", F.lit(b""), lambda all_ids, x: F.concat(all_ids, x["ids"])).alias("ids"),
    )
