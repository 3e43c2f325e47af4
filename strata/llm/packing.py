"""Best-fit packing of tokenised documents after Martello-Toth dominance reduction.

Lengths are whole numbers up to the capacity, so the packing problem of any
corpus is a histogram with one count per length. It is reduced and solved as
such: a bin that provably dominates every other bin with its largest piece is
fixed for as many copies as there are (a piece nothing fits beside; a pair that
fills the bin; the largest partner where no third piece fits, or where it is at
least as long as any two that fit and no four pieces do). The rest goes
best-fit, longest first. The answer is a list of runs (length, first number,
count, first bin, offset); pieces, numbered per length, look up their place.

Only the histogram (at most ``capacity`` rows) and the runs reach the driver.

Cases: a null or empty text is the single end token; longer documents are cut
into pieces of ``capacity`` tokens; equal rows are packed separately; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import common
from strata.session import materialise

CAPACITY = 4096
END = 1
PIECE_BYTES = 2 << 20  # text a task splits at a time


# Letters whose lower case and borders do not depend on what stands beside them, then signs.
_WORD = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-įı-ž]+)(?P<signs>[!-&(-/:-@\[-`{-}]*)$"
_MARK = "~"  # stands between parts in one string; no part of ``_WORD`` has it
MOST_KNOWN = 300_000


def gathered(pool: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs ``pool[start : start + n]`` one after the other."""
    before = np.cumsum(n) - n
    return pool[np.repeat(start - before, n) + np.arange(n.sum())]


class ChunkIds:
    """Ids of texts from those of their chunks between spaces and line ends.

    The tokenizer drops white space, lower-cases, and takes letters and the signs
    after them as matches of their own. So a chunk is a lower-case word and its
    signs where ``_WORD`` says so, else a part of its own, and each different part
    is encoded once. Parts are runs of one array of ids. When more than ``most``
    are known, the next piece of texts starts anew.
    """

    def __init__(self, tokenizer, most: int = MOST_KNOWN):
        self.tokenizer, self.most = tokenizer, most
        self.mark = tokenizer.encode(_MARK, add_special_tokens=False).ids[0]
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.pool, self.start, self.n = np.empty(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _encode(self, parts: list[str], joined: bool) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some parts and how many each has. Joined, they are the words of one string."""
        if not joined:
            each = [x.ids for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
            return np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each], np.int64)
        text = f" {_MARK} ".join([*parts, ""])
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        marks = ids == self.mark
        return ids[~marks], np.diff(np.flatnonzero(marks), prepend=-1) - 1

    def _numbers(self, column: pa.Array, joined: bool) -> np.ndarray:
        """The number of each part; new ones are encoded."""
        coded = column.dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = [p for p in parts if p not in self.known]
        if missing:
            ids, n = zip(*[self._encode(missing[at : at + 4096], joined) for at in range(0, len(missing), 4096)])
            n = np.concatenate(n)
            self.known.update(zip(missing, range(len(self.n), len(self.n) + len(n))))
            self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(n) - n])
            self.n, self.pool = np.concatenate([self.n, n]), np.concatenate([self.pool, *ids])
        return np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))[coded.indices.to_numpy()]

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of different chunks, one after the other, and how many each has."""
        split = pc.extract_regex(chunks, _WORD)
        words = split.is_valid()
        is_word = words.to_numpy(zero_copy_only=False)
        parts = np.zeros((len(chunks), 2), np.int64)
        some = split.filter(words)
        parts[is_word, 0] = self._numbers(pc.utf8_lower(some.field(0)), joined=True)
        parts[is_word, 1] = self._numbers(some.field(1), joined=True)
        parts[~is_word, 0] = self._numbers(chunks.filter(pc.invert(words)), joined=False)
        n = self.n[parts]
        return gathered(self.pool, self.start[parts].ravel(), n.ravel()), n.sum(axis=1)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string array, and the place where each text starts (one more than texts)."""
        if max(len(self.known), len(self.pool) // 8) > self.most:
            self._clear()
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        pool, n = self._chunks(coded.dictionary)
        start, code = np.cumsum(n) - n, coded.indices.to_numpy()
        total = np.concatenate([[0], np.cumsum(n[code])])
        out = np.empty(total[-1], np.uint32)
        for at in range(0, len(code), 1 << 17):
            some = code[at : at + (1 << 17)]
            out[total[at] : total[at + len(some)]] = gathered(pool, start[some], n[some])
        return out, total[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])]


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> ChunkIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return ChunkIds(Tokenizer.from_file(path))


def tokenise(df: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids per document, each document ended by ``end``.

    ``part`` and ``k`` number the pieces of one length
    within a task. ``keep_ids`` adds the packed ids of each piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, seen = chunk_ids(tokenizer), TaskContext.get().partitionId(), defaultdict(int)
        last = np.array([end], "<u4").tobytes()
        for batch in common.pieces(batches, 1, PIECE_BYTES):
            rows: list[tuple] = []
            owner: list[int] = []
            all_ids, edge = known.ids(batch.column(1).cast(pa.string()))
            for i in range(batch.num_rows):
                packed = all_ids[edge[i] : edge[i + 1]].astype("<u4").tobytes() + last
                for piece, at in enumerate(range(0, len(packed), 4 * capacity)):
                    ids = packed[at : at + 4 * capacity]
                    n = len(ids) // 4
                    rows.append((piece, at // 4, n, zlib.crc32(ids), part, seen[n], *((ids,) if keep_ids else ())))
                    seen[n] += 1
                    owner.append(i)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), *columns], names=names)

    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *([pa.binary()] if keep_ids else [])]
    names = [doc_id, "piece", "start", "length", "ids_crc32", "part", "k", *(["ids"] if keep_ids else [])]
    schema = f"`{doc_id}` {df.schema[doc_id].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, part int, k long" + (", ids binary" if keep_ids else "")
    return df.select(doc_id, common.text_bytes(text)).mapInArrow(common.tidy(run, lambda: chunk_ids(tokenizer)._clear()), schema)


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Bins that an optimal packing may hold, as (lengths, how often), and what is left."""
    left, sizes, fixed = dict(counts), sorted(counts), []

    def use(bin_: tuple[int, ...], times: int) -> None:
        fixed.append((bin_, times))
        for s in bin_:
            left[s] -= times
            if not left[s]:
                sizes.remove(s)
                left[s] = -1  # marks it removed once only

    def smallest(without: int, n: int) -> list[int]:
        """The n shortest pieces, one copy of ``without`` left out."""
        out: list[int] = []
        for s in sizes[: n + 1]:
            out += [s] * min(n, left[s] - (s == without))
        return out[:n]

    for s in sorted(counts, reverse=True):
        while left[s] > 0:
            room, low = capacity - s, smallest(s, 3)
            if not low or low[0] > room:
                use((s,), left[s])
                break
            at = bisect.bisect_right(sizes, room) - 1
            if sizes[at] == s and left[s] == 1:
                at -= 1  # its only copy is the piece itself
            best = sizes[at]
            fills = best == room
            no_third = len(low) < 2 or low[0] + low[1] > room
            no_fourth = len(low) < 3 or sum(low) > room
            if not (fills or no_third or (no_fourth and best >= _largest_sum(sizes, left, s, room))):
                break
            if best == s:
                times = left[s] // 2
                fixed.append(((s, s), times))
                left[s] -= 2 * times
                if not left[s]:
                    sizes.remove(s)
            else:
                use((s, best), min(left[s], left[best]))
    return fixed, {s: n for s, n in left.items() if n > 0}


def _largest_sum(sizes: list[int], left: dict[int, int], without: int, room: int) -> int:
    """Largest sum of two pieces within ``room``."""
    own = [s for s in sizes if s < room and left[s] - (s == without) > 0]
    low, high, best = 0, len(own) - 1, 0
    while low <= high:
        total = own[low] + own[high]
        if total > room:
            high -= 1
        elif low == high and left[own[low]] - (own[low] == without) < 2:
            break
        else:
            best, low = max(best, total), low + 1
    return best


def best_fit(counts: dict[int, int], capacity: int, first_bin: int) -> list[tuple[int, int, int, int]]:
    """Best-fit, longest first, on a histogram: runs (length, count, first bin, offset)."""
    runs: list[tuple[int, int, int, int]] = []
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: ranges of bins
    rooms: list[int] = []
    bin_ = first_bin

    def put(room: int, first: int, n: int) -> None:
        if room:
            if not open_bins[room]:
                bisect.insort(rooms, room)
            open_bins[room].append((first, n))

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            at = bisect.bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                first, have = open_bins[room].pop()
                if not open_bins[room]:
                    rooms.pop(at)
                take = min(n, have)
                deep = 1 if take < have else min(room // s, n // take)  # further copies go into the same bins
                for d in range(deep):
                    runs.append((s, take, first, capacity - room + d * s))
                n -= take * deep
                put(room - deep * s, first, take)
                if take < have:
                    put(room, first + take, have - take)
            else:
                deep = min(capacity // s, n)
                bins = n // deep
                for d in range(deep):
                    runs.append((s, bins, bin_, d * s))
                put(capacity - deep * s, bin_, bins)
                n, bin_ = n - bins * deep, bin_ + bins
    return runs


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first number, count, first bin, offset) that place every piece."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    placed: list[tuple[int, int, int, int]] = []
    bin_ = 0
    for lengths, times in fixed:
        if times:
            for i, s in enumerate(lengths):
                placed.append((s, times, bin_, sum(lengths[:i])))
            bin_ += times
    placed += best_fit(rest, capacity, bin_)
    used: dict[int, int] = defaultdict(int)
    runs = []
    for s, n, first, offset in placed:
        runs.append((s, used[s], n, first, offset))
        used[s] += n
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces (``length``, ``part``, ``k``)."""
    per_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_part = materialise(per_part.withColumn("before", before), "piece-counts")
    counts = {r[0]: r[1] for r in per_part.groupBy("length").agg(F.sum("n")).collect()}  # at most `capacity` rows
    runs = sorted(plan_packing(counts, capacity))
    shared = pieces.sparkSession.sparkContext.broadcast(np.array(runs, np.int64).reshape(-1, 5))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        table = shared.value
        key = lambda s, k: (s.astype(np.int64) << 48) | k.astype(np.int64)
        run = table[np.searchsorted(key(table[:, 0], table[:, 1]), key(length.to_numpy(), number.to_numpy()), side="right") - 1]
        return pd.DataFrame({"sequence_id": run[:, 3] + number.to_numpy() - run[:, 1], "offset": run[:, 4]})

    numbered = pieces.join(per_part.select("length", "part", "before"), ["length", "part"])
    placed = numbered.withColumn("_place", place("length", F.col("k") + F.col("before")))
    return placed.select(*[c for c in pieces.columns if c not in ("part", "k")], "_place.sequence_id", "_place.offset")


def best_fit_packing(df: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its sequence and offset."""
    common.small_batches(df.sparkSession)
    return pack(materialise(tokenise(df, tokenizer, text, doc_id, capacity, keep_ids=keep_ids), "pieces"), capacity)


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))
