"""Helpers the operators share: table reading, byte views of Arrow columns, names that cannot clash."""

from __future__ import annotations

import ctypes
import functools
import gc
import mmap
import sys
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text a task works on at a time; bounds the arrays derived from it.
PIECE_BYTES = 1 << 18
# Uncompressed text per block where an operator deals documents out to tasks.
BLOCK_BYTES = 8 << 20


# Seconds between two times a worker gives its memory back, unless it has
# grown by so many bytes since.
TIDY_SECONDS = 1.0
TIDY_BYTES = 16 << 20
_tidied = 0.0
_held = 0


def resident() -> int:
    """Bytes of memory this worker holds; 0 where the system does not say."""
    try:
        with open("/proc/self/statm") as stat:
            return int(stat.read().split()[1]) * mmap.PAGESIZE
    except OSError:
        return 0


def give_back() -> None:
    """Hand freed memory of this worker back to the system. Workers are used
    again by later stages, which would find it held by the allocator; the last
    group of a task is soon after the one before, so what was gained counts too."""
    global _tidied, _held
    if time.monotonic() - _tidied < TIDY_SECONDS and resident() < _held + TIDY_BYTES:
        return
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # another C library: nothing to trim
            pass
    _tidied, _held = time.monotonic(), resident()


def tidy(work: Callable, forget: Callable[[], None] | None = None) -> Callable:
    """``work`` over batches, with what the worker holds given back when they end."""

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            if forget is not None:
                forget()
            give_back()

    return run


def tidy_group(work: Callable) -> Callable:
    """``work`` over whole groups, with what the worker holds given back now and then."""

    def done(*args):
        try:
            return work(*args)
        finally:
            give_back()

    # Spark goes by the number of arguments.
    return {
        1: lambda table: done(table),
        2: lambda key, table: done(key, table),
        3: lambda key, left, right: done(key, left, right),
    }[work.__code__.co_argcount]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep one Arrow batch to 4 MiB, however long the texts of a table are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def text_bytes(text: str | Column) -> Column:
    """UTF-8 bytes of a text column; null counts as the empty text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text, F.lit("")).cast("binary")


def own_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or that name with underscores where the frame already has it."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array as one vector, and the offset where each value starts (one more than values)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece have about ``most`` bytes; one long text stays whole."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, at = bytes_of(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(at, at[start] + most, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def binary_array(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def input_bytes(df: DataFrame, column: str) -> tuple[int, int]:
    """Rows, and UTF-8 bytes of a text column: one cheap pass that sizes an operator."""
    n, b = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()
    return int(n), int(b)


# A fixed odd multiplier and its inverse modulo 2**64 for rolling hashes.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n, kept between calls."""
    kept = PIECE_BYTES + (1 << 18)
    if n <= kept and _powers:
        return _powers[0][:n], _powers[1][:n]
    steps = np.full((2, max(n, kept)), [[_BASE], [_INVERSE]], np.uint64)
    steps[:, 0] = 1
    made = np.cumprod(steps, axis=1)
    if n <= kept:  # those of a longer text go with it
        _powers[:] = list(made)
    return made[0][:n], made[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of ``(byte + 1) * base**i`` before each position (one more than bytes)."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def hashed_words(flat: np.ndarray, at: np.ndarray, byte_map: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts of a piece: 64-bit hash, text number, start and end byte.

    ``byte_map`` gives the byte to hash, 0 for separators. No word crosses texts.
    """
    if not len(flat):
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    shown = byte_map[flat]
    inside = shown != 0
    first = np.zeros(len(flat), bool)
    first[at[:-1][at[:-1] < len(flat)]] = True
    begins = inside & (first | np.concatenate([[True], ~inside[:-1]]))
    ends = inside & np.concatenate([~inside[1:] | first[1:], [True]])
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums, (_, down) = prefix_hashes(shown), powers(len(flat))
    hashes = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return hashes, np.searchsorted(at, start, side="right") - 1, start, end


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words, in order; runs over text borders are the caller's to leave out."""
    out = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        out = mix64(out * np.uint64(_BASE) + words[i : len(words) - n + 1 + i])
    return out


def lower_map(separators: bytes) -> np.ndarray:
    """Byte map that lower-cases A-Z and turns ``separators`` into 0 (byte 0 itself, elsewhere, into 255, which UTF-8 never has)."""
    out = np.arange(256, dtype=np.uint8)
    out[0] = 255
    out[65:91] += 32
    out[np.frombuffer(separators, np.uint8)] = 0
    return out


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys, each with the sum of its numbers."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


class Gathered:
    """Counts of keys over many pieces of a partition, handed out when ``most`` have come together."""

    def __init__(self, most: int = 1_500_000):
        self.most, self.parts, self.held = most, [], 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((keys, n))
        self.held += len(keys)

    def full(self) -> bool:
        """True where even the merged keys are too many."""
        if self.held >= self.most:
            self.parts = [self.take()]
            self.held = len(self.parts[0][0])
        return self.held >= self.most // 2

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys = [k for k, _ in self.parts] or [np.empty(0, np.uint64)]
        out = summed(np.concatenate(keys), np.concatenate([n for _, n in self.parts] or [np.empty(0, np.int64)]))
        self.parts, self.held = [], 0
        return out


def by_segment(keys: np.ndarray, n_segments: int) -> list[tuple[int, int, int]]:
    """(segment, from, to) of sorted 64-bit keys dealt by their high 32 bits."""
    edges = ((np.arange(n_segments + 1, dtype=np.uint64) << np.uint64(32)) + np.uint64(n_segments - 1)) // np.uint64(n_segments)
    at = np.searchsorted(keys >> np.uint64(32), edges)
    return [(s, int(a), int(b)) for s, (a, b) in enumerate(zip(at, at[1:])) if b > a]


def packed32(keys: np.ndarray) -> bytes:
    """Sorted 32-bit numbers: low halves, then steps of the high halves in one byte each where they fit."""
    keys = keys.astype(np.uint32)
    steps = np.diff(keys >> np.uint32(16), prepend=np.uint32(0))
    wide = len(steps) and steps.max() > 255
    return bytes([int(wide)]) + (keys & np.uint32(0xFFFF)).astype("<u2").tobytes() + steps.astype("<u2" if wide else "u1").tobytes()


def unpacked32(blob: bytes) -> np.ndarray:
    wide = blob[0]
    n = (len(blob) - 1) // (4 if wide else 3)
    low = np.frombuffer(blob, "<u2", n, 1).astype(np.uint32)
    steps = np.frombuffer(blob, "<u2" if wide else "u1", n, 1 + 2 * n).astype(np.uint32)
    return (np.cumsum(steps, dtype=np.uint32) << np.uint32(16)) | low


def small_counts(n: np.ndarray) -> bytes:
    """Counts in one byte each where they fit, else in eight."""
    return n.astype("u1" if not len(n) or n.max() < 256 else "<i8").tobytes()


def read_counts(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, "u1" if len(blob) == n else "<i8").astype(np.int64)


def block_of(doc_id: str, text: str, n_blocks: int) -> Column:
    """A block per row, equal for equal rows; a large id or text group spreads by the other column."""
    return F.pmod(F.xxhash64(doc_id, text), F.lit(n_blocks)).cast("int")


def count_blocks(n_bytes: int) -> int:
    return max(1, -(-n_bytes // BLOCK_BYTES))
