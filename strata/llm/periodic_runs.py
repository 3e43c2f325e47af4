"""Periodic runs of words: Lyndon roots from the grouping phase of a suffix sorter, extended to runs.

A run is a stretch of words with smallest period ``q`` and at least
``max(min_length, 2 * q)`` words that no neighbouring word extends.

1. A run of that length shows each of its words in a gram of ``min_length // 2``
   words that its text holds twice, so the stretches between words without such
   a gram are looked at one by one; no run crosses a stretch's border.
2. Phase one of the suffix sorter goes through groups of suffixes in descending
   order. Every member points to the nearest place before it in a lower group;
   what it points to moves up within its own group, by how often, and its known
   prefix grows by that many prefixes of the group at work. What a place knows
   at the end is its longest Lyndon prefix, so the groups give the Lyndon array
   with no second phase. It runs once for the order of letters and once for the
   reversed order.
3. The root of every run is the longest Lyndon prefix of a place under one of the
   orders. Each root is extended to both sides by longest common extensions
   (prefix hashes, bisected for all roots together), and each run found is
   compared word by word; a wrong hash is replaced by comparing words.

Cases: null and empty texts have no words and no runs, and collapse to an empty
text; texts shorter than ``min_length`` words have no runs; a very long text is
worked through alone, in some 30 bytes a byte, and 150 more for its words in
repeated grams; repeated rows and null ids are rows like any other; ties in
length go to the smaller start, then period; an empty table gives an empty
result. Columns beyond ``carry`` are not kept; clashing names are escaped.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import common

MIN_LENGTH = 12
# Words [^\x20\x09-\x0D]+
SEPARATORS = bytes([9, 10, 11, 12, 13, 32])
# Longer stretches keep their groups in C arrays instead of lists.
LIST_WORDS = 200_000

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def lyndon_array(letters: Sequence[int], n_letters: int) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place; letters are 0 to n_letters - 1."""
    n = len(letters)
    vector = list if n <= LIST_WORDS else lambda x: array("i", x)
    group = vector(letters)
    members: list[list[int] | None] = [[] for _ in range(n_letters)]
    for i, g in enumerate(letters):
        members[g].append(i)
    size = [1] * n_letters
    below, above = list(range(-1, n_letters - 1)), [*range(1, n_letters), -1]
    # Place p stands at p + 1 and points to itself until its group is done, then to its left; 0 is the border.
    jump = vector(range(n + 1))
    current = n_letters - 1
    while current >= 0:
        own = [i for i in members[current] if group[i] == current]
        members[current] = None
        grown = size[current]
        for i in own:
            jump[i + 1] = i
        votes: dict[int, int] = {}
        for i in own:
            p = i
            while jump[p] != p:
                jump[p] = p = jump[jump[p]]
            if p:
                votes[p] = votes.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, n_votes in votes.items():
            moved.setdefault((n_votes, group[p - 1]), []).append(p - 1)
        for (n_votes, g), part in sorted(moved.items(), reverse=True) if len(moved) > 1 else moved.items():
            new = len(size)  # stands right above what stays of its group
            members.append(part)
            size.append(size[g] + n_votes * grown)
            for p in part:
                group[p] = new
            up = above[g]
            above[g] = new
            below.append(g)
            above.append(up)
            if up >= 0:
                below[up] = new
        current = below[current]
    return np.array(size, np.int64)[np.array(group, np.int64)]


def extensions(words: np.ndarray, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the period goes on before ``at`` and from ``at + period`` on, by prefix hashes."""
    n = len(words)
    up, down = common.powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(common.mix64(words.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])

    def same(a: np.ndarray, length: np.ndarray, shift: np.ndarray) -> np.ndarray:
        one = (sums[a + length] - sums[a]) * down[a]
        other = (sums[a + shift + length] - sums[a + shift]) * down[a + shift]
        return one == other

    def longest(most: np.ndarray, starts) -> np.ndarray:
        low, high = np.zeros(len(at), np.int64), most.astype(np.int64)
        live = np.flatnonzero(high > low)
        while len(live):
            middle = (low[live] + high[live] + 1) // 2
            fits = same(starts(live, middle), middle, period[live])
            low[live] = np.where(fits, middle, low[live])
            high[live] = np.where(fits, high[live], middle - 1)
            live = live[high[live] > low[live]]
        return low

    right = longest(n - (at + period), lambda live, _: at[live])
    left = longest(at, lambda live, length: at[live] - length)
    return left, right


def extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch with this period around a root, by comparing words."""
    differ = np.flatnonzero(words[at + period :] != words[at : len(words) - period])
    end = at + period + int(differ[0]) if len(differ) else len(words)
    differ = np.flatnonzero(words[:at] != words[period : at + period])
    return int(differ[-1]) + 1 if len(differ) else 0, end


def runs_of(words: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """All runs of a row of whole numbers: (start, length, period), by start, then period."""
    n = len(words)
    found = []
    if n >= max(2, min_length):
        different, letters = np.unique(words, return_inverse=True)
        letters = letters.astype(np.int64)
        for order in (letters, len(different) - 1 - letters):
            period = lyndon_array(order.tolist(), len(different))
            at = np.flatnonzero(2 * period <= n)
            period = period[at]
            left, right = extensions(letters, at, period)
            long = left + period + right >= np.maximum(min_length, 2 * period)
            at, period, left, right = at[long], period[long], left[long], right[long]
            rows = np.stack([at - left, left + period + right, period, at], axis=1)
            # Roots of one run stand together; one of them is compared.
            _, first = np.unique(rows[:, :3], axis=0, return_index=True)
            for start, length, q, root in rows[first].tolist():
                if not np.array_equal(letters[start : start + length - q], letters[start + q : start + length]):
                    wrong = rows[(rows[:, 0] == start) & (rows[:, 1] == length) & (rows[:, 2] == q), 3]
                    for root in wrong.tolist():
                        begin, end = extended(letters, root, q)
                        if end - begin >= max(min_length, 2 * q):
                            found.append((begin, end - begin, q))
                else:
                    found.append((start, length, q))
    if not found:
        return np.empty((0, 3), np.int64)
    rows = np.unique(np.array(found, np.int64), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def in_repeated_grams(words: np.ndarray, doc: np.ndarray, gram: int) -> np.ndarray:
    """Whether a word is part of a gram that its text holds more than once; words are numbers, ``doc`` ascends."""
    n = len(words) - gram + 1
    covered = np.zeros(len(words), bool)
    if n <= 1:
        return covered
    keys = common.grams(common.mix64(words.astype(np.uint64) + np.uint64(1)), gram)
    keys = common.mix64(keys + doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    keys[doc[:n] != doc[gram - 1 :]] = np.arange(np.count_nonzero(doc[:n] != doc[gram - 1 :]), dtype=np.uint64)
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return covered
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    again = (twice[place] == keys) & (doc[:n] == doc[gram - 1 :])
    edges = np.zeros(len(words) + 1, np.int32)
    edges[:n] += again
    edges[gram : gram + n] -= again
    return np.cumsum(edges[:-1]) > 0


def _words(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a piece whose texts all end in a separator: number, text, first byte, byte behind."""
    inside = ~np.isin(flat, np.frombuffer(SEPARATORS, np.uint8))
    steps = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(flat[inside].tobytes())])
    return words.dictionary_encode().indices.to_numpy(), np.searchsorted(at, start, side="right") - 1, start, end


def _piece_runs(words: np.ndarray, doc: np.ndarray, min_length: int) -> np.ndarray:
    """(text, start, length, period) of all runs of a piece, starts counted over the piece."""
    covered = in_repeated_grams(words, doc, max(1, min_length // 2))
    inside = np.flatnonzero(covered)
    if not len(inside):
        return np.empty((0, 4), np.int64)
    border = (np.diff(inside) > 1) | (doc[inside[1:]] != doc[inside[:-1]])
    firsts = np.concatenate([[0], np.flatnonzero(border) + 1])
    lasts = np.concatenate([firsts[1:], [len(inside)]])
    long = lasts - firsts >= min_length
    firsts, lasts = firsts[long], lasts[long]
    if not len(firsts):
        return np.empty((0, 4), np.int64)
    # Stretches stand behind one another, each closed by a number that occurs once.
    sizes = lasts - firsts
    to = np.cumsum(sizes + 1) - (sizes + 1)
    row = np.empty(int(sizes.sum()) + len(sizes), np.int64)
    source = np.full(len(row), -1, np.int64)
    row[to + sizes] = int(words.max()) + 1 + np.arange(len(sizes))
    body = np.ones(len(row), bool)
    body[to + sizes] = False
    steps = np.repeat(inside[firsts] - to, sizes)
    source[body] = np.flatnonzero(body) + steps
    row[body] = words[source[body]]
    found = runs_of(row, min_length)
    found[:, 0] = source[found[:, 0]]
    return np.concatenate([doc[found[:, :1]], found], axis=1)


def _worker(n_carried: int, min_length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches, n_carried):
            flat, at = common.bytes_of(piece.column(n_carried))
            words, doc, start, end = _words(flat, at)
            first = np.searchsorted(doc, np.arange(piece.num_rows + 1))
            found = _piece_runs(words, doc, min_length)
            edges = np.zeros(len(words) + 1, np.int64)
            np.add.at(edges, found[:, 1] + found[:, 3], 1)
            np.add.at(edges, found[:, 1] + found[:, 2], -1)
            kept = np.cumsum(edges[:-1]) == 0
            # Kept words and the byte behind each, which becomes a space.
            marks = np.zeros(len(flat) + 1, np.int8)
            marks[start[kept]] = 1
            marks[end[kept] + 1] -= 1
            shown = np.cumsum(marks[:-1], dtype=np.int8) > 0
            text = flat.copy()
            text[end] = 32
            counts = np.concatenate([[0], np.cumsum(shown)])[at]
            text = text[shown].tobytes()
            collapsed = [text[a : max(a, b - 1)] for a, b in zip(counts.tolist(), counts[1:].tolist())]
            of = np.searchsorted(found[:, 0], np.arange(piece.num_rows + 1))
            rows = [
                [{"start": s, "length": n, "period": q} for s, n, q in (found[a:b, 1:] - [[w, 0, 0]]).tolist()]
                for a, b, w in zip(of.tolist(), of[1:].tolist(), first.tolist())
            ]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:n_carried], pa.array(np.diff(first), pa.int64()), pa.array(rows, kind), pa.array(collapsed, pa.string())],
                names=[*piece.schema.names[:n_carried], "_n_words", "_runs", "_collapsed"],
            )

    return work


def periodic_runs(docs: DataFrame, text: str | Column = "text", carry: Sequence[str] = ("doc_id",), min_length: int = MIN_LENGTH) -> DataFrame:
    """Carried columns, then ``n_words``, ``runs`` (start, length and period of every run, by start, then
    period) and ``collapsed``: words that no run holds after its first period, joined by single spaces.

    Where a carried column has one of these names, the new one gets underscores in front.
    """
    inner = [f"c{i}" for i in range(len(carry))]
    body = F.concat(common.text_bytes(text), F.lit(b" "))
    source = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(carry, inner)], body.alias("body"))
    schema = T.StructType([source.schema[a] for a in inner])
    schema = schema.add("_n_words", "long").add("_runs", T._parse_datatype_string(RUNS)).add("_collapsed", "string")
    out = source.mapInArrow(_worker(len(inner), min_length), schema)
    names = [common.own_name(docs.select(*[F.col(f"`{c}`") for c in carry]), n) for n in ("n_words", "runs", "collapsed")]
    return out.toDF(*carry, *names)


def with_planted_period(docs: DataFrame) -> Column:
    """Text of the contract: for a tenth of the ids, words from a place on repeat with a period.

    Rows with a null id keep their text.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    n = F.size(words).cast("long")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    root = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(root, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    planted = F.concat_ws(" ", F.slice(words, F.lit(1), a.cast("int")), tail)
    return F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of runs, its longest run and digests of all runs and of the collapsed text."""
    common.small_batches(spark)
    docs = common.table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", with_planted_period(docs).alias("text"))
    found = periodic_runs(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    out = found.withColumn("top", longest)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.l").alias("length"), (-F.col("top.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("top.l") / -F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
