"""Language-model scoring with a log-frequency Bloom filter of quantised bigram counts.

Counting: tasks gather word and bigram counts of the training texts as packed,
sorted arrays, which shuffle by hash segment and are summed there. A segment's
bigrams go into a Bloom filter of its own size: a bigram that occurs c times is
entered once for each of its 1 + floor(log2 c) levels. The segments' filters
together are broadcast. A look-up asks level after level until one is missing,
so a count is never under-estimated, and the middle of the last level's range
is taken for it.

Scoring: P(w | h) = (c(hw) + mu * P(w)) / (c(h) + mu), Dirichlet smoothing of
the bigram by the add-one word probability; every text begins after, and ends
with, an end token. A text's probability is the mean over the strengths in
``MUS`` (with the words alone as one of them), so texts that follow the corpus
closely and texts that share only words with it both get their due. Word counts are exact: texts are dealt out in blocks, each
block asks for the counts of its own words, and gets them beside its texts.

What is broadcast is bounded: filters go out in rounds of at most
``round_bytes`` together, each round scores the bigrams of its segments, and
the parts of a score are added. The model does not depend on that bound.

Cases: a null or empty text is its end token alone; null ids are not held out;
with no training text every count is zero; repeated rows count and score each;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common
from strata.llm.language_id import held_out
from strata.session import materialise

SPACE = common.lower_map(b" \t\n\v\f\r")
END = np.uint64(0x5BD1E9955BD1E995)
PROBES = 6
BITS_PER_LEVEL = 10
MUS = (float("inf"), 10_000.0, 300.0, 5.0)
ROUND_BYTES = 128 << 20


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end token, and where the texts start."""
    flat, at = common.bytes_of(column)
    words, owner, _, _ = common.hashed_words(flat, at, SPACE)
    n = np.bincount(owner, minlength=len(at) - 1)
    ends = np.cumsum(n + 1) - 1
    out = np.full(len(words) + len(n), END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = words
    return out, np.concatenate([[0], ends + 1])


def bigrams(token: np.ndarray) -> np.ndarray:
    """Hash of every token with the one before it; the first of a text follows an end token."""
    before = np.concatenate([[END], token[:-1]])
    return common.mix64(before * np.uint64(0x9E3779B97F4A7C15) + token)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names=["n", "segment", "keys", "counts"])


def count_grams(texts: DataFrame, n_segments: int) -> DataFrame:
    """Summed counts by segment: order 1 as packed 64-bit keys, order 2 as filters.

    Rows (n, segment, keys, counts): for words the sorted hashes and counts; for
    bigrams the filter's bits, and no counts.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = common.Gathered(), common.Gathered()
        for batch in common.pieces(batches, 0):
            token, _ = tokens(batch.column(0))
            for held, keys in ((words, token), (pairs, bigrams(token))):
                held.add(*np.unique(keys, return_counts=True))
            if words.full():
                yield out(1, words)
            if pairs.full():
                yield out(2, pairs)
        yield out(1, words)
        yield out(2, pairs)

    def out(n: int, held: common.Gathered) -> pa.RecordBatch:
        keys, counts = held.take()
        pack = (lambda k: k.tobytes()) if n == 1 else common.packed32  # a bigram's place in its segment is its low 32 bits
        rows = []
        for s, a, b in common.by_segment(keys, n_segments):
            k, c = keys[a:b], counts[a:b]
            if n == 2:
                k, c = common.summed(k & np.uint64(0xFFFFFFFF), c)
            rows.append((n, s, pack(k), common.small_counts(c)))
        return _rows(rows)

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held = key[0].as_py(), common.Gathered()
        for batch in batches:
            for blob, counts in zip(batch.column(2), batch.column(3)):
                blob = blob.as_py()
                keys = np.frombuffer(blob, np.uint64) if n == 1 else common.unpacked32(blob).astype(np.uint64)
                held.add(keys, common.read_counts(counts.as_py(), len(keys)))
            held.full()
        keys, counts = held.take()
        yield _rows([(n, key[1].as_py(), keys.tobytes() if n == 1 else build_filter(keys, counts), common.small_counts(counts) if n == 1 else b"")])

    found = texts.mapInArrow(gather, "n int, segment int, keys binary, counts binary")
    return found.groupBy("n", "segment").applyInArrow(add, "n int, segment int, keys binary, counts binary")


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1]  # 1 + floor(log2 c)


def expected_count(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level; 0 for level 0."""
    return np.where(levels > 0, (1.5 * np.exp2(levels - 1.0) - 0.5), 0.0)


def _probe(keys: np.ndarray, level: int, probe: int, size: np.ndarray | int) -> np.ndarray:
    mixed = common.mix64(keys * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level * 64 + probe + 1))
    return ((mixed >> np.uint64(32)) * np.asarray(size, np.uint64)) >> np.uint64(32)


def build_filter(keys: np.ndarray, counts: np.ndarray) -> bytes:
    levels = levels_of(counts)
    size = max(64, -(-int(levels.sum()) * BITS_PER_LEVEL // 64) * 64)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = keys[levels >= level]
        for probe in range(PROBES):
            bits[_probe(own, level, probe, size)] = True
    return np.packbits(bits).tobytes()


class Filters:
    """Filters of some segments in one array; segments that are not there have no bits."""

    def __init__(self, n_segments: int, blobs: list[tuple[int, bytes]]):
        self.n_segments = n_segments
        self.start, self.size = np.zeros(n_segments, np.int64), np.zeros(n_segments, np.int64)
        for s, blob in blobs:
            self.size[s] = len(blob) * 8
        self.start[1:] = np.cumsum(self.size)[:-1]
        self.bits = np.zeros(int(self.size.sum()) // 8, np.uint8)
        for s, blob in blobs:
            self.bits[self.start[s] // 8 :][: len(blob)] = np.frombuffer(blob, np.uint8)

    def segments(self, keys: np.ndarray) -> np.ndarray:
        return (((keys >> np.uint64(32)) * np.uint64(self.n_segments)) >> np.uint64(32)).astype(np.int64)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level up to which all are present, 0 where even the first is not."""
        segment = self.segments(keys)
        out, alive = np.zeros(len(keys), np.int64), np.flatnonzero(self.size[segment] > 0)
        level = 0
        while len(alive):
            level += 1
            for probe in range(PROBES):
                own = segment[alive]
                at = _probe(keys[alive] & np.uint64(0xFFFFFFFF), level, probe, self.size[own]).astype(np.int64) + self.start[own]
                alive = alive[(self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
            out[alive] = level
        return out


def block_counts(docs: DataFrame, counts: DataFrame, n_segments: int) -> DataFrame:
    """(block, keys, counts): for each block the training counts of its own words, by segment."""

    def ask(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = common.Gathered()
        for batch in common.pieces(batches, 2):
            keys = np.unique(tokens(batch.column(2))[0])
            held.add(keys, np.zeros(len(keys), np.int64))
            held.full()
        keys, _ = held.take()
        rows = [(key[0].as_py(), s, keys[a:b].tobytes(), b"") for s, a, b in common.by_segment(keys, n_segments)]
        yield _rows(rows).rename_columns(["block", "segment", "keys", "counts"])

    def answer(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
        keys = np.frombuffer(known["keys"][0].as_py(), np.uint64) if known.num_rows else np.empty(0, np.uint64)
        n = common.read_counts(known["counts"][0].as_py(), len(keys)) if known.num_rows else np.empty(0, np.int64)
        rows = []
        for block, blob in zip(asked["block"].to_pylist(), asked["keys"]):
            own = np.frombuffer(blob.as_py(), np.uint64)
            both = own[np.isin(own, keys, assume_unique=True)]
            rows.append((block, both.tobytes(), n[np.searchsorted(keys, both)].astype("<i8").tobytes()))
        kinds = [pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["block", "keys", "counts"])

    asked = docs.select("block", "segment_", "bytes").groupBy("block").applyInArrow(ask, "block int, segment int, keys binary, counts binary")
    known = counts.where("n = 1").select("segment", "keys", "counts")
    return asked.select("segment", "block", "keys").groupBy("segment").cogroup(known.groupBy("segment")).applyInArrow(answer, "block int, keys binary, counts binary")


def score_texts(df: DataFrame, train: str, text: str = "text", doc_id: str = "doc_id", mus: tuple[float, ...] = MUS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """Learn from the rows where the boolean column ``train`` holds, score all.

    Returns the id and ``train`` with n_tokens, n_known, train_tokens,
    base_score (add-one words) and score (the model).
    """
    spark = df.sparkSession
    common.small_batches(spark)
    _, n_bytes = common.input_bytes(df, text)
    n_segments = common.count_blocks(n_bytes)
    source = df.select(F.col(doc_id), F.coalesce(F.col(train), F.lit(False)).alias("_train"), common.text_bytes(text).alias("bytes"))
    counts = materialise(count_grams(source.where("_train").select("bytes"), n_segments), "gram-counts")

    filters = counts.where("n = 2").select("segment", F.octet_length("keys").alias("size")).sort("segment").collect()  # two numbers per segment
    rounds: list[list[int]] = [[]]
    held = 0
    for segment, size in filters:
        if held + size > round_bytes and rounds[-1]:
            rounds.append([])
            held = 0
        rounds[-1].append(segment)
        held += size
    total = materialise(counts.where("n = 1").select("keys", "counts").mapInArrow(_totals, "tokens long, words long"), "totals").agg(F.sum("tokens"), F.sum("words")).first()
    n_all, n_words = int(total[0] or 0), int(total[1] or 0)

    dealt = source.withColumn("block", common.block_of(doc_id, "bytes", n_segments)).withColumn("segment_", F.lit(0))
    answers = materialise(block_counts(dealt, counts, n_segments), "block-counts")
    kind = df.schema[doc_id].dataType.simpleString()
    parts, each = [], [f"score{i}" for i in range(len(mus))]
    for number, own in enumerate(rounds):
        blobs = [(r[0], bytes(r[1])) for r in counts.where((F.col("n") == 2) & F.col("segment").isin(own)).select("segment", "keys").toLocalIterator()]
        shared = spark.sparkContext.broadcast(Filters(n_segments, blobs))
        rated = dealt.select("block", doc_id, "_train", "bytes").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            _scorer(shared, doc_id, n_all, n_words, mus, set(own) if len(rounds) > 1 else None),
            f"`{doc_id}` {kind}, _train boolean, n_tokens long, n_known long, base_score double, " + ", ".join(f"{c} double" for c in each) + ", text_hash binary")
        parts.append(rated.withColumn("round", F.lit(number)))
    out = parts[0]
    if len(parts) > 1:
        rest = parts[1]
        for more in parts[2:]:
            rest = rest.unionByName(more)
        # Equal rows have equal scores; one of each round is added.
        rest = rest.groupBy(doc_id, "text_hash", "round").agg(*[F.max(c).alias(c) for c in each])
        rest = rest.groupBy(doc_id, "text_hash").agg(*[F.sum(c).alias(f"more_{c}") for c in each])
        rest = rest.withColumnsRenamed({doc_id: "_id", "text_hash": "_hash"})
        out = out.join(rest, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
        out = out.withColumns({c: F.col(c) + F.col(f"more_{c}") for c in each})
    most = F.greatest(*each) if len(each) > 1 else F.col(each[0])
    mean = sum((F.pow(F.lit(10.0), F.col(c) - most) for c in each[1:]), F.pow(F.lit(10.0), F.col(each[0]) - most)) / len(each)
    return out.withColumn("score", most + F.log10(mean)).select(doc_id, F.col("_train").alias(train), "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score")


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [len(k.as_py()) // 8 for k in batch.column(0)]
        n = [int(common.read_counts(c.as_py(), w).sum()) for c, w in zip(batch.column(1), words)]
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(words, pa.int64())], names=["tokens", "words"])


def _scorer(shared, doc_id: str, n_all: int, n_words: int, mus: tuple[float, ...], own: set[int] | None):
    each = [f"score{i}" for i in range(len(mus))]

    def rate(key: tuple, docs: pa.Table, counts: pa.Table) -> pa.Table:
        filters = shared.value
        keys = np.concatenate([np.frombuffer(k.as_py(), np.uint64) for k in counts["keys"]] or [np.empty(0, np.uint64)])
        n = np.concatenate([np.frombuffer(c.as_py(), "<i8") for c in counts["counts"]] or [np.empty(0, np.int64)])
        order = np.argsort(keys)
        keys, n = np.append(keys[order], np.uint64(2**64 - 1)), np.append(n[order], 0)
        out = []
        for batch in common.pieces(iter(docs.to_batches()), 3):
            token, at = tokens(batch.column(3))
            place = np.searchsorted(keys, token)
            c = np.where(keys[place] == token, n[place], 0)
            word = (c + 1.0) / (n_all + n_words + 1.0)
            base = np.log10((c + 1) / (n_all + 1 * (n_words + 1)))
            end = n[np.searchsorted(keys, END)] if keys[np.searchsorted(keys, END)] == END else 0
            history = np.concatenate([[end], c[:-1]]).astype(np.float64)
            history[at[:-1]] = end
            pair = bigrams(token)
            seen = expected_count(filters.levels(pair))
            seen = np.minimum(seen, np.minimum(history, c))  # a pair cannot be more frequent than its words
            models = [np.log10(word if np.isinf(mu) else (seen + mu * word) / (history + mu)) for mu in mus]
            if own is not None:
                here = np.isin(filters.segments(pair), list(own))
                models = [np.where(here, m, 0.0) for m in models]
            sums = [np.add.reduceat(x, at[:-1]) for x in ((c > 0).astype(np.int64), base, *models)]
            digest = [hashlib.md5(t.as_py()).digest() for t in batch.column(3)] if own is not None else [b""] * batch.num_rows
            out.append(pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(np.diff(at), pa.int64()), *map(pa.array, sums), common.binary_array(digest)],
                names=[doc_id, "_train", "n_tokens", "n_known", "base_score", *each, "text_hash"]))
        kinds = pa.schema([(doc_id, docs.schema.field(1).type), ("_train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), *[(c, pa.float64()) for c in each], ("text_hash", pa.binary())])
        return pa.Table.from_batches(out, schema=kinds)

    return rate


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("train", ~held_out("doc_id", 7))
    return score_texts(docs, "train").select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
