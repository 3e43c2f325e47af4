"""Exact de-duplication: a two-pass Bloom filter finds hashes that may repeat; only their rows shuffle.

Pass one counts every text hash in a filter of two-bit counters. Counters of all
tasks are added, saturating, segment by segment. Pass two probes it: a hash one
of whose counters is below two occurs once for certain, so its row passes
straight through. The other rows, true repeats and a few false positives, are
grouped exactly. The filter's size follows the number of rows up to
``max_slots``; a fuller filter sends more rows through the shuffle but never
changes a result.

Cases: a null text equals the empty text; among equal texts the largest doc_id
stays (null ids are the smallest); of rows that repeat with the same id as well
one stays; an empty table gives an empty result; all input columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import common
from strata.session import materialise

PROBES = 4
SLOTS_PER_ROW = 16
MAX_SLOTS = 1 << 28  # 32 MiB once it holds one bit per slot: the bound of what is broadcast
SEGMENT_SLOTS = 1 << 20


def with_digest(df: DataFrame, text: str, digest: str) -> DataFrame:
    """Add the SHA-256 of the text with A-Z lower-cased. In Arrow batches:
    ``translate`` and ``sha2`` in the JVM took five times as long."""

    @F.pandas_udf("binary")
    def sha(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for texts in batches:
                yield texts.map(lambda t: hashlib.sha256(t.lower()).digest())
        finally:
            common.give_back()

    return df.withColumn(digest, sha(common.text_bytes(text)))


def _slots(digests: pa.Array, n_slots: int) -> np.ndarray:
    """``PROBES`` slot numbers per 32-byte digest."""
    flat, _ = common.bytes_of(digests)
    words = flat.reshape(-1, 32).copy().view("<u8")
    return (words % np.uint64(n_slots)).astype(np.int64)


def repeated_bits(digests: DataFrame, n_rows: int, max_slots: int = MAX_SLOTS) -> list[tuple[int, bytes]]:
    """First pass over a frame whose only column is the digest: per segment one
    bit per slot, set where at least two rows have counted."""
    n_slots = _filter_slots(n_rows, max_slots)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            slots = np.sort(_slots(batch.column(0), n_slots).ravel())
            cut = np.searchsorted(slots, np.arange(0, n_slots + SEGMENT_SLOTS, SEGMENT_SLOTS))
            rows = [(s, slots[a:b]) for s, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in rows], pa.int32()), common.binary_array([(x - s * SEGMENT_SLOTS).astype("<u4").tobytes() for s, x in rows])],
                names=["segment", "slots"],
            )

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, twice = np.zeros(SEGMENT_SLOTS, bool), np.zeros(SEGMENT_SLOTS, bool)
        for batch in batches:
            for blob in batch.column(1):
                x = np.frombuffer(blob.as_buffer(), "<u4")
                own, n = np.unique(x, return_counts=True)
                twice[own[(n > 1) | seen[own]]] = True
                seen[own] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), common.binary_array([np.packbits(twice).tobytes()])], names=["segment", "bits"])

    counted = digests.mapInArrow(common.tidy(count), "segment int, slots binary")
    merged = counted.groupBy("segment").applyInArrow(merge, "segment int, bits binary")
    return [(r[0], bytes(r[1])) for r in merged.toLocalIterator()]


def _filter_slots(n_rows: int, max_slots: int) -> int:
    wanted = max(SEGMENT_SLOTS, SLOTS_PER_ROW * n_rows)
    return min(-(-wanted // SEGMENT_SLOTS) * SEGMENT_SLOTS, max_slots)


def may_repeat(df: DataFrame, digest: str, flag: str, n_rows: int, max_slots: int = MAX_SLOTS) -> DataFrame:
    """Both passes: add a flag that is false only where the digest is unique for certain."""
    n_slots = _filter_slots(n_rows, max_slots)
    bits = np.zeros(n_slots // 8, np.uint8)
    for segment, own in repeated_bits(df.select(digest), n_rows, max_slots):
        bits[segment * SEGMENT_SLOTS // 8 :][: len(own)] = np.frombuffer(own, np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def probe(digests: pd.Series) -> pd.Series:
        slots = _slots(pa.array(digests, pa.binary()), n_slots)
        return pd.Series(((shared.value[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1).all(axis=1))

    return df.withColumn(flag, probe(digest))


def exact_dedup(df: DataFrame, text: str = "text", doc_id: str = "doc_id", digest: str | None = None, max_slots: int = MAX_SLOTS) -> DataFrame:
    """Every input row with ``keep_id``, ``group_size``, ``kept`` and ``digest``.

    Give ``digest`` the name of a column that holds the digests already. The
    added columns get leading underscores where the input has their names.
    """
    if digest is None:
        digest = common.own_name(df, "digest")
        df = with_digest(df, text, digest)
    names = {n: common.own_name(df, n) for n in ("keep_id", "group_size", "kept", "may_repeat", "n_top", "d")}
    n_rows = df.count()
    flag = names["may_repeat"]
    tagged = may_repeat(df, digest, flag, n_rows, max_slots)
    once = tagged.where(~F.col(flag)).withColumns({names["keep_id"]: F.col(doc_id), names["group_size"]: F.lit(1).cast("long"), names["kept"]: F.lit(True)}).drop(flag)

    again = tagged.where(flag).drop(flag)
    per_id = again.select(F.col(digest).alias("_d"), F.col(f"`{doc_id}`").alias("_i")).groupBy("_d", "_i").agg(F.count(F.lit(1)).alias("n"))
    best = per_id.groupBy("_d").agg(F.max("_i").alias("top"), F.sum("n").alias("size"))
    top = best.join(per_id.withColumnsRenamed({"_d": "d2", "_i": "i2"}), (F.col("_d") == F.col("d2")) & F.col("top").eqNullSafe(F.col("i2")))
    key = names["d"]
    top = top.select(F.col("_d").alias(key), F.col("top").alias(names["keep_id"]), F.col("size").alias(names["group_size"]), F.col("n").alias(names["n_top"]))
    joined = again.join(top, F.col(digest) == F.col(key)).drop(key)
    is_top = F.col(doc_id).eqNullSafe(F.col(names["keep_id"]))
    plain = joined.where(~is_top | (F.col(names["n_top"]) == 1)).withColumn(names["kept"], F.col(doc_id).eqNullSafe(F.col(names["keep_id"])))
    # Rows that repeat with their id: any one of them stays.
    rank = F.row_number().over(Window.partitionBy(digest).orderBy(doc_id))
    tied = joined.where(is_top & (F.col(names["n_top"]) > 1)).withColumn(names["kept"], rank == 1)
    return once.unionByName(plain.drop(names["n_top"])).unionByName(tied.drop(names["n_top"]))


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Keeper and group size of every document, by whole normalised text."""
    common.small_batches(spark)
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    digests = materialise(with_digest(docs, "text", "digest").select("doc_id", "digest"), "digests")
    out = exact_dedup(digests, digest="digest")
    return out.select("doc_id", "keep_id", F.col("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP3_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
