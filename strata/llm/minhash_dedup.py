"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document is the multiset of its five-word shingles; a shingle weighs its
count times 1 + ``IDF`` * idf, idf scaled to 0..1. Document frequencies cover
all documents: texts are dealt out in blocks, a block sends its different
shingles by hash segment, and gets their frequencies back in the same order, a
byte each. A document with less than the threshold of its weight in shingles
that others have can have no partner and goes no further.

The others, one of each shingle multiset, get ``BANDS`` x ``ROWS`` samples whose
chance to agree is the weighted Jaccard similarity. Documents that agree in a
band are candidates. Every member of a bucket is compared with the smallest one;
a bucket that then still holds several components is cut into blocks, and every
two blocks meet in a task that tests all pairs of different components and
returns tree links. No candidate is left untested but where its ends are joined
already, so the tests of a bucket without links grow with the square of its
size. A link is a verified weighted Jaccard similarity of ``threshold`` or more.

Cases: null, empty and wordless texts are their own class; shorter texts than
five words are one shingle; equal multisets are one class; the class is the
smallest doc_id, repeated rows share it; null ids are the largest; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm import common, graph
from strata.llm.license_scan import WORDS
from strata.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
IDF = 0.2
BANDS, ROWS = 16, 4
BLOCK_ROWS, BLOCK_BYTES = 256, 8 << 20  # a block of a bucket: documents, bytes of vectors
ELEMENTS = 1 << 20  # shingles compared at once
SALTS = 8  # keys the rows of one class are dealt over
STEP = 8.0  # codes per doubling of a document frequency


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of all texts of a piece, sorted by text and shingle."""
    words, owner, _, _ = common.hashed_words(*common.bytes_of(column), WORDS)
    n = np.bincount(owner, minlength=len(column)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(n)])
    keys, texts = [], []
    if len(words) >= SHINGLE:
        all_ = common.grams(words, SHINGLE)
        whole = owner[: len(all_)] == owner[SHINGLE - 1 :]
        keys.append(all_[whole])
        texts.append(owner[: len(all_)][whole])
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)):
        keys.append(common.grams(words[first[i] : first[i + 1]], int(n[i])))
        texts.append(np.array([i]))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    key, text = np.concatenate(keys), np.concatenate(texts)
    order = np.lexsort((key, text))
    key, text = key[order], text[order]
    start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])]))
    return text[start], key[start], np.diff(np.append(start, len(key)))


def _block_keys(tables: list[pa.RecordBatch], column: int) -> tuple[np.ndarray, np.ndarray]:
    held = common.Gathered(1 << 62)
    for batch in common.pieces(iter(tables), column):
        _, key, _ = shingles(batch.column(column))
        held.add(*common.summed(key, np.ones(len(key), np.int64)))
    return held.take()


def _send(key: tuple, table: pa.Table, n_segments: int) -> pa.Table:
    keys, n = _block_keys(table.to_batches(), 1)
    rows = []
    for s, a, b in common.by_segment(keys, n_segments):
        low, count = common.summed(keys[a:b] & np.uint64(0xFFFFFFFF), n[a:b])
        rows.append((key[0].as_py(), s, common.packed32(low), common.small_counts(count)))
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["block", "segment", "keys", "counts"])


def _frequencies(key: tuple, table: pa.Table) -> pa.Table:
    """Sum the counts of a segment over all blocks, and answer each block in its own order."""
    asked = [common.unpacked32(k.as_py()) for k in table["keys"]]
    held = common.Gathered(1 << 62)
    for own, n in zip(asked, table["counts"]):
        held.add(own, common.read_counts(n.as_py(), len(own)))
    keys, n = held.take()
    codes = np.minimum(255, np.round(STEP * np.log2(n))).astype(np.uint8)
    answers = [codes[np.searchsorted(keys, own)].tobytes() for own in asked]
    return pa.table([table["block"].combine_chunks(), pa.array([key[0].as_py()] * len(asked), pa.int32()), common.binary_array(answers)], names=["block", "segment", "codes"])


def _codes(keys: np.ndarray, answers: pa.Table, n_segments: int) -> np.ndarray:
    """The frequency code of each of a block's keys, from the segments' answers."""
    known = dict(zip(answers["segment"].to_pylist(), answers["codes"]))
    out = np.zeros(len(keys), np.uint8)
    for s, a, b in common.by_segment(keys, n_segments):
        low = keys[a:b] & np.uint64(0xFFFFFFFF)
        out[a:b] = np.frombuffer(known[s].as_py(), np.uint8)[np.searchsorted(np.unique(low), low)]
    return out


def sample(keys: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """``n`` consistent weighted samples of a weighted set, each as one 64-bit number."""
    best, out = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64)
    salt = common.mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    unit = np.float32(1 / (1 << 24))
    draw = lambda x, shift: (((x >> np.uint64(shift)) & np.uint64(0xFFFFFF)).astype(np.float32) + np.float32(0.5)) * unit
    for at in range(0, len(keys), 1024):
        k = keys[at : at + 1024]
        a = common.mix64(k[:, None] ^ salt[None, :])
        b = common.mix64(a + np.uint64(0x9E3779B97F4A7C15))
        r = -np.log(draw(a, 0) * draw(a, 24))
        log_c = np.log(-np.log(draw(b, 0) * draw(b, 24)))
        beta = ((a >> np.uint64(48)).astype(np.float32) * np.float32(256) + (b >> np.uint64(48)).astype(np.float32) * np.float32(1 / 256)) * unit
        t = np.floor(np.log(weights[at : at + 1024].astype(np.float32))[:, None] / r + beta)
        log_a = log_c - r * (t + 1 - beta)
        low = log_a.argmin(axis=0)
        own = np.arange(n)
        better = log_a[low, own] < best
        best = np.where(better, log_a[low, own], best)
        out = np.where(better, common.mix64(k[low] + t[low, own].astype(np.int64).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)), out)
    return out


def shingle_weights(n_docs: int) -> np.ndarray:
    """What one occurrence of a shingle weighs, by frequency code."""
    idf = 1 - np.log((1 + np.exp2(np.arange(256) / STEP)) / 2) / np.log((2 + max(n_docs, 1)) / 2)
    return 1 + IDF * np.clip(idf, 0, 1)


def _describe(n_segments: int, n_docs: int, threshold: float, id_type: pa.DataType):
    """Per document of a block: whether it can have a partner, its multiset's key and, once per key, vector and bands."""

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys, _ = _block_keys(docs.to_batches(), 2)
        codes = _codes(keys, answers, n_segments)
        weight_of = shingle_weights(n_docs)
        seen: set[bytes] = set()
        rows: list[tuple] = []
        for batch in common.pieces(iter(docs.to_batches()), 2):
            text, shingle, n = shingles(batch.column(2))
            code = codes[np.searchsorted(keys, shingle)]
            weight = n * weight_of[code]
            edge = np.searchsorted(text, np.arange(batch.num_rows + 1))
            ids = list(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()))
            for i in range(batch.num_rows):
                own = slice(edge[i], edge[i + 1])
                w = weight[own]
                if not len(w) or w[code[own] > 0].sum() < (threshold - 1e-6) * w.sum():
                    rows.append((*ids[i], None, None, None, None))
                    continue
                blob = (shingle[own] >> np.uint64(32)).astype("<u4")
                order = np.argsort(blob, kind="stable")
                digest = hashlib.md5(shingle[own].tobytes() + n[own].tobytes()).digest()
                if digest in seen:
                    rows.append((*ids[i], digest, None, None, None))
                    continue
                seen.add(digest)
                picked = sample(shingle[own], w, BANDS * ROWS).reshape(BANDS, ROWS)
                bands = common.grams(np.ascontiguousarray(picked.T), ROWS)[0].view(np.int64).tolist()
                rows.append((*ids[i], digest, len(w), blob[order].tobytes() + code[own][order].tobytes() + common.small_counts(n[own][order]), bands))
        kinds = [id_type, pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["id", "text_hash", "digest", "n", "vector", "bands"])

    return run


def unpacked(vector: bytes, n: int, weight_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n sorted 32-bit keys and weights of a packed vector: keys, frequency codes, counts."""
    code = np.frombuffer(vector, np.uint8, n, 4 * n)
    return np.frombuffer(vector, "<u4", n), common.read_counts(vector[5 * n :], n) * weight_of[code]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two unpacked vectors."""
    (x, v), (y, w) = a, b
    _, i, j = np.intersect1d(x, y, return_indices=True)
    low = np.minimum(v[i], w[j]).sum()
    return float(low / (v.sum() + w.sum() - low))


def _verified(pairs: DataFrame, vectors: DataFrame, threshold: float, weight_of: np.ndarray) -> DataFrame:
    """The pairs (a, b) with a similarity of ``threshold`` or more. Pairs travel to
    the larger number first, so the many partners of one document stay spread."""

    @F.pandas_udf("boolean")
    def near(x: pd.Series, n: pd.Series, y: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([weighted_jaccard(unpacked(p, k, weight_of), unpacked(q, l, weight_of)) >= threshold for p, k, q, l in zip(x, n, y, m)], dtype=bool)

    with_b = pairs.join(vectors.select(F.col("cid").alias("b"), F.col("vector").alias("vb"), F.col("n").alias("nb")), "b")
    with_a = with_b.join(vectors.select(F.col("cid").alias("a"), F.col("vector").alias("va"), F.col("n").alias("na")), "a")
    return with_a.where(near("va", "na", "vb", "nb")).select("a", "b")


def _compare(threshold: float, weight_of: np.ndarray):
    """Tree links between the members of one block, or of two blocks, of a bucket.

    A pair is left out only where its answer is known: it is joined already, was
    tested as a pair of the bucket's first, shares an earlier band (where it is
    tested), or has total weights too far apart to reach the threshold.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        band, crossed = key[0].as_py(), key[2].as_py() != key[3].as_py()
        table = table.combine_chunks().sort_by("cid")
        ids, first, block = table["cid"].to_numpy(), table["first"][0].as_py(), table["block"].to_numpy()
        label = table["component"].to_numpy().copy()
        bands = np.array(table["bands"].to_pylist(), np.int64)[:, :band]
        n = table["n"].to_numpy()
        parts = [unpacked(v.as_py(), k, weight_of) for v, k in zip(table["vector"], n)]
        start = np.concatenate([[0], np.cumsum(n)])
        words, column = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        weight = np.concatenate([w for _, w in parts])
        total = np.add.reduceat(weight, start[:-1])
        own, a, b = np.zeros(len(words)), [], []
        for x in range(int(ids[0] == first), len(ids) - 1):
            open_ = (label[x + 1 :] != label[x]) & ~(bands[x + 1 :] == bands[x]).any(axis=1)
            open_ &= np.minimum(total[x + 1 :], total[x]) >= (threshold - 1e-9) * np.maximum(total[x + 1 :], total[x])
            if crossed:
                open_ &= block[x + 1 :] != block[x]
            y = np.flatnonzero(open_) + x + 1
            mine = slice(start[x], start[x + 1])
            own[column[mine]] = weight[mine]
            for some in np.split(y, np.flatnonzero(np.diff(np.cumsum(n[y]) // ELEMENTS)) + 1) if len(y) else []:
                edge = np.cumsum(n[some]) - n[some]
                at = np.repeat(start[some] - edge, n[some]) + np.arange(n[some].sum())
                low = np.add.reduceat(np.minimum(own[column[at]], weight[at]), edge)
                for z in some[low / (total[x] + total[some] - low) >= threshold]:
                    if label[z] != label[x]:
                        label[label == label[z]] = label[x]
                        a.append(ids[x])
                        b.append(ids[z])
            own[column[mine]] = 0
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(SALTS)).cast("int"))


def _copied(keys: DataFrame) -> DataFrame:
    """The other side of a salted join: a row per salt. It has only what several documents share."""
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the id, ``class_id``, ``kept``, and ``text_hash`` (xxhash64 of the text's bytes)."""
    spark = df.sparkSession
    common.small_batches(spark)
    n_docs, n_bytes = common.input_bytes(df, text)
    n_segments = common.count_blocks(n_bytes)
    weight_of = shingle_weights(n_docs)
    dealt = df.select(F.col(doc_id).alias("id"), common.text_bytes(text).alias("bytes")).withColumn("block", common.block_of("id", "bytes", n_segments)).withColumn("text_hash", F.xxhash64("bytes"))

    def send(key: tuple, table: pa.Table) -> pa.Table:
        return _send(key, table, n_segments)

    sent = dealt.select("block", "bytes").groupBy("block").applyInArrow(common.tidy_group(send), "block int, segment int, keys binary, counts binary")
    answers = materialise(sent.groupBy("segment").applyInArrow(common.tidy_group(_frequencies), "block int, segment int, codes binary"), "shingle-frequencies")
    kind = df.schema[doc_id].dataType
    described = dealt.select("block", "id", "bytes", "text_hash").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        common.tidy_group(_describe(n_segments, n_docs, threshold, to_arrow_type(kind))), f"id {kind.simpleString()}, text_hash long, digest binary, n long, vector binary, bands array<long>")
    docs = materialise(described.withColumn("cid", F.monotonically_increasing_id()), "near-documents")

    # One number per multiset; only a row with a vector can lend its own.
    seen = docs.where("digest IS NOT NULL").groupBy("digest").agg(F.min(F.when(F.col("vector").isNotNull(), F.col("cid"))).alias("cid"), F.count(F.lit(1)).alias("size"))
    classes = materialise(seen, "near-classes")
    chosen = docs.where("vector IS NOT NULL").select("cid", "n", "vector", "bands").join(classes.select("cid"), "cid")
    buckets = chosen.select("cid", F.octet_length("vector").alias("n_bytes"), F.posexplode("bands").alias("band", "sig"))
    vectors = docs.where("vector IS NOT NULL").select("cid", "n", "vector")
    shared = buckets.groupBy("band", "sig").agg(F.min("cid").alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = materialise(buckets.join(shared, ["band", "sig"]).select("band", "sig", "cid", "first", "n_bytes"), "near-buckets")
    tested = buckets.where("cid <> first").select(F.col("first").alias("a"), F.col("cid").alias("b")).distinct()
    links = materialise(_verified(tested, vectors, threshold, weight_of), "near-links")

    # Buckets that still hold several components are compared block against block.
    named = buckets.join(graph.components(links).select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    size = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n_bytes") / BLOCK_BYTES)).cast("int")
    mixed = named.groupBy("band", "sig").agg(F.min("component").alias("low"), F.max("component").alias("high"), size.alias("blocks")).where("low <> high").select("band", "sig", "blocks")
    cut = named.join(mixed, ["band", "sig"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = cut.select("band", "sig", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cid", "first", "component", "block")
    held = paired.join(chosen, "cid").groupBy("band", "sig", "i", "j").applyInArrow(common.tidy_group(_compare(threshold, weight_of)), "a long, b long")
    joined = graph.components(links.unionByName(materialise(held, "near-links")))
    # Documents that stand alone have keys of their own, and a class's rows spread over SALTS keys, so no join has a hot one.
    member = _salted(docs.select("id", "text_hash", "cid", F.coalesce("digest", F.lpad(F.col("cid").cast("string"), 24, "0").cast("binary")).alias("digest")))
    member = member.join(_copied(classes.where("size > 1").select("digest", F.col("cid").alias("class"))), ["digest", "salt"], "left")
    member = _salted(member.select("id", "text_hash", "cid", F.coalesce("class", "cid").alias("class")))
    member = member.join(_copied(joined.withColumnRenamed("node", "class")), ["class", "salt"], "left")
    member = materialise(member.select("id", "text_hash", "cid", F.coalesce("component", "class").alias("c")), "near-members")
    lowest = member.groupBy("c").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("size")).where("size > 1").select("c", "class_id")
    out = _salted(member).join(_copied(lowest), ["c", "salt"], "left").withColumn("class_id", F.coalesce("class_id", "id"))
    return out.select(F.col("id").alias(doc_id), "class_id", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"), "text_hash")


def op6_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_hash")
