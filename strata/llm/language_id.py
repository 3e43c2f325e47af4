"""Language identification by the nearest of several centroids per language.

A text becomes a TF-IDF vector of hashed byte 2- and 3-grams of its lower-cased
letters. Inverse document frequencies come from all labelled rows. Centroids are
fitted by spherical k-means on at most ``SAMPLE`` labelled rows per language
(those with the smallest id hashes; the only sampled step). The language of the
centroid with the highest cosine wins. A text is rejected where that cosine is
below the centroid's radius, a quarter of the lowest cosine among the sample rows
of its language, or where it has no letter.

Cases: null and letterless texts are ``und`` with score 0 and rejected; null
ids are never held out; with no labelled row everything is ``und``; equal
cosines go to the language first in order; other columns are kept; a very long
text is one vector like any other. The model takes 64 KiB a language, so its
size follows the number of languages, never the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import common
from strata.session import broadcast_if_small, materialise

SLOTS = 4096
SAMPLE = 512
CENTROIDS = 4
UNKNOWN = "und"


def _letters() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    plain = [*range(0, 65), *range(91, 97), *range(123, 128)]
    out[plain] = 32
    return out


LETTERS = _letters()


def vectors(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of hashed 2- and 3-grams, one row per text. Other ASCII than letters counts as one space."""
    n = len(at) - 1
    out = np.zeros((n, SLOTS), np.float32)
    if not len(flat):
        return out
    owner = np.repeat(np.arange(n), np.diff(at))
    shown = LETTERS[flat]
    keep = np.concatenate([[True], (shown[1:] != 32) | (shown[:-1] != 32) | (owner[1:] != owner[:-1])])
    shown, owner = shown[keep].astype(np.uint32), owner[keep]
    for size in (2, 3):
        if len(shown) < size:
            continue
        code = shown[: len(shown) - size + 1].copy()
        for i in range(1, size):
            code = (code << 8) | shown[i : len(shown) - size + 1 + i]
        code = ((code + np.uint32(size)) * np.uint32(2654435761)) >> np.uint32(20)
        whole = owner[: len(code)] == owner[size - 1 :]
        out += np.bincount(owner[: len(code)][whole] * SLOTS + code[whole], minlength=n * SLOTS).reshape(n, SLOTS)
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _parts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a few texts, so that their vectors stay small."""
    flat, at = common.bytes_of(column)
    start = 0
    while start < len(at) - 1:
        end = int(np.searchsorted(at, at[start] + common.PIECE_BYTES, side="right")) - 1
        end = min(max(end, start + 1), start + 256, len(at) - 1)
        yield start, flat[at[start] : at[end]], at[start : end + 1] - at[start]
        start = end


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, rows = np.zeros(SLOTS, np.int64), 0
    for batch in batches:
        rows += batch.num_rows
        for _, flat, at in _parts(batch.column(0)):
            found += (vectors(flat, at) > 0).sum(axis=0)
    slots = np.concatenate([[-1], np.flatnonzero(found)])
    yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(np.concatenate([[rows], found[slots[1:]]]), pa.int64())], names=["slot", "n"])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centroids from farthest-first seeds, and the cosine of each row with its own."""
    seeds = [0]
    near = x @ x[0]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, x @ x[seeds[-1]])
    centres = x[seeds]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres, (x @ centres.T).max(axis=1)


class Model:
    """Fitted languages, centroids, radii and inverse document frequencies; a few MB."""

    def __init__(self, labels: list[str], centres: np.ndarray, radii: np.ndarray, idf: np.ndarray):
        self.labels, self.centres, self.radii, self.idf = labels, centres, radii, idf


def held_out(doc_id: str, buckets: int) -> Column:
    """True where crc32 of the id as text leaves remainder 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % buckets == 2, F.lit(False))


def lowered(text: str) -> Column:
    return common.text_bytes(F.lower(F.col(text)))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Learn from rows with a non-null language. Statistics cover all of them."""
    rows = labelled.where(F.col(lang).isNotNull())
    found = rows.select(lowered(text)).mapInArrow(common.tidy(_document_frequencies), "slot int, n long").groupBy("slot").agg(F.sum("n")).collect()
    df = np.zeros(SLOTS)
    total = 0
    for slot, n in found:  # at most SLOTS + 1 rows
        if slot < 0:
            total = n
        else:
            df[slot] = n
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + np.float32(0.1)

    order = F.xxhash64(doc_id)
    nth = F.row_number().over(Window.partitionBy(lang).orderBy("_h"))
    limits = rows.select(lang, order.alias("_h")).withColumn("_n", nth).where(F.col("_n") <= sample).groupBy(lang).agg(F.max("_h").alias("_most"))
    most = materialise(limits.withColumnRenamed(lang, "_lang"), "language-limits")
    chosen = rows.select(F.col(lang).alias("_lang"), order.alias("_h"), lowered(text).alias("_text")).join(broadcast_if_small(most), "_lang").where("_h <= _most")
    chosen = chosen.withColumn("_n", F.row_number().over(Window.partitionBy("_lang").orderBy("_h", "_text"))).where(F.col("_n") <= sample)

    def centres(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_n")
        parts = [weighted(vectors(flat, at), idf) for _, flat, at in _parts(pa.array(pdf["_text"], pa.binary()))]
        x = np.concatenate(parts)
        x = x[np.linalg.norm(x, axis=1) > 0.5]
        if not len(x):
            return pd.DataFrame({"lang": pd.Series([], dtype=object), "centre": pd.Series([], dtype=object), "radius": pd.Series([], dtype=float)})
        centre, near = spherical_kmeans(x, centroids)
        return pd.DataFrame({"lang": key[0], "centre": [c.astype("<f4").tobytes() for c in centre], "radius": float(near.min()) / 4})

    fitted = sorted(map(tuple, chosen.groupBy("_lang").applyInPandas(centres, "lang string, centre binary, radius double").collect()))
    stacked = np.stack([np.frombuffer(c, "<f4") for _, c, _ in fitted]) if fitted else np.zeros((0, SLOTS), np.float32)
    return Model([r[0] for r in fitted], stacked, np.array([r[2] for r in fitted]), idf)


def predict(df: DataFrame, model: Model, text: str = "text", out: str = "_language") -> DataFrame:
    """Add a struct (lang_pred, score, rejected); ``out`` gets underscores in front where the input has that name."""
    out = common.own_name(df, out)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            for texts in batches:
                yield verdicts(texts, shared.value)
        finally:
            common.give_back()

    def verdicts(texts: pd.Series, m: Model) -> pd.DataFrame:
        column = pa.array(texts, pa.binary())
        best, score = np.full(len(texts), -1), np.zeros(len(texts))
        for start, flat, at in _parts(column):
            if len(m.labels):
                cosine = weighted(vectors(flat, at), m.idf) @ m.centres.T
                best[start : start + len(cosine)] = cosine.argmax(axis=1)
                score[start : start + len(cosine)] = cosine.max(axis=1)
        letter = np.array([any(c.isalpha() for c in t.decode()) for t in texts], bool) if len(texts) else np.zeros(0, bool)
        best[~letter] = -1
        labels, radii = np.array([*m.labels, UNKNOWN], object), np.append(m.radii, np.inf)
        score = np.where(best < 0, 0.0, np.clip(score, 0.0, 1.0))
        return pd.DataFrame({"lang_pred": labels[best], "score": score, "rejected": score < radii[best]})

    return df.withColumn(out, nearest(lowered(text)))


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    common.small_batches(spark)
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out("doc_id", 4))
    model = fit(docs.where(~F.col("held_out")))
    return predict(docs.drop("lang"), model).select("doc_id", "held_out", "_language.*")
