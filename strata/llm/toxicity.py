"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text.

Folding lower-cases, strips accents, maps letters that look like Latin ones
(Cyrillic, Greek, full-width and styled forms) and reads digits and signs next
to letters as the letters they stand for; i, l and 1 are one letter. What is
neither letter nor digit becomes a space.

The lexicon is learned: candidates are folded words and word beginnings that
several toxic texts share, their weight is the logarithm of their share of the
words in toxic texts over that in clean ones, and only terms whose document
counts differ clearly stay. A word counts with the best of its terms, unless an
exception phrase covers it. The sum of a text, and that sum divided by its
words, go through a logistic curve fitted on the same rows.

Bounds: learning takes about ``SAMPLE`` rows of each label (those with the
smallest hash of the id, one of an id) and at most ``TERMS`` candidates, the most frequent
ones; texts are scored whole, whatever their length.

Cases: null and empty texts, and texts without a match, get the score the curve
has at zero; rows without a label, or whose id is null, teach nothing; of rows
with one id and label the smallest text teaches; repeated rows and ties score alike; without any
toxic row to learn from all scores are 0, without any clean one 1; a very long
text is folded by itself, in some 40 bytes a character; an empty table gives an
empty result. Other columns are kept by ``score``; a clashing name is escaped.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import common
from strata.session import broadcast_if_small, materialise

SAMPLE = 20_000
TERMS = 20_000
BEGINNINGS = (4, 5, 6, 7, 8)  # letters of a word that can be a term
LEAST_DOCS = 3  # toxic texts that must share a candidate, and
LEAST_SHARE = 0.004  # their share
EXPLAINED = 0.95  # share of a beginning's toxic texts that a longer term has for the beginning to go
CLEAR = 4.0  # standard deviations between expected and seen toxic texts of a term
PIECE = 1 << 18

# Phrases in which a word of abuse is none.
EXCEPTIONS = (
    "trash can", "trash bag", "trash bin", "trash collection", "clown fish", "clown car", "circus clown", "rodeo clown",
    "pond scum", "soap scum", "sore loser", "loser pays", "stupid question", "no stupid questions", "disgusting smell", "disgusting taste",
)

# Letters that look like the Latin letter below them, and signs read as letters.
LOOK_ALIKES = {
    "аαɑ": "a", "в": "b", "сϲ": "c", "ԁ": "d", "еεҽ": "e", "ɡ": "g", "нһ": "h", "іιıӏ": "i", "ј": "j", "кκ": "k", "м": "m",
    "пη": "n", "оοσօ": "o", "рρ": "p", "ԛ": "q", "гѓ": "r", "ѕ": "s", "тτ": "t", "υμս": "u", "ν": "v", "ѡωԝ": "w", "хχ": "x", "уγ": "y",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
SPACE, DROPPED, BORDER = 32, 0, 10


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    """Folded code point of every code point of the first two planes."""
    alike = {ord(c): ord(to) for letters, to in LOOK_ALIKES.items() for c in letters}
    out = np.full(0x20000, SPACE, np.uint32)
    for cp in range(len(out)):
        c = chr(cp)
        if c in STANDS_FOR:
            out[cp] = cp
            continue
        kind = unicodedata.category(c)
        if kind[0] == "M" or kind in ("Cf", "Cs"):
            out[cp] = DROPPED
        elif kind[0] in "LN":
            first = unicodedata.normalize("NFKD", c.lower())[0]
            first = unicodedata.normalize("NFKD", first.lower())[0]
            out[cp] = alike.get(ord(first), ord(first))
    out[[ord("l"), ord("L")]] = ord("i")
    out[BORDER] = BORDER
    return out


@lru_cache(maxsize=1)
def _signs() -> np.ndarray:
    out = np.zeros(128, np.uint32)
    for sign, letter in STANDS_FOR.items():
        out[ord(sign)] = ord(letter)
    return out


def folded(texts: Sequence[str]) -> list[str]:
    """Folded texts: words with one space before, between and after them."""
    if not texts:
        return []
    joined = "\n".join(f" {t} ".replace("\n", " ") for t in texts)
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _table()
    c = np.where(c < len(table), table[np.minimum(c, len(table) - 1)], c)
    c = c[c != DROPPED]
    ascii_ = np.minimum(c, 127)
    sign = np.where(c < 128, _signs()[ascii_], 0)
    digit = (c >= 48) & (c <= 57)
    letter = ~digit & (sign == 0) & (c != SPACE) & (c != BORDER)
    for _ in range(3):  # a sign beside one that was read as a letter can be read too
        right = np.append(letter[1:], False)
        left = np.concatenate([[False], letter[:-1]])
        new = (sign != 0) & ~letter & np.where(digit, left | right, right)
        if not new.any():
            break
        letter |= new
    c = np.where(letter & (sign != 0), sign, c)
    c = np.where(letter | digit | (c == BORDER), c, SPACE).astype(np.uint32)
    c = np.where(c == ord("l"), ord("i"), c).astype(np.uint32)
    again = (c[1:] == SPACE) & (c[:-1] == SPACE)
    c = c[np.concatenate([[True], ~again])]
    return c.tobytes().decode("utf-32-le", "surrogatepass").split("\n")


def n_words(text: str) -> int:
    """Words of a folded text."""
    return max(0, text.count(" ") - 1)


def terms_of(text: str) -> set[str]:
    """Folded words, and their beginnings, that can be terms."""
    out = set()
    for word in set(text.split()):
        if len(word) <= 40:
            out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in BEGINNINGS if len(word) >= n)
    return out


def automaton(terms: Sequence[str], exceptions: Sequence[str] = ()):
    """Aho-Corasick over terms (values: number of the term, length) and exception phrases (number -1)."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        out.add_word(term, (i, len(term)))
    for phrase in folded([e for e in exceptions if e.strip()]):
        if phrase.strip():
            # A phrase that is a term too stays an exception.
            out.add_word(phrase, (-1, len(phrase)))
    if len(out):
        out.make_automaton()
    return out


def matched(machine, text: str, weights: Sequence[float]) -> list[tuple[int, float]]:
    """(first place, weight) of every word that a term matches and no exception covers."""
    if not len(machine):
        return []
    best: dict[int, float] = {}
    free: list[tuple[int, int]] = []
    for end, (term, length) in machine.iter(text):
        start = end - length + 1
        if term < 0:
            free.append((start, end))
        elif weights[term] > best.get(start, 0.0):
            best[start] = weights[term]
    for a, b in free:
        for start in [s for s in best if a <= s < b]:
            del best[start]
    return list(best.items())


@dataclass(frozen=True)
class Lexicon:
    """Terms in folded form, their weights, exception phrases and the curve's three coefficients."""

    terms: tuple[str, ...]
    weights: tuple[float, ...]
    exceptions: tuple[str, ...]
    curve: tuple[float, float, float]


def fitted_curve(share: np.ndarray, total: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression over bins of both features, by Newton steps with a slight pull to zero."""
    x = np.stack([np.ones(len(share)), share, total], axis=1)
    w, pull = np.zeros(3), np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        n = clean + toxic
        gradient = x.T @ (toxic - n * p) - pull @ w
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + pull, gradient)
        w = w + step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list]]:
    """Folded texts of the first column with the values of the second, a piece at a time."""
    for piece in common.pieces(batches, 0, PIECE):
        yield folded([t.decode("utf-8", "replace") for t in piece.column(0).to_pylist()]), piece.column(1).to_pylist()


def _toxic_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, int] = {}

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict({"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
        counts.clear()
        return batch

    for texts, _ in _texts(batches):
        for text in texts:
            for term in terms_of(text):
                counts[term] = counts.get(term, 0) + 1
        if len(counts) > 500_000:
            yield out()
    yield out()


def fit(labelled: DataFrame, text: str = "text", toxic: str = "toxic", id: str = "doc_id", exceptions: Sequence[str] = EXCEPTIONS, sample: int = SAMPLE, n_terms: int = TERMS) -> Lexicon:
    """Learn from a bounded number of rows with a text and a 0/1 label; ``labelled`` may repeat ids."""
    label = (F.col(f"`{toxic}`") > 0).cast("int")
    rows = labelled.where(F.col(f"`{toxic}`").isNotNull() & F.col(f"`{id}`").isNotNull())
    rows = rows.select(common.text_bytes(F.col(f"`{text}`")).alias("t"), label.alias("y"), F.xxhash64(F.col(f"`{id}`")).alias("h"))
    spark = rows.sparkSession
    found = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    # The hash, as a share of its range, below what leaves about ``sample`` rows of a label; a repeated id teaches once.
    place = F.col("h").cast("double") / 2.0**64 + 0.5
    least = F.when(F.col("y") == 1, F.lit(sample / max(found.get(1, 0), 1))).otherwise(F.lit(sample / max(found.get(0, 0), 1)))
    rows = materialise(rows.where(place < least).groupBy("y", "h").agg(F.min("t").alias("t")).select("t", "y"), "labelled")
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    exceptions = tuple(exceptions)
    if not n1 or not n0:
        return Lexicon((), (), exceptions, (30.0 if n1 else -30.0, 0.0, 0.0))
    seen = rows.where("y = 1").select("t", "y").mapInArrow(_toxic_terms, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    seen = seen.where(F.col("n") >= max(LEAST_DOCS, LEAST_SHARE * n1)).orderBy(F.desc("n"), "term").limit(n_terms)
    terms = [r["term"] for r in seen.select("term").collect()]
    shared = spark.sparkContext.broadcast(terms)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per label and term the texts that hold it and the sum of its shares of their words."""
        machine = automaton(shared.value)
        docs, shares = np.zeros((2, len(shared.value)), np.int64), np.zeros((2, len(shared.value)))
        for texts, labels in _texts(batches):
            for one, y in zip(texts, labels):
                words = n_words(one)
                if not words or not len(machine):
                    continue
                found, times = np.unique(np.fromiter((term for _, (term, _) in machine.iter(one)), np.int64), return_counts=True)
                docs[y, found] += 1
                shares[y, found] += times / words
        y, term = np.nonzero(docs)
        yield pa.RecordBatch.from_pydict({"y": pa.array(y, pa.int32()), "i": pa.array(term, pa.int32()), "docs": pa.array(docs[y, term]), "share": pa.array(shares[y, term])})

    sums = rows.mapInArrow(measured, "y int, i int, docs long, share double").groupBy("y", "i").agg(F.sum("docs"), F.sum("share")).collect()
    docs, shares = np.zeros((2, len(terms))), np.zeros((2, len(terms)))
    for y, i, d, s in sums:  # at most two rows a candidate
        docs[y, i], shares[y, i] = d, round(s, 9)
    least = 0.02 / n1
    weights = np.log((shares[1] / n1 + least) / (shares[0] / n0 + least))
    expected = docs.sum(axis=0) * n1 / (n1 + n0)
    clear = (docs[1] - expected) / np.sqrt(np.maximum(expected * n0 / (n1 + n0), 1e-9))
    number = {term: i for i, term in enumerate(terms)}
    good = set(np.flatnonzero((weights >= 0.7) & (clear >= CLEAR)).tolist())
    for i in sorted(good):
        # A beginning whose texts a longer term explains would only catch other words.
        for n in range(2, len(terms[i])):
            shorter = number.get(terms[i][:n])
            if shorter is not None and docs[1, i] >= EXPLAINED * docs[1, shorter]:
                good.discard(shorter)
    good = np.array(sorted(good), np.int64)
    terms, weights = tuple(terms[i] for i in good), tuple(float(w) for w in np.round(weights[good], 6))
    model = Lexicon(terms, weights, exceptions, (0.0, 0.0, 0.0))
    scored = _sums(rows, "t", model, "s").select("y", *_features("s"))
    bins = scored.groupBy("y", F.round(F.col("by_length") * 20).alias("a"), F.round(F.col("total") * 10).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    seen_bins: dict[tuple[float, float], list[int]] = {}
    for r in bins.collect():  # a few hundred, as both are logarithms
        seen_bins.setdefault((r["a"], r["b"]), [0, 0])[r["y"]] += r["n"]
    places = sorted(seen_bins)
    a, b = (np.array([p[k] for p in places]) for k in (0, 1))
    counts = np.array([seen_bins[p] for p in places], float)
    return Lexicon(terms, weights, exceptions, fitted_curve(a / 20, b / 10, counts[:, 0], counts[:, 1]))


def _sums(df: DataFrame, text: str, model: Lexicon, out: str) -> DataFrame:
    """Add a struct: summed weight, words, and matches of a binary text column."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("weight double, words long, hits long")
    def sums(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        machine = automaton(m.terms, m.exceptions)
        for batch in batches:
            weight, words, hits = [], [], []
            column = pa.RecordBatch.from_arrays([pa.array(batch, pa.binary())], names=["t"])
            for piece in common.pieces(iter([column]), 0, PIECE):
                for one in folded([t.decode("utf-8", "replace") for t in piece.column(0).to_pylist()]):
                    found = matched(machine, one, m.weights)
                    weight.append(sum(w for _, w in found))
                    words.append(n_words(one))
                    hits.append(len(found))
            yield pd.DataFrame({"weight": weight, "words": words, "hits": hits})

    return df.withColumn(out, sums(F.col(text)))


def _features(sums: str) -> tuple[Column, Column]:
    """What the curve sees: weight by length, and weight, both on a logarithmic scale."""
    s = F.col(sums)
    return F.log1p(F.lit(100) * s["weight"] / (s["words"] + 10)).alias("by_length"), F.log1p(s["weight"]).alias("total")


def score(docs: DataFrame, model: Lexicon, text: str | Column = "text", out: str = "toxicity") -> DataFrame:
    """Add a struct (score, hits, weight, words); ``out`` gets underscores in front where the name is taken."""
    body, sums, out = (common.own_name(docs, n) for n in ("_folding", "_sums", out))
    by_length, total = _features(sums)
    bias, a, b = model.curve
    curve = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(bias) + F.lit(a) * by_length + F.lit(b) * total)))
    s = F.col(sums)
    done = _sums(docs.withColumn(body, common.text_bytes(text)), body, model, sums)
    return done.withColumn(out, F.struct(curve.alias("score"), s["hits"].alias("hits"), s["weight"].alias("weight"), s["words"].alias("words"))).drop(body, sums)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; the lexicon comes from labelled documents that are not held out."""
    common.small_batches(spark)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    labels = common.table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic IS NOT NULL")
    labels = broadcast_if_small(labels)
    model = fit(docs.where("NOT held_out").join(labels, "doc_id"))
    scored = score(docs, model)
    shown = F.col("toxicity")
    return scored.select("doc_id", "held_out", shown["score"].alias("score"), F.when(shown["score"] >= 0.5, 1).otherwise(0).alias("predicted"), shown["hits"].alias("hits"))
