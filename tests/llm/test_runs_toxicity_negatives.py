"""Periodic runs, toxicity and hard negatives against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives, periodic_runs, toxicity

# ---------------------------------------------------------------- periodic runs


def brute_runs(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_random_words(least):
    rnd = random.Random(least)
    for _ in range(400):
        words = [rnd.randrange(rnd.choice([1, 2, 3])) for _ in range(rnd.randint(0, 60))]
        if words and rnd.random() < 0.3:
            words = (words[: rnd.randint(1, len(words))] * 60)[:60]
        assert [tuple(r) for r in periodic_runs.runs_of(np.array(words, np.int64), least).tolist()] == brute_runs(words, least)


def test_lyndon_array():
    rnd = random.Random(3)
    for _ in range(300):
        s = [rnd.randrange(3) for _ in range(rnd.randint(1, 30))]
        longest = []
        for i in range(len(s)):
            # A Lyndon word is smaller than all its proper suffixes.
            longest.append(max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))))
        assert periodic_runs.lyndon_array(s, 3).tolist() == longest


def test_wrong_hashes_are_replaced_by_comparing(monkeypatch):
    words = np.array([0, 1] * 10 + [2, 0, 1, 3] * 4 + list(range(5, 30)), np.int64)
    right = brute_runs(words.tolist())
    real = periodic_runs.extensions

    def too_long(words, at, period):
        left, right = real(words, at, period)
        return np.minimum(left + 3, at), np.minimum(right + 5, len(words) - at - period)

    monkeypatch.setattr(periodic_runs, "extensions", too_long)
    assert [tuple(r) for r in periodic_runs.runs_of(words).tolist()] == right


def test_long_stretches_use_arrays(monkeypatch):
    words = [i % 7 for i in range(100)] + [i % 3 for i in range(50)]
    before = periodic_runs.lyndon_array(words, 7).tolist()
    monkeypatch.setattr(periodic_runs, "LIST_WORDS", 10)
    assert periodic_runs.lyndon_array(words, 7).tolist() == before


RUN_TEXTS = [
    (1, "a b " * 10), (2, None), (3, ""), (4, " \t\n"), (5, "one two three"), (6, "x " * 12), (6, "x " * 12), (7, "x " * 11), (None, "p q r " * 5),
    (8, "äö 漢字\t😀 " * 9 + "end"), (9, "lead in " + "s t u v w x " * 2 + "tail " * 20 + "\x0bout"), (10, "w" * 50_000 + " " + "k l m " * 2000),
]


def test_periodic_runs(spark):
    docs = spark.createDataFrame([(i, t, "n", "r", 5) for i, t in RUN_TEXTS], "doc_id long, text string, n_words string, runs string, c0 int")
    got = periodic_runs.periodic_runs(docs, carry=["doc_id", "n_words", "runs", "c0"])
    assert got.columns == ["doc_id", "n_words", "runs", "c0", "_n_words", "_runs", "collapsed"]
    seen = sorted((repr(r.doc_id), r._n_words, [tuple(x) for x in r._runs], r.collapsed, r.n_words, r.c0) for r in got.collect())
    want = sorted((repr(i), len(w), (r := brute_runs(w)) and r or [], collapsed(w, r), "n", 5) for i, w in ((i, split(t)) for i, t in RUN_TEXTS))
    assert seen == want
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_op11_on_documents(spark, data):
    want = {}
    for doc in pq.read_table(f"{data}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        words, h = split(doc["text"]), zlib.crc32(str(doc["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = sorted(brute_runs(words) if len(words) < 1500 else fast_runs(words), key=lambda r: (r[0], r[2]))
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        digest = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), collapsed(words, runs))]
        want[doc["doc_id"]] = (len(runs), *top, 1000 * top[1] // top[2] if runs else None, *digest)
    got = periodic_runs.op11_periodic_runs(spark, data)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def fast_runs(words, least=12):
    numbers = np.unique(np.array(words, object), return_inverse=True)[1]
    found = {}
    for q in range(1, len(words) // 2 + 1):
        same = np.diff(np.concatenate([[0], (numbers[q:] == numbers[:-q]).astype(int), [0]]))
        for a, b in zip(np.flatnonzero(same == 1).tolist(), (np.flatnonzero(same == -1) + q).tolist()):
            if b - a >= max(least, 2 * q):
                found.setdefault((a, b), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def test_a_text_of_many_megabytes(spark):
    text = "lorem ipsum dolor " * 400_000 + " ".join(f"w{i}" for i in range(300_000))
    got = periodic_runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.n_words == 1_500_000 and [tuple(r) for r in got.runs] == [(0, 1_200_000, 3)]
    assert got.collapsed == "lorem ipsum dolor " + text[18 * 400_000 :]


# ---------------------------------------------------------------- toxicity


def test_folding():
    assert toxicity.folded(["1D10T ld!ot TRASH!! $tupid the$$$ 2020 a1b2", "", "Ѕtuрid é​x\nＷｏｒｄ", "x"]) == [
        " idiot idiot trash stupid the 2020 aib2 ", " ", " stupid ex word ", " x "]
    assert toxicity.folded([]) == [] and toxicity.n_words(" ") == 0 and toxicity.n_words(" a b ") == 2


def test_matches_count_words_once_and_leave_exceptions():
    machine = toxicity.automaton([" trash", " trash ", " ciown"], ["Trash can"])
    text = toxicity.folded(["trash trashy Trash can CLOWNS untrash"])[0]
    assert sorted(toxicity.matched(machine, text, [1.0, 3.0, 2.0])) == [(0, 3.0), (text.index(" trashy"), 1.0), (text.index(" ciowns"), 2.0)]
    assert toxicity.matched(toxicity.automaton([]), " a ", []) == []


@pytest.fixture(scope="module")
def lexicon(spark):
    rnd = random.Random(5)
    plain = [f"{a}{b}" for a in ("lo", "ra", "mi", "te", "su", "ka") for b in ("pel", "din", "mor", "sto", "va", "nix")]
    rows = []
    for i in range(400):
        words = [rnd.choice(plain) for _ in range(rnd.randint(20, 200))]
        if i % 4 == 0:
            for _ in range(1 + len(words) // 30):
                words[rnd.randrange(len(words))] = rnd.choice(["dreckian", "dreckolo", "pfuiword"])
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return toxicity.fit(spark.createDataFrame([*rows, (None, "dreck", 1), (9000, "dreck", None)], "doc_id long, text string, toxic int"))


def test_fit_finds_words_and_beginnings(lexicon):
    assert any(t.startswith(" drec") for t in lexicon.terms) and any(t.startswith(" pfui") for t in lexicon.terms)
    assert all(t.startswith((" drec", " pfui")) for t in lexicon.terms)


def test_score(spark, lexicon):
    docs = spark.createDataFrame([
        (1, "lopel radin dreckian mimor", "q"), (2, "lopel radin mimor", "q"), (3, None, "q"), (4, "", "q"), (5, "DR3CKIAN pfu1word", "q"), (5, "DR3CKIAN pfu1word", "q"),
        (6, "дreckian ԁrесkіаn", "q"), (None, "dreckolo", "q"), (7, "lopel radin " * 500_000 + "dreckian", "q"), (8, "漢字 😀 !!! 123", "q"),
    ], "doc_id long, text string, toxicity string")
    rows = toxicity.score(docs, lexicon).collect()
    assert rows[0].toxicity == "q" and len(rows) == 10
    got = {r.doc_id: r._toxicity for r in rows}
    assert got[1].score > 0.5 > got[2].score and got[5].score > 0.9 and got[None].score > 0.5 and got[6].hits == 1
    assert got[2].score == got[3].score == got[4].score == got[8].score and got[7].hits == 1 and got[7].words == 1_000_001
    assert got[7].score < got[1].score and all(0 <= s.score <= 1 for s in got.values())
    assert toxicity.score(docs.limit(0), lexicon).count() == 0


def test_fit_without_one_label(spark):
    for y, low, high in ((1, 0.99, 1), (0, 0, 0.01)):
        model = toxicity.fit(spark.createDataFrame([(1, "a b", y)], "doc_id long, text string, toxic int"))
        got = toxicity.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).first().toxicity.score
        assert low <= got <= high
    assert toxicity.fit(spark.createDataFrame([], "doc_id long, text string, toxic int")).terms == ()


def test_op12_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in toxicity.op12_toxicity(spark, folder).collect()}
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id"]).column(0).to_pylist()
    assert sorted(rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for i, r in rows.items())
    labels = [(r["doc_id"], r["toxic"]) for r in pq.read_table(f"{folder}/labels.parquet").to_pylist() if r["toxic"] is not None]
    right = [rows[i].predicted == y for i, y in labels if rows[i].held_out]
    caught = [rows[i].predicted for i, y in labels if y]
    assert np.mean(right) > 0.95 and np.mean(caught) > 0.75


# ---------------------------------------------------------------- hard negatives


def brute_negatives(rows, is_anchor, positives=5, negatives=10):
    """rows: (id, label, vector); all of one length."""
    out = []
    for a in sorted({(i, y, tuple(v)) for i, y, v in rows if is_anchor(i)}):
        scored = sorted((-sum(x * y for x, y in zip(a[2], v)), i, y) for i, y, v in rows if i != a[0])
        for score, i, _ in [s for s in scored if s[2] == a[1]][:positives]:
            fits = [(n, -s) for s, n, y in scored if y != a[1] and 30 * -score <= 100 * -s <= 90 * -score][:negatives]
            out += [(a[0], i, rank, n, -score, s) for rank, (n, s) in enumerate(fits, 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def run(spark, rows, schema="vec_id long, label int, embedding array<double>", **options):
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") % 10 == 0, **options).select(COLUMNS).collect())


@pytest.mark.parametrize("part_rows", [1 << 16, 40])
def test_hard_negatives(spark, part_rows, monkeypatch):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(6, 20))
    rows = []
    for i in range(300):
        label = int(rnd.integers(0, 3))
        v = np.floor(40 * (centres[label + 3 * int(rnd.integers(0, 2))] + rnd.normal(size=20) * 0.5))
        rows.append((i, label, v.tolist()))
    rows += [(i + 300, int(rnd.integers(0, 3)), rows[0][2]) for i in range(60)]  # ties
    rows += [(400, 7, rows[0][2]), (410, 8, [-x for x in rows[0][2]]), (5, 1, rows[5][2])]  # alone with its label, negative scores, a repeated id
    assert run(spark, rows, part_rows=part_rows) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_pairs_above_loses_nothing():
    rnd = np.random.default_rng(7)
    for scale in (1, 30, 2**40):
        x = np.floor(rnd.normal(size=(500, 33)) * np.linspace(0.1, 3, 33) * 20 * scale)
        q = x[:40]
        scores = np.array([[sum(int(a) * int(b) for a, b in zip(u, v)) for v in x] for u in q], object)
        for share in (0.8, 0.3, -1.0, -np.inf):
            least = np.array([float(scores[i, i]) * share if np.isfinite(share) else share for i in range(len(q))])
            allowed = rnd.random((len(q), len(x))) < 0.7
            at, to, _ = hard_negatives.pairs_above(q, x, least, allowed.copy())
            held = {(int(a), int(b)) for a, b in zip(at, to)}
            clamp = 2**63 - 1
            assert held == {(i, j) for i in range(len(q)) for j in range(len(x)) if allowed[i, j] and max(-clamp, min(clamp, scores[i, j])) >= least[i]}


def test_hard_negative_cases(spark):
    bad = [
        (None, 1, [1.0, 2.0]), (1, None, [1.0, 2.0]), (2, 1, None), (3, 1, []), (4, 1, [1.0, None]), (5, 1, [float("nan"), 1.0]), (6, 1, [float("inf"), 1.0]),
        (7, 2, [50.0, 60.0, 70.0]),  # another length
    ]
    good = [(10, 1, [10.0, 0.0]), (11, 1, [10.0, 0.0]), (12, 2, [5.0, 0.0]), (13, 2, [5.0, 9.0]), (14, 2, [9.0, 1.0]), (15, 2, [10.0, 0.0]), (20, 2, [0.0, 0.0])]
    got = run(spark, bad + good)
    assert got == brute_negatives(good, lambda i: i % 10 == 0)
    assert (10, 11, 1, 14, 100, 90) in got and (10, 11, 2, 12, 100, 50) in got and (10, 11, 3, 13, 100, 50) in got
    assert run(spark, bad) == [] and run(spark, []) == []
    again = run(spark, good + [good[0]])  # a repeated anchor is one anchor, and none of its own positives
    assert again == brute_negatives(good + [good[0]], lambda i: i % 10 == 0)
    named = spark.createDataFrame([(*r, 1, 2, "x") for r in good], "vec_id long, label int, embedding array<float>, part int, anchor int, v string")
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives(named, F.col("vec_id") % 10 == 0).select(COLUMNS).collect()) == brute_negatives(good, lambda i: i % 10 == 0)


def test_op13_on_embeddings(spark, data):
    table = pq.read_table(f"{data}/embeddings.parquet").to_pylist()
    rows = [
        (r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], [float(np.floor(256 * np.float64(np.float32(x)))) for x in r["embedding"]])
        for r in table if r["label"] is not None and r["embedding"] is not None
    ]
    got = hard_negatives.op13_hard_negatives(spark, data)
    assert got.columns[:6] == COLUMNS
    assert sorted(tuple(r) for r in got.select(COLUMNS).collect()) == brute_negatives(rows, lambda i: i % 100 == 0)
