"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from strata.llm import byte_bpe, embedding_dedup, exact_dedup, language_id, license_scan, lm_scoring, minhash_dedup, packing, suffix_dedup, url_lists

PASSAGE = " ".join(f"word{i}" for i in range(60))
DOCS = [
    (1, "The cat sat on the mat and looked at the moon all night", "en", "x"), (2, "THE CAT sat on the mat and looked at the moon all night", "en", "x"),
    (3, None, "en", "x"), (4, "", None, "x"), (5, "12 345 !!", "en", "x"), (6, "Der Hund und die Katze schlafen in der Nacht", "de", "x"),
    (7, "alpha " + PASSAGE + " omega", "en", "x"), (8, "beta " + PASSAGE + " psi", "en", "x"), (9, "a" * 900, "en", "x"),
    (10, "Licensed under CC BY-NC 4.0. All rights reserved.", "en", "x"), (10, "Licensed under CC BY-NC 4.0. All rights reserved.", "en", "x"),
    (11, "Übung macht den Meister 漢字 😀 " * 300, "de", None), (None, "no id here", "en", "x"),
]
SCHEMA = "doc_id long, text string, lang string, kept string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return [(i, (t or "").encode()) for i, t, _, _ in DOCS]


def test_exact_dedup(docs, empty):
    rows = exact_dedup.exact_dedup(docs).collect()
    assert len(rows) == len(DOCS) and exact_dedup.exact_dedup(empty).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.keep_id, r.group_size, r._kept))
    assert by[1] == [(2, 2, False)] and by[2] == [(2, 2, True)]
    assert by[3] == [(4, 2, False)] and by[4] == [(4, 2, True)] and by[None] == [(None, 1, True)]
    assert sorted(by[10]) == [(10, 2, False), (10, 2, True)]
    small = exact_dedup.exact_dedup(docs, max_slots=exact_dedup.SEGMENT_SLOTS).collect()
    assert sorted(map(repr, small)) == sorted(map(repr, rows))


def brute_spans(all_bytes, length=200):
    seen = {}
    for b in all_bytes:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in all_bytes:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_suffix_dedup(docs, empty):
    rows = suffix_dedup.remove_repeats(docs, carry=["doc_id", "kept"]).collect()
    want = sorted(zip((repr(i) for i, _ in texts()), brute_spans([b for _, b in texts()])))
    assert sorted((repr(r.doc_id), hashlib.sha256(r._kept).hexdigest()) for r in rows) == want
    assert suffix_dedup.remove_repeats(empty).count() == 0
    for r in suffix_dedup.remove_repeats(docs, whole_characters=True).collect():
        bytes(r.kept).decode()


def test_suffix_array():
    rng = random.Random(5)
    for _ in range(400):
        s = [rng.randint(1, rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_busy_anchors_count_windows(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_CHUNKS", 1)
    rows = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((repr(r.doc_id), hashlib.sha256(r.kept).hexdigest()) for r in rows) == sorted(zip((repr(i) for i, _ in texts()), brute_spans([b for _, b in texts()])))


def test_language_id(docs, empty):
    model = language_id.fit(docs)
    by = {r.doc_id: r._language for r in language_id.predict(docs, model).collect()}
    assert by[6].lang_pred == "de" and by[1].lang_pred == "en"
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (3, 4, 5))
    nothing = language_id.fit(empty)
    assert {r._language.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}


def test_byte_bpe(docs, empty):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    rows = byte_bpe.encode(docs, path, public_tokenizers.PATTERN, offsets="starts", decoded="back").collect()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == plain.encode_ordinary(r.text or "") and bytes(r.back).decode() == (r.text or "")
        assert len(r.starts) == len(r.ids)
    cache, rng = byte_bpe.chunk_cache(path, public_tokenizers.PATTERN), random.Random(3)
    for _ in range(2000):
        t = "".join(rng.choice("  \n\t\x1c\x85'sllaab1,.é漢😀　") for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(cache.ids([byte_bpe.split_chunks(t)])[0], "<u4").tolist() == plain.encode_ordinary(t)
    assert byte_bpe.encode(empty, path, public_tokenizers.PATTERN).count() == 0


def test_minhash(spark, empty):
    base = [f"w{i}" for i in range(200)]
    near = base[:150] + ["other"] + base[151:]
    far = [f"v{i}" for i in range(200)]
    rows = [(5, " ".join(base)), (7, " ".join(near)), (8, " ".join(far)), (9, None), (3, ""), (6, " ".join(base)), (6, " ".join(base)), (None, "one two")]
    got = {r.doc_id: (r.class_id, r.kept) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {5: (5, True), 7: (5, False), 6: (5, False), 8: (8, True), 9: (9, True), 3: (3, True), None: (None, True)}
    assert minhash_dedup.near_duplicates(empty).count() == 0


def brute_near(texts, threshold=0.8):
    """Smallest number each text is linked with, over all pairs."""
    import math
    from collections import Counter

    bags = [Counter(zip(*[t.split()[i:] for i in range(5)])) for t in texts]
    df = Counter(s for bag in bags for s in bag)
    idf = {s: 1 - math.log((1 + 2 ** (round(8 * math.log2(n)) / 8)) / 2) / math.log((2 + len(texts)) / 2) for s, n in df.items()}
    bags = [{s: n * (1 + 0.2 * min(1, max(0, idf[s]))) for s, n in bag.items()} for bag in bags]
    label, total = list(range(len(bags))), [sum(bag.values()) for bag in bags]
    for x in range(len(bags)):
        for y in range(x):
            low = sum(min(w, bags[y][s]) for s, w in bags[x].items() if s in bags[y])
            if label[x] != label[y] and low / (total[x] + total[y] - low) >= threshold:
                old, new = max(label[x], label[y]), min(label[x], label[y])
                label = [new if c == old else c for c in label]
    return label


def family(n, least, most, words=200, seed=5):
    """Texts that each change some words of an earlier one, so that near and less near copies share bands."""
    rng = np.random.default_rng(seed)
    out = [[f"w{i}" for i in range(words)]]
    while len(out) < n:
        text = list(out[rng.integers(len(out))])
        for i in rng.choice(words, rng.integers(least, most + 1), replace=False):
            text[i] = f"x{rng.integers(1 << 40)}"
        out.append(text)
    return [" ".join(t) for t in out]


def test_minhash_tests_every_candidate(spark, monkeypatch):
    texts = family(400, 3, 6)
    want = brute_near(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rows in (256, 32):
        monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", rows)
        got = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(df).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_minhash_of_a_line_repeated_very_often(spark):
    line = "one two three four five six seven\n" * 60000
    rows = [(1, line + "the first end of it all"), (2, line + "another end"), (3, " ".join(f"w{i}" for i in range(50)))]
    got = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_url_lists(spark):
    changes = spark.sql("""SELECT * FROM VALUES ('l', 'domain', 'bad.org', 'add', DATE'2024-01-05'), ('l', 'domain', 'bad.org', 'add', DATE'2024-01-05'),
      ('l', 'domain', 'bad.org', 'remove', DATE'2024-02-01'), ('m', 'host', 'a.b.com', 'add', DATE'2024-01-01'), ('m', 'path', 'c.com/x', 'add', DATE'2024-01-01'),
      ('n', 'host', 'z.com', 'add', DATE'2024-01-01'), ('n', 'host', 'z.com', 'remove', DATE'2024-01-01') t(list, kind, value, action, day)""")
    captures = spark.createDataFrame(
        [(1, "http://www.bad.org/x", "2024-01-10", 1), (2, "http://bad.org", "2024-02-01", 1), (3, "https://A.b.com:80/q", "2024-03-01", 1), (4, "https://c.com/x/y", "2024-03-01", 1),
         (5, None, "2024-03-01", 1), (6, "junk", "2024-03-01", 1), (7, "http://notbad.org/", "2024-01-10", 1), (8, "http://z.com", "2024-01-02", 1), (1, "http://www.bad.org/x", "2024-01-10", 1), (9, "http://bad.org", None, 1)],
        "page_id long, url string, f string, host int").selectExpr("page_id", "url", "CAST(f AS DATE) AS fetched_on", "host")
    got = sorted((r.page_id, r.lists) for r in url_lists.filter_urls(captures, changes).collect())
    assert got == [(1, "l"), (1, "l"), (2, ""), (3, "m"), (4, "m"), (5, ""), (6, ""), (7, ""), (8, ""), (9, "")]
    assert url_lists.filter_urls(captures.limit(0), changes).count() == 0


def test_license_scan(docs, empty):
    rows = license_scan.license_scan(docs).collect()
    assert len(rows) == len(DOCS) and license_scan.license_scan(empty).count() == 0
    got = {r.doc_id: r for r in rows}
    assert (got[10].n_words, got[10].n_base, got[10].first_word, got[10].last_word, got[10].base_labels, got[10].labels) == (10, 2, 2, 7, "cc-by,reserved", "cc-by,cc-by-nc,reserved")
    assert got[3].n_words == 0 and got[3].first_word is None and got[3].labels == ""


def test_lm_scoring(docs, empty):
    import math
    from collections import Counter

    frame = docs.selectExpr("doc_id", "text", "doc_id % 2 = 1 AS train")
    known = Counter(w for i, b in texts() if i is not None and i % 2 == 1 for w in [*b.lower().split(), None])
    n, v = sum(known.values()), len(known)
    rows = lm_scoring.score_texts(frame, "train").collect()
    want = {i: sum(math.log10((known[w] + 1) / (n + v + 1)) for w in [*b.lower().split(), None]) for i, b in texts()}
    for r in rows:
        assert r.base_score == pytest.approx(want[r.doc_id]) and r.train_tokens == n and r.score <= 0
    parts = lm_scoring.score_texts(frame, "train", round_bytes=1).collect()
    assert sorted((repr(r.doc_id), round(r.score, 6)) for r in parts) == sorted((repr(r.doc_id), round(r.score, 6)) for r in rows)
    assert lm_scoring.score_texts(empty.selectExpr("doc_id", "text", "true AS train"), "train").count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, 16))
    rows = [(i, [float(v) for v in x[i % 30] * (1 + i // 30)], i % 2) for i in range(40)]
    rows += [(100, None, 0), (101, [0.0] * 16, 0), (102, [float("nan")] + [1.0] * 15, 0), (103, rows[0][1], None), (104, [None] + [1.0] * 15, 0), (105, [1.0, 2.0], 0)]
    got = {r.vec_id: r for r in embedding_dedup.near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    for i in range(10):
        assert (got[i].n_links, got[i + 30].component_id, got[i + 30].kept) == (1, i, False)
    assert all(got[i].n_links == 0 and got[i].kept for i in (100, 101, 102, 103, 104, 105, 15))
    assert embedding_dedup.near_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.best_fit_packing(docs, path, capacity=64, keep_ids=True).collect()
    bins = {}
    for r in rows:
        assert r.length == len(r.ids) // 4 <= 64 and r.ids_crc32 == zlib.crc32(r.ids)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.best_fit_packing(empty, path).count() == 0


def test_chunks_keep_their_ids_among_others():
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), random.Random(11)
    signs = "aAbzZÉÀéİıßſĿŉÅJ'.,!~1½<|>_-\u0301\u030c \n\t漢😀"
    part = ["", "<|endoftext|> a<|endoftext|>b", "a\u0301b", "İx İ-- Istanbul", "ß's DON'T 's", "\t", "漢字 😀", "a~b ~ x~", "J\u030c j\u030c", "One, two,*** (three).\n\n FOUR", "x" * 3000,
            *("".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(6000))]
    alone = [tokenizer.encode(c, add_special_tokens=False).ids for c in part]
    known = packing.ChunkIds(tokenizer, most=2000)  # starts anew between the calls
    for at in range(0, len(part), 1500):
        ids, edge = known.ids(pa.array(part[at : at + 1500]))
        assert [ids[x:y].tolist() for x, y in zip(edge, edge[1:])] == alone[at : at + 1500]
    ids, edge = known.ids(pa.array([], pa.string()))
    assert (len(ids), edge.tolist()) == (0, [0])


def test_packing_is_optimal_on_small_cases():
    def fewest(sizes, capacity):
        best = len(sizes)

        def put(i, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if i == len(sizes):
                best = len(bins)
                return
            for j in range(len(bins)):
                if bins[j] + sizes[i] <= capacity:
                    put(i + 1, [*bins[:j], bins[j] + sizes[i], *bins[j + 1 :]])
            put(i + 1, [*bins, sizes[i]])

        put(0, [])
        return best

    rng = random.Random(7)
    for _ in range(150):
        sizes = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 7))), reverse=True)
        fixed, rest = packing.reduce_by_dominance({s: sizes.count(s) for s in sizes}, 12)
        left = [s for s, n in rest.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + (fewest(left, 12) if left else 0) == fewest(sizes, 12)


def test_a_worker_that_grew_gives_back_at_once(monkeypatch):
    """The last group of a task ends soon after the one before it."""
    from strata.llm import common

    done = []
    monkeypatch.setattr(common.gc, "collect", lambda: done.append(1))
    monkeypatch.setattr(common, "_tidied", common.time.monotonic() + 60)
    monkeypatch.setattr(common, "_held", 0, raising=False)
    common.give_back()
    assert done == [1]
    monkeypatch.setattr(common, "_tidied", common.time.monotonic() + 60)
    monkeypatch.setattr(common, "_held", 1 << 60, raising=False)
    common.give_back()
    assert done == [1]
