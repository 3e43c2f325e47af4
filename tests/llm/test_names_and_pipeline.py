"""Columns with clashing names, hosts, license spans, and the corpus pipeline against a brute-force version."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import byte_bpe, exact_dedup, language_id, license_scan, url_lists

NAMES = ["d", "h", "s", "n", "n_top", "ids", "block", "bytes", "_language", "own", "top", "size", "i2", "d2", "keep_id", "kept", "host", "_d", "_i"]


@pytest.fixture(scope="module")
def crowded(spark):
    rows = [(1, "Ein Text für alle", "de"), (2, "ein text für alle", "de"), (3, None, None), (3, None, None), (None, "x", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(NAMES)])


def test_exact_dedup_with_any_names(crowded):
    got = exact_dedup.exact_dedup(crowded)
    assert set(crowded.columns) < set(got.columns) and len(got.columns) == len(crowded.columns) + 4
    assert sorted((r.doc_id, r._keep_id, r._kept) for r in got.where("doc_id < 3").collect()) == [(1, 2, False), (2, 2, True)]
    assert got.count() == 5 and got.where("d <> 0").count() == 0


def test_bpe_with_any_names(crowded):
    got = byte_bpe.encode(crowded, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded="decoded")
    rows = got.collect()
    assert all(r.ids == 5 and (bytes(r.decoded).decode() == (r.text or "")) for r in rows)
    assert [len(r._ids) // 4 > 0 for r in rows] == [bool(r.text) for r in rows]


def test_language_with_any_names(crowded):
    model = language_id.fit(crowded)
    rows = language_id.predict(crowded, model).collect()
    assert all(r._language == NAMES.index("_language") and r["__language"].lang_pred for r in rows)


def test_url_filter_with_any_names(spark, crowded):
    changes = spark.createDataFrame([("bad", "domain", "bad.org", "add", "2024-01-01")], "list string, kind string, value string, action string, day string").withColumn("day", F.to_date("day"))
    urls = crowded.select("*", F.when(F.col("doc_id") == 1, "http://bad.org/x").alias("url"), F.lit("2024-05-05").cast("date").alias("fetched_on"))
    got = url_lists.filter_urls(urls, changes).collect()
    assert len(got) == 5 and [r.doc_id for r in got if r.blocked] == [1] and all(r.d == 0 and r.host == NAMES.index("host") for r in got)


@pytest.mark.parametrize("url, host, section", [
    ("http://user@bad.org/x/y", "bad.org", "x"), ("https://user:pw@bad.org/", "bad.org", ""), ("http://bad.org./x", "bad.org", "x"), ("HTTP://Bad.ORG:8080?q", "bad.org", ""),
    ("http://[2001:db8::1]:80/a", "[2001:db8::1]", "a"), ("http://a@b@bad.org/", "bad.org", ""), ("http:\\\\bad.org\\x", "bad.org", "x"), (" http://bad.org#f", "bad.org", ""),
    ("http://bad.org:80x/a", "bad.org", "a"), ("bad.org/x", None, ""), ("http:///x", None, ""), ("", None, ""), (None, None, ""), ("http://@/", None, ""), ("ftp://x.y", "x.y", ""),
])
def test_hosts(spark, url, host, section):
    import duckdb

    r = spark.createDataFrame([(url,)], "url string").select(url_lists.host_of("url").alias("h"), url_lists.segment_of("url").alias("s")).first()
    assert (r.h, r.s) == (host, section)
    sql = f"SELECT nullif(regexp_extract(lower(trim(u)), '{url_lists.HOST}', 1), ''), coalesce(regexp_extract(lower(trim(u)), '{url_lists.SEGMENT}', 1), '') FROM (SELECT CAST(? AS VARCHAR) AS u)"
    assert duckdb.execute(sql, [url]).fetchone() == (host, section)


def test_license_spans_are_verified(spark):
    texts = [
        (1, "released under the released under the released under the"), (2, "under the mit under the mit under the mit"), (3, "it is released under the MIT license."),
        (4, "this work is licensed under a creative commons attribution 4 0 license"), (5, "license mit the under released"), (6, None), (None, "All rights reserved"),
        (7, "permission is hereby granted, free of charge, to any other person obtaining a copy of this software and associated documentation files"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan.license_scan(docs).collect()}
    assert got == {1: "", 2: "", 3: "mit", 4: "cc-by", 5: "", 6: "", 7: "mit", None: "reserved"}
    _, spans = license_scan.scan(docs, [w for _, w in license_scan.NOTICES], max_grams=1)  # joined, not broadcast
    assert spans.where("whole").count() == 1
    rnd = random.Random(2)
    for _ in range(200):
        hits = [(rnd.randrange(9), rnd.randrange(6)) for _ in range(rnd.randint(0, 9))]
        best = 0
        for mask in range(1 << len(hits)):
            chosen = sorted(hits[i] for i in range(len(hits)) if mask >> i & 1)
            if all(a[0] < b[0] and a[1] < b[1] for a, b in zip(chosen, chosen[1:])):
                best = max(best, len(chosen))
        assert license_scan.longest_ascent(hits) == best


def test_base_phrases_on_documents(spark):
    import re

    folder = "/root/testdata/sf0.01"
    want = {}
    for doc in pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), doc["text"] or ""))
        found = [(i, label) for phrase, label in license_scan.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        places = sorted(i for i, _ in found)
        want[doc["doc_id"]] = (len(words), len(found), places[0] if places else None, places[-1] if places else None, ",".join(sorted({n for _, n in found})))
    got = license_scan.op8_license_scan(spark, folder).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


# ------------------------------------------------------------------- pipeline


def _words(rnd, syllables, n):
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def _lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    en = ["the", "an", "er", "ing", "tion", "ou", "th", "wh", "ent"]
    de = ["sch", "ung", "keit", "ich", "ä", "ver", "ge", "ß", "pf"]
    texts = [(_words(rnd, en if i % 2 else de, rnd.randint(80, 200)), "en" if i % 2 else "de") for i in range(60)]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts)]
    rows += [(100, texts[3][0].upper(), "en"), (101, texts[3][0], "en"), (101, texts[3][0], "en")]  # equal but for A-Z, and a repeated row
    chain = texts[5][0].split()
    for k in range(1, 4):  # a chain of near copies: each near the one before
        chain = chain[:]
        chain[k * 20] = f"changed{k}"
        rows.append((110 + k, " ".join(chain), "en"))
    passage = _words(rnd, en, 60)
    rows += [(120, texts[7][0] + " " + passage + " " + _words(rnd, en, 90), "en"), (121, _words(rnd, en, 90) + " " + passage, "en")]
    rows += [(130, "漢字 漢字 漢字 漢字 漢字", "zh"), (131, None, "en"), (132, "", "en"), (133, "12345 67890", "en"), (None, _words(rnd, de, 50), None)]
    return [(i, t, lang, "s", None if t is None else len(t), "extra") for i, t, lang in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, d string"


def test_pipeline_stages(spark, corpus):
    docs = spark.createDataFrame(corpus, SCHEMA)
    by_name = dict(corpus_pipeline.STAGES)
    known = by_name["language ID"](spark, docs, "").collect()
    assert {r.doc_id for r in known} >= set(range(60)) and not {131, 132, 133} & {r.doc_id for r in known}

    rows = [tuple(r) for r in known]
    kept = [tuple(r) for r in by_name["exact dedup"](spark, spark.createDataFrame(rows, SCHEMA), "").collect()]
    best = {}
    for r in rows:
        key = _lowered(r[1])
        best[key] = max(best.get(key, -1), -1 if r[0] is None else r[0])
    assert sorted(-1 if r[0] is None else r[0] for r in kept) == sorted(best.values())

    near = [tuple(r) for r in by_name["MinHash near-dedup"](spark, spark.createDataFrame(kept, SCHEMA), "").collect()]
    assert sorted(map(repr, near)) == sorted(repr(r) for r in kept if r[0] not in (111, 112, 113))

    cut = [tuple(r) for r in by_name["suffix-array dedup"](spark, spark.createDataFrame(near, SCHEMA), "").collect()]
    raw = [r[1].encode() for r in near]
    seen = {}
    for t in raw:
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] = seen.get(t[i : i + 200], 0) + 1
    want = []
    for r, t in zip(near, raw):
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        starts = [i for i in range(len(t) + 1) if i == len(t) or t[i] & 0xC0 != 0x80]
        text = b"".join(t[a:b] for a, b in zip(starts, starts[1:]) if not all(gone[a:b])).decode()
        want.append((r[0], text, *r[2:4], len(text), r[5]))
    assert sorted(map(repr, cut)) == sorted(map(repr, want))
    assert any(len(a[1]) != len(b[1]) for a, b in zip(sorted(near, key=repr), sorted(want, key=repr)))

    pieces = by_name["best-fit packing"](spark, spark.createDataFrame(cut, SCHEMA), "").collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    sizes = {repr(r[0]): len(tokenizer.encode(r[1], add_special_tokens=False).ids) + 1 for r in cut}
    packed = {}
    for p in pieces:
        packed.setdefault(p.sequence_id, []).append((p.offset, p.length))
        sizes[repr(p.doc_id)] -= p.length
    assert not any(sizes.values())
    total = 0
    for places in packed.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(n for _, n in places) <= 4096
        total += sum(n for _, n in places)
    assert len(packed) == -(-total // 4096)


def test_whole_pipeline(spark, corpus, tmp_path):
    spark.createDataFrame(corpus, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    ids = [r.doc_id for r in got.collect()]
    assert {0, 1, 2, 4, 5, 101, 120, 121, None} <= set(ids) and not {3, 100, 111, 112, 113, 131, 132, 133} & set(ids)
    assert ids.count(101) == 1
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
