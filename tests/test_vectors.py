from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import vectors as V
from strata.sources import tables
from tests.conftest import rows


@pytest.fixture(scope="module")
def embeddings(spark, data):
    return tables(spark, data, "embeddings")[0]


@pytest.fixture(scope="module")
def brute(embeddings):
    found = embeddings.orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in found])
    m = np.array([r["embedding"] for r in found], dtype="float64")
    m /= np.linalg.norm(m, axis=1, keepdims=True)

    def top(query, k, keep=None):
        q = np.array(query, dtype="float64")
        s = np.round(m @ (q / np.linalg.norm(q)), 9)
        order = [i for i in np.lexsort((ids, -s)) if keep is None or keep(found[i])]
        return [int(ids[i]) for i in order[:k]]

    return found, top


def test_top_k_equals_brute_force(embeddings, brute):
    found, top = brute
    query = list(found[3]["embedding"])
    assert [r["vec_id"] for r in V.similar(embeddings, query, 15, "vec_id", "embedding").collect()] == top(query, 15)
    kept = V.similar(embeddings, query, 15, "vec_id", "embedding", where=F.col("label") != 2)
    assert [r["vec_id"] for r in kept.collect()] == top(query, 15, lambda r: r["label"] != 2)


def test_missing_and_ragged_vectors_are_left_out(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 0.0]), (5, [2.0, 0.0])], "id int, v array<double>")
    assert rows(V.similar(df, [1.0, 0.0], 9, "id", "v")) == [(1, 1.0), (4, 0.0), (5, 1.0)]


def test_ties_are_broken_by_id_over_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(100).select("id", F.array(F.lit(1.0), F.lit(0.0)).alias("v")).repartition(3)
        assert [r["id"] for r in V.similar(df, [1.0, 0.0], 5, "id", "v").collect()] == [0, 1, 2, 3, 4]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("block", [1024, 3])
def test_many_queries_in_blocks(embeddings, brute, monkeypatch, block):
    monkeypatch.setattr(V, "QUERY_BLOCK", block)
    found, top = brute
    queries = embeddings.filter("vec_id < 8")
    got = V.similar_join(queries, embeddings, 4, query_id="vec_id", query_vec="embedding", id_col="vec_id", vec_col="embedding")
    lists = {}
    for r in got.orderBy("query_id", "rank").collect():
        lists.setdefault(int(r["query_id"]), []).append(r["vec_id"])
    assert lists == {r["vec_id"]: top(r["embedding"], 4) for r in found if r["vec_id"] < 8}


def test_no_queries(embeddings):
    got = V.similar_join(embeddings.limit(0), embeddings, 4, query_id="vec_id", query_vec="embedding", id_col="vec_id", vec_col="embedding")
    assert got.count() == 0


def test_embedding_and_error_columns(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, " "), (3, None)], "id int, t string")
    got = {r["id"]: (r["embedding"], r["embedding_error"]) for r in V.embed(df, "t").collect()}
    assert got[1][1] is None and np.linalg.norm(got[1][0]) == pytest.approx(1.0)
    assert got[2] == (None, "empty text") and got[3] == (None, "empty text")


def test_hybrid_equals_its_definition(spark, data):
    (documents,) = tables(spark, data, "documents")
    rows_ = V.embed(documents, "text").select("doc_id", "text", "embedding").collect()
    query = rows_[5]
    words = set(query["text"].lower().split())
    overlap = {r["doc_id"]: len(words & set(r["text"].strip().lower().split())) for r in rows_}
    vec = {r["doc_id"]: round(float(np.dot(np.float64(r["embedding"]), np.float64(query["embedding"]))), 6) for r in rows_ if r["embedding"]}
    k = 10
    by_text = sorted((d for d in overlap if overlap[d] > 0), key=lambda d: (-overlap[d], d))[:k]
    by_vec = sorted(vec, key=lambda d: (-vec[d], d))[:k]
    fused = {}
    for ranked in (by_text, by_vec):
        for i, doc in enumerate(ranked, 1):
            fused[doc] = fused.get(doc, 0) + 1 / (60 + i)
    got = V.hybrid(V.embed(documents, "text"), query["text"], list(query["embedding"]), k, id_col="doc_id", text_col="text", vec_col="embedding").collect()
    assert got[0]["doc_id"] == query["doc_id"]
    assert len({r["doc_id"] for r in got} & set(fused)) >= k - 1
    assert got[0]["fused_score"] == pytest.approx(max(fused.values()))


def test_hybrid_ranks_whole_lists(spark):
    """A document beyond the first k of one list keeps what that list gives it."""
    n, k = 42, 5
    docs = [(i, "red" if 0 < i < n - 1 else "blue red" if i == n - 1 else "red sky", [1.0, 0.1 * i]) for i in range(n)] + [(n, "green", None)]
    words = {d: len({"blue", "red"} & set(t.split())) for d, t, _ in docs}
    cosine = {d: round(v[0] / float(np.hypot(*v)), 6) for d, _, v in docs if v}
    lists = [sorted((d for d in words if words[d]), key=lambda d: (-words[d], d)), sorted(cosine, key=lambda d: (-cosine[d], d))]
    fused = {}
    for ranked in lists:
        for i, d in enumerate(ranked, 1):
            fused[d] = fused.get(d, 0) + 1 / (60 + i)
    df = spark.createDataFrame(docs, "id int, t string, v array<double>")
    got = V.hybrid(df, "blue red", [1.0, 0.0], k, id_col="id", text_col="t", vec_col="v").collect()
    want = sorted(fused, key=lambda d: (-round(fused[d], 12), d))[:k]
    assert [r["id"] for r in got] == want and [r["fused_score"] for r in got] == pytest.approx([fused[d] for d in want])


def test_approximate_neighbours_have_recall(embeddings, brute):
    found, top = brute
    hits = total = 0
    for i in (0, 7, 42, 99):
        query = list(found[i]["embedding"])
        near = {r["vec_id"] for r in V.ann(embeddings, query, 10, id_col="vec_id", vec_col="embedding", bucket=2.0, tables=12).collect()}
        hits, total = hits + len(near & set(top(query, 10))), total + 10
    assert hits / total >= 0.7


def test_sync_embeds_only_changed_rows(spark):
    def counting(df, text, out):
        return V.hashing_tf(df, text, out).withColumn(out, F.when(F.col(text) != "same", F.col(out)))

    empty = spark.createDataFrame([], "id int, content_hash string, embedding array<float>, embedding_error string")
    first = V.sync_embeddings(empty, spark.createDataFrame([(1, "same"), (2, "old")], "id int, t string"), id_col="id", text_col="t")
    second = V.sync_embeddings(first, spark.createDataFrame([(1, "same"), (2, "new"), (3, "add")], "id int, t string"),
                               id_col="id", text_col="t", fn=counting, mark_changes=True)
    got = {r["id"]: (r["embedding"] is not None, r["_change_type"]) for r in second.collect()}
    assert got == {1: (True, None), 2: (True, "update"), 3: (True, "insert")}


def test_join_of_blocks(spark):
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(30, 6))
    vectors = [(i, base[int(rnd.integers(0, 30))].tolist()) for i in range(400)]  # many ties
    vectors += [(1000, None), (1001, []), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1003, [float("nan")] * 6), (1004, [1.0, 2.0]), (1005, [2.0, 4.0])]
    df = spark.createDataFrame(vectors, "id int, v array<double>")
    whole = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors if v and len(v) == 6 and i < 1000}
    want = []
    for q in range(0, 400, 7):
        ranked = sorted(((-round(float(whole[q] @ v), 9), i) for i, v in whole.items()))[:5]
        want += [(str(q), i, rank) for rank, (_, i) in enumerate(ranked, 1)]
    asked = df.filter("id < 400 AND id % 7 = 0")
    for sizes in ({}, {"query_block": 10, "row_block": 50}):
        got = V.similar_join(asked, df, 5, query_id="id", query_vec="v", id_col="id", vec_col="v", **sizes)
        assert rows(got, "query_id", "id", "rank") == sorted(want, key=repr)
    other = V.similar_join(df.filter("id = 1004"), df, 5, query_id="id", query_vec="v", id_col="id", vec_col="v")
    assert rows(other, "id", "score") == [(1004, 1.0), (1005, 1.0)]


def test_fused_ranks_are_those_of_whole_lists(spark):
    rnd = np.random.default_rng(6)
    for kind, name in (("int", int), ("string", lambda i: f"d{i:04}")):
        lists = [[(name(int(i)), float(rnd.integers(0, 4 + 200 * n))) for i in rnd.permutation(900)[: 700 - 300 * n]] for n in range(2)]
        fused = {}
        for scored in lists:
            for rank, (i, _) in enumerate(sorted(scored, key=lambda r: (-r[1], r[0])), 1):
                fused[i] = fused.get(i, 0.0) + 1.0 / (60 + rank)
        want = sorted(fused.items(), key=lambda r: (-r[1], r[0]))[:7]
        frames = [spark.createDataFrame(scored, f"id {kind}, s double").repartition(5) for scored in lists]
        assert [tuple(r) for r in V.fuse_ranks(frames, 7, "id").collect()] == want
        assert V.fuse_ranks([f.limit(0) for f in frames], 7, "id").count() == 0
        assert [r.id for r in V.fuse_ranks([frames[0].limit(0), frames[1]], 2, "id").collect()] == [i for i, _ in sorted(lists[1], key=lambda r: (-r[1], r[0]))[:2]]


def test_postings_are_sorted_and_searched(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Red  sky red"), (2, "blue"), (3, None), (4, " "), (5, "sky blue sea")], "id int, t string")
    V.write_postings(docs, f"{tmp_path}/p", id_col="id", text_col="t")
    stored = spark.read.parquet(f"{tmp_path}/p")
    assert stored.count() == 6
    assert rows(V.search_postings(stored, "SKY blue blue", "id")) == [(1, 1), (2, 1), (5, 2)]


def test_index_of_inverted_lists(spark, embeddings, brute, tmp_path):
    found, top = brute
    V.VectorIndex.build(embeddings, f"{tmp_path}/i", id_col="vec_id", vec_col="embedding")
    index = V.VectorIndex(spark, f"{tmp_path}/i")
    assert index.vectors.count() == len(found) and index.centroids.agg(F.sum("rows")).first()[0] == len(found)
    for i in (0, 7, 42):
        query = list(found[i]["embedding"])
        assert [r.id for r in index.search(query, 10, exact=True).collect()] == top(query, 10)
        assert index.search(query, 10, probes=1).count() == 10  # lists are added until they hold ten rows
    many = index.search_many(embeddings.filter("vec_id % 20 = 0"), 10, query_id="vec_id", query_vec="embedding", id_col="vec_id")
    got = {}
    for r in many.collect():
        got.setdefault(int(r.query_id), set()).add(r.vec_id)
    hits = [len(got[r["vec_id"]] & set(top(list(r["embedding"]), 10))) / 10 for r in found if r["vec_id"] % 20 == 0]
    assert np.mean(hits) >= 0.95 and all(len(g) == 10 for g in got.values())


def test_index_of_copies_and_few_rows(spark, tmp_path):
    copies = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(50)] + [(99, [0.0, 1.0]), (100, [0.0, 0.0])], "id int, v array<double>")
    index = V.VectorIndex.build(copies, f"{tmp_path}/c", id_col="id", vec_col="v")
    assert [r.id for r in index.search([1.0, 0.0], 3, exact=True).collect()] == [0, 1, 2]
    assert {r.id for r in index.search([0.0, 1.0], 52, probes=1).collect()} == set(range(50)) | {99, 100}
    one = V.VectorIndex.build(copies.limit(1), f"{tmp_path}/o", id_col="id", vec_col="v")
    assert one.search([1.0, 1.0], 3).count() == 1


def test_few_pairs_are_looked_at_again(monkeypatch):
    rng = np.random.default_rng(3)
    queries, data = rng.normal(size=(64, 32)), rng.normal(size=(9000, 32))
    data[5000:] = data[7]  # copies tie, and the smaller row stays
    queries[0] = data[7]
    sizes, sort = [], np.lexsort
    monkeypatch.setattr(V.np, "lexsort", lambda keys: sizes.append(len(keys[0])) or sort(keys))
    at, to, score = V._best_rows(V._unit(queries), V._unit(data), 3)
    assert max(sizes) < len(queries) * 64
    exact = np.round(V._unit(queries) @ V._unit(data).T, V.SCORE_DIGITS)
    want = np.argsort(-exact, axis=1, kind="stable")[:, :3]
    assert to.reshape(-1, 3).tolist() == want.tolist() and score.tolist() == np.take_along_axis(exact, want, 1).ravel().tolist()


def test_rows_meet_centroids_in_slices():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(1000))], names=["q"])
    pieces = list(V._pieces(iter([batch, batch.slice(0, 0)])))
    assert max(p.num_rows for p in pieces) <= V.PROBE_ROWS and sum(p.num_rows for p in pieces) == 1000


def test_postings_have_more_ranges_for_more_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "POSTING_BYTES", 2000, raising=False)
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(200)], "id long, t string")
    docs.write.parquet(f"{tmp_path}/d")
    V.write_postings(spark.read.parquet(f"{tmp_path}/d"), f"{tmp_path}/p", id_col="id", text_col="t")
    stored = spark.read.parquet(f"{tmp_path}/p")
    assert len(stored.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions")) and stored.count() == 8000
