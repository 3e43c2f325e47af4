from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import merge as M
from tests.conftest import rows

T = "k string, part int, v int, stamp int"


def frame(spark, data, schema=T):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def target(spark):
    return frame(spark, [("a", 1, 10, 5), ("b", 1, 20, 5), ("c", 2, 30, 5), (None, 1, 40, 5)])


@pytest.fixture
def source(spark):
    return frame(spark, [("a", 1, 11, 6), ("b", 1, 21, 4), ("d", 1, 50, 6), (None, 1, 41, 6)])


@pytest.mark.parametrize("max_bytes", [0, 1 << 40])
def test_upsert_and_null_keys(target, source, max_bytes):
    got = rows(M.merge_upsert(target, source, ["k", "part"], max_bytes=max_bytes))
    want = [("a", 1, 11, 6), ("b", 1, 21, 4), ("c", 2, 30, 5), ("d", 1, 50, 6), (None, 1, 40, 5), (None, 1, 41, 6)]
    assert got == sorted(want, key=repr)


def test_newer_wins_keeps_the_later_row(target, source):
    got = {r["k"]: r["v"] for r in M.merge_newer(target, source, ["k", "part"], "stamp", ["v"]).collect() if r["k"]}
    assert got == {"a": 11, "b": 20, "c": 30, "d": 50}


def test_insert_only_is_idempotent(target, source):
    once = M.merge_insert_only(target, source.dropna(subset=["k"]), ["k", "part"])
    twice = M.merge_insert_only(once, source.dropna(subset=["k"]), ["k", "part"])
    assert rows(once) == rows(twice)


def test_duplicate_source_keys_are_refused(target, source):
    with pytest.raises(M.DuplicateSourceKeys):
        M.merge_upsert(target, source.union(source.limit(1)), ["k", "part"])
    M.assert_unique(source.filter("k IS NULL").union(source.filter("k IS NULL")), ["k"])  # null keys may repeat


def test_target_duplicates_are_all_updated(spark, source):
    target = frame(spark, [("a", 1, 1, 1)] * 3)
    got = M.merge(target, source, ["k", "part"], insert=False)
    assert rows(got, "k", "v") == [("a", 11)] * 3


def test_first_update_that_holds_applies(target, source):
    got = M.merge(
        target, source, {"k": "k"},
        updates=(M.Update({"v": "-s.v"}, "s.v > 20"), M.Update({"v": "s.v"})), insert=False,
    )
    assert {r["k"]: r["v"] for r in got.collect() if r["k"]} == {"a": 11, "b": -21, "c": 30}


def test_marks_tell_inserts_and_updates(target, source):
    got = M.merge_newer(target, source, ["k", "part"], "stamp", ["v"], mark_changes=True)
    marks = {r["k"]: r[M.CHANGE] for r in got.collect() if r["k"]}
    assert marks == {"a": "update", "b": None, "c": None, "d": "insert"}


def test_missing_source_columns_stay_or_become_null(spark, target):
    got = {r["k"]: r["stamp"] for r in M.merge_upsert(target, frame(spark, [("a", 9), ("z", 9)], "k string, v int"), ["k"]).collect()}
    assert got["a"] == 5 and got["z"] is None


def test_apply_marked(spark, target):
    changes = frame(spark, [("a", 1, 99, 9, "U"), ("n", 1, 1, 1, "I")], T + ", _op string")
    got = {r["k"]: r["v"] for r in M.apply_marked(target, changes, ["k"]).collect() if r["k"]}
    assert got == {"a": 99, "b": 20, "c": 30, "n": 1}
    with pytest.raises(Exception, match="row mark not allowed"):
        M.apply_marked(target, frame(spark, [("a", 1, 1, 1, "D")], T + ", _op string"), ["k"]).collect()


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    assert rows(M.delete_where(df, "v > 3")) == sorted([(1,), (None,)], key=repr)


def test_hash_diff_keeps_surrogates_and_sees_nulls(spark):
    from strata.functions.hashing import row_hash

    def hashed(data):
        df = spark.createDataFrame(data, "k string, a string, b string")
        return df.withColumns({"_keyHash": row_hash(["k"]), "_valueHash": row_hash(["a", "b"])})

    first = M.merge_hash_diff(hashed([]).select(F.lit(0).cast("long").alias("sid"), "*").limit(0), hashed([("x", "1", None), ("y", "ab", "c")]), order=["k"])
    assert rows(first, "sid", "k") == [(0, "x"), (1, "y")]
    second = M.merge_hash_diff(first, hashed([("x", "2", None), ("y", "a", "bc"), ("z", None, None)]), order=["k"])
    assert rows(second, "sid", "k", "a", "b") == sorted([(0, "x", "2", None), (1, "y", "a", "bc"), (2, "z", None, None)], key=repr)


def test_nested_columns_with_other_null_flags(spark):
    target = spark.sql("SELECT 'a' AS k, array('x') AS l, map('p', 'q') AS m")
    source = spark.createDataFrame([("a", ["y", None], {"p": None}), ("b", None, None)], "k string, l array<string>, m map<string,string>")
    got = rows(M.merge_upsert(target, source, ["k"]), "k", "l")
    assert got == [("a", ["y", None]), ("b", None)]


keys = st.lists(st.integers(0, 8), unique=True, max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys, keys, st.booleans())
def test_upsert_against_a_dictionary(spark, have, come, small):
    target = spark.createDataFrame([(k, f"t{k}") for k in have], "k int, v string")
    source = spark.createDataFrame([(k, f"s{k}") for k in come], "k int, v string")
    expected = {k: f"t{k}" for k in have} | {k: f"s{k}" for k in come}
    got = M.merge_upsert(target, source, ["k"], max_bytes=(1 << 40) if small else 0)
    assert rows(got) == sorted(expected.items(), key=repr)
    assert rows(M.merge_upsert(got, source, ["k"], max_bytes=0)) == rows(got)
