"""Streams whose schema grows, cut versions, signed counts, stored sketches and typed slices."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import sinks
from strata.operators import aggregates as A
from strata.operators import joins as J
from strata.sources import load_schema, seen_schema, widened
from strata.streaming import UnknownField, ingest_evolving, read_evolving
from tests.conftest import rows


def land(spark, folder, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)


def test_seen_and_widened_schema(spark):
    lines = spark.createDataFrame([('{"a": 1, "b": {"c d": [1.5, 2]}, "n": null, "e": {}}',), ('{"a": "x", "b": {"f": true}, "q": [{"z": 1}]}',), ("no json",), ("[1]",), (None,)], "value string")
    assert seen_schema(lines.filter("value LIKE '{%'")).simpleString() == "struct<a:string,b:struct<c d:array<double>,f:boolean>,q:array<struct<z:bigint>>>"
    assert seen_schema(lines.filter("value = 'no json'")) == StructType() == seen_schema(lines.limit(0))
    known = StructType.fromDDL("a long, b struct<f: string>, q array<struct<y: int>>")
    got = widened(known, StructType.fromDDL("A string, b struct<f: boolean, g: int>, q array<struct<z: bigint>>, new date"))
    assert got == StructType.fromDDL("a long, b struct<f: string, g: int>, q array<struct<y: int, z: bigint>>, new date")


def test_stream_stops_widens_and_goes_on(spark, tmp_path):
    at = {n: f"{tmp_path}/{n}" for n in ("landing", "bronze", "checkpoint", "schema")}
    run = lambda **kw: ingest_evolving(spark, at["landing"], at["bronze"], at["checkpoint"], at["schema"], "r", **{"max_files": 1, **kw})
    land(spark, at["landing"], '{"id": 1, "x": {"a": 1}}', "broken")
    assert run(start=StructType.fromDDL("id long, x struct<a: long>")) == 0
    land(spark, at["landing"], '{"id": 2, "x": {"a": 2, "b": "new"}, "y": 2.5}', '{"id": "odd", "x": {"a": 3}}')
    assert run() == 1 and run() == 0
    got = read_evolving(spark, at["bronze"], at["schema"])
    assert rows(got, "id", "x.a", "x.b", "y") == sorted([(1, 1, None, None), (2, 2, "new", 2.5), (None, 3, None, None), (None, None, None, None)], key=repr)
    assert got.filter("_rescued_data IS NOT NULL").count() == 2 and got.filter("_input_filename IS NULL OR _pipeline_run_id <> 'r'").count() == 0
    land(spark, at["landing"], '{"id": 4, "z": 1}')
    before = load_schema(spark, at["schema"])
    with pytest.raises(UnknownField):
        run(mode="fail")
    assert load_schema(spark, at["schema"]) == before and read_evolving(spark, at["bronze"], at["schema"]).count() == 4
    assert run(mode="rescue") == 0
    kept = read_evolving(spark, at["bronze"], at["schema"]).filter("id = 4").first()
    assert kept._rescued_data == '{"z":"1"}' and load_schema(spark, at["schema"]) == before
    with pytest.raises(ValueError):
        run(mode="other")


@pytest.mark.parametrize("kind", ["int", "date"])
def test_versions_of_any_shape_give_one_match(spark, kind):
    rnd = random.Random(3)
    point = (lambda n: n) if kind == "int" else (lambda n: dt.date(2020, 1, 1) + dt.timedelta(n))
    dim, fact = [], []
    for key in range(40):
        for i in range(rnd.randint(0, 7)):
            a = rnd.randrange(12)
            b = None if rnd.random() < 0.2 else a + rnd.randint(-1, 6)
            dim.append((key, point(a), None if b is None else point(b), key * 100 + i))
        fact += [(key, point(d)) for d in range(-1, 20)]
    dim += [(None, point(1), point(5), -1), (3, None, point(5), -2)]
    fact += [(None, point(2)), (3, None), (77, point(3))]
    versions = spark.createDataFrame(dim, f"k int, a {kind}, b {kind}, sk int").repartition(3)
    got = J.lookup_as_of(spark.createDataFrame(fact, f"key int, day {kind}"), versions, fact_key="key", fact_date="day", dim_key="k", effective="a", expiry="b", take={"sk": "sk"})
    want = []
    for key, day in fact:
        holds = [(a, sk) for k, a, b, sk in dim if k is not None and k == key and day is not None and a is not None and a <= day and (b is None or day <= b)]
        want.append((key, day, max(holds)[1] if holds else None))
    assert rows(got, "key", "day", "sk") == sorted(want, key=repr)


def test_multiset_difference(spark):
    rnd = random.Random(1)
    pick = lambda n: [(rnd.choice(["a", "b", None]), rnd.choice([1.0, float("nan"), None])) for _ in range(n)]
    left, right = pick(500) + [("hot", 0.0)] * 300, pick(200) + [("hot", -0.0)] * 7 + [("right", 1.0)]
    schema = "`a.b` string, _n double"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    want = Counter(map(repr, left))
    want.subtract(repr((x, abs(y) if y == 0 else y)) for x, y in right)
    for size in (1, 64, 1 << 20):
        got = Counter(repr(tuple(r)) for r in A.multiset_difference(a, b, size).collect())
        assert got == Counter({k: n for k, n in want.items() if n > 0})
    assert A.multiset_difference(a.limit(0), b).count() == 0


def test_sketches_of_slices(spark, tmp_path):
    values = spark.range(100_000).select((F.col("id") % 4).alias("s"), F.col("id").cast("double").alias("v"))
    A.write_quantile_sketches(values, "v", ["s"], f"{tmp_path}/k")
    A.write_quantile_sketches(values.filter("s = 2"), "v", ["s"], f"{tmp_path}/k")
    stored = spark.read.parquet(f"{tmp_path}/k")
    r = A.sketch_bounds(stored, 0.1, 0.9).first()
    assert r.rows == 99_999 and abs(r.low - 10_000) < 150 and abs(r.high - 90_000) < 150
    assert A.sketch_bounds(stored.filter("s = 1"), 0.1, 0.9).first().rows == 25_000


def test_slices_are_found_by_value_and_emptied_after_the_write(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame = lambda *r: spark.createDataFrame(r, "at timestamp_ntz, part string, v int")
    one, two = dt.datetime(2022, 2, 1, 10), dt.datetime(2022, 2, 1, 11, 30)
    sinks.replace_slice(frame((one, "a b", 1), (one, "c:d/e", 2), (two, "a b", 3), (two, None, 4)), path, ["at", "part"])
    sinks.replace_slice(frame(), path, ["at", "part"], slices=[("2022-02-01 10:00", "c:d/e"), (two, None), ("2022-02-01 10:00:00", "absent")])
    assert rows(spark.read.parquet(path), "v") == [(1,), (3,)]
    sinks.replace_slice(frame((one, "a b", 9)), path, ["at", "part"], slices=[(one, "a b")])
    assert rows(spark.read.parquet(path), "v") == [(3,), (9,)]
    broken = frame((one, "a b", 0)).withColumn("v", F.raise_error(F.lit("no rows")).cast("int"))
    with pytest.raises(Exception, match="no rows"):
        sinks.replace_slice(broken, path, ["at", "part"], slices=[(two, "a b")])
    assert rows(spark.read.parquet(path), "v") == [(3,), (9,)]
    with pytest.raises(ValueError):
        sinks.replace_slice(frame(), path, ["at", "part"], slices=[("x",)])
