from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import storage
from strata.operators.merge import merge_upsert
from strata.plans.reviews import BUSINESS_SCHEMA, REVIEW_SCHEMA, REVIEW_RULES, USER_SCHEMA, ReviewLake, review_transform
from strata.plans.smartgrid import READING_KEYS, GridLake
from strata.sinks import SnapshotTable
from strata.streaming import batch_counts, once, read_quarantine
from strata.streaming.jobs import ingest_bronze, reset_stream
from tests.conftest import rows


def land(folder, name, *docs, age=0):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs) + "\n")
    if age:
        os.utime(path, (time.time() - age, time.time() - age))


def reading(meter, kwh, at="2023-01-01T10:00:00", zip_code=98001, **more):
    return {"meterId": meter, "measurementInKWh": kwh, "zipCode": zip_code, "measurementDate": at, **more}


def test_readings_end_to_end(spark, tmp_path):
    landing = tmp_path / "landing" / "readings"
    lake = GridLake(spark, str(tmp_path), buckets=4)
    land(landing, "a.json", reading("m1", 7.5), reading("m1", 6.5), reading("m2", 50.0), reading("m3", "bad"),
         reading("m4", 9.0, at="never"), reading("m5", 8.0, extra=1), '{"broken', age=100)
    lake.bronze()
    table = lake.silver()
    assert rows(table.read(), "meterId", "measurementInKWh") == [("m1", __import__("decimal").Decimal("6.500"))]
    q = read_quarantine(spark, lake.path("quarantine"))
    assert rows(q.groupBy("dq_category").count()) == [("INVALID_DATE", 1), ("INVALID_VALUE", 1), ("SCHEMA_MISMATCH", 3)]

    # A correction in a newer file wins; a late file with an older time does not.
    land(landing, "b.json", reading("m1", 12.0), age=50)
    lake.bronze()
    lake.silver()
    land(landing, "c.json", reading("m1", 19.0), reading("m9", 5.0), age=500)
    lake.bronze()
    table = lake.silver()
    assert {r["meterId"]: float(r["measurementInKWh"]) for r in table.read().collect()} == {"m1": 12.0, "m9": 5.0}

    meters = spark.createDataFrame([("m1", 0)], "meterId string, sid long")
    places = spark.createDataFrame([(98001, 0)], "zipCode long, sid long")
    fact = lake.fact(meters, places, lake.dates("2023-01-01", "2023-01-02"))
    got = rows(fact.read(), "meterSid", "serviceLocationSid", "measurementDateSid", "measurementTimeSid", "powerConsumptedKwh")
    assert [(a, b, c, d, float(e)) for a, b, c, d, e in got] == [(-1, 0, "20230101", "100000", 5.0), (0, 0, "20230101", "100000", 12.0)]
    version = fact.version()
    lake.fact(meters, places, lake.dates("2023-01-01", "2023-01-02"))
    assert fact.version() == version  # nothing new, nothing committed


def test_grid_master_data(spark, tmp_path):
    lake = GridLake(spark, str(tmp_path), buckets=2)
    head = "meterId,MeterLocation,MeterNumber,class,maxKwh,efficiencyPercentage,envImpact,startupTimeMin"
    land(tmp_path / "landing/meters", "a.csv", "\ufeff" + head, "m2,here,2,Small,20,75,High,5", "m1,here,x,Large,20,80,High,5", "m3,here,3,Huge,20,75,High,5", ",here,4,Small,20,75,High,5", age=100)
    land(tmp_path / "landing/places", "a.csv", "ZipCode,Lat,Long", "98001,47.5,-122.25", "98002,n/a,-122.5", age=100)
    land(tmp_path / "landing/readings", "a.json", reading("m1", 7.5), reading("m3", 9.0), age=100)
    fact = lake.run("2023-01-01", "2023-01-02")
    got = [(a, b, float(c)) for a, b, c in rows(fact.read(), "meterSid", "serviceLocationSid", "powerConsumptedKwh")]
    assert got == [(-1, 0, 9.0), (0, 0, 7.5)]
    bad = read_quarantine(spark, lake.path("quarantine"))
    assert rows(bad.groupBy("table_name", "dq_category").count()) == [
        ("silver_meters", "INVALID_VALUE", 1), ("silver_meters", "MISSING_KEY", 1), ("silver_places", "MISSING_KEY", 1)]

    # A changed value, a new member, and a late older file.
    land(tmp_path / "landing/meters", "b.csv", head, "m1,here,1,Medium,20,80,High,5", "m0,here,5,Small,20,75,High,5", age=50)
    land(tmp_path / "landing/meters", "c.csv", head, "m2,there,2,Large,20,75,High,5", age=500)
    meters = lake.meters().read()
    assert rows(meters, "sid", "meterId", "class", "meterNum") == [(0, "m1", "Medium", 1), (1, "m2", "Small", 2), (2, "m0", "Small", 5)]
    assert [float(r[0]) for r in rows(meters, "efficiencyPercentage")] == [0.75, 0.75, 0.8]


def review(i, **more):
    return {"review_id": f"r{i}", "user_id": "u1", "business_id": "b1", "stars": 5, "useful": 1, "funny": 0, "cool": 0,
            "text": "fine", "date": "2024-01-02 03:04:05", **more}


def test_reviews_twice(spark, tmp_path):
    lake = ReviewLake(spark, str(tmp_path), buckets=2)
    land(tmp_path / "landing/business", "b.json", {"business_id": "b1", "name": "Cafe", "city": "EDMONTON, AB", "state": "AB", "stars": 4.5, "review_count": 3, "is_open": 1, "categories": "Food"})
    land(tmp_path / "landing/user", "u.json", {"user_id": "u1", "name": "Ann", "yelping_since": "2010-01-01 00:00:00", "review_count": 1, "average_stars": 4.0,
                                               "useful": 0, "funny": 0, "cool": 0, "fans": 2, "elite": "2019, 2020", "friends": ""})
    land(tmp_path / "landing/review", "1.json", review(1), review(2, user_id="nobody"), review(3, stars=9), review(4, user_id=None))
    fact = lake.run("2024-01-01", "2024-01-31")
    assert rows(fact.read(), "NK_review_id", "stars") == [("r1", 5.0)]
    (first,) = rows(fact.read(), "fact_created_date", "_silver_processing_date", "dq_user_key_valid")
    assert first[1] <= first[0] and first[2]
    q = read_quarantine(spark, lake.quarantine)
    assert rows(q, "layer", "dq_category") == [("gold", "MISSING_KEY"), ("silver", "INVALID_VALUE"), ("silver", "MISSING_FOREIGN_KEY")]
    user = lake.table("gold", "dim_user", ["NK_user_id"]).read().first()
    assert (user["elite_years"], user["friends_count"]) == (["2019", "2020"], 0)
    assert lake.table("gold", "dim_business", ["NK_business_id"]).read().first()["city"] == "Edmonton"

    land(tmp_path / "landing/review", "2.json", review(1, stars=2), review(5))
    fact = lake.run("2024-01-01", "2024-01-31")
    assert rows(fact.read(), "NK_review_id", "stars") == [("r1", 2.0), ("r5", 5.0)]
    again, new = rows(fact.read(), "NK_review_id", "fact_created_date", "_silver_processing_date")
    assert again[1] == first[0] and again[2] > first[1] and new[1] > first[0]  # replaced, but created when it first came
    assert rows(fact.change_feed(1), "NK_review_id", "_change_type") == [("r1", "update"), ("r5", "insert")]


def test_bronze_rate_cap_and_progress(spark, tmp_path):
    for i in range(5):
        land(tmp_path / "in", f"{i}.json", review(i))
    q = ingest_bronze(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), StructType.fromDDL(REVIEW_SCHEMA), "x", max_files=2, name="capped")
    q.awaitTermination()
    counts = batch_counts(q)
    assert {n for n, _, _ in counts} == {"capped"} and sum(c for *_, c in counts) == 5 and max(c for *_, c in counts) == 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_counts_of_all_batches_survive_restarts(spark, tmp_path):
    """More batches than Spark keeps the progress of, over three runs on one checkpoint."""
    from strata.sinks import write_stream
    from strata.sources import stream_json

    schema = StructType.fromDDL("id long")
    total = 0
    for run in range(3):
        spark.range(total, total + 40, 1, 40).write.mode("append").json(f"{tmp_path}/landing")
        q = write_stream(stream_json(spark, f"{tmp_path}/landing", schema, max_files=1), f"{tmp_path}/out", f"{tmp_path}/checkpoint", f"many{run}")
        q.awaitTermination()
        total += 40
        own = batch_counts(q)
        assert sum(n for _, _, n in own) == 40 and {name for name, _, _ in own} == {f"many{run}"}
    every = batch_counts(q, all_runs=True)
    assert sum(n for _, _, n in every) == 120 and len(every) > 100 and [b for _, b, _ in every] == sorted({b for _, b, _ in every})
    q = write_stream(stream_json(spark, f"{tmp_path}/landing", schema), f"{tmp_path}/out", f"{tmp_path}/checkpoint", "idle")
    q.awaitTermination()
    assert batch_counts(q) == [] and batch_counts(q, all_runs=True) == every


def test_windows_keep_late_rows(spark, tmp_path):
    from strata.streaming import WindowedStream

    schema = StructType.fromDDL("id long, ts timestamp")
    stream = lambda: WindowedStream(spark, f"{tmp_path}/w", schema, "ts", "10 minutes")
    landing = tmp_path / "landing"
    stamp = lambda t: f"2024-05-01T{t}:00Z"
    land(landing, "a.json", {"id": 1, "ts": stamp("10:01")}, {"id": 2, "ts": stamp("10:20")}, {"id": 3, "ts": None})
    stream().run(str(landing))
    land(landing, "b.json", {"id": 4, "ts": stamp("10:12")}, {"id": 5, "ts": stamp("10:09")}, {"id": 6, "ts": stamp("10:50")})
    stream().run(str(landing))
    assert sorted(r.id for r in stream().late().collect()) == [3, 5]
    stream().run(str(landing))  # nothing new
    land(landing, "c.json", {"id": 7, "ts": stamp("11:30")}, {"id": 8, "ts": stamp("10:45")}, {"id": 9, "ts": stamp("10:10")})
    stream().run(str(landing))
    assert sorted(r.id for r in stream().late().collect()) == [3, 5, 9]
    got = rows(stream().windows().selectExpr("date_format(bucket_start, 'HH:mm') AS at", "rows"))
    assert got == [("10:00", 2), ("10:15", 1), ("10:45", 2)]
    # A batch that is done again after a crash sorts its rows the same way.
    again = spark.read.schema(schema).json(str(landing / "b.json"))
    stream()._split(again, 1)
    assert sorted(r.id for r in stream().late().collect()) == [3, 5, 9]


def test_routes_are_counted_in_the_pass_that_quarantines(spark):
    from pyspark.sql import Observation

    from strata.operators.quality import between, observed_routes, schema_fits

    rules = [schema_fits(), between("v", 1, 5)]
    df = spark.createDataFrame([(1, None), (9, None), (2, "odd"), (None, None), (9, "odd")], "v int, _rescued_data string")
    counted = Observation()
    assert observed_routes(df, rules, counted).collect() and counted.get == {"passed": 1, "schema_failed": 2, "rule_failed": 2}
    counted = Observation()
    assert observed_routes(df.limit(0), rules, counted).collect() == [] and counted.get == {"passed": 0, "schema_failed": 0, "rule_failed": 0}


def make(spark, tmp_path, buckets=4):
    table = SnapshotTable(spark, f"{tmp_path}/t", ["k"], StructType.fromDDL("k int, v string"), buckets)
    plan = lambda t, s: merge_upsert(t, s, ["k"], mark_changes=True)
    return table, plan, lambda *data: spark.createDataFrame(list(data), "k int, v string")


def test_replayed_batch_commits_nothing(spark, tmp_path):
    table, plan, frame = make(spark, tmp_path)
    assert table.read().count() == 0 and table.version() == 0
    table.merge(frame((1, "a"), (2, "b")), plan, writer="w", batch_id=0)
    assert table.merge(frame((1, "zzz")), plan, writer="w", batch_id=0) is None
    assert table.append(frame((1, "zzz")), writer="w", batch_id=0) is None
    assert once(table, "w", 0, lambda: pytest.fail("ran twice")) is False
    ran = []
    assert once(table, "w", 1, lambda: ran.append(1)) and ran == [1]
    table.merge(frame((2, "c")), plan, writer="other", batch_id=0)
    assert rows(table.read()) == [(1, "a"), (2, "c")]
    assert rows(table.read(version=1)) == [(1, "a"), (2, "b")]


def test_grid_layers_size_their_shuffles(spark, data):
    from strata.queries import QUERIES

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "199")
    try:
        assert QUERIES["grid_silver"].run(spark, data).count() > 0
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rows_with_new_keys_rewrite_nothing(spark, tmp_path):
    table, plan, frame = make(spark, tmp_path, buckets=4)
    first = table.merge(frame(*[(i, "a") for i in range(64)]), plan)
    more = table.merge(frame(*[(i, "b") for i in range(64, 128)]), plan)
    assert more["rows_written"] == more["inserted"] == 64
    assert [p for p in more["parts"] if p[0] == first["attempt"]] == first["parts"]
    mixed = table.merge(frame((5, "c"), (200, "c")), plan)
    assert (mixed["inserted"], mixed["updated"]) == (1, 1) and mixed["rows_written"] < 34
    got = {r["k"]: r["v"] for r in table.read().collect()}
    assert len(got) == table.read().count() == 129 and got[5] == "c" and got[6] == "a" and got[70] == "b"


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table, plan, frame = make(spark, tmp_path, buckets=16)
    table.overwrite(frame(*[(i, "a") for i in range(64)]))
    record = table.merge(frame((5, "b")), plan)
    assert len([b for attempt, b in record["parts"] if attempt == record["attempt"]]) == 1
    assert record["updated"] == 1 and record["rows_written"] < 64
    assert table.read().count() == 64


def test_left_overs_of_a_dead_writer_are_ignored(spark, tmp_path):
    table, plan, frame = make(spark, tmp_path)
    table.overwrite(frame((1, "a")))
    frame((9, "ghost")).write.parquet(f"{tmp_path}/t/data/{2:020d}-dead/_bucket=0")
    assert rows(table.read()) == [(1, "a")]
    table.merge(frame((2, "b")), plan)
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    assert table.expire(days=-1) == [f"{2:020d}-dead"]


def test_two_writers_cannot_claim_one_version(spark, tmp_path, monkeypatch):
    table, plan, frame = make(spark, tmp_path)
    table.overwrite(frame((1, "a")))
    late, _, _ = make(spark, tmp_path)
    seen = late._latest()
    table.merge(frame((2, "b")), plan)
    monkeypatch.setattr(late, "_latest", lambda: seen)  # it started before the other committed
    with pytest.raises(Exception):
        late.merge(frame((3, "c")), plan)
    assert rows(table.read()) == [(1, "a"), (2, "b")]


def test_history_compaction_and_retention(spark, tmp_path):
    table, plan, frame = make(spark, tmp_path)
    for i in range(3):
        table.append(frame((i, "a")), writer="w", batch_id=i)
    assert table.compact(every_days=30)["operation"] == "compact"
    assert table.compact(every_days=30) is None
    assert rows(table.history(), "version", "operation", "inserted")[-1] == (4, "compact", 0)
    assert rows(table.read()) == [(0, "a"), (1, "a"), (2, "a")]
    assert table.expire(days=7) == []
    assert [int(n.split('-')[0]) for n in table.expire(days=-1)] == [1, 2, 3]
    assert rows(SnapshotTable(spark, f"{tmp_path}/t", ["k"]).read()) == [(0, "a"), (1, "a"), (2, "a")]
    assert table.change_feed(3).count() == 0  # a compaction changes no row


def test_published_changes_are_not_repeated(spark, tmp_path):
    table, plan, frame = make(spark, tmp_path)
    table.merge(frame((1, "a"), (2, "b")), plan)
    assert table.publish_changes(f"{tmp_path}/ch") == [1]
    table.merge(frame((2, "c"), (3, "d")), plan)
    assert table.publish_changes(f"{tmp_path}/ch") == [2]
    got = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/ch")
    assert rows(got, "k", "v", "_commit_version") == [(1, "a", 1), (2, "b", 1), (2, "c", 2), (3, "d", 2)]


def test_columns_may_be_added(spark, tmp_path):
    table, plan, frame = make(spark, tmp_path)
    table.overwrite(frame((1, "a")))
    table.add_columns(StructType.fromDDL("k int, extra double"))
    table.merge(spark.createDataFrame([(2, "b", 1.5)], "k int, v string, extra double"), plan)
    assert rows(table.read()) == sorted([(1, "a", None), (2, "b", 1.5)], key=repr)


def test_delete_and_reset(spark, tmp_path):
    table, plan, frame = make(spark, tmp_path)
    table.overwrite(frame((1, "a"), (2, "b"), (3, None)))
    table.delete_where("v = 'a'")
    assert rows(table.read(), "k") == [(2,), (3,)]
    reset_stream(spark, table, f"{tmp_path}/ck")
    assert not storage.exists(spark, f"{tmp_path}/t")
    with pytest.raises(ValueError):
        SnapshotTable(spark, f"{tmp_path}/t", ["k"])


def test_transform_keeps_lineage(spark):
    schema = StructType.fromDDL(REVIEW_SCHEMA + ", _rescued_data string, _input_filename string, _input_file_modification_date timestamp, _pipeline_run_id string, _processing_date timestamp")
    shaped = review_transform(spark.createDataFrame([], schema), "s1")
    assert {"_bronze_pipeline_run_id", "_bronze_processing_date", "_silver_pipeline_run_id", "review_useful_votes"} <= set(shaped.columns)
    assert "date" not in shaped.columns and len(REVIEW_RULES) == 6 and BUSINESS_SCHEMA and USER_SCHEMA
    assert F is not None


def _persisted(monkeypatch):
    """The columns of every frame that is persisted from now on."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: seen.append(self.columns) or persist(self, *a))
    return seen


def test_silver_keeps_good_rows_only(spark, tmp_path, monkeypatch):
    """A micro-batch is read again rather than kept whole; what the merge reads is kept."""
    lake = GridLake(spark, str(tmp_path), buckets=2)
    land(tmp_path / "landing/readings", "a.json", reading("m1", 7.5), reading("m2", 50.0), reading("m3", 9.0, extra=1))
    lake.bronze()
    seen = _persisted(monkeypatch)
    table = lake.silver()
    assert rows(table.read().select("meterId")) == [("m1",)]
    assert read_quarantine(spark, lake.path("quarantine")).count() == 2
    assert len(seen) == 1 and "dq_pass" in seen[0]


def test_fact_keeps_its_rows_only(spark, tmp_path, monkeypatch):
    lake = GridLake(spark, str(tmp_path), buckets=2)
    land(tmp_path / "landing/readings", "a.json", reading("m1", 7.5), reading("m2", 9.0))
    lake.bronze()
    lake.silver()
    seen = _persisted(monkeypatch)
    meters = spark.createDataFrame([("m1", 0)], "meterId string, sid long")
    places = spark.createDataFrame([(98001, 0)], "zipCode long, sid long")
    fact = lake.fact(meters, places, lake.dates("2023-01-01", "2023-01-02"))
    assert rows(fact.read(), "meterSid") == [(-1,), (0,)]
    assert len(seen) == 1 and "_commit_version" not in seen[0]
