from __future__ import annotations

import datetime as dt
import json
import re

import pytest
from pyspark.sql.types import StructType

from strata import sinks, sources, storage
from strata.plans.documents import parsed_receipts, receipt_fields, receipt_files
from strata.plans.sales import WEATHER_FIELDS, typed_weather
from strata.queries import QUERIES
from strata.session import RunConfig, scratch_path, scratch_root
from tests.conftest import rows


def test_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(b"\xef\xbb\xbfmeterId,maxKwh\nm1,07\n")
    df = sources.read_csv(spark, str(tmp_path / "m.csv"))
    assert df.columns == ["meterId", "maxKwh"] and rows(df) == [("m1", "07")]
    typed = sources.read_csv(spark, str(tmp_path / "*.csv"), "meterId string, maxKwh int")
    assert rows(typed) == [("m1", 7)]


def test_weather_array(spark, tmp_path):
    docs = [
        {"_id": "1", "guid": "g", "date": "2022-01-01T10:00:00", "main": {"unit": "C", "temp": 21}, "wind": {"unit": "km", "speed": 3.5},
         "clouds": {"all": 1}, "rain": {"unit": "mm", "1h": 4}},
        {"_id": "2", "guid": "h", "date": "2022-01-02T10:00:00", "main": {"unit": "C", "temp": -2}, "wind": {"unit": "km", "speed": 0},
         "clouds": {"all": 0}, "rain": {"unit": "mm", "1h": 0}},
    ]
    (tmp_path / "w.json").write_text(json.dumps(docs, indent=2))
    flat = typed_weather(sources.read_json_flat(spark, str(tmp_path / "w.json"), WEATHER_FIELDS))
    assert rows(flat, "id", "avg_temp", "clouds_all", "avg_rain_hr") == [("1", 21, True, 4), ("2", -2, False, 0)]


def test_landing_window(spark, tmp_path):
    at = dt.datetime(2023, 1, 1, 10, 45)
    assert sources.landing_folder("/x/", at) == "/x/2023/01/01/103000"
    folder = tmp_path / "2023/01/01/103000"
    folder.mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        sources.read_landing_window(spark, str(tmp_path), at)
    (folder / "a.json").write_text('{"meterId":"m1","kwh":5.5}\n')
    assert rows(sources.read_landing_window(spark, str(tmp_path), at), "meterId", "kwh") == [("m1", 5.5)]


def test_odd_names_are_found_once_a_row(spark):
    from strata.sources.evolution import with_rescued

    schema = StructType.fromDDL("id long, kwh double")
    df = with_rescued(spark.createDataFrame([('{"id":1,"kwh":"x"}',)], "value string"), schema)
    tree = df._jdf.queryExecution().optimizedPlan().toString()
    inside = re.findall(r"map_filter\((.*?), lambda y", tree)
    assert inside and not any("CASE WHEN" in part for part in inside)
    assert df.first()["_rescued_data"] == '{"kwh":"x"}'


def test_rescued_rows_are_kept(spark, tmp_path):
    lines = ['{"id":1,"kwh":7.5}', '{"id":2,"kwh":"seven"}', '{"id":3,"kwh":8,"extra":{"a":1}}', '{"id":4', '{"id":null,"kwh":1}']
    (tmp_path / "r.json").write_text("\n".join(lines))
    schema = StructType.fromDDL("id long, kwh double")
    got = {r["id"]: (r["kwh"], r["_rescued_data"]) for r in sources.read_rescued(spark, str(tmp_path / "r.json"), schema).collect() if r["_rescued_data"] or r["id"]}
    assert got[1] == (7.5, None)
    assert got[2] == (None, '{"kwh":"seven"}')
    assert got[3][0] == 8.0 and json.loads(got[3][1]) == {"extra": '{"a":1}'}
    assert got[None][0] is None and "_unreadable" in got[None][1]
    assert sources.read_rescued(spark, str(tmp_path / "r.json"), schema).count() == 5


def test_schema_only_grows(spark, tmp_path):
    path = str(tmp_path / "s" / "schema.json")
    (tmp_path / "1.json").write_text('{"a":1}\n')
    (tmp_path / "2.json").write_text('{"a":"text","b":2.5}\n')
    assert sources.load_schema(spark, path) is None
    first = sources.evolve_schema(spark, str(tmp_path / "1.json"), path)
    second = sources.evolve_schema(spark, str(tmp_path / "2.json"), path)
    assert first.simpleString() == "struct<a:bigint>"
    assert second.simpleString() == "struct<a:bigint,b:double>" == sources.load_schema(spark, path).simpleString()


def test_binary_and_text_files(spark, tmp_path):
    for name in ("a.PNG", "b.jpg", "c.txt"):
        (tmp_path / name).write_bytes(name.encode())
    files = receipt_files(spark, str(tmp_path))
    assert rows(files, "src_file_name", "length") == [("a.PNG", 5), ("b.jpg", 5)]
    docs = sources.read_text_docs(spark, str(tmp_path / "c.txt"))
    assert rows(docs, "content", "file_name") == [("c.txt", "c.txt")]


def test_receipts(spark):
    good = json.dumps({"document": {"elements": [{"content": "Shop"}, {"type": "logo"}, {"content": "Total 5"}]}})
    bad = json.dumps({"error_status": "unreadable", "document": {"elements": [{"content": "x"}]}})
    df = spark.createDataFrame([(1, good), (2, bad), (3, None)], "id int, parse_output string")
    assert rows(parsed_receipts(df), "id", "parse_error", "parse_text") == [(1, None, "Shop\n\nTotal 5"), (2, "unreadable", None), (3, None, None)]
    fields = receipt_fields(spark.createDataFrame([('{"merchant_name":"Shop","total":"12.345","tax":"none"}',)], "extract_result string")).first()
    assert (fields["merchant_name"], str(fields["total"]), fields["tax"], fields["address"]) == ("Shop", "12.35", None, None)


def test_copy_tables(spark, data, tmp_path):
    paths = sources.copy_tables(sources.parquet_reader(spark, data), ["nation", "region"], str(tmp_path), parallel=2)
    assert [sources.read_parquet(spark, p).count() for p in paths] == [25, 5]
    assert rows(sources.sql_on_file(spark, "parquet", paths[1]), "r_regionkey") == [(i,) for i in range(5)]


def test_write_by_and_single_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 2018), (2, 2019), (3, 2019)], "id int, puYear int")
    sinks.write_by(df.repartition(4), "puYear", str(tmp_path / "out"), files=1)
    assert len(list((tmp_path / "out" / "puYear=2019").glob("*.parquet"))) == 1
    assert sources.read_parquet(spark, str(tmp_path / "out")).filter("puYear = 2019").count() == 2


def test_append_refuses_unknown_columns(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.write_table(df, "t_append")
    sinks.write_table(spark.createDataFrame([("b", 2)], "v string, id long"), "t_append", "append")
    assert rows(spark.table("t_append")) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        sinks.write_table(spark.createDataFrame([(1,)], "other int"), "t_append", "append")
    sinks.reset_table(spark, "t_append", None)
    assert not spark.catalog.tableExists("t_append")


def test_pack_batches_sends_each_document_once(spark):
    seen = sinks.pack_batches(spark.range(1030, numPartitions=2).withColumnRenamed("id", "doc"), "doc", size=250)
    status = seen.collect()
    assert sum(r["documents"] for r in status) == 1030 and max(r["documents"] for r in status) == 250
    assert len({r["start_id"] for r in status}) == len(status) == 6


def test_run_config_and_scratch(spark):
    run = RunConfig("r1", "prd", parameters={"city": "Edmonton"})
    assert run.table("silver", "review", "lake") == "lake.prd_silver_review" and run.get("city") == "Edmonton"
    assert run.get("none", "x") == "x"
    with pytest.raises(KeyError):
        run.get("none")
    assert scratch_path(spark, "a").startswith(scratch_root(spark)) and scratch_path(spark, "a") != scratch_path(spark, "a")


def test_publish_is_all_or_nothing(spark, tmp_path):
    path = f"{tmp_path}/c/1.json"
    storage.publish_text(spark, path, "one")
    with pytest.raises(Exception):
        storage.publish_text(spark, path, "two")
    assert storage.read_text(spark, path) == "one"
    assert storage.list_names(spark, f"{tmp_path}/c") == ["1.json"]


def test_text_queries_read_whole_texts(spark, tmp_path):
    texts = ["one\ntwo\r\nthree", "漢字 😀 Übung\r", "", None, "x" * 100_000 + "\n"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    whole = [(t or "") + "\n" for t in texts]
    assert tuple(QUERIES["source_binary_bodies"].run(spark, str(tmp_path)).first()) == (sum(len(t.encode()) for t in whole), True, True)
    lines = [line for t in whole for line in re.split("\r\n|\r|\n", t)[:-1]]
    assert tuple(QUERIES["source_text_bodies"].run(spark, str(tmp_path)).first()) == (sum(map(len, whole)), len(lines), sum(map(len, lines)))


def test_lines_that_fit_are_not_taken_apart(spark):
    """The map of a line is made only where a name is unknown or a field unset."""
    from strata.sources.evolution import with_rescued

    schema = StructType.fromDDL("id long, kwh double, tags array<string>")
    lines = [
        '{"id":1,"kwh":2.5,"tags":["a"]}', '{"id":2,"kwh":"x","more":{"b":[1]},"tags":[]}', '{"id":3,"kwh":null}', '{"id":4}', '[1]', '"text"', '{"broken', None,
        '{"id":5,"kwh":"7","tags":[],"Id":9}', '{"id":6,"kwh":1,"tags":"none","gone":null}', "{}",
    ]
    df = with_rescued(spark.createDataFrame([(x,) for x in lines], "value string"), schema)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if "from_json" in line]
    assert made and all(0 <= line.find("CASE WHEN") < line.find("from_json") for line in made)
    assert [(r["id"], r["kwh"], r["_rescued_data"]) for r in df.collect()] == [
        (1, 2.5, None), (2, None, '{"kwh":"x","more":"{\\"b\\":[1]}"}'), (3, None, None), (4, None, None), (None, None, None), (None, None, None),
        (None, None, '{"_unreadable":"{\\"broken"}'), (None, None, '{"_unreadable":null}'), (5, 7.0, '{"Id":"9"}'), (6, 1.0, '{"tags":"none","gone":null}'), (None, None, None),
    ]
