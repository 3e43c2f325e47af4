"""Sources and sinks: driver tables written out in another form and read back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import sinks, sources
from strata.operators.aggregates import distribution, table_counts, union_all
from strata.operators.projections import carry_lineage, with_lineage
from strata.plans.questions import run_named
from strata.plans.sales import WEATHER_FIELDS, typed_weather
from strata.queries.registry import money, query, sql_total, text, total
from strata.session import RunConfig, scratch_path

EVENT_TOTALS = f"SELECT event_type, count(*) AS rows, {sql_total('value')} AS amount FROM events GROUP BY 1"


def _totals(df: DataFrame) -> DataFrame:
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), total("value").alias("amount"))


def _events_json(spark, d) -> str:
    (events,) = sources.tables(spark, d, "events")
    path = scratch_path(spark, "events-json")
    events.write.json(path)
    return path


@query("SRC-01", EVENT_TOTALS)
def source_json(spark, d):
    return _totals(sources.read_json(spark, _events_json(spark, d)))


@query("SRC-01 PRJ-03 PRJ-04", """
    SELECT 'run-1' AS bronze, 'run-2' AS silver, true AS has_file, true AS whole_second, count(*) AS rows FROM events""")
def source_lineage(spark, d):
    raw = sources.read_json(spark, _events_json(spark, d), "event_id long, event_type string, value double")
    rows = carry_lineage(with_lineage(raw, "run-1"), "bronze", "silver", "run-2")
    named = rows.select(
        F.col("_bronze_pipeline_run_id").alias("bronze"), F.col("_silver_pipeline_run_id").alias("silver"),
        (F.col("_input_filename").endswith(".json") & F.col("_input_file_modification_date").isNotNull()).alias("has_file"),
        (F.col("_bronze_processing_date") == F.date_trunc("second", "_bronze_processing_date")).alias("whole_second"))
    return distribution(named, "bronze", "silver", "has_file", "whole_second", count="rows")


def _as_json_arrays(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of JSON text to lines that make each file one JSON array."""
    lead = "["
    for frame in frames:
        lines = []
        for line in frame["line"]:
            lines.append(lead + line)
            lead = ","
        yield pd.DataFrame({"value": lines})
    yield pd.DataFrame({"value": ["[]" if lead == "[" else "]"]})


@query("SRC-02 JOB-05", f"""
    SELECT event_type AS temp_unit, CASE WHEN event_id % 3 = 0 THEN false WHEN event_id % 3 = 1 THEN true END AS clouds_all, count(*) AS rows,
           {sql_total('value')} AS rain, max(strftime(ts, '%Y-%m-%d')) AS last_day FROM events GROUP BY 1, 2""")
def source_json_flat(spark, d):
    """Nested weather-like documents in multi-line array files."""
    (events,) = sources.tables(spark, d, "events")
    nested = events.select(F.to_json(F.struct(
        F.col("event_id").cast("string").alias("_id"), F.lit("g").alias("guid"), text("ts").alias("date"),
        F.struct(F.col("event_type").alias("unit"), F.col("value").alias("temp")).alias("main"),
        F.struct(F.lit("km").alias("unit"), F.col("value").alias("speed")).alias("wind"),
        F.struct(F.when(F.col("event_id") % 3 < 2, F.col("event_id") % 3).alias("all")).alias("clouds"),
        F.struct(F.lit("mm").alias("unit"), F.col("value").alias("1h")).alias("rain"),
    )).alias("line"))
    path = scratch_path(spark, "weather")
    nested.mapInPandas(_as_json_arrays, "value string").write.text(path)
    flat = typed_weather(sources.read_json_flat(spark, path, WEATHER_FIELDS))
    return flat.groupBy("temp_unit", "clouds_all").agg(
        F.count(F.lit(1)).alias("rows"), total("avg_rain_hr").alias("rain"), F.max("date").alias("last_day"))


def _part_csv(spark, d) -> str:
    (part,) = sources.tables(spark, d, "part")
    path = scratch_path(spark, "part-csv")
    part.write.option("header", True).csv(path)
    return path


@query("SRC-03", "SELECT p_brand, count(*) AS rows, max(CAST(p_size AS VARCHAR)) AS largest_text FROM part GROUP BY 1")
def source_csv_text(spark, d):
    rows = sources.read_csv(spark, _part_csv(spark, d))
    return rows.groupBy("p_brand").agg(F.count(F.lit(1)).alias("rows"), F.max("p_size").alias("largest_text"))


@query("SRC-04", f"SELECT p_brand, count(*) AS rows, max(p_size) AS largest, {sql_total('p_retailprice')} AS price FROM part GROUP BY 1")
def source_csv_typed(spark, d):
    schema = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    rows = sources.read_csv(spark, _part_csv(spark, d), schema)
    return rows.groupBy("p_brand").agg(F.count(F.lit(1)).alias("rows"), F.max("p_size").alias("largest"), total("p_retailprice").alias("price"))


@query("SRC-06 SRC-05", "SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY 1")
def source_sql_on_file(spark, d):
    return distribution(sources.sql_on_file(spark, "parquet", f"{d}/orders.parquet"), "o_orderstatus", count="rows")


def _documents_text(spark, d) -> str:
    """The texts as they are, each closed by a line feed, in files that stay far below the 2 GB of one value."""
    (documents,) = sources.tables(spark, d, "documents")
    path = scratch_path(spark, "bodies")
    documents.select(F.coalesce("text", F.lit(""))).write.option("maxRecordsPerFile", 1000).text(path)
    return path


@query("SRC-07", "SELECT sum(length(CAST(doc_id AS VARCHAR)) + 1)::BIGINT AS bytes, true AS named FROM documents")
def source_binary(spark, d):
    (documents,) = sources.tables(spark, d, "documents")
    path = scratch_path(spark, "binary")
    documents.select(F.col("doc_id").cast("string")).write.text(path)
    files = sources.read_binary(spark, path, "*.txt")
    return files.agg(F.sum("length").alias("bytes"), F.every(F.col("src_file_name").endswith(".txt")).alias("named"))


@query("SRC-08", "SELECT sum(length(CAST(doc_id AS VARCHAR)) + 1)::BIGINT AS chars, count(*) AS lines FROM documents")
def source_text_docs(spark, d):
    (documents,) = sources.tables(spark, d, "documents")
    path = scratch_path(spark, "text")
    documents.select(F.col("doc_id").cast("string")).write.text(path)
    docs = sources.read_text_docs(spark, path).agg(F.sum(F.length("content")).alias("chars"))
    lines = sources.read_text_lines(spark, path).agg(F.count(F.lit(1)).alias("lines"))
    return docs.withColumn("lines", lines.scalar())


@query("SRC-07", "SELECT sum(strlen(coalesce(text, '')) + 1)::BIGINT AS bytes, true AS named, true AS sized FROM documents")
def source_binary_bodies(spark, d):
    """Whole texts as binary files; the bytes themselves are read and counted."""
    files = sources.read_binary(spark, _documents_text(spark, d), "*.txt")
    return files.agg(
        F.sum(F.octet_length("content")).alias("bytes"), F.every(F.col("src_file_name").endswith(".txt")).alias("named"),
        F.every(F.octet_length("content") == F.col("length")).alias("sized"))


@query("SRC-08", r"""
    SELECT sum(length(t))::BIGINT AS chars, sum(len(regexp_extract_all(t, '\r\n|\r|\n')))::BIGINT AS lines,
      sum(length(regexp_replace(t, '\r\n|\r|\n', '', 'g')))::BIGINT AS line_chars
    FROM (SELECT coalesce(text, '') || chr(10) AS t FROM documents)""")
def source_text_bodies(spark, d):
    """Whole texts through both text readers: files as rows, and their lines."""
    path = _documents_text(spark, d)
    docs = sources.read_text_docs(spark, path).agg(F.sum(F.length("content")).alias("chars"))
    lines = sources.read_text_lines(spark, path).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("line_chars"))
    return docs.crossJoin(lines)  # one row each


COPIED = ["region", "nation", "customer", "orders", "lineitem"]


@query("SRC-10 SET-02", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in COPIED))
def source_copy_tables(spark, d):
    out = scratch_path(spark, "copied")
    paths = sources.copy_tables(sources.parquet_reader(spark, d), COPIED, out)
    return table_counts({name: sources.read_parquet(spark, p) for name, p in zip(COPIED, paths)}).drop("formatted")


@query("SRC-11", f"""
    SELECT event_type, count(*) AS rows, {sql_total('value')} AS amount FROM events
    WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events) GROUP BY 1""")
def source_landing_window(spark, d):
    """All events land in one folder per day; the run after the last day reads its folder."""
    (events,) = sources.tables(spark, d, "events")
    root = scratch_path(spark, "landing")
    events.withColumn("day", text("ts")).drop("ts").write.partitionBy("day").json(root)
    last = events.agg(F.max("ts")).first()[0].replace(hour=0, minute=0, second=0, microsecond=0)
    rows = sources.read_landing_window(
        spark, root, last + timedelta(days=1), minutes=1440, schema="event_type string, value double", layout="day=%Y-%m-%d")
    return _totals(rows)


# A code list held in memory.
PRIORITIES = [("1-URGENT", 1, "now"), ("2-HIGH", 2, "today"), ("3-MEDIUM", 3, "this week"), ("5-LOW", 5, "later")]


@query("SRC-12 JON-02", f"""
    SELECT code, meaning, count(*) AS rows FROM orders JOIN (VALUES {', '.join(str(p) for p in PRIORITIES)}) c(priority, code, meaning)
    ON priority = o_orderpriority GROUP BY 1, 2""")
def source_in_memory(spark, d):
    (orders,) = sources.tables(spark, d, "orders")
    codes = spark.createDataFrame(PRIORITIES, "o_orderpriority string, code int, meaning string")
    joined = orders.join(F.broadcast(codes), "o_orderpriority")  # a fixed list of four rows
    return distribution(joined, "code", "meaning", count="rows")


@query("SNK-13 UDF-05 SNK-03", """
    SELECT 'run-2' AS run, c_mktsegment, count(*) AS rows FROM customer GROUP BY 2""")
def sink_reset_table(spark, d):
    """The second run asks for a reset, so only its rows remain."""
    (customer,) = sources.tables(spark, d, "customer")
    suffix = uuid.uuid4().hex
    for config in (RunConfig("run-1"), RunConfig("run-2", reset=True)):
        name = config.table("silver", f"customer_{suffix}")
        if config.reset:
            sinks.reset_table(spark, name, scratch_path(spark, "no-checkpoint"))
        rows = customer.select(F.lit(config.run_id).alias("run"), "c_custkey", "c_mktsegment")
        sinks.create_or(rows, name, lambda df, n: sinks.write_table(df, n, "append"), location=scratch_path(spark, name))
    return distribution(sources.table(spark, name), "run", "c_mktsegment", count="rows")


@query("SRC-09 SNK-01 SNK-02 SNK-03 FLT-03", """
    SELECT c_mktsegment, count(*) * 2 AS rows, count(*) AS named, (SELECT count(*) * 2 FROM customer) AS total FROM customer GROUP BY 1""")
def sink_catalog_table(spark, d):
    """Create a table, append to it by column name with a column missing."""
    (customer,) = sources.tables(spark, d, "customer")
    name = f"customers_{uuid.uuid4().hex}"
    rows = customer.select("c_custkey", "c_name", "c_mktsegment")
    append = lambda df, n: sinks.write_table(df, n, "append")
    sinks.create_or(rows, name, append, location=scratch_path(spark, name))
    sinks.create_or(customer.select("c_mktsegment", "c_custkey"), name, append)
    counted = sources.table(spark, name).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("rows"), F.count("c_name").alias("named"))
    return counted.withColumn("total", run_named(spark, "rows_of_table", table=name).scalar())


@query("SNK-04 SNK-09 SNK-10", """
    SELECT o_orderstatus, count(*) AS rows, CAST(sum(CAST(o_totalprice AS DECIMAL(10,2))) AS DOUBLE) AS amount FROM orders
    WHERE o_totalprice BETWEEN 1000 AND 400000 GROUP BY 1""")
def sink_ctas_view(spark, d):
    (orders,) = sources.tables(spark, d, "orders")
    name = f"orders_{uuid.uuid4().hex}"
    sinks.ctas(spark, name, """
        SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(10,2)) AS o_totalprice FROM {orders}
        WHERE o_totalprice BETWEEN 1000 AND 400000""", location=scratch_path(spark, name), orders=orders)
    empty = sinks.create_table(spark, f"{name}_empty", "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DECIMAL(10,2)",
                               location=scratch_path(spark, f"{name}_empty"))
    view = sinks.create_view(spark, f"{name}_view", f"SELECT * FROM {name} UNION ALL SELECT * FROM {name}_empty")
    assert view.schema == empty.schema
    return view.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_totalprice").cast("double").alias("amount"))


@query("SNK-11 JON-13", "SELECT 'test' AS tag_name, 'Order status: F, O or P' AS column_comment, count(*) AS rows FROM orders")
def sink_annotations(spark, d):
    (orders,) = sources.tables(spark, d, "orders")
    name = f"tagged_{uuid.uuid4().hex}"
    sinks.write_table(orders.select("o_orderkey", "o_orderstatus"), name, location=scratch_path(spark, name))
    sinks.annotate(spark, name, "Orders", {"o_orderstatus": "Order status: F, O or P"}, {"test": ""})
    tags = sinks.tagged_tables(spark).filter(F.col("table_name") == name)
    comments = sinks.describe_metadata(spark, name).filter("col_name = 'o_orderstatus'")
    rows = sources.table(spark, name).agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(tags.select("tag_name").scalar().alias("tag_name"), comments.select("comment").scalar().alias("column_comment"), "rows")


@query("SNK-02 SET-01", """
    SELECT extra, count(*) AS rows FROM (SELECT NULL::BIGINT AS extra FROM supplier UNION ALL SELECT c_nationkey % 3 FROM customer) GROUP BY 1""")
def sink_append_evolve(spark, d):
    supplier, customer = sources.tables(spark, d, "supplier", "customer")
    path = scratch_path(spark, "grown")
    sinks.append_files(supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), path)
    sinks.append_files(customer.select(F.col("c_name").alias("name"), (F.col("c_nationkey") % 3).cast("long").alias("extra"), F.col("c_custkey").alias("id")), path)
    return distribution(sources.read_parquet(spark, path, merge_schema=True), "extra", count="rows")


@query("SNK-05", f"SELECT year(o_orderdate) AS year, count(*) AS rows, {sql_total('o_totalprice')} AS amount FROM orders GROUP BY 1")
def sink_write_by_year(spark, d):
    (orders,) = sources.tables(spark, d, "orders")
    path = scratch_path(spark, "by-year")
    sinks.write_by(orders.withColumn("year", F.year("o_orderdate")), "year", path)
    return sources.read_parquet(spark, path).groupBy(F.col("year").cast("long").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), total("o_totalprice").alias("amount"))


@query("SNK-06 JOB-05", f"""
    SELECT o_orderstatus, count(*) AS rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END) AS DOUBLE) AS amount
    FROM orders GROUP BY 1""")
def sink_replace_slice(spark, d):
    """Load all slices, then reload one of them with doubled amounts, twice."""
    (orders,) = sources.tables(spark, d, "orders")
    path = scratch_path(spark, "slices")
    rows = orders.select("o_orderkey", money("o_totalprice").alias("amount"), "o_orderstatus")
    sinks.replace_slice(rows, path, "o_orderstatus")
    again = rows.filter("o_orderstatus = 'F'").withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)"))
    for _ in range(2):
        sinks.replace_slice(again, path, "o_orderstatus")
    return sources.read_parquet(spark, path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("double").alias("amount"))


# Event rows as JSON lines with a wrong type, an unknown field and a broken line.
MESSY = """CASE WHEN event_id % 50 = 7 THEN concat('{"event_id": ', CAST(event_id AS STRING))
    ELSE to_json(named_struct('event_id', event_id, 'value', CASE WHEN event_id % 20 = 1 THEN 'n/a' ELSE CAST(value AS STRING) END,
                              'event_type', event_type, 'note', CASE WHEN event_id % 30 = 2 THEN 'late' END)) END"""


@query("SRC-15", f"""
    SELECT CASE WHEN event_id % 50 = 7 THEN 'unreadable' WHEN event_id % 20 = 1 AND event_id % 30 = 2 THEN 'note,value'
                WHEN event_id % 20 = 1 THEN 'value' WHEN event_id % 30 = 2 THEN 'note' ELSE 'none' END AS rescued, count(*) AS rows,
           count(CASE WHEN event_id % 50 <> 7 AND event_id % 20 <> 1 THEN value END) AS typed FROM events GROUP BY 1""")
def source_rescued(spark, d):
    (events,) = sources.tables(spark, d, "events")
    path = scratch_path(spark, "messy")
    events.select(F.expr(MESSY)).write.text(path)
    schema = StructType.fromDDL("event_id long, value double, event_type string")
    rows = sources.read_rescued(spark, path, schema)
    keys = F.array_join(F.array_sort(F.map_keys(F.from_json("_rescued_data", "map<string,string>"))), ",")
    state = F.when(F.col("_rescued_data").isNull(), "none").when(keys == "_unreadable", "unreadable").otherwise(keys)
    return rows.groupBy(state.alias("rescued")).agg(F.count(F.lit(1)).alias("rows"), F.count("value").alias("typed"))


@query("SRC-14", """
    SELECT 'event_id,event_type,value,user_id' AS columns, (SELECT count(*) FROM events) * 2 AS rows, (SELECT count(*) FROM events) AS with_new""")
def source_schema_evolution(spark, d):
    """Two landings; the second brings a new column and another type for one."""
    (events,) = sources.tables(spark, d, "events")
    root = scratch_path(spark, "evolving")
    events.select("event_id", "event_type", "value").write.json(f"{root}/1")
    events.select("event_id", F.concat("event_type", F.lit("!")).alias("event_type"), F.col("value").cast("string").alias("value"), "user_id").write.json(f"{root}/2")
    first = sources.evolve_schema(spark, f"{root}/1", f"{root}/schema.json")
    second = sources.evolve_schema(spark, f"{root}/2", f"{root}/schema.json")
    assert set(first.fieldNames()) < set(second.fieldNames())
    rows = union_all([sources.read_rescued(spark, f"{root}/{n}", second).drop("_file") for n in (1, 2)])
    return rows.agg(F.lit(",".join(second.fieldNames())).alias("columns"), F.count(F.lit(1)).alias("rows"), F.count("user_id").alias("with_new"))
