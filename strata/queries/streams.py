"""Streaming jobs over JSON files made from the driver tables.

Every query runs its whole job in a folder of its own and reads the tables it
leaves behind.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.hashing import row_hash
from strata.operators.aggregates import distribution
from strata.plans.reviews import REVIEW_METRICS, ReviewLake, batch_silver
from strata.plans.smartgrid import LOCATION_VALUES, GridLake, daily_average_by_place, load_dimension, usage_by_place
from strata.queries.registry import query, sql_total
from strata.session import materialise, plan_bytes, scratch_path, size_shuffles
from strata.sources import stream_json, tables
from strata.sinks import write_stream
from strata.streaming import WindowedStream, batch_counts, bucket_15min, ingest_evolving, read_evolving, read_quarantine, read_route_counts

# ------------------------------------------------------------- review medallion

CITY = "CASE c_custkey % 4 WHEN 0 THEN 'EDMONTON AB' WHEN 1 THEN 'st. albert' WHEN 2 THEN 'Sherwood' ELSE c_mktsegment END"
DATE_END = "2024-01-25"


def _land_reviews(spark, d, lake: ReviewLake, correction: bool) -> None:
    events, customer, supplier = tables(spark, d, "events", "customer", "supplier")
    k = F.get_json_object("props", "$.k")
    e = F.col("event_id")
    review = {
        "review_id": F.concat(F.lit("R"), e.cast("string")), "user_id": F.concat(F.lit("U"), F.col("user_id").cast("string")),
        "business_id": F.concat(F.lit("B"), k), "useful": F.col("user_id") % 5, "funny": F.lit(0), "cool": F.lit(1),
        "text": F.col("event_type"),
    }
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    if correction:
        rows = events.filter(e % 20 == 3)
        review |= {"stars": F.lit("5"), "date": stamp}
    else:
        rows = events
        stars = F.floor(F.col("value") / 10).cast("string")
        review |= {
            "stars": F.when(e % 25 == 0, "n/a").otherwise(stars), "date": F.when(e % 30 == 1, "unknown").otherwise(stamp),
            "note": F.when(e % 40 == 2, "extra"),
        }
        customer.select(
            F.concat(F.lit("B"), F.col("c_custkey").cast("string")).alias("business_id"), F.col("c_name").alias("name"),
            F.expr(CITY).alias("city"), F.lit("AB").alias("state"), (F.col("c_nationkey") % 5 + 1).cast("double").alias("stars"),
            F.lit(10).alias("review_count"), F.lit(1).alias("is_open"), F.concat_ws(", ", "c_mktsegment", F.lit("All")).alias("categories"),
        ).write.json(lake.path("landing", "business"))
        supplier.select(
            F.concat(F.lit("U"), F.col("s_suppkey").cast("string")).alias("user_id"), F.col("s_name").alias("name"),
            F.lit("2010-01-02 03:04:05").alias("yelping_since"), F.lit(1).alias("review_count"), F.lit(4.0).alias("average_stars"),
            F.lit(1).alias("useful"), F.lit(1).alias("funny"), F.lit(1).alias("cool"), F.lit(0).alias("fans"),
            F.when(F.col("s_suppkey") % 2 == 0, "2019,2020").otherwise("").alias("elite"), F.lit("").alias("friends"),
        ).write.json(lake.path("landing", "user"))
    rows.select(*[c.alias(n) for n, c in review.items()]).write.mode("append").json(lake.path("landing", "review"))


def _reviews(spark, d) -> ReviewLake:
    """Two rounds: all reviews, then corrected reviews for some of them."""
    lake = ReviewLake(spark, scratch_path(spark, "reviews"))
    for correction in (False, True):
        _land_reviews(spark, d, lake, correction)
        lake.run("2024-01-01", DATE_END)
    return lake


REVIEWS = f"""
    e AS (SELECT event_id, user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(ts AS DATE) AS day, floor(value / 10) AS raw_stars, user_id % 5 AS useful,
                 event_id % 20 = 3 AS fixed, event_id % 25 = 0 OR event_id % 40 = 2 AS odd, event_id % 30 = 1 AS bad_date FROM events),
    v AS (SELECT *, NOT odd AND NOT bad_date AND raw_stars BETWEEN 1 AND 5 AS valid FROM e),
    silver AS (SELECT event_id, user_id, k, day, useful, CASE WHEN fixed THEN 5.0 ELSE raw_stars END::DOUBLE AS stars FROM v WHERE valid OR fixed),
    keyed AS (SELECT event_id, valid, fixed, user_id IN (SELECT s_suppkey FROM supplier) AND k IN (SELECT c_custkey FROM customer) AND day <= DATE '{DATE_END}' AS complete FROM v),
    fact AS (SELECT s.* FROM silver s JOIN keyed USING (event_id) WHERE complete),
    business AS (SELECT c_custkey, c_name, CASE c_custkey % 4 WHEN 0 THEN 'Edmonton' WHEN 1 THEN 'St. Albert' WHEN 2 THEN 'Sherwood Park' ELSE c_mktsegment END AS city FROM customer)"""


@query("STR-01 STR-02 STR-03 SRC-13 SNK-08 PRJ-03 SRC-15", """
    SELECT (SELECT count(*) FROM events) + (SELECT count(*) FROM events WHERE event_id % 20 = 3) AS rows,
           (SELECT count(*) FROM events WHERE event_id % 25 = 0 OR event_id % 40 = 2) AS rescued, true AS with_lineage""")
def stream_bronze(spark, d):
    bronze = spark.read.parquet(_reviews(spark, d).path("bronze", "review"))
    lineage = F.col("_input_filename").isNotNull() & F.col("_processing_date").isNotNull() & (F.col("_pipeline_run_id") == "run")
    return bronze.agg(F.count(F.lit(1)).alias("rows"), F.count("_rescued_data").alias("rescued"), F.every(lineage).alias("with_lineage"))


@query("STR-04 MRG-03 SRC-16 UDF-04 JOB-01", f"""
    WITH {REVIEWS} SELECT 'R' || event_id AS review_id, 'U' || user_id AS user_id, 'B' || k AS business_id, strftime(day, '%Y-%m-%d') AS review_date, stars, useful AS review_useful_votes FROM silver""")
def stream_silver(spark, d):
    rows = _reviews(spark, d).table("silver", "review", ["review_id"]).read()
    return rows.select("review_id", "user_id", "business_id", F.col("review_date").cast("string").alias("review_date"), "stars", "review_useful_votes")


@query("STR-05 MRG-07 PRJ-05 JOB-01", f"""
    WITH {REVIEWS} SELECT md5('B' || c_custkey) AS "SK_business_id", 'B' || c_custkey AS "NK_business_id", c_name AS name, city FROM business""")
def stream_dimension(spark, d):
    dim = _reviews(spark, d).table("gold", "dim_business", ["NK_business_id"]).read()
    return dim.select("SK_business_id", "NK_business_id", "name", "city")


@query("STR-06 MRG-17 JON-10 JOB-01", f"""
    WITH {REVIEWS} SELECT 'R' || event_id AS "NK_review_id", md5('B' || k) AS "SK_business_id", md5('U' || user_id) AS "SK_user_id", md5(strftime(day, '%Y%m%d')) AS "SK_date_id", stars FROM fact""")
def stream_fact(spark, d):
    fact = _reviews(spark, d).table("gold", "fact_review", ["NK_review_id"]).read()
    return fact.select("NK_review_id", "SK_business_id", "SK_user_id", "SK_date_id", "stars")


@query("MRG-17 PRJ-04 STR-06 JOB-01", f"""
    WITH {REVIEWS} SELECT 'R' || f.event_id AS "NK_review_id", useful AS review_useful_votes, 0::BIGINT AS review_funny_votes, 1::BIGINT AS review_cool_votes, event_type AS review_text,
      true AS dq_business_key_valid, true AS dq_user_key_valid, true AS dq_date_key_valid, true AS dated FROM fact f JOIN events USING (event_id)""")
def stream_fact_lineage(spark, d):
    """The rest of the review fact: votes, text, key flags, and dates that follow the layers."""
    fact = _reviews(spark, d).table("gold", "fact_review", ["NK_review_id"]).read()
    dated = (F.col("_bronze_processing_date") <= F.col("_silver_processing_date")) & (F.col("_silver_processing_date") <= F.col("fact_created_date"))
    fixed = F.substring("NK_review_id", 2, 20).cast("long") % 20 == 3  # came again: the row was made before that
    return fact.select(
        "NK_review_id", "review_useful_votes", "review_funny_votes", "review_cool_votes", "review_text",
        "dq_business_key_valid", "dq_user_key_valid", "dq_date_key_valid", F.coalesce(dated | (fixed & F.col("fact_created_date").isNotNull()), F.lit(False)).alias("dated"))


@query("DQ-04 DQ-14 STR-04 STR-06 JOB-01", f"""
    WITH {REVIEWS}, q AS (
      SELECT 'silver' AS layer, CASE WHEN odd THEN 'SCHEMA_MISMATCH' WHEN NOT raw_stars BETWEEN 1 AND 5 THEN 'INVALID_VALUE' ELSE 'BUSINESS_RULE' END AS dq_category FROM v WHERE NOT valid
      UNION ALL SELECT 'gold', 'MISSING_KEY' FROM keyed WHERE valid AND NOT complete UNION ALL SELECT 'gold', 'MISSING_KEY' FROM keyed WHERE fixed AND NOT complete)
    SELECT layer, dq_category, count(*) AS issues FROM q GROUP BY 1, 2""")
def stream_quarantine(spark, d):
    return distribution(read_quarantine(spark, _reviews(spark, d).quarantine), "layer", "dq_category", count="issues")


@query("STR-04 DQ-04 JOB-01", """
    WITH t AS (SELECT user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2, 3)
    SELECT 'U' || user_id AS user_id, 'B' || k AS business_id, strftime(day, '%Y-%m-%d') AS tip_date, 'visits: ' || n AS tip_text,
           CASE WHEN n > 1 THEN n ELSE 0 END AS tip_compliment_count FROM t WHERE k % 7 <> 0""")
def stream_tip(spark, d):
    """Tips made from the visits of a user to a business in a day; some lack their text or their count."""
    (events,) = tables(spark, d, "events")
    lake = ReviewLake(spark, scratch_path(spark, "tips"))
    k, n = F.col("k"), F.col("n")
    visits = events.groupBy("user_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    visits.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_id"), F.concat(F.lit("B"), k.cast("string")).alias("business_id"),
        F.when(k % 7 != 0, F.concat(F.lit("visits: "), n.cast("string"))).alias("text"), F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.when(n > 1, n).alias("compliment_count")).write.json(lake.path("landing", "tip"))
    return lake.tips().read().select("user_id", "business_id", F.col("tip_date").cast("string").alias("tip_date"), "tip_text", "tip_compliment_count")


@query("AGG-06 AGG-07 AGG-08 JOB-01", f"""
    WITH {REVIEWS} SELECT city, month(day) AS month, count(*) AS total_reviews, {sql_total('stars')} / count(*) AS avg_stars, sum(useful)::BIGINT AS total_useful_votes,
      count(*) FILTER (WHERE stars = 5) AS five_star_reviews, CAST(count(*) FILTER (WHERE stars = 5) * 100.0::DOUBLE / count(*) AS DOUBLE) AS five_star_pct
    FROM fact JOIN business ON c_custkey = k GROUP BY 1, 2""")
def stream_metrics(spark, d):
    lake = _reviews(spark, d)
    view = replace(REVIEW_METRICS, filter=None, measures={
        **REVIEW_METRICS.measures, "avg_stars": "CAST(sum(CAST(stars AS DECIMAL(18,2))) AS DOUBLE) / count(1)",
        "five_star_pct": "MEASURE(five_star_reviews) * 100D / MEASURE(total_reviews)"})
    parts = {
        "source": lake.table("gold", "fact_review", ["NK_review_id"]).read(),
        "business": lake.table("gold", "dim_business", ["NK_business_id"]).read(),
        "date_dim": spark.read.parquet(lake.path("gold", "dim_date")),
    }
    out = view.query(parts, ["city", "month"], ["total_reviews", "avg_stars", "total_useful_votes", "five_star_reviews", "five_star_pct"])
    return out.withColumn("month", F.col("month").cast("long"))


# ------------------------------------------------------------------- smart grid


def _grid(spark, d):
    """Two rounds of readings on quarter hours, the second with corrections."""
    events, supplier, nation = tables(spark, d, "events", "supplier", "nation")
    lake = GridLake(spark, scratch_path(spark, "grid"))
    slot = F.window("ts", "15 minutes")["start"]
    rows = events.select(
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("meterId"), F.col("value").alias("measurementInKWh"),
        (F.col("user_id") % 30).alias("zipCode"),
        F.when(F.col("event_id") % 40 == 5, "no date").otherwise(F.date_format(slot, "yyyy-MM-dd'T'HH:mm:ss")).alias("measurementDate"),
        (F.col("event_id") % 10 == 0).alias("fix"))
    members = supplier.filter("s_suppkey % 10 <> 0").select(
        F.concat(F.lit("M"), F.col("s_suppkey").cast("string")).alias("meterId"), "s_name",
        row_hash(["s_suppkey"]).alias("_keyHash"), row_hash(["s_name"]).alias("_valueHash"))
    spots = nation.select(F.col("n_nationkey").cast("long").alias("zipCode"), F.col("n_regionkey").alias("latitude"), F.lit(1.0).alias("longitude"))
    spots = spots.withColumns({"_keyHash": row_hash(["zipCode"]), "_valueHash": row_hash(LOCATION_VALUES)})
    meters = materialise(load_dimension(None, members, ["meterId"]))
    places = materialise(load_dimension(None, spots, ["zipCode"]))
    dates = materialise(lake.dates("2024-01-01", "2024-01-31"))
    for fix in (False, True):
        part = rows.filter("fix").withColumn("measurementInKWh", F.lit(10.0)) if fix else rows
        # All readings of a meter land in one file, as they come from one device.
        part.drop("fix").repartition(4, "meterId").write.mode("append").json(lake.path("landing", "readings"))
        size_shuffles(spark, spark.read.text(lake.path("landing", "readings")))
        lake.bronze()
        lake.silver()
        lake.fact(meters, places, dates)
    return lake, meters, places, dates


GRID = """
    e AS (SELECT user_id, user_id % 30 AS zip, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, value, event_id % 10 = 0 AS fix FROM events WHERE event_id % 40 <> 5),
    readings AS (SELECT user_id, zip, slot, CASE WHEN bool_or(fix) THEN 10.0 ELSE min(value) FILTER (WHERE value BETWEEN 5 AND 20) END::DOUBLE AS kwh FROM e GROUP BY 1, 2, 3
                 HAVING bool_or(fix) OR count(*) FILTER (WHERE value BETWEEN 5 AND 20) > 0),
    m AS (SELECT s_suppkey, row_number() OVER (ORDER BY 'M' || s_suppkey) - 1 AS sid FROM supplier WHERE s_suppkey % 10 <> 0),
    z AS (SELECT n_nationkey, n_regionkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS sid FROM nation)"""


@query("STR-04 STR-08 MRG-05 WIN-02 DQ-06 JOB-03", f"""
    WITH {GRID} SELECT 'M' || user_id AS meter, zip, strftime(slot, '%Y-%m-%d %H:%M:%S') AS at, kwh FROM readings""")
def grid_silver(spark, d):
    lake, *_ = _grid(spark, d)
    from strata.plans.smartgrid import READING_KEYS
    from strata.sinks import SnapshotTable

    rows = SnapshotTable(spark, lake.path("silver", "readings"), READING_KEYS).read()
    return rows.select(F.col("meterId").alias("meter"), F.col("zipCode").alias("zip"),
                       F.date_format("measurementDate", "yyyy-MM-dd HH:mm:ss").alias("at"), F.col("measurementInKWh").cast("double").alias("kwh"))


def _grid_fact(spark, d):
    from strata.sinks import SnapshotTable

    lake, meters, places, dates = _grid(spark, d)
    return SnapshotTable(spark, lake.path("gold", "fact_consumption"), ["_keyHash"]).read(), meters, places, dates


@query("STR-06 MRG-18 MRG-06 JON-11 MRG-16 JOB-03", f"""
    WITH {GRID} SELECT coalesce(m.sid, -1) AS "meterSid", coalesce(z.sid, -1) AS "serviceLocationSid", strftime(slot, '%Y%m%d') AS "measurementDateSid",
      strftime(slot, '%H%M%S') AS "measurementTimeSid", kwh AS "powerConsumptedKwh" FROM readings LEFT JOIN m ON s_suppkey = user_id LEFT JOIN z ON n_nationkey = zip""")
def grid_fact(spark, d):
    fact, *_ = _grid_fact(spark, d)
    return fact.drop("_keyHash", "_valueHash").withColumn("powerConsumptedKwh", F.col("powerConsumptedKwh").cast("double"))


@query("AGG-18 JON-12 JOB-03", f"""
    WITH {GRID} SELECT n_nationkey AS "zipCode", n_regionkey AS latitude, {sql_total('kwh')} AS total_kwh FROM readings JOIN z ON n_nationkey = zip GROUP BY 1, 2""")
def grid_usage_by_place(spark, d):
    fact, _, places, _ = _grid_fact(spark, d)
    return usage_by_place(fact, places).select(F.col("zipCode").cast("int").alias("zipCode"), "latitude", F.col("total_kwh").cast("double").alias("total_kwh"))


@query("AGG-19 JON-12 JOB-03", f"""
    WITH {GRID} SELECT n_nationkey AS zip, strftime(slot, '%Y-%m-%d') AS day, (2 * CAST(sum(CAST(kwh AS DECIMAL(18,2))) * 10000 AS BIGINT) + count(*)) // (2 * count(*)) / 10000.0::DOUBLE AS avg_consumption
    FROM readings JOIN m ON s_suppkey = user_id JOIN z ON n_nationkey = zip GROUP BY 1, 2""")
def grid_daily_average(spark, d):
    fact, meters, places, dates = _grid_fact(spark, d)
    out = daily_average_by_place(fact, meters, places, dates)
    return out.select(F.col("zipCode").cast("int").alias("zip"), F.col("calendarDate").cast("string").alias("day"),
                      F.round(F.col("avg_consumption").cast("double"), 4).alias("avg_consumption"))


MASTER = """
    m AS (SELECT s_suppkey, late, class, efficiency, row_number() OVER (ORDER BY late, 'M' || s_suppkey) - 1 AS sid FROM (
      SELECT s_suppkey, s_suppkey % 7 = 3 AS late, CASE s_suppkey % 4 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Large' END AS class,
             CASE WHEN s_suppkey % 5 = 0 THEN 50 ELSE 75 END / 100.0::DOUBLE AS efficiency FROM supplier) WHERE class IS NOT NULL)"""


def _grid_job(spark, d) -> GridLake:
    """The whole grid job twice. Round two brings other efficiencies, meters that
    were not known before, and the readings of every second quarter hour."""
    events, supplier, nation = tables(spark, d, "events", "supplier", "nation")
    lake = GridLake(spark, scratch_path(spark, "grid-job"))
    key, late = F.col("s_suppkey"), F.col("s_suppkey") % 7 == 3
    kinds = F.array(*[F.lit(c) for c in ("Small", "Medium", "Large", "Huge")])
    slot = F.window("ts", "15 minutes")["start"]
    readings = events.select(
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("meterId"), F.col("value").alias("measurementInKWh"), (F.col("user_id") % 30).alias("zipCode"),
        F.date_format(slot, "yyyy-MM-dd'T'HH:mm:ss").alias("measurementDate"), (F.unix_timestamp(slot) / 900 % 2).cast("int").alias("round"))
    for number in (0, 1):
        changed = F.lit(number == 1) & (key % 5 == 0)
        supplier.filter(~late | F.lit(number == 1)).select(
            F.concat(F.lit("M"), key.cast("string")).alias("meterId"), F.col("s_name").alias("MeterLocation"), key.alias("MeterNumber"),
            kinds[(key % 4).cast("int")].alias("class"), F.lit(20).alias("maxKwh"), F.when(changed, 50).otherwise(75).alias("efficiencyPercentage"),
            F.lit("High").alias("envImpact"), F.lit(5).alias("startupTimeMin"),
        ).write.mode("append").option("header", True).csv(lake.path("landing", "meters"))
        nation.select(
            F.col("n_nationkey").alias("ZipCode"), F.when(F.col("n_nationkey") % 10 == 9, "n/a").otherwise(F.col("n_regionkey").cast("string")).alias("Lat"), F.lit("-1.25").alias("Long"),
        ).write.mode("append").option("header", True).csv(lake.path("landing", "places"))
        # All readings of a meter land in one file, as they come from one device.
        readings.filter(F.col("round") == number).drop("round").repartition("meterId").write.mode("append").json(lake.path("landing", "readings"))
        lake.run("2024-01-01", "2024-01-31")
    return lake


@query("JOB-03 MRG-06 MRG-11 SRC-03 PRJ-12", f"""
    WITH {MASTER} SELECT sid, 'M' || s_suppkey AS "meterId", class, efficiency FROM m""")
def grid_meters(spark, d):
    """Meters through bronze, silver and gold: known ones keep their key, new ones get the next."""
    from strata.sinks import SnapshotTable

    dim = SnapshotTable(spark, _grid_job(spark, d).path("gold", "dim_meters"), ["meterId"]).read()
    return dim.select("sid", "meterId", "class", F.col("efficiencyPercentage").cast("double").alias("efficiency"))


@query("JOB-03 JON-12 MRG-18 AGG-18", f"""
    WITH {MASTER}, r AS (SELECT user_id, user_id % 30 AS zip, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, min(value) AS kwh FROM events WHERE value BETWEEN 5 AND 20 GROUP BY ALL)
    SELECT coalesce(class, 'unknown') AS class, n_regionkey::DOUBLE AS latitude, count(*) AS rows, {sql_total('kwh')} AS total_kwh
    FROM r LEFT JOIN m ON s_suppkey = user_id AND (NOT late OR CAST(epoch(slot) AS BIGINT) // 900 % 2 = 1) LEFT JOIN nation ON n_nationkey = zip AND n_nationkey % 10 <> 9 GROUP BY 1, 2""")
def grid_job(spark, d):
    """Usage by class of meter and latitude, after both rounds of the whole job."""
    from strata.sinks import SnapshotTable

    lake = _grid_job(spark, d)
    fact = SnapshotTable(spark, lake.path("gold", "fact_consumption"), ["_keyHash"]).read()
    meters = SnapshotTable(spark, lake.path("gold", "dim_meters"), ["meterId"]).read().select(F.col("sid").alias("meterSid"), "class")
    places = SnapshotTable(spark, lake.path("gold", "dim_places"), ["zipCode"]).read().select(F.col("sid").alias("serviceLocationSid"), "latitude")
    rows = fact.join(meters, "meterSid", "left").join(places, "serviceLocationSid", "left")
    return rows.groupBy(F.coalesce("class", F.lit("unknown")).alias("class"), "latitude").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("powerConsumptedKwh").cast("double").alias("total_kwh"))


# ------------------------------------------------------------- batch silver


def _batch_silver(spark, d):
    """The four datasets as JSON made from customers, suppliers and events, and the batch job over them."""
    customer, supplier, events = tables(spark, d, "customer", "supplier", "events")
    root = scratch_path(spark, "batch")
    k, cycle = F.col("c_custkey"), lambda *v: F.element_at(F.array(*[F.lit(x) for x in v]), (F.col("c_custkey") % len(v) + 1).cast("int"))
    customer.select(
        F.concat(F.lit("B"), k.cast("string")).alias("business_id"), F.col("c_name").alias("name"), F.lit("Edmonton").alias("city"), F.lit("AB").alias("state"),
        F.lit(1.5).alias("latitude"), F.lit(2.5).alias("longitude"), (k % 9 / 2).alias("stars"), k.alias("review_count"),
        cycle("Food,  Bars", "", " Shops ", None).alias("categories"),
        F.struct(cycle("1", "2", "n/a", None, "4").alias("RestaurantsPriceRange2"), cycle("True", "False", "None").alias("WheelchairAccessible"), cycle(None, "True").alias("DriveThru"),
                 F.lit("False").alias("RestaurantsTakeOut"), cycle("u'free'", "'paid'", "u'no'", None).alias("WiFi")).alias("attributes"),
    ).write.json(f"{root}/landing/business")
    supplier.select(
        F.concat(F.lit("U"), F.col("s_suppkey").cast("string")).alias("user_id"), F.col("s_name").alias("name"), F.lit("2010-01-02 03:04:05").alias("yelping_since"), F.lit(3).alias("review_count"),
        F.lit(1).alias("useful"), F.lit(2).alias("funny"), F.lit(3).alias("cool"), F.lit(4.0).alias("average_stars"), F.when(F.col("s_suppkey") % 2 == 0, "2019,2020").otherwise(" ").alias("elite"),
    ).write.json(f"{root}/landing/user")
    stamp = F.when(F.col("event_id") % 30 == 1, "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    ids = [F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_id"), F.concat(F.lit("B"), F.get_json_object("props", "$.k")).alias("business_id"), stamp.alias("date"), F.col("event_type").alias("text")]
    events.select(F.concat(F.lit("R"), F.col("event_id").cast("string")).alias("review_id"), *ids, F.floor(F.col("value") / 10).alias("stars"),
                  (F.col("user_id") % 5).alias("useful"), F.lit(0).alias("funny"), F.lit(1).alias("cool")).write.json(f"{root}/landing/review")
    events.select(*ids, F.when(F.col("event_id") % 7 > 0, F.col("event_id") % 7).alias("compliment_count")).write.json(f"{root}/landing/tip")
    return batch_silver(spark, f"{root}/landing", f"{root}/silver")


@query("JOB-02 PRJ-06 PRJ-07 PRJ-08", """
    SELECT 'B' || c_custkey AS business_id, CASE c_custkey % 4 WHEN 0 THEN 'Food|Bars' WHEN 2 THEN 'Shops' END AS categories,
      CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 4 THEN 4 END AS price_range, CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS wheelchair,
      CASE WHEN c_custkey % 2 = 1 THEN true END AS drive_thru, false AS take_out, CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS free_wifi FROM customer""")
def batch_silver_businesses(spark, d):
    rows = _batch_silver(spark, d)["business"]
    return rows.select("business_id", F.array_join("categories", "|").alias("categories"), F.col("priceRange").alias("price_range"), F.col("wheelchairAccessible").alias("wheelchair"),
                       F.col("driveThru").alias("drive_thru"), F.col("takeOut").alias("take_out"), F.col("freeWifi").alias("free_wifi"))


@query("JOB-02 PRJ-09 PRJ-10", """
    WITH e AS (SELECT event_id, user_id, value, event_id % 30 <> 1 AS dated, CAST(ts AS DATE) AS day FROM events)
    SELECT 'U' || user_id AS user_id, CASE WHEN user_id % 2 = 0 AND user_id IN (SELECT s_suppkey FROM supplier) THEN 2 WHEN user_id IN (SELECT s_suppkey FROM supplier) THEN 0 END AS elite_years,
      count(*) AS reviews, count(*) FILTER (WHERE dated) AS dated, count(DISTINCT CASE WHEN dated THEN day END) AS days, sum(floor(value / 10))::DOUBLE AS stars,
      count(*) FILTER (WHERE event_id % 7 >= 3) AS popular_tips FROM e GROUP BY user_id""")
def batch_silver_users(spark, d):
    """Reviews and tips of the batch silver layer per user, with the users' elite years."""
    silver = _batch_silver(spark, d)
    reviews = silver["review"].groupBy("user_id").agg(
        F.count(F.lit(1)).alias("reviews"), F.count("review_date").alias("dated"), F.countDistinct("review_date").alias("days"), F.sum("stars").alias("stars"))
    tips = silver["tip"].groupBy("user_id").agg(F.count_if("is_popular_tip").alias("popular_tips"))
    return reviews.join(tips, "user_id").join(silver["user"].select("user_id", F.col("elite_year_count").alias("elite_years")), "user_id", "left")


# ------------------------------------------------------------- growing schemas


@query("SRC-14 STR-01 JOB-01", """
    SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 <> 5 THEN o_totalprice::DOUBLE END AS price, o_custkey AS customer, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status,
      CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority, CASE WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS last_change,
      CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 10 = 5 THEN 'n/a' END AS odd_price FROM orders""")
def stream_evolving(spark, d):
    """Half of the orders land; then the rest, with a new field, new fields inside
    known ones, and prices that are no numbers. Both rounds share one checkpoint."""
    (orders,) = tables(spark, d, "orders")
    root = scratch_path(spark, "evolving")
    key, odd = F.col("o_orderkey"), F.col("o_orderkey") % 10 == 5
    base = {"id": key, "price": F.col("o_totalprice").cast("double")}
    rounds = [
        orders.filter(key % 2 == 0).select(F.to_json(F.struct(*[c.alias(n) for n, c in base.items()], F.struct(F.col("o_custkey").alias("key")).alias("customer"),
                                                             F.array(F.struct(F.lit(1).alias("v"))).alias("changes")))),
        orders.filter(key % 2 == 1).select(F.to_json(F.struct(
            key.alias("id"), F.when(odd, "n/a").otherwise(F.col("o_totalprice").cast("double").cast("string")).alias("price"), F.col("o_orderstatus").alias("status"),
            F.struct(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("priority")).alias("customer"),
            F.array(F.struct(F.lit(2).alias("v"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))).alias("changes")))),
    ]
    restarts = []
    for lines in rounds:
        lines.toDF("value").repartition(4).write.mode("append").text(f"{root}/landing")
        restarts.append(ingest_evolving(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", f"{root}/schema", "run", max_files=2))
    if restarts != [1, 1]:
        raise AssertionError(f"each round widens the schema once, not {restarts}")
    rows = read_evolving(spark, f"{root}/bronze", f"{root}/schema")
    return rows.select(
        "id", "price", F.col("customer.key").alias("customer"), "status", F.col("customer.priority").alias("priority"),
        F.col("changes")[0]["day"].alias("last_change"), F.get_json_object("_rescued_data", "$.price").alias("odd_price"))


@query("JOB-01 SRC-14 MRG-17", f"""
    WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, floor(value / 10) AS stars, event_id % 25 = 0 AS odd, event_id % 30 = 1 AS bad_date, event_id % 40 = 2 AS noted, event_id % 20 = 3 AS fixed FROM events),
    v AS (SELECT *, NOT odd AND NOT bad_date AND stars BETWEEN 1 AND 5 AS valid FROM e)
    SELECT noted, count(*) AS rows, sum(CASE WHEN fixed THEN 5 ELSE stars END)::DOUBLE AS stars FROM v WHERE valid OR fixed GROUP BY 1""")
def stream_reviews_evolving(spark, d):
    """The review job with a bronze layer that takes new fields in: reviews with a note pass instead of being quarantined."""
    lake = ReviewLake(spark, scratch_path(spark, "reviews"), evolve=True)
    for correction in (False, True):
        _land_reviews(spark, d, lake, correction)
        lake.run("2024-01-01", DATE_END)
    noted = read_evolving(spark, lake.path("bronze", "review"), lake.path("schemas", "review")).filter("note IS NOT NULL").select("review_id").distinct().withColumn("noted", F.lit(True))
    rows = lake.table("silver", "review", ["review_id"]).read().join(noted, "review_id", "left")
    return rows.groupBy(F.coalesce("noted", F.lit(False)).alias("noted")).agg(F.count(F.lit(1)).alias("rows"), F.sum("stars").alias("stars"))


# ------------------------------------------------------------- stream mechanics


@query("STR-07 STR-11 SRC-13 STR-02 STR-03", """
    SELECT count(*) AS rows, count(*) AS streamed, 0::BIGINT AS streamed_again FROM events""")
def stream_restart(spark, d):
    """A stream with a file cap runs twice on one checkpoint: the second run
    finds nothing new."""
    (events,) = tables(spark, d, "events")
    root = scratch_path(spark, "restart")
    schema = StructType.fromDDL("event_id long, user_id long, event_type string, value double")
    files = max(6, -(-plan_bytes(events) // (128 << 20)))
    events.select(*schema.fieldNames()).repartition(files).write.json(f"{root}/landing")
    counts = []
    for _ in range(2):
        q = write_stream(stream_json(spark, f"{root}/landing", schema, max_files=2), f"{root}/out", f"{root}/checkpoint", f"restart_{len(counts)}")
        q.awaitTermination()
        counts.append(sum(n for _, _, n in batch_counts(q)))
    return spark.read.parquet(f"{root}/out").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(counts[0]).cast("long").alias("streamed"), F.lit(counts[1]).cast("long").alias("streamed_again"))


LATE = """
    b AS (SELECT min(ts) + 0.4 * (max(ts) - min(ts)) AS one, min(ts) + 0.7 * (max(ts) - min(ts)) AS two, max(ts) AS three FROM events),
    l AS (SELECT e.*, b.*, CASE WHEN ts <= one AND event_id % 10 <> 3 THEN 1 WHEN ts <= two AND event_id % 10 <> 3 THEN 2 ELSE 3 END AS landing FROM events e, b),
    m AS (SELECT max(ts) FILTER (WHERE landing <= 2) AS before_third, max(ts) FILTER (WHERE landing = 1) AS before_second, max(ts) AS last FROM l),
    s AS (SELECT l.ts, l.value, m.last, coalesce(l.ts < CASE landing WHEN 2 THEN before_second WHEN 3 THEN before_third END - INTERVAL 30 MINUTE, false) AS late FROM l, m)"""


@query("STR-10 STR-07", f"""
    WITH {LATE}, w AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS bucket, count(*) AS rows, {sql_total('value')} AS amount FROM s, (SELECT max(last) AS top FROM s) t
      WHERE NOT late GROUP BY 1, top HAVING time_bucket(INTERVAL 15 MINUTE, min(ts)) + INTERVAL 15 MINUTE <= top - INTERVAL 30 MINUTE)
    SELECT strftime(bucket, '%Y-%m-%d %H:%M') AS bucket_start, rows, amount FROM w
    UNION ALL SELECT 'late', count(*), {sql_total('value')} FROM s WHERE late""")
def quarter_hours_stream(spark, d):
    """Quarter hours as a stream over three landings on one checkpoint: the third
    brings rows that are late by days, which stay in a table of their own."""
    (events,) = tables(spark, d, "events")
    root = scratch_path(spark, "windows")
    schema = StructType.fromDDL("event_id long, ts timestamp, value double")
    first, last = (f.cast("timestamp") for f in (F.min("ts"), F.max("ts")))
    at = lambda share: F.timestamp_micros((F.unix_micros(first) + share * (F.unix_micros(last) - F.unix_micros(first))).cast("long"))
    one, two = events.agg(at(0.4).alias("one"), at(0.7).alias("two")).first()
    ts, held = F.col("ts").cast("timestamp"), F.col("event_id") % 10 == 3
    landing = F.when((ts <= F.lit(one)) & ~held, 1).when((ts <= F.lit(two)) & ~held, 2).otherwise(3)
    rows = events.select("event_id", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ts"), "value", landing.alias("landing"))
    rows = materialise(rows, "landings")
    for number in (1, 2, 3):
        rows.filter(F.col("landing") == number).drop("landing").write.mode("append").json(f"{root}/landing")
        stream = WindowedStream(spark, root, schema, "ts")
        stream.run(f"{root}/landing", amount=F.sum(F.col("value").cast("decimal(18,2)")))
    windows = stream.windows().select(F.date_format("bucket_start", "yyyy-MM-dd HH:mm").alias("bucket_start"), "rows", F.col("amount").cast("double").alias("amount"))
    late = stream.late().agg(F.lit("late").alias("bucket_start"), F.count(F.lit(1)).alias("rows"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("amount"))
    return windows.unionByName(late)


@query("DQ-05 STR-11 STR-04", f"""
    WITH {REVIEWS}, c AS (SELECT count(*) FILTER (WHERE odd) AS schema_failed, count(*) FILTER (WHERE NOT odd AND NOT valid) AS rule_failed, count(*) FILTER (WHERE valid) AS passed, count(*) FILTER (WHERE fixed) AS again FROM v)
    SELECT schema_failed, rule_failed, passed + again AS passed FROM c""")
def stream_route_counts(spark, d):
    """Counters observed in the pass that quarantines, of all batches of both rounds."""
    counts = read_route_counts(spark, _reviews(spark, d).quarantine, "silver_review")
    return counts.agg(*[F.sum(c).alias(c) for c in ("schema_failed", "rule_failed", "passed")])


@query("STR-10", f"""
    SELECT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M') AS bucket_start, count(*) AS rows, {sql_total('value')} AS amount FROM events GROUP BY 1""")
def quarter_hours(spark, d):
    (events,) = tables(spark, d, "events")
    buckets = bucket_15min(events, "ts", amount=F.sum(F.col("value").cast("decimal(18,2)")))
    return buckets.select(F.date_format("bucket_start", "yyyy-MM-dd HH:mm").alias("bucket_start"), "rows", F.col("amount").cast("double").alias("amount"))
