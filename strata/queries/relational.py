"""Projections, filters, joins, aggregations, ranking and set operations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import cleaning as C
from strata.functions.dates import time_parts
from strata.operators import aggregates as A
from strata.operators import joins as J
from strata.operators import projections as P
from strata.operators import windows as Win
from strata.operators.dimensions import dim_date
from strata.operators.quality import reconcile
from strata.plans.metric_view import Join, MetricView
from strata.plans.questions import latest_extracts, monthly_reviews, most_reviewed_ranked, run_named, top_businesses
from strata.plans.sales import sales_report
from strata.plans.trips import top_by_ratio_per_weekday
from strata.queries.registry import mean, money, query, sql_mean, sql_total, text, total
from strata.session import broadcast_if_small, materialise, scratch_path
from strata.sources import tables

SQL_PROFIT = "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE)"


def line_profit():
    return money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")


# ---------------------------------------------------------------- ranking


@query("WIN-03 AGG-22 PRJ-13 PRJ-14 SRC-05 JOB-06", """
    WITH r AS (
      SELECT l_partkey, dayofweek(o_orderdate) + 1 AS day_of_week,
             round(avg(CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity END), 6) AS avg_ratio
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY day_of_week ORDER BY avg_ratio DESC NULLS LAST, l_partkey) AS rank FROM r)
    WHERE rank <= 10""")
def top_parts_by_weekday(spark, d):
    orders, lineitem = tables(spark, d, "orders", "lineitem")
    trips = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
    return top_by_ratio_per_weekday(trips, "o_orderdate", "l_partkey", "l_extendedprice", "l_quantity", 10, digits=6)


def _business(spark, d) -> DataFrame:
    """Customers as businesses: city from the nation, rating from the balance."""
    customer, orders, nation = tables(spark, d, "customer", "orders", "nation")
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("review_count"))
    return (
        customer.join(counts, customer["c_custkey"] == counts["o_custkey"], "left")
        .join(broadcast_if_small(nation), customer["c_nationkey"] == nation["n_nationkey"])
        .select(
            F.col("c_custkey").alias("business_id"), F.col("c_name").alias("name"), F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("state"), F.col("c_acctbal").alias("latitude"),
            (-F.col("c_acctbal")).alias("longitude"), (F.floor(F.col("c_acctbal") / 1000) / 2).alias("stars"),
            "review_count", F.array("c_mktsegment", F.lit("All")).alias("categories"),
        )
    )


BUSINESS = """
    business AS (
      SELECT c_custkey AS business_id, c_name AS name, n_name AS city, c_mktsegment AS state, c_acctbal AS latitude,
             -c_acctbal AS longitude, floor(c_acctbal / 1000) / 2 AS stars, n.review_count, [c_mktsegment, 'All'] AS categories
      FROM customer JOIN nation ON n_nationkey = c_nationkey
      LEFT JOIN (SELECT o_custkey, count(*) AS review_count FROM orders GROUP BY 1) n ON n.o_custkey = c_custkey)"""


@query("WIN-04 JOB-07", f"""
    WITH {BUSINESS}, ranked AS (
      SELECT *, rank() OVER (ORDER BY stars DESC, review_count DESC) AS rnk FROM business
      WHERE city = 'NATION_3' AND stars IS NOT NULL)
    SELECT business_id, name, latitude, longitude, city, state, stars, review_count FROM ranked WHERE rnk <= 5""")
def top_businesses_with_ties(spark, d):
    return top_businesses(_business(spark, d), "NATION_3", 5)


@query("WIN-05 SRT-01 JOB-07", f"""
    WITH {BUSINESS}
    SELECT business_id, name, latitude, longitude, city, state, stars, review_count FROM business
    WHERE city = 'NATION_3' AND stars IS NOT NULL ORDER BY stars DESC, review_count DESC NULLS LAST, business_id LIMIT 5""")
def top_businesses_rows(spark, d):
    return top_businesses(_business(spark, d), "NATION_3", 5, with_ties=False)


@query("WIN-04", """
    SELECT c_custkey, stars, rank FROM (
      SELECT c_custkey, floor(c_acctbal / 2000) AS stars, rank() OVER (ORDER BY floor(c_acctbal / 2000) DESC) AS rank FROM customer)
    WHERE rank <= 5""")
def ranked_customers_ties(spark, d):
    (customer,) = tables(spark, d, "customer")
    rated = customer.select("c_custkey", F.floor(F.col("c_acctbal") / 2000).cast("double").alias("stars"))
    return Win.top_k_ranked(rated, [("stars", "desc")], 5).select("c_custkey", "stars", F.col("rank").cast("long").alias("rank"))


@query("WIN-04", """
    SELECT l_returnflag, l_linestatus, l_quantity, rank, count(*) AS rows FROM (
      SELECT l_returnflag, l_linestatus, l_quantity,
             rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_quantity DESC) AS rank FROM lineitem)
    WHERE rank <= 400 GROUP BY ALL""")
def ranked_lines_per_group(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    top = Win.top_k_ranked(lineitem, [("l_quantity", "desc")], 400, group=["l_returnflag", "l_linestatus"])
    return top.groupBy("l_returnflag", "l_linestatus", "l_quantity", F.col("rank").cast("long").alias("rank")).agg(
        F.count(F.lit(1)).alias("rows"))


@query("WIN-05", """
    SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rank
    FROM part QUALIFY rank <= 20""")
def top_k_rows(spark, d):
    (part,) = tables(spark, d, "part")
    top = Win.top_k_rows(part.select("p_partkey", "p_retailprice"), [F.desc("p_retailprice"), F.asc("p_partkey")], 20)
    return top.withColumn("rank", F.col("rank").cast("long"))


@query("WIN-01", """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_event_per_user(spark, d):
    (events,) = tables(spark, d, "events")
    rows = events.select("user_id", "event_id", "event_type", "value", "ts")
    return Win.latest_per_key(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("WIN-02", """
    SELECT user_id, event_type, day, value, event_id FROM (
      SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events)
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY date_trunc('hour', ts) DESC, value, event_id) = 1""")
def latest_event_second_order(spark, d):
    (events,) = tables(spark, d, "events")
    rows = events.select("user_id", "event_type", text("ts").alias("day"), "value", "event_id", F.date_trunc("hour", "ts").alias("h"))
    return Win.latest_per_key(rows, ["user_id", "event_type", "day"], [F.desc("h"), F.asc("value"), F.asc("event_id")]).drop("h")


@query("WIN-06 TXT-06", """
    SELECT conv_id, turn, rank, text FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role) AS rank FROM conversations)
    WHERE rank <= 9""")
def latest_texts(spark, d):
    (conversations,) = tables(spark, d, "conversations")
    newest = Win.latest_texts(conversations, "conv_id", [F.desc("turn"), F.asc("role")], 9)
    return newest.select("conv_id", "turn", F.col("rank").cast("long").alias("rank"), "text")


@query("WIN-06 TXT-06 JOB-07", """
    SELECT c.conv_id AS business_id, turn, text
    FROM conversations c
    WHERE c.conv_id = (SELECT conv_id FROM conversations GROUP BY 1 ORDER BY count(*) DESC, conv_id LIMIT 1)
    ORDER BY turn DESC, role LIMIT 9""")
def latest_texts_of_one(spark, d):
    (conversations,) = tables(spark, d, "conversations")
    rows = conversations.withColumnRenamed("conv_id", "business_id")
    busiest = rows.groupBy("business_id").count().orderBy(F.desc("count"), "business_id").limit(1).select("business_id")
    return latest_extracts(rows, busiest.scalar(), "turn", "role").select("business_id", "turn", "text")


@query("SRT-01 JOB-07", f"""
    WITH {BUSINESS} SELECT business_id, name, latitude, longitude, city, state, review_count FROM business
    WHERE review_count IS NOT NULL ORDER BY review_count DESC, business_id LIMIT 5""")
def most_reviewed(spark, d):
    return run_named(spark, "most_reviewed", {"business": _business(spark, d)})


@query("WIN-04 JOB-07", f"""
    WITH {BUSINESS}, r AS (SELECT *, rank() OVER (ORDER BY review_count DESC) AS rnk FROM business WHERE review_count IS NOT NULL)
    SELECT business_id, name, review_count FROM r WHERE rnk <= 5""")
def most_reviewed_with_ties(spark, d):
    return most_reviewed_ranked(_business(spark, d), 5)


@query("SRT-02", "SELECT count(*) AS rows FROM (SELECT * FROM lineitem LIMIT 100)")
def plain_limit(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    return lineitem.limit(100).agg(F.count(F.lit(1)).alias("rows"))


@query("SRT-01", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top_k_orders(spark, d):
    (orders,) = tables(spark, d, "orders")
    return orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


# ------------------------------------------------------ projections, filters


@query("PRJ-01 PRJ-15", f"""
    SELECT nkInvoiceId, count(*) AS lines, {sql_total('quantity')} AS quantity, {sql_total('totalBeforeTax')} AS totalBeforeTax
    FROM (SELECT l_orderkey AS nkInvoiceId, l_quantity AS quantity, l_extendedprice * l_quantity AS totalBeforeTax FROM lineitem)
    GROUP BY 1""")
def project_lines(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    lines = P.project(lineitem, {
        "nkInvoiceId": "l_orderkey", "quantity": "l_quantity", "unitPrice": "l_extendedprice",
    }).withColumn("totalBeforeTax", F.col("unitPrice") * F.col("quantity")).drop("unitPrice")
    return lines.groupBy("nkInvoiceId").agg(
        F.count(F.lit(1)).alias("lines"), total("quantity").alias("quantity"), total("totalBeforeTax").alias("totalBeforeTax"))


@query("PRJ-02", "SELECT * EXCLUDE (p_brand, p_type) FROM part")
def select_except(spark, d):
    (part,) = tables(spark, d, "part")
    return P.select_except(part, ["p_brand", "p_type"])


CITY = """CASE c_custkey % 7 WHEN 0 THEN 'EDMONTON ' || c_mktsegment WHEN 1 THEN 'edmont' WHEN 2 THEN 'St.  Albert'
          WHEN 3 THEN 'Staint Albert' WHEN 4 THEN 'SHERWOOD' WHEN 5 THEN c_mktsegment END"""


@query("PRJ-05 FLT-07", f"""
    WITH c AS (SELECT {CITY} AS city FROM customer)
    SELECT city, CASE WHEN lower(city) LIKE '%edmont%' THEN 'Edmonton'
                      WHEN regexp_matches(lower(city), 'st[\\s\\.]*alb|saint alb|staint alb') THEN 'St. Albert'
                      WHEN regexp_matches(lower(city), 'sherwood park|sherwood') THEN 'Sherwood Park' ELSE city END AS city_standardized,
           count(*) AS rows
    FROM c GROUP BY 1, 2""")
def city_rules(spark, d):
    (customer,) = tables(spark, d, "customer")
    rows = customer.select(F.expr(CITY).alias("city")).withColumn("city_standardized", C.normalize_by_rules("city"))
    return A.distribution(rows, "city", "city_standardized", count="rows")


@query("PRJ-06 PRJ-07 JOB-02", """
    WITH b AS (
      SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'False' ELSE 'None' END AS take_out,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'u''free''' WHEN '2-HIGH' THEN '''paid''' WHEN '3-MEDIUM' THEN 'u''unpaid'''
                                  WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'no' END AS wifi FROM orders)
    SELECT o_orderkey, TRY_CAST(take_out AS BOOLEAN) AS take_out,
           CASE replace(replace(wifi, 'u', ''), '''', '') WHEN 'free' THEN true WHEN 'paid' THEN false END AS free_wifi FROM b""")
def flatten_attributes(spark, d):
    (orders,) = tables(spark, d, "orders")
    nested = orders.select("o_orderkey", F.struct(
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'False' ELSE 'None' END").alias("TakeOut"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "u'free'").when(F.col("o_orderpriority") == "2-HIGH", "'paid'")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "u'unpaid'").when(F.col("o_orderpriority") == "5-LOW", "no").alias("WiFi"),
    ).alias("attributes"))
    return nested.select("o_orderkey", C.try_bool("attributes.TakeOut").alias("take_out"),
                         C.unquote_flag("attributes.WiFi", "free", "paid").alias("free_wifi"))


LISTED = "CASE WHEN p_partkey % 5 = 0 THEN '  ' WHEN p_partkey % 11 = 0 THEN NULL ELSE replace(p_name, ' ', ', ') || ',' || p_brand END"


@query("PRJ-08 PRJ-09", f"""
    WITH p AS (SELECT p_partkey, {LISTED} AS tags FROM part)
    SELECT p_partkey, CASE WHEN trim(tags) <> '' THEN array_to_string(string_split_regex(trim(tags), ',\\s*'), '|') END AS items,
           CASE WHEN trim(tags) <> '' THEN len(string_split_regex(trim(tags), ',\\s*')) ELSE 0 END AS n_items FROM p""")
def split_lists(spark, d):
    (part,) = tables(spark, d, "part")
    rows = part.select("p_partkey", F.expr(LISTED).alias("tags"))
    return rows.select("p_partkey", F.array_join(C.split_list("tags"), "|").alias("items"),
                       C.list_count("tags").cast("long").alias("n_items"))


@query("PRJ-10 PRJ-11", """
    SELECT user_id, sum(CASE WHEN n >= 3 THEN 1 ELSE 0 END)::BIGINT AS popular, sum(n)::BIGINT AS compliments FROM (
      SELECT user_id, coalesce(CASE WHEN value < 60 THEN floor(value / 10) END, 0)::BIGINT AS n FROM events) GROUP BY 1""")
def popular_flag(spark, d):
    (events,) = tables(spark, d, "events")
    tips = events.select("user_id", F.when(F.col("value") < 60, F.floor(F.col("value") / 10)).alias("compliment_count"))
    tips = tips.withColumn("n", F.coalesce("compliment_count", F.lit(0)))
    return tips.groupBy("user_id").agg(F.count_if(C.at_least("n", 3)).alias("popular"), F.sum("n").alias("compliments"))


@query("PRJ-12", """
    SELECT p_partkey, CAST(CAST(p_size AS DECIMAL(16,6)) / 100 AS DOUBLE) AS fraction,
           CAST(CAST(p_retailprice AS DECIMAL(10,4)) AS DOUBLE) AS price, TRY_CAST(p_name AS INTEGER) AS name_number FROM part""")
def cast_layout(spark, d):
    (part,) = tables(spark, d, "part")
    raw = part.select("p_partkey", F.col("p_size").cast("string").alias("p_size"), "p_retailprice", "p_name")
    typed = raw.withColumn("fraction", C.percent_to_fraction("p_size")).withColumns(
        C.cast_layout({"p_retailprice": "decimal(10,4)", "p_name": "int"}))
    return typed.select("p_partkey", F.col("fraction").cast("double").alias("fraction"),
                        F.col("p_retailprice").cast("double").alias("price"), F.col("p_name").alias("name_number"))


@query("PRJ-14", """
    SELECT dayofweek(ts) + 1 AS day_of_week, strftime(ts, '%Y-%m-%d') AS day, hour(ts) AS hour, count(*) AS rows
    FROM events GROUP BY 1, 2, 3""")
def event_time_parts(spark, d):
    (events,) = tables(spark, d, "events")
    parts = events.withColumns(time_parts("ts")).withColumn("day", F.col("day").cast("string"))
    return A.distribution(parts, "day_of_week", "day", "hour", count="rows").select(
        F.col("day_of_week").cast("long").alias("day_of_week"), "day", F.col("hour").cast("long").alias("hour"), "rows")


@query("PRJ-16 AGG-19", f"""
    WITH cur AS (SELECT c_nationkey, {sql_mean('c_acctbal')} AS avg_balance FROM customer GROUP BY 1),
         prj AS (SELECT n_nationkey AS c_nationkey, n_regionkey / 10.0::DOUBLE AS impact FROM nation WHERE n_regionkey <> 2)
    SELECT c_nationkey, avg_balance, CASE WHEN impact IS NOT NULL THEN avg_balance * (1 + impact) ELSE avg_balance * 1.1::DOUBLE END AS projected
    FROM cur LEFT JOIN prj USING (c_nationkey)""")
def project_consumption(spark, d):
    customer, nation = tables(spark, d, "customer", "nation")
    current = customer.groupBy("c_nationkey").agg(mean("c_acctbal").alias("avg_balance"))
    impact = nation.filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), (F.col("n_regionkey") / 10).alias("impact"))
    return A.project_consumption(current, impact, "c_nationkey", "avg_balance", "impact")


# Fixed value: the sentence of a row.
SENTENCE = "On %s, Order ID (%s) - Order Line ID (%s) sold %s quantity of '%s' at $%s each. The Line total is $%s."


@query("PRJ-17 TXT-05", """
    SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey,
      'On ' || strftime(l_shipdate, '%b %d %Y') || ', Order ID (' || l_orderkey || ') - Order Line ID (' || l_linenumber || ') sold '
      || CAST(l_quantity AS INTEGER) || ' quantity of ''' || p_name || ''' at $' || format('{:,.2f}', p_retailprice) || ' each. The Line total is $'
      || format('{:,.2f}', l_extendedprice) || '.' AS sentence
    FROM lineitem JOIN part ON p_partkey = l_partkey""")
def render_text(spark, d):
    lineitem, part = tables(spark, d, "lineitem", "part")
    rows = lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"])
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", C.render_text(
        SENTENCE, F.date_format("l_shipdate", "MMM dd yyyy"), F.col("l_orderkey"), F.col("l_linenumber"),
        F.col("l_quantity").cast("int"), F.col("p_name"), F.format_number("p_retailprice", 2), F.format_number("l_extendedprice", 2),
    ).alias("sentence"))


@query("PRJ-18", """
    SELECT k, count(*) AS rows, count(missing) AS missing FROM (
      SELECT TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.none') AS missing FROM events) GROUP BY 1""")
def extract_fields(spark, d):
    (events,) = tables(spark, d, "events")
    typed = events.withColumns(C.extract_fields("props", {"k": "int", "none": "string"}))
    return typed.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.count("none").alias("missing"))


@query("PRJ-19", """
    SELECT c_name AS name, c_acctbal AS latitude, TRY_CAST(CASE WHEN c_custkey % 3 = 0 THEN 'n/a' ELSE CAST(c_nationkey AS VARCHAR) END AS DOUBLE) AS longitude,
           coalesce(CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END, '') AS tip_text FROM customer""")
def map_points(spark, d):
    (customer,) = tables(spark, d, "customer")
    rows = customer.select(
        F.col("c_name").alias("Name"), F.col("c_acctbal").alias("LATITUDE"),
        F.expr("CASE WHEN c_custkey % 3 = 0 THEN 'n/a' ELSE CAST(c_nationkey AS STRING) END").alias("Longitude"),
        F.expr("CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END").alias("tip_text"), "c_custkey")
    return P.map_points(rows)


@query("FLT-01", f"""
    SELECT o_orderstatus, count(*) AS rows, {sql_total('o_totalprice')} AS amount FROM orders
    WHERE (o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderpriority LIKE '%LOW')
      AND o_totalprice BETWEEN 1000 AND 300000 AND o_orderdate >= '1996-01-01' AND o_custkey IS NOT NULL GROUP BY 1""")
def filters(spark, d):
    (orders,) = tables(spark, d, "orders")
    kept = orders.filter(
        (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") | F.col("o_orderpriority").like("%LOW"))
        & F.col("o_totalprice").between(1000, 300000) & (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & F.col("o_custkey").isNotNull())
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), total("o_totalprice").alias("amount"))


@query("FLT-02", "SELECT page_id, url FROM pages WHERE lower(url) LIKE '%top' OR lower(url) LIKE '%=x' OR lower(url) LIKE '%.com/'")
def filter_suffix(spark, d):
    (pages,) = tables(spark, d, "pages")
    return P.filter_suffix(pages.select("page_id", "url"), "url", ["TOP", "=x", ".com/"])


@query("FLT-03 FLT-04 JOB-07", f"""
    WITH {BUSINESS} SELECT name, stars, review_count FROM business
    WHERE lower(city) = lower('nation_7') AND stars >= 1.5 AND review_count >= 8 AND list_contains(categories, 'BUILDING')""")
def top_of_category_in_city(spark, d):
    return run_named(spark, "top_of_category_in_city", {"business": _business(spark, d)},
                     city="nation_7", category="BUILDING", min_stars=1.5, min_reviews=8)


@query("FLT-03", f"WITH {BUSINESS} SELECT business_id, name, latitude, longitude, city, state FROM business WHERE city = 'NATION_11'")
def business_in_city(spark, d):
    return run_named(spark, "business_in_city", {"business": _business(spark, d)}, city="NATION_11")


def _reviews(spark, d) -> DataFrame:
    (orders,) = tables(spark, d, "orders")
    return orders.select(F.col("o_custkey").alias("business_id"), F.col("o_orderdate").alias("review_date"))


MONTHLY = """SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS review_count
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate >= {start} GROUP BY 1, 2"""


@query("FLT-05 AGG-04 JOB-07", MONTHLY.format(start="date_trunc('month', DATE '2001-06-19' - INTERVAL 12 MONTH)"))
def monthly_reviews_12(spark, d):
    return _long(monthly_reviews(_reviews(spark, d), _business(spark, d), "2001-06-19"))


@query("FLT-05", MONTHLY.format(start="DATE '2001-06-19' - INTERVAL 12 MONTH"))
def monthly_reviews_rolling(spark, d):
    return _long(monthly_reviews(_reviews(spark, d), _business(spark, d), "2001-06-19", from_month_start=False))


def _long(df: DataFrame) -> DataFrame:
    """Whole numbers in the type SQL date parts have."""
    return df.select(*[F.col(f.name).cast("long").alias(f.name) if f.dataType.simpleString() == "int" else F.col(f.name) for f in df.schema])


def _audit(spark, d) -> DataFrame:
    (events,) = tables(spark, d, "events")
    return events.select(
        "event_id", F.col("event_type").alias("action_name"),
        F.create_map(F.lit("full_name_arg"), F.concat_ws(".", F.lit("lake"), "event_type", F.pmod("user_id", F.lit(5)).cast("string"))).alias("request_params"),
        F.struct(F.concat(F.lit("user"), F.pmod("user_id", F.lit(3)).cast("string"), F.lit("@example.org")).alias("email")).alias("user_identity"),
        text("ts").alias("event_day"))


@query("FLT-06", """
    SELECT event_id, event_type AS action_name, strftime(ts, '%Y-%m-%d') AS event_day FROM events
    WHERE event_type IN ('view', 'click', 'error') AND 'lake.' || event_type || '.' || (user_id % 5) = 'lake.click.2' AND user_id % 3 = 1""")
def audit_events(spark, d):
    rows = P.audit_events(_audit(spark, d), ["view", "click", "error"], "request_params", "full_name_arg", "lake.click.2",
                          "user1@example.org", "user_identity.email")
    return rows.select("event_id", "action_name", "event_day")


@query("JON-13", """
    WITH tags AS (SELECT 'lake' AS c, event_type AS s, CAST(user_id % 5 AS VARCHAR) AS t FROM events GROUP BY ALL HAVING count(*) % 2 = 0)
    SELECT c || '.' || s || '.' || t AS table_name, count(*) AS rows
    FROM events JOIN tags ON 'lake.' || event_type || '.' || (user_id % 5) = c || '.' || s || '.' || t GROUP BY 1""")
def join_on_expr(spark, d):
    audit = _audit(spark, d)
    tags = audit.groupBy(F.col("request_params")["full_name_arg"].alias("n")).count().filter("count % 2 = 0").select(
        F.split("n", r"\.")[0].alias("c"), F.split("n", r"\.")[1].alias("s"), F.split("n", r"\.")[2].alias("t"))
    joined = J.join_on_expr(audit, tags, F.col("request_params")["full_name_arg"], F.concat_ws(".", "c", "s", "t"))
    return joined.groupBy(F.concat_ws(".", "c", "s", "t").alias("table_name")).agg(F.count(F.lit(1)).alias("rows"))


@query("FLT-07", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_brands(spark, d):
    (part,) = tables(spark, d, "part")
    return P.distinct(part, ["p_brand", "p_type"])


# ------------------------------------------------------------------- joins


@query("JON-01", f"""
    SELECT o_orderpriority, count(*) AS rows, {sql_total('l_extendedprice')} AS amount
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def inner_join(spark, d):
    lineitem, orders = tables(spark, d, "lineitem", "orders")
    joined = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"), total("l_extendedprice").alias("amount"))


@query("JON-02", """
    SELECT n_name, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def broadcast_join(spark, d):
    customer, nation = tables(spark, d, "customer", "nation")
    joined = J.broadcast_join(customer.withColumnRenamed("c_nationkey", "n_nationkey"), nation, "n_nationkey")
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))


@query("JON-03 DQ-12", """
    SELECT c_custkey, n.actual_count, c_nationkey AS stated_count, coalesce(n.actual_count, 0) - c_nationkey AS difference
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS actual_count FROM orders GROUP BY 1) n ON n.o_custkey = c_custkey""")
def reconcile_orders(spark, d):
    customer, orders = tables(spark, d, "customer", "orders")
    stated = customer.select("c_custkey", F.col("c_nationkey").alias("stated_count"))
    actual = orders.select(F.col("o_custkey").alias("c_custkey"))
    return reconcile(stated, actual, "c_custkey", "stated_count").select("c_custkey", "actual_count", "stated_count", "difference")


@query("JON-03", f"""
    SELECT c_custkey, c_mktsegment, n.orders, n.spent FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS orders, {sql_total('o_totalprice')} AS spent FROM orders GROUP BY 1) n ON n.o_custkey = c_custkey""")
def left_agg_join(spark, d):
    customer, orders = tables(spark, d, "customer", "orders")
    return J.left_agg_join(customer.select("c_custkey", "c_mktsegment"), orders.withColumnRenamed("o_custkey", "c_custkey"),
                           ["c_custkey"], orders=F.count(F.lit(1)), spent=total("o_totalprice"))


@query("JON-04 JON-01 AGG-13 JOB-05", f"""
    WITH daily AS (
      SELECT CAST(o_orderdate AS DATE) AS day, {sql_total('l_extendedprice')} AS DailyTotal, {SQL_PROFIT} AS DailyProfit
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
    weather AS (SELECT CAST(ts - INTERVAL 24 YEAR AS DATE) AS day, {sql_mean('value')} AS avg_temp FROM events GROUP BY 1)
    SELECT strftime(day, '%Y-%m-%d') AS InvoiceDate, DailyTotal, DailyProfit, avg_temp AS WeatherAvgTemp,
           CASE WHEN avg_temp IS NOT NULL THEN 'C' END AS WeatherUnit, '2024-02-01' AS copiedDate, 'run-1' AS copiedPipelineId
    FROM daily LEFT JOIN weather USING (day)""")
def daily_sales_report(spark, d):
    orders, lineitem, events = tables(spark, d, "orders", "lineitem", "events")
    weather = events.groupBy(F.date_trunc("day", F.expr("ts - INTERVAL 24 YEAR")).alias("date")).agg(
        mean("value").alias("avg_temp"), F.lit("C").alias("temp_unit"))
    invoices = orders.select(F.col("o_orderkey").alias("InvoiceID"), F.col("o_orderdate").alias("InvoiceDate"))
    lines = lineitem.select(F.col("l_orderkey").alias("InvoiceID"), money("l_extendedprice").alias("LinePrice"),
                            line_profit().alias("LineProfit"))
    report = sales_report(invoices, lines, weather, "2024-02-01", "run-1")
    return report.withColumns({
        "InvoiceDate": F.col("InvoiceDate").cast("string"), "copiedDate": F.col("copiedDate").cast("string"),
        "DailyTotal": F.col("DailyTotal").cast("double"), "DailyProfit": F.col("DailyProfit").cast("double")})


@query("JON-05", """
    SELECT o_custkey, o_orderkey FROM orders o WHERE NOT EXISTS (
      SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_nationkey = o.o_orderkey % 25)""")
def not_exists(spark, d):
    orders, customer = tables(spark, d, "orders", "customer")
    cond = (F.col("s.o_custkey") == F.col("t.c_custkey")) & (F.col("s.o_orderkey") % 25 == F.col("t.c_nationkey"))
    return J.not_exists(orders, customer, cond).select("o_custkey", "o_orderkey")


@query("JON-06", """
    SELECT c_custkey FROM customer c WHERE EXISTS (
      SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice <> c.c_acctbal AND o.o_orderstatus = 'F')""")
def exists_changed(spark, d):
    orders, customer = tables(spark, d, "orders", "customer")
    cond = (F.col("s.c_custkey") == F.col("t.o_custkey")) & (F.col("t.o_totalprice") != F.col("s.c_acctbal"))
    return J.exists(customer, orders.filter("o_orderstatus = 'F'"), cond).select("c_custkey")


@query("JON-07 AGG-25", """
    SELECT p_partkey, (SELECT max(o_orderkey) FROM orders) AS max_value, p_partkey + (SELECT max(o_orderkey) FROM orders) AS sk FROM part""")
def with_scalar(spark, d):
    part, orders = tables(spark, d, "part", "orders")
    return J.with_scalar(part.select("p_partkey"), A.max_or_zero(orders, "o_orderkey")).withColumn("sk", F.col("p_partkey") + F.col("max_value"))


@query("JON-08", """
    WITH one AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1)
    SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN one ON o_custkey = c_custkey""")
def lookup_one(spark, d):
    customer, orders = tables(spark, d, "customer", "orders")
    side = orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return J.lookup_one(customer.select("c_custkey"), side, ["c_custkey"], [F.asc("o_totalprice"), F.asc("o_orderkey")])


VERSIONS = """
    versions AS (
      SELECT p_partkey AS item, 2 * p_partkey AS sk, TIMESTAMP '1990-01-01' AS eff, TIMESTAMP '1997-06-30' AS exp FROM part
      UNION ALL SELECT p_partkey, 2 * p_partkey + 1, TIMESTAMP '1997-06-30', TIMESTAMP '1999-12-31' FROM part WHERE p_partkey % 3 <> 0)"""


@query("JON-09", f"""
    WITH {VERSIONS}, m AS (
      SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, (SELECT max_by(sk, eff) FROM versions
        WHERE item = l_partkey AND eff <= l_shipdate AND l_shipdate <= exp) AS sk FROM lineitem)
    SELECT sk, count(*) AS rows FROM m GROUP BY 1""")
def lookup_as_of(spark, d):
    lineitem, part = tables(spark, d, "lineitem", "part")
    versions = _versions(part)
    mapped = J.lookup_as_of(lineitem, versions, fact_key="l_partkey", fact_date="l_shipdate", dim_key="item",
                            effective="eff", expiry="exp", take={"sk": "sk"})
    return mapped.groupBy("sk").agg(F.count(F.lit(1)).alias("rows"))


def _versions(part: DataFrame) -> DataFrame:
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    old = part.select(F.col("p_partkey").alias("item"), (2 * F.col("p_partkey")).alias("sk"), at("1990-01-01").alias("eff"), at("1997-06-30").alias("exp"))
    new = part.filter("p_partkey % 3 <> 0").select("p_partkey", 2 * F.col("p_partkey") + 1, at("1997-06-30"), at("1999-12-31"))
    return old.union(new)


@query("JON-09", f"""
    WITH {VERSIONS}, wide AS (SELECT * FROM versions UNION ALL SELECT p_partkey, -p_partkey, TIMESTAMP '1996-01-01', TIMESTAMP '1996-12-31' FROM part),
    m AS (SELECT o_orderkey, (SELECT max_by(sk, eff) FROM wide WHERE item = o_custkey AND eff <= o_orderdate AND o_orderdate <= exp) AS sk FROM orders)
    SELECT o_orderkey, sk FROM m""")
def lookup_as_of_overlaps(spark, d):
    orders, part = tables(spark, d, "orders", "part")
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    wide = _versions(part).union(part.select("p_partkey", -F.col("p_partkey"), at("1996-01-01"), at("1996-12-31")))
    mapped = J.lookup_as_of(orders.select("o_orderkey", "o_custkey", "o_orderdate"), wide, fact_key="o_custkey", fact_date="o_orderdate",
                            dim_key="item", effective="eff", expiry="exp", take={"sk": "sk"}, row_id=["o_orderkey"])
    return mapped.select("o_orderkey", "sk")


NESTED = """
    nested AS (
      SELECT p_partkey AS item, 10 * p_partkey AS sk, TIMESTAMP '1992-01-01' AS eff, CAST(NULL AS TIMESTAMP) AS exp FROM part
      UNION ALL SELECT p_partkey, 10 * p_partkey + 1, TIMESTAMP '1993-01-01', TIMESTAMP '1996-12-31' FROM part WHERE p_partkey % 2 = 0
      UNION ALL SELECT p_partkey, 10 * p_partkey + 2, TIMESTAMP '1994-03-01', TIMESTAMP '1994-09-30' FROM part WHERE p_partkey % 3 = 0
      UNION ALL SELECT p_partkey, 10 * p_partkey + 3, TIMESTAMP '1994-09-30', TIMESTAMP '1995-06-30' FROM part WHERE p_partkey % 3 <> 1
      UNION ALL SELECT p_partkey, 10 * p_partkey + 4, TIMESTAMP '1996-12-31', TIMESTAMP '1996-12-31' FROM part WHERE p_partkey % 5 = 0)"""


@query("JON-09", f"""
    WITH {NESTED} SELECT l_orderkey, l_linenumber,
      (SELECT max_by(sk, eff) FROM nested WHERE item = l_partkey AND eff <= l_shipdate AND (exp IS NULL OR l_shipdate <= exp)) AS sk FROM lineitem""")
def lookup_as_of_nested(spark, d):
    """Versions that lie within one another, touch, last a day or for ever: one match per row in one shuffle."""
    lineitem, part = tables(spark, d, "lineitem", "part")
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    spans = [("1992-01-01", None, "true"), ("1993-01-01", "1996-12-31", "p_partkey % 2 = 0"), ("1994-03-01", "1994-09-30", "p_partkey % 3 = 0"),
             ("1994-09-30", "1995-06-30", "p_partkey % 3 <> 1"), ("1996-12-31", "1996-12-31", "p_partkey % 5 = 0")]
    versions = A.union_all([
        part.filter(which).select(F.col("p_partkey").alias("item"), (10 * F.col("p_partkey") + i).alias("sk"), at(a).alias("eff"), at(b).alias("exp"))
        for i, (a, b, which) in enumerate(spans)])
    mapped = J.lookup_as_of(lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"), versions, fact_key="l_partkey",
                            fact_date="l_shipdate", dim_key="item", effective="eff", expiry="exp", take={"sk": "sk"})
    return mapped.select("l_orderkey", "l_linenumber", "sk")


@query("JON-10 JON-11", """
    SELECT coalesce(p.sk, -1) AS part_sk, coalesce(s.sk, '-1') AS supp_sk, count(*) AS rows FROM lineitem
    LEFT JOIN (SELECT p_partkey, p_size AS sk FROM part WHERE p_partkey % 7 <> 0) p ON p_partkey = l_partkey
    LEFT JOIN (SELECT s_suppkey, lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS sk FROM supplier WHERE s_suppkey % 7 <> 0) s ON s_suppkey = l_suppkey
    GROUP BY 1, 2""")
def star_fact_unknown(spark, d):
    lineitem, part, supplier = tables(spark, d, "lineitem", "part", "supplier")
    mapped = J.star_lookup(lineitem, [
        J.Lookup(part.filter("p_partkey % 7 <> 0"), {"l_partkey": "p_partkey"}, {"p_size": "part_sk"}, {"part_sk": -1}),
        J.Lookup(supplier.filter("s_suppkey % 7 <> 0").withColumn("sk", F.lpad(F.col("s_nationkey").cast("string"), 6, "0")),
                 {"l_suppkey": "s_suppkey"}, {"sk": "supp_sk"}, {"supp_sk": "-1"}),
    ])
    return A.distribution(mapped, "part_sk", "supp_sk", count="rows")


@query("JON-12", f"""
    SELECT r_name, year(o_orderdate) AS year, count(*) AS rows, {sql_total('l_extendedprice')} AS amount
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2""")
def star_query(spark, d):
    lineitem, orders, customer, nation, region = tables(spark, d, "lineitem", "orders", "customer", "nation", "region")
    per_order = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum(money("l_extendedprice")).alias("s"))
    places = nation.join(broadcast_if_small(region), nation["n_regionkey"] == region["r_regionkey"])
    facts = per_order.join(orders, per_order["l_orderkey"] == orders["o_orderkey"]).join(customer, orders["o_custkey"] == customer["c_custkey"])
    joined = J.broadcast_join(facts.withColumnRenamed("c_nationkey", "n_nationkey"), places, "n_nationkey")
    return joined.groupBy("r_name", F.year("o_orderdate").cast("long").alias("year")).agg(
        F.sum("n").alias("rows"), F.sum("s").cast("double").alias("amount"))


@query("JON-14", """
    SELECT event_id, event_type, max(value) OVER (PARTITION BY event_type) AS top_value FROM events""")
def join_group_max(spark, d):
    (events,) = tables(spark, d, "events")
    return J.join_group_max(events.select("event_id", "event_type", "value"), ["event_type"], "value", "top_value").drop("value")


# ------------------------------------------------------------- aggregations


@query("AGG-01", f"""
    SELECT count(*) AS total_orders, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities,
           {sql_mean('o_totalprice')} AS avg_price, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price,
           count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS open_orders, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS closed_orders FROM orders""")
def profile_orders(spark, d):
    (orders,) = tables(spark, d, "orders")
    found = A.profile(
        orders, count="total_orders",
        distinct={"customers": "o_custkey", "priorities": "o_orderpriority"}, ranges={"o_totalprice": ("min_price", "max_price")},
        counts_if={"open_orders": F.col("o_orderstatus") == "O", "closed_orders": F.col("o_orderstatus") == "F"},
    )
    return J.with_scalar(found, orders.agg(mean("o_totalprice").alias("avg_price")))


@query("AGG-01 AGG-23", """
    SELECT count(*) AS total_documents, count(DISTINCT lang) AS languages, count(DISTINCT source) AS sources,
           round(avg(length(text)), 6) AS avg_length, min(n_chars) AS min_chars, max(n_chars) AS max_chars FROM documents""")
def profile_documents(spark, d):
    (documents,) = tables(spark, d, "documents")
    return A.profile(documents, count="total_documents", distinct={"languages": "lang", "sources": "source"},
                     averages={"avg_length": F.length("text")}, ranges={"n_chars": ("min_chars", "max_chars")}).withColumn(
        "avg_length", F.round("avg_length", 6))


@query("AGG-02", """
    SELECT p_brand, p_type, count(*) AS parts, round(avg(p_size), 6) AS avg_size FROM part GROUP BY 1, 2""")
def group_stats(spark, d):
    (part,) = tables(spark, d, "part")
    return A.group_stats(part, ["p_brand", "p_type"], "p_size", "parts", "avg_size").withColumn("avg_size", F.round("avg_size", 6))


@query("AGG-03", "SELECT l_quantity, count(*) AS count FROM lineitem GROUP BY 1")
def order_distribution(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    return A.distribution(lineitem, "l_quantity")


@query("AGG-04", f"SELECT year(o_orderdate) AS year, count(*) AS rows, {sql_mean('o_totalprice')} AS avg_price FROM orders GROUP BY 1")
def yearly_trend(spark, d):
    (orders,) = tables(spark, d, "orders")
    return _long(A.trend(orders, "o_orderdate", "year", avg_price=mean("o_totalprice")))


@query("AGG-04", f"SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, count(*) AS rows, {sql_total('l_quantity')} AS quantity FROM lineitem GROUP BY 1, 2")
def monthly_trend(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    return _long(A.trend(lineitem, "l_shipdate", "month", quantity=total("l_quantity")))


@query("AGG-05 AGG-06", """
    SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS open_lines,
           count(*) FILTER (WHERE l_quantity >= 25) AS big_lines FROM lineitem GROUP BY 1""")
def conditional_counts(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    return lineitem.groupBy("l_returnflag").agg(
        F.sum(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("open_lines"),
        F.expr("count(1) FILTER (WHERE l_quantity >= 25)").alias("big_lines"))


SALES_METRICS = MetricView(
    joins=(Join("orders", "source.l_orderkey = orders.o_orderkey"), Join("part", "source.l_partkey = part.p_partkey")),
    filter="orders.o_orderstatus <> 'P'",
    dimensions={"year": "CAST(year(orders.o_orderdate) AS BIGINT)", "brand": "part.p_brand", "flag": "source.l_returnflag", "priority": "orders.o_orderpriority"},
    measures={
        "lines": "count(1)", "quantity": "CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)",
        "big_lines": "count(1) FILTER (WHERE l_quantity >= 40)", "big_pct": "MEASURE(big_lines) * 100D / MEASURE(lines)",
        "avg_quantity": "MEASURE(quantity) / MEASURE(lines)",
    },
)


def _metrics(spark, d, dims, measures, view=SALES_METRICS):
    lineitem, orders, part = tables(spark, d, "lineitem", "orders", "part")
    return view.query({"source": lineitem, "orders": orders, "part": part}, dims, measures)


@query("AGG-06 AGG-07 AGG-08", f"""
    SELECT year(o_orderdate) AS year, p_brand AS brand, count(*) AS lines, count(*) FILTER (WHERE l_quantity >= 40) * 100.0::DOUBLE / count(*) AS big_pct
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus <> 'P' GROUP BY 1, 2""")
def metric_view_year_brand(spark, d):
    return _metrics(spark, d, ["year", "brand"], ["lines", "big_pct"])


@query("AGG-08", f"""
    SELECT count(*) AS lines, {sql_total('l_quantity')} AS quantity, {sql_total('l_quantity')} / count(*) AS avg_quantity
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus <> 'P'""")
def metric_view_total(spark, d):
    return _metrics(spark, d, [], ["lines", "quantity", "avg_quantity"])


@query("AGG-08", f"""
    SELECT l_returnflag AS flag, o_orderpriority AS priority, {sql_total('l_quantity')} AS quantity, count(*) FILTER (WHERE l_quantity >= 40) AS big_lines
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE p_size > 10 GROUP BY 1, 2""")
def metric_view_filtered(spark, d):
    return _metrics(spark, d, ["flag", "priority"], ["quantity", "big_lines"], replace(SALES_METRICS, filter="part.p_size > 10"))


@query("AGG-09", """
    SELECT s AS summary, round(CASE s WHEN 'count' THEN count(q) WHEN 'mean' THEN avg(q) WHEN 'stddev' THEN stddev_samp(q) WHEN 'min' THEN min(q) ELSE max(q) END, 6) AS l_quantity,
           round(CASE s WHEN 'count' THEN count(p) WHEN 'mean' THEN avg(p) WHEN 'stddev' THEN stddev_samp(p) WHEN 'min' THEN min(p) ELSE max(p) END, 4) AS l_extendedprice
    FROM (SELECT l_quantity AS q, l_extendedprice AS p FROM lineitem), (SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS s) GROUP BY s""")
def summary_lineitem(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    s = A.summary(lineitem, "l_quantity", "l_extendedprice")
    return s.select("summary", F.round(F.col("l_quantity").cast("double"), 6).alias("l_quantity"),
                    F.round(F.col("l_extendedprice").cast("double"), 4).alias("l_extendedprice"))


@query("AGG-10", """
    WITH b AS (SELECT quantile_disc(l_extendedprice, 0.0015) AS low, quantile_disc(l_extendedprice, 0.9985) AS high FROM lineitem WHERE l_extendedprice > 0)
    SELECT low, high, (SELECT count(*) FROM lineitem, b WHERE l_extendedprice BETWEEN low AND high) AS rows FROM b""")
def percentile_trim(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    bounds = materialise(A.percentile_bounds(lineitem, "l_extendedprice"), "bounds")
    kept = A.percentile_trim(lineitem, "l_extendedprice", bounds=bounds).agg(F.count(F.lit(1)).alias("rows"))
    return J.with_scalar(bounds, kept)


@query("AGG-10", """
    WITH n AS (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders WHERE o_totalprice > 0 GROUP BY 1)
    SELECT 'all' AS slices, sum(n)::BIGINT AS rows, true AS low_fits, true AS high_fits FROM n UNION ALL SELECT 'two years', sum(n)::BIGINT, true, true FROM n WHERE y BETWEEN 1994 AND 1995""")
def percentile_slices(spark, d):
    """Stored sketches per year, merged over all years and over two of them; the
    ranks their bounds have among the rows lie within a thousandth of what was asked."""
    (orders,) = tables(spark, d, "orders")
    dated = orders.withColumn("y", F.year("o_orderdate"))
    path = scratch_path(spark, "sketches")
    A.write_quantile_sketches(dated, "o_totalprice", ["y"], path)
    A.write_quantile_sketches(dated.filter("y = 1995"), "o_totalprice", ["y"], path)  # a slice comes again
    stored = spark.read.parquet(path)
    price = F.col("o_totalprice")
    checked = []
    for name, which in (("all", F.lit(True)), ("two years", F.col("y").between(1994, 1995))):
        bounds = A.sketch_bounds(stored.filter(which))
        rows = J.with_scalar(dated.filter(which & (price > 0)).select("o_totalprice"), bounds)
        # A bound stands for all ranks of its value; the nearest of them counts.
        off = lambda bound, q: F.greatest(F.avg((price < F.col(bound)).cast("int")) - q, q - F.avg((price <= F.col(bound)).cast("int")), F.lit(0.0))
        checked.append(rows.agg(F.lit(name).alias("slices"), F.max("rows").alias("rows"), (off("low", 0.0015) <= 0.001).alias("low_fits"), (off("high", 0.9985) <= 0.001).alias("high_fits")))
    return A.union_all(checked)


@query("AGG-10", """
    SELECT quantile_disc(o_totalprice, 0.0015) AS low, quantile_disc(o_totalprice, 0.9985) AS high FROM orders WHERE o_totalprice > 0""")
def percentile_sketch(spark, d):
    """The mergeable sketch, settled by a pass over the values near its bounds."""
    (orders,) = tables(spark, d, "orders")
    return A.percentile_bounds(orders, "o_totalprice", accuracy=1_000_000, settled=True)


@query("AGG-11", "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    return A.duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"])


@query("AGG-12", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def distinct_days(spark, d):
    (orders,) = tables(spark, d, "orders")
    return A.distinct_days(orders, "o_orderdate").select(F.col("day").cast("string").alias("day"))


@query("AGG-14", f"""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, l_partkey, {sql_total('l_extendedprice')} AS revenue, {SQL_PROFIT} AS profit
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def daily_item_revenue(spark, d):
    orders, lineitem = tables(spark, d, "orders", "lineitem")
    rows = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
    return rows.groupBy(text("o_orderdate").alias("day"), "l_partkey").agg(
        total("l_extendedprice").alias("revenue"), F.sum(line_profit()).cast("double").alias("profit"))


@query("AGG-13", f"SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, {sql_total('l_extendedprice')} AS revenue FROM lineitem GROUP BY 1")
def daily_totals(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    rows = lineitem.select(text("l_shipdate").alias("day"), money("l_extendedprice").alias("p"))
    return A.daily_totals(rows, "day", revenue="p").withColumn("revenue", F.col("revenue").cast("double"))


@query("AGG-15", f"""
    SELECT round(avg(s), 4) AS avg_profit FROM (
      SELECT o_orderkey, {sql_total('l_extendedprice')} AS s FROM orders JOIN lineitem ON l_orderkey = o_orderkey
      WHERE o_orderdate BETWEEN '1996-01-01' AND '1996-03-31' GROUP BY 1)""")
def avg_of_sums(spark, d):
    orders, lineitem = tables(spark, d, "orders", "lineitem")
    quarter = orders.filter("o_orderdate BETWEEN TIMESTAMP_NTZ '1996-01-01' AND TIMESTAMP_NTZ '1996-03-31'")
    rows = lineitem.join(quarter, lineitem["l_orderkey"] == quarter["o_orderkey"])
    return A.avg_of_sums(rows, "o_orderkey", "l_extendedprice", "avg_profit").select(F.round("avg_profit", 4).alias("avg_profit"))


@query("AGG-16", """
    SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, l_extendedprice AS profit FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderdate BETWEEN '1996-01-01' AND '1996-03-31'""")
def profit_rows(spark, d):
    orders, lineitem = tables(spark, d, "orders", "lineitem")
    quarter = orders.filter("o_orderdate BETWEEN TIMESTAMP_NTZ '1996-01-01' AND TIMESTAMP_NTZ '1996-03-31'")
    rows = lineitem.join(quarter, lineitem["l_orderkey"] == quarter["o_orderkey"])
    return _long(rows.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.col("l_extendedprice").alias("profit")))


@query("AGG-17", """
    SELECT strftime(o_orderdate, '%A') AS day_of_week, dayofweek(o_orderdate) + 1 AS day_of_week_id,
           CAST(round(avg(CAST(o_custkey AS DECIMAL(10,2))), 2) AS DOUBLE) AS avg_quantity, count(*) // 4 AS avg_rows_per_week FROM orders GROUP BY 1, 2""")
def weekday_usage(spark, d):
    (orders,) = tables(spark, d, "orders")
    return _long(A.weekday_usage(orders, "o_orderdate", "o_custkey")).withColumn("avg_quantity", F.col("avg_quantity").cast("double"))


@query("AGG-18", f"""
    SELECT n_name, n_nationkey AS lat, {sql_total('o_totalprice')} AS total FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def usage_by_place(spark, d):
    orders, customer, nation = tables(spark, d, "orders", "customer", "nation")
    per_customer = orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("s"))
    placed = per_customer.join(customer, per_customer["o_custkey"] == customer["c_custkey"])
    named = J.broadcast_join(placed.withColumnRenamed("c_nationkey", "n_nationkey"), nation, "n_nationkey")
    return named.groupBy("n_name", F.col("n_nationkey").alias("lat")).agg(F.sum("s").cast("double").alias("total"))


@query("AGG-19 JON-12", f"""
    SELECT c_nationkey AS place, strftime(o_orderdate, '%Y-%m-%d') AS day, {sql_mean('o_totalprice')} AS avg_price
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""")
def daily_avg_by_place(spark, d):
    orders, customer = tables(spark, d, "orders", "customer")
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return rows.groupBy(F.col("c_nationkey").alias("place"), text("o_orderdate").alias("day")).agg(mean("o_totalprice").alias("avg_price"))


@query("AGG-20", f"""
    WITH u AS (SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE event_type END AS endpoint, user_id % 4 AS sku, CAST(ts AS DATE) AS day, value FROM events)
    SELECT endpoint, sku, strftime(day, '%Y-%m-%d') AS day, count(*) AS record_count, {sql_total('value')} AS total_usage FROM u
    WHERE endpoint IS NOT NULL AND day >= (SELECT max(day) FROM u) - 10 GROUP BY 1, 2, 3""")
def usage_cost(spark, d):
    (events,) = tables(spark, d, "events")
    usage = events.select(
        F.struct(F.when(F.col("event_type") != "signup", F.col("event_type")).alias("endpoint_name")).alias("usage_metadata"),
        F.pmod("user_id", F.lit(4)).alias("sku"), F.to_date("ts").alias("day"), money("value").alias("quantity"))
    flat = usage.select(F.col("usage_metadata.endpoint_name").alias("endpoint"), "sku", "day", "quantity")
    today = flat.agg(F.max("day")).scalar()
    cost = A.usage_cost(flat, "day", today, ["endpoint", "sku"], "quantity", days=10)
    return cost.withColumns({"day": F.col("day").cast("string"), "total_usage": F.col("total_usage").cast("double")})


@query("AGG-21", "SELECT l_suppkey, l_returnflag, count(*) AS record_count FROM lineitem GROUP BY 1, 2")
def skew_check(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    return A.skew_check(lineitem, ["l_suppkey", "l_returnflag"])


@query("AGG-23", "SELECT round(avg(length(html)), 6) AS avg_length, max(length(html)) AS max_length FROM pages")
def length_stats(spark, d):
    (pages,) = tables(spark, d, "pages")
    return A.length_stats(pages, "html").select(F.round("avg_length", 6).alias("avg_length"), F.col("max_length").cast("long").alias("max_length"))


@query("AGG-24", """
    SELECT count(*) AS rows, round(avg(len(string_split(text, ', '))), 6) AS avg_items, max(len(string_split(text, ', '))) AS max_items FROM documents""")
def list_stats(spark, d):
    (documents,) = tables(spark, d, "documents")
    return _long(A.list_stats(documents, "text")).withColumn("avg_items", F.round("avg_items", 6))


@query("AGG-26", """
    SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS x_bin, CAST(floor(l_extendedprice / 10000) AS BIGINT) AS y_bin, count(*) AS rows FROM lineitem GROUP BY 1, 2""")
def pair_histogram(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    return A.pair_histogram(lineitem, "l_quantity", "l_extendedprice", 5, 10000)


@query("AGG-26", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS correlation, count(*) AS rows FROM lineitem")
def pair_correlation(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    return A.pair_correlation(lineitem, "l_quantity", "l_extendedprice").withColumn("correlation", F.round("correlation", 6))


@query("AGG-27", "SELECT toxic, quality, count(*) AS rows FROM labels GROUP BY 1, 2")
def count_by_state(spark, d):
    (labels,) = tables(spark, d, "labels")
    return A.distribution(labels, "toxic", "quality", count="rows")


# ------------------------------------------------------------ set operations


@query("SET-01", """
    SELECT 'customer' AS kind, c_nationkey AS nation, count(*) AS rows FROM customer GROUP BY 1, 2
    UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 1, 2""")
def union_by_name(spark, d):
    customer, supplier = tables(spark, d, "customer", "supplier")
    both = A.union_all([
        customer.select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation")),
        supplier.select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind")),
    ])
    return A.distribution(both, "kind", "nation", count="rows")


@query("SET-02", """
    SELECT table_name, rows, format('{:,}', rows) AS formatted FROM (
      SELECT 'lineitem' AS table_name, count(*) AS rows FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders
      UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'events', count(*) FROM events)""")
def table_counts(spark, d):
    names = ["lineitem", "orders", "customer", "events"]
    return A.table_counts(dict(zip(names, tables(spark, d, *names))))


@query("SET-03", """
    SELECT o_custkey, o_orderstatus FROM orders EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 100000""")
def rejects(spark, d):
    (orders,) = tables(spark, d, "orders")
    rows = orders.select("o_custkey", "o_orderstatus")
    return A.rejects(rows, orders.filter("o_totalprice > 100000").select("o_custkey", "o_orderstatus"))


@query("SET-03", """
    SELECT o_custkey, o_orderstatus FROM orders EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 100000""")
def rejects_all(spark, d):
    (orders,) = tables(spark, d, "orders")
    rows = orders.select("o_custkey", "o_orderstatus")
    return A.rejects(rows, orders.filter("o_totalprice > 100000").select("o_custkey", "o_orderstatus"), keep_duplicates=True)


@query("SET-03", """
    WITH a AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_returnflag END AS mode, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_quantity END AS quantity, l_tax FROM lineitem)
    SELECT mode, quantity, count(*) AS rows FROM (SELECT mode, quantity FROM a EXCEPT ALL SELECT mode, quantity FROM a WHERE l_tax > 0.06) GROUP BY 1, 2""")
def rejects_hot_row(spark, d):
    """One row is a third of the table; its surplus comes from many small slices."""
    (lineitem,) = tables(spark, d, "lineitem")
    hot = F.col("l_orderkey") % 3 == 0
    rows = lineitem.select(F.when(hot, "hot").otherwise(F.col("l_returnflag")).alias("mode"), F.when(~hot, F.col("l_quantity")).alias("quantity"), "l_tax")
    left = A.multiset_difference(rows.select("mode", "quantity"), rows.filter("l_tax > 0.06").select("mode", "quantity"), slice_rows=1000)
    return left.groupBy("mode", "quantity").agg(F.count(F.lit(1)).alias("rows"))


@query("SET-03 DQ-06", """
    SELECT ok, count(*) AS rows FROM (SELECT coalesce(value BETWEEN 5 AND 20, false) AS ok FROM events) GROUP BY 1""")
def split_by_flag(spark, d):
    (events,) = tables(spark, d, "events")
    good, bad = A.split_by(events, F.col("value").between(5, 20))
    return A.union_all([good.select(F.lit(True).alias("ok")), bad.select(F.lit(False).alias("ok"))]).groupBy("ok").agg(
        F.count(F.lit(1)).alias("rows"))


@query("MRG-14 MRG-12", """
    WITH days AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders),
    n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1)
    SELECT md5(strftime(d, '%Y%m%d')) AS SK_date_id, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS NK_date_id, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
           strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_abbr, week(d) AS week_of_year, dayofweek(d) + 1 AS day_of_week,
           strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_abbr, day(d) AS day_of_month, dayofyear(d) AS day_of_year,
           dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) BETWEEN 1 AND 5 AS is_weekday,
           strftime(d, '%Y-%m-%d') AS date_yyyymmdd, strftime(d, '%m/%d/%Y') AS date_mmddyyyy, coalesce(orders, 0) AS orders
    FROM days LEFT JOIN n USING (d)""")
def date_dimension(spark, d):
    (orders,) = tables(spark, d, "orders")
    first, last = orders.agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    counts = orders.groupBy(F.to_date("o_orderdate").alias("date_actual")).agg(F.count(F.lit(1)).alias("orders"))
    dim = dim_date(spark, str(first), str(last)).join(counts, "date_actual", "left").drop("date_actual")
    return _long(dim.withColumn("NK_date_id", F.col("NK_date_id").cast("string"))).withColumns({
        "NK_date_id": F.col("NK_date_id").cast("int"), "orders": F.coalesce("orders", F.lit(0))})


@query("MRG-15", """
    WITH n AS (SELECT CAST(ts AS DATE) AS d, count(*) AS rows FROM events GROUP BY 1)
    SELECT strftime(d, '%Y%m%d') AS sid, year(d) AS year, month(d) AS month, day(d) AS dayofmonth, dayofweek(d) + 1 AS dayofweek, quarter(d) AS quarter, rows FROM n""")
def date_dimension_compact(spark, d):
    (events,) = tables(spark, d, "events")
    first, last = events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    counts = events.groupBy(F.to_date("ts").alias("calendarDate")).agg(F.count(F.lit(1)).alias("rows"))
    return _long(dim_date(spark, str(first), str(last), "compact").join(counts, "calendarDate").drop("calendarDate"))
