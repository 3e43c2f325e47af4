"""Whole jobs on small fixtures: questions, metric views, trips, sales, meters."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from strata import sinks
from strata.operators import aggregates as A
from strata.operators import joins as J
from strata.operators import projections as P
from strata.operators import windows as Win
from strata.plans import questions as Q
from strata.plans import reviews as R
from strata.plans import sales, smartgrid, trips
from strata.plans.metric_view import Join, MetricView
from strata.session import materialise
from tests.conftest import rows


@pytest.fixture(scope="module")
def business(spark):
    data = [(f"b{i}", f"n{i}", "Edmonton" if i < 8 else "St. Albert", "AB", 53.5, -113.5, s, c, cats) for i, (s, c, cats) in enumerate([
        (5.0, 300, ["Restaurants"]), (5.0, 300, ["Food"]), (4.5, 900, ["Restaurants"]), (4.5, 99, ["Restaurants"]), (4.5, 99, ["Restaurants"]),
        (4.5, 99, ["Bars"]), (4.0, 1, None), (None, 5, []), (5.0, 1000, ["Restaurants"])])]
    return spark.createDataFrame(data, "business_id string, name string, city string, state string, latitude double, longitude double, stars double, review_count long, categories array<string>")


def test_ties_are_kept_whole(business):
    assert [r[0] for r in rows(Q.top_businesses(business, "Edmonton", 4), "business_id")] == ["b0", "b1", "b2", "b3", "b4", "b5"]
    assert rows(Q.top_businesses(business, "Edmonton", 4, with_ties=False), "business_id") == [("b0",), ("b1",), ("b2",), ("b3",)]
    assert rows(Q.most_reviewed_ranked(business, 1), "business_id") == [("b8",)]
    assert rows(Q.most_reviewed_ranked(business, 3, with_ties=False), "business_id") == [("b0",), ("b2",), ("b8",)]


def test_named_questions(spark, business):
    got = Q.run_named(spark, "top_of_category_in_city", {"business": business}, city="EDMONTON")
    assert [tuple(r) for r in got.collect()] == [("n0", 5.0, 300), ("n2", 4.5, 900)]
    assert Q.run_named(spark, "business_in_city", {"business": business}).count() == 8
    assert Q.run_named(spark, "most_reviewed", {"business": business}, k=2).count() == 2
    with pytest.raises(KeyError):
        Q.run_named(spark, "most_reviewed", {"business": business}, town="x")


def test_rolling_windows(spark, business):
    days = ["2021-01-01", "2021-01-18", "2021-01-19", "2022-01-19", "2020-12-31"]
    review = spark.createDataFrame([("b0", dt.date.fromisoformat(d)) for d in days] + [("gone", dt.date(2022, 1, 1))], "business_id string, review_date date")
    assert [tuple(r) for r in Q.monthly_reviews(review, business, "2022-01-19").collect()] == [(2021, 1, 3), (2022, 1, 1)]
    assert [tuple(r) for r in Q.monthly_reviews(review, business, "2022-01-19", from_month_start=False).collect()] == [(2021, 1, 1), (2022, 1, 1)]


def test_nine_newest_texts(spark):
    tips = spark.createDataFrame([("b0", i, f"w{i} " * 30) for i in range(12)] + [("b1", 99, "other")], "business_id string, day int, text string")
    got = Q.latest_extracts(tips, "b0", "day", "text")
    assert [r["day"] for r in got.orderBy(F.desc("day")).collect()] == list(range(11, 2, -1))
    assert got.first()["text"].split() == [f"w{got.first()['day']}"] * 30
    short = Q.latest_extracts(tips, "b0", "day", "text", words=25)
    assert len(short.first()["text"].split()) == 25
    assert Win.latest_texts(tips, "business_id", [F.desc("day")], 2).count() == 3


def test_metric_view_filter_and_unknown_names(spark):
    fact = spark.createDataFrame([("k1", "d1", 5.0, 1), ("k1", "d1", 1.0, 2), ("k2", "d1", 5.0, 4), ("kx", "d1", 5.0, 8)], "SK_business_id string, SK_date_id string, stars double, review_useful_votes long")
    parts = {
        "source": fact, "business": spark.createDataFrame([("k1", "Edmonton", "A"), ("k2", "Calgary", "B")], "SK_business_id string, city string, name string"),
        "date_dim": spark.createDataFrame([("d1", 2024, 1)], "SK_date_id string, year int, month int"),
    }
    got = R.REVIEW_METRICS.query(parts, ["business_name", "year"], ["total_reviews", "five_star_pct", "total_useful_votes", "avg_stars"]).first()
    assert (got["business_name"], got["total_reviews"], float(got["five_star_pct"]), got["total_useful_votes"], got["avg_stars"]) == ("A", 2, 50.0, 3, 3.0)
    assert replace(R.REVIEW_METRICS, filter=None).query(parts, [], ["total_reviews"]).first()[0] == 3
    with pytest.raises(ValueError):
        MetricView({}, {"a": "MEASURE(b) + 1", "b": "MEASURE(a)"}).query({"source": fact}, [], ["a"])
    assert Join("x", "1 = 1").name == "x"


def test_review_silver_batch(spark):
    b = spark.sql("""SELECT 'b' AS business_id, 'n' AS name, 'c' AS city, 'AB' AS state, 1D AS latitude, 2D AS longitude, 4D AS stars, 9L AS review_count, ' Food, Bars' AS categories,
        named_struct('RestaurantsPriceRange2', '2', 'WheelchairAccessible', 'True', 'DriveThru', 'None', 'RestaurantsTakeOut', 'False', 'WiFi', "u'free'") AS attributes""")
    got = R.silver_business(b).first()
    assert (got["categories"], got["priceRange"], got["wheelchairAccessible"], got["driveThru"], got["takeOut"], got["freeWifi"]) == (["Food", "Bars"], 2, True, None, False, True)
    u = spark.createDataFrame([("u", "n", "2010-01-01 00:00:00", 1, 1, 1, 1, 4.0, "2019,2020"), ("v", "m", "bad", 1, 1, 1, 1, 4.0, " ")],
                              "user_id string, name string, yelping_since string, review_count long, cool long, useful long, funny long, average_stars double, elite string")
    assert rows(R.silver_user(u), "user_id", "member_since", "elite_year_count", "elite_years") == [("u", dt.date(2010, 1, 1), 2, ["2019", "2020"]), ("v", None, 0, None)]
    t = spark.createDataFrame([("u", "b", "2010-01-01 00:00:00", "x", 3), ("u", "b", "2010-01-01 00:00:00", "x", 2), ("u", "b", "x", "x", None)], "user_id string, business_id string, date string, text string, compliment_count long")
    assert rows(R.silver_tip(t), "compliment_count", "is_popular_tip") == [(2, False), (3, True), (None, False)]
    r = spark.createDataFrame([("r", "u", "b", "2010-01-01 00:00:00", 5.0, 1, 2, 3, "t")], "review_id string, user_id string, business_id string, date string, stars double, useful long, funny long, cool long, text string")
    assert R.silver_review(r).first()["review_date"] == dt.date(2010, 1, 1)


TRIP = "vendorID string, tpepPickupDateTime timestamp_ntz, tpepDropoffDateTime timestamp_ntz, passengerCount int, tripDistance double, puLocationId string, fareAmount double, startLon double"


def test_trips(spark):
    at = dt.datetime(2019, 1, 6, 8)
    later = at + dt.timedelta(minutes=9)
    df = spark.createDataFrame([("1", at, later, 1, 2.0, "7", 10.005, None), ("2", at, at, 1, 2.0, "7", 10.0, None), ("1", at, later, 0, 2.0, "7", 10.0, None),
                                ("1", at, later, 1, 0.0, "8", 80.0, None), ("x", at, later, 2, 4.0, "9", 50.0, None)], TRIP)
    valid, trimmed = trips.clean_trips(df), trips.clean_trips(df, trips.TRIMMED_TRIP)
    assert valid.count() == 3 and trimmed.count() == 2
    assert "startLon" not in valid.columns and dict(valid.dtypes)["fareAmount"] == "decimal(10,2)" and dict(valid.dtypes)["vendorID"] == "int"
    top = trips.top_by_ratio_per_weekday(df, "tpepPickupDateTime", "puLocationId", "fareAmount", "tripDistance", 2)
    assert [tuple(r)[:2] for r in top.orderBy("rank").collect()] == [("9", 1), ("7", 1)]


def test_sales_report_reload(spark, tmp_path):
    invoices = spark.createDataFrame([(1, dt.date(2022, 1, 1)), (2, dt.date(2022, 1, 2))], "InvoiceID int, InvoiceDate date")
    lines = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (2, 7, 3)], "InvoiceID int, LinePrice int, LineProfit int")
    weather = spark.createDataFrame([(dt.datetime(2022, 1, 1, 9), 21, "C")], "date timestamp_ntz, avg_temp int, temp_unit string")
    for run in ("a", "b"):
        report = sales.sales_report(invoices, lines, weather, "2022-02-01", run)
        sinks.replace_slice(report, f"{tmp_path}/report", "copiedDate")
    other = sales.sales_report(invoices, lines, weather, "2022-02-02", "c")
    sinks.replace_slice(other, f"{tmp_path}/report", "copiedDate")
    day = "2022-02-02"
    before = spark.read.parquet(f"{tmp_path}/report")
    kept = before.filter(f"copiedDate <> '{day}'").count()
    assert 0 < kept < before.count()
    sinks.replace_slice(other.limit(0), f"{tmp_path}/report", "copiedDate", slices=[(day,)])
    assert spark.read.parquet(f"{tmp_path}/report").count() == kept
    sinks.replace_slice(other, f"{tmp_path}/report", "copiedDate")
    got = rows(spark.read.parquet(f"{tmp_path}/report"), "InvoiceDate", "DailyTotal", "DailyProfit", "WeatherAvgTemp", "copiedPipelineId")
    assert got == [(dt.date(2022, 1, 1), 11, 3, 21, "b"), (dt.date(2022, 1, 1), 11, 3, 21, "c"), (dt.date(2022, 1, 2), 7, 3, None, "b"), (dt.date(2022, 1, 2), 7, 3, None, "c")]


def test_warehouse_load_maps_old_sales_to_the_expired_item(spark):
    end, change = dt.datetime(9999, 12, 31), dt.datetime(2022, 9, 5)
    item = "nkStockItemId int, itemDescription string, size string, leadTimeDays int, isChillerRequired boolean, effectiveDate timestamp_ntz, expiryDate timestamp_ntz"
    stock1 = spark.createDataFrame([(86, "old", "M", 1, False, dt.datetime(2016, 1, 1), end)], item)
    stock2 = spark.createDataFrame([(86, "old", "M", 1, False, dt.datetime(2016, 1, 1), change), (86, "new", "M", 1, False, change, end)], item)
    invoices = spark.createDataFrame([(1, dt.date(2021, 12, 31)), (2, dt.date(2022, 10, 1))], "nkInvoiceId int, nkInvoiceDate date")
    cols = "nkInvoiceId int, nkStockItemId int, quantity int, unitPrice int, taxRate int, tax int, totalAfterTax int, profit int"
    line = lambda inv, q: (inv, 86, q, 2, 15, 1, 9, 3)
    first = sales.load_warehouse(None, stock1, invoices.limit(1), spark.createDataFrame([line(1, 4)], cols))
    second = sales.load_warehouse(first, stock2, invoices, spark.createDataFrame([line(1, 5), line(2, 6)], cols))
    joined = second.fact.join(second.items, "skStockItem")
    assert rows(joined, "invoiceId", "itemDescription", "active", "quantity", "totalBeforeTax") == [(1, "old", False, 5, 10), (2, "new", True, 6, 12)]
    assert rows(second.fact, "skTransaction", "invoiceId") == [(1, 1), (2, 2)]
    third = sales.load_warehouse(second, stock2, invoices, spark.createDataFrame([line(1, 5), line(2, 6)], cols))
    assert rows(third.fact) == rows(second.fact) and rows(third.items) == rows(second.items) and rows(third.dates) == rows(second.dates)


def test_meters(spark):
    meter = "meterId string, MeterLocation string, MeterNumber string, class string, maxKwh string, efficiencyPercentage string, envImpact string, startupTimeMin string, _input_file_modification_date int"
    df = spark.createDataFrame([("m1", "98001", "1", "Small", "15.5", "87", "Low", "5", 1), ("m1", "98001", "1", "Large", "15.5", "88", "Low", "5", 2), ("m2", "98001", "2", "Huge", "1", "1", "Low", "5", 1)], meter)
    silver = smartgrid.silver_meters(df)
    assert [(r["meterId"], r["class"], float(r["efficiencyPercentage"]), float(r["maxKwh"])) for r in silver.collect()] == [("m1", "Large", 0.88, 15.5)]
    assert dict(silver.dtypes)["efficiencyPercentage"] == "decimal(16,6)"
    dim = materialise(smartgrid.load_dimension(None, smartgrid.meter_members(silver), ["meterId"]))
    again = smartgrid.load_dimension(dim, smartgrid.meter_members(silver), ["meterId"])
    assert rows(again) == rows(dim) and rows(dim, "sid") == [(0,)]


def test_map_points_needs_its_columns(spark):
    df = spark.createDataFrame([("a", "53.5", "x", None)], "Name string, Latitude string, LONGITUDE string, Review_Text string")
    assert rows(P.map_points(df)) == [("a", 53.5, None, "")]
    assert P.map_points(df.drop("Latitude")) is None


def test_as_of_boundaries(spark):
    day = lambda d: dt.date(2022, 1, d)
    fact = spark.createDataFrame([(i, 1, day(i)) for i in (1, 5, 10, 11, 20)] + [(99, 2, day(5)), (98, None, day(5))], "id int, k int, d date")
    dim = spark.createDataFrame([(1, "a", day(1), day(10)), (1, "b", day(10), day(15))], "key int, v string, f date, t date")
    args = dict(fact_key="k", fact_date="d", dim_key="key", effective="f", expiry="t", take={"v": "v"})
    want = [(1, "a"), (5, "a"), (10, "b"), (11, "b"), (20, None), (98, None), (99, None)]
    assert sorted(rows(J.lookup_as_of(fact, dim, **args), "id", "v")) == sorted(want)
    assert sorted(rows(J.lookup_as_of(fact, dim, **args, row_id=["id"]), "id", "v")) == sorted(want)


def test_summary_statistics(spark):
    df = spark.createDataFrame([(1, "a, b"), (3, "c"), (None, "")], "n int, l string")
    assert A.list_stats(df, "l").first().asDict() == {"rows": 3, "avg_items": pytest.approx(4 / 3), "max_items": 2}
    assert A.max_or_zero(df.limit(0), "n").first()[0] == 0
    good, bad = A.split_by(df, F.col("n") > 1)
    assert (good.count(), bad.count()) == (1, 2)


def test_hot_key_ranks(spark):
    """A third and more of all rows on one key, many ties, few partitions."""
    df = spark.range(9000).select("id", F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") % 3).alias("v"))
    latest = Win.latest_per_key(df, ["k"], [F.desc("v"), F.desc("id")])
    assert latest.count() == 50 and latest.filter("k = 0").first()["id"] == max(i for i in range(9000) if (i < 4000 or i % 50 == 0) and i % 3 == 2)
    ties = Win.top_k_ranked(df, [("v", "desc")], 5)
    assert ties.count() == 3000 and ties.select("rank").distinct().count() == 1
    per_key = Win.top_k_ranked(df, [("v", "desc")], 1, group=["k"])
    assert per_key.filter("k = 0").count() == sum(1 for i in range(9000) if (i < 4000 or i % 50 == 0) and i % 3 == 2)


def test_duplicates_survive_in_rejects(spark):
    everything = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    clean = spark.createDataFrame([(1,)], "v int")
    assert rows(A.rejects(everything, clean)) == [(2,)]
    assert rows(A.rejects(everything, clean, keep_duplicates=True)) == [(2,), (2,)]


def test_exact_quantiles_against_a_sort(spark):
    df = spark.range(5000, numPartitions=5).select((F.col("id") * 7919 % 1000).cast("double").alias("v")).union(spark.createDataFrame([(None,)], "v double"))
    values = sorted(r[0] for r in df.filter("v IS NOT NULL").collect())
    got = A.exact_quantiles(df, "v", {"a": 0.0015, "b": 0.5, "c": 1.0}).first()
    assert tuple(got) == (values[7], values[2499], values[-1])
    assert A.percentile_trim(df, "v", 0.1, 0.9).agg(F.min("v")).first()[0] == A.percentile_bounds(df, "v", 0.1, 0.9).first()["low"]
    assert A.exact_quantiles(df.limit(0), "v", {"a": 0.5}).first()[0] is None


def test_transaction_lines_are_kept_small(spark):
    """A second load leaves only its new and changed lines behind, without their hashes."""
    from strata import storage
    from strata.operators.facts import build_fact_txn
    from strata.plans import sales
    from strata.session import materialise, scratch_path

    root = scratch_path(spark, "x").rsplit("/", 1)[0]
    invoices = spark.range(100).select(F.col("id").alias("nkInvoiceId"), F.to_date(F.lit("2024-01-02")).alias("nkInvoiceDate"))
    lines = invoices.select("nkInvoiceId", (F.col("nkInvoiceId") % 7).alias("nkStockItemId"), F.lit(3).alias("quantity"))
    dates = sales.load_dates(None, invoices)
    items = spark.createDataFrame([(1, 1, None, None)], "skStockItem long, nkStockItemId long, effectiveDate date, expiryDate date")
    load = lambda fact, rows: sales.load_fact(fact, rows, invoices, dates, items, measures={"quantity": "quantity"})
    first = materialise(load(None, lines.filter("nkInvoiceId < 90")), "fact")
    before = set(storage.list_names(spark, root))
    second = load(first, lines.withColumn("quantity", F.when(F.col("nkInvoiceId") == 5, 4).otherwise(F.col("quantity"))))
    held = [spark.read.parquet(f"{root}/{n}") for n in set(storage.list_names(spark, root)) - before]
    lines_held = [h for h in held if "nkInvoiceId" in h.columns]
    assert lines_held and all(h.count() <= 11 for h in lines_held)
    assert not any("hash" in c.lower() for h in lines_held for c in h.columns)
    got = {r["invoiceId"]: (r["skTransaction"], r["quantity"]) for r in second.collect()}
    assert len(got) == 100 and got[5][1] == 4 and sorted(k for k, _ in got.values()) == list(range(1, 101))
    assert {i: got[i][0] for i in range(90)} == {r["invoiceId"]: r["skTransaction"] for r in first.collect()}
    with pytest.raises(Exception, match="duplicate keys"):
        build_fact_txn(first, lines.union(lines), invoices, dates, items, measures={"quantity": "quantity"})
