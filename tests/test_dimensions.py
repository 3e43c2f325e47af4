from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import dimensions as D
from strata.plans.sales import ITEM_DATA, load_items
from strata.session import materialise
from tests.conftest import rows

ITEM = "nkStockItemId int, itemDescription string, size string, leadTimeDays int, isChillerRequired boolean, effectiveDate timestamp_ntz, expiryDate timestamp_ntz"
START, CHANGE, NEXT, END = (dt.datetime(y, 1, 1) for y in (2016, 2022, 2023, 9999))


def item(key, name, eff, exp):
    return (key, name, "M", 3, False, eff, exp)


def stock(spark, *versions):
    return spark.createDataFrame(list(versions), ITEM)


def check(dim):
    """One active row per member, unique keys, ordered non-overlapping dates."""
    found = [r.asDict() for r in dim.collect()]
    assert len({r["skStockItem"] for r in found}) == len(found)
    for key in {r["nkStockItemId"] for r in found}:
        mine = sorted((r for r in found if r["nkStockItemId"] == key), key=lambda r: r["effectiveDate"])
        assert sum(r["active"] for r in mine) == 1
        for a, b in zip(mine, mine[1:]):
            assert a["expiryDate"] <= b["effectiveDate"]
    return found


def test_227_items_with_10_changes_make_237_rows(spark):
    first = load_items(None, stock(spark, *[item(i, f"n{i}", START, END) for i in range(227)]))
    dim = materialise(first)
    assert dim.count() == 227 and dim.filter("active").count() == 227
    second = [item(i, f"n{i}", START, CHANGE if i < 10 else END) for i in range(227)]
    second += [item(i, f"new{i}", CHANGE, END) for i in range(10)]
    after = materialise(load_items(dim, stock(spark, *second)))
    check(after)
    assert after.count() == 237
    assert rows(after.groupBy("active").count()) == [(False, 10), (True, 227)]
    again = load_items(after, stock(spark, *second))
    assert rows(again) == rows(after)


def test_source_without_the_old_version(spark):
    dim = materialise(load_items(None, stock(spark, item(1, "a", START, END))))
    only_new = stock(spark, item(1, "b", CHANGE, END))
    kept = load_items(dim, only_new, expire="source_row")
    assert kept.filter("active").count() == 2  # the rule of the source row closes nothing
    closed = check(load_items(dim, only_new, expire="next_effective"))
    assert {r["expiryDate"] for r in closed} == {CHANGE, END}


def test_several_new_versions_at_once(spark):
    dim = materialise(load_items(None, stock(spark, item(1, "a", START, END))))
    src = stock(spark, item(1, "a", START, CHANGE), item(1, "b", CHANGE, NEXT), item(1, "c", NEXT, END))
    found = check(load_items(dim, src))
    assert [(r["itemDescription"], r["active"]) for r in sorted(found, key=lambda r: r["effectiveDate"])] == [("a", False), ("b", False), ("c", True)]


def test_late_older_version_stays_inactive(spark):
    dim = materialise(load_items(None, stock(spark, item(1, "b", CHANGE, END))))
    found = check(load_items(dim, stock(spark, item(1, "a", START, CHANGE), item(1, "b", CHANGE, END))))
    assert [(r["itemDescription"], r["active"]) for r in sorted(found, key=lambda r: r["effectiveDate"])] == [("a", False), ("b", True)]


def test_value_that_comes_back(spark):
    dim = materialise(load_items(None, stock(spark, item(1, "a", START, END))))
    dim = materialise(load_items(dim, stock(spark, item(1, "a", START, CHANGE), item(1, "b", CHANGE, END))))
    dim = materialise(load_items(dim, stock(spark, item(1, "b", CHANGE, NEXT), item(1, "a", NEXT, END))))
    assert len(check(dim)) == 3


def test_unknown_expiry_rule(spark):
    with pytest.raises(ValueError):
        load_items(None, stock(spark, item(1, "a", START, END)), expire="never")


def test_null_data_still_has_a_hash(spark):
    src = stock(spark, (1, None, None, None, None, START, END))
    assert load_items(None, src).filter("dataHash IS NOT NULL").count() == 1
    assert set(ITEM_DATA) <= set(load_items(None, src).columns)


def test_surrogate_keys_are_consecutive_over_partitions(spark):
    df = spark.range(5000, numPartitions=7).select((F.col("id") * 37 % 5000).alias("n"))
    got = D.assign_sk(df, "sk", ["n"], base=100).orderBy("n").select("sk").collect()
    assert [r[0] for r in got] == list(range(101, 5101))


def test_surrogate_keys_with_one_hot_order_value(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("n"))
    sk = D.assign_sk(df, "sk", ["n"])
    assert sorted(r[0] for r in sk.select("sk").collect()) == list(range(1, 3001))
    assert sk.filter("n = 7").agg(F.max("sk")).first()[0] == 2000


def test_surrogate_keys_of_nothing(spark):
    assert D.assign_sk(spark.range(0), "sk", ["id"]).count() == 0


def test_scd0_adds_only_the_unseen(spark):
    members = spark.createDataFrame([("a",), ("b",)], "nk string")
    empty = spark.createDataFrame([], "sk long, nk string")
    first = D.scd0(empty, members, "nk", "sk", ["nk"])
    second = D.scd0(first, members.union(spark.createDataFrame([("c",)], "nk string")), "nk", "sk", ["nk"])
    assert rows(second, "sk", "nk") == [(1, "a"), (2, "b"), (3, "c")]


def test_scd1_keeps_or_overwrites_the_creation_date(spark):
    at = lambda t: F.lit(t).cast("timestamp")
    src = lambda v: spark.createDataFrame([(1, v)], "id int, v string")
    old, new = D.scd1_members(src("a"), "id", at("2024-01-01")), D.scd1_members(src("b"), "id", at("2024-02-01"))
    kept = D.scd1(old, new, "id").first()
    assert (kept["v"], kept["dim_created_date"].month, kept["dim_updated_date"].month) == ("b", 1, 2)
    assert D.scd1(old, new, "id", keep_created=False).first()["dim_created_date"].month == 2


def test_time_dimension(spark):
    dim = D.dim_time(spark)
    assert dim.count() == 86_400
    assert rows(dim.groupBy("dayPart").count()) == [(p, 21_600) for p in ("Afternoon", "Evening", "Morning", "Night")]
    assert dim.filter("time = '05:59:59'").first().asDict() == {
        "sid": "055959", "time": "05:59:59", "hour": 5, "minute": 59, "second": 59, "dayPart": "Night"}


def test_date_dimension(spark):
    dim = D.dim_date(spark, "2024-02-28", "2024-03-02")
    leap = dim.filter("date_yyyymmdd = '2024-02-29'").first()
    assert (leap["NK_date_id"], leap["day_of_week"], leap["is_weekend"], leap["week_of_year"], leap["day_of_year"]) == (20240229, 5, False, 9, 60)
    assert dim.count() == 4
    compact = D.dim_date(spark, "2024-03-02", "2024-03-04", "compact")
    merged = D.merge_static(D.dim_date(spark, "2024-03-01", "2024-03-03", "compact"), compact, "sid")
    assert rows(merged, "sid") == [("20240301",), ("20240302",), ("20240303",), ("20240304",)]
