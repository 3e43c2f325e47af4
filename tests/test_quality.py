from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import quality as Q
from strata.operators.facts import build_fact, build_fact_hash
from strata.operators.joins import Lookup
from strata.plans.reviews import FACT_RULES, REVIEW_RULES, TIP_RULES
from tests.conftest import rows

REVIEW = "review_id string, user_id string, business_id string, stars double, review_date date, _rescued_data string, at int"


@pytest.fixture
def reviews(spark):
    df = spark.createDataFrame([
        ("r1", "u", "b", 4.0, "2024-01-01", None, 1),
        ("r1", "u", "b", 9.0, "2024-01-01", None, 2),        # newer, bad stars
        ("r2", None, "b", None, None, None, 1),
        (None, "u", "b", 3.0, "2024-01-01", None, 1),
        (None, "u", "b", 2.0, "2024-01-01", None, 2),
        ("r3", "u", "b", 5.0, "2024-01-01", '{"x":"1"}', 1),
    ], REVIEW.replace("review_date date", "review_date string"))
    return df.withColumn("review_date", F.col("review_date").cast("date"))


def test_first_failed_rule_gives_the_category(reviews):
    flagged = Q.with_flags(reviews, REVIEW_RULES).filter("NOT dq_pass")
    got = rows(flagged.select("review_id", "at", Q.category(REVIEW_RULES).alias("c")))
    assert got == sorted([
        ("r1", 2, "INVALID_VALUE"), ("r2", 1, "MISSING_FOREIGN_KEY"), (None, 1, "MISSING_PRIMARY_KEY"),
        (None, 2, "MISSING_PRIMARY_KEY"), ("r3", 1, "SCHEMA_MISMATCH")], key=repr)


def test_all_reasons_are_kept(reviews):
    flagged = Q.with_flags(reviews, REVIEW_RULES).filter("review_id = 'r2'")
    row = flagged.select(Q.reasons(REVIEW_RULES).alias("r"), Q.failed_columns(REVIEW_RULES).alias("f")).first()
    assert row["r"] == ["Missing foreign key: user_id", "Invalid star rating: must be 1-5", "Invalid date format"]
    assert row["f"] == ["user_id", "stars", "review_date"]


def test_a_newer_bad_row_does_not_hide_a_good_one(reviews):
    after = Q.route(reviews, REVIEW_RULES, ["review_id"], [F.desc("at")])
    assert rows(after.passed, "review_id", "stars") == [("r1", 4.0)]
    assert after.rule_failed.count() == 4 and after.schema_failed.count() == 1
    before = Q.route(reviews, REVIEW_RULES, ["review_id"], [F.desc("at")], dedup="before")
    assert before.passed.count() == 0
    assert before.failed.count() == 4  # the two rows without a key count as one
    with pytest.raises(ValueError):
        Q.route(reviews, REVIEW_RULES, ["review_id"], [F.desc("at")], dedup="never")


def test_quarantine_layout(spark, reviews):
    failed = Q.route(reviews, REVIEW_RULES, ["review_id"], [F.desc("at")]).failed
    q = Q.to_quarantine(failed, REVIEW_RULES, dataset="review", table_name="silver_review", layer="silver", keys=["review_id"], run_id="x")
    want = StructType.fromDDL(Q.QUARANTINE_SCHEMA)
    assert [(f.name, f.dataType.simpleString()) for f in q.schema] == [(f.name, f.dataType.simpleString()) for f in want]
    r1 = q.filter("record_key['review_id'] = 'r1'").first()
    assert json.loads(r1["original_record"])["stars"] == 9.0
    assert q.filter("record_key['review_id'] = 'r3'").first()["original_record"] == '{"x":"1"}'
    assert r1["is_resolved"] is False and r1["resolved_timestamp"] is None
    report = Q.issue_report(q).filter("dq_category = 'MISSING_PRIMARY_KEY'").first()
    assert report["issues"] == 2 and report["failed_columns"] == "review_id"


def test_tip_rules(spark):
    df = spark.createDataFrame([("u", "b", None, "t", None), ("u", "b", "2024-01-01", None, None)],
                               "user_id string, business_id string, tip_date string, tip_text string, _rescued_data string")
    got = Q.with_flags(df, TIP_RULES).select(Q.category(TIP_RULES).alias("c"))
    assert rows(got) == [("INVALID_DATE",), ("MISSING_CONTENT",)]


def test_rule_helpers(spark):
    df = spark.createDataFrame([("Small", "7", "2024-01-01"), ("Tiny", "x", "soon"), (None, None, None)], "class string, n string, d string")
    rules = [Q.one_of("class", ["Small", "Large"]), Q.parses_as("n", "double"), Q.parses_as("d", "timestamp")]
    assert rows(Q.with_flags(df, rules), "dq_pass") == [(False,), (False,), (True,)]
    counts = Q.route_counts(Q.with_flags(df, rules)).first()
    assert (counts["rows"], counts["passed"], counts["failed"]) == (3, 1, 2)


def test_profile_checks(spark):
    df = spark.createDataFrame([(1, 5, 3), (2, None, 9), (9, 1, 1)], "a int, b int, c int")
    assert Q.count_nulls(df, ["a", "b"]).first()[0] == 1
    assert Q.value_range(df, ["a", "b"]).first().asDict() == {"min_a": 1, "max_a": 9, "min_b": 1, "max_b": 5}
    assert rows(Q.check_order(df, "a", "c"), "a") == [(9,)]
    clean = Q.clean(spark.createDataFrame([("1",), ("x",), ("7",)], "v string"), ["v <> '7'"], {"v": "int"})
    assert rows(clean) == sorted([(1,), (None,)], key=repr)


def test_key_audit(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    child = spark.createDataFrame([(1,), (3,), (3,), (3,), (None,)], "ref int")
    got = Q.audit_keys({"p": parent, "c": child}, {"p": ["id"]}, [("c", "ref", "p", "id")])
    assert {(r["check"], r["violations"]) for r in got.collect()} == {("null key", 1), ("duplicate key", 1), ("orphan", 3)}


def test_fact_rejects_have_reasons(spark):
    facts = spark.createDataFrame([("r1", "b1", "u1", 1), ("r1", "b2", "u1", 2), ("r2", "bx", "ux", 1)], "id string, b string, u string, at int")
    dim = lambda k, v: spark.createDataFrame(v, f"{k} string, sk string")
    accepted, rejected = build_fact(
        facts, [Lookup(dim("nb", [("b1", "B1"), ("b2", "B2")]), {"b": "nb"}, {"sk": "SK_business_id"}),
                Lookup(dim("nu", [("u1", "U1")]), {"u": "nu"}, {"sk": "SK_user_id"})],
        "id", ["at"], [F.desc("at")])
    assert rows(accepted) == [("r1", "B2", "U1", 2)]
    flagged = Q.with_flags(rejected, FACT_RULES[:2]).select(F.array_join(Q.reasons(FACT_RULES[:2]), ", ").alias("r"))
    assert flagged.first()[0] == "Missing business dimension key, Missing user dimension key"


def test_two_unknown_members_do_not_share_a_key_hash(spark):
    readings = spark.createDataFrame([("m8", 7.5), ("m9", 8.5)], "meterId string, kwh double")
    dim = spark.createDataFrame([("m1", 0)], "meterId string, sid long")
    fact = build_fact_hash(readings, [Lookup(dim, {"meterId": "meterId"}, {"sid": "meterSid"}, {"meterSid": -1})], "kwh", natural=["meterId"])
    assert rows(fact, "meterSid") == [(-1,), (-1,)]
    assert fact.select("_keyHash").distinct().count() == 2


def test_text_keys_keep_leading_zeros(spark):
    from strata.operators.joins import star_lookup

    fact = spark.createDataFrame([("00:00:05",), ("99",)], "t string")
    times = spark.createDataFrame([("00:00:05", "000005")], "time string, sid string")
    got = star_lookup(fact, [Lookup(times, {"t": "time"}, {"sid": "timeSid"}, {"timeSid": "-1"})])
    assert rows(got, "timeSid") == [("-1",), ("000005",)]
