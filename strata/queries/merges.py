"""Merges, dimensions, facts and snapshot tables over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import hash_sk, row_hash
from strata.operators import aggregates as A
from strata.operators import dimensions as D
from strata.operators import merge as M
from strata.operators.facts import build_fact
from strata.operators.joins import Lookup
from strata.operators.windows import latest_per_key
from strata.plans.sales import load_dates, load_fact, load_items
from strata.plans.smartgrid import consumption_lookups, consumption_rows, load_dimension
from strata.queries.registry import money, query, text
from strata.session import dropped_shuffles, in_parallel, materialise, scratch_path
from strata.sinks.snapshots import SnapshotTable
from strata.sources import tables

# Target: customers below 80 % of the keys. Source: customers above 60 % with
# changed balances, so both sides overlap and both have keys of their own.
SPLIT = """
    b AS (SELECT max(c_custkey) AS m FROM customer),
    target AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_custkey % 5 AS stamp FROM customer, b WHERE c_custkey < m * 0.8),
    source AS (SELECT c_custkey, upper(c_name) AS c_name, c_nationkey,
                      CASE WHEN c_custkey % 2 = 0 THEN c_acctbal ELSE c_acctbal + 1 END AS c_acctbal, c_custkey % 7 AS stamp
               FROM customer, b WHERE c_custkey > m * 0.6)"""


def _split(spark, d) -> tuple[DataFrame, DataFrame]:
    (customer,) = tables(spark, d, "customer")
    top = customer.agg(F.max("c_custkey")).scalar()
    target = customer.filter(F.col("c_custkey") < top * 0.8).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", (F.col("c_custkey") % 5).alias("stamp"))
    source = customer.filter(F.col("c_custkey") > top * 0.6).select(
        "c_custkey", F.upper("c_name").alias("c_name"), "c_nationkey",
        F.expr("CASE WHEN c_custkey % 2 = 0 THEN c_acctbal ELSE c_acctbal + 1 END").alias("c_acctbal"),
        (F.col("c_custkey") % 7).alias("stamp"))
    return target, source


@query("MRG-02", f"""
    WITH {SPLIT} SELECT * FROM target UNION ALL SELECT s.* FROM source s WHERE s.c_custkey NOT IN (SELECT c_custkey FROM target)""")
def merge_insert_only(spark, d):
    return M.merge_insert_only(*_split(spark, d), ["c_custkey"])


@query("MRG-03 MRG-20", f"""
    WITH {SPLIT} SELECT * FROM source UNION ALL SELECT t.* FROM target t WHERE t.c_custkey NOT IN (SELECT c_custkey FROM source)""")
def merge_upsert(spark, d):
    return M.merge_upsert(*_split(spark, d), ["c_custkey"])


@query("MRG-04", f"""
    WITH {SPLIT}, t AS (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 11 END AS part FROM target),
    s AS (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 11 END AS part FROM source)
    SELECT s.c_custkey, s.part, s.c_acctbal FROM s
    UNION ALL SELECT t.c_custkey, t.part, t.c_acctbal FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.c_custkey = t.c_custkey AND s.part = t.part)""")
def merge_upsert_compound(spark, d):
    part = F.expr("CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 11 END").alias("part")
    target, source = (x.select("c_custkey", part, "c_acctbal") for x in _split(spark, d))
    return M.merge_upsert(target, source, ["c_custkey", "part"])


@query("MRG-05 STR-08", f"""
    WITH {SPLIT}
    SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(t.c_name, s.c_name) AS c_name, coalesce(t.c_nationkey, s.c_nationkey) AS c_nationkey,
           CASE WHEN t.c_custkey IS NULL OR s.stamp > t.stamp THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
           CASE WHEN t.c_custkey IS NULL OR s.stamp > t.stamp THEN s.stamp ELSE t.stamp END AS stamp
    FROM target t FULL JOIN source s ON s.c_custkey = t.c_custkey""")
def merge_newer(spark, d):
    return M.merge_newer(*_split(spark, d), ["c_custkey"], "stamp", ["c_acctbal"])


@query("MRG-01", f"""
    WITH {SPLIT}
    SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
           CASE WHEN t.c_custkey IS NULL THEN 'new ' || s.c_name WHEN s.stamp = 0 THEN s.c_name ELSE t.c_name END AS c_name,
           CASE WHEN t.c_custkey IS NULL THEN s.c_nationkey WHEN s.c_custkey IS NOT NULL AND s.stamp <> 0 AND s.stamp > t.stamp THEN -s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
           t.c_acctbal, CASE WHEN t.c_custkey IS NULL THEN s.stamp ELSE t.stamp END AS stamp
    FROM target t FULL JOIN source s ON s.c_custkey = t.c_custkey WHERE t.c_custkey IS NOT NULL OR s.stamp <> 3""")
def merge_conditional(spark, d):
    target, source = _split(spark, d)
    return M.merge(
        target, source, ["c_custkey"],
        updates=(M.Update({"c_name": "s.c_name"}, "s.stamp = 0"), M.Update({"c_nationkey": "-s.c_nationkey"}, "s.stamp > t.stamp")),
        insert={"c_custkey": "s.c_custkey", "c_name": "concat('new ', s.c_name)", "c_nationkey": "s.c_nationkey", "stamp": "s.stamp"},
        insert_when="s.stamp <> 3")


@query("MRG-06 MRG-11", f"""
    WITH {SPLIT}, t AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS sid, *, sha256(CAST(c_custkey AS VARCHAR)) AS kh,
        sha256(CAST(c_nationkey AS VARCHAR) || chr(31) || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)) AS vh FROM target),
    s AS (SELECT *, sha256(CAST(c_custkey AS VARCHAR)) AS kh,
        sha256(CAST(c_nationkey AS VARCHAR) || chr(31) || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)) AS vh FROM source),
    n AS (SELECT (SELECT max(sid) FROM t) + row_number() OVER (ORDER BY s.c_custkey) AS sid, s.* FROM s WHERE kh NOT IN (SELECT kh FROM t))
    SELECT t.sid, t.kh AS "_keyHash", CASE WHEN s.vh <> t.vh THEN s.c_name ELSE t.c_name END AS c_name, coalesce(s.vh, t.vh) AS "_valueHash"
    FROM t LEFT JOIN s USING (kh) UNION ALL SELECT sid, kh, c_name, vh FROM n""")
def merge_hash_diff(spark, d):
    def hashed(df):
        return df.select("c_custkey", "c_name", row_hash(["c_custkey"]).alias("_keyHash"), row_hash(["c_nationkey", money("c_acctbal")]).alias("_valueHash"))

    target, source = (hashed(x) for x in _split(spark, d))
    numbered = D.assign_sk(target, "sid", ["c_custkey"], base=-1)
    return M.merge_hash_diff(numbered, source, order=["c_custkey"]).select("sid", "_keyHash", "c_name", "_valueHash")


@query("MRG-09", "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT coalesce(o_totalprice > 100000 AND o_orderstatus = 'F', false)")
def delete_where(spark, d):
    (orders,) = tables(spark, d, "orders")
    return M.delete_where(orders, "o_totalprice > 100000 AND o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")


@query("SNK-07", f"""
    WITH {SPLIT} SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal
    FROM target t FULL JOIN source s ON s.c_custkey = t.c_custkey""")
def apply_marked(spark, d):
    target, source = (x.select("c_custkey", "c_name", "c_acctbal") for x in _split(spark, d))
    known = target.select("c_custkey", F.lit("U").alias("_op"))
    changes = source.join(known, "c_custkey", "left").withColumn("_op", F.coalesce("_op", F.lit("I")))
    return M.apply_marked(target, changes, ["c_custkey"])


@query("MRG-20", "SELECT true AS refused, count(*) AS duplicate_keys FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)")
def merge_guard(spark, d):
    """A source with repeated keys is refused; the count of such keys is shown."""
    (lineitem,) = tables(spark, d, "lineitem")
    try:
        M.assert_unique(lineitem, ["l_orderkey"])
        refused = False
    except M.DuplicateSourceKeys:
        refused = True
    return A.duplicate_keys(lineitem, ["l_orderkey"]).agg(F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("duplicate_keys"))


# ------------------------------------------------------------- surrogate keys


@query("MRG-10", """
    SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS sk FROM orders""")
def assign_surrogate_keys(spark, d):
    (orders,) = tables(spark, d, "orders")
    return D.assign_sk(orders.select("o_orderkey", "o_totalprice"), "sk", ["o_totalprice", "o_orderkey"], base=1000).select("o_orderkey", "sk")


@query("MRG-12", "SELECT s_suppkey, md5(CAST(s_suppkey AS VARCHAR)) AS sk FROM supplier")
def hash_surrogate_keys(spark, d):
    (supplier,) = tables(spark, d, "supplier")
    return supplier.select("s_suppkey", hash_sk("s_suppkey").alias("sk"))


# ------------------------------------------------------------------ dimensions


@query("MRG-13 JON-05 AGG-12 JOB-04", """
    WITH a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'F'),
    b AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT d FROM a)),
    k AS (SELECT d, row_number() OVER (ORDER BY d) AS sk FROM a UNION ALL SELECT d, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY d) FROM b)
    SELECT sk AS "skDate", CAST(strftime(d, '%Y%m%d') AS BIGINT) AS "nkDateId", strftime(d, '%Y-%m-%d') AS date, year(d) AS year, month(d) AS month,
           day(d) AS "dayOfMonth", quarter(d) AS quarter FROM k""")
def scd0_dates(spark, d):
    (orders,) = tables(spark, d, "orders")
    first = load_dates(None, orders.filter("o_orderstatus = 'F'"), "o_orderdate")
    second = load_dates(first, orders, "o_orderdate")
    ints = {c: F.col(c).cast("long") for c in ("year", "month", "dayOfMonth", "quarter")}
    return second.withColumns({"date": F.col("date").cast("string"), **ints})


@query("MRG-07 MRG-12", f"""
    WITH {SPLIT} SELECT md5(CAST(c_custkey AS VARCHAR)) AS "SK_c_custkey", c_custkey AS "NK_c_custkey", c_name, c_acctbal,
      CASE WHEN c_custkey IN (SELECT c_custkey FROM target) THEN 1 ELSE 2 END AS created, CASE WHEN c_custkey IN (SELECT c_custkey FROM source) THEN 2 ELSE 1 END AS updated
    FROM (SELECT c_custkey, c_name, c_acctbal FROM source UNION ALL SELECT c_custkey, c_name, c_acctbal FROM target WHERE c_custkey NOT IN (SELECT c_custkey FROM source))""")
def scd1_dimension(spark, d):
    target, source = (x.select("c_custkey", "c_name", "c_acctbal") for x in _split(spark, d))
    old = D.scd1_members(target, "c_custkey", F.lit("2024-01-01 00:00:01").cast("timestamp"))
    new = D.scd1_members(source, "c_custkey", F.lit("2024-01-01 00:00:02").cast("timestamp"))
    dim = D.scd1(old, new, "c_custkey")
    return dim.withColumns({"created": F.second("dim_created_date"), "updated": F.second("dim_updated_date")}).drop("dim_created_date", "dim_updated_date")


def _stock(part: DataFrame, second: bool) -> DataFrame:
    """Versioned stock items: every 5th has a second version from 2000 on, which
    the second extract brings together with the closed first one."""
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    changed = F.col("p_partkey") % 5 == 0
    base = part.select(
        F.col("p_partkey").alias("nkStockItemId"), F.col("p_name").alias("itemDescription"), F.col("p_brand").alias("size"),
        F.col("p_size").alias("leadTimeDays"), (F.col("p_size") > 25).alias("isChillerRequired"), at("1990-01-01").alias("effectiveDate"),
        (F.when(changed, at("1999-12-31")).otherwise(at("9999-12-31")) if second else at("9999-12-31")).alias("expiryDate"))
    if not second:
        return base
    newer = part.filter(changed).select(
        F.col("p_partkey").alias("nkStockItemId"), F.upper("p_name").alias("itemDescription"), F.col("p_brand").alias("size"),
        F.col("p_size").alias("leadTimeDays"), (F.col("p_size") > 25).alias("isChillerRequired"), at("1999-12-31").alias("effectiveDate"),
        at("9999-12-31").alias("expiryDate"))
    return base.unionByName(newer)


ITEM_SQL = """
    base AS (SELECT p_partkey AS nk, p_name AS name, p_brand AS size, p_size AS lead, p_size > 25 AS chill, DATE '1990-01-01' AS eff FROM part),
    newer AS (SELECT nk, upper(name) AS name, size, lead, chill, DATE '1999-12-31' AS eff FROM base WHERE nk % 5 = 0),
    dim AS (
      SELECT row_number() OVER (ORDER BY nk) AS sk, *, nk % 5 <> 0 AS active, CASE WHEN nk % 5 = 0 THEN DATE '1999-12-31' ELSE DATE '9999-12-31' END AS exp FROM base
      UNION ALL SELECT (SELECT count(*) FROM base) + row_number() OVER (ORDER BY nk), *, true, DATE '9999-12-31' FROM newer)"""


def _item_dim(spark, d) -> DataFrame:
    (part,) = tables(spark, d, "part")
    first = load_items(None, _stock(part, False))
    return load_items(first, _stock(part, True))


def _item_rows(dim: DataFrame) -> DataFrame:
    return dim.select(
        F.col("skStockItem").alias("sk"), F.col("nkStockItemId").alias("nk"), F.col("itemDescription").alias("name"), "dataHash", "active",
        text("effectiveDate").alias("eff"), text("expiryDate").alias("exp"))


SCD2_SQL = f"""
    WITH {ITEM_SQL} SELECT sk, nk, name, sha256(name || size || CAST(lead AS VARCHAR) || CAST(chill AS VARCHAR)) AS "dataHash", active,
      strftime(eff, '%Y-%m-%d') AS eff, strftime(exp, '%Y-%m-%d') AS exp FROM dim"""


@query("MRG-08 JON-06 JON-07 JOB-04", SCD2_SQL)
def scd2_dimension(spark, d):
    return _item_rows(_item_dim(spark, d))


@query("MRG-08", SCD2_SQL)
def scd2_rerun(spark, d):
    """Loading the same extract again changes nothing."""
    (part,) = tables(spark, d, "part")
    return _item_rows(load_items(materialise(_item_dim(spark, d)), _stock(part, True)))


@query("MRG-08 AGG-27", f"WITH {ITEM_SQL} SELECT active, count(*) AS rows FROM dim GROUP BY 1")
def scd2_active_counts(spark, d):
    return A.distribution(_item_dim(spark, d), "active", count="rows")


@query("MRG-16", """
    SELECT strftime(ts, '%H%M%S') AS sid, CASE WHEN hour(ts) <= 5 THEN 'Night' WHEN hour(ts) <= 11 THEN 'Morning' WHEN hour(ts) <= 17 THEN 'Afternoon' ELSE 'Evening' END AS "dayPart",
           hour(ts) AS hour, minute(ts) AS minute, second(ts) AS second, count(*) AS rows FROM events GROUP BY ALL""")
def time_dimension(spark, d):
    (events,) = tables(spark, d, "events")
    counts = events.groupBy(F.date_format("ts", "HH:mm:ss").alias("time")).agg(F.count(F.lit(1)).alias("rows"))
    dim = D.dim_time(spark).join(counts, "time")
    return dim.select("sid", "dayPart", *[F.col(c).cast("long").alias(c) for c in ("hour", "minute", "second")], "rows")


# ----------------------------------------------------------------------- facts


@query("MRG-17 JON-10", """
    WITH l AS (SELECT event_id, user_id, value, ts, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT 'fact' AS part, count(*) AS rows, count(DISTINCT md5(CAST(k AS VARCHAR))) AS members FROM l
      WHERE k IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 <> 0) AND user_id IN (SELECT s_suppkey FROM supplier) AND event_id % 2 = 0
    UNION ALL SELECT 'rejected', count(*), count(DISTINCT k) FROM l
      WHERE NOT (k IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 <> 0) AND user_id IN (SELECT s_suppkey FROM supplier)) AND event_id % 2 = 0""")
def fact_with_rejects(spark, d):
    events, customer, supplier = tables(spark, d, "events", "customer", "supplier")
    rows = events.select(
        (F.col("event_id") - F.pmod("event_id", F.lit(2))).alias("event_id"), F.col("event_id").alias("seq"), "user_id", "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"))
    rows = rows.filter("seq % 2 = 0").unionByName(rows.filter("seq % 2 = 1").withColumn("seq", F.lit(-1).cast("long")))
    accepted, rejected = build_fact(
        rows,
        [Lookup(customer.filter("c_custkey % 9 <> 0").withColumn("SK", hash_sk("c_custkey")), {"k": "c_custkey"}, {"SK": "SK_customer"}),
         Lookup(supplier.withColumn("SK", hash_sk("s_suppkey")), {"user_id": "s_suppkey"}, {"SK": "SK_supplier"})],
        "event_id", ["value", "k"], [F.desc("seq")])
    return A.union_all([
        accepted.agg(F.lit("fact").alias("part"), F.count(F.lit(1)).alias("rows"), F.countDistinct("SK_customer").alias("members")),
        rejected.agg(F.lit("rejected").alias("part"), F.count(F.lit(1)).alias("rows"), F.countDistinct("k").alias("members")),
    ])


def _readings(spark, d) -> DataFrame:
    (events,) = tables(spark, d, "events")
    return events.select(
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("meterId"), money("value").alias("measurementInKWh"),
        (F.col("user_id") % 30).alias("zipCode"), F.col("ts").alias("measurementDate"))


@query("MRG-18 JON-11 MRG-06 MRG-11 MRG-16 JOB-03", """
    WITH m AS (SELECT s_suppkey, row_number() OVER (ORDER BY 'M' || s_suppkey) - 1 AS sid FROM supplier WHERE s_suppkey % 10 <> 0),
    z AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS sid FROM nation)
    SELECT coalesce(m.sid, -1) AS "meterSid", coalesce(z.sid, -1) AS "serviceLocationSid", strftime(ts, '%Y%m%d') AS "measurementDateSid",
           strftime(ts, '%H%M%S') AS "measurementTimeSid", value AS "powerConsumptedKwh"
    FROM events LEFT JOIN m ON s_suppkey = user_id LEFT JOIN z ON n_nationkey = user_id % 30""")
def fact_consumption(spark, d):
    supplier, nation = tables(spark, d, "supplier", "nation")
    readings = _readings(spark, d)
    members = supplier.filter("s_suppkey % 10 <> 0").select(
        F.concat(F.lit("M"), F.col("s_suppkey").cast("string")).alias("meterId"), "s_name",
        row_hash(["s_suppkey"]).alias("_keyHash"), row_hash(["s_name"]).alias("_valueHash"))
    places = nation.select(F.col("n_nationkey").cast("long").alias("zipCode"), "n_name", row_hash(["n_nationkey"]).alias("_keyHash"), row_hash(["n_name"]).alias("_valueHash"))
    meters, zips = load_dimension(None, members, ["meterId"]), load_dimension(None, places, ["zipCode"])
    bounds = readings.agg(F.min(F.to_date("measurementDate")), F.max(F.to_date("measurementDate"))).first()
    dates = D.dim_date(spark, str(bounds[0]), str(bounds[1]), "compact")
    rows = consumption_rows(readings, consumption_lookups(meters, zips, dates, D.dim_time(spark)))
    return rows.drop("_keyHash", "_valueHash").withColumn("powerConsumptedKwh", F.col("powerConsumptedKwh").cast("double"))


def _invoice_lines(spark, d, changed: bool) -> tuple[DataFrame, DataFrame]:
    """Orders as invoices; one line per order, part and line number. The second
    extract has all orders and other quantities where the part number ends in 0."""
    orders, lineitem = tables(spark, d, "orders", "lineitem")
    invoices = orders.select(F.col("o_orderkey").alias("nkInvoiceId"), F.col("o_orderdate").alias("nkInvoiceDate"))
    merged = lineitem.groupBy("l_orderkey", "l_partkey", "l_linenumber").agg(
        F.sum(money("l_quantity")).alias("q"), F.sum(money("l_extendedprice")).alias("p"))
    quantity = F.when(F.col("l_partkey") % 10 == 0, F.col("q") + 1).otherwise(F.col("q")) if changed else F.col("q")
    lines = merged.select(
        F.col("l_orderkey").alias("nkInvoiceId"), F.col("l_partkey").alias("nkStockItemId"), F.col("l_linenumber").alias("lineNo"),
        quantity.cast("long").alias("quantity"), F.col("p").cast("decimal(18,2)").alias("unitPrice"))
    if not changed:
        invoices = invoices.filter("nkInvoiceId % 2 = 0")
        lines = lines.filter("nkInvoiceId % 2 = 0")
    return invoices, lines


@query("MRG-19 JON-05 JON-06 JON-08 JON-09 JOB-04", f"""
    WITH {ITEM_SQL}, days AS (SELECT d, row_number() OVER (ORDER BY d) AS sk FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)),
    l AS (SELECT l_orderkey, l_partkey, l_linenumber, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS p FROM lineitem GROUP BY 1, 2, 3)
    SELECT l_orderkey AS "invoiceId", l_partkey AS item, l_linenumber AS line, days.sk AS "skInvoiceDate",
           (SELECT max_by(dim.sk, dim.eff) FROM dim WHERE dim.nk = l_partkey AND dim.eff <= o_orderdate AND o_orderdate <= dim.exp) AS "skStockItem",
           CAST(q AS BIGINT) + CASE WHEN l_partkey % 10 = 0 THEN 1 ELSE 0 END AS quantity, CAST(p AS DOUBLE) AS price
    FROM l JOIN orders ON o_orderkey = l_orderkey JOIN days ON days.d = CAST(o_orderdate AS DATE)""")
def fact_transactions(spark, d):
    """Two loads: half of the invoices, then all with changed quantities."""
    (orders,) = tables(spark, d, "orders")
    with dropped_shuffles(spark):
        dates, items = in_parallel(
            lambda: materialise(load_dates(None, orders, "o_orderdate")), lambda: materialise(_item_dim(spark, d)))
        measures = {"quantity": "quantity", "unitPrice": "unitPrice", "item": "nkStockItemId", "line": "lineNo"}
        ids = ("nkInvoiceId", "nkInvoiceDate", "nkStockItemId", "lineNo")
        fact = None
        for changed in (False, True):
            invoices, lines = _invoice_lines(spark, d, changed)
            fact = materialise(load_fact(fact, lines, invoices, dates, items, id_cols=ids, measures=measures), "fact", compression="zstd")
    return fact.select("invoiceId", "item", "line", "skInvoiceDate", "skStockItem", "quantity", F.col("unitPrice").cast("double").alias("price"))


# ------------------------------------------------------------- snapshot tables


def _snapshot(spark, d) -> SnapshotTable:
    """A new table: three commits and a compaction."""
    target, source = _split(spark, d)
    table = SnapshotTable(spark, scratch_path(spark, "snapshot-table"), ["c_custkey"], target.schema, buckets=8)
    table.overwrite(target)
    for _ in range(2):  # the second time is a replay and commits nothing
        table.merge(source, _newer_plan, writer="load", batch_id=0)
    table.delete_where("c_nationkey = 3")
    table.compact()
    return table


def _newer_plan(t: DataFrame, s: DataFrame) -> DataFrame:
    return M.merge_newer(t, s, ["c_custkey"], "stamp", ["c_acctbal"], check_unique=False, mark_changes=True)


NEWER = f"""
    {SPLIT}, newer AS (
      SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(t.c_nationkey, s.c_nationkey) AS c_nationkey,
             CASE WHEN t.c_custkey IS NULL OR s.stamp > t.stamp THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
             CASE WHEN t.c_custkey IS NULL THEN 'insert' WHEN s.stamp > t.stamp THEN 'update' END AS change
      FROM target t FULL JOIN source s ON s.c_custkey = t.c_custkey)"""


@query("MRG-21 MRG-22 MRG-09 STR-07", f"WITH {NEWER} SELECT c_custkey, c_nationkey, c_acctbal FROM newer WHERE c_nationkey <> 3")
def snapshot_table(spark, d):
    return _snapshot(spark, d).read().select("c_custkey", "c_nationkey", "c_acctbal")


@query("MRG-21 STR-07", f"""
    WITH {NEWER} SELECT 1::BIGINT AS version, 'overwrite' AS operation, (SELECT count(*) FROM target) AS inserted, 0::BIGINT AS updated
    UNION ALL SELECT 2, 'merge', count(*) FILTER (WHERE change = 'insert'), count(*) FILTER (WHERE change = 'update') FROM newer
    UNION ALL SELECT 3, 'delete', 0, 0 UNION ALL SELECT 4, 'compact', 0, 0""")
def snapshot_history(spark, d):
    return _snapshot(spark, d).history().select("version", "operation", "inserted", "updated")


@query("STR-09", f"""
    WITH {NEWER} SELECT c_custkey, c_acctbal, change, 2::BIGINT AS version FROM newer WHERE change IS NOT NULL""")
def change_feed(spark, d):
    feed = _snapshot(spark, d).change_feed(after_version=1)
    return feed.select("c_custkey", "c_acctbal", F.col(M.CHANGE).alias("change"), F.col("_commit_version").alias("version"))
