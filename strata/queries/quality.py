"""Data quality over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.aggregates import union_all
from strata.queries.registry import query
from strata.sources import tables

# Fixed rules for event rows; the oracle statements repeat them in SQL.
RULES = [
    Q.schema_fits(),
    Q.Rule("user_id", "user_id IS NOT NULL AND user_id % 17 <> 0", "user_id", "Missing user", "MISSING_KEY"),
    Q.between("value", 5.0, 200.0, "value must be 5-200"),
    Q.one_of("event_type", ["click", "view", "purchase", "error"], "unknown type"),
]

FLAGGED = """
    f AS (
      SELECT *, k % 10 <> 0 AS s_ok, user_id % 17 <> 0 AS u_ok, value BETWEEN 5.0 AND 200.0 AS v_ok,
             event_type IN ('click', 'view', 'purchase', 'error') AS t_ok
      FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""
CATEGORY = """CASE WHEN NOT s_ok THEN 'SCHEMA_MISMATCH' WHEN NOT u_ok THEN 'MISSING_KEY' WHEN NOT v_ok THEN 'INVALID_VALUE'
      WHEN NOT t_ok THEN 'INVALID_VALUE' ELSE 'OTHER' END"""
REASON = """concat_ws('; ', CASE WHEN NOT s_ok THEN 'Schema mismatch: rescued data present' END, CASE WHEN NOT u_ok THEN 'Missing user' END,
      CASE WHEN NOT v_ok THEN 'value must be 5-200' END, CASE WHEN NOT t_ok THEN 'unknown type' END)"""
FAILED = """concat_ws(',', CASE WHEN NOT s_ok THEN '_rescued_data' END, CASE WHEN NOT u_ok THEN 'user_id' END,
      CASE WHEN NOT v_ok THEN 'value' END, CASE WHEN NOT t_ok THEN 'event_type' END)"""


def _events(spark, d) -> DataFrame:
    """Events with a rescued-data text wherever the k property ends in 0."""
    (events,) = tables(spark, d, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return events.withColumn("_rescued_data", F.when(k % 10 == 0, F.col("props")))


@query("DQ-01 DQ-06", f"WITH {FLAGGED} SELECT event_id, s_ok, u_ok, v_ok, t_ok, s_ok AND u_ok AND v_ok AND t_ok AS dq_pass FROM f")
def dq_flags(spark, d):
    flagged = Q.with_flags(_events(spark, d), RULES)
    return flagged.select("event_id", *[F.col(r.flag).alias(n) for r, n in zip(RULES, ["s_ok", "u_ok", "v_ok", "t_ok"])], "dq_pass")


@query("DQ-02 DQ-03", f"""
    WITH {FLAGGED} SELECT event_id, {CATEGORY} AS category, {REASON} AS reason, {FAILED} AS failed FROM f""")
def dq_reasons(spark, d):
    flagged = Q.with_flags(_events(spark, d), RULES)
    return flagged.select("event_id", Q.category(RULES).alias("category"), F.array_join(Q.reasons(RULES), "; ").alias("reason"),
                          F.array_join(Q.failed_columns(RULES), ",").alias("failed"))


def _quarantine(spark, d) -> DataFrame:
    routed = Q.route(_events(spark, d), RULES, ["event_id"], [F.desc("ts")])
    return Q.to_quarantine(routed.failed, RULES, dataset="events", table_name="silver_events", layer="silver",
                           keys=["event_id", "user_id"], run_id="run-1")


@query("DQ-04 DQ-05", f"""
    WITH {FLAGGED} SELECT 'events' AS dataset, 'silver_events' AS table_name, 'silver' AS layer, 'event_id=' || event_id || ',user_id=' || user_id AS record_key,
      {CATEGORY} AS dq_category, {REASON} AS dq_reason, {FAILED} AS failed_columns, CASE WHEN NOT s_ok THEN props ELSE CAST(event_id AS VARCHAR) END AS original_record,
      'run-1' AS pipeline_run_id, false AS is_resolved, CAST(NULL AS VARCHAR) AS resolution_notes
    FROM f WHERE NOT (s_ok AND u_ok AND v_ok AND t_ok)""")
def dq_quarantine(spark, d):
    rows = _quarantine(spark, d)
    key = F.concat_ws(",", *[F.concat(F.lit(f"{k}="), F.col("record_key")[k]) for k in ("event_id", "user_id")])
    original = F.coalesce(F.get_json_object("original_record", "$.event_id"), F.col("original_record"))
    return rows.withColumns({"record_key": key, "failed_columns": F.array_join("failed_columns", ","), "original_record": original}).drop(
        "quarantine_timestamp", "resolved_timestamp")


@query("DQ-14", f"""
    WITH {FLAGGED} SELECT 'events' AS dataset, 'silver' AS layer, {CATEGORY} AS dq_category, {REASON} AS dq_reason, {FAILED} AS failed_columns, count(*) AS issues
    FROM f WHERE NOT (s_ok AND u_ok AND v_ok AND t_ok) GROUP BY ALL""")
def dq_report(spark, d):
    return Q.issue_report(_quarantine(spark, d))


@query("DQ-05 WIN-01", f"""
    WITH {FLAGGED}, p AS (SELECT * FROM f WHERE s_ok AND u_ok AND v_ok AND t_ok QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1)
    SELECT 'passed' AS route, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM p
    UNION ALL SELECT 'schema', count(*), sum(event_id)::BIGINT FROM f WHERE NOT s_ok
    UNION ALL SELECT 'rules', count(*), sum(event_id)::BIGINT FROM f WHERE s_ok AND NOT (u_ok AND v_ok AND t_ok)""")
def dq_route(spark, d):
    routed = Q.route(_events(spark, d), RULES, ["user_id", "event_type"], [F.desc("ts"), F.asc("event_id")])
    return _routes(routed)


@query("DQ-05 WIN-01", f"""
    WITH {FLAGGED}, l AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1)
    SELECT 'passed' AS route, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM l WHERE s_ok AND u_ok AND v_ok AND t_ok
    UNION ALL SELECT 'schema', count(*), sum(event_id)::BIGINT FROM l WHERE NOT s_ok
    UNION ALL SELECT 'rules', count(*), sum(event_id)::BIGINT FROM l WHERE s_ok AND NOT (u_ok AND v_ok AND t_ok)""")
def dq_route_latest_first(spark, d):
    """Latest row first, then rules."""
    routed = Q.route(_events(spark, d), RULES, ["user_id", "event_type"], [F.desc("ts"), F.asc("event_id")], dedup="before")
    return _routes(routed)


def _routes(routed: Q.Routed) -> DataFrame:
    parts = {"passed": routed.passed, "schema": routed.schema_failed, "rules": routed.rule_failed}
    return union_all([
        df.agg(F.lit(name).alias("route"), F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")) for name, df in parts.items()
    ])


@query("DQ-05", f"WITH {FLAGGED} SELECT count(*) AS rows, count(*) FILTER (WHERE p) AS passed, count(*) FILTER (WHERE NOT p) AS failed FROM (SELECT s_ok AND u_ok AND v_ok AND t_ok AS p FROM f)")
def dq_route_counts(spark, d):
    return Q.route_counts(Q.with_flags(_events(spark, d), RULES))


@query("DQ-07 DQ-08 DQ-10", """
    SELECT count(*) FILTER (WHERE l_quantity IS NULL OR l_shipdate IS NULL OR CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_tax END IS NULL) AS incomplete_rows,
           min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity, min(l_discount) AS min_l_discount, max(l_discount) AS max_l_discount,
           count(*) FILTER (WHERE l_shipdate < '1996-01-01' OR l_shipdate >= '2000-01-01') AS outside_period FROM lineitem""")
def dq_checks(spark, d):
    from strata.operators.joins import with_scalar

    (lineitem,) = tables(spark, d, "lineitem")
    holes = lineitem.withColumn("l_tax", F.expr("CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_tax END"))
    out = Q.count_nulls(holes, ["l_quantity", "l_shipdate", "l_tax"])
    out = with_scalar(out, Q.value_range(lineitem, ["l_quantity", "l_discount"]))
    return with_scalar(out, Q.check_period(lineitem, "l_shipdate", "1996-01-01", "2000-01-01"))


@query("DQ-09", """
    SELECT o_orderkey, l_partkey, l_linenumber, l_suppkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderdate >= l_shipdate""")
def dq_order_of_dates(spark, d):
    lineitem, orders = tables(spark, d, "lineitem", "orders")
    trips = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
    return Q.check_order(trips, "o_orderdate", "l_shipdate").select("o_orderkey", "l_partkey", "l_linenumber", "l_suppkey")


@query("DQ-11 JOB-06 PRJ-12", """
    SELECT l_returnflag, count(*) AS rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS fare, CAST(sum(CAST(l_linenumber AS INTEGER)) AS BIGINT) AS lines FROM lineitem
    WHERE l_quantity > 5 AND l_discount > 0 AND l_extendedprice BETWEEN 1000 AND 75000 GROUP BY 1""")
def dq_clean(spark, d):
    (lineitem,) = tables(spark, d, "lineitem")
    raw = lineitem.withColumn("l_linenumber", F.col("l_linenumber").cast("string"))
    rows = Q.clean(raw, ["l_quantity > 5", "l_discount > 0", "l_extendedprice BETWEEN 1000 AND 75000"],
                   {"l_extendedprice": "decimal(10,2)", "l_linenumber": "int"})
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("l_extendedprice").cast("double").alias("fare"), F.sum("l_linenumber").alias("lines"))


PRIMARY = {"customer": ["c_custkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"]}
FOREIGN = [
    ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("events", "user_id", "supplier", "s_suppkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
]


def _audit_sql() -> str:
    parts = []
    for t, keys in PRIMARY.items():
        cols, any_null = ", ".join(keys), " OR ".join(f"{k} IS NULL" for k in keys)
        parts.append(f"SELECT '{t}' AS table_name, 'null key' AS \"check\", '{','.join(keys)}' AS columns, count(*) AS violations FROM {t} WHERE {any_null}")
        parts.append(f"SELECT '{t}', 'duplicate key', '{','.join(keys)}', count(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1)")
    for t, c, p, pc in FOREIGN:
        parts.append(f"SELECT '{t}', 'orphan', '{c}->{p}.{pc}', count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {p})")
    return " UNION ALL ".join(parts)


@query("DQ-13 AGG-11", _audit_sql())
def key_audit(spark, d):
    names = ["customer", "orders", "lineitem", "events", "supplier", "nation"]
    return Q.audit_keys(dict(zip(names, tables(spark, d, *names))), PRIMARY, FOREIGN)
