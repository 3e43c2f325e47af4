"""Data quality: rules as data, flags, routing, the shared quarantine layout,
and the profile checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions.cleaning import to_ts
from strata.operators.aggregates import union_all
from strata.operators.windows import latest_per_key

# Fixed layout shared by every layer.
QUARANTINE_SCHEMA = (
    "dataset string, table_name string, layer string, record_key map<string,string>, dq_category string, "
    "dq_reason string, failed_columns array<string>, original_record string, pipeline_run_id string, "
    "quarantine_timestamp timestamp, is_resolved boolean, resolved_timestamp timestamp, resolution_notes string"
)
SCHEMA_RULE = "schema"


@dataclass(frozen=True)
class Rule:
    """One row rule. ``check`` is an SQL condition that must be true; null fails.

    Rules are tried in order for the category, so list the weightiest first.
    """

    name: str
    check: str
    column: str
    reason: str
    category: str = "BUSINESS_RULE"

    @property
    def flag(self) -> str:
        return f"dq_{self.name}_valid"

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.check), F.lit(False))


def required(column: str, reason: str | None = None, category: str = "MISSING_KEY") -> Rule:
    return Rule(column, f"`{column}` IS NOT NULL", column, reason or f"Missing {column}", category)


def between(column: str, low: float, high: float, reason: str | None = None, category: str = "INVALID_VALUE") -> Rule:
    return Rule(column, f"`{column}` BETWEEN {low} AND {high}", column, reason or f"{column} must be {low}-{high}", category)


def parses_as(column: str, dtype: str, reason: str | None = None, category: str = "INVALID_VALUE") -> Rule:
    return Rule(column, f"try_cast(`{column}` AS {dtype}) IS NOT NULL", column, reason or f"{column} is no {dtype}", category)


def one_of(column: str, values: Sequence[str], reason: str | None = None, category: str = "INVALID_VALUE") -> Rule:
    listed = ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)
    return Rule(column, f"`{column}` IN ({listed})", column, reason or f"{column} is not in the list", category)


def schema_fits(column: str = "_rescued_data") -> Rule:
    return Rule(SCHEMA_RULE, f"`{column}` IS NULL", column, "Schema mismatch: rescued data present", "SCHEMA_MISMATCH")


def with_flags(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One boolean per rule and ``dq_pass`` for all of them."""
    flagged = df.withColumns({r.flag: r.holds() for r in rules})
    passed = F.lit(True)
    for r in rules:
        passed = passed & F.col(r.flag)
    return flagged.withColumn("dq_pass", passed)


def category(rules: Sequence[Rule], default: str = "OTHER") -> Column:
    """Category of the first failed rule."""
    out = None
    for r in rules:
        failed = ~F.col(r.flag)
        out = F.when(failed, r.category) if out is None else out.when(failed, r.category)
    return F.lit(default) if out is None else out.otherwise(default)


def _failed(rules: Sequence[Rule], value) -> Column:
    return F.array_compact(F.array(*[F.when(~F.col(r.flag), F.lit(value(r))) for r in rules]))


def reasons(rules: Sequence[Rule]) -> Column:
    return _failed(rules, lambda r: r.reason)


def failed_columns(rules: Sequence[Rule]) -> Column:
    return F.array_distinct(_failed(rules, lambda r: r.column))


def to_quarantine(
    df: DataFrame, rules: Sequence[Rule], *, dataset: str, table_name: str, layer: str, keys: Sequence[str],
    run_id: str, default_category: str = "OTHER", rescued: str | None = "_rescued_data", at: Column | None = None,
) -> DataFrame:
    """Flagged, failed rows in the shared 13-column layout."""
    own = [c for c in df.columns if not c.startswith("dq_")]
    original = F.to_json(F.struct(*own))
    if rescued and rescued in df.columns:
        original = F.coalesce(F.col(rescued), original)
    pairs = [part for k in keys for part in (F.lit(k), F.col(k).cast("string"))]
    return df.select(
        F.lit(dataset).alias("dataset"), F.lit(table_name).alias("table_name"), F.lit(layer).alias("layer"),
        F.create_map(*pairs).alias("record_key"), category(rules, default_category).alias("dq_category"),
        F.array_join(reasons(rules), "; ").alias("dq_reason"), failed_columns(rules).alias("failed_columns"),
        original.alias("original_record"), F.lit(run_id).alias("pipeline_run_id"),
        (at if at is not None else F.current_timestamp()).cast("timestamp").alias("quarantine_timestamp"),
        F.lit(False).alias("is_resolved"), F.lit(None).cast("timestamp").alias("resolved_timestamp"),
        F.lit(None).cast("string").alias("resolution_notes"),
    )


@dataclass(frozen=True)
class Routed:
    passed: DataFrame
    schema_failed: DataFrame
    rule_failed: DataFrame

    @property
    def failed(self) -> DataFrame:
        return self.schema_failed.unionByName(self.rule_failed)


def route(
    df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], order: Sequence[Column], dedup: str = "after"
) -> Routed:
    """Split rows into passed, schema-failed and rule-failed.

    ``dedup="after"`` keeps the latest *good* row per key and quarantines every
    bad row. ``"before"`` takes the latest row per key first; a newer bad row
    then hides an older good one, and all rows without a key count as one.
    """
    if dedup not in ("after", "before"):
        raise ValueError("dedup is 'after' or 'before'")
    rows = latest_per_key(df, keys, order) if dedup == "before" else df
    flagged = with_flags(rows, rules)
    schema_flags = [r.flag for r in rules if r.name == SCHEMA_RULE]
    fits = F.col(schema_flags[0]) if schema_flags else F.lit(True)
    passed = flagged.filter("dq_pass")
    if dedup == "after":
        passed = latest_per_key(passed, keys, order)
    return Routed(passed, flagged.filter(~fits), flagged.filter(fits & ~F.col("dq_pass")))


def observed_routes(df: DataFrame, rules: Sequence[Rule], counted: Observation) -> DataFrame:
    """The failed rows, flagged. Whatever writes them fills ``counted`` in the
    same pass: rows passed, schema_failed and rule_failed."""
    flagged = with_flags(df, rules)
    schema_flags = [r.flag for r in rules if r.name == SCHEMA_RULE]
    fits = F.col(schema_flags[0]) if schema_flags else F.lit(True)
    seen = flagged.observe(
        counted, F.count_if("dq_pass").alias("passed"), F.count_if(~fits).alias("schema_failed"), F.count_if(fits & ~F.col("dq_pass")).alias("rule_failed"))
    return seen.filter(~F.col("dq_pass"))


def route_counts(flagged: DataFrame) -> DataFrame:
    """Passed and failed rows in one pass."""
    return flagged.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("dq_pass").alias("passed"), F.count_if(~F.col("dq_pass")).alias("failed")
    )


def count_nulls(df: DataFrame, cols: Sequence[str], out: str = "incomplete_rows") -> DataFrame:
    """Completeness: rows in which any mandatory column is null."""
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull()
    return df.agg(F.count_if(missing).alias(out))


def value_range(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Validity: smallest and largest value per column."""
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))])


def check_order(df: DataFrame, start: str, end: str) -> DataFrame:
    """Consistency: rows that do not start before they end."""
    return df.filter(F.col(start) >= F.col(end))


def check_period(df: DataFrame, ts: str, first: str, last: str, out: str = "outside_period") -> DataFrame:
    """Timeliness: rows outside [first, last)."""
    outside = (F.col(ts) < F.lit(first).cast("timestamp_ntz")) | (F.col(ts) >= F.lit(last).cast("timestamp_ntz"))
    return df.agg(F.count_if(outside).alias(out))


def clean(df: DataFrame, conditions: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    """Rows that meet every condition, in the target types."""
    out = df
    for condition in conditions:
        out = out.filter(condition)
    return out.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def reconcile(stated: DataFrame, actual: DataFrame, key: str, stated_count: str, out: str = "actual_count") -> DataFrame:
    """Stated against counted rows per key."""
    counted = actual.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    joined = stated.join(counted, key, "left")
    return joined.withColumn("difference", F.coalesce(F.col(out), F.lit(0)) - F.col(stated_count))


def audit_keys(
    tables: Mapping[str, DataFrame], primary: Mapping[str, Sequence[str]],
    foreign: Sequence[tuple[str, str, str, str]] = (),
) -> DataFrame:
    """Undeclared constraints checked: null keys, duplicate keys, orphans.

    ``foreign`` lists ``(table, column, parent table, parent column)``. Orphans
    are counted per distinct value, so a hot orphan costs one row in the join.
    """
    found = []
    for name, keys in primary.items():
        # Both checks come out of one count per key.
        missing = F.lit(False)
        for k in keys:
            missing = missing | F.col(k).isNull()
        counted = tables[name].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("_nulls"),
            F.count_if(~missing & (F.col("_n") > 1)).alias("_twice"),
        )
        both = F.explode(F.array(
            F.struct(F.lit("null key").alias("check"), F.col("_nulls").alias("violations")),
            F.struct(F.lit("duplicate key").alias("check"), F.col("_twice").alias("violations")),
        ))
        found.append(counted.select(both.alias("b")).select(
            F.lit(name).alias("table_name"), "b.check", F.lit(",".join(keys)).alias("columns"), "b.violations"
        ))
    for child, column, parent, parent_column in foreign:
        values = tables[child].filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        known = tables[parent].select(F.col(parent_column).alias("_p"))
        orphans = values.join(known, F.col("_v") == F.col("_p"), "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))
        found.append(orphans.select(F.lit(child).alias("table_name"), F.lit("orphan").alias("check"),
                                    F.lit(f"{column}->{parent}.{parent_column}").alias("columns"), "violations"))
    return union_all(found)


def issue_report(quarantine: DataFrame) -> DataFrame:
    """Open issues by category, reason and failed columns."""
    return quarantine.groupBy(
        "dataset", "layer", "dq_category", "dq_reason", F.array_join("failed_columns", ",").alias("failed_columns")
    ).agg(F.count(F.lit(1)).alias("issues"))


def parseable(column: str) -> Column:
    return to_ts(column).isNotNull()
