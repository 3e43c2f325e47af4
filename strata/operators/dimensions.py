"""Surrogate keys and dimensions: date, time of day, SCD type 0, 1 and 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.functions.hashing import hash_sk, row_hash
from strata.operators.merge import Update, merge
from strata.operators.windows import latest_per_key, row_tie_break
from strata.session import broadcast_if_small, materialise

_POSITION = (1 << 33) - 1  # lower bits of monotonically_increasing_id


def assign_sk(df: DataFrame, sk: str, order: Sequence[str], base: int | DataFrame = 0) -> DataFrame:
    """Consecutive keys ``base + 1, base + 2, ...`` in the given order.

    Rows are range-partitioned and sorted, written once with their place in
    the partition, and shifted by the sizes of the partitions before. No task
    ever sees more than its own range. Without an ``order`` rows are numbered as
    they lie, with neither a shuffle nor a sort. ``base`` may be a one-row
    aggregate, such as the highest key of the dimension.
    """
    by = [F.col(c) for c in order] + [row_tie_break(df)]
    lying = df.repartitionByRange(*by).sortWithinPartitions(*by) if order else df
    return numbered(materialise(with_places(lying), "numbered"), sk, base)


def with_places(df: DataFrame) -> DataFrame:
    """Rows with their partition and place in it. To be written before
    ``numbered`` reads them, so that every later read sees the same places."""
    return (
        df.withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION)))
    )


def numbered(placed: DataFrame, sk: str, base: int | DataFrame = 0) -> DataFrame:
    """Written rows of ``with_places`` with consecutive keys after ``base``."""
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition, so neither this window nor the broadcast grows with the data.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    start = base.select(base.columns[0]).scalar() if isinstance(base, DataFrame) else F.lit(base)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(sk, start.cast("long") + F.col("_offset") + F.col("_place") + 1)
        .drop("_part", "_place", "_offset")
    )


def max_sk(dim: DataFrame, sk: str, empty: int = 0) -> DataFrame:
    return dim.agg(F.coalesce(F.max(sk), F.lit(empty)).cast("long").alias("max_sk"))


def _days(spark: SparkSession, start: str, end: str) -> DataFrame:
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("d"))


def dim_date(spark: SparkSession, start: str, end: str, style: str = "full") -> DataFrame:
    """Date dimension: ``full`` with names, flags and MD5 key, ``compact`` with
    a ``yyyyMMdd`` key. Weekday 1 is Sunday; weeks are ISO weeks."""
    days = _days(spark, start, end)
    d = F.col("d")
    if style == "compact":
        return days.select(
            d.alias("calendarDate"), F.date_format(d, "yyyyMMdd").alias("sid"),
            F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("dayofmonth"),
            F.dayofweek(d).alias("dayofweek"), F.quarter(d).alias("quarter"),
        )
    number = F.date_format(d, "yyyyMMdd").cast("int")
    weekday = F.dayofweek(d)
    return days.select(
        hash_sk(number).alias("SK_date_id"), number.alias("NK_date_id"), d.alias("date_actual"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_abbr"),
        F.weekofyear(d).alias("week_of_year"), weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "EEE").alias("day_abbr"),
        F.dayofmonth(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"),
        weekday.isin(1, 7).alias("is_weekend"), weekday.between(2, 6).alias("is_weekday"),
        F.date_format(d, "yyyy-MM-dd").alias("date_yyyymmdd"), F.date_format(d, "MM/dd/yyyy").alias("date_mmddyyyy"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """Time-of-day dimension: 86,400 seconds, text keys ``HHmmss``."""
    second = F.col("id")
    h, m, s = (second / 3600).cast("int"), (second % 3600 / 60).cast("int"), (second % 60).cast("int")
    part = (
        F.when(F.col("hour") <= 5, "Night").when(F.col("hour") <= 11, "Morning")
        .when(F.col("hour") <= 17, "Afternoon").otherwise("Evening")
    )
    return spark.range(86_400).select(
        F.format_string("%02d%02d%02d", h, m, s).alias("sid"),
        F.format_string("%02d:%02d:%02d", h, m, s).alias("time"),
        h.alias("hour"), m.alias("minute"), s.alias("second"),
    ).withColumn("dayPart", part)


def merge_static(existing: DataFrame | None, generated: DataFrame, key: str) -> DataFrame:
    """Re-generate a static dimension into what exists: same keys are
    overwritten, new ones added, others kept."""
    return generated if existing is None else merge(existing, generated, [key], check_unique=False)


def scd0(dim: DataFrame, members: DataFrame, natural_key: str, sk: str, order: Sequence[str]) -> DataFrame:
    """Type 0: only members not seen before are added; nothing ever changes."""
    known = dim.select(F.col(natural_key).alias("_known"))
    unseen = members.join(known, F.col(natural_key) == F.col("_known"), "left_anti")
    added = assign_sk(unseen, sk, order, base=max_sk(dim, sk))
    return dim.unionByName(added.select(*dim.columns))


def invoice_dates(invoices: DataFrame, date: str) -> DataFrame:
    """Calendar members (without surrogate key) for the distinct days of a table."""
    d = F.col("date")
    return invoices.select(F.to_date(date).alias("date")).distinct().select(
        F.date_format(d, "yyyyMMdd").cast("long").alias("nkDateId"), d,
        F.year(d).alias("year"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("dayOfMonth"), F.quarter(d).alias("quarter"),
    )


def scd1_members(source: DataFrame, natural_key: str, now: Column | None = None) -> DataFrame:
    """Source rows in type 1 layout: ``SK_``/``NK_`` keys and dimension dates."""
    at = now if now is not None else F.current_timestamp()
    rest = [c for c in source.columns if c != natural_key]
    return source.select(
        hash_sk(natural_key).alias(f"SK_{natural_key}"), F.col(natural_key).alias(f"NK_{natural_key}"), *rest,
        at.alias("dim_created_date"), at.alias("dim_updated_date"),
    )


def scd1(dim: DataFrame, members: DataFrame, natural_key: str, keep_created: bool = True, **options) -> DataFrame:
    """Type 1: attributes are overwritten. The creation date of a known member
    is kept unless ``keep_created=False`` asks for overwriting it as well."""
    kept = {"dim_created_date"} if keep_created else set()
    change = {c: f"s.`{c}`" for c in dim.columns if c in members.columns and c not in kept}
    return merge(dim, members, [f"NK_{natural_key}"], updates=(Update(change),), **options)


def scd2(
    dim: DataFrame,
    source: DataFrame,
    *,
    key: str,
    data: Sequence[str],
    sk: str,
    effective: str = "effectiveDate",
    expiry: str = "expiryDate",
    expire: str = "source_row",
    sep: str = "",
    null: str = "",
) -> DataFrame:
    """Type 2: one row per version with ``active``, start and end dates.

    * A source row is new unless the active version has the same data or this
      very version (data and start date) is there already, so a second run
      over the same source changes nothing.
    * Of the new versions of a member the latest is active, provided it starts
      after the active one.
    * The active version a later one replaces is closed. ``source_row`` takes
      the end date its own row carries in the source now (no such row, no
      closing); ``next_effective`` takes the start of the next version.

    The hashes are plain concatenations by default; see ``row_hash``.
    """
    if expire not in ("source_row", "next_effective"):
        raise ValueError("expire is 'source_row' or 'next_effective'")
    staged = source.select(key, *data, effective, expiry).withColumns({
        "idHash": row_hash([key], "", ""), "dataHash": row_hash(list(data), sep, null),
    })
    staged = latest_per_key(staged, ["idHash", "dataHash", effective], [F.desc_nulls_last(expiry)])
    have = dim.select(
        F.col("idHash").alias("_i"), F.col("dataHash").alias("_d"),
        F.col(effective).alias("_e"), F.col("active").alias("_a"),
    )
    first_load = dim.isEmpty()
    new = staged if first_load else staged.join(
        have,
        (F.col("idHash") == F.col("_i")) & (F.col("dataHash") == F.col("_d"))
        & (F.coalesce(F.col("_a"), F.lit(False)) | (F.col(effective) == F.col("_e"))),
        "left_anti",
    )
    new = materialise(new, "versions")  # the delta only; everything below but the last join is of its size

    latest = new.groupBy(F.col("idHash").alias("_ni")).agg(F.max(effective).alias("_ne"))
    versions = new.join(broadcast_if_small(latest), F.col("idHash") == F.col("_ni"), "left")
    newest = F.col(effective) == F.col("_ne")
    if first_load:
        versions = versions.withColumn("active", newest).drop("_ni", "_ne")
        return assign_sk(versions, sk, [key, effective], base=max_sk(dim, sk)).select(*dim.columns)

    # Active versions of the members that have new ones.
    members = new.select(F.col("idHash").alias("_m"))
    current = materialise(dim.filter(F.coalesce(F.col("active"), F.lit(False))).select(
        F.col("idHash").alias("_ci"), F.col("dataHash").alias("_cd"), F.col(effective).alias("_ce")
    ).join(broadcast_if_small(members), F.col("_ci") == F.col("_m"), "left_semi"), "current-versions")
    versions = (
        versions.join(broadcast_if_small(current.select("_ci", "_ce")), F.col("idHash") == F.col("_ci"), "left")
        .withColumn("active", newest & (F.col("_ce").isNull() | (F.col(effective) > F.col("_ce"))))
        .drop("_ni", "_ne", "_ci", "_ce")
    )
    added = assign_sk(versions, sk, [key, effective], base=max_sk(dim, sk))

    # Active versions that a later one replaces, with the end date that closes them.
    after = broadcast_if_small(new.select(F.col("idHash").alias("_xi"), F.col(effective).alias("_xe")))
    later = (F.col("_ci") == F.col("_xi")) & (F.col("_xe") > F.col("_ce"))
    if expire == "source_row":
        own = staged.select(
            F.col("idHash").alias("_oi"), F.col("dataHash").alias("_od"),
            F.col(effective).alias("_oe"), F.col(expiry).alias("_close"),
        )
        same = (F.col("_ci") == F.col("_oi")) & (F.col("_cd") == F.col("_od")) & (F.col("_ce") == F.col("_oe"))
        closings = own.join(broadcast_if_small(current), same).join(after, later, "left_semi").drop("_oi", "_od", "_oe")
    else:
        closings = current.join(after, later).groupBy("_ci", "_cd", "_ce").agg(F.min("_xe").alias("_close"))
    closings = materialise(closings.filter(F.col("_close").isNotNull()), "closings")

    # The dimension meets its closings once; rows without one pass through.
    out = dim.join(
        broadcast_if_small(closings),
        F.coalesce(F.col("active"), F.lit(False)) & (F.col("idHash") == F.col("_ci"))
        & (F.col("dataHash") == F.col("_cd")) & (F.col(effective) == F.col("_ce")),
        "left",
    )
    closing = F.col("_close").isNotNull()
    out = out.withColumns({
        "active": F.when(closing, F.lit(False)).otherwise(F.col("active")),
        expiry: F.when(closing, F.col("_close")).otherwise(F.col(expiry)),
    })
    return out.select(*dim.columns).unionByName(added.select(*dim.columns))


def empty_scd2(source: DataFrame, key: str, data: Sequence[str], sk: str, effective: str, expiry: str) -> DataFrame:
    """Empty type 2 dimension with the layout ``scd2`` expects."""
    return source.select(
        F.lit(0).cast("long").alias(sk), key, *data,
        F.lit("").alias("idHash"), F.lit("").alias("dataHash"), F.lit(True).alias("active"), effective, expiry,
    ).filter(F.lit(False))
