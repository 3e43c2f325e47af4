"""Profiles, statistics and roll-ups. All of them pre-aggregate on the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.session import materialise

SLICE_ROWS = 1 << 20  # copies of one row that a task writes
SKETCH_K = 8000  # size of a quantile sketch


def profile(
    df: DataFrame,
    *,
    count: str = "total_rows",
    distinct: Mapping[str, str] | None = None,
    averages: Mapping[str, str | Column] | None = None,
    ranges: Mapping[str, tuple[str, str]] | None = None,
    counts_if: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One-row profile in a single pass; each argument maps an output name.

    ``ranges`` maps a column to the names of its minimum and maximum.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    aggs = [F.count(F.lit(1)).alias(count)]
    aggs += [F.countDistinct(c).alias(n) for n, c in (distinct or {}).items()]
    aggs += [F.avg(col(c)).alias(n) for n, c in (averages or {}).items()]
    for c, (low, high) in (ranges or {}).items():
        aggs += [F.min(c).alias(low), F.max(c).alias(high)]
    aggs += [F.count_if(cond).alias(n) for n, cond in (counts_if or {}).items()]
    return df.agg(*aggs)


def group_stats(df: DataFrame, by: Sequence[str], value: str, count: str = "rows", average: str = "average") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count), F.avg(value).alias(average)).orderBy(F.desc(count), *by)


def distribution(df: DataFrame, *cols: str, count: str = "count") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count))


def skew_check(df: DataFrame, keys: Sequence[str], count: str = "record_count") -> DataFrame:
    """Rows per candidate partition key, largest first."""
    return distribution(df, *keys, count=count).orderBy(F.desc(count), *keys)


def trend(df: DataFrame, date: str, unit: str = "year", **aggregates: Column) -> DataFrame:
    """Yearly or monthly trend: row count plus further aggregates."""
    parts = {"year": F.year(date)} if unit == "year" else {"year": F.year(date), "month": F.month(date)}
    extra = [a.alias(n) for n, a in aggregates.items()]
    return df.groupBy(*[c.alias(n) for n, c in parts.items()]).agg(F.count(F.lit(1)).alias("rows"), *extra)


def write_quantile_sketches(df: DataFrame, col: str, slices: Sequence[str], path: str, k: int = SKETCH_K) -> None:
    """One mergeable sketch of the positive values per slice, a Parquet row each.
    Slices that are there already are replaced, the others stay."""
    sketched = df.filter(F.col(col) > 0).groupBy(*slices).agg(F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("rows"))
    sketched.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*slices).parquet(path)


def sketch_bounds(sketches: DataFrame, low: float = 0.0015, high: float = 0.9985) -> DataFrame:
    """Central bounds over any choice of stored slices (low, high, rows), from
    their sketches alone. The rank error falls with about 1 / k: 0.03 % for ``SKETCH_K``."""
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("s"), F.sum("rows").alias("rows"))
    both = F.kll_sketch_get_quantile_double("s", F.array(F.lit(low), F.lit(high)))
    return merged.select(both.alias("b"), "rows").select(F.col("b")[0].alias("low"), F.col("b")[1].alias("high"), "rows")


def summary(df: DataFrame, *cols: str, statistics: Sequence[str] = ("count", "mean", "stddev", "min", "max")) -> DataFrame:
    return df.select(*cols).summary(*statistics)


def exact_quantiles(df: DataFrame, col: str, quantiles: Mapping[str, float]) -> DataFrame:
    """One row with the smallest value at or above each rank ``ceil(q * n)``.

    Values are counted first, then range-partitioned and summed up partition by
    partition, so neither a sketch nor a sort of all rows ends in one task.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    placed = materialise(counts.repartitionByRange("_v").withColumn("_part", F.spark_partition_id()), "values")
    sizes = placed.groupBy("_part").agg(F.sum("_n").alias("_size"))
    # One row per partition: this window and the broadcast do not grow with the data.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    running = F.sum("_n").over(W.partitionBy("_part").orderBy("_v").rowsBetween(W.unboundedPreceding, 0))
    ranked = placed.withColumn("_upto", running).join(F.broadcast(offsets), "_part")
    total = placed.agg(F.sum("_n")).scalar()
    reached = F.col("_upto") + F.col("_offset")
    return ranked.agg(*[F.min(F.when(reached >= F.ceil(total * F.lit(q)), F.col("_v"))).alias(n) for n, q in quantiles.items()])


def settled_quantiles(df: DataFrame, col: str, quantiles: Mapping[str, float], accuracy: int) -> DataFrame:
    """``exact_quantiles`` with a sketch before it: the sketch encloses each rank
    between two values, and all values between enclosures count as one, so what
    is grouped and sorted is about ``4 / accuracy`` of the rows per quantile."""
    rows = df.filter(F.col(col).isNotNull())
    ends = [min(max(q + side * 2 / accuracy, 0.0), 1.0) for q in quantiles.values() for side in (-1, 1)]
    found = rows.agg(F.percentile_approx(col, ends, accuracy).alias("ends"), F.count(F.lit(1)).alias("n")).first()
    if not found["n"]:
        return exact_quantiles(rows, col, quantiles)
    ranges = list(zip(found["ends"][::2], found["ends"][1::2]))
    value = F.col(col)
    around = rows.agg(*[c for low, high in ranges for c in (F.count_if(value < low), F.count_if(value <= high))]).first()
    for i, q in enumerate(quantiles.values()):
        if not around[2 * i] < max(ceil(found["n"] * q), 1) <= around[2 * i + 1]:
            return exact_quantiles(rows, col, quantiles)  # the sketch missed a rank
    # Order is kept and the enclosed values stay, so the ranks are those of all rows.
    edge = F.greatest(*[F.when(value >= low, F.least(value, F.lit(high))) for low, high in ranges])
    kept = F.coalesce(edge, F.lit(min(low for low, _ in ranges)))
    return exact_quantiles(rows.select(kept.cast(df.schema[col].dataType).alias(col)), col, quantiles)


def percentile_bounds(
    df: DataFrame, col: str, low: float = 0.0015, high: float = 0.9985, accuracy: int | None = None, settled: bool = False
) -> DataFrame:
    """Central bounds of the positive values: exact, or from a mergeable sketch
    whose rank error is ``1 / accuracy``; ``settled`` makes the sketch's exact."""
    positive = df.filter(F.col(col) > 0)
    if accuracy is None:
        return exact_quantiles(positive, col, {"low": low, "high": high})
    if settled:
        return settled_quantiles(positive, col, {"low": low, "high": high}, accuracy)
    both = F.percentile_approx(col, [low, high], accuracy)
    return positive.agg(both.alias("_b")).select(F.col("_b")[0].alias("low"), F.col("_b")[1].alias("high"))


def percentile_trim(
    df: DataFrame, col: str, low: float = 0.0015, high: float = 0.9985, accuracy: int | None = None, bounds: DataFrame | None = None
) -> DataFrame:
    """Rows inside the central bounds of a column. ``bounds`` takes a row with
    ``low`` and ``high`` that is known already, such as that of stored sketches."""
    if bounds is None:
        bounds = percentile_bounds(df, col, low, high, accuracy)
    return df.filter((F.col(col) >= bounds.select("low").scalar()) & (F.col(col) <= bounds.select("high").scalar()))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "count") -> DataFrame:
    return distribution(df, *keys, count=count).filter(F.col(count) > 1)


def distinct_days(df: DataFrame, ts: str, out: str = "day") -> DataFrame:
    return df.select(F.to_date(ts).alias(out)).distinct()


def daily_totals(df: DataFrame, date: str, **sums: str | Column) -> DataFrame:
    return df.groupBy(date).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def avg_of_sums(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Average over keys of the sum per key."""
    return df.groupBy(key).agg(F.sum(value).alias("_s")).agg(F.avg("_s").alias(out))


def weekday_usage(df: DataFrame, ts: str, quantity: str, weeks: int = 4) -> DataFrame:
    """Weekday name and id (1 = Sunday), average quantity over decimals rounded
    to two places, and rows per week by whole-number division."""
    day = F.col(ts)
    average = F.round(F.avg(F.col(quantity).cast("decimal(10,2)")), 2)
    return df.groupBy(F.date_format(day, "EEEE").alias("day_of_week"), F.dayofweek(day).alias("day_of_week_id")).agg(
        average.alias("avg_quantity"),
        F.expr(f"count(1) div {int(weeks)}").alias("avg_rows_per_week"),
    )


def usage_cost(
    df: DataFrame, date: str, today: str | Column, by: Sequence[str], quantity: str, days: int = 30
) -> DataFrame:
    """Cost roll-up of the last days by endpoint, product and date; rows whose
    first grouping field is missing are no usage of an endpoint."""
    end = F.lit(today).cast("date") if isinstance(today, str) else today
    recent = df.filter(F.col(by[0]).isNotNull() & (F.col(date) >= F.date_sub(end, days)))
    return recent.groupBy(*by, date).agg(
        F.count(F.lit(1)).alias("record_count"), F.sum(quantity).alias("total_usage")
    )


def length_stats(df: DataFrame, text: str) -> DataFrame:
    return df.agg(F.avg(F.length(text)).alias("avg_length"), F.max(F.length(text)).alias("max_length"))


def list_stats(df: DataFrame, text: str, sep: str = ", ") -> DataFrame:
    """Size of delimited lists: rows, average and maximum."""
    size = F.size(F.split(text, sep))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.avg(size).alias("avg_items"), F.max(size).alias("max_items"))


def max_or_zero(df: DataFrame, col: str, out: str = "max_value") -> DataFrame:
    return df.agg(F.coalesce(F.max(col), F.lit(0)).alias(out))


def pair_histogram(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Two measures against each other as counts on a grid, instead of plotting
    every row on the driver."""
    return df.groupBy(
        F.floor(F.col(x) / x_width).alias("x_bin"), F.floor(F.col(y) / y_width).alias("y_bin")
    ).agg(F.count(F.lit(1)).alias("rows"))


def pair_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(x, y).alias("correlation"), F.count(F.lit(1)).alias("rows"))


def project_consumption(current: DataFrame, projection: DataFrame, key: str, average: str, impact: str, default: float = 1.1) -> DataFrame:
    """Projected average: raised by the key's impact, or by the default factor
    where no projection exists."""
    joined = current.join(projection.select(key, impact), key, "left")
    factor = F.coalesce(1 + F.col(impact), F.lit(default))
    return joined.withColumn("projected", F.col(average) * factor).drop(impact)


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def table_counts(named: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, also number-formatted, ordered over the whole union."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.format_number("rows", 0).alias("formatted")
        )
        for name, df in named.items()
    ]
    return union_all(counts).orderBy("table_name")


def rejects(all_rows: DataFrame, clean: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows of the first frame that are not in the second. The plain form is
    EXCEPT DISTINCT, so equal rejected rows collapse to one; with
    ``keep_duplicates`` every row stays as often as it is there more often."""
    return multiset_difference(all_rows, clean) if keep_duplicates else all_rows.subtract(clean)


def multiset_difference(left: DataFrame, right: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """EXCEPT ALL by signed counts. Only a count per different row is shuffled;
    the surplus is dealt out in slices of ``slice_rows`` copies, so a row that
    makes up a third of the table is written by many tasks."""
    cols = [f"c{i}" for i in range(len(left.columns))]
    signed = left.toDF(*cols).withColumn("_sign", F.lit(1)).union(right.toDF(*cols).withColumn("_sign", F.lit(-1)))
    surplus = signed.groupBy(*cols).agg(F.sum("_sign").alias("_n")).filter(F.col("_n") > 0)
    slices = surplus.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / slice_rows))))
    dealt = slices.repartition("_slice", *cols)
    copies = F.least(F.lit(slice_rows).cast("long"), F.col("_n") - F.col("_slice") * slice_rows).cast("int")
    return dealt.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), copies))).select(*cols).toDF(*left.columns)


def split_by(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows by a row condition, without any shuffle;
    a condition that is null rejects."""
    ok = F.coalesce(keep, F.lit(False))
    return df.filter(ok), df.filter(~ok)
