"""Layout projections, lineage columns and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import second_precision


def project(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Target layout ``{new name: source column or expression}``; the rest is dropped."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in mapping.items()])


def select_except(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def with_lineage(df: DataFrame, run_id: str, from_files: bool = True) -> DataFrame:
    """Run id, processing time (to the second) and source file of every row."""
    cols = {
        "_pipeline_run_id": F.lit(run_id),
        "_processing_date": second_precision(F.current_timestamp()),
    }
    if from_files:
        cols["_input_filename"] = F.col("_metadata.file_path")
        cols["_input_file_modification_date"] = F.col("_metadata.file_modification_time")
    return df.select("*", *[c.alias(n) for n, c in cols.items()])


def carry_lineage(df: DataFrame, source: str, target: str, run_id: str) -> DataFrame:
    """Keep the lineage of the layer before as ``_<source>_*`` and stamp this one."""
    return df.withColumnsRenamed({
        "_pipeline_run_id": f"_{source}_pipeline_run_id",
        "_processing_date": f"_{source}_processing_date",
    }).withColumns({
        f"_{target}_pipeline_run_id": F.lit(run_id),
        f"_{target}_processing_date": second_precision(F.current_timestamp()),
    })


def map_points(df: DataFrame) -> DataFrame | None:
    """Name, latitude, longitude and optional texts for a map layer.

    Column names match in any case. Coordinates that are no numbers become
    null, missing texts become ''. None when a required column is missing.
    """
    required = ["name", "latitude", "longitude"]
    texts = ["tip_text", "review_text", "summary"]
    have = {c.lower(): c for c in df.columns}
    if not set(required) <= set(have):
        return None

    def value(name: str) -> Column:
        c = F.col(have[name])
        if name in ("latitude", "longitude"):
            return c.try_cast("double")
        return F.coalesce(c.cast("string"), F.lit(""))

    return df.select(*[value(n).alias(n) for n in required + [t for t in texts if t in have]])


def filter_suffix(df: DataFrame, col: str, suffixes: Sequence[str]) -> DataFrame:
    """Rows whose text ends with one of the suffixes, in any case."""
    text, hit = F.lower(F.col(col)), F.lit(False)
    for suffix in suffixes:
        hit = hit | text.endswith(suffix.lower())
    return df.filter(hit)


def last_months(df: DataFrame, col: str, today: str, months: int = 12, from_month_start: bool = False) -> DataFrame:
    """Rolling date filter. The bound is a constant, so it reaches the scan."""
    day = F.lit(today).cast("date")
    start = F.add_months(day, -months)
    return df.filter(F.col(col) >= (F.trunc(start, "month") if from_month_start else start))


def audit_events(
    df: DataFrame, actions: Sequence[str], params: str, key: str, value: str, user: str, user_field: str
) -> DataFrame:
    """Audit rows of some actions on one object by one user: a map lookup
    (``params[key]``) and a struct field (``user.field``) as filters."""
    return df.filter(
        F.col("action_name").isin(*actions)
        & (F.col(params)[key] == value)
        & (F.col(user_field) == user)
    )


def distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()
