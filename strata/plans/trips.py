"""Trip data: quality checks, trimming, and zones ranked by fare per distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.cleaning import safe_ratio
from strata.functions.dates import time_parts
from strata.operators.quality import clean
from strata.operators.windows import top_n_per_group

# Target types of the clean trip table.
TRIP_TYPES = {
    "vendorID": "int", "puLocationId": "int", "doLocationId": "int", "paymentType": "int",
    "fareAmount": "decimal(10,2)", "extra": "decimal(10,2)", "mtaTax": "decimal(10,2)",
    "improvementSurcharge": "decimal(10,2)", "tipAmount": "decimal(10,2)", "tollsAmount": "decimal(10,2)",
    "totalAmount": "decimal(10,2)",
}
# The two published definitions of a clean trip.
TRIMMED_TRIP = [
    "passengerCount > 0", "tripDistance > 0", "tpepDropoffDateTime > tpepPickupDateTime",
    "fareAmount >= 2.5", "fareAmount <= 75",
]
VALID_TRIP = ["passengerCount > 0", "fareAmount BETWEEN 1 AND 1000", "tpepPickupDateTime < tpepDropoffDateTime"]


def clean_trips(trips: DataFrame, conditions: list[str] = VALID_TRIP) -> DataFrame:
    types = {c: t for c, t in TRIP_TYPES.items() if c in trips.columns}
    return clean(trips, conditions, types).drop("startLon", "startLat", "endLon", "endLat")


def top_by_ratio_per_weekday(
    df: DataFrame, ts: str, item: str, amount: str, distance: str, n: int = 10, digits: int | None = None
) -> DataFrame:
    """Per weekday the n items with the highest average of amount per distance.

    One shuffle for the averages, one for the ranks; each weekday is limited
    to n rows per task before the second.
    """
    rated = df.select(
        F.col(item), time_parts(ts)["day_of_week"].alias("day_of_week"), safe_ratio(amount, distance).alias("_ratio")
    )
    average = F.avg("_ratio")
    per_item = rated.groupBy(item, "day_of_week").agg(
        (F.round(average, digits) if digits is not None else average).alias("avg_ratio")
    )
    return top_n_per_group(
        per_item, ["day_of_week"], [F.desc_nulls_last("avg_ratio"), F.asc(item)], n, "rank", tie_break=False
    )
