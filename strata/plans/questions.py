"""Question library: named, parameterised queries with trusted SQL.

Tables are passed as frames and stand in braces; values are bound parameters.
Business columns: business_id, name, city, state, latitude, longitude, stars,
review_count, categories (array). Review columns: review_id, user_id,
business_id, review_date, text. Tip columns: user_id, business_id, tip_date, text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.projections import last_months
from strata.operators.windows import latest_texts_of, top_k_ranked, top_k_rows


@dataclass(frozen=True)
class Question:
    sql: str
    defaults: Mapping[str, object] = field(default_factory=dict)


QUESTIONS: dict[str, Question] = {
    "business_in_city": Question(
        "SELECT business_id, name, latitude, longitude, city, state FROM {business} WHERE city = :city",
        {"city": "Edmonton"},
    ),
    "top_of_category_in_city": Question(
        """
        SELECT name, stars, review_count FROM {business}
        WHERE lower(city) = lower(:city) AND stars >= :min_stars AND review_count >= :min_reviews
          AND array_contains(categories, :category)
        ORDER BY stars DESC, review_count DESC, name
        """,
        {"city": "Edmonton", "category": "Restaurants", "min_stars": 4.5, "min_reviews": 100},
    ),
    "most_reviewed": Question(
        """
        SELECT business_id, name, latitude, longitude, city, state, review_count FROM {business}
        WHERE review_count IS NOT NULL ORDER BY review_count DESC, business_id LIMIT :k
        """,
        {"k": 5},
    ),
    "rows_of_table": Question("SELECT count(*) AS rows FROM identifier(:table)"),
}


def run_named(spark: SparkSession, name: str, tables: Mapping[str, DataFrame] | None = None, **params) -> DataFrame:
    """Run a library query with its default parameters overridden by ``params``."""
    question = QUESTIONS[name]
    unknown = set(params) - set(question.defaults) if question.defaults else set()
    if unknown:
        raise KeyError(f"query '{name}' has no parameter {sorted(unknown)}")
    return spark.sql(question.sql, args={**question.defaults, **params}, **(tables or {}))


def top_businesses(business: DataFrame, city: str, k: int = 5, with_ties: bool = True) -> DataFrame:
    """Best rated businesses of a city, by stars and then review count."""
    cols = ["business_id", "name", "latitude", "longitude", "city", "state", "stars", "review_count"]
    rows = business.filter((F.col("city") == city) & F.col("stars").isNotNull()).select(*cols)
    if with_ties:
        return top_k_ranked(rows, [("stars", "desc"), ("review_count", "desc")], k).select(*cols)
    return top_k_rows(rows, [F.desc("stars"), F.desc("review_count"), F.asc("business_id")], k).select(*cols)


def most_reviewed_ranked(business: DataFrame, k: int = 5, with_ties: bool = True) -> DataFrame:
    cols = ["business_id", "name", "review_count"]
    rows = business.filter(F.col("review_count").isNotNull()).select(*cols)
    if with_ties:
        return top_k_ranked(rows, [("review_count", "desc")], k).select(*cols)
    return top_k_rows(rows, [F.desc("review_count"), F.asc("business_id")], k).select(*cols)


def monthly_reviews(
    review: DataFrame, business: DataFrame, today: str | date, months: int = 12, from_month_start: bool = True
) -> DataFrame:
    """Reviews of known businesses per month of the rolling window."""
    recent = last_months(review, "review_date", str(today), months, from_month_start)
    known = recent.join(business.select("business_id"), "business_id")
    return known.groupBy(F.year("review_date").alias("year"), F.month("review_date").alias("month")).agg(
        F.count(F.lit(1)).alias("review_count")
    ).orderBy("year", "month")


def latest_extracts(
    df: DataFrame, business_id, date_col: str, tie: str, k: int = 9, words: int | None = None, text: str = "text"
) -> DataFrame:
    """Newest texts of one business, whole or, with ``words``, their first words. ``k`` is 9,
    the number of rows the rule "rank below 10" returns."""
    return latest_texts_of(df, "business_id", business_id, [F.desc(date_col), F.asc(tie)], k, text, words)
