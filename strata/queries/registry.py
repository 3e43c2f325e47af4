"""Registry of queries with the inventory entries they cover and, where SQL
can say the same, an independent statement over the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register the decorated function under its own name."""

    def add(fn: Run) -> Run:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query '{fn.__name__}' is registered twice")
        QUERIES[fn.__name__] = Query(fn.__name__, tuple(covers.split()), fn, sql)
        return fn

    return add


# Money is summed as decimals, so a sum does not depend on the order of rows.
def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def total(c: str | Column) -> Column:
    return F.sum(money(c)).cast("double")


def mean(c: str | Column) -> Column:
    return total(c) / F.count(c)


def text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def sql_total(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def sql_mean(x: str) -> str:
    return f"({sql_total(x)} / count({x}))"
