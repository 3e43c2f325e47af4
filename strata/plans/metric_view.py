"""Metric views: named measures over a star, evaluated at any grain."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import broadcast_if_small

_MEASURE = re.compile(r"MEASURE\(\s*(\w+)\s*\)", re.IGNORECASE)


@dataclass(frozen=True)
class Join:
    """Dimension of a view: alias and an SQL condition over ``source`` and the alias."""

    name: str
    on: str


@dataclass(frozen=True)
class MetricView:
    """``measures`` are SQL aggregates, or expressions over other measures
    written ``MEASURE(name)``. ``dimensions`` are SQL expressions over
    ``source`` and the joined aliases."""

    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    joins: Sequence[Join] = field(default_factory=tuple)
    filter: str | None = None

    def _needed(self, measures: Sequence[str]) -> tuple[list[str], list[str]]:
        """Plain aggregates to compute, then the derived ones in order."""
        plain: list[str] = []
        derived: list[str] = []

        def visit(name: str, path: tuple[str, ...]) -> None:
            if name in path:
                raise ValueError(f"measure '{name}' refers to itself")
            inner = _MEASURE.findall(self.measures[name])
            for i in inner:
                visit(i, (*path, name))
            into = derived if inner else plain
            if name not in into:
                into.append(name)

        for m in measures:
            visit(m, ())
        return plain, derived

    def query(self, tables: Mapping[str, DataFrame], dimensions: Sequence[str], measures: Sequence[str]) -> DataFrame:
        """One aggregate at the chosen grain. ``tables`` holds the source under
        ``source`` and each joined dimension under its alias."""
        plain, derived = self._needed(measures)
        df = tables["source"].alias("source")
        for join in self.joins:
            # Inner joins also filter, so each stays even when no column of it is used.
            side = broadcast_if_small(tables[join.name])
            df = df.join(side.alias(join.name), F.expr(join.on), "inner")
        if self.filter:
            df = df.filter(F.expr(self.filter))
        out = df.groupBy(*[F.expr(self.dimensions[d]).alias(d) for d in dimensions]).agg(
            *[F.expr(self.measures[m]).alias(m) for m in plain]
        )
        for m in derived:
            out = out.withColumn(m, F.expr(_MEASURE.sub(r"`\1`", self.measures[m])))
        return out.select(*dimensions, *measures)
