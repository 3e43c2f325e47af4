"""Join shapes. Plain equi-joins are ``DataFrame.join``; here are the shapes
with a rule of their own.

Broadcast hints are given only behind a size check. Everything else is left to
adaptive execution, which also splits hot keys of inner and left joins; no
operator here needs a full outer join, whose hot keys cannot be split.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from strata.operators.windows import latest_per_key
from strata.session import BROADCAST_BYTES, broadcast_if_small


def broadcast_join(big: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join with an explicit broadcast of ``small`` as long as it is small."""
    return big.join(broadcast_if_small(small, max_bytes), on, how)


def left_agg_join(left: DataFrame, right: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Left join to a side that is aggregated to its keys first."""
    grouped = right.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return left.join(grouped, list(keys), "left")


def left_date_join(left: DataFrame, right: DataFrame, left_date: str, right_ts: str) -> DataFrame:
    """Left join of a day column with the day of a timestamp on the other side."""
    days = right.withColumn("_day", F.to_date(right_ts))
    return left.join(days, F.to_date(left[left_date]) == days["_day"], "left").drop("_day")


def not_exists(source: DataFrame, target: DataFrame, condition: Column) -> DataFrame:
    """Rows of ``source`` with no match; columns are named ``s.`` and ``t.``."""
    return source.alias("s").join(target.alias("t"), condition, "left_anti")


def exists(source: DataFrame, target: DataFrame, condition: Column) -> DataFrame:
    """Rows of ``source`` with a match; the condition may hold non-equi parts."""
    return source.alias("s").join(target.alias("t"), condition, "left_semi")


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Every column of a one-row aggregate added to each row, as scalar
    subqueries, so no join is planned at all."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


def lookup_one(left: DataFrame, right: DataFrame, on: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Left lookup of at most one row per key: the first by ``order``."""
    return left.join(latest_per_key(right, on, order), list(on), "left")


def lookup_as_of(
    fact: DataFrame,
    dim: DataFrame,
    *,
    fact_key: str,
    fact_date: str,
    dim_key: str,
    effective: str,
    expiry: str,
    take: Mapping[str, str],
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """Effective-dated lookup: same key and ``effective <= date <= expiry``,
    both ends inclusive; of all versions that hold, the one with the latest
    ``effective`` wins, of equal ones that with the larger taken values.

    Versions of a key may touch, overlap or lie within one another. They are
    cut at all their borders into pieces with one winner each, so a fact row
    meets at most one piece and the fact table is shuffled once, by key. A null
    expiry holds for ever. ``row_id`` is accepted but no longer needed.
    """
    versions = version_pieces(dim, key=dim_key, effective=effective, expiry=expiry, take=take)
    date = fact[fact_date]
    inside = (F.col("_from") <= date) & (F.col("_to").isNull() | (date <= F.col("_to")))
    inside &= (F.col("_from_in") | (date > F.col("_from"))) & (F.col("_to_in") | F.col("_to").isNull() | (date < F.col("_to")))
    joined = fact.join(broadcast_if_small(versions), (fact[fact_key] == F.col("_k")) & inside, "left")
    return joined.drop("_k", "_from", "_to", "_from_in", "_to_in")


def version_pieces(dim: DataFrame, *, key: str, effective: str, expiry: str, take: Mapping[str, str]) -> DataFrame:
    """Versions cut into pieces that do not overlap: ``_k``, ``_from``, ``_to`` (null: for ever),
    whether each end belongs to the piece, and the taken columns of the winner.

    Versions are sorted by key and start, and a sweep holds only those that are
    in force at its place, so a key may have any number of versions.
    """
    held = dim.select(F.col(key).alias("_k"), F.col(effective).alias("_from"), F.col(expiry).alias("_to"), *[F.col(c).alias(a) for c, a in take.items()])
    held = held.filter(F.col("_k").isNotNull() & F.col("_from").isNotNull() & (F.col("_to").isNull() | (F.col("_from") <= F.col("_to"))))
    schema = StructType(held.schema.fields[:3]).add("_from_in", "boolean").add("_to_in", "boolean")
    out = StructType([StructField(f.name, f.dataType) for f in [*schema.fields, *held.schema.fields[3:]]])
    kinds = [(f.name, to_arrow_type(f.dataType, timestamp_utc=True)) for f in out]
    ordered = held.repartition("_k").sortWithinPartitions("_k", "_from", *take.values())

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[tuple] = []
        force: list[tuple] = []  # versions in force: (-place, end or None, taken)
        at: list = [None, None, False]  # key, start of the open piece, whether it belongs to it

        def close(end, belongs: bool) -> None:
            if end is None or at[1] < end or (at[1] == end and at[2] and belongs):
                pieces.append((at[0], at[1], end, at[2], belongs, *force[0][2]))

        def expire(until=None) -> None:
            """Versions that end before ``until``, or all of them."""
            while force and force[0][1] is not None and (until is None or force[0][1] < until):
                end = force[0][1]
                close(end, True)
                at[1], at[2] = end, False
                while force and force[0][1] is not None and force[0][1] <= end:
                    heappop(force)
            if force and until is None:  # held for ever: nothing comes behind it
                close(None, True)
                force.clear()

        place = 0
        for batch in batches:
            for k, start, end, *taken in zip(*[column.to_pylist() for column in batch.columns]):
                if k != at[0]:
                    if force:
                        expire()
                    at[0] = k
                expire(start) if force else None
                if force:
                    close(start, False)
                place += 1
                heappush(force, (-place, end, taken))
                at[1], at[2] = start, True
            if len(pieces) >= 10_000:
                yield _batch(pieces, kinds)
                pieces.clear()
        if force:
            expire()
        yield _batch(pieces, kinds)

    return ordered.mapInArrow(sweep, out)


def _batch(rows: list[tuple], kinds: Sequence[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])


@dataclass(frozen=True)
class Lookup:
    """One dimension of a star lookup: which columns match, what to take, and
    the member that stands for "not found" (None leaves null).

    The unknown member has the type of the taken key. For text keys such as
    ``HHmmss`` give ``"-1"``: a number would turn the key numeric and drop its
    leading zeros.
    """

    dim: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str]
    unknown: Mapping[str, object] = field(default_factory=dict)


def star_lookup(fact: DataFrame, lookups: Sequence[Lookup], max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left-join a batch or streaming fact to its dimensions, taking keys.

    Small dimensions are broadcast; a dimension of millions of members is
    joined by shuffle, with hot members split by adaptive execution.
    """
    out = fact
    for i, lk in enumerate(lookups):
        side = lk.dim.select(
            *[F.col(d).alias(f"_k{i}_{j}") for j, d in enumerate(lk.on.values())],
            *[F.col(c).alias(a) for c, a in lk.take.items()],
        )
        match = F.lit(True)
        for j, f in enumerate(lk.on):
            match = match & (out[f] == side[f"_k{i}_{j}"])
        out = out.join(broadcast_if_small(side, max_bytes), match, "left").drop(
            *[f"_k{i}_{j}" for j in range(len(lk.on))]
        )
        if lk.unknown:
            out = out.withColumns({
                a: F.coalesce(F.col(a), F.lit(v).cast(side.schema[a].dataType)) for a, v in lk.unknown.items()
            })
    return out


def join_on_expr(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str = "inner") -> DataFrame:
    """Join on computed keys, for example a concatenated three-part name."""
    a, b = left.withColumn("_lk", left_key), right.withColumn("_rk", right_key)
    return a.join(b, F.col("_lk") == F.col("_rk"), how).drop("_lk", "_rk")


def join_group_max(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Each row with the maximum of its key. The maximum is pre-aggregated and
    joined back, so a hot key is never sorted in one task as a window would."""
    top = df.groupBy(*keys).agg(F.max(value).alias(out))
    return df.join(top, list(keys), "left")
