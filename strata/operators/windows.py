"""Ranking. Every rank filter here is written so that Spark limits each group
(or the whole table) on the map side before rows are shuffled; a key that holds
most of the rows then sends only a few of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from strata.functions.cleaning import first_words


def row_tie_break(df: DataFrame) -> Column:
    """Hash of a row, to order rows that agree in every order column."""

    def hashable(t) -> bool:
        if isinstance(t, (MapType, VariantType)):
            return False
        if isinstance(t, ArrayType):
            return hashable(t.elementType)
        if isinstance(t, StructType):
            return all(hashable(f.dataType) for f in t)
        return True

    return F.xxhash64(*[F.col(f.name) for f in df.schema if hashable(f.dataType)])


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank_col: str | None = "rank",
    tie_break: bool = True,
) -> DataFrame:
    """The first n rows of each group; ties are broken by a row hash."""
    by = list(order) + ([row_tie_break(df)] if tie_break else [])
    name = rank_col or "_rank"
    ranked = df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*by))).filter(F.col(name) <= n)
    return ranked if rank_col else ranked.drop(name)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_break: bool = True) -> DataFrame:
    """One row per key, the first by ``order``. Order columns that are constant
    inside a batch leave ties; the row hash makes the choice repeatable."""
    return top_n_per_group(df, keys, order, 1, None, tie_break)


def top_k_rows(df: DataFrame, order: Sequence[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Ranked top-k without ties over a whole table: each task keeps k rows,
    and only the k survivors are numbered."""
    first = df.orderBy(*order).limit(k)
    return first.withColumn(rank_col, F.row_number().over(W.orderBy(*order)))


def top_k_ranked(
    df: DataFrame, order: Sequence[tuple[str, str]], k: int, group: Sequence[str] = (), rank_col: str = "rank"
) -> DataFrame:
    """Rows with ``RANK() <= k``, ties kept whole, ``order`` being
    ``(column, "asc" | "desc")``.

    The rank of a row is fixed by its order values, and every value ranked
    within k occurs among the first k rows. So the first k rows give at most k
    ranked values, and the table is joined to those. However many rows tie,
    none of them are gathered in one task.
    """
    names = [c for c, _ in order]

    def by(cols: Sequence[str]) -> list[Column]:
        return [
            F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_first()
            for c, (_, d) in zip(cols, order)
        ]

    if group:
        head = df.select(*group, *names).withColumn("_rn", F.row_number().over(W.partitionBy(*group).orderBy(*by(names))))
        head = head.filter(F.col("_rn") <= k).drop("_rn")
        over = W.partitionBy(*group).orderBy(*by(names))
    else:
        head = df.select(*names).orderBy(*by(names)).limit(k)
        over = W.orderBy(*by(names))
    ranks = head.withColumn(rank_col, F.rank().over(over)).distinct()
    keys = [*group, *names]
    ranks = ranks.withColumnsRenamed({c: f"_r_{c}" for c in keys})
    match = F.lit(True)
    for c in keys:
        match = match & df[c].eqNullSafe(ranks[f"_r_{c}"])
    side = ranks if group else F.broadcast(ranks)  # without groups: at most k rows
    return df.join(side, match, "inner").drop(*[f"_r_{c}" for c in keys])


def latest_texts(
    df: DataFrame, key: str, order: Sequence[Column], k: int = 9, text: str | None = None, words: int | None = None
) -> DataFrame:
    """Newest k rows of every key; with ``words`` the text is cut to a short
    extract after the rows are chosen."""
    newest = top_n_per_group(df, [key], order, k)
    if text and words:
        newest = newest.withColumn(text, first_words(text, words))
    return newest


def latest_texts_of(
    df: DataFrame, key: str, value, order: Sequence[Column], k: int = 9, text: str | None = None, words: int | None = None
) -> DataFrame:
    """Newest k rows of one key: filter first, then a limited sort."""
    newest = df.filter(F.col(key) == value).orderBy(*order).limit(k)
    if text and words:
        newest = newest.withColumn(text, first_words(text, words))
    return newest
