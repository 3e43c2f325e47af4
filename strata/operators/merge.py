"""Merges at plan level: target snapshot + source -> new snapshot.

Open-source Spark refuses MERGE on Parquet tables, so a merge is planned as

* target LEFT JOIN source, which updates matched rows, and
* source LEFT ANTI JOIN target keys, which are the rows to insert.

Both keep the large side on the left, where adaptive execution can split hot
keys, and a source of checked small size is broadcast, so the target is not
shuffled at all. A full outer join would allow neither. Rows with a null key
part never match and are therefore inserted, as in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.types import relaxed
from strata.operators.aggregates import duplicate_keys
from strata.session import BROADCAST_BYTES, fits_broadcast, materialise

CHANGE = "_change_type"


@dataclass(frozen=True)
class Update:
    """Conditional update of matched rows; ``t.`` is the target, ``s.`` the source.

    ``set`` maps target columns to SQL expressions; None sets every column the
    source has. Of several updates the first whose condition holds applies.
    """

    set: Mapping[str, str] | None = None
    when: str | None = None


class DuplicateSourceKeys(ValueError):
    """The merge source holds one key more than once."""


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a complete key occurs more than once. Keys with a null part
    never match anything and may repeat."""
    complete = df.select(*keys).dropna(subset=list(keys))
    twice = duplicate_keys(complete, keys).limit(3).collect()
    if twice:
        shown = ", ".join(str(tuple(r)[:-1]) for r in twice)
        raise DuplicateSourceKeys(f"merge source has duplicate keys on {list(keys)}: {shown}")


def unmatched(
    target: DataFrame, source: DataFrame, on: Sequence[str] | Mapping[str, str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Source rows without a match in the target: the rows a merge inserts.
    Rows with a null key part are among them."""
    keys = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    target_keys = target.select(*[F.col(a).alias(f"_t_{b}") for a, b in keys.items()])
    if fits_broadcast(source, max_bytes):
        # Reduced to the keys that do match, which are at most as many as the source rows.
        wanted = source.select(*[F.col(b).alias(f"_s_{b}") for b in keys.values()])
        same = F.lit(True)
        for b in keys.values():
            same = same & (F.col(f"_t_{b}") == F.col(f"_s_{b}"))
        target_keys = target_keys.join(F.broadcast(wanted), same, "left_semi").distinct()
    s = source.alias("s")
    hit = F.lit(True)
    for b in keys.values():
        hit = hit & (F.col(f"s.`{b}`") == F.col(f"_t_{b}"))
    return s.join(target_keys, hit, "left_anti")


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    *,
    updates: Sequence[Update] = (Update(),),
    insert: Mapping[str, str] | bool = True,
    insert_when: str | None = None,
    check_unique: bool = True,
    mark_changes: bool = False,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """New snapshot of ``target`` under the given matched and not-matched rules.

    ``on`` lists the key columns, or maps target keys to source keys.
    ``insert`` is True (all columns by name), False, or ``{column: expression}``
    over ``s.``. With ``mark_changes`` a column tells 'insert', 'update' or
    null (row carried over).
    """
    keys = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    if check_unique:
        assert_unique(source, list(keys.values()))
    small = fits_broadcast(source, max_bytes)
    names = target.columns

    t = target.alias("t")
    s = source.withColumn("_hit", F.lit(True)).alias("s")
    match = F.expr(" AND ".join(f"t.`{a}` = s.`{b}`" for a, b in keys.items()))
    joined = t.join(F.broadcast(s) if small else s, match, "left")

    applied = F.lit(None).cast("int")
    for number, update in reversed(list(enumerate(updates))):
        holds = F.col("s._hit").isNotNull()
        if update.when:
            holds = holds & F.coalesce(F.expr(update.when), F.lit(False))
        applied = F.when(holds, F.lit(number)).otherwise(applied)
    joined = joined.withColumn("_applied", applied)

    def value(column: str) -> Column:
        out = F.col(f"t.`{column}`")
        for number, update in enumerate(updates):
            if update.set is None:
                expr = F.col(f"s.`{column}`") if column in source.columns else None
            else:
                expr = F.expr(update.set[column]) if column in update.set else None
            if expr is not None:
                out = F.when(F.col("_applied") == number, expr.cast(relaxed(target.schema[column].dataType))).otherwise(out)
        return out.alias(column)

    mark = F.when(F.col("_applied").isNotNull(), F.lit("update")).alias(CHANGE)
    kept = joined.select(*[value(c) for c in names], *([mark] if mark_changes else []))
    if insert is False:
        return kept

    fresh = unmatched(target, source, keys, max_bytes).alias("s")
    if insert_when:
        fresh = fresh.filter(F.expr(insert_when))

    def inserted(column: str) -> Column:
        dtype = relaxed(target.schema[column].dataType)
        if insert is True:
            expr = F.col(f"s.`{column}`") if column in source.columns else F.lit(None)
        else:
            expr = F.expr(insert[column]) if column in insert else F.lit(None)
        return expr.cast(dtype).alias(column)

    added = fresh.select(*[inserted(c) for c in names], *([F.lit("insert").alias(CHANGE)] if mark_changes else []))
    return kept.unionByName(added)


def merge_insert_only(target: DataFrame, source: DataFrame, on: Sequence[str], **options) -> DataFrame:
    """Insert unseen keys, never touch existing rows (idempotent reload)."""
    return merge(target, source, on, updates=(), **options)


def merge_upsert(target: DataFrame, source: DataFrame, on: Sequence[str], **options) -> DataFrame:
    return merge(target, source, on, **options)


def merge_newer(
    target: DataFrame, source: DataFrame, on: Sequence[str], stamp: str, set_cols: Sequence[str], **options
) -> DataFrame:
    """Update only when the source stamp is later: late files never overwrite
    a correction that came in before them."""
    change = {c: f"s.`{c}`" for c in [*set_cols, stamp] if c in target.columns}
    return merge(target, source, on, updates=(Update(change, f"s.`{stamp}` > t.`{stamp}`"),), **options)


def merge_hash_diff(
    target: DataFrame,
    source: DataFrame,
    *,
    key_hash: str = "_keyHash",
    value_hash: str = "_valueHash",
    surrogate: str = "sid",
    start: int = 0,
    order: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Match on the key hash, update where the value hash differs, keep the
    surrogate key of existing rows and number the new ones after the highest."""
    from strata.operators.dimensions import assign_sk  # surrogate keys build on merges elsewhere

    columns = [c for c in target.columns if c != surrogate and c in source.columns]
    change = {c: f"s.`{c}`" for c in columns if c != key_hash}
    old = merge(
        target, source, [key_hash],
        updates=(Update(change, f"t.`{value_hash}` <> s.`{value_hash}`"),), insert=False, **options,
    )
    new = unmatched(target, source, [key_hash]).select(*columns)
    base = target.agg(F.coalesce(F.max(surrogate), F.lit(start - 1)).alias("m"))
    numbered = assign_sk(new, surrogate, order or [key_hash], base=base)
    return old.unionByName(numbered, allowMissingColumns=True).select(*target.columns)


def apply_marked(target: DataFrame, changes: DataFrame, keys: Sequence[str], op: str = "_op") -> DataFrame:
    """Row-marked sink: 'I' rows are inserted, 'U' rows replace their key;
    deletes are not allowed, an unknown mark is an error."""
    marked = changes.withColumn(
        op, F.when(F.col(op).isin("I", "U"), F.col(op)).otherwise(
            F.raise_error(F.concat(F.lit("row mark not allowed: "), F.coalesce(F.col(op), F.lit("null"))))
        )
    )
    updated = merge(
        target, marked.filter(F.col(op) == "U").drop(op), keys, updates=(Update(),), insert=False,
    )
    inserts = marked.filter(F.col(op) == "I").select(*target.columns)
    return updated.unionByName(inserts)


def delete_where(df: DataFrame, condition: str | Column) -> DataFrame:
    """Snapshot without the rows for which the condition is true."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.filter(~F.coalesce(cond, F.lit(False)))


def stable(df: DataFrame) -> DataFrame:
    """Snapshot written once, for merges whose result is read several times."""
    return materialise(df, "snapshot")
