"""Fact tables over star lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import storage
from strata.functions.hashing import row_hash
from strata.operators.aggregates import duplicate_keys
from strata.operators.dimensions import max_sk, numbered, with_places
from strata.operators.joins import Lookup, lookup_as_of, star_lookup
from strata.operators.merge import Update, assert_unique, merge
from strata.operators.windows import latest_per_key
from strata.session import materialise, scratch_path


def build_fact(
    source: DataFrame, lookups: Sequence[Lookup], natural_key: str, measures: Sequence[str | Column],
    order: Sequence[Column],
) -> tuple[DataFrame, DataFrame]:
    """Accepted fact rows and rows with a missing dimension member.

    Rows are reduced to the latest per natural key before the lookups, so the
    joins carry each fact once. Every looked-up key gets a ``dq_<key>_valid``
    flag in the rejected part.
    """
    latest = latest_per_key(source, [natural_key], order)
    mapped = star_lookup(latest, lookups)
    keys = [alias for lk in lookups for alias in lk.take.values()]
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    flagged = mapped.withColumns({f"dq_{k}_valid": F.col(k).isNotNull() for k in keys})
    accepted = flagged.filter(complete).select(natural_key, *keys, *measures)
    return accepted, flagged.filter(~complete)


def build_fact_hash(
    source: DataFrame,
    lookups: Sequence[Lookup],
    measure: str,
    *,
    natural: Sequence[str],
    measure_as: str | None = None,
) -> DataFrame:
    """Fact rows with unknown members filled and key/value hashes for
    ``merge_hash_diff``.

    The key hash covers the surrogate keys and also the natural key: two rows
    that both fall on the unknown member must not share one hash, or the merge
    would find its source ambiguous.
    """
    keys = [alias for lk in lookups for alias in lk.take.values()]
    mapped = star_lookup(source, lookups)
    out = mapped.select(
        *keys, F.col(measure).alias(measure_as or measure),
        row_hash([*keys, *natural]).alias("_keyHash"), row_hash([measure]).alias("_valueHash"),
    )
    return out


def _packed(hashed: str | Column) -> Column:
    """A SHA-256 in half the bytes; any other text as it is."""
    h = F.col(hashed) if isinstance(hashed, str) else hashed
    return F.when(h.rlike("^[0-9a-f]{64}$"), F.unhex(h)).otherwise(h.cast("binary"))


def build_fact_txn(
    fact: DataFrame,
    lines: DataFrame,
    invoices: DataFrame,
    dates: DataFrame,
    items: DataFrame,
    *,
    measures: Mapping[str, str],
    id_cols: Sequence[str] = ("nkInvoiceId", "nkInvoiceDate", "nkStockItemId"),
) -> DataFrame:
    """Transaction fact, incremental: unseen lines are inserted with keys and
    lookups, known lines with other measures are updated in measures only.

    ``lines`` carries nkInvoiceId, nkStockItemId and the measures, ``invoices``
    nkInvoiceId and nkInvoiceDate. ``id_cols`` makes up the row identity; add
    the line number when one invoice may list an item twice.
    """
    named = lines.select(
        "nkInvoiceId", "nkStockItemId", *[c for c in id_cols if c in lines.columns and c not in ("nkInvoiceId", "nkStockItemId")],
        *[F.expr(e).alias(n) for n, e in measures.items()],
    )
    # The earliest date of an invoice counts: a minimum is combined before the shuffle, a ranking is not.
    dated = invoices.groupBy("nkInvoiceId").agg(F.min("nkInvoiceDate").alias("nkInvoiceDate"))
    staged = named.join(dated, "nkInvoiceId", "left")
    hashes = {"newIdHash": row_hash(list(id_cols)), "newDataHash": row_hash(list(measures))}
    first_load = fact.isEmpty()
    # Lines are written without their hashes, which do not compress and cost more disk than all the rest; each read makes them again.
    path = scratch_path(lines.sparkSession, "lines")
    staged = materialise(with_places(staged) if first_load else staged, path=path, compression="zstd")
    digests = staged.withColumns(hashes).select(F.xxhash64("newIdHash").alias("_digest"))
    if not duplicate_keys(digests, ["_digest"]).isEmpty():
        assert_unique(staged.withColumns(hashes), ["newIdHash"])
    unseen = staged
    if not first_load:
        # One meeting by key hash tells new lines from lines that may have changed; the merge looks at these alone.
        known = fact.groupBy(_packed("idHash").alias("_known")).agg(
            F.min(_packed("dataHash")).alias("_low"), F.max(_packed("dataHash")).alias("_high"))
        met = staged.withColumn("_id", _packed(hashes["newIdHash"])).join(known, F.col("_id") == F.col("_known"), "left")
        own = _packed(hashes["newDataHash"])
        new, changed = F.col("_known").isNull(), (F.col("_low") != own) | (F.col("_high") != own)
        delta = materialise(met.filter(new | changed).withColumn("_new", new).drop("_id", "_known", "_low", "_high"), "delta", compression="zstd")
        storage.remove(lines.sparkSession, path)
        unseen = materialise(with_places(delta.filter("_new").drop("_new")), "new-lines", compression="zstd")
        change = {m: f"s.`{m}`" for m in measures} | {"dataHash": "s.newDataHash"}
        updated = merge(
            fact, delta.filter("NOT _new").withColumns(hashes).select("newIdHash", "newDataHash", *measures), {"idHash": "newIdHash"},
            updates=(Update(change, "t.dataHash <> s.newDataHash"),), insert=False, check_unique=False,
        )
    # Keys need no order, so new rows are numbered where they lie.
    unseen = numbered(unseen, "skTransaction", max_sk(fact, "skTransaction"))
    with_dates = star_lookup(unseen, [Lookup(dates, {"nkInvoiceDate": "date"}, {"skDate": "skInvoiceDate"})])
    with_items = lookup_as_of(
        with_dates, items, fact_key="nkStockItemId", fact_date="nkInvoiceDate", dim_key="nkStockItemId",
        effective="effectiveDate", expiry="expiryDate", take={"skStockItem": "skStockItem"},
    )
    shaped = with_items.withColumns({
        "idHash": hashes["newIdHash"], "dataHash": hashes["newDataHash"], "invoiceId": F.col("nkInvoiceId"),
    })
    added = shaped.select(*fact.columns)
    return added if first_load else updated.unionByName(added)
