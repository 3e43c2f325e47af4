"""Sales warehouse load and the daily sales report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dimensions import empty_scd2, invoice_dates, scd0, scd2
from strata.operators.facts import build_fact_txn
from strata.operators.joins import left_date_join
from strata.session import dropped_shuffles, in_parallel, materialise

ITEM_DATA = ["itemDescription", "size", "leadTimeDays", "isChillerRequired"]
MEASURES: Mapping[str, str] = {
    "quantity": "quantity", "unitPrice": "unitPrice", "totalBeforeTax": "unitPrice * quantity", "taxRate": "taxRate",
    "tax": "tax", "totalAfterTax": "totalAfterTax", "profit": "profit",
}
DATE_DIM = "skDate long, nkDateId long, date date, year int, month int, dayOfMonth int, quarter int"


@dataclass(frozen=True)
class Warehouse:
    """Current snapshots of the three warehouse tables."""

    dates: DataFrame
    items: DataFrame
    fact: DataFrame


def load_dates(dim: DataFrame | None, invoices: DataFrame, date: str = "nkInvoiceDate") -> DataFrame:
    """Calendar with the days that have invoices; days are only ever added."""
    existing = dim if dim is not None else invoices.sparkSession.createDataFrame([], DATE_DIM)
    return scd0(existing, invoice_dates(invoices, date), "date", "skDate", ["date"])


def load_items(dim: DataFrame | None, stock: DataFrame, expire: str = "source_row") -> DataFrame:
    """Versioned stock items. ``stock`` has nkStockItemId, the item data,
    effectiveDate and expiryDate."""
    if dim is None:
        dim = empty_scd2(stock, "nkStockItemId", ITEM_DATA, "skStockItem", "effectiveDate", "expiryDate")
    return scd2(dim, stock, key="nkStockItemId", data=ITEM_DATA, sk="skStockItem", expire=expire)


def load_fact(
    fact: DataFrame | None, lines: DataFrame, invoices: DataFrame, dates: DataFrame, items: DataFrame,
    id_cols=("nkInvoiceId", "nkInvoiceDate", "nkStockItemId"), measures: Mapping[str, str] = MEASURES,
) -> DataFrame:
    if fact is None:
        shape = lines.select(*[F.expr(e).alias(n) for n, e in measures.items()]).schema
        columns = ["skTransaction long", "skInvoiceDate long", "skStockItem long",
                   f"invoiceId {lines.schema['nkInvoiceId'].dataType.simpleString()}"]
        columns += [f"`{f.name}` {f.dataType.simpleString()}" for f in shape] + ["idHash string", "dataHash string"]
        fact = lines.sparkSession.createDataFrame([], ", ".join(columns))
    return build_fact_txn(fact, lines, invoices, dates, items, measures=measures, id_cols=id_cols)


def load_warehouse(
    before: Warehouse | None, stock: DataFrame, invoices: DataFrame, lines: DataFrame, **options
) -> Warehouse:
    """Both dimensions, then the fact. Each is written once in the shared
    folder, because the next step and the next load read it."""
    with dropped_shuffles(invoices.sparkSession):
        dates, items = in_parallel(
            lambda: materialise(load_dates(before.dates if before else None, invoices), "dim_date"),
            lambda: materialise(load_items(before.items if before else None, stock), "dim_item"),
        )
        fact = materialise(load_fact(before.fact if before else None, lines, invoices, dates, items, **options), "fact", compression="zstd")
    return Warehouse(dates, items, fact)


def sales_report(
    invoices: DataFrame, lines: DataFrame, weather: DataFrame, copied_date: str, copied_id: str,
    *, key: str = "InvoiceID", date: str = "InvoiceDate", total: str = "LinePrice", profit: str = "LineProfit",
) -> DataFrame:
    """Daily totals and profit with the weather of the day, stamped for reload
    by ``replace_slice`` on ``copiedDate``.

    Lines are summed per invoice before the join, so the join carries one row
    per invoice. ``weather`` has date, avg_temp and temp_unit.
    """
    per_invoice = lines.groupBy(key).agg(F.sum(total).alias("_total"), F.sum(profit).alias("_profit"))
    daily = (
        invoices.select(key, F.to_date(date).alias("InvoiceDate")).join(per_invoice, key)
        .groupBy("InvoiceDate").agg(F.sum("_total").alias("DailyTotal"), F.sum("_profit").alias("DailyProfit"))
    )
    joined = left_date_join(daily, weather, "InvoiceDate", "date")
    return joined.select(
        "InvoiceDate", "DailyTotal", "DailyProfit",
        F.col("avg_temp").alias("WeatherAvgTemp"), F.col("temp_unit").alias("WeatherUnit"),
        F.lit(copied_date).cast("date").alias("copiedDate"), F.lit(copied_id).alias("copiedPipelineId"),
    )


# Flat weather names and their place in the nested feed.
WEATHER_FIELDS = {
    "id": "_id", "guid": "guid", "date": "date", "temp_unit": "main.unit", "avg_temp": "main.temp",
    "wind_unit": "wind.unit", "avg_wind": "wind.speed", "clouds_all": "clouds.all", "rain_unit": "rain.unit",
    "avg_rain_hr": "rain.`1h`",
}


def typed_weather(flat: DataFrame) -> DataFrame:
    """Weather with the cloud code 0/1 as a flag."""
    return flat.withColumn("clouds_all", F.col("clouds_all").try_cast("int").try_cast("boolean"))
