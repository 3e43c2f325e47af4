"""Smart-grid lakehouse: readings, meters and places to a consumption fact."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.cleaning import percent_to_fraction, to_ts
from strata.functions.dates import second_precision
from strata.functions.hashing import row_hash
from strata.operators.dimensions import dim_date, dim_time
from strata.operators.facts import build_fact_hash
from strata.operators.joins import Lookup
from strata.operators.merge import merge_hash_diff, merge_newer
from strata.operators.quality import Rule, between, one_of, required, schema_fits
from strata.operators.windows import latest_per_key
from strata.session import in_parallel, size_shuffles
from strata.sinks.snapshots import SnapshotTable
from strata.streaming.jobs import fact_stream, ingest_bronze, ingest_csv, silver_stream

READING_SCHEMA = "meterId string, measurementInKWh double, zipCode long, measurementDate string"
READING_KEYS = ["measurementDate", "meterId", "zipCode"]
READING_RULES = [
    schema_fits(),
    between("measurementInKWh", 5.0, 20.0, "kWh must be 5 to 20"),
    Rule("measurementDate", "measurementDate IS NOT NULL", "measurementDate", "Measurement date is no timestamp", "INVALID_DATE"),
]
METER_RULES = [required("meterId"), one_of("class", ["Small", "Medium", "Large"])]
PLACE_RULES = [required("zipCode"), required("latitude"), required("longitude")]
# The columns of the landed master data.
METER_LANDED = [
    "meterId", "MeterLocation", "MeterNumber", "class", "maxKwh", "efficiencyPercentage", "envImpact", "startupTimeMin",
]
PLACE_LANDED = ["ZipCode", "Lat", "Long"]

METER_VALUES = [
    "meterLocation", "meterNum", "class", "maxKwh", "efficiencyPercentage", "environmentalImpact", "startTimeMinutes",
]
LOCATION_VALUES = ["latitude", "longitude"]
UNKNOWN = -1
UNKNOWN_TEXT = "-1"


def silver_readings(bronze: DataFrame, run_id: str) -> DataFrame:
    """Typed readings; the file time becomes the record's modification time."""
    return bronze.select(
        to_ts("measurementDate").alias("measurementDate"),
        F.col("measurementInKWh").try_cast("decimal(20,3)").alias("measurementInKWh"),
        "meterId", "zipCode", "_rescued_data",
        F.col("_input_file_modification_date").alias("_record_modified_date"),
        F.lit(run_id).alias("_pipeline_run_id"),
        second_precision(F.current_timestamp()).alias("_processing_date"),
    )


def latest_reading_order() -> list:
    """Newest file first; inside one file the smaller value."""
    return [F.desc("_record_modified_date"), F.asc("measurementInKWh")]


def type_meters(bronze: DataFrame) -> DataFrame:
    """Meter master data from all-text CSV."""
    return bronze.select(
        "meterId", F.col("MeterLocation").alias("meterLocation"), F.col("MeterNumber").try_cast("int").alias("meterNum"),
        "class", F.col("maxKwh").try_cast("decimal(10,4)").alias("maxKwh"),
        percent_to_fraction("efficiencyPercentage").alias("efficiencyPercentage"),
        F.col("envImpact").alias("environmentalImpact"), F.col("startupTimeMin").try_cast("int").alias("startTimeMinutes"),
        *[c for c in bronze.columns if c.startswith("_")],
    )


def type_places(bronze: DataFrame) -> DataFrame:
    """Places by zip code from all-text CSV."""
    return bronze.select(
        F.col("ZipCode").try_cast("long").alias("zipCode"), F.col("Lat").try_cast("double").alias("latitude"),
        F.col("Long").try_cast("double").alias("longitude"), *[c for c in bronze.columns if c.startswith("_")],
    )


def silver_meters(bronze: DataFrame) -> DataFrame:
    """Typed meters of the known classes; the latest row per meter."""
    typed = type_meters(bronze).filter(F.col("class").isin("Small", "Medium", "Large"))
    order = [F.desc("_input_file_modification_date")] if "_input_file_modification_date" in bronze.columns else []
    return latest_per_key(typed, ["meterId"], order)


def meter_members(silver: DataFrame) -> DataFrame:
    return silver.select(
        "meterId", *METER_VALUES, row_hash(["meterId"]).alias("_keyHash"), row_hash(METER_VALUES).alias("_valueHash")
    )


def location_members(silver: DataFrame) -> DataFrame:
    return silver.select(
        "zipCode", *LOCATION_VALUES, row_hash(["zipCode"]).alias("_keyHash"), row_hash(LOCATION_VALUES).alias("_valueHash")
    )


def load_dimension(dim: DataFrame | None, members: DataFrame, order: list[str]) -> DataFrame:
    """Hash-diff load with ``sid`` counted from 0."""
    target = dim
    if target is None:
        target = members.select(F.lit(0).cast("long").alias("sid"), "*").filter(F.lit(False))
    return merge_hash_diff(target, members, order=order)


def consumption_lookups(meters: DataFrame, places: DataFrame, dates: DataFrame, times: DataFrame) -> list[Lookup]:
    return [
        Lookup(meters, {"meterId": "meterId"}, {"sid": "meterSid"}, {"meterSid": UNKNOWN}),
        Lookup(places, {"zipCode": "zipCode"}, {"sid": "serviceLocationSid"}, {"serviceLocationSid": UNKNOWN}),
        Lookup(dates, {"_date": "calendarDate"}, {"sid": "measurementDateSid"}, {"measurementDateSid": UNKNOWN_TEXT}),
        Lookup(times, {"_time": "time"}, {"sid": "measurementTimeSid"}, {"measurementTimeSid": UNKNOWN_TEXT}),
    ]


def consumption_rows(silver: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Fact rows of readings: timestamp split into date and time of day, keys
    looked up, hashes added."""
    parts = silver.withColumns({
        "_date": F.to_date("measurementDate"), "_time": F.date_format("measurementDate", "HH:mm:ss"),
    })
    return build_fact_hash(parts, lookups, "measurementInKWh", natural=READING_KEYS, measure_as="powerConsumptedKwh")


def usage_by_place(fact: DataFrame, places: DataFrame) -> DataFrame:
    """Total kWh per place with its coordinates."""
    totals = fact.groupBy("serviceLocationSid").agg(F.sum("powerConsumptedKwh").alias("total_kwh"))
    return totals.join(places, totals["serviceLocationSid"] == places["sid"]).select(
        "zipCode", "latitude", "longitude", "total_kwh"
    )


def daily_average_by_place(fact: DataFrame, meters: DataFrame, places: DataFrame, dates: DataFrame) -> DataFrame:
    """Average kWh per place and day, over readings of known meters.

    The fact is pre-aggregated to its keys, so the joins carry groups, not rows.
    """
    grouped = fact.groupBy("meterSid", "serviceLocationSid", "measurementDateSid").agg(
        F.sum("powerConsumptedKwh").alias("_s"), F.count("powerConsumptedKwh").alias("_n")
    )
    joined = (
        grouped.join(meters.select(F.col("sid").alias("meterSid")), "meterSid", "left_semi")
        .join(dates.select(F.col("sid").alias("measurementDateSid"), "calendarDate"), "measurementDateSid")
        .join(places.select(F.col("sid").alias("serviceLocationSid"), "zipCode"), "serviceLocationSid")
    )
    return joined.groupBy("zipCode", "calendarDate").agg((F.sum("_s") / F.sum("_n")).alias("avg_consumption"))


@dataclass(frozen=True)
class GridLake:
    """Folders of one smart-grid lakehouse under ``root``."""

    spark: SparkSession
    root: str
    run_id: str = "run"
    buckets: int = 8

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def bronze(self, landing: str | None = None, max_files: int | None = 75) -> None:
        ingest_bronze(
            self.spark, landing or self.path("landing", "readings"), self.path("bronze", "readings"),
            self.path("checkpoints", "bronze"), StructType.fromDDL(READING_SCHEMA), self.run_id, max_files=max_files,
            name="bronze_readings",
        ).awaitTermination()

    def silver(self, max_files: int | None = 10) -> SnapshotTable:
        """Newer-wins merge: a correction in a newer file replaces a reading, a
        late older file never does."""
        schema = self.spark.read.parquet(self.path("bronze", "readings")).schema
        layout = silver_readings(self.spark.createDataFrame([], schema), self.run_id).drop("_rescued_data").schema
        table = SnapshotTable(self.spark, self.path("silver", "readings"), READING_KEYS, layout, self.buckets)
        change = ["measurementInKWh", "_pipeline_run_id", "_processing_date"]
        silver_stream(
            self.spark, self.path("bronze", "readings"), schema, table,
            transform=lambda df: silver_readings(df, self.run_id), rules=READING_RULES, keys=READING_KEYS,
            order=latest_reading_order(),
            plan=lambda t, s: merge_newer(
                t, s, READING_KEYS, "_record_modified_date", change, check_unique=False, mark_changes=True
            ),
            quarantine=self.path("quarantine"), checkpoint=self.path("checkpoints", "silver"), run_id=self.run_id,
            dataset="readings", name="silver_readings", max_files=max_files,
        ).awaitTermination()
        table.publish_changes(self.path("changes", "readings"))
        return table

    def master(
        self, dataset: str, landed: list[str], key: str, values: list[str], typed: Callable[[DataFrame], DataFrame],
        rules: list[Rule], members: Callable[[DataFrame], DataFrame],
    ) -> SnapshotTable:
        """Landed CSV of master data through bronze and silver to a dimension.

        Silver takes the newest file's row of each member and quarantines rows
        that break a rule; the dimension updates members whose values changed
        and keeps their ``sid``.
        """
        ingest_csv(
            self.spark, self.path("landing", dataset), self.path("bronze", dataset), self.path("checkpoints", f"bronze_{dataset}"),
            landed, self.run_id, name=f"bronze_{dataset}",
        ).awaitTermination()

        def shaped(bronze: DataFrame) -> DataFrame:
            return typed(bronze).withColumnRenamed("_input_file_modification_date", "_record_modified_date").withColumns({
                "_pipeline_run_id": F.lit(self.run_id), "_processing_date": second_precision(F.current_timestamp()),
            }).drop("_input_filename")

        schema = self.spark.read.parquet(self.path("bronze", dataset)).schema
        layout = shaped(self.spark.createDataFrame([], schema)).schema
        silver = SnapshotTable(self.spark, self.path("silver", dataset), [key], layout, self.buckets)
        change = [*values, "_pipeline_run_id", "_processing_date"]
        silver_stream(
            self.spark, self.path("bronze", dataset), schema, silver, transform=shaped, rules=rules, keys=[key],
            order=[F.desc("_record_modified_date")],
            plan=lambda t, s: merge_newer(t, s, [key], "_record_modified_date", change, check_unique=False, mark_changes=True),
            quarantine=self.path("quarantine"), checkpoint=self.path("checkpoints", f"silver_{dataset}"), run_id=self.run_id,
            dataset=dataset, name=f"silver_{dataset}",
        ).awaitTermination()
        rows = members(silver.read())
        shape = rows.select(F.lit(0).cast("long").alias("sid"), "*").schema
        dim = SnapshotTable(self.spark, self.path("gold", f"dim_{dataset}"), [key], shape, self.buckets)
        # Numbering needs the highest sid of all, so the dimension is written whole.
        dim.overwrite(load_dimension(dim.read(), rows, [key]), run_id=self.run_id)
        return dim

    def meters(self) -> SnapshotTable:
        return self.master("meters", METER_LANDED, "meterId", METER_VALUES, type_meters, METER_RULES, meter_members)

    def places(self) -> SnapshotTable:
        return self.master("places", PLACE_LANDED, "zipCode", LOCATION_VALUES, type_places, PLACE_RULES, location_members)

    def run(self, start: str, end: str) -> SnapshotTable:
        """All layers, for whatever has landed since the last run: master data
        and readings side by side, then the fact."""
        landed = [self.spark.read.text(self.path("landing", d)) for d in ("meters", "places", "readings")]
        size_shuffles(self.spark, *landed)

        def readings() -> None:
            self.bronze()
            self.silver()

        meters, places, _ = in_parallel(self.meters, self.places, readings)
        return self.fact(meters.read(), places.read(), self.dates(start, end))

    def dates(self, start: str, end: str) -> DataFrame:
        return dim_date(self.spark, start, end, "compact")

    def times(self) -> DataFrame:
        return dim_time(self.spark)

    def fact(self, meters: DataFrame, places: DataFrame, dates: DataFrame) -> SnapshotTable:
        """Fact stream over reading changes: hash-diff merge on the key hash.

        Rows are identified by hashes; the reading's keys are unique, so the
        latest change of each is taken before the lookups.
        """
        silver = SnapshotTable(self.spark, self.path("silver", "readings"), READING_KEYS)
        lookups = consumption_lookups(meters, places, dates, self.times())
        layout = consumption_rows(self.spark.createDataFrame([], silver.schema), lookups).schema
        table = SnapshotTable(self.spark, self.path("gold", "fact_consumption"), ["_keyHash"], layout, self.buckets)
        fact_stream(
            self.spark, self.path("changes", "readings"), silver.schema, table,
            build=lambda df: (consumption_rows(latest_per_key(df, READING_KEYS, [F.desc("_commit_version")]), lookups), None),
            plan=hash_diff_plan, checkpoint=self.path("checkpoints", "fact"), run_id=self.run_id, name="fact_consumption",
        ).awaitTermination()
        return table


def hash_diff_plan(target: DataFrame, source: DataFrame) -> DataFrame:
    """Hash-diff merge of a fact that is addressed by its key hash alone."""
    from strata.operators.merge import Update, merge

    change = {c: f"s.`{c}`" for c in target.columns if c != "_keyHash"}
    return merge(target, source, ["_keyHash"], updates=(Update(change, "t._valueHash <> s._valueHash"),),
                 check_unique=False, mark_changes=True)
