"""Review data: batch silver layer, and the streaming medallion to a star."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import storage
from strata.functions.cleaning import at_least, array_count, list_count, normalize_by_rules, split_list, to_day, try_bool, unquote_flag
from strata.operators.dimensions import dim_date, scd1, scd1_members
from strata.operators.facts import build_fact
from strata.operators.joins import Lookup
from strata.operators.merge import Update, merge, merge_upsert
from strata.operators.projections import carry_lineage
from strata.operators.quality import Rule, required, schema_fits, to_quarantine, with_flags
from strata.operators.windows import latest_per_key
from strata.plans.metric_view import Join, MetricView
from strata.session import in_parallel, size_shuffles
from strata.sinks.snapshots import SnapshotTable
from strata.streaming.evolving import ingest_evolving, read_evolving
from strata.streaming.jobs import dim_stream, fact_stream, ingest_bronze, silver_stream

# Fixed names: compliment counters of a user.
COMPLIMENTS = [
    "compliment_hot", "compliment_more", "compliment_profile", "compliment_cute", "compliment_list", "compliment_note",
    "compliment_plain", "compliment_cool", "compliment_funny", "compliment_writer", "compliment_photos",
]


def silver_business(bronze: DataFrame) -> DataFrame:
    """Typed amenities and categories of a business, for the batch layer."""
    a = "attributes"
    return bronze.select(
        "business_id", "name", "city", "state", "latitude", "longitude", "stars", "review_count",
        split_list("categories").alias("categories"),
        F.col(f"{a}.RestaurantsPriceRange2").try_cast("int").alias("priceRange"),
        try_bool(f"{a}.WheelchairAccessible").alias("wheelchairAccessible"),
        try_bool(f"{a}.DriveThru").alias("driveThru"),
        try_bool(f"{a}.RestaurantsTakeOut").alias("takeOut"),
        unquote_flag(f"{a}.WiFi", "free", "paid").alias("freeWifi"),
    )


def silver_user(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "user_id", "name", to_day("yelping_since").alias("member_since"), "review_count",
        F.col("cool").alias("review_cool_votes"), F.col("useful").alias("review_useful_votes"),
        F.col("funny").alias("review_funny_votes"), "average_stars",
        split_list("elite").alias("elite_years"), list_count("elite").alias("elite_year_count"),
    )


def silver_review(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "review_id", "user_id", "business_id", to_day("date").alias("review_date"), "stars",
        F.col("useful").alias("review_useful_votes"), F.col("funny").alias("review_funny_votes"),
        F.col("cool").alias("review_cool_votes"), "text",
    )


def silver_tip(bronze: DataFrame) -> DataFrame:
    """A tip is popular from three compliments on."""
    return bronze.select(
        "user_id", "business_id", to_day("date").alias("tip_date"), "text", "compliment_count",
        at_least("compliment_count", 3).alias("is_popular_tip"),
    )


# Landed layouts of the batch layer.
BATCH_LAYOUTS = {
    "business": "business_id string, name string, city string, state string, latitude double, longitude double, stars double, review_count long, categories string, "
                "attributes struct<RestaurantsPriceRange2: string, WheelchairAccessible: string, DriveThru: string, RestaurantsTakeOut: string, WiFi: string>",
    "user": "user_id string, name string, yelping_since string, review_count long, useful long, funny long, cool long, average_stars double, elite string",
    "review": "review_id string, user_id string, business_id string, date string, stars double, useful long, funny long, cool long, text string",
    "tip": "user_id string, business_id string, date string, text string, compliment_count long",
}


def batch_silver(spark: SparkSession, landing: str, silver: str) -> dict[str, DataFrame]:
    """Landed JSON of all four datasets to typed silver tables, side by side; a
    run replaces the tables. Returns them by name."""
    shapes = {"business": silver_business, "user": silver_user, "review": silver_review, "tip": silver_tip}
    sources = {name: spark.read.schema(layout).json(f"{landing}/{name}") for name, layout in BATCH_LAYOUTS.items()}
    size_shuffles(spark, *sources.values())

    def write(name: str) -> None:
        shapes[name](sources[name]).write.mode("overwrite").parquet(f"{silver}/{name}")

    in_parallel(*[lambda name=name: write(name) for name in shapes])
    return {name: spark.read.parquet(f"{silver}/{name}") for name in shapes}



# Row rules, weightiest first: the first failed one gives the category.
# Fixed values.
REVIEW_RULES = [
    schema_fits(),
    Rule("primary_key", "review_id IS NOT NULL", "review_id", "Missing primary key: review_id", "MISSING_PRIMARY_KEY"),
    Rule("user_id", "user_id IS NOT NULL", "user_id", "Missing foreign key: user_id", "MISSING_FOREIGN_KEY"),
    Rule("business_id", "business_id IS NOT NULL", "business_id", "Missing foreign key: business_id", "MISSING_FOREIGN_KEY"),
    Rule("stars", "stars BETWEEN 1 AND 5", "stars", "Invalid star rating: must be 1-5", "INVALID_VALUE"),
    Rule("date", "review_date IS NOT NULL", "review_date", "Invalid date format", "BUSINESS_RULE"),
]
# Fixed values.
TIP_RULES = [
    schema_fits(),
    required("user_id"),
    required("business_id"),
    Rule("date", "tip_date IS NOT NULL", "tip_date", "Invalid date", "INVALID_DATE"),
    Rule("text", "tip_text IS NOT NULL", "tip_text", "Missing tip text", "MISSING_CONTENT"),
]

# Fixed values.
FACT_RULES = [
    Rule("business_key", "SK_business_id IS NOT NULL", "SK_business_id", "Missing business dimension key", "MISSING_KEY"),
    Rule("user_key", "SK_user_id IS NOT NULL", "SK_user_id", "Missing user dimension key", "MISSING_KEY"),
    Rule("date_key", "SK_date_id IS NOT NULL", "SK_date_id", "Missing date dimension key", "MISSING_KEY"),
]


def review_transform(bronze: DataFrame, run_id: str) -> DataFrame:
    renamed = bronze.withColumn("review_date", to_day("date")).withColumnsRenamed({
        "useful": "review_useful_votes", "funny": "review_funny_votes", "cool": "review_cool_votes", "text": "review_text",
    })
    return carry_lineage(renamed, "bronze", "silver", run_id).drop("date", "_input_filename")


def tip_transform(bronze: DataFrame, run_id: str) -> DataFrame:
    shaped = bronze.withColumns({
        "tip_date": to_day("date"),
        "tip_compliment_count": F.coalesce(F.col("compliment_count"), F.lit(0)),
    }).withColumnRenamed("text", "tip_text")
    return carry_lineage(shaped, "bronze", "silver", run_id).drop("date", "compliment_count", "_input_filename")


def business_transform(bronze: DataFrame, run_id: str) -> DataFrame:
    shaped = bronze.withColumn("city", normalize_by_rules("city")).withColumnsRenamed({
        "stars": "lifetime_avg_stars", "review_count": "lifetime_review_count",
    })
    return carry_lineage(shaped, "bronze", "silver", run_id).drop("_input_filename")


def user_transform(bronze: DataFrame, run_id: str) -> DataFrame:
    shaped = bronze.withColumns({
        "member_since": to_day("yelping_since"), "elite_years": split_list("elite"), "friends_array": split_list("friends"),
    }).withColumnsRenamed({"average_stars": "lifetime_avg_stars", "review_count": "lifetime_review_count"})
    return carry_lineage(shaped, "bronze", "silver", run_id).drop("yelping_since", "elite", "friends", "_input_filename")


def user_members(silver: DataFrame) -> DataFrame:
    """User rows in dimension layout, with the number of friends for the list."""
    counted = silver.withColumn("friends_count", array_count("friends_array"))
    cols = [
        "user_id", "name", "member_since", "lifetime_review_count", "useful", "funny", "cool", "elite_years",
        "friends_count", "fans", "lifetime_avg_stars", *COMPLIMENTS,
    ]
    return scd1_members(counted.select(*[c for c in cols if c in counted.columns]), "user_id")


def business_members(silver: DataFrame) -> DataFrame:
    cols = [
        "business_id", "name", "address", "city", "state", "postal_code", "latitude", "longitude", "lifetime_avg_stars",
        "lifetime_review_count", "is_open", "attributes", "categories", "hours",
    ]
    return scd1_members(silver.select(*[c for c in cols if c in silver.columns]), "business_id")


# Fixed values.
REVIEW_METRICS = MetricView(
    joins=(
        Join("business", "source.SK_business_id = business.SK_business_id"),
        Join("date_dim", "source.SK_date_id = date_dim.SK_date_id"),
    ),
    filter="business.city = 'Edmonton'",
    dimensions={
        "review_date": "date_dim.date_actual", "year": "date_dim.year", "month": "date_dim.month",
        "month_name": "date_dim.month_name", "business_name": "business.name", "city": "business.city",
        "categories": "business.categories", "is_open": "business.is_open", "star_rating": "source.stars",
    },
    measures={
        "total_reviews": "count(1)", "avg_stars": "avg(stars)", "total_useful_votes": "sum(review_useful_votes)",
        "total_funny_votes": "sum(review_funny_votes)", "total_cool_votes": "sum(review_cool_votes)",
        "five_star_reviews": "count(1) FILTER (WHERE stars = 5.0)",
        "one_star_reviews": "count(1) FILTER (WHERE stars = 1.0)",
        "five_star_pct": "MEASURE(five_star_reviews) * 100.0 / MEASURE(total_reviews)",
    },
)

# The fields of the landed files. Nested objects stay JSON text.
BUSINESS_SCHEMA = (
    "business_id string, name string, address string, city string, state string, postal_code string, latitude double, longitude double, "
    "stars double, review_count long, is_open int, attributes string, categories string, hours string"
)
USER_SCHEMA = (
    "user_id string, name string, yelping_since string, review_count long, average_stars double, useful long, funny long, cool long, fans long, elite string, friends string, "
    "compliment_hot long, compliment_more long, compliment_profile long, compliment_cute long, compliment_list long, compliment_note long, "
    "compliment_plain long, compliment_cool long, compliment_funny long, compliment_writer long, compliment_photos long"
)
TIP_SCHEMA = "user_id string, business_id string, text string, date string, compliment_count long"
REVIEW_SCHEMA = "review_id string, user_id string, business_id string, stars double, useful long, funny long, cool long, text string, date string"
BUSINESS_COLUMNS = [
    "business_id", "name", "address", "city", "state", "postal_code", "latitude", "longitude", "lifetime_avg_stars",
    "lifetime_review_count", "is_open", "attributes", "categories", "hours",
]
USER_COLUMNS = [
    "user_id", "name", "member_since", "lifetime_review_count", "lifetime_avg_stars", "useful", "funny", "cool", "fans",
    "elite_years", "friends_array", *COMPLIMENTS,
]
REVIEW_COLUMNS = [
    "review_id", "user_id", "business_id", "review_date", "stars", "review_useful_votes", "review_funny_votes",
    "review_cool_votes", "review_text",
]
TIP_COLUMNS = ["user_id", "business_id", "tip_date", "tip_text", "tip_compliment_count"]
LINEAGE_DATES = ["_bronze_processing_date", "_silver_processing_date"]
LINEAGE = ["_bronze_pipeline_run_id", "_silver_pipeline_run_id", *LINEAGE_DATES]


def replace_reviews(target: DataFrame, source: DataFrame) -> DataFrame:
    """Upsert of review facts that leaves the creation date of known ones."""
    change = {c: f"s.`{c}`" for c in target.columns if c != "fact_created_date"}
    return merge(target, source, ["NK_review_id"], updates=(Update(change),), check_unique=False, mark_changes=True)


def schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


@dataclass(frozen=True)
class ReviewLake:
    """Folders of one review lakehouse under ``root``."""

    spark: SparkSession
    root: str
    run_id: str = "run"
    buckets: int = 8
    evolve: bool = False  # unknown fields widen the bronze schema instead of being quarantined

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def quarantine(self) -> str:
        return self.path("quarantine")

    def bronze(self, dataset: str, ddl: str, max_files: int | None = 75) -> None:
        if self.evolve:
            ingest_evolving(
                self.spark, self.path("landing", dataset), self.path("bronze", dataset), self.path("checkpoints", f"bronze_{dataset}"),
                self.path("schemas", dataset), self.run_id, start=schema_of(ddl), max_files=max_files, name=f"bronze_{dataset}",
            )
            return
        ingest_bronze(
            self.spark, self.path("landing", dataset), self.path("bronze", dataset), self.path("checkpoints", f"bronze_{dataset}"),
            schema_of(ddl), self.run_id, max_files=max_files, name=f"bronze_{dataset}",
        ).awaitTermination()

    def _bronze_schema(self, dataset: str) -> StructType:
        if self.evolve:
            return read_evolving(self.spark, self.path("bronze", dataset), self.path("schemas", dataset)).schema
        return self.spark.read.parquet(self.path("bronze", dataset)).schema

    def table(self, layer: str, name: str, keys, schema: StructType | None = None) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path(layer, name), keys, schema, self.buckets)

    def silver(self, dataset: str, transform, rules, keys, columns, max_files: int | None = 10) -> SnapshotTable:
        """Run the silver stream of a dataset and publish its changes."""
        bronze_schema = self._bronze_schema(dataset)
        shaped = transform(self.spark.createDataFrame([], bronze_schema), self.run_id)
        table = self.table("silver", dataset, keys, shaped.select(*columns, *LINEAGE).schema)
        silver_stream(
            self.spark, self.path("bronze", dataset), bronze_schema, table,
            transform=lambda df: transform(df, self.run_id), rules=rules, keys=keys,
            order=[F.desc("_input_file_modification_date"), F.desc("_bronze_processing_date")],
            plan=lambda t, s: merge_upsert(t, s, keys, check_unique=False, mark_changes=True),
            quarantine=self.quarantine, checkpoint=self.path("checkpoints", f"silver_{dataset}"),
            run_id=self.run_id, dataset=dataset, name=f"silver_{dataset}", max_files=max_files, recursive=self.evolve,
        ).awaitTermination()
        table.publish_changes(self.path("changes", dataset))
        return table

    def dimension(self, dataset: str, members, natural_key: str) -> SnapshotTable:
        """Run the type 1 dimension stream over a dataset's silver changes."""
        silver = self.table("silver", dataset, [natural_key])
        layout = members(self.spark.createDataFrame([], silver.schema))
        table = self.table("gold", f"dim_{dataset}", [f"NK_{natural_key}"], layout.schema)
        dim_stream(
            self.spark, self.path("changes", dataset), silver.schema, table,
            transform=lambda df: members(latest_per_key(df, [natural_key], [F.desc("_commit_version")])),
            plan=lambda t, s: scd1(t, s, natural_key, check_unique=False, mark_changes=True),
            checkpoint=self.path("checkpoints", f"dim_{dataset}"), run_id=self.run_id, name=f"dim_{dataset}",
        ).awaitTermination()
        return table

    def date_dimension(self, start: str, end: str) -> DataFrame:
        path = self.path("gold", "dim_date")
        dim_date(self.spark, start, end).coalesce(1).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def review_fact(self, dates: DataFrame) -> SnapshotTable:
        """Fact stream over review changes. A review that comes again replaces
        its earlier fact row instead of doubling it; the date that row was
        created stays. Only rows with all keys reach the fact."""
        silver = self.table("silver", "review", ["review_id"])
        business = self.table("gold", "dim_business", ["NK_business_id"])
        users = self.table("gold", "dim_user", ["NK_user_id"])
        measures = ["stars", "review_useful_votes", "review_funny_votes", "review_cool_votes", "review_text", *LINEAGE_DATES]

        def lookups() -> list[Lookup]:
            return [
                Lookup(business.read(), {"business_id": "NK_business_id"}, {"SK_business_id": "SK_business_id"}),
                Lookup(users.read(), {"user_id": "NK_user_id"}, {"SK_user_id": "SK_user_id"}),
                Lookup(dates, {"review_date": "date_actual"}, {"SK_date_id": "SK_date_id"}),
            ]

        def build(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
            accepted, rejected = build_fact(
                batch.withColumnRenamed("review_id", "NK_review_id"), lookups(), "NK_review_id", measures,
                [F.desc("_commit_version")],
            )
            bad = to_quarantine(
                with_flags(rejected, FACT_RULES), FACT_RULES, dataset="review", table_name="fact_review", layer="gold",
                keys=["NK_review_id"], run_id=self.run_id,
            )
            valid = {f"dq_{k}_key_valid": F.lit(True) for k in ("business", "user", "date")}
            return accepted.withColumns({**valid, "fact_created_date": F.current_timestamp()}), bad

        layout, _ = build(self.spark.createDataFrame([], silver.schema).withColumn("_commit_version", F.lit(0)))
        table = self.table("gold", "fact_review", ["NK_review_id"], layout.schema)
        fact_stream(
            self.spark, self.path("changes", "review"), silver.schema, table, build=build,
            plan=replace_reviews, checkpoint=self.path("checkpoints", "fact_review"), run_id=self.run_id, name="fact_review",
            quarantine=self.quarantine,
        ).awaitTermination()
        return table

    def tips(self) -> SnapshotTable:
        """Bronze and silver tips; a tip has no id, so user, business and day are its key."""
        self.bronze("tip", TIP_SCHEMA)
        return self.silver("tip", tip_transform, TIP_RULES, ["user_id", "business_id", "tip_date"], TIP_COLUMNS)

    def run(self, start: str, end: str) -> SnapshotTable:
        """All layers in order, for whatever has landed since the last run.
        The datasets of one layer do not depend on each other. Tips feed no
        dimension or fact and may be absent."""
        size_shuffles(self.spark, *[self.spark.read.text(self.path("landing", d)) for d in ("business", "user", "review")])
        if storage.exists(self.spark, self.path("landing", "tip")):
            self.tips()
        key = lambda c: [schema_fits(), required(c)]
        in_parallel(
            lambda: self.bronze("business", BUSINESS_SCHEMA),
            lambda: self.bronze("user", USER_SCHEMA),
            lambda: self.bronze("review", REVIEW_SCHEMA),
        )
        in_parallel(
            lambda: self.silver("business", business_transform, key("business_id"), ["business_id"], BUSINESS_COLUMNS),
            lambda: self.silver("user", user_transform, key("user_id"), ["user_id"], USER_COLUMNS),
            lambda: self.silver("review", review_transform, REVIEW_RULES, ["review_id"], REVIEW_COLUMNS),
        )
        in_parallel(
            lambda: self.dimension("business", business_members, "business_id"),
            lambda: self.dimension("user", user_members, "user_id"),
        )
        return self.review_fact(self.date_dimension(start, end))
