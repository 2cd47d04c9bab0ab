"""Nested collection records: one JSON line per unit and pass."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.names import unit_key
from ..operators import ladder
from . import bridge

RIGHT = "raw_label string, status string, raw_value string, fee_amount double, fee_currency string, canonical_key string"
BRAND = f"""raw_brand_name string, cabin string, screen_order bigint, price_value decimal(14,2), price_type string,
 currency string, display_price_text string, fare_family_code string, description string, source string,
 amenities array<struct<{RIGHT.replace(' string', ': string').replace(' double', ': double')}>>,
 miles struct<mileage_available: boolean, miles_earned: double, bonus_percent: double>"""


def _inner(ddl: str) -> str:
    """A top-level column list as struct fields."""
    import re
    return re.sub(r"(^|, ?|\s)(\w+) (string|bigint|decimal|double|array|struct|boolean|date|int)", r"\1\2: \3", ddl)


CABIN = f"""cabin: string, source: string, departure: date, `return`: date, has_availability: boolean, note: string,
 flight_no: string, booking_class: string, operating_carrier: string, is_codeshare: boolean, is_interline: boolean,
 brands: array<struct<{_inner(BRAND)}>>"""
RECORD = f"""unit_key string, carrier string, origin string, destination string, season string, source string,
 status string, retry_count int, error string, elapsed_s double, cabins array<struct<{CABIN}>>"""


def nest(brands: DataFrame, rights: DataFrame) -> DataFrame:
    """Flat brand rows and their rights as nested records.

    A record holds one itinerary per cabin, each family once and each right once per family, so
    every list is as short as the vocabulary behind it.
    """
    key = bridge.FLIGHT + ["raw_brand_name"]
    none = F.lit(None)
    item = F.struct(F.col("right_key").alias("raw_label"), "status", "raw_value",
                    none.cast("double").alias("fee_amount"), none.cast("string").alias("fee_currency"),
                    F.col("right_key").alias("canonical_key"))
    am = rights.groupBy(*key).agg(F.sort_array(F.collect_list(item)).alias("amenities"))
    df = brands.join(am, key, "left")
    brand = F.struct(
        "raw_brand_name", F.col("group_cabin").alias("cabin"), "screen_order", "price_value", "price_type",
        "currency", "display_price_text", "fare_family_code", F.lit("").alias("description"), "source", "amenities",
        F.struct("mileage_available", "miles_earned", "bonus_percent").alias("miles"))
    rec = bridge.UNIT + ["pass_no"]
    cab = df.groupBy(*rec, "group_cabin", "source", "departure", "return_date").agg(
        F.transform(F.sort_array(F.collect_list(F.struct(F.col("screen_order").alias("o"), brand.alias("b")))),
                    lambda x: x.b).alias("brands"))
    cabin = F.struct(F.col("group_cabin").alias("cabin"), "source", "departure", F.col("return_date").alias("return"),
                     F.lit(True).alias("has_availability"), F.lit("").alias("note"), "brands")
    out = cab.groupBy(*rec).agg(F.sort_array(F.collect_list(F.struct(F.col("group_cabin").alias("o"), cabin.alias("c")))).alias("cs"),
                                F.min("source").alias("source"))
    return out.select(
        unit_key(*[F.col(c) for c in bridge.UNIT]).alias("unit_key"), *bridge.UNIT, "source", F.lit("success").alias("status"),
        F.lit(0).alias("retry_count"), F.lit("").alias("error"), F.lit(0.0).alias("elapsed_s"),
        F.transform("cs", lambda x: x.c).alias("cabins"), "pass_no")


def read_records(spark: SparkSession, *paths) -> DataFrame:
    return spark.read.schema(RECORD).json(list(paths))


def read_tolerant(spark: SparkSession, *paths):
    """(good records, broken lines): a half-written last line never stops a read."""
    lines = spark.read.text(list(paths)).where(F.trim("value") != "")
    df = lines.select(F.from_json("value", RECORD + ", _broken string", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("r"))
    good = df.where("r._broken is null").select("r.*").drop("_broken")
    return good, df.where("r._broken is not null").select("r._broken")


def flatten(records: DataFrame) -> DataFrame:
    """One typed row per brand, with the defaults older records need."""
    c = records.select("unit_key", *bridge.UNIT, F.col("source").alias("record_source"),
                       F.posexplode_outer("cabins").alias("result_no", "c"))
    b = c.select("unit_key", *bridge.UNIT, "record_source", "result_no", F.col("c.cabin").alias("group_cabin"),
                 F.coalesce("c.source", F.lit("")).alias("cabin_source"), "c.departure",
                 F.coalesce("c.has_availability", F.lit(True)).alias("has_availability"),
                 F.coalesce("c.flight_no", F.lit("")).alias("flight_no"), F.explode_outer("c.brands").alias("b"))
    return b.select(
        "*", F.coalesce("b.raw_brand_name", F.lit("")).alias("raw_brand_name"), "b.price_value",
        F.coalesce("b.price_type", F.lit("absolute")).alias("price_type"),
        F.coalesce("b.screen_order", F.lit(0)).alias("screen_order"), "b.fare_family_code", "b.currency",
        F.coalesce("b.source", F.lit("")).alias("brand_source"), "b.amenities", "b.miles").drop("b")


def strength(records: DataFrame) -> DataFrame:
    """Packages and right lines of each record, counted inside its arrays."""
    packs = F.aggregate("cabins", F.lit(0), lambda n, c: n + F.size(F.coalesce(c.brands, F.array())))
    rights = F.aggregate("cabins", F.lit(0), lambda n, c: n + F.aggregate(
        F.coalesce(c.brands, F.array()), F.lit(0), lambda m, b: m + F.coalesce(F.size(b.amenities), F.lit(0))))
    return records.withColumns({"packages": packs, "right_lines": rights})


def overlay(disk: DataFrame, new: DataFrame) -> DataFrame:
    """Records on disk with the newer ones laid over them, by unit key.

    The result goes to a new path; the old one stays readable until readers have moved.
    """
    both = disk.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return ladder.first_group(both, ["unit_key"], [F.col("_batch").desc()]).drop("_batch")


def read_passes(spark: SparkSession, base: str) -> DataFrame:
    """All passes under ``base`` as one table, ``pass_order`` from the folder ``pass_no=N`` of each file."""
    df = read_records(spark, base).drop("pass_no")
    return df.withColumn("pass_order", F.regexp_extract(F.col("_metadata.file_path"), r"/pass_no=(\d+)/", 1).cast("int"))
