"""Fares kept by the day they were collected."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..sources import bridge

DAY = "coll_date"


def collected_fares(spark, sf_dir) -> DataFrame:
    """Cheapest absolute price per collection day, route ladder and family; a pass is collected in a day."""
    df = bridge.with_itinerary(bridge.raw_lines(spark, sf_dir), season=False) \
        .where((F.col("price_type") == "absolute") & F.col("price_value").isNotNull()) \
        .withColumn(DAY, F.date_add(F.lit(bridge.FIRST_DAY).cast("date"), F.col("pass_no")))
    return df.withColumnRenamed("group_cabin", "cabin").groupBy(*bridge.UNIT, "cabin", "raw_brand_name", DAY).agg(F.min("price_value").alias("price"))


def replace_days(fares: DataFrame, path: str) -> None:
    """Writes the days ``fares`` has; a day already there is replaced whole, other days stay as they are."""
    fares.repartition(DAY, "carrier").write.partitionBy(DAY).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_days(spark: SparkSession, path: str, schema: StructType, first=None, last=None) -> DataFrame:
    """The archive, or its days from ``first`` to ``last``; only their folders are read."""
    fields = [f for f in schema.fields if f.name != DAY]
    df = spark.read.schema(StructType([*fields, StructField(DAY, DateType())])).parquet(path)
    if first is not None:
        df = df.where(F.col(DAY) >= F.lit(first).cast("date"))
    return df if last is None else df.where(F.col(DAY) <= F.lit(last).cast("date"))
