"""Joins with the fixed airport and carrier lists; both are a hundred rows, hence broadcast."""

from pyspark.sql import DataFrame, functions as F

from ..functions import names


def with_airport(df: DataFrame, code: str, prefix: str) -> DataFrame:
    """City, country and region of one end of a route; unknown codes become 'Other'."""
    dim = names.airport_dim(df.sparkSession)
    j = df.join(F.broadcast(dim), F.upper(F.trim(F.col(code))) == F.col("ap_code"), "left")
    return j.withColumns({
        f"{prefix}_city_code": F.coalesce("city_code", F.upper(F.trim(F.col(code)))),
        f"{prefix}_country_code": F.coalesce("country_code", F.lit("")),
        f"{prefix}_country": F.coalesce("country_name", F.lit("Other")),
        f"{prefix}_region": F.coalesce("region", F.lit("Other"))}) \
        .drop("ap_code", "city_code", "city_name", "country_code", "country_name", "region")


def with_places(df: DataFrame) -> DataFrame:
    return with_airport(with_airport(df, "origin", "origin"), "destination", "dest")


def with_airline(df: DataFrame, code="carrier", out="airline_name") -> DataFrame:
    dim = names.carrier_dim(df.sparkSession).withColumnRenamed("airline_name", "_name")
    j = df.join(F.broadcast(dim), F.upper(F.col(code)) == F.col("dim_carrier"), "left")
    return j.withColumn(out, F.coalesce("_name", F.col(code))).drop("dim_carrier", "_name")


def route_type():
    """Local when either end lies in Turkey."""
    return F.when(F.array_contains(F.array("origin_country_code", "dest_country_code"), "TR"), "Local") \
        .otherwise("Beyond")


def carrier_type(carrier="carrier"):
    return F.when(names.is_low_cost(F.col(carrier)), "Low Cost").otherwise("Legacy")
