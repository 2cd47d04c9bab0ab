"""Choosing among itineraries of one search.

Every choice is a top-1 by an ordering, so that Spark keeps one candidate per key and task
before anything is shuffled; no operator ranks a whole search.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions import names
from . import ladder
from .ranking import numbered


def in_search(df: DataFrame, group="group_cabin") -> DataFrame:
    """Cards under their own cabin; only the Economy search may yield higher cabins."""
    return ladder.regroup(df, group, keep_higher=F.col(group) == "Economy")


def flight_scores(buckets: DataFrame, flight, carry=()) -> DataFrame:
    """Figures by which itineraries of a search compete."""
    df = ladder.step_ratio(buckets, flight)
    return df.groupBy(*flight, *carry).agg(
        F.size(F.collect_set("cabin")).alias("cabins"), F.count("*").alias("fares"),
        F.sum("n_rights").alias("items"), F.min("price_value").alias("base_price"),
        F.max((F.col("cabin") == F.col("group_cabin")).cast("int")).alias("has_searched"),
        *ladder.quality_columns())


def right_coverage(rights: DataFrame, flight, keys) -> DataFrame:
    """How many different rights an itinerary states, as a bit set (fixed-size state)."""
    index = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col("right_key")).cast("int")
    bits = F.bit_or(F.when(index > 0, F.call_function("shiftleft", F.lit(1), index)).otherwise(0))
    return rights.groupBy(*flight).agg(F.bit_count(bits).alias("n_rights_known"))


def broadest_first():
    """Order of the marketplace: cabins, fares, rights, sane steps, items, cheapest base."""
    return [F.col("cabins").desc(), F.col("fares").desc(), F.col("n_rights_known").desc(),
            F.col("bad_steps"), F.col("worst_step"), F.col("items").desc(),
            F.col("base_price").asc_nulls_last(), F.col("flight_id")]


def direct_first():
    """Order of the search page: direct itineraries that price the searched cabin, then fares."""
    pooled = (F.col("direct") & (F.col("has_searched") == 1)).desc()
    return [pooled, F.col("fares").desc(), F.col("cabins").desc(), F.col("bad_steps"),
            F.col("worst_step"), F.col("base_price").asc_nulls_last(), F.col("flight_id")]


def side_picks(by_cabin: DataFrame, search) -> DataFrame:
    """The winner's cabins, and for each higher cabin it lacks the next itinerary offering one.

    ``by_cabin`` has a row per itinerary and cabin with the itinerary's figures.
    """
    first = ladder.first_rows(by_cabin, [*search, "cabin"], direct_first())
    winner = ladder.first_rows(by_cabin, search, direct_first()).select(
        *search, F.col("flight_id").alias("winner"))
    higher = names.cabin_base(F.col("cabin")) > names.cabin_base(F.col("group_cabin"))
    return first.join(winner, search).where((F.col("flight_id") == F.col("winner")) | higher) \
        .withColumn("is_side_pick", F.col("flight_id") != F.col("winner"))


def dedicated_over_leak(picks: DataFrame, unit) -> DataFrame:
    """A cabin's own search beats a leak from another; then the earlier search."""
    return ladder.first_rows(picks, [*unit, "cabin"], [
        (F.col("cabin") == F.col("group_cabin")).desc(), names.cabin_base(F.col("group_cabin"))])


def split_in_halves(df: DataFrame, first="origin", second="destination") -> DataFrame:
    """Distinct routes in two halves by code order; of an odd number the second half has one more."""
    routes, total = numbered(df.select(first, second).distinct(), [first, second])
    return routes.select(first, second, F.when(F.col("place") <= total // 2, "A").otherwise("B").alias("half"))
