"""Wide and nested export shapes of published fares."""

from pyspark.sql import DataFrame, functions as F

from ..rules import rights as R


def reported_rights(rights: DataFrame) -> DataFrame:
    """Right keys that at least one row reports, with how often."""
    return rights.where("status <> 'Unknown'").groupBy("right_key").agg(F.count("*").alias("reported"))


def right_columns(rights: DataFrame, keys, column="status", default="Unknown") -> DataFrame:
    """One column per right, in the fixed order; missing ones get ``default``."""
    wide = rights.groupBy(*keys).agg(*[
        F.max(F.when(F.col("right_key") == k, F.col(column))).alias(k) for k in R.RIGHT_KEYS])
    return wide.select(*keys, *[F.coalesce(k, F.lit(default)).alias(k) for k in R.RIGHT_KEYS])


def drop_unreported(wide: DataFrame) -> DataFrame:
    """Leave out right columns that are Unknown on every row.

    The only value that reaches the driver is one row of sixteen flags.
    """
    flags = wide.agg(*[F.max(F.col(k) != "Unknown").alias(k) for k in R.RIGHT_KEYS]).first()
    return wide.drop(*[k for k in R.RIGHT_KEYS if not (flags and flags[k])])


def feature_map(keys, rights: DataFrame) -> DataFrame:
    """features: map<feed key, struct(state, detail)> per key (at most sixteen entries); an Unknown right has no state."""
    from ..functions.names import literal_map
    from ..functions.rights import short_detail
    feed = F.element_at(literal_map(R.FEED_KEYS.items()), F.col("right_key"))
    entry = F.struct(feed.alias("key"), F.struct(
        F.when(F.col("status") != "Unknown", F.col("status")).alias("state"),
        short_detail(F.col("right_key"), F.col("raw_value"), F.col("status")).alias("detail")).alias("value"))
    return rights.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("features"))
