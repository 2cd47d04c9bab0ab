"""Competitive questions: what the next tier costs and what it adds."""

from pyspark.sql import Window, functions as F

from ..functions import names
from ..operators import geography, ladder
from ..plans import archive
from ..rules import rights as R
from ..sources import bridge
from ..sources.tables import scratch
from .ladders import L, route_ladders
from .registry import query

U = bridge.UNIT
MARKET = ["origin", "destination", "season", "cabin"]


def mean(col, as_name):
    """Decimal sum over count, so the result does not depend on row order."""
    return (F.sum(col).cast("double") / F.count(col)).alias(as_name)


def step_rows(spark, sf):
    t = ladder.transitions(route_ladders(spark, sf), L)
    step = F.concat((F.col("brand_order") + 1).cast("string"), F.lit("-"), (F.col("to_order") + 1).cast("string"))
    return t.withColumn("step", step)


@query
def a22_transition_fee(spark, sf):
    """Mean of each unit's own tier fees, never the difference of tier means."""
    return step_rows(spark, sf).groupBy("carrier", "cabin", "step").agg(
        F.count("*").alias("units"), mean("fee", "mean_fee"), F.min("fee").cast("double").alias("lowest"),
        F.max("fee").cast("double").alias("highest"))


def market_steps(spark, sf):
    return step_rows(spark, sf).groupBy(*MARKET, "step", "carrier").agg(F.sum("fee").alias("fee"))


@query
def a23_market_position(spark, sf, target="TK"):
    """The target carrier's fee beside its rivals' range and the market mean."""
    mine = F.col("carrier") == target
    m = market_steps(spark, sf).groupBy(*MARKET, "step").agg(
        F.max(F.when(mine, F.col("fee"))).cast("double").alias("own_fee"),
        F.min(F.when(~mine, F.col("fee"))).cast("double").alias("rival_min"),
        F.max(F.when(~mine, F.col("fee"))).cast("double").alias("rival_max"), mean("fee", "market_mean"))
    own, mid = F.col("own_fee"), F.col("market_mean")
    label = F.when(own < mid * 0.9, "cheap").when(own > mid * 1.1, "expensive").otherwise("average")
    return m.where("own_fee is not null").withColumn("position", label)


@query
def j24_rival_comparison(spark, sf, target="TK"):
    """Target against each market's rivals on the same step, as a join of two aggregates."""
    steps = market_steps(spark, sf)
    own = steps.where(F.col("carrier") == target).select(*MARKET, "step", F.col("fee").alias("own"))
    rivals = steps.where(F.col("carrier") != target).groupBy(*MARKET, "step").agg(
        F.count("*").alias("rivals"), F.sum("fee").alias("rival_sum"))
    j = own.join(rivals, [*MARKET, "step"])
    return j.select(*MARKET, "step", F.col("own").cast("double").alias("own_fee"), "rivals",
                    (F.col("own").cast("double") - F.col("rival_sum").cast("double") / F.col("rivals")).alias("gap"))


@query
def a24_package_index(spark, sf):
    """Cheapest price of each tier of a market by carrier; all carriers, a row each."""
    df = route_ladders(spark, sf).withColumn("tier", names.tier_code(F.col("cabin"), F.col("brand_order")))
    return df.groupBy("origin", "destination", "season", "tier", "carrier").agg(F.min("price").cast("double").alias("price"))


def tier_rights(spark, sf):
    """Granted rights (Included or Paid) and content score of each route ladder's families.

    The right of one family is one bit.  The strongest statement counts, so a right is granted if any statement
    grants it and scores 1 if any includes it: two bit sets say all, and no right needs a row of its own.
    """
    r = bridge.rights(spark, sf)
    idx = F.array_position(F.array(*[F.lit(k) for k in R.RIGHT_KEYS]), F.col("right_key")).cast("int")
    bit = F.call_function("shiftleft", F.lit(1), idx)
    stated = lambda status: F.bit_or(F.when(F.col("status") == status, bit).otherwise(0))
    per = r.groupBy(*U, F.col("group_cabin").alias("cabin"), "raw_brand_name").agg(
        stated("Included").alias("included"), stated("Paid").alias("paid"))
    only_paid = F.col("paid").bitwiseAND(F.bitwise_not("included"))
    per = per.select(*L, "raw_brand_name", F.col("included").bitwiseOR(F.col("paid")).alias("granted"),
                     (F.bit_count("included") + F.bit_count(only_paid) * 0.5).alias("score"))
    return route_ladders(spark, sf).join(per, L + ["raw_brand_name"])


def tier_steps(spark, sf):
    """Each step of a route ladder with its fee, the rights it adds and the change of the content score.

    A right that can be bought counts as gained.
    """
    w = Window.partitionBy(*L).orderBy("brand_order")
    t = tier_rights(spark, sf).withColumns({
        "upper": F.lead("granted").over(w), "upper_score": F.lead("score").over(w), "upper_price": F.lead("price").over(w),
        "to_order": F.lead("brand_order").over(w)}).where("to_order is not null")
    return t.select(*L, "brand_order", "to_order", F.concat_ws("-", F.col("brand_order") + 1, F.col("to_order") + 1).alias("step"),
                    (F.col("upper_price") - F.col("price")).cast("decimal(14,2)").alias("fee"),
                    F.bit_count(F.col("upper").bitwiseAND(F.bitwise_not("granted"))).alias("gained"),
                    (F.col("upper_score") - F.col("score")).alias("score_change"))


@query
def a25_fee_heatmap(spark, sf):
    """Carriers against tier steps under three metrics: mean fee, mean rights gained, mean change of score."""
    per = tier_steps(spark, sf).groupBy("carrier", "step").agg(
        F.count("*").alias("units"), mean("fee", "fee"), (F.sum("gained") / F.count("*")).alias("rights_gained"),
        (F.sum("score_change") / F.count("*")).alias("score_change"))
    return per.unpivot(["carrier", "step", "units"], ["fee", "rights_gained", "score_change"], "metric", "value")


@query
def a26_rights_gained(spark, sf):
    """Rights each step adds; a right that can be bought counts as gained."""
    return tier_steps(spark, sf).groupBy("carrier", "cabin", "brand_order", "to_order").agg(
        F.count("*").alias("units"), F.sum("gained").alias("gained"), F.sum("score_change").alias("score_change"))


@query
def a32_content_score(spark, sf):
    """Content score per tier: Included 1, Paid 0.5, anything else 0."""
    t = tier_rights(spark, sf).withColumn("tier", names.tier_code(F.col("cabin"), F.col("brand_order")))
    return t.groupBy("carrier", "tier").agg(F.count("*").alias("families"), F.sum("score").alias("score"),
                                            F.max("score").alias("best"))


@query
def a27_geographic_drill(spark, sf):
    df = geography.with_places(step_rows(spark, sf)).withColumn("ond", F.concat_ws("-", "origin", "destination"))
    return df.groupingSets(
        [["ond", "cabin"], ["origin_country", "cabin"], ["origin_region", "cabin"]],
        "ond", "origin_country", "origin_region", "cabin").agg(F.count("*").alias("steps"), mean("fee", "mean_fee"))


@query
def a27_rollup_and_cube(spark, sf):
    df = geography.with_places(step_rows(spark, sf)).withColumn("ond", F.concat_ws("-", "origin", "destination"))
    up = df.rollup("origin_region", "origin_country", "ond").agg(F.count("*").alias("steps"), mean("fee", "mean_fee")) \
        .select(F.lit("rollup").alias("kind"), "origin_region", "origin_country", "ond",
                F.lit(None).cast("string").alias("season"), F.lit(None).cast("string").alias("cabin"), "steps", "mean_fee")
    cube = df.cube("season", "cabin").agg(F.count("*").alias("steps"), mean("fee", "mean_fee"))
    none = F.lit(None).cast("string")
    return up.unionByName(cube.select(F.lit("cube").alias("kind"), none.alias("origin_region"), none.alias("origin_country"),
                                      none.alias("ond"), "season", "cabin", "steps", "mean_fee"))


@query
def a28_carrier_profile(spark, sf):
    """Coverage, tiers, mean fee and family list; lists are built from distinct values."""
    lad, steps = route_ladders(spark, sf), step_rows(spark, sf)
    cover = lad.groupBy("carrier").agg(F.countDistinct("origin", "destination").alias("routes"),
                                       F.max(F.col("brand_order") + 1).alias("tiers"))
    fee = steps.groupBy("carrier").agg(mean("fee", "mean_fee"))
    fam = lad.select("carrier", "raw_brand_name").distinct().groupBy("carrier").agg(
        F.array_join(F.sort_array(F.collect_set("raw_brand_name")), ", ").alias("families"))
    return cover.join(fee, "carrier").join(fam, "carrier")


@query
def a29_distinct_counts(spark, sf):
    return bridge.lines(spark, sf).agg(
        F.count("*").alias("rows"), F.countDistinct("origin", "destination").alias("onds"),
        F.countDistinct("carrier").alias("carriers"), F.countDistinct("carrier", "raw_brand_name").alias("packages"))


@query
def a30_first_right_map(spark, sf):
    """Per carrier and family the first statement of each right, in reading order."""
    r = bridge.rights(spark, sf).withColumn("k", names.match_key(F.col("raw_brand_name")))
    first = r.groupBy("carrier", "k", "right_key").agg(F.min(F.struct("pos", "flight_id", "status", "raw_value")).alias("b"))
    return first.select("carrier", "k", "right_key", "b.status", "b.raw_value")


@query
def a31_nested_index(spark, sf):
    """carrier -> route -> season -> cabins, as one nested row per carrier."""
    d = bridge.ladders(spark, sf).select(*U, "cabin").distinct()
    s = d.groupBy("carrier", "origin", "destination", "season").agg(F.sort_array(F.collect_set("cabin")).alias("cabins"))
    o = s.groupBy("carrier", F.concat_ws("-", "origin", "destination").alias("ond")).agg(
        F.sort_array(F.collect_list(F.struct("season", "cabins"))).alias("seasons"))
    idx = o.groupBy("carrier").agg(F.map_from_entries(F.collect_list(F.struct("ond", "seasons"))).alias("onds"))
    flat = idx.select("carrier", F.size("onds").alias("n_onds"), F.explode("onds").alias("ond", "seasons"))
    return flat.select("carrier", "n_onds", "ond", F.array_join(F.transform("seasons", lambda x: F.concat(
        x.season, F.lit(":"), F.array_join(x.cabins, "/"))), ";").alias("seasons"))


@query
def o1_comparison_order(spark, sf):
    df = route_ladders(spark, sf)
    return df.select(*L, "brand_order", "raw_brand_name").orderBy(
        "origin", "destination", "carrier", "season", names.cabin_base(F.col("cabin")), "brand_order")


@query
def p16_export_filters(spark, sf, season="Summer", missing="meal"):
    """Ladders of one season in which a right is stated nowhere."""
    r = bridge.rights(spark, sf)
    have = r.where(F.col("right_key") == missing).select(*bridge.FLIGHT).distinct()
    df = bridge.cards(spark, sf).where(F.col("season") == season).join(have, bridge.FLIGHT, "left_anti")
    return df.groupBy("carrier", "group_cabin").agg(F.count("*").alias("packages"),
                                                    F.countDistinct("flight_id").alias("ladders"))


def filter_bar(df, carriers=None, cabins=None, routes=None, seasons=None, regions=None, days=None, collected=None):
    """The common filters of every view; an absent one lets everything through.

    ``days`` bounds the departure, ``collected`` the collection day.
    """
    for col, wanted in (("carrier", carriers), ("cabin", cabins), ("ond", routes), ("season", seasons),
                        ("origin_region", regions)):
        if wanted:
            df = df.where(F.col(col).isin(list(wanted)))
    for col, span in (("departure", days), ("coll_date", collected)):
        if span:
            df = df.where(F.col(col).between(*[F.lit(d).cast("date") for d in span]))
    return df


@query
def p17_filter_bar(spark, sf):
    """All filters at once over the archive; of its days only the chosen ones are read."""
    path = scratch(spark, "archive")
    fares = archive.collected_fares(spark, sf)
    archive.replace_days(fares, path)
    kept = archive.read_days(spark, path, fares.schema)
    df = geography.with_places(kept).withColumn("ond", F.concat_ws("-", "origin", "destination"))
    df = filter_bar(df, carriers=["TK", "LH", "AC"], cabins=["Economy", "Business"], seasons=["Summer"],
                    regions=["Europe", "Turkey"], collected=("2026-01-16", "2026-01-17"))
    return df.groupBy(F.col("coll_date").cast("string").alias("coll_date"), "carrier", "cabin", "ond").agg(
        F.count("*").alias("n"), F.sum("price").cast("double").alias("total"))


@query
def p17_departure_filter(spark, sf):
    df = geography.with_places(bridge.lines(spark, sf)).withColumn("ond", F.concat_ws("-", "origin", "destination")) \
        .withColumnRenamed("group_cabin", "cabin")
    df = filter_bar(df, carriers=["TK", "LH", "AC"], cabins=["Economy", "Business"], seasons=["Summer"],
                    regions=["Europe", "Turkey"], days=("2026-06-01", "2026-07-10"))
    return df.groupBy("carrier", "cabin", "ond").agg(F.count("*").alias("n"),
                                                     F.sum("price_value").cast("double").alias("total"))
