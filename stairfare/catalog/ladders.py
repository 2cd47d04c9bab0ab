"""Ladder building, ordering, choosing and publishing."""

from pyspark.sql import Window, functions as F

from ..functions import names
from ..operators import consensus, ladder
from ..plans import gold
from ..sources import bridge
from .registry import query

U = bridge.UNIT
L = U + ["cabin"]


def route_ladders(spark, sf):
    df = bridge.ladders(spark, sf)
    df = df.withColumn("name_rank", names.name_rank(F.col("raw_brand_name"), F.col("cabin")))
    return ladder.number_ladder(df, L, ladder.by_price("price", "name_rank", "raw_brand_name"))


@query
def w1_brand_order(spark, sf):
    return route_ladders(spark, sf).select(*L, "raw_brand_name", F.col("price").cast("double").alias("price"),
                                           "name_rank", "brand_order")


@query
def w2_tier_code(spark, sf):
    df = route_ladders(spark, sf).withColumn("tier_code", names.tier_code(F.col("cabin"), F.col("brand_order")))
    return df.groupBy("carrier", "tier_code").agg(
        F.count("*").alias("n"), F.min("price").cast("double").alias("cheapest"))


@query
def w3_delta_prices(spark, sf):
    df = ladder.resolve_prices(bridge.cards(spark, sf), bridge.FLIGHT, ["screen_order", "raw_brand_name"])
    return df.groupBy("carrier", "group_cabin", "price_type").agg(
        F.count("*").alias("n"), F.count("resolved").alias("n_priced"),
        F.sum("resolved").cast("double").alias("total"))


@query
def w4_strongest_record(spark, sf):
    df = gold.strongest_records(gold.chosen_results(spark, sf))
    return df.select(*U, "pass_no", "packages", "right_lines").distinct()


@query
def w5_one_ladder_per_cabin(spark, sf):
    df = ladder.one_ladder_per_cabin(ladder.rank_results(gold.unit_brands(spark, sf), U), U)
    return df.groupBy(*U, "cabin", "group_cabin").agg(F.count("*").alias("brands"))


@query
def w6_unique_published_names(spark, sf):
    return gold.published(spark, sf).select(
        *U, "cabin", "shown_name", "brand_order", "tier_code",
        F.col("abs_price").cast("double").alias("abs_price"))


def dated_ladders(spark, sf):
    """Ladder figures of each itinerary: date, size, content, quality."""
    df = ladder.step_ratio(bridge.cards(spark, sf), bridge.FLIGHT)
    return df.groupBy(*bridge.FLIGHT, *[c for c in U if c != "season"], "source", "departure",
                      "block_no", "date_pos").agg(
        F.count("*").alias("n_brands"), F.sum("n_rights").alias("content"),
        F.min("price_value").alias("base_price"), *ladder.quality_columns())


@query
def w7_best_date(spark, sf):
    best = ladder.first_rows(dated_ladders(spark, sf), U + ["group_cabin"], [
        F.col("n_brands").desc(), F.col("content").desc(), F.col("departure"), F.col("flight_id")])
    return best.select(*U, "group_cabin", F.col("departure").cast("string").alias("departure"),
                       "n_brands", "content")


def walked_days(walk, limit=5):
    """Days the walk really visits: a block ends at its n-th absence if nothing was found before."""
    w = Window.partitionBy(*U, "walk_block")
    nth = F.row_number().over(Window.partitionBy(*U, "walk_block", "outcome").orderBy("day"))
    df = walk.withColumn("nth", nth)
    stop = F.min(F.when((F.col("outcome") == "absent") & (F.col("nth") == limit), F.col("day"))).over(w)
    found = F.min(F.when(F.col("outcome") == "found", F.col("day"))).over(w)
    df = df.withColumns({"stop_day": stop, "found_day": found})
    cut = F.col("stop_day").isNotNull() & (F.col("found_day").isNull() | (F.col("found_day") > F.col("stop_day")))
    return df.where(~cut | (F.col("day") <= F.col("stop_day"))).drop("nth", "stop_day", "found_day")


@query
def w8_absence_cutoff(spark, sf):
    return walked_days(bridge.date_walk(spark, sf)).groupBy(*U, "walk_block").agg(
        F.count("*").alias("days"), F.count(F.when(F.col("outcome") == "found", 1)).alias("found"),
        F.max("day").cast("string").alias("last_day"))


@query
def w9_first_productive_block(spark, sf):
    found = walked_days(bridge.date_walk(spark, sf)).where("outcome = 'found'") \
        .groupBy(*U, "walk_block").agg(F.count("*").alias("days"), F.max("fares").alias("most_fares"))
    return ladder.first_rows(found, U, [F.col("walk_block")])


SOURCE_PRIORITY = {"direct": 1, "market": 2, "search": 3}


@query
def w10_best_source(spark, sf):
    df = dated_ladders(spark, sf).withColumn(
        "priority", F.element_at(names.literal_map(SOURCE_PRIORITY.items()), F.col("source")))
    best = ladder.first_rows(df, U + ["group_cabin"], [
        F.col("n_brands").desc(), F.col("bad_steps"), ladder.round_half_up(F.col("worst_step"), 2),
        F.col("priority"), F.col("flight_id")])
    return best.select(*U, "group_cabin", "source", "n_brands", "bad_steps", "worst_step")


@query
def w16_unique_display_names(spark, sf):
    c = F.col
    df = bridge.cards(spark, sf)
    name, _ = names.family_override(c("carrier"), c("fare_family_code"), c("raw_brand_name"))
    df = names.with_pretty_name(df.withColumn("family", F.coalesce(name, c("raw_brand_name"))), "family")
    df = ladder.unique_names(df, bridge.FLIGHT)
    return df.groupBy("carrier", "pretty_name", "shown_name").agg(F.count("*").alias("n"))


@query
def w19_tier_transitions(spark, sf):
    t = ladder.transitions(route_ladders(spark, sf), L)
    return t.select(*L, "brand_order", "to_order", F.col("fee").cast("double").alias("fee"))


@query
def w22_cheapest_family(spark, sf):
    df = ladder.number_ladder(bridge.cards(spark, sf), bridge.FLIGHT,
                              ladder.by_price("price_value", "screen_order", "raw_brand_name"), "screen_no")
    return df.groupBy("carrier", "raw_brand_name", "screen_no").agg(
        F.count("*").alias("n"), F.sum("price_value").cast("double").alias("total"),
        F.sum("n_seen").alias("seen"))


@query
def a1_ladder_quality(spark, sf):
    q = ladder.ladder_quality(bridge.ladders(spark, sf), L, "price")
    return q.select(*L, "n_brands", "bad_steps", "worst_step")


@query
def a2_ladder_content(spark, sf):
    """Families of a ladder, and how much they say: rights and the parts of their descriptions."""
    key = L[:-1] + ["group_cabin"]
    said = bridge.descriptions(spark, sf).groupBy(*key).agg(F.sum(ladder.description_parts(F.col("description"))).alias("parts"))
    cards = bridge.cards(spark, sf).groupBy(*key).agg(
        F.count("*").alias("n_brands"), F.sum("n_rights").alias("right_lines"))
    return cards.join(said, key).select(*key, "n_brands", (F.col("right_lines") + F.col("parts")).alias("content"))


@query
def a3_record_strength(spark, sf):
    return gold.chosen_results(spark, sf).groupBy(*U, "pass_no").agg(
        F.count("*").alias("packages"), F.sum("n_rights").alias("right_lines"))


@query
def u2_ranked_rows(spark, sf):
    """Ranked rows of each cabin result, before one ladder per cabin is chosen."""
    df = ladder.rank_results(gold.unit_brands(spark, sf), U)
    return df.groupBy("carrier", "group_cabin", "cabin", "brand_order").agg(
        F.count("*").alias("n"), F.sum("abs_price").cast("double").alias("total"))


@query
def j10_season_pair_preferences(spark, sf):
    ev = gold.order_evidence(spark, sf, gold.unit_brands(spark, sf))
    return consensus.pair_preferences(ev).select(
        *consensus.ROUTE, "first_key", "second_key", F.col("gap").cast("double").alias("gap"))


@query
def j11_consensus_ladder(spark, sf):
    return gold.published_with_consensus(spark, sf).select(
        *U, "cabin", "shown_name", "brand_order", "tier_code",
        F.col("abs_price").cast("double").alias("abs_price"))


@query
def p7_regroup_by_cabin(spark, sf):
    df = ladder.regroup(bridge.cards(spark, sf))
    return df.groupBy("carrier", "group_cabin", "cabin", "raw_brand_name").agg(F.count("*").alias("n"))


@query
def p8_drop_bare_codes(spark, sf):
    df = names.with_pretty_name(bridge.cards(spark, sf)).where(~names.is_bare_code(F.col("pretty_name")))
    return df.groupBy("pretty_name").agg(F.count("*").alias("n"))


@query
def j3_family_override(spark, sf):
    c = F.col
    name, cabin = names.family_override(c("carrier"), c("fare_family_code"), c("raw_brand_name"))
    df = bridge.lines(spark, sf).withColumn("tabled_name", name).withColumn("tabled_cabin", cabin)
    return df.where("tabled_name is not null").groupBy(
        "carrier", "fare_family_code", "tabled_name", "tabled_cabin").agg(F.count("*").alias("n"))


@query
def j4_spelling_lookup(spark, sf):
    dim = names.spelling_dim(spark)
    df = bridge.lines(spark, sf).withColumn("k", names.match_key(F.col("raw_brand_name")))
    hit = df.join(F.broadcast(dim), (F.col("carrier") == dim.sp_carrier) & (F.col("k") == dim.sp_key))
    return hit.groupBy("carrier", "k", "spelling").agg(F.count("*").alias("n"))
