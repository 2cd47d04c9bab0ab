"""Choosing itineraries, merging sources and dates."""

from pyspark.sql import Window, functions as F

from ..functions import names
from ..operators import ladder, matching, selection
from ..plans import gold
from ..rules.rights import RIGHT_KEYS
from ..sources import bridge
from .registry import query

U = bridge.UNIT
SEARCH = U + ["block_no", "date_pos", "group_cabin"]
FL = bridge.FLIGHT
SIDED = U + ["departure", "group_cabin"]
CARRY = [c for c in SEARCH if c not in FL]


def search_scores(spark, sf, with_cabin=False):
    buckets = selection.in_search(bridge.cards(spark, sf))
    if with_cabin:
        w = Window.partitionBy(*FL)
        df = ladder.step_ratio(buckets, FL)
        worst = F.greatest(F.coalesce(F.max("step_ratio").over(w), F.lit(1.0)), F.lit(1.0))
        scored = df.withColumns({
            "fares": F.count("*").over(w), "cabins": F.size(F.collect_set("cabin").over(w)),
            "base_price": F.min("price_value").over(w),
            "has_searched": F.max((F.col("cabin") == F.col("group_cabin")).cast("int")).over(w),
            "bad_steps": F.count(F.when(F.col("step_ratio") > 3.0, 1)).over(w),
            "worst_step": ladder.round_half_up(worst, 3)})
        out = scored.select(*SEARCH, "flight_id", "cabin", "fares", "cabins", "base_price", "has_searched",
                            "bad_steps", "worst_step").distinct()
    else:
        out = selection.flight_scores(buckets, FL, CARRY)
    return out.withColumn("direct", F.col("flight_id") % 3 == 0)


@query
def w11_best_flight_marketplace(spark, sf):
    cover = selection.right_coverage(bridge.rights(spark, sf), FL, RIGHT_KEYS)
    best = ladder.first_rows(search_scores(spark, sf).join(cover, FL), SEARCH, selection.broadest_first())
    return best.select(*SEARCH, "flight_id", "cabins", "fares", "n_rights_known", "bad_steps", "worst_step", "items")


@query
def w12_best_flight_direct_first(spark, sf):
    best = ladder.first_rows(search_scores(spark, sf), SEARCH, selection.direct_first())
    return best.select(*SEARCH, "flight_id", "direct", "cabins", "fares", "bad_steps", "worst_step")


@query
def w13_side_pick(spark, sf):
    picks = selection.side_picks(search_scores(spark, sf, with_cabin=True), SEARCH)
    return picks.select(*SEARCH, "cabin", "flight_id", "is_side_pick")


@query
def w14_dedicated_beats_leak(spark, sf):
    picks = selection.side_picks(search_scores(spark, sf, with_cabin=True), SEARCH)
    unit = [c for c in SEARCH if c != "group_cabin"]
    return selection.dedicated_over_leak(picks, unit).select(*unit, "cabin", "group_cabin", "flight_id")


@query
def w18_audit_sample(spark, sf):
    """First collected unit of each carrier, split by the search that covers its cabins."""
    res = gold.chosen_results(spark, sf)
    first = ladder.first_group(res, ["carrier"], [F.col("flight_id"), F.col("season"), F.col("pass_no")])
    search = F.when(F.col("group_cabin") == "Business", "Business").otherwise("Economy")
    return first.groupBy("carrier", "origin", "destination", "season", search.alias("search")).agg(
        F.min("departure").cast("string").alias("dep"), F.count("*").alias("stored"))


@query
def w20_split_routes(spark, sf):
    return selection.split_in_halves(bridge.job_rows(spark, sf))


@query
def w21_rank_dates(spark, sf):
    per_flight = bridge.cards(spark, sf).groupBy("flight_id", "season").agg(F.min("price_value").alias("p"))
    df = bridge.with_itinerary(per_flight).groupBy("origin", "destination", "season", "departure").agg(
        F.max(F.col("flight_id") % 3 == 0).alias("has_direct"), F.count("*").alias("flights"),
        F.min("p").alias("cheapest"))
    ranked = ladder.number_ladder(df, ["origin", "destination", "season"], [
        F.col("has_direct").desc(), F.col("flights").desc(), F.col("cheapest"), F.col("departure")], "place")
    return ranked.select("origin", "destination", "season", F.col("departure").cast("string").alias("departure"),
                         "has_direct", "flights", F.col("cheapest").cast("double").alias("cheapest"), "place")


@query
def w23_keep_better_retry(spark, sf):
    rec = gold.chosen_results(spark, sf).groupBy(*U, "pass_no").agg(F.count("*").alias("brands"))
    return ladder.first_rows(rec, U, [F.col("brands").desc(), F.col("pass_no").desc()])


@query
def u5_custom_ranking(spark, sf):
    """The caller names the ranking columns; here the cheapest base decides first."""
    keys = [F.col("base_price").asc_nulls_last(), F.col("fares").desc(), F.col("flight_id")]
    return ladder.first_rows(search_scores(spark, sf), SEARCH, keys).select(
        *SEARCH, "flight_id", "fares", F.col("base_price").cast("double").alias("base_price"))


def sides(spark, sf):
    df = bridge.sided_cards(spark, sf)
    return df.where("side = 'primary'"), df.where("side = 'secondary'")


def side_lists(spark, sf):
    """Both sources' ladders of a unit, date and cabin side by side, from one pass over the cards."""
    df = bridge.sided_cards(spark, sf).withColumn("k", names.match_key(F.col("raw_brand_name")))
    item = F.struct("screen_order", F.col("raw_brand_name").alias("name"), "k", F.col("price_value").alias("price"))
    of = lambda side: F.sort_array(F.collect_list(F.when(F.col("side") == side, item)))
    return df.groupBy(*SIDED).agg(of("primary").alias("mine"), of("secondary").alias("theirs")).where("size(mine) > 0 and size(theirs) > 0")


def aligned_sides(spark, sf):
    return matching.aligned_names(side_lists(spark, sf), SIDED)


@query
def j5_match_brands(spark, sf):
    pairs = aligned_sides(spark, sf)
    return pairs.groupBy("carrier", F.col("raw_brand_name").alias("own"), F.col("other_name").alias("other")).agg(F.count("*").alias("n"))


def sided_rights(spark, sf):
    df = bridge.settled_rights(spark, sf, together=SIDED).withColumn("side", F.when(F.col("ln") % 2 == 1, "primary").otherwise("secondary"))
    return matching.merged_rights(df, ["at", *SIDED, "side", "raw_brand_name"]).drop("at")


def both_sides(df):
    return [df.where(F.col("side") == side).drop("side") for side in ("primary", "secondary")]


@query
def j6_fill_rights(spark, sf):
    """Rights and miles of the primary source's families, holes filled from the family the match pairs with each."""
    key = SIDED + ["raw_brand_name"]
    aligned = aligned_sides(spark, sf)
    own, other = both_sides(sided_rights(spark, sf))
    rights = matching.fill_rights(own, matching.under_own_name(other, aligned, SIDED), key)
    mine, theirs = both_sides(bridge.sided_miles(spark, sf))
    miles = matching.fill_miles(mine, matching.under_own_name(theirs, aligned, SIDED), key)
    said = F.when(F.col("mileage_available"), "Included").when(~F.col("mileage_available"), "Not Included").otherwise("Unknown")
    number = F.coalesce(F.col("miles_earned"), F.col("bonus_percent")).cast("int").cast("string")
    miles = miles.select("carrier", F.lit("miles").alias("right_key"), said.alias("status"), "filled", number.alias("raw_value"))
    return rights.select(*miles.columns).unionByName(miles).groupBy("carrier", "right_key", "status", "filled") \
        .agg(F.count("*").alias("n"), F.max("raw_value").alias("last_value"))


def named_families(families):
    """Families of a ladder that are held as numbers, in screen order under their names."""
    known = F.array(*[F.struct(F.lit(b).cast("string").alias("name"), names.match_key(F.lit(b).cast("string")).alias("k")) for b in [*bridge.BRANDS, None]])
    named = lambda f: F.get(known, f.brand_no.cast("int"))
    return F.sort_array(F.transform(families, lambda f: matching.family_item(named(f).getField("name"), f.screen_order, f.price_value, named(f).k, said=f.said)))


@query
def j7_fill_rights_across_flights(spark, sf):
    """Rights the winning itinerary lacks, from the next best itinerary that sells the family under any spelling.

    Each other itinerary's ladder is matched with the winner's once; one minimum per family and right then
    replaces a walk over the itineraries of a search.  Cards and rights come from one cut of the lines, dealt by
    search; a family carries its rights as bits, so nothing is joined and no search is shuffled.
    """
    one = ["at", "flight_id", "is_summer", "cabin_no"]
    cards = bridge.packed_cards(spark, sf, matching.packed_right, SEARCH)
    lists = ladder.step_ratio(cards, one).groupBy(*one).agg(
        F.collect_list(F.struct("screen_order", "brand_no", "price_value", "said")).alias("theirs"), F.count("*").alias("n_brands"), *ladder.quality_columns())
    w = Window.partitionBy("at", "is_summer", "cabin_no", *[c for c in SEARCH if c not in FL]).orderBy(*gold.best_first())
    lists = bridge.with_itinerary(lists, season=False).withColumns({
        "place": F.row_number().over(w), "winner": F.first("flight_id").over(w), "mine": F.first("theirs").over(w)})
    lists = bridge.named_season(lists).withColumns({c: named_families(c) for c in ("mine", "theirs")})
    search = ["at", "winner", "season", "group_cabin"]
    rights = matching.aligned_names(lists, [*search, "place"], carried=["said"]).where("other_name IS NOT NULL AND coalesce(group_cabin, '') <> ''")
    best = matching.first_known(rights, [*search, "raw_brand_name"])
    return bridge.with_itinerary(best, "winner", season=False).groupBy(
        "carrier", "right_key", "status", (F.col("place") > 1).alias("borrowed")).agg(F.count("*").alias("n"))


@query
def j8_top_up(spark, sf):
    p, s = sides(spark, sf)
    out = matching.top_up(p, s, SIDED)
    return out.groupBy("carrier", "group_cabin", "raw_brand_name", "added", "screen_no").agg(
        F.count("*").alias("n"), F.sum("price_value").cast("double").alias("total"))


def cross_date(spark, sf):
    """Per unit and cabin: the best date's families, the other dates' in order, and the fill."""
    keys = U + ["group_cabin"]
    df = bridge.sided_cards(spark, sf).groupBy(*keys, "departure", "raw_brand_name").agg(
        F.min(F.struct("price_value", "screen_order")).alias("b")).select(
        *keys, "departure", "raw_brand_name", "b.*")
    lists = matching.family_lists(df, keys + ["departure"]).withColumn("n", F.size("families"))
    w = Window.partitionBy(*keys).orderBy(F.col("n").desc(), F.col("departure"))
    lists = lists.withColumn("place", F.row_number().over(w))
    per = lists.groupBy(*keys).agg(
        F.max(F.when(F.col("place") == 1, F.col("families"))).alias("mine"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("place") > 1, F.struct("departure", "families")))),
                    lambda d: d.families).alias("dates"))
    return per.withColumn("merged", matching.fill_across_dates(F.col("mine"), F.col("dates")))


@query
def j9_fill_across_dates(spark, sf):
    keys = U + ["group_cabin"]
    df = cross_date(spark, sf).select(*keys, F.size("mine").alias("before"), F.explode("merged").alias("f"))
    return df.groupBy(*keys, "before").agg(
        F.count("*").alias("after"), F.sum("f.price").cast("double").alias("price_total"))


@query
def a4_strongest_status(spark, sf):
    r = matching.merged_rights(bridge.settled_rights(spark, sf), FL + ["raw_brand_name"])
    return r.groupBy("right_key", "status").agg(F.count("*").alias("n"), F.max("raw_value").alias("last_value"))


@query
def a5_strongest_known_status(spark, sf):
    rights = bridge.settled_rights(spark, sf, later_wins=False)
    r = matching.merged_rights(rights, FL + ["raw_brand_name"], later_wins=False, drop_unknown=True)
    return r.groupBy("right_key", "status").agg(F.count("*").alias("n"), F.min("raw_value").alias("first_value"))


@query
def u4_ladder_folds(spark, sf):
    """How far the date fold gets: families added and steps over 3x before and after."""
    df = cross_date(spark, sf)
    return df.groupBy("carrier", "group_cabin").agg(
        F.count("*").alias("ladders"), F.sum(F.size("merged") - F.size("mine")).alias("added"),
        F.sum(matching.bad_steps(F.col("mine"))).alias("bad_before"),
        F.sum(matching.bad_steps(F.col("merged"))).alias("bad_after"))


@query
def a34_families_per_date(spark, sf):
    df = bridge.lines(spark, sf).withColumn("k", names.match_key(F.col("raw_brand_name")))
    df = df.groupBy(*U, "group_cabin", "departure", "k").agg(F.count("*").alias("_n"))
    per_date = df.groupBy(*U, "group_cabin", "departure").agg(F.count("*").alias("families"))
    total = df.groupBy(*U, "group_cabin").agg(F.countDistinct("k").alias("all_families"))
    return per_date.join(total, U + ["group_cabin"]).select(
        *U, "group_cabin", F.col("departure").cast("string").alias("departure"), "families", "all_families")
