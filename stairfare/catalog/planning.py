"""Job lists, work plans, identity filters and enrichment."""

from pyspark.sql import functions as F

from ..functions import cards as cardfn, dates, names, rights as rightfn
from ..operators import geography, identity, ladder
from ..plans import gold
from ..rules import places, rights as R
from ..sources import bridge, jobs
from ..sources.tables import scratch, table
from .registry import query
from .texts import card_texts, tally

U = bridge.UNIT
OPPORTUNISTIC = ["PC", "VF"]


def route_text(o="origin", d="destination"):
    sep = bridge.pick(["-", "/", "_", ">"], F.col("pos") % 4)
    text = F.concat(F.col(o), sep, F.col(d))
    return F.when(F.col("pos") % 10 == 9, F.concat(F.col(o), F.lit("-"))) \
        .when(F.col("pos") % 3 == 0, F.lower(text)).otherwise(text)


def listed_jobs(spark, sf):
    df = bridge.job_rows(spark, sf).select(
        F.when(F.col("pos") % 9 == 0, "").otherwise(F.col("carrier")).alias("CARRIER"),
        route_text().alias("OND"), F.col("c_mktsegment").alias("SEGMENT"), "pos")
    return df


@query
def s1_job_list_csv(spark, sf):
    """Job list written as CSV and read back through the header roles."""
    path = scratch(spark, "jobs")
    df = bridge.job_rows(spark, sf).select(
        F.col("carrier").alias("Airline"), F.col("origin").alias("From"), F.col("destination").alias("To"),
        F.col("c_mktsegment").alias("SEGMENT"), F.col("pos").alias("row"))
    df.write.option("header", True).csv(path)
    out = jobs.read_jobs(spark, path, pos="row")
    return out.select("carrier", "origin", "destination", "pos",
                      F.col("raw_row")["SEGMENT"].alias("segment"))


@query
def p1_split_routes(spark, sf):
    df = bridge.job_rows(spark, sf).withColumn("ond", route_text())
    o, d = jobs.split_route(F.col("ond"))
    return tally(df.withColumn("o", o).withColumn("d", d), "ond", "o", "d")


@query
def p2_usable_rows(spark, sf):
    out = jobs.to_jobs(listed_jobs(spark, sf), "pos")
    return out.groupBy("carrier", "origin", "destination").agg(
        F.count("*").alias("n"), F.min("pos").alias("first_pos"),
        F.max(F.col("raw_row")["SEGMENT"]).alias("segment"), F.max(F.size("raw_row")).alias("passed"))


@query
def w17_first_request(spark, sf):
    return jobs.first_request(jobs.to_jobs(listed_jobs(spark, sf), "pos")).select(
        "carrier", "origin", "destination", "pos")


@query
def p13_valid_rows(spark, sf):
    ok, bad = jobs.valid_and_invalid(listed_jobs(spark, sf), "CARRIER", "OND")
    both = ok.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False)))
    return tally(both, "valid", "SEGMENT")


@query
def p14_rows_from_position(spark, sf):
    return tally(bridge.job_rows(spark, sf).where(F.col("pos") >= 150), "carrier")


def planned_units(spark, sf):
    first = jobs.first_request(bridge.job_rows(spark, sf).select("pos", "carrier", "origin", "destination"))
    return dates.with_seasons(first)


def completed_units(spark, sf):
    return bridge.date_walk(spark, sf).where("outcome = 'found' and walk_block = 3").select(*U).distinct()


@query
def j12_pending_units(spark, sf):
    return planned_units(spark, sf).join(completed_units(spark, sf), U, "left_anti").select(*U, "pos")


@query
def j13_reload_completed(spark, sf):
    rec = gold.chosen_results(spark, sf).groupBy(*U, "pass_no").agg(F.count("*").alias("packages"))
    return ladder.first_rows(rec.join(completed_units(spark, sf), U, "left_semi"), U, ["pass_no"])


@query
def j14_opportunistic_units(spark, sf):
    """Listed carriers times routes is an explode of the short list, not a cross join."""
    df = bridge.job_rows(spark, sf)
    extra = df.select("origin", "destination").distinct().withColumn(
        "carrier", F.explode(F.array(*[F.lit(c) for c in OPPORTUNISTIC])))
    listed = df.select("carrier", "origin", "destination").distinct()
    return dates.with_seasons(extra.join(listed, ["carrier", "origin", "destination"], "left_anti")) \
        .select(*U)


TODAY = "2026-01-15"


@query
def j28_units_with_dates(spark, sf):
    units = planned_units(spark, sf)
    plan = dates.date_plan(units.select("origin", "destination", "season").distinct(),
                           F.lit(TODAY).cast("date"), seed=7)
    return units.join(plan, ["origin", "destination", "season"]).groupBy(*U).agg(
        F.count("*").alias("days"), F.max("block_no").alias("blocks"),
        F.min("departure").cast("string").alias("first_day"), F.max("return_date").cast("string").alias("last_day"))


@query
def j25_lead_time_bands(spark, sf):
    """Departures in each lead-time band; the bands are a literal list, so nothing is joined."""
    bands = [places.FAR_BAND] + [(c - s, c + s) for c, s in places.FALLBACK_BANDS]
    arr = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in bands])
    lead = F.date_diff(F.col("departure"), F.lit(TODAY).cast("date"))
    df = bridge.lines(spark, sf).withColumn("band", F.explode(F.filter(arr, lambda x: lead.between(x.lo, x.hi))))
    return df.groupBy("carrier", "band.lo", "band.hi").agg(F.count("*").alias("n"))


@query
def j26_batch_overlap(spark, sf):
    df = bridge.job_rows(spark, sf)
    key = ["carrier", "origin", "destination"]
    a, b = df.where("pos % 7 < 4"), df.where("pos % 7 >= 4")
    both = a.select(*key).distinct().join(b.select(*key).distinct(), key, "left_semi")
    return both.agg(F.count("*").alias("overlap"))


@query
def o3_seeded_order(spark, sf):
    key = F.md5(F.concat_ws("|", *U, F.lit("seed-7")))
    return planned_units(spark, sf).select(*U, key.alias("shuffle_key")).orderBy("shuffle_key")


@query
def x1_union_passes(spark, sf):
    rec = gold.chosen_results(spark, sf).groupBy(*U, "pass_no").agg(F.count("*").alias("packages"))
    manual = completed_units(spark, sf).select(*U, F.lit(99).alias("pass_no"), F.lit(0).cast("bigint").alias("packages"))
    return tally(rec.unionByName(manual), "pass_no", "season")


@query
def x2_union_lists(spark, sf):
    """Two lists under different headers, one row per request, repeats counted per list."""
    df = bridge.job_rows(spark, sf)
    a = df.where("pos % 2 = 0").select(F.col("carrier").alias("CARRIER"), F.concat_ws("-", "origin", "destination").alias("OND"), "pos")
    b = df.where("pos % 2 = 1").select(F.col("carrier").alias("Airline"), F.col("origin").alias("From"),
                                       F.col("destination").alias("To"), "pos")
    both = jobs.to_jobs(a, "pos").withColumn("list", F.lit("a")).unionByName(
        jobs.to_jobs(b, "pos").withColumn("list", F.lit("b")))
    order = F.when(F.col("list") == "a", 0).otherwise(1)
    per = both.groupBy("carrier", "origin", "destination", "list").agg(
        F.count("*").alias("rows"), F.min("pos").alias("pos"))
    kept = ladder.first_rows(per, ["carrier", "origin", "destination"], [order, F.col("pos")]) \
        .select("carrier", "origin", "destination", F.col("list").alias("kept_list"))
    return per.join(kept, ["carrier", "origin", "destination"]).groupBy("list").agg(
        F.sum(F.col("rows")).alias("rows"),
        F.sum(F.when(F.col("list") == F.col("kept_list"), F.col("rows") - 1).otherwise(F.col("rows"))).alias("repeats"))


@query
def x3_except_completed(spark, sf):
    return planned_units(spark, sf).select(*U).exceptAll(completed_units(spark, sf))


@query
def x4_common_families(spark, sf):
    """Families both seasons sell on a route."""
    df = bridge.ladders(spark, sf).withColumn("k", names.match_key(F.col("raw_brand_name")))
    route = ["carrier", "origin", "destination", "cabin", "k"]
    both = df.where("season = 'Summer'").select(*route).intersect(df.where("season = 'Winter'").select(*route))
    return both.groupBy("carrier", "cabin").agg(F.count("*").alias("common"))


@query
def p3_carrier_attribution(spark, sf):
    it = bridge.itineraries(spark, sf)
    c = F.col
    ok = identity.belongs_to(c("row_carrier"), c("fare_iata"), c("operating"), c("carrier"))
    return tally(it.where(ok), "carrier", "row_carrier", "fare_iata", "operating")


@query
def p4_markets_all_segments(spark, sf):
    """Itineraries the carrier markets throughout; first-segment matches where a search has none.

    The search-wide test is an aggregate joined back, so a busy search is not one window.
    """
    c = F.col
    it = bridge.itineraries(spark, sf).withColumns({
        "all_seg": identity.markets_every_segment(c("segments"), c("carrier")),
        "first_seg": identity.markets_first_segment(c("segments"), c("carrier"))})
    search = ["carrier", "origin", "destination", "block_no", "date_pos"]
    any_all = it.groupBy(*search).agg(F.max("all_seg").alias("any_all"))
    kept = it.join(any_all, search).where(c("all_seg") | (c("first_seg") & ~c("any_all")))
    return kept.groupBy(*search).agg(F.count("*").alias("kept"), F.count(F.when(c("all_seg"), 1)).alias("fully"))


@query
def p5_codeshare_interline(spark, sf):
    share, inter = identity.codeshare_and_interline(F.col("segments"), F.col("virtual_interline"))
    it = bridge.itineraries(spark, sf).withColumn("is_codeshare", share).withColumn("is_interline", inter)
    return tally(it, "carrier", "is_codeshare", "is_interline")


@query
def p6_contradicting_boxes(spark, sf):
    c = F.col
    requested = F.when(c("ln") % 2 == 0, "Business").otherwise("Economy")
    df = bridge.cards(spark, sf).withColumn("requested", requested).withColumn(
        "dropped", identity.contradicts_itself(c("raw_brand_name"), c("group_cabin"), c("requested")))
    return tally(df, "raw_brand_name", "group_cabin", "requested", "dropped")


@query
def p9_carrier_type(spark, sf):
    return tally(bridge.lines(spark, sf).withColumn("carrier_type", geography.carrier_type()),
                 "carrier", "carrier_type")


@query
def p10_route_type(spark, sf):
    df = geography.with_places(bridge.lines(spark, sf)).withColumn("route_type", geography.route_type())
    return tally(df, "origin", "destination", "route_type")


@query
def p18_season_of_day(spark, sf):
    o = table(spark, sf, "orders")
    return tally(o.select(F.month("o_orderdate").alias("month"), bridge.season_of(F.col("o_orderdate")).alias("season")),
                 "month", "season")


@query
def p19_excluded_cards(spark, sf):
    df = card_texts(spark, sf).withColumn("excluded", cardfn.is_excluded_card(F.col("card")))
    lines = cardfn.card_lines(F.col("card"))
    return tally(df.withColumn("unnamed", cardfn.card_name(lines).isNull()), "group_cabin", "excluded", "unnamed")


@query
def p20_exclusive_rows(spark, sf):
    c = F.col
    it = bridge.itineraries(spark, sf)
    keep = ~c("exclusive") & identity.operator_matches(c("operating"), c("carrier"))
    return tally(it.where(keep), "carrier", "operating")


@query
def j1_airport_enrichment(spark, sf):
    df = geography.with_places(bridge.lines(spark, sf))
    cols = ["origin", "destination"] + [f"{e}_{w}" for e in ("origin", "dest")
                                        for w in ("city_code", "country_code", "country", "region")]
    return tally(df, *cols)


@query
def j2_airline_name(spark, sf):
    return tally(geography.with_airline(bridge.lines(spark, sf)), "carrier", "airline_name")


@query
def j19_feed_keys(spark, sf):
    key = F.element_at(names.literal_map(R.FEED_KEYS.items()), F.col("right_key"))
    return tally(bridge.rights(spark, sf).withColumn("feed_key", key), "right_key", "feed_key")


@query
def j20_airline_code(spark, sf):
    code = identity.resolve_airline(F.col("operating"))
    return tally(bridge.itineraries(spark, sf), "operating").withColumn("code", code)


@query
def j21_operator_matches(spark, sf):
    ok = identity.operator_matches(F.col("operating"), F.col("carrier"))
    return tally(bridge.itineraries(spark, sf).withColumn("matches", ok), "carrier", "operating", "matches")


@query
def j22_right_of_text(spark, sf):
    """Right mentioned in each chat message: the longest synonym anywhere in the whole text."""
    df = table(spark, sf, "conversations").select("role", rightfn.right_of_label(F.col("text")).alias("right_key"))
    lines = bridge.rule_lines(spark, sf).select(F.lit("panel").alias("role"), rightfn.right_of_label(F.col("line")).alias("right_key"))
    return tally(df.unionByName(lines), "role", "right_key")


@query
def j15_attach_by_price(spark, sf):
    """Names and miles from a second reading, joined by rounded price (the last reading wins).

    A package without a price is never looked up, but stays.
    """
    df = bridge.cards(spark, sf).withColumn("whole", F.bround(F.col("price_value"), 0).cast("bigint"))
    seen = df.where("price_value is not null and (n_seen > 1 or ln > 2)").groupBy(*bridge.FLIGHT, "whole").agg(
        F.max(F.struct("screen_order", "raw_brand_name", "miles_earned")).alias("b"))
    out = df.join(seen, bridge.FLIGHT + ["whole"], "left")
    earned = F.coalesce(F.col("b.miles_earned"), F.col("miles_earned"))
    flag = F.when(F.col("mileage_available").isNull() & F.col("b.miles_earned").isNotNull(), True) \
        .otherwise(F.col("mileage_available"))
    return out.groupBy("carrier", F.coalesce("b.raw_brand_name", "raw_brand_name").alias("name"), flag.alias("miles_flag")) \
        .agg(F.count("*").alias("n"), F.count("b").alias("attached"), F.sum(earned).alias("miles"))


@query
def a20_route_census(spark, sf):
    """Segments seen and itineraries with packages per marketing carrier."""
    it = bridge.itineraries(spark, sf)
    seen = it.select(F.explode("segments.marketing_airline").alias("code")).groupBy("code") \
        .agg(F.count("*").alias("in_segments"))
    first = it.withColumn("code", F.get("segments", F.lit(0)).marketing_airline)
    sold = bridge.cards(spark, sf).select("flight_id").distinct()
    packs = first.join(sold, "flight_id", "left_semi").groupBy("code").agg(F.count("*").alias("with_packages"))
    return seen.join(packs, "code", "left").withColumn("with_packages", F.coalesce("with_packages", F.lit(0)))


@query
def o5_most_common(spark, sf):
    return a20_route_census(spark, sf).orderBy(F.col("in_segments").desc(), "code")


@query
def u1_adapter_registry(spark, sf):
    """Each source's adapter normalises its own rows; priorities come from the registry."""
    from ..sources.adapters import normalized
    df = normalized(bridge.lines(spark, sf))
    return df.groupBy("source", "priority", "currency", "served").agg(
        F.count("*").alias("n"), F.sum("price_value").cast("double").alias("total"))
