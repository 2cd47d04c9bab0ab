"""Sources and sinks: every query writes a file form of the data and reads it back."""

from pyspark.sql import functions as F

from ..functions import generators, names, rights as rightfn
from ..operators import geography, identity, matching
from ..plans import export, feed, gold
from ..rules import rights as R
from ..sources import bridge, payloads, records
from ..sources.tables import scratch
from .choosing import SIDED
from .quality import counted, judged, run_summary, verdicts
from .registry import query
from .texts import tally

U = bridge.UNIT
FL = bridge.FLIGHT


def record_rows(spark, sf):
    orders = gold.chosen_orders(spark, sf)
    rights = matching.merged_rights(bridge.settled_rights(spark, sf, orders=orders), FL + ["raw_brand_name"])
    return records.nest(gold.chosen_results(spark, sf, orders), rights)


def record_files(spark, sf, by_pass=False):
    path = scratch(spark, "records")
    df = record_rows(spark, sf)
    if by_pass:
        df.write.partitionBy("pass_no").json(path)
    else:
        df.drop("pass_no").write.json(path)
    return path


def staged_pass(spark, base, *passes):
    """Records of some passes; the pass is the folder, so only their files are read."""
    df = spark.read.schema(records.RECORD + ", pass_no int").json(base)
    return df.where(F.col("pass_no").isin(*passes)).drop("pass_no")


@query
def s2_read_records(spark, sf):
    df = records.strength(records.read_records(spark, record_files(spark, sf)))
    return df.groupBy(*U).agg(F.count("*").alias("records"), F.sum("packages").alias("packages"),
                              F.sum("right_lines").alias("right_lines"))


@query
def s3_tolerant_read(spark, sf):
    """A file with half-written lines and blank lines; only whole records count."""
    path = scratch(spark, "broken")
    df = record_rows(spark, sf)
    text = F.to_json(F.struct(*[c for c in df.columns if c != "pass_no"]))
    cut = F.when(F.col("pass_no") == 1, F.substr(text, F.lit(1), (F.length(text) / 2).cast("int"))).otherwise(text)
    df.select(F.concat(cut, F.when(F.col("pass_no") == 2, F.lit("\n")).otherwise("")).alias("value")).write.text(path)
    good, broken = records.read_tolerant(spark, path)
    return good.groupBy("carrier").agg(F.count("*").alias("n")).unionByName(
        broken.agg(F.lit("(broken)").alias("carrier"), F.count("_broken").alias("n")))


@query
def s4_flatten_records(spark, sf):
    df = records.flatten(records.read_records(spark, record_files(spark, sf)))
    return df.groupBy("carrier", "group_cabin", "raw_brand_name", "price_type", "cabin_source").agg(
        F.count("*").alias("n"), F.sum("price_value").cast("double").alias("total"),
        F.sum(F.coalesce(F.size("amenities"), F.lit(0))).alias("rights"),
        F.count("miles.mileage_available").alias("with_miles"), F.max(F.col("departure").cast("string")).alias("last_day"))


@query
def s5_nest_records(spark, sf):
    df = records.strength(record_rows(spark, sf))
    return df.select("unit_key", "pass_no", F.size("cabins").alias("cabins"), "packages", "right_lines",
                     F.array_join(F.transform("cabins", lambda c: c.cabin), ",").alias("cabin_list"))


@query
def s6_append_units(spark, sf):
    """Finished units appended pass by pass to one place."""
    path = scratch(spark, "append")
    staged = record_files(spark, sf, by_pass=True)
    for p in (0, 1, 2):
        staged_pass(spark, staged, p).write.mode("append").json(path)
    return tally(records.read_records(spark, path), "carrier", "season")


@query
def s7_overlay_rewrite(spark, sf):
    base = record_files(spark, sf, by_pass=True)
    disk = staged_pass(spark, base, 0)
    new = staged_pass(spark, base, 1, 2).withColumn("note", F.lit("new"))
    out = scratch(spark, "overlay")
    records.overlay(disk.withColumn("note", F.lit("disk")), new).write.json(out)
    return tally(spark.read.schema(records.RECORD + ", note string").json(out), "carrier", "note")


@query
def s12_concatenate_passes(spark, sf):
    """Passes written to folders of their own, read as one table; the folder says which pass a record is from."""
    df = records.read_passes(spark, record_files(spark, sf, by_pass=True))
    return tally(df, "carrier", "pass_order")


def published_fares(spark, sf, orders=None):
    brands = gold.unit_brands(spark, sf, orders).withColumn("card_name", F.col("raw_brand_name"))
    from ..operators import ladder
    return geography.with_places(ladder.publish(brands, U))


def card_rights(spark, sf, later_wins=True, orders=None):
    df = matching.merged_rights(bridge.settled_rights(spark, sf, later_wins, orders=orders), FL + ["raw_brand_name"], later_wins)
    return df.withColumnRenamed("raw_brand_name", "card_name")


def flat_fares(spark, sf, stamp="2026-01-15T00:00:00"):
    """The 43 published columns, all as text."""
    c = F.col
    key, orders = FL + ["card_name"], gold.chosen_orders(spark, sf)
    df = published_fares(spark, sf, orders).join(export.right_columns(card_rights(spark, sf, orders=orders), key), key)
    price = F.coalesce("abs_price", F.when(c("price_type") == "absolute", c("price_value")))
    s = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    cols = {
        "Carrier": c("carrier"), "Origin": c("origin"), "Destination": c("destination"),
        "Origin City Code": c("origin_city_code"), "Origin Country Code": c("origin_country_code"),
        "Dest City Code": c("dest_city_code"), "Dest Country Code": c("dest_country_code"),
        "Departure Date": c("departure"), "Return Date": c("return_date"), "Season": c("season"), "Cabin": c("cabin"),
        "Brand Order": c("brand_order"), "Tier Code": c("tier_code"), "Raw Brand Name": c("pretty_name"),
        "Normalized Brand Name": c("shown_name"),
        "Display Price": F.when(c("display_price_text") != "", c("display_price_text")).otherwise(s(c("price_value"))),
        "Calculated Absolute Price": price, "Currency": c("currency"), "Source": c("source"),
        "Fare Family Code": names.clean_fare_code(c("fare_family_code")), "Brand Description": F.lit(""),
        **{R.RIGHT_TITLES[k]: c(k) for k in R.RIGHT_KEYS},
        "Mileage Available": rightfn.yes_no(c("mileage_available")), "Miles Earned": c("miles_earned"),
        "Bonus Percent": c("bonus_percent"), "Scrape Timestamp": F.lit(stamp), "Status": F.lit("success"),
        "Retry Count": F.lit(0)}
    return df.select(*[s(v).alias(k) for k, v in cols.items()])


@query
def s8_flat_csv(spark, sf):
    path = scratch(spark, "flat")
    df = flat_fares(spark, sf)
    df.write.option("header", True).option("emptyValue", "").csv(path)
    back = spark.read.option("header", True).schema(df.schema).csv(path)
    return back.select(*[F.coalesce(f"`{c}`", F.lit("")).alias(c) for c in df.columns])


@query
def s9_failed_units(spark, sf):
    path = scratch(spark, "failed")
    df = counted(judged(spark, sf)).where("n_brands = 0")
    rows = df.select(
        F.col("carrier").alias("Carrier"), F.col("origin").alias("Origin"), F.col("destination").alias("Destination"),
        F.col("season").alias("Season"), F.col("final_status").alias("Status"), F.col("retry_count").cast("string").alias("Retry Count"),
        F.concat_ws(", ", F.lit("direct"), F.lit("market")).alias("Sources Tried"), F.col("error").alias("Error"),
        F.concat_ws("; ", "issues").alias("Validation Issues"), F.col("elapsed_s").cast("string").alias("Elapsed (s)"))
    rows.write.option("header", True).csv(path)
    return spark.read.option("header", True).schema(rows.schema).csv(path)


@query
def s10_run_summary_json(spark, sf):
    path = scratch(spark, "summary")
    df = run_summary(judged(spark, sf))
    df.write.json(path)
    return spark.read.schema(df.schema).json(path)


STAMP = "2026-01-15T00:00:00"


def feed_document(spark, sf):
    """Writes the feed and reads it back: (head, fares, runs)."""
    path = scratch(spark, "feed")
    key, orders = FL + ["card_name"], gold.chosen_orders(spark, sf)
    feats = export.feature_map(key, card_rights(spark, sf, later_wins=False, orders=orders))
    df = published_fares(spark, sf, orders).join(feats, key, "left")
    usd = F.when(F.upper("currency") == "USD", F.coalesce("abs_price", "price_value"))
    fares = df.select(
        F.date_format(F.date_add(F.lit(bridge.FIRST_DAY).cast("date"), F.col("pass_no")), "yyyy-MM").alias("coll_date"),
        F.col("season").alias("coll_season"), F.col("departure").cast("string").alias("query_date"), F.col("carrier").alias("airline"),
        "origin", "destination", "season", "cabin", F.col("pretty_name").alias("fare_brand"),
        F.col("tier_code").alias("std_tier"), (F.col("brand_order") + 1).alias("package_order"),
        geography.route_type().alias("ond_type"), geography.carrier_type().alias("carrier_type"),
        F.coalesce("abs_price", "price_value").alias("price"), usd.alias("price_usd"), "source", "features")
    folder = scratch(spark, "feed-fares")
    fares.write.parquet(folder)
    fares = feed.prune_features(spark.read.schema(fares.schema).parquet(folder))
    runs = feed.run_rows(fares, "v12", STAMP)
    feed.write_feed(fares, runs, path, STAMP, ["airline", "origin", "destination", "season", "cabin", "package_order", "fare_brand"])
    return feed.read_feed(spark, path, fares.schema, runs.schema)


@query
def s11_feed_json(spark, sf):
    """The feed's fares read back and unfolded: every stated feature of every fare."""
    _, fares, _ = feed_document(spark, sf)
    flat = fares.select(F.col("airline").alias("carrier"), "season", "ond_type", "carrier_type", "price_usd", F.explode("features").alias("feature", "f"))
    return flat.where("f.state is not null").groupBy("carrier", "season", "ond_type", "carrier_type", "feature", "f.state", "f.detail").agg(
        F.count("*").alias("n"), F.sum("price_usd").cast("double").alias("price_total"))


@query
def s11_feed_envelope(spark, sf):
    """The envelope read back: count and runs, and which features the fares still have a place for."""
    head, fares, runs = feed_document(spark, sf)
    kept = fares.select(F.explode(F.map_keys("features")).alias("key")).distinct().agg(F.array_join(F.sort_array(F.collect_set("key")), ",").alias("features"))
    one = head.join(kept, F.lit(True))
    return runs.join(F.broadcast(one), F.lit(True)).select(
        "generated_at", "count", "features", "run_id", "coll_date", "coll_season", "collected_at", F.array_join("airlines", ",").alias("airlines"),
        F.array_join("onds", ",").alias("onds"), "record_count", "status")


@query
def s16_filtered_tsv(spark, sf):
    from .analytics import filter_bar
    path = scratch(spark, "tsv")
    df = filter_bar(bridge.ladders(spark, sf), carriers=["TK", "LH"], seasons=["Winter"])
    df = df.select(*U, "cabin", "raw_brand_name", F.col("price").cast("string").alias("price"))
    df.write.option("header", True).option("sep", "\t").csv(path)
    return spark.read.option("header", True).option("sep", "\t").schema(df.schema).csv(path)


def market_bodies(spark, sf):
    """Marketplace responses, one per itinerary and searched cabin."""
    package = ["flight_id", "is_summer", "package", "card"]
    rights = matching.merged_rights(bridge.said_cards(spark, sf), package)
    said = F.struct("right_key", F.col("raw_value").alias("says"), (F.col("status") != "Not Included").alias("has"), (F.col("status") == "Paid").alias("paid"))
    packs = bridge.named_package(rights.groupBy(*package).agg(F.sort_array(F.collect_list(said)).alias("said")))
    pack = F.struct("card.screen_order", "raw_brand_name", "card.price_value", "card.code_no", "said")
    fl = bridge.with_itinerary(packs.groupBy(*FL).agg(F.sort_array(F.collect_list(pack)).alias("ps")))
    e = F.lit(None).cast("string")

    def item(s):
        return F.struct(s.right_key.alias("name"), s.says.alias("description"), F.struct(
            s.has.alias("is_available"), e.alias("display_text"), F.lit(2).alias("piece"), F.when(s.paid, "23").alias("allowance"),
            F.struct(F.when(s.paid, "Kesintili").alias("text")).alias("tooltip")).alias("attributes"))

    def package_of(p):
        return F.struct(p.raw_brand_name.alias("raw_name"), p.price_value.cast("double").alias("total_price"), F.lit("TRY").alias("currency"),
                        bridge.pick(bridge.CODES, p.code_no).alias("automation_key"), F.transform(p.said, item).alias("items"))
    flight = F.struct(F.struct(F.lit(100.0).alias("total")).alias("price"),
                      F.array(F.struct(F.col("carrier").alias("marketing_airline"))).alias("segments"),
                      F.transform("ps", package_of).alias("provider_packages"))
    body = F.to_json(F.struct(F.struct(F.array(flight).alias("departure")).alias("flights"), F.struct(F.struct(F.struct(
        F.lit(0.0243).alias("USD")).alias("Rates")).alias("TRY")).alias("currency_rates")))
    return fl.select(*FL, "origin", "destination", "block_no", "date_pos", body.alias("body"))


@query
def s18_marketplace_json(spark, sf):
    few = payloads.tallied_items(payloads.market_packages(market_bodies(spark, sf)), ["marketing", "raw_brand_name"])
    df = payloads.market_rights(few)
    return df.groupBy("marketing", "raw_brand_name", "kind", "right_key", "status").agg(
        F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"), F.max("raw_value").alias("last_value"))


@query
def s18_largest_response(spark, sf):
    search = ["origin", "destination", "season", "block_no", "date_pos", "group_cabin"]
    best = payloads.largest_body(market_bodies(spark, sf), search)
    df = payloads.market_packages(best)
    return df.groupBy(*search).agg(F.count("*").alias("packages"))


def airline_ladders(spark, sf):
    """Airline availability: fare category map per itinerary, fullest ladder per unit and cabin."""
    cards = bridge.cards(spark, sf)
    q, ln = F.col("qty"), F.col("ln")
    kind = bridge.pick([t for t, _ in R.AIRLINE_RIGHT_TYPES] + ["BONUS_MILE"], q % 20)
    arg = F.struct(q.alias("kilo"), ln.alias("piece"), F.when(kind == "BONUS_MILE", (ln * 5).cast("int")).alias("percentage"))
    right = F.struct(kind.alias("rightType"),
                     (ln % 3 != 0).alias("hasRight"), (ln % 2 == 0).alias("withCharge"), F.lit("ALLOWED").alias("rightStatus"), arg.alias("args"))
    bare = bridge.pick(list(R.AIRLINE_BRAND_NAMES), q % 3)
    code = F.when(ln % 5 == 1, bare).when(~(ln % 5).isin(0, 2), F.col("raw_brand_name"))
    brand = F.struct(code.alias("brandCode"), F.when(ln % 5 == 0, F.array(bare)).alias("brandCodeList"), F.struct(
        F.col("price_value").cast("double").alias("amount"), F.lit("USD").alias("currencyCode")).alias("grandTotalFare"),
        F.array(right).alias("brandRightList"))
    per = cards.groupBy(*FL, "carrier", "origin", "destination").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("screen_order", brand.alias("b")))), lambda x: x.b).alias("bookingPriceInfoList"))
    code = F.when(F.col("group_cabin") == "Premium Economy", "PREMIUM").otherwise(F.upper("group_cabin"))
    fl = per.groupBy("flight_id", *U).agg(F.map_from_entries(F.collect_list(F.struct(code, F.struct("bookingPriceInfoList")))).alias("fareCategory"))
    opt = F.struct((F.col("flight_id") % 17 == 0).alias("soldOutAllFlights"), F.array(F.struct("fareCategory")).alias("originDestinationOptionList"))
    body = F.to_json(F.struct(F.struct(F.array(opt).alias("originDestinationInformationList")).alias("data")))
    return payloads.airline_ladders(fl.select(*U, F.col("flight_id").alias("offer_no"), body.alias("body")), U)


@query
def s19_airline_brands(spark, sf):
    """Names, bonus miles and descriptions of the airline's brands."""
    b = payloads.airline_brands(airline_ladders(spark, sf))
    return b.groupBy("cabin", "raw_brand_name", F.coalesce("fare_family_code", F.lit("-")).alias("code"), "mileage_available", "bonus_percent").agg(
        F.count("*").alias("n"), F.sum("price_value").cast("double").alias("total"), F.max("description").alias("last_description"))


@query
def s19_airline_json(spark, sf):
    r = payloads.airline_rights(airline_ladders(spark, sf))
    return r.groupBy(*U, "cabin", F.col("offer_no").alias("flight_id")).agg(
        F.countDistinct("screen_order").alias("brands"), F.count("right_key").alias("mapped"),
        F.count(F.when(F.col("status") == "Not Included", 1)).alias("refused"), F.max("raw_value").alias("last_value"))


@query
def s20_search_page_json(spark, sf):
    """Search-page payload per itinerary and searched cabin: boxes, absolute prices, rule lines.

    A box without a price text costs the base fare.
    """
    lis = bridge.rule_lines(spark, sf).groupBy(*FL, "raw_brand_name").agg(F.sort_array(F.collect_set("line")).alias("lis"))
    cards = bridge.cards(spark, sf).join(lis, FL + ["raw_brand_name"])
    box = F.struct(F.col("raw_brand_name").alias("name"), F.col("fare_family_code").alias("ffcode"), F.col("group_cabin").alias("cabin"),
                   F.coalesce(F.concat(F.lit("+ "), F.col("price_value").cast("string"), F.lit(" USD")), F.lit("")).alias("priceText"), "lis")
    fl = cards.groupBy(*FL, "carrier").agg(F.sort_array(F.collect_list(F.struct("screen_order", box.alias("b")))).alias("bs"))
    body = F.to_json(F.struct("carrier", F.lit("319 .08 USD").alias("baseText"), F.transform("bs", lambda x: x.b).alias("brands")))
    df = payloads.search_boxes(fl.select(*FL, body.alias("body")), F.col("group_cabin"))
    kept = df.where(F.col("tabled") | ~identity.contradicts_itself(F.col("raw_brand_name"), F.col("box_cabin"), F.col("requested")))
    r = kept.select("row_carrier", "raw_brand_name", "currency", "price_value", F.explode("lines").alias("line"))
    r = r.groupBy("row_carrier", "raw_brand_name", "currency", "line").agg(F.count("*").alias("n"), F.sum("price_value").cast("double").alias("total"))
    r = r.withColumn("r", rightfn.rule_line(F.col("line")))
    return r.select("row_carrier", "raw_brand_name", "currency", "line", F.col("r.kind").alias("kind"), F.col("r.key").alias("key"),
                    F.col("r.status").alias("status"), "n", "total")


@query
def s21_verification_report(spark, sf):
    """Verdicts kept from the prior report where they were OK, the rest checked again."""
    path = scratch(spark, "verify")
    v = verdicts(spark, sf).select(*SIDED, "verdict")
    v.where("season = 'Summer'").withColumn("origin_of_row", F.lit("prior")).write.json(path)
    prior = spark.read.schema("carrier string, origin string, destination string, season string, departure date, group_cabin string, verdict string, origin_of_row string").json(path)
    ok = prior.where(F.col("verdict").startswith("OK"))
    again = v.join(ok.select(*SIDED), SIDED, "left_anti").withColumn("origin_of_row", F.lit("now"))
    out = scratch(spark, "verify-next")
    ok.unionByName(again).write.json(out)
    return tally(spark.read.schema(prior.schema).json(out), "carrier", "season", "verdict", "origin_of_row")


@query
def u3_rule_line_rows(spark, sf):
    """Every number of a panel line as a row of its own; distinct lines are read once, their counts ride along."""
    df = bridge.rule_lines(spark, sf).groupBy("line").agg(F.count("*").alias("n"))
    return df.select("line", "n", F.inline(generators.number_facts(F.col("line"))))


@query
def u3_penalty_rows(spark, sf):
    """Fees before and after departure, which depend on what a line said earlier."""
    df = bridge.penalty_lines(spark, sf).groupBy("line").agg(F.count("*").alias("n"))
    facts = generators.penalty_facts(df.asTable())
    return facts.groupBy("topic", "phase", "outcome").agg(F.count("*").alias("lines"), F.sum("n").alias("n"))
