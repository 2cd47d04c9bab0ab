"""Bulk jobs over the scalar functions: each value with how often it occurs."""

from pyspark.sql import functions as F

from ..functions import cards as cardfn, dates, money, names, rights as rightfn
from ..rules import rights as R
from ..sources import bridge
from ..sources.tables import table
from .registry import query


def tally(df, *cols):
    return df.groupBy(*cols).agg(F.count("*").alias("n"))


def tally_by(df, inputs, **values):
    """How often each value of an expression occurs, worked out once per distinct input.

    Rows are counted by the columns the expressions read, the rules are applied to the few survivors, and what
    comes out equal is summed.
    """
    few = df.groupBy(*inputs).agg(F.count("*").alias("n"))
    named = few.withColumns(values)
    return named.groupBy(*dict.fromkeys([*inputs, *values])).agg(F.sum("n").alias("n"))


@query
def f1_match_key(spark, sf):
    return tally_by(bridge.lines(spark, sf), ["raw_brand_name"], match_key=names.match_key(F.col("raw_brand_name")))


@query
def f2_subtier(spark, sf):
    n = F.col("raw_brand_name")
    subtier = names.detect_subtier(n)
    return tally_by(bridge.lines(spark, sf), ["raw_brand_name"], subtier=subtier, subtier_rank=names.subtier_rank(subtier))


@query
def f3_cabin_word(spark, sf):
    n = F.col("raw_brand_name")
    return tally_by(bridge.lines(spark, sf), ["raw_brand_name"], cabin_word=names.detect_cabin(n))


@query
def f4_pretty_name(spark, sf):
    return names.with_pretty_name(tally(bridge.lines(spark, sf), "carrier", "raw_brand_name")).select("carrier", "raw_brand_name", "pretty_name", "n")


@query
def f5_suspicious_name(spark, sf):
    df = names.with_pretty_name(tally(bridge.lines(spark, sf), "carrier", "raw_brand_name", "fare_family_code")).withColumn(
        "suspicious", names.is_suspicious(F.col("pretty_name"), F.col("fare_family_code")))
    return df.groupBy("pretty_name", F.coalesce("fare_family_code", F.lit("-")).alias("code"), "suspicious").agg(F.sum("n").alias("n"))


def _effective(df):
    """The cabin a box is tagged with is a hint: it decides where neither code nor name does."""
    c = F.col
    return names.effective_cabin(c("raw_brand_name"), c("fare_family_code"), c("hint"), c("group_cabin"), c("carrier"))


@query
def f6_effective_cabin(spark, sf):
    hint = F.when(F.col("ln") % 4 == 0, "Business").when(F.col("ln") % 4 == 1, "Premium Economy")
    df = bridge.lines(spark, sf).withColumn("hint", hint)
    inputs = ["carrier", "raw_brand_name", "fare_family_code", "group_cabin", "hint"]
    return tally_by(df, inputs, effective_cabin=_effective(df)).select(
        "carrier", "raw_brand_name", F.coalesce("fare_family_code", F.lit("-")).alias("code"), "group_cabin",
        F.coalesce("hint", F.lit("-")).alias("hint"), "effective_cabin", "n")


@query
def f7_canonical_name(spark, sf):
    n, cab = F.col("raw_brand_name"), F.col("group_cabin")
    return tally_by(bridge.lines(spark, sf), ["raw_brand_name", "group_cabin"],
                    canonical_name=names.canonical_name(n, cab), global_rank=names.name_rank(n, cab))


@query
def f8_clean_fare_code(spark, sf):
    few = tally_by(bridge.lines(spark, sf), ["fare_family_code"], clean_code=names.clean_fare_code(F.col("fare_family_code")))
    return few.select(F.coalesce("fare_family_code", F.lit("-")).alias("code"), "clean_code", "n")


@query
def f9_parse_price(spark, sf):
    df = bridge.lines(spark, sf).select(money.parse_price(F.col("price_text")).alias("p"))
    return df.groupBy(F.col("p.price_type").alias("price_type"), F.col("p.currency").alias("currency")) \
        .agg(F.count("*").alias("n"), F.sum("p.value").cast("double").alias("total"),
             F.max("p.value").cast("double").alias("largest"))


@query
def f10_split_cents(spark, sf):
    broken = F.replace(F.col("list_price").cast("decimal(14,2)").cast("string"), F.lit("."), F.lit(" . "))
    joined = money.join_split_cents(F.concat(broken, F.lit(" USD")))
    p = money.parse_price(joined)
    return bridge.lines(spark, sf).groupBy("carrier").agg(
        F.sum(p["value"]).cast("double").alias("total"), F.min(joined).alias("first_text"))


@query
def f11_base_plus_delta(spark, sf):
    base = F.when(F.col("ln") != 3, F.col("list_price").cast("decimal(14,2)"))
    delta = F.when(F.col("ln") != 5, F.col("qty").cast("decimal(14,2)"))
    return bridge.lines(spark, sf).groupBy("carrier", "ln").agg(
        F.sum(money.absolute_of(base, delta)).cast("double").alias("total"),
        F.count("*").alias("n"))


@query
def f12_lira_to_usd(spark, sf):
    rate = (F.lit(240) + F.col("flight_id") % 5).cast("decimal(10,0)") * F.lit("0.0001").cast("decimal(5,4)")
    usd = money.to_usd(F.col("list_price").cast("decimal(14,2)"), F.col("currency"), rate)
    return bridge.lines(spark, sf).groupBy("carrier", "currency").agg(
        F.sum(usd).cast("double").alias("total_usd"), F.count("*").alias("n"))


@query
def f13_status_of_text(spark, sf):
    return tally_by(bridge.rule_lines(spark, sf), ["line"], status=rightfn.status_of_text(F.col("line")))


@query
def f14_item_status(spark, sf):
    ln = F.col("ln")
    available = F.when(ln % 3 == 0, True).when(ln % 3 == 1, False)
    st = rightfn.item_status(F.when(ln != 1, available), F.col("raw_value"), F.lit(""),
                             F.when(ln == 5, "Kesintili"))
    few = tally_by(bridge.rights(spark, sf), ["ln", "right_key", "raw_value"], item_status=st)
    return few.groupBy("ln", "right_key", "item_status").agg(F.sum("n").alias("n"))


def _flags():
    ln = F.col("ln")
    has = F.when(ln % 3 == 0, True).when(ln % 3 == 1, False)
    return (has, F.when(ln % 2 == 0, True),
            F.when(ln == 5, "ALLOWED_WITH_PENALTY").when(ln == 2, "NOT_ALLOWED").otherwise("ALLOWED"))


@query
def f15_flagged_status(spark, sf):
    has, charge, state = _flags()
    ln, q = F.col("ln"), F.col("qty")
    value = rightfn.flagged_value(F.when(ln % 2 == 0, q), F.when(ln % 3 == 0, ln),
                                  F.when(ln == 7, q), F.lit("USD"), F.when(ln == 5, q), state)
    few = tally_by(bridge.lines(spark, sf), ["ln", "qty"], status=rightfn.flagged_status(has, charge, state), raw_value=value)
    return few.groupBy("ln", "status", "raw_value").agg(F.sum("n").alias("n"))


@query
def f16_rule_lines(spark, sf):
    few = tally(bridge.rule_lines(spark, sf), "line").withColumn("r", rightfn.rule_line(F.col("line")))
    return few.select("line", "r.kind", "r.key", "r.status", "r.value", "r.earned", "r.bonus", "n")


@query
def f17_item_codes(spark, sf):
    item = bridge.pick([i for i, _ in R.ITEM_CODES] + ["entertainment"], F.col("supp_no") % 28)
    mapped = F.element_at(names.literal_map(R.ITEM_CODES), F.col("item"))
    air = bridge.pick([i for i, _ in R.AIRLINE_RIGHT_TYPES] + ["NO_SHOW"], F.col("part_no") % 20)
    amap = F.element_at(names.literal_map(R.AIRLINE_RIGHT_TYPES), F.col("right_type"))
    df = bridge.lines(spark, sf).withColumn("item", item).withColumn("right_type", air)
    return tally_by(df, ["item", "right_type"], right_key=F.coalesce(mapped, F.lit("")), airline_key=F.coalesce(amap, F.lit("")))


@query
def f18_rule_detail(spark, sf):
    return tally_by(bridge.rights(spark, sf), ["right_key", "status"], detail=rightfn.rule_detail(F.col("right_key"), F.col("status")))


@query
def f19_baggage_short(spark, sf):
    df = bridge.rights(spark, sf).where(F.col("right_key").isin(R.BAGGAGE_KEYS))
    return tally_by(df, ["raw_value"], short=rightfn.baggage_short(F.col("raw_value")))


@query
def f20_baggage_text(spark, sf):
    piece = F.when(F.col("ln") != 4, F.col("ln"))
    allowance = F.when(F.col("qty") % 2 == 0, F.col("qty").cast("string"))
    few = tally_by(bridge.lines(spark, sf), ["ln", "qty"], detail=rightfn.baggage_text(piece, allowance, F.lit("1 bag")))
    return few.groupBy("ln", "detail").agg(F.sum("n").alias("n"))


@query
def f21_fee_text(spark, sf):
    df = bridge.rights(spark, sf).where(F.col("status") == "Paid")
    return tally_by(df, ["raw_value"], fee=money.fee_text(F.col("raw_value")))


@query
def f22_miles_feature(spark, sf):
    state, detail = rightfn.miles_feature(F.col("mileage_available"), F.col("miles_earned"),
                                          F.col("bonus_percent"))
    few = tally_by(bridge.cards(spark, sf), ["mileage_available", "miles_earned", "bonus_percent"], state=state, detail=detail)
    return few.groupBy("state", "detail").agg(F.sum("n").alias("n"))


@query
def f23_display_price(spark, sf):
    text = F.when(F.col("ln") % 2 == 0, F.col("price_text")).otherwise("")
    price = F.col("price_value")
    live = F.when(text != "", text).otherwise(F.coalesce(price.cast("string"), F.lit("")))
    stored = F.coalesce(text, F.lit(""))
    usd = F.when(F.coalesce("currency", F.lit("USD")) == "USD", price)
    return bridge.lines(spark, sf).groupBy("carrier").agg(
        F.max(live).alias("live_text"), F.max(stored).alias("stored_text"),
        F.count(F.when(live != stored, 1)).alias("differ"),
        F.sum(usd).cast("double").alias("usd_total"))


@query
def f24_row_names_carrier(spark, sf):
    it = bridge.itineraries(spark, sf)
    text = F.when(F.col("flight_id") % 2 == 0, F.concat_ws(" ", F.col("row_carrier"), F.lit("12 · Nonstop"))) \
        .otherwise(F.col("operating"))
    it = it.withColumn("text", text).join(
        F.broadcast(names.carrier_dim(spark)), F.col("carrier") == F.col("dim_carrier"), "left")
    hit = names.names_carrier(F.col("text"), F.col("carrier"), F.col("airline_name"))
    return tally(it.withColumn("is_target", hit).withColumn("norm", names.norm_airline(F.col("text"))),
                 "carrier", "text", "norm", "is_target")


@query
def f27_keys(spark, sf):
    unit = names.unit_key(*[F.col(c) for c in bridge.UNIT])
    return tally(bridge.lines(spark, sf).select(
        unit.alias("unit_key"), names.unit_key(*[F.col(c) for c in bridge.UNIT + ["group_cabin"]])
        .alias("ladder_key")), "unit_key", "ladder_key")


@query
def f28_candidate_dates(spark, sf):
    """Date plan of each (route, season): own hash instead of a random generator."""
    jobs = bridge.job_rows(spark, sf).select("origin", "destination").distinct()
    plan = dates.date_plan(dates.with_seasons(jobs), F.lit("2026-01-15").cast("date"), seed=7)
    return plan.select("origin", "destination", "season", "block_no", "pos",
                       F.col("departure").cast("string").alias("departure"),
                       F.col("return_date").cast("string").alias("return_date"))


@query
def f29_lbs_to_kg(spark, sf):
    lbs = F.col("qty") * 2 - 1
    return tally(bridge.lines(spark, sf).select(lbs.alias("lbs"), cardfn.lbs_to_kg(lbs).alias("kg")),
                 "lbs", "kg")


def card_texts(spark, sf):
    """Offer panels written out from the collected cards."""
    c = F.col
    head = F.when(c("group_cabin") == "Business", "Business class") \
        .when(c("ln") % 2 == 0, "Economy class").otherwise("Ekonomi sınıfı")
    name = F.when(c("ln") == 5, F.lit(None)).otherwise(c("raw_brand_name"))
    special = F.when(c("ln") == 6, F.lit("Only for ages 17 - 30"))
    text = F.concat_ws(
        "\n", head, name, special, F.lit("Baggage"), F.lit("Personal item: Included"),
        F.concat(F.lit("Carry-on baggage: 1 × "), (c("qty") % 60 + 10).cast("string"), F.lit(" lbs")),
        F.when(c("ln") % 2 == 0, "Checked baggage: Not included").otherwise("Check-in bagajı: 2 × 23 kg"),
        F.lit("Flexibility"),
        F.when(c("ln") % 3 == 0, "Non-refundable (partial tax refund only)")
        .otherwise(F.concat(F.lit("Cancellation fee: from $"), c("qty").cast("string"))),
        F.when(c("ln") % 3 == 1, "Changes not permitted"), F.when(c("ln") == 4, "Salon erişimi var"),
        F.concat(F.lit("Airline miles: at least "), F.format_number(c("qty") * 100, 0)),
        F.concat(F.lit("$"), F.format_number(c("price_value"), 2)))
    return bridge.cards(spark, sf).where(c("price_type") == "absolute").select("group_cabin", text.alias("card"))


@query
def f30_fare_cards(spark, sf):
    few = cardfn.tallied_cards(card_texts(spark, sf), "card", "group_cabin")
    parsed = cardfn.parse_cards(few, "card", "group_cabin")
    r = parsed.select("card_cabin", "brand_name", "n", "price_total", (F.col("miles_earned") * F.col("n")).alias("miles"),
                      F.explode("rights").alias("r"))
    return r.groupBy("card_cabin", "brand_name", "r.key", "r.status", "r.value").agg(
        F.sum("n").alias("n"), F.sum("price_total").cast("double").alias("price_total"),
        F.sum("miles").cast("bigint").alias("miles_total"))


@query
def f31_json_round_trip(spark, sf):
    """Cards encoded to JSON text and decoded again with an explicit schema."""
    schema = "raw_brand_name string, price_value decimal(14,2), fare_family_code string"
    df = bridge.cards(spark, sf).withColumn("body", F.to_json(F.struct(
        "raw_brand_name", "price_value", "fare_family_code")))
    back = F.from_json("body", schema)
    return df.select(back.alias("b"), F.get_json_object("body", "$.raw_brand_name").alias("path_name")) \
        .groupBy("path_name", F.coalesce("b.fare_family_code", F.lit("-")).alias("code")) \
        .agg(F.count("*").alias("n"), F.sum("b.price_value").cast("double").alias("total"))


@query
def f32_mileage_yes_no(spark, sf):
    return tally(bridge.cards(spark, sf).withColumn("mileage", rightfn.yes_no(F.col("mileage_available"))),
                 "season", "mileage")


@query
def f33_display_formats(spark, sf):
    df = bridge.lines(spark, sf).join(F.broadcast(names.carrier_dim(spark)),
                                      F.col("carrier") == F.col("dim_carrier"), "left")
    title = names.carrier_title(F.col("carrier"), F.col("airline_name"))
    label = money.price_label(F.col("price_value"), F.col("currency"), F.lit("n/a"))
    return df.groupBy(title.alias("title"), "currency").agg(
        F.max(label).alias("last_label"), F.min(label).alias("first_label"), F.count("*").alias("n"))


@query
def f34_state_detail(spark, sf):
    few = tally_by(bridge.rights(spark, sf), ["right_key", "status", "raw_value"], cell=rightfn.state_and_detail(F.col("status"), F.col("raw_value")))
    return few.groupBy("right_key", "cell").agg(F.sum("n").alias("n"))


@query
def f35_elapsed_seconds(spark, sf):
    ev = table(spark, sf, "events")
    span = F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")) / 1000000.0
    return ev.groupBy("user_id").agg((F.floor(span * 1000 + 0.5) / 1000).alias("elapsed_s"))
