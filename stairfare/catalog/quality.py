"""Completeness, run summaries, quality checks and verification."""

from pyspark.sql import functions as F

from ..functions import names, rights as rightfn
from ..operators import ladder, quality
from ..plans import archive, gold
from ..rules import rights as R, vocab
from ..sources import bridge
from ..sources.tables import scratch
from .choosing import SIDED, sides
from .ladders import L
from .registry import query
from .texts import tally

U = bridge.UNIT
FLAGS = ["missing_cabin", "missing_brands", "missing_price", "missing_rights", "missing_miles",
         "missing_source", "missing_business"]


def judged(spark, sf):
    df = quality.with_completeness(bridge.attempts(spark, sf))
    return df.withColumn("final_status", quality.final_status())


@query
def a6_unit_completeness(spark, sf):
    return judged(spark, sf).select("flight_id", *U, *FLAGS, F.array_join("issues", "; ").alias("issues"),
                                    quality.needs_retry().alias("needs_retry"))


@query
def a7_final_status(spark, sf):
    return tally(judged(spark, sf), "carrier", "status", "final_status")


def counted(df):
    """Opportunistic units without brands are neither counted nor failed."""
    return df.where(~(F.col("opportunistic") & (F.col("n_brands") == 0)))


def run_summary(df):
    s = F.col("final_status")
    n = lambda cond: F.count(F.when(cond, 1))
    return counted(df).agg(
        F.count("*").alias("units"), n(s == "success").alias("succeeded"), n(s == "partial").alias("partial"),
        n(s == "no_availability").alias("no_availability"), n(s == "failed").alias("failed"),
        *[n(F.col(f)).alias(f"units_{f}") for f in FLAGS],
        F.sum("n_brands").alias("rows"), F.sum("elapsed_s").alias("total_seconds"))


@query
def a8_run_summary(spark, sf):
    return run_summary(judged(spark, sf))


@query
def p11_successful_units(spark, sf):
    return tally(judged(spark, sf).where("final_status = 'success'"), "carrier", "season")


@query
def p12_uncounted_opportunistic(spark, sf):
    return tally(counted(judged(spark, sf)), "carrier", "opportunistic")


@query
def p21_second_pass(spark, sf):
    return tally(judged(spark, sf).where(quality.second_pass()), "carrier", "status", "missing_business")


@query
def a9_currency_leaks(spark, sf):
    text = F.concat_ws(" ", F.col("price_text"), F.col("currency"))
    df = bridge.lines(spark, sf).withColumn("text_leak", text.rlike(r"\b(TL|TRY)\b"))
    return df.where("currency not in ('USD', '') or text_leak").groupBy("carrier", "currency", "text_leak") \
        .agg(F.count("*").alias("n"))


@query
def a10_duplicate_names(spark, sf):
    """Names one ladder publishes more than once; the published ladder has none."""
    raw = names.with_pretty_name(ladder.regroup(bridge.cards(spark, sf))).groupBy(
        *bridge.FLIGHT, "carrier", "cabin", "pretty_name").agg(F.count("*").alias("n"))
    dup = raw.where("n > 1").groupBy("carrier", "pretty_name").agg(F.count("*").alias("ladders"))
    clean = gold.published(spark, sf).groupBy(*L, "shown_name").agg(F.count("*").alias("n")).where("n > 1") \
        .groupBy("carrier", F.col("shown_name").alias("pretty_name")).agg(F.count("*").alias("ladders"))
    return dup.withColumn("stage", F.lit("read")).unionByName(clean.withColumn("stage", F.lit("published")))


@query
def a11_misread_baggage(spark, sf):
    short = rightfn.baggage_short(F.col("raw_value"))
    kg = F.regexp_extract(F.col("short"), "^([0-9]+)kg$", 1)
    df = bridge.rights(spark, sf).where(F.col("right_key").isin(R.BAGGAGE_KEYS)).withColumn("short", short)
    return df.where((kg != "") & (F.length(kg) >= 3)).groupBy("carrier", "right_key", "short") \
        .agg(F.count("*").alias("n"))


def falling_steps(df, keys, order, price):
    from pyspark.sql import Window
    before = F.lag(price).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("before", before).where(F.col(price) < F.col("before"))


@query
def a12_falling_prices(spark, sf):
    """Steps of published ladders where a higher tier costs less; rows without a price are passed over."""
    df = gold.published_with_consensus(spark, sf).where("abs_price is not null")
    bad = falling_steps(df, L, ["brand_order", "shown_name", "abs_price"], "abs_price")
    return bad.groupBy("carrier", "cabin", "shown_name").agg(
        F.count("*").alias("n"), F.min(F.col("abs_price") - F.col("before")).cast("double").alias("deepest"))


@query
def a13_right_coverage(spark, sf):
    """Rights a carrier states on nearly all of its ladders, yet not on some."""
    five = ["cabin_baggage", "checked_baggage", "meal", "seat_selection", "lounge_access"]
    df = bridge.rights(spark, sf)
    unit = U + ["group_cabin"]
    has = [F.max((F.col("right_key") == k) & (F.col("status") != "Unknown")).alias(k) for k in five]
    per = df.groupBy(*unit).agg(*has)
    per = per.select(*unit, F.inline(F.array(*[F.struct(F.lit(k).alias("right_key"), F.col(k).alias("has")) for k in five])))
    out = per.groupBy("carrier", "right_key").agg(F.count(F.when(F.col("has"), 1)).alias("have"), F.count("*").alias("units"))
    miss = F.col("units") - F.col("have")
    flag = (F.col("units") >= 8) & (miss > 0) & (F.col("have") / F.col("units") >= 0.85)
    return out.withColumn("missing", miss).withColumn("flagged", flag)


@query
def a14_business_coverage(spark, sf):
    df = bridge.attempts(spark, sf).where(~names.is_low_cost(F.col("carrier")))
    per = df.groupBy(*U).agg(F.max("has_business").alias("b"), F.max("has_economy").alias("e"))
    return per.groupBy("carrier").agg(F.count("*").alias("units"),
                                      F.count(F.when(F.col("e") & ~F.col("b"), 1)).alias("missing"))


@query
def a15_refund_fee_spread(spark, sf):
    from ..functions.money import fee_text
    df = bridge.rights(spark, sf).where("right_key = 'refund' and status = 'Paid'").withColumn(
        "fee", fee_text(F.col("raw_value")) != "")
    per = df.groupBy("carrier").agg(F.count(F.when(F.col("fee"), 1)).alias("with_fee"),
                                    F.count(F.when(~F.col("fee"), 1)).alias("without_fee"))
    cls = F.when(F.col("without_fee") == 0, "all").when(F.col("with_fee") == 0, "none").otherwise("mixed")
    return per.groupBy(cls.alias("spread")).agg(F.count("*").alias("carriers"), F.sum("with_fee").alias("fees"),
                                                F.sum("without_fee").alias("no_fees"))


@query
def a16_archive_rows(spark, sf):
    """Fares kept by collection day; the second day is collected again and replaces its own rows only.

    A row per day, season, carrier and route, so no list grows with the network.
    """
    path = scratch(spark, "archive")
    fares = archive.collected_fares(spark, sf)
    archive.replace_days(fares, path)
    archive.replace_days(fares.where(F.col("coll_date") == F.date_add(F.lit(bridge.FIRST_DAY).cast("date"), 1)), path)
    kept = archive.read_days(spark, path, fares.schema)
    return kept.groupBy(F.col("coll_date").cast("string").alias("coll_date"), "season", "carrier", F.concat_ws("-", "origin", "destination").alias("ond")) \
        .agg(F.count("*").alias("record_count"))


@query
def a17_suspicious_names(spark, sf):
    df = quality.suspicious(names.with_pretty_name(bridge.lines(spark, sf)), vocab.ACCEPTED_TOKENS)
    return df.groupBy("carrier", "pretty_name", F.concat_ws("-", "origin", "destination").alias("ond")).agg(F.count("*").alias("n"))


def verdicts(spark, sf):
    p, s = sides(spark, sf)
    return quality.compare_readings(p, s, SIDED)


@query
def j23_compare_readings(spark, sf):
    return verdicts(spark, sf).select(*U, F.col("departure").cast("string").alias("departure"), "group_cabin", "verdict")


@query
def a18_verification_gate(spark, sf):
    """Each verdict, the suspicious names, and the gate: shut if a name mismatches or looks like a code."""
    v = verdicts(spark, sf).groupBy(F.col("verdict").alias("check")).agg(F.count("*").alias("found"))
    names_ = a17_suspicious_names(spark, sf).select("carrier", "pretty_name").distinct().agg(F.count("*").alias("found"))
    return quality.gate(v, names_)


@query
def x5_rotated_inventory(spark, sf):
    df = verdicts(spark, sf).where(F.col("l").isNotNull())
    return df.groupBy("carrier", quality.rotated(F.col("s.name"), F.col("l.name")).alias("rotated")) \
        .agg(F.count("*").alias("n"))


@query
def a19_publish_gate(spark, sf):
    df = judged(spark, sf).groupBy("carrier").agg(
        F.count("*").alias("outcomes"), F.count(F.when(F.col("final_status") == "success", 1)).alias("good"))
    return df.withColumn("may_continue", quality.publish_gate(F.col("outcomes"), F.col("good")))


@query
def a21_reading_fingerprint(spark, sf):
    df = bridge.sided_cards(spark, sf)
    return quality.fingerprint(df, ["carrier", "season", "side"], "origin", "destination", "raw_brand_name", "price_value")


@query
def x6_reading_diff(spark, sf):
    p, s = sides(spark, sf)
    cols = ["carrier", "group_cabin", "raw_brand_name"]
    return quality.reading_diff(p.select(*cols), s.select(*cols)).withColumnRenamed("surplus", "n")


@query
def a33_without_rights(spark, sf):
    """Packages for which nobody stated any right."""
    known = bridge.rights(spark, sf).where("status <> 'Unknown' and raw_value <> ''").select(
        *bridge.FLIGHT, "raw_brand_name").distinct()
    bare = bridge.cards(spark, sf).join(known, bridge.FLIGHT + ["raw_brand_name"], "left_anti")
    return tally(bare, "carrier", "raw_brand_name")


@query
def a35_unit_sources(spark, sf):
    per = gold.chosen_results(spark, sf)
    return per.groupBy(*U).agg(F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"),
                               F.count("*").alias("total_brands"))


@query
def p15_reported_rights(spark, sf):
    """Rights some row reports; one aggregate decides which columns survive."""
    from ..plans.export import reported_rights
    return reported_rights(bridge.rights(spark, sf))


def first_findings(bad, order, first=15):
    """The first findings in ``order`` and, beside each, how many are left out (none below ``first``).

    Showing the first ones is the report's purpose.  Their number is a one-row relation joined back, so
    building the query runs nothing.
    """
    total = bad.agg(F.count("*").alias("found"))
    return bad.orderBy(*order).limit(first).join(F.broadcast(total)) \
        .withColumn("and_more", F.greatest(F.col("found") - first, F.lit(0))).drop("found")


@query
def o2_first_findings(spark, sf):
    bad = a12_falling_prices(spark, sf).select("carrier", "cabin", "shown_name", "n")
    return first_findings(bad, ["carrier", "cabin", "shown_name"])
