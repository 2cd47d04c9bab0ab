"""Human corrections over collected ladders."""

from pyspark.sql import functions as F

from ..functions import names, rights as rightfn
from ..operators import changeset as cs, ladder
from ..rules import rights as R
from ..sources import bridge
from ..sources.tables import scratch
from .registry import query
from .texts import tally

U = bridge.UNIT
L = U + ["cabin"]


def entries(spark, sf):
    """A typed change-set: the second source's view of each family, as text cells."""
    df = bridge.lines(spark, sf).where("ln % 2 = 0").groupBy(*U, "group_cabin", "raw_brand_name").agg(
        F.min(F.struct("screen_order", "flight_id", "qty", F.col("list_price").alias("p"))).alias("b"))
    q = F.col("b.qty")
    price = F.replace(F.col("b.p").cast("decimal(14,2)").cast("string"), F.lit("."), F.lit(","))
    cells = {t: F.lit("") for t in cs.RIGHT_COLS}
    cells["Cabin Baggage"] = F.when(q % 13 == 0, "maybe").when(q % 4 == 1, "Included: 1×8kg").when(q % 4 == 2, "dahil").otherwise("")
    cells["Meal"] = F.when(q % 3 == 0, "Paid: $5").when(q % 3 == 1, "-").otherwise("")
    cells["Refund"] = F.when(q % 5 == 0, "ücretli:  48 h ").otherwise("")
    return df.select(
        F.col("b.screen_order").alias("line"),
        F.when(q % 7 == 0, "remove").when(q % 7 == 1, "").when(q == 50, "delete").otherwise("UPSERT").alias("Action"),
        F.lower("carrier").alias("Carrier"), F.col("origin").alias("Origin"),
        F.when(q == 49, "X1").otherwise(F.col("destination")).alias("Destination"),
        F.lower("season").alias("Season"), F.upper("group_cabin").alias("Cabin"),
        (q % 14 + 1).cast("string").alias("Brand Order"), F.col("raw_brand_name").alias("Brand Name"),
        F.when((q % 3 != 0) | (q % 11 == 0), price).otherwise("").alias("Price USD"),
        F.when(q % 3 == 0, q.cast("string")).otherwise("").alias("Step USD"),
        *[v.alias(t) for t, v in cells.items()], F.concat(F.lit("n"), q.cast("string")).alias("Note"))


def collected(spark, sf):
    """The first source's ladders per route."""
    df = bridge.lines(spark, sf).where("ln % 2 = 1 and price_type = 'absolute' and price_value is not null")
    df = df.withColumnRenamed("group_cabin", "cabin").groupBy(*L, "raw_brand_name").agg(
        F.min("price_value").alias("price_value"))
    df = ladder.number_ladder(df, L, [F.col("price_value"), F.col("raw_brand_name")], "screen_order")
    return df.withColumnRenamed("raw_brand_name", "brand_name").withColumn("k", names.match_key(F.col("brand_name")))


@query
def f25_right_cells(spark, sf):
    df = entries(spark, sf)
    cells = F.array(*[F.struct(F.lit(t).alias("title"), F.col(t).alias("cell")) for t in ("Cabin Baggage", "Meal", "Refund")])
    df = df.select(F.inline(cells)).where("cell <> ''")
    status, detail = rightfn.split_cell(F.col("cell"))
    return tally(df.withColumn("status", status).withColumn("detail", detail), "title", "cell", "status", "detail")


@query
def f26_check_entries(spark, sf):
    df = cs.checked(entries(spark, sf))
    return df.select("line", "action", "carrier", "origin", "destination", "season", "cabin", "k",
                     F.array_join("errors", "; ").alias("errors"))


@query
def s13_change_set_csv(spark, sf):
    """Change-set written as CSV and read back; rows of blanks drop."""
    path = scratch(spark, "changes")
    df = entries(spark, sf).select(*cs.COLUMNS)
    blank = df.limit(0).unionByName(df.sparkSession.createDataFrame([tuple(" " for _ in cs.COLUMNS)], df.schema))
    df.unionByName(blank).write.option("header", True).csv(path)
    back = spark.read.option("header", True).schema(df.schema).csv(path)
    return cs.drop_blank_rows(back).groupBy("Action", "Carrier", "Cabin").agg(
        F.count("*").alias("n"), F.count("Step USD").alias("steps"), F.max("Note").alias("last_note"))


LEGEND = ["# Change-set template: one package per row",
          "# Action: upsert (default) or remove", "# Price USD is absolute, Step USD the fee from the tier below"]


@query
def s14_template_with_legend(spark, sf):
    """Template rows under ``#`` legend lines; the reader skips the legend."""
    path = scratch(spark, "template")
    df = entries(spark, sf).select(*cs.COLUMNS)
    rows = df.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in cs.COLUMNS])).alias("value"))
    legend = spark.createDataFrame([(x,) for x in LEGEND], "value string")
    legend.unionByName(rows).write.text(path)
    back = spark.read.schema(df.schema).option("comment", "#").csv(path)
    return back.groupBy("Season", "Cabin", "Meal").agg(F.count("*").alias("n"))


@query
def s15_export_packages(spark, sf):
    """Collected packages in change-set shape, one column per right (the later statement wins)."""
    from ..plans import export, gold
    orders = gold.chosen_orders(spark, sf)
    res = gold.chosen_results(spark, sf, orders)
    key = bridge.FLIGHT + ["raw_brand_name"]
    last = bridge.settled_rights(spark, sf, orders=orders).groupBy(*key, "right_key").agg(
        F.max(F.struct("pos", "status", "raw_value")).alias("b"))
    cell = last.select(*key, "right_key", rightfn.cell_text(F.col("b.status"), F.col("b.raw_value")).alias("cell"))
    wide = export.right_columns(cell, key, "cell", "")
    df = ladder.number_ladder(res, U + ["pass_no", "group_cabin"], ["screen_order", "raw_brand_name"], "no")
    return df.join(wide, key).select(
        *U, "pass_no", F.col("group_cabin").alias("cabin"), (F.col("no") + 1).alias("brand_order"),
        F.col("raw_brand_name").alias("brand_name"),
        F.coalesce(F.col("price_value").cast("string"), F.lit("")).alias("price_usd"), *R.RIGHT_KEYS)


@query
def j16_merge_changes(spark, sf):
    ok = cs.checked(entries(spark, sf)).where("size(errors) = 0")
    return cs.merge(collected(spark, sf), ok).select(
        *L, "k", "outcome", "brand_name", F.col("own_price").cast("double").alias("own_price"), "new_unit")


@query
def w15_step_prices(spark, sf):
    ok = cs.checked(entries(spark, sf)).where("size(errors) = 0")
    df = cs.merge(collected(spark, sf), ok).where("outcome not in ('removed', 'nothing')")
    return cs.resolve_steps(df).select(*L, "k", "place", F.col("price").cast("double").alias("price"))


@query
def j17_import_store(spark, sf):
    """Import of new entries into the stored ones, by the six-part package key."""
    df = cs.checked(entries(spark, sf)).select(*L, "k", "action", "note", "line")
    store, rows = df.where("season = 'Summer'"), df.where("cabin = 'Economy'").withColumn("note", F.lit("new"))
    return cs.upsert_store(store, rows, L + ["k"]).groupBy("carrier", "season", "cabin", "note").agg(F.count("*").alias("n"))


@query
def j18_inherit_rights(spark, sf):
    ok = cs.checked(entries(spark, sf)).where("size(errors) = 0")
    # Equal places are lines of one order, which all its itineraries have; only without a place does the itinerary decide.
    first_flight = F.min(F.when(F.col("screen_order").isNull(), F.col("flight_id"))).alias("flight_id")
    lines = bridge.kept_lines(bridge.with_itinerary(bridge.stating_lines(spark, sf)), ["carrier", "raw_brand_name"], False, first_flight)
    first = bridge.statements(lines).withColumn("k", names.match_key(F.col("raw_brand_name"))) \
        .groupBy("carrier", "k", "right_key").agg(F.min(F.struct("pos", "flight_id", "status", "raw_value")).alias("b"))
    title = F.element_at(names.literal_map(R.RIGHT_TITLES.items()), F.col("right_key"))
    data = first.select("carrier", "k", title.alias("title"), rightfn.cell_text(F.col("b.status"), F.col("b.raw_value")).alias("cell"))
    out = cs.inherit_rights(cs.long_rights(ok), data)
    return out.groupBy("carrier", "title", "origin_of_cell").agg(F.count("*").alias("n"), F.max("resolved").alias("last_cell"))


@query
def j27_overlay_one_unit(spark, sf, unit=("TK", "IST", "AMS", "Summer")):
    """Pending entries over one unit, as the editor shows it."""
    def only(df):
        for c, v in zip(U, unit):
            df = df.where(F.col(c) == v)
        return df
    ok = only(cs.checked(entries(spark, sf)).where("size(errors) = 0"))
    df = cs.merge(only(collected(spark, sf)), ok).where("outcome not in ('removed', 'nothing')")
    return cs.resolve_steps(df).select("cabin", "place", "brand_name", "outcome", F.col("price").cast("double").alias("price"))
