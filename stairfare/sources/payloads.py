"""Search payloads of the three sources: explicit schemas and their flattening."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import money, names, rights as rightfn
from ..operators import ladder
from ..rules import rights as R

ITEM = "struct<name: string, description: string, attributes: struct<is_available: boolean, display_text: string, piece: int, allowance: string, tooltip: struct<text: string>>>"
PACKAGE = f"struct<raw_name: string, name: string, total_price: double, price: double, currency: string, automation_key: string, id: string, items: array<{ITEM}>>"
SEGMENT = "struct<marketing_airline: string, airline: string, operating_airline: string, flight_number: string, class: string, warnings: struct<is_code_shared_flight: boolean>>"
MARKET = f"""flights struct<departure: array<struct<price: struct<total: double, base: double>, infos: struct<is_virtual_interlining: boolean>,
 segments: array<{SEGMENT}>, provider_packages: array<{PACKAGE}>>>>, currency_rates struct<TRY: struct<Rates: struct<USD: double>>>"""

ARGS = "struct<kilo: int, piece: int, amount: double, currency: string, percentage: string>"
AIR_RIGHT = f"struct<rightType: string, hasRight: boolean, withCharge: boolean, rightStatus: string, args: {ARGS}>"
AIR_BRAND = f"struct<brandCode: string, brandCodeList: array<string>, grandTotalFare: struct<amount: double, currencyCode: string, currencySign: string>, brandRightList: array<{AIR_RIGHT}>>"
AIRLINE = f"""data struct<originDestinationInformationList: array<struct<soldOutAllFlights: boolean, originDestinationOptionList:
 array<struct<fareCategory: map<string, struct<bookingPriceInfoList: array<{AIR_BRAND}>>>>>>>>"""
AIRLINE_CABINS = {"ECONOMY": "Economy", "PREMIUM": "Premium Economy", "BUSINESS": "Business", "FIRST": "First"}

SEARCH = """carrier string, fare_iata string, operating string, direct boolean, baseText string,
 brands array<struct<name: string, ffcode: string, cabin: string, priceText: string, lis: array<string>>>"""


def largest_body(df: DataFrame, keys, body="body") -> DataFrame:
    """Of several responses to one search the longest text."""
    return ladder.first_rows(df, keys, [F.length(body).desc(), F.col(body)])


def market_packages(df: DataFrame, body="body") -> DataFrame:
    """Marketplace search -> one row per package, in USD at the payload's own rate."""
    p = df.withColumn("p", F.from_json(body, MARKET))
    fl = p.select("*", F.explode("p.flights.departure").alias("f")).withColumn(
        "rate", F.col("p.currency_rates.TRY.Rates.USD").cast("decimal(10,6)")).drop("p", body)
    pk = fl.select("*", F.posexplode("f.provider_packages").alias("screen_order", "pk"))
    dec = lambda c: F.col(c).cast("decimal(14,2)")
    base = F.coalesce(F.when(dec("f.price.total") != 0, dec("f.price.total")), dec("f.price.base"))
    delta = F.coalesce(dec("pk.total_price"), dec("pk.price"))
    absolute = F.when(delta.isNotNull(), F.coalesce((base + delta).cast("decimal(14,2)"), delta))
    return pk.withColumns({
        "marketing": F.get("f.segments", F.lit(0)).marketing_airline,
        "raw_brand_name": F.coalesce("pk.raw_name", "pk.name", F.concat(F.lit("Fare "), (F.col("screen_order") + 1).cast("string"))),
        "price_value": money.to_usd(absolute, F.col("pk.currency"), F.col("rate")),
        "fare_family_code": F.coalesce("pk.automation_key", "pk.id"), "items": F.col("pk.items")}).drop("f", "pk", "rate")


def tallied_items(packages: DataFrame, keys) -> DataFrame:
    """Every item of the packages counted: one row per ``keys`` and different item, with the packages' prices summed.

    ``market_rights`` judges an item by what it says alone, so it reads each wording once.
    """
    it = packages.select(*keys, "price_value", F.explode("items").alias("item"))
    return it.groupBy(*keys, "item").agg(F.count("*").alias("n"), F.sum("price_value").alias("total")) \
        .select(*keys, "n", "total", F.array("item").alias("items"))


def market_rights(packages: DataFrame) -> DataFrame:
    """Items of marketplace packages as rights, miles or description."""
    it = packages.select("*", F.explode("items").alias("i")).drop("items")
    name = F.lower(F.coalesce("i.name", F.lit("")))
    at = "i.attributes"
    text = F.coalesce("i.description", f"{at}.display_text", F.lit(""))
    tip = F.coalesce(f"{at}.tooltip.text", F.lit(""))
    key = F.element_at(names.literal_map(R.ITEM_CODES), name)
    kind = F.when(name.isin(R.MILES_ITEMS), "miles").when(key.isNotNull(), "right").otherwise("description")
    detail = F.when(key.isin(R.BAGGAGE_KEYS), rightfn.baggage_text(F.col(f"{at}.piece"), F.col(f"{at}.allowance"), text)).otherwise(text)
    full = F.when(tip.rlike(r"\d") & ~detail.contains(tip), F.concat_ws(" — ", F.when(detail != "", detail), tip)).otherwise(detail)
    return it.withColumns({
        "kind": kind, "right_key": key,
        "status": F.when(kind == "right", rightfn.item_status(F.col(f"{at}.is_available"), text, F.col(f"{at}.display_text"), tip)),
        "raw_value": full}).drop("i")


def airline_ladders(df: DataFrame, keys, body="body") -> DataFrame:
    """Airline availability -> the fullest outbound ladder per key and cabin; sold out drops."""
    p = df.withColumn("out", F.get(F.from_json(body, AIRLINE).data.originDestinationInformationList, F.lit(0))).drop(body)
    p = p.where(~F.coalesce("out.soldOutAllFlights", F.lit(False)))
    opt = p.select("*", F.explode("out.originDestinationOptionList").alias("opt"))
    cat = opt.select("*", F.explode("opt.fareCategory").alias("cabin_key", "cat")).drop("out", "opt")
    cabin = F.element_at(names.literal_map(AIRLINE_CABINS.items()), F.col("cabin_key"))
    cat = cat.withColumn("cabin", cabin).where("cabin is not null").withColumn("brands", F.col("cat.bookingPriceInfoList")).drop("cat")
    return ladder.first_rows(cat, [*keys, "cabin"], [F.size("brands").desc(), F.col("offer_no")])


def _airline_value(r: Column) -> Column:
    a = r["args"]
    return rightfn.flagged_value(a["kilo"], a["piece"], a["amount"], a["currency"], a["percentage"], r["rightStatus"])


def airline_rights(ladders: DataFrame) -> DataFrame:
    """Rights of airline brands with status and value."""
    b = ladders.select("*", F.posexplode("brands").alias("screen_order", "b")).drop("brands")
    r = b.select("*", F.explode("b.brandRightList").alias("r"))
    return r.withColumns({
        "right_key": F.element_at(names.literal_map(R.AIRLINE_RIGHT_TYPES), F.col("r.rightType")),
        "is_miles": F.col("r.rightType").isin(R.AIRLINE_MILE_TYPES),
        "status": rightfn.flagged_status(F.col("r.hasRight"), F.col("r.withCharge"), F.col("r.rightStatus")),
        "raw_value": _airline_value(F.col("r"))}).drop("b", "r")


def airline_brands(ladders: DataFrame) -> DataFrame:
    """Brands of airline ladders: name, code, price, miles and description.

    A bare code has its own name, a brand without a code that of its cabin and place.  Of several mile rights the last
    says whether miles are earned, the last percentage is the bonus; without a mile right nothing is known.  The
    description lists what the right taxonomy has no place for, and the baggage.
    """
    b = ladders.select("*", F.posexplode("brands").alias("screen_order", "b")).drop("brands")
    some = lambda c: F.when(c != "", c)
    code = F.coalesce(some(F.col("b.brandCode")), F.get("b.brandCodeList", F.lit(0)))
    known = names.literal_map(R.AIRLINE_BRAND_NAMES.items())
    name = F.coalesce(F.element_at(known, code), some(code), F.concat(F.col("cabin"), F.lit(" #"), F.col("screen_order").cast("string")))
    rights = F.coalesce("b.brandRightList", F.array().cast(f"array<{AIR_RIGHT}>"))
    miles = F.filter(rights, lambda r: r["rightType"].isin(R.AIRLINE_MILE_TYPES))
    shares = F.filter(F.transform(miles, lambda r: r["args"]["percentage"]), lambda x: x.isNotNull())
    keys = names.literal_map(R.AIRLINE_RIGHT_TYPES)

    def bit(r):
        key, value = some(F.coalesce(F.element_at(keys, r["rightType"]), F.lit(""))), _airline_value(r)
        label = F.when(key.isNull(), r["rightType"]).when(key.isin("checked_baggage", "cabin_baggage"), F.replace(key, F.lit("_"), F.lit(" ")))
        return F.when(~r["rightType"].isin(R.AIRLINE_MILE_TYPES) & (value != "") & label.isNotNull(), F.concat(label, F.lit(": "), value))
    return b.withColumns({
        "raw_brand_name": name, "fare_family_code": code, "price_value": F.col("b.grandTotalFare.amount").cast("decimal(14,2)"),
        "mileage_available": F.when(F.size(miles) > 0, F.coalesce(F.element_at(miles, -1)["hasRight"], F.lit(False))),
        "bonus_percent": F.try_element_at(shares, F.lit(-1)).try_cast("double"),
        "description": F.array_join(F.array_compact(F.transform(rights, bit)), "; ")}).drop("b")


def search_boxes(df: DataFrame, requested: Column, body="body") -> DataFrame:
    """Search page -> one row per brand box: own cabin, absolute price, rule lines.

    The base fare is read once a page, before the boxes are unfolded.
    """
    p = df.withColumn("p", F.from_json(body, SEARCH)).drop(body).withColumn("base", money.parse_price(money.join_split_cents(F.col("p.baseText"))))
    b = p.select("*", F.posexplode("p.brands").alias("screen_order", "b"))
    base, delta = F.col("base"), money.parse_price(money.join_split_cents(F.col("b.priceText")))
    carrier = F.upper("p.carrier")
    tabled, _ = names.family_override(carrier, F.col("b.ffcode"), F.lit(""))
    name = F.coalesce(tabled, F.when(F.col("b.name") != "", F.col("b.name")), F.col("b.ffcode"))
    return b.select(
        *[c for c in df.columns if c != body], "screen_order", carrier.alias("row_carrier"),
        name.alias("raw_brand_name"), F.col("b.cabin").alias("box_cabin"), requested.alias("requested"),
        F.col("b.ffcode").alias("fare_family_code"), tabled.isNotNull().alias("tabled"),
        money.absolute_of(base["value"], delta["value"]).alias("price_value"),
        F.coalesce(delta["currency"], base["currency"]).alias("currency"), F.col("b.lis").alias("lines"))
