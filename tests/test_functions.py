"""Literal cases of the text, price, right and date functions."""

from decimal import Decimal

from pyspark.sql import functions as F

from stairfare.functions import cards, dates, money, names, rights
from stairfare.operators import identity
from stairfare.sources import jobs


def test_match_key_and_subtier(column):
    assert column(["Eco Fly", "ECOFLY", None, "Semi-Flex"], names.match_key) == ["ecofly", "ecofly", "", "semiflex"]
    assert column(["ECO FLY", "Eco Classic", "Semi Flex", "Flexible", "Restricted", "Go Light"], names.detect_subtier) == \
        ["basic", "standard", "semiflex", "flex", None, "lite"]


def test_cabin_words_prefer_premium(column):
    assert column(["PREMECON", "premium ekonomi light", "Economy", "BUSINESS FLEX", "First Suite", "Latitude"],
                  names.detect_cabin) == ["Premium Economy", "Premium Economy", "Economy", "Business", "First", None]


def test_clean_fare_code(column):
    assert column(["CL-f48780cd96ac4e338339d6bb919f4a09", "EF-EF", "EF-PF", None, ""], names.clean_fare_code) == \
        ["CL", "EF", "EF-PF", "", ""]


def test_pretty_names(spark):
    rows = [("TK", "Eco Fly"), ("TK", "BX"), ("LH", "ECONOMY CLASSIC"), ("LH", "FLEXIBLE"), ("BA", "PREMECON"), ("EK", "ECOFLEX"),
            ("ZZ", "Semi-Flex")]
    df = names.with_pretty_name(spark.createDataFrame(rows, "carrier string, raw_brand_name string"))
    got = {(r.carrier, r.raw_brand_name): r.pretty_name for r in df.collect()}
    assert got == {("TK", "Eco Fly"): "EcoFly", ("TK", "BX"): "BX", ("LH", "ECONOMY CLASSIC"): "Economy Classic",
                   ("LH", "FLEXIBLE"): "Flexible", ("BA", "PREMECON"): "PREMECON", ("EK", "ECOFLEX"): "Economy Flex",
                   ("ZZ", "Semi-Flex"): "Semi-Flex"}


def test_effective_cabin(spark):
    rows = [("AC", "PRIME FLY", "PF-PF", "Economy", "Premium Economy"), ("AC", "ECO FLY", "EF-EF", "Economy", "Business"),
            ("BA", "PESEL", None, "Economy", "Premium Economy"), ("BA", "Plus", "PEPRO", "Economy", "Premium Economy"),
            ("LH", "Business Flex", None, "Economy", "Business"), ("LH", "Flex", None, "Economy", "Economy")]
    df = spark.createDataFrame(rows, "c string, n string, f string, g string, want string")
    c = F.col
    eff = names.effective_cabin(c("n"), c("f"), F.lit(None).cast("string"), c("g"), c("c"))
    assert df.where(eff != c("want")).count() == 0


def test_parse_price(column):
    got = column(["230 USD", "+30", "₺16.306,99", "$1,234.56", "1,5 EUR", "1,234", "", "abc TL"], money.parse_price)
    assert [(g.value, g.price_type, g.currency) for g in got] == [
        (Decimal("230.00"), "absolute", "USD"), (Decimal("30.00"), "delta", None), (Decimal("16306.99"), "absolute", "TRY"),
        (Decimal("1234.56"), "absolute", "USD"), (Decimal("1.50"), "absolute", "EUR"), (Decimal("1234.00"), "absolute", None),
        (None, "absolute", None), (None, "absolute", "TRY")]
    assert column(["319 .08 USD"], money.join_split_cents) == ["319.08 USD"]


def test_fee_text(column):
    assert column(["Yakl. 3531.00 TRY (48 saate kadar)", "Change fee: from $180", "3.531,00 TRY", "free", "0 USD"], money.fee_text) == \
        ["~86 USD", "~180 USD", "~86 USD", "", ""]


def test_status_of_text(column):
    assert column(["23 kg for a fee", "not permitted", "change permitted 2+ days", "+25 EUR", "Non-refundable.", "var", "none", "23 kg"],
                  rights.status_of_text) == ["Paid", "Not Included", "Included", "Paid", "Not Included", "Included", "Not Included", "Unknown"]


def test_longest_label_wins(column):
    assert column(["Extra baggage", "no-show refund", "Refund", "Coffee machine", "WiFi onboard"], rights.right_of_label) == \
        ["extra_baggage", "no_show_refund", "refund", None, "wifi"]


def test_baggage_short(column):
    assert column(["1 parça X 8 kg kabin bagajı (55x40x20 cm)", "2 pieces, 8 kg", "23kg", "1 piece", "55x40x20 cm"], rights.baggage_short) == \
        ["1×8kg", "2×8kg", "23kg", "", ""]


def test_rule_lines(column):
    got = column(["Baggage: 1 x 23 KG", "Cabin Baggage: 0 x 8 KG", "Personal item: 1 x 3 kg", "%25 Ekstra Mil", "Earn 1,500 miles",
                  "CANCEL_BEFOREDEPARTURE - Non-refundable.", "PRIORITY_CHECKIN - free", "Food Menu", "Something else"], rights.rule_line)
    assert [(g.kind, g.key, g.status, g.earned, g.bonus) for g in got] == [
        ("right", "checked_baggage", "Included", None, None), ("right", "cabin_baggage", "Not Included", None, None),
        ("ignored", None, None, None, None), ("miles", None, None, None, 25.0), ("miles", None, None, 1500.0, None),
        ("right", "refund", "Not Included", None, None), ("description", None, None, None, None),
        ("right", "meal", "Included", None, None), ("description", None, None, None, None)]


def test_airline_names(column):
    assert column(["SKY express", "Wizz Air Malta", "Wizz Air", "All Nippon Airways", "China", "Aegean Airlines", ""], identity.resolve_airline) == \
        ["GQ", "W4", "W6", "NH", None, "A3", None]


def test_operator_matches(spark):
    rows = [("", "LH", True), ("Aegean Airlines", "LH", False), ("Lufthansa CityLine", "LH", True), ("Blue Sky", "ZZ", True)]
    df = spark.createDataFrame(rows, "op string, t string, want boolean")
    assert df.where(identity.operator_matches(F.col("op"), F.col("t")) != F.col("want")).count() == 0


CARD = """Economy class
Prime Fly
Flexibility
Change fee: from $180
Cancellation fee: from $95
Baggage
Checked baggage: 1 × 50 lbs
Carry-on baggage: 1 × 22 lbs
Other benefits
Meals provided
Seat selection available
Airline miles: at least 3,140
$512"""
CARD_TR = """Ekonomi sınıfı
Prime Fly
Değişiklik ücreti: from $180
İptal ücreti: from $95
Bagaj
Check-in bagajı: 1 × 23 kg
Kabin bagajı hakkı: 1 × 10 kg
Yemek ve içecek sunulur
Koltuk seçimi yapılabilir
Hava yolu şirketi milleri: en az 3.140
$512"""


def test_fare_cards(spark):
    bad = ["Economy class\nBaggage\nChecked baggage: Not included\n$616", "Economy class\nEasyCancel\nFree cancellation\n$688",
           "Economy class\nEco Fly\nOnly for ages 17 - 30\n$540", "Economy class\nRecommended\nBaggage\n$592", "Economy class\n$592\nBaggage\n$592"]
    df = spark.createDataFrame([(t, "Economy") for t in [CARD, CARD_TR, *bad]], "card string, cabin string")
    rows = cards.parse_cards(df).collect()
    assert [(r.brand_name, r.price_value, r.card_cabin, r.miles_earned) for r in rows] == [("Prime Fly", Decimal("512.00"), "Economy", 3140)] * 2
    for r in rows:
        m = {x.key: (x.status, x.value) for x in r.rights}
        assert m["cabin_baggage"] == ("Included", "1 x 10 KG") and m["checked_baggage"] == ("Included", "1 x 23 KG")
        assert m["refund"] == ("Paid", "$95") and m["change"] == ("Paid", "$180")
        assert m["seat_selection"][0] == "Included" and m["meal"][0] == "Included"
    assert column_lbs(spark) == [8, 8, 8, 10, 10, 23, 32, 45]


def test_cards_are_parsed_once_a_wording(spark, tmp_path, monkeypatch):
    """Cards that differ in their price alone are counted before they are parsed; what is published stays the same."""
    from stairfare.catalog import texts
    from tests.test_plans import odd_tables
    parse, asked = cards.parse_cards, []
    made = [CARD, CARD.replace("$512", " $ 1,024.50 "), CARD.replace("Baggage", "Baggage\n\n$7"), CARD.replace("$512", "$1.2.3,4"), CARD.replace("$512", ""), CARD_TR,
            "Economy class\n$592\nBaggage\nCarry-on baggage: Included\n$5", "Economy class\nEco Fly\nOnly for ages 17 - 30\n$540", "", None]
    df = spark.createDataFrame([(t, "Economy", i % 2) for i, t in enumerate(made + made)], "card string, cabin string, z int")

    def of(rows, n, total):
        return sorted((r.card_cabin, r.brand_name, str(r.rights), r.miles_earned, r.n, r.total) for r in rows.groupBy(
            "card_cabin", "brand_name", F.to_json("rights").alias("rights"), "miles_earned").agg(F.sum(n).alias("n"), F.sum(total).alias("total")).collect())
    few = cards.tallied_cards(df)
    assert of(parse(few), "n", "price_total") == of(parse(df), F.lit(1), "price_value") and few.count() < df.distinct().count()
    sf = odd_tables(spark, tmp_path)
    r = parse(texts.card_texts(spark, sf), "card", "group_cabin").select("*", F.explode("rights").alias("r"))
    each = r.groupBy("card_cabin", "brand_name", "r.key", "r.status", "r.value").agg(F.count("*").alias("n"), F.sum("price_value").cast("double").alias("price_total"),
                                                                                     F.sum("miles_earned").cast("bigint").alias("miles_total"))
    monkeypatch.setattr(cards, "parse_cards", lambda df, *more: asked.append(df) or parse(df, *more))
    assert sorted(map(str, texts.f30_fare_cards(spark, sf).collect())) == sorted(map(str, each.collect())) and each.count()
    assert asked[0].groupBy("group_cabin", F.regexp_replace("card", r"[$][\d.,]+$", "")).count().where("count > 1").count() == 0


def column_lbs(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([17, 15, 18, 22, 23, 50, 70, 100])], "i int, x int")
    return [r.y for r in df.select("i", cards.lbs_to_kg(F.col("x")).alias("y")).orderBy("i").collect()]


def test_split_route(column):
    o = column(["LHR-SIN", "lhr/sin", "A_B", "LHR-SIN-JFK", "LHR-"], lambda x: jobs.split_route(x)[0])
    assert o == ["LHR", "LHR", None, None, None]


def test_job_headers(spark):
    df = spark.createDataFrame([(1, "EU", "LHR-SIN", "ba", 9), (2, "EU", "LHR-SIN", "BA", 8), (3, "EU", "", "BA", 7)],
                               "`_c0` int, ORIGIN_REGION string, OND string, CARRIER string, PAX int")
    out = jobs.first_request(jobs.to_jobs(df, "_c0")).collect()
    assert [(r.carrier, r.origin, r.destination, r.raw_row["PAX"]) for r in out] == [("ba", "LHR", "SIN", "9")]


def test_date_plan_stays_in_season(spark):
    units = dates.with_seasons(spark.createDataFrame([("IST", "JFK"), ("LHR", "SIN")], "origin string, destination string"))
    for today in ("2026-01-01", "2026-06-15", "2026-10-30"):
        plan = dates.date_plan(units, F.lit(today).cast("date"), seed=1)
        assert plan.where(~dates.in_season(F.col("departure"), F.col("season"))).count() == 0
        assert plan.where("datediff(return_date, departure) <> 3").count() == 0
        per = plan.groupBy("origin", "destination", "season", "block_no").agg(F.count("*").alias("n"))
        assert per.where("n <> 5").count() == 0
        assert plan.select("origin", "destination", "season").distinct().count() == 4


def test_window_plan_walks_consecutive_days(spark):
    units = dates.with_seasons(spark.createDataFrame([("IST", "JFK")], "origin string, destination string"))
    plan = dates.window_plan(units, F.lit("2026-02-01").cast("date"), seed=3)
    per = plan.groupBy("season").agg(F.count("*").alias("n"), F.date_diff(F.max("departure"), F.min("departure")).alias("span"),
                                     F.min(F.date_diff("departure", F.lit("2026-02-01").cast("date"))).alias("lead"))
    assert all(r.n == 7 and r.span == 6 and r.lead >= 21 for r in per.collect())
    first = plan.where("pos = 0").where(~dates.in_season(F.col("departure"), F.col("season")))
    assert first.count() == 0


def test_unreported_right_columns_drop(spark):
    from stairfare.plans import export
    from stairfare.rules.rights import RIGHT_KEYS
    r = spark.createDataFrame([(1, "meal", "Paid"), (1, "pet", "Unknown"), (2, "wifi", "Included")], "id int, right_key string, status string")
    wide = export.right_columns(r, ["id"])
    assert wide.columns == ["id", *RIGHT_KEYS]
    assert export.drop_unreported(wide).columns == ["id", "meal", "wifi"]


def test_adapters_by_priority(spark):
    from stairfare.sources.adapters import REGISTRY, normalized
    df = spark.createDataFrame([("direct", "TK", "USD", Decimal("1.00")), ("direct", "ZZ", "USD", Decimal("1.00")),
                                ("market", "ZZ", "TRY", Decimal("100.00")), ("search", "ZZ", "USD", None)],
                               "source string, carrier string, currency string, price_value decimal(14,2)")
    rows = normalized(df).collect()
    assert len(rows) == df.count()  # a row that cannot be served is kept and marked
    out = sorted((r.priority, r.carrier, r.currency, r.price_value) for r in rows if r.served)
    assert out == [(1, "TK", "USD", Decimal("1.00")), (2, "ZZ", "USD", Decimal("2.43"))]
    assert [p for p, _, _ in sorted(REGISTRY.values(), key=lambda v: v[0])] == [1, 2, 3]
