"""Places in a global order, adapters, the gate, evidence of successful records, airline brands, penalties."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stairfare.functions import generators, rights as rightfn
from stairfare.operators import consensus, ladder, quality, selection
from stairfare.operators.ranking import numbered
from stairfare.sources import adapters, payloads


def test_places_in_a_global_order_need_no_task_with_all_rows(spark, capsys):
    df = spark.range(0, 5_000, 1, 7).select(F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v"), "id")
    placed, total = numbered(df, [F.col("v").desc(), "id"])
    got = [(r.v, r.id, r.place) for r in placed.collect()]
    want = sorted(((r.v, r.id) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    assert total == 5_000 and sorted(got, key=lambda x: x[2]) == [(v, i, n + 1) for n, (v, i) in enumerate(want)]
    placed.explain()
    assert "SinglePartition" not in capsys.readouterr().out
    none, zero = numbered(df.limit(0), ["id"])
    assert none.count() == zero == 0


def test_halves_of_an_odd_number_of_routes(spark):
    df = spark.createDataFrame([("A", "X"), ("B", "X"), ("A", "Z"), ("A", "X"), ("C", "Y"), (None, "Y")], "origin string, destination string")
    got = {(r.origin, r.destination): r.half for r in selection.split_in_halves(df).collect()}
    assert got == {(None, "Y"): "A", ("A", "X"): "A", ("A", "Z"): "B", ("B", "X"): "B", ("C", "Y"): "B"}


def test_adapters_lose_no_row(spark, monkeypatch):
    rows = [("direct", "TK", "1.00", "USD"), ("direct", "ZZ", "2.00", "USD"), ("market", "ZZ", "100.00", "TRY"), ("search", "TK", None, "USD"), ("other", "TK", "3.00", "USD"), (None, "TK", "4.00", "USD")]
    df = spark.createDataFrame([(s, c, Decimal(p) if p else None, u) for s, c, p, u in rows], "source string, carrier string, price_value decimal(14,2), currency string")
    got = sorted(((r.source, r.carrier, str(r.price_value), r.currency, r.priority, r.served) for r in adapters.normalized(df).collect()), key=str)
    assert got == sorted([("direct", "TK", "1.00", "USD", 1, True), ("direct", "ZZ", "2.00", "USD", 1, False), ("market", "ZZ", "2.43", "USD", 2, True),
                          ("search", "TK", "None", "USD", 3, False), ("other", "TK", "3.00", "USD", None, False), (None, "TK", "4.00", "USD", None, False)], key=str)
    monkeypatch.setitem(adapters.REGISTRY, "other", (9, None, lambda: {"currency": F.lit("EUR")}))
    assert {(r.priority, r.currency) for r in adapters.normalized(df).where("source = 'other'").collect()} == {(9, "EUR")}


@pytest.mark.parametrize("verdicts, names, shut", [([("OK", 3)], 0, False), ([("OK", 3), ("NAME_MISMATCH", 1)], 0, True), ([("OK", 3)], 2, True), ([], 0, False)])
def test_the_gate_is_shut_by_mismatches_and_by_suspicious_names(spark, verdicts, names, shut):
    out = quality.gate(spark.createDataFrame(verdicts, "check string, found long"), spark.createDataFrame([(names,)], "found long"))
    got = {r.check: (r.found, r.blocks) for r in out.collect()}
    assert got["gate"] == (sum(n for _, n in verdicts), shut) and got["suspicious_names"] == (names, names > 0)


def test_the_ladder_of_a_failed_record_changes_no_order(spark):
    unit = "carrier string, origin string, destination string, season string, pass_no int, cabin string, pretty_name string, abs_price decimal(14,2), slot int"
    rows = [("TK", "IST", "JFK", s, p, "Economy", n, Decimal(x), i) for s, p, ladder_ in (("Summer", 0, [("Flex", 268), ("Light", 270)]), ("Winter", 1, [("Light", 270), ("Flex", 325)]))
            for i, (n, x) in enumerate(ladder_)]
    published = spark.createDataFrame(rows, unit)
    good = published.select("carrier", "origin", "destination", "season", "pass_no").distinct()
    both = consensus.pair_preferences(consensus.season_evidence(published, good))
    assert [(r.first_key, r.second_key) for r in both.collect()] == [("light", "flex")]
    for failed in ("Summer", "Winter"):
        assert consensus.pair_preferences(consensus.season_evidence(published, good.where(F.col("season") != failed))).count() == 0


def test_airline_brands_have_names_miles_and_descriptions(spark):
    right = lambda kind, has=True, **args: {"rightType": kind, "hasRight": has, "withCharge": False, "rightStatus": "ALLOWED", "args": args}
    brands = [{"brandCode": "GN", "grandTotalFare": {"amount": 99.5}, "brandRightList": [right("CHECKED_BAGGAGE", kilo=23, piece=1), right("MILE", True), right("BONUS_MILE", False, percentage=25)]},
              {"brandCode": "", "brandCodeList": ["CL"], "brandRightList": [right("SOMETHING_NEW", kilo=5)]},
              {"brandRightList": None}, {"brandCode": "XY", "brandRightList": [right("MILE", None, percentage="x")]}]
    body = json.dumps({"data": {"originDestinationInformationList": [{"originDestinationOptionList": [{"fareCategory": {"ECONOMY": {"bookingPriceInfoList": brands}}}]}]}})
    df = spark.createDataFrame([("u", 1, body)], "unit string, offer_no long, body string")
    got = payloads.airline_brands(payloads.airline_ladders(df, ["unit"])).orderBy("screen_order").collect()
    assert [(r.raw_brand_name, r.fare_family_code, r.mileage_available, r.bonus_percent, r.description) for r in got] == [
        ("FlexFly", "GN", False, 25.0, "checked baggage: 23 KG x 1 PC"), ("EcoFly", "CL", None, None, "SOMETHING_NEW: 5 KG"),
        ("Economy #2", None, None, None, ""), ("XY", "XY", False, None, "")]


def test_description_parts(column):
    assert column(["a; b;;  ; c", "", None, ";", "one"], ladder.description_parts) == [3, 0, 0, 0, 1]


def test_number_facts(column):
    facts = lambda c: F.transform(generators.number_facts(c), lambda x: F.concat_ws(":", x["fact"], x["value"]))
    assert column(["Baggage: 2 x 23 KG", "%25 Ekstra Mil", "no number", None, "Ücret 7"], facts) == [["baggage:2", "x:23"], [":25"], [], [], ["ücret:7"]]


def test_percentages_keep_their_wording(spark):
    df = spark.createDataFrame([("25",), ("12.5",), ("0",), ("",), (None,), ("x",)], "p string")
    none = F.lit(None).cast("int")
    got = [r.v for r in df.select(rightfn.flagged_value(none, none, none, F.lit(None).cast("string"), F.col("p"), F.lit("ALLOWED")).alias("v")).collect()]
    assert got == ["25%", "12.5%", "ALLOWED", "ALLOWED", "ALLOWED", "ALLOWED"]


@pytest.mark.parametrize("line, facts", [
    ("Change: before departure 5 USD, after departure 1,045 USD", [("date_change", "before", "5"), ("date_change", "after", "1045")]),
    ("Before departure: change 5 USD / refund not permitted", [("date_change", "before", "5"), ("refund", "before", "Not Included")]),
    ("Refund before departure free / after departure not allowed; change 5 EUR", [("refund", "before", "Included"), ("refund", "after", "Not Included"), ("date_change", "before", "5"), ("date_change", "after", "5")]),
    ("Non refundable; change free before departure, after 5", [("refund", "before", "Not Included"), ("refund", "after", "Not Included"), ("date_change", "before", "Included"), ("date_change", "after", "5")]),
    ("Meal included; lounge 5", []), ("", []), (None, [])])
def test_penalties_depend_on_what_was_said_before(line, facts):
    assert generators.penalties(line) == facts
