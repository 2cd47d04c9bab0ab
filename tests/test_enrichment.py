"""Filling rights and miles from the matching family of another ladder."""

from decimal import Decimal

from stairfare.operators import matching

KEY = ["unit"]


def ladders(spark, rows):
    df = spark.createDataFrame([(u, n, Decimal(p) if p is not None else None, i) for i, (u, n, p) in enumerate(rows)],
                               "unit string, raw_brand_name string, price_value decimal(14,2), screen_order long")
    return df


def aligned(spark, own, other):
    lists = matching.family_lists(ladders(spark, own), KEY, "mine").join(matching.family_lists(ladders(spark, other), KEY, "theirs"), KEY)
    return matching.aligned_names(lists, KEY)


def rights(spark, rows):
    return spark.createDataFrame(rows, "unit string, raw_brand_name string, right_key string, status string, raw_value string")


OWN = [("a", "Light", 100), ("a", "Eco Flex", 200)]
OTHER = [("a", "ECOFLEX", 210), ("a", "Sky Saver", 90), ("a", "Prime", 900)]


def test_a_family_fills_the_one_spelt_otherwise(spark):
    pairs = aligned(spark, OWN, OTHER)
    own = rights(spark, [("a", "Eco Flex", "meal", "Paid", "own"), ("a", "Eco Flex", "refund", "Unknown", "kept"), ("a", "Light", "meal", "Unknown", "")])
    other = rights(spark, [("a", "ECOFLEX", "meal", "Included", "x"), ("a", "ECOFLEX", "refund", "Paid", ""), ("a", "ECOFLEX", "lounge_access", "Included", "y"),
                           ("a", "ECOFLEX", "extra_baggage", "Unknown", "z"), ("a", "Prime", "meal", "Included", "")])
    out = matching.fill_rights(own, matching.under_own_name(other, pairs, KEY), KEY + ["raw_brand_name"])
    got = {(r.raw_brand_name, r.right_key): (r.status, r.raw_value, r.filled) for r in out.collect()}
    assert got == {("Eco Flex", "meal"): ("Paid", "own", False), ("Eco Flex", "refund"): ("Paid", "kept", True),
                   ("Eco Flex", "lounge_access"): ("Included", "y", True), ("Light", "meal"): ("Unknown", "", False)}


def test_miles_are_taken_whole_and_only_where_nothing_is_said(spark):
    schema = "unit string, raw_brand_name string, mileage_available boolean, miles_earned double, bonus_percent double"
    own = spark.createDataFrame([("a", "Eco Flex", None, None, 25.0), ("a", "Light", False, None, None)], schema)
    other = spark.createDataFrame([("a", "ECOFLEX", True, 500.0, None), ("a", "LIGHT", True, 9.0, None), ("a", "Prime", True, 1.0, None)], schema)
    pairs = aligned(spark, OWN, OTHER + [("a", "LIGHT", 1)])
    out = matching.fill_miles(own, matching.under_own_name(other, pairs, KEY), KEY + ["raw_brand_name"])
    assert {r.raw_brand_name: (r.mileage_available, r.miles_earned, r.bonus_percent, r.filled) for r in out.collect()} == {
        "Eco Flex": (True, 500.0, None, True), "Light": (False, None, None, False)}


def test_equal_ladders_pair_the_rest_by_price_and_no_family_twice(spark):
    pairs = aligned(spark, [("a", "Light", 100), ("a", "Classic", None), ("a", "Flex", 200)], [("a", "Saver", 90), ("a", "FLEX", 300), ("a", "Standard", 120)])
    assert {r.raw_brand_name: r.other_name for r in pairs.collect()} == {"Flex": "FLEX", "Light": "Saver"}
    assert aligned(spark, OWN, [("b", "Light", 1)]).count() == 0
