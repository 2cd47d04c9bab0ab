"""Physical plans: hot keys are cut before the shuffle, nothing is crossed, scans are narrow."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stairfare.operators import ladder, matching, quality
from tests.conftest import dec

SF = "/root/testdata/sf0.001"
NAMES = ["a22_transition_fee", "w6_unique_published_names", "j10_season_pair_preferences", "w13_side_pick", "j7_fill_rights_across_flights",
         "j14_opportunistic_units", "j20_airline_code", "j25_lead_time_bands", "p4_markets_all_segments", "a13_right_coverage"]


def plan_of(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")
@pytest.mark.parametrize("name", NAMES)
def test_no_cross_or_loop_join(spark, capsys, name):
    text = plan_of(entry.queries()[name](spark, SF), capsys)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")
def test_scans_read_needed_columns_only(spark, capsys):
    text = plan_of(entry.queries()["a22_transition_fee"](spark, SF), capsys)
    read = re.findall(r"ReadSchema: struct<([^>]*)", text)
    assert not any("l_comment" in r or "o_totalprice" in r for r in read)


def test_choice_is_limited_before_the_shuffle(spark, capsys):
    df = spark.range(1000).withColumn("k", F.col("id") % 3).withColumn("v", F.col("id") % 7)
    text = plan_of(ladder.first_rows(df, ["k"], [F.col("v").desc(), F.col("id")]), capsys)
    assert text.count("WindowGroupLimit") >= 2          # once per task, once after the exchange
    text = plan_of(ladder.first_group(df, ["k"], [F.col("v").desc()]), capsys)
    assert text.count("WindowGroupLimit") >= 2


def test_hot_key_results_stay_whole(spark):
    """A third of all rows under one key: same result as a plain loop over all rows."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("key"),
        (F.col("id") % 16).cast("string").alias("right_key"),
        F.element_at(F.array(*[F.lit(s) for s in ("Included", "Paid", "Not Included", "Unknown")]),
                     (F.col("id") % 4 + 1).cast("int")).alias("status"),
        F.lit("").alias("raw_value"), F.col("id").alias("pos"))
    rank = {"Included": 3, "Paid": 2, "Not Included": 1, "Unknown": 0}
    want = {}
    for i in range(n):
        k = (0 if i % 3 == 0 else i % 500, str(i % 16))
        s = ("Included", "Paid", "Not Included", "Unknown")[i % 4]
        if k not in want or rank[s] >= rank[want[k]]:
            want[k] = s
    got = {(r.key, r.right_key): r.status for r in matching.merged_rights(df, ["key"]).collect()}
    assert got == want


def test_reading_diff_counts_repeats(spark):
    a = spark.createDataFrame([("x", dec(1)), ("x", dec(1)), ("x", dec(1)), ("y", dec(2))], "n string, p decimal(14,2)")
    b = spark.createDataFrame([("x", dec(1)), ("z", dec(3))], "n string, p decimal(14,2)")
    out = sorted((r.n, r.only_in, r.surplus) for r in quality.reading_diff(a, b).collect())
    assert out == [("x", "first", 2), ("y", "first", 1), ("z", "second", 1)]


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    """Two deliveries with a restart between give what one batch over both gives; a start without news changes nothing."""
    import datetime
    from stairfare.streaming import events as ev
    rows = [(i, datetime.datetime(2026, 3, 1, i % 24), i % 4, ("view", "error")[i % 3 == 0], 1.0, f'{{"k": {i}}}') for i in range(40)]
    folder, base = str(tmp_path / "in"), str(tmp_path / "run")

    def run():
        stream = ev.event_stream(spark, folder, name="*.parquet")
        return sorted(map(tuple, ev.run_to_latest(ev.retries(stream), "restart", ["unit"], base=base).collect()))
    spark.createDataFrame(rows[:25], ev.EVENT).write.parquet(folder)
    first = run()
    assert run() == first
    spark.createDataFrame(rows[25:], ev.EVENT).write.mode("append").parquet(folder)
    whole = ev.retries(ev.parsed(spark.createDataFrame(rows, ev.EVENT)))
    assert run() == sorted(map(tuple, whole.collect())) != first


def small_tables(spark, folder):
    """An itinerary with a third of all lines, one order listed twice, lines that come twice, lines without a part."""
    import datetime
    day = datetime.datetime(1995, 6, 1)
    orders = [(i, 7 if i % 3 == 0 else i * 37, day) for i in range(60)] + [(5, 1500, day)]
    lines = [(i % 60, None if i % 41 == 0 else (i * 13) % 90, (i * 5) % 17, i % 7 + 1, float(i % 9 + 1), 10.0 + i, 0.01 * (i % 10), 0.02, "NR"[i % 2], "OF"[i % 2]) for i in range(1500)]
    lines += lines[:300]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("how", [{}, {"later_wins": False}, {"later_wins": False, "drop_unknown": True}])
def test_settled_rights_lose_none_that_prevails(spark, tmp_path, how):
    from stairfare.sources import bridge
    sf, key = small_tables(spark, tmp_path), bridge.FLIGHT + ["raw_brand_name"]
    settled = bridge.settled_rights(spark, sf, how.get("later_wins", True))
    of = lambda df: sorted(map(str, matching.merged_rights(df, key, **how).collect()))
    assert of(settled) == of(bridge.rights(spark, sf))
    whole = bridge.rights(spark, sf).where("flight_id = 7").count()
    assert settled.where("flight_id = 7").count() < whole


def test_statements_are_not_shuffled(spark, tmp_path):
    """Lines are dealt by family before they are unfolded, and a join on the family does not deal what they state again."""
    from stairfare.catalog import choosing, files
    sf = small_tables(spark, tmp_path)
    for df in (choosing.a4_strongest_status(spark, sf), choosing.a5_strongest_known_status(spark, sf)):
        tree = df._jdf.queryExecution().executedPlan().toString()
        above = tree[:tree.index("Generate explode")]
        assert above.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(right_key" in above
    tree = files.record_rows(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(.*\n(?:[^\n]*(?:Project|Sort|Aggregate)[^\n]*\n)*[^\n]*Generate explode", tree)


def test_first_rights_without_a_place(spark, tmp_path):
    """The first statement per carrier, family and right is the same whether equal lines are cut before or not."""
    from stairfare.sources import bridge
    sf = small_tables(spark, tmp_path)
    lines = bridge.with_itinerary(bridge.stating_lines(spark, sf))
    first_flight = F.min(F.when(F.col("screen_order").isNull(), F.col("flight_id"))).alias("flight_id")
    cut = bridge.statements(bridge.kept_lines(lines, ["carrier", "raw_brand_name"], False, first_flight))
    whole = bridge.rights(spark, sf)

    def of(df):
        best = df.groupBy("carrier", "raw_brand_name", "right_key").agg(F.min(F.struct("pos", "flight_id", "status", "raw_value")).alias("b"))
        return sorted(map(str, best.select("carrier", "raw_brand_name", "right_key", "b.status", "b.raw_value").collect()))
    assert of(cut) == of(whole)


def test_card_lines_are_judged_without_patterns(spark):
    """Only lines that may say something are parsed, and which right they name takes no regular expression."""
    from stairfare.functions import cards
    text = "Economy class\nEco Fly\nBaggage\nCarry-on baggage: 1 × 22 lbs\nİptal ücreti: from $30\nAirline miles: at least 1,200\n$120.50"
    df = spark.createDataFrame([(text, "Economy")], "card string, cabin string")
    row = cards.parse_cards(df, "card").collect()[0]
    assert [(r.key, r.status, r.value) for r in row.rights] == [("cabin_baggage", "Included", "1 x 10 KG"), ("refund", "Paid", "$30")]
    assert row.miles_earned == 1200 and row.brand_name == "Eco Fly" and row.price_value == dec("120.50")
    tree = df.select(cards.says_something(F.lower("card")))._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" not in tree


def odd_tables(spark, folder):
    """``small_tables`` with more itineraries a search, and orders and lines without a customer, supplier, price or flag."""
    import datetime
    sf = small_tables(spark, folder)
    orders = [(100 + i, None if i % 17 == 0 else (i % 7) * 7500 + i % 3, datetime.datetime(1995 + i % 3, 1 + i % 12, 1)) for i in range(120)]
    lines = [(100 + i % 120, (i * 13) % 90, None if i % 37 == 0 else (i * 5) % 17, i % 7 + 1, float(i % 9 + 1), None if i % 11 == 0 else 10.0 + i % 50,
              0.01 * (i % 11), 0.02, (None, "N", "R", "R")[i % 4], "O") for i in range(1700)]
    lines += [(100, 5 + i % 3, 2, 5 + i % 2, 3.0 + i, 9.0, 0.0, 0.0, "R", "O") for i in range(3)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.mode("append").parquet(f"{sf}/orders.parquet")
    spark.createDataFrame(lines, spark.read.parquet(f"{sf}/lineitem.parquet").schema).write.mode("append").parquet(f"{sf}/lineitem.parquet")
    return sf


def test_card_prices_are_those_of_the_cards(spark, tmp_path):
    from stairfare.sources import bridge
    sf, columns = odd_tables(spark, tmp_path), [*bridge.FLIGHT, "raw_brand_name", "price_value"]
    prices = bridge.card_prices(spark, sf)
    of = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert of(prices) == of(bridge.cards(spark, sf))
    tree = prices._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in tree and "SortAggregate" not in tree


def test_records_are_made_of_the_chosen_itineraries_only(spark, tmp_path):
    """Records are the same as from all cards and statements; of the other itineraries no line is dealt, sorted or unfolded."""
    from stairfare.catalog import files
    from stairfare.plans import gold
    from stairfare.sources import bridge, records
    sf, key = odd_tables(spark, tmp_path), bridge.FLIGHT + ["raw_brand_name"]
    whole = records.nest(gold.best_results(bridge.cards(spark, sf)), matching.merged_rights(bridge.rights(spark, sf), key))
    of = lambda df: sorted(map(str, df.collect()))
    rows = files.record_rows(spark, sf)
    assert of(rows) == of(whole)
    orders = gold.chosen_orders(spark, sf)
    assert 0 < orders.count() < bridge.order_rows(spark, sf).count() and orders.where("flight_id IS NULL").count()
    tree = rows._jdf.queryExecution().executedPlan().toString()
    assert tree.count("chosen-orders") >= 2 and tree.count("/orders.parquet") == 0


def test_published_fares_and_their_rights_come_from_the_chosen_itineraries(spark, tmp_path):
    from stairfare.catalog import files
    from stairfare.plans import gold
    from stairfare.sources import bridge
    sf, key = odd_tables(spark, tmp_path), bridge.FLIGHT + ["raw_brand_name"]
    of = lambda df: sorted(map(str, df.collect()))
    orders = gold.chosen_orders(spark, sf)
    assert of(gold.strongest_records(gold.best_results(bridge.cards(spark, sf)))) == of(gold.unit_brands(spark, sf, orders).drop("result_no"))
    kept = gold.unit_brands(spark, sf, orders).select(*key).withColumnRenamed("raw_brand_name", "card_name")
    for later in (True, False):
        whole = files.card_rights(spark, sf, later).join(kept, FL := bridge.FLIGHT + ["card_name"], "left_semi")
        assert of(files.card_rights(spark, sf, later, orders).join(kept, FL, "left_semi")) == of(whole)


RECORD_QUERIES = ["s2_read_records", "t1_ingest_records", "s4_flatten_records", "s6_append_units", "s12_concatenate_passes", "s3_tolerant_read",
                  "s7_overlay_rewrite", "s11_feed_envelope"]


def test_record_and_feed_queries_take_whole_lines_of_the_chosen_itineraries_only(spark, tmp_path, monkeypatch):
    """Lines are taken twice, for cards and for statements, both times of the orders chosen before."""
    from stairfare.plans import gold
    from stairfare.sources import bridge
    sf, raw_lines, asked = odd_tables(spark, tmp_path), bridge.raw_lines, []
    chosen = gold.chosen_orders(spark, sf)
    assert 0 < chosen.count() < bridge.order_rows(spark, sf).count()

    class Seen(Exception):
        pass

    def take(*given):
        asked.append(given[2] if len(given) > 2 else None)
        if len(asked) == 2:
            raise Seen
        return raw_lines(*given)
    monkeypatch.setattr(bridge, "raw_lines", take)
    monkeypatch.setattr(gold, "chosen_orders", lambda *_: chosen)
    for name in RECORD_QUERIES:
        asked.clear()
        with pytest.raises(Seen):
            entry.queries()[name](spark, sf)
        assert all(o is chosen for o in asked), name


def test_card_prices_are_cut_as_numbers(spark, tmp_path):
    """Lines are joined, grouped and dealt as numbers only, with one figure that orders as the cards do, to the last digit."""
    import datetime
    from stairfare.sources import bridge
    sf, top, most, key = str(tmp_path), 999999999999.99, 2147483647.0, [*bridge.FLIGHT, "raw_brand_name"]
    flag = lambda d, p: (7 if d else 4, p, "R" if d else "N")
    groups = [[flag(False, top), flag(True, -most)], [flag(False, -top), flag(False, top)], [flag(False, None), flag(True, 1.0)],
              [flag(False, None), flag(False, 5.0)], [flag(True, -most), flag(True, most)], [flag(True, None), flag(True, most)], [flag(True, None)], [flag(False, 0.0)]]
    lines = [(1, g if g < 7 else None, g, ln, p if r == "R" else 1.0, p, 0.0, 0.0, r, "O") for g, rows in enumerate(groups) for ln, p, r in rows]
    lines += [(1, 3, None, 1, 7.0, 7.0, 0.0, 0.0, None, "O"), (1, None, None, 5, 9.0, 9.0, 0.0, 0.0, None, "O")]
    spark.createDataFrame([(1, None, datetime.datetime(1995, 5, 1))], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(f"{sf}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
                          " l_discount double, l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{sf}/lineitem.parquet")
    prices = bridge.card_prices(spark, sf)
    of = lambda df: sorted(map(str, df.select(*key, "price_value").collect()))
    assert of(prices) == of(bridge.cards(spark, sf)) and len(of(prices)) == 10
    tree = prices._jdf.queryExecution().executedPlan().toString()
    dealt = tree[tree.index("HashAggregate"):]
    assert re.search(r"HashAggregate\(keys=\[flight_id#\d+L?, is_summer#\d+, package#\d+L?\], functions=\[min\(cost#\d+\)\]", dealt)


def test_rights_across_flights_come_from_one_cut(spark, tmp_path):
    """Families carry their rights as bits, so orders are the only join and only lines and families are dealt; rows are those of a join."""
    from pyspark.sql import Window
    from stairfare.catalog import choosing
    from stairfare.plans import gold
    from stairfare.sources import bridge
    sf, fl, search = odd_tables(spark, tmp_path), bridge.FLIGHT, choosing.SEARCH
    lists = matching.family_lists(bridge.cards(spark, sf), [*search, "flight_id"], "theirs")
    lists = lists.join(ladder.ladder_quality(bridge.cards(spark, sf), [*search, "flight_id"]), [*search, "flight_id"])
    w = Window.partitionBy(*search).orderBy(*gold.best_first())
    lists = lists.withColumns({"place": F.row_number().over(w), "winner": F.first("flight_id").over(w), "mine": F.first("theirs").over(w)})
    aligned = matching.aligned_names(lists, [*fl, "winner", "place"])
    known = matching.merged_rights(bridge.rights(spark, sf), fl + ["raw_brand_name"]).where("status <> 'Unknown'")
    best = matching.under_own_name(known, aligned, fl).groupBy("winner", "season", "group_cabin", "raw_brand_name", "right_key").agg(F.min(F.struct("place", "status")).alias("b"))
    whole = bridge.with_itinerary(best, "winner", season=False).groupBy("carrier", "right_key", "b.status", (F.col("b.place") > 1).alias("borrowed")).count()
    got = choosing.j7_fill_rights_across_flights(spark, sf)
    tree = got._jdf.queryExecution().executedPlan().toString()
    of = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert of(got) == of(whole) and got.where("borrowed").count()
    assert len(re.findall(r"(?:Hash|Merge|Loop)Join", tree)) == 1 and tree.count("Exchange hashpartitioning") == 3


@pytest.mark.parametrize("said, want", [
    ([], {}), ([("meal", "Unknown"), (None, "Paid"), ("wifi", None)], {}), ([("meal", "Paid"), ("meal", "Not Included"), ("pet", "Included")], {"meal": 2, "pet": 3}),
    ([(k, s) for k in ("cabin_baggage", "pet") for s in ("Included", "Unknown", "Paid")], {"cabin_baggage": 3, "pet": 3})])
def test_packed_rights_hold_the_strongest_statuses(spark, said, want):
    from stairfare.rules.rights import RIGHT_KEYS
    df = spark.createDataFrame(said, "k string, s string").agg(F.bit_or(matching.packed_right(F.col("k"), F.col("s"))).alias("said"))
    row = df.select(*[matching.packed_rank(F.coalesce("said", F.lit(0)), k).alias(k) for k in RIGHT_KEYS]).collect()[0]
    assert {k: row[k] for k in RIGHT_KEYS if row[k]} == want
