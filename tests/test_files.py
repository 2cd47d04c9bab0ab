"""Payload queries on small literal cards."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from stairfare.catalog import files
from stairfare.plans import archive, feed


def test_search_page_keeps_unpriced_cards_and_judges_by_the_searched_cabin(spark, monkeypatch):
    cards = spark.createDataFrame(
        [(1, "Summer", "Economy", "XX", "Light", "", Decimal("10.00"), 1), (1, "Summer", "Economy", "XX", "Flex", "", None, 2),
         (1, "Summer", "Business", "XX", "Economy Saver", "", Decimal("20.00"), 3)],
        "flight_id long, season string, group_cabin string, carrier string, raw_brand_name string, fare_family_code string, price_value decimal(14,2), screen_order long")
    lines = cards.selectExpr("flight_id", "season", "group_cabin", "raw_brand_name", "'Food Menu' AS line")
    monkeypatch.setattr(files.bridge, "cards", lambda *_: cards)
    monkeypatch.setattr(files.bridge, "rule_lines", lambda *_: lines)
    got = {r.raw_brand_name: (r.currency, r.n, r.total) for r in files.s20_search_page_json(spark, "").collect()}
    assert got == {"Light": ("USD", 1, 329.08), "Flex": ("USD", 1, 319.08)}  # an economy box in a business search is noise


def test_feed_is_one_document_without_features_nobody_states(spark, tmp_path):
    feature = "map<string,struct<state:string,detail:string>>"
    fares = spark.createDataFrame(
        [("TK", "IST", f"A{i:02d}", "Summer" if i % 3 else "Winter", "2026-01", i, {"meal": ("Included", "a,\"ü\""), "lounge": (None, "")} if i % 2 else {"lounge": (None, "")})
         for i in range(30)], f"airline string, origin string, destination string, coll_season string, coll_date string, price long, features {feature}")
    pruned = feed.prune_features(fares)
    runs = feed.run_rows(pruned, "v1", "2026-01-15T00:00:00")
    feed.write_feed(pruned, runs, str(tmp_path / "feed"), "2026-01-15T00:00:00", ["destination"])
    text = "".join(f.read_text() for part in feed.PARTS for f in sorted((tmp_path / "feed" / part).glob("*.txt")))
    document = json.loads(text)
    assert (document["generated_at"], document["count"], len(document["fares"])) == ("2026-01-15T00:00:00", 30, 30)
    assert [f["destination"] for f in document["fares"]] == [f"A{i:02d}" for i in range(30)]
    assert {k for f in document["fares"] for k in f["features"]} == {"meal"} and document["fares"][1]["features"]["meal"]["detail"] == "a,\"ü\""
    assert [(r["run_id"], r["record_count"], r["airlines"], len(r["onds"])) for r in document["runs"]] == [("v1_Summer", 20, ["TK"], 20), ("v1_Winter", 10, ["TK"], 10)]
    head, back, back_runs = feed.read_feed(spark, str(tmp_path / "feed"), pruned.schema, runs.schema)
    assert head.first()["count"] == 30 and sorted(map(str, back.collect())) == sorted(map(str, pruned.collect())) and back_runs.count() == 2


def test_an_empty_feed_is_a_document_too(spark, tmp_path):
    fares = spark.createDataFrame([], "airline string, origin string, destination string, coll_season string, coll_date string, features map<string,struct<state:string,detail:string>>")
    feed.write_feed(feed.prune_features(fares), feed.run_rows(fares, "v1", "t"), str(tmp_path / "feed"), "t", ["airline"])
    text = "".join(f.read_text() for part in feed.PARTS for f in sorted((tmp_path / "feed" / part).glob("*.txt")))
    assert json.loads(text) == {"generated_at": "t", "count": 0, "fares": [], "runs": []}


def test_a_day_written_again_replaces_its_own_rows_only(spark, tmp_path):
    rows = lambda price, *days: spark.createDataFrame([("TK", d, price) for d in days], "carrier string, coll_date string, price long") \
        .withColumn("coll_date", F.to_date("coll_date"))
    path, both = str(tmp_path / "archive"), rows(1, "2026-01-15", "2026-01-16")
    archive.replace_days(both, path)
    read = lambda **days: sorted((str(r.coll_date), r.price) for r in archive.read_days(spark, path, both.schema, **days).collect())
    for _ in range(2):
        archive.replace_days(rows(2, "2026-01-16"), path)
        assert read() == [("2026-01-15", 1), ("2026-01-16", 2)]
    assert read(first="2026-01-16") == [("2026-01-16", 2)] and read(last="2026-01-15") == [("2026-01-15", 1)]


def test_marketplace_responses_from_one_cut(spark, tmp_path):
    """Every response has the packages of its cards with all their merged rights; lines are dealt twice, responses never."""
    from stairfare.operators import matching
    from stairfare.sources import bridge
    from tests.test_plans import odd_tables
    sf, key = odd_tables(spark, tmp_path), bridge.FLIGHT + ["raw_brand_name"]
    bodies = files.market_bodies(spark, sf)
    tree = bodies._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in tree[:tree.index("Generate explode")] and tree.count("Exchange hashpartitioning(flight_id") == 2
    want = {}
    cards = {tuple(r[k] for k in key): r for r in bridge.cards(spark, sf).collect() if None not in [r[k] for k in key]}
    for r in matching.merged_rights(bridge.rights(spark, sf), key).collect():
        if (k := tuple(r[x] for x in key)) in cards:
            want.setdefault(k, []).append((r.right_key, r.raw_value, r.status != "Not Included", "23" if r.status == "Paid" else None))
    got, rows = {}, bodies.collect()
    for r in rows:
        packs = json.loads(r.body)["flights"]["departure"][0]["provider_packages"]
        places = [cards[(r.flight_id, r.season, r.group_cabin, p["raw_name"])].screen_order or 0 for p in packs]
        assert places == sorted(places)
        for p in packs:
            card = cards[k := (r.flight_id, r.season, r.group_cabin, p["raw_name"])]
            assert p.get("automation_key") == card.fare_family_code
            assert p.get("total_price") == (None if card.price_value is None else float(card.price_value))
            got[k] = [(i["name"], i.get("description"), i["attributes"]["is_available"], i["attributes"].get("allowance")) for i in p["items"]]
    assert len(rows) == len({k[:3] for k in cards}) and got == {k: sorted(v, key=lambda x: x[0]) for k, v in want.items()}


def test_marketplace_items_are_judged_once_a_wording(spark, tmp_path, monkeypatch):
    """Items that say the same are counted before they are judged; counts, sums and last values are those of judging each item."""
    from stairfare.sources import payloads
    from tests.test_plans import odd_tables
    sf, judge, asked = odd_tables(spark, tmp_path), payloads.market_rights, []
    packages = payloads.market_packages(files.market_bodies(spark, sf))
    key = ["marketing", "raw_brand_name", "kind", "right_key", "status"]
    each = judge(packages).groupBy(*key).agg(F.count("*").alias("n"), F.sum("price_value").cast("double").alias("total"), F.max("raw_value").alias("last_value"))
    monkeypatch.setattr(payloads, "market_rights", lambda df: asked.append(df) or judge(df))
    of = lambda df: sorted(map(str, df.collect()))
    assert of(files.s18_marketplace_json(spark, sf)) == of(each)
    items = lambda df: df.select("marketing", "raw_brand_name", F.explode("items").alias("i"))
    assert items(asked[0]).count() == items(packages).distinct().count() < items(packages).count()


def test_rule_lines_of_a_box_are_dealt_once(spark, tmp_path):
    """Panel lines are made distinct and listed in one grouping, and each page's base fare is read before its boxes are unfolded."""
    from tests.test_plans import odd_tables
    tree = files.s20_search_page_json(spark, odd_tables(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert ", line" not in "".join(x for x in tree.splitlines() if "Exchange hashpartitioning(flight_id" in x)
    page = spark.createDataFrame([('{"carrier":"xx","baseText":"319 .08 USD","brands":[{"name":"Light","priceText":"+ 10.00 USD"},{"name":"Flex"}]}',)], "body string")
    from stairfare.sources import payloads
    boxes = payloads.search_boxes(page, F.lit("Economy"))
    assert [(r.raw_brand_name, r.price_value, r.currency) for r in boxes.collect()] == [("Light", Decimal("329.08"), "USD"), ("Flex", Decimal("319.08"), "USD")]
    tree = boxes._jdf.queryExecution().optimizedPlan().toString()
    assert "baseText" not in tree[:tree.index("Generate posexplode")]
