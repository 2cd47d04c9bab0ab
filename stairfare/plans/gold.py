"""The published ladder, from collected cards to tier codes."""

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import names
from ..operators import consensus, ladder, quality
from ..sources import bridge
from ..sources.tables import scratch

UNIT = bridge.UNIT
SEARCH = [*UNIT, "pass_no", "group_cabin"]


def best_first():
    """Order of the itineraries of one search: more families, fewer implausible steps, smaller worst step."""
    return [F.col("n_brands").desc(), F.col("bad_steps"), F.col("worst_step"), F.col("flight_id")]


def best_results(cards: DataFrame) -> DataFrame:
    """Per unit, pass and searched cabin the ladder of one itinerary.

    The ladder's figures ride on its own rows, so the choice needs no join back.
    """
    w = Window.partitionBy(*bridge.FLIGHT)
    df = ladder.step_ratio(cards, bridge.FLIGHT)
    worst = F.greatest(F.coalesce(F.max("step_ratio").over(w), F.lit(1.0)), F.lit(1.0))
    df = df.withColumns({
        "n_brands": F.count("*").over(w),
        "bad_steps": F.count(F.when(F.col("step_ratio") > 3.0, 1)).over(w),
        "worst_step": ladder.round_half_up(worst, 3)})
    return ladder.first_group(df, SEARCH, best_first())


def chosen_orders(spark, sf_dir) -> DataFrame:
    """Orders of the itineraries and seasons that ``best_results`` chooses in some cabin.

    Which these are follows from prices alone, so whole cards and statements are made of their lines only.  The
    orders are written once to the shared folder; where they are few, lines join them without a shuffle.
    """
    quality_of = ladder.ladder_quality(bridge.card_prices(spark, sf_dir), ["flight_id", "is_summer", "cabin_no"])
    figures = bridge.with_itinerary(bridge.named_season(quality_of))
    best, o = ladder.first_rows(figures, SEARCH, best_first()).select("flight_id", "season"), bridge.order_rows(spark, sf_dir)
    folder, same = scratch(spark, "chosen-orders"), o.flight_id.eqNullSafe(best.flight_id) & (o.season == best.season)
    o.join(best, same, "left_semi").write.parquet(folder)
    return spark.read.schema(o.schema).parquet(folder)


def chosen_results(spark, sf_dir, orders=None) -> DataFrame:
    """``best_results`` of all cards, made from the cards of the itineraries it chooses (``orders``, if these are known)."""
    return best_results(bridge.cards(spark, sf_dir, chosen_orders(spark, sf_dir) if orders is None else orders))


def strongest_records(results: DataFrame) -> DataFrame:
    """Of several records of one unit the strongest: packages, rights, then the later pass."""
    w = Window.partitionBy(*UNIT, "pass_no")
    df = results.withColumns({"packages": F.count("*").over(w),
                              "right_lines": F.sum("n_rights").over(w)})
    return ladder.first_group(df, UNIT, [
        F.col("packages").desc(), F.col("right_lines").desc(), F.col("pass_no").desc()])


def unit_brands(spark, sf_dir, orders=None) -> DataFrame:
    """Brand rows of the record kept for each unit, ready to rank."""
    df = strongest_records(chosen_results(spark, sf_dir, orders))
    return df.withColumn("result_no", (names.cabin_base(F.col("group_cabin")) / 1000).cast("int"))


def published(spark, sf_dir) -> DataFrame:
    """Published ladders by price order alone."""
    return ladder.publish(unit_brands(spark, sf_dir), UNIT)


def successful_records(spark, sf_dir) -> DataFrame:
    """Unit and pass of records collected without an issue by some attempt; partial ones are not among them."""
    judged = quality.with_completeness(bridge.attempts(spark, sf_dir)).withColumn("final_status", quality.final_status())
    return judged.where("final_status = 'success'").select(*UNIT, "pass_no").distinct()


def order_evidence(spark, sf_dir, brands: DataFrame) -> DataFrame:
    """What the published ladders of successful records say about the order of families."""
    return consensus.season_evidence(ladder.publish(brands, UNIT), successful_records(spark, sf_dir))


def published_with_consensus(spark, sf_dir) -> DataFrame:
    """Published ladders with the order repaired by the other season's evidence.

    The brand rows feed both the evidence and the final ranking; every ladder is published, but only
    successful records are evidence.
    """
    brands = unit_brands(spark, sf_dir)
    evidence = order_evidence(spark, sf_dir, brands)
    return ladder.publish(brands, UNIT, consensus.reorder_by(evidence, UNIT))
