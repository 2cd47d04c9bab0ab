"""Candidate dates: season-correct blocks of days inside lead-time bands."""

from pyspark.sql import Column, DataFrame, functions as F

from ..rules.places import (BLOCK_DAYS, FALLBACK_BANDS, FAR_BAND, HORIZON, MIN_LEAD, TRIP_LENGTH)


def in_season(day: Column, season: Column) -> Column:
    return F.month(day).between(4, 10) == (season == "Summer")


def with_seasons(df: DataFrame) -> DataFrame:
    """Every row once per season, without a join."""
    return df.withColumn("season", F.explode(F.array(F.lit("Summer"), F.lit("Winter"))))


def stable_number(*key: Column) -> Column:
    """The same whole number for the same key on every run and engine."""
    head = F.substring(F.md5(F.concat_ws("|", *[k.cast("string") for k in key])), 1, 8)
    return F.conv(head, 16, 10).cast("bigint")


def stable_choice(cands: Column, *key: Column) -> Column:
    """One element, always the same for the same key; null when there is none."""
    n = F.greatest(F.size(cands), F.lit(1))
    return F.get(cands, F.pmod(stable_number(*key), n).cast("int"))


def days_between(today: Column, lo, hi) -> Column:
    return F.sequence(F.date_add(today, lo), F.date_add(today, hi))


def band_candidates(today: Column, season: Column, lo: int, hi: int, block: int) -> Column:
    """Days whose whole block stays in season, else days in the band that start in season."""
    days = days_between(today, max(1, lo - (block - 1)), hi)
    whole = F.filter(days, lambda d: F.forall(
        F.sequence(d, F.date_add(d, block - 1)), lambda x: in_season(x, season)))
    starts = F.filter(days, lambda d: in_season(d, season) & (d >= F.date_add(today, lo)))
    return F.when(F.size(whole) > 0, whole).otherwise(starts)


def date_plan(units: DataFrame, today: Column, seed: int = 0, block: int = BLOCK_DAYS,
              far_band=FAR_BAND, bands=FALLBACK_BANDS, trip: int = TRIP_LENGTH) -> DataFrame:
    """Explode each (origin, destination, season) into its ordered candidate dates.

    One block per lead-time band, deepest first; a band without a season-correct day widens
    by 90 days; if no band serves the season, any season day within the horizon is used.
    """
    key = [F.col("origin"), F.col("destination"), F.col("season"), F.lit(seed)]
    season = F.col("season")
    picks = []
    for i, (lo, hi) in enumerate([far_band] + [(c - s, c + s) for c, s in bands]):
        near = band_candidates(today, season, lo, hi, block)
        wide = band_candidates(today, season, max(1, lo - 90), hi + 90, block)
        picks.append(F.coalesce(stable_choice(near, *key, F.lit(i)),
                                stable_choice(wide, *key, F.lit(i))))
    starts = F.array_distinct(F.array_compact(F.array(*picks)))
    anyday = F.filter(days_between(today, MIN_LEAD, max(HORIZON, 400)),
                      lambda d: in_season(d, season))
    last = F.array_compact(F.array(stable_choice(anyday, *key, F.lit(99))))
    starts = F.when(F.size(starts) > 0, starts).otherwise(last)
    blocks = units.select("*", F.posexplode(starts).alias("block_no", "start")) \
        .withColumn("block_no", F.col("block_no") + 1)
    out = blocks.withColumn("pos", F.explode(F.sequence(F.lit(0), F.lit(block - 1))))
    return out.withColumn("departure", F.date_add("start", F.col("pos"))) \
        .withColumn("return_date", F.date_add("departure", trip)).drop("start")


def window_plan(units: DataFrame, today: Column, seed: int = 0, min_lead=MIN_LEAD,
                horizon=HORIZON, window=6, trip: int = TRIP_LENGTH) -> DataFrame:
    """One long walk from a season day at least ``min_lead`` days out."""
    key = [F.col("origin"), F.col("destination"), F.col("season"), F.lit(seed)]
    days = F.filter(days_between(today, min_lead, horizon), lambda d: in_season(d, F.col("season")))
    wide = F.filter(days_between(today, min_lead, max(horizon, 400)),
                    lambda d: in_season(d, F.col("season")))
    start = stable_choice(F.when(F.size(days) > 0, days).otherwise(wide), *key)
    out = units.withColumn("start", start).withColumn(
        "pos", F.explode(F.sequence(F.lit(0), F.lit(window))))
    return out.withColumn("block_no", F.lit(1)) \
        .withColumn("departure", F.date_add("start", F.col("pos"))) \
        .withColumn("return_date", F.date_add("departure", trip)).drop("start")
