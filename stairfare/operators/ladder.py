"""Ladder operators: prices, order, quality, names, one ladder per cabin.

Windows here partition by one ladder.  A ladder holds each family once (repeats were reduced
to the cheapest by a map-side aggregate), so a partition stays as small as the list of family
names a carrier sells, however many observations lie behind it.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import names


def resolve_prices(df: DataFrame, keys, order, out="resolved") -> DataFrame:
    """Absolute price of every row; a delta counts from the last absolute price before it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    is_abs = F.col("price_type") == "absolute"
    anchor = F.last(F.when(is_abs, F.col("price_value")), ignorenulls=True).over(w)
    return df.withColumn(out, F.when(is_abs, F.col("price_value"))
                         .otherwise((anchor + F.col("price_value")).cast("decimal(14,2)")))


def by_price(price, rank, *ties):
    return [F.col(price).asc_nulls_last(), F.col(rank).asc(), *[F.col(t).asc() for t in ties]]


def number_ladder(df: DataFrame, keys, order, out="brand_order") -> DataFrame:
    """0-based position of each family inside its ladder."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w) - 1)


def step_ratio(df: DataFrame, keys, price="price_value") -> DataFrame:
    """Ratio of each truthy price to the next cheaper one of its ladder."""
    p = F.when(F.col(price) != 0, F.col(price)).cast("double")
    w = Window.partitionBy(*keys).orderBy(p.asc_nulls_last())
    before = F.lag(p).over(w)
    return df.withColumn("step_ratio", F.when(before > 0, p / before))


def round_half_up(x: Column, digits: int) -> Column:
    return F.floor(x * 10 ** digits + 0.5) / float(10 ** digits)


def quality_columns():
    worst = F.greatest(F.coalesce(F.max("step_ratio"), F.lit(1.0)), F.lit(1.0))
    return [F.count(F.when(F.col("step_ratio") > 3.0, 1)).alias("bad_steps"),
            round_half_up(worst, 3).alias("worst_step")]


def ladder_quality(df: DataFrame, keys, price="price_value") -> DataFrame:
    """Families, implausible steps (over 3x) and worst step per ladder."""
    return step_ratio(df, keys, price).groupBy(*keys).agg(
        F.count("*").alias("n_brands"), *quality_columns())


def description_parts(description: Column) -> Column:
    """How many parts of a ``;``-separated description say anything."""
    parts = F.split(F.coalesce(description, F.lit("")), ";")
    return F.size(F.filter(parts, lambda p: F.trim(p) != ""))


def first_rows(df: DataFrame, keys, order) -> DataFrame:
    """The best row per key.  Spark limits each group before the shuffle, so a hot key is cheap."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_group(df: DataFrame, keys, order) -> DataFrame:
    """All rows that share the best order values of their key (a whole ladder, a whole record)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rk", F.rank().over(w)).where("_rk = 1").drop("_rk")


def unique_names(df: DataFrame, keys, pretty="pretty_name", raw="raw_brand_name",
                 out="shown_name") -> DataFrame:
    """Where one ladder shows a name twice, append the words of the raw name it lacks."""
    n = F.count("*").over(Window.partitionBy(*keys, pretty))
    known = F.transform(F.split(F.col(pretty), " "), lambda w: F.lower(w))
    extra = F.filter(F.split(F.trim(F.col(raw)), r"[\s/_-]+"),
                     lambda w: (w != "") & ~F.array_contains(known, F.lower(w)))
    longer = F.trim(F.concat(F.col(pretty), F.lit(" "), F.array_join(extra, " ")))
    return df.withColumn(out, F.when(n < 2, F.col(pretty)).otherwise(longer))


def cheapest_per_name(df: DataFrame, keys, name="shown_name", price="abs_price",
                      order="brand_order") -> DataFrame:
    """One row per published name: the cheapest (0 and null count as dearest), else the first."""
    p = F.when(F.col(price) != 0, F.col(price))
    slot = F.min(order).over(Window.partitionBy(*keys, name))
    return first_rows(df.withColumn("slot", slot), [*keys, name], [p.asc_nulls_last(), F.col(order)])


def regroup(df: DataFrame, group="group_cabin", hint=None, keep_higher=True) -> DataFrame:
    """Tabled names first, then each brand under its own cabin; lower cabins drop.

    The cabin is worked out once per row: a filter on a computed column would make the
    optimiser work it out again for the filter.
    """
    c = F.col
    carrier, code, keep = c("carrier"), c("fare_family_code"), keep_higher
    keep = F.lit(keep) if isinstance(keep, bool) else keep
    tabled, _ = names.family_override(carrier, code, c("raw_brand_name"))

    def placed(name):
        eff = names.effective_cabin(name, code, c(hint) if hint else F.lit(None).cast("string"),
                                    c(group), carrier)
        return names.let(eff, lambda e: F.when(names.keeps_cabin(e, c(group), keep), F.struct(
            name.alias("family_name"), e.alias("cabin"))))
    rows = F.array_compact(F.array(names.let(F.coalesce(tabled, c("raw_brand_name")), placed)))
    return df.select("*", F.inline(rows)).drop("raw_brand_name") \
        .withColumnRenamed("family_name", "raw_brand_name")


def rank_results(df: DataFrame, unit, reorder=None) -> DataFrame:
    """Published rows of every cabin result, before one ladder per cabin is chosen.

    ``df`` holds one row per brand with ``result_no`` (position of its cabin result in the
    unit), ``group_cabin``, name, code, price and ``screen_order``.  ``reorder`` may change
    ``brand_order`` by outside evidence once the price order is known.
    """
    keys = [*unit, "result_no", "cabin"]
    df = names.with_pretty_name(regroup(df)).where(~names.is_bare_code(F.col("pretty_name")))
    df = df.withColumn("name_rank", names.name_rank(F.col("pretty_name"), F.col("cabin")))
    df = resolve_prices(df, keys, ["screen_order", "raw_brand_name"])
    df = number_ladder(df, keys, by_price("resolved", "name_rank", "screen_order", "raw_brand_name"))
    if reorder is not None:
        df = reorder(df)
    df = resolve_prices(df, keys, ["brand_order"], out="abs_price")
    df = unique_names(df, keys, raw="pretty_name")
    return cheapest_per_name(df, keys)


def one_ladder_per_cabin(df: DataFrame, unit) -> DataFrame:
    """Of several ladders for one cabin: more brands, then its own search, then the earlier."""
    size = F.count("*").over(Window.partitionBy(*unit, "result_no", "cabin"))
    df = df.withColumn("ladder_size", size)
    return first_group(df, [*unit, "cabin"], [
        F.col("ladder_size").desc(), (F.col("group_cabin") == F.col("cabin")).desc(),
        F.col("result_no").asc()])


def publish(df: DataFrame, unit, reorder=None) -> DataFrame:
    """The published ladder: one per unit and cabin, with tier codes."""
    out = one_ladder_per_cabin(rank_results(df, unit, reorder), unit)
    return out.withColumn("tier_code", names.tier_code(F.col("cabin"), F.col("brand_order")))


def transitions(ladder: DataFrame, keys, price="price", order="brand_order") -> DataFrame:
    """Each step of a ladder: from, to and the fee between them."""
    w = Window.partitionBy(*keys).orderBy(order)
    return ladder.withColumns({
        "to_order": F.lead(order).over(w),
        "to_price": F.lead(price).over(w)}) \
        .where(F.col("to_order").isNotNull()) \
        .withColumn("fee", (F.col("to_price") - F.col(price)).cast("decimal(14,2)"))
