"""Order consensus between seasons.

A pair of families whose order differs between the two seasons is decided by the season in
which the two prices lie further apart.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import match_key

ROUTE = ["carrier", "origin", "destination", "cabin"]


def season_evidence(published: DataFrame, successful: DataFrame | None = None, price="abs_price", slot="slot") -> DataFrame:
    """One row per route, cabin and family key: place and price in either season.

    The first occurrence of a key in a ladder counts.  Pre-aggregated, so a family seen in any
    number of rows arrives as one.  With ``successful`` (keys of records, a row each) only the ladders of these
    records say anything about the order.
    """
    if successful is not None:
        published = published.join(successful, successful.columns, "left_semi")
    df = published.withColumn("k", match_key(F.col("pretty_name"))).where(F.col("k") != "")
    first = lambda s: F.min(F.when(F.col("season") == s, F.struct(
        F.col(slot).alias("at"), F.col(price).alias("price"))))
    out = df.groupBy(*ROUTE, "k").agg(first("Summer").alias("s"), first("Winter").alias("w"))
    return out.where("s is not null and w is not null").select(
        *ROUTE, "k", F.col("s.at").alias("s_at"), F.col("s.price").alias("s_price"),
        F.col("w.at").alias("w_at"), F.col("w.price").alias("w_price"))


def pair_preferences(evidence: DataFrame) -> DataFrame:
    """Pairs the seasons order differently, with the order the wider gap supports.

    Only contradicted pairs leave the join: the order test is part of its condition.
    """
    ev = evidence.where("s_price is not null and w_price is not null")
    a, b = ev.alias("a"), ev.alias("b")
    same_route = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ROUTE]
    differ = (F.col("a.s_at") < F.col("b.s_at")) != (F.col("a.w_at") < F.col("b.w_at"))
    cond = (F.col("a.k") < F.col("b.k")) & differ
    for c in same_route:
        cond = cond & c
    s_gap = F.abs(F.col("a.s_price") - F.col("b.s_price"))
    w_gap = F.abs(F.col("a.w_price") - F.col("b.w_price"))
    summer_first = F.col("a.s_at") < F.col("b.s_at")
    a_first = F.when(s_gap > w_gap, summer_first).otherwise(~summer_first)
    return a.join(b, cond).where(s_gap != w_gap).select(
        *[F.col(f"a.{c}").alias(c) for c in ROUTE],
        F.when(a_first, F.col("a.k")).otherwise(F.col("b.k")).alias("first_key"),
        F.when(a_first, F.col("b.k")).otherwise(F.col("a.k")).alias("second_key"),
        F.greatest(s_gap, w_gap).alias("gap"))


def _must_swap(left: Column, right: Column, seen: Column) -> Column:
    """True when the evidence puts ``right`` before ``left``."""
    l, r = F.try_element_at(seen, left), F.try_element_at(seen, right)
    summer, winter = l.s_at > r.s_at, l.w_at > r.w_at          # right comes first
    s_gap, w_gap = F.abs(l.s_price - r.s_price), F.abs(l.w_price - r.w_price)
    wins = F.when(summer & ~winter, s_gap > w_gap).when(winter & ~summer, w_gap > s_gap)
    return F.coalesce(wins & (left != right) & (left != "") & (right != ""), F.lit(False))


def bubble(keys: Column, seen: Column) -> Column:
    """Positions of ``keys`` after repeated passes that swap contradicted neighbours.

    A pass carries one element along the list, as a neighbour-swap loop does; passes stop at
    the first one without a swap, and after n*n of them at the latest.
    """
    item = "array<struct<i:int,k:string>>"
    start = F.transform(keys, lambda k, i: F.struct(i.cast("int").alias("i"), k.alias("k")))

    def one_pass(arr):
        init = F.struct(F.expr(f"cast(array() as {item})").alias("out"),
                        F.get(arr, F.lit(0)).alias("carry"), F.lit(False).alias("moved"))

        def step(acc, nxt):
            swap = _must_swap(acc.carry.k, nxt.k, seen)
            return F.struct(
                F.concat(acc.out, F.array(F.when(swap, nxt).otherwise(acc.carry))).alias("out"),
                F.when(swap, acc.carry).otherwise(nxt).alias("carry"),
                (acc.moved | swap).alias("moved"))
        return F.aggregate(F.slice(arr, F.lit(2), F.greatest(F.size(arr), F.lit(1))), init, step,
                           lambda acc: F.struct(
            F.concat(acc.out, F.array(acc.carry)).alias("arr"), acc.moved.alias("moved")))

    def outer(acc, _):
        return F.when(acc.moved, one_pass(acc.arr)).otherwise(acc)
    n = F.size(keys)
    end = F.aggregate(F.sequence(F.lit(1), F.greatest(n * n, F.lit(1))),
                      F.struct(start.alias("arr"), F.lit(True).alias("moved")), outer)
    return F.transform(end.arr, lambda e: e.i)


def reorder_by(evidence: DataFrame, unit):
    """A ``reorder`` step for :func:`stairfare.operators.ladder.rank_results`.

    The evidence of one route and cabin becomes one map (a few families), so no pair is ever
    written out; each ladder looks up only the neighbours it compares.
    """
    seen = evidence.groupBy(*ROUTE).agg(F.map_from_entries(F.collect_list(F.struct(
        "k", F.struct("s_at", "s_price", "w_at", "w_price")))).alias("seen"))

    def apply(df: DataFrame) -> DataFrame:
        keys = [*unit, "result_no", "cabin"]
        df = df.withColumn("k", match_key(F.col("pretty_name")))
        lists = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("brand_order", "k"))).alias("l"))
        lists = lists.join(seen, ROUTE).where(F.size("l") > 1)
        moved = lists.select(*keys, F.posexplode(bubble(F.col("l.k"), F.col("seen")))
                             .alias("new_order", "brand_order"))
        return df.join(moved, [*keys, "brand_order"], "left") \
            .withColumn("brand_order", F.coalesce("new_order", "brand_order")).drop("new_order", "k")
    return apply
