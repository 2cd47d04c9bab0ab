"""Matching, merging and enriching ladders of two sources or of several dates.

The exact equi-join cases are joins; the two order-dependent rules fold over one ladder's
family list, which holds each family once.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import let, literal_map, match_key
from ..functions.rights import status_rank
from ..rules.rights import RIGHT_KEYS
from ..rules.vocab import STATUS_RANK
from . import ladder


def top_up(primary: DataFrame, secondary: DataFrame, keys, name="raw_brand_name") -> DataFrame:
    """Primary ladder plus the families only the secondary has, renumbered by price."""
    key = match_key(F.col(name))
    p, s = primary.withColumn("k", key), secondary.withColumn("k", key).where("k <> ''")
    extra = s.join(p.select(*keys, "k").distinct(), [*keys, "k"], "left_anti") \
        .join(p.select(*keys).distinct(), keys, "left_semi")
    extra = ladder.first_rows(extra, [*keys, "k"], ["screen_order", name])
    both = p.withColumn("added", F.lit(False)).unionByName(extra.withColumn("added", F.lit(True)))
    return ladder.number_ladder(both, keys, [F.col("price_value").asc_nulls_last(), "added",
                                             "screen_order", name], "screen_no")


def merged_rights(rights: DataFrame, keys, later_wins=True, drop_unknown=False) -> DataFrame:
    """Strongest status per key and right; ties go to the later (or the earlier) statement."""
    pos = F.col("pos") if later_wins else -F.col("pos")
    known = rights.where("status <> 'Unknown'") if drop_unknown else rights
    best = F.max(F.struct(status_rank(F.col("status")).alias("r"), pos.alias("p"), "status", "raw_value"))
    return known.groupBy(*keys, "right_key").agg(best.alias("b")) \
        .select(*keys, "right_key", "b.status", "b.raw_value")


#: Bits of a right in a packed number: one for each rank a known status reaches.
RANKS = max(STATUS_RANK.values())


def packed_right(right_key: Column, status: Column) -> Column:
    """A statement as a number; OR over a family's statements holds what ``merged_rights`` calls its strongest statuses.

    Each right of the taxonomy has as many bits as its status has ranks, so the stronger status covers the weaker.
    """
    ranks = literal_map((s, 2 ** r - 1) for s, r in STATUS_RANK.items())
    first = literal_map((k, i * RANKS) for i, k in enumerate(RIGHT_KEYS))
    reached = F.coalesce(F.element_at(ranks, status), F.lit(0)).cast("bigint")
    return F.call_function("shiftleft", reached, F.element_at(first, right_key))


def packed_rank(packed: Column, right_key: str) -> Column:
    """Rank of a right's strongest status in a packed number, 0 where it is unknown or not stated."""
    return F.bit_count(F.shiftright(packed, RIGHT_KEYS.index(right_key) * RANKS).bitwiseAND(F.lit(2 ** RANKS - 1).cast("bigint")))


def first_known(rows: DataFrame, keys, place="place", packed="said") -> DataFrame:
    """``keys, right_key, status, place``: each right's status where it is known first.

    A row holds all rights while the rows are cut, place and rank as one number each; only what is left becomes a row a right.
    """
    step = RANKS + 1

    def earliest(right_key):
        rank = packed_rank(F.col(packed), right_key)
        return F.min(F.when(rank > 0, F.col(place).cast("bigint") * step + rank)).alias(f"_{right_key}")
    best = rows.groupBy(*keys).agg(*[earliest(k) for k in RIGHT_KEYS])
    each = best.select(*keys, F.inline(F.array(*[F.struct(F.lit(k).alias("right_key"), F.col(f"_{k}").alias("at_rank")) for k in RIGHT_KEYS]))) \
        .where("at_rank IS NOT NULL")
    status = F.element_at(literal_map((r, s) for s, r in STATUS_RANK.items()), (F.col("at_rank") % step).cast("int"))
    return each.select(*keys, "right_key", status.alias("status"), F.expr(f"at_rank div {step}").alias(place))


def fill_rights(own: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Missing or Unknown rights of ``own`` from ``other``; a known status is never replaced."""
    o = other.where("status <> 'Unknown'").select(
        *keys, "right_key", F.col("status").alias("o_status"), F.col("raw_value").alias("o_value"))
    j = own.join(o, [*keys, "right_key"], "full_outer")
    take = (F.col("status").isNull() | (F.col("status") == "Unknown")) & F.col("o_status").isNotNull()
    value = F.when(F.col("o_value") != "", F.col("o_value")).otherwise(F.coalesce("raw_value", F.lit("")))
    return j.select(*keys, "right_key", F.when(take, F.col("o_status")).otherwise(F.col("status")).alias("status"),
                    F.when(take, value).otherwise(F.col("raw_value")).alias("raw_value"),
                    take.alias("filled"))


def fill_miles(own: DataFrame, other: DataFrame, keys, columns=("mileage_available", "miles_earned", "bonus_percent")) -> DataFrame:
    """Miles of ``own``; all of them from ``other`` where ``own`` does not say whether there are any."""
    o = other.where(F.col(columns[0]).isNotNull()).select(*keys, *[F.col(c).alias(f"o_{c}") for c in columns])
    take = F.col(columns[0]).isNull() & F.col(f"o_{columns[0]}").isNotNull()
    return own.join(o, list(keys), "left").select(
        *keys, *[F.when(take, F.col(f"o_{c}")).otherwise(F.col(c)).alias(c) for c in columns], take.alias("filled"))


def aligned_names(lists: DataFrame, keys, own="mine", other="theirs", name="raw_brand_name", carried=()) -> DataFrame:
    """``keys, raw_brand_name, other_name``: which family of the other ladder is which of one's own.

    A family of either ladder stands in one row at most, so what is joined over it cannot multiply.  What the other ladder's
    families hold under the names ``carried`` comes along; it is then under one's own name without a join.
    """
    pairs = lists.select(*keys, own, other, F.inline(matched_pairs(F.col(own), F.col(other))))
    its = F.get(other, F.col("o"))
    return pairs.select(*keys, F.get(own, F.col("p")).getField("name").alias(name), its.getField("name").alias("other_name"),
                        *[its.getField(c).alias(c) for c in carried])


def under_own_name(rows: DataFrame, aligned: DataFrame, keys, name="raw_brand_name") -> DataFrame:
    """Rows of the other source under the names one's own ladder uses; families without a match drop."""
    renamed = rows.withColumnRenamed(name, "other_name")
    return renamed.join(aligned, [*keys, "other_name"]).drop("other_name")


def family_item(name="raw_brand_name", place="screen_order", price="price_value", key=None, **carried) -> Column:
    """A family as the lists hold it: struct<screen_order,name,k,price>, and what else it is to carry."""
    named = F.col(name) if isinstance(name, str) else name
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(a) for a, c in {
        "screen_order": place, "name": named, "k": match_key(named) if key is None else key, "price": price, **carried}.items()])


def family_lists(df: DataFrame, keys, out="families", name="raw_brand_name") -> DataFrame:
    """Families of one ladder in screen order."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(family_item(name))).alias(out))


def matched_pairs(primary: Column, other: Column) -> Column:
    """array<struct<p:int,o:int>> (0-based): exact key, unique containment, then price place.

    The fold goes through the primary's families in order, as each match uses up one family of
    the other ladder.
    """
    others = F.transform(other, lambda o, j: F.struct(j.cast("int").alias("j"), o.k.alias("k")))
    mine = F.transform(primary, lambda p, i: F.struct(i.cast("int").alias("i"), p.k.alias("k")))
    pair = "array<struct<p:int,o:int>>"

    def taken(acc):
        return F.transform(acc, lambda x: x.o)

    def step(acc, p):
        free = F.filter(others, lambda o: (o.k != "") & ~F.array_contains(taken(acc), o.j))
        exact = F.filter(free, lambda o: o.k == p.k)
        near = F.filter(free, lambda o: o.k.contains(p.k) | p.k.contains(o.k))
        pick = F.when(p.k == "", F.lit(None).cast("int")) \
            .when(F.size(exact) > 0, F.get(exact, F.lit(0)).j) \
            .when(F.size(near) == 1, F.get(near, F.lit(0)).j)
        return let(pick, lambda j: F.when(j.isNotNull(), F.concat(
            acc, F.array(F.struct(p.i.alias("p"), j.alias("o"))))).otherwise(acc))
    named = F.aggregate(mine, F.expr(f"cast(array() as {pair})"), step)

    def by_price(arr):
        rows = F.transform(arr, lambda x, i: F.struct(
            x.price.isNull().alias("none"), x.price.alias("price"), i.cast("int").alias("i")))
        return F.transform(F.array_sort(rows), lambda x: x.i)
    zipped = F.zip_with(by_price(primary), by_price(other), lambda p, o: F.struct(p.alias("p"), o.alias("o")))

    def with_rest(found):
        rest = F.filter(zipped, lambda z: ~F.exists(found, lambda x: (x.p == z.p) | (x.o == z.o)))
        return F.when(F.size(primary) == F.size(other), F.concat(found, rest)).otherwise(found)
    return let(named, with_rest)


def bad_steps(families: Column) -> Column:
    """Steps over 3x in a family list, zero and missing prices left out."""
    prices = F.sort_array(F.transform(F.filter(families, lambda f: f.price != 0),
                                      lambda f: f.price.cast("double")))
    return let(prices, lambda p: F.size(F.filter(F.zip_with(
        F.slice(p, F.lit(2), F.greatest(F.size(p), F.lit(1))), p, lambda hi, lo: hi / lo), lambda r: r > 3.0)))


def fill_across_dates(primary: Column, dates: Column) -> Column:
    """Families of the primary date, plus those other dates add without a new >3x step.

    ``dates`` is an array of family lists in date order; each accepted date becomes part of the
    ladder the next one is judged against.
    """
    def step(cur, date):
        known = F.transform(cur, lambda f: f.k)
        fresh = F.filter(date, lambda f: (f.k != "") & ~F.array_contains(known, f.k))
        fresh = let(fresh, lambda fs: F.filter(fs, lambda f, i: F.array_position(
            F.transform(fs, lambda x: x.k), f.k) == i + 1))
        return let(F.concat(cur, fresh), lambda trial: F.when(
            (F.size(trial) > F.size(cur)) & (bad_steps(trial) <= bad_steps(cur)), trial).otherwise(cur))
    return F.aggregate(dates, primary, step)
