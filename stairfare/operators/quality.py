"""Completeness, quality gates and comparison of readings."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import names
from ..rules import vocab

EXPECTED_CABINS = 1


def with_completeness(units: DataFrame) -> DataFrame:
    """Flags and issue texts of collected units.

    Needs ``carrier, source, n_cabins, n_brands, n_priced, n_with_rights, n_with_miles,
    has_business``, one row per unit.
    """
    c = F.col
    some = c("n_brands") > 0
    flags = {
        "missing_source": F.coalesce(c("source"), F.lit("")) == "",
        "missing_cabin": c("n_cabins") < EXPECTED_CABINS,
        "missing_business": (c("carrier") != "") & ~names.is_low_cost(c("carrier")) & ~c("has_business"),
        "missing_brands": ~some,
        "missing_price": some & (c("n_priced") == 0),
        "missing_rights": some & (c("n_with_rights") == 0),
        "missing_miles": some & (c("n_with_miles") == 0),
    }
    figures = {
        "missing_cabin": (c("n_cabins").cast("string"), F.lit(str(EXPECTED_CABINS))),
        "missing_business": (F.upper("carrier"),),
    }

    def text(flag, before, behind):
        first, *last = figures.get(flag, (F.lit(""),))
        return F.concat(F.lit(before), first, F.lit(behind), *last)
    df = units.withColumns(flags)
    return df.withColumn("issues", F.array_compact(F.array(
        *[F.when(c(flag), text(flag, before, behind)) for flag, before, behind in vocab.ISSUE_TEXTS])))


def needs_retry() -> Column:
    c = F.col
    return c("missing_brands") | c("missing_source") | c("missing_price") | c("missing_business")


def second_pass() -> Column:
    """Units worth one more attempt: failed without brands, or Business missing."""
    return ((F.col("n_brands") == 0) & (F.col("status") == "failed")) | F.col("missing_business")


def final_status() -> Column:
    c = F.col
    empty = F.when(c("status").isin("failed", "no_availability"), c("status")) \
        .when(F.coalesce(c("error"), F.lit("")) == "", "no_availability").otherwise("failed")
    return F.when(c("missing_brands"), empty).when(F.size("issues") > 0, "partial").otherwise("success")


def publish_gate(total: Column, good: Column) -> Column:
    """The run may go on unless more than 20 outcomes succeed in less than a quarter."""
    return ~((total > 20) & (F.floor(good * 100 / F.greatest(total, F.lit(1))) < 25))


def rotated(stored: Column, live: Column) -> Column:
    """Nested sets, or at least half of the smaller set shared: inventory moved, names are right."""
    return (F.size(stored) > 0) & (F.size(live) > 0) & (
        (F.size(F.array_except(stored, live)) == 0) | (F.size(F.array_except(live, stored)) == 0)
        | (F.size(F.array_intersect(stored, live)) * 2 >= F.least(F.size(stored), F.size(live))))


def ladder_arrays(df: DataFrame, keys, out) -> DataFrame:
    """Names and prices of one ladder in price order (families are distinct, so short)."""
    item = F.struct(F.col("price_value").alias("price"), F.col("raw_brand_name").alias("name"))
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias(out))


def compare_readings(stored: DataFrame, live: DataFrame, keys) -> DataFrame:
    """Verdict per ladder: OK, price drift, inventory changed or name mismatch."""
    j = ladder_arrays(stored, keys, "s").join(ladder_arrays(live, keys, "l"), keys, "left")
    s, live_ = F.col("s.name"), F.coalesce(F.col("l.name"), F.array().cast("array<string>"))
    drift = F.exists(F.zip_with("s.price", "l.price", lambda a, b: F.abs(a - b) > 0.01), lambda x: x)
    verdict = F.when(s == live_, F.when(drift, "OK_PRICE_DRIFT").otherwise("OK")) \
        .when(rotated(s, live_) | (F.size(live_) == 0), "OK_INVENTORY_CHANGED").otherwise("NAME_MISMATCH")
    return j.withColumn("verdict", verdict)


def gate(verdicts: DataFrame, suspicious_names: DataFrame) -> DataFrame:
    """``check, found, blocks``: a row per verdict, one for suspicious names, and the gate over all of them.

    ``verdicts`` has a row per verdict (``check, found``), ``suspicious_names`` one row with their number.  The gate's
    ``found`` are the ladders looked at; any mismatch and any suspicious name shuts it.
    """
    v = verdicts.withColumn("blocks", F.col("check") == "NAME_MISMATCH")
    s = suspicious_names.select(F.lit("suspicious_names").alias("check"), "found", (F.col("found") > 0).alias("blocks"))
    rows = v.unionByName(s)
    whole = rows.agg(F.lit("gate").alias("check"), F.coalesce(F.sum(F.when(F.col("check") != "suspicious_names", F.col("found"))), F.lit(0)).alias("found"),
                     F.coalesce(F.max("blocks"), F.lit(False)).alias("blocks"))
    return rows.unionByName(whole)


def fingerprint(df: DataFrame, keys, *columns) -> DataFrame:
    """Order-free fingerprint of a reading: row count, xor and bounded sum of row hashes.

    The state has a constant size and the sum cannot overflow before trillions of rows.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.bit_xor(head).alias("hash_xor"),
                                 F.sum(F.pmod(head, F.lit(1000003))).alias("hash_sum"))


def reading_diff(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct rows that one of two readings has more often, with how many more (``surplus``).

    One aggregate counts both sides, so a value that many rows share is summed where the rows are.
    """
    both = first.withColumn("__side", F.lit(1)).unionByName(second.withColumn("__side", F.lit(-1)))
    return both.groupBy(*first.columns).agg(F.sum("__side").alias("surplus")).where("surplus <> 0") \
        .withColumn("only_in", F.when(F.col("surplus") > 0, "first").otherwise("second")).withColumn("surplus", F.abs("surplus"))


def suspicious(df: DataFrame, accepted) -> DataFrame:
    """Published names that look like codes; bare codes never publish, accepted tokens pass."""
    p = F.col("pretty_name")
    return df.where(~names.is_bare_code(p) & ~F.upper(p).isin(accepted)
                    & names.is_suspicious(p, F.col("fare_family_code")))


