"""Human corrections: a change-set checked, completed and merged into collected ladders."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.names import literal_map, match_key
from ..functions.rights import cell_text, split_cell
from ..rules import rights as R, vocab
from . import ladder

UNIT_COLS = ["Action", "Carrier", "Origin", "Destination", "Season", "Cabin"]
PACKAGE_COLS = ["Brand Order", "Brand Name", "Price USD", "Step USD"]
RIGHT_COLS = [t for _, t, _ in R.RIGHTS]
COLUMNS = UNIT_COLS + PACKAGE_COLS + RIGHT_COLS + ["Note"]
LADDER = ["carrier", "origin", "destination", "season", "cabin"]


def _cell(name: str) -> Column:
    return F.trim(F.coalesce(F.col(f"`{name}`"), F.lit("")))


def drop_blank_rows(df: DataFrame) -> DataFrame:
    return df.where(F.exists(F.array(*[_cell(c) for c in COLUMNS]), lambda v: v != ""))


def _number(name: str):
    text = F.replace(_cell(name), F.lit(","), F.lit("."))
    ok = text.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$")
    return text, ok


def checked(df: DataFrame, line="line") -> DataFrame:
    """Normalised cells plus ``errors``, one text per defect; rows keep their line number.

    The last test looks for the same package on an earlier line.
    """
    act = F.lower(F.when(_cell("Action") == "", "upsert").otherwise(_cell("Action")))
    season = F.element_at(literal_map((s.lower(), s) for s in vocab.SEASONS), F.lower(_cell("Season")))
    cabin = F.element_at(literal_map((s.lower(), s) for s in vocab.CABINS), F.lower(_cell("Cabin")))
    code = {c: F.upper(_cell(c)) for c in ("Carrier", "Origin", "Destination")}
    errors = [F.when(~act.isin("upsert", "remove"), F.concat(F.lit("Action '"), act, F.lit("' is not upsert or remove")))]
    for c, v in code.items():
        bad = ~F.length(v).between(2, 3) if c == "Carrier" else ~v.rlike("^[A-Z]{3}$")
        errors.append(F.when(v == "", f"{c} is empty").when(bad, F.concat(F.lit(f"{c} '"), v, F.lit("' is not a code"))))
    errors += [F.when(season.isNull(), F.concat(F.lit("Season '"), _cell("Season"), F.lit("' is unknown"))),
               F.when(cabin.isNull(), F.concat(F.lit("Cabin '"), _cell("Cabin"), F.lit("' is unknown"))),
               F.when(_cell("Brand Name") == "", "Brand Name is empty")]
    numbers = {}
    for c in ("Brand Order", "Price USD", "Step USD"):
        text, ok = _number(c)
        numbers[c] = F.when((text != "") & ok, text)
        errors.append(F.when((text != "") & ~ok, F.concat(F.lit(f"{c} '"), text, F.lit("' is not a number"))))
    price, step = numbers["Price USD"].isNotNull(), numbers["Step USD"].isNotNull()
    errors += [F.when((act == "upsert") & ~price & ~step, "Price USD or Step USD is needed"),
               F.when(price & step, "Price USD and Step USD exclude each other")]
    cells = {}
    for t in RIGHT_COLS:
        status, detail = split_cell(F.col(f"`{t}`"))
        errors.append(F.when((_cell(t) != "") & status.isNull(), F.concat(F.lit(f"{t} '"), _cell(t), F.lit("' is no status"))))
        cells[t] = F.coalesce(cell_text(status, detail), F.lit(""))
    out = df.select(
        F.col(line).alias("line"), act.alias("action"), code["Carrier"].alias("carrier"),
        code["Origin"].alias("origin"), code["Destination"].alias("destination"), season.alias("season"),
        cabin.alias("cabin"), _cell("Brand Name").alias("brand_name"), match_key(_cell("Brand Name")).alias("k"),
        F.floor(numbers["Brand Order"].cast("double")).cast("int").alias("brand_no"),
        numbers["Price USD"].cast("decimal(14,2)").alias("price_usd"),
        numbers["Step USD"].cast("decimal(14,2)").alias("step_usd"),
        *[v.alias(t) for t, v in cells.items()], _cell("Note").alias("note"),
        F.array_compact(F.array(*errors)).alias("errors"))
    w = Window.partitionBy(*LADDER, "k", F.size("errors") == 0).orderBy("line")
    before = F.lag("line").over(w)
    dup = F.when((F.size("errors") == 0) & before.isNotNull(),
                 F.concat(F.lit("same package on line "), before.cast("string")))
    return out.withColumn("errors", F.array_compact(F.array_append("errors", dup)))


def long_rights(df: DataFrame) -> DataFrame:
    """(line, carrier, k, title, cell) of every right cell, filled or not."""
    cells = F.array(*[F.struct(F.lit(t).alias("title"), F.col(f"`{t}`").alias("cell")) for t in RIGHT_COLS])
    return df.select("line", "carrier", "k", F.inline(cells))


def inherit_rights(cells: DataFrame, collected: DataFrame) -> DataFrame:
    """Blank cells from another manual row of the same carrier and family, else from the data.

    ``collected`` has (carrier, k, title, cell).  Both donors are reduced to one row per key on
    the map side before they are joined.
    """
    filled = cells.where("cell <> ''").groupBy("carrier", "k", "title").agg(
        F.min(F.struct("line", "cell")).alias("m")).select("carrier", "k", "title", F.col("m.cell").alias("from_manual"))
    data = collected.select("carrier", "k", "title", F.col("cell").alias("from_data"))
    key = ["carrier", "k", "title"]
    own = F.when(F.col("cell") != "", F.col("cell"))
    return cells.join(filled, key, "left").join(data, key, "left").withColumn(
        "resolved", F.coalesce(own, "from_manual", "from_data", F.lit(""))) \
        .withColumn("origin_of_cell", F.when(own.isNotNull(), "own").when(F.col("from_manual").isNotNull(), "manual")
                    .when(F.col("from_data").isNotNull(), "data").otherwise("none"))


def merge(collected: DataFrame, entries: DataFrame) -> DataFrame:
    """Collected families with the entries applied: replaced, added or removed.

    ``collected`` has LADDER, ``k``, ``brand_name``, ``price_value``, ``screen_order``;
    ``entries`` are checked rows without errors.  A family's last entry counts.
    """
    e = ladder.first_rows(entries, [*LADDER, "k"], [F.col("line").desc()]).select(
        *LADDER, "k", "action", F.col("brand_name").alias("e_name"), "price_usd", "step_usd", "brand_no")
    units = collected.select(*LADDER[:-1]).distinct().withColumn("known_unit", F.lit(True))
    j = collected.withColumn("has", F.lit(True)).join(e, [*LADDER, "k"], "full_outer").join(units, LADDER[:-1], "left")
    up = F.col("action") == "upsert"
    outcome = F.when(F.col("action").isNull(), "kept").when(up & F.col("has").isNotNull(), "updated") \
        .when(up, "added").when(F.col("has").isNotNull(), "removed").otherwise("nothing")
    j = j.withColumn("outcome", outcome)
    return j.select(
        *LADDER, "k", "outcome", F.when(up, F.col("e_name")).otherwise(F.col("brand_name")).alias("brand_name"),
        F.when(up, F.col("price_usd")).otherwise(F.col("price_value")).alias("own_price"),
        F.when(up, F.col("step_usd")).alias("step_usd"),
        F.when(up, F.coalesce(F.col("brand_no") - 1, F.lit(0))).otherwise(F.col("screen_order")).alias("screen_order"),
        (~F.coalesce("known_unit", F.lit(False))).alias("new_unit"))


def resolve_steps(df: DataFrame) -> DataFrame:
    """Absolute price of step rows: the last own price plus the steps since."""
    order = [F.col("screen_order"), F.col("own_price").asc_nulls_last(), F.col("brand_name")]
    w = Window.partitionBy(*LADDER).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("seg", F.count("own_price").over(w))
    df = df.withColumn("place", F.row_number().over(Window.partitionBy(*LADDER).orderBy(*order)) - 1)
    seg = Window.partitionBy(*LADDER, "seg")
    run = seg.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    base = F.max("own_price").over(seg)
    stepped = (base + F.sum(F.coalesce("step_usd", F.lit(0).cast("decimal(14,2)"))).over(run)).cast("decimal(14,2)")
    price = F.coalesce("own_price", F.when(F.col("step_usd").isNotNull(), stepped))
    return df.withColumn("price", price).drop("seg")


def upsert_store(store: DataFrame, rows: DataFrame, keys, replace_all=False) -> DataFrame:
    """Import into the stored change-set: rows replace those with the same key, or all."""
    if replace_all:
        return rows
    return store.join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows)
