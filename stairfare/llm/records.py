"""Text records of the fare library that the operators of this folder work on."""

from pyspark.sql import Column, DataFrame, functions as F

KEY, TEXT = "package_key", "description"


def package_texts(records: DataFrame) -> DataFrame:
    """``package_key, carrier, season, cabin, raw_brand_name, description`` of raw unit records.

    ``records`` has ``unit_key`` and ``cabins`` (array of cabins, each with ``cabin`` and an array
    ``brands``).  A unit without cabins or a cabin without brands gives no row; a package without a
    description keeps a null text.  The key is unit, cabin and place on the screen.
    """
    unit = F.split("unit_key", r"\|")
    cabins = records.select("unit_key", unit[0].alias("carrier"), unit[3].alias("season"), F.explode("cabins").alias("c"))
    brands = cabins.select("unit_key", "carrier", "season", F.col("c.cabin").alias("cabin"), F.posexplode("c.brands").alias("place", "b"))
    return brands.select(F.concat_ws("|", "unit_key", "cabin", F.col("place").cast("string")).alias(KEY),
                         "carrier", "season", "cabin", F.col("b.raw_brand_name").alias("raw_brand_name"),
                         F.col("b.description").alias(TEXT))


def note_texts(changes: DataFrame) -> DataFrame:
    """``package_key, description`` of a manual change-set: the note a person typed beside a package."""
    parts = ["Carrier", "Origin", "Destination", "Season", "Cabin", "Brand Name"]
    return changes.select(F.concat_ws("|", *[F.coalesce(F.col(f"`{p}`"), F.lit("")) for p in parts]).alias(KEY),
                          F.col("Note").alias(TEXT))


def keyed(df: DataFrame, key: str, text: str, for_python: bool = False) -> DataFrame:
    """Only ``__key`` and ``__text`` (null as empty), whatever else the table holds.

    For Python the key is text, since pandas has no null among integers; ``restored`` turns it back.
    """
    k = F.col(f"`{key}`")
    return df.select((k.cast("string") if for_python else k).alias("__key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))


def restored(df: DataFrame, key: str, source: DataFrame) -> DataFrame:
    """``df`` with its text column ``key`` cast to the type it has in ``source``."""
    return df.withColumn(key, F.col(f"`{key}`").cast(source.schema[key].dataType))


def once(df: DataFrame, **values: Column) -> DataFrame:
    """Adds columns that are computed once a row, however often later steps name them.

    Spark would otherwise paste a costly expression into each place that uses it, also into the body
    of a lambda; it never does so across a generator.
    """
    packed = F.explode(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))).alias("__once")
    return df.select("*", packed).select("*", *[F.col(f"__once.{k}").alias(k) for k in values]).drop("__once")


def row_mark() -> Column:
    """Tells rows of one key apart by their text; repeated rows share it."""
    return F.xxhash64("__text")


def packed(df: DataFrame, **values: Column) -> DataFrame:
    """``values`` beside the whole row as one struct ``__row``: no column of the table can clash with them."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    return df.select(row, *[v.alias(k) for k, v in values.items()])


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The columns of ``__row`` again, some of them with a new value."""
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col(f"__row.`{c}`").alias(c) for c in columns])


def without(df: DataFrame, dropped: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of ``df`` whose key and text are not in ``dropped`` (``__key, __mark``); all columns stay, whatever their names.

    Null keys match null keys.
    """
    marked = packed(df, __own=F.col(f"`{key}`"), __text_mark=F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    d = dropped.select(F.col("__key").alias("__dkey"), F.col("__mark").alias("__dmark"))
    same = F.col("__text_mark").eqNullSafe(F.col("__dmark")) & F.col("__own").eqNullSafe(F.col("__dkey"))
    return unpacked(marked.join(d, same, "left_anti"), df.columns)
