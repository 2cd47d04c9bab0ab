"""Places in an order over a whole table, without a task that sees all of it."""

from pyspark.sql import DataFrame, functions as F

from ..sources.tables import scratch


def numbered(df: DataFrame, order, out="place") -> tuple[DataFrame, int]:
    """``df`` with the place (from 1 on) of each row in ``order``, and how many rows there are.

    Rows are dealt by range and sorted within each; a row's place is its place in the range plus the rows
    of the ranges before, of which the driver gets one number each.  The ranges are written once to the shared
    folder, so that places do not change when a task runs again.  Rows that tie have any order among themselves.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    folder = scratch(spark, "places")
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed.write.parquet(folder)
    kept = spark.read.schema(placed.schema).parquet(folder).withColumn("__range", F.shiftright("__at", 33))
    before, firsts = 0, []
    for r in kept.groupBy("__range").agg(F.count("*").alias("n")).orderBy("__range").collect():
        firsts.append((r["__range"], before))
        before += r["n"]
    first = F.broadcast(spark.createDataFrame(firsts, "__range long, __before long"))
    return kept.join(first, "__range").withColumn(out, F.col("__before") + inside + 1).drop("__range", "__at", "__before"), before
