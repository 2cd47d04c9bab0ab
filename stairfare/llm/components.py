"""Connected components of an edge table that is itself spread over the cluster."""

from pyspark.sql import DataFrame, functions as F

from ..sources.tables import scratch


def _written(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    folder = scratch(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``edges`` (``a``, ``b``: longs); the root is the smallest node reachable.

    Alternating rounds of large star (every node hands its larger neighbours its smallest one) and small
    star (its smaller ones) until the edges are stars: a logarithmic number of rounds.  Each round's
    edges are written to the shared folder, which ends the lineage and outlives executors.  Nothing but
    two numbers a round reaches the driver.
    """
    e = _written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b") \
            .unionByName(lowest.select("a", F.col("m").alias("b"))).distinct()
        e = _written(small, "edges")
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before == state:
            break
        before = state
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
