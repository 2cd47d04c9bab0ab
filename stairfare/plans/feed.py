"""The dashboard's feed: one JSON document ``{generated_at, count, fares, runs}`` written by many tasks.

The document lies in folders whose files, taken by name, follow each other: head, fares, between, runs, end.  Every
line of fares and runs is a record, all but the first with a comma before it, so no task writes more than its range.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ranking import numbered

PARTS = ("0-head", "1-fares", "2-between", "3-runs", "4-end")


def prune_features(fares: DataFrame, features="features") -> DataFrame:
    """Features no fare states are left out of every fare; at most one flag a feature reaches the driver."""
    stated = fares.select(F.explode(features).alias("key", "f")).where("f.state is not null").select("key").distinct()
    keep = F.array(*[F.lit(r["key"]) for r in stated.orderBy("key").collect()]).cast("array<string>")
    return fares.withColumn(features, F.map_filter(features, lambda k, _: F.array_contains(keep, k)))


def run_rows(fares: DataFrame, run: str, collected_at: str) -> DataFrame:
    """One archive row per collection month and season, with its carriers and routes.

    Both are made distinct before they are listed; there are no more routes than pairs of airports.
    """
    key = ["coll_date", "coll_season"]
    count = fares.groupBy(*key).agg(F.count("*").alias("record_count"))
    parts = fares.select(*key, "airline", F.concat_ws("-", "origin", "destination").alias("ond")).distinct()
    lists = parts.groupBy(*key).agg(F.sort_array(F.collect_set("airline")).alias("airlines"), F.sort_array(F.collect_set("ond")).alias("onds"))
    return count.join(lists, key).select(
        F.concat_ws("_", F.lit(run), F.when(F.col("coll_season") != "", F.col("coll_season")).otherwise(F.col("coll_date"))).alias("run_id"), *key,
        F.lit(collected_at).alias("collected_at"), "airlines", "onds", "record_count", F.lit("OK").alias("status"))


def _write_list(rows: DataFrame, order, folder: str) -> int:
    line = F.to_json(F.struct(*rows.columns))
    lines, count = numbered(rows.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(order)], line.alias("__line")),
                            [f"__{i}" for i in range(len(order))])
    text = F.when(F.col("place") == 1, F.col("__line")).otherwise(F.concat(F.lit(","), F.col("__line")))
    lines.repartitionByRange("place").sortWithinPartitions("place").select(text.alias("value")).write.text(folder)
    return count


def write_feed(fares: DataFrame, runs: DataFrame, path: str, generated_at: str, order) -> None:
    """Writes the document under ``path``; ``order`` are the fares' columns that tell any two apart."""
    spark = fares.sparkSession
    count = _write_list(fares, order, f"{path}/{PARTS[1]}")
    _write_list(runs, ["run_id", "coll_date"], f"{path}/{PARTS[3]}")
    fixed = {PARTS[0]: f'{{"generated_at":"{generated_at}","count":{count},"fares":[', PARTS[2]: '],"runs":[', PARTS[4]: "]}"}
    for part, text in fixed.items():
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/{part}")


def read_feed(spark: SparkSession, path: str, fares, runs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(head, fares, runs) of a document, given the schemas of its two lists."""
    def listed(part, schema):
        line = F.ltrim(F.col("value"), F.lit(","))
        return spark.read.text(f"{path}/{part}").select(F.from_json(line, schema).alias("r")).select("r.*")

    head = spark.read.text(f"{path}/{PARTS[0]}").select(F.from_json(F.concat("value", F.lit("]}")), "generated_at string, count bigint").alias("h")).select("h.*")
    return head, listed(PARTS[1], fares), listed(PARTS[3], runs)
