"""The run's event log as JSON lines: written by ``emit_line``, followed as a stream, broken lines kept aside."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import written

EVENT = """ts timestamp, event string, source string, carrier string, origin string, destination string, season string,
 departure string, status string, brands int, retry int, attempt int, delay double, elapsed_s double, error string"""
BROKEN = "_broken"


def emit_line(fields) -> Column:
    """The JSON line of an event; a field without a value is left out."""
    return F.to_json(F.struct(*fields))


def follow(spark: SparkSession, folder: str) -> DataFrame:
    """The log files of a folder as they arrive.  A line that is no whole record has only ``_broken``, its text."""
    return spark.readStream.schema(f"{EVENT}, {BROKEN} string").option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", BROKEN).json(folder)


def take_in(spark: SparkSession, folder: str, base: str) -> tuple[DataFrame, DataFrame]:
    """(events, broken lines) of everything that has arrived in ``folder``, kept under ``base``.

    A batch writes both under its own number, so one that runs again rewrites its own rows; started again
    with the same ``base`` it reads only what is new.  A file is read once: the line a crash cut in
    half stays aside for good, and the run that follows writes a file of its own.
    """
    log = follow(spark, folder)

    def write(df, batch):
        df.withColumn("whole", F.col(BROKEN).isNull()).write.mode("overwrite").partitionBy("whole").json(f"{base}/rows/batch={batch}")
    if not written(spark, f"{base}/rows/batch=-1"):
        write(spark.createDataFrame([], log.schema), -1)
    log.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(f"{EVENT}, {BROKEN} string, batch long, whole boolean").option("basePath", f"{base}/rows").json(f"{base}/rows")
    return rows.where("whole").drop(BROKEN, "batch", "whole"), rows.where("not whole").select("batch", BROKEN)
