"""Streaming queries over the event log and the record files."""

from pyspark.sql import functions as F

from ..sources import bridge, event_log, records
from ..sources.tables import scratch, table
from ..streaming import events as ev
from .files import record_files
from .registry import query
from .texts import tally

STAMP = "yyyy-MM-dd HH:mm:ss"


def text(col):
    return F.date_format(col, STAMP).alias(col)


@query
def t1_ingest_records(spark, sf):
    """Record files picked up by a file stream as they arrive."""
    stream = spark.readStream.schema(records.RECORD).json(record_files(spark, sf))
    rows = stream.select(*bridge.UNIT, F.size("cabins").alias("cabins"))
    return ev.run_to_files(rows, "ingest").groupBy("carrier", "season").agg(
        F.count("*").alias("records"), F.sum("cabins").alias("cabins"))


@query
def t2_event_stream(spark, sf):
    out = ev.run_to_files(ev.event_stream(spark, sf).withWatermark("ts", "10 minutes"), "events")
    return tally(out, "event", "status", "attempt")


@query
def s17_event_jsonl(spark, sf):
    """The event log as JSON lines in two deliveries with a restart between; every fiftieth line was cut in half by a crash."""
    path, base = scratch(spark, "event-log"), scratch(spark, "event-log-in")
    e = bridge.with_itinerary(ev.parsed(table(spark, sf, "events")), key="unit", season=False)
    log = e.select("event_id", *[c for c in ("ts", "event", "source", "carrier", "origin", "destination", "status", "brands", "attempt", "error")])
    lines = log.select("event_id", event_log.emit_line(log.drop("event_id").columns).alias("value"))
    cut = F.when(F.col("event_id") % 50 == 7, F.substr("value", F.lit(1), (F.length("value") / 2).cast("int"))).otherwise(F.col("value"))
    for part in (0, 1):
        lines.where(F.col("event_id") % 2 == part).select(cut.alias("value")).write.mode("append").text(path)
        good, broken = event_log.take_in(spark, path, base)
    kept = good.groupBy("event", "carrier", "source", "status").agg(F.count("*").alias("n"), F.sum("brands").alias("brands"), F.max("ts").alias("ts"))
    side = broken.agg(F.lit("(broken)").alias("event"), F.lit("").alias("carrier"), F.lit("").alias("source"), F.lit("").alias("status"),
                      F.count("*").alias("n"), F.lit(None).cast("bigint").alias("brands"), F.lit(None).cast("timestamp").alias("ts"))
    return kept.unionByName(side).select("event", "carrier", "source", "status", "n", "brands", F.date_format("ts", STAMP).alias("last"))


@query
def t3_strongest_per_unit(spark, sf):
    return ev.keep_strongest(ev.event_stream(spark, sf), "strongest")


@query
def t4_exactly_once(spark, sf):
    """The same checkpoint run twice: the second start finds nothing left to do."""
    base = scratch(spark, "once")
    stream = ev.event_stream(spark, sf)
    ev.run_to_files(stream, "once", base=base)
    out = ev.run_to_files(ev.event_stream(spark, sf), "once", base=base)
    return out.agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("events"))


@query
def t5_throughput(spark, sf):
    """Finished units in the last ten minutes, minute by minute, with the time left; the plan is one unit per itinerary."""
    rate = ev.run_to_latest(ev.throughput(ev.event_stream(spark, sf)), "rate", ["start", "end"])
    finishes = ev.run_to_latest(ev.first_finishes(ev.event_stream(spark, sf)), "finishes", ["unit"])
    return ev.eta_minutes(rate, finishes, table(spark, sf, "customer").agg(F.count("*"))).select(text("start"), text("end"), "finished", "per_minute", "eta_minutes")


def log_lines(spark, sf):
    """The event log as the text runs write into one log a month: a header at the start of each half day, no run on the lines."""
    e = ev.parsed(table(spark, sf, "events")).where("event <> 'start'")
    stamp, half = F.date_format("ts", STAMP), F.floor(F.hour("ts") / 12)
    line = F.concat_ws(" | ", stamp, F.concat(F.lit("unit"), F.col("unit").cast("string")),
                       F.col("status"), F.concat(F.lit("brands="), F.col("brands").cast("string"),
                                                 F.when(F.col("attempt") == 4, " falling back").otherwise("")))
    log = F.date_format("ts", "yyyy-MM")
    heads = e.groupBy(F.to_date("ts").alias("day"), half.alias("half")).agg(F.count("*").alias("n"), F.min("ts").alias("ts"))
    head = F.concat_ws(" | ", stamp, F.concat(F.lit("Units: "), F.col("n").cast("string"), F.lit(" total, "), F.col("n").cast("string"),
                                              F.lit(" pending, "), (F.dayofmonth("ts") % 5).cast("string"), F.lit(" skipped")))
    return e.select(log.alias("log"), "ts", line.alias("value")).unionByName(heads.select(log.alias("log"), "ts", head.alias("value")))


@query
def t6_run_tallies(spark, sf):
    """Counts that start again at every header; the second delivery goes on in the middle of a run."""
    path, base = scratch(spark, "log"), scratch(spark, "tallies")
    lines = log_lines(spark, sf)
    early = (F.dayofmonth("ts") < 15) | (F.dayofmonth("ts") == 15) & (F.hour("ts") < 6)
    for part in (early, ~early):
        lines.where(part).select("log", "value").write.mode("append").partitionBy("log").text(path)
        logs = spark.readStream.schema("value string, log string").text(path)
        out = ev.run_tallies(ev.parse_log(logs), "tallies", base)
    return out


@query
def t6_per_minute(spark, sf):
    """Tumbling view of the outcomes."""
    e = ev.event_stream(spark, sf).withWatermark("ts", "10 minutes")
    t = ev.tallies(e, F.window("ts", "1 hour").alias("w"))
    out = ev.run_to_latest(t.select(F.col("w.start").alias("start"), "outcomes", "succeeded", "partial", "failed", "brands"), "hourly", ["start"])
    return out.select(text("start"), "outcomes", "succeeded", "partial", "failed", "brands")


@query
def t7_idle_sessions(spark, sf):
    """Two deliveries, the second from the middle of a day on; spans that reach over the break are one."""
    path, base = scratch(spark, "in-two"), scratch(spark, "sessions")
    raw = table(spark, sf, "events")
    early = (F.dayofmonth("ts") < 15) | (F.dayofmonth("ts") == 15) & (F.hour("ts") < 6)
    newest = F.lit(raw.agg(F.date_trunc("month", F.max("ts"))).first()[0])
    first = (F.date_trunc("month", "ts") < newest) | early
    for part, folder in ((first, "a"), (~first, "b")):
        raw.where(part).write.parquet(f"{path}/{folder}")
        stream = spark.readStream.schema(ev.EVENT).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
        out = ev.run_sessions(ev.of_run(ev.parsed(stream)), "sessions", base=base)
    return out.select("run_id", text("start"), text("end"), "events")


@query
def t8_live_health(spark, sf):
    """The publish gate of each run."""
    return ev.run_to_latest(ev.health(ev.of_run(ev.event_stream(spark, sf)), "run_id"), "health", ["run_id"])


@query
def t9_late_records(spark, sf):
    """Two deliveries with a restart between; rows of the second that are too old go to the side table."""
    path, base = scratch(spark, "two"), scratch(spark, "late")
    raw = table(spark, sf, "events")
    for part, folder in ((0, "a"), (1, "b")):
        raw.where(F.col("event_id") % 2 == part).write.parquet(f"{path}/{folder}")
        stream = spark.readStream.schema(ev.EVENT).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
        on_time, late = ev.route_late(ev.parsed(stream), "2 days", base)
    kept = ev.strongest(on_time).withColumn("is_late", F.lit(False))
    side = ev.strongest(late).withColumn("is_late", F.lit(True))
    return kept.unionByName(side)


@query
def t10_stream_static_join(spark, sf):
    out = ev.run_to_files(ev.with_static(ev.event_stream(spark, sf), bridge.CARRIERS), "static")
    return tally(out, "carrier", "airline_name", "event")


@query
def t11_retries_per_unit(spark, sf):
    return ev.run_to_latest(ev.retries(ev.event_stream(spark, sf)), "retries", ["unit"])
