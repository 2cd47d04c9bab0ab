"""The run's event log as a stream: progress, health, retries, late arrivals.

Sources are file streams, sinks are files with a checkpoint, so a restarted query goes on
where it stopped.  State is kept by built-in aggregates.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.names import literal_map
from ..operators import geography, quality
from ..sources.tables import scratch, written

EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
OUTCOME = {"view": "success", "purchase": "success", "signup": "partial", "error": "failed"}


def event_stream(spark: SparkSession, folder: str, name="events.parquet") -> DataFrame:
    """Event files of a folder as they arrive."""
    raw = spark.readStream.schema(EVENT).option("pathGlobFilter", name).parquet(folder)
    return parsed(raw)


def parsed(raw: DataFrame) -> DataFrame:
    """Columns of the run log: event, unit, status, brands and attempt."""
    k = F.get_json_object("props", "$.k").cast("int")
    event = F.when(F.col("event_type") == "click", "start").when(F.col("event_type") == "error", "retry").otherwise("end")
    status = F.element_at(literal_map(OUTCOME.items()), F.col("event_type"))
    return raw.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("unit"), event.alias("event"),
        F.coalesce(status, F.lit("")).alias("status"), (k % 8).alias("brands"), (k % 5).alias("attempt"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("error "), k.cast("string"))).alias("error"))


def run_to_files(stream: DataFrame, label: str, mode="append", schema=None, base=None) -> DataFrame:
    """Process what is there with a checkpointed file sink and read the sink."""
    spark = stream.sparkSession
    base = base or scratch(spark, label)
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{base}/out") \
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(schema or stream.schema).parquet(f"{base}/out")


def run_to_latest(stream: DataFrame, label: str, keys, base=None) -> DataFrame:
    """The latest result of each key after what has arrived so far.

    A micro-batch writes only the keys it changed, under its own number, so a batch that runs again
    rewrites its own folder.  The sink is read, not remembered: started again with the same ``base``,
    the query goes on where it stopped, and with nothing new it gives what it gave before.
    """
    spark = stream.sparkSession
    base = base or scratch(spark, label)
    out = f"{base}/out"

    def write(df, batch):
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")
    if not written(spark, f"{out}/batch=-1"):
        write(spark.createDataFrame([], stream.schema), -1)  # a stream without any file has an empty result
    q = stream.writeStream.outputMode("update").foreachBatch(write) \
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    rest = [c for c in stream.columns if c not in keys]
    schema = StructType([*stream.schema.fields, StructField("batch", LongType())])
    return spark.read.schema(schema).parquet(out).groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")) \
        .select(*[c if c in keys else F.col(f"r.{c}").alias(c) for c in stream.columns])


def run_sessions(events: DataFrame, label: str, gap="300 seconds", delay="10 minutes", base=None) -> DataFrame:
    """Active spans of each run: ``run_id, start, end, events``; silence longer than ``gap`` ends a span.

    A batch joins its spans to those still open from the batch before.  A span that ended ``delay`` before the
    newest event is closed: it is appended once and not touched again; the open ones, one or two a run, go
    into the batch's own folder.  Events older than ``delay`` when their batch starts come too late and are left
    out.  With the same ``base`` a later start goes on; the result is the closed spans and the open ones.
    """
    spark = events.sparkSession
    base = base or scratch(spark, label)
    spans = "run_id string, start timestamp, `end` timestamp, events bigint"
    micros = lambda x: int(x) if x is not None else None

    def write(df, batch):
        session = df.sparkSession
        opened = f"{spans}, newest bigint"
        before = session.read.schema(opened).parquet(f"{base}/open/batch={batch - 1}") if batch >= 0 else session.createDataFrame([], opened)
        last = micros(before.agg(F.max("newest")).first()[0])
        fresh = df if last is None else df.where(F.col("ts") >= F.timestamp_micros(F.lit(last)) - F.expr(f"interval {delay}"))
        new = fresh.groupBy("run_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events")) \
            .select("run_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")
        both = new.unionByName(before.where("run_id is not null").drop("newest"))
        w = Window.partitionBy("run_id").orderBy("start", "end")
        upto = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
        both.withColumn("fresh", F.coalesce(F.col("start") > upto, F.lit(True)).cast("int")) \
            .withColumn("span", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
            .groupBy("run_id", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("events").alias("events")).drop("span") \
            .write.mode("overwrite").parquet(f"{base}/joined/batch={batch}")
        joined = session.read.schema(spans).parquet(f"{base}/joined/batch={batch}")
        now = micros(joined.agg(F.unix_micros(F.max("end") - F.expr(f"interval {gap}"))).first()[0])
        newest = F.lit(max((t for t in (last, now) if t is not None), default=None)).cast("bigint")
        closed = F.coalesce(F.col("end") < F.timestamp_micros(newest) - F.expr(f"interval {delay}"), F.lit(False))
        joined.where(closed).write.mode("overwrite").parquet(f"{base}/closed/batch={batch}")
        # a row without a run carries the newest time on, also when no span is open
        mark = session.createDataFrame([(None, None, None, None)], spans)
        joined.where(~closed).unionByName(mark).withColumn("newest", newest).write.mode("overwrite").parquet(f"{base}/open/batch={batch}")
    if not written(spark, f"{base}/open/batch=-1"):
        write(spark.createDataFrame([], events.schema), -1)
    q = events.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    opened = spark.read.schema(f"{spans}, batch long").parquet(f"{base}/open")
    latest = opened.agg(F.max("batch")).first()[0]
    return spark.read.schema(f"{spans}, batch long").parquet(f"{base}/closed").drop("batch").unionByName(opened.where((F.col("batch") == latest) & F.col("run_id").isNotNull()).drop("batch"))


def throughput(events: DataFrame, width="10 minutes", slide="1 minute") -> DataFrame:
    """Finished units per sliding window and their rate."""
    done = events.where("event = 'end'").withWatermark("ts", "10 minutes")
    return done.groupBy(F.window("ts", width, slide).alias("w")).agg(F.count("*").alias("finished")) \
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "finished",
                (F.col("finished") / 10.0).alias("per_minute"))


def first_finishes(events: DataFrame) -> DataFrame:
    """When each unit finished first; finished again it is no further progress."""
    return events.where("event = 'end'").groupBy("unit").agg(F.min("ts").alias("ts"))


def eta_minutes(rate: DataFrame, finishes: DataFrame, total: DataFrame) -> DataFrame:
    """Units of the plan not finished by the window's end over the window's rate.

    ``total`` is one row with the plan's size.  Finishes are counted per minute and summed within each
    day, days on top, so that no task sorts the whole log.
    """
    minute = finishes.groupBy((F.date_trunc("minute", "ts") + F.expr("interval 1 minute")).alias("end")).agg(F.count("*").alias("n"))
    marks = minute.unionByName(rate.select("end", F.lit(0).cast("bigint").alias("n"))).groupBy("end").agg(F.sum("n").alias("n")) \
        .withColumn("day", F.to_date("end"))
    days = marks.groupBy("day").agg(F.sum("n").alias("n"))
    before = days.select("day", (F.sum("n").over(Window.orderBy("day")) - F.col("n")).alias("before"))
    done = marks.join(before, "day").select("end", (F.sum("n").over(Window.partitionBy("day").orderBy("end")) + F.col("before")).alias("done"))
    left = F.greatest(F.col("total") - F.col("done"), F.lit(0))
    return rate.join(done, "end").crossJoin(F.broadcast(total.select(F.col(total.columns[0]).alias("total")))) \
        .withColumn("eta_minutes", F.floor(left / F.col("per_minute") + 0.5).cast("bigint"))


def of_run(events: DataFrame) -> DataFrame:
    """Events with the run they belong to: one a day."""
    return events.withColumn("run_id", F.concat(F.lit("run"), F.date_format("ts", "yyyyMMdd")))


def tallies(events: DataFrame, *keys) -> DataFrame:
    s = F.col("status")
    n = lambda c: F.count(F.when(c, 1))
    return events.where("event = 'end' or event = 'retry'").groupBy(*keys).agg(
        F.count("*").alias("outcomes"), n(s == "success").alias("succeeded"), n(s == "partial").alias("partial"),
        n(s == "failed").alias("failed"), F.sum("brands").alias("brands"))


def health(events: DataFrame, *keys) -> DataFrame:
    """The publish gate over the outcomes so far."""
    t = tallies(events, *keys)
    return t.select(*keys, "outcomes", "succeeded",
                    quality.publish_gate(F.col("outcomes"), F.col("succeeded")).alias("may_continue"))


def strongest(events: DataFrame) -> DataFrame:
    """Strongest record per unit so far: more brands, more attempts, the later event.

    A weaker record that arrives late loses the comparison, so it changes nothing.
    """
    best = F.max(F.struct("brands", "attempt", "ts", "event_id"))
    return events.where("event = 'end'").groupBy("unit").agg(best.alias("b"), F.count("*").alias("seen")) \
        .select("unit", "b.brands", "b.attempt", "b.event_id", "seen")


def strongest_per_run(events: DataFrame, run="1 day", delay="2 days") -> DataFrame:
    """Strongest record per run and unit.  The watermark ends a run's state; rows behind it change nothing."""
    best = F.max(F.struct("brands", "attempt", "ts", "event_id"))
    return events.where("event = 'end'").withWatermark("ts", delay).groupBy(F.window("ts", run).alias("w"), "unit") \
        .agg(best.alias("b"), F.count("*").alias("seen")).select(F.col("w.start").alias("run"), "unit", "b", "seen")


def keep_strongest(events: DataFrame, label: str, base=None, **runs) -> DataFrame:
    """Of each unit the strongest record of all runs so far: ``unit, brands, attempt, event_id, seen``.

    State is kept for runs the watermark has not passed; finished ones are rows of the sink, a unit and run each,
    and are compared when they are read.  What comes too late belongs to the side table of :func:`route_late`.
    """
    rows = run_to_latest(strongest_per_run(events, **runs), label, ["run", "unit"], base)
    return rows.groupBy("unit").agg(F.max("b").alias("b"), F.sum("seen").alias("seen")).select("unit", "b.brands", "b.attempt", "b.event_id", "seen")


def retries(events: DataFrame) -> DataFrame:
    """Retry count, highest attempt and last error per unit."""
    return events.where("event = 'retry'").groupBy("unit").agg(
        F.count("*").alias("retries"), F.max("attempt").alias("attempts"),
        F.max(F.struct("ts", "event_id", "error")).alias("e")) \
        .select("unit", "retries", "attempts", F.col("e.error").alias("last_error"))


LOG_LINE = r"^(\S+ \S+) \| \S+ \| (success|no_availability|failed|partial) \| brands=(\d+)"
RUN_HEADER = r"^(\S+ \S+) \| Units: (\d+) total, (\d+) pending, (\d+) skipped"


def parse_log(lines: DataFrame) -> DataFrame:
    """Terminal lines and run headers of text logs; 'falling back' lines are not terminal.

    Which run a line belongs to is not written on it.  Needs ``log`` beside ``value``.
    """
    v = F.col("value")
    head = v.rlike(RUN_HEADER)
    out = lines.where(head | (v.rlike(LOG_LINE) & ~v.contains("falling back")))
    return out.select(
        "log", F.when(head, F.regexp_extract(v, RUN_HEADER, 1)).otherwise(F.regexp_extract(v, LOG_LINE, 1)).alias("at"),
        F.when(head, "header").otherwise("end").alias("event"), F.regexp_extract(v, LOG_LINE, 2).alias("status"),
        F.when(~head, F.regexp_extract(v, LOG_LINE, 3).cast("int")).otherwise(0).alias("brands"),
        F.when(head, F.regexp_extract(v, RUN_HEADER, 4).cast("int")).otherwise(0).alias("skipped"))


def run_tallies(parsed_log: DataFrame, label: str, base=None) -> DataFrame:
    """Outcomes of each run of each log: ``log, run, skipped, terminal, ok, empty, failed, brands``.

    A header starts a run and its counts anew; a line belongs to the last header at or before it, or to the
    run without a header (null).  The headers of each log so far are the state: a batch reads those of the batch
    before, adds its own and writes them under its number, beside the counts of its lines.  So a run
    goes on from one batch to the next, and from one start to the next with the same ``base``.  Headers
    are few; lines are counted before they meet them.
    """
    spark = parsed_log.sparkSession
    base = base or scratch(spark, label)
    heads = "log string, run string, skipped int"
    counts = ("terminal", "ok", "empty", "failed", "brands")

    def write(df, batch):
        session = df.sparkSession
        old = session.read.schema(heads).parquet(f"{base}/headers/batch={batch - 1}") if batch >= 0 else session.createDataFrame([(None, None, None)], heads)
        new = df.where("event = 'header'").select("log", F.col("at").alias("run"), "skipped")
        old.unionByName(new).groupBy("log", "run").agg(F.max("skipped").alias("skipped")) \
            .write.mode("overwrite").parquet(f"{base}/headers/batch={batch}")
        known = session.read.schema(heads).parquet(f"{base}/headers/batch={batch}") \
            .groupBy("log").agg(F.sort_array(F.collect_list("run")).alias("runs"))
        s = F.col("status")
        n = lambda c: F.count(F.when(c, 1))
        lines = df.where("event = 'end'").groupBy("log", "at").agg(
            F.count("*").alias("terminal"), n(s.isin("success", "partial")).alias("ok"), n(s == "no_availability").alias("empty"),
            n(s == "failed").alias("failed"), F.sum("brands").alias("brands"))
        run = F.array_max(F.filter("runs", lambda r: r <= F.col("at")))
        lines.join(known, "log", "left").withColumn("run", run).groupBy("log", "run").agg(*[F.sum(c).alias(c) for c in counts]) \
            .write.mode("overwrite").parquet(f"{base}/counts/batch={batch}")
    if not written(spark, f"{base}/counts/batch=-1"):
        write(spark.createDataFrame([], parsed_log.schema), -1)
    q = parsed_log.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.schema(f"log string, run string, {', '.join(f'{c} bigint' for c in counts)}, batch long").parquet(f"{base}/counts").drop("batch")
    headers = spark.read.schema(f"{heads}, batch long").parquet(f"{base}/headers")  # a row without a log marks every batch
    latest = headers.agg(F.max("batch")).first()[0]
    now = headers.where((F.col("batch") == latest) & F.col("log").isNotNull()).drop("batch")
    both = rows.withColumn("skipped", F.lit(None).cast("int")).unionByName(now.select("*", *[F.lit(0).cast("bigint").alias(c) for c in counts]))
    return both.groupBy("log", "run").agg(F.coalesce(F.max("skipped"), F.lit(0)).alias("skipped"), *[F.sum(c).alias(c) for c in counts])


def route_late(stream: DataFrame, delay: str, base: str):
    """(on time, late): rows older than the newest earlier batch minus the delay go aside.

    Every batch leaves the newest time so far beside its rows, under its own number, so a batch that
    runs again reads the same mark and writes the same rows; a later start with ``base`` goes on.
    """
    spark = stream.sparkSession

    def write(df, batch):
        session = df.sparkSession
        mark = session.read.parquet(f"{base}/mark/batch={batch - 1}").first()[0] if batch > 0 else None
        limit = F.lit(mark) - F.expr(f"interval {delay}") if mark is not None else None
        late = (F.col("ts") < limit) if limit is not None else F.lit(False)
        df.withColumn("is_late", late).write.mode("overwrite").parquet(f"{base}/rows/batch={batch}")
        newest = F.max("ts") if mark is None else F.greatest(F.max("ts"), F.lit(mark))
        df.agg(newest.alias("ts")).write.mode("overwrite").parquet(f"{base}/mark/batch={batch}")
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/state") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.parquet(f"{base}/rows")
    return rows.where("not is_late"), rows.where("is_late")


def with_static(events: DataFrame, carriers) -> DataFrame:
    """Stream joined to the fixed carrier list."""
    codes = F.array(*[F.lit(c) for c in carriers])
    df = events.withColumn("carrier", F.element_at(codes, (F.col("unit") % len(carriers) + 1).cast("int")))
    return geography.with_airline(df)
