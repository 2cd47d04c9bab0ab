"""Figures of the event log on small literal logs."""

import datetime as dt
import json

import pandas as pd

from stairfare.catalog import streams
from stairfare.sources import event_log
from stairfare.streaming import events as ev

DAY = dt.datetime(2024, 1, 1)


def folder(spark, path, minutes, planned):
    """Event files in which unit ``i`` finishes at minute ``minutes[i]``, and a plan of so many units."""
    rows = [(n, DAY + dt.timedelta(minutes=m, seconds=5), unit, "view", 1.0, '{"k": 1}') for n, (unit, m) in enumerate(minutes)]
    df = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])
    df.astype({"ts": "datetime64[us]"}).to_parquet(f"{path}/events.parquet")
    spark.range(planned).withColumnRenamed("id", "c_custkey").write.parquet(f"{path}/customer.parquet")


def test_time_left_counts_all_finished_units_of_the_plan(spark, tmp_path):
    finished = [(u, u // 15) for u in range(150)] + [(3, 1430)] + [(u, 1445) for u in range(150, 160)]  # unit 3 again; the last ones a day on
    folder(spark, str(tmp_path), finished, 250)
    got = {r.end: r for r in streams.t5_throughput(spark, str(tmp_path)).collect()}
    assert (got["2024-01-01 00:10:00"].finished, got["2024-01-01 00:10:00"].eta_minutes) == (150, 7)  # 100 left at 15 a minute
    assert (got["2024-01-01 00:01:00"].finished, got["2024-01-01 00:01:00"].eta_minutes) == (15, 157)  # 235 left at 1.5
    assert (got["2024-01-01 00:19:00"].finished, got["2024-01-01 00:19:00"].eta_minutes) == (15, 67)  # 100 left at 1.5
    assert (got["2024-01-02 00:06:00"].finished, got["2024-01-02 00:06:00"].eta_minutes) == (10, 90)  # 90 left at 1


def arrives(path, name, lines):
    (path / name).parent.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("".join(x + "\n" for x in lines))


def test_a_second_header_restarts_the_counts_also_across_batches(spark, tmp_path):
    logs, base = tmp_path / "logs", str(tmp_path / "tallies")
    stream = lambda: ev.parse_log(spark.readStream.schema("value string, log string").text(str(logs)))
    done = lambda t, s="success", n=2, more="": f"2026-01-01 {t} | unit1 | {s} | brands={n}{more}"
    arrives(logs, "log=a/1", [done("09:00:00"), "2026-01-01 10:00:00 | Units: 9 total, 9 pending, 4 skipped", done("10:00:00"), done("10:05:00", "failed", 0),
                              done("10:06:00", "success", 3, " falling back"), "noise"])
    arrives(logs, "log=b/1", [done("08:00:00", "no_availability", 0)])
    first = {(r.log, r.run): r for r in ev.run_tallies(stream(), "tallies", base).collect()}
    assert (first["a", "2026-01-01 10:00:00"].terminal, first["a", None].terminal, first["b", None].empty) == (2, 1, 1)
    arrives(logs, "log=a/2", [done("10:30:00"), "2026-01-01 11:00:00 | Units: 9 total, 5 pending, 6 skipped", done("11:30:00", "partial", 5)])
    got = {(r.log, r.run): (r.skipped, r.terminal, r.ok, r.empty, r.failed, r.brands) for r in ev.run_tallies(stream(), "tallies", base).collect()}
    assert got == {("a", None): (0, 1, 1, 0, 0, 2), ("a", "2026-01-01 10:00:00"): (4, 3, 2, 0, 1, 4), ("a", "2026-01-01 11:00:00"): (6, 1, 1, 0, 0, 5),
                   ("b", None): (0, 1, 0, 1, 0, 0)}
    assert sorted(ev.run_tallies(stream(), "tallies", base).collect(), key=str) == sorted(ev.run_tallies(stream(), "tallies", str(tmp_path / "once")).collect(), key=str)


def log_of(spark, path):
    return spark.readStream.schema(ev.EVENT).option("recursiveFileLookup", True).parquet(str(path))


def events(path, name, rows):
    """Event files: ``(event id, minute, unit, kind, brands)``."""
    out = [(i, DAY + dt.timedelta(minutes=m), unit, kind, 1.0, '{"k": %d}' % k) for i, m, unit, kind, k in rows]
    path.mkdir(exist_ok=True)
    pd.DataFrame(out, columns=["event_id", "ts", "user_id", "event_type", "value", "props"]).astype({"ts": "datetime64[us]"}).to_parquet(path / name)


def test_spans_go_on_after_a_restart_and_closed_ones_are_not_written_again(spark, tmp_path):
    path, base = tmp_path / "in", tmp_path / "spans"
    run = lambda b: sorted((r.start, r.end, r.events) for r in ev.run_sessions(ev.of_run(ev.parsed(log_of(spark, path))), "spans", base=str(b)).collect())
    events(path, "a.parquet", [(1, 0, 1, "view", 1), (2, 4, 1, "view", 1), (3, 60, 1, "view", 1)])
    assert [n for _, _, n in run(base)] == [2, 1]
    before = {f: f.stat().st_mtime_ns for f in (base / "closed").rglob("*.parquet")}
    events(path, "b.parquet", [(4, 64, 2, "view", 1), (5, 120, 2, "view", 1), (6, 1, 2, "view", 1)])  # the last one comes too late
    got = run(base)
    assert [(s, n) for s, _, n in got] == [(DAY, 2), (DAY + dt.timedelta(hours=1), 2), (DAY + dt.timedelta(hours=2), 1)]
    assert got == run(base) and all(f.stat().st_mtime_ns == t for f, t in before.items())


def test_state_of_a_finished_run_is_gone_and_late_records_change_nothing(spark, tmp_path):
    path, base = tmp_path / "in", str(tmp_path / "strongest")
    run = lambda: {r.unit: (r.brands, r.event_id, r.seen) for r in ev.keep_strongest(ev.parsed(log_of(spark, path)), "s", base, delay="1 hour").collect()}
    events(path, "a.parquet", [(1, 0, 1, "view", 3), (2, 5, 1, "view", 5), (3, 7, 2, "view", 2)])
    assert run() == {1: (5, 2, 2), 2: (2, 3, 1)}
    events(path, "b.parquet", [(4, 4 * 1440, 1, "view", 4)])
    assert run() == {1: (5, 2, 3), 2: (2, 3, 1)}
    events(path, "c.parquet", [(5, 1, 1, "view", 1), (6, 2, 2, "view", 7), (7, 4 * 1440 + 1, 2, "view", 3)])  # the first day is over
    assert run() == {1: (5, 2, 3), 2: (3, 7, 2)}
    state = spark.read.format("statestore").load(f"{base}/state")
    assert {r.d.date() for r in state.selectExpr("key.window.start as d").collect()} == {(DAY + dt.timedelta(days=4)).date()}


def test_event_lines_in_two_deliveries_equal_one(spark, tmp_path):
    path, base = tmp_path / "log", str(tmp_path / "taken")
    line = lambda n, **more: json.dumps({"ts": f"2026-01-01T00:00:0{n}.250+00:00", "event": "end", "carrier": "TK", "brands": n, **more})
    arrives(path, "a.jsonl", [line(1), "", line(2, error="söz, \"x\"")[:30]])
    event_log.take_in(spark, str(path), base)
    arrives(path, "b.jsonl", [line(3, unknown=[1]), line(4, status="success")])
    good, broken = event_log.take_in(spark, str(path), base)
    assert sorted((r.brands, r.status, r.ts.microsecond) for r in good.collect()) == [(1, None, 250000), (3, None, 250000), (4, "success", 250000)]
    assert [r._broken for r in broken.collect()] == [line(2, error="söz, \"x\"")[:30]]
    again, side = event_log.take_in(spark, str(path), str(tmp_path / "once"))
    assert sorted(map(str, again.collect())) == sorted(map(str, good.collect())) and side.count() == 1
