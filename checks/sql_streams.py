"""SQL for the streaming queries: what a batch over the whole log gives."""

from .cte import C, build as b, itin

SQL = {}
C["ev"] = """SELECT event_id, ts, user_id AS unit, CASE event_type WHEN 'click' THEN 'start' WHEN 'error' THEN 'retry' ELSE 'end' END AS event,
  CASE event_type WHEN 'view' THEN 'success' WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'partial' WHEN 'error' THEN 'failed' ELSE '' END AS status,
  CAST(props->>'$.k' AS INT)%8 AS brands, CAST(props->>'$.k' AS INT)%5 AS attempt, CASE WHEN event_type='error' THEN 'error ' || (props->>'$.k') END AS error FROM events"""
st = lambda x, n: f"strftime({x}, '%Y-%m-%d %H:%M:%S') AS {n}"
SQL["t1_ingest_records"] = b("SELECT carrier, season, count(*) AS records, CAST(sum(k) AS BIGINT) AS cabins FROM (SELECT carrier, origin, destination, season, pass_no, count(DISTINCT group_cabin) AS k FROM results GROUP BY ALL) GROUP BY ALL")
SQL["t2_event_stream"] = b("SELECT event, status, attempt, count(*) AS n FROM ev GROUP BY ALL")


def strongest(src):
    return f"""SELECT unit, brands, attempt, event_id, seen FROM (SELECT *, count(*) OVER (PARTITION BY unit) AS seen, row_number() OVER (PARTITION BY unit ORDER BY brands DESC, attempt DESC, ts DESC, event_id DESC) AS rn
      FROM {src} WHERE event='end') WHERE rn=1"""


SQL["t3_strongest_per_unit"] = b(strongest("ev"))
SQL["t4_exactly_once"] = "SELECT count(*) AS rows, count(DISTINCT event_id) AS events FROM events"
C["rate"] = "SELECT date_trunc('minute', ts) - to_minutes(i) AS s, count(*) AS finished FROM ev, range(0,10) r(i) WHERE event='end' GROUP BY ALL"
C["first_done"] = "SELECT date_trunc('minute', min(ts)) + INTERVAL 1 MINUTE AS m FROM ev WHERE event='end' GROUP BY unit"
C["done_marks"] = "SELECT m, sum(n) AS n FROM (SELECT m, 1 AS n FROM first_done UNION ALL SELECT s + INTERVAL 10 MINUTE, 0 FROM rate) GROUP BY m"
C["done_by"] = "SELECT m, sum(n) OVER (ORDER BY m) AS done FROM done_marks"
SQL["t5_throughput"] = b(f"""SELECT {st('s', 'start')}, {st("m", '"end"')}, finished, finished/CAST(10 AS DOUBLE) AS per_minute,
  CAST(floor(greatest((SELECT count(*) FROM customer)-done,0)/(finished/CAST(10 AS DOUBLE))+0.5) AS BIGINT) AS eta_minutes FROM rate JOIN done_by ON m = s + INTERVAL 10 MINUTE""")
C["unit_ev"] = f"SELECT *, {itin('unit', dates=False)} FROM ev"
SQL["s17_event_jsonl"] = b(f"""SELECT event, carrier, source, status, count(*) AS n, CAST(sum(brands) AS BIGINT) AS brands, {st('max(ts)', 'last')} FROM unit_ev WHERE event_id%50<>7 GROUP BY event, carrier, source, status
  UNION ALL SELECT '(broken)', '', '', '', count(*), NULL, NULL FROM ev WHERE event_id%50=7""")
C["log"] = "SELECT *, 'run' || strftime(ts, '%Y%m%d') AS run_id FROM ev WHERE event<>'start'"
SQL["t6_run_tallies"] = b("""SELECT strftime(ts, '%Y-%m') AS log, run, CAST(max(skipped) AS INT) AS skipped, count(*) FILTER (t) AS terminal, count(*) FILTER (t AND status IN ('success','partial')) AS ok, count(*) FILTER (t AND status='no_availability') AS empty,
  count(*) FILTER (t AND status='failed') AS failed, CAST(coalesce(sum(brands) FILTER (t), 0) AS BIGINT) AS brands FROM (SELECT *, attempt<>4 AS t, strftime(first, '%Y-%m-%d %H:%M:%S') AS run, day(first)%5 AS skipped
   FROM (SELECT *, min(ts) OVER (PARTITION BY CAST(ts AS DATE), hour(ts)//12) AS first FROM log)) GROUP BY ALL""")
SQL["t6_per_minute"] = b(f"""SELECT {st("date_trunc('hour', ts)", 'start')}, count(*) AS outcomes, count(*) FILTER (status='success') AS succeeded, count(*) FILTER (status='partial') AS partial,
  count(*) FILTER (status='failed') AS failed, CAST(sum(brands) AS BIGINT) AS brands FROM log GROUP BY date_trunc('hour', ts)""")
SQL["t7_idle_sessions"] = b(f"""SELECT run_id, {st('min(ts)', 'start')}, {st("max(ts) + INTERVAL 300 SECOND", '"end"')}, count(*) AS events FROM (SELECT *, count(*) FILTER (gap) OVER (PARTITION BY run_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sess FROM (
  SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY run_id ORDER BY ts, event_id) + INTERVAL 300 SECOND, TRUE) AS gap FROM (SELECT *, 'run' || strftime(ts, '%Y%m%d') AS run_id FROM ev))) GROUP BY run_id, sess""")
SQL["t8_live_health"] = b("""SELECT run_id, outcomes, good AS succeeded, NOT (outcomes>20 AND good*100//outcomes<25) AS may_continue FROM (SELECT run_id, count(*) AS outcomes, count(*) FILTER (status='success') AS good FROM log GROUP BY ALL)""")
C["late"] = "SELECT *, event_id%2=1 AND ts < (SELECT max(ts) FROM ev WHERE event_id%2=0) - INTERVAL 2 DAY AS is_late FROM ev"
SQL["t9_late_records"] = b(f"SELECT *, FALSE AS is_late FROM ({strongest('(SELECT * FROM late WHERE NOT is_late)')}) UNION ALL SELECT *, TRUE FROM ({strongest('(SELECT * FROM late WHERE is_late)')})")
from stairfare.sources.bridge import CARRIERS  # noqa: E402
from .cte import pick  # noqa: E402
SQL["t10_stream_static_join"] = b(f"SELECT carrier, coalesce(airline_name, carrier) AS airline_name, event, count(*) AS n FROM (SELECT *, {pick(CARRIERS, 'unit % 25')} AS carrier FROM ev) LEFT JOIN airlines ON carrier=dim_carrier GROUP BY ALL")
SQL["t11_retries_per_unit"] = b("SELECT unit, count(*) AS retries, max(attempt) AS attempts, max({'t': ts, 'i': event_id, 'e': error}).e AS last_error FROM ev WHERE event='retry' GROUP BY ALL".replace("max({'t': ts, 'i': event_id, 'e': error}).e", "(max({'t': ts, 'i': event_id, 'e': error})).e"))
