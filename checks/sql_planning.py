"""SQL for job lists, work plans, identity filters and enrichment."""

import re

from stairfare.rules import places, rights as R

from . import cte as c
from .cte import C, U, build as b, key
from .sql_ladders import FL
from .sql_texts import tally

SQL = {}
route = f"(origin || {c.pick(['-', '/', '_', '>'], 'pos % 4')} || destination)"
C["listed"] = f"""SELECT *, CASE WHEN pos%9=0 THEN '' ELSE carrier END AS cc,
  CASE WHEN pos%10=9 THEN origin || '-' WHEN pos%3=0 THEN lower({route}) ELSE {route} END AS ond FROM job_rows"""
SQL["s1_job_list_csv"] = b("""SELECT carrier, origin, destination, pos, c_mktsegment AS segment FROM job_rows
  QUALIFY row_number() OVER (PARTITION BY carrier, origin, destination ORDER BY pos)=1""")
SQL["p1_split_routes"] = b("SELECT ond, CASE WHEN pos%10<>9 THEN origin END AS o, CASE WHEN pos%10<>9 THEN destination END AS d, count(*) AS n FROM listed GROUP BY ALL")
SQL["p2_usable_rows"] = b("""SELECT cc AS carrier, origin, destination, count(*) AS n, min(pos) AS first_pos, max(c_mktsegment) AS segment, CAST(4 AS INT) AS passed
  FROM listed WHERE cc<>'' AND pos%10<>9 GROUP BY ALL""")
SQL["w17_first_request"] = b("SELECT cc AS carrier, origin, destination, min(pos) AS pos FROM listed WHERE cc<>'' AND pos%10<>9 GROUP BY ALL")
SQL["p13_valid_rows"] = b('SELECT cc<>\'\' AND pos%10<>9 AS valid, c_mktsegment AS "SEGMENT", count(*) AS n FROM listed GROUP BY ALL')
SQL["p14_rows_from_position"] = b("SELECT carrier, count(*) AS n FROM job_rows WHERE pos>=150 GROUP BY ALL")
C["planned"] = "SELECT carrier, origin, destination, season, min(pos) AS pos FROM job_rows, (VALUES ('Summer'),('Winter')) s(season) GROUP BY ALL"
C["completed"] = f"SELECT DISTINCT {U} FROM date_walk WHERE outcome='found' AND walk_block=3"
SQL["j12_pending_units"] = b(f"SELECT {U}, pos FROM planned ANTI JOIN completed USING ({U})")
SQL["j13_reload_completed"] = b(f"SELECT {U}, pass_no, packages FROM records SEMI JOIN completed USING ({U}) QUALIFY row_number() OVER (PARTITION BY {U} ORDER BY pass_no)=1")
SQL["j14_opportunistic_units"] = b(f"""SELECT {U} FROM (SELECT DISTINCT origin, destination FROM listing), (VALUES ('PC'),('VF')) x(carrier), (VALUES ('Summer'),('Winter')) s(season)
  WHERE (carrier, origin, destination) NOT IN (SELECT (carrier, origin, destination) FROM listing)""", listing="SELECT * FROM job_rows")
T = "DATE '2026-01-15'"


def in_season(d):
    return f"((month({d}) BETWEEN 4 AND 10) = (season='Summer'))"


def days(lo, hi):
    return f"list_transform(range({lo}, {hi}+1), lambda i: {T} + CAST(i AS INT))"


def cands(lo, hi):
    start = max(1, lo - 4)
    whole = f"list_filter({days(start, hi)}, lambda d: len(list_filter(range(0,5), lambda k: {in_season('(d + CAST(k AS INT))')})) = 5)"
    near = f"list_filter({days(start, hi)}, lambda d: {in_season('d')} AND d >= {T} + {lo})"
    return f"(CASE WHEN len({whole})>0 THEN {whole} ELSE {near} END)"


def choose(x, salt):
    num = f"CAST('0x' || substr(md5(origin || '|' || destination || '|' || season || '|7|{salt}'),1,8) AS BIGINT)"
    return f"({x})[{num} % greatest(len({x}),1) + 1]"


bands = [places.FAR_BAND] + [(a - s, a + s) for a, s in places.FALLBACK_BANDS]
near = ", ".join(f"{cands(lo, hi)} AS n{i}, {cands(max(1, lo - 90), hi + 90)} AS w{i}" for i, (lo, hi) in enumerate(bands))
picks = ", ".join(f"coalesce({choose(f'n{i}', i)}, {choose(f'w{i}', i)})" for i in range(4))
C["date_plan"] = f"""SELECT origin, destination, season, CAST(list_position(starts, s) AS INT) AS block_no, CAST(p AS INT) AS pos, s + CAST(p AS INT) AS departure, s + CAST(p+3 AS INT) AS return_date
  FROM (SELECT *, unnest(starts) AS s FROM (SELECT *, list_filter([p0, CASE WHEN p1 <> p0 OR p0 IS NULL THEN p1 END, CASE WHEN coalesce(p2 NOT IN (p0, p1), TRUE) THEN p2 END,
     CASE WHEN coalesce(p3 NOT IN (p0, p1, p2), TRUE) THEN p3 END], lambda z: z IS NOT NULL) AS starts FROM (
   SELECT origin, destination, season, {', '.join(f'coalesce({choose(f"n{i}", i)}, {choose(f"w{i}", i)}) AS p{i}' for i in range(4))} FROM (
    SELECT *, {near} FROM (SELECT DISTINCT origin, destination, season FROM planned))))), range(0,5) r(p)"""
SQL["f28_candidate_dates"] = b("SELECT origin, destination, season, block_no, pos, CAST(departure AS VARCHAR) AS departure, CAST(return_date AS VARCHAR) AS return_date FROM date_plan")
SQL["j28_units_with_dates"] = b(f"""SELECT {U}, count(*) AS days, max(block_no) AS blocks, CAST(min(departure) AS VARCHAR) AS first_day, CAST(max(return_date) AS VARCHAR) AS last_day
  FROM (SELECT {U} FROM planned) JOIN date_plan USING (origin, destination, season) GROUP BY ALL""")
SQL["j25_lead_time_bands"] = b(f"""SELECT carrier, CAST(lo AS INT) AS lo, CAST(hi AS INT) AS hi, count(*) AS n FROM lines JOIN (VALUES {','.join(f'({lo},{hi})' for lo, hi in bands)}) v(lo,hi)
  ON departure - {T} BETWEEN lo AND hi GROUP BY ALL""")
SQL["j26_batch_overlap"] = b("""SELECT count(*) AS overlap FROM (SELECT carrier, origin, destination FROM job_rows WHERE pos%7<4 INTERSECT SELECT carrier, origin, destination FROM job_rows WHERE pos%7>=4)""")
SQL["o3_seeded_order"] = b(f"SELECT {U}, md5(concat_ws('|', {U}, 'seed-7')) AS shuffle_key FROM planned ORDER BY shuffle_key")
SQL["x1_union_passes"] = b("SELECT pass_no, season, count(*) AS n FROM (SELECT pass_no, season FROM records UNION ALL SELECT 99, season FROM completed) GROUP BY ALL")
SQL["x2_union_lists"] = b("""SELECT list, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(CASE WHEN list=first_list THEN rows-1 ELSE rows END) AS BIGINT) AS repeats FROM (
  SELECT *, min(list) OVER (PARTITION BY carrier, origin, destination) AS first_list FROM (SELECT carrier, origin, destination, CASE WHEN pos%2=0 THEN 'a' ELSE 'b' END AS list, count(*) AS rows FROM job_rows GROUP BY ALL)) GROUP BY list""")
SQL["x3_except_completed"] = b(f"SELECT {U} FROM planned EXCEPT SELECT {U} FROM completed")
SQL["x4_common_families"] = b(f"""SELECT carrier, cabin, count(*) AS common FROM (SELECT carrier, origin, destination, cabin, {key('raw_brand_name')} AS k FROM ladders WHERE season='Summer'
  INTERSECT SELECT carrier, origin, destination, cabin, {key('raw_brand_name')} FROM ladders WHERE season='Winter') GROUP BY ALL""")

spell = []
for code, name, more in places.CARRIERS:
    for s in [name] + [m for m in more.split(",") if m]:
        n = re.sub(r"\s+", " ", re.sub("[^a-z0-9 ]", " ", s.lower())).strip()
        if (code, n, len(spell)) not in spell:
            spell.append((code, n, len(spell)))
C["spelled"] = "SELECT * FROM (VALUES " + ",".join(f"({c.lit(a)},{c.lit(n)},{i})" for a, n, i in spell) + ") v(sc, sn, si)"
C["resolved_ops"] = f"""SELECT op, coalesce((SELECT arg_min(sc, si) FROM spelled WHERE sn = {c.norm_airline('op')}),
   (SELECT CASE WHEN count(DISTINCT sc)=1 THEN min(sc) END FROM spelled WHERE contains({c.norm_airline('op')}, sn) OR contains(sn, {c.norm_airline('op')}))) AS code
  FROM (SELECT DISTINCT operating AS op FROM itineraries WHERE operating<>'')"""
C["judged"] = f"""SELECT i.*, CASE WHEN operating='' THEN TRUE WHEN code IS NOT NULL THEN code=carrier WHEN airline_name IS NULL THEN TRUE
   ELSE contains({c.norm_airline('operating')}, {c.norm_airline('airline_name')}) END AS op_ok, code
  FROM itineraries i LEFT JOIN resolved_ops ON operating=op LEFT JOIN airlines ON carrier=dim_carrier"""
SQL["j20_airline_code"] = b("SELECT operating, count(*) AS n, min(code) AS code FROM judged GROUP BY operating")
SQL["j21_operator_matches"] = b("SELECT carrier, operating, op_ok AS matches, count(*) AS n FROM judged GROUP BY ALL")
SQL["p3_carrier_attribution"] = b("""SELECT carrier, row_carrier, fare_iata, operating, count(*) AS n FROM judged WHERE (row_carrier='' OR row_carrier=carrier) AND (fare_iata='' OR fare_iata=carrier)
  AND op_ok AND (row_carrier=carrier OR fare_iata=carrier) GROUP BY ALL""")
SQL["p20_exclusive_rows"] = b("SELECT carrier, operating, count(*) AS n FROM judged WHERE NOT exclusive AND op_ok GROUP BY ALL")
SR = "carrier, origin, destination, block_no, date_pos"
SQL["p4_markets_all_segments"] = b(f"""SELECT {SR}, count(*) AS kept, count(*) FILTER (al) AS fully FROM (SELECT *, bool_or(al) OVER (PARTITION BY {SR}) AS anyal FROM
  (SELECT *, coalesce(m2=carrier, TRUE) AS al FROM itineraries)) WHERE al OR NOT anyal GROUP BY ALL""")
SQL["p5_codeshare_interline"] = b("""SELECT carrier, (shared1 AND flight_id%3=0) OR (o1 <> m1 AND o1 IS DISTINCT FROM m2) OR (o2 IS NOT NULL AND o2<>m1 AND o2<>m2) AS is_codeshare,
  virtual_interline OR coalesce(m2<>m1, FALSE) AS is_interline, count(*) AS n FROM itineraries GROUP BY ALL""")
w = c.cabin_of("raw_brand_name")
SQL["p6_contradicting_boxes"] = b(f"""SELECT raw_brand_name, group_cabin, requested, coalesce(w<>group_cabin AND w<>'Premium Economy' AND group_cabin<>'Premium Economy'
   AND greatest({c.base('w')}, {c.base('group_cabin')}) <= {c.base('requested')}, FALSE) AS dropped, count(*) AS n
  FROM (SELECT *, {w} AS w, CASE WHEN ln%2=0 THEN 'Business' ELSE 'Economy' END AS requested FROM cards) GROUP BY ALL""")
SQL["p9_carrier_type"] = b(tally("lines", "carrier", f"CASE WHEN {c.low_cost('carrier')} THEN 'Low Cost' ELSE 'Legacy' END AS carrier_type"))
C["placed"] = """SELECT l.*, coalesce(a.city_code, l.origin) AS origin_city_code, coalesce(a.country_code,'') AS origin_country_code, coalesce(a.country_name,'Other') AS origin_country, coalesce(a.region,'Other') AS origin_region,
  coalesce(d.city_code, l.destination) AS dest_city_code, coalesce(d.country_code,'') AS dest_country_code, coalesce(d.country_name,'Other') AS dest_country, coalesce(d.region,'Other') AS dest_region
  FROM lines l LEFT JOIN airports a ON l.origin=a.ap_code LEFT JOIN airports d ON l.destination=d.ap_code"""
SQL["p10_route_type"] = b(tally("placed", "origin", "destination", "CASE WHEN origin_country_code='TR' OR dest_country_code='TR' THEN 'Local' ELSE 'Beyond' END AS route_type"))
SQL["j1_airport_enrichment"] = b(tally("placed", "origin", "destination", *[f"{e}_{x}" for e in ("origin", "dest") for x in ("city_code", "country_code", "country", "region")]))
SQL["p18_season_of_day"] = "SELECT CAST(month(o_orderdate) AS INT) AS month, CASE WHEN month(o_orderdate) BETWEEN 4 AND 10 THEN 'Summer' ELSE 'Winter' END AS season, count(*) AS n FROM orders GROUP BY ALL"
SQL["p19_excluded_cards"] = b("""SELECT group_cabin, ln=6 AS excluded, ln=5 AS unnamed, count(*) AS n FROM cards WHERE price_type='absolute' GROUP BY ALL""")
SQL["j2_airline_name"] = b("SELECT carrier, coalesce(airline_name, carrier) AS airline_name, count(*) AS n FROM lines LEFT JOIN airlines ON carrier=dim_carrier GROUP BY ALL")
SQL["j19_feed_keys"] = b(tally("rights", "right_key", f"{c.mapping('right_key', R.FEED_KEYS.items())} AS feed_key"))
SQL["j22_right_of_text"] = b(f"""SELECT role, right_key, CAST(sum(n) AS BIGINT) AS n FROM (SELECT role, {c.right_of('text')} AS right_key, 1 AS n FROM conversations
  UNION ALL SELECT 'panel', {c.right_of('line')}, n FROM (SELECT line, count(*) AS n FROM rule_lines GROUP BY ALL)) GROUP BY ALL""")
SQL["j15_attach_by_price"] = b(f"""SELECT carrier, coalesce(bn, raw_brand_name) AS name, CASE WHEN mileage_available IS NULL AND bm IS NOT NULL THEN TRUE ELSE mileage_available END AS miles_flag,
  count(*) AS n, count(bn) AS attached, sum(coalesce(bm, miles_earned)) AS miles FROM (SELECT *, CAST(round_even(price_value, 0) AS BIGINT) AS whole FROM cards) c
  LEFT JOIN (SELECT {FL}, CAST(round_even(price_value, 0) AS BIGINT) AS whole, arg_max(raw_brand_name, screen_order) AS bn, max({{'s': screen_order, 'm': miles_earned}}).m AS bm FROM cards WHERE price_value IS NOT NULL AND (n_rights > 3 OR ln > 2) GROUP BY ALL)
  USING ({FL}, whole) GROUP BY ALL""").replace("max({'s': screen_order, 'm': miles_earned}).m", "(max({'s': screen_order, 'm': miles_earned})).m")
SQL["a20_route_census"] = b("""SELECT code, count(*) AS in_segments, max(coalesce(p,0)) AS with_packages FROM (SELECT m1 AS code FROM itineraries UNION ALL SELECT m2 FROM itineraries WHERE m2 IS NOT NULL)
  LEFT JOIN (SELECT m1 AS code, count(*) AS p FROM itineraries WHERE flight_id IN (SELECT flight_id FROM raw_lines) GROUP BY ALL) USING (code) GROUP BY ALL""")
SQL["o5_most_common"] = SQL["a20_route_census"]
SQL["u1_adapter_registry"] = b("""SELECT source, CAST(CASE source WHEN 'direct' THEN 1 WHEN 'market' THEN 2 ELSE 3 END AS INT) AS priority, CASE WHEN source='market' THEN 'USD' ELSE currency END AS currency,
  CASE source WHEN 'direct' THEN carrier IN ('TK','LH','AC') WHEN 'search' THEN price_value IS NOT NULL ELSE TRUE END AS served, count(*) AS n,
  CAST(sum(CASE WHEN source='market' AND currency='TRY' THEN CAST(round(price_value * CAST('0.0243' AS DECIMAL(5,4)), 2) AS DECIMAL(14,2)) ELSE price_value END) AS DOUBLE) AS total FROM lines GROUP BY ALL""")
