"""SQL for choosing itineraries and merging sources and dates."""

from . import cte as c
from .cte import C, U, base, build as b, key, r3, rank_of
from .sql_ladders import FL

SQL = {}
S = U + ", block_no, date_pos, group_cabin"
D = U + ", departure, group_cabin"

fam = c.override('carrier', 'fare_family_code', 'raw_brand_name', 2)
C["buckets"] = f"""SELECT * FROM (SELECT *, {c.effective('fam', 'fare_family_code', 'NULL', 'group_cabin', 'carrier')} AS cabin
  FROM (SELECT *, coalesce({fam}, raw_brand_name) AS fam FROM cards)) WHERE cabin=group_cabin OR (group_cabin='Economy' AND {base('cabin')} > 0)"""
C["bucket_ratios"] = f"""SELECT *, p / lag(p) OVER (PARTITION BY {FL} ORDER BY p NULLS LAST) AS step_ratio FROM
  (SELECT *, CAST(CASE WHEN price_value<>0 THEN price_value END AS DOUBLE) AS p FROM buckets)"""
C["scores"] = f"""SELECT {S}, flight_id, flight_id%3=0 AS direct, CAST(count(DISTINCT cabin) AS INT) AS cabins, count(*) AS fares, CAST(sum(n_rights) AS BIGINT) AS items,
  min(price_value) AS base_price, max(CASE WHEN cabin=group_cabin THEN 1 ELSE 0 END) AS has_searched, count(*) FILTER (step_ratio>3.0) AS bad_steps,
  {r3('greatest(coalesce(max(step_ratio),1),1)')} AS worst_step FROM bucket_ratios GROUP BY ALL"""
C["coverage"] = f"SELECT {FL}, CAST(count(DISTINCT right_key) AS INT) AS n_rights_known FROM rights GROUP BY ALL"
SQL["w11_best_flight_marketplace"] = b(f"""SELECT {S}, flight_id, cabins, fares, n_rights_known, bad_steps, worst_step, items FROM scores JOIN coverage USING ({FL})
  QUALIFY row_number() OVER (PARTITION BY {S} ORDER BY cabins DESC, fares DESC, n_rights_known DESC, bad_steps, worst_step, items DESC, base_price NULLS LAST, flight_id)=1""")
direct = "(direct AND has_searched=1) DESC, fares DESC, cabins DESC, bad_steps, worst_step, base_price NULLS LAST, flight_id"
SQL["w12_best_flight_direct_first"] = b(f"SELECT {S}, flight_id, direct, cabins, fares, bad_steps, worst_step FROM scores QUALIFY row_number() OVER (PARTITION BY {S} ORDER BY {direct})=1")
C["side_picks"] = f"""SELECT f.*, f.flight_id <> w.flight_id AS is_side_pick FROM (SELECT * FROM scores JOIN (SELECT DISTINCT {FL}, cabin FROM buckets) USING ({FL})
   QUALIFY row_number() OVER (PARTITION BY {S}, cabin ORDER BY {direct})=1) f
  JOIN (SELECT {S}, flight_id FROM scores QUALIFY row_number() OVER (PARTITION BY {S} ORDER BY {direct})=1) w USING ({S})
  WHERE f.flight_id = w.flight_id OR {base('cabin')} > {base('group_cabin')}"""
SQL["w13_side_pick"] = b(f"SELECT {S}, cabin, flight_id, is_side_pick FROM side_picks")
SN = U + ", block_no, date_pos"
SQL["w14_dedicated_beats_leak"] = b(f"SELECT {SN}, cabin, group_cabin, flight_id FROM side_picks QUALIFY row_number() OVER (PARTITION BY {SN}, cabin ORDER BY cabin=group_cabin DESC, {base('group_cabin')})=1")
SQL["w18_audit_sample"] = b(f"""SELECT {U}, CASE WHEN group_cabin='Business' THEN 'Business' ELSE 'Economy' END AS search, CAST(min(departure) AS VARCHAR) AS dep, count(*) AS stored
  FROM (SELECT * FROM results QUALIFY rank() OVER (PARTITION BY carrier ORDER BY flight_id, season, pass_no)=1) GROUP BY ALL""")
SQL["w20_split_routes"] = b("""SELECT origin, destination, CASE WHEN row_number() OVER (ORDER BY origin, destination) <= count(*) OVER () // 2 THEN 'A' ELSE 'B' END AS half
  FROM (SELECT DISTINCT origin, destination FROM job_rows)""")
SQL["w21_rank_dates"] = b("""SELECT origin, destination, season, CAST(departure AS VARCHAR) AS departure, has_direct, flights, CAST(cheapest AS DOUBLE) AS cheapest,
  CAST(row_number() OVER (PARTITION BY origin, destination, season ORDER BY has_direct DESC, flights DESC, cheapest, departure) - 1 AS INT) AS place FROM (
  SELECT origin, destination, season, departure, bool_or(flight_id%3=0) AS has_direct, count(DISTINCT flight_id) AS flights, min(price_value) AS cheapest FROM cards GROUP BY ALL)""")
SQL["w23_keep_better_retry"] = b(f"""SELECT * FROM (SELECT {U}, pass_no, packages AS brands FROM records) QUALIFY row_number() OVER (PARTITION BY {U} ORDER BY brands DESC, pass_no DESC)=1""")
SQL["u5_custom_ranking"] = b(f"SELECT {S}, flight_id, fares, CAST(base_price AS DOUBLE) AS base_price FROM scores QUALIFY row_number() OVER (PARTITION BY {S} ORDER BY base_price NULLS LAST, fares DESC, flight_id)=1")

C["sided"] = f"""SELECT {D}, side, raw_brand_name, (min({{'p': price_value, 's': screen_order}})).p AS price_value, (min({{'p': price_value, 's': screen_order}})).s AS screen_order
  FROM (SELECT *, CASE WHEN ln%2=1 THEN 'primary' ELSE 'secondary' END AS side FROM lines WHERE price_type='absolute' AND price_value IS NOT NULL) GROUP BY ALL"""
C["family_lists"] = f"""SELECT {D}, side, list({{'s': screen_order, 'name': raw_brand_name, 'k': {key('raw_brand_name')}, 'price': price_value}} ORDER BY screen_order, raw_brand_name) AS f FROM sided GROUP BY ALL"""
# matching walks the primary ladder one family per step


def pair_steps(two):
    """Fragments that match the lists ``f`` and ``g`` of each ``id`` of ``two``; ``all_pairs`` has the places ``pi, oj``."""
    return {
        "two": two,
        "walk": """SELECT id, f, g, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS ps, CAST([] AS BIGINT[]) AS os FROM two UNION ALL
      SELECT id, f, g, i+1, CASE WHEN pick IS NOT NULL THEN list_append(ps, i+1) ELSE ps END, CASE WHEN pick IS NOT NULL THEN list_append(os, pick) ELSE os END FROM (
       SELECT *, CASE WHEN len(exact)>0 THEN exact[1] WHEN len(near)=1 THEN near[1] END AS pick FROM (
        SELECT *, list_filter(range(1, len(g)+1), lambda j: g[j].k = f[i+1].k AND NOT list_contains(os, j)) AS exact,
         list_filter(range(1, len(g)+1), lambda j: (contains(g[j].k, f[i+1].k) OR contains(f[i+1].k, g[j].k)) AND NOT list_contains(os, j)) AS near FROM walk WHERE i < len(f)))""",
        "ended": "SELECT * FROM walk WHERE i = len(f)",
        "priced": """SELECT id, unnest(range(1, len(f)+1)) AS n, unnest(list_transform(list_sort(list_transform(range(1, len(f)+1), lambda i: {'o': f[i].price IS NULL, 'p': f[i].price, 'i': i})), lambda x: x.i)) AS pi,
      unnest(list_transform(list_sort(list_transform(range(1, len(f)+1), lambda i: {'o': g[i].price IS NULL, 'p': g[i].price, 'i': i})), lambda x: x.i)) AS oj FROM ended WHERE len(f)=len(g)""",
        "pairs": """SELECT id, unnest(ps) AS pi, unnest(os) AS oj FROM ended UNION ALL SELECT p.id, p.pi, p.oj FROM priced p JOIN ended e ON p.id=e.id
      WHERE NOT list_contains(ps, p.pi) AND NOT list_contains(os, p.oj)""",
        "all_pairs": "SELECT two.*, pi, oj, f[pi].name AS own, g[oj].name AS other FROM pairs JOIN two USING (id)"}


def recursive(select, steps):
    return "WITH RECURSIVE " + b(select, **steps)[5:]


sides = pair_steps(f"SELECT {D}, carrier || '|' || origin || '|' || destination || '|' || season || departure || group_cabin AS id, p.f AS f, s.f AS g FROM (SELECT * FROM family_lists WHERE side='primary') p JOIN (SELECT * FROM family_lists WHERE side='secondary') s USING ({D})")
SQL["j5_match_brands"] = recursive("SELECT carrier, own, other, count(*) AS n FROM all_pairs GROUP BY ALL", sides)
C["sided_rights"] = f"""SELECT {D}, side, raw_brand_name, right_key, status, raw_value FROM (SELECT *, CASE WHEN ln%2=1 THEN 'primary' ELSE 'secondary' END AS side FROM rights)
  QUALIFY row_number() OVER (PARTITION BY {D}, side, raw_brand_name, right_key ORDER BY {rank_of('status')} DESC, pos DESC, status DESC, raw_value DESC)=1"""
C["sided_miles"] = f"""SELECT {D}, side, raw_brand_name, CASE WHEN is_open THEN TRUE WHEN ln%3=0 THEN FALSE END AS miles, CASE WHEN is_open THEN CAST(CASE WHEN qty%2=0 THEN qty*10 ELSE qty END AS VARCHAR) END AS number
  FROM (SELECT *, CASE WHEN ln%2=1 THEN 'primary' ELSE 'secondary' END AS side FROM lines WHERE price_type='absolute' AND price_value IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY {D}, side, raw_brand_name ORDER BY price_value, screen_order)=1"""
SQL["j6_fill_rights"] = recursive(f"""SELECT carrier, right_key, CASE WHEN t THEN os ELSE status END AS status, t AS filled, count(*) AS n,
   max(CASE WHEN t THEN CASE WHEN ov<>'' THEN ov ELSE coalesce(raw_value,'') END ELSE raw_value END) AS last_value FROM (
  SELECT *, (status IS NULL OR status='Unknown') AND os IS NOT NULL AS t FROM
   (SELECT * EXCLUDE (side) FROM sided_rights WHERE side='primary') FULL OUTER JOIN
   (SELECT {D}, own AS raw_brand_name, right_key, status AS os, raw_value AS ov FROM (SELECT * FROM sided_rights WHERE side='secondary' AND status<>'Unknown') s JOIN all_pairs USING ({D}) WHERE s.raw_brand_name=other)
   USING ({D}, raw_brand_name, right_key)) GROUP BY ALL
  UNION ALL SELECT carrier, 'miles', CASE CASE WHEN t THEN om ELSE miles END WHEN TRUE THEN 'Included' WHEN FALSE THEN 'Not Included' ELSE 'Unknown' END, t, count(*), max(CASE WHEN t THEN onum ELSE number END) FROM (
   SELECT *, miles IS NULL AND om IS NOT NULL AS t FROM (SELECT * FROM sided_miles WHERE side='primary') LEFT JOIN
    (SELECT {D}, own AS raw_brand_name, miles AS om, number AS onum FROM (SELECT * FROM sided_miles WHERE side='secondary' AND miles IS NOT NULL) s JOIN all_pairs USING ({D}) WHERE s.raw_brand_name=other)
   USING ({D}, raw_brand_name)) GROUP BY ALL""", sides)
C["best_rights"] = f"""SELECT {FL}, raw_brand_name, right_key, status, raw_value FROM rights
  QUALIFY row_number() OVER (PARTITION BY {FL}, raw_brand_name, right_key ORDER BY {rank_of('status')} DESC, pos DESC)=1"""
SQL["a4_strongest_status"] = b("SELECT right_key, status, count(*) AS n, max(raw_value) AS last_value FROM best_rights GROUP BY ALL")
SQL["a5_strongest_known_status"] = b(f"""SELECT right_key, status, count(*) AS n, min(raw_value) AS first_value FROM (SELECT * FROM rights WHERE status<>'Unknown'
  QUALIFY row_number() OVER (PARTITION BY {FL}, raw_brand_name, right_key ORDER BY {rank_of('status')} DESC, pos)=1) GROUP BY ALL""")
C["search_winner"] = f"SELECT {S}, flight_id AS winner FROM dated QUALIFY row_number() OVER (PARTITION BY {S} ORDER BY n_brands DESC, bad_steps, worst_step, flight_id)=1"
C["flight_lists"] = f"SELECT {S}, flight_id, list({{'s': screen_order, 'name': raw_brand_name, 'k': {key('raw_brand_name')}, 'price': price_value}} ORDER BY screen_order, raw_brand_name) AS l FROM cards GROUP BY ALL"
flights = pair_steps(f"""SELECT {S}, o.flight_id AS flight_id, winner, concat_ws('|', {S}, o.flight_id) AS id, w.l AS f, o.l AS g FROM flight_lists o JOIN search_winner USING ({S}) JOIN flight_lists w USING ({S}) WHERE w.flight_id = winner""")
SQL["j7_fill_rights_across_flights"] = recursive(f"""SELECT carrier, right_key, status, flight_id <> winner AS borrowed, count(*) AS n FROM (
  SELECT {S}, own, right_key, status, r.flight_id AS flight_id, winner FROM (SELECT * FROM best_rights JOIN dated USING ({FL}) WHERE status<>'Unknown') r JOIN all_pairs p USING ({S}, flight_id) WHERE r.raw_brand_name = p.other
   QUALIFY row_number() OVER (PARTITION BY {S}, own, right_key ORDER BY n_brands DESC, bad_steps, worst_step, r.flight_id)=1) GROUP BY ALL""", flights)
SQL["j8_top_up"] = b(f"""SELECT carrier, group_cabin, raw_brand_name, added, CAST(screen_no AS INT) AS screen_no, count(*) AS n, CAST(sum(price_value) AS DOUBLE) AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY {D} ORDER BY price_value NULLS LAST, added, screen_order, raw_brand_name) - 1 AS screen_no FROM (
   SELECT *, side='secondary' AS added FROM sided s WHERE side='primary' OR (
     EXISTS (SELECT 1 FROM sided p WHERE p.side='primary' AND {' AND '.join(f'p.{x.strip()}=s.{x.strip()}' for x in D.split(','))}) AND
     NOT EXISTS (SELECT 1 FROM sided p WHERE p.side='primary' AND p.raw_brand_name=s.raw_brand_name AND {' AND '.join(f'p.{x.strip()}=s.{x.strip()}' for x in D.split(','))})))) GROUP BY ALL""")
UG = U + ", group_cabin"
bad = lambda x: f"len(list_filter(range(1, len({x})), lambda i: list_sort(list_transform({x}, lambda q: CAST(q.price AS DOUBLE)))[i+1] / list_sort(list_transform({x}, lambda q: CAST(q.price AS DOUBLE)))[i] > 3.0))"
date_cte = {
    "day_rows": f"""SELECT {UG}, departure, raw_brand_name, (min({{'p': price_value, 's': screen_order}})).p AS price_value, (min({{'p': price_value, 's': screen_order}})).s AS screen_order FROM sided GROUP BY ALL""",
    "day_lists": f"""SELECT *, row_number() OVER (PARTITION BY {UG} ORDER BY len(f) DESC, departure) AS place, carrier||origin||destination||season||group_cabin AS id FROM (
       SELECT {UG}, departure, list({{'k': {key('raw_brand_name')}, 'price': price_value}} ORDER BY screen_order, raw_brand_name) AS f FROM day_rows GROUP BY ALL)""",
    "others": f"SELECT id, f AS g, row_number() OVER (PARTITION BY id ORDER BY departure) AS rn FROM day_lists WHERE place > 1",
    "fold": f"""SELECT id, CAST(0 AS BIGINT) AS i, f AS cur FROM day_lists WHERE place=1 UNION ALL
      SELECT id, rn, CASE WHEN len(trial) > len(cur) AND {bad('trial')} <= {bad('cur')} THEN trial ELSE cur END FROM (
       SELECT fold.id, rn, cur, list_concat(cur, list_filter(g, lambda x: NOT list_contains(list_transform(cur, lambda y: y.k), x.k))) AS trial FROM fold JOIN others ON fold.id=others.id AND rn=i+1)""",
    "folded": f"SELECT d.*, cur FROM day_lists d JOIN (SELECT id, arg_max(cur, i) AS cur FROM fold GROUP BY id) USING (id) WHERE place=1"}
SQL["j9_fill_across_dates"] = "WITH RECURSIVE " + b(f"""SELECT {UG}, CAST(len(f) AS INT) AS before, len(cur) AS after, CAST(list_sum(list_transform(cur, lambda x: x.price)) AS DOUBLE) AS price_total FROM folded""", **date_cte)[5:]
SQL["u4_ladder_folds"] = "WITH RECURSIVE " + b(f"""SELECT carrier, group_cabin, count(*) AS ladders, CAST(sum(len(cur)-len(f)) AS BIGINT) AS added, CAST(sum({bad('f')}) AS BIGINT) AS bad_before,
  CAST(sum({bad('cur')}) AS BIGINT) AS bad_after FROM folded GROUP BY ALL""", **date_cte)[5:]
SQL["a34_families_per_date"] = b(f"""SELECT {UG}, CAST(departure AS VARCHAR) AS departure, families, all_families FROM
  (SELECT {UG}, departure, count(DISTINCT raw_brand_name) AS families FROM lines GROUP BY ALL) JOIN (SELECT {UG}, count(DISTINCT raw_brand_name) AS all_families FROM lines GROUP BY ALL) USING ({UG})""")
