"""SQL for ladder building, ordering, choosing and publishing."""

from stairfare.rules import vocab

from . import cte as c
from .cte import C, U, base, build as b, key, pretty, r3, subrank, subtier, tier

SQL = {}
L = U + ", cabin"
FL = "flight_id, season, group_cabin"

# cards carry how often they were seen
C["cards"] = C["cards"].replace("SELECT * EXCLUDE (rn),", "SELECT * EXCLUDE (rn), n_seen*3 AS n_rights,").replace(
    "row_number() OVER", "count(*) OVER (PARTITION BY flight_id, season, group_cabin, raw_brand_name) n_seen, row_number() OVER")

# attempts and how they ended
C["attempts"] = f"""SELECT *, CASE WHEN flight_id%31=0 THEN '' ELSE src END AS source, CASE WHEN flight_id%34=0 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN flight_id%34=0 THEN 'timeout' WHEN flight_id%51=0 THEN 'no flights' ELSE '' END AS error, carrier IN ('PC','VF') AS opportunistic, (flight_id%97)/CAST(4 AS DOUBLE) AS elapsed_s
  FROM (SELECT flight_id, {U}, pass_no, source AS src, CAST(count(DISTINCT CASE WHEN keep THEN group_cabin END) AS INT) AS n_cabins, count(*) FILTER (keep) AS n_brands,
   count(*) FILTER (keep AND price_value IS NOT NULL AND flight_id%29<>0) AS n_priced, count(*) FILTER (keep AND n_rights>3 AND flight_id%23<>0) AS n_with_rights,
   count(*) FILTER (keep AND mileage_available IS NOT NULL AND flight_id%37<>0) AS n_with_miles, bool_or(keep AND group_cabin='Business') AS has_business, bool_or(keep AND group_cabin='Economy') AS has_economy
  FROM (SELECT *, NOT (group_cabin='Business' AND flight_id%4=0) AND flight_id%17<>0 AS keep FROM cards) GROUP BY ALL)"""
C["flagged"] = f"""SELECT *, source='' AS missing_source, n_cabins<1 AS missing_cabin, NOT {c.low_cost('carrier')} AND NOT has_business AS missing_business, n_brands=0 AS missing_brands,
  n_brands>0 AND n_priced=0 AS missing_price, n_brands>0 AND n_with_rights=0 AS missing_rights, n_brands>0 AND n_with_miles=0 AS missing_miles FROM attempts"""
C["judged_units"] = """SELECT *, CASE WHEN missing_brands THEN CASE WHEN status='failed' THEN 'failed' WHEN error='' THEN 'no_availability' ELSE 'failed' END
   WHEN issues<>'' THEN 'partial' ELSE 'success' END AS final_status FROM (SELECT *, concat_ws('; ', CASE WHEN missing_source THEN 'no source recorded' END,
   CASE WHEN missing_cabin THEN 'cabins found=' || n_cabins || ' < expected 1' END, CASE WHEN missing_business THEN 'no Business cabin for non-LCC carrier ' || carrier END,
   CASE WHEN missing_brands THEN 'no branded fares extracted' END, CASE WHEN missing_price THEN 'no prices on any brand' END,
   CASE WHEN missing_rights THEN 'no right data on any brand' END, CASE WHEN missing_miles THEN 'no miles data on any brand' END) AS issues FROM flagged)"""
C["successes"] = f"SELECT DISTINCT {U}, pass_no FROM judged_units WHERE final_status='success'"
C["ranked_ladders"] = f"""SELECT *, row_number() OVER (PARTITION BY {L} ORDER BY price, name_rank, raw_brand_name) - 1 AS brand_order
  FROM (SELECT *, {base('cabin')} + {subrank(subtier('raw_brand_name'))} AS name_rank FROM ladders)"""
SQL["w1_brand_order"] = b(f"SELECT {L}, raw_brand_name, CAST(price AS DOUBLE) AS price, name_rank, CAST(brand_order AS INT) AS brand_order FROM ranked_ladders")
SQL["w2_tier_code"] = b(f"SELECT carrier, {tier('cabin', 'brand_order')} AS tier_code, count(*) AS n, CAST(min(price) AS DOUBLE) AS cheapest FROM ranked_ladders GROUP BY ALL")


def resolved(order, part):
    return f"""CASE WHEN price_type='absolute' THEN price_value ELSE CAST(last_value(CASE WHEN price_type='absolute' THEN price_value END IGNORE NULLS)
      OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + price_value AS DECIMAL(14,2)) END"""


SQL["w3_delta_prices"] = b(f"""SELECT carrier, group_cabin, price_type, count(*) AS n, count(resolved) AS n_priced, CAST(sum(resolved) AS DOUBLE) AS total
  FROM (SELECT *, {resolved('screen_order, raw_brand_name', FL)} AS resolved FROM cards) GROUP BY ALL""")

C["ratios"] = f"""SELECT *, CASE WHEN before > 0 THEN p / before END AS step_ratio FROM (SELECT *, lag(p) OVER (PARTITION BY {FL} ORDER BY p NULLS LAST) AS before
  FROM (SELECT *, CAST(CASE WHEN price_value <> 0 THEN price_value END AS DOUBLE) AS p FROM cards))"""
worst = r3("greatest(coalesce(max(step_ratio), 1), 1)")
C["dated"] = f"""SELECT {FL}, carrier, origin, destination, source, departure, block_no, date_pos, pass_no, count(*) AS n_brands, CAST(sum(n_rights) AS BIGINT) AS content,
  min(price_value) AS base_price, count(*) FILTER (step_ratio > 3.0) AS bad_steps, {worst} AS worst_step FROM ratios GROUP BY ALL"""
C["results"] = f"""SELECT k.* FROM cards k JOIN (SELECT {FL} FROM dated QUALIFY row_number() OVER (PARTITION BY {U}, pass_no, group_cabin
  ORDER BY n_brands DESC, bad_steps, worst_step, flight_id) = 1) USING ({FL})"""
C["records"] = f"SELECT {U}, pass_no, count(*) AS packages, CAST(sum(n_rights) AS BIGINT) AS right_lines FROM results GROUP BY ALL"
C["winners"] = f"SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY {U} ORDER BY packages DESC, right_lines DESC, pass_no DESC) = 1"
SQL["a3_record_strength"] = b("SELECT * FROM records")
SQL["w4_strongest_record"] = b("SELECT * FROM winners")
C["brands"] = f"""SELECT r.*, CASE group_cabin WHEN 'Economy' THEN 0 WHEN 'Premium Economy' THEN 1 ELSE 2 END AS result_no
  FROM results r JOIN winners w USING ({U}, pass_no)"""
C["regrouped"] = f"""SELECT *, {c.effective('fam', 'fare_family_code', 'NULL', 'group_cabin', 'carrier')} AS cabin
  FROM (SELECT *, coalesce({c.override('carrier', 'fare_family_code', 'raw_brand_name', 2)}, raw_brand_name) AS fam FROM brands)"""
RK = U + ", result_no, cabin"
C["pretty_rows"] = f"""SELECT *, {pretty('fam', 'carrier')} AS pretty_name FROM regrouped WHERE cabin = group_cabin OR {base('cabin')} > {base('group_cabin')}"""
C["resolved_rows"] = f"""SELECT *, {base('cabin')} + {subrank(subtier('pretty_name'))} AS name_rank, {resolved('screen_order, fam', RK)} AS resolved
  FROM pretty_rows WHERE NOT {c.bare('pretty_name')}"""
C["ordered_rows"] = f"SELECT *, row_number() OVER (PARTITION BY {RK} ORDER BY resolved NULLS LAST, name_rank, screen_order, fam) - 1 AS brand_order FROM resolved_rows"
C["named_rows"] = f"""SELECT *, {resolved('brand_order', RK)} AS abs_price, pretty_name AS shown_name FROM ordered_rows"""
C["distinct_rows"] = f"""SELECT *, min(brand_order) OVER (PARTITION BY {RK}, shown_name) AS slot FROM named_rows
  QUALIFY row_number() OVER (PARTITION BY {RK}, shown_name ORDER BY CASE WHEN abs_price<>0 THEN abs_price END NULLS LAST, brand_order) = 1"""
C["ladder_pick"] = f"""SELECT {RK} FROM (SELECT {RK}, group_cabin, count(*) AS size FROM distinct_rows GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {L} ORDER BY size DESC, group_cabin=cabin DESC, result_no) = 1"""
C["published"] = f"SELECT d.*, {tier('cabin', 'brand_order')} AS tier_code FROM distinct_rows d JOIN ladder_pick USING ({RK})"
SQL["w5_one_ladder_per_cabin"] = b(f"SELECT {L}, group_cabin, count(*) AS brands FROM published GROUP BY ALL")
SQL["w6_unique_published_names"] = b(f"SELECT {L}, shown_name, CAST(brand_order AS INT) AS brand_order, tier_code, CAST(abs_price AS DOUBLE) AS abs_price FROM published")
SQL["u2_ranked_rows"] = b("SELECT carrier, group_cabin, cabin, CAST(brand_order AS INT) AS brand_order, count(*) AS n, CAST(sum(abs_price) AS DOUBLE) AS total FROM distinct_rows GROUP BY ALL")
SQL["w7_best_date"] = b(f"""SELECT {U}, group_cabin, CAST(departure AS VARCHAR) AS departure, n_brands, content FROM dated
  QUALIFY row_number() OVER (PARTITION BY {U}, group_cabin ORDER BY n_brands DESC, content DESC, departure, flight_id) = 1""")
C["date_walk"] = f"""SELECT {U}, walk_block, day, CASE max(seen) WHEN 2 THEN 'found' WHEN 1 THEN 'absent' ELSE 'no_availability' END AS outcome,
  max(CASE WHEN seen=2 THEN fares END) AS fares FROM (SELECT *, {c.itin('o_custkey', dates=False)} FROM (SELECT o_custkey,
  CASE WHEN month(o_orderdate) BETWEEN 4 AND 10 THEN 'Summer' ELSE 'Winter' END AS season, CAST((year(o_orderdate)-1995)//3+1 AS INT) AS walk_block,
  CAST(o_orderdate AS DATE) AS day, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END AS seen, CAST(o_orderkey%6+1 AS INT) AS fares FROM orders)) GROUP BY ALL"""
C["walked"] = f"""SELECT w.* FROM date_walk w LEFT JOIN (SELECT {U}, walk_block, (list(day ORDER BY day) FILTER (outcome='absent'))[5] AS stop_day,
  min(day) FILTER (outcome='found') AS found_day FROM date_walk GROUP BY ALL) s USING ({U}, walk_block)
  WHERE stop_day IS NULL OR found_day < stop_day OR day <= stop_day"""
SQL["w8_absence_cutoff"] = b(f"SELECT {U}, walk_block, count(*) AS days, count(*) FILTER (outcome='found') AS found, CAST(max(day) AS VARCHAR) AS last_day FROM walked GROUP BY ALL")
SQL["w9_first_productive_block"] = b(f"""SELECT * FROM (SELECT {U}, walk_block, count(*) AS days, max(fares) AS most_fares FROM walked WHERE outcome='found' GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {U} ORDER BY walk_block) = 1""")
SQL["w10_best_source"] = b(f"""SELECT {U}, group_cabin, source, n_brands, bad_steps, worst_step FROM dated QUALIFY row_number() OVER (PARTITION BY {U}, group_cabin
  ORDER BY n_brands DESC, bad_steps, {r3('worst_step', 2)}, CASE source WHEN 'direct' THEN 1 WHEN 'market' THEN 2 ELSE 3 END, flight_id) = 1""")
SQL["w16_unique_display_names"] = b(f"""SELECT carrier, pretty_name, CASE WHEN cnt < 2 THEN pretty_name ELSE trim(pretty_name || ' ' || array_to_string(list_filter(
   regexp_split_to_array(trim(raw_brand_name), '[\\s/_-]+'), lambda w: w <> '' AND NOT list_contains(list_transform(string_split(pretty_name, ' '), lambda p: lower(p)), lower(w))), ' ')) END AS shown_name, count(*) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY {FL}, pretty_name) AS cnt FROM (SELECT *, {pretty('fam', 'carrier')} AS pretty_name FROM (
   SELECT *, coalesce({c.override('carrier', 'fare_family_code', 'raw_brand_name', 2)}, raw_brand_name) AS fam FROM cards))) GROUP BY ALL""")
C["steps"] = f"""SELECT *, CAST(to_price - price AS DECIMAL(14,2)) AS fee FROM (SELECT *, lead(brand_order) OVER w AS to_order, lead(price) OVER w AS to_price FROM ranked_ladders
  WINDOW w AS (PARTITION BY {L} ORDER BY brand_order)) WHERE to_order IS NOT NULL"""
SQL["w19_tier_transitions"] = b(f"SELECT {L}, CAST(brand_order AS INT) AS brand_order, CAST(to_order AS INT) AS to_order, CAST(fee AS DOUBLE) AS fee FROM steps")
SQL["w22_cheapest_family"] = b(f"""SELECT carrier, raw_brand_name, CAST(screen_no AS INT) AS screen_no, count(*) AS n, CAST(sum(price_value) AS DOUBLE) AS total, CAST(sum(n_rights)/3 AS BIGINT) AS seen
  FROM (SELECT *, row_number() OVER (PARTITION BY {FL} ORDER BY price_value NULLS LAST, screen_order, raw_brand_name) - 1 AS screen_no FROM cards) GROUP BY ALL""")
SQL["a1_ladder_quality"] = b(f"""SELECT {L}, count(*) AS n_brands, count(*) FILTER (r > 3.0) AS bad_steps, {r3('greatest(coalesce(max(r), 1), 1)')} AS worst_step FROM (
  SELECT *, CAST(price AS DOUBLE) / lag(CAST(price AS DOUBLE)) OVER (PARTITION BY {L} ORDER BY price) AS r FROM ladders) GROUP BY ALL""")
SQL["a2_ladder_content"] = b(f"""SELECT {U}, group_cabin, n_brands, CAST(right_lines + parts AS BIGINT) AS content FROM
  (SELECT {U}, group_cabin, count(*) AS n_brands, sum(n_rights) AS right_lines FROM cards GROUP BY ALL) JOIN
  (SELECT {U}, group_cabin, sum(CASE WHEN ln=7 THEN 0 WHEN ln%2=0 THEN 2 ELSE 1 END) AS parts FROM lines GROUP BY ALL) USING ({U}, group_cabin)""")
RT = "carrier, origin, destination, cabin"
C["season_keys"] = f"""SELECT {RT}, season, k, arg_min(slot, slot) AS at, arg_min(abs_price, slot) AS price FROM (SELECT *, {key('pretty_name')} AS k FROM published SEMI JOIN successes USING ({U}, pass_no)) WHERE k<>'' GROUP BY ALL"""
SQL["j10_season_pair_preferences"] = b(f"""SELECT {RT}, CASE WHEN sg > wg THEN s1 ELSE w1 END AS first_key, CASE WHEN sg > wg THEN s2 ELSE w2 END AS second_key, CAST(greatest(sg, wg) AS DOUBLE) AS gap
 FROM (SELECT {', '.join('a.' + x.strip() for x in RT.split(','))}, abs(a.price-b.price) AS sg, abs(x.price-y.price) AS wg,
   CASE WHEN a.at<b.at THEN a.k ELSE b.k END AS s1, CASE WHEN a.at<b.at THEN b.k ELSE a.k END AS s2, CASE WHEN x.at<y.at THEN a.k ELSE b.k END AS w1, CASE WHEN x.at<y.at THEN b.k ELSE a.k END AS w2
  FROM season_keys a JOIN season_keys b ON a.season='Summer' AND b.season='Summer' AND a.k < b.k AND {' AND '.join(f'a.{x.strip()}=b.{x.strip()}' for x in RT.split(','))}
  JOIN season_keys x ON x.season='Winter' AND x.k=a.k AND {' AND '.join(f'a.{x.strip()}=x.{x.strip()}' for x in RT.split(','))}
  JOIN season_keys y ON y.season='Winter' AND y.k=b.k AND {' AND '.join(f'a.{x.strip()}=y.{x.strip()}' for x in RT.split(','))})
 WHERE s1 <> w1 AND sg <> wg""")
SQL["p7_regroup_by_cabin"] = b(f"""SELECT carrier, group_cabin, cabin, fam AS raw_brand_name, count(*) AS n FROM (SELECT *, {c.effective('fam', 'fare_family_code', 'NULL', 'group_cabin', 'carrier')} AS cabin
  FROM (SELECT *, coalesce({c.override('carrier', 'fare_family_code', 'raw_brand_name', 2)}, raw_brand_name) AS fam FROM cards)) WHERE cabin=group_cabin OR {base('cabin')} > {base('group_cabin')} GROUP BY ALL""")
SQL["p8_drop_bare_codes"] = b(f"SELECT pretty_name, count(*) AS n FROM (SELECT {pretty('raw_brand_name', 'carrier')} AS pretty_name FROM cards) WHERE NOT {c.bare('pretty_name')} GROUP BY ALL")
SQL["j3_family_override"] = b(f"""SELECT carrier, fare_family_code, tabled_name, tabled_cabin, count(*) AS n FROM (SELECT carrier, fare_family_code, {c.override('carrier', 'fare_family_code', 'raw_brand_name', 2)} AS tabled_name,
  {c.override('carrier', 'fare_family_code', 'raw_brand_name', 3)} AS tabled_cabin FROM lines) WHERE tabled_name IS NOT NULL GROUP BY ALL""")
SQL["j4_spelling_lookup"] = b(f"""SELECT carrier, k, spelling, count(*) AS n FROM (SELECT carrier, {key('raw_brand_name')} AS k FROM lines) JOIN {c.values(vocab.SPELLINGS, 'sc, sk, spelling')} ON carrier=sc AND k=sk GROUP BY ALL""")

# order repair: neighbours swap one pair per step, pass by pass, until a pass changes nothing
_prefs = SQL["j10_season_pair_preferences"].split("\nSELECT", 1)[1]
CONSENSUS = {
    "prefs": f"SELECT {RT}, list(first_key || '>' || second_key) AS pl FROM (SELECT {_prefs}) GROUP BY ALL",
    "queues": f"""SELECT *, {' || '.join(f"'|' || {x.strip()}" for x in RK.split(','))} AS id FROM (SELECT {RK}, list({{'i': brand_order, 'k': k}} ORDER BY brand_order) AS arr
      FROM (SELECT *, {key('pretty_name')} AS k FROM ordered_rows) GROUP BY ALL) JOIN prefs USING ({RT}) WHERE len(arr) > 1""",
    "bub": """SELECT id, pl, arr, CAST(1 AS BIGINT) AS i, FALSE AS sw, CAST(1 AS BIGINT) AS pass, FALSE AS done FROM queues UNION ALL
      SELECT id, pl, CASE WHEN hit THEN list_concat(list_concat(arr[1:i-1], [arr[i+1], arr[i]]), arr[i+2:]) ELSE arr END,
        CASE WHEN i < len(arr) THEN i+1 ELSE 1 END, CASE WHEN i < len(arr) THEN sw OR hit ELSE FALSE END,
        CASE WHEN i < len(arr) THEN pass ELSE pass+1 END, i = len(arr) AND (NOT sw OR pass >= len(arr)*len(arr)) FROM (
        SELECT *, i < len(arr) AND arr[i].k<>'' AND arr[i+1].k<>'' AND arr[i].k<>arr[i+1].k AND list_contains(pl, arr[i+1].k || '>' || arr[i].k) AS hit FROM bub WHERE NOT done)""",
    "settled": "SELECT id, unnest(range(0, len(arr))) AS new_order, unnest(list_transform(arr, lambda x: x.i)) AS brand_order FROM bub WHERE done",
    "ordered2": f"""SELECT o.* EXCLUDE (brand_order), coalesce(new_order, o.brand_order) AS brand_order FROM (SELECT *, {' || '.join(f"'|' || {x.strip()}" for x in RK.split(','))} AS id FROM ordered_rows) o
      LEFT JOIN settled s ON o.id=s.id AND o.brand_order=s.brand_order""",
    "named2": C["named_rows"].replace("ordered_rows", "ordered2"),
    "distinct2": C["distinct_rows"].replace("named_rows", "named2"),
    "pick2": C["ladder_pick"].replace("distinct_rows", "distinct2"),
    "published2": C["published"].replace("distinct_rows", "distinct2").replace("ladder_pick", "pick2")}
SQL["j11_consensus_ladder"] = "WITH RECURSIVE " + b(f"SELECT {L}, shown_name, CAST(brand_order AS INT) AS brand_order, tier_code, CAST(abs_price AS DOUBLE) AS abs_price FROM published2", **CONSENSUS)[5:]
