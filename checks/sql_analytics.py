"""SQL for the competitive questions."""

from . import cte as c
from .cte import C, U, base, build as b, key, rank_of, tier
from .sql_ladders import FL, L

SQL = {}
M = "origin, destination, season, cabin"
C["step_rows"] = "SELECT *, (brand_order+1) || '-' || (to_order+1) AS step FROM steps"
mean = lambda x, n: f"CAST(sum({x}) AS DOUBLE)/count({x}) AS {n}"
SQL["a22_transition_fee"] = b(f"""SELECT carrier, cabin, step, count(*) AS units, {mean('fee', 'mean_fee')}, CAST(min(fee) AS DOUBLE) AS lowest, CAST(max(fee) AS DOUBLE) AS highest FROM step_rows GROUP BY ALL""")
C["market_steps"] = f"SELECT {M}, step, carrier, sum(fee) AS fee FROM step_rows GROUP BY ALL"
SQL["a23_market_position"] = b(f"""SELECT *, CASE WHEN own_fee < market_mean*CAST(0.9 AS DOUBLE) THEN 'cheap' WHEN own_fee > market_mean*CAST(1.1 AS DOUBLE) THEN 'expensive' ELSE 'average' END AS position FROM (
  SELECT {M}, step, CAST(max(fee) FILTER (carrier='TK') AS DOUBLE) AS own_fee, CAST(min(fee) FILTER (carrier<>'TK') AS DOUBLE) AS rival_min, CAST(max(fee) FILTER (carrier<>'TK') AS DOUBLE) AS rival_max, {mean('fee', 'market_mean')}
  FROM market_steps GROUP BY ALL) WHERE own_fee IS NOT NULL""")
SQL["j24_rival_comparison"] = b(f"""SELECT {M}, step, CAST(own AS DOUBLE) AS own_fee, rivals, CAST(own AS DOUBLE) - CAST(rs AS DOUBLE)/rivals AS gap FROM (SELECT {M}, step, fee AS own FROM market_steps WHERE carrier='TK')
  JOIN (SELECT {M}, step, count(*) AS rivals, sum(fee) AS rs FROM market_steps WHERE carrier<>'TK' GROUP BY ALL) USING ({M}, step)""")
SQL["a24_package_index"] = b(f"""SELECT origin, destination, season, {tier('cabin', 'brand_order')} AS tier, carrier, CAST(min(price) AS DOUBLE) AS price
  FROM ranked_ladders GROUP BY ALL""")
C["ladder_rights"] = f"""SELECT {U}, group_cabin AS cabin, raw_brand_name, right_key, status FROM rights
  QUALIFY row_number() OVER (PARTITION BY {U}, group_cabin, raw_brand_name, right_key ORDER BY {rank_of('status')} DESC, pos DESC)=1"""
C["tier_rights"] = f"""SELECT * FROM ranked_ladders JOIN (SELECT {L}, raw_brand_name, coalesce(list(right_key) FILTER (status IN ('Included','Paid')), []) AS granted,
  sum(CASE status WHEN 'Included' THEN CAST(1 AS DOUBLE) WHEN 'Paid' THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS score FROM ladder_rights GROUP BY ALL) USING ({L}, raw_brand_name)"""
C["tier_steps"] = f"""SELECT *, (brand_order+1) || '-' || (t+1) AS step, CAST(up - price AS DECIMAL(14,2)) AS fee, len(list_filter(ug, lambda x: NOT list_contains(granted, x))) AS gained, us - score AS change FROM (
   SELECT *, lead(brand_order) OVER w AS t, lead(granted) OVER w AS ug, lead(score) OVER w AS us, lead(price) OVER w AS up FROM tier_rights WINDOW w AS (PARTITION BY {L} ORDER BY brand_order)) WHERE t IS NOT NULL"""
SQL["a25_fee_heatmap"] = b("""SELECT carrier, step, units, metric, value FROM (SELECT carrier, step, count(*) AS units, CAST(sum(fee) AS DOUBLE)/count(fee) AS fee, CAST(sum(gained) AS DOUBLE)/count(*) AS rights_gained,
   sum(change)/count(*) AS score_change FROM tier_steps GROUP BY ALL) UNPIVOT (value FOR metric IN (fee, rights_gained, score_change))""")
SQL["a26_rights_gained"] = b("""SELECT carrier, cabin, CAST(brand_order AS INT) AS brand_order, CAST(t AS INT) AS to_order, count(*) AS units, CAST(sum(gained) AS BIGINT) AS gained, sum(change) AS score_change FROM tier_steps GROUP BY ALL""")
SQL["a32_content_score"] = b(f"SELECT carrier, {tier('cabin', 'brand_order')} AS tier, count(*) AS families, sum(score) AS score, max(score) AS best FROM tier_rights GROUP BY ALL")
C["step_places"] = """SELECT s.*, s.origin || '-' || s.destination AS ond, coalesce(country_name,'Other') AS origin_country, coalesce(region,'Other') AS origin_region FROM step_rows s LEFT JOIN airports ON origin=ap_code"""
SQL["a27_geographic_drill"] = b(f"SELECT ond, origin_country, origin_region, cabin, count(*) AS steps, {mean('fee', 'mean_fee')} FROM step_places GROUP BY GROUPING SETS ((ond,cabin),(origin_country,cabin),(origin_region,cabin))")
SQL["a27_rollup_and_cube"] = b(f"""SELECT 'rollup' AS kind, origin_region, origin_country, ond, NULL AS season, NULL AS cabin, count(*) AS steps, {mean('fee', 'mean_fee')} FROM step_places GROUP BY ROLLUP (origin_region, origin_country, ond)
  UNION ALL SELECT 'cube', NULL, NULL, NULL, season, cabin, count(*), {mean('fee', 'mean_fee')} FROM step_places GROUP BY CUBE (season, cabin)""")
SQL["a28_carrier_profile"] = b(f"""SELECT * FROM (SELECT carrier, count(DISTINCT (origin, destination)) AS routes, CAST(max(brand_order)+1 AS INT) AS tiers, string_agg(DISTINCT raw_brand_name, ', ' ORDER BY raw_brand_name) AS families FROM ranked_ladders GROUP BY carrier)
  JOIN (SELECT carrier, {mean('fee', 'mean_fee')} FROM step_rows GROUP BY ALL) USING (carrier)""")
SQL["a29_distinct_counts"] = b("SELECT count(*) AS rows, count(DISTINCT (origin, destination)) AS onds, count(DISTINCT carrier) AS carriers, count(DISTINCT (carrier, raw_brand_name)) AS packages FROM lines")
SQL["a30_first_right_map"] = b(f"""SELECT carrier, k, right_key, status, raw_value FROM (SELECT *, {key('raw_brand_name')} AS k FROM rights)
  QUALIFY row_number() OVER (PARTITION BY carrier, k, right_key ORDER BY pos, flight_id, status, raw_value)=1""")
SQL["a31_nested_index"] = b("""SELECT carrier, CAST(count(*) OVER (PARTITION BY carrier) AS INT) AS n_onds, ond, seasons FROM (SELECT carrier, ond, string_agg(season || ':' || cabins, ';' ORDER BY season) AS seasons FROM (
   SELECT carrier, origin || '-' || destination AS ond, season, string_agg(DISTINCT cabin, '/' ORDER BY cabin) AS cabins FROM ladders GROUP BY carrier, ond, season) GROUP BY ALL)""")
SQL["o1_comparison_order"] = b(f"SELECT {L}, CAST(brand_order AS INT) AS brand_order, raw_brand_name FROM ranked_ladders ORDER BY origin, destination, carrier, season, {base('cabin')}, brand_order")
SQL["p16_export_filters"] = b(f"""SELECT carrier, group_cabin, count(*) AS packages, count(DISTINCT flight_id) AS ladders FROM cards ANTI JOIN (SELECT DISTINCT {FL} FROM rights WHERE right_key='meal') USING ({FL})
  WHERE season='Summer' GROUP BY ALL""")
SQL["p17_filter_bar"] = b("""SELECT CAST(coll_date AS VARCHAR) AS coll_date, carrier, cabin, origin || '-' || destination AS ond, count(*) AS n, CAST(sum(price) AS DOUBLE) AS total FROM collected LEFT JOIN airports ON origin=ap_code
  WHERE carrier IN ('TK','LH','AC') AND cabin IN ('Economy','Business') AND season='Summer' AND coalesce(region,'Other') IN ('Europe','Turkey') AND coll_date BETWEEN DATE '2026-01-16' AND DATE '2026-01-17' GROUP BY ALL""")
SQL["p17_departure_filter"] = b("""SELECT carrier, group_cabin AS cabin, origin || '-' || destination AS ond, count(*) AS n, CAST(sum(price_value) AS DOUBLE) AS total FROM placed WHERE carrier IN ('TK','LH','AC') AND group_cabin IN ('Economy','Business')
  AND season='Summer' AND origin_region IN ('Europe','Turkey') AND departure BETWEEN DATE '2026-06-01' AND DATE '2026-07-10' GROUP BY ALL""")
