"""SQL for sources and sinks: the same content straight from the tables."""

from stairfare.rules import rights as R

from . import cte as c
from .cte import C, U, base, build as b, rank_of
from .sql_ladders import FL, L
from .sql_quality import SUMMARY
from .sql_texts import rule_line

SQL = {}
C["res_rights"] = f"SELECT {FL}, raw_brand_name, count(*) AS nr FROM best_rights GROUP BY ALL"
C["rec"] = f"""SELECT {U}, pass_no, count(*) AS packages, CAST(sum(nr) AS BIGINT) AS right_lines, count(DISTINCT group_cabin) AS cabins, string_agg(DISTINCT group_cabin, ',' ORDER BY group_cabin) AS cabin_list
  FROM results JOIN res_rights USING ({FL}, raw_brand_name) GROUP BY {U}, pass_no"""
SQL["s2_read_records"] = b(f"SELECT {U}, count(*) AS records, CAST(sum(packages) AS BIGINT) AS packages, CAST(sum(right_lines) AS BIGINT) AS right_lines FROM rec GROUP BY ALL")
SQL["s3_tolerant_read"] = b("SELECT carrier, count(*) AS n FROM records WHERE pass_no<>1 GROUP BY ALL UNION ALL SELECT '(broken)', count(*) FROM records WHERE pass_no=1")
SQL["s4_flatten_records"] = b(f"""SELECT carrier, group_cabin, raw_brand_name, price_type, source AS cabin_source, count(*) AS n, CAST(sum(price_value) AS DOUBLE) AS total, CAST(sum(nr) AS BIGINT) AS rights,
  count(mileage_available) AS with_miles, CAST(max(departure) AS VARCHAR) AS last_day FROM results JOIN res_rights USING ({FL}, raw_brand_name) GROUP BY ALL""")
SQL["s5_nest_records"] = b(f"SELECT upper(concat_ws('|', {U})) AS unit_key, pass_no, CAST(cabins AS INT) AS cabins, CAST(packages AS INT) AS packages, CAST(right_lines AS INT) AS right_lines, cabin_list FROM rec")
SQL["s6_append_units"] = b("SELECT carrier, season, count(*) AS n FROM records GROUP BY ALL")
SQL["s7_overlay_rewrite"] = b(f"""SELECT carrier, note, count(*) AS n FROM (SELECT *, CASE WHEN pass_no=0 THEN 'disk' ELSE 'new' END AS note FROM records) r
  WHERE note='new' OR NOT EXISTS (SELECT 1 FROM records x WHERE x.pass_no>0 AND {' AND '.join(f'x.{k.strip()}=r.{k.strip()}' for k in U.split(','))}) GROUP BY ALL""")
SQL["s12_concatenate_passes"] = b("SELECT carrier, pass_no AS pass_order, count(*) AS n FROM records GROUP BY ALL")
s = lambda x: f"coalesce(CAST({x} AS VARCHAR), '')"
C["right_wide"] = f"SELECT {FL}, raw_brand_name, {', '.join(f'''coalesce(max(status) FILTER (right_key='{k}'), 'Unknown') AS {k}''' for k in R.RIGHT_KEYS)} FROM best_rights GROUP BY ALL"
C["published_places"] = """SELECT p.*, coalesce(a.city_code, p.origin) AS origin_city_code, coalesce(a.country_code,'') AS origin_country_code, coalesce(d.city_code, p.destination) AS dest_city_code, coalesce(d.country_code,'') AS dest_country_code
  FROM published p LEFT JOIN airports a ON p.origin=a.ap_code LEFT JOIN airports d ON p.destination=d.ap_code"""
cols = {"Carrier": "carrier", "Origin": "origin", "Destination": "destination", "Origin City Code": "origin_city_code", "Origin Country Code": "origin_country_code", "Dest City Code": "dest_city_code",
        "Dest Country Code": "dest_country_code", "Departure Date": "departure", "Return Date": "return_date", "Season": "season", "Cabin": "cabin", "Brand Order": "brand_order", "Tier Code": "tier_code",
        "Raw Brand Name": "pretty_name", "Normalized Brand Name": "shown_name", "Display Price": f"CASE WHEN display_price_text<>'' THEN display_price_text ELSE {s('price_value')} END",
        "Calculated Absolute Price": "coalesce(abs_price, CASE WHEN price_type='absolute' THEN price_value END)", "Currency": "currency", "Source": "source", "Fare Family Code": c.clean_code("fare_family_code"),
        "Brand Description": "''", **{R.RIGHT_TITLES[k]: k for k in R.RIGHT_KEYS}, "Mileage Available": "CASE WHEN mileage_available THEN 'Yes' WHEN NOT mileage_available THEN 'No' ELSE '' END",
        "Miles Earned": "miles_earned", "Bonus Percent": "bonus_percent", "Scrape Timestamp": "'2026-01-15T00:00:00'", "Status": "'success'", "Retry Count": "0"}
SQL["s8_flat_csv"] = b(f"SELECT {', '.join(f'{s(v)} AS {chr(34)}{k}{chr(34)}' for k, v in cols.items())} FROM published_places JOIN right_wide USING ({FL}, raw_brand_name)")
SQL["s9_failed_units"] = b("""SELECT carrier AS "Carrier", origin AS "Origin", destination AS "Destination", season AS "Season", final_status AS "Status", CAST(flight_id%3 AS VARCHAR) AS "Retry Count", 'direct, market' AS "Sources Tried",
  nullif(error,'') AS "Error", issues AS "Validation Issues", CAST(elapsed_s AS VARCHAR) AS "Elapsed (s)" FROM judged_units WHERE NOT (opportunistic AND n_brands=0) AND n_brands=0""")
SQL["s10_run_summary_json"] = b(SUMMARY)
C["known_rights"] = f"""SELECT * FROM rights WHERE status<>'Unknown' QUALIFY row_number() OVER (PARTITION BY {FL}, raw_brand_name, right_key ORDER BY {rank_of('status')} DESC, pos)=1"""
SQL["s11_feed_json"] = b(f"""SELECT carrier, season, CASE WHEN origin_country_code='TR' OR dest_country_code='TR' THEN 'Local' ELSE 'Beyond' END AS ond_type, CASE WHEN {c.low_cost('carrier')} THEN 'Low Cost' ELSE 'Legacy' END AS carrier_type,
  feature, state, detail, count(*) AS n, CAST(sum(CASE WHEN currency='USD' THEN coalesce(abs_price, price_value) END) AS DOUBLE) AS price_total FROM published_places JOIN (SELECT {FL}, raw_brand_name,
   {c.mapping('right_key', R.FEED_KEYS.items())} AS feature, status AS state, {c.short_detail('right_key', 'raw_value', 'status')} AS detail FROM known_rights) USING ({FL}, raw_brand_name) GROUP BY ALL""")
C["feed_keys"] = f"SELECT DISTINCT {c.mapping('right_key', R.FEED_KEYS.items())} AS feature FROM known_rights JOIN published USING ({FL}, raw_brand_name)"
SQL["s11_feed_envelope"] = b("""SELECT '2026-01-15T00:00:00' AS generated_at, (SELECT count(*) FROM published) AS count, (SELECT string_agg(feature, ',' ORDER BY feature) FROM feed_keys) AS features, 'v12_' || season AS run_id,
  '2026-01' AS coll_date, season AS coll_season, '2026-01-15T00:00:00' AS collected_at, string_agg(DISTINCT carrier, ',' ORDER BY carrier) AS airlines,
  string_agg(DISTINCT origin || '-' || destination, ',' ORDER BY origin || '-' || destination) AS onds, count(*) AS record_count, 'OK' AS status FROM published GROUP BY season""")
SQL["s16_filtered_tsv"] = b(f"SELECT {L}, raw_brand_name, CAST(price AS VARCHAR) AS price FROM ladders WHERE carrier IN ('TK','LH') AND season='Winter'")
txt = "(desc0 || '  ' || tip)"
C["market_items"] = f"""SELECT carrier, raw_brand_name, price_value, right_key AS nm, st, raw_value AS desc0, CASE WHEN st='Paid' THEN 'Kesintili' ELSE '' END AS tip,
  {c.mapping('right_key', R.ITEM_CODES)} AS rk FROM (SELECT {FL}, raw_brand_name, right_key, status AS st, raw_value FROM best_rights) JOIN cards USING ({FL}, raw_brand_name)"""
det = f"CASE WHEN list_contains({c.arr(R.BAGGAGE_KEYS)}, rk) AND st='Paid' THEN '2 parça X 23 kg' ELSE desc0 END"
usd = "CAST(round(CAST(100 + price_value AS DECIMAL(14,2)) * CAST('0.0243' AS DECIMAL(10,6)), 2) AS DECIMAL(14,2))"
SQL["s18_marketplace_json"] = b(f"""SELECT carrier AS marketing, raw_brand_name, CASE WHEN rk IS NOT NULL THEN 'right' ELSE 'description' END AS kind, rk AS right_key, CASE WHEN rk IS NOT NULL THEN CASE WHEN st='Not Included' THEN 'Not Included'
   WHEN {c.status_of(txt)}='Paid' OR contains(lower({txt}), 'kesintili') THEN 'Paid' WHEN {c.status_of(txt)}='Not Included' THEN 'Not Included' ELSE 'Included' END END AS status, count(*) AS n,
   CAST(sum({usd}) AS DOUBLE) AS total, max({det}) AS last_value FROM market_items GROUP BY ALL""")
C["market_bodies"] = f"""SELECT {FL}, origin, destination, block_no, date_pos, count(*) AS packages, '{{"flights":{{"departure":[{{"price":{{"total":100.0}},"segments":[{{"marketing_airline":"' || any_value(carrier) || '"}}],"provider_packages":['
   || string_agg('{{"raw_name":"' || raw_brand_name || '"' || coalesce(',"total_price":' || CAST(price_value AS DOUBLE), '') || ',"currency":"TRY"' || coalesce(',"automation_key":"' || fare_family_code || '"', '') || ',"items":[' || items || ']}}', ',' ORDER BY screen_order)
   || ']}}]}},"currency_rates":{{"TRY":{{"Rates":{{"USD":0.0243}}}}}}}}' AS body
  FROM cards JOIN (SELECT {FL}, raw_brand_name, string_agg('{{"name":"' || right_key || '","description":"' || raw_value || '","attributes":{{"is_available":' || (status <> 'Not Included') || ',"piece":2'
     || CASE WHEN status='Paid' THEN ',"allowance":"23","tooltip":{{"text":"Kesintili"}}}}}}' ELSE ',"tooltip":{{}}}}}}' END, ',' ORDER BY right_key) AS items FROM best_rights GROUP BY ALL) USING ({FL}, raw_brand_name)
  GROUP BY {FL}, origin, destination, block_no, date_pos"""
SQL["s18_largest_response"] = b("""SELECT origin, destination, season, block_no, date_pos, group_cabin, packages FROM market_bodies
  QUALIFY row_number() OVER (PARTITION BY origin, destination, season, block_no, date_pos, group_cabin ORDER BY length(body) DESC, body)=1""")
C["air"] = f"""SELECT {U}, group_cabin AS cabin, flight_id, count(*) AS brands, count(*) FILTER (qty%20<>19) AS mapped, count(*) FILTER (ln%3=0) AS refused, max(qty || ' KG x ' || ln || ' PC' || CASE WHEN qty%20=19 THEN ' x ' || (ln*5) || '%' ELSE '' END) AS last_value FROM cards WHERE flight_id%17<>0 GROUP BY ALL"""
SQL["s19_airline_json"] = b(f"SELECT * FROM air QUALIFY row_number() OVER (PARTITION BY {L} ORDER BY brands DESC, flight_id)=1")
C["air_brands"] = f"""SELECT *, CASE ln%5 WHEN 1 THEN bare WHEN 0 THEN bare WHEN 2 THEN NULL ELSE raw_brand_name END AS code, ({c.arr([t for t, _ in R.AIRLINE_RIGHT_TYPES])})[CAST(qty%20 AS INT)+1] AS kind FROM (
  SELECT k.*, row_number() OVER (PARTITION BY {FL} ORDER BY screen_order) - 1 AS place, {c.pick(list(R.AIRLINE_BRAND_NAMES), 'qty % 3')} AS bare FROM cards k
  JOIN (SELECT {U}, cabin AS group_cabin, flight_id FROM air QUALIFY row_number() OVER (PARTITION BY {L} ORDER BY brands DESC, flight_id)=1) USING ({U}, group_cabin, flight_id))"""
key_of = c.mapping("kind", [(k, v) for k, v in R.AIRLINE_RIGHT_TYPES if v])
SQL["s19_airline_brands"] = b(f"""SELECT group_cabin AS cabin, coalesce({c.mapping('code', R.AIRLINE_BRAND_NAMES.items())}, code, group_cabin || ' #' || place) AS raw_brand_name, coalesce(code, '-') AS code,
  CASE WHEN qty%20=19 THEN ln%3<>0 END AS mileage_available, CASE WHEN qty%20=19 THEN CAST(ln*5 AS DOUBLE) END AS bonus_percent, count(*) AS n, CAST(sum(price_value) AS DOUBLE) AS total,
  max(CASE WHEN kind IS NULL THEN '' WHEN {key_of} IS NULL THEN kind || ': ' || val WHEN {key_of} IN ('checked_baggage','cabin_baggage') THEN replace({key_of}, '_', ' ') || ': ' || val ELSE '' END) AS last_description
  FROM (SELECT *, qty || ' KG x ' || ln || ' PC' AS val FROM air_brands) GROUP BY ALL""")
w = c.cabin_of("raw_brand_name")
tab = c.override('carrier', 'fare_family_code', "''", 2)
C["boxes"] = f"""SELECT {FL}, carrier, raw_brand_name AS card, coalesce(tabled, raw_brand_name) AS raw_brand_name, CAST(CAST('319.08' AS DECIMAL(14,2)) + coalesce(price_value, 0) AS DECIMAL(14,2)) AS pv FROM (SELECT *, {tab} AS tabled, {w} AS w FROM cards)
  WHERE tabled IS NOT NULL OR NOT coalesce(w<>group_cabin AND w<>'Premium Economy' AND group_cabin<>'Premium Economy' AND {base('w')} <= {base('group_cabin')}, FALSE)"""
SQL["s20_search_page_json"] = b(f"""SELECT row_carrier, raw_brand_name, currency, line, kind, key, status, n, total FROM ({rule_line('line')} FROM (SELECT carrier AS row_carrier, raw_brand_name, 'USD' AS currency, line, count(*) AS n, CAST(sum(pv) AS DOUBLE) AS total
  FROM boxes JOIN (SELECT DISTINCT {FL}, raw_brand_name AS card, line FROM rule_lines) USING ({FL}, card) GROUP BY ALL)))""")
SQL["s21_verification_report"] = b("""SELECT carrier, season, verdict, CASE WHEN season='Summer' AND verdict LIKE 'OK%' THEN 'prior' ELSE 'now' END AS origin_of_row, count(*) AS n FROM verdicts GROUP BY ALL""")
SQL["u3_rule_line_rows"] = b(r"""SELECT line, n, lower(regexp_extract(m, '^([\p{L}]*)', 1)) AS fact, regexp_extract(m, '(\d+)$', 1) AS value FROM (SELECT line, n, unnest(regexp_extract_all(line, '[\p{L}]*[^\p{L}\d]*?\d+')) AS m FROM (SELECT line, count(*) AS n FROM rule_lines GROUP BY ALL))""")
C["penalty_counts"] = "SELECT supp_no%6 AS form, qty, count(*) AS n FROM raw_lines GROUP BY ALL"
C["penalty_facts"] = """SELECT n, unnest(CASE form
  WHEN 0 THEN [['date_change','before',q],['date_change','after',more]] WHEN 1 THEN [['date_change','before',q],['refund','before','Not Included']]
  WHEN 2 THEN [['refund','before','Included'],['refund','after','Not Included'],['date_change','before',q],['date_change','after',q]]
  WHEN 3 THEN [['refund','after',more],['date_change','after',q]]
  WHEN 4 THEN [['refund','before','Not Included'],['refund','after','Not Included'],['date_change','before','Included'],['date_change','after',q]] ELSE [] END) AS f
  FROM (SELECT form, n, CAST(qty AS VARCHAR) AS q, CAST(qty+40 AS VARCHAR) AS more FROM penalty_counts)"""
SQL["u3_penalty_rows"] = b("SELECT f[1] AS topic, f[2] AS phase, f[3] AS outcome, count(*) AS lines, CAST(sum(n) AS BIGINT) AS n FROM penalty_facts GROUP BY ALL")
