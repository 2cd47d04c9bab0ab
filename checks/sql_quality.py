"""SQL for completeness, run summaries, quality checks and verification."""

from stairfare.rules import rights as R, vocab

from . import cte as c
from .cte import C, U, base, build as b, pretty, subrank, subtier
from .sql_choosing import D, recursive
from .sql_ladders import CONSENSUS, FL, L

SQL = {}
FLAGS = ["missing_cabin", "missing_brands", "missing_price", "missing_rights", "missing_miles", "missing_source", "missing_business"]
SQL["a6_unit_completeness"] = b(f"SELECT flight_id, {U}, {', '.join(FLAGS)}, issues, missing_brands OR missing_source OR missing_price OR missing_business AS needs_retry FROM judged_units")
SQL["a7_final_status"] = b("SELECT carrier, status, final_status, count(*) AS n FROM judged_units GROUP BY ALL")
cnt = "FROM judged_units WHERE NOT (opportunistic AND n_brands=0)"
SUMMARY = f"""SELECT count(*) AS units, count(*) FILTER (final_status='success') AS succeeded, count(*) FILTER (final_status='partial') AS partial,
  count(*) FILTER (final_status='no_availability') AS no_availability, count(*) FILTER (final_status='failed') AS failed,
  {', '.join(f'count(*) FILTER ({f}) AS units_{f}' for f in FLAGS)}, CAST(sum(n_brands) AS BIGINT) AS rows, sum(elapsed_s) AS total_seconds {cnt}"""
SQL["a8_run_summary"] = b(SUMMARY)
SQL["p11_successful_units"] = b("SELECT carrier, season, count(*) AS n FROM judged_units WHERE final_status='success' GROUP BY ALL")
SQL["p12_uncounted_opportunistic"] = b(f"SELECT carrier, opportunistic, count(*) AS n {cnt} GROUP BY ALL")
SQL["p21_second_pass"] = b("SELECT carrier, status, missing_business, count(*) AS n FROM judged_units WHERE (n_brands=0 AND status='failed') OR missing_business GROUP BY ALL")
SQL["a9_currency_leaks"] = b(r"""SELECT carrier, currency, regexp_matches(price_text || ' ' || currency, '\b(TL|TRY)\b') AS text_leak, count(*) AS n FROM lines
  WHERE currency<>'USD' OR regexp_matches(price_text || ' ' || currency, '\b(TL|TRY)\b') GROUP BY ALL""")
fam = c.override('carrier', 'fare_family_code', 'raw_brand_name', 2)
SQL["a10_duplicate_names"] = b(f"""SELECT carrier, pretty_name, count(*) AS ladders, 'read' AS stage FROM (SELECT {FL}, carrier, cabin, pretty_name FROM (
   SELECT *, {pretty('fam', 'carrier')} AS pretty_name FROM (SELECT *, {c.effective('fam', 'fare_family_code', 'NULL', 'group_cabin', 'carrier')} AS cabin FROM
    (SELECT *, coalesce({fam}, raw_brand_name) AS fam FROM cards)) WHERE cabin=group_cabin OR {base('cabin')}>{base('group_cabin')}) GROUP BY ALL HAVING count(*)>1) GROUP BY ALL
  UNION ALL SELECT carrier, shown_name, count(*), 'published' FROM (SELECT {L}, shown_name FROM published GROUP BY ALL HAVING count(*)>1) GROUP BY ALL""")
SQL["a11_misread_baggage"] = b(f"""SELECT carrier, right_key, short, count(*) AS n FROM (SELECT *, {c.bag_short('raw_value')} AS short FROM rights WHERE list_contains({c.arr(R.BAGGAGE_KEYS)}, right_key))
  WHERE regexp_matches(short, '^[0-9]{{3,}}kg$') GROUP BY ALL""")
SQL["a12_falling_prices"] = recursive(f"""SELECT carrier, cabin, shown_name, count(*) AS n, CAST(min(abs_price-before) AS DOUBLE) AS deepest FROM (SELECT *, lag(abs_price) OVER (PARTITION BY {L} ORDER BY
   brand_order, shown_name, abs_price) AS before FROM published2 WHERE abs_price IS NOT NULL) WHERE abs_price < before GROUP BY ALL""", CONSENSUS)
five = ["cabin_baggage", "checked_baggage", "meal", "seat_selection", "lounge_access"]
SQL["a13_right_coverage"] = b(f"""SELECT carrier, right_key, have, units, units-have AS missing, units>=8 AND units>have AND have/units>=0.85 AS flagged FROM (
  SELECT carrier, right_key, count(*) FILTER (has) AS have, count(*) AS units FROM (SELECT {U}, group_cabin, k.right_key AS right_key, bool_or(r.right_key=k.right_key AND status<>'Unknown') AS has
   FROM rights r, (SELECT unnest({c.arr(five)}) AS right_key) k GROUP BY ALL) GROUP BY ALL)""")
SQL["a14_business_coverage"] = b(f"""SELECT carrier, count(*) AS units, count(*) FILTER (e AND NOT bz) AS missing FROM (SELECT {U}, bool_or(has_business) AS bz, bool_or(has_economy) AS e
  FROM attempts WHERE NOT {c.low_cost('carrier')} GROUP BY ALL) GROUP BY ALL""")
SQL["a15_refund_fee_spread"] = b(f"""SELECT CASE WHEN nf=0 THEN 'all' WHEN wf=0 THEN 'none' ELSE 'mixed' END AS spread, count(*) AS carriers, CAST(sum(wf) AS BIGINT) AS fees, CAST(sum(nf) AS BIGINT) AS no_fees FROM (
  SELECT carrier, count(*) FILTER ({c.fee_text('raw_value')}<>'') AS wf, count(*) FILTER ({c.fee_text('raw_value')}='') AS nf FROM rights WHERE right_key='refund' AND status='Paid' GROUP BY ALL) GROUP BY ALL""")
C["collected"] = f"SELECT {U}, group_cabin AS cabin, raw_brand_name, CAST(DATE '2026-01-15' + pass_no AS DATE) AS coll_date, min(price_value) AS price FROM lines WHERE price_type='absolute' AND price_value IS NOT NULL GROUP BY ALL"
SQL["a16_archive_rows"] = b("SELECT CAST(coll_date AS VARCHAR) AS coll_date, season, carrier, origin || '-' || destination AS ond, count(*) AS record_count FROM collected GROUP BY ALL")
SQL["a17_suspicious_names"] = b(f"""SELECT carrier, pretty_name, origin || '-' || destination AS ond, count(*) AS n FROM (SELECT *, {pretty('raw_brand_name', 'carrier')} AS pretty_name FROM lines)
  WHERE NOT {c.bare('pretty_name')} AND NOT list_contains({c.arr(vocab.ACCEPTED_TOKENS)}, upper(pretty_name)) AND {c.suspicious('pretty_name', 'fare_family_code')} GROUP BY ALL""")
C["reading"] = f"""SELECT {D}, side, list(raw_brand_name ORDER BY price_value, raw_brand_name) AS nm, list(price_value ORDER BY price_value, raw_brand_name) AS pr FROM sided GROUP BY ALL"""
C["verdicts"] = f"""SELECT *, CASE WHEN sn = ln_ THEN CASE WHEN len(list_filter(range(1, len(sp)+1), lambda i: abs(sp[i]-lp[i])>0.01))>0 THEN 'OK_PRICE_DRIFT' ELSE 'OK' END
   WHEN rot OR len(ln_)=0 THEN 'OK_INVENTORY_CHANGED' ELSE 'NAME_MISMATCH' END AS verdict FROM (SELECT *, len(ln_)>0 AND (list_has_all(sn, ln_) OR list_has_all(ln_, sn) OR
    len(list_intersect(sn, ln_))*2 >= least(len(sn), len(ln_))) AS rot FROM (SELECT s.* EXCLUDE (nm, pr, side), s.nm AS sn, s.pr AS sp, coalesce(l.nm, []) AS ln_, l.pr AS lp, l.nm IS NOT NULL AS has_live
   FROM (SELECT * FROM reading WHERE side='primary') s LEFT JOIN (SELECT * FROM reading WHERE side='secondary') l USING ({D})))"""
SQL["j23_compare_readings"] = b(f"SELECT {U}, CAST(departure AS VARCHAR) AS departure, group_cabin, verdict FROM verdicts")
C["code_names"] = f"""SELECT DISTINCT carrier, pretty_name FROM (SELECT *, {pretty('raw_brand_name', 'carrier')} AS pretty_name FROM lines)
  WHERE NOT {c.bare('pretty_name')} AND NOT list_contains({c.arr(vocab.ACCEPTED_TOKENS)}, upper(pretty_name)) AND {c.suspicious('pretty_name', 'fare_family_code')}"""
C["gate_rows"] = """SELECT verdict AS "check", count(*) AS found, verdict='NAME_MISMATCH' AS blocks FROM verdicts GROUP BY ALL
  UNION ALL SELECT 'suspicious_names', count(*), count(*) > 0 FROM code_names"""
SQL["a18_verification_gate"] = b("""SELECT * FROM gate_rows UNION ALL SELECT 'gate', (SELECT count(*) FROM verdicts), (SELECT bool_or(blocks) FROM gate_rows)""")
SQL["x5_rotated_inventory"] = b("SELECT carrier, rot AS rotated, count(*) AS n FROM verdicts WHERE has_live GROUP BY ALL")
SQL["a19_publish_gate"] = b("""SELECT carrier, outcomes, good, NOT (outcomes>20 AND good*100//outcomes<25) AS may_continue FROM (SELECT carrier, count(*) AS outcomes,
  count(*) FILTER (final_status='success') AS good FROM judged_units GROUP BY ALL)""")
SQL["a21_reading_fingerprint"] = b("""SELECT carrier, season, side, count(*) AS rows, bit_xor(h) AS hash_xor, CAST(sum(h % 1000003) AS BIGINT) AS hash_sum FROM (
  SELECT *, CAST('0x' || substr(md5(concat_ws('|', origin, destination, raw_brand_name, CAST(price_value AS VARCHAR))),1,8) AS BIGINT) AS h FROM sided) GROUP BY ALL""")
SQL["x6_reading_diff"] = b("""SELECT *, count(*) AS n FROM ((SELECT *, 'first' AS only_in FROM (SELECT carrier, group_cabin, raw_brand_name FROM sided WHERE side='primary' EXCEPT ALL SELECT carrier, group_cabin, raw_brand_name FROM sided WHERE side='secondary'))
  UNION ALL (SELECT *, 'second' FROM (SELECT carrier, group_cabin, raw_brand_name FROM sided WHERE side='secondary' EXCEPT ALL SELECT carrier, group_cabin, raw_brand_name FROM sided WHERE side='primary'))) GROUP BY ALL""")
SQL["a33_without_rights"] = b(f"""SELECT carrier, raw_brand_name, count(*) AS n FROM cards ANTI JOIN (SELECT {FL}, raw_brand_name FROM rights WHERE status<>'Unknown' AND raw_value<>'') USING ({FL}, raw_brand_name) GROUP BY ALL""")
SQL["a35_unit_sources"] = b(f"SELECT {U}, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS total_brands FROM results GROUP BY {U}")
SQL["p15_reported_rights"] = b("SELECT right_key, count(*) AS reported FROM rights WHERE status<>'Unknown' GROUP BY ALL")
falls = SQL["a12_falling_prices"]
SQL["o2_first_findings"] = f"WITH q AS ({falls}) SELECT carrier, cabin, shown_name, n, greatest((SELECT count(*) FROM q) - 15, 0) AS and_more FROM q ORDER BY carrier, cabin, shown_name LIMIT 15"
