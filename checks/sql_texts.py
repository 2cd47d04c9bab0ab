"""SQL for the bulk text jobs."""

from stairfare.rules import rights as R, vocab

from . import cte as c

SQL = {}
b = c.build


def tally(src, *cols):
    named = ", ".join(cols)
    return f"SELECT {named}, count(*) AS n FROM {src} GROUP BY ALL"


N = "raw_brand_name"
SQL["f1_match_key"] = b(tally("lines", N, f"{c.key(N)} AS match_key"))
SQL["f2_subtier"] = b(tally("lines", N, f"{c.subtier(N)} AS subtier", f"{c.subrank(c.subtier(N))} AS subtier_rank"))
SQL["f3_cabin_word"] = b(tally("lines", N, f"{c.cabin_of(N)} AS cabin_word"))
SQL["f4_pretty_name"] = b(tally("lines", "carrier", N, f"{c.pretty(N, 'carrier')} AS pretty_name"))
SQL["f5_suspicious_name"] = b(f"""SELECT pretty_name, coalesce(fare_family_code,'-') AS code,
  {c.suspicious('pretty_name', 'fare_family_code')} AS suspicious, count(*) AS n
  FROM (SELECT *, {c.pretty(N, 'carrier')} AS pretty_name FROM lines) GROUP BY ALL""")
SQL["f6_effective_cabin"] = b(tally(
    "lines", "carrier", N, "coalesce(fare_family_code,'-') AS code", "group_cabin",
    "coalesce(hint, '-') AS hint", f"{c.effective(N, 'fare_family_code', 'hint', 'group_cabin', 'carrier')} AS effective_cabin")
    .replace("FROM lines", "FROM (SELECT *, CASE WHEN ln%4=0 THEN 'Business' WHEN ln%4=1 THEN 'Premium Economy' END AS hint FROM lines)"))
lbl = c.mapping(c.subtier(N), [(k, t) for k, _, t in vocab.SUBTIERS])
cleaned = f"trim(regexp_replace(regexp_replace({N}, '(?i)\\b(class|fare|package|brand)\\b', ' ', 'g'), '\\s+', ' ', 'g'))"
SQL["f7_canonical_name"] = b(tally(
    "lines", N, "group_cabin",
    f"coalesce(group_cabin || ' ' || {lbl}, group_cabin || ' — ' || {cleaned}) AS canonical_name",
    f"{c.base('group_cabin')} + {c.subrank(c.subtier(N))} AS global_rank"))
SQL["f8_clean_fare_code"] = b(tally("lines", "coalesce(fare_family_code,'-') AS code",
                                    f"{c.clean_code('fare_family_code')} AS clean_code"))


def number(t):
    num = f"ltrim(regexp_extract({t}, '([-+]?\\d[\\d.,]*)', 1), '+')"
    lc = f"(length({num}) - instr(reverse({num}), ','))"
    ld = f"(length({num}) - instr(reverse({num}), '.'))"
    eu = f"replace(replace({num}, '.', ''), ',', '.')"
    us = f"replace({num}, ',', '')"
    return f"""TRY_CAST(CASE WHEN contains({num}, ',') AND contains({num}, '.') THEN CASE WHEN {lc} > {ld} THEN {eu} ELSE {us} END
      WHEN contains({num}, ',') THEN CASE WHEN regexp_matches({num}, ',\\d{{1,2}}$') THEN {eu} ELSE {us} END ELSE {num} END AS DECIMAL(14,2))"""


def currency(t):
    w = f"upper(regexp_extract({t}, '(?i)\\b(USD|EUR|TRY|GBP|TL)\\b', 1))"
    return f"""CASE WHEN contains({t},'$') THEN 'USD' WHEN contains({t},'€') THEN 'EUR' WHEN contains({t},'₺') THEN 'TRY'
      WHEN contains({t},'£') THEN 'GBP' WHEN contains({t},'TL') THEN 'TRY' WHEN {w} <> '' THEN {w} END"""


SQL["f9_parse_price"] = b(f"""SELECT CASE WHEN price_text LIKE '+%' THEN 'delta' ELSE 'absolute' END AS price_type,
  {currency('price_text')} AS currency, count(*) AS n, CAST(sum({number('price_text')}) AS DOUBLE) AS total,
  CAST(max({number('price_text')}) AS DOUBLE) AS largest FROM lines GROUP BY ALL""")
SQL["f10_split_cents"] = b("""SELECT carrier, CAST(sum(CAST(list_price AS DECIMAL(14,2))) AS DOUBLE) AS total,
  min(CAST(list_price AS DECIMAL(14,2))::VARCHAR || ' USD') AS first_text FROM lines GROUP BY ALL""")
SQL["f11_base_plus_delta"] = b("""SELECT carrier, ln, CAST(sum(CASE WHEN ln=3 THEN CAST(qty AS DECIMAL(14,2))
  WHEN ln=5 THEN CAST(list_price AS DECIMAL(14,2)) ELSE CAST(list_price AS DECIMAL(14,2)) + qty END) AS DOUBLE) AS total,
  count(*) AS n FROM lines GROUP BY ALL""")
SQL["f12_lira_to_usd"] = b("""SELECT carrier, currency, CAST(sum(CASE WHEN currency='TRY' THEN
  CAST(round(CAST(list_price AS DECIMAL(14,2)) * (CAST(240 + flight_id%5 AS DECIMAL(10,0)) * CAST('0.0001' AS DECIMAL(5,4))), 2) AS DECIMAL(14,2))
  ELSE CAST(list_price AS DECIMAL(14,2)) END) AS DOUBLE) AS total_usd, count(*) AS n FROM lines GROUP BY ALL""")
SQL["f13_status_of_text"] = b(tally("rule_lines", "line", f"{c.status_of('line')} AS status"))
item_text = "(raw_value || '  ' || CASE WHEN ln=5 THEN 'Kesintili' ELSE '' END)"
SQL["f14_item_status"] = b(tally("rights", "ln", "right_key", f"""CASE WHEN ln<>1 AND ln%3=1 THEN 'Not Included'
  WHEN {c.status_of(item_text)} = 'Paid' OR contains(lower({item_text}), 'kesintili') THEN 'Paid'
  WHEN {c.status_of(item_text)} = 'Not Included' THEN 'Not Included' ELSE 'Included' END AS item_status"""))
SQL["f15_flagged_status"] = b(tally("lines", "ln", """CASE WHEN ln%3=1 OR ln=2 THEN 'Not Included'
  WHEN ln%2=0 OR ln=5 THEN 'Paid' ELSE 'Included' END AS status""", """coalesce(nullif(concat_ws(' x ',
  CASE WHEN ln%2=0 THEN qty || ' KG' END, CASE WHEN ln%3=0 THEN ln || ' PC' END, CASE WHEN ln=7 THEN qty || ' USD' END,
  CASE WHEN ln=5 THEN qty || '%' END), ''), 'ALLOWED') AS raw_value"""))


def rule_line(x):
    miles = f"(regexp_matches({x}, '{R.MILES_LINE_PATTERN}') AND NOT contains(lower({x}), 'baggage'))"
    num = f"TRY_CAST(replace(regexp_extract({x}, '(\\d[\\d.,]*)', 1), ',', '') AS DOUBLE)"
    pct = f"regexp_matches({x}, '{R.PERCENT_LINE_PATTERN}')"
    bag = f"regexp_matches({x}, '{R.BAG_LINE_PATTERN}')"
    bk = f"lower(regexp_extract({x}, '{R.BAG_LINE_PATTERN}', 1))"
    bp, bg = (f"TRY_CAST(regexp_extract({x}, '{R.BAG_LINE_PATTERN}', {i}) AS INT)" for i in (2, 3))
    rule = f"regexp_matches({x}, '{R.RULE_LINE_PATTERN}')"
    tok = f"upper(regexp_extract({x}, '{R.RULE_LINE_PATTERN}', 1))"
    txt = f"trim(regexp_extract({x}, '{R.RULE_LINE_PATTERN}', 2))"
    rkey = f"(CASE {tok} " + " ".join(f"WHEN {c.lit(k)} THEN {c.lit(v)}" for k, v in R.RULE_TOKENS) + f" ELSE coalesce({c.right_of(tok)}, '') END)"
    fkey = f"coalesce({c.right_of(x)}, '')"
    kind = f"""CASE WHEN {miles} THEN 'miles' WHEN {bag} THEN CASE WHEN contains({bk}, 'personal') THEN 'ignored' ELSE 'right' END
      WHEN {rule} THEN CASE WHEN {rkey} <> '' THEN 'right' ELSE 'description' END WHEN {fkey} <> '' THEN 'right' ELSE 'description' END"""
    return f"""SELECT *, CASE WHEN kind='right' THEN k0 END AS key, CASE WHEN kind='right' THEN s0 END AS status,
      CASE WHEN kind='right' THEN v0 END AS value, CASE WHEN kind='miles' AND NOT pct THEN num END AS earned,
      CASE WHEN kind='miles' AND pct THEN num END AS bonus FROM (SELECT *, {kind} AS kind, {pct} AS pct, {num} AS num,
      CASE WHEN {bag} THEN CASE WHEN contains({bk}, 'cabin') THEN 'cabin_baggage' ELSE 'checked_baggage' END WHEN {rule} THEN {rkey} ELSE {fkey} END AS k0,
      CASE WHEN {bag} THEN CASE WHEN {bp}>0 AND {bg}>0 THEN 'Included' ELSE 'Not Included' END WHEN {rule} THEN {c.status_of(txt)}
        ELSE CASE WHEN {c.status_of(x)}='Unknown' THEN 'Included' ELSE {c.status_of(x)} END END AS s0,
      CASE WHEN {bag} THEN {bp} || ' x ' || {bg} || ' KG' WHEN {rule} THEN {txt} ELSE {x} END AS v0"""


SQL["f16_rule_lines"] = b(f"""SELECT line, kind, key, status, value, earned, bonus, n FROM (
  {rule_line('line')} FROM (SELECT line, count(*) AS n FROM rule_lines GROUP BY ALL)))""")
items = [i for i, _ in R.ITEM_CODES] + ["entertainment"]
types = [i for i, _ in R.AIRLINE_RIGHT_TYPES] + ["NO_SHOW"]
SQL["f17_item_codes"] = b(f"""SELECT item, {c.mapping('item', R.ITEM_CODES, "''")} AS right_key, right_type,
  {c.mapping('right_type', R.AIRLINE_RIGHT_TYPES, "''")} AS airline_key, count(*) AS n FROM (SELECT
  {c.pick(items, 'supp_no % 28')} AS item, {c.pick(types, 'part_no % 20')} AS right_type FROM lines) GROUP BY ALL""")
SQL["f18_rule_detail"] = b(tally("rights", "right_key", "status", f"{c.rule_word('right_key', 'status')} AS detail"))
SQL["f19_baggage_short"] = b(f"""SELECT raw_value, {c.bag_short('raw_value')} AS short, count(*) AS n FROM rights
  WHERE list_contains({c.arr(R.BAGGAGE_KEYS)}, right_key) GROUP BY ALL""")
SQL["f20_baggage_text"] = b(tally("lines", "ln", """CASE WHEN ln<>4 AND qty%2=0 THEN ln || ' parça X ' || qty || ' kg'
  ELSE '1 bag' END AS detail"""))
SQL["f21_fee_text"] = b(f"SELECT raw_value, {c.fee_text('raw_value')} AS fee, count(*) AS n FROM rights WHERE status='Paid' GROUP BY ALL")
SQL["f22_miles_feature"] = b(tally("cards", """CASE WHEN mileage_available THEN 'Included' WHEN NOT mileage_available
  THEN 'Not Included' END AS state""", """CASE WHEN mileage_available IS NOT NULL THEN coalesce(CASE WHEN coalesce(miles_earned,0)<>0
  THEN CAST(miles_earned AS BIGINT) || ' mil' WHEN coalesce(bonus_percent,0)<>0 THEN '%' || CAST(bonus_percent AS BIGINT) || ' bonus' END, '') END AS detail"""))
SQL["f23_display_price"] = b("""SELECT carrier, max(live) AS live_text, max(stored) AS stored_text,
  count(*) FILTER (live <> stored) AS differ, CAST(sum(CASE WHEN currency='USD' THEN price_value END) AS DOUBLE) AS usd_total
  FROM (SELECT *, CASE WHEN ln%2=0 AND price_text<>'' THEN price_text ELSE coalesce(CAST(price_value AS VARCHAR),'') END AS live,
  CASE WHEN ln%2=0 THEN price_text ELSE '' END AS stored FROM lines) GROUP BY ALL""")
SQL["f24_row_names_carrier"] = b(f"""SELECT carrier, text, {c.norm_airline('text')} AS norm,
  (coalesce({c.norm_airline('airline_name')} <> '' AND contains({c.norm_airline('text')}, {c.norm_airline('airline_name')}) AND airline_name IS NOT NULL, FALSE)
   OR regexp_matches(upper(text), '\\b' || carrier || '\\s?-?\\s?[0-9]{{1,4}}\\b')) AS is_target, count(*) AS n
  FROM (SELECT *, CASE WHEN flight_id%2=0 THEN row_carrier || ' 12 · Nonstop' ELSE operating END AS text FROM itineraries)
  LEFT JOIN airlines ON carrier = dim_carrier GROUP BY ALL""")
SQL["f27_keys"] = b(tally("lines", "upper(concat_ws('|', carrier, origin, destination, season)) AS unit_key",
                          "upper(concat_ws('|', carrier, origin, destination, season, group_cabin)) AS ladder_key"))
SQL["f29_lbs_to_kg"] = b(tally("lines", "qty*2-1 AS lbs", """CAST(CASE WHEN qty*2-1 BETWEEN 15 AND 18 THEN 8
  WHEN qty*2-1 BETWEEN 22 AND 23 THEN 10 WHEN qty*2-1 = 50 THEN 23 WHEN qty*2-1 = 70 THEN 32
  ELSE floor((qty*2-1)*CAST(0.4536 AS DOUBLE)+0.5) END AS INT) AS kg"""))
card_ok = "price_type='absolute' AND ln NOT IN (5,6) AND price_value IS NOT NULL AND lower(raw_brand_name) NOT IN ('flexible','economy','business','first')"
kg = "(CASE WHEN qty%60+10 BETWEEN 15 AND 18 THEN 8 WHEN qty%60+10 BETWEEN 22 AND 23 THEN 10 WHEN qty%60+10=50 THEN 23 ELSE CAST(floor((qty%60+10)*CAST(0.4536 AS DOUBLE)+0.5) AS INT) END)"
SQL["f30_fare_cards"] = b(f"""SELECT card_cabin, brand_name, r.key AS key, r.status AS status, r.value AS value, count(*) AS n,
  CAST(sum(price_value) AS DOUBLE) AS price_total, CAST(sum(qty*100) AS BIGINT) AS miles_total FROM (
  SELECT CASE WHEN group_cabin='Business' THEN 'Business' ELSE 'Economy' END AS card_cabin, raw_brand_name AS brand_name, price_value, qty,
   unnest(list_filter([
    {{'key':'cabin_baggage','status':'Included','value':'1 x ' || {kg} || ' KG'}},
    CASE WHEN ln%2=0 THEN {{'key':'checked_baggage','status':'Not Included','value':'Not included'}} ELSE {{'key':'checked_baggage','status':'Included','value':'2 x 23 KG'}} END,
    CASE WHEN ln%3=0 THEN {{'key':'refund','status':'Not Included','value':'Non-refundable (partial tax refund only)'}} ELSE {{'key':'refund','status':'Paid','value':'$' || qty}} END,
    CASE WHEN ln%3=1 THEN {{'key':'change','status':'Not Included','value':'Changes not permitted'}} END,
    CASE WHEN ln=4 THEN {{'key':'lounge_access','status':'Included','value':'Salon erişimi var'}} END], lambda x: x IS NOT NULL)) AS r
  FROM cards WHERE {card_ok}) GROUP BY ALL""")
SQL["f31_json_round_trip"] = b("""SELECT raw_brand_name AS path_name, coalesce(fare_family_code,'-') AS code, count(*) AS n,
  CAST(sum(price_value) AS DOUBLE) AS total FROM cards GROUP BY ALL""")
SQL["f32_mileage_yes_no"] = b(tally("cards", "season", "CASE WHEN mileage_available THEN 'Yes' WHEN NOT mileage_available THEN 'No' ELSE '' END AS mileage"))
label = "coalesce(format('{:,.2f}', CAST(price_value AS DOUBLE)) || ' ' || currency, 'n/a')"
SQL["f33_display_formats"] = b(f"""SELECT coalesce(airline_name || ' (' || carrier || ')', carrier) AS title, currency,
  max({label}) AS last_label, min({label}) AS first_label, count(*) AS n FROM lines LEFT JOIN airlines ON carrier=dim_carrier GROUP BY ALL""")
SQL["f34_state_detail"] = b(tally("rights", "right_key", "CASE WHEN trim(raw_value)<>'' THEN status || ' — ' || trim(raw_value) ELSE status END AS cell"))
SQL["f35_elapsed_seconds"] = f"""SELECT user_id, {c.r3('epoch_us(max(ts))/CAST(1000000 AS DOUBLE) - epoch_us(min(ts))/CAST(1000000 AS DOUBLE)')} AS elapsed_s FROM events GROUP BY ALL"""
SQL["f35_elapsed_seconds"] = """SELECT user_id, floor(((epoch_us(max(ts)) - epoch_us(min(ts)))/CAST(1000000 AS DOUBLE))*1000+0.5)/1000 AS elapsed_s FROM events GROUP BY ALL"""
