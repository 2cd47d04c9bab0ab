"""Named SQL fragments and the builder that puts the needed ones before a SELECT."""

import re

from stairfare.rules import places, rights as R, vocab
from stairfare.sources import bridge as B


def lit(v):
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def arr(values):
    return "[" + ",".join(lit(v) for v in values) + "]"


def pick(values, index):
    return f"({arr(values)})[CAST({index} AS INT)+1]"


def chain(text, rules, default="NULL"):
    whens = " ".join(f"WHEN contains({text}, {lit(t)}) THEN {lit(v)}" for t, v in rules)
    return f"(CASE {whens} ELSE {default} END)"


def mapping(key, pairs, default="NULL"):
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in pairs)
    return f"(CASE {key} {whens} ELSE {default} END)"


def any_of(text, words):
    return "(" + " OR ".join(f"contains({text}, {lit(w)})" for w in words) + ")"


def values(rows, cols):
    body = ",".join("(" + ",".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) v({cols}))"


def itin(k, season="season", dates=True):
    b = f"({k} // 500)"
    blk = f"((({b} * 7) % 15) // 5 + 1)"
    pos = f"((({b} * 7) % 15) % 5)"
    out = f"""{pick(B.CARRIERS, f'{k} % 25')} AS carrier,
    {pick(B.ORIGINS, f'({k} // 25) % 4')} AS origin,
    {pick(B.DESTINATIONS, f'({k} // 100) % 5')} AS destination,
    CAST({b} % 3 AS INT) AS pass_no, {pick(B.SOURCES, f'({b} + {k} // 1500) % 3')} AS source,
    CAST({blk} AS INT) AS block_no, CAST({pos} AS INT) AS date_pos"""
    if dates:
        out += f""",
    (CASE WHEN {season}='Summer' THEN DATE '2026-06-01' ELSE DATE '2026-11-10' END
       + CAST(({blk}-1)*30 + {pos} AS INT)) AS departure,
    (CASE WHEN {season}='Summer' THEN DATE '2026-06-01' ELSE DATE '2026-11-10' END
       + CAST(({blk}-1)*30 + {pos} + 3 AS INT)) AS return_date"""
    return out


def price_text(p, ln, qty):
    us = f"format('{{:,.2f}}', CAST({p} AS DOUBLE))"
    return f"""(CASE WHEN {p} IS NULL THEN '' WHEN {ln}%4=0 THEN '₺' || translate({us}, ',.', '.,')
      WHEN {ln}%4=1 THEN '$' || {us}
      WHEN {ln}%4=2 THEN CAST(CAST({p} AS DECIMAL(14,2)) AS VARCHAR) || ' USD'
      ELSE '+' || {qty} || ' USD' END)"""


def key(x):
    return f"regexp_replace(lower(coalesce({x},'')), '[^a-z0-9]', '', 'g')"


def padded(x):
    return f"(' ' || lower(coalesce({x},'')) || ' ')"


def subtier(x):
    return chain(padded(x), vocab.SUBTIER_TOKENS)


def cabin_of(x):
    return chain(padded(x), vocab.CABIN_TOKENS)


def base(c):
    return f"(CASE {c} WHEN 'Premium Economy' THEN 1000 WHEN 'Business' THEN 2000 WHEN 'First' THEN 3000 ELSE 0 END)"


def subrank(s):
    return f"(CASE {s} " + " ".join(f"WHEN {lit(k)} THEN {r}" for k, r, _ in vocab.SUBTIERS) + " ELSE 35 END)"


def tier(c, order):
    return f"(CASE {c} WHEN 'Premium Economy' THEN 'PEco' WHEN 'Business' THEN 'Bus' WHEN 'First' THEN 'Fir' ELSE 'Eco' END || '-' || ({order}+1))"


def tokens(x):
    return f"list_filter(regexp_split_to_array(upper(coalesce({x},'')), '[-_/ ]'), lambda t: t <> '')"


def override(carrier, code, name, what):
    """what: 2 = display name, 3 = cabin."""
    def first(x):
        pairs = [(f"{r[0]}|{r[1]}", r[what]) for r in vocab.FAMILY_CODES]
        hit = f"list_filter({tokens(x)}, lambda t: list_contains({arr([k for k, _ in pairs])}, upper({carrier}) || '|' || t))[1]"
        return mapping(f"(upper({carrier}) || '|' || {hit})", pairs)
    return f"coalesce({first(code)}, {first(name)})"


def pe_code(x):
    return f"regexp_matches(upper(trim(coalesce({x},''))), '{vocab.PE_CODE_PATTERN}')"


def effective(name, code, hint, fallback, carrier):
    short = " OR ".join(
        f"(upper({carrier})={lit(c)} AND list_has_any(list_concat({tokens(code)}, {tokens(name)}), {arr(v)}))"
        for c, v in vocab.PE_CODES_BY_CARRIER.items())
    return f"""coalesce({override(carrier, code, name, 3)}, CASE WHEN {short} THEN 'Premium Economy' END,
      {cabin_of(name)}, CASE WHEN {pe_code(name)} OR {pe_code(code)} THEN 'Premium Economy' END, {hint}, {fallback})"""


def cap(w):
    return f"(upper(substr({w},1,1)) || lower(substr({w},2)))"


def upper_only(s):
    return f"({s} = upper({s}) AND {s} <> lower({s}))"


def bare(s):
    return f"regexp_matches({s}, '{vocab.BARE_CODE_PATTERN}')"


def pretty(name, carrier):
    s = f"trim(coalesce({name},''))"
    spell = mapping(f"(upper({carrier}) || '|' || {key(s)})", [(f"{c}|{k}", v) for c, k, v in vocab.SPELLINGS])
    words = f"list_aggregate(list_transform(regexp_split_to_array({s}, '\\s+'), lambda w: {cap('w')}), 'string_agg', ' ')"
    return f"""coalesce({spell}, CASE WHEN {bare(s)} THEN {s} WHEN {upper_only(s)} AND contains({s}, ' ') THEN {words}
      WHEN {upper_only(s)} AND list_contains({arr(vocab.FARE_WORDS)}, lower({s})) THEN {cap(s)} ELSE {s} END)"""


def suspicious(name, code):
    s = f"trim(coalesce({name},''))"
    return f"""({s} = '' OR {bare(s)} OR coalesce({upper_only(s)} AND NOT contains({s}, ' ')
      AND NOT list_contains({arr(vocab.FARE_WORDS)}, lower({s})) AND len({tokens(code)}) > 0
      AND {key(s)} = {key(tokens(code) + '[1]')}, FALSE))"""


def clean_code(code):
    t = f"list_filter(regexp_split_to_array(trim(coalesce({code},'')), '[-_/ ]'), lambda t: t <> '' AND NOT regexp_matches(t, '{vocab.HEX_ID_PATTERN}'))"
    return f"coalesce(CASE WHEN len(list_distinct({t}))=1 THEN {t}[1] ELSE array_to_string({t}, '-') END, '')"


def norm_text(x):
    return f"regexp_replace(lower(trim(coalesce({x},''))), '\\s+', ' ', 'g')"


def right_of(x):
    flat = sorted([(w, k) for k, ws in R.SYNONYMS for w in ws], key=lambda p: -len(p[0]))
    return chain(norm_text(x), flat)


def status_of(x):
    t, raw = norm_text(x), f"coalesce({x},'')"
    return f"""(CASE WHEN regexp_matches({raw}, '{R.MONEY_PATTERN}') OR regexp_matches({raw}, '{R.PLUS_MONEY_PATTERN}')
       OR {any_of(t, R.PAID_HINTS)} THEN 'Paid'
      WHEN {any_of(t, R.EXCLUDED_HINTS)} OR regexp_matches({t}, '{R.EXCLUDED_WORD_PATTERN}') THEN 'Not Included'
      WHEN {any_of(t, R.INCLUDED_HINTS)} OR regexp_matches({t}, '{R.INCLUDED_WORD_PATTERN}') THEN 'Included'
      ELSE 'Unknown' END)"""


def rank_of(s):
    return f"(CASE {s} WHEN 'Included' THEN 3 WHEN 'Paid' THEN 2 WHEN 'Not Included' THEN 1 ELSE 0 END)"


def fee_usd(x):
    t = f"coalesce({x},'')"
    ex = lambda g: f"regexp_extract({t}, '{R.FEE_PATTERN}', {g})"
    amount = f"(CASE WHEN {ex(1)} <> '' THEN {ex(2)} ELSE {ex(3)} END)"
    cur = f"(CASE {ex(1)} WHEN '$' THEN 'USD' WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' ELSE CASE upper({ex(4)}) WHEN 'TL' THEN 'TRY' ELSE upper({ex(4)}) END END)"
    commas = f"(length({amount}) - length(replace({amount}, ',', '')))"
    last = lambda ch: f"(CASE WHEN contains({amount}, '{ch}') THEN length({amount}) - instr(reverse({amount}), '{ch}') ELSE -1 END)"
    n = f"TRY_CAST(CASE WHEN {commas} = 1 AND {last(',')} > {last('.')} THEN replace(replace({amount}, '.', ''), ',', '.') ELSE replace({amount}, ',', '') END AS DOUBLE)"
    rate = f"(CASE {cur} WHEN 'TRY' THEN CAST(1.0 AS DOUBLE)/41 WHEN 'EUR' THEN CAST(1.09 AS DOUBLE) WHEN 'GBP' THEN CAST(1.27 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END)"
    return f"(CASE WHEN {amount} <> '' THEN {n} * {rate} END)"


def fee_text(x):
    return f"(CASE WHEN {fee_usd(x)} > 0 THEN '~' || replace(format('{{:,.0f}}', {fee_usd(x)}), ',', '.') || ' USD' ELSE '' END)"


def bag_short(x):
    t = f"coalesce({x},'')"
    both = r"(?i)(\d+)\s*(?:parça|pieces?|pc)?\s*[x×]\s*(\d+)\s*kg"
    w = f"regexp_extract({t}, '(?i)(\\d+)\\s*kg', 1)"
    p = f"regexp_extract({t}, '(?i)(\\d+)\\s*(?:parça|pieces?|pc)\\b', 1)"
    return f"""(CASE WHEN regexp_matches({t}, '{both}') THEN regexp_extract({t}, '{both}', 1) || '×' || regexp_extract({t}, '{both}', 2) || 'kg'
      WHEN {w} <> '' AND {p} <> '' THEN {p} || '×' || {w} || 'kg' WHEN {w} <> '' THEN {w} || 'kg' ELSE '' END)"""


def rule_word(k, s):
    pairs = [(f"{r}|{st}", w) for r, p, i in R.RULE_DETAILS for st, w in (("Paid", p), ("Included", i))]
    return f"(CASE WHEN list_contains({arr([r for r, _, _ in R.RULE_DETAILS])}, {k}) THEN {mapping(f'({k} || {lit(chr(124))} || {s})', pairs, lit(''))} END)"


def short_detail(k, v, s):
    return f"""(CASE WHEN {rule_word(k, s)} IS NOT NULL THEN CASE WHEN {fee_text(v)} <> '' THEN {rule_word(k, s)} || ' · ' || {fee_text(v)} ELSE {rule_word(k, s)} END
      WHEN list_contains({arr(R.BAGGAGE_KEYS)}, {k}) THEN {bag_short(v)} ELSE '' END)"""


def norm_airline(x):
    return f"trim(regexp_replace(regexp_replace(lower(coalesce({x},'')), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"


def low_cost(c):
    return f"list_contains({arr(vocab.LOW_COST)}, upper({c}))"


def r3(x, digits=3):
    m = 10 ** digits
    return f"(floor(({x})*{m}+0.5)/{m})"


U = "carrier, origin, destination, season"
C = {}

C["raw_lines"] = f"""SELECT o_custkey AS flight_id,
  CASE WHEN month(o_orderdate) BETWEEN 4 AND 10 THEN 'Summer' ELSE 'Winter' END AS season,
  {pick(B.GROUP_CABINS, 'l_suppkey % 3')} AS group_cabin, {pick(B.BRANDS, 'l_partkey % 14')} AS raw_brand_name,
  CAST(l_partkey % 11 AS INT) AS code_no,
  CASE WHEN l_discount >= 0.095 AND l_linenumber = 7 THEN NULL
       WHEN l_returnflag='R' AND l_linenumber > 4 THEN CAST(l_quantity AS DECIMAL(14,2))
       ELSE CAST(l_extendedprice AS DECIMAL(14,2)) END AS price_value,
  CASE WHEN l_returnflag='R' AND l_linenumber > 4 THEN 'delta' ELSE 'absolute' END AS price_type,
  CASE WHEN l_linenumber=1 AND l_tax > 0.075 THEN 'TRY' ELSE 'USD' END AS currency,
  (l_orderkey*8 + l_linenumber)*1000 + l_partkey % 1000 AS screen_order,
  l_linenumber AS ln, CAST(l_quantity AS INT) AS qty, l_partkey AS part_no, l_suppkey AS supp_no,
  l_extendedprice AS list_price, l_linestatus='O' AS is_open
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

C["lines"] = f"""SELECT *, {itin('flight_id')}, {pick(B.CODES, 'code_no')} AS fare_family_code,
  {price_text('list_price', 'ln', 'qty')} AS price_text FROM raw_lines"""

C["cards"] = f"""SELECT * EXCLUDE (rn), {itin('flight_id')}, {pick(B.CODES, 'code_no')} AS fare_family_code,
  {price_text('price_value', 'ln', 'qty')} AS display_price_text,
  CASE WHEN is_open THEN TRUE WHEN ln%2=0 THEN FALSE END AS mileage_available,
  CASE WHEN is_open AND ln%3=0 THEN qty*CAST(10 AS DOUBLE) END AS miles_earned,
  CASE WHEN is_open AND ln%3=1 THEN qty*CAST(1 AS DOUBLE) END AS bonus_percent
FROM (SELECT flight_id, season, group_cabin, raw_brand_name, price_value, price_type, screen_order, code_no,
   currency, ln, qty, is_open, row_number() OVER (PARTITION BY flight_id, season, group_cabin, raw_brand_name
     ORDER BY price_type='delta', price_value IS NULL, price_value, screen_order) rn FROM raw_lines) WHERE rn=1"""

C["rights"] = f"""SELECT *, CASE
    WHEN list_contains({arr(R.BAGGAGE_KEYS)}, right_key) THEN CASE ln%3
       WHEN 0 THEN (ln%3+1) || ' parça X ' || (qty*3) || ' kg kabin (55x40x20 cm)' WHEN 1 THEN (qty*3) || 'kg'
       ELSE (ln%3+1) || ' pieces, ' || (qty*3) || ' KG' END
    WHEN status='Paid' THEN CASE WHEN ln=7 THEN '' WHEN ln%2=0 THEN 'Change fee: from $' || qty
       ELSE 'Yakl. ' || qty || '0.00 TRY (48 saate kadar)' END ELSE '' END AS raw_value, {itin('flight_id')}
FROM (SELECT flight_id, season, group_cabin, raw_brand_name, ln, qty, screen_order,
   {pick(R.RIGHT_KEYS, '(supp_no + ln + 5*j) % 16')} AS right_key,
   {pick(B.STATUSES, '(part_no + ln + j) % 4')} AS status, screen_order*4 + j AS pos
   FROM raw_lines, (VALUES (0),(1),(2)) t(j))"""

C["rule_lines"] = f"""SELECT flight_id, season, group_cabin, raw_brand_name, screen_order, CASE supp_no % 12
  WHEN 0 THEN 'Baggage: ' || (ln%3) || ' x 23 KG' WHEN 1 THEN 'Cabin Baggage: ' || (ln%2) || ' x 8 KG'
  WHEN 2 THEN 'Personal item: 1 x 3 kg' WHEN 3 THEN 'SEATSELECTION - at charge'
  WHEN 4 THEN 'CANCEL_BEFOREDEPARTURE - Non-refundable.' WHEN 5 THEN 'CHANGE_AFTERDEPARTURE - change permitted 2+ days'
  WHEN 6 THEN '%' || qty || ' Ekstra Mil' WHEN 7 THEN 'Earn 1,' || qty || ' miles' WHEN 8 THEN 'Food Menu'
  WHEN 9 THEN 'PRIORITY_CHECKIN - free' WHEN 10 THEN 'Lounge access included'
  ELSE 'Date change fee: from $' || qty END AS line, {itin('flight_id')} FROM raw_lines"""

C["itineraries"] = f"""SELECT *, flight_id%3=0 AS direct,
  CASE WHEN flight_id%11=0 THEN 'BA' WHEN flight_id%7=0 THEN '' ELSE carrier END AS row_carrier,
  CASE WHEN flight_id%13=0 THEN 'QR' WHEN flight_id%5=0 THEN '' ELSE carrier END AS fare_iata,
  {pick(B.OPERATORS, 'flight_id % 9')} AS operating, flight_id%19=0 AS virtual_interline, flight_id%23=0 AS exclusive,
  carrier AS m1, CASE WHEN flight_id%3<>0 AND flight_id%4=0 THEN other ELSE carrier END AS o1,
  CASE WHEN flight_id%3<>0 THEN CASE WHEN flight_id%5=0 THEN other ELSE carrier END END AS m2,
  CASE WHEN flight_id%3<>0 THEN carrier END AS o2, flight_id%6=0 AS shared1
FROM (SELECT c_custkey AS flight_id, c_mktsegment, c_acctbal, {itin('c_custkey', dates=False)},
  {pick(B.CARRIERS, '(c_custkey+1) % 25')} AS other FROM customer)"""

C["ladders"] = f"""SELECT {U}, group_cabin AS cabin, raw_brand_name, min(price_value) AS price FROM lines
  WHERE price_type='absolute' AND price_value IS NOT NULL GROUP BY ALL"""

C["job_rows"] = f"""SELECT c_custkey AS pos, c_mktsegment, c_acctbal,
  {itin('c_custkey', dates=False)} FROM customer"""

C["airports"] = "SELECT * FROM " + values(
    places.AIRPORTS, "ap_code, city_code, city_name, country_code, country_name, region")
C["airlines"] = "SELECT * FROM " + values(
    [(c, n) for c, n, _ in places.CARRIERS], "dim_carrier, airline_name")


def build(select: str, **extra) -> str:
    """``WITH`` the fragments the query needs, directly or through others."""
    have = {**C, **extra}
    need, order = set(), []

    def visit(sql):
        for name in have:
            if name not in need and re.search(rf"\b{name}\b", sql):
                need.add(name)
                visit(have[name])
                order.append(name)
    visit(select)
    ctes = ",\n".join(f"{n} AS ({have[n]})" for n in order)
    return (f"WITH {ctes}\n" if ctes else "") + select
