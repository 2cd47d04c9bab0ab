"""SQL for human corrections."""

from stairfare.operators.changeset import RIGHT_COLS
from stairfare.rules import rights as R

from . import cte as c
from .cte import C, U, build as b, key
from .sql_ladders import FL, L

SQL = {}
q = "qty"
blank = ", ".join(f"'' AS \"{t}\"" for t in RIGHT_COLS if t not in ("Cabin Baggage", "Meal", "Refund"))
C["entries"] = f"""SELECT screen_order AS line, CASE WHEN qty%7=0 THEN 'remove' WHEN qty%7=1 THEN '' WHEN qty=50 THEN 'delete' ELSE 'UPSERT' END AS "Action", lower(carrier) AS "Carrier", origin AS "Origin",
  CASE WHEN qty=49 THEN 'X1' ELSE destination END AS "Destination", lower(season) AS "Season", upper(group_cabin) AS "Cabin", CAST(qty%14+1 AS VARCHAR) AS "Brand Order", raw_brand_name AS "Brand Name",
  CASE WHEN qty%3<>0 OR qty%11=0 THEN replace(CAST(CAST(list_price AS DECIMAL(14,2)) AS VARCHAR), '.', ',') ELSE '' END AS "Price USD", CASE WHEN qty%3=0 THEN CAST(qty AS VARCHAR) ELSE '' END AS "Step USD",
  CASE WHEN qty%13=0 THEN 'maybe' WHEN qty%4=1 THEN 'Included: 1×8kg' WHEN qty%4=2 THEN 'dahil' ELSE '' END AS "Cabin Baggage",
  CASE WHEN qty%3=0 THEN 'Paid: $5' WHEN qty%3=1 THEN '-' ELSE '' END AS "Meal", CASE WHEN qty%5=0 THEN 'ücretli:  48 h ' ELSE '' END AS "Refund", {blank}, 'n' || qty AS "Note"
  FROM lines WHERE ln%2=0 QUALIFY row_number() OVER (PARTITION BY {U}, group_cabin, raw_brand_name ORDER BY screen_order, flight_id, qty, list_price)=1"""
SQL["f25_right_cells"] = b("""SELECT title, cell, CASE lower(trim(split_part(trim(cell), ':', 1))) WHEN 'included' THEN 'Included' WHEN 'dahil' THEN 'Included' WHEN 'paid' THEN 'Paid' WHEN 'ücretli' THEN 'Paid' WHEN '-' THEN 'Not Included' END AS status,
  CASE WHEN contains(cell, ':') THEN trim(split_part(trim(cell), ':', 2)) ELSE '' END AS detail, count(*) AS n FROM (SELECT unnest(['Cabin Baggage','Meal','Refund']) AS title, unnest(["Cabin Baggage","Meal","Refund"]) AS cell FROM entries) WHERE cell<>'' GROUP BY ALL""")
C["checked"] = f"""SELECT *, CASE WHEN errs='' AND prev IS NOT NULL THEN 'same package on line ' || prev ELSE errs END AS errors FROM (
  SELECT *, lag(line) OVER (PARTITION BY carrier, origin, destination, season, cabin, k, errs='' ORDER BY line) AS prev FROM (SELECT *, CASE WHEN "Price USD"<>'' THEN CAST(replace("Price USD", ',', '.') AS DECIMAL(14,2)) END AS price_usd,
  CASE WHEN "Step USD"<>'' THEN CAST("Step USD" AS DECIMAL(14,2)) END AS step_usd, concat_ws('; ',
   CASE WHEN action='delete' THEN 'Action ''delete'' is not upsert or remove' END, CASE WHEN destination='X1' THEN 'Destination ''X1'' is not a code' END,
   CASE WHEN action='upsert' AND "Price USD"='' AND "Step USD"='' THEN 'Price USD or Step USD is needed' END, CASE WHEN "Price USD"<>'' AND "Step USD"<>'' THEN 'Price USD and Step USD exclude each other' END,
   CASE WHEN "Cabin Baggage"='maybe' THEN 'Cabin Baggage ''maybe'' is no status' END) AS errs FROM (
  SELECT *, lower(CASE WHEN "Action"='' THEN 'upsert' ELSE "Action" END) AS action, upper("Carrier") AS carrier, "Origin" AS origin, "Destination" AS destination, upper("Season"[1]) || "Season"[2:] AS season,
   CASE "Cabin" WHEN 'ECONOMY' THEN 'Economy' WHEN 'BUSINESS' THEN 'Business' ELSE 'Premium Economy' END AS cabin, "Brand Name" AS brand_name, {key('"Brand Name"')} AS k, CAST("Brand Order" AS INT) AS brand_no FROM
   (SELECT line, "Action", "Carrier", "Origin", "Destination", "Season", "Cabin", "Brand Order", "Brand Name", "Price USD", "Step USD", "Cabin Baggage", "Meal", "Refund", "Note" FROM entries) e)))"""
# DuckDB folds quoted names without regard to case, so the typed columns are renamed first
for word in ("Action", "Carrier", "Origin", "Destination", "Season", "Cabin"):
    C["checked"] = C["checked"].replace(f'"{word}"', f'"t_{word}"')
C["checked"] = C["checked"].replace('(SELECT line, "t_Action", "t_Carrier", "t_Origin", "t_Destination", "t_Season", "t_Cabin",',
                                    '(SELECT line, "Action" AS "t_Action", "Carrier" AS "t_Carrier", "Origin" AS "t_Origin", "Destination" AS "t_Destination", "Season" AS "t_Season", "Cabin" AS "t_Cabin",')
SQL["f26_check_entries"] = b("SELECT line, action, carrier, origin, destination, season, cabin, k, errors FROM checked")
SQL["s13_change_set_csv"] = b("""SELECT nullif("Action", '') AS "Action", "Carrier", "Cabin", count(*) AS n, count(nullif("Step USD", '')) AS steps, max("Note") AS last_note FROM entries GROUP BY ALL""")
SQL["s14_template_with_legend"] = b("""SELECT "Season", "Cabin", nullif("Meal", '') AS "Meal", count(*) AS n FROM entries GROUP BY ALL""")
cellx = "CASE WHEN trim(raw_value)<>'' THEN status || ': ' || trim(raw_value) ELSE status END"
SQL["s15_export_packages"] = b(f"""SELECT {U}, pass_no, group_cabin AS cabin, CAST(row_number() OVER (PARTITION BY {U}, pass_no, group_cabin ORDER BY screen_order, raw_brand_name) AS INT) AS brand_order,
   raw_brand_name AS brand_name, coalesce(CAST(price_value AS VARCHAR), '') AS price_usd, {', '.join(R.RIGHT_KEYS)} FROM results JOIN (SELECT {FL}, raw_brand_name, {', '.join(f"coalesce(max(cell) FILTER (right_key='{k}'), '') AS {k}" for k in R.RIGHT_KEYS)}
   FROM (SELECT *, {cellx} AS cell FROM rights QUALIFY row_number() OVER (PARTITION BY {FL}, raw_brand_name, right_key ORDER BY pos DESC, status DESC, raw_value DESC)=1) GROUP BY ALL) USING ({FL}, raw_brand_name)""")
C["collected"] = f"""SELECT *, {key('brand_name')} AS k, row_number() OVER (PARTITION BY {L} ORDER BY price_value, brand_name) - 1 AS screen_order FROM (SELECT {U}, group_cabin AS cabin, raw_brand_name AS brand_name, min(price_value) AS price_value
  FROM lines WHERE ln%2=1 AND price_type='absolute' AND price_value IS NOT NULL GROUP BY ALL)"""
C["valid"] = f"SELECT * FROM checked WHERE errors='' QUALIFY row_number() OVER (PARTITION BY {L}, k ORDER BY line DESC)=1"
C["merged"] = f"""SELECT m.*, u.carrier IS NULL AS new_unit FROM (SELECT {L}, k, CASE WHEN v.action IS NULL THEN 'kept' WHEN v.action='upsert' AND c.screen_order IS NOT NULL THEN 'updated' WHEN v.action='upsert' THEN 'added'
   WHEN c.screen_order IS NOT NULL THEN 'removed' ELSE 'nothing' END AS outcome, CASE WHEN v.action='upsert' THEN v.brand_name ELSE c.brand_name END AS brand_name, CASE WHEN v.action='upsert' THEN price_usd ELSE price_value END AS own_price,
   CASE WHEN v.action='upsert' THEN step_usd END AS step_usd, CASE WHEN v.action='upsert' THEN brand_no-1 ELSE c.screen_order END AS so FROM collected c FULL OUTER JOIN valid v USING ({L}, k)) m
  LEFT JOIN (SELECT DISTINCT {U} FROM collected) u USING ({U})"""
SQL["j16_merge_changes"] = b(f"SELECT {L}, k, outcome, brand_name, CAST(own_price AS DOUBLE) AS own_price, new_unit FROM merged")
C["placed_rows"] = f"""SELECT *, count(own_price) OVER w AS seg, row_number() OVER w - 1 AS place FROM merged WHERE outcome NOT IN ('removed','nothing')
  WINDOW w AS (PARTITION BY {L} ORDER BY so, own_price NULLS LAST, brand_name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
C["stepped"] = f"""SELECT *, coalesce(own_price, CASE WHEN step_usd IS NOT NULL THEN max(own_price) OVER (PARTITION BY {L}, seg) + sum(coalesce(step_usd,0)) OVER (PARTITION BY {L}, seg ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END) AS price FROM placed_rows"""
SQL["w15_step_prices"] = b(f"SELECT {L}, k, CAST(place AS INT) AS place, CAST(price AS DOUBLE) AS price FROM stepped")
SQL["j17_import_store"] = b(f"""SELECT carrier, season, cabin, note, count(*) AS n FROM (SELECT carrier, season, cabin, "Note" AS note FROM checked s WHERE season='Summer' AND NOT EXISTS (SELECT 1 FROM checked r WHERE r.cabin='Economy' AND
  {' AND '.join(f'r.{x.strip()} IS NOT DISTINCT FROM s.{x.strip()}' for x in (L + ', k').split(','))}) UNION ALL SELECT carrier, season, cabin, 'new' FROM checked WHERE cabin='Economy') GROUP BY ALL""")
cells = "CASE title WHEN 'Cabin Baggage' THEN CASE WHEN \"Cabin Baggage\"='dahil' THEN 'Included' ELSE \"Cabin Baggage\" END WHEN 'Meal' THEN CASE WHEN \"Meal\"='-' THEN 'Not Included' ELSE \"Meal\" END WHEN 'Refund' THEN CASE WHEN \"Refund\"<>'' THEN 'Paid: 48 h' ELSE '' END ELSE '' END"
C["cells"] = f"SELECT line, carrier, k, title, {cells} AS cell FROM (SELECT * FROM checked WHERE errors='') , (SELECT unnest({c.arr(RIGHT_COLS)}) AS title)"
SQL["j18_inherit_rights"] = b(f"""SELECT carrier, title, CASE WHEN cell<>'' THEN 'own' WHEN fm IS NOT NULL THEN 'manual' WHEN fd IS NOT NULL THEN 'data' ELSE 'none' END AS origin_of_cell, count(*) AS n,
   max(coalesce(nullif(cell,''), fm, fd, '')) AS last_cell FROM cells LEFT JOIN (SELECT carrier, k, title, arg_min(cell, line) AS fm FROM cells WHERE cell<>'' GROUP BY ALL) USING (carrier, k, title)
  LEFT JOIN (SELECT carrier, k, {c.mapping('right_key', R.RIGHT_TITLES.items())} AS title, {cellx} AS fd FROM (SELECT *, {key('raw_brand_name')} AS k FROM rights) QUALIFY row_number() OVER (PARTITION BY carrier, k, right_key ORDER BY pos, flight_id, status, raw_value)=1) USING (carrier, k, title) GROUP BY ALL""")
SQL["j27_overlay_one_unit"] = b("SELECT cabin, CAST(place AS INT) AS place, brand_name, outcome, CAST(price AS DOUBLE) AS price FROM stepped WHERE carrier='TK' AND origin='IST' AND destination='AMS' AND season='Summer'")
