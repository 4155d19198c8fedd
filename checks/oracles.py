"""Expected results of the registered queries, in SQL over the given tables.

The damage done to each feed line follows from its row key, so the outcome is
stated as a CASE on the key. Nothing here parses text.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Orders as each of the three clients (part 0, 1, 2) delivers them: the two copies of
# a re-delivered line (m = 9) are two rows.
TX = """
WITH base AS (
  SELECT o_orderkey AS k, o_orderkey % 97 AS m, o_custkey AS ck, unnest([0, 1, 2]) AS part,
         CAST(o_totalprice AS DECIMAL(12,2)) AS price, o_orderstatus AS st, o_orderpriority AS pr,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts
  FROM orders),
tx AS (
  SELECT *, price AS amt, 'client_' || substr('abc', part + 1, 1) AS client FROM base
  UNION ALL
  SELECT *, CAST(price + 1 AS DECIMAL(12,2)) AS amt,
         'client_' || substr('abc', part + 1, 1) AS client
  FROM base WHERE m = 9),
clean AS (
  SELECT *, CAST(CASE m WHEN 5 THEN 1234.50 ELSE amt END AS DECIMAL(12,2)) AS amount
  FROM tx WHERE m NOT IN (1, 2, 3, 4, 8, 10, 12))
"""

CUST = """
WITH cust AS (
  SELECT c_custkey AS k, c_custkey % 53 AS m, part, c_name, c_mktsegment, c_nationkey,
         'client_' || substr('abc', part + 1, 1) AS client,
         CAST(DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER) AS DATE) AS day
  FROM (SELECT *, unnest([0, 1, 2]) AS part FROM customer))
"""

ALL = TX + CUST.replace("WITH cust", ", cust")

REJECTED_TX = """CASE WHEN m IN (2, 3, 10) THEN 'unparseable_row'
    WHEN m = 1 THEN 'missing_required_field:amount'
    WHEN m = 4 THEN 'missing_required_field:source_customer_id'
    WHEN m = 8 THEN 'missing_required_field:source_customer_id,amount'
    WHEN m = 12 THEN 'missing_required_field:source_transaction_id,source_customer_id,amount' END"""
REJECTED_CUST = """CASE m WHEN 1 THEN 'missing_required_field:source_customer_id'
    WHEN 2 THEN 'unparseable_row' END"""

QUARANTINE = (
    ALL
    + f""", quarantined AS (
  SELECT client AS client_id, 'transactions' AS entity,
         CASE WHEN m <> 12 THEN CAST(k AS VARCHAR) END AS id, {REJECTED_TX} AS reason
  FROM tx WHERE m IN (1, 2, 3, 4, 8, 10, 12) AND NOT (m = 12 AND part = 2)
  UNION ALL
  SELECT client, 'customers', CASE WHEN m <> 1 THEN CAST(k AS VARCHAR) END, {REJECTED_CUST}
  FROM cust WHERE m IN (1, 2))
"""
)

# --- raw scan ---------------------------------------------------------------

REFUND = "CASE st WHEN 'F' THEN 'true' WHEN 'O' THEN '0' END"
RAW_TX_ID = "CASE m WHEN 12 THEN NULL WHEN 14 THEN ' ' || k || '  ' ELSE CAST(k AS VARCHAR) END"
RAW_TX_CUST = """CASE WHEN m IN (4, 12) THEN NULL WHEN m = 8 THEN 'NULL' WHEN m = 14 THEN '  ' || ck || ' '
    ELSE CAST(ck AS VARCHAR) END"""


def from_feed(client: str, entity: str, file: str) -> str:
    return f"'{client}' AS _client_id, '{entity}' AS _entity, '{file}' AS _source_file"


ORACLES["bronze_scan_comma"] = f"""{TX}
SELECT {RAW_TX_ID} AS transaction_id, {RAW_TX_CUST} AS customer_id,
  CASE WHEN m = 1 THEN 'SOME' WHEN m = 5 THEN '$1,234.50' WHEN m NOT IN (8, 12) THEN CAST(amt AS VARCHAR) END AS amount,
  CASE WHEN m = 6 THEN 'N/A' WHEN m <> 12 THEN 'USD' END AS currency,
  CASE WHEN m <> 12 THEN pr END AS channel,
  CASE WHEN m = 7 THEN 'SOMEDAY' WHEN m <> 12 THEN iso END AS created_ts,
  CASE WHEN m <> 12 THEN 'N/A' END AS discount_code,
  CASE WHEN m = 12 THEN NULL WHEN m = 11 AND st = 'P' THEN '"' ELSE {REFUND} END AS is_refund,
  {from_feed('client_a', 'transactions', 'transactions_2024_01.txt')}
FROM tx WHERE part = 0 AND m NOT IN (2, 3, 10)"""

B_NAME = """CASE m WHEN 3 THEN 'Zita' WHEN 4 THEN 'Kit|Marlow' WHEN 5 THEN NULL WHEN 6 THEN '  Olga  van Dyk '
    ELSE 'First' || k || ' Last' || k END"""
B_ADDRESS = """CASE m WHEN 11 THEN k || ' "Old" | Street' ELSE k || ' Main | Street' END"""
DAY_TEXT = "CASE m WHEN 7 THEN '2024-02-30' ELSE strftime(day, '%Y-%m-%d') END"

ORACLES["bronze_scan_pipe"] = f"""{CUST}
SELECT CASE WHEN m <> 1 THEN CAST(k AS VARCHAR) END AS cust_id, {B_NAME} AS full_name,
  CASE m WHEN 8 THEN 'None' ELSE 'u' || k || '@x.test' END AS contact_email, 'C' || c_nationkey AS country,
  {B_ADDRESS} AS address, CAST(k % 1000 AS VARCHAR) AS zip, {DAY_TEXT} AS created_date,
  CASE WHEN m = 9 THEN 'maybe' WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END AS vip_flag,
  {from_feed('client_b', 'customers', 'customer_dump.txt')}
FROM cust WHERE part = 1 AND m <> 2"""

C_AGE = "CASE WHEN k % 10 = 0 THEN 'unknown' ELSE CAST(20 + k % 50 AS VARCHAR) END"

ORACLES["bronze_scan_tab"] = f"""{CUST}
SELECT CASE WHEN m <> 1 THEN CAST(k AS VARCHAR) END AS id, 'F' || k AS fname, 'L' || k AS lname,
  {DAY_TEXT} AS signup_date, {C_AGE} AS age,
  CASE WHEN m = 9 THEN 'maybe' WHEN k % 2 = 0 THEN '1' ELSE '0' END AS marketing_opt_in,
  {from_feed('client_c', 'customers', 'customers.txt')}
FROM cust WHERE part = 2 AND m <> 2"""

ORACLES["bronze_corrupt_capture"] = f"""{TX},
lines AS (
  SELECT client, part, m, k, CAST(k AS VARCHAR) AS c0,
    CASE part
      WHEN 0 THEN ck || ',' || price || ',USD,"' || pr || '",' || iso || ',N/A,' || coalesce({REFUND}, '')
      WHEN 1 THEN ck || '|' || price || '|EUR|' || iso || '|' || (k % 7) || '|' || pr
      ELSE ck || chr(9) || price || chr(9) || CAST((k % 1000) / 100.0 AS DECIMAL(12,2)) || chr(9) || price
           || chr(9) || pr END AS others,
    CASE part WHEN 0 THEN ',' WHEN 1 THEN '|' ELSE chr(9) END AS sep
  FROM tx)
SELECT client AS client_id, CASE WHEN m <> 12 THEN c0 END AS id, m IN (2, 3, 10) AS is_corrupt,
  CASE m WHEN 2 THEN c0 WHEN 3 THEN c0 || sep || others || sep || 'extra'
         WHEN 10 THEN c0 || sep || '"' || others END AS corrupt_text
FROM lines WHERE NOT (m = 12 AND part = 2)"""

# A line that does not parse keeps the fields that were read of it, and all of its text.
CORRUPT_TX = f"""CASE m
  WHEN 2 THEN CAST(k AS VARCHAR)
  WHEN 3 THEN k || sep || others || sep || 'extra'
  WHEN 10 THEN k || sep || '"' || others END"""
LINES = f"""{TX},
lines AS (
  SELECT *, CASE part WHEN 0 THEN ',' WHEN 1 THEN '|' ELSE chr(9) END AS sep,
    CASE part
      WHEN 0 THEN ck || ',' || price || ',USD,"' || pr || '",' || iso || ',N/A,' || coalesce({REFUND}, '')
      WHEN 1 THEN ck || '|' || price || '|EUR|' || iso || '|' || (k % 7) || '|' || pr
      ELSE ck || chr(9) || price || chr(9) || CAST((k % 1000) / 100.0 AS DECIMAL(12,2)) || chr(9) || price
           || chr(9) || pr END AS others
  FROM tx)"""


def tx_cell(normal: str, open_quote: str = "NULL") -> str:
    """A cell of a transaction line: absent where only the key is there, or a quote was left open."""
    return f"CASE WHEN m IN (2, 12) THEN NULL WHEN m = 10 THEN {open_quote} ELSE {normal} END"


RAW_AMOUNT_CELL = "CASE m WHEN 1 THEN 'SOME' WHEN 5 THEN '$1,234.50' WHEN 8 THEN NULL ELSE CAST(amt AS VARCHAR) END"
RAW_TS_CELL = "CASE m WHEN 7 THEN 'SOMEDAY' ELSE iso END"

ORACLES["bronze_scan_pipe_transactions"] = f"""{LINES}
SELECT {RAW_TX_ID} AS txn_id, {tx_cell(RAW_TX_CUST, "others")} AS cust_id, {tx_cell(RAW_AMOUNT_CELL)} AS total,
  {tx_cell("CASE m WHEN 6 THEN 'N/A' ELSE 'EUR' END")} AS currency, {tx_cell(RAW_TS_CELL)} AS txn_ts,
  {tx_cell("CAST(k % 7 AS VARCHAR)")} AS items, {tx_cell("pr")} AS notes, {CORRUPT_TX} AS _corrupt_record,
  {from_feed('client_b', 'transactions', 'txn_history.txt')}
FROM lines WHERE part = 1"""

TAX_TEXT = "CAST(CAST((k % 1000) / 100.0 AS DECIMAL(12,2)) AS VARCHAR)"

ORACLES["bronze_scan_tab_transactions"] = f"""{LINES}
SELECT {RAW_TX_ID} AS id, {tx_cell(RAW_TX_CUST, "others")} AS user_id, {tx_cell("CAST(price AS VARCHAR)")} AS price_usd,
  {tx_cell(TAX_TEXT)} AS tax, {tx_cell(RAW_AMOUNT_CELL)} AS final_amount, {tx_cell("pr")} AS payment_type,
  {CORRUPT_TX} AS _corrupt_record, {from_feed('client_c', 'transactions', 'transactions.txt')}
FROM lines WHERE part = 2 AND m <> 12"""

ORACLES["bronze_scan_headerless"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS number, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
  o_orderstatus AS status, 'headless' AS _client_id, 'orders' AS _entity, 'lines.txt' AS _source_file
FROM orders"""

ORACLES["bronze_row_counts"] = f"""{ALL}
SELECT client AS client_id, 'transactions' AS entity, count(*) AS row_count
FROM tx WHERE NOT (m = 12 AND part = 2) GROUP BY client
UNION ALL SELECT client, 'customers', count(*) FROM cust GROUP BY client"""

ORACLES["table_roundtrip"] = """
SELECT count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS amount_sum
FROM orders"""

ORACLES["versions_and_readers"] = """
SELECT reader, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders JOIN (VALUES ('before both', NULL), ('after the quick one', 'O'), ('after the slow one', 'F')) AS r(reader, status)
  ON status IS NULL OR o_orderstatus = status
GROUP BY reader"""

ORACLES["names_change_together"] = """
SELECT l_returnflag AS flag, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum, sum(l_quantity) AS quantity, true AS shown
FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY 1"""

ORACLES["bronze_recut_gzip"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS number, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
  o_orderstatus AS status,
  CASE WHEN o_orderkey % 10 = 3
       THEN o_orderkey || ';' || CAST(o_totalprice AS DECIMAL(12,2)) || ';' || o_orderstatus || ';extra' END AS corrupt_text
FROM orders"""

# --- scalar steps -----------------------------------------------------------

ORACLES["rename_null_tokens"] = """
SELECT 'client_x' AS client_id, CAST(o_orderkey AS VARCHAR) AS source_transaction_id,
  CASE o_orderkey % 12 WHEN 6 THEN 'none' WHEN 7 THEN 'N/a' WHEN 9 THEN chr(9) || 'NULL'
       WHEN 10 THEN 'USD' WHEN 11 THEN 'EUR' END AS currency
FROM orders"""

ORACLES["split_name"] = """
SELECT CAST(c_custkey AS VARCHAR) AS id,
  CASE c_custkey % 10 WHEN 1 THEN 'Zita' WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN 'Olga'
    WHEN 6 THEN 'Una' WHEN 7 THEN 'NULL' WHEN 8 THEN 'Kit|Marlow' ELSE 'First' || c_custkey END AS first_name,
  CASE c_custkey % 10 WHEN 5 THEN 'van Dyk' || c_custkey WHEN 6 THEN 'fold ' || c_custkey
    WHEN 0 THEN 'Last' || c_custkey WHEN 9 THEN 'Last' || c_custkey END AS last_name
FROM customer"""

ORACLES["parse_dates"] = """
SELECT event_id, CASE WHEN event_id % 6 = 0 THEN CAST(ts AS DATE) END AS by_day,
  CASE WHEN event_id % 6 = 1 THEN CAST(ts AS DATE) END AS by_time
FROM events"""

ORACLES["parse_timestamps"] = """
SELECT event_id, CASE WHEN event_id % 8 IN (0, 7)
    OR (event_id % 8 = 5 AND month(ts) >= 10 AND day(ts) >= 10)
  THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_ts
FROM events"""

ORACLES["cast_int_safe"] = """
SELECT l_orderkey, l_linenumber,
  CASE (l_orderkey + l_linenumber) % 10 WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN NULL
    WHEN 7 THEN NULL WHEN 8 THEN -CAST(trunc(l_quantity) AS INTEGER)
    ELSE CAST(trunc(l_quantity) AS INTEGER) END AS quantity
FROM lineitem"""

ORACLES["cast_decimal_clean"] = """
WITH l AS (SELECT l_orderkey, l_linenumber, (l_orderkey + l_linenumber) % 14 AS m,
                  CAST(l_extendedprice AS DECIMAL(12,2)) AS price FROM lineitem)
SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN m IN (2, 3) THEN -price WHEN m = 5 THEN 12.35 WHEN m = 6 THEN 1000.00
            WHEN m BETWEEN 7 AND 12 THEN NULL ELSE price END AS DECIMAL(12,2)) AS amount
FROM l"""

ORACLES["map_boolean"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 9 IN (0, 1, 6) THEN TRUE
                        WHEN o_orderkey % 9 IN (2, 3) THEN FALSE END AS flag
FROM orders"""

TX_CURRENCY = """CASE part WHEN 2 THEN 'USD' WHEN 0 THEN CASE WHEN m <> 6 THEN 'USD' END
    ELSE CASE WHEN m <> 6 THEN 'EUR' END END"""

ORACLES["default_currency"] = f"""{TX}
SELECT client AS client_id, {TX_CURRENCY} AS currency, count(*) AS n FROM clean GROUP BY 1, 2"""

ORACLES["default_currency_overrides"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'USD' AS currency FROM orders"""

# --- clean and quarantined rows ---------------------------------------------

ORACLES["quarantine_rows"] = f"{QUARANTINE} SELECT client_id, entity, id, reason FROM quarantined"

KEY = "CAST(k AS VARCHAR)"
CUSTOMER_ID = "CAST(ck AS VARCHAR)"
ANY_TS = "CASE WHEN m <> 7 THEN ts END"
SIGNUP = "CASE WHEN m <> 7 THEN day END"
A_FLAG = "CASE st WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END"
RAW_AMOUNT = "CASE m WHEN 5 THEN '$1,234.50' ELSE CAST(amt AS VARCHAR) END"
TAX = "CAST((k % 1000) / 100.0 AS DECIMAL(12,2))"
EMAIL = "CASE WHEN m <> 8 THEN 'u' || k || '@x.test' END"
B_FIRST = """CASE m WHEN 3 THEN 'Zita' WHEN 4 THEN 'Kit|Marlow' WHEN 5 THEN NULL WHEN 6 THEN 'Olga'
    ELSE 'First' || k END"""
B_LAST = "CASE WHEN m = 6 THEN 'van Dyk' WHEN m NOT IN (3, 4, 5) THEN 'Last' || k END"
LOYALTY = "CASE WHEN m <> 10 THEN c_nationkey END"
AGE = "CAST(CASE WHEN k % 10 <> 0 THEN 20 + k % 50 END AS INTEGER)"
EVEN_FLAG = "CASE WHEN m <> 9 THEN k % 2 = 0 END"

REJECTED_IDS = f"CASE WHEN m <> 12 THEN {KEY} END"
REJECTED_CK = f"CASE WHEN m IN (1, 3) THEN {CUSTOMER_ID} WHEN m = 10 THEN others END"
REJECTED_AMOUNT = "CASE WHEN m IN (3, 4) THEN amt END"
# As delivered: the rejected shapes of a cell only.
REJECTED_CUST_CELL = f"CASE WHEN m IN (1, 3) THEN {CUSTOMER_ID} WHEN m = 8 THEN 'NULL' WHEN m = 10 THEN others END"
# A quoted cell inside the open quote ends it early: what follows moves up.
A_OPEN = """'"' || ck || ',' || price || ',USD,"' || pr || '"'"""

ORACLES["quarantine_raw_values"] = f"""{TX}
SELECT client AS client_id,
  CASE WHEN m <> 12 THEN {KEY} END AS source_transaction_id, {REJECTED_AMOUNT} AS amount,
  CASE WHEN part > 0 THEN NULL ELSE {tx_cell(RAW_AMOUNT_CELL, "iso")} END AS raw_amount
FROM tx WHERE m IN (1, 2, 3, 4, 8, 10, 12) AND NOT (m = 12 AND part = 2)"""

ORACLES["quarantine_client_a_transactions"] = f"""{LINES}
SELECT {REJECTED_IDS} AS transaction_id, {REJECTED_CUST_CELL.replace("THEN others", f"THEN {A_OPEN}")} AS customer_id,
  {REJECTED_AMOUNT} AS amount, {tx_cell("'USD'")} AS currency, {tx_cell("pr", REFUND)} AS channel,
  {tx_cell("iso")} AS created_ts, CAST(NULL AS VARCHAR) AS discount_code, {tx_cell(A_FLAG)} AS is_refund,
  {CORRUPT_TX} AS _corrupt_record, {from_feed('client_a', 'transactions', 'transactions_2024_01.txt')},
  'client_a' AS client_id, {REJECTED_IDS} AS source_transaction_id,
  {REJECTED_CK.replace("THEN others", f"THEN {A_OPEN}")} AS source_customer_id, {tx_cell("ts")} AS transaction_ts,
  {REJECTED_TX} AS _quarantine_reason, {tx_cell(RAW_AMOUNT_CELL, "iso")} AS raw_amount,
  {tx_cell("'USD'", "'N/A'")} AS raw_currency, {tx_cell("pr", REFUND)} AS raw_channel,
  {tx_cell("'N/A'")} AS raw_discount_code, {tx_cell(REFUND)} AS raw_is_refund
FROM lines WHERE part = 0 AND m IN (1, 2, 3, 4, 8, 10, 12)"""

ORACLES["quarantine_client_b_transactions"] = f"""{LINES}
SELECT {REJECTED_IDS} AS txn_id, {REJECTED_CUST_CELL} AS cust_id, {tx_cell(RAW_AMOUNT_CELL)} AS total,
  {tx_cell("'EUR'")} AS currency, {tx_cell("iso")} AS txn_ts, {tx_cell("CAST(k % 7 AS VARCHAR)")} AS items,
  {tx_cell("pr")} AS notes, {CORRUPT_TX} AS _corrupt_record, {from_feed('client_b', 'transactions', 'txn_history.txt')},
  'client_b' AS client_id, {REJECTED_IDS} AS source_transaction_id, {REJECTED_CK} AS source_customer_id,
  {tx_cell("ts")} AS transaction_ts, CAST({tx_cell("k % 7")} AS INTEGER) AS quantity, {REJECTED_AMOUNT} AS amount,
  {REJECTED_TX} AS _quarantine_reason, {tx_cell("'EUR'")} AS raw_currency, {tx_cell("pr")} AS raw_notes
FROM lines WHERE part = 1 AND m IN (1, 2, 3, 4, 8, 10, 12)"""

ORACLES["quarantine_client_c_transactions"] = f"""{LINES}
SELECT {KEY} AS id, {REJECTED_CUST_CELL} AS user_id, {tx_cell("price")} AS price_usd, {tx_cell(TAX)} AS tax,
  {tx_cell(RAW_AMOUNT_CELL)} AS final_amount, {tx_cell("pr")} AS payment_type, {CORRUPT_TX} AS _corrupt_record,
  {from_feed('client_c', 'transactions', 'transactions.txt')}, 'client_c' AS client_id,
  {KEY} AS source_transaction_id, {REJECTED_CK} AS source_customer_id, {REJECTED_AMOUNT} AS amount, 'USD' AS currency,
  {REJECTED_TX} AS _quarantine_reason, {tx_cell("CAST(price AS VARCHAR)")} AS raw_price_usd,
  {tx_cell(TAX_TEXT)} AS raw_tax, {tx_cell("pr")} AS raw_payment_type
FROM lines WHERE part = 2 AND m IN (1, 2, 3, 4, 8, 10)"""


def rejected_customer(names: str, cells: dict[str, str], part: int, feed: str, file: str, id_cell: str) -> str:
    """Rejected customers: one without an id, with all else, or one of which only the id is there."""
    own = ", ".join(f"CASE WHEN m = 1 THEN {value} END AS {name}" for name, value in cells.items())
    return f"""{names}
SELECT CASE WHEN m = 2 THEN {KEY} END AS {id_cell}, CASE WHEN m = 2 THEN {KEY} END AS source_customer_id,
  CASE WHEN m = 2 THEN {KEY} END AS _corrupt_record, {own},
  {from_feed(feed, 'customers', file)}, '{feed}' AS client_id, {REJECTED_CUST} AS _quarantine_reason
FROM cust WHERE part = {part} AND m IN (1, 2)"""


A_NAMES = {
    "first_name": "'Customer'",
    "last_name": "substr(c_name, 10)",
    "email": "'u' || k || '@x.test'",
    "status": "c_mktsegment",
}
ORACLES["quarantine_client_a_customers"] = rejected_customer(
    CUST,
    {
        **A_NAMES,
        **{f"raw_{name}": value for name, value in A_NAMES.items()},
        "phone": "CAST(NULL AS VARCHAR)",
        "raw_phone": "CAST(NULL AS VARCHAR)",
        "signup_ts": "strftime(day, '%Y-%m-%d') || 'T00:00:00'",
        "signup_date": "day",
        "loyalty_points": "c_nationkey",
        "raw_loyalty_points": "CAST(c_nationkey AS VARCHAR)",
    },
    0, "client_a", "customers_2024_01.txt", "customer_id",
)
ORACLES["quarantine_client_b_customers"] = rejected_customer(
    CUST,
    {
        "full_name": "'First' || k || ' Last' || k",
        "contact_email": "'u' || k || '@x.test'",
        "email": "'u' || k || '@x.test'",
        "country": "'C' || c_nationkey",
        "raw_country": "'C' || c_nationkey",
        "address": "k || ' Main | Street'",
        "raw_address": "k || ' Main | Street'",
        "zip": "CAST(k % 1000 AS VARCHAR)",
        "postal_code": "CAST(k % 1000 AS VARCHAR)",
        "created_date": "strftime(day, '%Y-%m-%d')",
        "signup_date": "day",
        "vip_flag": "CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END",
        "is_vip": "k % 2 = 0",
        "first_name": "'First' || k",
        "last_name": "'Last' || k",
    },
    1, "client_b", "customer_dump.txt", "cust_id",
)
ORACLES["quarantine_client_c_customers"] = rejected_customer(
    CUST,
    {
        "fname": "'F' || k",
        "first_name": "'F' || k",
        "lname": "'L' || k",
        "last_name": "'L' || k",
        "signup_date": "day",
        "raw_signup_date": "strftime(day, '%Y-%m-%d')",
        "age": AGE,
        "raw_age": C_AGE,
        "marketing_opt_in": "k % 2 = 0",
        "raw_marketing_opt_in": "CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END",
    },
    2, "client_c", "customers.txt", "id",
)

ORACLES["silver_client_a_customers"] = f"""{CUST}
SELECT {KEY} AS customer_id, 'Customer' AS first_name, substr(c_name, 10) AS last_name, {EMAIL} AS email,
  CAST(NULL AS VARCHAR) AS phone,
  CASE m WHEN 7 THEN '2024-02-30' ELSE strftime(day, '%Y-%m-%d') END || 'T00:00:00' AS signup_ts,
  c_mktsegment AS status, {LOYALTY} AS loyalty_points,
  {from_feed('client_a', 'customers', 'customers_2024_01.txt')},
  'client_a' AS client_id, {KEY} AS source_customer_id, {SIGNUP} AS signup_date
FROM cust WHERE part = 0 AND m NOT IN (1, 2)"""

ORACLES["silver_client_a_transactions"] = f"""{TX}
SELECT {RAW_TX_ID} AS transaction_id, {RAW_TX_CUST} AS customer_id, amount,
  {TX_CURRENCY} AS currency, pr AS channel, CASE m WHEN 7 THEN 'SOMEDAY' ELSE iso END AS created_ts,
  CAST(NULL AS VARCHAR) AS discount_code, {A_FLAG} AS is_refund,
  {from_feed('client_a', 'transactions', 'transactions_2024_01.txt')},
  'client_a' AS client_id, {KEY} AS source_transaction_id, {CUSTOMER_ID} AS source_customer_id,
  {ANY_TS} AS transaction_ts
FROM clean WHERE part = 0"""

ORACLES["silver_client_b_customers"] = f"""{CUST}
SELECT {KEY} AS cust_id, {B_NAME} AS full_name, CASE m WHEN 8 THEN 'None' ELSE 'u' || k || '@x.test' END AS contact_email,
  'C' || c_nationkey AS country, {B_ADDRESS} AS address, CAST(k % 1000 AS VARCHAR) AS zip,
  {DAY_TEXT} AS created_date, CASE WHEN m = 9 THEN 'maybe' WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END AS vip_flag,
  {from_feed('client_b', 'customers', 'customer_dump.txt')},
  'client_b' AS client_id, {KEY} AS source_customer_id, {EMAIL} AS email, CAST(k % 1000 AS VARCHAR) AS postal_code,
  {B_FIRST} AS first_name, {B_LAST} AS last_name, {SIGNUP} AS signup_date, {EVEN_FLAG} AS is_vip
FROM cust WHERE part = 1 AND m NOT IN (1, 2)"""

ORACLES["silver_client_b_transactions"] = f"""{TX}
SELECT {RAW_TX_ID} AS txn_id, {RAW_TX_CUST} AS cust_id, {RAW_AMOUNT} AS total, {TX_CURRENCY} AS currency,
  CASE m WHEN 7 THEN 'SOMEDAY' ELSE iso END AS txn_ts, CAST(k % 7 AS VARCHAR) AS items, pr AS notes,
  {from_feed('client_b', 'transactions', 'txn_history.txt')},
  'client_b' AS client_id, {KEY} AS source_transaction_id, {CUSTOMER_ID} AS source_customer_id,
  {ANY_TS} AS transaction_ts, CAST(k % 7 AS INTEGER) AS quantity, amount
FROM clean WHERE part = 1"""

ORACLES["silver_client_c_customers"] = f"""{CUST}
SELECT {KEY} AS id, 'F' || k AS fname, 'L' || k AS lname, {SIGNUP} AS signup_date, {AGE} AS age,
  {EVEN_FLAG} AS marketing_opt_in, {from_feed('client_c', 'customers', 'customers.txt')},
  'client_c' AS client_id, {KEY} AS source_customer_id, 'F' || k AS first_name, 'L' || k AS last_name
FROM cust WHERE part = 2 AND m NOT IN (1, 2)"""

ORACLES["silver_client_c_transactions"] = f"""{TX}
SELECT {RAW_TX_ID} AS id, {RAW_TX_CUST} AS user_id, price AS price_usd, {TAX} AS tax,
  {RAW_AMOUNT} AS final_amount, pr AS payment_type, {from_feed('client_c', 'transactions', 'transactions.txt')},
  'client_c' AS client_id, {KEY} AS source_transaction_id, {CUSTOMER_ID} AS source_customer_id,
  amount, 'USD' AS currency
FROM clean WHERE part = 2"""

ORACLES["chained_steps"] = """
SELECT CAST(o_orderkey AS INTEGER) AS id,
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS "Total",
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS total_text,
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS amount,
  CASE WHEN o_orderkey % 3 = 0 THEN 'missing_required_field:amount' END AS reason
FROM orders"""

ORACLES["split_conservation"] = f"""{ALL}
SELECT client AS client_id, 'transactions' AS entity, count(*) AS bronze_n,
  count(*) FILTER (WHERE m NOT IN (1, 2, 3, 4, 8, 10, 12)) AS clean_n,
  count(*) FILTER (WHERE m IN (1, 2, 3, 4, 8, 10, 12)) AS quarantine_n
FROM tx WHERE NOT (m = 12 AND part = 2) GROUP BY client
UNION ALL
SELECT client, 'customers', count(*), count(*) FILTER (WHERE m NOT IN (1, 2)), count(*) FILTER (WHERE m IN (1, 2))
FROM cust GROUP BY client"""

ORACLES["silver_as_tables"] = f"""{ALL}
SELECT client AS client_id, 'transactions' AS entity, m NOT IN (1, 2, 3, 4, 8, 10, 12) AS is_clean, count(*) AS n
FROM tx WHERE NOT (m = 12 AND part = 2) GROUP BY ALL
UNION ALL
SELECT client, 'customers', m NOT IN (1, 2), count(*) FROM cust GROUP BY ALL"""

ORACLES["refine_times"] = f"""{ALL}
SELECT DISTINCT client AS client_id, unnest(['customers', 'transactions']) AS entity,
  TRUE AS one_time, TRUE AS all_set, TRUE AS after_landing
FROM cust"""

# --- curated tables ---------------------------------------------------------

ORACLES["conform_schema"] = """
SELECT 'client_x' AS client_id, CAST(p_partkey AS VARCHAR) AS source_transaction_id,
  CAST(NULL AS VARCHAR) AS source_customer_id, CAST(NULL AS VARCHAR) AS transaction_ts,
  CAST(p_retailprice AS DECIMAL(12,2)) AS amount, CAST(NULL AS VARCHAR) AS currency,
  CAST(NULL AS VARCHAR) AS channel, CAST(NULL AS VARCHAR) AS payment_type, CAST(p_size AS INTEGER) AS quantity,
  CAST(NULL AS VARCHAR) AS discount_code, CAST(NULL AS BOOLEAN) AS is_refund, CAST(NULL AS DECIMAL(12,2)) AS tax,
  CAST(NULL AS VARCHAR) AS notes, CAST(NULL AS VARCHAR) AS _source_file
FROM part"""

ORACLES["union_clients"] = f"""{ALL}
SELECT client AS client_id, 'transactions' AS entity, count(*) AS n FROM clean GROUP BY client
UNION ALL SELECT client, 'customers', count(*) FROM cust WHERE m NOT IN (1, 2) GROUP BY client"""

ORACLES["surrogate_keys"] = """
SELECT o_orderkey, 'client_' || (o_custkey % 3) || CASE WHEN o_orderkey % 5 <> 0 THEN '_' || o_custkey ELSE '' END
  AS customer_key
FROM orders"""

ORACLES["dedupe_latest"] = """
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events)
WHERE rn = 1"""

ORACLES["dedupe_ties"] = """
SELECT l_orderkey, ship_day, quantity, l_linenumber, l_returnflag
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY ship_day DESC NULLS LAST, quantity DESC, l_linenumber DESC, l_returnflag DESC) AS rn
      FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN CAST(l_shipdate AS DATE) END AS ship_day,
                   CAST(trunc(l_quantity) AS INTEGER) AS quantity, l_linenumber, l_returnflag FROM lineitem))
WHERE rn = 1"""

GOLD = (
    ALL
    + f""", gold_customers AS (
  SELECT client || '_' || k AS customer_key, client AS client_id, {KEY} AS source_customer_id,
    CASE part WHEN 0 THEN 'Customer' WHEN 1 THEN {B_FIRST} ELSE 'F' || k END AS first_name,
    CASE part WHEN 0 THEN substr(c_name, 10) WHEN 1 THEN {B_LAST} ELSE 'L' || k END AS last_name,
    CASE WHEN part < 2 THEN {EMAIL} END AS email, CAST(NULL AS VARCHAR) AS phone,
    CASE WHEN part = 1 THEN 'C' || c_nationkey END AS country,
    CASE WHEN part = 1 THEN {B_ADDRESS} END AS address,
    CASE WHEN part = 1 THEN CAST(k % 1000 AS VARCHAR) END AS postal_code,
    {SIGNUP} AS signup_date, CASE WHEN part = 0 THEN c_mktsegment END AS status,
    CASE WHEN part = 2 THEN {AGE} END AS age, CASE WHEN part = 0 THEN {LOYALTY} END AS loyalty_points,
    CASE WHEN part = 1 THEN {EVEN_FLAG} END AS is_vip, CASE WHEN part = 2 THEN {EVEN_FLAG} END AS marketing_opt_in,
    CASE part WHEN 0 THEN 'customers_2024_01.txt' WHEN 1 THEN 'customer_dump.txt' ELSE 'customers.txt' END AS _source_file
  FROM cust WHERE m NOT IN (1, 2)),
gold_transactions AS (
  SELECT client || '_' || k AS transaction_key, client || '_' || ck AS customer_key, client AS client_id,
    {KEY} AS source_transaction_id, {CUSTOMER_ID} AS source_customer_id,
    CASE WHEN part < 2 THEN {ANY_TS} END AS transaction_ts, amount, {TX_CURRENCY} AS currency,
    CASE WHEN part = 0 THEN pr END AS channel, CASE WHEN part = 2 THEN pr END AS payment_type,
    CASE WHEN part = 1 THEN CAST(k % 7 AS INTEGER) END AS quantity, CAST(NULL AS VARCHAR) AS discount_code,
    CASE WHEN part = 0 THEN {A_FLAG} END AS is_refund, CASE WHEN part = 2 THEN {TAX} END AS tax,
    CASE WHEN part = 1 THEN pr END AS notes,
    CASE part WHEN 0 THEN 'transactions_2024_01.txt' WHEN 1 THEN 'txn_history.txt' ELSE 'transactions.txt' END
      AS _source_file
  FROM clean WHERE NOT (m = 9 AND amt = price))
"""
)

ORACLES["gold_customers"] = ORACLES["gold_customers_table"] = f"{GOLD} SELECT * FROM gold_customers"
ORACLES["gold_transactions"] = ORACLES["gold_transactions_table"] = f"{GOLD} SELECT * FROM gold_transactions"
ORACLES["gold_counts"] = f"""{GOLD}
SELECT 'customers' AS entity, count(*) AS n FROM gold_customers
UNION ALL SELECT 'transactions', count(*) FROM gold_transactions"""

ORACLES["whole_run"] = f"""SELECT entity, n, n AS reported FROM ({ORACLES["gold_counts"]})"""


def filled(rows: str, entity: str, columns: list[str], where: str = "") -> str:
    """How many rows of each client have a value, column by column."""
    return "\nUNION ALL ".join(
        f"SELECT client_id, '{entity}' AS entity, '{c}' AS \"column\", count({c}) AS n FROM {rows} {where} GROUP BY client_id"
        for c in columns
    )


CUSTOMER_COLUMNS = """client_id source_customer_id first_name last_name email phone country address postal_code
    signup_date status age loyalty_points is_vip marketing_opt_in _source_file""".split()
TRANSACTION_COLUMNS = """client_id source_transaction_id source_customer_id transaction_ts amount currency channel
    payment_type quantity discount_code is_refund tax notes _source_file""".split()
# Before duplicates are removed: both copies of a re-delivered line.
ORACLES["known_columns"] = f"""{GOLD.replace("WHERE NOT (m = 9 AND amt = price)", "")}
{filled("gold_customers", "customers", CUSTOMER_COLUMNS)}
UNION ALL {filled("gold_transactions", "transactions", TRANSACTION_COLUMNS)}"""

ORACLES["stage_row_counts"] = f"""{GOLD}, feeds AS (
  SELECT client AS client_id, 'transactions' AS entity, m IN (1, 2, 3, 4, 8, 10, 12) AS bad
  FROM tx WHERE NOT (m = 12 AND part = 2)
  UNION ALL SELECT client, 'customers', m IN (1, 2) FROM cust)
SELECT 'bronze' AS stage, client_id, entity, count(*) AS n FROM feeds GROUP BY ALL
UNION ALL SELECT 'clean', client_id, entity, count(*) FROM feeds WHERE NOT bad GROUP BY ALL
UNION ALL SELECT 'quarantine', client_id, entity, count(*) FROM feeds WHERE bad GROUP BY ALL
UNION ALL SELECT 'gold', NULL, 'customers', count(*) FROM gold_customers
UNION ALL SELECT 'gold', NULL, 'transactions', count(*) FROM gold_transactions"""

# --- reports ----------------------------------------------------------------

ORACLES["quarantine_summary"] = f"""{QUARANTINE}
SELECT client_id, entity, reason, count(*) AS n FROM quarantined GROUP BY 1, 2, 3"""
ORACLES["quarantine_reason_counts"] = f"""{QUARANTINE}
SELECT client_id, entity, reason, count(*) AS n FROM quarantined GROUP BY ALL"""
ORACLES["quarantine_top_reasons"] = f"""{QUARANTINE}
SELECT client_id, entity, reason, count(*) AS n FROM quarantined GROUP BY 1, 2, 3
ORDER BY n DESC, client_id, entity, reason LIMIT 5"""
ORACLES["transactions_with_customers"] = f"""{GOLD}
SELECT t.transaction_key, t.customer_key, t.amount, c.first_name, c.email, c.signup_date
FROM gold_transactions t LEFT JOIN gold_customers c ON t.customer_key = c.customer_key"""
ORACLES["orphan_transactions"] = f"""{GOLD}
SELECT client_id, count(*) AS n FROM gold_transactions t
WHERE NOT EXISTS (SELECT 1 FROM gold_customers c WHERE c.customer_key = t.customer_key) GROUP BY client_id"""
ORACLES["footer_counts"] = f"""{GOLD}, feeds AS (
  SELECT client AS client_id, 'transactions' AS entity, m IN (1, 2, 3, 4, 8, 10, 12) AS bad
  FROM tx WHERE NOT (m = 12 AND part = 2)
  UNION ALL SELECT client, 'customers', m IN (1, 2) FROM cust)
SELECT client_id, entity, count(*) FILTER (NOT bad) AS clean_n, count(*) FILTER (bad) AS quarantine_n
FROM feeds GROUP BY ALL"""
ORACLES["customers_with_free_names"] = """
SELECT o_custkey AS customer_key, o_orderkey AS number, o_orderstatus AS segment, o_orderpriority AS "CUSTOMER_SEGMENT",
  c_name AS name, c_mktsegment AS customer_customer_segment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
ORACLES["dedupe_by_aggregate"] = """
SELECT l_linenumber, l_orderkey, ship_day, l_linestatus AS mode
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY ship_day DESC NULLS LAST, l_linestatus DESC, l_linenumber DESC) AS rn
      FROM (SELECT *, CASE WHEN l_orderkey % 3 > 0 THEN CAST(l_shipdate AS DATE) END AS ship_day FROM lineitem))
WHERE rn = 1"""
