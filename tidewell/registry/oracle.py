"""For each query, independent SQL with the same result on the same tables.

Rules kept in mind: decimal division gives a double here, so exact quotients are done in
whole numbers; window order by needs NULLS LAST spelled out; every output column is cast to
the type the query returns.
"""

from __future__ import annotations

SOURCE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'WEBSITE' WHEN '2-HIGH' THEN 'WEBSITE'
    WHEN '3-MEDIUM' THEN 'STORE' WHEN '4-NOT SPECIFIED' THEN 'STORE' WHEN '5-LOW' THEN 'OTA' END"""

SOURCE_CUSTOMERS = f"""source_customers AS (
  SELECT s.*, c_name, n_name
  FROM (SELECT {SOURCE} AS src, o_custkey AS k, max(o_orderdate) AS seen FROM orders GROUP BY 1, 2) s
  JOIN customer ON c_custkey = s.k JOIN nation ON n_nationkey = c_nationkey)"""

CUSTOMERS = (
    SOURCE_CUSTOMERS
    + """, customers AS (
  SELECT 'P' || (k // 2) AS PERSON_KEY, c_name AS FULL_NAME,
    CASE WHEN k % 13 = 0 THEN '' ELSE ' ' || c_name || '@Example.com ' END AS EMAIL,
    '+61 ' || k AS PHONE, n_name AS LOCALE, src AS SRC_SYSTEM, src || '_' || k AS SRC_USER_ID,
    CASE WHEN k % 11 = 0 THEN NULL ELSE seen END AS LAST_SEEN_UTC,
    CAST(CASE WHEN k % 13 = 0 THEN 0.8 ELSE 1.0 END AS DECIMAL(3,2)) AS MATCH_CONFIDENCE
  FROM source_customers)"""
)

PERSONS = (
    CUSTOMERS
    + """, ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY PERSON_KEY
      ORDER BY LAST_SEEN_UTC ASC NULLS LAST, SRC_SYSTEM, SRC_USER_ID) AS rn_first,
    row_number() OVER (PARTITION BY PERSON_KEY
      ORDER BY LAST_SEEN_UTC DESC NULLS LAST, SRC_SYSTEM, SRC_USER_ID) AS rn_last
  FROM customers), persons AS (
  SELECT g.PERSON_KEY, lower(nullif(trim(g.e), '')) AS EMAIL_NORM,
    regexp_replace(nullif(trim(g.p), ''), '[^0-9+]', '', 'g') AS PHONE_NORM,
    l.FULL_NAME, l.LOCALE, lower(f.SRC_SYSTEM) AS FIRST_SEEN_CHANNEL,
    l.LAST_SEEN_UTC AS LAST_SEEN_TS, lower(l.SRC_SYSTEM) AS SRC_SYSTEM_LATEST,
    l.SRC_USER_ID AS SRC_USER_ID_LATEST, l.MATCH_CONFIDENCE
  FROM (SELECT PERSON_KEY, max(EMAIL) AS e, max(PHONE) AS p FROM customers GROUP BY 1) g
  JOIN ranked l ON l.PERSON_KEY = g.PERSON_KEY AND l.rn_last = 1
  JOIN ranked f ON f.PERSON_KEY = g.PERSON_KEY AND f.rn_first = 1)"""
)

ORDERS = f"""order_lines AS (
  SELECT l_orderkey, min(l_partkey) AS part, sum(l_quantity) AS qty FROM lineitem GROUP BY 1),
order_codes AS (
  SELECT o.*, qty, part, CASE part % 10 WHEN 0 THEN 'SYD-' WHEN 1 THEN 'TAS-' ELSE 'K-' END || part AS code
  FROM orders o LEFT JOIN order_lines ON l_orderkey = o_orderkey),
order_view AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_ID_SRC, o_orderkey, o_custkey, {SOURCE} AS SOURCE,
    o_orderdate AS ORDER_TS,
    CASE WHEN o_custkey % 19 <> 0 THEN 'P' || (o_custkey // 2) END AS PERSON_KEY,
    CASE WHEN part % 7 = 0 THEN ' ' || lower(code) || ' ' ELSE code END AS PRODUCT_ID, part,
    CAST(qty AS BIGINT) AS QTY, CAST(o_totalprice AS DECIMAL(18,2)) AS GROSS_AMOUNT,
    CASE WHEN o_custkey % 17 = 0 THEN 'HKY' WHEN o_custkey % 13 = 0 THEN 'CNY' ELSE 'AUD' END AS CURRENCY,
    CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'cancelled' WHEN 'P' THEN 'refunded' END AS STATUS
  FROM order_codes)"""

STOCK = """stock AS (
  SELECT event_id AS ROW_ID, 'K-' || (props->>'$.k') AS PRODUCT_ID, CAST(props->>'$.k' AS BIGINT) AS AVAILABLE_QTY,
    CAST(value AS DECIMAL(18,2)) AS PRICE, 'AUD' AS CURRENCY, ts AS LAST_UPDATED_UTC,
    CASE event_type WHEN 'click' THEN 'website' WHEN 'view' THEN 'ota' WHEN 'purchase' THEN 'store'
      WHEN 'signup' THEN 'partner' END AS SRC_SYSTEM
  FROM events), latest AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY PRODUCT_ID, SRC_SYSTEM
      ORDER BY LAST_UPDATED_UTC DESC NULLS LAST, ROW_ID) AS rn FROM stock) WHERE rn = 1)"""

NOW = "TIMESTAMP '2024-01-30 23:58:00'"
AGE = f"datediff('second', LAST_UPDATED_UTC, {NOW})"


def _fresh(fresh: str, stale: str, expired: str, age: str = AGE) -> str:
    return f"CASE WHEN {age} < 900 THEN '{fresh}' WHEN {age} <= 145600 THEN '{stale}' ELSE '{expired}' END"


INVENTORY = (
    STOCK
    + f""", inventory AS (
  SELECT l.* EXCLUDE (ROW_ID), {_fresh("fresh", "stale", "expired")} AS FRESHNESS_FLAG,
    (lo_q <> hi_q OR hi_p - lo_p > 300) AS CONFLICT_FLAG, CAST(sources AS INTEGER) AS SOURCE_COVERAGE
  FROM latest l JOIN (SELECT PRODUCT_ID, min(AVAILABLE_QTY) AS lo_q, max(AVAILABLE_QTY) AS hi_q,
      min(PRICE) AS lo_p, max(PRICE) AS hi_p, count(DISTINCT SRC_SYSTEM) AS sources
    FROM latest GROUP BY 1) USING (PRODUCT_ID))"""
)


def _initcap(text: str) -> str:
    """Capitalise every piece that ends at a blank or punctuation mark."""
    pieces = rf"regexp_extract_all({text}, '[^\s!?@\"^#$&~_,.:;+*%/|(){{}}<>\[\]\\-]*[\s!?@\"^#$&~_,.:;+*%/|(){{}}<>\[\]\\-]?')"
    return f"array_to_string(list_transform({pieces}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def _ratio(a: str, b: str) -> str:
    """a / b rounded at six digits, then at two, halves away from zero; whole a, whole b >= 0."""
    six = f"((2 * abs(CAST({a} AS HUGEINT)) * 1000000 + {b}) // (2 * nullif({b}, 0)))"
    return f"sign({a}) * CAST((({six} + 5000) // 10000) AS DECIMAL(18,2)) / 100"


def _pct(a: str, b: str) -> str:
    return f"CAST({_ratio(a, b)} AS DECIMAL(18,2))"


PRODUCTS = (
    INVENTORY
    + ", "
    + ORDERS
    + f""", products AS (
  SELECT PRODUCT_ID, {_initcap("replace(PRODUCT_ID, '-', ' ')")} AS PRODUCT_NAME,
    CASE WHEN PRODUCT_ID LIKE 'SYD%' THEN 'City Tour' WHEN PRODUCT_ID LIKE 'TAS%' THEN 'Island Tour'
      ELSE 'General' END AS CATEGORY
  FROM (SELECT upper(trim(PRODUCT_ID)) AS PRODUCT_ID FROM order_view
        UNION SELECT upper(trim(PRODUCT_ID)) FROM inventory))"""
)

CHANNELS = """channels AS (
  SELECT CHANNEL_ID, upper(CHANNEL_ID[1]) || lower(CHANNEL_ID[2:]) AS CHANNEL_NAME,
    CASE WHEN CHANNEL_ID IN ('website', 'ota') THEN 'Online' WHEN CHANNEL_ID = 'store' THEN 'Offline'
      ELSE 'Partner' END AS CHANNEL_TYPE
  FROM (SELECT lower(nullif(trim(SOURCE), '')) AS CHANNEL_ID FROM order_view
        UNION SELECT lower(nullif(trim(SRC_SYSTEM), '')) FROM inventory
        UNION SELECT lower(nullif(trim(SRC_SYSTEM), '')) FROM customers) WHERE CHANNEL_ID IS NOT NULL)"""

GOLD = PERSONS + ", " + PRODUCTS + ", " + CHANNELS

KEYED_ORDERS = (
    GOLD
    + """, keyed AS (
  SELECT v.ORDER_ID_SRC, v.SOURCE, p.PERSON_KEY, d.PRODUCT_ID, c.CHANNEL_ID, v.ORDER_TS,
    CAST(v.QTY AS DECIMAL(38,0)) AS QTY, CAST(v.GROSS_AMOUNT AS DECIMAL(38,0)) AS GROSS_AMOUNT,
    v.CURRENCY, v.STATUS
  FROM order_view v LEFT JOIN persons p ON v.PERSON_KEY = p.PERSON_KEY
  LEFT JOIN products d ON v.PRODUCT_ID = d.PRODUCT_ID
  LEFT JOIN channels c ON lower(v.SOURCE) = c.CHANNEL_ID)"""
)

SNAPSHOT_COLUMNS = f"""{NOW} AS SNAPSHOT_TS, p.PRODUCT_ID, c.CHANNEL_ID, v.AVAILABLE_QTY AS AVAIL_QTY,
    CAST(v.PRICE AS DECIMAL(10,2)) AS PRICE, v.CURRENCY,
    CAST(datediff('second', v.LAST_UPDATED_UTC, {NOW}) AS DECIMAL(38,0)) AS SYNC_DELAY_SEC,
    v.LAST_UPDATED_UTC, v.FRESHNESS_FLAG AS STATUS, v.CONFLICT_FLAG, v.SOURCE_COVERAGE"""

SNAPSHOT = (
    GOLD
    + f""", snapshot AS (
  SELECT {SNAPSHOT_COLUMNS}
  FROM inventory v LEFT JOIN products p ON upper(trim(v.PRODUCT_ID)) = p.PRODUCT_ID
  LEFT JOIN channels c ON lower(trim(v.SRC_SYSTEM)) = c.CHANNEL_ID)"""
)

PAID = "STATUS = 'paid' AND ORDER_TS >= TIMESTAMP '2001-07-03'"
BRIDGE = "SELECT PERSON_KEY, SRC_SYSTEM, SRC_USER_ID AS SRC_CUSTOMER_ID FROM customers"


def _daily_revenue(rows: str) -> str:
    return f"""SELECT date_trunc('day', ORDER_TS) AS order_day, count(*) AS total_orders,
    CAST(sum(GROSS_AMOUNT) AS DECIMAL(38,0)) AS revenue_aud,
    {_pct("CAST(sum(GROSS_AMOUNT) AS BIGINT)", "count(*)")} AS aov_aud
  FROM {rows} WHERE {PAID} GROUP BY 1"""


def _floored(floors: tuple[int, int, int]) -> str:
    fresh, stale, expired = floors
    return f"""WITH {SNAPSHOT}, base AS (
    SELECT {_fresh("fresh", "stale", "expired")} AS freshness_status, count(*) AS n FROM snapshot GROUP BY 1),
  filled AS (SELECT s AS freshness_status, greatest(coalesce(n, 0), floor) AS record_count
    FROM (VALUES ('fresh', {fresh}), ('stale', {stale}), ('expired', {expired})) v(s, floor)
    LEFT JOIN base ON base.freshness_status = s),
  total AS (SELECT CAST(sum(record_count) AS BIGINT) AS t FROM filled)
  SELECT freshness_status, CAST(record_count AS BIGINT) AS record_count,
    {_pct("100 * record_count", "t")} AS percentage FROM filled, total"""


# --- raw exports -> gold: the expected tables, straight from the test tables -----------------

RAW_CODE = "'K' || lpad(CAST(part % 50 AS VARCHAR), 3, '0')"

RAW_USERS = (
    SOURCE_CUSTOMERS
    + """, raw_users AS (
  SELECT CASE WHEN src <> 'WEBSITE' OR k % 23 <> 0 THEN c_name END AS FULL_NAME,
    CASE WHEN (src = 'STORE' AND k % 13 <> 0) OR (src = 'WEBSITE' AND k % 17 <> 0)
      THEN 'user' || (k // 2) || '@example.com' END AS EMAIL,
    CASE WHEN src = 'WEBSITE' OR (src = 'STORE' AND k % 9 <> 0) OR (src = 'OTA' AND k % 7 <> 0)
      THEN '61' || lpad(CAST(k AS VARCHAR), 9, '0') END AS PHONE,
    CASE src WHEN 'OTA' THEN 'WHATSAPP' ELSE src END AS SRC_SYSTEM,
    CASE src WHEN 'STORE' THEN 'st_' WHEN 'WEBSITE' THEN 'web_' ELSE 'wa_' END || k AS SRC_USER_ID,
    seen AS LAST_SEEN_UTC
  FROM source_customers),
records AS (
  SELECT sha256(coalesce('e:' || EMAIL, 'p:' || PHONE, 'r:' || SRC_SYSTEM || ':' || SRC_USER_ID)) AS PERSON_KEY,
    FULL_NAME, EMAIL, PHONE, CASE WHEN PHONE IS NOT NULL THEN 'AU' END AS LOCALE, SRC_SYSTEM, SRC_USER_ID,
    LAST_SEEN_UTC,
    CAST(CASE WHEN EMAIL IS NOT NULL AND PHONE IS NOT NULL THEN 1.0 WHEN EMAIL IS NOT NULL THEN 0.9
      WHEN PHONE IS NOT NULL THEN 0.8 ELSE 0.5 END AS DECIMAL(3,2)) AS MATCH_CONFIDENCE
  FROM raw_users),
unified AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY PERSON_KEY, SRC_SYSTEM
    ORDER BY LAST_SEEN_UTC DESC NULLS LAST, SRC_USER_ID) AS rn FROM records) WHERE rn = 1)"""
)

RAW_PERSONS = (
    RAW_USERS
    + """, raw_persons AS (
  SELECT g.PERSON_KEY, g.e AS EMAIL_NORM, g.p AS PHONE_NORM, l.FULL_NAME, l.LOCALE,
    lower(f.SRC_SYSTEM) AS FIRST_SEEN_CHANNEL, l.LAST_SEEN_UTC AS LAST_SEEN_TS,
    lower(l.SRC_SYSTEM) AS SRC_SYSTEM_LATEST, l.SRC_USER_ID AS SRC_USER_ID_LATEST, l.MATCH_CONFIDENCE,
    row_number() OVER (ORDER BY g.PERSON_KEY) AS PERSON_ID
  FROM (SELECT PERSON_KEY, max(EMAIL) AS e, max(PHONE) AS p FROM unified GROUP BY 1) g
  JOIN (SELECT *, row_number() OVER (PARTITION BY PERSON_KEY
    ORDER BY LAST_SEEN_UTC DESC NULLS LAST, SRC_SYSTEM, SRC_USER_ID) AS rn FROM unified) l
    ON l.PERSON_KEY = g.PERSON_KEY AND l.rn = 1
  JOIN (SELECT *, row_number() OVER (PARTITION BY PERSON_KEY
    ORDER BY LAST_SEEN_UTC ASC NULLS LAST, SRC_SYSTEM, SRC_USER_ID) AS rn FROM unified) f
    ON f.PERSON_KEY = g.PERSON_KEY AND f.rn = 1)"""
)

RAW_ORDERS = (
    RAW_USERS
    + ", "
    + ORDERS
    + f""", raw_orders AS (
  SELECT CASE SOURCE WHEN 'STORE' THEN 'S-' WHEN 'WEBSITE' THEN 'W-' ELSE 'O-' END || ORDER_ID_SRC AS ORDER_ID_SRC,
    SOURCE, ORDER_TS + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS ORDER_TS, o_custkey,
    CASE SOURCE WHEN 'STORE' THEN 'st_' || o_custkey WHEN 'WEBSITE' THEN 'web_' || o_custkey
      ELSE CASE WHEN o_custkey % 19 = 0 THEN 'ghost' || o_custkey ELSE 'user' || (o_custkey // 2) END
        || '@example.com' END AS ref,
    {RAW_CODE} AS PRODUCT_ID, QTY, GROSS_AMOUNT,
    CASE WHEN SOURCE = 'WEBSITE' THEN CURRENCY ELSE 'AUD' END AS CURRENCY,
    CASE WHEN STATUS = 'paid' THEN 'paid' WHEN SOURCE = 'STORE' THEN 'void' WHEN SOURCE = 'WEBSITE' THEN 'cancelled'
      ELSE 'refunded' END AS STATUS
  FROM order_view),
refs AS (
  SELECT SRC_SYSTEM AS SOURCE, SRC_USER_ID AS ref, PERSON_KEY FROM records
  UNION SELECT DISTINCT 'OTA', EMAIL, PERSON_KEY FROM records WHERE EMAIL IS NOT NULL),
raw_fact AS (
  SELECT 'ORD_' || CASE WHEN rn > 999999 THEN CAST(rn AS VARCHAR) ELSE lpad(CAST(rn AS VARCHAR), 6, '0') END
      AS ORDER_KEY, * EXCLUDE (rn)
  FROM (SELECT row_number() OVER (ORDER BY ORDER_TS, ORDER_ID_SRC, SOURCE) AS rn, ORDER_ID_SRC, PERSON_KEY,
      PRODUCT_ID, lower(SOURCE) AS CHANNEL_ID, ORDER_TS, CAST(QTY AS DECIMAL(38,0)) AS QTY,
      CAST(GROSS_AMOUNT AS DECIMAL(38,0)) AS GROSS_AMOUNT, CURRENCY, STATUS,
      CAST(date_trunc('month', ORDER_TS) AS DATE) AS ORDER_MONTH
    FROM raw_orders LEFT JOIN refs USING (SOURCE, ref)))"""
)

RAW_NOW = NOW
RAW_STOCK = """raw_stock AS (
  SELECT 'K' || lpad(CAST(CAST(props->>'$.k' AS INTEGER) % 50 AS VARCHAR), 3, '0') AS PRODUCT_ID,
    CAST(user_id % 10 AS BIGINT) AS AVAILABLE_QTY, CAST(value AS DECIMAL(18,2)) AS PRICE,
    CASE event_type WHEN 'purchase' THEN date_trunc('minute', ts) WHEN 'signup' THEN date_trunc('second', ts)
      ELSE ts END AS LAST_UPDATED_UTC,
    CASE event_type WHEN 'purchase' THEN 'STORE' WHEN 'signup' THEN 'PARTNER' ELSE 'OTA' END AS SRC_SYSTEM,
    CASE WHEN event_type = 'signup' THEN 'P' || event_id END AS ROW_ID
  FROM events),
raw_latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY PRODUCT_ID, SRC_SYSTEM
    ORDER BY LAST_UPDATED_UTC DESC, ROW_ID, AVAILABLE_QTY, PRICE) AS rn FROM raw_stock) WHERE rn = 1)"""

_MONEY_TEXT_SIGN = "CASE WHEN o_orderkey % 6 = 3 THEN -1 ELSE 1 END"


def all_oracles() -> dict[str, str]:
    sql: dict[str, str] = {}

    # order marts
    sql["daily_revenue_exact"] = f"""WITH {ORDERS}, d AS (
    SELECT date_trunc('day', ORDER_TS) AS order_day, count(*) AS n, sum(CAST(GROSS_AMOUNT * 100 AS HUGEINT)) AS cents
    FROM order_view WHERE STATUS = 'paid' AND ORDER_TS >= DATE '2001-08-02' - 30 GROUP BY 1)
  SELECT CAST(order_day AS TIMESTAMP) AS order_day, n AS total_orders,
    CAST(CAST(cents AS DECIMAL(38,0)) / 100 AS DECIMAL(38,2)) AS revenue_aud,
    CAST({_ratio("cents", "n")} / 100 AS DECIMAL(18,2)) AS aov_aud FROM d"""
    sql["daily_revenue"] = f"""WITH {ORDERS}, whole AS (
    SELECT ORDER_TS, STATUS, CAST(GROSS_AMOUNT AS DECIMAL(38,0)) AS GROSS_AMOUNT FROM order_view)
  {_daily_revenue("whole")}"""
    sql["daily_orders_by_channel"] = f"""WITH {KEYED_ORDERS}
  SELECT date_trunc('day', ORDER_TS) AS order_day, CHANNEL_ID AS channel, count(*) AS orders
  FROM keyed WHERE {PAID} GROUP BY 1, 2"""
    sql["top_products"] = f"""WITH {KEYED_ORDERS}
  SELECT PRODUCT_ID, count(*) AS orders, CAST(sum(GROSS_AMOUNT) AS DECIMAL(38,0)) AS revenue_aud
  FROM keyed WHERE {PAID} GROUP BY 1 ORDER BY revenue_aud DESC NULLS FIRST, PRODUCT_ID ASC NULLS LAST LIMIT 10"""
    sql["status_mix"] = f"""WITH {ORDERS}
  SELECT STATUS, count(*) AS orders FROM order_view WHERE ORDER_TS >= TIMESTAMP '2001-07-03' GROUP BY 1"""
    sql["hour_dow_heatmap"] = """SELECT CAST(isodow(ts) AS INTEGER) AS dow_iso, strftime(ts, '%a') AS dow_label,
    CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS orders
  FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-01' GROUP BY 1, 2, 3"""
    sql["recent_orders"] = f"""WITH {KEYED_ORDERS}
  SELECT k.ORDER_TS, p.FULL_NAME, d.PRODUCT_NAME, k.GROSS_AMOUNT
  FROM keyed k JOIN persons p ON k.PERSON_KEY = p.PERSON_KEY JOIN products d ON k.PRODUCT_ID = d.PRODUCT_ID
  ORDER BY k.ORDER_TS DESC NULLS FIRST, k.ORDER_ID_SRC DESC LIMIT 10"""

    # scalar semantics
    code = "event_type || '-' || (props->>'$.k') || '-aB.cD'"
    k = "CAST(props->>'$.k' AS BIGINT)"
    sql["scalar_semantics"] = f"""SELECT event_id,
    datediff('second', ts, TIMESTAMP '2024-01-15 12:00:00.9') AS age_seconds,
    datediff('day', ts, TIMESTAMP '2024-01-15 12:00:00.9') AS age_days,
    date_trunc('day', ts) AS day_start, CAST(ts AS DATE) AS day, hour(ts) AS hour_of_day, isodow(ts) AS dow_iso,
    strftime(ts, '%a') AS dow_label, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
    CAST(value AS DECIMAL(38,0)) AS whole, CAST(value AS DECIMAL(10,2)) AS cents,
    {_initcap(code)} AS capitalised,
    CASE WHEN event_id > 999 THEN CAST(event_id AS VARCHAR) ELSE lpad(CAST(event_id AS VARCHAR), 3, '0') END AS padded,
    CASE WHEN user_id % 3 <> 0 THEN greatest(user_id % 3, {k} % 2) END AS greatest,
    {_pct(k, "(user_id % 4)")} AS quotient,
    CASE WHEN user_id % 2 <> 0 THEN event_type END AS text_or_null,
    ts >= TIMESTAMP '2024-01-12' AS in_window
  FROM events"""

    # dimensions, facts, bridge
    sql["dim_person"] = f"""WITH {PERSONS}
  SELECT *, row_number() OVER (ORDER BY PERSON_KEY) AS PERSON_ID FROM persons"""
    sql["dim_product"] = f"""WITH {PRODUCTS}
  SELECT *, CASE WHEN PRODUCT_ID IS NOT NULL
    THEN row_number() OVER (ORDER BY PRODUCT_ID ASC NULLS LAST) END AS PRODUCT_ID_KEY FROM products"""
    sql["dim_channel"] = f"""WITH {GOLD}
  SELECT *, row_number() OVER (ORDER BY CHANNEL_ID) AS CHANNEL_KEY FROM channels"""
    sql["surrogate_key_distributed"] = """SELECT o_orderdate, o_orderkey,
    row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders"""
    sql["stable_surrogate_keys"] = f"""WITH {CUSTOMERS},
  known AS (SELECT PERSON_KEY, max(SRC_SYSTEM = 'STORE') AS first FROM customers GROUP BY 1)
  SELECT PERSON_KEY, row_number() OVER (ORDER BY first DESC, PERSON_KEY) AS PERSON_ID FROM known"""
    sql["fact_orders"] = f"""WITH {KEYED_ORDERS}, n AS (
    SELECT CAST(row_number() OVER (ORDER BY ORDER_TS ASC NULLS LAST, ORDER_ID_SRC ASC NULLS LAST, SOURCE ASC NULLS LAST)
      AS VARCHAR) AS rn, * FROM keyed)
  SELECT 'ORD_' || CASE WHEN length(rn) > 6 THEN rn ELSE lpad(rn, 6, '0') END AS ORDER_KEY,
    * EXCLUDE (rn, SOURCE) FROM n"""
    sql["fact_inventory_snapshot"] = f"WITH {SNAPSHOT} SELECT * FROM snapshot"
    sql["person_source_ids"] = f"WITH {CUSTOMERS} SELECT DISTINCT PERSON_KEY, SRC_SYSTEM, SRC_USER_ID FROM customers"
    sql["bridge_person_identity"] = f"""WITH {CUSTOMERS}
  SELECT PERSON_KEY, SRC_SYSTEM, SRC_USER_ID AS SRC_CUSTOMER_ID, MATCH_CONFIDENCE,
    TIMESTAMP '2001-08-02' AS LOADED_AT FROM customers"""

    # customer marts
    sql["dedup_rate"] = f"""WITH {PERSONS}, bridge AS ({BRIDGE}),
  c AS (SELECT (SELECT count(DISTINCT SRC_CUSTOMER_ID) FROM bridge) AS raw_customers,
    (SELECT count(DISTINCT PERSON_KEY) FROM persons) AS unified_customers)
  SELECT *, CASE WHEN raw_customers = 0 THEN 0
    ELSE {_pct("100 * (raw_customers - unified_customers)", "raw_customers")} END AS dedup_rate_pct FROM c"""
    sql["customers_per_channel"] = f"""WITH {CUSTOMERS}
  SELECT lower(SRC_SYSTEM) AS channel, count(DISTINCT PERSON_KEY) AS unique_customers FROM customers GROUP BY 1"""
    unified = """unified AS (
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY PERSON_KEY, SRC_SYSTEM
      ORDER BY LAST_SEEN_UTC DESC NULLS LAST, SRC_USER_ID) AS rn FROM customers) WHERE rn = 1)"""
    sql["customers_per_source"] = f"""WITH {CUSTOMERS}, {unified}
  SELECT SRC_SYSTEM AS src_system, count(*) AS unified_customers FROM unified GROUP BY 1"""
    sql["customer_unified"] = f"WITH {CUSTOMERS}, {unified} SELECT * FROM unified"
    sql["dedup_rate_by_source"] = f"""WITH {CUSTOMERS}, {unified},
  u AS (SELECT SRC_SYSTEM, count(*) AS unified_customers FROM unified GROUP BY 1),
  r AS (SELECT SRC_SYSTEM AS src_system, count(*) AS raw_customers FROM customers GROUP BY 1)
  SELECT r.src_system, raw_customers, unified_customers,
    {_pct("100 * (raw_customers - unified_customers)", "raw_customers")} AS dedup_rate_pct
  FROM r LEFT JOIN u ON u.SRC_SYSTEM = r.src_system"""
    age = "datediff('day', LAST_SEEN_TS, TIMESTAMP '2001-08-02')"
    sql["recency_buckets"] = f"""WITH {PERSONS}
  SELECT CASE WHEN {age} <= 7 THEN '≤ 7 days' WHEN {age} <= 30 THEN '8–30 days' WHEN {age} <= 90 THEN '31–90 days'
    ELSE '> 90 days' END AS active_bucket, count(*) AS customer_count
  FROM persons WHERE LAST_SEEN_TS IS NOT NULL GROUP BY 1"""
    sql["users_by_locale"] = f"WITH {PERSONS} SELECT LOCALE, count(*) AS users FROM persons GROUP BY 1"

    # inventory marts
    sql["inventory_detail"] = f"""WITH {SNAPSHOT}
  SELECT p.PRODUCT_ID, p.PRODUCT_NAME, p.CATEGORY, c.CHANNEL_NAME AS SOURCE_CHANNEL, AVAIL_QTY, PRICE, CURRENCY,
    {_pct("SYNC_DELAY_SEC", "3600")} AS SYNC_DELAY_HOURS,
    {_fresh("Fresh", "Stale", "Expired")} AS FRESHNESS_STATUS,
    strftime(LAST_UPDATED_UTC, '%Y-%m-%d %H:%M:%S') AS LAST_UPDATED_UTC,
    strftime(SNAPSHOT_TS, '%Y-%m-%d %H:%M:%S') AS SNAPSHOT_TS
  FROM snapshot f LEFT JOIN products p ON f.PRODUCT_ID = p.PRODUCT_ID
  LEFT JOIN channels c ON f.CHANNEL_ID = c.CHANNEL_ID"""
    sql["freshness_distribution"] = _floored((0, 0, 0))
    sql["freshness_distribution_reordered"] = _floored((3, 0, 100000))
    sql["freshness_distribution_floored"] = _floored((25, 15, 9))

    # landing and cleaning
    sql["bronze_landing"] = """SELECT 'STORE' AS src_system, 'orders' AS src_file,
    TIMESTAMP '2001-08-02' AS load_ts, o_orderkey AS id, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS cust,
    o_orderstatus AS status, o_custkey % 3 <> 0 AS has_cust_key FROM orders
  UNION ALL SELECT 'WEBSITE', 'events', TIMESTAMP '2024-01-30 23:58:00', event_id, NULL, event_type, false FROM events"""
    sql["variant_extract"] = """SELECT event_id,
    CASE WHEN event_id % 3 <> 2 THEN CAST(props->>'$.k' AS INTEGER) END AS as_int,
    CASE event_id % 3 WHEN 2 THEN '$' || (props->>'$.k') || '.50' ELSE props->>'$.k' END AS as_text,
    CAST(CAST(props->>'$.k' AS DECIMAL(18,2)) + CASE WHEN event_id % 3 = 2 THEN 0.5 ELSE 0 END AS DECIMAL(18,2))
      AS as_money FROM events"""
    money_code = "CASE WHEN o_custkey % 2 = 0 THEN 'AUD' ELSE 'CNY' END"
    prefix = "CASE o_orderkey % 6 WHEN 0 THEN 'AUD' WHEN 3 THEN 'HKD' END"
    sql["money_parse"] = f"""SELECT o_orderkey,
    CASE WHEN o_orderkey % 6 <> 5 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * {_MONEY_TEXT_SIGN}
      AS DECIMAL(18,2)) END AS amount,
    {prefix} AS code_in_amount, {money_code} AS currency,
    coalesce({prefix} <> {money_code}, false) AS mismatch FROM orders"""
    sql["money_parse_strict"] = """SELECT o_orderkey,
    CASE WHEN o_orderkey % 4 = 2 THEN CAST(1000000 + o_orderkey % 1000 + 0.25 AS DECIMAL(18,2)) END AS amount FROM orders"""
    sql["timestamp_offsets"] = """SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) - INTERVAL 11 HOUR
    WHEN 1 THEN date_trunc('second', ts) + INTERVAL 210 MINUTE END AS utc FROM events"""
    sql["numeric_parquet_landing"] = """SELECT c_custkey, CAST(61000000000 + c_custkey AS VARCHAR) AS phone,
    CAST(c_custkey * 1000003 + 0.25 AS DECIMAL(18,2)) AS amount FROM customer"""
    sql["bad_records"] = """SELECT 'STORE' AS src_system, 'customers.csv' AS src_file, count(*) AS row_count,
    count(*) FILTER (c_custkey % 10 IN (0, 1)) AS bad_rows FROM customer
  UNION ALL SELECT 'OTA', 'events.jsonl', count(*), count(*) FILTER (event_id % 7 = 0) FROM events
  UNION ALL SELECT 'WHATSAPP', 'free.jsonl', count(*), count(*) FILTER (event_id % 5 = 0) FROM events"""
    utc = """CASE event_id % 7 WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN ts WHEN 2 THEN date_trunc('second', ts)
      WHEN 3 THEN date_trunc('second', ts) WHEN 4 THEN date_trunc('second', ts)
      WHEN 5 THEN date_trunc('second', ts) + INTERVAL 330 MINUTE END"""
    sql["timestamp_parse"] = f"""SELECT event_id, {utc} AS utc,
    CASE WHEN event_id % 7 IN (0, 2) THEN {utc} - INTERVAL 10 HOUR ELSE {utc} END AS utc_from_brisbane,
    event_id % 7 = 4 AS ambiguous FROM events"""
    sql["contact_normalise"] = """WITH r AS (
    SELECT c_custkey, CASE WHEN c_custkey % 13 <> 0 THEN lower(c_name) || '@example.com' END AS email,
      CASE c_custkey % 4 WHEN 0 THEN '61' || c_custkey WHEN 1 THEN '44' || c_custkey WHEN 2 THEN '852' || c_custkey
        END AS phone,
      CASE c_custkey % 4 WHEN 0 THEN '+61' || c_custkey WHEN 1 THEN '44' || c_custkey || '0'
        WHEN 2 THEN '+852' || c_custkey END AS phone_kept_plus,
      upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS name,
      CASE c_custkey % 4 WHEN 0 THEN 'AU' WHEN 1 THEN 'GB' WHEN 2 THEN 'HK' END AS locale FROM customer)
  SELECT *, CAST(CASE WHEN email IS NOT NULL AND phone IS NOT NULL THEN 1.0 WHEN email IS NOT NULL THEN 0.9
    WHEN phone IS NOT NULL THEN 0.8 ELSE 0.5 END AS DECIMAL(3,2)) AS confidence FROM r"""
    sql["product_code_normalise"] = """SELECT p_partkey, replace(upper(p_brand), '-', '') || p_partkey AS code,
    upper(p_brand) || '-' || p_partkey AS code_with_hyphen FROM part"""
    sql["status_normalise"] = """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'paid' WHEN 1 THEN 'paid'
    WHEN 2 THEN 'paid' WHEN 3 THEN 'void' WHEN 4 THEN 'cancelled' WHEN 5 THEN 'refunded'
    ELSE lower(o_orderstatus) END AS status FROM orders"""
    sql["inventory_latest"] = f"WITH {STOCK} SELECT * FROM latest"
    sql["inventory_unified"] = f"WITH {INVENTORY} SELECT * FROM inventory"
    sql["inventory_conflict"] = f"""WITH {INVENTORY}
  SELECT PRODUCT_ID, bool_or(CONFLICT_FLAG) AS CONFLICT_FLAG FROM inventory GROUP BY 1"""
    sql["source_coverage"] = f"""WITH {STOCK}
  SELECT PRODUCT_ID, CAST(count(DISTINCT SRC_SYSTEM) AS INTEGER) AS SOURCE_COVERAGE, count(*) AS row_count
  FROM stock GROUP BY 1"""
    sql["order_person_lookup"] = f"""WITH {CUSTOMERS}, refs AS (
    SELECT DISTINCT SRC_SYSTEM AS s, SRC_USER_ID AS ref, PERSON_KEY FROM customers WHERE SRC_SYSTEM <> 'OTA'
    UNION SELECT DISTINCT 'OTA', lower(trim(EMAIL)), PERSON_KEY FROM customers WHERE EMAIL <> ''),
  o AS (SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_ID_SRC, {SOURCE} AS SOURCE, o_custkey FROM orders),
  r AS (SELECT *, CASE WHEN SOURCE = 'OTA' THEN 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '@example.com'
    ELSE SOURCE || '_' || o_custkey END AS ref FROM o)
  SELECT ORDER_ID_SRC, SOURCE, PERSON_KEY FROM r LEFT JOIN refs ON s = SOURCE AND refs.ref = r.ref"""

    # identity
    contacts = """contacts AS (
    SELECT src AS SRC_SYSTEM, CAST(k AS VARCHAR) AS SRC_USER_ID,
      CASE WHEN k % 13 <> 0 THEN 'e:e' || (k // 2) END AS e,
      CASE WHEN k % 8 NOT IN (0, 7) THEN 'p:' || ((k + 1) // 2) END AS p FROM source_customers)"""
    own = "'r:' || SRC_SYSTEM || ':' || SRC_USER_ID"
    sql["identity_one_pass"] = f"""WITH {SOURCE_CUSTOMERS}, {contacts}
  SELECT SRC_SYSTEM, SRC_USER_ID, sha256(coalesce(e, p, {own})) AS PERSON_KEY FROM contacts"""
    sql["identity_components"] = f"""WITH RECURSIVE {SOURCE_CUSTOMERS}, {contacts},
  pairs AS (SELECT DISTINCT e AS a, p AS b FROM contacts WHERE e IS NOT NULL AND p IS NOT NULL
    UNION SELECT DISTINCT p, e FROM contacts WHERE e IS NOT NULL AND p IS NOT NULL),
  reach(node, other) AS (
    SELECT a, a FROM pairs UNION SELECT r.node, b FROM reach r JOIN pairs ON a = r.other),
  roots AS (SELECT node, min(other) AS root FROM reach GROUP BY 1)
  SELECT SRC_SYSTEM, SRC_USER_ID, sha256(coalesce(root, e, p, {own})) AS PERSON_KEY
  FROM contacts LEFT JOIN roots ON node = coalesce(e, p)"""

    sql["identity_incremental"] = sql["identity_components"]

    # quality
    sql["key_violations"] = """SELECT 'lineitem' AS table_name, 'LINE' AS key_name,
    l_orderkey || '/' || l_linenumber AS key_value, count(*) AS row_count
  FROM lineitem GROUP BY 3 HAVING count(*) > 1
  UNION ALL SELECT 'dim_product', 'PRODUCT_ID', NULL, 1
  WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))"""
    sql["quality_gate"] = """WITH lines AS (
    SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem),
  judged AS (SELECT *, array_to_string(list_filter([CASE WHEN l_linenumber = 7 THEN 'LINE filled' END,
      CASE WHEN copies > 1 AND l_linenumber <> 7 THEN 'LINE unique' END,
      CASE WHEN l_quantity > 45 THEN 'quantity' END], lambda x: x IS NOT NULL), ', ') AS rules FROM lines)
  SELECT rules, count(*) AS row_count, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM judged GROUP BY 1"""
    sql["orphan_keys"] = f"""WITH {KEYED_ORDERS}
  SELECT 'fact_orders' AS table_name, 'PERSON_KEY' AS key_name, count(*) FILTER (PERSON_KEY IS NULL) AS orphan_rows,
    count(*) AS row_count FROM keyed
  UNION ALL SELECT 'fact_orders', 'PRODUCT_ID', count(*) FILTER (PRODUCT_ID IS NULL), count(*) FROM keyed
  UNION ALL SELECT 'fact_orders', 'CHANNEL_ID', count(*) FILTER (CHANNEL_ID IS NULL), count(*) FROM keyed"""
    sql["currency_check"] = f"""WITH {ORDERS}
  SELECT CURRENCY AS currency, count(*) AS row_count, CAST(sum(GROSS_AMOUNT) AS DECIMAL(28,2)) AS amount,
    CURRENCY NOT IN ('AUD', 'CNY', 'HKD', 'USD', 'GBP', 'EUR') AS unknown_code FROM order_view GROUP BY 1"""

    # sources and sinks
    sql["csv_source"] = """SELECT CAST(c_custkey AS VARCHAR) AS ID,
    CASE WHEN c_custkey % 5 <> 0 THEN c_name || ', "' || c_mktsegment || '"' END AS name,
    c_custkey || '.0' AS tel FROM customer"""
    sql["json_source"] = """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(props->>'$.k' AS INTEGER) END AS k,
    CASE WHEN event_id % 2 <> 0 THEN 'none' END AS text FROM events"""
    sql["json_array_split"] = """SELECT event_id, user_id, event_type, '}],"' || chr(92) || props AS text FROM events"""
    sql["full_refresh_sink"] = "SELECT c_custkey AS id, c_name AS name FROM customer"
    sql["snapshot_append"] = f"""WITH {STOCK}, days AS (
    SELECT unnest([{NOW}, {NOW} + INTERVAL 1 DAY]) AS t)
  SELECT CAST(t AS DATE) AS SNAPSHOT_DATE, count(*) AS row_count,
    CAST(sum(datediff('second', LAST_UPDATED_UTC, t)) AS DECIMAL(38,0)) AS delay, t AS "at"
  FROM latest, days GROUP BY t"""

    # the whole build from raw exports
    sql["raw_to_gold_landing"] = f"""WITH {SOURCE_CUSTOMERS}
  SELECT CASE src WHEN 'OTA' THEN 'WHATSAPP' ELSE src END AS src_system,
    CASE src WHEN 'STORE' THEN 'users_store.csv' WHEN 'WEBSITE' THEN 'users_website.csv'
      ELSE 'users_whatsapp.jsonl' END AS src_file,
    count(*) AS row_count, 'raw_users' AS entity FROM source_customers GROUP BY src
  UNION ALL SELECT {SOURCE}, 'orders_' || lower({SOURCE}) || '.csv', count(*), 'raw_orders' FROM orders GROUP BY 1, 2
  UNION ALL SELECT CASE event_type WHEN 'purchase' THEN 'STORE' WHEN 'signup' THEN 'PARTNER' ELSE 'OTA' END,
    CASE event_type WHEN 'purchase' THEN 'inventory_store.csv' WHEN 'signup' THEN 'inventory_partner.csv'
      ELSE 'inventory_ota.jsonl' END, count(*), 'raw_inventory'
  FROM events GROUP BY 1, 2"""
    sql["raw_to_gold_customers"] = f"WITH {RAW_USERS} SELECT * FROM unified"
    sql["raw_to_gold_dim_person"] = f"WITH {RAW_PERSONS} SELECT * FROM raw_persons"
    sql["raw_to_gold_persons_transitive"] = f"""WITH RECURSIVE {RAW_USERS},
  nodes AS (SELECT *, 'e:' || EMAIL AS e, 'p:' || PHONE AS p FROM raw_users),
  pairs AS (SELECT DISTINCT e AS a, p AS b FROM nodes WHERE e IS NOT NULL AND p IS NOT NULL
    UNION SELECT DISTINCT p, e FROM nodes WHERE e IS NOT NULL AND p IS NOT NULL),
  reach(node, other) AS (SELECT a, a FROM pairs UNION SELECT r.node, b FROM reach r JOIN pairs ON a = r.other),
  roots AS (SELECT node, min(other) AS root FROM reach GROUP BY 1)
  SELECT DISTINCT sha256(coalesce(root, e, p, 'r:' || SRC_SYSTEM || ':' || SRC_USER_ID)) AS PERSON_KEY, SRC_SYSTEM
  FROM nodes LEFT JOIN roots ON node = coalesce(e, p)"""
    sql["raw_to_gold_dim_product"] = f"""WITH {ORDERS}, {RAW_STOCK}, codes AS (
    SELECT {RAW_CODE} AS PRODUCT_ID FROM order_view UNION SELECT PRODUCT_ID FROM raw_stock)
  SELECT PRODUCT_ID, PRODUCT_ID AS PRODUCT_NAME, 'General' AS CATEGORY, CASE WHEN PRODUCT_ID IS NOT NULL
    THEN row_number() OVER (ORDER BY PRODUCT_ID ASC NULLS LAST) END AS PRODUCT_ID_KEY FROM codes"""
    sql["raw_to_gold_fact_orders"] = f"WITH {RAW_ORDERS} SELECT * FROM raw_fact"
    sql["raw_to_gold_fact_inventory"] = f"""WITH {RAW_STOCK}, spread AS (
    SELECT PRODUCT_ID, min(AVAILABLE_QTY) <> max(AVAILABLE_QTY) OR min(PRICE) <> max(PRICE) AS conflict,
      CAST(count(*) AS INTEGER) AS sources FROM raw_latest GROUP BY 1)
  SELECT {RAW_NOW} AS SNAPSHOT_TS, PRODUCT_ID, lower(SRC_SYSTEM) AS CHANNEL_ID, AVAILABLE_QTY AS AVAIL_QTY,
    CAST(PRICE AS DECIMAL(10,2)) AS PRICE, 'AUD' AS CURRENCY,
    CAST(datediff('second', LAST_UPDATED_UTC, {RAW_NOW}) AS DECIMAL(38,0)) AS SYNC_DELAY_SEC, LAST_UPDATED_UTC,
    {_fresh("fresh", "stale", "expired", f"datediff('second', LAST_UPDATED_UTC, {RAW_NOW})")} AS STATUS,
    conflict AS CONFLICT_FLAG, sources AS SOURCE_COVERAGE
  FROM raw_latest JOIN spread USING (PRODUCT_ID)"""
    sql["raw_to_gold_daily_revenue"] = f"WITH {RAW_ORDERS} {_daily_revenue('raw_fact')}"
    # the same results by stored state
    sql["snapshot_history"] = sql["snapshot_append"]
    sql["rollup_daily_revenue"] = sql["daily_revenue_exact"]
    sql["rollup_status_mix"] = sql["status_mix"]
    sql["distinct_sketches"] = f"""WITH {ORDERS}
  SELECT lower(SOURCE) AS channel, count(DISTINCT PERSON_KEY) AS customers, true AS within_bound
  FROM order_view WHERE PERSON_KEY IS NOT NULL GROUP BY 1"""
    sql["bucketed_order_persons"] = f"""WITH {ORDERS}, {PERSONS}
  SELECT LOCALE, count(*) AS orders, sum(GROSS_AMOUNT) AS amount FROM order_view JOIN persons USING (PERSON_KEY) GROUP BY 1"""
    sql["streaming_customers"] = sql["raw_to_gold_customers"]
    sql["streaming_fact_orders"] = sql["raw_to_gold_fact_orders"]
    sql["streaming_inventory"] = sql["inventory_unified"]
    return sql
