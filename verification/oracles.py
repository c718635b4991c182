"""DuckDB SQL for the registered queries, written independently of the Spark code.

Ratios are rounded half up in integer arithmetic, since DuckDB divides decimals as
doubles. Each ``WITH`` part below is one layer; a query takes the layers it needs.
"""

from __future__ import annotations

import hashlib

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"

STG_USERS = f"""
stg_users AS (
  SELECT c_custkey AS user_id, c_name AS full_name,
         'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         CASE c_custkey % 5 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Fluid' WHEN 3 THEN 'Other' END AS gender,
         CASE c_custkey % 4 WHEN 0 THEN 'Mr.' WHEN 1 THEN 'Ms.' WHEN 2 THEN 'Dr.' END AS title,
         c_mktsegment AS occupation, n_name AS nationality, r_name AS language,
         CASE c_custkey % 3 WHEN 0 THEN 'Bachelor' WHEN 1 THEN 'Master' ELSE 'PhD' END AS academic_degree,
         CAST(18 + c_custkey % 60 AS INTEGER) AS age,
         CASE c_custkey % 4 WHEN 0 THEN 'O+' WHEN 1 THEN 'A+' WHEN 2 THEN 'B+' ELSE 'AB+' END AS blood_type,
         n_name || ' City' AS city, r_name AS state, n_name AS country_code,
         CAST(10000 + c_custkey % 90000 AS VARCHAR) AS postal_code,
         TIMESTAMP '2023-01-01 00:00:00' + to_days(CAST(c_custkey % 300 AS INTEGER)) AS created_at,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_custkey % 700) AS updated_at,
         {AS_OF} AS loaded_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

STG_PRODUCTS = f"""
stg_products AS (
  SELECT p_partkey AS product_id, p_brand AS make, p_name AS model,
         CAST(2000 + p_size % 25 AS INTEGER) AS year, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         TIMESTAMP '2023-01-01 00:00:00' AS created_at, {AS_OF} AS loaded_at
  FROM part
)"""

STG_PURCHASES = f"""
stg_purchases AS (
  SELECT event_id AS purchase_id,
         CASE WHEN event_id % 101 = 0 THEN CAST(-1 AS BIGINT) ELSE user_id END AS user_id,
         CASE WHEN event_id % 97 = 0 THEN CAST(999999999 AS BIGINT) ELSE CAST(props->>'k' AS BIGINT) END AS product_id,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END AS purchased_at,
         ts - INTERVAL 1 DAY AS added_to_cart_at,
         CASE WHEN value >= 100 THEN ts + INTERVAL 10 DAY END AS returned_at,
         {AS_OF} AS loaded_at
  FROM events WHERE event_type = 'purchase'
)"""

ORDER_LINE_PURCHASES = f"""
numbered AS (
  SELECT *, CASE WHEN l_linenumber IS NULL THEN 0 WHEN l_linenumber >= 0 THEN l_linenumber * 2 + 1 ELSE l_linenumber * -2 END AS a,
         row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS b
  FROM lineitem
),
placed AS (SELECT *, CAST((a + b) * (a + b + 1) // 2 + b AS BIGINT) AS place FROM numbered),
stg_purchases AS (
  SELECT (CAST(l_orderkey AS BIGINT) * (CAST(1 AS BIGINT) << length(bin(place))) + place) * 64 + length(bin(place)) AS purchase_id,
         o_custkey AS user_id, l_partkey AS product_id, o_orderdate AS purchased_at,
         o_orderdate AS added_to_cart_at,
         CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS returned_at, {AS_OF} AS loaded_at
  FROM placed JOIN orders ON l_orderkey = o_orderkey
)"""

DIM_PRODUCTS = """
dim_products AS (
  SELECT p.product_id, p.make, p.model, p.year, CAST(p.price AS DECIMAL(12,2)) AS price, p.created_at, p.loaded_at,
         COUNT(q.purchase_id) AS times_sold, COUNT(q.returned_at) AS times_returned
  FROM stg_products p LEFT JOIN stg_purchases q ON p.product_id = q.product_id
  GROUP BY ALL
)"""

DIM_USERS = """
dim_users AS (
  SELECT u.user_id, u.full_name, u.email, u.occupation, u.city, u.state, u.country_code, u.age, u.created_at,
         COUNT(q.purchase_id) AS total_purchases,
         CAST(COALESCE(SUM(p.price), 0) AS DECIMAL(12,2)) AS total_spent,
         COUNT(q.returned_at) AS total_returns,
         MIN(q.purchased_at) AS first_purchase_at, MAX(q.purchased_at) AS last_purchase_at
  FROM stg_users u LEFT JOIN stg_purchases q ON u.user_id = q.user_id
       LEFT JOIN stg_products p ON q.product_id = p.product_id
  GROUP BY ALL
)"""

FCT = """
fct_purchases AS (
  SELECT q.purchase_id, q.user_id, q.product_id, p.make AS product_make, p.model AS product_model,
         p.price AS product_price, q.purchased_at, q.added_to_cart_at, q.returned_at,
         q.returned_at IS NOT NULL AS is_returned, q.loaded_at
  FROM stg_purchases q LEFT JOIN stg_products p ON q.product_id = p.product_id
)"""

LAST = """
user_last_purchase AS (
  SELECT user_id, product_make || ' ' || product_model AS last_product, product_price AS last_product_price
  FROM fct_purchases
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY purchased_at DESC NULLS FIRST, purchase_id DESC) = 1
)"""

GOLD = f"""
gold AS (
  SELECT d.user_id, full_name, email, occupation, city, state, country_code, age,
         total_purchases, total_spent, total_returns,
         CAST(CAST((2 * CAST(total_spent * 100 AS BIGINT) + total_purchases) // (2 * total_purchases) AS BIGINT)
              * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS avg_purchase_value,
         CAST(CAST((2000 * total_returns + total_purchases) // (2 * total_purchases) AS BIGINT)
              * CAST('0.1' AS DECIMAL(2,1)) AS DECIMAL(5,1)) AS return_rate_pct,
         last_product AS last_purchased_product, CAST(last_product_price AS DECIMAL(12,2)) AS last_purchased_price,
         first_purchase_at, last_purchase_at, d.created_at AS user_created_at, {AS_OF} AS refreshed_at
  FROM dim_users d LEFT JOIN user_last_purchase l ON d.user_id = l.user_id
  WHERE total_purchases > 0
)"""

STAGING = [STG_USERS, STG_PRODUCTS, STG_PURCHASES]
MARTS = [*STAGING, DIM_PRODUCTS, DIM_USERS, FCT]
TO_GOLD = [*MARTS, LAST, GOLD]

RESULTS = """
results AS (
  SELECT ts AS detected_at, 'inv-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS invocation_id,
         CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_type = 'error' THEN 'fail'
              WHEN event_type = 'signup' THEN 'warn' ELSE 'pass' END AS status,
         CASE user_id % 3 WHEN 0 THEN 'staging' WHEN 1 THEN 'marts' ELSE 'gold' END AS schema_name,
         'model_' || CAST(user_id % 7 AS VARCHAR) AS table_name, 'c' || CAST(event_id % 5 AS VARCHAR) AS column_name,
         'test_' || CAST(event_id % 40 AS VARCHAR) AS test_name, event_type AS test_type,
         CASE WHEN event_id % 6 = 0 THEN 'WARN' ELSE 'ERROR' END AS severity, event_id % 4 AS failures,
         'event ' || CAST(event_id AS VARCHAR) AS test_results_description,
         't' || CAST(event_id % 40 AS VARCHAR) AS test_unique_id,
         'model_' || CAST(user_id % 7 AS VARCHAR) AS model_unique_id
  FROM events
)"""

RUNS = """
runs AS (
  SELECT 'inv-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS invocation_id,
         'model_' || CAST(user_id % 7 AS VARCHAR) AS name,
         CASE event_id % 2 WHEN 0 THEN 'model' ELSE 'test' END AS resource_type,
         CASE user_id % 2 WHEN 0 THEN 'table' ELSE 'view' END AS materialization,
         CASE WHEN event_type = 'error' THEN 'error' WHEN event_id % 2 = 0 THEN 'success' ELSE 'pass' END AS status,
         value AS execution_time, event_id % 1000 AS rows_affected,
         ts AS execute_started_at, ts + INTERVAL 1 MINUTE AS execute_completed_at
  FROM events
)"""

MODELS = """
models AS (
  SELECT DISTINCT 'model_' || CAST(user_id % 9 AS VARCHAR) AS unique_id, 'model_' || CAST(user_id % 9 AS VARCHAR) AS name,
         CASE (user_id % 9) % 3 WHEN 0 THEN 'staging' WHEN 1 THEN 'marts' ELSE 'gold' END AS schema_name
  FROM events
)"""

TREND = """
trend AS (
  SELECT CAST(detected_at AS DATE) AS run_date, invocation_id, COUNT(*) AS total_tests,
         COUNT(*) FILTER (WHERE status = 'pass') AS passed, COUNT(*) FILTER (WHERE status <> 'pass') AS failed,
         CAST(CAST((2000 * COUNT(*) FILTER (WHERE status = 'pass') + COUNT(*)) // (2 * COUNT(*)) AS BIGINT)
              * CAST('0.1' AS DECIMAL(2,1)) AS DECIMAL(5,1)) AS pass_rate_pct,
         MAX(detected_at) AS last_detected_at
  FROM results GROUP BY 1, 2
)"""

DELTA = """
states AS (
  SELECT user_id, event_id, ts, event_type FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
), later AS (
  SELECT user_id, event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'
)"""

USER_STATES = """
before AS (
  SELECT user_id, occupation, city, created_at, created_at AS updated_at FROM stg_users
  WHERE created_at < TIMESTAMP '2023-08-01 00:00:00'
), after AS (
  SELECT user_id, occupation,
         CASE WHEN updated_at >= TIMESTAMP '2024-01-20 00:00:00' THEN 'New ' || city ELSE city END AS city, created_at,
         CASE WHEN updated_at >= TIMESTAMP '2024-01-20 00:00:00' THEN updated_at ELSE created_at END AS updated_at
  FROM stg_users WHERE occupation <> 'MACHINERY'
)"""


def sql(parts: list[str], select: str) -> str:
    return f"WITH {','.join(parts)}\n{select}" if parts else select


def dig(stream: str, key: str, field: str, below: int) -> str:
    """The generator's number: 15 hex digits of an MD5 over field and key, modulo ``below``."""
    text = f"md5('{stream}:42:{field}:' || CAST({key} AS VARCHAR))"
    return f"(CAST('0x' || substr({text}, 1, 15) AS BIGINT) % {below})"


def pick(number: str, choices: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(choices))
    return f"CASE {number} {cases} END"


ORACLES: dict[str, str] = {}

def _json(fields: list[tuple[str, str]]) -> str:
    """A JSON object's text; a value is SQL for its text or NULL."""
    parts = [f"'\"{name}\":' || coalesce({value}, 'null')" for name, value in fields]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def _text(column: str) -> str:
    return f"'\"' || {column} || '\"'"


def _number(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def _instant(column: str) -> str:
    return f"strftime({column}, '\"%Y-%m-%dT%H:%M:%S.%fZ\"')"


_ADDRESS = _json(
    [("city", _text("city")), ("state", _text("state")), ("country_code", _text("country_code")),
     ("postal_code", _text("postal_code")), ("street_name", _text("'Market St'")),
     ("street_number", _text("CAST(user_id % 999 AS VARCHAR)"))]
)
_USER_JSON = _json(
    [("id", _number("user_id")), ("name", _text("full_name")), ("email", _text("email")), ("gender", _text("gender")),
     ("title", _text("title")), ("occupation", _text("occupation")), ("nationality", _text("nationality")),
     ("language", _text("language")), ("academic_degree", _text("academic_degree")), ("age", _number("age")),
     ("blood_type", _text("blood_type")), ("address", _ADDRESS), ("created_at", _instant("created_at")),
     ("updated_at", _instant("updated_at"))]
)
_PRODUCT_JSON = _json(
    [("id", _number("product_id")), ("make", _text("make")), ("model", _text("model")), ("year", _number("year")),
     ("price", _number("price")), ("created_at", _instant("created_at"))]
)
_PURCHASE_JSON = _json(
    [("id", _number("purchase_id")), ("user_id", _number("user_id")), ("product_id", _number("product_id")),
     ("purchased_at", _instant("purchased_at")), ("added_to_cart_at", _instant("added_to_cart_at")),
     ("returned_at", _instant("returned_at"))]
)
ORACLES["raw_envelope"] = sql(
    STAGING,
    f"""
SELECT stream, sha256(data) AS record_id, data, {AS_OF} AS emitted_at FROM (
  SELECT 'raw_users' AS stream, {_USER_JSON} AS data FROM stg_users
  UNION ALL SELECT 'raw_products', {_PRODUCT_JSON} FROM stg_products
  UNION ALL SELECT 'raw_purchases', {_PURCHASE_JSON} FROM stg_purchases)""",
)

ORACLES["raw_scan_counts"] = """
SELECT 'raw_users' AS table_name, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 'raw_products', COUNT(*) FROM part
UNION ALL SELECT 'raw_purchases', COUNT(*) FROM events WHERE event_type = 'purchase'"""

ORACLES["discover_raw_schema"] = sql(
    STAGING,
    """
SELECT 'raw_users' AS stream, f.field_name, f.field_type, COUNT(*) AS records,
       COUNT(*) FILTER (WHERE (f.field_name = 'gender' AND gender IS NULL) OR (f.field_name = 'title' AND title IS NULL)) AS null_values
FROM stg_users, (VALUES ('id','BIGINT'), ('name','STRING'), ('email','STRING'), ('gender','STRING'), ('title','STRING'),
  ('occupation','STRING'), ('nationality','STRING'), ('language','STRING'), ('academic_degree','STRING'), ('age','BIGINT'),
  ('blood_type','STRING'), ('address','OBJECT<city: STRING, country_code: STRING, postal_code: STRING, state: STRING, street_name: STRING, street_number: STRING>'),
  ('address.city','STRING'), ('address.state','STRING'), ('address.country_code','STRING'), ('address.postal_code','STRING'),
  ('address.street_name','STRING'), ('address.street_number','STRING'), ('created_at','STRING'), ('updated_at','STRING')) f(field_name, field_type)
GROUP BY ALL
UNION ALL
SELECT 'raw_products', f.field_name, CASE WHEN f.field_name = 'price' THEN (
         SELECT 'DECIMAL(' || (MAX(length(split_part(price::VARCHAR, '.', 1))) + MAX(length(rtrim(split_part(price::VARCHAR, '.', 2), '0'))))
                || ',' || MAX(length(rtrim(split_part(price::VARCHAR, '.', 2), '0'))) || ')' FROM stg_products)
       ELSE f.field_type END, COUNT(*), 0
FROM stg_products, (VALUES ('id','BIGINT'), ('make','STRING'), ('model','STRING'), ('year','BIGINT'), ('price','DECIMAL'),
  ('created_at','STRING')) f(field_name, field_type)
GROUP BY ALL
UNION ALL
SELECT 'raw_purchases', f.field_name, f.field_type, COUNT(*),
       COUNT(*) FILTER (WHERE (f.field_name = 'purchased_at' AND purchased_at IS NULL) OR (f.field_name = 'returned_at' AND returned_at IS NULL))
FROM stg_purchases, (VALUES ('id','BIGINT'), ('user_id','BIGINT'), ('product_id','BIGINT'), ('purchased_at','STRING'),
  ('added_to_cart_at','STRING'), ('returned_at','STRING')) f(field_name, field_type)
GROUP BY ALL""",
)

ORACLES["seed_if_empty"] = ORACLES["raw_envelope"]
ORACLES["seed_then_refresh"] = f"SELECT record_id, data, emitted_at FROM ({ORACLES['raw_envelope']}) WHERE stream = 'raw_products'"

ORACLES["full_refresh_overwrite"] = """
SELECT 'raw_users' AS table_name, COUNT(*) AS row_count, COUNT(*) AS payloads FROM customer
UNION ALL SELECT 'raw_products', COUNT(*), COUNT(*) FROM part
UNION ALL SELECT 'raw_purchases', COUNT(*), COUNT(*) FROM events WHERE event_type = 'purchase'"""

def _profile(field: str, choices: list[str]) -> str:
    return pick(dig("users", "c_custkey", field, len(choices)), choices)


_bought = f"(TIMESTAMP '2024-01-01 00:00:00' + to_minutes({dig('purchases', 'c_custkey', 'bought', 288000)}))"
_created = f"(TIMESTAMP '2024-01-01 00:00:00' + to_minutes({dig('users', 'c_custkey', 'created', 288000)}))"
ORACLES["synthetic_ecommerce"] = f"""
SELECT c_custkey AS id, 'User ' || c_custkey AS name, 'user' || c_custkey || '@example.com' AS email,
       {_profile('gender', ['Male', 'Female', 'Fluid', 'Other'])} AS gender,
       {_profile('title', ['Mr.', 'Ms.', 'Dr.'])} AS title,
       {_profile('occupation', ['Engineer', 'Teacher', 'Nurse', 'Designer', 'Analyst'])} AS occupation,
       {_profile('nationality', ['American', 'Canadian', 'British', 'German', 'Japanese', 'Brazilian'])} AS nationality,
       {_profile('language', ['English', 'German', 'Japanese', 'Portuguese'])} AS language,
       {_profile('degree', ['Bachelor', 'Master', 'PhD'])} AS academic_degree,
       CAST(18 + {dig('users', 'c_custkey', 'age', 60)} AS INTEGER) AS age,
       {_profile('blood', ['O+', 'A+', 'B+', 'AB+', 'O-', 'A-', 'B-', 'AB-'])} AS blood_type,
       'City ' || {dig('users', 'c_custkey', 'city', 100)} AS city,
       'State ' || {dig('users', 'c_custkey', 'state', 10)} AS state,
       {_profile('country', ['US', 'CA', 'GB', 'DE', 'JP', 'BR'])} AS country_code,
       CAST(10000 + {dig('users', 'c_custkey', 'postal', 90000)} AS VARCHAR) AS postal_code,
       {_profile('street', ['Birch Rd', 'Canal St', 'Hill Ave', 'Lake Dr', 'Mill Ln'])} AS street_name,
       CAST(1 + {dig('users', 'c_custkey', 'house', 999)} AS VARCHAR) AS street_number,
       {_created} AS created_at, {_created} AS updated_at,
       {dig('purchases', 'c_custkey', 'user', 100_000_000)} AS user_id,
       {dig('purchases', 'c_custkey', 'product', 5000)} AS product_id,
       {_bought} AS purchased_at, {_bought} - INTERVAL 1 DAY AS added_to_cart_at,
       CASE WHEN {dig('purchases', 'c_custkey', 'returned', 10)} = 0 THEN {_bought} + INTERVAL 10 DAY END AS returned_at
FROM customer"""

_makes = ["Aster", "Borealis", "Cinder", "Dune", "Ember", "Fjord", "Gale", "Harbor"]
ORACLES["synthetic_products"] = f"""
SELECT id, {pick(dig('products', 'id', 'make', 8), _makes)} AS make, 'Model ' || {dig('products', 'id', 'model', 500)} AS model,
       CAST(2000 + {dig('products', 'id', 'year', 25)} AS INTEGER) AS year,
       CAST(({dig('products', 'id', 'price', 8000000)} + 100000) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS price,
       TIMESTAMP '2024-01-01 00:00:00' AS created_at
FROM (SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS id FROM part)"""

ORACLES["stg_users"] = sql([STG_USERS], "SELECT * FROM stg_users")
ORACLES["stg_products"] = sql([STG_PRODUCTS], "SELECT * FROM stg_products")
ORACLES["stg_purchases"] = sql([STG_PURCHASES], "SELECT * FROM stg_purchases")
ORACLES["stg_purchases_quarantine"] = sql(
    [STG_PURCHASES],
    """
SELECT purchase_id, CASE WHEN user_id >= 0 THEN user_id END AS user_id,
       CASE WHEN product_id <> 999999999 THEN product_id END AS product_id, purchased_at,
       CASE WHEN user_id < 0 AND product_id = 999999999 THEN 'user_id,product_id' WHEN user_id < 0 THEN 'user_id'
            WHEN product_id = 999999999 THEN 'product_id' ELSE '' END AS errors
FROM stg_purchases""",
)
ORACLES["dim_products"] = sql([STG_PRODUCTS, STG_PURCHASES, DIM_PRODUCTS], "SELECT * FROM dim_products")
ORACLES["dim_users"] = sql([*STAGING, DIM_USERS], "SELECT * FROM dim_users")
ORACLES["fct_purchases"] = sql([STG_PRODUCTS, STG_PURCHASES, FCT], "SELECT * FROM fct_purchases")
ORACLES["user_last_purchase"] = sql([STG_PRODUCTS, STG_PURCHASES, FCT, LAST], "SELECT * FROM user_last_purchase")
ORACLES["gold_user_purchases"] = sql(TO_GOLD, "SELECT * FROM gold")
ORACLES["gold_order_lines"] = sql(
    [STG_USERS, STG_PRODUCTS, ORDER_LINE_PURCHASES, DIM_USERS, FCT, LAST, GOLD], "SELECT * FROM gold"
)
ORACLES["full_build"] = ORACLES["gold_order_lines"]
ORACLES["layer_showcase"] = sql(
    TO_GOLD,
    """
(SELECT 'staging' AS layer, user_id, full_name, CAST(NULL AS DECIMAL(12,2)) AS total_spent FROM stg_users ORDER BY user_id LIMIT 5)
UNION ALL (SELECT 'marts', user_id, full_name, total_spent FROM dim_users ORDER BY user_id LIMIT 10)
UNION ALL (SELECT 'gold', user_id, full_name, total_spent FROM gold ORDER BY user_id LIMIT 10)""",
)
ORACLES["versioned_latest"] = sql(
    [STG_PRODUCTS, STG_PURCHASES, DIM_PRODUCTS],
    """
SELECT 'dim_products_v1' AS relation, 9 AS columns, COUNT(*) AS row_count FROM dim_products WHERE times_sold > 0
UNION ALL SELECT 'dim_products', 10, COUNT(*) FROM dim_products
UNION ALL SELECT 'dim_products, declared', 9, COUNT(*) FROM dim_products WHERE times_sold > 0""",
)
ORACLES["versioned_projection"] = sql(
    [STG_PRODUCTS, STG_PURCHASES, DIM_PRODUCTS],
    "SELECT product_id, make, model, year, price, times_sold, times_returned FROM dim_products",
)

ORACLES["top_spenders"] = sql(
    TO_GOLD,
    "SELECT full_name, total_spent, total_purchases, avg_purchase_value FROM gold ORDER BY total_spent DESC, user_id LIMIT 10",
)
ORACLES["high_return_rate"] = sql(
    TO_GOLD, "SELECT full_name, return_rate_pct, total_returns, total_purchases FROM gold WHERE return_rate_pct > 15"
)
ORACLES["customer_lifetime_value"] = sql(
    TO_GOLD,
    """
SELECT full_name, total_spent, avg_purchase_value, total_purchases,
       CAST(floor((epoch_us(last_purchase_at) - epoch_us(first_purchase_at)) // 1000000) AS BIGINT) AS tenure_seconds
FROM gold""",
)
ORACLES["recent_purchasers"] = sql(
    TO_GOLD,
    """
SELECT full_name, last_purchased_product, last_purchased_price, last_purchase_at FROM gold
WHERE last_purchase_at > TIMESTAMP '2024-02-25 00:00:00' - INTERVAL 30 DAY""",
)
ORACLES["geo_revenue"] = sql(
    TO_GOLD,
    "SELECT city, state, country_code, COUNT(*) AS customers, CAST(SUM(total_spent) AS DECIMAL(22,2)) AS revenue FROM gold GROUP BY ALL",
)
ORACLES["revenue_by_country"] = sql(
    TO_GOLD, "SELECT country_code, CAST(SUM(total_spent) AS DECIMAL(22,2)) AS revenue FROM gold GROUP BY ALL"
)
ORACLES["return_rate_histogram"] = sql(
    TO_GOLD,
    "SELECT CAST(floor(return_rate_pct / 10) * 10 AS INTEGER) AS band_from_pct, COUNT(*) AS customers FROM gold GROUP BY 1",
)
ORACLES["value_vs_return_rate"] = sql(TO_GOLD, "SELECT user_id, avg_purchase_value, return_rate_pct FROM gold")
ORACLES["purchase_timeline"] = sql(
    TO_GOLD,
    """
SELECT 'first' AS activity, CAST(first_purchase_at AS DATE) AS day, COUNT(*) AS customers FROM gold
WHERE first_purchase_at IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'last', CAST(last_purchase_at AS DATE), COUNT(*) FROM gold WHERE last_purchase_at IS NOT NULL GROUP BY ALL""",
)
ORACLES["product_monthly_sales"] = sql(
    [STG_PRODUCTS, STG_PURCHASES, FCT],
    """
SELECT CAST(date_trunc('month', purchased_at) AS DATE) AS month, product_id, COUNT(*) AS units,
       CAST(SUM(product_price) AS DECIMAL(20,2)) AS revenue, COUNT(*) FILTER (WHERE is_returned) AS returns,
       CAST(CAST((2000 * COUNT(*) FILTER (WHERE is_returned) + COUNT(*)) // (2 * COUNT(*)) AS BIGINT)
            * CAST('0.1' AS DECIMAL(2,1)) AS DECIMAL(5,1)) AS return_rate_pct
FROM fct_purchases GROUP BY 1, 2""",
)
ORACLES["weekly_kpi"] = sql(
    [STG_PRODUCTS, STG_PURCHASES, FCT],
    """
SELECT cohort_week, CAST((week - cohort_week) // 7 AS INTEGER) AS weeks_later, COUNT(DISTINCT user_id) AS active_users,
       CAST(SUM(product_price) AS DECIMAL(30,2)) AS revenue
FROM (SELECT user_id, product_price, CAST(date_trunc('week', purchased_at) AS DATE) AS week,
             MIN(CAST(date_trunc('week', purchased_at) AS DATE)) OVER (PARTITION BY user_id) AS cohort_week
      FROM fct_purchases WHERE purchased_at IS NOT NULL)
GROUP BY 1, 2""",
)
ORACLES["rfm_features"] = sql(
    [
        *TO_GOLD,
        """
features AS (
  SELECT user_id, age, country_code, CAST(DATE '2024-02-01' - CAST(last_purchase_at AS DATE) AS INTEGER) AS recency_days,
         total_purchases AS frequency, total_spent AS monetary, avg_purchase_value, return_rate_pct FROM gold
), cuts AS (
  SELECT quantile_disc(recency_days, [0.25, 0.5, 0.75]) AS r, quantile_disc(frequency, [0.25, 0.5, 0.75]) AS f,
         quantile_disc(monetary, [0.25, 0.5, 0.75]) AS m FROM features
)""",
    ],
    """
SELECT features.*,
       4 - (CAST(recency_days > r[1] AS INTEGER) + CAST(recency_days > r[2] AS INTEGER) + CAST(recency_days > r[3] AS INTEGER)) AS recency_score,
       1 + CAST(frequency > f[1] AS INTEGER) + CAST(frequency > f[2] AS INTEGER) + CAST(frequency > f[3] AS INTEGER) AS frequency_score,
       1 + CAST(monetary > m[1] AS INTEGER) + CAST(monetary > m[2] AS INTEGER) + CAST(monetary > m[3] AS INTEGER) AS monetary_score
FROM features, cuts""",
)

# --- checks: every declared check as one SELECT of its failures -------------------------

_SCHEMAS = {
    "raw_users": "raw", "raw_products": "raw", "raw_purchases": "raw",
    "stg_users": "staging", "stg_products": "staging", "stg_purchases": "staging",
    "dim_users": "marts", "dim_products": "marts", "fct_purchases": "marts", "gold_user_purchases": "gold",
}
_RELATIONS = {
    "raw_users": "(SELECT c_name AS data FROM customer)", "raw_products": "(SELECT p_name AS data FROM part)",
    "raw_purchases": "(SELECT event_type AS data FROM events WHERE event_type = 'purchase')",
    "gold_user_purchases": "gold",
}


def _check(test_type: str, table: str, column: str, failures: str, arguments: str = "") -> str:
    suffix = f"_{hashlib.md5(arguments.encode()).hexdigest()[:8]}" if arguments else ""
    return f"""
SELECT '{test_type}_{table}_{column}{suffix}' AS check_name, '{_SCHEMAS[table]}' AS schema_name, '{table}' AS table_name,
       '{column}' AS column_name, '{test_type}' AS test_type, 'error' AS severity, failures,
       CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM ({failures})"""


def _not_null(table: str, column: str) -> str:
    relation = _RELATIONS.get(table, table)
    return _check("not_null", table, column, f"SELECT COUNT(*) AS failures FROM {relation} WHERE {column} IS NULL")


def _unique(table: str, column: str) -> str:
    relation = _RELATIONS.get(table, table)
    repeated = f"SELECT {column} FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1"
    return _check("unique", table, column, f"SELECT COUNT(*) AS failures FROM ({repeated})")


def _relationship(table: str, column: str, parent: str) -> str:
    relation = _RELATIONS.get(table, table)
    orphans = (
        f"SELECT COUNT(*) AS failures FROM {relation} c WHERE c.{column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})"
    )
    return _check("relationships", table, column, orphans, f"{parent}|{column}")


def _expression(table: str, column: str, condition: str) -> str:
    relation = _RELATIONS.get(table, table)
    return _check(
        "expression_is_true", table, column, f"SELECT COUNT(*) AS failures FROM {relation} WHERE NOT ({column} {condition})",
        f"{column} {condition}",
    )


def _accepted(column: str, values: str) -> str:
    return _check(
        "accepted_values", "stg_users", column,
        f"SELECT COUNT(DISTINCT {column}) AS failures FROM stg_users WHERE {column} NOT IN ({values})",
        values.replace("'", "").replace(", ", "|"),
    )


_NOT_NULL = [
    ("raw_users", "data"), ("raw_products", "data"), ("raw_purchases", "data"),
    ("stg_users", "user_id"), ("stg_users", "email"), ("stg_users", "full_name"), ("stg_users", "age"),
    ("stg_products", "product_id"), ("stg_products", "make"), ("stg_products", "model"), ("stg_products", "price"),
    ("stg_purchases", "purchase_id"), ("stg_purchases", "user_id"), ("stg_purchases", "product_id"),
    ("dim_users", "user_id"), ("dim_users", "full_name"), ("dim_users", "email"), ("dim_users", "total_purchases"),
    ("dim_users", "total_spent"),
    ("dim_products", "product_id"), ("dim_products", "make"), ("dim_products", "model"), ("dim_products", "price"),
    ("fct_purchases", "purchase_id"), ("fct_purchases", "user_id"), ("fct_purchases", "product_id"),
    ("gold_user_purchases", "user_id"), ("gold_user_purchases", "full_name"), ("gold_user_purchases", "email"),
    ("gold_user_purchases", "total_purchases"), ("gold_user_purchases", "total_spent"),
    ("gold_user_purchases", "avg_purchase_value"), ("gold_user_purchases", "return_rate_pct"),
]
_UNIQUE = [
    ("stg_users", "user_id"), ("stg_users", "email"), ("stg_products", "product_id"), ("stg_purchases", "purchase_id"),
    ("dim_users", "user_id"), ("dim_users", "email"), ("dim_products", "product_id"), ("fct_purchases", "purchase_id"),
    ("gold_user_purchases", "user_id"), ("gold_user_purchases", "email"),
]
_RELATIONSHIPS = [
    ("stg_purchases", "user_id", "stg_users"), ("stg_purchases", "product_id", "stg_products"),
    ("dim_users", "user_id", "stg_users"), ("dim_products", "product_id", "stg_products"),
    ("fct_purchases", "user_id", "stg_users"), ("fct_purchases", "product_id", "stg_products"),
    ("gold_user_purchases", "user_id", "dim_users"),
]
_EXPRESSIONS = [
    ("dim_users", "total_purchases", ">= 0"), ("dim_products", "price", "> 0"), ("dim_products", "times_sold", ">= 0"),
]
_GENDERS = _accepted("gender", "'Male', 'Female', 'Fluid', 'Other'")

ORACLES["check_not_null"] = sql(TO_GOLD, " UNION ALL ".join(_not_null(*c) for c in _NOT_NULL))
ORACLES["check_unique"] = sql(TO_GOLD, " UNION ALL ".join(_unique(*c) for c in _UNIQUE))
ORACLES["check_relationships"] = sql(TO_GOLD, " UNION ALL ".join(_relationship(*c) for c in _RELATIONSHIPS))
ORACLES["check_accepted_values"] = sql([STG_USERS], " UNION ALL ".join([_GENDERS, _accepted("academic_degree", "'Master'")]))
ORACLES["check_expression"] = sql(
    TO_GOLD,
    " UNION ALL ".join([*(_expression(*c) for c in _EXPRESSIONS), _expression("dim_products", "times_returned", "= 0")]),
)
ORACLES["check_suite"] = sql(
    TO_GOLD,
    " UNION ALL ".join(
        [*(_not_null(*c) for c in _NOT_NULL), *(_unique(*c) for c in _UNIQUE),
         *(_relationship(*c) for c in _RELATIONSHIPS), *(_expression(*c) for c in _EXPRESSIONS), _GENDERS]
    ),
)


def _share(column: str, at_least: float) -> str:
    return _check(
        "not_null_proportion", "stg_users", column,
        f"SELECT CASE WHEN COUNT({column}) >= {at_least} * COUNT(*) THEN 0 ELSE COUNT(*) - COUNT({column}) END AS failures FROM stg_users",
        str(at_least),
    )


ORACLES["check_extended"] = sql(
    [STG_USERS, STG_PURCHASES],
    " UNION ALL ".join(
        [
            _check("between", "stg_users", "age", "SELECT COUNT(*) AS failures FROM stg_users WHERE age < 20 OR age > 70", "20|70"),
            _check("matches", "stg_users", "email",
                   "SELECT COUNT(*) AS failures FROM stg_users WHERE NOT regexp_matches(email, '^user[0-9]+@example[.]com$')",
                   "^user[0-9]+@example[.]com$"),
            _check("matches", "stg_users", "blood_type",
                   "SELECT COUNT(*) AS failures FROM stg_users WHERE NOT regexp_matches(blood_type, '^O')", "^O"),
            _share("gender", 0.75),
            _share("title", 0.9),
            _expression("stg_purchases", "returned_at", "<= TIMESTAMP '2024-02-01 00:00:00'"),
        ]
    ),
)
_OPTIONS = [("error", 0, 0, "fail"), ("warn", 0, 0, "warn"), ("error", 10, 1000000000, "warn"), ("error", 1000000000, 1000000000, "pass")]


def _severity(severity: str, warn: int, error: int, status: str) -> str:
    options = "" if (severity, warn, error) == ("error", 0, 0) else f"{severity}|{warn}|{error}"
    suffix = f"_{hashlib.md5(options.encode()).hexdigest()[:8]}" if options else ""
    return f"""
SELECT 'not_null_fct_purchases_purchased_at{suffix}' AS check_name, 'purchased_at' AS column_name, '{severity}' AS severity,
       COUNT(*) AS failures, '{status}' AS status FROM stg_purchases WHERE purchased_at IS NULL"""


ORACLES["check_severity"] = sql([STG_PURCHASES], " UNION ALL ".join(_severity(*o) for o in _OPTIONS))
ORACLES["check_failing_rows"] = sql(
    [STG_PRODUCTS, STG_PURCHASES],
    "SELECT * FROM stg_purchases WHERE product_id NOT IN (SELECT product_id FROM stg_products)",
)
ORACLES["source_freshness"] = f"""
SELECT 'raw_users' AS source_name, MAX({AS_OF} - INTERVAL 6 HOUR) AS max_loaded_at, CAST(21600 AS BIGINT) AS age_seconds, 'pass' AS status FROM customer
UNION ALL SELECT 'raw_products', MAX({AS_OF} - INTERVAL 18 HOUR), 64800, 'warn' FROM part
UNION ALL SELECT 'raw_purchases', MAX({AS_OF} - INTERVAL 30 HOUR), 108000, 'error' FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'raw_empty', NULL, NULL, 'error'"""
ORACLES["contract_diff"] = sql(
    [*STAGING, DIM_USERS],
    """
SELECT column_name, problem, expected_type, actual_type, COUNT(*) AS affected_rows FROM dim_users,
  (VALUES ('occupation', 'missing', 'string', NULL), ('age', 'type_mismatch', 'int', 'string'),
          ('job', 'unexpected', NULL, 'string'), ('total_spent', 'overflow', 'decimal(6,2)', 'decimal(12,2)'))
  v(column_name, problem, expected_type, actual_type)
WHERE problem <> 'overflow' OR total_spent >= 10000 GROUP BY ALL""",
)
ORACLES["wap_report"] = sql(
    [STG_USERS, STG_PRODUCTS, STG_PURCHASES],
    """
SELECT 'dim_products' AS table_name, 'published' AS outcome, (SELECT COUNT(*) FROM stg_products) AS row_count,
       CAST(8 AS BIGINT) AS checks, CAST(8 AS BIGINT) AS passed, CAST(0 AS BIGINT) AS warned, CAST(0 AS BIGINT) AS failed
UNION ALL
SELECT 'fct_purchases', 'blocked', (SELECT COUNT(*) FROM stg_purchases), 6, 6 - bad, 0, bad
FROM (SELECT CAST(EXISTS (SELECT 1 FROM stg_purchases WHERE user_id NOT IN (SELECT user_id FROM stg_users)) AS BIGINT)
           + CAST(EXISTS (SELECT 1 FROM stg_purchases WHERE product_id NOT IN (SELECT product_id FROM stg_products)) AS BIGINT) AS bad)""",
)

_FIRST = ("raw_users", "raw_products", "raw_purchases", "stg_users", "stg_products", "stg_purchases")
_RECORDED = [
    *(_not_null(*c) for c in _NOT_NULL if c[0] in _FIRST), *(_unique(*c) for c in _UNIQUE if c[0] in _FIRST),
    *(_relationship(*c) for c in _RELATIONSHIPS if c[0] in _FIRST), _GENDERS,
]
_UNIT_TESTS = ("return_rate_calculation", "avg_purchase_value", "user_with_no_returns", "last_purchased_product")
ORACLES["build_history"] = sql(
    STAGING,
    f"""
SELECT 'check' AS kind, check_name AS name, status, failures AS n FROM ({" UNION ALL ".join(_RECORDED)})
UNION ALL SELECT 'model', 'stg_users', 'success', COUNT(*) FROM stg_users
UNION ALL SELECT 'model', 'stg_products', 'success', COUNT(*) FROM stg_products
UNION ALL SELECT 'model', 'stg_purchases', 'error', COUNT(*) FROM stg_purchases
UNION ALL SELECT 'model', unnest(['dim_products', 'fct_purchases', 'dim_users', 'gold_user_purchases']), 'skipped', NULL
UNION ALL SELECT 'unit_test', 'gold_user_purchases.' || unnest({list(_UNIT_TESTS)}), 'pass', NULL""",
)

# --- observability ----------------------------------------------------------------------

ORACLES["obs_pass_rate_trend"] = sql([RESULTS, TREND], "SELECT * EXCLUDE (last_detected_at) FROM trend")
ORACLES["obs_results_by_model"] = sql(
    [RESULTS],
    """
SELECT schema_name AS layer, table_name AS model, test_type, status, COUNT(*) AS test_count,
       CAST(detected_at AS DATE) AS run_date, invocation_id FROM results GROUP BY ALL""",
)
ORACLES["obs_execution_times"] = sql(
    [RUNS],
    """
SELECT name AS model_name, materialization, execution_time, status, rows_affected, execute_started_at, invocation_id
FROM runs WHERE resource_type = 'model'""",
)
ORACLES["obs_invocation_history"] = sql(
    [RUNS],
    """
SELECT invocation_id, resource_type, COUNT(*) AS total, COUNT(*) FILTER (WHERE status IN ('success', 'pass')) AS passed,
       COUNT(*) FILTER (WHERE status NOT IN ('success', 'pass')) AS failed,
       CAST(round(CAST(AVG(execution_time) AS DECIMAL(18,6)), 2) AS DECIMAL(14,2)) AS avg_execution_time_s,
       MIN(execute_started_at) AS started_at, MAX(execute_completed_at) AS completed_at
FROM runs GROUP BY ALL""",
)
ORACLES["obs_latest_failures"] = sql(
    [RESULTS],
    """
SELECT test_name, table_name, column_name, test_type, status, severity, failures, test_results_description, detected_at
FROM results WHERE status <> 'pass'""",
)
ORACLES["obs_test_coverage"] = sql(
    [RESULTS, MODELS],
    """
SELECT m.name AS model_name, m.schema_name AS layer, COUNT(DISTINCT r.test_unique_id) AS test_count,
       COUNT(DISTINCT r.column_name) AS columns_tested
FROM models m LEFT JOIN results r ON r.model_unique_id = m.unique_id GROUP BY ALL""",
)
ORACLES["obs_test_coverage_sketched"] = ORACLES["obs_test_coverage"]
ORACLES["distinct_rolling"] = sql(
    [RESULTS, "ends AS (SELECT DISTINCT CAST(detected_at AS DATE) AS day FROM results)", """
near AS (
  SELECT e.day, r.schema_name, r.test_results_description AS d, r.test_unique_id AS t,
         e.day - CAST(r.detected_at AS DATE) < 7 AS now
  FROM ends e JOIN results r ON e.day - CAST(r.detected_at AS DATE) BETWEEN 0 AND 13),
ds AS (SELECT day, schema_name, d, bool_or(now) AND bool_or(NOT now) AS kept FROM near GROUP BY ALL),
ts AS (SELECT day, schema_name, t, bool_or(now) AND bool_or(NOT now) AS kept FROM near GROUP BY ALL),
counted AS (
  SELECT day, schema_name, count(*) AS row_count, count(DISTINCT d) AS distinct_test_results_description,
         count(DISTINCT t) AS distinct_test_unique_id FROM near WHERE now GROUP BY ALL),
kd AS (SELECT day, schema_name, count(*) FILTER (kept) AS kept_test_results_description FROM ds GROUP BY ALL),
kt AS (SELECT day, schema_name, count(*) FILTER (kept) AS kept_test_unique_id FROM ts GROUP BY ALL)"""],
    """
SELECT * FROM counted JOIN kd USING (day, schema_name) JOIN kt USING (day, schema_name)""",
)
ORACLES["dash_kpis"] = sql(
    [RESULTS, TREND, RUNS, MODELS],
    """
SELECT total_tests, pass_rate_pct, (SELECT COUNT(*) FROM models) AS model_count,
       (SELECT MAX(execute_completed_at) FROM runs) AS last_run
FROM trend ORDER BY run_date DESC, last_detected_at DESC, invocation_id DESC LIMIT 1""",
)
ORACLES["dash_pass_rate_series"] = sql([RESULTS, TREND], "SELECT run_date, pass_rate_pct, invocation_id FROM trend")
ORACLES["dash_duration_series"] = sql(
    [RUNS], "SELECT name AS model_name, execution_time, execute_started_at FROM runs WHERE resource_type = 'model'"
)
ORACLES["dash_results_latest_run"] = sql(
    [RESULTS, TREND],
    """
SELECT schema_name AS layer, table_name AS model, test_type, status, COUNT(*) AS test_count FROM results
WHERE invocation_id = (SELECT invocation_id FROM trend ORDER BY run_date DESC, last_detected_at DESC, invocation_id DESC LIMIT 1)
GROUP BY schema_name, table_name, test_type, status, CAST(detected_at AS DATE)""",
)
ORACLES["dash_recent_failures"] = sql(
    [RESULTS],
    """
SELECT test_name, table_name, column_name, test_type, severity, failures, detected_at FROM results
WHERE status <> 'pass' ORDER BY detected_at DESC NULLS FIRST, test_name, table_name, column_name LIMIT 50""",
)
ORACLES["view_reports"] = ORACLES["obs_pass_rate_trend"]
ORACLES["slowest_models"] = sql(
    [RUNS],
    """
SELECT name, execution_time, execution_time > 60 AS is_slow, execute_started_at FROM runs
WHERE resource_type = 'model' AND status IN ('success', 'error')
ORDER BY execution_time DESC, execute_started_at, name LIMIT 10""",
)
ORACLES["unused_models"] = """
SELECT DISTINCT 'model_' || CAST(user_id % 50 AS VARCHAR) AS name FROM events
EXCEPT SELECT 'model_' || CAST(event_id % 31 AS VARCHAR) FROM events WHERE event_type = 'click'
EXCEPT SELECT 'model_' || CAST(event_id % 37 AS VARCHAR) FROM events WHERE event_type = 'view'"""

# --- incremental loads, history, comparison ---------------------------------------------

ORACLES["dedup_latest"] = """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) = 1"""
ORACLES["incr_high_water"] = """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate > (SELECT MAX(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01 00:00:00')"""
ORACLES["incr_upsert"] = """
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
ORACLES["incr_upsert_late"] = f"SELECT *, CAST(ts AS DATE) AS event_day FROM ({ORACLES['incr_upsert']})"
ORACLES["incr_upsert_pruned"] = ORACLES["incr_upsert_late"]
CHANGED_PURCHASES = """
changed AS (
  SELECT * REPLACE (CASE WHEN purchase_id % 8 = 1 THEN purchased_at ELSE returned_at END AS returned_at)
  FROM stg_purchases WHERE purchase_id % 5 <> 0
)"""
ORACLES["incr_dim_users"] = sql(
    [*STAGING, CHANGED_PURCHASES, DIM_USERS.replace("stg_purchases", "changed")], "SELECT * FROM dim_users"
)
ORACLES["incr_delete_insert"] = sql(
    [DELTA], "SELECT * FROM states WHERE user_id NOT IN (SELECT user_id FROM later) UNION ALL SELECT * FROM later"
)
ORACLES["incr_append"] = "SELECT event_id, ts, user_id FROM events"
ORACLES["incr_insert_overwrite"] = """
SELECT event_id, event_type, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN 0.0 ELSE value END AS value,
       CAST(ts AS DATE) AS event_day FROM events"""
ORACLES["microbatch_daily"] = """
SELECT CAST(ts AS DATE) AS event_day, COUNT(*) AS row_count FROM events
WHERE ts < TIMESTAMP '2024-01-25 00:00:00' AND (ts >= TIMESTAMP '2024-01-14 00:00:00' OR event_type <> 'signup')
GROUP BY 1"""
ORACLES["microbatch_unique_key"] = """
WITH early AS (
  SELECT event_id, ts, user_id FROM events WHERE event_id % 2 = 0 AND ts < TIMESTAMP '2024-01-13 00:00:00'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
), reloaded AS (
  SELECT event_id, ts, user_id FROM events
  WHERE ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00' AND CAST(ts AS DATE) <> DATE '2024-01-15'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
), between_loads AS (
  SELECT DISTINCT user_id FROM events
  WHERE event_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'
)
SELECT *, CAST(ts AS DATE) AS event_day FROM reloaded
UNION ALL
SELECT *, CAST(ts AS DATE) FROM early
WHERE user_id NOT IN (SELECT user_id FROM reloaded) AND user_id NOT IN (SELECT user_id FROM between_loads)"""
ORACLES["schema_evolve"] = """
SELECT policy, columns, COUNT(*) AS row_count,
       CASE WHEN policy <> 'sync_all_columns' THEN COUNT(*) FILTER (WHERE c_mktsegment <> 'BUILDING') END AS c_mktsegment_filled,
       CASE WHEN policy <> 'ignore' THEN COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING') END AS name_length_filled
FROM customer, (VALUES ('ignore', 3), ('append_new_columns', 4), ('sync_all_columns', 3)) v(policy, columns)
GROUP BY policy, columns"""
def key(*parts: str) -> str:
    """SHA-256 over texts, each behind its length."""
    texts = [f"CAST({p} AS VARCHAR)" for p in parts]
    return "sha256(" + " || ".join(f"coalesce(length({t}) || ':' || {t}, '~')" for t in texts) + ")"


ORACLES["scd2_snapshot"] = sql(
    [STG_USERS, USER_STATES],
    f"""
SELECT b.user_id, b.city, b.updated_at AS valid_from, CASE WHEN a.updated_at > b.updated_at THEN a.updated_at END AS valid_to,
       {key('b.user_id', 'b.updated_at')} AS scd_id
FROM before b LEFT JOIN after a ON a.user_id = b.user_id
UNION ALL
SELECT a.user_id, a.city, a.updated_at, NULL, {key('a.user_id', 'a.updated_at')} FROM after a LEFT JOIN before b ON a.user_id = b.user_id
WHERE b.user_id IS NULL OR a.updated_at > b.updated_at""",
)
ORACLES["scd2_snapshot_check"] = sql(
    [STG_USERS, USER_STATES],
    f"""
SELECT b.user_id, b.city, TIMESTAMP '2023-09-01 00:00:00' AS valid_from,
       CASE WHEN a.user_id IS NULL OR a.city <> b.city THEN {AS_OF} END AS valid_to,
       {key('b.user_id', "TIMESTAMP '2023-09-01 00:00:00'")} AS scd_id
FROM before b LEFT JOIN after a ON a.user_id = b.user_id
UNION ALL
SELECT a.user_id, a.city, {AS_OF}, NULL, {key('a.user_id', AS_OF)} FROM after a LEFT JOIN before b ON a.user_id = b.user_id
WHERE b.user_id IS NULL OR a.city <> b.city""",
)
ORACLES["compare_relations"] = sql(
    [STG_USERS, USER_STATES],
    """
SELECT CASE WHEN a.user_id IS NULL THEN 'only_in_a' WHEN b.user_id IS NULL THEN 'only_in_b'
            WHEN a.city = b.city AND a.updated_at = b.updated_at AND a.occupation = b.occupation
                 AND a.created_at = b.created_at THEN 'identical' ELSE 'changed' END AS status, COUNT(*) AS keys
FROM before b FULL JOIN after a ON a.user_id = b.user_id GROUP BY 1""",
)
ORACLES["compare_columns"] = sql(
    [
        STG_USERS, USER_STATES,
        """
paired AS (
  SELECT b.occupation = a.occupation AS occupation, b.city = a.city AS city, b.created_at = a.created_at AS created_at,
         b.updated_at = a.updated_at AS updated_at
  FROM before b JOIN after a ON a.user_id = b.user_id
)""",
    ],
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c}) AS matching, COUNT(*) FILTER (WHERE NOT {c}) AS differing FROM paired"
        for c in ("occupation", "city", "created_at", "updated_at")
    ),
)
ORACLES["compare_row_counts"] = sql(
    [STG_USERS, USER_STATES],
    """
SELECT (SELECT COUNT(*) FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM after)) AS only_in_a,
       (SELECT COUNT(*) FROM (SELECT * FROM after EXCEPT ALL SELECT * FROM before)) AS only_in_b""",
)


def _anomaly(by: str, metric: str, expression: str, sigmas: float, where: str = "TRUE", silent: str = "NULL") -> str:
    partition = f"PARTITION BY {by}" if by else ""
    comma = f"{by}, " if by else ""
    groups = f"(SELECT DISTINCT {by} FROM e)" if by else "(SELECT 1 AS one)"
    same = f"AND m.{by} = g.{by}" if by else ""
    return f"""
WITH e AS (SELECT * FROM events WHERE {where}),
days AS (SELECT CAST(unnest(generate_series((SELECT MIN(CAST(ts AS DATE)) FROM e), (SELECT MAX(CAST(ts AS DATE)) FROM e), INTERVAL 1 DAY)) AS DATE) AS day),
m AS (SELECT {comma}CAST(ts AS DATE) AS day, {expression} AS {metric} FROM e GROUP BY ALL),
filled AS (SELECT {f'g.{by}, ' if by else ''}days.day, coalesce(m.{metric}, {silent}) AS {metric}
           FROM {groups} g CROSS JOIN days LEFT JOIN m ON m.day = days.day {same})
SELECT {comma}day, {metric}, z_score, COALESCE(abs(z_score) > {sigmas}, FALSE) AS is_anomaly FROM (
  SELECT *, CASE WHEN COUNT({metric}) OVER w >= 7 AND stddev_samp({metric}) OVER w > 0
       THEN round(({metric} - AVG({metric}) OVER w) / stddev_samp({metric}) OVER w, 6) END AS z_score
  FROM filled
  WINDOW w AS ({partition} ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))"""


ORACLES["volume_anomaly"] = _anomaly("", "row_count", "COUNT(*)", 1.5, "day(ts) NOT IN (20, 21)", "0")
ORACLES["schema_anomaly"] = """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day, day(ts) AS n FROM events),
f AS (SELECT day, 'k' AS field_name, CASE WHEN n BETWEEN 10 AND 12 THEN 'string' ELSE 'bigint' END AS type FROM d
      UNION ALL SELECT day, 'channel', 'string' FROM d WHERE n >= 15
      UNION ALL SELECT day, 'value', 'double' FROM d WHERE n % 7 <> 0),
p AS (SELECT day, lag(day) OVER (ORDER BY day) AS before FROM (SELECT DISTINCT day FROM d) QUALIFY before IS NOT NULL),
names AS (SELECT DISTINCT field_name FROM f)
SELECT p.day, names.field_name,
       CASE WHEN o.type IS NULL THEN 'appeared' WHEN w.type IS NULL THEN 'vanished' ELSE 'retyped' END AS change,
       o.type AS old_type, w.type AS new_type
FROM p CROSS JOIN names
LEFT JOIN f o ON o.day = p.before AND o.field_name = names.field_name
LEFT JOIN f w ON w.day = p.day AND w.field_name = names.field_name
WHERE o.type IS DISTINCT FROM w.type"""
ORACLES["distribution_anomaly"] = _anomaly("event_type", "large_values", "COUNT(*) FILTER (WHERE value >= 100)", 2.0)
ORACLES["freshness_anomaly"] = _anomaly(
    "", "silent_seconds", "86400 - CAST(floor(epoch_us(MAX(ts)) // 1000000) AS BIGINT) % 86400", 1.5
)
ORACLES["dedup_staging_money"] = f"""
SELECT o_orderkey, CAST((CAST(round(o_totalprice * 100) AS BIGINT) + 1) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS amount,
       {AS_OF} AS loaded_at FROM orders"""
ORACLES["surrogate_keys"] = sql(
    [STG_USERS],
    f"""
SELECT user_id, {key('user_id', 'gender')} AS user_key,
       CASE WHEN user_id % 2 = 0 THEN {key("'x|=y'", "'z'")} ELSE {key("'x'", "'y|=z'")} END AS text_key FROM stg_users""",
)
ORACLES["stream_dedup"] = sql([STG_PURCHASES], "SELECT *, CAST(added_to_cart_at AS DATE) AS event_day FROM stg_purchases")

ORACLES["scd2_changelog"] = f"""
WITH last AS (
  SELECT user_id, ts, CASE WHEN event_type <> 'signup' THEN event_type END AS event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS r FROM events) WHERE r = 1),
steps AS (
  SELECT * FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS was FROM last)
  WHERE event_type IS DISTINCT FROM was),
periods AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until FROM steps)
SELECT user_id, event_type, ts AS valid_from, until AS valid_to, {key("user_id", "ts")} AS scd_id
FROM periods WHERE event_type IS NOT NULL"""

# Distances are exact here; what a sketch may be off decides nothing, since shifts stand far above the rest.
def _shift_pass(name: str, part: str) -> str:
    """One round of judging, against days for which ``part`` holds."""
    return f"""
{name}_pairs AS (SELECT d.day, d.n, r.day AS ref, r.n AS m FROM days d JOIN days r ON r.k BETWEEN d.k - 14 AND d.k - 1 AND {part}),
{name}_sizes AS (SELECT day, n, sum(m) AS m FROM {name}_pairs GROUP BY day, n),
{name}_steps AS (
  SELECT day, sum(own) OVER w AS a, sum(1 - own) OVER w AS b
  FROM (SELECT day, x, 1 AS own FROM v UNION ALL SELECT p.day, v.x, 0 FROM {name}_pairs p JOIN v ON v.day = p.ref)
  WINDOW w AS (PARTITION BY day ORDER BY x RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name}_distances AS (
  SELECT day, max(abs(a / n - b / m)) AS distance,
         greatest(0.1, sqrt(-ln(0.000001 / 2) / 2) * sqrt((n + m) / (n * m))) AS chance
  FROM {name}_steps JOIN {name}_sizes USING (day) GROUP BY day, n, m),
{name}_earlier AS (
  SELECT *, list(distance) OVER (ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS before
  FROM days LEFT JOIN {name}_distances USING (day)),
{name}_centers AS (SELECT *, list_median(list_filter(before, lambda d: d IS NOT NULL)) AS center FROM {name}_earlier),
{name} AS (
  SELECT day, coalesce(k > 7 AND distance > chance AND distance > coalesce(
           center + 6 * 1.4826 * list_median(list_transform(list_filter(before, lambda d: d IS NOT NULL), lambda d: abs(d - center))), 0),
         false) AS is_shift
  FROM {name}_centers)"""


ORACLES["distribution_shift"] = f"""
WITH v AS (
  SELECT CAST(ts AS DATE) AS day,
         CASE WHEN day(ts) NOT IN (18, 19, 25) THEN value WHEN event_id % 10 = 0 THEN 500.0 ELSE 0.0 END AS x
  FROM events),
days AS (SELECT day, count(*) AS n, row_number() OVER (ORDER BY day) AS k FROM v GROUP BY day),
{_shift_pass("one", "true")},
{_shift_pass("two", "r.day NOT IN (SELECT day FROM one WHERE is_shift)")}
SELECT day, n, is_shift FROM days JOIN two USING (day)"""


def _repeated(table: str, columns: str) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns.split(","))
    return f"""
SELECT '{table}' AS table_name, '{columns}' AS columns, count(*) AS failures, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count
FROM (SELECT count(*) AS n FROM {table} WHERE {present} GROUP BY {columns} HAVING count(*) > 1)"""


ORACLES["check_unique_two_pass"] = " UNION ALL ".join(
    _repeated(t, c)
    for t, c in [("orders", "o_orderkey"), ("lineitem", "l_orderkey,l_linenumber"), ("events", "user_id"), ("customer", "c_name")]
)

_VIEWS = [
    ("v_test_pass_rate_trend", "obs_pass_rate_trend", "passed"),
    ("v_test_results_by_model", "obs_results_by_model", "test_count"),
    ("v_model_execution_times", "obs_execution_times", "rows_affected"),
    ("v_invocation_history", "obs_invocation_history", "failed"),
    ("v_latest_test_failures", "obs_latest_failures", "failures"),
    ("v_test_coverage_by_model", "obs_test_coverage", "columns_tested"),
]
ORACLES["view_totals"] = " UNION ALL ".join(
    f"SELECT '{view}' AS view, count(*) AS row_count, CAST(sum({column}) AS BIGINT) AS total FROM ({ORACLES[report]})"
    for view, report, column in _VIEWS
)
ORACLES["unused_models_transitive"] = """
WITH RECURSIVE edges AS (
  SELECT DISTINCT user_id % 50 AS up, (user_id % 50 * 3 + 1) % 50 AS down FROM events WHERE event_type = 'click'),
used AS (
  SELECT DISTINCT event_id % 5 AS no FROM events WHERE event_type = 'view'
  UNION SELECT up FROM edges JOIN used ON down = no)
SELECT DISTINCT 'model_' || CAST(user_id % 50 AS VARCHAR) AS name FROM events WHERE user_id % 50 NOT IN (SELECT no FROM used)"""
ORACLES["incr_cursor_lookback"] = """
SELECT event_id, user_id, event_type, CASE WHEN event_id % 53 <> 0 THEN ts END AS ts
FROM events, range(1, 3) AS copies(c) WHERE c = 1 OR event_id % 10 = 0"""
ORACLES["stream_late_rows"] = ORACLES["stream_dedup"]
ORACLES["compare_differences"] = sql(
    [STG_USERS, USER_STATES],
    """
SELECT * FROM (
  SELECT coalesce(a.user_id, b.user_id) AS user_id,
         CASE WHEN b.user_id IS NULL THEN 'only_in_b' WHEN a.user_id IS NULL THEN 'only_in_a' ELSE 'changed' END AS status,
         CASE WHEN a.user_id IS NULL OR b.user_id IS NULL THEN '' ELSE concat_ws(',',
           CASE WHEN a.occupation IS DISTINCT FROM b.occupation THEN 'occupation' END,
           CASE WHEN a.city IS DISTINCT FROM b.city THEN 'city' END,
           CASE WHEN a.created_at IS DISTINCT FROM b.created_at THEN 'created_at' END,
           CASE WHEN a.updated_at IS DISTINCT FROM b.updated_at THEN 'updated_at' END) END AS columns
  FROM before b FULL JOIN after a ON a.user_id = b.user_id)
WHERE status <> 'changed' OR columns <> ''""",
)
