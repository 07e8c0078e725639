"""SQL text shared by the comparison queries: the sample tables, written out once more."""


def padded(column: str, width: int) -> str:
    """Zero padding that never cuts longer text."""
    text = f"CAST({column} AS VARCHAR)"
    return f"lpad({text}, greatest({width}, length({text}))::INTEGER, '0')"


EVENT_ROWS = """
event_rows AS (
  SELECT event_id AS n, user_id, event_type, value, ts,
         event_id % 17 = 0 AS broken,
         CASE WHEN event_id % 29 <> 0 THEN 'evt-' || event_id END AS sent_id,
         CASE WHEN event_id % 13 <> 0 THEN event_type END AS sent_city,
         CASE WHEN event_id % 11 = 0 THEN -value ELSE value END AS sent_temperature,
         CASE WHEN event_id % 19 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS sent_time,
         CASE event_id % 4 WHEN 0 THEN 'external_api' WHEN 1 THEN 'sensor_data'
                           WHEN 3 THEN 'other_feed' END AS sent_source
  FROM events
)"""

BRONZE = (
    EVENT_ROWS
    + """,
whole_payloads AS (
  SELECT *, '{' || concat_ws(',',
      '"event_id":"' || sent_id || '"',
      '"city":"' || sent_city || '"',
      '"latitude":' || (user_id % 200 - 100),
      '"longitude":' || (user_id * 3 % 400 - 200),
      '"temperature":' || sent_temperature,
      '"humidity":' || (user_id % 111),
      '"wind_speed":' || (n % 40),
      '"pressure":' || (user_id % 100 + 950),
      '"precipitation":0',
      '"cloud_cover":' || (n % 101),
      '"weather_condition":"' || event_type || '"',
      '"timestamp":"' || sent_time || '"',
      '"data_source":"' || sent_source || '"',
      '"cluster_id":"cluster-' || (user_id % 4) || '"',
      '"notebook_path":"/jobs/weather"') || '}' AS payload
  FROM event_rows
),
bronze AS (
  SELECT *,
         (user_id % 4) || '-' || n || '-' || CAST(floor(epoch(ts)) AS BIGINT) AS record_id,
         ts AS ingestion_timestamp,
         CAST(ts AS DATE) AS ingestion_date,
         CAST(hour(ts) AS INTEGER) AS ingestion_hour,
         CAST(user_id % 4 AS VARCHAR) AS log_partition,
         CAST(n AS VARCHAR) AS log_offset,
         CAST(floor(epoch(ts)) AS BIGINT) * 1000 AS log_sequence,
         ts AS log_enqueued_at,
         event_type AS log_partition_key,
         CASE WHEN broken THEN left(payload, length(payload) // 2) ELSE payload END AS raw_payload,
         CAST(strlen(CASE WHEN broken THEN left(payload, length(payload) // 2) ELSE payload END)
              AS INTEGER) AS payload_size_bytes
  FROM whole_payloads
)"""
)

READINGS = (
    EVENT_ROWS
    + """,
read_fields AS (
  SELECT n, user_id, ts, broken,
         (user_id % 4) || '-' || n || '-' || CAST(floor(epoch(ts)) AS BIGINT) AS source_record_id,
         CASE WHEN NOT broken THEN sent_id END AS event_id,
         CASE WHEN NOT broken THEN sent_city END AS city,
         CASE WHEN NOT broken THEN CAST(user_id % 200 - 100 AS DOUBLE) END AS latitude,
         CASE WHEN NOT broken THEN CAST(user_id * 3 % 400 - 200 AS DOUBLE) END AS longitude,
         CASE WHEN NOT broken THEN sent_temperature END AS temperature,
         CASE WHEN NOT broken THEN CAST(user_id % 111 AS DOUBLE) END AS humidity,
         CASE WHEN NOT broken THEN CAST(n % 40 AS DOUBLE) END AS wind_speed,
         CASE WHEN NOT broken THEN CAST(user_id % 100 + 950 AS DOUBLE) END AS pressure,
         CASE WHEN NOT broken THEN CAST(0 AS DOUBLE) END AS precipitation,
         CASE WHEN NOT broken THEN CAST(n % 101 AS DOUBLE) END AS cloud_cover,
         CASE WHEN NOT broken THEN event_type END AS weather_condition,
         CASE WHEN NOT broken AND sent_time IS NOT NULL THEN ts END AS weather_timestamp,
         CASE WHEN NOT broken THEN sent_source END AS data_source,
         CASE WHEN NOT broken THEN 'cluster-' || (user_id % 4) END AS weather_cluster_id
  FROM event_rows
),
readings AS (
  SELECT *,
         CASE WHEN event_id IS NOT NULL AND city IS NOT NULL AND temperature IS NOT NULL
                THEN 'SUCCESS'
              WHEN event_id IS NOT NULL OR city IS NOT NULL OR temperature IS NOT NULL
                THEN 'PARTIAL'
              ELSE 'FAILED' END AS parsing_status
  FROM read_fields
)"""
)

FILLED_READINGS = (
    READINGS
    + """,
filled AS (
  SELECT * REPLACE (
           coalesce(event_id, coalesce(city, 'unknown') || '-' ||
             CAST(floor(epoch(ts)) AS BIGINT)) AS event_id,
           coalesce(weather_timestamp, ts) AS weather_timestamp,
           coalesce(data_source, 'sensor_simulator') AS data_source)
  FROM readings
)"""
)

ORDER_ITEMS = f"""
joined AS (
  SELECT l.*, o.*, p.p_name, p.p_type,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(l.l_tax AS DECIMAL(4,2)) AS tax_rate,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount_rate,
         CASE WHEN l.l_orderkey % 23 = 0 THEN 1 ELSE 0 END AS defect
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey
),
totals AS (
  SELECT *, CAST(quantity * unit_price + defect AS DECIMAL(10,2)) AS total_amount FROM joined
),
order_items AS (
  SELECT l_orderkey, l_suppkey, defect, quantity, unit_price, total_amount,
         'ORD-' || {padded("l_orderkey", 6)} AS order_id,
         l_linenumber AS line_number,
         'PRD' || {padded("l_partkey", 3)} AS product_id,
         p_name AS product_name,
         p_type AS product_category,
         CASE WHEN l_orderkey % 31 = 0 THEN '' ELSE 'CUST-' || o_custkey END AS customer_id,
         'VEND-' || l_suppkey AS vendor_id,
         'WH-' || (l_suppkey % 5) AS warehouse_location,
         CASE WHEN l_suppkey % 7 = 0 THEN 'CHF' ELSE 'USD' END AS currency,
         'user' || o_custkey || CASE WHEN o_custkey % 29 = 0 THEN '@' ELSE '@example.com' END
           AS customer_email,
         CASE WHEN l_suppkey % 10 = 0 THEN 'Bay ' || l_suppkey
              ELSE l_suppkey || ' Harbour Road' END AS shipping_address,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PROCESSING' ELSE 'NEW' END
           AS order_status,
         CASE l_returnflag WHEN 'R' THEN 'REFUNDED' WHEN 'A' THEN 'PAID' ELSE 'PENDING' END
           AS payment_status,
         o_orderdate AS order_date,
         l_shipdate AS ship_date,
         l_shipdate AS timestamp,
         o_orderdate AS created_at,
         CAST(total_amount * tax_rate AS DECIMAL(10,2)) AS tax_amount,
         CAST(total_amount * discount_rate AS DECIMAL(10,2)) AS discount_amount,
         CAST(discount_rate * 100 AS DECIMAL(5,2)) AS discount_percentage,
         CAST(CASE WHEN total_amount > 500 THEN 0 ELSE 10 END AS DECIMAL(10,2)) AS shipping_cost
  FROM totals
)"""

NET_ORDERS = (
    ORDER_ITEMS
    + """,
net_orders AS (
  SELECT * REPLACE (CAST(quantity * unit_price - discount_amount + tax_amount + shipping_cost
                         + defect AS DECIMAL(10,2)) AS total_amount)
  FROM order_items
)"""
)

EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# The twenty order rules: name, criticality, category, condition, reason.
ORDER_RULES = [
    (
        "total_amount_calculation_valid",
        "error",
        "critical",
        "abs(total_amount - quantity * unit_price) <= 0.01",
        "total_amount differs from quantity times unit_price",
    ),
    ("quantity_positive", "error", "critical", "quantity > 0", None),
    ("unit_price_positive", "error", "critical", "unit_price > 0", None),
    ("total_amount_positive", "error", "critical", "total_amount > 0", None),
    ("order_id_not_null", "error", "critical", "trim(order_id) <> ''", None),
    ("product_id_not_null", "error", "critical", "trim(product_id) <> ''", None),
    ("customer_id_not_null", "error", "critical", "trim(customer_id) <> ''", None),
    ("order_date_not_null", "error", "critical", "order_date IS NOT NULL", None),
    (
        "tax_amount_valid",
        "error",
        "critical",
        "tax_amount >= 0 AND tax_amount <= total_amount * 0.3",
        "tax is outside 0 to 30 percent of the total",
    ),
    (
        "order_status_valid",
        "warn",
        "high",
        "order_status IN ('NEW','PROCESSING','SHIPPED','DELIVERED','CANCELLED','RETURNED')",
        None,
    ),
    (
        "payment_status_valid",
        "warn",
        "high",
        "payment_status IN ('PENDING','PAID','REFUNDED','FAILED','PARTIAL')",
        None,
    ),
    (
        "payment_order_status_consistency",
        "warn",
        "high",
        "(order_status = 'DELIVERED' AND payment_status = 'PAID')"
        " OR (order_status = 'CANCELLED' AND payment_status IN ('REFUNDED','FAILED','PENDING'))"
        " OR (order_status IN ('NEW','PROCESSING','SHIPPED')"
        " AND payment_status IN ('PENDING','PAID'))"
        " OR (order_status = 'RETURNED' AND payment_status = 'REFUNDED')",
        "payment state does not fit the order state",
    ),
    (
        "shipping_address_complete",
        "warn",
        "high",
        "length(shipping_address) >= 10",
        "shipping address is missing or short",
    ),
    ("order_id_format", "warn", "medium", "regexp_matches(order_id, '^ORD-[0-9]{6}$')", None),
    ("product_id_format", "warn", "medium", "regexp_matches(product_id, '^PRD[0-9]{3}$')", None),
    ("customer_email_format", "warn", "medium", f"regexp_matches(customer_email, '{EMAIL}')", None),
    ("quantity_reasonable_range", "warn", "low", "quantity <= 1000", None),
    ("unit_price_reasonable_range", "warn", "low", "unit_price <= 50000", None),
    ("order_date_not_future", "warn", "low", "order_date <= TIMESTAMP '2001-08-01 00:00:00'", None),
    (
        "discount_percentage_valid",
        "warn",
        "low",
        "discount_percentage BETWEEN 0 AND 100",
        None,
    ),
]


def flag_columns(rules, names=None) -> str:
    """One 0/1 column per rule."""
    return ",\n         ".join(
        f"CAST(coalesce({rule[3]}, false) AS INTEGER) AS {rule[0]}"
        for rule in rules
        if names is None or rule[0] in names
    )


def _ok(rules, criticality=None) -> str:
    return " AND ".join(
        f"{rule[0]} = 1" for rule in rules if criticality in (None, rule[1])
    )


def validated(source: str, rules, name: str = "validated") -> str:
    """Rule flags and the quality columns derived from them."""
    failed = " + ".join(f"(1 - {rule[0]})" for rule in rules)
    reasons = ", ".join(
        f"CASE WHEN {rule[0]} = 0 THEN '{rule[4] or rule[0]}' END" for rule in rules
    )
    results = ", ".join(f"CASE WHEN {rule[0]} = 0 THEN '{rule[0]}' END" for rule in rules)
    warn_ok = _ok(rules, "warn") or "true"
    return f"""
{name}_rules AS (
  SELECT *, {flag_columns(rules)}
  FROM {source}
),
{name}_counts AS (
  SELECT *, CAST({failed} AS INTEGER) AS failed_rules FROM {name}_rules
),
{name} AS (
  SELECT *,
         {len(rules)} - failed_rules AS passed_rules,
         ({len(rules)} - failed_rules) / CAST({len(rules)} AS DOUBLE) AS quality_score,
         CASE WHEN NOT ({_ok(rules, "error")}) THEN 'FAIL'
              WHEN NOT ({warn_ok}) THEN 'WARNING' ELSE 'PASS' END AS quality_flag,
         CASE WHEN NOT ({_ok(rules, "error")}) THEN 'error'
              WHEN NOT ({warn_ok}) THEN 'warn' END AS criticality,
         CASE WHEN failed_rules > 0 THEN concat_ws('; ', {reasons}) END AS failure_reason,
         CASE WHEN failed_rules > 0 THEN concat_ws('; ', {results})
              ELSE 'All rules passed' END AS rule_results
  FROM {name}_counts
)"""


VALIDATED = ORDER_ITEMS + "," + validated("order_items", ORDER_RULES)

# The fourteen rules for weather readings.
WEATHER_RULES = [
    ("event_id_not_null", "error", "critical", "trim(event_id) <> ''", None),
    ("city_not_null", "error", "critical", "trim(city) <> ''", None),
    ("weather_timestamp_not_null", "error", "critical", "weather_timestamp IS NOT NULL", None),
    ("temperature_is_numeric", "warn", "high", "temperature IS NOT NULL", None),
    ("humidity_is_numeric", "warn", "high", "humidity IS NOT NULL", None),
    ("latitude_is_numeric", "warn", "high", "latitude IS NOT NULL", None),
    ("longitude_is_numeric", "warn", "high", "longitude IS NOT NULL", None),
    ("temperature_realistic_range", "warn", "medium", "temperature BETWEEN -60 AND 60", None),
    ("humidity_valid_percentage", "warn", "medium", "humidity BETWEEN 0 AND 100", None),
    ("latitude_valid_range", "warn", "medium", "latitude BETWEEN -90 AND 90", None),
    ("longitude_valid_range", "warn", "medium", "longitude BETWEEN -180 AND 180", None),
    ("city_name_format", "warn", "medium", "length(city) BETWEEN 2 AND 50", None),
    (
        "data_source_valid",
        "warn",
        "medium",
        "data_source IN ('sensor_simulator','external_api','sensor_data')",
        None,
    ),
    (
        "timestamp_not_future",
        "error",
        "critical",
        "weather_timestamp <= TIMESTAMP '2024-01-31 00:00:00'",
        None,
    ),
]

VALIDATED_READINGS = FILLED_READINGS + "," + validated("filled", WEATHER_RULES)
