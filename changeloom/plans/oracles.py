"""The contract queries as plain SQL over the given tables."""

from __future__ import annotations

TEXT_TIME = "'%Y-%m-%d %H:%M:%S.%f'"
DAY = "substr(last_modified_ts, 1, 10)"

# Names and order of the columns are the data contract.
COLUMNS = {
    "transactions": (
        "transaction_id, user_id, product_id, payment_id, shipping_id, "
        "quantity, discount, last_modified_ts, status"
    ),
    "users": (
        "user_id, full_name, phone_number, sex, address, birthdate, email, job, "
        "last_modified_ts, status"
    ),
    "products": (
        "product_id, product_name, category, unit_price, merchant_name, rating, "
        "last_modified_ts, status"
    ),
    "payments": "payment_id, payment_method, currency, last_modified_ts, status",
    "shippings": (
        "shipping_id, shipping_address, shipping_cost, shipping_status, status, last_modified_ts"
    ),
    "events": "event_id, user_id, event_type, value, last_modified_ts",
}

KEYS = {
    "transactions": "transaction_id",
    "users": "user_id",
    "products": "product_id",
    "payments": "payment_id",
    "shippings": "shipping_id",
    "events": "event_id",
}

# Every message of an entity as columns, with its log position and fault number.
FEEDS = {
    "transactions": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS transaction_id,
               CAST(o_custkey AS VARCHAR) AS user_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               o_orderpriority AS payment_id,
               concat_ws('-', l_orderkey, l_linenumber) AS shipping_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(round(l_discount * 100) AS INTEGER) AS discount,
               strftime(l_shipdate, {TEXT_TIME}) AS last_modified_ts,
               'INSERT' AS status,
               l_partkey * 1000000 + l_suppkey AS off,
               l_partkey % 20 AS fault
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "shippings": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS shipping_id,
               concat('ADDR-', l_suppkey) AS shipping_address,
               CAST(round(l_tax * 100) AS FLOAT) AS shipping_cost,
               CASE l_returnflag WHEN 'A' THEN 'Delivered' WHEN 'N' THEN 'In-Transit'
                                 ELSE 'Delay' END AS shipping_status,
               'INSERT' AS status,
               strftime(l_shipdate, {TEXT_TIME}) AS last_modified_ts,
               l_partkey * 1000000 + l_suppkey AS off,
               l_partkey % 20 AS fault
        FROM lineitem""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               p_name AS product_name,
               p_type AS category,
               CAST(p_retailprice + version - 1 AS FLOAT) AS unit_price,
               p_brand AS merchant_name,
               CAST(p_size / 10.0 AS FLOAT) AS rating,
               concat('2024-01-0', version, ' 00:00:00.000000') AS last_modified_ts,
               CASE version WHEN 2 THEN 'UPDATE' ELSE 'INSERT' END AS status,
               version AS off,
               99 AS fault
        FROM (SELECT *, 1 AS version FROM part
              UNION ALL
              SELECT *, 2 AS version FROM part WHERE p_partkey % 10 = 0)""",
    "users": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id,
               c_name AS full_name,
               CAST(NULL AS VARCHAR) AS phone_number,
               CAST(NULL AS VARCHAR) AS sex,
               n_name AS address,
               CAST(NULL AS VARCHAR) AS birthdate,
               concat(c_custkey, '@example.com') AS email,
               CASE version WHEN 2 THEN 'RETIRED' ELSE c_mktsegment END AS job,
               concat('2024-01-0', version, ' 00:00:00.000000') AS last_modified_ts,
               CASE version WHEN 2 THEN 'UPDATE' ELSE 'INSERT' END AS status,
               version AS off,
               99 AS fault
        FROM (SELECT *, 1 AS version FROM customer
              UNION ALL
              SELECT *, 2 AS version FROM customer WHERE c_custkey % 10 = 0)
        JOIN nation ON c_nationkey = n_nationkey""",
    "payments": """
        SELECT DISTINCT o_orderpriority AS payment_id,
               o_orderpriority AS payment_method,
               'USD' AS currency,
               '2024-01-01 00:00:00.000000' AS last_modified_ts,
               'INSERT' AS status,
               0 AS off,
               99 AS fault
        FROM orders""",
    "events": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               CAST(user_id AS VARCHAR) AS user_id,
               event_type,
               value,
               strftime(ts, {TEXT_TIME}) AS last_modified_ts,
               event_id AS off,
               event_id % 20 AS fault
        FROM events""",
}


def _good(name: str) -> str:
    return f"(SELECT {COLUMNS[name]}, off FROM ({FEEDS[name]}) AS feed WHERE fault > 4)"


def _current(name: str, key: str | None = None) -> str:
    key = key or KEYS[name]
    return f"""(
        SELECT {COLUMNS[name]} FROM (
            SELECT *, row_number() OVER (
                PARTITION BY {key} ORDER BY last_modified_ts DESC, off DESC) AS newest
            FROM {_good(name)} AS good
        ) AS ranked WHERE newest = 1)"""


def _json(columns: list[str]) -> str:
    # A 32-bit number stands in its shortest text.
    short = {c: f"CAST(CAST({c} AS VARCHAR) AS DOUBLE)" for c in ("rating", "unit_price")}
    pairs = ", ".join(f"'{c}', {short.get(c, c)}" for c in columns)
    return f"CAST(json_object({pairs}) AS VARCHAR)"


def _image(name: str, without_key: bool = False) -> str:
    columns = COLUMNS[name].split(", ")
    return _json([c for c in columns if not (without_key and c == KEYS[name])])


def _dead_letters(name: str) -> str:
    return f"""
        SELECT CASE fault WHEN 1 THEN {_image(name, without_key=True)}
                          ELSE substr({_image(name)}, 1, 20) END AS raw_value,
               '{name}' AS entity
        FROM ({FEEDS[name]}) AS feed WHERE fault IN (1, 2)"""


def _routes(name: str) -> str:
    return f"""
        SELECT CASE WHEN fault IN (0, 3, 4) THEN 'dropped'
                    WHEN fault IN (1, 2) THEN 'dead_letter' ELSE 'good' END AS route,
               count(*) AS messages,
               '{name}' AS entity
        FROM ({FEEDS[name]}) AS feed GROUP BY 1"""


def _retained(name: str) -> str:
    return f"""SELECT {COLUMNS[name]}, {DAY} AS date FROM {_current(name)} AS latest
               WHERE CAST({DAY} AS DATE) > DATE '2001-11-04' - 3"""


def _key_values(name: str) -> str:
    # Fields without a value are left out of the JSON.
    empty = ("phone_number", "sex", "birthdate") if name == "users" else ()
    pairs = [c for c in COLUMNS[name].split(", ") if c not in empty] + ["date"]
    return f"""SELECT {KEYS[name]} AS key, {_json(pairs)} AS value
               FROM (SELECT *, {DAY} AS date FROM {_good(name)} AS good)
                    AS dated"""


def _serving(name: str, columns: str) -> str:
    return f"""SELECT {columns}, {DAY} AS date
               FROM {_current(name)} AS latest"""


# A seventh of the transactions has times without a fraction, hence no date.
UNDATED = f"""(
    SELECT * REPLACE (CASE WHEN off // 1000000 % 7 = 0 THEN substr(last_modified_ts, 1, 19)
                           ELSE last_modified_ts END AS last_modified_ts)
    FROM {_good("transactions")} AS good)"""

LAST_SEEN = _current("events", "user_id")
DAMAGED = ("transactions", "shippings", "events")


def _published(name: str) -> str:
    return f"""
    SELECT 'archive' AS output, {KEYS[name]} AS content FROM {_good(name)} AS good
    UNION ALL SELECT 'key_value', value FROM ({_key_values(name)}) AS records
    UNION ALL SELECT 'dead_letter', raw_value FROM ({_dead_letters(name)}) AS dead"""


PUBLISHED = _published("events")

ORACLES = {
    "cdc_after": f"""
        SELECT CASE fault WHEN 1 THEN {_image("transactions", without_key=True)}
                          WHEN 2 THEN substr({_image("transactions")}, 1, 20)
                          ELSE {_image("transactions")} END AS after
        FROM ({FEEDS["transactions"]}) AS feed WHERE fault NOT IN (0, 3, 4)""",
    **{
        f"cdc_good_{name}": f"SELECT {COLUMNS[name]} FROM {_good(name)} AS good"
        for name in ("users", "products", "payments", "transactions", "shippings")
    },
    "cdc_dead_letter": " UNION ALL ".join(_dead_letters(name) for name in DAMAGED),
    "cdc_dead_letter_envelope": " UNION ALL ".join(
        f"""{_dead_letters(name)} UNION ALL
        SELECT '{{"payload":' AS raw_value, '{name}' AS entity
        FROM ({FEEDS[name]}) AS feed WHERE fault = 3"""
        for name in DAMAGED
    ),
    "cdc_route_counts": " UNION ALL ".join(f"({_routes(name)})" for name in DAMAGED),
    "cdc_date": f"""
        SELECT event_id, last_modified_ts,
               CAST(CAST(try_strptime(last_modified_ts, {TEXT_TIME}) AS DATE) AS VARCHAR) AS date
        FROM (SELECT event_id,
                     CASE event_type WHEN 'error' THEN substr(last_modified_ts, 1, 19)
                                     ELSE last_modified_ts END AS last_modified_ts
              FROM {_good("events")} AS good) AS uneven""",
    "cdc_kv": _key_values("transactions"),
    "serving_ingest": f"""
        SELECT product_id, product_name, category, merchant_name, status, unit_price, rating,
               last_modified_ts, {DAY} AS date
        FROM {_good("products")} AS good""",
    "serving_projection": _serving(
        "shippings", "shipping_id, shipping_address, status, shipping_cost, last_modified_ts"
    ),
    "serving_null_defaults": _serving(
        "users",
        "user_id, full_name, coalesce(phone_number, 'null') AS phone_number, "
        "coalesce(sex, 'null') AS sex, address, email, job, status, "
        "coalesce(birthdate, 'null') AS birthdate, last_modified_ts",
    ),
    "serving_table": f"""
        SELECT {COLUMNS["events"]}, {DAY} AS date FROM {LAST_SEEN} AS latest""",
    "serving_table_ties": f"""
        SELECT event_id, user_id, event_type, value, concat({DAY}, ' 00:00:00.000000')
               AS last_modified_ts, {DAY} AS date
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY user_id ORDER BY {DAY} DESC, off DESC) AS newest
              FROM {_good("events")} AS good) AS ranked WHERE newest = 1""",
    "status_stamp": f"""
        SELECT transaction_id, user_id, product_id, payment_id, shipping_id, quantity, discount,
               last_modified_ts, off,
               CASE WHEN version > 1 THEN 'UPDATED' ELSE status END AS status
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY transaction_id ORDER BY last_modified_ts, off) AS version
              FROM {_good("transactions")} AS good) AS numbered""",
    **{
        f"upsert_{name}": f"SELECT {COLUMNS[name]} FROM {_current(name)} AS latest"
        for name in ("users", "products", "payments", "transactions", "shippings")
    },
    "retention_transactions": _retained("transactions"),
    "retention_shippings": _retained("shippings"),
    "layout_sorted": f"""
        SELECT {COLUMNS["transactions"]}, {DAY} AS date
        FROM {_current("transactions")} AS latest""",
    "layout_bloom": f"""
        SELECT {COLUMNS["users"]} FROM {_current("users")} AS latest WHERE user_id = '7'""",
    "q_point_lookup": f"""
        SELECT {COLUMNS["products"]} FROM {_current("products")} AS latest
        WHERE product_id = '10'""",
    "q_user_lookup": f"""
        SELECT {COLUMNS["transactions"]} FROM {_current("transactions")} AS latest
        WHERE user_id = '7'""",
    "q_filter_status": f"""
        SELECT {COLUMNS["products"]} FROM {_current("products")} AS latest
        WHERE status = 'UPDATE'""",
    "q_filter_keys": f"""
        SELECT {COLUMNS["transactions"]} FROM {_current("transactions")} AS latest
        WHERE user_id IN ('3', '7', '42') AND status = 'INSERT'""",
    "q_recent": f"""
        SELECT {COLUMNS["transactions"]} FROM {_current("transactions")} AS latest
        WHERE last_modified_ts BETWEEN '1996-01-01 00:00:00.000000'
                                   AND '2000-12-31 23:59:59.999999'
        ORDER BY last_modified_ts DESC, transaction_id DESC LIMIT 100""",
    "q_metrics_by_dim": f"""
        SELECT payment_id, status, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
               avg(discount) AS avg_discount, min(quantity) AS min_quantity,
               max(quantity) AS max_quantity
        FROM {_current("transactions")} AS latest GROUP BY payment_id, status""",
    "q_product_metrics": f"""
        SELECT category, count(*) AS products,
               CAST(sum(CAST(round(CAST(unit_price AS DOUBLE) * 100) AS BIGINT)) AS BIGINT)
                   AS price_cents,
               min(unit_price) AS min_price, max(unit_price) AS max_price,
               max(rating) AS max_rating
        FROM {_current("products")} AS latest GROUP BY category""",
    "q_shipping_metrics": f"""
        SELECT shipping_status, count(*) AS shippings,
               CAST(sum(CAST(round(CAST(shipping_cost AS DOUBLE) * 100) AS BIGINT)) AS BIGINT)
                   AS cost_cents,
               max(shipping_cost) AS max_cost
        FROM {_current("shippings")} AS latest GROUP BY shipping_status""",
    "q_daily": f"""
        SELECT {DAY} AS date, count(*) AS orders,
               CAST(sum(quantity) AS BIGINT) AS units, avg(discount) AS avg_discount
        FROM {_current("transactions")} AS latest GROUP BY 1""",
    "q_sql": f"""
        SELECT p.merchant_name, count(*) AS orders, CAST(sum(t.quantity) AS BIGINT) AS units
        FROM {_current("transactions")} AS t
        LEFT JOIN {_current("products")} AS p ON t.product_id = p.product_id
        GROUP BY p.merchant_name""",
    "q_star_revenue": f"""
        SELECT category, job, payment_method, shipping_status,
               count(*) AS orders,
               CAST(sum(quantity) AS BIGINT) AS units,
               CAST(sum(CAST(round(CAST(unit_price AS DOUBLE) * 100) AS BIGINT)
                        * quantity * (100 - discount)) AS BIGINT) AS revenue,
               CAST(sum(CAST(round(CAST(shipping_cost AS DOUBLE) * 100) AS BIGINT)) AS BIGINT)
                   AS shipping_cents
        FROM {_current("transactions")} AS t
        LEFT JOIN {_current("products")} AS p ON t.product_id = p.product_id
        LEFT JOIN {_current("payments")} AS m ON t.payment_id = m.payment_id
        LEFT JOIN {_current("users")} AS u ON t.user_id = u.user_id
        LEFT JOIN {_current("shippings")} AS s ON t.shipping_id = s.shipping_id
        GROUP BY category, job, payment_method, shipping_status""",
    "stream_cdc_source": f"SELECT {COLUMNS['events']} FROM {_good('events')} AS good",
    "stream_kv_sink": _key_values("events"),
    "stream_archive": f"""
        SELECT {COLUMNS["events"]}, off, {DAY} AS date
        FROM {_good("events")} AS good""",
    "stream_dlq": _dead_letters("events"),
    "archive_replay": f"""
        SELECT {COLUMNS["events"]}, {DAY} AS date
        FROM {LAST_SEEN} AS latest""",
    "stream_upsert": f"""
        SELECT {COLUMNS["events"]}, {DAY} AS date
        FROM {LAST_SEEN} AS latest""",
    "stream_upsert_transactions": _retained("transactions"),
    "stream_upsert_undated": f"""
        SELECT {COLUMNS["transactions"]}, {DAY} AS date, batches
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY transaction_id
                  ORDER BY CAST(last_modified_ts AS TIMESTAMP) DESC, last_modified_ts DESC, off DESC
              ) AS newest FROM {UNDATED} AS changes) AS ranked,
             (VALUES ('thirds'), ('halves')) AS b(batches)
        WHERE newest = 1 AND length(last_modified_ts) > 19
          AND CAST({DAY} AS DATE) > DATE '2001-11-04' - 3""",
    "archive_merged": f"""
        SELECT {COLUMNS["events"]}, off, {DAY} AS date FROM {_good("events")} AS good
        WHERE {DAY} >= '2024-01-10' AND {DAY} < '2024-01-20'""",
    "stream_fanout": PUBLISHED,
    **{
        f"stream_fanout_{name}": _published(name)
        for name in ("users", "products", "payments", "transactions", "shippings")
    },
    "stream_fresh_checkpoint": PUBLISHED,
    "stream_mode_switch": PUBLISHED,
    "stream_restart": PUBLISHED,
    "stream_progress": """
        SELECT 'events-history' AS query, count(*) AS input_rows FROM events""",
}

# What a live, a segmented or an indexed table gives is what its batch form gives.
ORACLES |= {
    live: ORACLES[batch]
    for live, batch in (
        ("q_star_colocated", "q_star_revenue"),
        ("stream_upsert_segments", "stream_upsert_undated"),
        ("serving_live", "serving_table"),
        ("status_live", "status_stamp"),
        ("rollup_live_daily", "q_daily"),
        ("rollup_live_metrics", "q_metrics_by_dim"),
        *((f"{name}_indexed", name) for name in ("q_point_lookup", "q_user_lookup", "q_filter_keys", "q_recent")),
    )
}
