"""The same reports in plain SQL over the order and event tables, for cross-checks.

Written against the flat input tables, independent of the Spark code: order lines are
joined directly, sessions come from a gap window over events, and pairs from self-joins.
"""

import re

from souk.schemas import BROWSERS, DEVICE_TYPES, PAYMENT_METHODS, REFERRERS
from souk.sources.warehouse import OPERATING_SYSTEMS


def _pick(values: tuple[str, ...], index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


def _id(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}_' || lpad(CAST({number} AS VARCHAR), {width}, '0')"


def _round(value: str, scale: int = 2) -> str:
    """Round half up on the decimal digits of a double."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {scale}) AS DOUBLE)"


def _money(value: str) -> str:
    return f"CAST(round({value}, 2) AS DOUBLE)"


def _ratio(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)"


def _units(value: str) -> str:
    """A count or amount in ten-thousandths, as a whole number."""
    return f"CAST(CAST({value} AS DECIMAL(38,4)) * 10000 AS HUGEINT)"


def _mean(total: str, count: str, scale: int = 2, factor: int = 1) -> str:
    """``factor * total / count`` rounded half up in whole numbers, for amounts from 0."""
    digits = 10**scale
    parts, whole = f"({_units(total)} * {factor * digits})", f"nullif({_units(count)}, 0)"
    return f"CAST((2 * {parts} + {whole}) // (2 * {whole}) AS DOUBLE) / {digits}"


def _pct(part: str, whole: str, scale: int = 2) -> str:
    return _mean(part, whole, scale, 100)


def _big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


ISO = "'%Y-%m-%dT%H:%M:%S'"
PAID = "status IN ('completed', 'shipped')"

CTES = {
    "u": f"""
        SELECT {_id("user", "c_custkey", 9)} AS user_id, n_name AS city, r_name AS state, 'RW' AS country,
               TIMESTAMP '1994-10-01 00:00:00' + to_days(CAST(c_custkey % 92 AS INTEGER))
                   + to_hours(CAST(c_custkey % 24 AS INTEGER)) AS reg,
               TIMESTAMP '1994-10-01 00:00:00' + to_days(CAST(c_custkey % 92 + 30 + c_custkey % 61 AS INTEGER))
                   + to_hours(CAST(c_custkey % 24 AS INTEGER)) AS act
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "p": f"""
        SELECT {_id("prod", "p_partkey", 9)} AS product_id, p_name AS name, 'cat_' || p_type AS category_id,
               'sub_' || p_type || '_' || p_brand AS subcategory_id, p_type || ' goods' AS category_name,
               p_brand AS subcategory_name, CAST(p_retailprice AS DECIMAL(12,2)) AS base_price,
               p_partkey % 50 AS current_stock, p_partkey % 50 > 0 AS is_active,
               strftime(TIMESTAMP '1994-01-01' + to_days(CAST(p_partkey % 270 AS INTEGER)), {ISO}) AS creation_date
        FROM part""",
    "t": f"""
        SELECT o_orderkey AS k, {_id("txn", "o_orderkey", 12)} AS transaction_id,
               {_id("sess", "o_orderkey // 2", 10)} AS session_id, {_id("user", "o_custkey", 9)} AS user_id,
               o_orderdate AS ts, strftime(o_orderdate, {ISO}) AS timestamp,
               CASE WHEN o_orderkey % 7 = 0 THEN 'refunded' WHEN o_orderstatus = 'F' THEN 'completed'
                    WHEN o_orderstatus = 'O' THEN 'shipped' WHEN o_orderstatus = 'P' THEN 'processing' END AS status,
               {_pick(PAYMENT_METHODS, "CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1")} AS payment_method,
               coalesce(s, 0) AS subtotal, coalesce(d, 0) AS discount,
               coalesce(s, 0) - coalesce(d, 0) AS total, coalesce(n, 0) AS item_count
        FROM orders LEFT JOIN (
            SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s, count(*) AS n,
                   sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS d
            FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "l": f"""
        SELECT transaction_id, user_id, ts, timestamp, status, payment_method, l_linenumber AS line_number,
               {_id("prod", "l_partkey", 9)} AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS subtotal,
               CAST({_mean("l_extendedprice", "l_quantity")} AS DECIMAL(18,2)) AS unit_price
        FROM lineitem JOIN t ON l_orderkey = k""",
    "e0": """
        SELECT event_id, ts, user_id AS uid, event_type, value,
               CASE WHEN event_type IN ('view', 'click', 'purchase')
                    THEN 'prod_' || lpad(props->>'$.k', 9, '0') END AS product_id,
               CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 21600000000
                    THEN 1 ELSE 0 END AS starts
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "e1": "SELECT *, sum(starts) OVER (PARTITION BY uid ORDER BY ts, event_id) AS visit FROM e0",
    "e": """
        SELECT *, first_value(event_id) OVER (PARTITION BY uid, visit ORDER BY ts, event_id) AS first_id FROM e1""",
    "s": f"""
        SELECT first_id, {_id("sess", "first_id", 10)} AS session_id, {_id("user", "uid", 9)} AS user_id,
               min(ts) AS started_at, max(ts) AS ended_at, strftime(min(ts), {ISO}) AS start_time,
               strftime(max(ts), {ISO}) AS end_time, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS duration_seconds,
               {_pick(DEVICE_TYPES, "uid % 3")} AS device_type, {_pick(OPERATING_SYSTEMS, "uid % 4")} AS os,
               {_pick(BROWSERS, "uid % 4")} AS browser, {_pick(REFERRERS, "first_id % 7")} AS referrer,
               CASE WHEN bool_or(event_type = 'purchase') THEN 'converted'
                    WHEN bool_or(event_type = 'click') THEN 'abandoned' ELSE 'browsing' END AS conversion_status,
               count(*) AS page_view_count,
               bool_or(event_type = 'view' AND product_id IS NOT NULL) AS has_viewed_product,
               bool_or(event_type IN ('click', 'purchase') AND product_id IS NOT NULL) AS has_cart,
               count(DISTINCT CASE WHEN event_type IN ('click', 'purchase') THEN product_id END) AS cart_size,
               coalesce(string_agg(DISTINCT CASE WHEN event_type = 'view' THEN product_id END, ','
                   ORDER BY CASE WHEN event_type = 'view' THEN product_id END), '') AS viewed_products
        FROM e GROUP BY first_id, uid""",
    "c": f"""
        SELECT {_id("sess", "first_id", 10)} AS session_id, product_id, count(*) AS quantity
        FROM e WHERE event_type IN ('click', 'purchase') AND product_id IS NOT NULL GROUP BY ALL""",
    "ct": """
        SELECT c.*, s.user_id, s.started_at, s.end_time, s.conversion_status, p.base_price AS price
        FROM c JOIN s USING (session_id) LEFT JOIN p USING (product_id)""",
    "v": f"""
        SELECT {_id("user", "user_id", 9)} AS user_id, ts, {_id("prod", "props->>'$.k'", 9)} AS product_id,
               CAST(floor(value) AS BIGINT) AS view_duration
        FROM events WHERE event_type = 'view' AND props->>'$.k' IS NOT NULL""",
    "keyed": """
        SELECT user_id || '#' || CAST(9223372036854775807 - epoch_us(started_at) // 1000 AS VARCHAR) AS row_key, s.*,
               city, state FROM s LEFT JOIN (SELECT user_id, city, state FROM u) USING (user_id)
        QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY session_id DESC) = 1""",
    "busy": "SELECT user_id FROM s GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1",
    "paid_t": f"SELECT * FROM t WHERE {PAID}",
    "paid_l": f"SELECT * FROM l WHERE {PAID}",
    "sp": "SELECT session_id, count(*) AS orders, sum(total) AS revenue FROM paid_t GROUP BY session_id",
    "os": "SELECT user_id, count(*) AS n, sum(total) AS spend FROM paid_t GROUP BY user_id",
    "rt": """
        SELECT transaction_id, CASE WHEN k % 101 <> 0 THEN user_id END AS user_id,
               CASE WHEN k % 83 = 0 THEN TIMESTAMP '2026-03-07' ELSE ts END AS ts,
               CASE WHEN k % 103 = 0 THEN 'unknown' ELSE status END AS status, subtotal, discount,
               CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN -total ELSE total END AS total
        FROM t""",
    "rs": """
        SELECT session_id, user_id,
               CASE WHEN first_id % 11 = 0 THEN 0 WHEN first_id % 13 = 0 THEN NULL ELSE page_view_count END AS views,
               CASE WHEN first_id % 17 = 0 OR first_id % 19 = 0 THEN 'unknown' ELSE referrer END AS referrer,
               CASE WHEN first_id % 29 = 0 THEN 'browsing' ELSE conversion_status END AS conversion_status,
               CASE WHEN first_id % 31 = 0 THEN 0 ELSE duration_seconds END AS duration_seconds
        FROM s""",
    "months": f"""
        SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n, sum(total) AS total, sum(discount) AS discount,
               sum(subtotal) AS subtotal FROM paid_t GROUP BY 1""",
    "cohorts": f"""
        SELECT strftime(reg, '%Y-%m') AS cohort,
               (year(ts) - year(reg)) * 12 + month(ts) - month(reg) AS month_offset,
               count(DISTINCT user_id) AS users, sum(total) AS spend, count(*) AS orders
        FROM paid_t JOIN u USING (user_id) GROUP BY 1, 2""",
    "ss": """
        SELECT user_id, count(*) AS sessions, sum(duration_seconds) AS duration,
               count(*) FILTER (conversion_status = 'converted') AS converted FROM s GROUP BY user_id""",
    "cl0": """
        SELECT user_id, n, spend,
               CAST(spend AS DOUBLE) / CASE WHEN u.user_id IS NULL THEN 3 ELSE greatest(1,
                   floor(floor(epoch(TIMESTAMP '2002-01-01' - reg) / 86400) / 30)) END AS monthly,
               CAST(coalesce(converted, 0) AS DOUBLE) / greatest(1, coalesce(sessions, 0)) AS conv,
               CAST(coalesce(duration, 0) AS DOUBLE) / greatest(1, coalesce(sessions, 0)) AS dur
        FROM os LEFT JOIN ss USING (user_id) LEFT JOIN u USING (user_id)""",
    "purchases": "SELECT DISTINCT user_id AS basket, product_id AS item FROM l WHERE status = 'completed'",
    "views": "SELECT DISTINCT first_id AS basket, product_id AS item FROM e WHERE event_type = 'view' AND product_id IS NOT NULL",
}


def _clv(score: str, name: str) -> dict[str, str]:
    return {
        f"{name}_score": f"SELECT *, least(1.0::DOUBLE, {score}) AS score FROM cl0",
        f"{name}_value": f"""
            SELECT *, {_round("monthly * 6 * (0.6::DOUBLE + 0.3::DOUBLE * score)")} AS clv FROM {name}_score""",
        name: f"""
            SELECT user_id, clv AS clv_estimate, {_round("monthly")} AS avg_monthly_revenue, n AS total_orders,
                   {_money("spend")} AS total_spend, {_round("score", 3)} AS engagement_score,
                   CASE WHEN clv > 60000 THEN 'High' WHEN clv > 30000 THEN 'Medium' ELSE 'Low' END AS clv_segment
            FROM {name}_value""",
    }


CTES |= _clv("conv * 2 + dur / 3600", "clv") | _clv("conv * 2", "clv_nodur")


def _pairs(baskets: str) -> str:
    return f"""SELECT x.item AS product_a, y.item AS product_b, count(*) AS pair_count
        FROM {baskets} x JOIN {baskets} y ON x.basket = y.basket AND x.item < y.item
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"""


def _faults(relation: str, parent: str, parent_key: str, child: str, child_key: str) -> str:
    orphans = f"FROM {child} WHERE {child_key} IS NOT NULL AND {child_key} NOT IN (SELECT {parent_key} FROM {parent})"
    return f"""SELECT '{relation}' AS relation, (SELECT count(*) {orphans}) AS orphan_rows,
        (SELECT count(DISTINCT {child_key}) {orphans}) AS orphan_keys,
        (SELECT count(*) FROM (SELECT 1 FROM {parent} GROUP BY {parent_key} HAVING count(*) > 1)) AS repeated_parent_keys"""


def _repeats(entity: str, table: str, key: str) -> str:
    return f"SELECT '{entity}' AS entity, {key} AS key_value, count(*) AS copies FROM {table} GROUP BY {key} HAVING count(*) > 1"


DATE_PARTS = "year(ts)::BIGINT AS year, month(ts)::BIGINT AS month, strftime(ts, '%B') AS month_name"

REPORTS = {
    # keyed access
    "user_sessions_recent": """
        SELECT row_key, session_id, start_time, conversion_status AS conversion, device_type AS device
        FROM keyed WHERE user_id = (SELECT user_id FROM busy) ORDER BY row_key LIMIT 10""",
    "user_sessions_converted": """
        SELECT session_id, start_time, viewed_products AS products FROM keyed
        WHERE user_id = (SELECT user_id FROM busy) AND conversion_status = 'converted'""",
    "recent_sessions_per_user": """
        SELECT user_id, user_id || '#' || CAST(9223372036854775807 - epoch_us(started_at) // 1000 AS VARCHAR) AS row_key,
               session_id, start_time, row_number() OVER (PARTITION BY user_id ORDER BY row_key, session_id) AS position
        FROM s QUALIFY position <= 10""",
    "session_keyed_table": """
        SELECT row_key, session_id AS sess_session_id, start_time AS sess_start_time, end_time AS sess_end_time,
               duration_seconds::VARCHAR AS sess_duration_seconds, conversion_status AS sess_conversion_status,
               referrer AS sess_referrer, viewed_products AS sess_viewed_products, device_type, os AS device_os,
               browser AS device_browser, city AS device_city, state AS device_state,
               page_view_count::VARCHAR AS stats_page_view_count, cart_size::VARCHAR AS stats_cart_size
        FROM keyed""",
    "keep_last_3_versions": """
        WITH w AS (SELECT user_id || '#' || CAST(9223372036854775807 - epoch_us(started_at) // 1000 AS VARCHAR) AS row_key,
                          session_id, unnest(range(1, 2 + page_view_count % 5)) AS written, page_view_count AS n, cart_size AS c
                   FROM s)
        SELECT row_key, session_id, written, n * written // (1 + n % 5) AS page_view_count,
               c * written // (1 + n % 5) AS cart_size,
               row_number() OVER (PARTITION BY row_key ORDER BY written DESC, session_id DESC) AS version
        FROM w QUALIFY version <= 3""",
    "session_last_total": f"""
        SELECT session_id, {_money("total")} AS last_total FROM t
        QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ts DESC, transaction_id DESC) = 1""",
    # quality
    "entity_counts": """
        SELECT 'users' AS entity, count(*) AS row_count FROM u UNION ALL SELECT 'products', count(*) FROM p
        UNION ALL SELECT 'categories', count(DISTINCT category_id) FROM p UNION ALL SELECT 'sessions', count(*) FROM s
        UNION ALL SELECT 'transactions', count(*) FROM t""",
    "clean_transactions": f"""
        SELECT transaction_id, user_id, status, strftime(ts, {ISO}) AS timestamp, subtotal::DOUBLE AS subtotal,
               discount::DOUBLE AS discount, total::DOUBLE AS total,
               CASE WHEN subtotal > 0 THEN {_pct("discount", "subtotal")} ELSE 0.0 END AS discount_pct
        FROM rt WHERE total >= 0 AND user_id IS NOT NULL""",
    "clean_transactions_report": """
        SELECT CASE WHEN total IS NULL OR user_id IS NULL THEN 'missing_key_field' WHEN total < 0 THEN 'negative_total'
                    ELSE 'kept' END AS reason, count(*) AS row_count FROM rt GROUP BY 1""",
    "clean_sessions": """
        SELECT session_id, user_id, views AS page_view_count, referrer, conversion_status,
               greatest(1, least(duration_seconds, 14400)) AS duration_seconds FROM rs WHERE views > 0""",
    "clean_sessions_report": """
        SELECT CASE WHEN views > 0 THEN 'kept' ELSE 'no_page_views' END AS reason, count(*) AS row_count
        FROM rs GROUP BY 1""",
    "duplicate_keys": " UNION ALL ".join(
        [
            _repeats("users", "u", "user_id"),
            _repeats("products", "p", "product_id"),
            _repeats("transactions", "t", "transaction_id"),
            _repeats("sessions", "s", "session_id"),
            _repeats("order_lines", "lineitem", "l_orderkey::VARCHAR || '#' || l_linenumber::VARCHAR"),
        ]
    ),
    "fk_violations": " UNION ALL ".join(
        [
            _faults("users-transactions", "u", "user_id", "t", "user_id"),
            _faults("users-sessions", "u", "user_id", "s", "user_id"),
            _faults("transactions-items", "orders", "o_orderkey", "lineitem", "l_orderkey"),
            _faults("products-items", "part", "p_partkey", "lineitem", "l_partkey"),
            _faults(
                "categories-products",
                "(SELECT DISTINCT category_id, subcategory_id FROM p)",
                "category_id",
                "p",
                "category_id",
            ),
            _faults("sessions-transactions", "s", "session_id", "t", "session_id"),
        ]
    ),
    # flatten and enrich
    "export_users": f"""
        SELECT user_id, coalesce(city, '') AS city, coalesce(state, '') AS province, country,
               strftime(reg, {ISO}) AS registration_date, strftime(act, {ISO}) AS last_active, coalesce(n, 0) AS total_orders,
               coalesce({_money("spend")}, 0.0) AS total_spent_rwf, coalesce({_mean("spend", "n")}, 0.0) AS avg_order_rwf
        FROM u LEFT JOIN os USING (user_id)""",
    "export_products": """
        SELECT product_id, name, category_id, category_name, subcategory_id, subcategory_name,
               base_price::DOUBLE AS base_price_rwf, current_stock, is_active, creation_date FROM p""",
    "export_transactions": f"""
        SELECT transaction_id, user_id, session_id, timestamp, strftime(ts, '%Y-%m-%d') AS date, {DATE_PARTS},
               subtotal::DOUBLE AS subtotal_rwf, discount::DOUBLE AS discount_rwf, total::DOUBLE AS total_rwf,
               payment_method, status, item_count FROM t""",
    "export_transaction_items": f"""
        SELECT transaction_id, user_id, timestamp, strftime(ts, '%Y-%m-%d') AS date, month(ts)::BIGINT AS month,
               strftime(ts, '%B') AS month_name, status, payment_method, product_id,
               coalesce(name, product_id) AS product_name, quantity, unit_price::DOUBLE AS unit_price_rwf,
               subtotal::DOUBLE AS item_subtotal_rwf FROM l LEFT JOIN p USING (product_id)""",
    "export_sessions": f"""
        SELECT session_id, user_id, start_time, end_time, duration_seconds,
               {_mean("duration_seconds", "60")} AS duration_minutes, city, state AS province, device_type, os,
               browser, conversion_status, referrer, page_view_count, cart_size AS cart_item_count
        FROM s LEFT JOIN u USING (user_id)""",
    "export_categories": """
        SELECT DISTINCT category_id, category_name, subcategory_id, subcategory_name,
               (regexp_extract(subcategory_name, '([0-9]+)$', 1)::BIGINT % 36 + 10)::DOUBLE / 100 AS profit_margin
        FROM p""",
    "slim_transactions": """
        SELECT transaction_id, user_id, timestamp, total::DOUBLE AS total, subtotal::DOUBLE AS subtotal,
               discount::DOUBLE AS discount, status, payment_method FROM t""",
    "slim_users": f"""
        SELECT user_id, city, state, country, strftime(reg, {ISO}) AS registration_date,
               strftime(act, {ISO}) AS last_active FROM u""",
    "slim_products": """
        SELECT product_id, name, category_id, subcategory_id, base_price::DOUBLE AS base_price, current_stock, is_active
        FROM p""",
    "slim_sessions": """
        SELECT session_id, user_id, start_time, duration_seconds, device_type, os, referrer, conversion_status FROM s""",
    "enrich_products": """
        SELECT product_id, name, category_id, subcategory_id, base_price::DOUBLE AS base_price, current_stock, is_active,
               category_name, subcategory_name FROM p""",
    "province_lookup": "SELECT user_id, city, state AS province FROM u",
    "orders_from_carts": """
        SELECT session_id, user_id, end_time AS timestamp, count(*) AS line_count,
               sum(quantity * price)::DOUBLE AS subtotal, 0.0::DOUBLE AS discount, sum(quantity * price)::DOUBLE AS total
        FROM ct WHERE conversion_status = 'converted' GROUP BY ALL""",
    "order_lines_from_carts": """
        SELECT session_id, product_id, quantity, price::DOUBLE AS unit_price, (quantity * price)::DOUBLE AS subtotal
        FROM ct WHERE conversion_status = 'converted'""",
    # filters and joins
    "paid_transactions": "SELECT transaction_id, user_id, status, total::DOUBLE AS total FROM paid_t",
    "converted_sessions_semi": "SELECT session_id, user_id FROM s WHERE session_id IN (SELECT session_id FROM paid_t)",
    "inactive_users": "SELECT user_id FROM u WHERE user_id NOT IN (SELECT user_id FROM paid_t)",
    # revenue
    "top_products_lines": f"""
        SELECT product_id, name AS product_name, category_name AS category, {_money("revenue")} AS total_revenue,
               units AS total_units, n AS order_count
        FROM (SELECT product_id, sum(subtotal) AS revenue, {_big("sum(quantity)")} AS units, count(*) AS n FROM l
              WHERE status = 'completed' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) LEFT JOIN p USING (product_id)""",
    "top_products_orders": f"""
        SELECT product_id, {_money("sum(subtotal)")} AS total_revenue, {_big("sum(quantity)")} AS total_units,
               count(DISTINCT transaction_id) AS order_count, {_mean("sum(unit_price)", "count(*)")} AS avg_price
        FROM paid_l GROUP BY 1 ORDER BY sum(subtotal) DESC, 1 LIMIT 10""",
    "product_revenue": f"""
        SELECT product_id, {_money("sum(subtotal)")} AS total_revenue, {_big("sum(quantity)")} AS units_sold,
               count(DISTINCT transaction_id) AS orders FROM paid_l GROUP BY 1""",
    "top_product_names": f"""
        SELECT coalesce(name, product_id) AS product_name,
               CASE WHEN length(coalesce(name, product_id)) > 22 THEN substr(coalesce(name, product_id), 1, 22) || '...'
                    ELSE coalesce(name, product_id) END AS label,
               {_money("sum(subtotal)")} AS revenue, {_big("sum(quantity)")} AS units
        FROM paid_l LEFT JOIN p USING (product_id) GROUP BY 1, 2 ORDER BY sum(subtotal) DESC, 1 LIMIT 12""",
    "monthly_revenue_period": f"""
        SELECT month AS period, {_money("total")} AS total_revenue, n AS order_count,
               {_mean("total", "n")} AS avg_order_value, {_money("discount")} AS total_discount FROM months""",
    "monthly_revenue": f"""
        SELECT month, n AS order_count, {_money("total")} AS total_revenue, {_mean("total", "n")} AS avg_order_value,
               {_money("discount")} AS total_discounts, {_pct("discount", "subtotal", 1)} AS discount_rate_pct
        FROM months""",
    "monthly_growth": f"""
        SELECT month, total_revenue, previous_revenue,
               sign(total_revenue - previous_revenue)
                   * {_pct("abs(total_revenue - previous_revenue)", "previous_revenue")} AS mom_growth_pct
        FROM (SELECT month, {_money("total")} AS total_revenue,
                     lag({_money("total")}) OVER (ORDER BY month) AS previous_revenue FROM months)""",
    "daily_product_sales": f"""
        SELECT product_id, strftime(ts, '%Y-%m-%d') AS day, {_big("sum(quantity)")} AS units_sold,
               {_money("sum(subtotal)")} AS revenue FROM paid_l GROUP BY 1, 2""",
    "category_revenue": f"""
        SELECT category_name AS category, {_money("sum(subtotal)")} AS revenue, {_big("sum(quantity)")} AS units_sold,
               count(DISTINCT product_id) AS unique_products FROM paid_l JOIN p USING (product_id) GROUP BY 1""",
    "category_revenue_top10": f"""
        SELECT coalesce(split_part(category_name, ' ', 1), 'Other') AS category, {_money("sum(subtotal)")} AS revenue,
               {_big("sum(quantity)")} AS units
        FROM paid_l LEFT JOIN p USING (product_id) GROUP BY 1 ORDER BY sum(subtotal) DESC, 1 LIMIT 10""",
    "payment_mix": f"""
        SELECT payment_method, count(*) AS transaction_count, {_money("sum(total)")} AS total_revenue FROM t GROUP BY 1""",
    "province_revenue": f"""
        SELECT state AS province, count(DISTINCT user_id) AS buyers, count(*) AS orders,
               {_money("sum(total)")} AS total_revenue FROM paid_t JOIN u USING (user_id) GROUP BY 1""",
    "kpi_summary": f"""
        SELECT {_money("r")} AS total_revenue, 'RWF ' || format('{{:,}}', CAST(round(r) AS BIGINT)) AS total_revenue_label,
               coalesce({_ratio("conv", "visits")}, 0) * 100 AS conversion_rate_pct, {_mean("r", "n")} AS avg_order
        FROM (SELECT sum(total) AS r, count(*) AS n FROM t),
             (SELECT count(*) FILTER (conversion_status = 'converted') AS conv, count(*) AS visits FROM s)""",
    # customers
    "user_order_stats": f"""
        SELECT user_id, n AS order_count, {_money("spend")} AS total_spent, {_mean("spend", "n")} AS avg_order FROM os""",
    "buyer_segments": f"""
        SELECT CASE WHEN n >= 5 THEN 'High-Frequency' WHEN n >= 2 THEN 'Regular' ELSE 'One-Time' END AS segment,
               count(*) AS user_count, {_mean("sum(spend)", "count(*)")} AS avg_lifetime_spend,
               {_mean("sum(n)", "count(*)", 1)} AS avg_orders FROM os GROUP BY 1""",
    "user_segments": f"""
        WITH labels AS (SELECT unnest(['High-Frequency (5+)', 'Regular (2-4)', 'One-Time', 'Inactive']) AS segment),
        a AS (SELECT CASE WHEN coalesce(n, 0) >= 5 THEN 'High-Frequency (5+)' WHEN n >= 2 THEN 'Regular (2-4)'
                          WHEN n = 1 THEN 'One-Time' ELSE 'Inactive' END AS segment, spend
              FROM u LEFT JOIN os USING (user_id))
        SELECT segment, count(a.segment) AS user_count,
               {_pct("count(a.segment)", "(SELECT count(*) FROM u)", 1)} AS share_pct,
               coalesce({_mean("coalesce(sum(spend), 0)", "count(a.segment)")}, 0.0) AS avg_spend
        FROM labels LEFT JOIN a USING (segment) GROUP BY 1""",
    "cohort_spend": f"""
        SELECT cohort, month_offset, users AS active_users, {_money("spend")} AS total_spend, orders,
               {_mean("spend", "users")} AS avg_spend FROM cohorts""",
    "cohort_pivot": """
        SELECT cohort, """
    + ", ".join(
        f"coalesce(max(CASE WHEN month_offset = {m} THEN {_money('spend')} END), 0.0) AS month_{m}" for m in (3, 4, 5)
    )
    + " FROM cohorts GROUP BY 1 ORDER BY 1 LIMIT 4",
    "clv": "SELECT * FROM clv",
    "clv_no_duration": "SELECT * FROM clv_nodur",
    "clv_segments": f"""
        SELECT clv_segment, count(*) AS user_count, {_mean("sum(CAST(clv_estimate AS DECIMAL(18,2)))", "count(*)")} AS avg_clv,
               max(clv_estimate) AS max_clv FROM clv GROUP BY 1""",
    "clv_top5": "SELECT * FROM clv ORDER BY clv_estimate DESC, user_id LIMIT 5",
    "clv_histogram": f"""
        WITH r AS (SELECT min(clv_estimate) AS lo, (max(clv_estimate) - min(clv_estimate)) / 30 AS w,
                          {_mean("sum(CAST(clv_estimate AS DECIMAL(18,2)))", "count(*)")} AS mean_clv FROM clv_nodur),
        h AS (SELECT least(floor((clv_estimate - lo) / w), 29)::BIGINT AS bin, count(*) AS users
              FROM clv_nodur, r GROUP BY 1)
        SELECT range AS bin, lo + range * w AS lower_edge, coalesce(users, 0) AS users, mean_clv
        FROM range(30), r LEFT JOIN h ON bin = range""",
    "clv_concentration": f"""
        WITH q AS (SELECT quantile_cont(clv_estimate, 0.8) AS cut FROM clv)
        SELECT {_round("cut")} AS cut_clv, count(*) FILTER (clv_estimate >= cut) AS top_users, count(*) AS all_users,
               {_ratio("sum(CAST(clv_estimate AS DECIMAL(18,2))) FILTER (clv_estimate >= cut)",
                       "sum(CAST(clv_estimate AS DECIMAL(18,2)))")} AS top_value_share
        FROM clv, q GROUP BY cut""",
    "purchase_summary": f"""
        SELECT user_id, count(*) AS total_orders, {_money("sum(total)")} AS total_spent,
               {_mean("sum(total)", "count(*)")} AS avg_order, strftime(max(ts), {ISO}) AS last_purchase
        FROM paid_t GROUP BY 1""",
    # sessions
    "sessionize_events": """
        SELECT session_id, user_id, start_time, end_time, duration_seconds, page_view_count AS events FROM s""",
    "device_conversion_sql": f"""
        SELECT device_type, count(DISTINCT s.session_id) AS total_sessions, count(DISTINCT transaction_id) AS conversions,
               {_pct("count(DISTINCT transaction_id)", "count(DISTINCT s.session_id)")} AS conversion_rate_pct,
               {_mean("sum(duration_seconds)", "count(*) * 60", 1)} AS avg_session_min
        FROM s LEFT JOIN t ON s.session_id = t.session_id GROUP BY 1""",
    "device_conversion": f"""
        SELECT device_type, count(DISTINCT s.session_id) AS sessions, count(DISTINCT transaction_id) AS conversions,
               {_mean("sum(duration_seconds)", "count(*) * 60", 1)} AS avg_min,
               {_pct("count(DISTINCT transaction_id)", "count(DISTINCT s.session_id)")} AS conv_pct,
               any_value(per_session) AS avg_min_per_session
        FROM s LEFT JOIN t ON s.session_id = t.session_id
        JOIN (SELECT device_type, {_mean("sum(duration_seconds)", "count(*) * 60", 1)} AS per_session
              FROM s GROUP BY 1) USING (device_type) GROUP BY 1""",
    "device_totals": f"""
        SELECT device_type, count(*) AS sessions, count(orders) AS converted_sessions,
               {_pct("count(orders)", "count(*)")} AS conversion_rate_pct
        FROM s LEFT JOIN sp USING (session_id) GROUP BY 1""",
    "referrer_revenue": f"""
        SELECT referrer, count(DISTINCT s.session_id) AS sessions, count(DISTINCT transaction_id) AS conversions,
               {_money("sum(total)")} AS total_revenue, {_mean("sum(total)", "count(total)")} AS avg_order_value
        FROM s LEFT JOIN paid_t ON s.session_id = paid_t.session_id GROUP BY 1""",
    "referrer_top6": f"""
        SELECT referrer, count(*) AS sessions, count(orders) AS converted_sessions,
               {_pct("count(orders)", "count(*)", 1)} AS conversion_pct, {_money("coalesce(sum(revenue), 0)")} AS revenue
        FROM s LEFT JOIN sp USING (session_id) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6""",
    "session_funnel": f"""
        WITH f AS (SELECT 1 AS i, 'All Sessions' AS stage, count(*) AS n FROM s
            UNION ALL SELECT 2, 'Viewed Product', count(*) FILTER (has_viewed_product) FROM s
            UNION ALL SELECT 3, 'Added to Cart', count(*) FILTER (has_cart) FROM s
            UNION ALL SELECT 4, 'Converted', count(*) FILTER (conversion_status = 'converted') FROM s
            UNION ALL SELECT 5, 'Completed Order', count(*) FROM paid_t)
        SELECT i::BIGINT AS stage_no, stage, n, {_pct("n", "first_value(n) OVER (ORDER BY i)")} AS pct_of_first,
               sign(lag(n) OVER (ORDER BY i) - n)
                   * {_pct("abs(lag(n) OVER (ORDER BY i) - n)", "lag(n) OVER (ORDER BY i)")} AS drop_pct FROM f""",
    # products
    "product_funnel": f"""
        WITH a AS (SELECT product_id, count(*) AS views FROM v GROUP BY 1),
        b AS (SELECT product_id, {_big("sum(quantity)")} AS carts FROM c GROUP BY 1),
        d AS (SELECT product_id, {_big("sum(quantity)")} AS units FROM paid_l GROUP BY 1)
        SELECT product_id, views AS view_count, coalesce(carts, 0) AS cart_adds, coalesce(units, 0) AS purchases,
               {_pct("coalesce(carts, 0)", "views")} AS view_to_cart_pct,
               {_pct("coalesce(units, 0)", "views")} AS view_to_purchase_pct
        FROM a LEFT JOIN b USING (product_id) LEFT JOIN d USING (product_id) ORDER BY views DESC, product_id LIMIT 20""",
    "product_views": "SELECT product_id, count(*) AS view_count FROM v GROUP BY 1",
    "product_cart_adds": f"SELECT product_id, {_big('sum(quantity)')} AS cart_qty FROM c GROUP BY 1",
    "product_purchases": f"SELECT product_id, {_big('sum(quantity)')} AS purchased_qty FROM paid_l GROUP BY 1",
    "product_performance": f"""
        WITH a AS (SELECT product_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS views, count(DISTINCT user_id) AS users,
                          {_mean("sum(view_duration)", "count(view_duration)")} AS duration FROM v GROUP BY 1, 2),
        b AS (SELECT product_id, strftime(ts, '%Y-%m-%d') AS day, {_big("sum(quantity)")} AS units,
                     sum(subtotal) AS revenue FROM paid_l GROUP BY 1, 2),
        d AS (SELECT product_id, strftime(started_at, '%Y-%m-%d') AS day, {_big("sum(quantity)")} AS carts
              FROM ct GROUP BY 1, 2)
        SELECT product_id || '#' || day AS row_key, product_id, day, coalesce(views, 0) AS view_count,
               coalesce(users, 0) AS unique_users, duration AS avg_duration_sec, coalesce(units, 0) AS units_sold,
               {_money("coalesce(revenue, 0)")} AS revenue, coalesce(carts, 0) AS cart_adds,
               {_ratio("coalesce(units, 0)", "coalesce(views, 0)")} AS conversion_rate
        FROM a FULL JOIN b USING (product_id, day) FULL JOIN d USING (product_id, day)""",
    "copurchase_pairs": _pairs("purchases"),
    "coview_pairs": _pairs("views"),
    "also_bought": """
        SELECT x.item AS product_id, row_number() OVER (PARTITION BY x.item ORDER BY count(*) DESC, y.item) AS position,
               y.item AS other_id, count(*) AS pair_count
        FROM purchases x JOIN purchases y ON x.basket = y.basket AND x.item <> y.item
        GROUP BY x.item, y.item QUALIFY position <= 3""",
    # streams, with the windows that are still open at the end of the input
    "stream_product_views": f"""
        SELECT product_id, strftime(date_trunc('day', ts), {ISO}) AS window_start, count(*) AS view_count,
               count(DISTINCT user_id) AS unique_users,
               {_mean("sum(view_duration)", "count(view_duration)")} AS avg_duration_sec
        FROM v GROUP BY product_id, date_trunc('day', ts)""",
    "stream_payment_windows": f"""
        WITH a AS (SELECT o_orderdate AS ts, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
                          {_pick(PAYMENT_METHODS, "CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1")} AS payment_method
                   FROM orders),
        w AS (SELECT payment_method, 'tumbling' AS kind, date_trunc('day', ts) AS start, total FROM a
              UNION ALL SELECT payment_method, 'sliding', date_trunc('day', ts) - to_days(i::INTEGER), total
              FROM a, range(7) r(i))
        SELECT payment_method, kind, strftime(start, {ISO}) AS window_start, count(*) AS payments,
               {_money("sum(total)")} AS revenue
        FROM w GROUP BY payment_method, kind, start""",
    "stream_sessions": """
        SELECT user_id, start_time, end_time, page_view_count AS event_count FROM s""",
    "stream_latest_session": f"""
        SELECT {_id("user", "user_id", 9)} AS user_id, event_id, strftime(ts, {ISO}) AS last_seen, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_dedup": f"""
        SELECT event_id, {_id("user", "user_id", 9)} AS user_id, event_type, strftime(ts, {ISO}) AS timestamp
        FROM events""",
}


def _needed(sql: str, found: list[str]) -> None:
    """The names of CTES that ``sql`` reads, each after those it reads itself."""
    for name in CTES:
        if name not in found and re.search(rf"(?:FROM|JOIN)\s+{name}\b", sql):
            _needed(CTES[name], found)
            if name not in found:
                found.append(name)


# batches change how a report is made, not its rows
for _name in ("product_performance", "purchase_summary"):
    REPORTS[f"{_name}_by_batches"] = REPORTS[_name]


def oracle_sql() -> dict[str, str]:
    full = {}
    for report, sql in REPORTS.items():
        names: list[str] = []
        _needed(sql, names)
        ctes = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in names)
        body = sql.strip()
        if body.startswith("WITH "):
            body = (", " if ctes else "WITH ") + body.removeprefix("WITH ")
        full[report] = (f"WITH {ctes}\n" if ctes else "") + body
    return full
