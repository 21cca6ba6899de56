"""DuckDB statements over the raw driver tables, written independently of the Spark plans.

Each data set is one CTE; ``statement`` prepends the CTEs a query needs. Marts join line by line
and review by review here, where the Spark side works with weights. Decimals are returned as
doubles, which is how DuckDB hands them to a data frame.
"""

from __future__ import annotations

import re

# Stated here once more, so that a wrong value or rule on the other side shows.
CALENDAR = ("1995-01-01", "2001-12-31")
FIRST_BATCH, SECOND_BATCH = "1995-01-01", "1998-06-01"
ORDER_STATUSES = ("approved", "canceled", "created", "delivered", "invoiced", "processing", "shipped", "unavailable")
ORDER_STATUS_ROWS = (
    ("created", 1, False, "Order record created"),
    ("approved", 2, False, "Payment approved"),
    ("invoiced", 3, False, "Invoice issued"),
    ("processing", 4, False, "Being prepared by seller"),
    ("shipped", 5, False, "Handed to carrier"),
    ("delivered", 6, True, "Received by customer"),
    ("canceled", 7, True, "Cancelled before delivery"),
    ("unavailable", 8, True, "Item unavailable, not fulfilled"),
)
STATE_CODES = (
    "ac al am ap ba ce df es go ma mg ms mt pa pb pe pi pr rj rn ro rr rs sc se sp to"
).split()
DELAY_BANDS = (
    ("<= -7", "7+ days early"), ("< 0", "Early"), ("= 0", "On the day"), ("<= 7", "1-7 days late"), ("<= 14", "8-14 days late"),
)
GRAINS = {
    "sv_orders": ["order_id"], "sv_order_items": ["order_id", "order_item_id"], "sv_payments": ["order_id", "payment_sequential"],
    "sv_reviews": ["review_id", "order_id"], "sv_customer_keys": ["customer_id"], "sv_customers": ["customer_unique_id"],
    "sv_geolocation": ["zip_code_prefix"], "sv_sellers_history": ["seller_id", "__START_AT"],
    "sv_products_history": ["product_id", "__START_AT"], "dim_seller": ["seller_sk"], "dim_product": ["product_sk"],
    "dim_customer": ["customer_sk"], "bridge_customer_order": ["customer_id"], "fct_order_items": ["order_item_sk"],
    "fct_payments": ["payment_sk"], "fct_reviews": ["review_sk"],
}
# Data set -> rule -> what must hold.
RULES = {
    "sv_orders": {
        "valid_order_id": "order_id IS NOT NULL",
        "valid_customer_id": "customer_id IS NOT NULL",
        "known_status": "list_contains([" + ", ".join(f"'{s}'" for s in ORDER_STATUSES) + "], order_status)",
        "delivery_after_purchase": "CASE WHEN order_delivered_customer_date IS NULL THEN true"
        " ELSE order_delivered_customer_date >= order_purchase_timestamp END",
        "carrier_after_approval": "NOT coalesce(order_delivered_carrier_date < order_approved_at, false)",
        "delivered_has_date": "NOT (order_status = 'delivered' AND order_delivered_customer_date IS NULL)",
    },
    "sv_order_items": {
        "valid_order_id": "order_id IS NOT NULL", "valid_item_seq": "order_item_id IS NOT NULL",
        "non_negative_price": "NOT price < 0", "non_negative_freight": "NOT freight_value < 0",
    },
    "sv_payments": {
        "valid_order_id": "order_id IS NOT NULL", "known_payment_type": "NOT payment_type = 'not_defined'",
        "positive_value": "NOT payment_value <= 0",
    },
    "sv_reviews": {
        "valid_review_id": "review_id IS NOT NULL", "valid_order_id": "order_id IS NOT NULL",
        "score_in_range": "review_score IN (1, 2, 3, 4, 5)",
    },
    "sv_customer_keys": {"valid_customer_id": "customer_id IS NOT NULL", "valid_unique_id": "customer_unique_id IS NOT NULL"},
    "dim_seller": {"unique_seller": "seller_id IS NOT NULL"},
    "dim_product": {"unique_product": "product_id IS NOT NULL", "category_resolved": "category_en IS NOT NULL"},
    "dim_customer": {"unique_person": "customer_unique_id IS NOT NULL"},
    "fct_order_items": {
        "valid_sk": "order_item_sk IS NOT NULL", "has_customer_sk": "customer_sk IS NOT NULL",
        "non_negative_revenue": "NOT gross_revenue < 0",
    },
    "fct_payments": {"valid_sk": "payment_sk IS NOT NULL"},
    "fct_reviews": {"valid_sk": "review_sk IS NOT NULL", "score_in_range": "review_score IN (1, 2, 3, 4, 5)"},
}


def near(value: str, digits: int) -> str:
    """Half-up rounding of a double by its shortest decimal form."""
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 15)), {digits}) AS DOUBLE)"


def ratio(top: str, bottom: str, digits: int) -> str:
    """Half-up rounding of a ratio of non-negative integers, exact."""
    scaled = f"(2 * CAST({top} AS HUGEINT) * {10**digits} + {bottom}) // (2 * {bottom})"
    return f"CAST(CASE WHEN {bottom} > 0 THEN {scaled} END AS DOUBLE) / {10**digits}"


def mean(column: str, digits: int) -> str:
    return near(f"AVG({column})", digits)


def money(column: str) -> str:
    return f"CAST(SUM({column}) AS DOUBLE)"


def cents(column: str) -> str:
    return f"CAST({column} * 100 AS HUGEINT)"


_STATUSES = ", ".join(f"'{s}'" for s in ORDER_STATUSES)
_BATCH_1 = f"TIMESTAMP '{FIRST_BATCH} 00:00:00'"
_BATCH_2 = f"TIMESTAMP '{SECOND_BATCH} 00:00:00'"
_DELAY_CASE = (
    "CASE "
    + " ".join(f"WHEN delivery_delay_days {test} THEN '{label}'" for test, label in DELAY_BANDS)
    + " ELSE '15+ days late' END"
)


def clean_city(column: str) -> str:
    states = "|".join(STATE_CODES)
    head = f"trim(split_part(lower(trim({column})), '/', 1))"
    bare = f"regexp_replace({head}, '[\\s\\-]+({states})$', '')"
    return f"trim(regexp_replace({bare}, '\\s+', ' ', 'g'))"


def versions(source: str, key: str, tracked: str, order: str = "_ingested_at") -> str:
    return f"""
        SELECT * EXCLUDE (content, position, previous), {order} AS "__START_AT",
               lead({order}) OVER (PARTITION BY {key} ORDER BY {order}) AS "__END_AT"
        FROM (SELECT *, row_number() OVER w AS position, lag(content) OVER w AS previous
              FROM (SELECT *, row({tracked}) AS content FROM {source})
              WINDOW w AS (PARTITION BY {key} ORDER BY {order}, content))
        WHERE position = 1 OR content IS DISTINCT FROM previous"""


def ordered_versions(source: str, key: str, tracked: str, order: str) -> str:
    """Versions where several rows may have one order value: those go by content."""
    return f"""
        SELECT * EXCLUDE (content, position, previous), {order} AS "__START_AT",
               lead({order}) OVER (PARTITION BY {key} ORDER BY {order}, content) AS "__END_AT"
        FROM (SELECT *, row_number() OVER w AS position, lag(content) OVER w AS previous
              FROM (SELECT DISTINCT *, row({tracked}) AS content FROM {source})
              WINDOW w AS (PARTITION BY {key} ORDER BY {order}, content))
        WHERE position = 1 OR content IS DISTINCT FROM previous"""


CTES = {
    # ------------------------------------------------------------------ landing sources
    "br_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'c' || o_orderkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    ELSE 'processing' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               o_orderdate + INTERVAL 1 DAY AS order_approved_at,
               CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + to_days(CAST(o_orderkey % 5 AS INT))
                    END AS order_delivered_carrier_date,
               CASE WHEN (o_orderstatus = 'F' AND o_orderkey % 20 <> 0)
                      OR (o_orderstatus <> 'F' AND o_orderkey % 10 = 0)
                    THEN o_orderdate + to_days(CAST((o_orderkey * 7) % 61 - 2 AS INT))
                         + to_hours(CAST(o_orderkey % 24 AS INT))
                    END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date,
               o_orderdate AS _ingested_at, 'orders.parquet' AS _source_file
        FROM orders""",
    "br_order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(row_number() OVER (
                   PARTITION BY l_orderkey
                   ORDER BY md5(l_partkey || '|' || l_suppkey || '|' || l_linenumber || '|'
                                || CAST(l_shipdate AS DATE)),
                            l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                            l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
               ) AS INT) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(10, 2)) AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(10, 2)) * CAST(l_tax AS DECIMAL(4, 2))
                    AS DECIMAL(10, 2)) AS freight_value,
               l_shipdate AS _ingested_at
        FROM lineitem""",
    "br_customers": """
        SELECT 'c' || o_orderkey AS customer_id,
               o_custkey || '-' || (o_orderkey % 8) AS customer_unique_id,
               z.n_nationkey AS customer_zip_code_prefix,
               lower(c_mktsegment) AS customer_city, z.n_name AS customer_state,
               o_orderdate AS _ingested_at
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation z ON z.n_nationkey = (c_nationkey + (o_orderkey // 8) % 2) % 25""",
    "br_geolocation": """
        SELECT CASE WHEN c_nationkey < 23 THEN c_nationkey ELSE c_nationkey + 900 END
                   AS geolocation_zip_code_prefix,
               round(c_acctbal) / 100 AS geolocation_lat,
               CAST(c_custkey % 180 AS DOUBLE) AS geolocation_lng,
               lower(c_mktsegment) AS geolocation_city, r_name AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "br_sellers": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_nationkey AS seller_zip_code_prefix,
               'city ' || s_nationkey AS seller_city, n_name AS seller_state,
               {_BATCH_1} AS _ingested_at
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL
        SELECT CAST(s_suppkey AS VARCHAR), s_nationkey, 'moved ' || s_nationkey, n_name, {_BATCH_2}
        FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 25 = 0""",
    "br_products": f"""
        WITH described AS (
            SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS product_id,
                   CASE WHEN p_partkey % 40 <> 1 THEN lower(p_type) END AS product_category_name,
                   CAST(length(p_name) AS INT) AS product_name_lenght,
                   CAST(length(p_type) AS INT) AS product_description_lenght,
                   p_size % 6 + 1 AS product_photos_qty,
                   CASE WHEN p_partkey % 97 <> 0 THEN p_size * 250 END AS product_weight_g,
                   p_size AS product_length_cm, p_size % 7 + 1 AS product_height_cm,
                   p_size % 11 + 1 AS product_width_cm
            FROM part)
        SELECT * EXCLUDE (p_partkey), {_BATCH_1} AS _ingested_at FROM described
        UNION ALL
        SELECT * EXCLUDE (p_partkey) REPLACE ('recategorised' AS product_category_name), {_BATCH_2}
        FROM described WHERE p_partkey % 50 = 0""",
    "br_category_translation": """
        SELECT DISTINCT CASE WHEN p_type = 'PROMO' THEN 'x_PROMO' ELSE p_type END
                   AS product_category_name,
               'en_' || lower(p_type) AS product_category_name_english
        FROM part""",
    "br_payments": """
        SELECT CASE WHEN event_id % 1000 = 7 THEN 'x' ELSE '' END || event_id AS order_id,
               CAST(user_id % 3 + 1 AS INT) AS payment_sequential,
               CASE event_type WHEN 'purchase' THEN 'credit_card' WHEN 'click' THEN 'boleto'
                    WHEN 'view' THEN 'voucher' WHEN 'signup' THEN 'debit_card'
                    WHEN 'error' THEN 'not_defined' END AS payment_type,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 12 + 1 AS payment_installments,
               CAST(CASE WHEN event_id % 500 = 0 THEN 0 ELSE value END AS DECIMAL(10, 2))
                   AS payment_value,
               ts AS _ingested_at
        FROM events""",
    "br_reviews": """
        SELECT 'r' || (event_id % 500) AS review_id,
               CAST(event_id - event_id % 3 AS VARCHAR) AS order_id,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 5 + 1 AS review_score,
               CAST(NULL AS VARCHAR) AS review_comment_title,
               CASE WHEN event_id % 4 <> 0 THEN event_type END AS review_comment_message,
               ts AS review_creation_date, ts AS review_answer_timestamp, ts AS _ingested_at
        FROM events""",
    # ------------------------------------------------------------------ silver
    "sv_orders": f"""
        SELECT * FROM br_orders
        WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_status IN ({_STATUSES})""",
    "sv_order_items": """
        SELECT *, sha256(order_id || '||' || order_item_id) AS order_item_sk
        FROM br_order_items WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL""",
    "sv_payments": """
        SELECT *, coalesce(payment_type = 'not_defined' OR payment_value <= 0, false) AS is_suspect
        FROM br_payments WHERE order_id IS NOT NULL""",
    "sv_reviews": """
        SELECT *, sha256(review_id || '||' || order_id) AS review_sk
        FROM br_reviews WHERE review_id IS NOT NULL AND order_id IS NOT NULL""",
    "sv_quarantine_orders": """
        SELECT * FROM (
            SELECT order_id, order_status, order_purchase_timestamp, order_approved_at,
                   order_delivered_carrier_date, order_delivered_customer_date, _ingested_at,
                   CASE WHEN order_delivered_carrier_date < order_approved_at
                        THEN 'carrier_before_approval'
                        WHEN order_delivered_customer_date < order_purchase_timestamp
                        THEN 'delivered_before_purchase'
                        WHEN order_status = 'delivered' AND order_delivered_customer_date IS NULL
                        THEN 'delivered_without_date'
                        WHEN order_status <> 'delivered'
                             AND order_delivered_customer_date IS NOT NULL
                        THEN 'undelivered_with_date' END AS _quarantine_reason
            FROM br_orders) WHERE _quarantine_reason IS NOT NULL""",
    "sv_customer_keys": """
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix,
               _ingested_at
        FROM br_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL""",
    "sv_customers": f"""
        SELECT customer_unique_id, zip_code_prefix, city, state, _ingested_at,
               lifetime_order_count, lifetime_order_count > 1 AS is_repeat_customer
        FROM (SELECT customer_unique_id, customer_zip_code_prefix AS zip_code_prefix,
                     {clean_city('customer_city')} AS city,
                     upper(trim(customer_state)) AS state, _ingested_at,
                     count(*) OVER (PARTITION BY customer_unique_id) AS lifetime_order_count,
                     row_number() OVER (PARTITION BY customer_unique_id
                                        ORDER BY _ingested_at DESC, customer_id DESC) AS rn
              FROM br_customers) WHERE rn = 1""",
    "sv_category_translation": """
        SELECT lower(trim(product_category_name)) AS category_pt,
               lower(trim(product_category_name_english)) AS category_en
        FROM br_category_translation WHERE product_category_name IS NOT NULL""",
    "sv_geolocation": """
        WITH points AS (
            SELECT DISTINCT geolocation_zip_code_prefix AS zip_code_prefix,
                   geolocation_lat AS latitude, geolocation_lng AS longitude,
                   lower(trim(geolocation_city)) AS city, upper(trim(geolocation_state)) AS state
            FROM br_geolocation),
        centre AS (
            SELECT zip_code_prefix, avg(latitude) AS latitude, avg(longitude) AS longitude,
                   count(*) AS source_point_count FROM points GROUP BY zip_code_prefix),
        ranked AS (
            SELECT zip_code_prefix, city, state,
                   row_number() OVER (PARTITION BY zip_code_prefix
                                      ORDER BY count(*) DESC, city NULLS FIRST, state NULLS FIRST) AS rn
            FROM points GROUP BY zip_code_prefix, city, state)
        SELECT centre.*, city, state FROM centre JOIN ranked USING (zip_code_prefix)
        WHERE rn = 1""",
    "sv_sellers_history": versions(
        "br_sellers", "seller_id", "seller_zip_code_prefix, seller_city, seller_state"
    ),
    "sv_products_history": versions(
        "br_products", "product_id",
        "product_category_name, product_name_lenght, product_description_lenght,"
        " product_photos_qty, product_weight_g, product_length_cm, product_height_cm,"
        " product_width_cm",
    ),
    # ------------------------------------------------------------------ gold
    "dim_order_status": "SELECT * FROM (VALUES "
    + ", ".join(f"('{s}', {n}, {str(t).lower()}, '{d}')" for s, n, t, d in ORDER_STATUS_ROWS)
    + ") AS v(order_status, status_order, is_terminal, status_description)",
    "dim_date": f"""
        SELECT d AS date_key, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
               CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day,
               CAST(weekofyear(d) AS INT) AS week_of_year,
               CAST(dayofweek(d) + 1 AS INT) AS day_of_week, monthname(d) AS month_name,
               dayname(d) AS day_name, strftime(d, '%Y-%m') AS year_month,
               dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}',
                                                 INTERVAL 1 DAY)) AS DATE) AS d)""",
    "dim_seller": """
        SELECT sha256(seller_id) AS seller_sk, seller_id, seller_city, seller_state,
               seller_zip_code_prefix AS zip_code_prefix, latitude AS seller_latitude,
               longitude AS seller_longitude, latitude IS NOT NULL AS has_geo,
               "__START_AT" AS valid_from
        FROM sv_sellers_history h
        LEFT JOIN sv_geolocation g ON g.zip_code_prefix = h.seller_zip_code_prefix
        WHERE "__END_AT" IS NULL""",
    "dim_product": """
        SELECT sha256(product_id) AS product_sk, product_id,
               coalesce(product_category_name, 'unknown') AS category_pt,
               coalesce(t.category_en, product_category_name, 'unknown') AS category_en,
               product_name_lenght AS name_length,
               product_description_lenght AS description_length,
               product_photos_qty AS photos_qty, CAST(product_weight_g AS DOUBLE) AS weight_g,
               CAST(product_length_cm AS DOUBLE) AS length_cm,
               CAST(product_height_cm AS DOUBLE) AS height_cm,
               CAST(product_width_cm AS DOUBLE) AS width_cm,
               CAST(product_length_cm * product_height_cm * product_width_cm AS DOUBLE)
                   AS volume_cm3,
               CASE WHEN product_weight_g IS NULL THEN 'unknown'
                    WHEN product_weight_g < 500 THEN 'small'
                    WHEN product_weight_g < 2000 THEN 'medium'
                    WHEN product_weight_g < 10000 THEN 'large' ELSE 'oversized' END AS size_bucket,
               "__START_AT" AS valid_from
        FROM sv_products_history h
        LEFT JOIN sv_category_translation t ON t.category_pt = h.product_category_name
        WHERE "__END_AT" IS NULL""",
    "dim_customer": """
        SELECT sha256(customer_unique_id) AS customer_sk, customer_unique_id,
               p.city AS customer_city, p.state AS customer_state, p.zip_code_prefix,
               latitude AS customer_latitude, longitude AS customer_longitude,
               latitude IS NOT NULL AS has_geo, lifetime_order_count, is_repeat_customer,
               CASE WHEN lifetime_order_count >= 3 THEN 'frequent'
                    WHEN lifetime_order_count = 2 THEN 'returning' ELSE 'one_time' END
                   AS customer_segment
        FROM sv_customers p LEFT JOIN sv_geolocation g ON g.zip_code_prefix = p.zip_code_prefix""",
    "bridge_customer_order": """
        SELECT customer_id, min(customer_unique_id) AS customer_unique_id,
               sha256(min(customer_unique_id)) AS customer_sk
        FROM sv_customer_keys GROUP BY customer_id""",
    "fct_order_items": f"""
        SELECT order_item_sk, i.order_id, order_item_id, customer_sk, sha256(seller_id) AS seller_sk,
               sha256(product_id) AS product_sk,
               CAST(order_purchase_timestamp AS DATE) AS order_date_key, order_status,
               o.customer_id, seller_id, product_id, order_purchase_timestamp, order_approved_at,
               order_delivered_customer_date, order_estimated_delivery_date, shipping_limit_date,
               price, freight_value, price + freight_value AS gross_revenue,
               CASE WHEN price > 0 THEN {ratio(cents('freight_value'), cents('price'), 4)} END
                   AS freight_ratio,
               CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                              CAST(order_delivered_customer_date AS DATE)) AS INT) AS delivery_days,
               CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                              CAST(order_delivered_customer_date AS DATE)) AS INT)
                   AS delivery_delay_days,
               CASE WHEN order_delivered_customer_date IS NULL THEN NULL
                    ELSE CAST(order_delivered_customer_date AS DATE)
                         > CAST(order_estimated_delivery_date AS DATE) END AS is_late_delivery,
               order_status = 'delivered' AS is_delivered
        FROM sv_order_items i JOIN sv_orders o ON o.order_id = i.order_id
        LEFT JOIN bridge_customer_order b ON b.customer_id = o.customer_id""",
    "fct_payments": """
        SELECT sha256(p.order_id || '||' || payment_sequential) AS payment_sk, p.order_id,
               payment_sequential, customer_sk,
               CAST(order_purchase_timestamp AS DATE) AS order_date_key, payment_type,
               payment_installments, payment_value, payment_installments > 1 AS is_installment,
               is_suspect, order_purchase_timestamp IS NOT NULL AS has_order, order_status
        FROM sv_payments p LEFT JOIN sv_orders o ON o.order_id = p.order_id
        LEFT JOIN bridge_customer_order b ON b.customer_id = o.customer_id""",
    "fct_reviews": """
        SELECT review_sk, review_id, r.order_id, customer_sk,
               CAST(order_purchase_timestamp AS DATE) AS order_date_key, review_score,
               review_score <= 2 AS is_negative, review_score >= 4 AS is_positive,
               review_comment_message IS NOT NULL AS has_comment, review_creation_date,
               review_answer_timestamp,
               CASE WHEN order_delivered_customer_date IS NOT NULL
                    THEN coalesce(order_delivered_customer_date > order_estimated_delivery_date,
                                  false) END AS is_late_delivery,
               order_status
        FROM sv_reviews r LEFT JOIN sv_orders o ON o.order_id = r.order_id
        LEFT JOIN bridge_customer_order b ON b.customer_id = o.customer_id""",
    # ------------------------------------------------------------------ marts
    "mart_delivery_performance": f"""
        SELECT customer_state, strftime(order_purchase_timestamp, '%Y-%m') AS year_month,
               count(*) AS line_items, count(DISTINCT f.order_id) AS orders,
               {money('gross_revenue')} AS gmv, {mean('delivery_days', 1)} AS avg_delivery_days,
               {mean('delivery_delay_days', 1)} AS avg_delay_days,
               {near('100 * avg(CASE WHEN f.is_late_delivery THEN 1.0 ELSE 0.0 END)', 2)}
                   AS late_pct,
               {mean('review_score', 2)} AS avg_review_score
        FROM fct_order_items f LEFT JOIN dim_customer c ON c.customer_sk = f.customer_sk
        LEFT JOIN fct_reviews r ON r.order_id = f.order_id
        WHERE is_delivered GROUP BY ALL""",
    "seller_scores": f"""
        SELECT f.seller_sk, s.seller_id, seller_city, seller_state, count(*) AS line_items,
               count(DISTINCT f.order_id) AS orders,
               count(DISTINCT product_id) AS distinct_products, {money('gross_revenue')} AS gmv,
               {ratio(ratio(f'SUM({cents("price")})', 'COUNT(price)', 4) + ' * 10000', '10000', 0)}
                   / 100 AS avg_item_price,
               {mean('delivery_days', 1)} AS avg_delivery_days,
               {near('100 * avg(CASE WHEN f.is_late_delivery THEN 1.0 ELSE 0.0 END)', 2)}
                   AS late_pct,
               {mean('review_score', 2)} AS avg_review_score
        FROM fct_order_items f JOIN dim_seller s ON s.seller_sk = f.seller_sk
        LEFT JOIN fct_reviews r ON r.order_id = f.order_id GROUP BY ALL""",
    "mart_seller_scorecard": "SELECT * FROM seller_scores WHERE line_items >= 600",
    "mart_monthly_revenue": f"""
        SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month,
               count(DISTINCT order_id) AS orders, count(DISTINCT f.customer_sk) AS customers,
               count(*) AS line_items, {money('gross_revenue')} AS gmv,
               {money('price')} AS product_revenue, {money('freight_value')} AS freight_revenue,
               {near('100 * avg(CASE WHEN is_repeat_customer THEN 1.0 ELSE 0.0 END)', 2)}
                   AS repeat_customer_pct,
               {ratio(f'SUM({cents("gross_revenue")})', 'COUNT(DISTINCT order_id)', 0)}
                   / 100 AS avg_order_value
        FROM fct_order_items f LEFT JOIN dim_customer c ON c.customer_sk = f.customer_sk
        GROUP BY ALL""",
}


def _rule_rows() -> str:
    """One aggregate per rule; months stand for runs."""
    stamps = {
        "dim_seller": "valid_from", "dim_product": "valid_from",
        "dim_customer": f"TIMESTAMP '{CALENDAR[1]} 00:00:00'",
        "fct_order_items": "order_date_key", "fct_payments": "order_date_key",
        "fct_reviews": "order_date_key",
    }
    selects = []
    for dataset, rules in RULES.items():
        layer = "silver" if dataset.startswith("sv_") else "gold"
        stamp = stamps.get(dataset, "_ingested_at")
        source = dataset.replace("sv_customer_keys", "sv_customer_keys_raw")
        for name, predicate in rules.items():
            passed = f"coalesce({predicate}, false)"
            selects.append(
                f"SELECT '{layer}' AS layer, '{dataset}' AS dataset, '{name}' AS expectation,"
                f" max(CAST(date_trunc('month', {stamp}) AS TIMESTAMP)) AS last_seen,"
                f" count(*) FILTER (WHERE {passed}) AS total_passed,"
                f" count(*) FILTER (WHERE NOT {passed}) AS total_failed"
                f" FROM {_before_rules(dataset)}"
            )
    return " UNION ALL ".join(selects)


def _before_rules(dataset: str) -> str:
    return {
        "sv_orders": "br_orders",
        "sv_order_items": "br_order_items",
        "sv_payments": "br_payments",
        "sv_reviews": "br_reviews",
        "sv_customer_keys": "br_customers",
    }.get(dataset, dataset)


CTES["dq_expectation_report"] = _rule_rows()


def statement(body: str) -> str:
    """``body`` preceded by every CTE it mentions, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    if body.lstrip().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    heads = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {heads}\n{body}"


def table(name: str, replace: str = "") -> str:
    return statement(f"SELECT *{f' REPLACE ({replace})' if replace else ''} FROM {name}")


def _as_double(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def _placed(*columns: str) -> str:
    return ", ".join(f"round({c} + 1e-9, 6) AS {c}" for c in columns)


_SHARE = "(CASE WHEN {0} THEN 1 ELSE 0 END)"


def share(predicate: str) -> str:
    """Percentage with one decimal as decimal arithmetic gives it: five places first."""
    hits = f"SUM(CASE WHEN {predicate} THEN 1 ELSE 0 END)"
    five = f"((2 * CAST({hits} AS HUGEINT) * 100000 + COUNT(*)) // (2 * COUNT(*)))"
    return f"CAST((2 * {five} + 100) // 200 AS DOUBLE) / 10"


def mean_of_rounded(column: str, digits: int) -> str:
    """Mean of rounded doubles, exact, half up (values may be negative nowhere they are used)."""
    scaled = f"CAST(round({column} * {10**digits}) AS HUGEINT)"
    return f"{ratio(f'SUM({scaled})', f'COUNT({column})', 0)} / {10**digits}"


_STATE_REVENUE = f"""
    SELECT customer_state, count(DISTINCT order_id) AS orders, {money('gross_revenue')} AS gmv,
           {mean('delivery_days', 1)} AS avg_delivery_days
    FROM fct_order_items f JOIN dim_customer c ON c.customer_sk = f.customer_sk
    GROUP BY customer_state"""
_DELAY_SCORE = f"""
    SELECT {_DELAY_CASE} AS delay_bucket, min(delivery_delay_days) AS sort_key,
           count(DISTINCT f.order_id) AS orders, {mean('review_score', 2)} AS avg_score
    FROM fct_order_items f JOIN fct_reviews r ON r.order_id = f.order_id
    WHERE delivery_delay_days IS NOT NULL GROUP BY 1"""
_WORST = """
    SELECT seller_id, seller_city, seller_state, line_items, orders, gmv, avg_delivery_days,
           late_pct, avg_review_score
    FROM mart_seller_scorecard WHERE line_items >= 100
    ORDER BY late_pct DESC, seller_id LIMIT 20"""
_ONTIME = f"""
    SELECT {share('NOT is_late_delivery')} AS ontime_pct
    FROM fct_order_items WHERE is_late_delivery IS NOT NULL"""


def _grain(dataset: str) -> str:
    keys = ", ".join(f'"{k}"' for k in GRAINS[dataset])
    null = " OR ".join(f'"{k}" IS NULL' for k in GRAINS[dataset])
    return (
        f"SELECT '{dataset}' AS dataset, CAST(sum(n) AS BIGINT) AS total_rows,"
        f" count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS repeated_keys,"
        f" CAST(coalesce(sum(n) FILTER (WHERE {null}), 0) AS BIGINT) AS null_key_rows"
        f" FROM (SELECT {keys}, count(*) AS n FROM {dataset} GROUP BY {keys})"
    )


def _orphans(relation: str, fact: str, key: str, dimension: str, other: str) -> str:
    return (
        f"SELECT '{relation}' AS relation, count({key}) AS orphan_rows,"
        f" count(DISTINCT {key}) AS orphan_keys,"
        f" count(*) FILTER (WHERE {key} IS NULL) AS null_key_rows"
        f" FROM {fact} WHERE {key} IS NULL OR {key} NOT IN (SELECT {other} FROM {dimension})"
    )


RELATIONS = (
    ("lines without order", "sv_order_items", "order_id", "sv_orders", "order_id"),
    ("lines without customer", "fct_order_items", "customer_sk", "dim_customer", "customer_sk"),
    ("lines without seller", "fct_order_items", "seller_sk", "dim_seller", "seller_sk"),
    ("lines without product", "fct_order_items", "product_sk", "dim_product", "product_sk"),
    ("lines without date", "fct_order_items", "order_date_key", "dim_date", "date_key"),
    ("lines without status", "fct_order_items", "order_status", "dim_order_status",
     "order_status"),
    ("payments without order", "sv_payments", "order_id", "sv_orders", "order_id"),
    ("reviews without order", "sv_reviews", "order_id", "sv_orders", "order_id"),
    ("customers without place", "sv_customers", "zip_code_prefix", "sv_geolocation",
     "zip_code_prefix"),
    ("sellers without place", "dim_seller", "zip_code_prefix", "sv_geolocation",
     "zip_code_prefix"),
)


# Columns of the landed files.
SOURCE_COLUMNS = {
    "orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at order_delivered_carrier_date"
    " order_delivered_customer_date order_estimated_delivery_date",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "products": "product_id product_category_name product_name_lenght product_description_lenght product_photos_qty product_weight_g"
    " product_length_cm product_height_cm product_width_cm",
    "payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "reviews": "review_id order_id review_score review_comment_title review_comment_message review_creation_date review_answer_timestamp",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state",
    "category_translation": "product_category_name product_category_name_english",
}


def _digits(text: str) -> str:
    """The first eight hexadecimal digits of a digest as a number."""
    return f"CAST('0x' || substr(md5(CAST({text} AS VARCHAR)), 1, 8) AS BIGINT)"


def _digest(source: str, columns: str) -> str:
    whole = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns.split()) + ")"
    return f"SELECT '{source}' AS source, count(*) AS rows, CAST(sum({_digits(whole)}) AS BIGINT) AS digest FROM br_{source}"


def _inferred() -> str:
    """Types after each of three landings: whole numbers, then decimals, then texts among the values."""
    landed = """(SELECT *, CASE WHEN part = 0 THEN CAST(CAST(trunc(payment_value) AS BIGINT) AS VARCHAR)
                              WHEN part = 2 AND k % 5 = 0 THEN 'n/a' ELSE CAST(payment_value AS VARCHAR) END AS amount
                  FROM (SELECT *, CASE WHEN order_id LIKE 'x%' THEN 2 ELSE CAST(ltrim(order_id, 'x') AS BIGINT) % 3 END AS part,
                               CAST(ltrim(order_id, 'x') AS BIGINT) AS k FROM br_payments))"""
    columns = {
        "order_id": "order_id", "payment_sequential": "payment_sequential", "payment_type": "payment_type",
        "payment_installments": "payment_installments", "payment_value": "amount",
    }
    return " UNION ALL ".join(
        f"""SELECT {last} AS landing, '{name}' AS column_name,
                   CASE WHEN bool_and(regexp_full_match(CAST({source} AS VARCHAR), '[0-9]+')) THEN 'bigint'
                        WHEN bool_and(regexp_full_match(CAST({source} AS VARCHAR), '[0-9]+([.][0-9]+)?')) THEN 'decimal(38,9)'
                        ELSE 'string' END AS type,
                   count(*) AS rows FROM {landed} WHERE part <= {last}"""
        for last in range(3) for name, source in columns.items()
    )


_SPOILED_ORDERS = """(SELECT CASE WHEN k % 110 = 1 THEN NULL ELSE order_id END AS order_id,
                         CASE WHEN k % 70 = 5 THEN NULL ELSE customer_id END AS customer_id,
                         CASE WHEN k % 90 = 7 THEN 'mystery' WHEN k % 95 = 9 THEN NULL ELSE order_status END AS order_status,
                         * EXCLUDE (order_id, customer_id, order_status, k)
                  FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM br_orders))"""


def _statements() -> dict[str, str]:
    out = {
        name: table(name)
        for name in (
            "sv_orders", "sv_reviews", "sv_quarantine_orders", "sv_customer_keys", "sv_customers",
            "sv_category_translation", "sv_sellers_history", "sv_products_history",
            "dim_product", "bridge_customer_order", "fct_reviews",
            "mart_delivery_performance", "mart_seller_scorecard", "mart_monthly_revenue",
            "dq_expectation_report",
        )
    }
    out["sv_order_items"] = table("sv_order_items", _as_double("price", "freight_value"))
    out["sv_payments"] = table("sv_payments", _as_double("payment_value"))
    out["sv_geolocation"] = table("sv_geolocation", _placed("latitude", "longitude"))
    out["dim_seller"] = table("dim_seller", _placed("seller_latitude", "seller_longitude"))
    out["dim_customer"] = table("dim_customer", _placed("customer_latitude", "customer_longitude"))
    out["fct_order_items"] = table(
        "fct_order_items", _as_double("price", "freight_value", "gross_revenue")
    )
    out["fct_payments"] = table("fct_payments", _as_double("payment_value"))

    span = "SELECT min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS l FROM orders"
    out["dim_date"] = statement(
        f"SELECT d.* FROM dim_date d, ({span}) WHERE date_key BETWEEN f AND l"
    )

    monthly = "FROM mart_monthly_revenue WHERE orders > 100"
    bodies = {
        "q01_monthly_report": "SELECT year_month, orders, customers, gmv, avg_order_value,"
        f" repeat_customer_pct {monthly}",
        "q02_seller_states": f"""
            SELECT seller_state, count(DISTINCT seller_id) AS sellers,
                   CAST(sum(line_items) AS BIGINT) AS line_items,
                   {ratio(f"SUM(CAST(round(gmv * 100) AS HUGEINT))", '100', 2)} AS gmv,
                   {mean_of_rounded('avg_delivery_days', 1)} AS avg_delivery_days,
                   {mean_of_rounded('late_pct', 2)} AS late_pct,
                   {mean_of_rounded('avg_review_score', 2)} AS avg_review_score
            FROM mart_seller_scorecard GROUP BY seller_state HAVING sum(line_items) >= 100""",
        "q03_worst_sellers": _WORST,
        "q04_reviews_by_lateness": f"""
            SELECT CASE WHEN is_late_delivery THEN 'Late' ELSE 'On time' END AS delivery_status,
                   count(*) AS reviews, {mean('review_score', 2)} AS avg_score,
                   {share('is_negative')} AS pct_1_or_2_star,
                   {share('is_positive')} AS pct_4_or_5_star
            FROM fct_reviews WHERE is_late_delivery IS NOT NULL GROUP BY 1""",
        "q05_score_by_delay": f"SELECT * EXCLUDE (sort_key) FROM ({_DELAY_SCORE})",
        "q06_category_changes": """
            SELECT product_id, product_category_name, "__START_AT" AS valid_from,
                   "__END_AT" AS valid_to,
                   CASE WHEN "__END_AT" IS NULL THEN 'current' ELSE 'superseded' END
                       AS version_status
            FROM sv_products_history
            WHERE product_id IN (SELECT product_id FROM sv_products_history
                                 GROUP BY product_id HAVING count(*) > 1)
            ORDER BY product_id, "__START_AT" LIMIT 40""",
        "q07_quality_summary": f"""
            SELECT layer, dataset, expectation, total_passed, total_failed,
                   {ratio('100 * total_failed', '(total_passed + total_failed)', 3)} AS failure_pct
            FROM dq_expectation_report""",
        "q08_revenue_by_state": _STATE_REVENUE,
        "q09_gmv_total": f"SELECT {money('gross_revenue')} AS total_gmv FROM fct_order_items",
        "q10_ontime_rate": _ONTIME,
        "q11_monthly_tile": "SELECT year_month, orders, gmv, avg_order_value,"
        f" repeat_customer_pct {monthly}",
        "q12_delay_versus_score": _DELAY_SCORE,
        "q13_revenue_by_state_tile": _STATE_REVENUE,
        "q14_seller_tile": f"SELECT * EXCLUDE (orders) FROM ({_WORST})",
        "q15_widget_total_gmv": 'SELECT CAST(sum(gross_revenue) AS DOUBLE) AS "sum(total_gmv)"'
        " FROM fct_order_items",
        "q15_widget_ontime": f'SELECT sum(ontime_pct) AS "sum(ontime_pct)" FROM ({_ONTIME})',
        "q15_widget_monthly_gmv": f'SELECT year_month, gmv AS "sum(gmv)" {monthly}',
        "q15_widget_score_by_delay": 'SELECT delay_bucket, sum(avg_score) AS "sum(avg_score)"'
        f" FROM ({_DELAY_SCORE}) GROUP BY delay_bucket",
        "q15_widget_state_gmv": 'SELECT customer_state, sum(gmv) AS "sum(gmv)"'
        f" FROM ({_STATE_REVENUE}) GROUP BY customer_state",
        "q15_widget_seller_table": f"SELECT * EXCLUDE (orders) FROM ({_WORST})",
        "q16_star_report": f"""
            SELECT customer_state, seller_state, category_en, year_month, count(*) AS line_items,
                   {money('gross_revenue')} AS gmv, {mean('delivery_days', 1)} AS avg_delivery_days
            FROM fct_order_items f
            LEFT JOIN dim_customer c ON c.customer_sk = f.customer_sk
            LEFT JOIN dim_seller s ON s.seller_sk = f.seller_sk
            LEFT JOIN dim_product p ON p.product_sk = f.product_sk
            LEFT JOIN dim_date d ON d.date_key = f.order_date_key GROUP BY ALL""",
        "q17_control_totals": f"""
            SELECT (SELECT {money('gross_revenue')} FROM fct_order_items) AS gmv,
                   (SELECT count(*) FROM fct_order_items) AS line_items,
                   (SELECT count(*) FROM dim_customer) AS persons,
                   (SELECT count(*) FROM dim_customer WHERE is_repeat_customer) AS repeat_persons,
                   (SELECT count(*) FROM sv_sellers_history WHERE "__END_AT" IS NULL)
                       AS current_sellers,
                   (SELECT count(*) FROM sv_sellers_history) AS seller_versions""",
        "grain_report": " UNION ALL ".join(_grain(d) for d in GRAINS),
        "orphan_keys": " UNION ALL ".join(_orphans(*r) for r in RELATIONS),
        "asof_seller": """
            SELECT i.order_item_sk, i.seller_id, seller_city, seller_state,
                   "__START_AT" AS version_start
            FROM fct_order_items i LEFT JOIN (
                SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY "__START_AT") AS n
                FROM sv_sellers_history) h
              ON h.seller_id = i.seller_id
             AND (h.n = 1 OR i.order_purchase_timestamp >= h."__START_AT")
             AND (h."__END_AT" IS NULL OR i.order_purchase_timestamp < h."__END_AT")""",
        "scd2_event_status": versions(
            "(SELECT user_id, event_type, ts FROM events)", "user_id", "event_type", "ts"
        ),
        "scd2_changed_keys": """
            SELECT * FROM sv_sellers_history WHERE seller_id IN (
                SELECT seller_id FROM sv_sellers_history GROUP BY seller_id HAVING count(*) > 1)""",
        "scd2_sequence_ties": """
            SELECT customer_unique_id, _ingested_at, count(*) AS variants
            FROM (SELECT DISTINCT * FROM br_customers)
            GROUP BY customer_unique_id, _ingested_at HAVING count(*) > 1""",
        "normalise_city": f"""
            SELECT customer_id, city, {clean_city('city')} AS clean
            FROM (SELECT customer_id,
                         CASE CAST(substr(customer_id, 2) AS BIGINT) % 6
                              WHEN 0 THEN ' Sao  ' || customer_city || ' SP '
                              WHEN 1 THEN customer_city || ' - sp'
                              WHEN 2 THEN customer_city || '/' || customer_state
                              WHEN 3 THEN '/' || customer_city
                              WHEN 4 THEN 'Porto to'
                              ELSE NULL END AS city
                  FROM br_customers)""",
        "v_dim_customer_secure": """
            SELECT * REPLACE (left(customer_unique_id, 4) || '***REDACTED***' AS customer_unique_id,
                              round(customer_latitude, 1) AS customer_latitude,
                              round(customer_longitude, 1) AS customer_longitude)
            FROM dim_customer""",
        "v_dim_customer_regional": f"""
            SELECT * REPLACE ({_placed('customer_latitude', 'customer_longitude')})
            FROM dim_customer WHERE customer_state IN ('NATION_3', 'NATION_7')""",
        "v_fct_reviews_secure": "SELECT * FROM fct_reviews",
        "review_text_masked": """
            SELECT * REPLACE (
                CASE WHEN review_comment_message IS NOT NULL THEN '[REDACTED]' END
                    AS review_comment_message) FROM sv_reviews""",
        "csv_ingest": """
            SELECT order_id, customer_id, order_status,
                   strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S')
                       AS order_purchase_timestamp,
                   strftime(order_approved_at, '%Y-%m-%d %H:%M:%S') AS order_approved_at,
                   strftime(order_delivered_carrier_date, '%Y-%m-%d %H:%M:%S')
                       AS order_delivered_carrier_date,
                   strftime(order_delivered_customer_date, '%Y-%m-%d %H:%M:%S')
                       AS order_delivered_customer_date,
                   strftime(order_estimated_delivery_date, '%Y-%m-%d %H:%M:%S')
                       AS order_estimated_delivery_date,
                   CAST(NULL AS VARCHAR) AS _rescued_data, 'orders' AS _source_system
            FROM br_orders""",
        "csv_drift": """
            SELECT seller_id, CAST(seller_zip_code_prefix AS VARCHAR) AS seller_zip_code_prefix,
                   CASE WHEN CAST(seller_id AS BIGINT) % 3 <> 2 THEN seller_city END AS seller_city,
                   seller_state,
                   CASE WHEN CAST(seller_id AS BIGINT) % 3 = 1
                        THEN '{"seller_rating":"' || (CAST(seller_id AS BIGINT) % 5) || '"}' END
                       AS _rescued_data
            FROM br_sellers""",
        "csv_awkward_files": """
            SELECT seller_id,
                   CASE WHEN n <> 2 THEN CAST(seller_zip_code_prefix AS VARCHAR) END AS seller_zip_code_prefix,
                   CASE WHEN n <> 2 THEN seller_city END AS seller_city,
                   CASE WHEN n <> 2 THEN seller_state END AS seller_state,
                   CASE WHEN n = 2 THEN '{"_raw_line":"' || seller_id || '"}'
                        WHEN n = 3 THEN '{"note_c4":"' || seller_city || '","note_c5":"' || seller_state || '"}' END
                       AS _rescued_data
            FROM (SELECT *, CAST(seller_id AS BIGINT) % 4 AS n FROM br_sellers)""",
        "layout_report": " UNION ALL ".join(
            f"SELECT '{table}' AS \"table\", '{step}' AS step, 'done' AS status, count(*) AS rows FROM {table}"
            for table, columns in (
                ("fct_order_items", "order_purchase_timestamp, seller_id"),
                ("fct_payments", "order_date_key"), ("fct_reviews", "order_date_key"),
            )
            for step in (f"cluster and compact by {columns}", "statistics")
        ),
        "csv_reviews": """
            SELECT review_id, order_id, CAST(review_score AS VARCHAR) AS review_score,
                   review_comment_message || ',' || chr(10) || '"second line"'
                       AS review_comment_message
            FROM br_reviews""",
        "malformed_orders": """
            SELECT order_id,
                   concat_ws(',', CASE WHEN k % 50 = 3 THEN 'order_purchase_timestamp' END,
                             CASE WHEN k % 30 = 3 THEN 'order_approved_at' END) AS malformed
            FROM (SELECT order_id, CAST(order_id AS BIGINT) AS k FROM br_orders)
            WHERE k % 50 = 3 OR k % 30 = 3""",
        "newest_orders": """
            SELECT * REPLACE (
                CASE WHEN CAST(order_id AS BIGINT) % 9 = 0 THEN 'canceled' ELSE order_status END
                    AS order_status,
                CASE WHEN CAST(order_id AS BIGINT) % 9 = 0 THEN _ingested_at + INTERVAL 1 DAY
                     ELSE _ingested_at END AS _ingested_at)
            FROM br_orders""",
        "csv_inferred": _inferred(),
        "csv_all_sources": " UNION ALL ".join(_digest(name, columns) for name, columns in SOURCE_COLUMNS.items()),
        "csv_audit": """
            SELECT 'sellers' AS _source_system, count(*) AS rows, count(*) AS with_file, count(*) AS with_time FROM br_sellers""",
        "landing_gate": "SELECT * FROM (VALUES ('orders', 5::BIGINT), ('sellers', 0), ('products', -1)) AS v(source, files)",
        "drop_rules": " UNION ALL ".join(
            f"SELECT '{dataset}' AS dataset, '{column}' AS column_name, count(*) FILTER (WHERE {_digits(column)} % 50 <> 0) AS kept,"
            f" 0::BIGINT AS without FROM {_before_rules(dataset)}"
            for dataset, column in (
                ("sv_order_items", "order_id"), ("sv_order_items", "order_item_id"), ("sv_payments", "order_id"),
                ("sv_reviews", "review_id"), ("sv_reviews", "order_id"), ("sv_customer_keys", "customer_id"),
                ("sv_customer_keys", "customer_unique_id"),
            )
        ),
        "fail_rules": " UNION ALL ".join(
            f"SELECT '{dataset}' AS dataset, '{rule}' AS expectation, 'refused' AS outcome, count(*) AS rows FROM {dataset}"
            for dataset, rule in (
                ("dim_seller", "unique_seller"), ("dim_product", "unique_product"), ("dim_customer", "unique_person"),
                ("fct_order_items", "valid_sk"), ("fct_payments", "valid_sk"), ("fct_reviews", "valid_sk"),
            )
        ),
        "null_keys": " UNION ALL ".join(
            f"SELECT '{dataset}' AS dataset, count({what}) AS rows FROM {source} WHERE {_digits(key)} % 4 <> 0"
            for dataset, source, key, what in (
                ("sv_category_translation", "br_category_translation", "product_category_name", "*"),
                ("sv_geolocation", "br_geolocation", "geolocation_zip_code_prefix", "DISTINCT geolocation_zip_code_prefix"),
                ("sv_customers", "br_customers", "customer_unique_id", "DISTINCT customer_unique_id"),
            )
        ),
        "stream_quarantine": """
            SELECT 'sv_orders' AS "table", 'clean' AS reason, count(*) AS rows FROM sv_orders
            UNION ALL SELECT 'sv_quarantine_orders', _quarantine_reason, count(*) FROM sv_quarantine_orders GROUP BY 2""",
        "report_order": " UNION ALL ".join(
            f"SELECT '{report}' AS report, CAST(row_number() OVER (ORDER BY {order}) AS INT) AS position, {key} AS key FROM ({source})"
            for report, source, key, order in (
                ("months", "SELECT * FROM mart_monthly_revenue WHERE orders > 100", "year_month", "year_month"),
                ("delays", _DELAY_SCORE, "delay_bucket", "sort_key"),
                ("states", _STATE_REVENUE, "customer_state", "gmv DESC, customer_state"),
                ("state tile", _STATE_REVENUE, "customer_state", "gmv DESC, customer_state"),
                ("worst sellers", _WORST, "seller_id", "late_pct DESC, seller_id"),
                ("seller table", _WORST, "seller_id", "avg_delivery_days NULLS FIRST, avg_review_score NULLS FIRST, seller_id"),
                ("changes", """SELECT product_id || '@' || CAST(CAST("__START_AT" AS DATE) AS VARCHAR) AS k, product_id, "__START_AT"
                    FROM sv_products_history WHERE product_id IN (
                        SELECT product_id FROM sv_products_history GROUP BY product_id HAVING count(*) > 1)
                    ORDER BY product_id, "__START_AT" LIMIT 40""", "k", 'product_id, "__START_AT"'),
            )
        ),
        "layout_skipping": " UNION ALL ".join(
            f"SELECT '{layout}' AS layout, '{kind}' AS filter, {skips} AS skips_files, count(*) FILTER (WHERE {hit}) AS rows FROM fct_order_items"
            for layout, kind, skips in (("ranges", "month", True), ("ranges", "seller", False), ("curve", "month", True), ("curve", "seller", True))
            for hit in ["order_purchase_timestamp BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-04-01'" if kind == "month" else "seller_id = '7'"]
        ),
        "sql_views": """
            SELECT customer_state, left(min(customer_unique_id), 4) || '***REDACTED***' AS first_person, count(DISTINCT order_id) AS orders
            FROM fct_order_items f JOIN dim_customer c ON c.customer_sk = f.customer_sk GROUP BY customer_state""",
        "asof_hot_key": f"""
            WITH log AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, event_type, ts FROM events),
            held AS ({ordered_versions("(SELECT user_id, event_type, ts FROM log)", "user_id", "event_type", "ts")})
            SELECT l.event_id, l.user_id, l.ts - INTERVAL 1 DAY AS asked_at, h.event_type, h."__START_AT" AS version_start
            FROM log l LEFT JOIN held h ON h.user_id = l.user_id AND l.ts - INTERVAL 1 DAY >= h."__START_AT"
             AND (h."__END_AT" IS NULL OR l.ts - INTERVAL 1 DAY < h."__END_AT")""",
        "scd2_incremental": "SELECT * FROM sv_products_history",
        "scd2_hot_key": ordered_versions(
            "(SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, event_type, ts FROM events)",
            "user_id", "event_type", "ts",
        ),
        "scd2_three_batches": "SELECT arrangement, v.* FROM ("
        + ordered_versions("(SELECT user_id, event_type, ts FROM events)", "user_id", "event_type", "ts")
        + ") v, (VALUES ('in order'), ('reversed'), ('delivered twice')) AS a(arrangement)",
        "stream_rule_counts": " UNION ALL ".join(
            f"SELECT '{rule}' AS expectation, count(*) FILTER (WHERE coalesce({holds}, false)) AS passed,"
            f" count(*) FILTER (WHERE NOT coalesce({holds}, false)) AS failed FROM {_SPOILED_ORDERS}"
            for rule, holds in RULES["sv_orders"].items()
        ),
        "stream_spoiled_orders": f"""
            SELECT order_id, customer_id, order_status FROM {_SPOILED_ORDERS}
            WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_status IN ({_STATUSES})""",
        "stream_silver_orders": "SELECT * EXCLUDE (_source_file) FROM sv_orders",
        "mart_delivery_fanout_safe": f"""
            WITH scores AS (SELECT order_id, sum(review_score) AS score, count(review_score) AS n
                            FROM fct_reviews GROUP BY order_id),
            measured AS (
                SELECT customer_state, strftime(order_purchase_timestamp, '%Y-%m') AS year_month,
                       count(*) AS line_items, count(DISTINCT f.order_id) AS orders,
                       {money('gross_revenue')} AS gmv,
                       {mean('delivery_days', 1)} AS avg_delivery_days,
                       {mean('delivery_delay_days', 1)} AS avg_delay_days,
                       {near('100 * avg(CASE WHEN f.is_late_delivery THEN 1.0 ELSE 0.0 END)', 2)}
                           AS late_pct
                FROM fct_order_items f LEFT JOIN dim_customer c ON c.customer_sk = f.customer_sk
                WHERE is_delivered GROUP BY ALL),
            reviewed AS (
                SELECT customer_state, year_month,
                       {near('CAST(sum(score) AS DOUBLE) / sum(n)', 2)} AS avg_review_score
                FROM (SELECT DISTINCT f.order_id, customer_state,
                             strftime(order_purchase_timestamp, '%Y-%m') AS year_month
                      FROM fct_order_items f
                      LEFT JOIN dim_customer c ON c.customer_sk = f.customer_sk
                      WHERE is_delivered) JOIN scores USING (order_id) GROUP BY ALL)
            SELECT m.*, avg_review_score FROM measured m LEFT JOIN reviewed r
              ON r.customer_state IS NOT DISTINCT FROM m.customer_state
             AND r.year_month = m.year_month""",
    }
    out.update({name: statement(body) for name, body in bodies.items()})
    return out


STATEMENTS = _statements()
