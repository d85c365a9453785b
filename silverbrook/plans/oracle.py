"""The registered queries as SQL for DuckDB, written from the table mapping and the rules."""

from __future__ import annotations

from silverbrook import settings


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


STATES = _list(settings.STATE_CODES)
STATE_ROWS = _rows([(code, *info) for code, info in settings.STATES.items()])
CATEGORIES = "['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD']"
REASONS = _list(settings.END_REASONS)
JOURNEY = _list(settings.JOURNEY)
STEPS = _list(settings.SESSION_STEPS)
PAIRS = settings.MOJIBAKE
MONEY = "CAST({} AS DECIMAL(18,2))"


def _fixed(text: str) -> str:
    for bad, good in PAIRS:
        text = f"replace({text}, '{bad}', '{good}')"
    return text


def _total(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def _mean(column: str) -> str:
    return f"{_total(column)} / count({column})"




def _series(week: str) -> str:
    """Daily series per category with lags and the mean of a week's rows."""
    return f"""
        SELECT * FROM (SELECT category AS category_en, purchase_date, orders_count, total_revenue,
            isodow(purchase_date) AS day_of_week, isodow(purchase_date) >= 6 AS is_weekend,
            month(purchase_date) AS month, quarter(purchase_date) AS quarter,
            lag(orders_count, 1) OVER d AS lag_1, lag(orders_count, 7) OVER d AS lag_7,
            lag(orders_count, 14) OVER d AS lag_14,
            CAST(sum(orders_count) OVER w AS DOUBLE) / count(*) OVER w AS rolling_7d_mean
          FROM (SELECT category, purchase_date, count(DISTINCT order_id) AS orders_count,
              {_total('total_value')} AS total_revenue FROM fact_sales GROUP BY ALL)
          WINDOW d AS (PARTITION BY category ORDER BY purchase_date),
            w AS (PARTITION BY category ORDER BY purchase_date ROWS BETWEEN {week}))
        WHERE lag_14 IS NOT NULL"""


def _demand(rows: str) -> dict[str, tuple[list[str], str]]:
    """Parts that fit a ridge regression per category over a series, by Cholesky factors, and test it.

    The jobs solve the same systems by another elimination.
    """
    names, p = settings.DEMAND_FEATURES, range(len(settings.DEMAND_FEATURES))
    x = [f"CAST({name} AS DOUBLE)" for name in names]
    y = "CAST(orders_count AS DOUBLE)"
    train = "FILTER (WHERE is_train)"
    moments = [f"covar_pop({x[i]}, {x[j]}) {train} AS c_{i}_{j}" for i in p for j in p if i <= j]
    moments += [f"covar_pop({x[i]}, {y}) {train} AS cy_{i}" for i in p]
    moments += [f"covar_pop({y}, {y}) {train} AS cy", f"avg({y}) {train} AS my"]
    moments += [f"avg({x[i]}) {train} AS m_{i}" for i in p]
    # A layer of columns uses those of the layers before.
    layers = [
        [f"sqrt(greatest(c_{i}_{i}, 0)) AS s_{i}" for i in p] + ["sqrt(greatest(cy, 0)) AS sy"],
        [f"s_{i} = 0 OR sy = 0 AS f_{i}" for i in p] + ["CASE WHEN sy = 0 THEN 1 ELSE sy END AS ky"],
        [f"CASE WHEN f_{i} THEN 1 ELSE s_{i} END AS k_{i}" for i in p],
        [f"CASE WHEN f_{i} OR f_{j} THEN 0 ELSE c_{i}_{j} / (k_{i} * k_{j}) END AS a_{j}_{i}" for i in p for j in p if i < j]
        + [f"CASE WHEN f_{i} THEN 1 ELSE c_{i}_{i} / (k_{i} * k_{i}) END + {settings.DEMAND_REG}::DOUBLE / ky AS a_{i}_{i}"
           for i in p]
        + [f"CASE WHEN f_{i} THEN 0 ELSE cy_{i} / (k_{i} * ky) END AS b_{i}" for i in p],
    ]
    for j in p:
        layers.append([f"sqrt(a_{j}_{j}" + "".join(f" - l_{j}_{k} * l_{j}_{k}" for k in range(j)) + f") AS l_{j}_{j}"])
        layers.append([f"(a_{i}_{j}" + "".join(f" - l_{i}_{k} * l_{j}_{k}" for k in range(j)) + f") / l_{j}_{j} AS l_{i}_{j}"
                       for i in p if i > j])
    layers += [[f"(b_{i}" + "".join(f" - l_{i}_{k} * z_{k}" for k in range(i)) + f") / l_{i}_{i} AS z_{i}"] for i in p]
    layers += [[f"(z_{i}" + "".join(f" - l_{k}_{i} * w_{k}" for k in p if k > i) + f") / l_{i}_{i} AS w_{i}"]
               for i in reversed(p)]
    layers += [[f"w_{i} * ky / k_{i} AS x_{i}" for i in p], ["my - (" + " + ".join(f"x_{i} * m_{i}" for i in p) + ") AS x0"]]
    models = f"SELECT category_en, {', '.join(moments)} FROM {rows}_cut GROUP BY category_en HAVING bool_or(NOT is_train)"
    for layer in filter(None, layers):
        models = f"SELECT *, {', '.join(layer)} FROM ({models})"
    predicted = "x0 + " + " + ".join(f"x_{i} * {x[i]}" for i in p)
    return {
        f"{rows}_cut": (
            [rows],
            f"""
            SELECT *, purchase_date <= max(CASE WHEN n <= floor(n_rows * {settings.DEMAND_TRAIN_SHARE}::DOUBLE)
                THEN purchase_date END) OVER (PARTITION BY category_en) AS is_train
            FROM (SELECT *, count(*) OVER (PARTITION BY category_en) AS n_rows,
                row_number() OVER (PARTITION BY category_en ORDER BY purchase_date) AS n
              FROM {rows} WHERE category_en IS NOT NULL)
            WHERE n_rows >= {settings.DEMAND_MIN_ROWS}""",
        ),
        f"{rows}_models": ([f"{rows}_cut"], f"SELECT category_en, x0, {', '.join(f'x_{i}' for i in p)} FROM ({models})"),
        f"{rows}_errors": (
            [f"{rows}_models"],
            f"""
            SELECT category_en, sqrt(avg(error * error)) AS rmse, avg(abs(error)) AS mae, count(*) AS n_test
            FROM (SELECT category_en, {y} - ({predicted}) AS error
              FROM {rows}_cut JOIN {rows}_models USING (category_en) WHERE NOT is_train)
            GROUP BY category_en""",
        ),
    }


def _calendar_of(day: str) -> list[str]:
    return [f"isodow({day})", f"CAST(isodow({day}) >= 6 AS INTEGER)", f"month({day})", f"quarter({day})"]


# name -> (needs, select)
CTES: dict[str, tuple[list[str], str]] = {
    "states": ([], f"SELECT * FROM (VALUES {STATE_ROWS}) v(state, state_name, region)"),
    "raw_clicks": (
        [],
        f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id,
          CASE WHEN event_id % 33 = 0 THEN NULL WHEN event_id % 101 = 0 THEN ''
               ELSE user_id || '-' || strftime(ts, '%Y%m%d') END AS session_id,
          CAST(user_id AS VARCHAR) AS user_id,
          CASE WHEN event_id % 50 = 0 THEN NULL ELSE CASE event_type
            WHEN 'signup' THEN 'session_start' WHEN 'view' THEN 'product_view'
            WHEN 'click' THEN 'add_to_cart' WHEN 'purchase' THEN 'order_placed'
            WHEN 'error' THEN 'session_end' END END AS event_type,
          CASE WHEN event_id % 97 = 0 THEN 'not-a-time'
               ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp_text,
          CASE event_id % 25 WHEN 0 THEN 'bot' WHEN 1 THEN '' WHEN 2 THEN NULL
               ELSE ['mobile', 'desktop', 'tablet'][user_id % 3 + 1] END AS device,
          event_id % 89 = 0 AS broken,
          CAST(k AS VARCHAR) AS product_id,
          {CATEGORIES}[k % 6 + 1] AS category,
          value AS price,
          CASE WHEN k % 5 <> 0 THEN {STATES}[k % 27 + 1] END AS state,
          'city_' || k AS city,
          CASE WHEN event_type = 'error' THEN {REASONS}[k % 5 + 1] END AS reason,
          ts
        FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
              FROM events)""",
    ),
    "silver_clickstream": (
        ["raw_clicks"],
        """
        SELECT event_id, session_id, user_id, event_type,
          TRY_CAST(timestamp_text AS TIMESTAMP) AS event_ts,
          CASE WHEN device IN ('mobile', 'desktop', 'tablet') THEN device ELSE 'unknown' END
            AS device,
          CASE WHEN NOT broken THEN category END AS category,
          CASE WHEN NOT broken THEN product_id END AS product_id,
          CASE WHEN NOT broken THEN price END AS price,
          CASE WHEN NOT broken THEN coalesce(state, city) END AS location,
          ts AS ingested_at
        FROM raw_clicks
        WHERE event_id IS NOT NULL AND length(session_id) > 0 AND length(event_type) > 0
          AND TRY_CAST(timestamp_text AS TIMESTAMP) >= TIMESTAMP '1900-01-01'
          AND TRY_CAST(timestamp_text AS TIMESTAMP) < TIMESTAMP '2200-01-01'""",
    ),
    "order_lines": (
        [],
        f"""
        SELECT l_orderkey || '-' || l_linenumber AS order_id,
          o_custkey || '-' || strftime(o_orderdate, '%Y%m%d') AS session_id,
          CAST(o_custkey AS VARCHAR) AS customer_id,
          CAST(l_partkey AS VARCHAR) AS product_id,
          CAST(l_suppkey AS VARCHAR) AS seller_id,
          CASE WHEN l_partkey % 20 = 0 THEN '  ' || p_type || '  ' ELSE p_type END AS category,
          CASE WHEN l_partkey % 41 = 0 THEN 'N/A'
               WHEN l_partkey % 25 = 0 THEN CAST(-amount AS VARCHAR)
               WHEN l_partkey % 37 = 0 THEN CAST(amount AS VARCHAR) || '5'
               ELSE CAST(amount AS VARCHAR) END AS price,
          CAST(CAST(round(amount * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS VARCHAR)
            AS freight_value,
          epoch_us(o_orderdate) AS purchase_timestamp,
          CASE WHEN l_suppkey % 17 = 0 THEN lower(code)
               WHEN l_suppkey % 19 = 0 THEN ' ' || code || ' '
               WHEN l_suppkey % 23 = 0 THEN code || '0' ELSE code END AS state,
          CASE WHEN l_quantity = 50 THEN 'd' WHEN l_returnflag = 'R' THEN 'u' ELSE 'c' END
            AS cdc_operation,
          epoch_ms(l_shipdate) AS cdc_ts_ms,
          l_shipdate, o_orderdate
        FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
                {STATES}[c_nationkey + 1] AS code
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)""",
    ),
    "raw_orders": (["order_lines"], "SELECT * FROM order_lines WHERE cdc_operation <> 'd'"),
    "clean_orders": (
        ["raw_orders", "states"],
        """
        SELECT order_id, session_id, customer_id, product_id, seller_id, trim(category) AS category,
          CAST(CAST(CAST(price AS DECIMAL(24,6)) AS DECIMAL(18,2)) AS DOUBLE) AS price,
          CAST(CAST(CAST(freight_value AS DECIMAL(24,6)) AS DECIMAL(18,2)) AS DOUBLE) AS freight_value,
          CAST(CAST(CAST(price AS DECIMAL(24,6)) + CAST(freight_value AS DECIMAL(24,6)) AS DECIMAL(18,2)) AS DOUBLE)
            AS total_value,
          make_timestamp(purchase_timestamp) AS purchase_ts,
          s.state, coalesce(s.region, 'Desconhecido') AS region, l_shipdate AS ingested_at,
          cdc_ts_ms, cdc_operation
        FROM (SELECT * FROM raw_orders WHERE TRY_CAST(price AS DOUBLE) > 0
              AND TRY_CAST(price AS DOUBLE) < 1e15
              AND TRY_CAST(freight_value AS DOUBLE) >= 0 AND TRY_CAST(freight_value AS DOUBLE) < 1e15
              AND make_timestamp(purchase_timestamp) >= TIMESTAMP '1900-01-01'
              AND make_timestamp(purchase_timestamp) < TIMESTAMP '2200-01-01') r
          LEFT JOIN states s ON s.state = upper(trim(r.state))""",
    ),
    "silver_orders": (
        ["clean_orders"],
        """
        SELECT * EXCLUDE (cdc_ts_ms, cdc_operation) FROM clean_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY cdc_ts_ms DESC,
          CAST(product_id AS BIGINT) DESC, CAST(seller_id AS BIGINT) DESC, price DESC,
          freight_value DESC) = 1""",
    ),
    "raw_reviews": (
        [],
        """
        SELECT *, concat_ws(chr(10), 'REVIEW_ID: ' || review_id, 'ORDER_ID: ' || order_id,
            'CUSTOMER_ID: ' || customer_id, 'RATING: ' || rating || '/5',
            'TIMESTAMP: ' || strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f'), '---', title_line, '',
            body) AS raw_content
        FROM (SELECT doc_id,
            CASE WHEN doc_id % 43 = 0 THEN '' WHEN doc_id % 20 = 19 THEN CAST(doc_id - 1 AS VARCHAR)
                 ELSE CAST(doc_id AS VARCHAR) END AS review_id,
            (doc_id % 250) || '-' || (1 + doc_id % 5) AS order_id,
            CAST(doc_id % 1500 AS VARCHAR) AS customer_id,
            CASE WHEN doc_id % 23 = 0 THEN 'N/A' WHEN doc_id % 29 = 0 THEN '-1'
                 WHEN doc_id % 31 = 0 THEN '7' ELSE CAST(1 + (doc_id // 3) % 5 AS VARCHAR) END
              AS rating,
            CASE WHEN doc_id % 2 = 0 THEN 'TITLE: Review ' || doc_id END AS title_line,
            CASE WHEN doc_id % 37 = 0 THEN '   '
                 WHEN doc_id % 14 = 0 THEN replace(text, 'é', 'Ã©') ELSE text END AS body,
            TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 60 AS INTEGER)) AS ingested_at
          FROM documents)""",
    ),
    "silver_reviews": (
        ["raw_reviews"],
        f"""
        SELECT review_id, order_id, customer_id, rating, title, message,
          len(regexp_split_to_array(message, '\\s+')) AS text_length, ingested_at
        FROM (SELECT review_id, order_id, customer_id,
            TRY_CAST(regexp_replace(rating, '[^0-9\\-]', '', 'g') AS INTEGER) AS rating,
            regexp_extract(raw_content, '(?m)^TITLE: (.*)$', 1) AS title,
            {_fixed(
                f"trim(regexp_extract(raw_content, '{settings.REVIEW_MESSAGE}', 1))"
            )} AS message,
            ingested_at, doc_id
          FROM raw_reviews)
        WHERE length(review_id) > 0 AND length(order_id) > 0 AND rating BETWEEN 1 AND 5
          AND length(trim(message)) > 0
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY ingested_at DESC, doc_id DESC)
          = 1""",
    ),
    "fact_sales": (
        ["silver_orders", "states"],
        """
        SELECT order_id, session_id, customer_id, product_id, seller_id,
          CAST(strftime(purchase_ts, '%Y%m%d') AS INTEGER) AS date_id, category,
          o.state, s.region, price, freight_value, total_value, purchase_ts,
          CAST(purchase_ts AS DATE) AS purchase_date
        FROM silver_orders o LEFT JOIN states s ON o.state = s.state""",
    ),
    "fact_clickstream": (
        ["silver_clickstream"],
        """
        SELECT event_id, session_id, user_id, event_type, event_ts,
          CAST(event_ts AS DATE) AS event_date, device,
          CAST(strftime(event_ts, '%Y%m%d') AS INTEGER) AS date_id, category, product_id, price,
          location
        FROM silver_clickstream""",
    ),
    "fact_reviews": (
        ["silver_reviews"],
        """
        SELECT review_id, order_id, customer_id, rating,
          CASE WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral'
               ELSE 'negative' END AS sentiment,
          title, message, text_length,
          CAST(strftime(ingested_at, '%Y%m%d') AS INTEGER) AS date_id,
          CAST(ingested_at AS DATE) AS review_date
        FROM silver_reviews""",
    ),
    "executive": (
        ["fact_sales", "fact_reviews"],
        f"""
        SELECT s.purchase_date AS day, count(DISTINCT s.order_id) AS total_orders,
          count(DISTINCT s.customer_id) AS total_customers,
          {_total('s.total_value')} AS total_revenue,
          {_mean('s.total_value')} AS avg_order_value,
          avg(CAST(r.rating AS DOUBLE)) AS avg_rating,
          count(DISTINCT CASE WHEN r.sentiment = 'positive' THEN r.review_id END)
            AS positive_reviews,
          count(DISTINCT CASE WHEN r.sentiment = 'negative' THEN r.review_id END)
            AS negative_reviews
        FROM fact_sales s LEFT JOIN fact_reviews r ON s.order_id = r.order_id
        GROUP BY s.purchase_date""",
    ),
    "performance": (
        ["fact_sales"],
        f"""
        SELECT purchase_date, category, state, region, count(DISTINCT order_id) AS orders,
          count(DISTINCT customer_id) AS customers, {_total('total_value')} AS revenue,
          {_mean('total_value')} AS avg_order_value, {_total('price')} AS product_revenue,
          {_total('freight_value')} AS freight_revenue
        FROM fact_sales GROUP BY purchase_date, category, state, region""",
    ),
    "funnel": (
        ["fact_clickstream"],
        """
        SELECT CAST(date_trunc('hour', event_ts) AS TIMESTAMP) AS hour, event_date, event_type,
          device, category, count(*) AS event_count, count(DISTINCT session_id) AS sessions,
          count(DISTINCT user_id) AS users
        FROM fact_clickstream
        GROUP BY date_trunc('hour', event_ts), event_date, event_type, device, category""",
    ),
    "review_mart": (
        ["fact_reviews", "fact_sales"],
        """
        SELECT review_date, sentiment, category, region, count(review_id) AS review_count,
          avg(CAST(rating AS DOUBLE)) AS avg_rating,
          avg(CAST(text_length AS DOUBLE)) AS avg_text_length
        FROM fact_reviews r LEFT JOIN fact_sales s ON r.order_id = s.order_id
        GROUP BY review_date, sentiment, category, region""",
    ),
    "trends": (
        ["fact_sales"],
        f"""
        SELECT purchase_date, orders, revenue,
          CASE WHEN o7 > 0 THEN CAST(orders - o7 AS DOUBLE) / o7 * 100 END AS orders_growth_pct,
          CASE WHEN r7 > 0 THEN (revenue - r7) / r7 * 100 END AS revenue_growth_pct,
          CASE WHEN r7 > 0 AND r14 > 0 THEN (revenue - r7) / r7 - (r7 - r14) / r14 END
            AS revenue_acceleration,
          CASE WHEN dev > 0 AND abs(revenue - mean) > 2 * dev THEN 1 ELSE 0 END AS anomaly_flag
        FROM (SELECT *, lag(orders, 7) OVER d AS o7, lag(revenue, 7) OVER d AS r7,
            lag(revenue, 14) OVER d AS r14, avg(revenue) OVER m AS mean,
            stddev_pop(revenue) OVER m AS dev
          FROM (SELECT purchase_date, count(DISTINCT order_id) AS orders,
              {_total('total_value')} AS revenue FROM fact_sales GROUP BY purchase_date)
          WINDOW d AS (ORDER BY purchase_date),
            m AS (ORDER BY purchase_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))""",
    ),
    "category_trends": (
        ["fact_sales"],
        f"""
        SELECT purchase_date, category, orders, revenue,
          CASE WHEN o7 > 0 THEN CAST(orders - o7 AS DOUBLE) / o7 * 100 END AS orders_growth_pct,
          CASE WHEN r7 > 0 THEN (revenue - r7) / r7 * 100 END AS revenue_growth_pct
        FROM (SELECT *, lag(orders, 7) OVER d AS o7, lag(revenue, 7) OVER d AS r7
          FROM (SELECT purchase_date, category, count(DISTINCT order_id) AS orders,
              {_total('total_value')} AS revenue FROM fact_sales
              GROUP BY purchase_date, category)
          WINDOW d AS (PARTITION BY category ORDER BY purchase_date))""",
    ),
    "monthly_sales": (
        ["fact_sales"],
        """SELECT CAST(date_trunc('month', purchase_date) AS DATE) AS purchase_date FROM fact_sales
        WHERE purchase_date IS NOT NULL""",
    ),
    "recent_executive": (
        ["executive"],
        """SELECT * FROM executive
        WHERE day >= (SELECT max(purchase_date) FROM fact_sales) - INTERVAL 90 DAY""",
    ),
    "recent_performance": (
        ["performance"],
        """SELECT * FROM performance
        WHERE purchase_date >= (SELECT max(purchase_date) FROM fact_sales) - INTERVAL 90 DAY""",
    ),
    "recent_funnel": (
        ["funnel"],
        """SELECT * FROM funnel
        WHERE event_date >= (SELECT max(event_date) FROM fact_clickstream) - INTERVAL 7 DAY""",
    ),
    "recent_reviews": (
        ["review_mart"],
        """SELECT * FROM review_mart
        WHERE review_date >= (SELECT max(review_date) FROM fact_reviews) - INTERVAL 90 DAY""",
    ),
    "calendar": (
        ["silver_orders", "silver_clickstream", "silver_reviews"],
        """
        SELECT CAST(d AS DATE) AS date_actual FROM (SELECT unnest(generate_series(
            date_trunc('year', a), CAST(year(b) || '-12-31' AS TIMESTAMP), INTERVAL 1 DAY)) AS d
          FROM (SELECT min(ts) AS a, max(ts) AS b FROM (
            SELECT purchase_ts AS ts FROM silver_orders UNION ALL
            SELECT event_ts FROM silver_clickstream UNION ALL
            SELECT ingested_at FROM silver_reviews)))""",
    ),
    "churn_features": (
        ["fact_sales", "fact_reviews"],
        f"""
        SELECT s.customer_id, s.recency, s.frequency, s.monetary,
          coalesce(r.avg_rating, 3.0) AS avg_rating,
          CASE WHEN s.recency > 30 THEN 1 ELSE 0 END AS churned
        FROM (SELECT customer_id,
            date_diff('day', max(purchase_date), (SELECT max(purchase_date) FROM fact_sales))
              AS recency,
            count(DISTINCT order_id) AS frequency, {_total('total_value')} AS monetary
          FROM fact_sales GROUP BY customer_id) s
        LEFT JOIN (SELECT customer_id, avg(CAST(rating AS DOUBLE)) AS avg_rating
          FROM fact_reviews GROUP BY customer_id) r ON s.customer_id = r.customer_id""",
    ),
    "series": (["fact_sales"], _series("6 PRECEDING AND CURRENT ROW")),
    "leak_free": (["fact_sales"], _series("7 PRECEDING AND 1 PRECEDING")),
    **_demand("series"),
    **_demand("leak_free"),
    "outcomes": (
        ["raw_clicks"],
        f"""
        SELECT session_id, depth, CASE WHEN depth IS NOT NULL THEN {STEPS}[depth + 1] END
            AS deepest_step, end_reason, events
        FROM (SELECT session_id,
            max(nullif(list_position({STEPS}, event_type), 0) - 1) AS depth, count(*) AS events
          FROM raw_clicks WHERE length(session_id) > 0 AND length(event_type) > 0
          GROUP BY session_id)
        LEFT JOIN (SELECT session_id, reason AS end_reason FROM raw_clicks
          WHERE length(session_id) > 0 AND event_type = 'session_end' AND NOT broken
            AND reason IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY session_id
            ORDER BY TRY_CAST(timestamp_text AS TIMESTAMP) DESC NULLS LAST, reason DESC) = 1)
        USING (session_id)""",
    ),
}


def with_ctes(select: str, *needs: str) -> str:
    """A statement with the named parts, and what they need, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for other in CTES[name][0]:
            add(other)
        order.append(name)

    for name in needs:
        add(name)
    parts = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order)
    return f"WITH {parts}\n{select}" if parts else select


def _all(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}", name)


def _quality(source: str, table: str, rules: dict[str, str], key: str) -> str:
    counts = {name: f"count(*) FILTER (WHERE {test})" for name, test in rules.items()}
    counts["duplicate_key"] = f"count({key}) - count(DISTINCT {key})"
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{name}' AS rule, count(*) AS rows_checked, "
        f"{count} AS rows_hit FROM {table}"
        for name, count in counts.items()
    )


_MESSAGE = f"trim(regexp_extract(raw_content, '{settings.REVIEW_MESSAGE}', 1))"
_CODE = f"CASE WHEN list_contains({STATES}, upper(trim(state))) THEN upper(trim(state)) END"
_RATING = "TRY_CAST(regexp_replace(rating, '[^0-9\\-]', '', 'g') AS INTEGER)"

QUALITY = " UNION ALL ".join(
    [
        _quality(
            "clickstream",
            "raw_clicks",
            {
                "missing_event_id": "event_id IS NULL",
                "missing_session": "session_id IS NULL OR session_id = ''",
                "missing_event_type": "event_type IS NULL OR event_type = ''",
                "unknown_device":
                    "device IS NULL OR device NOT IN ('mobile', 'desktop', 'tablet')",
                "bad_timestamp": "TRY_CAST(timestamp_text AS TIMESTAMP) IS NULL",
                "implausible_timestamp": "TRY_CAST(timestamp_text AS TIMESTAMP) < TIMESTAMP '1900-01-01'"
                " OR TRY_CAST(timestamp_text AS TIMESTAMP) >= TIMESTAMP '2200-01-01'",
            },
            "event_id",
        ),
        _quality(
            "orders",
            "raw_orders",
            {
                "missing_id": "order_id IS NULL OR customer_id IS NULL",
                "bad_price": "NOT coalesce(TRY_CAST(price AS DOUBLE) > 0 AND "
                "TRY_CAST(price AS DOUBLE) < 1e15, false)",
                "bad_freight": "NOT coalesce(TRY_CAST(freight_value AS DOUBLE) >= 0 AND "
                "TRY_CAST(freight_value AS DOUBLE) < 1e15, false)",
                "bad_state": f"({_CODE}) IS NULL",
                "repaired_state": f"({_CODE}) <> state",
                "padded_category": "trim(category) <> category",
                "missing_purchase_time": "purchase_timestamp IS NULL",
                "implausible_purchase_time": "make_timestamp(purchase_timestamp) < TIMESTAMP '1900-01-01'"
                " OR make_timestamp(purchase_timestamp) >= TIMESTAMP '2200-01-01'",
            },
            "order_id",
        ),
        _quality(
            "reviews",
            "raw_reviews",
            {
                "missing_id": "review_id = '' OR order_id = ''",
                "bad_rating": f"coalesce({_RATING}, 0) NOT BETWEEN 1 AND 5",
                "empty_message": f"{_MESSAGE} = ''",
                "damaged_encoding": " OR ".join(
                    f"contains({_MESSAGE}, '{bad}')" for bad, _ in PAIRS
                ),
            },
            "review_id",
        ),
    ]
)

_STEP_COUNTS = " UNION ALL ".join(
    f"SELECT {at} AS step_order, '{name}' AS step, "
    f"count(*) FILTER (WHERE depth >= {at}) AS sessions, "
    f"CAST(count(*) FILTER (WHERE depth >= {at}) AS DOUBLE) / "
    f"nullif(count(*) FILTER (WHERE depth >= {max(at - 1, 0)}), 0) AS rate FROM outcomes"
    for at, name in enumerate(settings.SESSION_STEPS)
)

_AUDIT = " UNION ALL ".join(
    f"SELECT '{step}' AS step, 'SUCCESS' AS status, count(*) AS records FROM {table}"
    for step, table in [
        ("silver_clickstream", "silver_clickstream"),
        ("silver_orders", "silver_orders"),
        ("silver_reviews", "silver_reviews"),
        ("dim_date", "calendar"),
        ("dim_category", "(SELECT DISTINCT category FROM (SELECT category FROM silver_orders "
         "UNION ALL SELECT category FROM silver_clickstream) WHERE category IS NOT NULL)"),
        ("dim_geography", "states"),
        ("fact_sales", "fact_sales"),
        ("fact_clickstream", "fact_clickstream"),
        ("fact_reviews", "fact_reviews"),
    ]
)

_ITEM_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_tax"

# Day after day: what is predicted for a day is the last of the fourteen counts before the next.
_RECURSION = f"""
    WITH RECURSIVE made AS (
      SELECT category_en, (SELECT max(purchase_date) FROM fact_sales) AS forecast_date, 0 AS n, 0.0::DOUBLE AS predicted,
        seen FROM (SELECT category_en, list(CAST(orders_count AS DOUBLE) ORDER BY purchase_date) AS seen
          FROM (SELECT * FROM leak_free QUALIFY row_number() OVER
            (PARTITION BY category_en ORDER BY purchase_date DESC) <= 14)
          GROUP BY category_en HAVING count(*) = 14)
      UNION ALL
      SELECT category_en, day, n + 1, value, list_append(seen[2:14], value)
      FROM (SELECT made.*, CAST(forecast_date + INTERVAL 1 DAY AS DATE) AS day, greatest(0, x0 + x_0 * seen[14]
          + x_1 * seen[8] + x_2 * seen[1] + x_3 * (list_sum(seen[8:14]) / 7) + {' + '.join(
            f'x_{i} * {v}' for i, v in enumerate(_calendar_of('(forecast_date + INTERVAL 1 DAY)'), start=4))}) AS value
        FROM made JOIN leak_free_models USING (category_en) WHERE n < {settings.FORECAST_DAYS}))
    SELECT * FROM made"""

SQL: dict[str, str] = {
    "silver_clickstream": _all("silver_clickstream"),
    "silver_orders": _all("silver_orders"),
    "silver_reviews": _all("silver_reviews"),
    "cdc_unwrap": with_ctes(
        """SELECT order_id, session_id, customer_id, product_id, seller_id, category, price,
          freight_value, purchase_timestamp, state, cdc_operation, cdc_ts_ms FROM raw_orders""",
        "raw_orders",
    ),
    "event_stream_filter": with_ctes(
        """SELECT event_id, session_id, user_id, event_type, timestamp_text AS timestamp, device,
          product_id, category, price, state, city, reason, 'kafka' AS source
        FROM raw_clicks WHERE event_type IS NULL OR event_type <> 'order_placed'""",
        "raw_clicks",
    ),
    "insert_new_keys": with_ctes(
        """SELECT CAST(batch_id AS BIGINT) AS batch_id, order_id, product_id, seller_id,
          total_value
        FROM (SELECT *, CASE cdc_operation WHEN 'c' THEN 0 ELSE 1 END AS batch_id
              FROM clean_orders)
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY batch_id, cdc_ts_ms DESC,
          CAST(product_id AS BIGINT) DESC, CAST(seller_id AS BIGINT) DESC, price DESC,
          freight_value DESC) = 1""",
        "clean_orders",
    ),
    "stream_silver_orders": with_ctes(
        "SELECT * EXCLUDE (ingested_at) FROM silver_orders", "silver_orders"
    ),
    "stream_silver_orders_many_batches": with_ctes(
        "SELECT * EXCLUDE (ingested_at) FROM silver_orders", "silver_orders"
    ),
    "land_review_files": with_ctes(
        """SELECT review_id, order_id, customer_id, rating,
          regexp_extract(raw_content, '(?m)^TITLE: (.*)$', 1) AS title, raw_content FROM raw_reviews""",
        "raw_reviews",
    ),
    "stream_audit": with_ctes(
        """SELECT 'land_events' AS step, 'SUCCESS' AS status, count(*) AS records FROM raw_clicks
          WHERE event_type IS NULL OR event_type <> 'order_placed'
        UNION ALL SELECT 'silver_clickstream', 'SUCCESS', count(*) FROM raw_clicks
          WHERE length(session_id) > 0 AND length(event_type) > 0 AND event_type <> 'order_placed'
            AND TRY_CAST(timestamp_text AS TIMESTAMP) >= TIMESTAMP '1900-01-01'
            AND TRY_CAST(timestamp_text AS TIMESTAMP) < TIMESTAMP '2200-01-01'
        UNION ALL SELECT 'again', 'SUCCESS', 0 UNION ALL SELECT 'missing_input', 'SUCCESS', 0""",
        "raw_clicks",
    ),
    "preview_sales": with_ctes(
        """SELECT order_id, customer_id, product_id, category, total_value, purchase_date
        FROM fact_sales ORDER BY order_id LIMIT 100""",
        "fact_sales",
    ),
    "replaced_days": with_ctes(
        """SELECT purchase_date, count(*) AS orders, CASE WHEN purchase_date < (SELECT
            CAST(min(purchase_date) + CAST(floor(date_diff('day', min(purchase_date), max(purchase_date)) / 2)
            AS INTEGER) AS DATE) FROM monthly_sales) THEN count(*) ELSE 0 END AS written_again
        FROM monthly_sales GROUP BY purchase_date""",
        "monthly_sales",
    ),
    "managed_tables": with_ctes(
        """SELECT 'clickstream' AS name, count(*) AS n_rows FROM silver_clickstream
        UNION ALL SELECT 'orders', count(*) FROM silver_orders
        UNION ALL SELECT 'reviews', count(*) FROM silver_reviews""",
        "silver_clickstream", "silver_orders", "silver_reviews",
    ),
    "reference_csv": """SELECT CAST(doc_id AS VARCHAR) AS review_id,
        CAST(1 + (doc_id // 3) % 5 AS VARCHAR) AS review_score,
        CASE WHEN doc_id % 2 = 0 THEN ' Review ' || doc_id END AS review_comment_title,
        CASE WHEN doc_id % 37 = 0 THEN '   ' ELSE text END AS review_comment_message
      FROM documents""",
    "time_series_leak_free": with_ctes(
        "SELECT * REPLACE (round(rolling_7d_mean, 6) AS rolling_7d_mean) FROM leak_free", "leak_free"),
    "demand_metrics": with_ctes(
        """SELECT category_en, round(rmse, 6) AS rmse, round(mae, 6) AS mae, n_test FROM series_errors""",
        "series_errors"),
    "demand_forecast": with_ctes(
        f"""SELECT category_en AS category, CAST(d AS DATE) AS forecast_date, round(greatest(x0 + {' + '.join(
            f'x_{i} * {v}' for i, v in enumerate(_calendar_of('d'), start=4))}, 0), 6) AS predicted_orders,
          round(rmse, 4) AS model_rmse, round(mae, 4) AS model_mae
        FROM series_models JOIN series_errors USING (category_en),
          (SELECT unnest(generate_series(max(purchase_date) + INTERVAL 1 DAY,
            max(purchase_date) + INTERVAL {settings.FORECAST_DAYS} DAY, INTERVAL 1 DAY)) AS d FROM fact_sales)""",
        "series_errors"),
    "demand_runs": with_ctes(
        f"""SELECT 'demand_' || category_en AS run_name, unnest(['param', 'param', 'param', 'metric', 'metric']) AS kind,
          unnest(['category', 'algorithm', 'reg_param', 'rmse', 'mae']) AS name,
          unnest([category_en, 'LinearRegression', '{settings.DEMAND_REG}', format('{{:,.6f}}', rmse),
            format('{{:,.6f}}', mae)]) AS value FROM series_errors""",
        "series_errors"),
    "demand_forecast_recursive": with_ctes(
        f"""SELECT category_en, forecast_date, round(predicted, 6) AS predicted_orders FROM ({_RECURSION})
        WHERE n > 0""",
        "leak_free_models"),
    "risk_labels": with_ctes(
        """SELECT risk_label, count(*) AS total_customers, round(avg(p), 6) AS avg_churn_prob,
          round(avg(recency), 6) AS avg_recency, round(avg(frequency), 6) AS avg_frequency,
          round(avg(monetary), 6) AS avg_monetary, 0.5::DOUBLE AS model_f1, 0.75::DOUBLE AS model_auc
        FROM (SELECT *, CASE WHEN p > 0.7 THEN 'high' WHEN p > 0.4 THEN 'medium' ELSE 'low' END AS risk_label
              FROM (SELECT *, least(recency / 365.0::DOUBLE, 1.0) AS p FROM churn_features))
        GROUP BY risk_label""",
        "churn_features",
    ),
    "churn_score_columns": with_ctes(
        "SELECT customer_id, recency, frequency, monetary, true AS sound FROM churn_features", "churn_features"),
    "risk_label_counts": with_ctes(
        """SELECT count(*) FILTER (WHERE p > 0.7) AS high_risk, count(*) FILTER (WHERE p <= 0.4) AS low_risk
        FROM (SELECT least(recency / 365.0::DOUBLE, 1.0) AS p FROM churn_features)""",
        "churn_features",
    ),
    "run_totals": with_ctes(
        f"""SELECT 'SUCCESS' AS status, count(*) AS steps, CAST(sum(records) AS BIGINT) AS records,
          true AS timed FROM ({_AUDIT})""",
        "silver_clickstream", "silver_orders", "silver_reviews", "calendar", "states",
        "fact_sales", "fact_clickstream", "fact_reviews",
    ),
    "stream_silver_clickstream": with_ctes(
        """SELECT event_id, session_id, user_id, event_type,
          TRY_CAST(timestamp_text AS TIMESTAMP) AS event_ts,
          CASE WHEN device IN ('mobile', 'desktop', 'tablet') THEN device ELSE 'unknown' END
            AS device,
          category, product_id, price, coalesce(state, city) AS location
        FROM raw_clicks
        WHERE length(session_id) > 0 AND length(event_type) > 0 AND event_type <> 'order_placed'
          AND TRY_CAST(timestamp_text AS TIMESTAMP) >= TIMESTAMP '1900-01-01'
          AND TRY_CAST(timestamp_text AS TIMESTAMP) < TIMESTAMP '2200-01-01'""",
        "raw_clicks",
    ),
    "stream_silver_reviews": _all("silver_reviews"),
    "dim_date": with_ctes(
        """SELECT CAST(strftime(date_actual, '%Y%m%d') AS INTEGER) AS date_id, date_actual,
          year(date_actual) AS year, quarter(date_actual) AS quarter, month(date_actual) AS month,
          week(date_actual) AS week, isodow(date_actual) AS day_of_week,
          dayname(date_actual) AS day_name, monthname(date_actual) AS month_name,
          isodow(date_actual) >= 6 AS is_weekend FROM calendar""",
        "calendar",
    ),
    "dim_category": with_ctes(
        """SELECT DISTINCT category AS category_en FROM (SELECT category FROM silver_orders
          UNION ALL SELECT category FROM silver_clickstream) WHERE category IS NOT NULL""",
        "silver_orders",
        "silver_clickstream",
    ),
    "dim_geography": with_ctes(
        """SELECT s.state, s.state_name, s.region, count(o.order_id) AS orders
        FROM states s LEFT JOIN silver_orders o ON s.state = o.state GROUP BY ALL""",
        "states",
        "silver_orders",
    ),
    "fact_sales": _all("fact_sales"),
    "fact_clickstream": _all("fact_clickstream"),
    "fact_reviews": _all("fact_reviews"),
    "mart_executive": _all("executive"),
    "mart_executive_general": _all("executive"),
    "mart_executive_no_fan_out": with_ctes(
        f"""SELECT purchase_date AS day, count(*) AS total_orders,
          count(DISTINCT customer_id) AS total_customers, {_total('total_value')} AS total_revenue,
          {_mean('total_value')} AS avg_order_value,
          CAST(sum(stars) AS DOUBLE) / sum(n) AS avg_rating,
          CAST(coalesce(sum(positive), 0) AS BIGINT) AS positive_reviews,
          CAST(coalesce(sum(negative), 0) AS BIGINT) AS negative_reviews
        FROM fact_sales s LEFT JOIN (SELECT order_id, sum(rating) AS stars, count(*) AS n,
            count(*) FILTER (WHERE sentiment = 'positive') AS positive,
            count(*) FILTER (WHERE sentiment = 'negative') AS negative
          FROM fact_reviews GROUP BY order_id) r ON s.order_id = r.order_id
        GROUP BY purchase_date""",
        "fact_sales",
        "fact_reviews",
    ),
    "mart_sales_performance": _all("performance"),
    "mart_funnel": _all("funnel"),
    "mart_reviews": _all("review_mart"),
    "mart_trends": _all("trends"),
    "mart_category_trends": _all("category_trends"),
    "views": with_ctes(
        """SELECT 'vw_executive' AS name, count(*) AS n_rows FROM executive
        UNION ALL SELECT 'vw_sales_performance', count(*) FROM performance
        UNION ALL SELECT 'vw_funnel', count(*) FROM funnel
        UNION ALL SELECT 'vw_reviews', count(*) FROM review_mart
        UNION ALL SELECT 'vw_trends', count(*) FROM trends
        UNION ALL SELECT 'vw_category_trends', count(*) FROM category_trends""",
        "executive", "performance", "funnel", "review_mart", "trends", "category_trends",
    ),
    "recent_executive": _all("recent_executive"),
    "recent_sales_performance": _all("recent_performance"),
    "recent_funnel": _all("recent_funnel"),
    "recent_reviews": _all("recent_reviews"),
    "kpi_totals": with_ctes(
        f"""SELECT {_total('total_revenue')} AS total_revenue,
          CAST(sum(total_orders) AS BIGINT) AS total_orders,
          round(avg(coalesce(avg_order_value, 0)), 6) AS avg_order_value,
          round(avg(coalesce(avg_rating, 0)), 6) AS avg_rating,
          CAST(sum(total_customers) AS BIGINT) AS total_customers FROM recent_executive""",
        "recent_executive",
    ),
    "kpi_totals_exact": with_ctes(
        f"""SELECT total_revenue, total_orders, avg_order_value, avg_rating, total_customers
        FROM (SELECT {_total('total_value')} AS total_revenue, count(*) AS total_orders,
            {_mean('total_value')} AS avg_order_value,
            count(DISTINCT customer_id) AS total_customers
          FROM recent), (SELECT avg(CAST(rating AS DOUBLE)) AS avg_rating
          FROM fact_reviews JOIN recent USING (order_id))""".replace(
            "FROM recent",
            """FROM (SELECT * FROM fact_sales WHERE purchase_date >=
              (SELECT max(purchase_date) FROM fact_sales) - INTERVAL 90 DAY)""",
        ).replace(
            "JOIN recent",
            """JOIN (SELECT order_id FROM fact_sales WHERE purchase_date >=
              (SELECT max(purchase_date) FROM fact_sales) - INTERVAL 90 DAY)""",
        ),
        "fact_sales",
        "fact_reviews",
    ),
    "visitors_per_type": with_ctes(
        """SELECT event_type, count(DISTINCT session_id) AS sessions, count(DISTINCT user_id) AS users
        FROM fact_clickstream WHERE event_date >= (SELECT max(event_date) FROM fact_clickstream) - INTERVAL 7 DAY
        GROUP BY event_type""",
        "fact_clickstream"),
    "visitors_per_day": with_ctes(
        """SELECT event_date, count(DISTINCT session_id) AS sessions, count(DISTINCT user_id) AS users
        FROM fact_clickstream WHERE event_date >= (SELECT max(event_date) FROM fact_clickstream) - INTERVAL 7 DAY
        GROUP BY event_date""",
        "fact_clickstream"),
    "unpivot_review_counts": with_ctes(
        """SELECT day, 'positive_reviews' AS kind, positive_reviews AS review_count
        FROM recent_executive UNION ALL
        SELECT day, 'negative_reviews', negative_reviews FROM recent_executive""",
        "recent_executive",
    ),
    "top_categories_by_revenue": with_ctes(
        f"""SELECT category, {_total('revenue')} AS revenue FROM recent_performance
        WHERE category IS NOT NULL GROUP BY category ORDER BY revenue DESC, category LIMIT 10""",
        "recent_performance",
    ),
    "revenue_by_region": with_ctes(
        f"""SELECT region, {_total('revenue')} AS revenue FROM recent_performance
        WHERE region IS NOT NULL GROUP BY region""",
        "recent_performance",
    ),
    "revenue_trend": with_ctes(
        f"""SELECT purchase_date, {_total('revenue')} AS revenue,
          CAST(sum(orders) AS BIGINT) AS orders FROM recent_performance GROUP BY purchase_date""",
        "recent_performance",
    ),
    "top_states_by_revenue": with_ctes(
        f"""SELECT state, {_total('revenue')} AS revenue FROM recent_performance
        WHERE state IS NOT NULL GROUP BY state ORDER BY revenue DESC, state LIMIT 10""",
        "recent_performance",
    ),
    "funnel_totals": with_ctes(
        f"""SELECT event_type, event_count, journey_order,
          CAST(event_count * 100 AS DOUBLE) / first_value(event_count)
            OVER (ORDER BY journey_order) AS percent_initial
        FROM (SELECT event_type, CAST(sum(event_count) AS BIGINT) AS event_count,
            CAST(list_position({JOURNEY}, event_type) - 1 AS INTEGER) AS journey_order
          FROM recent_funnel GROUP BY event_type) WHERE journey_order >= 0""",
        "recent_funnel",
    ),
    "events_by_device": with_ctes(
        """SELECT device, CAST(sum(event_count) AS BIGINT) AS event_count FROM recent_funnel
        WHERE device IS NOT NULL GROUP BY device""",
        "recent_funnel",
    ),
    "top_events_over_time": with_ctes(
        """SELECT event_date, event_type, CAST(sum(event_count) AS BIGINT) AS event_count
        FROM recent_funnel WHERE event_type IN (SELECT event_type FROM recent_funnel
          GROUP BY event_type ORDER BY sum(event_count) DESC, event_type LIMIT 2)
        GROUP BY event_date, event_type""",
        "recent_funnel",
    ),
    "sessions_users_by_day": with_ctes(
        """SELECT event_date, CAST(sum(sessions) AS BIGINT) AS sessions,
          CAST(sum(users) AS BIGINT) AS users FROM recent_funnel GROUP BY event_date""",
        "recent_funnel",
    ),
    "sentiment_distribution": with_ctes(
        """SELECT sentiment, CAST(sum(review_count) AS BIGINT) AS review_count
        FROM recent_reviews GROUP BY sentiment""",
        "recent_reviews",
    ),
    "weighted_daily_rating": with_ctes(
        """SELECT review_date,
          round(coalesce(sum(avg_rating * review_count) / nullif(sum(review_count), 0), 0), 6)
            AS avg_rating,
          CAST(sum(review_count) AS BIGINT) AS review_count
        FROM recent_reviews GROUP BY review_date""",
        "recent_reviews",
    ),
    "top_reviewed_categories": with_ctes(
        """SELECT category, CAST(sum(review_count) AS BIGINT) AS review_count,
          round(avg(avg_rating), 6) AS avg_rating
        FROM recent_reviews WHERE category IS NOT NULL GROUP BY category
        ORDER BY review_count DESC, category LIMIT 10""",
        "recent_reviews",
    ),
    "sentiment_by_region": with_ctes(
        """SELECT region, sentiment, CAST(sum(review_count) AS BIGINT) AS review_count
        FROM recent_reviews WHERE region IS NOT NULL GROUP BY region, sentiment""",
        "recent_reviews",
    ),
    "churn_features": _all("churn_features"),
    "time_series_features": _all("series"),
    "chronological_cut": with_ctes(
        """SELECT category_en, n_rows, max(purchase_date) AS split_date
        FROM (SELECT category_en, purchase_date, count(*) OVER (PARTITION BY category_en) AS n_rows,
            row_number() OVER (PARTITION BY category_en ORDER BY purchase_date) AS n FROM series)
        WHERE n <= floor(n_rows * 0.8::DOUBLE) GROUP BY category_en, n_rows""",
        "series",
    ),
    "product_catalog": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category_pt,
          coalesce(english, p_type) AS category, price, seller_id, freight,
          CASE p_size WHEN 0 THEN 1 ELSE p_size END AS photos_qty
        FROM part JOIN (SELECT l_partkey, l_extendedprice AS price,
            CAST(l_suppkey AS VARCHAR) AS seller_id, l_tax AS freight FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY {_ITEM_ORDER}) = 1)
          ON p_partkey = l_partkey
          LEFT JOIN (VALUES ('ECONOMY', 'economy'), ('LARGE', 'large'), ('MEDIUM', 'medium'),
            ('PROMO', 'promotion')) t(name, english) ON p_type = t.name
        WHERE p_partkey % 53 <> 0 AND p_type <> ''""",
    "review_pool": """
        SELECT CAST(doc_id AS VARCHAR) AS review_id,
          CAST(1 + (doc_id // 3) % 5 AS INTEGER) AS review_score,
          CASE WHEN doc_id % 2 = 0 THEN 'Review ' || doc_id ELSE '' END AS title,
          trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS message
        FROM documents WHERE doc_id % 37 <> 0
          AND trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''""",
    "quality_report": with_ctes(QUALITY, "raw_clicks", "raw_orders", "raw_reviews"),
    "session_outcomes": _all("outcomes"),
    "step_conversion": with_ctes(_STEP_COUNTS, "outcomes"),
    "session_end_reasons": with_ctes(
        "SELECT end_reason, count(*) AS sessions FROM outcomes GROUP BY end_reason", "outcomes"
    ),
    "run_audit": with_ctes(
        _AUDIT, "calendar", "fact_sales", "fact_clickstream", "fact_reviews", "states"
    ),
}
SQL["kpi_totals_of_facts"] = SQL["kpi_totals_exact"]
SQL["land_review_files_again"] = SQL["land_review_files"]
SQL["packed_bronze"] = SQL["stream_from_segments"] = SQL["event_stream_filter"]
SQL["catalog_views"] = SQL["views"]
SQL["published_sales"] = SQL["replaced_days"].replace("CASE WHEN purchase_date <", "CASE WHEN purchase_date >=")
SQL["incremental_clickstream"] = with_ctes(
    """SELECT *, event_date >= (SELECT CAST(max(ts) AS DATE) - 9 FROM events) AS second_run FROM fact_clickstream""",
    "fact_clickstream")
