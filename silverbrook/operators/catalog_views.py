"""The six marts as views of the catalog, in SQL, for sessions that know nothing of this package.

They stand for the marts of :mod:`silverbrook.operators.marts` with unique keys: the facts hold one
row per order and review.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

MONEY = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


def _money(column: str) -> str:
    return MONEY.format(column)


def _mean_money(column: str) -> str:
    return f"try_divide({_money(column)}, CAST(count({column}) AS DOUBLE))"


def _growth(column: str) -> str:
    before = f"lag({column}, 7) OVER days"
    return f"CASE WHEN {before} > 0 THEN CAST({column} - {before} AS DOUBLE) / CAST({before} AS DOUBLE) * 100 END"


def texts(database: str) -> dict[str, str]:
    """The views' queries by name."""
    sales, clicks, reviews = (f"{database}.fact_{n}" for n in ("sales", "clickstream", "reviews"))
    category, geography = f"{database}.dim_category", f"{database}.dim_geography"
    category_of = f"LEFT JOIN {category} c ON c.category_id = f.category_id"
    geography_of = f"LEFT JOIN {geography} g ON g.geo_id = f.geo_id"
    return {
        "vw_executive": f"""
            SELECT purchase_date AS day, count(order_id) AS total_orders,
              count(DISTINCT customer_id) AS total_customers,
              CAST(sum(value * copies) AS DOUBLE) AS total_revenue,
              try_divide(CAST(sum(value * copies) AS DOUBLE),
                CAST(sum(CASE WHEN value IS NOT NULL THEN copies END) AS DOUBLE)) AS avg_order_value,
              try_divide(CAST(sum(rating_sum) AS DOUBLE), CAST(sum(n_ratings) AS DOUBLE)) AS avg_rating,
              coalesce(sum(n_positive), 0) AS positive_reviews, coalesce(sum(n_negative), 0) AS negative_reviews
            FROM (
              SELECT f.purchase_date, f.order_id, f.customer_id, CAST(f.total_value AS DECIMAL(18,2)) AS value,
                CAST(greatest(coalesce(r.n_reviews, 1), 1) AS DECIMAL(18,0)) AS copies,
                r.rating_sum, r.n_ratings, r.n_positive, r.n_negative
              FROM {sales} f LEFT JOIN (
                SELECT order_id, count(*) AS n_reviews, count(rating) AS n_ratings, sum(rating) AS rating_sum,
                  count(CASE WHEN sentiment = 'positive' THEN review_id END) AS n_positive,
                  count(CASE WHEN sentiment = 'negative' THEN review_id END) AS n_negative
                FROM {reviews} GROUP BY order_id) r ON r.order_id = f.order_id)
            GROUP BY purchase_date""",
        "vw_sales_performance": f"""
            SELECT f.purchase_date, c.category_en AS category, g.state, g.region, count(f.order_id) AS orders,
              count(DISTINCT f.customer_id) AS customers, {_money('f.total_value')} AS revenue,
              {_mean_money('f.total_value')} AS avg_order_value, {_money('f.price')} AS product_revenue,
              {_money('f.freight_value')} AS freight_revenue
            FROM {sales} f {category_of} {geography_of}
            GROUP BY f.purchase_date, c.category_en, g.state, g.region""",
        "vw_funnel": f"""
            SELECT date_trunc('hour', f.event_ts) AS hour, f.event_date, f.event_type, f.device,
              c.category_en AS category, count(*) AS event_count, count(DISTINCT f.session_id) AS sessions,
              count(DISTINCT f.user_id) AS users
            FROM {clicks} f {category_of}
            GROUP BY date_trunc('hour', f.event_ts), f.event_date, f.event_type, f.device, c.category_en""",
        "vw_reviews": f"""
            SELECT f.review_date, f.sentiment, c.category_en AS category, g.region, sum(f.n) AS review_count,
              try_divide(CAST(sum(f.rating_sum) AS DOUBLE), CAST(sum(f.n_rating) AS DOUBLE)) AS avg_rating,
              try_divide(CAST(sum(f.length_sum) AS DOUBLE), CAST(sum(f.n_length) AS DOUBLE)) AS avg_text_length
            FROM (
              SELECT r.*, s.category_id, s.geo_id
              FROM (
                SELECT order_id, review_date, sentiment, count(review_id) AS n, count(rating) AS n_rating,
                  sum(rating) AS rating_sum, count(text_length) AS n_length, sum(text_length) AS length_sum
                FROM {reviews} GROUP BY order_id, review_date, sentiment) r
              LEFT JOIN {sales} s ON s.order_id = r.order_id) f {category_of} {geography_of}
            GROUP BY f.review_date, f.sentiment, c.category_en, g.region""",
        "vw_trends": f"""
            SELECT purchase_date, orders, revenue, {_growth('orders')} AS orders_growth_pct,
              {_growth('revenue')} AS revenue_growth_pct,
              CASE WHEN lag(revenue, 7) OVER days > 0 AND lag(revenue, 14) OVER days > 0 THEN
                (revenue - lag(revenue, 7) OVER days) / lag(revenue, 7) OVER days
                - (lag(revenue, 7) OVER days - lag(revenue, 14) OVER days) / lag(revenue, 14) OVER days
              END AS revenue_acceleration,
              CASE WHEN stddev_pop(revenue) OVER month > 0 AND abs(revenue - try_divide(
                CAST(sum(CAST(revenue AS DECIMAL(18,2))) OVER month AS DOUBLE),
                CAST(count(revenue) OVER month AS DOUBLE))) > 2 * stddev_pop(revenue) OVER month
                THEN 1 ELSE 0 END AS anomaly_flag
            FROM (SELECT purchase_date, count(order_id) AS orders, {_money('total_value')} AS revenue
                  FROM {sales} GROUP BY purchase_date)
            WINDOW days AS (ORDER BY purchase_date),
              month AS (ORDER BY purchase_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
        "vw_category_trends": f"""
            SELECT purchase_date, category, orders, revenue, {_growth('orders')} AS orders_growth_pct,
              {_growth('revenue')} AS revenue_growth_pct
            FROM (SELECT f.purchase_date, c.category_en AS category, count(f.order_id) AS orders,
                    {_money('f.total_value')} AS revenue
                  FROM {sales} f {category_of} GROUP BY f.purchase_date, c.category_en)
            WINDOW days AS (PARTITION BY category ORDER BY purchase_date)""",
    }


def create(spark: SparkSession, database: str) -> list[str]:
    """Create or replace the views beside the gold tables; any session of the catalog can read them."""
    made = texts(database)
    for name, text in made.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")
    return [f"{database}.{name}" for name in made]
