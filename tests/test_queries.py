import re

import duckdb
import pytest

import __spark_entry__ as entry_points
import check

SLOW = {"stream_silver_orders", "stream_silver_clickstream", "stream_silver_reviews"}


@pytest.fixture(scope="module")
def db(sf):
    link = duckdb.connect()
    for table in check.TABLES:
        link.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return link


def test_sql_belongs_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(set(entry_points.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, sf, db, name):
    frame = entry_points.queries()[name](spark, sf)
    got = check.sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = db.execute(entry_points.oracle_sql()[name])
    want = check.sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_marts_keep_totals(spark, sf):
    """Sums over marts equal sums over facts."""
    run = {n: entry_points.queries()[n](spark, sf) for n in (
        "fact_sales", "mart_sales_performance", "mart_trends", "fact_clickstream", "mart_funnel")}
    total = {n: run[n].selectExpr(f"sum(cast({c} as decimal(18,2)))").first()[0]
             for n, c in (("fact_sales", "total_value"), ("mart_sales_performance", "revenue"),
                          ("mart_trends", "revenue"))}
    assert len(set(total.values())) == 1
    events = run["mart_funnel"].selectExpr("sum(event_count)").first()[0]
    assert events == run["fact_clickstream"].count()


def test_plans_reduce_before_the_shuffle(spark, sf):
    """No copies of clicks for distinct counts; windows reach every scan of the facts."""
    plan = lambda name: entry_points.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan("mart_funnel")
    recent = plan("recent_funnel")
    assert "Expand" not in recent and recent.count("event_date#") > 0
    assert recent.count("(event_date") >= 2  # a filter above each of the two scans
    executive = plan("recent_executive")
    # The last day is known from the footers, so that the bound of both scans is a plain date.
    assert "LeftSemi" in executive and len(re.findall(r"\(purchase_date#\d+ >= \d{4}-", executive)) >= 2
    assert "LeftSemi" in plan("mart_reviews")


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
