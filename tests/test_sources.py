import json

import pytest
from pyspark.sql import functions as F

from silverbrook.operators import catalog
from silverbrook.sources import changes, events, reviews, tables
from silverbrook.streaming import folders


def messages(spark, *values):
    return spark.createDataFrame(
        [(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string")


AFTER = dict(order_id="1", session_id="s", customer_id="c", product_id="p", seller_id="v",
             category="t", price="9.90", freight_value=1.5, purchase_timestamp=17, state="SP",
             other="x")


def test_change_envelopes(spark):
    rows = changes.read_cdc(messages(
        spark,
        {"payload": {"op": "c", "ts_ms": 5, "before": None, "after": AFTER, "source": {"a": 1}}},
        {"op": "u", "ts_ms": 6, "after": {**AFTER, "order_id": "2"}},
        {"op": "r", "ts_ms": 7, "after": {"order_id": None}},
        {"op": "d", "ts_ms": 8, "before": AFTER, "after": None},
        {"op": "c", "ts_ms": 9, "after": {}},
        {"payload": {"op": "c", "ts_ms": 9, "after": None}},
        {"schema": 1},
        "not json",
    ))
    got = {r.cdc_ts_ms: r for r in rows.collect()}
    assert sorted(got) == [5, 6, 7]
    assert (got[5].price, got[5].freight_value, got[5].purchase_timestamp) == ("9.90", "1.5", 17)
    assert (got[6].order_id, got[6].cdc_operation, got[7].order_id) == ("2", "u", None)
    assert {r.source for r in got.values()} == {"debezium"}


def test_event_messages(spark):
    rows = events.read_events(messages(
        spark,
        {"event_id": "1", "event_type": "search", "properties": {"query": "q", "price": 1.5}},
        {"event_id": "2", "event_type": "order_placed", "properties": {}},
        {"event_id": "3", "event_type": None, "properties": '{"a": 1}'},
    ))
    kept = events.exclude_event_types(rows).orderBy("event_id").collect()
    assert [r.event_id for r in kept] == ["1", "3"]
    assert json.loads(kept[0].properties) == {"query": "q", "price": 1.5}
    assert json.loads(kept[1].properties) == {"a": 1}
    assert kept[0].source == "kafka" and kept[0].ingested_at


def test_review_documents(spark):
    texts = [
        "REVIEW_ID: r1\nORDER_ID: o1\nCUSTOMER_ID: c1\nRATING: 4/5\nTIMESTAMP: t\n---\n"
        "TITLE: first\nbody TITLE: no\nTITLE: last \n\ntext",
        "REVIEW_ID: a\nREVIEW_ID:  b \nTITLE: head\nRATING: N/A/5\n --- \n\nx\nREVIEW_ID: c",
        "nothing here",
    ]
    files = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)],
                                  "file_path string, value string")
    got = reviews.parse_reviews(files).orderBy("file_path").collect()
    fields = [(r.review_id, r.order_id, r.customer_id, r.rating, r.title) for r in got]
    assert fields == [("r1", "o1", "c1", "4", "last"), ("b", "", "", "N/A", ""),
                      ("", "", "", "", "")]
    assert [r.raw_content for r in got] == texts


def test_reference_csv(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_bytes('﻿id,text\n1,"a ""b"", c"\n2,"two\nlines"\n'.encode())
    rows = tables.read_reference_csv(spark, str(path))
    assert rows.columns == ["id", "text"]
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [("1", 'a "b", c'),
                                                                ("2", "two\nlines")]


def test_last_days(spark):
    rows = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-31')) as d")
    import datetime as dt
    kept = tables.last_days(rows, "d", 7, dt.date(2024, 1, 31))
    assert kept.agg(F.min("d"), F.count("*")).first() == (dt.date(2024, 1, 24), 8)
    since = tables.first_day(rows, "d", 7)
    assert tables.last_days(rows, "d", 7, since=since).count() == 8


def test_a_large_reference_file_is_refused(spark, tmp_path, monkeypatch):
    path = tmp_path / "rows.csv"
    path.write_text("id\n1\n")
    assert tables.read_reference_csv(spark, str(path)).count() == 1
    monkeypatch.setattr(tables.settings, "REFERENCE_CSV_BYTES", 4)
    with pytest.raises(ValueError, match="too large"):
        tables.read_reference_csv(spark, str(path))


def test_the_last_day_comes_from_the_footers(spark, tmp_path):
    import datetime as dt
    path = str(tmp_path / "t")
    rows = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-31')) as d, 1 as v")
    rows.repartition(3).write.parquet(path)
    assert tables.last_value(spark, path, rows.schema, "d") == dt.date(2024, 1, 31)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    metadata = folders.session_like(spark, {
        "spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"})
    plan = tables.largest(metadata.read.schema(rows.schema).parquet(path), "d")._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(d)]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    rows.limit(0).write.parquet(path + "0")
    assert tables.last_value(spark, path + "0", rows.schema, "d") is None


def test_catalog(spark):
    products = spark.createDataFrame(
        [("p1", "brinquedos", "3"), ("p2", "novo", None), ("p3", "", "1"), ("p4", "novo", "1")],
        "product_id string, product_category_name string, product_photos_qty string")
    items = spark.createDataFrame(
        [("p1", "5.0", "s2", "1", 2), ("p1", "4.0", "s1", "2", 1), ("p2", "7", "s", "0", 3),
         ("p3", "7", "s", "0", 4)],
        "product_id string, price string, seller_id string, freight_value string, n int")
    names = spark.createDataFrame(
        [("brinquedos", "toys")],
        "product_category_name string, product_category_name_english string")
    got = catalog.product_catalog(products, items, names, ["n"]).orderBy("product_id").collect()
    assert [tuple(r) for r in got] == [("p1", "brinquedos", "toys", 4.0, "s1", 2.0, 3),
                                       ("p2", "novo", "novo", 7.0, "s", 0.0, 1)]
    pool = spark.createDataFrame([("1", "5", None, " ok "), ("2", "4", "t", " \n"),
                                  ("3", "3", "t", None)],
                                 "review_id string, review_score string, "
                                 "review_comment_title string, review_comment_message string")
    assert [tuple(r) for r in catalog.review_pool(pool).collect()] == [("1", 5, "", "ok")]
