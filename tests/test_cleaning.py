import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverbrook import schemas
from silverbrook.functions import values as V
from silverbrook.operators import cleaning as C

TS = "2024-05-01T10:00:00"


def event(**kw):
    row = dict(event_id="e", session_id="s", user_id="u", event_type="search", timestamp=TS,
               device="mobile", properties="{}", ingested_at=TS, source="kafka")
    return {**row, **kw}


def order(**kw):
    row = dict(order_id="o", session_id="s", customer_id="c", product_id="p", seller_id="v",
               category="toys", price="10.00", freight_value="1.50",
               purchase_timestamp=1_714_557_600_000_000, state="SP", cdc_operation="c",
               cdc_ts_ms=1, ingested_at=TS, source="debezium")
    return {**row, **kw}


def review(**kw):
    row = dict(file_path="f", review_id="r", order_id="o", customer_id="c", rating="5", title="",
               raw_content="H: 1\n---\n\ngood", ingested_at=TS, source="minio")
    return {**row, **kw}


def clean(spark, name, rows):
    step = {"clickstream": C.silver_clickstream, "orders": C.silver_orders,
            "reviews": C.silver_reviews}[name]
    names = schemas.BRONZE[name].fieldNames()
    data = [tuple(row[n] for n in names) for row in rows]
    return step(spark.createDataFrame(data, schemas.BRONZE[name])).collect()


@pytest.mark.parametrize("field", ["session_id", "event_type"])
@pytest.mark.parametrize("value", [None, ""])
def test_event_needs_session_and_type(spark, field, value):
    assert clean(spark, "clickstream", [event(**{field: value})]) == []


def test_event_id_may_be_empty_but_not_null(spark):
    rows = [event(event_id=None), event(event_id="")]
    assert [r.event_id for r in clean(spark, "clickstream", rows)] == [""]


def test_devices(spark):
    given = ["mobile", "desktop", "tablet", "tv", "", None, "Mobile"]
    rows = clean(spark, "clickstream", [event(event_id=str(i), device=d)
                                        for i, d in enumerate(given)])
    found = {r.event_id: r.device for r in rows}
    assert [found[str(i)] for i in range(7)] == ["mobile", "desktop", "tablet"] + ["unknown"] * 4


def test_properties_and_location(spark):
    rows = clean(spark, "clickstream", [
        event(event_id="1", properties='{"category": "a", "price": 2.5, "city": "x", "total": 9}'),
        event(event_id="2", properties='{"state": "SP", "city": "x"}'),
        event(event_id="3", properties="{bad"),
        event(event_id="4", properties=None),
    ])
    found = {r.event_id: (r.category, r.price, r.location) for r in rows}
    assert found == {"1": ("a", 2.5, "x"), "2": (None, None, "SP"),
                     "3": (None, None, None), "4": (None, None, None)}


def test_bad_event_time_is_dropped(spark):
    rows = [event(event_id="1", timestamp="soon"), event(event_id="2", timestamp=None),
            event(event_id="3")]
    got = clean(spark, "clickstream", rows)
    assert [(r.event_id, r.event_ts) for r in got] == [("3", dt.datetime(2024, 5, 1, 10))]


@pytest.mark.parametrize(
    "price", ["0.00", "-1", "abc", "", None, "NaN", "Infinity", "1e17", "1e400"])
def test_bad_price(spark, price):
    assert clean(spark, "orders", [order(price=price)]) == []


@pytest.mark.parametrize("price,freight,want", [
    ("10.005", "0", (10.01, 0.0, 10.01)), ("12.345", "1.505", (12.35, 1.51, 13.85)),
    ("0.004", "0.004", (0.0, 0.0, 0.01)), ("1.115", "0.1", (1.12, 0.1, 1.22)), ("1e2", "2.5", (100.0, 2.5, 102.5))])
def test_amounts_below_a_cent_are_rounded(spark, price, freight, want):
    """Rounded half up as written; the total is that of the amounts before rounding."""
    row = clean(spark, "orders", [order(price=price, freight_value=freight)])[0]
    assert (row.price, row.freight_value, row.total_value) == want


@pytest.mark.parametrize("freight,kept", [("0", 1), ("-0.01", 0), ("x", 0), (None, 0)])
def test_freight(spark, freight, kept):
    assert len(clean(spark, "orders", [order(freight_value=freight)])) == kept


@pytest.mark.parametrize("field", ["order_id", "customer_id", "purchase_timestamp"])
def test_order_needs(spark, field):
    assert clean(spark, "orders", [order(**{field: None})]) == []


def test_states(spark):
    given = ["sp", " SP ", "SP0", None, "XX", "rj"]
    rows = clean(spark, "orders", [order(order_id=str(i), state=s) for i, s in enumerate(given)])
    found = {r.order_id: (r.state, r.region) for r in rows}
    unknown = (None, "Desconhecido")
    assert [found[str(i)] for i in range(6)] == [
        ("SP", "Sudeste"), ("SP", "Sudeste"), unknown, unknown, unknown, ("RJ", "Sudeste")]


def test_order_values(spark):
    row = clean(spark, "orders", [order(category="  toys  ", price="0.10",
                                        freight_value="0.20")])[0]
    assert (row.category, row.total_value) == ("toys", 0.3)
    assert row.purchase_ts == dt.datetime(2024, 5, 1, 10)


@pytest.mark.parametrize("rating,result", [
    ("5", 5), ("1", 1), ("N/A", None), ("-1", None), ("0", None), ("6", None), ("4/5", None),
    ("", None), (None, None), ("99999999999", None), (" 3 ", 3), ("-", None)])
def test_rating(spark, rating, result):
    got = clean(spark, "reviews", [review(rating=rating)])
    assert [r.rating for r in got] == ([] if result is None else [result])


@pytest.mark.parametrize("raw,message,words", [
    ("no separator", None, 0),
    ("H: 1\n---\nTITLE: only\n\n", None, 0),
    ("H: 1\n---\n\n   ", None, 0),
    ("H: 1\n---\n\n.", ".", 1),
    ("H: 1\n---\nTITLE: t\n\na b\n", "a b\n", 3),
    ("H: 1\n---\n\none\n---\ntwo", "one\n---\ntwo", 3),
    ("H: 1\n---\n  text  ", "text", 1),
    ("H: 1\n---\n\n\n two  words", "\n two  words", 3),
    ("H: 1\n---\nTITLE: no end", "TITLE: no end", 3),
    (None, None, 0)])
def test_message(spark, raw, message, words):
    got = clean(spark, "reviews", [review(raw_content=raw)])
    assert [(r.message, r.text_length) for r in got] == (
        [] if message is None else [(message, words)])


def test_review_ids(spark):
    rows = [review(review_id=""), review(order_id=""), review(review_id=None),
            review(review_id="k", customer_id="")]
    assert [r.review_id for r in clean(spark, "reviews", rows)] == ["k"]


def test_mojibake(spark):
    bad = "nÃ£o Ã§ Ã© Ã³ Ãº Ã¢ Ãª Ã­ Ãµ Ã  €"
    text = spark.createDataFrame([(bad,), ("limpo é",), (None,)], "t string")
    got = [r[0] for r in text.select(V.fix_mojibake(F.col("t"))).collect()]
    assert got == ["não ç é ó ú â ê í õ à €", "limpo é", None]


def test_risk_and_sentiment(spark):
    rows = spark.createDataFrame([(0.71, 5), (0.7, 4), (0.41, 3), (0.4, 2)], "p double, rating int")
    got = rows.select(V.risk_label("p"), V.sentiment()).collect()
    assert [tuple(r) for r in got] == [("high", "positive"), ("medium", "positive"),
                                       ("medium", "neutral"), ("low", "negative")]
