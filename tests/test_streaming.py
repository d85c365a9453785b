import json
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from silverbrook import schemas, settings
from silverbrook.operators.dedup import descending, latest_per_key
from silverbrook.plans import registry
from silverbrook.plans import testbed as tb
from silverbrook.plans.staging import Step, Tables
from silverbrook.sources import events, tables
from silverbrook.streaming import jobs, sinks, upsert

ORDERS = schemas.SILVER["orders"]


def order_batch(spark, rows):
    """(order_id, product_id, cdc_ts_ms) rows as clean orders."""
    base = spark.createDataFrame(rows, "order_id string, product_id string, cdc_ts_ms bigint")
    missing = [f for f in ORDERS if f.name not in ("order_id", "product_id")]
    return base.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing))


VERSIONED = schemas.VERSIONED["orders"]


def about():
    return VERSIONED, "order_id", [F.col("cdc_ts_ms")]


def put(spark, path, number, rows):
    return upsert.write_batch(order_batch(spark, rows), number, path, *about()[1:])


def stored(spark, path, mode="latest"):
    rows = upsert.current(spark, path, *about(), mode).collect()
    return sorted((r.order_id, r.product_id, r.seen_in) for r in rows)


BATCHES = [
    [("a", "old", 1), ("a", "new", 2), ("b", "b0", 1)],
    [("a", "later", 9), ("c", "c1", 1)],
    [("c", "c2", 9), ("b", "b2", 0)],
]
FIRST = [("a", "new", 0), ("b", "b0", 0), ("c", "c1", 1)]
LATEST = [("a", "later", 1), ("b", "b0", 0), ("c", "c2", 2)]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
def test_latest_does_not_depend_on_batch_borders(spark, tmp_path, order):
    path = str(tmp_path / "t")
    counts = [put(spark, path, number, BATCHES[batch]) for number, batch in enumerate(order)]
    assert sum(counts) == 6  # one row per key and batch
    got = [(key, product) for key, product, _ in stored(spark, path)]
    assert got == [(key, product) for key, product, _ in LATEST]


def test_replay_and_compaction(spark, tmp_path):
    for mode, want in (("first", FIRST), ("latest", LATEST)):
        path = str(tmp_path / mode)
        for number in (0, 1):
            put(spark, path, number, BATCHES[number])
        assert not upsert.compact(spark, path, *about(), mode, after=3)
        assert upsert.compact(spark, path, *about(), mode, after=2)
        put(spark, path, 2, BATCHES[2])
        assert stored(spark, path, mode) == want
        for number in (1, 0, 2):  # batches run again, before and after the compaction
            put(spark, path, number, BATCHES[number])
        assert stored(spark, path, mode) == want
        assert upsert.compact(spark, path, *about(), mode, after=1)
        assert stored(spark, path, mode) == want
        assert not upsert.compact(spark, path, *about(), mode, after=1)
        # Rows of old batches and replaced versions lie in folders that a read leaves out.
        known = upsert.versions(spark, path)
        old = upsert.base(spark, path, VERSIONED, "order_id", known)
        files = [r[0] for r in old.select("_metadata.file_path").collect()]
        assert files and all(f"/upto={known.of[int(f.split('bucket=')[1].split('/')[0])][-1]}/" in f for f in files)
        assert upsert.deltas(spark, path, VERSIONED, known).isEmpty()


def exchanged(plan):
    """The scans that lie below an exchange of a plan's text."""
    lines = [(len(line) - len(line.lstrip(" :+-*(0123456789)")), line) for line in plan.splitlines()]
    found = []
    for at, (deep, line) in enumerate(lines):
        if "Exchange" in line.split("[")[0].split("(")[0]:
            for below, inner in lines[at + 1 :]:
                if below <= deep:
                    break
                if "Scan" in inner:
                    found.append(inner)
    return found


def test_the_base_is_neither_shuffled_nor_read_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, 0, [(f"k{i}", "p", i) for i in range(500)])
    assert upsert.compact(spark, path, *about(), after=1, buckets=8)
    put(spark, path, 1, [("k3", "newer", 10_000), ("k4", "older", -1), ("new", "n", 1)])
    for mode in ("latest", "first"):
        rows = upsert.current(spark, path, *about(), mode)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == 1, plan
        assert exchanged(plan) and not any("Bucketed: true" in scan or "bucket=" in scan for scan in exchanged(plan))
        got = {r.order_id: r.product_id for r in rows.collect()}
        assert len(got) == 501 and got["k4"] == "p" and got["k3"] == ("newer" if mode == "latest" else "p")


def test_a_compaction_writes_only_buckets_with_new_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, 0, [(f"k{i}", "p", i) for i in range(100)])
    upsert.compact(spark, path, *about(), after=1, buckets=8)
    first = {b: list(v) for b, v in upsert.versions(spark, path).of.items()}
    assert len(first) == 8
    put(spark, path, 1, [("k7", "newer", 10_000)])
    upsert.compact(spark, path, *about(), after=1, buckets=3)  # the table keeps its eight
    second = upsert.versions(spark, path)
    assert second.buckets == 8 and sorted(map(len, second.of.values())) == [1] * 7 + [2]
    new = [b for b, v in second.of.items() if len(v) == 2]
    held = {p.relative_to(tmp_path / "t" / "base").as_posix() for p in (tmp_path / "t" / "base").glob("bucket=*/upto=*")}
    assert held == {f"bucket={b}/upto=0" for b in first} | {f"bucket={new[0]}/upto=1"}
    assert len(stored(spark, path)) == 100 and ("k7", "newer", 1) in stored(spark, path)


def test_replaced_versions_and_lost_compactions_are_deleted(spark, tmp_path):
    path, base = str(tmp_path / "t"), tmp_path / "t" / "base"
    for number in range(4):
        put(spark, path, number, [("a", f"p{number}", number)])
        # What a compaction that failed has left is not read, and is gone after the next one.
        lost = base / "bucket=0" / "upto=77"
        lost.mkdir(parents=True)
        (lost / "part-00000_00000.c000.parquet").write_text("half a file")
        assert upsert.compact(spark, path, *about(), after=1, buckets=1)
        assert not lost.exists()
        assert stored(spark, path) == [("a", f"p{number}", number)]
    assert {p.name for p in (base / "bucket=0").iterdir()} == {"upto=1", "upto=2", "upto=3"}
    assert {p.name for p in (tmp_path / "t" / "delta").iterdir() if "=" in p.name} == {"part=2", "part=3"}


def test_rows_without_a_key_are_not_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    assert put(spark, path, 0, [(None, "p", 1), ("a", "p", None)]) == 1
    upsert.compact(spark, path, *about(), after=1)
    put(spark, path, 1, [("a", "q", 1), (None, "q", 1)])
    assert stored(spark, path) == [("a", "q", 1)]


def test_a_batch_reads_nothing_of_the_table(spark, tmp_path):
    """The cost of a batch stays the same however large the table is."""
    path = str(tmp_path / "t")
    put(spark, path, 0, BATCHES[0])
    (tmp_path / "t" / "delta" / "part=7").mkdir()
    (tmp_path / "t" / "delta" / "part=7" / "broken.parquet").write_text("not a file that can be read")
    assert put(spark, path, 1, BATCHES[1]) == 2


def test_empty_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    assert upsert.current(spark, path, *about()).isEmpty()
    assert not upsert.compact(spark, path, *about())
    assert put(spark, path, 0, []) == 0
    assert put(spark, path, 3, [("a", "p", 1)]) == 1
    assert stored(spark, path) == [("a", "p", 3)]
    with pytest.raises(ValueError):
        stored(spark, path, "other")


def test_ties_are_settled_by_content(spark):
    rows = [("a", str(i), 1) for i in range(50)]
    picked = {latest_per_key(order_batch(spark, rows).repartition(n), "order_id",
                             descending(["cdc_ts_ms"])).first().product_id for n in (1, 3, 7)}
    assert len(picked) == 1


def test_missing_input(spark, tmp_path):
    where = [str(tmp_path / n) for n in ("bronze", "silver", "ck")]
    assert jobs.silver_orders(spark, *where) == 0
    assert jobs.silver_clickstream(spark, *where) == 0


def test_sixty_files_keep_the_latest(spark, tmp_path):
    bronze, silver, check = (str(tmp_path / n) for n in ("bronze", "silver", "ck"))
    names = schemas.BRONZE["orders"].fieldNames()

    def version(n):
        row = {"order_id": "o", "customer_id": "c", "product_id": f"p{n}", "price": "1.00", "freight_value": "0",
               "purchase_timestamp": 1_600_000_000_000_000, "state": "SP", "cdc_operation": "u", "cdc_ts_ms": n}
        return tuple(row.get(name) for name in names)

    for n in range(1, 61):
        spark.createDataFrame([version(n)], schemas.BRONZE["orders"]).coalesce(1).write.mode("append").parquet(bronze)
    assert jobs.silver_orders(spark, bronze, silver, check, files=10) == 6
    assert [r.product_id for r in jobs.stored(spark, jobs.ORDERS, silver).collect()] == ["p60"]


def test_orders_in_many_batches_equal_one_pass(spark, sf, tmp_path):
    bronze, silver, check = (str(tmp_path / n) for n in ("bronze", "silver", "ck"))
    # The versions of an order lie in different files.
    tb.raw_orders(spark, sf).repartition(6, "cdc_ts_ms", "product_id").write.parquet(bronze)
    order = tb.order_newest()
    assert jobs.silver_orders(spark, bronze, silver, check, order, files=2) > 0
    assert upsert.deltas(spark, silver, VERSIONED, upsert.Versions()).select("part").distinct().count() >= 3
    want = tb.silver_orders(spark, sf)
    got = jobs.stored(spark, jobs.ORDERS, silver, order)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(got.columns)).isEmpty()
    # Nothing new: a second run adds nothing.
    assert jobs.silver_orders(spark, bronze, silver, check, order) == 0
    # A stream that starts from another checkpoint would number its batches from 0 again.
    with pytest.raises(Exception, match="another checkpoint"):
        jobs.silver_orders(spark, bronze, silver, check + "2", order)
    assert got.count() == want.count()


def test_events_land_and_append(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    ts = "2024-05-01T10:00:00"

    def put(name, *rows):
        (topic / name).write_text("\n".join(json.dumps(r) for r in rows))

    def message(i, kind="search"):
        return {"event_id": str(i), "session_id": "s", "user_id": "u", "event_type": kind,
                "timestamp": ts, "device": "tv", "properties": {"category": "c"}}

    bronze, silver, c1, c2 = (str(tmp_path / n) for n in ("bronze", "silver", "c1", "c2"))

    def step():
        landed = jobs.land_events(events.message_files(spark, str(topic)), bronze, c1)
        return landed, jobs.silver_clickstream(spark, bronze, silver, c2)

    put("a", message(1), message(2), message(3, "order_placed"))
    assert step() == (2, 2)
    put("b", message(2), message(4), message(5, None))
    assert step() == (3, 2)
    rows = tables.table(spark, silver, schemas.SILVER["clickstream"]).collect()
    # Events are not deduplicated.
    assert sorted(r.event_id for r in rows) == ["1", "2", "2", "4"]
    assert {r.device for r in rows} == {"unknown"}
    parts = set(spark.read.parquet(bronze).columns) & {"year", "month", "day", "hour"}
    assert parts == {"year", "month", "day", "hour"}


def test_review_files(spark, tmp_path):
    inbox = tmp_path / "inbox" / "2024-05-01"
    inbox.mkdir(parents=True)

    def put(name, review_id, text, rating="5"):
        (inbox / name).write_text(f"REVIEW_ID: {review_id}\nORDER_ID: o\nCUSTOMER_ID: c\n"
                                  f"RATING: {rating}/5\nTIMESTAMP: t\n---\nTITLE: t\n\n{text}")

    bronze, silver, c1, c2 = (str(tmp_path / n) for n in ("bronze", "silver", "c1", "c2"))

    def step():
        landed = jobs.land_reviews(spark, str(tmp_path / "inbox"), bronze, c1)
        return landed, jobs.silver_reviews(spark, bronze, silver, c2)

    put("a.txt", "r1", "bom\nproduto")
    put("a-dup.txt", "r1", "bom\nproduto")
    put("b.txt", "r2", "x", "N/A")
    put("skip.md", "r9", "x")
    assert step() == (3, 1)
    put("c.txt", "r1", "again")
    put("d.txt", "r3", "nÃ£o")
    assert step() == (2, 2)
    rows = jobs.stored(spark, jobs.REVIEWS, silver, mode="first").orderBy("review_id").collect()
    assert [(r.review_id, r.message, r.text_length, r.title) for r in rows] == [
        ("r1", "bom\nproduto", 2, "t"), ("r3", "não", 1, "t")]
    assert "hour" not in spark.read.parquet(bronze).columns


def test_an_inbox_does_not_grow(spark, tmp_path):
    inbox = tmp_path / "inbox" / "2024-05-01"
    inbox.mkdir(parents=True)
    where = [str(tmp_path / n) for n in ("inbox", "bronze", "ck", "archive")]

    def put(*names):
        for name in names:
            (inbox / f"{name}.txt").write_text(f"REVIEW_ID: {name}\nORDER_ID: o\nRATING: 5/5\n---\nfine")

    def landed():
        rows = tables.read_bronze(spark, "reviews", where[1], stream=False)
        return sorted(r.review_id for r in rows.collect())

    put("a", "b")
    assert jobs.land_reviews(spark, *where) == 2
    put("c")
    assert jobs.land_reviews(spark, *where) == 1
    put("d", "e")
    assert jobs.land_reviews(spark, *where) == 2
    assert landed() == ["a", "b", "c", "d", "e"]
    left = {p.stem for p in inbox.glob("*.txt")}
    archived = {p.stem for p in (tmp_path / "archive").rglob("*.txt")}
    assert {"a", "b"} <= archived and not left & archived and left | archived == set("abcde")


def test_packed_hours(spark, tmp_path):
    bronze, packed = str(tmp_path / "bronze"), str(tmp_path / "packed")
    names = schemas.BRONZE["clickstream"].fieldNames()

    def land(number, hour):
        row = {"event_id": str(number), "ingested_at": f"2024-05-01T{hour:02d}:30:00"}
        rows = spark.createDataFrame([tuple(row.get(n) for n in names)], schemas.BRONZE["clickstream"])
        sinks.bronze_columns(rows)[0].coalesce(1).write.mode("append").partitionBy(
            "year", "month", "day", "hour").parquet(bronze)

    def read():
        return sinks.read_packed(spark, "clickstream", bronze, packed)

    for number in range(6):
        land(number, 10 + number // 5)
    assert sinks.pack_bronze(spark, "clickstream", bronze, packed, "2024/05/01/11") == ["2024/05/01/10"]
    assert len(read().inputFiles()) == 2 and len(list((tmp_path / "bronze").rglob("*.parquet"))) == 6
    assert sorted(r.event_id for r in read().collect()) == list("012345")
    # What lands in an open hour is seen, closed hours are packed once, and a run that was lost is not read.
    land(6, 11)
    spark.createDataFrame([], sinks.bronze_schema("clickstream", ["year"])).write.parquet(f"{packed}/run=lost")
    assert sinks.pack_bronze(spark, "clickstream", bronze, packed, "2024/05/01/11") == []
    assert sinks.pack_bronze(spark, "clickstream", bronze, packed, "2024/05/01/12") == ["2024/05/01/11"]
    assert sorted(r.event_id for r in read().collect()) == list("0123456")
    assert len(read().inputFiles()) == 2


def test_settings_of_a_write_stay_out_of_the_session(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    moved = sinks.for_large_files(spark.range(10).withColumn("x", F.current_timestamp()))
    assert moved.sparkSession.conf.get(name) != before == spark.conf.get(name)
    assert moved.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC" and moved.count() == 10
    assert not spark.catalog.listTables("global_temp")


def test_small_files_share_tasks_and_folders(spark, tmp_path):
    """A file per review costs neither a folder nor a large share of a task."""
    reviews = spark.range(600).select(F.format_string("REVIEW_ID: %d\nORDER_ID: o\nRATING: 5/5\n---\nfine", "id").alias("value"))
    inbox, bronze = str(tmp_path / "inbox"), tmp_path / "bronze"
    assert registry._drop_files(reviews, inbox) == 600
    assert len(list((tmp_path / "inbox").iterdir())) <= 64
    assert jobs.land_reviews(spark, inbox, str(bronze), str(tmp_path / "ck")) == 600
    assert len(list(bronze.rglob("*.parquet"))) <= 8
    assert tables.read_bronze(spark, "reviews", str(bronze), stream=False).select("review_id").distinct().count() == 600
    # A second arrival lies beside the first, and texts that occur twice are two files.
    assert registry._drop_files(reviews.limit(5).union(reviews.limit(5)), inbox, 1) == 10
    assert jobs.land_reviews(spark, inbox, str(bronze), str(tmp_path / "ck")) == 10


def test_an_inbox_is_landed_by_a_bounded_number_of_files(spark, tmp_path, monkeypatch):
    """What the driver holds of a running batch does not grow with the inbox, and no listed file is cached."""
    monkeypatch.setattr(settings, "INBOX_FILES", 2)
    inbox = tmp_path / "inbox" / "0"
    inbox.mkdir(parents=True)
    for n in range(5):
        (inbox / f"{n}.txt").write_text(f"REVIEW_ID: {n}\nORDER_ID: o\nRATING: 5/5\n---\nfine")
    where = [str(tmp_path / n) for n in ("inbox", "bronze", "ck", "archive")]
    assert jobs.land_reviews(spark, *where) == 5
    assert len([p for p in (tmp_path / "ck" / "commits").iterdir() if p.name.isdigit()]) == 3
    landed = tables.read_bronze(spark, "reviews", where[1], stream=False).collect()
    assert sorted(r.review_id for r in landed) == list("01234")
    assert settings.SMALL_FILES["spark.sql.hive.manageFilesourcePartitions"] == "false"
    assert jobs.land_reviews(spark, *where) == 0


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_shuffle_files_go_with_the_write(spark, sf, tmp_path):
    bronze, silver, check = (str(tmp_path / n) for n in ("bronze", "silver", "ck"))
    tb.raw_orders(spark, sf).repartition(4).write.parquet(bronze)
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("order_id")).agg(F.count("*").alias("n"))
    before = shuffle_files(spark)
    tables_ = Tables(spark, str(tmp_path / "t"), {
        "a": Step(lambda t: rows), "b": Step(lambda t: t("a").groupBy("order_id").agg(F.max("n").alias("n")),
                                             slices=("order_id", 3), frees=("a",))}, "run")
    assert sorted(tuple(r) for r in tables_("b").collect()) == [(i, 100) for i in range(10)]
    assert not (tmp_path / "t" / "a").exists() and len(tables_("a").collect()) == 10
    assert jobs.silver_orders(spark, bronze, silver, check, tb.order_newest(), files=2) > 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    for _ in range(50):  # they are removed in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left


def test_a_slice_is_filtered_before_it_is_dealt(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    best, dealt, keep = latest_per_key(rows, "k", [F.col("v").desc()]), [], sinks.overwrite
    monkeypatch.setattr(sinks, "overwrite", lambda part, *a: dealt.append(part) or keep(part, *a))
    assert sinks.overwrite_sliced(best, str(tmp_path / "t"), "k", 4) == 3 and len(dealt) == 4
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).collect()), key=str) == [("a", 2), ("b", 3), (None, 5)]
    for part in dealt:
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("xxhash64(k") > plan.index("Window")


def test_a_compaction_deals_few_buckets_at_a_time(spark, tmp_path, monkeypatch):
    path, dealt, keep = str(tmp_path / "t"), [], upsert.base
    put(spark, path, 0, [(f"k{i}", "p", i) for i in range(100)])
    monkeypatch.setattr(upsert, "base", lambda *a: dealt.append(a[-1]) or keep(*a))
    monkeypatch.setattr(settings, "COMPACT_BUCKETS", 3)
    assert upsert.compact(spark, path, *about(), after=1, buckets=8)
    assert sorted(map(len, dealt)) == [2, 3, 3] and sorted(b for some in dealt for b in some) == list(range(8))
    monkeypatch.setattr(upsert, "base", keep)
    assert len(stored(spark, path)) == 100
    put(spark, path, 1, [(f"k{i}", "newer", 1000) for i in range(50)])
    assert upsert.compact(spark, path, *about(), after=1)
    assert [p for _, p, _ in stored(spark, path)].count("newer") == 50 and len(stored(spark, path)) == 100


def test_offsets_are_numbered_without_gathering_a_partition(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("p"), (F.col("id") * 7 - 900).alias("n"))
    got = registry._numbered(rows, "p", "n", span=100)
    assert got.columns == ["p", "n", "offset"]
    want = rows.withColumn("offset", F.row_number().over(Window.partitionBy("p").orderBy("n")).cast("bigint") - 1)
    assert got.count() == 500 and got.exceptAll(want).isEmpty()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "row_number() windowspecdefinition(p#" in plan and ", _span#" in plan[plan.index("row_number() windowspecdefinition("):]


def test_batches_are_dealt_once_for_a_compaction(spark, tmp_path, monkeypatch):
    """A single batch holds a row per key already: it is dealt to the buckets and not ranked again."""
    path, ranked = str(tmp_path / "t"), []
    schema = "k string, v bigint"
    keep = upsert.resolve
    monkeypatch.setattr(upsert, "resolve", lambda *a: ranked.append(1) or keep(*a))
    about = (spark.createDataFrame([], schema).schema, "k", [F.col("v")])
    upsert.write_batch(spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], schema), 0, path, "k", [F.col("v")])
    assert upsert.compact(spark, path, *about, after=1, buckets=2) and not ranked
    for number, value in ((1, 5), (2, 4)):
        upsert.write_batch(spark.createDataFrame([("a", value)], schema), number, path, "k", [F.col("v")])
    assert upsert.compact(spark, path, *about, after=1, buckets=2) and ranked
    assert sorted(tuple(r) for r in upsert.current(spark, path, *about).collect()) == [("a", 5, 1), ("b", 2, 0)]


def test_one_batch_is_read_as_it_is(spark, tmp_path, monkeypatch):
    """A single batch since the last compaction is a row per key: a reader doesn't shuffle and rank it again."""
    path, ranked, keep, deltas = str(tmp_path / "t"), [], upsert.resolve, upsert.deltas
    monkeypatch.setattr(upsert, "resolve", lambda *a: ranked.append(1) or keep(*a))
    put(spark, path, 0, BATCHES[0])
    rows = upsert.current(spark, path, *about())
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString() and not ranked
    assert stored(spark, path) == [("a", "new", 0), ("b", "b0", 0)]

    def meanwhile(*a):  # a second batch comes after the batches were listed
        put(spark, path, 1, BATCHES[1])
        return deltas(*a)

    monkeypatch.setattr(upsert, "deltas", meanwhile)
    assert stored(spark, path) == [("a", "new", 0), ("b", "b0", 0)]
    monkeypatch.setattr(upsert, "deltas", deltas)
    assert stored(spark, path) == [("a", "later", 1), ("b", "b0", 0), ("c", "c1", 1)] and ranked
    assert upsert.compact(spark, path, *about(), after=1, buckets=2)
    ranked.clear()
    put(spark, path, 2, BATCHES[2])
    assert stored(spark, path) == LATEST and not ranked


def test_topic_and_bronze_are_compressed_and_landed_unsorted(spark, sf, tmp_path):
    topic, bronze = tmp_path / "topic", tmp_path / "bronze"
    messages = tb.order_messages(spark, sf)
    registry._topic(messages, str(topic), rows=1000)
    files = list(topic.glob("part-*"))
    assert files and all(f.suffix == ".gz" for f in files) and max(spark.read.text(str(f)).count() for f in files) == 1000
    assert spark.read.text(str(topic)).exceptAll(messages).isEmpty() and spark.read.text(str(topic)).count() == messages.count()
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    assert jobs.land_changes(events.message_files(spark, str(topic)), str(bronze), str(tmp_path / "ck")) > 0
    assert all(".zstd." in f.name for f in bronze.rglob("*.parquet"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
