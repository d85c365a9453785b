import json

import pytest
from pyspark.sql import functions as F

from silverbrook.sources import segments
from silverbrook.streaming import jobs, sinks


def put(topic, partition, first, lines, name="a"):
    folder = topic / f"partition={partition}" / f"first={first:020d}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def drain(spark, topic, tmp_path, per_task=3, fail_at=None):
    """Appends what is new to a table; a message can break the batch."""
    rows = segments.message_segments(spark, str(topic), per_task)
    if fail_at:
        rows = rows.withColumn("value", F.when(F.col("value") == fail_at, F.raise_error(F.lit("broken"))).otherwise(
            F.col("value")))
    return sinks.drain(spark, sinks.append_writer(rows, str(tmp_path / "out"), str(tmp_path / "ck")))


def table(spark, tmp_path):
    rows = spark.read.schema("partition int, offset bigint, value string").parquet(str(tmp_path / "out")).collect()
    return sorted(tuple(r) for r in rows)


def test_offsets_go_on_where_the_last_batch_ended(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, 0, 5, ["e", "f", "g", "h"])  # what lay before has been removed
    put(topic, 0, 9, ["i"])
    put(topic, 1, 0, ["A"])
    want = [(0, 5 + k, v) for k, v in enumerate("efghi")] + [(1, 0, "A")]
    assert drain(spark, topic, tmp_path) == 6 and table(spark, tmp_path) == want
    assert drain(spark, topic, tmp_path) == 0
    put(topic, 0, 9, ["i", "j", "ß"])
    put(topic, 0, 12, ["l", "m", "n", "o"])
    put(topic, 2, 0, ["new"])
    want += [(0, 10, "j"), (0, 11, "ß"), *((0, 12 + k, v) for k, v in enumerate("lmno")), (2, 0, "new")]
    assert drain(spark, topic, tmp_path) == 7 and table(spark, tmp_path) == sorted(want)


def test_a_failed_batch_is_read_again(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, 0, 0, list("abc"))
    assert drain(spark, topic, tmp_path) == 3
    put(topic, 0, 3, list("def"))
    with pytest.raises(Exception, match="broken"):
        drain(spark, topic, tmp_path, fail_at="e")
    assert [v for _, _, v in table(spark, tmp_path)] == list("abc")
    put(topic, 0, 6, list("gh"))  # comes after the failed batch, which holds the same messages as before
    assert drain(spark, topic, tmp_path) == 3
    assert [v for _, _, v in table(spark, tmp_path)] == list("abcdef")
    assert drain(spark, topic, tmp_path) == 2
    assert [(o, v) for _, o, v in table(spark, tmp_path)] == list(enumerate("abcdefgh"))


def test_tasks_are_bounded_and_lost_messages_are_noticed(tmp_path):
    topic = tmp_path / "topic"
    for first in range(0, 100, 10):
        put(topic, 0, first, [str(first + k) for k in range(10)])
    reader = segments.SegmentReader(str(topic), 7)
    spans = reader.partitions({"0": 3}, {"0": 98})
    assert [(s.begin, s.end) for s in spans] == [(a, min(a + 7, 98)) for a in range(3, 98, 7)]
    assert all(len(s.segments) <= 2 for s in spans)
    assert [v for s in spans for _, _, v in reader.read(s)] == [str(k) for k in range(3, 98)]
    assert reader.partitions({"0": 98}, {"0": 98}) == []
    with pytest.raises(ValueError, match="gone"):
        segments.SegmentReader(str(tmp_path / "none"), 7).partitions({"0": 3}, {"0": 5})
    assert segments.SegmentReader(str(tmp_path / "none"), 7).latestOffset() == {}


def test_events_from_segments(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, 0, 0, [json.dumps({"event_id": "1", "session_id": "s", "event_type": "search"}), "no json"])
    where = [str(tmp_path / n) for n in ("bronze", "ck")]
    assert jobs.land_events(segments.message_segments(spark, str(topic)), *where) == 2
    assert jobs.land_events(segments.message_segments(spark, str(topic)), *where) == 0
