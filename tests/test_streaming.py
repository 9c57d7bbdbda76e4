import json

import pytest
from medallion.plans import read_quarantine, read_raw
from medallion.plans.refine import locate_quarantine
from medallion.sources import text_messages
from medallion.sources.messages import positioned
from medallion.streaming import Offsets, drain_to_raw, land_messages, parse_again
from medallion.streaming.positions import RAW_POSITION, folded

SCHEMA = "id int, v string"


@pytest.fixture
def topic(spark, folder):
    path = folder("topic")

    def send(*texts):
        spark.createDataFrame([(t,) for t in texts], "value string").write.mode("append").text(path)

    send.path = path
    return send


def event(i, v="a"):
    return json.dumps({"operation": "insert", "before": {}, "after": {"id": i, "v": v}})


def drain(spark, lake, topic, progress, **options):
    raw = lake.table("raw", "shop", "items")
    return drain_to_raw(text_messages(spark, topic.path, **options), raw, SCHEMA, progress)


def ids(lake):
    return sorted(r.id for r in read_raw(lake, "shop", "items", from_events=True).collect())


def test_each_run_adds_what_is_new_and_stops(spark, lake, topic, folder):
    progress = folder("progress")
    topic(event(1), event(2))
    assert not drain(spark, lake, topic, progress).isActive
    assert ids(lake) == [1, 2]
    drain(spark, lake, topic, progress)
    assert ids(lake) == [1, 2]
    topic(event(3))
    drain(spark, lake, topic, progress)
    assert ids(lake) == [1, 2, 3]


def test_streams_with_progress_of_their_own_do_not_overwrite_each_other(
    spark, lake, topic, folder
):
    topic(event(1))
    drain(spark, lake, topic, folder("progress"))
    drain(spark, lake, topic, folder("progress"))
    assert ids(lake) == [1, 1]


def test_batches_and_batch_writes_share_a_table(spark, lake, topic, folder):
    for i in range(3):
        topic(event(i))
    drain(spark, lake, topic, folder("progress"), max_files=1)
    assert ids(lake) == [0, 1, 2]
    more = lake.read("raw", "shop", "items").filter("after.id = 2")
    lake.write(more, "raw", "shop", "items")
    assert ids(lake) == [0, 1, 2, 2]


def test_a_batch_that_failed_after_writing_is_written_once(spark, lake, topic, folder):
    """The sink has the rows but the stream does not know: it repeats the batch."""
    progress = folder("progress")
    topic(event(1), event(2))
    raw = lake.table("raw", "shop", "items")

    class Failing:
        def add_batch(self, df, run_id, batch_id):
            raw.add_batch(df, run_id, batch_id)
            raise RuntimeError("lost the driver")

    with pytest.raises(Exception, match="lost the driver"):
        drain_to_raw(text_messages(spark, topic.path), Failing(), SCHEMA, progress)
    assert ids(lake) == [1, 2]
    drain(spark, lake, topic, progress)
    assert ids(lake) == [1, 2]


def test_bad_messages_are_set_aside(spark, lake, topic, folder):
    topic(event(1), "not json", event(2), '{"after": {"id": "x"}}')
    drain(spark, lake, topic, folder("progress"))
    assert ids(lake) == [1, 2]
    bad = sorted(r.rejected for r in read_quarantine(lake, "shop", "items").collect())
    assert bad == ["not json", '{"after": {"id": "x"}}']


def test_files_per_batch(spark, lake, folder, topic):
    for i in range(4):
        topic(event(i))
    raw = lake.table("raw", "shop", "items")
    drain_to_raw(
        text_messages(spark, topic.path), raw, SCHEMA, folder("progress"), files_per_batch=1
    )
    assert len(raw.read().inputFiles()) == 1
    assert ids(lake) == [0, 1, 2, 3]


WITH_POSITION = "value string, topic string, partition int, offset bigint"


@pytest.fixture
def positioned_messages(spark):
    def make(*places, partition=0, text=None):
        rows = [(text or f'{{"after": {{"id": {o}}}}}', "t", partition, o) for o in places]
        return spark.createDataFrame(rows, WITH_POSITION)

    return make


def test_positions_stay_with_the_messages(spark, lake, positioned_messages):
    raw = lake.table("raw", "shop", "p")
    land_messages(positioned_messages(3, 4, partition=7), raw, "id bigint", "a", 0)
    land_messages(positioned_messages(9, text="no json"), raw, "id bigint", "a", 1)
    found = raw.read(all_columns=True).select("after.id", *RAW_POSITION).collect()
    assert sorted(map(tuple, found), key=str) == [(3, "t", 7, 3), (4, "t", 7, 4), (None, "t", 0, 9)]
    assert [tuple(r) for r in locate_quarantine(lake, "shop", "p").collect()] == [
        ("run-a/batch-1", "t", 0, 9, "no json")
    ]


def test_offsets_that_raw_holds_stay_out(spark, lake, positioned_messages):
    raw, offsets = lake.table("raw", "shop", "p"), Offsets(lake.table("state", "offsets", "p"))

    def land(run, batch, *messages):
        rows = messages[0]
        for more in messages[1:]:
            rows = rows.union(more)
        land_messages(rows, raw, "id bigint", run, batch, offsets=offsets)

    def held():
        return sorted((r[2], r[3]) for r in raw.read(all_columns=True).select("after.id", *RAW_POSITION).collect())

    land("a", 0, positioned_messages(0, 1, 2), positioned_messages(0, partition=1))
    land("a", 1, positioned_messages(3, 4), positioned_messages(5, 6, partition=1))
    # another stream from the start, and a batch of the first one again
    land("b", 0, positioned_messages(*range(7)), positioned_messages(*range(7), partition=1))
    land("a", 1, positioned_messages(3, 4), positioned_messages(5, 6, partition=1))
    assert held() == [(0, k) for k in range(7)] + [(1, k) for k in range(7)]
    with pytest.raises(ValueError, match="no position"):
        land("c", 0, spark.createDataFrame([("x",)], "value string"))


def test_ranges_fold(spark):
    rows = [("t", 0, 0, 4), ("t", 0, 5, 9), ("t", 0, 20, 30), ("t", 0, 2, 3), ("t", 0, 25, 26), ("t", 1, 0, 0), ("u", 0, 1, 2)]
    frame = spark.createDataFrame(rows, "topic string, partition int, first bigint, last bigint")
    assert sorted(map(tuple, folded(frame).collect())) == [
        ("t", 0, 0, 9), ("t", 0, 20, 30), ("t", 1, 0, 0), ("u", 0, 1, 2),
    ]


def test_rejected_messages_get_a_second_chance(spark, lake, positioned_messages):
    raw = lake.table("raw", "shop", "p")
    text = '{"after": {"id": "x7"}}'
    land_messages(positioned_messages(1, text=text), raw, "id bigint", "a", 0)
    land_messages(positioned_messages(2, text="never"), raw, "id bigint", "a", 1)
    land_messages(positioned_messages(3), raw, "id bigint", "a", 2)
    assert [parse_again(raw, "id string") for _ in range(2)] == [1, 1]
    again = raw.read_batches(["run-again/batch-0"])
    assert [tuple(r) for r in again.select("after.id", *RAW_POSITION).collect()] == [("x7", "t", 0, 1)]
    assert read_quarantine(lake, "shop", "p").count() == 2
    assert [r[0] for r in read_quarantine(lake, "shop", "p", "id string").collect()] == ["never"]
    assert parse_again(lake.table("raw", "shop", "none"), "id string") == 0


def test_kafka_frames_keep_text_and_position(spark):
    frame = spark.sql("SELECT CAST('x' AS binary) AS value, 't' AS topic, 1 AS partition, 5L AS offset, 0 AS key")
    assert [tuple(r) for r in positioned(frame).collect()] == [("x", "t", 1, 5)]
