"""Streams across restarts, and batches that are run again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymark.operators.scores import trainee_scores
from tallymark.streaming.appends import key_bucket, read_appended, stream_distinct, stream_insert_if_absent
from tallymark.streaming.scores import current_scores, stream_scores

SCHEMA = "trainee long, at timestamp_ntz, seq long, action string"


def actions(n, start=0):
    names = ["visit_lecture", "do_homework", "miss_lecture", "miss_homework", "none"]
    first = dt.datetime(2024, 1, 1)
    return [(0 if i % 3 else i % 5, first + dt.timedelta(minutes=i), i, names[i * 7 % 5]) for i in range(start, start + n)]


def scores_of(spark, folder, deliveries, delay="2 hours"):
    inbox, marks, progress = (f"{folder}/{p}" for p in ("inbox", "marks", "progress"))
    for k, rows in enumerate(deliveries):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{inbox}/{k}")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{inbox}/*")
        stream_scores(stream, marks, progress, delay).awaitTermination()
    return sorted(current_scores(spark, marks).collect(), key=str)


def whole_scores(spark, rows):
    return sorted(trainee_scores(spark.createDataFrame(rows, SCHEMA)).collect(), key=str)


def test_scores_continue_after_a_restart(spark, tmp_path):
    """Three runs of the stream from one checkpoint; each trainee is in all of them."""
    deliveries = [actions(60, 60 * k) for k in range(3)]
    assert all(len({r[0] for r in d}) == 5 for d in deliveries)
    assert scores_of(spark, tmp_path, deliveries) == whole_scores(spark, actions(180))


def test_actions_that_come_late_take_their_place(spark, tmp_path):
    """Neighbours swapped across deliveries: their order decides the mark, as it is clamped."""
    rows = actions(180)
    late = [r for r in rows if r[2] % 7 == 3]
    in_time = [r for r in rows if r[2] % 7 != 3]
    deliveries = [in_time[:70], late[:10] + in_time[70:90], in_time[90:] + late[10:]]
    assert scores_of(spark, tmp_path, deliveries) == whole_scores(spark, rows)
    first, *rest = [r for d in deliveries for r in d if r[0] == 0]
    by_arrival = trainee_scores(spark.createDataFrame(
        [(r[0], r[1], n, r[3]) for n, r in enumerate([first, *rest])], SCHEMA).withColumn("at", F.lit(None))).first()
    assert by_arrival.mark != next(r.mark for r in whole_scores(spark, rows) if r.trainee == 0)


def test_settled_actions_leave_the_state_and_later_ones_are_dropped(spark, tmp_path):
    rows = actions(180)
    too_late = (0, dt.datetime(2024, 1, 1), 999, "do_homework")
    deliveries = [rows[:170], rows[170:], [too_late], [(99, dt.datetime(2024, 1, 1, 2, 59), 1, "do_homework")]]
    got = scores_of(spark, tmp_path, deliveries, delay="10 minutes")
    assert got == whole_scores(spark, rows + [deliveries[3][0]])
    state = spark.read.format("statestore").option("stateVarName", "pending").load(f"{tmp_path}/progress")
    kept = state.selectExpr("list_value.at AS at").collect() if "list_value" in state.columns else None
    if kept is not None:
        assert all(r.at >= 1704067200_000_000 + 60_000_000 * (179 - 10) for r in kept) and len(kept) < 15


def test_actions_without_a_time_or_a_trainee(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    rows = [(None, day, 1, "do_homework"), (1, None, 1, "do_homework"), (1, day, 2, "miss_lecture"),
            (None, day, 0, "miss_homework"), (1, day, None, "visit_lecture")]
    got = scores_of(spark, tmp_path, [rows])
    assert sorted((r.trainee or 0, r.mark) for r in got) == [(0, 2), (1, 2)]


EVENTS = "event_id long, ts timestamp_ntz, value int"


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Tokyo"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_append_ignores_what_is_there(spark, tmp_path, zone):
    inbox, table, progress = (str(tmp_path / p) for p in ("inbox", "table", "progress"))
    day = dt.datetime(2024, 1, 1)
    deliveries = [[(1, day, 10), (2, day, 20), (2, day, 21)], [(2, day, 22), (3, day, 30)], [(1, day, 10), (3, day, 31)],
                  [(1, None, 11), (2, day + dt.timedelta(days=9), 23)]]
    for k, rows in enumerate(deliveries):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{inbox}/{k}")
        stream = spark.readStream.schema(EVENTS).parquet(f"{inbox}/*")
        stream_insert_if_absent(stream, table, progress, ["event_id"], ["ts", "value"]).awaitTermination()
    schema = spark.createDataFrame([], EVENTS).schema
    out = read_appended(spark, table, schema).select("event_id", "value").collect()
    assert sorted(map(tuple, out)) == [(1, 10), (2, 20), (3, 30)]


def test_a_batch_reads_the_buckets_of_its_keys_only(spark, tmp_path):
    table = str(tmp_path / "table")
    day = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(i, day, i) for i in range(2000)], EVENTS)
    rows.withColumn("bucket", key_bucket(["event_id"])).write.partitionBy("bucket").parquet(f"{table}/batch=0")
    wanted = [r[0] for r in rows.filter("event_id in (5, 17)").select(key_bucket(["event_id"])).collect()]
    read = read_appended(spark, table, rows.schema, before=1, buckets=wanted)
    files = {r[0].split("bucket=")[1].split("/")[0] for r in read.select(F.input_file_name()).distinct().collect()}
    assert files == set(map(str, wanted)) and read.columns == rows.columns
    assert {5, 17} <= {r.event_id for r in read.collect()}
    assert read_appended(spark, table, rows.schema, before=0).count() == 0


def test_append_replays_from_a_lost_checkpoint(spark, tmp_path):
    inbox, table = str(tmp_path / "inbox"), str(tmp_path / "table")
    day = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, day, 10), (2, day, 20)], EVENTS).coalesce(1).write.parquet(f"{inbox}/0")
    for progress in ("p1", "p2"):
        stream = spark.readStream.schema(EVENTS).parquet(f"{inbox}/*")
        stream_insert_if_absent(
            stream, table, str(tmp_path / progress), ["event_id"], ["ts"]).awaitTermination()
    schema = spark.createDataFrame([], EVENTS).schema
    assert read_appended(spark, table, schema).count() == 2


def test_repeats_within_the_watermark(spark, tmp_path):
    inbox, table, progress = (str(tmp_path / p) for p in ("inbox", "table", "progress"))
    day = dt.datetime(2024, 1, 1)
    rows = [(1, day, 10), (1, day, 10), (2, day + dt.timedelta(hours=1), 20)]
    schema = "event_id long, ts timestamp, value int"
    for k in range(2):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{inbox}/{k}")
        stream = spark.readStream.schema(schema).parquet(f"{inbox}/*")
        stream_distinct(stream, table, progress, ["event_id"], "ts", "2 hours").awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(table).collect()) == [1, 2]
