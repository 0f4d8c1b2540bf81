import pytest
from helpers import SF, frame, rows
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.plans import frames, jobs, sql
from clickloom.session import shared_folder
from clickloom.sources import decode_json, encode_json, kafka_options, write_kafka
from clickloom.sources.files import split_line


def test_kafka_options():
    assert kafka_options() == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "hotitems",
        "startingOffsets": "latest",
    }
    assert kafka_options("t", "h:1", "earliest", 500)["maxOffsetsPerTrigger"] == "500"


def test_records_in_kafka_layout(spark):
    data = [(1, 2, 3, "pv", 1000), (4, None, 6, None, 2000)]
    df = spark.createDataFrame(data, schemas.USER_BEHAVIOR)
    records = encode_json(df, ["user_id"])
    assert [f.dataType.simpleString() for f in records.schema] == ["binary", "binary"]
    assert set(map(str, decode_json(records, schemas.USER_BEHAVIOR).collect())) == set(map(str, df.collect()))
    broken = spark.createDataFrame([(bytearray(b"not json"),)], "value binary")
    assert tuple(decode_json(broken, schemas.RECEIPT_EVENT).first()) == (None, None, None)


def test_kafka_writer_is_configured(spark):
    stream = frames.event_stream(spark, SF)
    assert write_kafka(stream.select("user_id"), "/tmp/clickloom-tests/none") is not None


def test_split_line(spark):
    df = spark.createDataFrame([("3,create,,1618203600000",), ("x,pay, t ,1",)], "value string")
    assert [tuple(r) for r in split_line(df, schemas.ORDER_EVENT).collect()] == [
        (3, "create", "", 1618203600000),
        (None, "pay", "t", 1),
    ]


def test_sql_forms_agree(spark):
    data = [(i % 5, "pv" if i % 4 else "buy", 800 * i) for i in range(200)]
    df = frame(spark, data, "item_id long, behavior string, ts_ms long")
    expected = rows(jobs.hot_items(df), "item_id", "window_end_ms", "cnt", "row_num")
    assert rows(sql.hot_items_in_sql(df), "item_id", "window_end_ms", "cnt", "row_num") == expected
    table = sql.hot_items_from_table(df)
    assert rows(table, "item_id", "cnt", "row_num") == sorted((i, c, r) for i, _, c, r in expected)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_session_zone_does_not_matter(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    expected = rows(jobs.hot_items(frames.behavior(frames.events(spark, SF)), view="view"))
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert rows(jobs.hot_items(frames.behavior(frames.events(spark, SF)), view="view")) == expected
        ms = frames.events(spark, SF).agg(F.min("ts_ms")).first()[0]
        assert ms == 1704067798778
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark, "x").startswith("/tmp/clickloom-tests/clickloom/x-")


def test_filters_reach_the_scan(spark):
    plan = jobs.hot_items(frames.behavior(frames.events(spark, SF)), view="view")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in text
