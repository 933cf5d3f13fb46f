"""Avro files: every type there and back, splits at any byte, files from elsewhere, failed tasks."""

import datetime as dt
import json
import os
import zlib
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.sources import avro
from tallymark.sources.avro import Cursor, Names, put_long, read_avro, reader_of, write_avro, writer_of

SCHEMA = """a boolean, b tinyint, c smallint, d int, e bigint, f float, g double, h string, i binary, j date,
  k timestamp, l timestamp_ntz, m decimal(20,3), n array<int>, o map<string, array<date>>,
  p struct<q: string, r: struct<s: timestamp, t: decimal(5,2)>>, u bigint not null"""
UTC = dt.timezone.utc
FULL = (True, -128, 32767, -(1 << 31), (1 << 63) - 1, 1.5, -2.25, "Zoë\n\u0000🙂", b"\x00\xff", dt.date(1969, 12, 31),
        dt.datetime(1960, 1, 2, 3, 4, 5, 678901, UTC), dt.datetime(2024, 2, 29, 23, 59, 59), Decimal("-12345.678"),
        [1, None, -1], {"k": [dt.date(2020, 1, 1), None], "": None},
        ("q", (dt.datetime(2000, 1, 1, tzinfo=UTC), Decimal("-0.01"))), -(1 << 63))
ROWS = [FULL, (None,) * 16 + (0,), (False, 0, 0, 0, 0, 0.0, 0.0, "", b"", dt.date(1970, 1, 1),
        dt.datetime(1970, 1, 1, tzinfo=UTC), dt.datetime(1970, 1, 1), Decimal("0.000"), [], {}, (None, None), 1)]


@pytest.mark.parametrize("codec", ["deflate", "null"])
def test_every_type_comes_back(spark, tmp_path, codec):
    df = spark.createDataFrame(ROWS, SCHEMA)
    write_avro(df, f"{tmp_path}/x", codec=codec)
    back = read_avro(spark, f"{tmp_path}/x")
    assert [f.name for f in back.schema] == df.columns
    assert [(f.dataType, f.nullable) for f in back.schema][3:] == [(f.dataType, f.nullable) for f in df.schema][3:]
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


@settings(max_examples=300, deadline=None)
@given(st.integers(-(1 << 63), (1 << 63) - 1))
def test_whole_numbers(value):
    out = bytearray()
    put_long(out, value)
    assert Cursor(bytes(out)).long() == value


@settings(max_examples=200, deadline=None)
@given(st.decimals(allow_nan=False, allow_infinity=False, places=3, min_value=-10**12, max_value=10**12))
def test_decimals(value):
    schema = {"type": "bytes", "logicalType": "decimal", "precision": 20, "scale": 3}
    out = bytearray()
    writer_of(schema)(out, value)
    assert reader_of(schema, Names())(Cursor(bytes(out))) == value


def test_splits_anywhere_read_every_row_once(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/x"
    rows = spark.range(0, 3000, 1, 3).select("id", F.concat(F.lit("name "), "id").alias("name"))
    write_avro(rows, path)  # one block a file
    assert len([f for f in os.listdir(path) if f.endswith(".avro")]) == 3
    small = f"{tmp_path}/y"
    (tmp_path / "y").mkdir()
    for name in os.listdir(path):  # the same files in blocks of ten rows
        with open(f"{path}/{name}", "rb") as file:
            header = avro.read_header(file)
            size = os.path.getsize(f"{path}/{name}")
            take, out = reader_of(header.schema, Names()), [file.seek(0) or file.read(header.end)]
            put = writer_of(header.schema)
            for count, data in avro.blocks(file, header, 0, size, size):
                cursor = Cursor(data)
                values = [take(cursor) for _ in range(count)]
                for at in range(0, count, 10):
                    body, frame = bytearray(), bytearray()
                    for value in values[at:at + 10]:
                        put(body, value)
                    packed = zlib.compress(bytes(body), wbits=-15)
                    put_long(frame, len(values[at:at + 10]))
                    put_long(frame, len(packed))
                    out += [bytes(frame), packed, header.sync]
        (tmp_path / "y" / name).write_bytes(b"".join(out))
    for split in (61, 97, 1000, 1 << 20):
        got = read_avro(spark, small, splitBytes=str(split))
        assert sorted(r.id for r in got.collect()) == list(range(3000)), split


def test_files_from_elsewhere(spark, tmp_path):
    """Unions in any order, named types, enums, fixed, millis, blocks with sizes, a recursive record."""
    schema = {"type": "record", "name": "top", "namespace": "n", "fields": [
        {"name": "either", "type": ["string", "null", "long"]}, {"name": "number", "type": ["int", "null", "long"]},
        {"name": "colour", "type": {"type": "enum", "name": "hue", "symbols": ["red", "blue"]}},
        {"name": "again", "type": "hue"}, {"name": "four", "type": {"type": "fixed", "name": "f4", "size": 4}},
        {"name": "when", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "list", "type": {"type": "array", "items": "int"}}, {"name": "gone", "type": "null"}]}
    body = bytearray()
    for either, number in (((0, b"\x02x"), (2, 1 << 40)), ((1, b""), (1, None)), ((2, b"\x0e"), (0, 3))):
        put_long(body, either[0])
        body += either[1]
        put_long(body, number[0])
        if number[1] is not None:
            put_long(body, number[1])
        body += b"\x02\x00abcd"
        put_long(body, 1500)
        body += b"\x03\x04\x02\x04\x00"  # two items in a block of two bytes
    out = bytearray(avro.MAGIC)
    writer_of({"type": "map", "values": "bytes"})(out, [("avro.schema", json.dumps(schema).encode())])
    sync = b"0123456789abcdef"
    out += sync
    put_long(out, 3)
    put_long(out, len(body))
    (tmp_path / "x.avro").write_bytes(bytes(out + body + sync))
    rows = read_avro(spark, f"{tmp_path}/x.avro").orderBy("number").collect()
    assert [(r.either and r.either.asDict(), r.number, r.colour, r.again, bytes(r.four), r.list, r.gone) for r in rows] == [
        (None, None, "blue", "red", b"abcd", [1, 2], None),
        ({"member0": None, "member1": 7}, 3, "blue", "red", b"abcd", [1, 2], None),
        ({"member0": "x", "member1": None}, 1 << 40, "blue", "red", b"abcd", [1, 2], None)]
    assert rows[0].when == dt.datetime(1970, 1, 1, 0, 0, 1, 500000)


def test_append_overwrite_and_other_schemas(spark, tmp_path):
    path = f"{tmp_path}/x"
    write_avro(spark.range(3), path)
    write_avro(spark.range(3, 5).withColumn("name", F.lit("n")), path)
    got = read_avro(spark, path, "id bigint, name string").orderBy("id").collect()
    assert [(r.id, r.name) for r in got] == [(0, None), (1, None), (2, None), (3, "n"), (4, "n")]
    write_avro(spark.range(7, 9), path, mode="overwrite")
    assert [r.id for r in read_avro(spark, path).orderBy("id").collect()] == [7, 8]


def test_a_failed_job_leaves_no_file_to_read(spark, tmp_path):
    path = f"{tmp_path}/x"
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(
        F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        write_avro(bad, path)
    assert avro.files_in(path) == []
    assert read_avro(spark, path, "id bigint").count() == 0


def test_what_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="field name"):
        write_avro(spark.range(1).withColumnRenamed("id", "a b"), f"{tmp_path}/x")
    (tmp_path / "bad.avro").write_bytes(b"nothing")
    with pytest.raises(Exception, match="not an Avro"):
        read_avro(spark, f"{tmp_path}/bad.avro").collect()
    path = f"{tmp_path}/cut"
    write_avro(spark.range(0, 1000, 1, 1), path)
    file = avro.files_in(path)[0].path
    with open(file, "rb") as whole:
        data = whole.read()
    with open(file, "wb") as cut:
        cut.write(data[:-30])
    with pytest.raises(Exception, match="sync marker"):
        read_avro(spark, path).collect()
