"""Avro object container files as a Spark data source.

A task writes one file of deflated blocks, each followed by the file's sync marker, under a hidden
name; the commit gives the files of the tasks that count their names, so a lost or repeated task
leaves nothing behind. A file is read in splits of bytes: a split owns the blocks that begin in it and
finds its first one at a sync marker, so every block is read once wherever the cuts fall.

Paths are folders that driver and executors share; any file system of pyarrow will do.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema

MAGIC, SYNC = b"Obj\x01", 16
BLOCK_BYTES, SPLIT_BYTES, BATCH_ROWS = 1 << 18, 64 << 20, 4096

#: Fixed names of the format: primitive types, and logical types with what they are stored as.
PLAIN = {T.BooleanType(): "boolean", T.ByteType(): "int", T.ShortType(): "int", T.IntegerType(): "int",
         T.LongType(): "long", T.FloatType(): "float", T.DoubleType(): "double", T.StringType(): "string",
         T.BinaryType(): "bytes"}
LOGICAL = {T.DateType(): ("int", "date"), T.TimestampType(): ("long", "timestamp-micros"),
           T.TimestampNTZType(): ("long", "local-timestamp-micros")}
SPARK_OF = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
            "double": T.DoubleType(), "string": T.StringType(), "bytes": T.BinaryType(), "null": T.NullType(),
            "date": T.DateType(), "timestamp-micros": T.TimestampType(), "timestamp-millis": T.TimestampType(),
            "local-timestamp-micros": T.TimestampNTZType(), "local-timestamp-millis": T.TimestampNTZType()}
WIDER = ({"int", "long"}, T.LongType()), ({"float", "double"}, T.DoubleType())
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


# --- schemas


def avro_type(kind: T.DataType, name: str):
    """The Avro schema of a Spark type; `name` is what a record in it is called."""
    if kind in PLAIN:
        return PLAIN[kind]
    if kind in LOGICAL:
        stored, logical = LOGICAL[kind]
        return {"type": stored, "logicalType": logical}
    if isinstance(kind, T.DecimalType):
        return {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": optional(kind.elementType, kind.containsNull, name)}
    if isinstance(kind, T.MapType) and kind.keyType == T.StringType():
        return {"type": "map", "values": optional(kind.valueType, kind.valueContainsNull, name)}
    if isinstance(kind, T.StructType):
        for field in kind:
            if not NAME.match(field.name):
                raise ValueError(f"{field.name!r} cannot be a field name in Avro")
        return {"type": "record", "name": name, "fields": [
            {"name": f.name, "type": optional(f.dataType, f.nullable, f"{name}_{f.name}")} for f in kind]}
    raise ValueError(f"no Avro type for {kind.simpleString()}")


def optional(kind: T.DataType, nullable: bool, name: str):
    made = avro_type(kind, name)
    return ["null", made] if nullable else made


class Names:
    """Types by name: records, enums and fixed types may be referred to further on."""

    def __init__(self):
        self.known: dict[str, dict] = {}

    def resolve(self, schema):
        """The schema itself, its kind, and its branches if it is a union."""
        if isinstance(schema, list):
            return schema, "union"
        if isinstance(schema, str):
            schema = self.known.get(schema, {"type": schema})
        if isinstance(schema["type"], (dict, list)):
            return self.resolve(schema["type"])
        if "name" in schema and schema["type"] in ("record", "error", "enum", "fixed"):
            for name in (schema["name"], f"{schema.get('namespace', '')}.{schema['name']}"):
                self.known[name] = schema
        return schema, schema["type"]


def merged_union(branches: list) -> T.DataType | None:
    """The one type of a union whose branches are a narrow and a wide number."""
    found = {b if isinstance(b, str) else None for b in branches}
    return next((wide for names, wide in WIDER if found == names), None)


def spark_type(schema, names: Names) -> tuple[T.DataType, bool]:
    """The Spark type of an Avro schema and whether it may be null."""
    schema, kind = names.resolve(schema)
    if kind == "union":
        branches = [b for b in schema if b != "null"]
        nullable = len(branches) < len(schema)
        if len(branches) == 1:
            return spark_type(branches[0], names)[0], nullable
        if wide := merged_union(branches):
            return wide, nullable
        return T.StructType([T.StructField(f"member{i}", spark_type(b, names)[0], True)
                             for i, b in enumerate(branches)]), nullable
    if kind in ("record", "error"):
        return T.StructType([T.StructField(f["name"], *spark_type(f["type"], names)) for f in schema["fields"]]), False
    if kind == "array":
        return T.ArrayType(*spark_type(schema["items"], names)), False
    if kind == "map":
        return T.MapType(T.StringType(), *spark_type(schema["values"], names)), False
    if kind == "enum":
        return T.StringType(), False
    if schema.get("logicalType") == "decimal":
        return T.DecimalType(schema["precision"], schema.get("scale", 0)), False
    if kind == "fixed":
        return T.BinaryType(), False
    return SPARK_OF.get(schema.get("logicalType"), SPARK_OF[kind]), kind == "null"


# --- values


def put_long(out: bytearray, value: int) -> None:
    rest = (value << 1) ^ (value >> 63)
    while rest > 127:
        out.append(rest & 127 | 128)
        rest >>= 7
    out.append(rest)


def put_bytes(out: bytearray, value: bytes) -> None:
    put_long(out, len(value))
    out += value


def writer_of(schema) -> Callable[[bytearray, object], None]:
    """What appends a value of this (own) schema; dates and times come as whole numbers."""
    if isinstance(schema, list):
        inner = writer_of(schema[1])

        def maybe(out, value):
            if value is None:
                out.append(0)
            else:
                out.append(2)
                inner(out, value)
        return maybe
    kind = schema if isinstance(schema, str) else schema["type"]
    if kind in ("int", "long"):
        return put_long
    if kind == "boolean":
        return lambda out, value: out.append(1 if value else 0)
    if kind in ("float", "double"):
        pack = struct.Struct("<f" if kind == "float" else "<d").pack
        return lambda out, value: out.extend(pack(value))
    if kind == "string":
        return lambda out, value: put_bytes(out, value.encode())
    if kind == "bytes" and not isinstance(schema, str):
        scale = schema["scale"]

        def decimal(out, value):
            whole = int(value.scaleb(scale))
            put_bytes(out, whole.to_bytes((whole + (whole < 0)).bit_length() // 8 + 1, "big", signed=True))
        return decimal
    if kind == "bytes":
        return put_bytes
    if kind == "record":
        fields = [(f["name"], writer_of(f["type"])) for f in schema["fields"]]

        def record(out, value):
            for name, put in fields:
                put(out, value[name])
        return record
    inner = writer_of(schema["items" if kind == "array" else "values"])

    def several(out, value):
        if value:
            put_long(out, len(value))
            for each in value:
                if kind == "map":
                    put_bytes(out, each[0].encode())
                    each = each[1]
                inner(out, each)
        out.append(0)
    return several


class Cursor:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def long(self) -> int:
        data, at, value, shift = self.data, self.at, 0, 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                self.at = at
                return (value >> 1) ^ -(value & 1)
            shift += 7

    def take(self, n: int) -> bytes:
        self.at += n
        if n < 0 or self.at > len(self.data):
            raise ValueError("an Avro value goes beyond its block")
        return self.data[self.at - n:self.at]

    def bytes(self) -> bytes:
        return self.take(self.long())


def reader_of(schema, names: Names) -> Callable[[Cursor], object]:
    """What takes a value of any schema off a cursor; dates and times stay whole numbers."""
    schema, kind = names.resolve(schema)
    if kind == "union":
        takes = [reader_of(b, names) for b in schema]
        branches = [b for b in schema if b != "null"]
        if len(branches) < 2 or merged_union(branches):
            return lambda c: takes[c.long()](c)
        members = {i: f"member{branches.index(b)}" for i, b in enumerate(schema) if b != "null"}

        def branch(c):
            i = c.long()
            value = takes[i](c)
            return {members[i]: value} if i in members else None
        return branch
    if kind in ("record", "error"):
        fields: list = []  # filled below, so that a record may hold itself in a union

        def record(c):
            return {name: take(c) for name, take in fields}
        fields += [(f["name"], reader_of(f["type"], names)) for f in schema["fields"]]
        return record
    if kind in ("array", "map"):
        inner = reader_of(schema["items" if kind == "array" else "values"], names)

        def several(c):
            out = []
            while n := c.long():
                if n < 0:  # a block that says its size in bytes, too
                    n = -n
                    c.long()
                for _ in range(n):
                    out.append((c.bytes().decode(), inner(c)) if kind == "map" else inner(c))
            return out
        return several
    if kind == "enum":
        symbols = schema["symbols"]
        return lambda c: symbols[c.long()]
    raw = (lambda c: c.take(schema["size"])) if kind == "fixed" else Cursor.bytes
    if schema.get("logicalType") == "decimal":
        scale = schema.get("scale", 0)
        return lambda c: Decimal(int.from_bytes(raw(c), "big", signed=True)).scaleb(-scale)
    if kind in ("int", "long"):
        if schema.get("logicalType", "").endswith("timestamp-millis"):
            return lambda c: c.long() * 1000
        return Cursor.long
    if kind == "boolean":
        return lambda c: c.take(1) == b"\x01"
    if kind in ("float", "double"):
        unpack, size = struct.Struct("<f" if kind == "float" else "<d").unpack, 4 if kind == "float" else 8
        return lambda c: unpack(c.take(size))[0]
    return {"string": lambda c: c.bytes().decode(), "null": lambda c: None}.get(kind, raw)


# --- files


def located(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)


def files_in(path: str) -> list[fs.FileInfo]:
    """The files of a folder, or the one file; hidden ones are left out."""
    system, place = located(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.is_file:
        return [info]
    found = system.get_file_info(fs.FileSelector(place, recursive=True))
    return sorted((f for f in found if f.is_file and not os.path.basename(f.path).startswith((".", "_"))),
                  key=lambda f: f.path)


@dataclass
class Header:
    schema: object
    codec: str
    sync: bytes
    end: int


def read_header(file) -> Header:
    """What a file starts with; its length is not known before it is read."""
    size = 1 << 16
    while True:
        file.seek(0)
        data = file.read(size)
        if data[:4] != MAGIC:
            raise ValueError("not an Avro object container file")
        cursor = Cursor(data)
        cursor.at = 4
        try:
            meta = dict(reader_of({"type": "map", "values": "bytes"}, Names())(cursor))
            sync = cursor.take(SYNC)
        except (IndexError, ValueError):
            if len(data) < size:
                raise ValueError("an Avro file that ends in its header") from None
            size *= 4
            continue
        return Header(json.loads(meta["avro.schema"]), meta.get("avro.codec", b"null").decode(), sync, cursor.at)


def first_block(file, header: Header, start: int, size: int) -> int:
    """Where the first block at or after `start` begins; `size` if there is none."""
    if start <= header.end:
        return header.end
    at, kept = start - SYNC, b""
    while at < size:
        file.seek(at)
        data = kept + file.read(1 << 20)
        found = data.find(header.sync)
        if found >= 0:
            return at - len(kept) + found + SYNC
        at += len(data) - len(kept)
        kept = data[-(SYNC - 1):]
    return size


def blocks(file, header: Header, start: int, end: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(number of values, bytes) of the blocks that begin in [start, end)."""
    at = first_block(file, header, start, size)
    while at < min(end, size):
        file.seek(at)
        cursor = Cursor(file.read(20))
        try:
            count, length = cursor.long(), cursor.long()
        except IndexError:
            raise ValueError("an Avro file that ends within a block") from None
        file.seek(at + cursor.at)
        data = file.read(length + SYNC)
        if data[length:] != header.sync:
            raise ValueError("an Avro block without its sync marker")
        at += cursor.at + length + SYNC
        yield count, zlib.decompress(data[:length], -15) if header.codec == "deflate" else data[:length]


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int
    size: int


class AvroReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, split_bytes: int):
        self.path, self.schema, self.split_bytes = path, schema, split_bytes

    def partitions(self):
        return [Split(f.path, at, min(at + self.split_bytes, f.size), f.size)
                for f in files_in(self.path) for at in range(0, f.size, self.split_bytes)]

    def read(self, split: Split | None):
        if split is None:  # Spark asks so when there are no files
            return
        arrow = to_arrow_schema(self.schema)
        with located(self.path)[0].open_input_file(split.path) as file:
            header = read_header(file)
            if header.codec not in ("null", "deflate"):
                raise ValueError(f"Avro codec {header.codec!r} is not supported")
            take, rows = reader_of(header.schema, Names()), []
            for count, data in blocks(file, header, split.start, split.end, split.size):
                cursor = Cursor(data)
                for _ in range(count):
                    rows.append(take(cursor))
                    if len(rows) == BATCH_ROWS:
                        yield self.batch(rows, arrow)
                        rows = []
            if rows:
                yield self.batch(rows, arrow)

    def batch(self, rows: list[dict], arrow: pa.Schema) -> pa.RecordBatch:
        """Columns by name: one that a file lacks is null, one that is not asked for goes."""
        return pa.RecordBatch.from_arrays(
            [pa.array([row.get(f.name) for row in rows], f.type) for f in arrow], schema=arrow)


@dataclass
class Written(WriterCommitMessage):
    path: str


def stored(kind: pa.DataType) -> pa.DataType:
    """An Arrow type with dates and times as the whole numbers they are kept as."""
    if pa.types.is_timestamp(kind):
        return pa.int64()
    if pa.types.is_date32(kind):
        return pa.int32()
    if pa.types.is_list(kind):
        return pa.list_(stored(kind.value_type))
    if pa.types.is_map(kind):
        return pa.map_(kind.key_type, stored(kind.item_type))
    if pa.types.is_struct(kind):
        return pa.struct([(f.name, stored(f.type)) for f in kind])
    return kind


class AvroWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, codec: str, overwrite: bool):
        if codec not in ("null", "deflate"):
            raise ValueError(f"Avro codec {codec!r} is not supported")
        self.path, self.codec = path, codec
        self.schema = json.dumps(avro_type(schema, "row"))
        system, place = located(path)
        system.create_dir(place, recursive=True)
        self.replaced = [f.path for f in files_in(path)] if overwrite else []

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, place = located(self.path)
        task = TaskContext.get().partitionId()
        target = f"{place}/.part-{task:05d}-{uuid.uuid4().hex}.avro"
        try:
            self.write_file(system, target, batches)
        except BaseException:
            if system.get_file_info(target).is_file:
                system.delete_file(target)
            raise
        return Written(target)

    def write_file(self, system: fs.FileSystem, target: str, batches: Iterator[pa.RecordBatch]) -> None:
        sync = uuid.uuid4().bytes
        fields = [(f["name"], writer_of(f["type"])) for f in json.loads(self.schema)["fields"]]
        with system.open_output_stream(target) as file:
            head = bytearray(MAGIC)
            writer_of({"type": "map", "values": "bytes"})(
                head, [("avro.schema", self.schema.encode()), ("avro.codec", self.codec.encode())])
            file.write(bytes(head) + sync)

            def flush(count: int, body: bytearray) -> None:
                data = bytes(body)
                if self.codec == "deflate":
                    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
                    data = pack.compress(data) + pack.flush()
                frame = bytearray()
                put_long(frame, count)
                put_long(frame, len(data))
                file.write(bytes(frame) + data + sync)

            body, count = bytearray(), 0
            for batch in batches:
                columns = [batch.column(name).cast(stored(batch.column(name).type)).to_pylist()
                           for name, _ in fields]
                for row in zip(*columns):
                    for (_, put), value in zip(fields, row):
                        put(body, value)
                    count += 1
                    if len(body) >= BLOCK_BYTES:
                        flush(count, body)
                        body, count = bytearray(), 0
            if count:
                flush(count, body)

    def commit(self, messages: list[Written | None]) -> None:
        system, _ = located(self.path)
        for old in self.replaced:
            system.delete_file(old)
        for message in filter(None, messages):
            folder, name = os.path.split(message.path)
            system.move(message.path, f"{folder}/{name.lstrip('.')}")

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = located(self.path)
        for message in filter(None, messages):
            system.delete_file(message.path)


class AvroSource(DataSource):
    """Options: path, codec (deflate or null), splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "avro_files"

    def schema(self) -> T.StructType:
        files = files_in(self.options["path"])
        if not files:
            raise ValueError(f"no Avro files in {self.options['path']}: give a schema")
        with located(self.options["path"])[0].open_input_file(files[0].path) as file:
            kind, _ = spark_type(read_header(file).schema, Names())
        if not isinstance(kind, T.StructType):
            raise ValueError("only files of records are tables")
        return kind

    def reader(self, schema: T.StructType) -> AvroReader:
        return AvroReader(self.options["path"], schema, int(self.options.get("splitBytes", SPLIT_BYTES)))

    def writer(self, schema: T.StructType, overwrite: bool) -> AvroWriter:
        return AvroWriter(self.options["path"], schema, self.options.get("codec", "deflate"), overwrite)


def write_avro(df: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """One file per task; `mode` is append or overwrite."""
    df.sparkSession.dataSource.register(AvroSource)
    df.write.format(AvroSource.name()).options(**options).mode(mode).save(path)


def read_avro(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              **options: str) -> DataFrame:
    """Rows of all files under the path. Without a schema the first file's is taken; with one, its
    columns are found by name in every file, and are null where a file has no such column."""
    spark.dataSource.register(AvroSource)
    reader = spark.read.format(AvroSource.name()).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)
