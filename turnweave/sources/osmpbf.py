"""OpenStreetMap PBF as a Spark data source: ``spark.read.format("osmpbf").option("entity", ...).load(path)``.

``entity`` is ``nodes`` (node_id, lat, lon, file, seq), ``ways`` (way_id, refs, tags) or ``relations`` (rel_id, tags,
members). Planning reads only the frame headers and skips over the bodies, so other blobs cost no more than a
seek; each data blob is a partition of its own, bundled up to ``split_bytes``. A reader decodes the wanted
entity alone, strings only where tags are wanted. ``file`` and ``seq`` are the number of a node's file and its place
there, by which a repeated id is settled. ``tag`` and ``values`` (comma-separated) keep the ways that have the tag with
one of the values; the others' references are not decoded.

Paths are local or any URI that pyarrow's file systems open; a folder stands for its ``.pbf`` files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMAS = {
    "nodes": "node_id long, lat double, lon double, file int, seq long",
    "ways": "way_id long, refs array<long>, tags map<string,string>",
    "relations": "rel_id long, tags map<string,string>, members array<struct<id:long,role:string,type:string>>",
}
MEMBER_TYPES = ("NODE", "WAY", "RELATION")
_NODE_TYPE = pa.schema([("node_id", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("file", pa.int32()), ("seq", pa.int64())])
_TAGS = pa.map_(pa.string(), pa.string())
_WAY_TYPE = pa.schema([("way_id", pa.int64()), ("refs", pa.list_(pa.int64())), ("tags", _TAGS)])
_RELATION_TYPE = pa.schema([("rel_id", pa.int64()), ("tags", _TAGS), ("members", pa.list_(pa.struct([("id", pa.int64()), ("role", pa.string()), ("type", pa.string())])))])
#: Places in a file are numbered blob offset first, so that they grow along the file.
_SEQ_SHIFT = 20


def scale_coordinate(offset: Column, granularity: Column, raw: Column) -> Column:
    """Degrees: one whole-number sum, then one division."""
    return (offset + granularity * raw).cast("double") / F.lit(1e9)


def undelta(values: Column) -> Column:
    """Running sums of an array of differences."""
    grown = F.aggregate(values, F.array().cast("array<bigint>"), lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("bigint")))))
    return grown


def fields(data: bytes | memoryview) -> Iterator[tuple[int, int | memoryview]]:
    """(number, value) of a message: whole numbers, or the bytes of length-delimited and fixed fields."""
    view, at = memoryview(data), 0
    while at < len(view):
        tag, at = _varint(view, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(view, at)
        else:
            if kind == 2:
                size, at = _varint(view, at)
            elif kind in (1, 5):
                size = 8 if kind == 1 else 4
            else:
                raise ValueError(f"unknown wire type {kind}")
            value = view[at : at + size]
            if len(value) != size:
                raise ValueError("a message ends before its time")
            at += size
        yield tag >> 3, value


def _varint(view: memoryview, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        if at >= len(view):
            raise ValueError("a message ends before its time")
        b = view[at]
        at += 1
        out |= (b & 127) << shift
        if b < 128:
            return out, at
        shift += 7


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _zigzag(x: int) -> int:
    return x >> 1 ^ -(x & 1)


def packed(data: memoryview) -> np.ndarray:
    """Varints end to end, as unsigned 64-bit numbers."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    last = raw < 128
    if not last[-1]:
        raise ValueError("a message ends before its time")
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.bitwise_or.reduceat((raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64), starts)


def _deltas(data: memoryview) -> np.ndarray:
    x = packed(data)
    return np.cumsum((x >> np.uint64(1)).astype(np.int64) ^ -(x & np.uint64(1)).astype(np.int64))


def inflate(blob: bytes) -> bytes:
    """The content of a Blob message, stored or zlib-compressed."""
    for number, value in fields(blob):
        if number == 1:
            return bytes(value)
        if number == 3:
            return zlib.decompress(value)
        if number in (4, 5, 6, 7):
            break
    raise ValueError("a blob is neither stored nor zlib-compressed")


class Block:
    """A PrimitiveBlock."""

    def __init__(self, data: bytes):
        self.raw_strings: memoryview | None = None
        self.groups: list[memoryview] = []
        self.granularity, self.lat_offset, self.lon_offset = 100, 0, 0
        for number, value in fields(data):
            if number == 1:
                self.raw_strings = value
            elif number == 2:
                self.groups.append(value)
            elif number == 17:
                self.granularity = _signed(value)
            elif number == 19:
                self.lat_offset = _signed(value)
            elif number == 20:
                self.lon_offset = _signed(value)

    @cached_property
    def strings(self) -> list[str]:
        """Decoded when first asked for: nodes need none."""
        return [bytes(s).decode("utf-8", "replace") for k, s in fields(self.raw_strings or b"") if k == 1]

    def _tags(self, keys: memoryview, values: memoryview) -> list[tuple[str, str]]:
        out: dict[str, str] = {}
        for k, v in zip(packed(keys).tolist(), packed(values).tolist(), strict=True):
            out.setdefault(self.strings[k], self.strings[v])  # the first of equal keys counts
        return list(out.items())

    def nodes(self, file: int, seq: int) -> Iterator[pa.RecordBatch]:
        plain: list[tuple[int, int, int]] = []
        parts = []
        for group in self.groups:
            for number, value in fields(group):
                if number == 1:
                    f = dict(fields(value))
                    plain.append((_zigzag(f.get(1, 0)), _zigzag(f.get(8, 0)), _zigzag(f.get(9, 0))))
                elif number == 2:
                    f = dict(fields(value))
                    ids, lats, lons = (_deltas(f.get(k, memoryview(b""))) for k in (1, 8, 9))
                    if not len(ids) == len(lats) == len(lons):
                        raise ValueError("dense nodes have ids and coordinates in different numbers")
                    parts.append((ids, lats, lons))
        if plain:
            parts.append(tuple(np.array(x, np.int64) for x in zip(*plain, strict=True)))
        for ids, lats, lons in parts:
            lat, lon = ((o + self.granularity * x).astype(np.float64) / 1e9 for o, x in ((self.lat_offset, lats), (self.lon_offset, lons)))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(lat), pa.array(lon), pa.array(np.full(len(ids), file, np.int32)), pa.array(np.arange(seq, seq + len(ids)))], schema=_NODE_TYPE)
            seq += len(ids)

    def ways(self, tag: str | None = None, values: frozenset[str] = frozenset()) -> Iterator[pa.RecordBatch]:
        """With ``tag`` only the ways that have it with one of the values; the others' references stay undecoded."""
        ids, refs, tags = [], [], []
        if tag is not None and (tag not in self.strings or values.isdisjoint(self.strings)):
            return
        empty = memoryview(b"")
        for group in self.groups:
            for number, value in fields(group):
                if number == 3:
                    f = dict(fields(value))
                    own = self._tags(f.get(2, empty), f.get(3, empty))
                    if tag is not None and dict(own).get(tag) not in values:
                        continue
                    ids.append(_signed(f.get(1, 0)))
                    refs.append(_deltas(f.get(8, empty)))
                    tags.append(own)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(refs, pa.list_(pa.int64())), pa.array(tags, _TAGS)], schema=_WAY_TYPE)

    def relations(self) -> Iterator[pa.RecordBatch]:
        ids, tags, members = [], [], []
        empty = memoryview(b"")
        for group in self.groups:
            for number, value in fields(group):
                if number == 4:
                    f = dict(fields(value))
                    ids.append(_signed(f.get(1, 0)))
                    tags.append(self._tags(f.get(2, empty), f.get(3, empty)))
                    roles, kinds = packed(f.get(8, empty)).tolist(), packed(f.get(10, empty)).tolist()
                    members.append([{"id": i, "role": self.strings[r], "type": MEMBER_TYPES[k]} for i, r, k in zip(_deltas(f.get(9, empty)).tolist(), roles, kinds, strict=True)])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(tags, _TAGS), pa.array(members, _RELATION_TYPE.field("members").type)], schema=_RELATION_TYPE)


def _files(path: str):
    """(file system, paths) of a file or of the ``.pbf`` files in a folder."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    if system.get_file_info(name).type == fs.FileType.Directory:
        found = system.get_file_info(fs.FileSelector(name, recursive=True))
        return system, sorted(x.path for x in found if x.type == fs.FileType.File and x.path.endswith(".pbf"))
    return system, [name]


def frames(file, size: int) -> Iterator[tuple[str, int, int]]:
    """(blob type, offset, size) of each blob; the bodies are skipped."""
    at = 0
    while at < size:
        file.seek(at)
        n = int.from_bytes(file.read(4), "big")
        head = file.read(n)
        if len(head) != n:
            raise ValueError("the file ends inside a header")
        f = dict(fields(head))
        body = f.get(3, 0)
        if at + 4 + n + body > size:
            raise ValueError("the file ends inside a blob")
        yield bytes(f.get(1, b"")).decode(), at + 4 + n, body
        at += 4 + n + body


@dataclass
class BlobPartition(InputPartition):
    path: str
    number: int
    blobs: list[tuple[int, int]]


class OsmPbfReader(DataSourceReader):
    def __init__(self, path: str, entity: str, split_bytes: int, tag: str | None = None, values: frozenset[str] = frozenset()):
        self.path, self.entity, self.split_bytes, self.tag, self.values = path, entity, split_bytes, tag, values

    def partitions(self) -> list[InputPartition]:
        system, names = _files(self.path)
        out: list[InputPartition] = []
        for number, name in enumerate(names):
            with system.open_input_file(name) as f:
                blobs: list[tuple[int, int]] = []
                for kind, offset, size in frames(f, f.size()):
                    if kind != "OSMData":
                        continue
                    if blobs and sum(n for _, n in blobs) + size > self.split_bytes:
                        out.append(BlobPartition(name, number, blobs))
                        blobs = []
                    blobs.append((offset, size))
                if blobs:
                    out.append(BlobPartition(name, number, blobs))
        return out or [BlobPartition("", 0, [])]

    def read(self, partition: BlobPartition) -> Iterator[pa.RecordBatch]:
        if not partition.blobs:
            return
        system, _ = _files(self.path)
        with system.open_input_file(partition.path) as f:
            for offset, size in partition.blobs:
                f.seek(offset)
                block = Block(inflate(f.read(size)))
                if self.entity == "nodes":
                    yield from block.nodes(partition.number, offset << _SEQ_SHIFT)
                elif self.entity == "ways":
                    yield from block.ways(self.tag, self.values)
                else:
                    yield from block.relations()


class OsmPbfSource(DataSource):
    """Options: ``path``, ``entity`` (nodes, ways, relations), ``split_bytes`` (compressed, 16 MiB)."""

    @classmethod
    def name(cls) -> str:
        return "osmpbf"

    def _entity(self) -> str:
        entity = self.options.get("entity", "nodes")
        if entity not in SCHEMAS:
            raise ValueError(f"entity is one of {', '.join(SCHEMAS)}")
        return entity

    def schema(self) -> str:
        return SCHEMAS[self._entity()]

    def reader(self, schema) -> OsmPbfReader:
        return OsmPbfReader(self.options["path"], self._entity(), int(self.options.get("split_bytes", 1 << 24)), self.options.get("tag"), frozenset(filter(None, self.options.get("values", "").split(","))))


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(OsmPbfSource)


def read(spark: SparkSession, path: str, entity: str, **options: str):
    register(spark)
    return spark.read.format("osmpbf").options(entity=entity, **options).load(path)
