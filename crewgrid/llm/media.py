"""Media columns: payloads stored as images in archives, read back by a data source that plans byte ranges.

A payload (bytes, padded with 0 to a positive multiple of 64) becomes a
lossless 8-bit greyscale PNG, 64 samples a row. Each writing task puts its
images as stored members into one ZIP archive of a shared folder; the
archive's directory holds every member's offset, length and checksum.

Reading: the driver lists archives and cuts each into byte ranges, it
opens none of them. A task reads its archive's directory, takes the members whose
offset lies in its range and streams them in batches bounded in bytes.
Each member is read, checked against its CRC and decoded by itself; one
that fails is read again from its own offset, up to `retries` times, and then
fails the task, so that no member is ever left out.

A writing task's archive has a name of its own and counts only once the
job commits (a list of archives is written last), so tasks that ran twice
or lost their executor leave no member twice.

Nulls and odd input: a null text is an empty one, stored as 64 zero bytes;
a null doc_id comes back as null. Rows are members one by one, so repeated
rows and ids come back as often as they went in. An empty table gives no
archive and no row. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import shared_dir, table

UNIT, LEVEL = 64, 1
RANGE_BYTES, BATCH_BYTES, RETRIES = 32 << 20, 8 << 20, 3
_PNG = b"\x89PNG\r\n\x1a\n"
SCHEMA = "doc_id long, n_bytes long, payload binary, media_bytes long, media_sha256 string"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.binary()), ("media_bytes", pa.int64()), ("media_sha256", pa.string())])


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % UNIT or (0 if data else UNIT))


def encode(payload: bytes) -> bytes:
    """A PNG of 8-bit grey samples; every row has filter 0."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    lines = np.zeros((len(rows), UNIT + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", UNIT, len(rows), 8, 0, 0, 0, 0)
    return _PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def decode(media: bytes) -> bytes:
    if media[:8] != _PNG:
        raise ValueError("no PNG signature")
    at, width, packed = 8, 0, []
    while at < len(media):
        size, kind = struct.unpack_from(">I4s", media, at)
        data = media[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(data, zlib.crc32(kind)):
            raise ValueError("chunk checksum")
        if kind == b"IHDR":
            width = struct.unpack_from(">I", data)[0]
        elif kind == b"IDAT":
            packed.append(data)
        at += size + 12
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(-1, width + 1)
    if lines[:, 0].any():
        raise ValueError("row filter")
    return lines[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """A perceptual hash of 64 bits in hex (means of an 8 x 8 grid of bands against their own mean), then mean and spread of the samples."""
    x = np.frombuffer(payload, np.uint8)
    cut = [len(x) * k // 64 for k in range(64)]
    sums = np.add.reduceat(x, cut, dtype=np.uint64).astype(np.float64)
    means = sums / np.diff([*cut, len(x)])
    bits = np.packbits(means > means.mean()).tobytes().hex()
    return f"{bits}:{x.mean():.4f}:{x.std():.4f}"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class ArchiveWritten(WriterCommitMessage):
    name: str
    size: int
    members: int


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ArchiveWritten:
        fs, root = _filesystem(self.path)
        name, members, size = f"{uuid.uuid4().hex}.zip", 0, 0
        sink = archive = None
        for batch in iterator:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                if archive is None:
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(f"{root}/{name}")
                    archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED)
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                key = "null" if doc_id.as_py() is None else str(doc_id.as_py())
                archive.writestr(zipfile.ZipInfo(f"{members}.{key}.{len(data)}.png"), encode(padded(data)))
                members += 1
        if archive is not None:
            archive.close()
            size = sink.tell()
            sink.close()
        return ArchiveWritten(name, size, members)

    def commit(self, messages: list) -> None:
        fs, root = _filesystem(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/archives.json") as out:
            out.write(json.dumps([[m.name, m.size] for m in messages if m and m.members]).encode())

    def abort(self, messages: list) -> None:
        fs, root = _filesystem(self.path)
        for m in messages:
            if m and m.members:
                fs.delete_file(f"{root}/{m.name}")


@dataclass
class ByteRange(InputPartition):
    archive: str
    start: int
    end: int


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int, batch_bytes: int, retries: int):
        self.path, self.range_bytes, self.batch_bytes, self.retries = path, range_bytes, batch_bytes, retries

    def partitions(self) -> list[ByteRange]:
        fs, root = _filesystem(self.path)
        with fs.open_input_stream(f"{root}/archives.json") as listing:
            archives = json.loads(listing.read())
        step = self.range_bytes
        return [ByteRange(f"{root}/{n}", at, at + step) for n, size in archives for at in range(0, size, step)] or [ByteRange("", 0, 0)]

    def _member(self, source, offset: int, packed: int, crc: int) -> bytes:
        """The bytes of one stored member, from its own offset alone."""
        source.seek(offset)
        head = source.read(30)
        name, extra = struct.unpack_from("<HH", head, 26)
        source.seek(offset + 30 + name + extra)
        data = source.read(packed)
        if head[:4] != b"PK\x03\x04" or len(data) != packed or zlib.crc32(data) != crc:
            raise OSError(f"member at {offset} is broken")
        return data

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        fs, _ = _filesystem(self.path)
        source = fs.open_input_file(partition.archive)
        try:
            with zipfile.ZipFile(source) as archive:
                members = [(i.header_offset, i.compress_size, i.CRC, i.filename) for i in archive.infolist() if partition.start <= i.header_offset < partition.end]
            rows: list[tuple] = []
            held = 0
            for offset, packed, crc, name in members:
                for left in range(self.retries, -1, -1):
                    try:
                        media = self._member(source, offset, packed, crc)
                        payload = decode(media)
                        break
                    except (OSError, ValueError, struct.error):
                        if not left:
                            raise
                        # The handle itself may be dead: a new one, from this member's offset.
                        source.close()
                        source = fs.open_input_file(partition.archive)
                _, key, n_bytes, _ = name.split(".")
                rows.append((None if key == "null" else int(key), int(n_bytes), payload, len(media), hashlib.sha256(media).hexdigest()))
                held += len(payload)
                if held >= self.batch_bytes:
                    yield self._batch(rows)
                    rows, held = [], 0
            if rows:
                yield self._batch(rows)
        finally:
            source.close()

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


class MediaArchive(DataSource):
    """format("media_archive"); options path, range_bytes, batch_bytes, retries."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        o = self.options
        return ArchiveReader(o["path"], int(o.get("range_bytes", RANGE_BYTES)), int(o.get("batch_bytes", BATCH_BYTES)), int(o.get("retries", RETRIES)))

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"])


def store(docs: DataFrame, path: str) -> None:
    """docs: doc_id, text; written as archives under path."""
    docs.sparkSession.dataSource.register(MediaArchive)
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).write.format("media_archive").mode("append").option("path", path).save()


def load(spark: SparkSession, path: str, **options) -> DataFrame:
    """doc_id, n_bytes, payload, media_bytes, media_sha256 of every member."""
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").options(path=path, **options).load()


def media_digests(media: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            features = [feature(p.as_buffer()) for p in b.column("payload")]
            yield pa.RecordBatch.from_arrays([*(c for c, n in zip(b.columns, b.schema.names, strict=True) if n != "payload"), pa.array(features, pa.string())], [*(n for n in b.schema.names if n != "payload"), "feature"])

    narrow = media.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"), "media_bytes", "media_sha256", "payload",
    )
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return narrow.mapInArrow(run, schema)


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/media-{uuid.uuid4().hex}"
    store(table(spark, sf_dir, "documents"), path)
    return media_digests(load(spark, path))
