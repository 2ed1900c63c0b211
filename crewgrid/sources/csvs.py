"""CSV files of any encoding in, and with the UTF-8 mark out.

Reading: each file is probed as a stream, a MiB at a time: a mark tells UTF-8 or UTF-16, else it is UTF-8 if all of it is
valid, else code page 949 if all of it is that. A file that is neither, or that is no CSV, is an empty
table. Columns are found by their names in the header. A file is one task's work.

Writing: a data source whose tasks write whole files, each with the mark and the header, into a
staging folder; the commit moves them to their place, and only then removes what was there before. A write that
breaks off leaves the old files.
"""

from __future__ import annotations

import codecs
import csv
import io
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..session import ship
from .listing import filesystem

_PIECE = 1 << 20
csv.field_size_limit(min(sys.maxsize, 1 << 31))


def encoding_of(source) -> str | None:
    """The encoding of a file from its first byte on, None if it has none of these."""
    head = source.read(4)
    if head.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)):
        tried = ["utf-16"]
    else:
        tried = ["utf-8-sig"] if head.startswith(codecs.BOM_UTF8) else ["utf-8", "cp949"]
    decoders = {name: codecs.getincrementaldecoder(name)() for name in tried}
    piece = head
    while True:
        more = source.read(_PIECE)
        for name in list(decoders):
            try:
                decoders[name].decode(piece, final=not more)
            except UnicodeDecodeError:
                del decoders[name]
        if not decoders:
            return None
        if not more:
            return next(iter(decoders))
        piece = more


def _rows(path: str) -> Iterator[list[str]]:
    fs, at = filesystem(path)
    with fs.open_input_file(at) as source:
        encoding = encoding_of(source)
    if encoding is None:
        raise ValueError("no known encoding")
    with fs.open_input_file(at) as source, io.TextIOWrapper(io.BufferedReader(source, _PIECE) if isinstance(source, io.RawIOBase) else source, encoding, newline="") as text:
        yield from csv.reader(text, strict=True)


def whole_rows(path: str) -> Iterator[list[str]]:
    """A file's rows, the header first; none of a broken one, which is read to its end before."""
    try:
        for _ in _rows(path):
            pass
    except (ValueError, csv.Error, OSError):
        return
    yield from _rows(path)


def header(path: str) -> list[str]:
    return [c.strip() for c in next(iter(whole_rows(path)), [])]


def _files(path: str) -> list[str]:
    fs, at = filesystem(path)
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.Directory:
        return sorted(f.path for f in fs.get_file_info(pafs.FileSelector(at)) if f.base_name.endswith(".csv") and not f.base_name.startswith(("_", ".")))
    return [path] if info.type == pafs.FileType.File else []


def read_named(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The schema's columns by their names in each file's header; those that a file lacks are null, values that are empty or don't fit too. Without a file no rows."""
    wanted = spark.createDataFrame([], schema).schema
    paths, names = _files(path), wanted.names
    if not paths:
        return spark.createDataFrame([], wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column("path").to_pylist():
                rows, held = whole_rows(p), []
                head = [c.strip() for c in next(rows, [])]
                at = [head.index(n) if n in head else None for n in names]

                def batch() -> pa.RecordBatch:
                    return pa.RecordBatch.from_arrays([pa.array([r[i] or None if i is not None and i < len(r) else None for r in held], pa.string()) for i in at], names)  # noqa: B023

                for r in rows:
                    if r:
                        held.append(r)
                    if len(held) == 10_000:
                        yield batch()
                        held.clear()
                if held:
                    yield batch()

    ship(spark)
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths))
    texts = listed.mapInArrow(run, ", ".join(f"`{n}` string" for n in names))
    return texts.select([F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted])


@dataclass
class Staged(WriterCommitMessage):
    names: list[str] = field(default_factory=list)


class MarkedWriter(DataSourceWriter):
    def __init__(self, path: str, columns: list[str], overwrite: bool):
        self.path, self.columns, self.overwrite, self.id = path, columns, overwrite, uuid.uuid4().hex

    def _staging(self) -> tuple[pafs.FileSystem, str, str]:
        fs, at = filesystem(self.path)
        return fs, at, f"{at}/_staged-{self.id}"

    def write(self, rows: Iterator) -> Staged:
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, _, staging = self._staging()
        fs.create_dir(staging, recursive=True)
        # Another attempt of the task writes a file of its own; the one that is committed is named in its message.
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.csv"
        with fs.open_output_stream(f"{staging}/{name}") as out:
            text = io.StringIO(newline="")
            to = csv.writer(text, lineterminator="\n")
            to.writerow(self.columns)
            out.write(codecs.BOM_UTF8)
            for i, row in enumerate(rows, 1):
                to.writerow(["" if v is None else v for v in row])
                if i % 10_000 == 0:
                    out.write(text.getvalue().encode("utf-8", "surrogatepass"))
                    text.seek(0)
                    text.truncate()
            out.write(text.getvalue().encode("utf-8", "surrogatepass"))
        return Staged([name])

    def commit(self, messages: list[Staged | None]) -> None:
        fs, at, staging = self._staging()
        fs.create_dir(staging, recursive=True)
        old = [f.path for f in fs.get_file_info(pafs.FileSelector(at)) if f.base_name.endswith(".csv")] if self.overwrite else []
        for name in sorted(n for m in messages if m for n in m.names):
            fs.move(f"{staging}/{name}", f"{at}/{name[:-4]}-{self.id[:8]}.csv")
        for f in old:
            fs.delete_file(f)
        fs.delete_dir(staging)

    def abort(self, messages: list[Staged | None]) -> None:
        fs, _, staging = self._staging()
        fs.create_dir(staging, recursive=True)
        fs.delete_dir(staging)


class MarkedCsv(DataSource):
    """format("csv_marked"): UTF-8 with the mark, a header, empty fields for nulls; modes append and overwrite; option path."""

    @classmethod
    def name(cls) -> str:
        return "csv_marked"

    def writer(self, schema, overwrite: bool) -> MarkedWriter:
        return MarkedWriter(self.options["path"], schema.names, overwrite)


def write_marked(df: DataFrame, path: str) -> None:
    """df in place of what is there."""
    ship(df.sparkSession)
    df.sparkSession.dataSource.register(MarkedCsv)
    df.write.format("csv_marked").mode("overwrite").option("path", path).save()
