"""A data source for workbooks: every filled cell is a row of the cells relation.

New ones (.xlsx, .xlsm) are zipped XML and are read with the standard library, old ones
(.xls) by `sources.xls`, so no spreadsheet package is needed. A task gets either several small workbooks or
one sheet of a large one: the driver lists files, and of those larger than `splitBytes`
reads the archive's directory and the list of sheets. A sheet is read as a stream, which ends with the last wanted
row; of shared strings, tasks hold one block of bytes and offsets. One that can't be read
becomes one row with sheet null and the error as its value.

Filters on file, sheet and row_idx reach the reader where Spark hands them on (spark.sql.python.filterPushdown.enabled);
`firstRow` and `lastRow` are options for the same.

Encrypted workbooks can't be opened, with a password or without; they come as such error rows, which say so.
"""

from __future__ import annotations

import json
import re
import zipfile
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree as ET

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..schema import CELLS
from ..session import ship
from .listing import filesystem
from .xls import MAGIC, UnsupportedFormat, XlsBook

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Bytes from which a workbook is read sheet by sheet; bytes and files of small workbooks in a partition.
SPLIT_BYTES, TOGETHER_BYTES, TOGETHER_FILES = 8 << 20, 32 << 20, 64


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(element) -> str:
    """All runs of text but phonetic hints."""
    return "".join(t.text or "" for child in element for t in ([child] if child.tag == _MAIN + "t" else child.findall(_MAIN + "t") if child.tag == _MAIN + "r" else []))


def _elements(part, tag: str, within: str) -> Iterator[ET.Element]:
    """The elements of a tag within another, none of which is held."""
    outer = None
    for event, e in ET.iterparse(part, ("start", "end")):
        if event == "start" and e.tag == _MAIN + within:
            outer = e
        elif event == "end" and e.tag == _MAIN + tag:
            yield e
            if outer is not None:
                outer.clear()


class _Strings:
    """A workbook's shared strings by number: their bytes in one block, and where each begins."""

    def __init__(self, z: zipfile.ZipFile):
        self.data, self.begins = bytearray(), array("Q", [0])
        if "xl/sharedStrings.xml" in z.namelist():
            with z.open("xl/sharedStrings.xml") as part:
                for si in _elements(part, "si", "sst"):
                    self.data += _text(si).encode("utf-8", "surrogatepass")
                    self.begins.append(len(self.data))

    def __getitem__(self, i: int) -> str:
        return self.data[self.begins[i] : self.begins[i + 1]].decode("utf-8", "surrogatepass")


class XlsxBook:
    """sheets: their names; cells(i, first, last): row, column and value of a sheet's filled cells."""

    def __init__(self, source):
        self.zip, self.strings = zipfile.ZipFile(source), None
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
        sheets = ET.fromstring(self.zip.read("xl/workbook.xml")).find(_MAIN + "sheets")
        self.sheets = [sheet.get("name") for sheet in sheets]
        self.paths = [t.lstrip("/") if t.startswith("/") else f"xl/{t}" for t in (targets[sheet.get(_REL + "id")] for sheet in sheets)]

    def cells(self, i: int, first: int = 0, last: int | None = None) -> Iterator[tuple[int, int, str]]:
        row_idx = -1
        with self.zip.open(self.paths[i]) as part:
            for row in _elements(part, "row", "sheetData"):
                row_idx = int(row.get("r", row_idx + 2)) - 1
                if last is not None and row_idx > last:
                    return
                if row_idx < first:
                    continue
                col_idx = -1
                for c in row.findall(_MAIN + "c"):
                    col_idx = _column(c.get("r")) if c.get("r") else col_idx + 1
                    kind, v = c.get("t"), c.find(_MAIN + "v")
                    if kind == "inlineStr":
                        inline = c.find(_MAIN + "is")
                        value = _text(inline) if inline is not None else None
                    else:
                        value = v.text if v is not None else None
                        if kind == "s" and value is not None:
                            self.strings = self.strings or _Strings(self.zip)
                            value = self.strings[int(value)]
                    if value not in (None, ""):
                        yield row_idx, col_idx, value


def open_book(source) -> XlsxBook | XlsBook:
    """By its first bytes, whatever the file is called."""
    magic = source.read(len(MAGIC))
    source.seek(0)
    if magic[:2] != b"PK" and magic != MAGIC:
        raise UnsupportedFormat("neither a zipped nor a compound workbook")
    return XlsBook(source) if magic == MAGIC else XlsxBook(source)


def workbook_cells(source, sheet: int | None = None, first: int = 0, last: int | None = None, names: set[str] | None = None) -> Iterator[tuple[str, int, int, int, str]]:
    """sheet, sheet_idx, row_idx, col_idx, value of the filled cells of a workbook, or of one sheet of it, from the first to the last row wanted."""
    book = open_book(source)
    for i, name in enumerate(book.sheets):
        if sheet in (None, i) and (names is None or name in names):
            for row, col, value in book.cells(i, first, last):
                yield name, i, row, col, value


def failure(error: Exception) -> str:
    """What is said of a workbook that can't be read, whatever is wrong with it."""
    return f"{type(error).__name__}: {error}"


@dataclass
class Books(InputPartition):
    """Small workbooks, or one sheet of a large one."""

    paths: list[str] = field(default_factory=list)
    sheet: int | None = None


@dataclass
class Wanted:
    """What is pushed into the scan: rows from, to, and sheets and files by name (None: all)."""

    first: int = 0
    last: int | None = None
    sheets: set[str] | None = None
    files: set[str] | None = None

    def take(self, f: Filter) -> bool:
        """Narrow to the filter's rows; False if it says more than can be told here."""
        column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
        values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
        if column == "row_idx" and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)) and f.value is not None:
            last = f.value - isinstance(f, LessThan)
            self.last = last if self.last is None else min(self.last, last)
            if isinstance(f, EqualTo):
                self.first = max(self.first, f.value)
        elif column == "row_idx" and isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.value is not None:
            self.first = max(self.first, f.value + isinstance(f, GreaterThan))
        elif column in ("sheet", "file") and values is not None:
            have = getattr(self, column + "s")
            setattr(self, column + "s", values if have is None else have & values)
        else:
            return False
        return True


class CellsReader(DataSourceReader):
    """Workbooks of a folder, or those given one by one, whose paths the rows then carry as they are."""

    def __init__(self, path: str, recursive: bool, paths: list[str] | None = None, split: int = SPLIT_BYTES, wanted: Wanted | None = None):
        self.path, self.recursive, self.paths, self.split, self.wanted = path, recursive, paths, split, wanted or Wanted()

    def _listed(self) -> list[tuple[str, int]]:
        if self.paths is not None:
            sizes = []
            for p in self.paths:
                fs, at = filesystem(p)
                sizes.append((p, fs.get_file_info(at).size or 0))
            return sizes
        fs, root = filesystem(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            return [(root, info.size)]
        found = fs.get_file_info(pafs.FileSelector(root, recursive=self.recursive, allow_not_found=True))
        good = (f for f in found if f.type == pafs.FileType.File and re.search(r"\.xls[xm]?$", f.path.lower()) and not f.base_name.startswith(("~$", "_MOVED_")))
        return sorted((f.path, f.size) for f in good)

    def _open(self, path: str):
        fs, at = (filesystem(self.path)[0], path) if self.paths is None else filesystem(path)
        return fs.open_input_file(at)

    def partitions(self) -> list[Books]:
        out, held, files = [], 0, [x for x in self._listed() if self.wanted.files is None or x[0] in self.wanted.files]
        together = Books()
        for path, size in files:
            if size >= self.split:
                try:
                    with self._open(path) as source:
                        names = open_book(source).sheets
                    out += [Books([path], i) for i, name in enumerate(names) if self.wanted.sheets is None or name in self.wanted.sheets]
                    continue
                except Exception:  # noqa: BLE001 - the task that reads it says what is wrong
                    out.append(Books([path]))
                    continue
            if together.paths and (held + size > TOGETHER_BYTES or len(together.paths) >= TOGETHER_FILES):
                out.append(together)
                together, held = Books(), 0
            together.paths.append(path)
            held += size
        return [*out, together] if together.paths or not out else out

    def read(self, partition: Books) -> Iterator[tuple]:
        w = self.wanted
        for path in partition.paths:
            try:
                with self._open(path) as source:
                    for sheet, sheet_idx, row_idx, col_idx, value in workbook_cells(source, partition.sheet, w.first, w.last, w.sheets):
                        yield path, sheet, sheet_idx, row_idx, col_idx, value
            except Exception as error:  # noqa: BLE001 - one bad workbook must not stop the others
                yield path, None, None, None, None, failure(error)


class PushedReader(CellsReader):
    """With the query's filters; Spark allows this class only where its setting for it is on."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802 - the interface's name
        for f in filters:
            self.wanted.take(f)
            yield f  # Spark applies them too, to error rows among others


class XlsxCells(DataSource):
    """format("xlsx_cells"); options path and recursive, or paths (a JSON list); splitBytes; firstRow and lastRow; pushed (true where Spark hands filters on)."""

    @classmethod
    def name(cls) -> str:
        return "xlsx_cells"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> CellsReader:
        o = self.options
        paths = json.loads(o["paths"]) if "paths" in o else None
        wanted = Wanted(int(o.get("firstRow", 0)), int(o["lastRow"]) if "lastRow" in o else None)
        kind = PushedReader if o.get("pushed", "false") == "true" else CellsReader
        return kind(o.get("path", ""), o.get("recursive", "true").lower() == "true", paths, int(o.get("splitBytes", SPLIT_BYTES)), wanted)


def _reader(spark: SparkSession, **options):
    ship(spark)
    spark.dataSource.register(XlsxCells)
    return spark.read.format("xlsx_cells").options(pushed=spark.conf.get("spark.sql.python.filterPushdown.enabled"), **options)


def read_cells(spark: SparkSession, path: str, recursive: bool = True, **options) -> DataFrame:
    return _reader(spark, path=path, recursive=str(recursive), **options).load()


def read_workbooks(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """The cells of some workbooks; `file` is the path as given."""
    return _reader(spark, paths=json.dumps(paths), **options).load()


def readable(cells: DataFrame) -> DataFrame:
    return cells.where("sheet is not null")


def read_errors(cells: DataFrame) -> DataFrame:
    """One row a file; of a workbook read sheet by sheet, the least of what its tasks say."""
    return cells.where("sheet is null").groupBy("file").agg(F.min("value").alias("error"))
