"""A data source that lists files with their fingerprints: path, size, mtime, SHA-1 of the first MiB.

The driver lists folders only until there are enough to deal out; tasks list what is below
them. Files are told by the pushed filters on path, size and time before any is opened,
and of one that is, a task reads the first MiB and no more. A file that can't be opened has a null for its hash.
"""

from __future__ import annotations

import fnmatch
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow.fs as pafs
from pyspark.sql import datasource as ds

from ..constants import FINGERPRINT_BYTES
from ..schema import MANIFEST

#: Folders that the driver makes partitions of, once there are so many; files of one folder in a partition.
FOLDERS, FILES = 64, 1000


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    path = re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:", path) else (pafs.LocalFileSystem(), path)


def opens(path: str) -> bool:
    """Whether tasks can read the store without Spark."""
    try:
        filesystem(path)
    except Exception:  # noqa: BLE001 - unknown schemes, missing client libraries
        return False
    return True


def _prefix(path: str) -> str:
    """What stands before a file's place in the store in its full path, as Spark writes it."""
    scheme = re.match(r"([a-z0-9]+):(//[^/]*)?", path)
    return "file:" if not scheme or scheme[1] == "file" else f"{scheme[0]}/" if scheme[1] in ("s3", "gs") else scheme[0]


#: What each filter asks of a value.
_TESTS: dict[type, Callable] = {
    ds.EqualTo: lambda v, x: v == x, ds.In: lambda v, x: v in x, ds.GreaterThan: lambda v, x: v > x, ds.GreaterThanOrEqual: lambda v, x: v >= x,
    ds.LessThan: lambda v, x: v < x, ds.LessThanOrEqual: lambda v, x: v <= x, ds.StringStartsWith: lambda v, x: v.startswith(x),
    ds.StringEndsWith: lambda v, x: v.endswith(x), ds.StringContains: lambda v, x: x in v,
}


@dataclass
class Some(ds.InputPartition):
    """Folders, with all below them, and single files (place, size, time)."""

    folders: list[str] = field(default_factory=list)
    files: list[tuple] = field(default_factory=list)


class FingerprintReader(ds.DataSourceReader):
    def __init__(self, path: str, recursive: bool, pattern: str | None, first: int = FINGERPRINT_BYTES):
        self.path, self.recursive, self.pattern, self.first = path, recursive, pattern, first
        self.tests: list[tuple[int, type, object]] = []

    def _wanted(self, place: str, size: int, mtime) -> bool:
        name = place.rsplit("/", 1)[-1]
        row = (_prefix(self.path) + place, size, mtime)
        named = not name.startswith(("~$", "_MOVED_")) and (self.pattern is None or fnmatch.fnmatchcase(name, self.pattern))
        return named and all(_TESTS[kind](row[i], x) for i, kind, x in self.tests)

    def partitions(self) -> list[Some]:
        fs, root = filesystem(self.path)
        if fs.get_file_info(root).type == pafs.FileType.File:
            info = fs.get_file_info(root)
            return [Some(files=[(root, info.size, info.mtime)])]
        waiting, files = [root], []
        while waiting and len(waiting) < FOLDERS:
            found = [x for f in waiting for x in fs.get_file_info(pafs.FileSelector(f, allow_not_found=f == root))]
            files += [(x.path, x.size, x.mtime) for x in found if x.type == pafs.FileType.File and self._wanted(x.path, x.size, x.mtime)]
            waiting = [x.path for x in found if x.type == pafs.FileType.Directory] if self.recursive else []
        files.sort()
        return [Some([f]) for f in sorted(waiting)] + [Some(files=files[i : i + FILES]) for i in range(0, len(files), FILES)] or [Some()]

    def read(self, partition: Some) -> Iterator[tuple]:
        fs, prefix = filesystem(self.path)[0], _prefix(self.path)
        below = (x for f in partition.folders for x in fs.get_file_info(pafs.FileSelector(f, recursive=True)))
        every = [*partition.files, *((x.path, x.size, x.mtime) for x in below if x.type == pafs.FileType.File and self._wanted(x.path, x.size, x.mtime))]
        for place, size, mtime in every:
            try:
                with fs.open_input_file(place) as source:
                    sha1 = hashlib.sha1(source.read(self.first)).hexdigest()
            except OSError:
                sha1 = None
            yield prefix + place, size, mtime, sha1


class PushedFingerprints(FingerprintReader):
    """With the query's filters; Spark allows this class only where its setting for it is on."""

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:  # noqa: N802 - the interface's name
        for f in filters:
            column = getattr(f, "attribute", ())
            if type(f) in _TESTS and len(column) == 1 and column[0] in ("path", "size", "mtime"):
                self.tests.append((("path", "size", "mtime").index(column[0]), type(f), f.value))
            else:
                yield f


class Fingerprints(ds.DataSource):
    """format("file_fingerprints"); options path, recursive, pattern (of names), pushed (true where Spark hands filters on)."""

    @classmethod
    def name(cls) -> str:
        return "file_fingerprints"

    def schema(self) -> str:
        return MANIFEST

    def reader(self, schema) -> FingerprintReader:
        o = self.options
        kind = PushedFingerprints if o.get("pushed", "false") == "true" else FingerprintReader
        return kind(o["path"], o.get("recursive", "true") == "true", o.get("pattern"))
