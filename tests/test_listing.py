"""Listing without reading: at most the first MiB of a file, filters before any file is opened, folders dealt to tasks."""

import hashlib
import os
from datetime import datetime, timezone

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from crewgrid.sources import files, listing
from tests.conftest import rows

MIB = 1 << 20


@pytest.fixture
def tree(tmp_path):
    for i in range(12):
        (tmp_path / f"d{i}" / "deep").mkdir(parents=True)
        (tmp_path / f"d{i}" / f"a{i}.xlsx").write_bytes(b"x" * i)
        (tmp_path / f"d{i}" / "deep" / f"b{i}.csv").write_bytes(b"y" * i)
    (tmp_path / "~$lock.xlsx").write_bytes(b"")
    (tmp_path / "_MOVED_a.xlsx").write_bytes(b"")
    (tmp_path / "top.xlsx").write_bytes(b"z" * (MIB + 7))
    return tmp_path


def test_fingerprints(spark, tree):
    got = {r.path: r for r in files.list_files(spark, str(tree)).collect()}
    assert len(got) == 25 and all(p.startswith(f"file:{tree}/") for p in got)
    top = got[f"file:{tree}/top.xlsx"]
    assert (top.size, top.sha1) == (MIB + 7, hashlib.sha1(b"z" * MIB).hexdigest())
    assert files.list_files(spark, str(tree), "*.xls*").count() == 13 and files.list_files(spark, str(tree), "*.xls*", recursive=False).count() == 1
    assert files.list_files(spark, str(tree / "top.xlsx")).count() == 1 and files.list_files(spark, str(tree / "none")).count() == 0




def test_no_more_than_the_first_mib_is_read(tmp_path, monkeypatch):
    """A sparse file of 3 GB: what is asked of the store is counted."""
    with open(tmp_path / "huge.xlsx", "wb") as f:
        f.write(b"h" * MIB)
        f.truncate(3 << 30)
    asked, plain = [], pafs.LocalFileSystem()

    class Store:
        def __getattr__(self, name):
            return getattr(plain, name)

        def open_input_file(self, place):
            source = plain.open_input_file(place)

            class Counting:
                def __enter__(self):
                    return self

                def __exit__(self, *_):
                    source.close()

                def read(self, n):
                    asked.append((place, n))
                    return source.read(n)

            return Counting()

    monkeypatch.setattr(listing, "filesystem", lambda path: (Store(), path))
    reader = listing.PushedFingerprints(str(tmp_path), True, None)
    got = [r for p in reader.partitions() for r in reader.read(p)]
    assert [(r[1], r[3]) for r in got] == [(3 << 30, hashlib.sha1(b"h" * MIB).hexdigest())] and asked == [(str(tmp_path / "huge.xlsx"), MIB)]
    asked.clear()
    reader = listing.PushedFingerprints(str(tmp_path), True, None)
    assert list(reader.pushFilters([listing.ds.LessThan(("size",), 100), listing.ds.EqualTo(("sha1",), "x")])) == [listing.ds.EqualTo(("sha1",), "x")]
    assert [r for p in reader.partitions() for r in reader.read(p)] == [] and not asked


def test_folders_are_dealt_to_tasks(tree, monkeypatch):
    monkeypatch.setattr(listing, "FOLDERS", 10)
    reader = listing.FingerprintReader(str(tree), True, None)
    parts = reader.partitions()
    assert sum(len(p.folders) == 1 for p in parts) == 12 and len([r for p in parts for r in reader.read(p)]) == 25


def test_pushed_filters_give_the_same(spark, tree):
    os.utime(tree / "d3" / "a3.xlsx", (1_600_000_000, 1_600_000_000))
    asked = [
        "path like '%a1%'", "path like 'file:/%'", "path like '%.csv'", "size > 3", "size >= 3 and size < 7", "size <= 0", "size = 5", "size in (2, 4)", "mtime < timestamp'2021-01-01'", "mtime >= timestamp'2021-01-01' and sha1 is not null",
    ]
    plain = [rows(files.list_files(spark, str(tree)).where(a).select("path")) for a in asked]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        assert [rows(files.list_files(spark, str(tree)).where(a).select("path")) for a in asked] == plain
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert len(plain[8]) == 1 and [len(x) for x in plain[:3]] == [3, 25, 12]


def test_what_changed_since_the_manifest(spark, tree):
    before = spark.createDataFrame(files.list_files(spark, str(tree)).collect(), files.MANIFEST)
    (tree / "d1" / "a1.xlsx").write_bytes(b"new")
    (tree / "d2" / "a2.xlsx").unlink()
    (tree / "d2" / "more.xlsx").write_bytes(b"")
    status = files.diff(files.list_files(spark, str(tree)), before).where("status <> 'unchanged'")
    assert {(r.path.rsplit("/", 1)[1], r.status) for r in status.collect()} == {("a1.xlsx", "changed"), ("a2.xlsx", "deleted"), ("more.xlsx", "new")}
    assert before.where(F.col("mtime") > datetime(2020, 1, 1, tzinfo=timezone.utc)).count() == 25
