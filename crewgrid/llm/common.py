"""Shared plumbing: reading tables, tables written between jobs, the byte maps of the word definitions."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: ASCII bytes A-Z to a-z; every other byte stays.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: The words of licence scans: [0-9a-z] and bytes from 0x80 on; A-Z become a-z, all else a space.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_UPPER_LETTERS, _LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shipped(query: Callable) -> Callable:
    """A query or stage whose workers have the package."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        ship(spark)
        return query(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset and driver and executors are one machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="crewgrid-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: a cut of lineage that survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables of `written` that nothing reads any more: what was made of them is written itself."""
    for df in tables:
        if path := getattr(df, "written_at", None):
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)


def in_batches(rows: Iterable[tuple], schema: pa.Schema, rows_at_most: int = 10_000, bytes_at_most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches that stay small whatever the length of their texts and binaries."""
    columns: list[list] = [[] for _ in schema]
    held = 0
    for row in rows:
        for column, value in zip(columns, row, strict=True):
            column.append(value)
            held += len(value) if isinstance(value, (bytes, str)) else value.nbytes if isinstance(value, np.ndarray) else 0
        if held > bytes_at_most or len(columns[0]) >= rows_at_most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            columns, held = [[] for _ in schema], 0
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Working names that are no column of df."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while f"__{name}" in have:
            name += "_"
        out.append(f"__{name}")
    return out


#: Bits of a bitmap's part, bits at least and at most (32 MB).
_PART, _LEAST_BITS, MOST_BITS = 32768, 1 << 16, 1 << 28


def bitmap(hashes: DataFrame, bits_each: int = 16) -> np.ndarray:
    """A bitmap of the table's only column, longs, by their last bits: `bits_each` or more for each row, until MOST_BITS.

    What is in the table is in the map; a fuller map only has more of the rest in it."""
    size = min(max(_LEAST_BITS, 1 << (bits_each * hashes.count()).bit_length()), MOST_BITS)
    slot = F.col(hashes.columns[0]).bitwiseAND(F.lit(size - 1))
    parts = hashes.select(slot.alias("slot")).groupBy((F.col("slot") / _PART).cast("int").alias("part")).agg(F.expr(f"bitmap_construct_agg(pmod(slot, {_PART}))").alias("bits"))
    bits = np.zeros(size // 8, np.uint8)
    for r in parts.toLocalIterator():
        bits[r.part * _PART // 8 : (r.part + 1) * _PART // 8] = np.frombuffer(r.bits, np.uint8)
    return bits


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (longs) may be in the map."""
    slots = hashes & np.int64(8 * len(bits) - 1)
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER_LETTERS, _LOWER_LETTERS)


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k."""
    return F.crc32(doc_id.cast("string")) % F.lit(k)


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
