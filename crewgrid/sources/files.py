"""File listings, fingerprints and the manifest that tells new, changed and gone files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import FINGERPRINT_BYTES
from ..functions.scalars import content_sha1, file_name
from ..schema import ALIAS, MANIFEST
from ..session import ship
from . import csvs, listing


def list_files(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """path, size, mtime, sha1 of the first MiB; lock files and files already moved are left out.

    Folders are listed by tasks, which read no more than that of a file; stores that only Spark's readers open are read by these, whole."""
    if listing.opens(path):
        ship(spark)
        spark.dataSource.register(listing.Fingerprints)
        options = {"path": path, "recursive": str(recursive).lower(), "pushed": spark.conf.get("spark.sql.python.filterPushdown.enabled")}
        return spark.read.format("file_fingerprints").options(**options, **({"pattern": pattern} if pattern else {})).load()
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    name = file_name("path")
    named = files.where(~name.startswith("~$") & ~name.startswith("_MOVED_"))
    return named.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), content_sha1("content", FINGERPRINT_BYTES).alias("sha1"))


def diff(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """path and status: new, changed, unchanged or deleted."""
    old = manifest.select("path", *[F.col(c).alias(f"old_{c}") for c in ("size", "mtime", "sha1")], F.lit(True).alias("known"))
    both = files.withColumn("here", F.lit(True)).join(old, "path", "full_outer")
    same = F.col("size").eqNullSafe(F.col("old_size")) & F.col("mtime").eqNullSafe(F.col("old_mtime")) & F.col("sha1").eqNullSafe(F.col("old_sha1"))
    status = F.when(F.col("here").isNull(), "deleted").when(F.col("known").isNull(), "new").when(same, "unchanged").otherwise("changed")
    return both.select("path", status.alias("status"))


def upsert(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """The manifest with the files' fingerprints in place of older ones. Files that failed should not be among `files`."""
    both = manifest.withColumn("__age", F.lit(1)).unionByName(files.withColumn("__age", F.lit(0)))
    newest = W.partitionBy("path").orderBy("__age", F.col("mtime").desc_nulls_last(), "sha1")
    return both.withColumn("__r", F.row_number().over(newest)).where("__r = 1").drop("__r", "__age")


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MANIFEST)


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Spark has them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def read_csv(spark: SparkSession, path: str, schema: str, fallback: str | None = None) -> DataFrame:
    """A CSV file with a declared schema, its columns by name, from the second place if it isn't at the first, empty if it is at neither or broken."""
    at = next((p for p in (path, fallback) if p and exists(spark, p)), None)
    return spark.createDataFrame([], schema) if at is None else csvs.read_named(spark, at, schema)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A whole JSON document; missing or broken gives no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def read_alias(spark: SparkSession, path: str) -> DataFrame | None:
    """The alias table; None where there is no file. Missing columns raise."""
    if not exists(spark, path):
        return None
    lacking = {"raw_org", "raw_dept", "std_org", "std_dept"} - set(csvs.header(path))
    if lacking:
        raise ValueError(f"alias table lacks {sorted(lacking)}")
    return csvs.read_named(spark, path, ALIAS).na.fill("")


def first_existing(spark: SparkSession, *paths: str) -> str | None:
    return next((p for p in paths if p and exists(spark, p)), None)


def newest(spark: SparkSession, folder: str, pattern: str = "*.xls*") -> str | None:
    """The last file by name."""
    if not exists(spark, folder):
        return None
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return listed.where(~file_name("path").startswith("~$")).agg(F.max("path")).first()[0]
