"""Sinks: every table is stripped of sensitive columns before it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.canonical import drop_sensitive, fix_dept
from . import csvs

LAYERS = ("bronze", "silver", "gold", "qa", "addons")


def save(df: DataFrame, root: str, layer: str, name: str, csv: bool = False, partition_by: str | None = None) -> str:
    """Parquet under root/layer/name, with a CSV copy on demand (UTF-8 with its mark)."""
    if layer not in LAYERS:
        raise ValueError(f"no layer {layer}")
    clean = drop_sensitive(df)
    writer = clean.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{root}/{layer}/{name}")
    if csv:
        csvs.write_marked(clean, f"{root}/{layer}/{name}_csv")
    return f"{root}/{layer}/{name}"


def save_unless_empty(df: DataFrame, root: str, layer: str, name: str, **options) -> str | None:
    return None if df.isEmpty() else save(df, root, layer, name, **options)


def save_json(df: DataFrame, root: str, layer: str, name: str) -> str:
    """One JSON document a row."""
    path = f"{root}/{layer}/{name}"
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
    return path


def save_fixed(df: DataFrame, name: str, dept: str, path: str) -> None:
    """The table with one person's dept set, as CSV."""
    csvs.write_marked(drop_sensitive(fix_dept(df, name, dept)), path)
