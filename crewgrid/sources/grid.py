"""Sheets of unknown layout as one relation of cells: file, sheet, sheet_idx, row_idx, col_idx, value.

Header rows are found by aggregation over cells, so a workbook is read once
whatever the number of candidate rows, and many workbooks are scanned side by side.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalars import normalise

SHEET = ["file", "sheet", "sheet_idx"]


def filled(cells: DataFrame) -> DataFrame:
    return cells.withColumn("value", normalise("value")).where(~F.col("value").isin(K.NULL_TOKENS))


def header_by_share(cells: DataFrame, most_rows: int = K.HEADER_ROWS, unnamed: float = K.UNNAMED_SHARE) -> DataFrame:
    """Of each sheet the first row, below which there is data, of whose columns fewer than the share are unnamed (one at least may not be)."""
    width = F.max("col_idx").over(W.partitionBy(*SHEET)) + 1
    named = filled(cells).withColumns({"width": width, "last_row": F.max("row_idx").over(W.partitionBy(*SHEET))})
    rows = named.where(F.col("row_idx") < most_rows).groupBy(*SHEET, "row_idx").agg(F.count("*").alias("named"), F.max("width").alias("width"), F.max("last_row").alias("last_row"))
    fits = (F.col("width") - F.col("named")) < F.greatest(F.lit(1), F.floor(F.col("width") * unnamed))
    return rows.where(fits & (F.col("row_idx") < F.col("last_row"))).groupBy(*SHEET).agg(F.min("row_idx").alias("header_row"))


def header_by_needles(cells: DataFrame, needles: list[str], most_rows: int, default: int | None = 0) -> DataFrame:
    """Of each sheet the first row with a cell that holds a needle."""
    text = F.lower(F.regexp_replace(F.coalesce("value", F.lit("")), r"(?U)\s+", ""))
    hit = F.lit(False)
    for n in needles:
        hit = hit | text.contains(n.lower())
    found = F.min(F.when(hit & (F.col("row_idx") < most_rows), F.col("row_idx")))
    return cells.groupBy(*SHEET).agg((found if default is None else F.coalesce(found, F.lit(default))).alias("header_row"))


def headers(cells: DataFrame, header_rows: DataFrame) -> DataFrame:
    """Of each sheet: columns (array, blanks as col_i, repeats suffixed by their ordinal) and rows (number of non-empty data rows)."""
    at = cells.join(header_rows, SHEET)
    name = F.when(normalise("value").isin(K.NULL_TOKENS), F.concat(F.lit("col_"), F.col("col_idx").cast("string"))).otherwise(normalise("value"))
    heads = at.where("row_idx = header_row").withColumn("name", name)
    seen = F.row_number().over(W.partitionBy(*SHEET, "name").orderBy("col_idx")) - 1
    heads = heads.withColumn("seen", seen).withColumn("name", F.when(F.col("seen") > 0, F.concat_ws("_", "name", F.col("seen").cast("string"))).otherwise(F.col("name")))
    columns = heads.groupBy(*SHEET).agg(F.transform(F.sort_array(F.collect_list(F.struct("col_idx", "name"))), lambda x: x["name"]).alias("columns"))
    data = filled(at).where("row_idx > header_row").groupBy(*SHEET).agg(F.countDistinct("row_idx").alias("rows"))
    return columns.join(data, SHEET, "left").na.fill({"rows": 0})


def scan_sheets(cells: DataFrame, most_rows: int = K.SCAN_ROWS, unnamed: float = K.SCAN_SHARE, skip: tuple[str, ...] = ()) -> DataFrame:
    """Metadata of every sheet: file, sheet, kind, sample of ten columns, rows."""
    from ..operators.classify import sheet_kind

    found = headers(cells, header_by_share(cells, most_rows, unnamed))
    every = cells.select(*SHEET).distinct().join(found, SHEET, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    columns = F.coalesce("columns", F.array().cast("array<string>"))
    return every.select(*SHEET, sheet_kind(F.col("sheet"), columns, skip).alias("kind"), columns.alias("columns"), F.slice(columns, 1, 10).alias("cols_sample"), "rows")


def unique_names(names: list[str]) -> list[str]:
    """Blanks as col_i, repeats suffixed."""
    count: Counter = Counter()
    out = []
    for i, n in enumerate(names):
        n = " ".join(str(n or "").split())
        n = f"col_{i}" if n in K.NULL_TOKENS else n
        out.append(f"{n}_{count[n]}" if count[n] else n)
        count[n] += 1
    return out


def promote(cells: DataFrame, file: str, sheet: str, header_row: int, width: int, names: list[str]) -> DataFrame:
    """One sheet as a table of text columns with its headers as names; rows without any value are left out."""
    own = filled(cells.where((F.col("file") == file) & (F.col("sheet") == sheet) & (F.col("row_idx") > header_row)))
    wide = own.groupBy("row_idx").agg(*[F.max(F.when(F.col("col_idx") == i, F.col("value"))).alias(n) for i, n in enumerate(names[:width])])
    return wide.drop("row_idx")


def by_position(cells: DataFrame, positions: dict[int, str]) -> DataFrame:
    """All sheets' rows with fixed positions as columns."""
    return cells.groupBy(*SHEET, "row_idx").agg(*[F.max(F.when(F.col("col_idx") == i, F.col("value"))).alias(n) for i, n in positions.items()])


def position_of(columns: Column, keys: list[str]) -> Column:
    """Place of the header that equals or holds a key, the first key first; null if none. For sheets of many layouts in one plan."""
    plain = F.transform(columns, lambda c: F.lower(F.regexp_replace(c, r"(?U)\s", "")))
    places = F.transform(F.lit([k.lower() for k in keys]), lambda k: F.array_position(F.transform(plain, lambda c: c.contains(k)), True))
    return F.try_element_at(F.filter(places, lambda p: p > 0), F.lit(1)).cast("int") - 1
