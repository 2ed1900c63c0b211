"""Tables out of cells: rosters, skill and recruiting lists, career sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalars import clean_text, date_in, digits_year, file_name, normalise_light, number, person_name, split_org, to_date, year_in
from ..operators.canonical import latest_by_name
from .grid import SHEET, by_position, header_by_needles, header_by_share, headers, position_of, promote


def roster(cells: DataFrame, *keep: str) -> DataFrame:
    """Hire and exit lists, one name a row: year, type, name, source_file, sheet, and what to keep of the cells. Without a fitting header the first column lists hires and the
    second exits; one column is never both."""
    rows = header_by_needles(cells, K.ROSTER_NEEDLES, 200)
    cols = headers(cells, rows).withColumns({"join_at": position_of(F.col("columns"), ["입사"]), "exit_at": position_of(F.col("columns"), ["퇴사", "퇴직"])})
    cols = cols.withColumn("join_at", F.coalesce("join_at", F.when(F.coalesce("exit_at", F.lit(1)) != 0, F.lit(0))))
    cols = cols.withColumn("exit_at", F.coalesce("exit_at", F.when((F.size("columns") > 1) & (F.coalesce("join_at", F.lit(0)) != 1), F.lit(1))))
    at = cells.join(cols, SHEET).join(rows, SHEET).where("row_idx > header_row and col_idx in (join_at, exit_at)")
    kind = F.when(F.col("col_idx") == F.col("join_at"), "hire").otherwise("exit")
    out = at.select(year_in("sheet", "file").alias("year"), kind.alias("type"), clean_text(person_name("value")).alias("name"), file_name("file").alias("source_file"), "sheet", *keep)
    return out.where("name is not null").distinct()


def turnover_lists(cells: DataFrame) -> DataFrame:
    """As roster, of sheets whose headers are exactly the two list names; the year is the sheet name's digits."""
    exact = cells.where(F.trim("value").isin("입사자", "퇴사자"))
    heads = exact.groupBy(*SHEET).agg(F.min("row_idx").alias("header_row"))
    at = exact.join(heads, SHEET).where("row_idx = header_row").select(*SHEET, "header_row", "col_idx", F.trim("value").alias("head"))
    names = cells.join(at, [*SHEET, "col_idx"]).where("row_idx > header_row")
    out = names.select(digits_year("sheet").alias("year"), F.when(F.col("head") == "입사자", "hire").otherwise("exit").alias("type"), clean_text("value").alias("name"))
    return out.where("name is not null")


def keyed_list(cells: DataFrame, keys: dict[str, list[str]], *keep: str) -> DataFrame:
    """Sheets of many layouts to one table: each field from the column whose header holds one of its keys."""
    rows = header_by_needles(cells, K.AUX_NEEDLES, K.AUX_ROWS)
    places = headers(cells, rows).withColumns({f"at_{f}": position_of(F.col("columns"), k) for f, k in keys.items()}).drop("columns", "rows")
    at = cells.join(places, SHEET).join(rows, SHEET).where("row_idx > header_row")
    fields = at.groupBy(*SHEET, "row_idx").agg(*[F.max(F.when(F.col("col_idx") == F.col(f"at_{f}"), normalise_light("value"))).alias(f) for f in keys])
    known = [F.coalesce(F.trim(f), F.lit("")) != "" for f in ("name", "emp_id") if f in keys]
    named: Column = known[0]
    for k in known[1:]:
        named = named | k
    return fields.where(named).select(*keys, file_name("file").alias("source_file"), "sheet", *keep)


def skills(cells: DataFrame, *keep: str) -> DataFrame:
    return keyed_list(cells, K.SKILL_KEYS, *keep)


def recruits(cells: DataFrame, *keep: str) -> DataFrame:
    return keyed_list(cells, K.RECRUIT_KEYS, *keep)


def grades(cells: DataFrame) -> DataFrame | None:
    """The grade table: of the first sheet of the first file, below the first of ten rows with a name column, else below the first row. None without cells."""
    rows = header_by_needles(cells, ["이름"], 10)
    first = headers(cells, rows).join(rows, SHEET).orderBy(*SHEET[:1], "sheet_idx").first()
    return None if first is None else promote(cells, first.file, first.sheet, first.header_row, len(first["columns"]), first["columns"])


def career_rows(cells: DataFrame, *keep: str) -> DataFrame:
    """Career-length sheets by position, without the sensitive ones; snapshot_date is the file name's eight digits."""
    heads = header_by_needles(cells, ["이름", "name"], 5, default=1)
    sized = cells.groupBy(*SHEET).agg(F.max("row_idx").alias("size")).withColumn("hint", F.col("sheet").contains("재직자"))
    chosen = sized.groupBy("file").agg(F.max_by("sheet", F.struct("hint", "size", -F.col("sheet_idx"))).alias("sheet"))
    rows = by_position(cells.join(chosen, ["file", "sheet"], "left_semi"), K.CAREER_COLUMNS).join(heads, SHEET).where("row_idx > header_row")
    org, dept = split_org("org")
    return rows.where(clean_text("name").isNotNull()).select(
        "seq", "role_type", clean_text("name").alias("name"), "grade", org.alias("org"), to_date("join_date").alias("join_date"), "education", "career_grade",
        *[number(c).alias(c) for c in ("prev_career_months", "tenure_months", "total_career_months")],
        F.trim("org").alias("org_full"), dept.alias("dept"), date_in(file_name("file")).alias("snapshot_date"), *keep,
    )


def latest_careers(rows: DataFrame) -> DataFrame:
    """A name's latest row."""
    return latest_by_name(rows, "snapshot_date", "seq", "org_full")


def careers(cells: DataFrame) -> DataFrame:
    return latest_careers(career_rows(cells))


def master_sheets(cells: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """Sheets with their headers and kinds, for the canonical projection: SHEET, header_row, columns, kind, rows."""
    from ..operators.classify import sheet_kind

    rows = header_by_share(cells)
    found = headers(cells, rows).join(rows, SHEET)
    return found.withColumn("kind", sheet_kind(F.col("sheet"), F.col("columns"), skip))
