"""Column resolution, canonical rows, keep-best dedup and the alias dimension."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import ALIASES, NULL_TOKENS, SENSITIVE_NAMES, SENSITIVE_PARTS
from ..functions.scalars import clean_text, date_spelling, emp_id, normalise, to_date, year_in, year_last_parts
from ..schema import MASTER_COLUMNS


def key(text) -> str:
    """The driver's twin of functions.scalars.key_of, for headers."""
    return re.sub(r"[\s()\[\]{}_:\-]", "", "" if text is None else str(text)).lower()


def find_column(columns: list[str], aliases: list[str]) -> str | None:
    """A header that equals an alias, else one that contains one; the order of aliases decides, then that of columns."""
    keys = {key(c): c for c in reversed(columns)}
    for a in aliases:
        if key(a) in keys:
            return keys[key(a)]
    return next((c for a in aliases if key(a) for c in columns if key(a) in key(c)), None)


def sensitive(columns: list[str]) -> list[str]:
    """Headers that hold a sensitive word; a shorter header within such a word is not one."""
    return [c for c in columns if any(key(s) in key(c) for s in SENSITIVE_PARTS)]


def drop_sensitive(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.strip() in SENSITIVE_NAMES or c in sensitive([c])])


def fields_of(columns: list[str]) -> list[tuple[int, str]]:
    """Places of the canonical fields among a sheet's headers; none without an id and a name column. Sensitive columns are no one's."""
    open_ = [c for c in columns if c not in sensitive(columns)]
    at = {field: find_column(open_, names) for field, names in ALIASES.items()}
    if at["emp_id"] is None and at["name"] is None:
        return []
    return [(columns.index(c), field) for field, c in at.items() if c is not None]


def canonicalise(df: DataFrame, source: str, sheet: str) -> DataFrame | None:
    """A sheet with text columns to master rows in one projection; None without an id and a name column."""
    found = {field: df.columns[i] for i, field in fields_of(df.columns)}
    if not found:
        return None
    columns = [(F.col(f"`{found[f]}`") if f in found else F.lit(None)).cast("string").alias(f) for f in ALIASES]
    return project(df.select(*columns, F.lit(source).alias("file"), F.lit(sheet).alias("sheet"), F.lit("snapshot_year" in found).alias("has_year")))


def date_spellings(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """A histogram: of each of `by` and each column how many dates are spelled how (n), and how many have a first, and a second, number over 12."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), date_spelling(c).alias("spelling"), *[(x > 12).alias(n) for x, n in zip(year_last_parts(c), ("first", "second"), strict=True)]) for c in columns])
    return rows.select(*by, F.explode(each).alias("d")).groupBy(*by, "d.column", "d.spelling").agg(F.count("*").alias("n"), F.count_if("d.first").alias("first_over_12"), F.count_if("d.second").alias("second_over_12"))


def day_orders(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Of each of `by`, for each column whether dates like 1/2/2024 have the day first: where that fits more of the column's dates."""
    told = date_spellings(rows, by, columns).where("spelling = 'year_last'")
    first = F.col("first_over_12") > F.col("second_over_12")
    return told.groupBy(*by).agg(*[F.max(F.when(F.col("column") == c, first)).alias(f"{c}_day_first") for c in columns])


def project(rows: DataFrame) -> DataFrame:
    """rows: a text column for each field (null where the sheet lacks it), file, sheet, has_year. Master rows.

    The order of day and month is chosen once a sheet and column, from all of its dates."""
    sheet = ["file", "sheet"]
    rows = rows.join(day_orders(rows.where("file is not null and sheet is not null"), sheet, ["join_date", "exit_date"]), sheet, "left")
    given = F.regexp_replace("snapshot_year", r"\.0$", "").try_cast("int")
    joined = to_date("join_date", F.col("join_date_day_first"))
    out = rows.select(
        emp_id("emp_id").alias("emp_id"),
        *[clean_text(f).alias(f) for f in ("name", "org", "dept", "title", "grade")],
        joined.alias("join_date"),
        to_date("exit_date", F.col("exit_date_day_first")).alias("exit_date"),
        # A choice for the whole sheet: a null in a given column stays null.
        F.when(F.col("has_year"), given).otherwise(F.coalesce(year_in("file"), F.year(joined))).alias("snapshot_year"),
        F.col("file").alias("data_source"),
        F.col("sheet").alias("sheet_name"),
    )
    return out.dropna(how="all", subset=["emp_id", "name"]).select(MASTER_COLUMNS)


def employee_key():
    """The id, else the name."""
    e, n = F.trim("emp_id"), F.trim("name")
    return F.when(e.isNull() | e.isin(NULL_TOKENS), F.coalesce(n, F.lit(""))).otherwise(e)


def completeness():
    filled = sum((F.col(c).isNotNull().cast("int") for c in ("name", "org", "dept", "title", "grade")), F.lit(0))
    return F.col("exit_date").isNotNull().cast("int") * 100 + filled


def deduplicate(master: DataFrame, *ties: str) -> DataFrame:
    """One row a person and snapshot year: the most complete, then the latest exit, the latest join, then by `ties` (all columns if none given)."""
    rest = ties or [c for c in master.columns if c not in ("exit_date", "join_date")]
    best = W.partitionBy("__key", "snapshot_year").orderBy(
        completeness().desc(), F.col("exit_date").desc_nulls_last(), F.col("join_date").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]
    )
    ranked = master.withColumn("__key", employee_key()).withColumn("__rank", F.row_number().over(best))
    return ranked.where("__rank = 1").drop("__key", "__rank")


def latest_people(master: DataFrame, *ties: str) -> DataFrame:
    """People of the latest snapshot that are active at its year's end; one row an id."""
    from .gold import active_at

    last = master.agg(F.max("snapshot_year")).scalar()
    active = master.withColumn("__last", last).where((F.col("snapshot_year") == F.col("__last")) & active_at(F.col("__last"))).drop("__last")
    order = [F.col(c).asc_nulls_last() for c in (ties or master.columns)]
    return active.withColumn("__rank", F.row_number().over(W.partitionBy(employee_key()).orderBy(*order))).where("__rank = 1").drop("__rank")


def latest_by_name(df: DataFrame, by: str = "snapshot_date", *ties: str) -> DataFrame:
    order = [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]
    return df.withColumn("__rank", F.row_number().over(W.partitionBy("name").orderBy(*order))).where("__rank = 1").drop("__rank")


#: An alias table of up to so many rows is sent to all executors (about 200 bytes each); a longer one is joined by a shuffle.
ALIAS_ROWS = 100_000


def _alias(alias: DataFrame) -> DataFrame:
    known = alias.select(normalise("raw_org").alias("__org"), normalise("raw_dept").alias("__dept"), "std_org", "std_dept")
    known = known.groupBy("__org", "__dept").agg(F.min(F.struct("std_org", "std_dept")).alias("s")).select("__org", "__dept", "s.std_org", "s.std_dept")
    return F.broadcast(known) if alias.limit(ALIAS_ROWS + 1).count() <= ALIAS_ROWS else known


def apply_alias(df: DataFrame, alias: DataFrame) -> DataFrame:
    """org and dept by the alias table where it has the pair; nulls stay null."""
    hit = (normalise("org") == F.col("__org")) & (normalise("dept") == F.col("__dept"))
    out = df.join(_alias(alias), hit, "left")
    return out.withColumns({"org": F.coalesce("std_org", "org"), "dept": F.coalesce("std_dept", "dept")}).select(df.columns)


def alias_missing(df: DataFrame, alias: DataFrame) -> DataFrame:
    """Pairs that the alias table lacks, once each."""
    pairs = df.select(normalise("org").alias("org"), normalise("dept").alias("dept")).distinct()
    return pairs.join(_alias(alias), (F.col("org") == F.col("__org")) & (F.col("dept") == F.col("__dept")), "left_anti")


def standardise(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Typed standard columns by a config's map, each source used once; mapped sources go, rows without a name go, sensitive columns go."""
    new, used = {}, []
    for std, source in mapping.items():
        if source and source in df.columns and std not in df.columns and source not in used:
            c = F.col(f"`{source}`").cast("string")
            new[std] = to_date(c) if std in ("join_date", "exit_date") else normalise(c)
            used.append(source)
    out = drop_sensitive(df.withColumns(new).drop(*used))
    return out.where(F.col("name").isNotNull() & ~F.col("name").isin(NULL_TOKENS)) if "name" in out.columns else out


def missing_dept(df: DataFrame) -> DataFrame:
    return df.where(F.col("dept").isNull() | (F.trim("dept") == ""))


def fix_dept(df: DataFrame, name: str, dept: str) -> DataFrame:
    return df.withColumn("dept", F.when(F.trim("name") == name.strip(), F.lit(dept)).otherwise(F.col("dept")))
