"""Kinds of sheets and files as expressions: a cascade of rules over a sheet's name and headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalars import contains_any, file_name, file_suffix, key_of, parent_folder
from .canonical import key


def _keys(words: list[str]) -> list[str]:
    return list(dict.fromkeys(key(w) for w in words))


def has(columns: Column, signals: list[str]) -> Column:
    """A header holds a signal or is held by one; empty headers never do."""
    words = F.lit(_keys(signals))
    return F.exists(columns, lambda c: (c != "") & F.exists(words, lambda s: c.contains(s) | s.contains(c)))


def _holding(word: str):
    return lambda c: c.contains(word)


def _any_in(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for w in _keys(words):
        found = found | text.contains(w)
    return found


def sheet_kind(sheet: Column, columns: Column, skip: tuple[str, ...] = ()) -> Column:
    """The first rule that fits decides; resident numbers beside ids and dates don't keep a sheet from being a master. skip: names of sheets
    to leave out besides those that any company may have."""
    name = key_of(sheet)
    keys = F.transform(F.coalesce(columns, F.array().cast("array<string>")), lambda c: key_of(c))
    dated = has(keys, K.JOIN_SIGNALS) | has(keys, K.EXIT_SIGNALS)
    with_id, with_name = has(keys, K.ID_SIGNALS), has(keys, K.NAME_SIGNALS)
    contacts = F.lit(0)
    for s in _keys(K.CONTACT_SIGNALS):
        contacts = contacts + F.exists(keys, _holding(s)).cast("int")
    listed = F.exists(keys, lambda c: c.contains("입사자") | c.contains("퇴사자"))
    return (
        F.when(_any_in(name, [*K.SKIP_SHEETS, *skip]), "skip")
        .when(has(keys, K.ORG_SIGNALS) | _any_in(name, K.ORG_SIGNALS), "org_chart")
        .when((contacts >= 2) & ~(with_id & dated), "sensitive_drop")
        .when(with_id & dated, "master")
        .when(_any_in(name, K.MASTER_SHEETS) & dated, "master")
        .when(with_name & dated & ~with_id, "reference_roster")
        .when(listed, "reference_roster")
        .when(has(keys, K.PRICE_SIGNALS), "aux_pricing")
        .when(has(keys, K.RESIDENT_SIGNALS), "aux_personalcard")
        .when(has(keys, K.SKILL_SIGNALS), "aux_skill")
        .when(has(keys, K.RECRUIT_SIGNALS), "aux_recruit")
        .when(has(keys, K.GRADE_SIGNALS) & with_name, "aux_personalcard")
        .otherwise("unknown")
    )


def kind_rank(kind: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for i, k in enumerate(K.KINDS) for x in (k, i)])
    return F.coalesce(F.try_element_at(ranks, kind), F.lit(len(K.KINDS)))


def name_kind(path: Column, names=K.FILE_NAMES) -> Column:
    """Kind by keywords of the file's name, the first that fits, else null."""
    name = file_name(path)
    out = F.lit(None).cast("string")
    for kind, words in reversed(names):
        out = F.when(contains_any(name, words), kind).otherwise(out)
    return out


def folder_kind(path: Column) -> Column:
    """Kind by the folder that files of a kind are sorted into, else null."""
    folder = F.lower(parent_folder(path))
    out = F.lit(None).cast("string")
    for where, kind in K.FOLDER_KINDS.items():
        out = F.when(folder == where, kind).otherwise(out)
    return out


def file_kinds(sheets: DataFrame) -> DataFrame:
    """sheets: file, kind. Each file's most telling kind, and whether its folder, its name or its sheets decided it."""
    best = sheets.groupBy("file").agg(F.min_by("kind", F.struct(kind_rank(F.col("kind")), F.col("kind"))).alias("content"))
    mapped = F.create_map(*[F.lit(x) for pair in K.FILE_KINDS.items() for x in pair])
    content = F.when(file_suffix("file").isin(".xlsx", ".xlsm"), F.coalesce(F.try_element_at(mapped, F.col("content")), F.col("content")))
    kind = F.coalesce(folder_kind(F.col("file")), name_kind(F.col("file")), content, F.lit("master_candidate"))
    by = F.when(folder_kind(F.col("file")).isNotNull(), "folder").when(name_kind(F.col("file")).isNotNull(), "name").when(content.isNotNull(), "content").otherwise("default")
    return best.select("file", kind.alias("kind"), by.alias("decided_by"))


def sort_plan(sheets: DataFrame) -> DataFrame:
    """Where each file belongs; nothing is moved. Old binary workbooks, which aren't opened, go by their names alone."""
    best = sheets.groupBy("file").agg(F.min_by("kind", F.struct(kind_rank(F.col("kind")), F.col("kind"))).alias("kind"))
    folders = F.create_map(*[F.lit(x) for pair in K.FOLDERS.items() for x in pair])
    opened = F.when(kind_rank(F.col("kind")) < len(K.KINDS) - 1, F.col("kind")).otherwise(F.coalesce(name_kind(F.col("file")), F.lit("unknown")))
    best = best.withColumn("kind", F.when(file_suffix("file") == ".xls", F.coalesce(name_kind(F.col("file"), K.XLS_NAMES), F.lit("unknown"))).otherwise(opened))
    return best.withColumn("folder", F.coalesce(F.try_element_at(folders, F.col("kind")), F.lit("unknown")))


def new_alerts(sheets: DataFrame, known: DataFrame) -> DataFrame:
    """Sheets of unknown kind that have not been reported yet, by file and sheet."""
    return sheets.where("kind in ('unknown', 'read_error')").dropDuplicates(["file", "sheet"]).join(known.select("file", "sheet"), ["file", "sheet"], "left_anti")


def registry_rows(sheets: DataFrame, registry: DataFrame) -> DataFrame:
    """New registry entries for unknown header sets that it lacks: columns (a sample of fifteen), numbered after the last type, and the registry's
    next version, which all of one call share."""
    from pyspark.sql import Window as W

    last = registry.agg(F.coalesce(F.max("type_no"), F.lit(0)).alias("type_no"), F.coalesce(F.max_by("version", "type_no"), F.lit("v1.0")).alias("version"))
    sets = sheets.where("kind = 'unknown'").select(F.slice(F.array_distinct("columns"), 1, 15).alias("columns")).distinct()
    sets = sets.join(registry.select("columns"), "columns", "left_anti")
    # Header sets of unknown sheets are schema, not data: a few in any corpus.
    sets = sets.withColumn("type_no", F.row_number().over(W.orderBy("columns")) + last.select("type_no").scalar())
    return sets.withColumn("version", bump_version(last.select("version").scalar()))


def bump_version(version: Column) -> Column:
    """The minor number of v1.2 goes up by one."""
    major, minor = F.regexp_extract(version, r"(\d+)\.(\d+)", 1), F.regexp_extract(version, r"(\d+)\.(\d+)", 2).try_cast("int")
    return F.concat(F.lit("v"), major, F.lit("."), (minor + 1).cast("string"))


def best_sheets(sheets: DataFrame) -> DataFrame:
    """sheets: file, sheet, sheet_idx, rows. Of each file the active and the exited list: by the sheet name's score, then by size, then by place.
    Without a name that tells, the largest sheet is the active list."""
    from pyspark.sql import Window as W

    name = F.lower(F.regexp_replace("sheet", " ", ""))
    active, exited = contains_any(name, K.ACTIVE_SHEETS), contains_any(name, K.EXITED_SHEETS)
    scored = sheets.withColumns({"is_exit": exited, "score": active.cast("int") * 5 - exited.cast("int") * 5, "is_active": active})
    w = W.partitionBy("file").orderBy(F.desc("score"), F.desc("rows"), "sheet_idx")
    gone = scored.where("is_exit").withColumn("r", F.row_number().over(w)).where("r = 1").select("file", "sheet", F.lit("exited").alias("role"))
    left = scored.join(gone.select("file", "sheet"), ["file", "sheet"], "left_anti")
    first = W.partitionBy("file").orderBy(F.desc("is_active"), F.when(F.col("is_active"), F.col("score")).desc_nulls_last(), F.desc("rows"), "sheet_idx")
    here = left.withColumn("r", F.row_number().over(first)).where("r = 1").select("file", "sheet", F.lit("active").alias("role"))
    survey = scored.where(contains_any(name, K.SURVEY_SHEETS)).withColumn("r", F.row_number().over(W.partitionBy("file").orderBy("sheet_idx"))).where("r = 1")
    return here.unionByName(gone).unionByName(survey.select("file", "sheet", F.lit("survey").alias("role")))
