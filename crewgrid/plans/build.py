"""From a folder of workbooks to the gold tables, incrementally, with one commit.

What is made of files alone (cells, sheets, canonical rows, roster and list rows) is
kept by generation: a build parses new and changed files into one generation, and an
index says which has a file's rows. Files that are unchanged are not parsed again; one
that can't be read is reported and is not entered in the manifest, so that the next run tries it again.

Of canonical rows, those of new, changed and gone files tell the keys (person and
snapshot year) that are touched. Only touched keys are ranked again, from the rows
of all files in the buckets (by a hash of the key) that hold them; other buckets of the master table stay as they are.
The difference, old rows of these keys with a minus and new ones with a plus, is added to the
gold counts. So gold equals that of a full build, and a build reads the changed files, their keys' buckets and the small gold tables.

All tables belong to one snapshot (sources.snapshots): a build that breaks off anywhere leaves the
old whole set, and of two at a time the second is refused. Raw files are never written to.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalars import file_name, file_suffix
from ..operators import canonical, classify, gold, qa
from ..schema import CELLS, MANIFEST, MASTER, MASTER_COLUMNS, RECRUIT, ROSTER, SKILL
from ..session import ship
from ..sources import files, lists
from ..sources.grid import SHEET, filled, promote, scan_sheets
from ..sources.snapshots import Snapshot, Snapshots, Transaction
from ..sources.xlsx import read_errors, read_workbooks, readable

#: Names of career-length workbooks hold this.
CAREERS = "경력연차"
#: Parts of the master table, by a hash of the key; kept from the first build on.
BUCKETS = 64
#: Kinds of files of which no master rows are made: the report lists them.
SKIPPED = ["aux_pricing", "aux_recruit", "aux_skill", "aux_personalcard", "aux_reference_roster", "org_chart", "sensitive_drop", "non_excel", "unmatched_excel"]
_INDEX, _EARLY = "file string, generation string", MASTER + ", tenure_days long"
_ALERT, _TYPE = "file string, sheet string, kind string, detected_at timestamp", "columns array<string>, type_no int, version string"


@dataclass
class BuildResult:
    master: DataFrame
    roster: DataFrame
    skills: DataFrame
    recruits: DataFrame
    gold: dict[str, DataFrame]
    headcount: DataFrame
    ref_only: DataFrame
    master_only: DataFrame
    report: DataFrame
    sheets: DataFrame
    errors: DataFrame
    snapshot: Snapshot
    ingest: dict
    parsed: list[str] = field(default_factory=list)


def new_and_changed(spark: SparkSession, raw: str, base: Snapshot, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """The files as they are and what became of them since the snapshot; force takes all as changed."""
    now = files.list_files(spark, raw)
    return now, _status(now, base, force)


def _status(now: DataFrame, base: Snapshot, force: bool) -> DataFrame:
    status = files.diff(now, base.read("bronze/manifest", MANIFEST))
    return status.withColumn("status", F.when(F.lit(force) & (F.col("status") == "unchanged"), "changed").otherwise(F.col("status")))


def _settings(alias: DataFrame | None, skip: tuple[str, ...]) -> dict:
    """What canonical rows rest on besides their files; kept rows are only good for the same settings."""
    known = None if alias is None else [str(x) for x in alias.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64(*alias.columns).cast("decimal(38,0)")), F.lit(0))).first()]
    return {"alias": known, "skip": sorted(skip)}


def canonical_rows(cells: DataFrame, alias: DataFrame | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """Master rows of all sheets of that kind, of any layout, in one plan: each sheet's headers tell the fields of its columns."""
    ship(cells.sparkSession)

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for file, sheet, sheet_idx, header_row, columns in b.itertuples(index=False):
                found = canonical.fields_of(list(columns))
                has_year = any(f == "snapshot_year" for _, f in found)
                out += [(file, sheet, sheet_idx, at, header_row, f, has_year) for at, f in found]
            yield pd.DataFrame(out, columns=["file", "sheet", "sheet_idx", "col_idx", "header_row", "field", "has_year"])

    sheets = lists.master_sheets(cells, skip).where("kind = 'master'").select(*SHEET, "header_row", "columns")
    fields = sheets.mapInPandas(resolve, "file string, sheet string, sheet_idx int, col_idx int, header_row int, field string, has_year boolean")
    data = filled(cells).join(fields, [*SHEET, "col_idx"]).where("row_idx > header_row")
    wide = data.groupBy(*SHEET, "row_idx", "has_year").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in K.ALIASES])
    rows = canonical.project(wide)
    return rows if alias is None else canonical.apply_alias(rows, alias)


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("key", "snapshot_year"), F.lit(n)).cast("int").alias("bucket")


def _with_key(master: DataFrame) -> DataFrame:
    return master.withColumn("key", canonical.employee_key())


def _of_keys(rows: DataFrame, touched: DataFrame, how: str) -> DataFrame:
    """Rows (with a key) that the touched keys have (left_semi) or not (left_anti); a null year is a year."""
    t = touched.select(F.col("key").alias("__key"), F.col("snapshot_year").alias("__year"))
    return rows.join(t, (F.col("key") == F.col("__key")) & F.col("snapshot_year").eqNullSafe(F.col("__year")), how)


def _watched(tx: Transaction, sheets: DataFrame) -> DataFrame:
    """Sheets of unknown kind that were not reported before, entered among the alerts; their header sets are numbered in the registry."""
    found = classify.new_alerts(sheets.select("file", "sheet", "kind"), tx.now.read("qa/alerts", _ALERT)).withColumn("detected_at", F.current_timestamp())
    new = classify.registry_rows(sheets, tx.now.read("bronze/registry", _TYPE))
    if not new.isEmpty():
        tx.append("bronze/registry", new.coalesce(1))
    return tx.append("qa/alerts", found.coalesce(1)) if not found.isEmpty() else found.limit(0)


def watch(spark: SparkSession, processed: str, sheets: DataFrame) -> DataFrame:
    """The new alerts of some sheets, in a snapshot of their own."""
    tx = Snapshots(spark, processed).begin()
    found = _watched(tx, sheets)
    tx.commit()
    return found


class _Build:
    """One build: its transaction, the index of live files, and what it parsed."""

    def __init__(self, spark: SparkSession, raw: str, processed: str, alias: DataFrame | None, force: bool, skip: tuple[str, ...], buckets: int):
        self.spark, self.tx, self.alias, self.skip = spark, Snapshots(spark, processed).begin(), alias, skip
        settings, base = _settings(alias, skip), self.tx.base
        self.force = force or base.meta.get("settings", settings) != settings
        self.buckets = base.meta.get("buckets", buckets)
        self.tx.meta |= {"settings": settings, "buckets": self.buckets}
        self.files = self.tx.write("bronze/files", files.list_files(spark, raw))
        self.status = self.tx.write("bronze/status", _status(self.files, base, self.force))
        touched = self.status.where("status <> 'unchanged'")
        excel = file_suffix("path").isin(".xls", ".xlsx", ".xlsm")
        self.parsed = [r.path for r in touched.where(F.col("status").isin("new", "changed") & excel).select("path").orderBy("path").collect()]
        self.touched_files = touched.select(F.col("path").alias("file"))
        self.old_index = base.read("bronze/index", _INDEX)
        index = self.old_index.join(self.touched_files, "file", "left_anti")
        if self.parsed:
            index = index.unionByName(spark.createDataFrame([(p, self.tx.id) for p in self.parsed], _INDEX))
        self.index = self.tx.write("bronze/index", index)

    def parse(self) -> dict:
        """The generation of this build: cells, sheets, kinds, canonical rows, roster and list rows. What the pass itself observed."""
        tx, gen = self.tx, F.lit(self.tx.id).alias("generation")
        if not self.parsed:
            return {"cells": 0, "error_rows": 0}
        seen = Observation()
        cells = read_workbooks(self.spark, self.parsed).observe(seen, F.count_if(F.col("sheet").isNotNull()).alias("cells"), F.count_if(F.col("sheet").isNull()).alias("error_rows"))
        cells = tx.append("bronze/cells", cells.select("*", gen), tx.id)
        good = readable(cells).drop("generation")
        sheets = tx.append("bronze/sheets", scan_sheets(good, skip=self.skip).select("*", gen), tx.id)
        kinds = tx.append("bronze/kinds", classify.file_kinds(sheets).select("*", gen), tx.id)
        of_kind = lambda kind: kinds.where(F.col("kind") == kind).select("file")
        # A kind that no parsed sheet or file has gives no rows, so nothing is run for it; there are as many kinds as rules.
        there = {r.kind for r in sheets.select("kind").union(kinds.select("kind")).distinct().collect()}
        if "master_candidate" in there:
            rows = _with_key(canonical_rows(good.join(of_kind("master_candidate"), "file", "left_semi"), self.alias, self.skip))
            # Sorted by file, so that a file's rows are found without reading the others.
            rows = rows.select(*MASTER_COLUMNS, "key", gen, _bucket(self.buckets)).repartition("bucket").sortWithinPartitions("bucket", "data_source")
            tx.append("bronze/master_rows", rows, tx.id, buckets=True)

        def of(kind: str, file_kind: str) -> DataFrame:
            wanted = sheets.where(F.col("kind") == kind).select(*SHEET).unionByName(sheets.join(of_kind(file_kind), "file", "left_semi").select(*SHEET))
            return good.join(wanted, SHEET, "left_semi")

        parts = {"roster": ("reference_roster", "aux_reference_roster", lists.roster), "skill": ("aux_skill", "aux_skill", lists.skills), "recruit": ("aux_recruit", "aux_recruit", lists.recruits)}
        for name, (kind, file_kind, read) in parts.items():
            if there & {kind, file_kind}:
                tx.append(f"bronze/{name}_rows", read(of(kind, file_kind), "file").select("*", gen), tx.id)
        if any(CAREERS in file_of(p) for p in self.parsed):
            tx.append("bronze/career_rows", lists.career_rows(good.where(file_name("file").contains(CAREERS)), "file").select("*", gen), tx.id)
        return dict(seen.get)

    def live(self, name: str, empty: str | None = None, **which) -> DataFrame:
        """The rows of all files that are there."""
        return self.tx.now.read(name, empty, **which).join(self.index, ["file", "generation"], "left_semi").drop("generation")

    def masters(self) -> tuple[DataFrame, DataFrame]:
        """Rank the touched keys anew. The master table, and the signed difference."""
        tx, base, n = self.tx, self.tx.base, self.buckets
        names = "bronze/master_rows"
        if names not in tx.now:
            tx.append(names, self.spark.createDataFrame([], MASTER + ", key string, generation string, bucket int"), tx.id, buckets=True)
        keys = lambda df: df.select("key", "snapshot_year")
        gone_files = self.old_index.join(self.touched_files, "file", "left_semi")
        old_generations = [r.generation for r in gone_files.select("generation").distinct().collect()]
        new = tx.now.read(names, generations=[tx.id])
        touched = keys(new)
        if old_generations:
            before = base.read(names, generations=old_generations)
            touched = touched.unionByName(keys(before.join(gone_files.withColumnRenamed("file", "data_source"), ["data_source", "generation"], "left_semi")))
        touched = tx.write("bronze/touched_keys", touched.distinct().select("key", "snapshot_year", _bucket(n)))
        buckets = sorted(r.bucket for r in touched.select("bucket").distinct().collect())  # at most n
        rows = tx.now.read(names, buckets=buckets).join(self.index.withColumnRenamed("file", "data_source"), ["data_source", "generation"], "left_semi")
        best = canonical.deduplicate(_of_keys(rows, touched, "left_semi").select(MASTER_COLUMNS))
        old = _with_key(base.read("silver/master", MASTER, buckets=buckets))
        signed = best.withColumn("sign", F.lit(1)).unionByName(_of_keys(old, touched, "left_semi").select(*MASTER_COLUMNS, F.lit(-1).alias("sign")))
        delta = tx.write("bronze/delta", signed)
        stay = _of_keys(old, touched, "left_anti").select(MASTER_COLUMNS)
        both = _with_key(stay.unionByName(delta.where("sign = 1").drop("sign"))).select(*MASTER_COLUMNS, _bucket(n))
        master = tx.write_buckets("silver/master", both.repartition("bucket").sortWithinPartitions("bucket"), buckets)
        self.touched, self.touched_buckets = touched, buckets
        return master, delta

    def golds(self, delta: DataFrame) -> dict[str, DataFrame]:
        base = self.tx.base
        count = "hires long, exits long"
        schemas = {"turnover_yearly": f"year long, {count}, net long", "monthly": f"month date, {count}, net long", "dept_monthly": f"org string, dept string, month date, {count}"}
        out = {name: gold.added(base.read(f"gold/{name}", s), getattr(gold, name), delta) for name, s in schemas.items()}
        early = _of_keys(_with_key(base.read("gold/early_exit_30d", _EARLY)), self.touched, "left_anti").drop("key")
        out["early_exit_30d"] = gold.in_order(early.unionByName(gold.early_exits(delta.where("sign = 1").drop("sign"))))
        return {name: self.tx.write(f"gold/{name}", df) for name, df in out.items()}

    def addons(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        as_is = lambda df: df
        tables = {"reference_roster": ("roster", lambda df: df.distinct()), "aux_skill": ("skill", as_is), "aux_recruit": ("recruit", as_is), "career_rank": ("career", lists.latest_careers)}
        for name, (part, made) in tables.items():
            if f"bronze/{part}_rows" in self.tx.now:
                self.tx.write_unless_empty(f"addons/{name}", made(self.live(f"bronze/{part}_rows").drop("file")))
            else:
                self.tx.drop(f"addons/{name}")
        read = lambda name, schema: self.tx.now.read(f"addons/{name}", schema)
        return read("reference_roster", ROSTER), read("aux_skill", SKILL), read("aux_recruit", RECRUIT)

    def report(self, observed: dict, master_rows: int, began: float, headcount: str) -> dict:
        """What became of the files: as counted in the pass, and the lists by kind, from the small tables of files."""
        kinds, errors = self.live("bronze/kinds", "file string, kind string, decided_by string, generation string"), read_errors(self.live("bronze/cells", CELLS + ", generation string"))
        excel = file_suffix("path").isin(".xls", ".xlsx", ".xlsm")
        every = self.files.join(kinds.select(F.col("file").alias("path"), "kind"), "path", "left").join(errors.withColumnRenamed("file", "path"), "path", "left")
        has_rows = self.live_files_with_rows().withColumn("rows", F.lit(True))
        every = every.join(has_rows.withColumnRenamed("data_source", "path"), "path", "left")
        bucket = F.when(~excel, "non_excel").when(F.col("error").isNotNull(), "read_fail").when(F.col("kind") != "master_candidate", F.coalesce("kind", F.lit("unmatched_excel")))
        bucket = bucket.when(F.col("rows").isNull(), "unmatched_excel").otherwise("master")
        listed = F.sort_array(F.collect_list(F.when(F.col("bucket") != "master", F.concat(file_name("path"), F.coalesce(F.concat(F.lit(" ("), "error", F.lit(")")), F.lit(""))))))
        by = {r.bucket: r for r in every.withColumn("bucket", bucket).groupBy("bucket").agg(F.count("*").alias("n"), listed.alias("names")).collect()}
        names = lambda k: list(by[k].names) if k in by else []
        status = {r.status: r["count"] for r in self.status.groupBy("status").count().collect()}
        return {
            "raw_files": sum(r.n for r in by.values()), "read_ok": sum(r.n for k, r in by.items() if k not in ("read_fail", "non_excel")), "read_fail": len(names("read_fail")),
            "read_fail_list": names("read_fail"), "classified_skips": {k: names(k) for k in SKIPPED}, "skipped_files": names("org_chart"), "master_auto_rows": master_rows,
            "fast_path": not self.parsed and not status.get("deleted", 0), "parsed": len(self.parsed), **observed, "status": status, "headcount": headcount,
            "touched_buckets": len(self.touched_buckets), "elapsed_sec": round(time.time() - began, 1),
        }

    def live_files_with_rows(self) -> DataFrame:
        rows = self.tx.now.read("bronze/master_rows").select("data_source", "generation").distinct()
        return rows.join(self.index.withColumnRenamed("file", "data_source"), ["data_source", "generation"], "left_semi").select("data_source").distinct()


def build(
    spark: SparkSession, raw: str, processed: str, alias: DataFrame | None = None, force: bool = False, headcount: str | None = None,
    columns: dict[str, str] | None = None, skip: tuple[str, ...] = (), buckets: int = BUCKETS, keep: int = 2, grace: float = 3600,
) -> BuildResult:
    """headcount: name of the headcount workbook, else the last one in raw/headcount; columns: its column map; skip: sheet names to leave out;
    buckets: parts of the master table (the first build decides); keep, grace: snapshots kept, and seconds that a broken build's folders are left."""
    began = time.time()
    b = _Build(spark, raw, processed, alias, force, skip, buckets)
    tx = b.tx
    observed = b.parse()
    master, delta = b.masters()
    tables = b.golds(delta)
    roster, skills, recruits = b.addons()
    if alias is not None:
        missing = canonical.alias_missing(tx.now.read("bronze/master_rows").join(b.index.withColumnRenamed("file", "data_source"), ["data_source", "generation"], "left_semi"), alias)
        tx.write("qa/alias_missing", missing)
    said = "no column map" if not columns else "no workbook"
    tx.drop("silver/headcount_active", "silver/headcount_exited", "silver/headcount_survey")
    if columns and (workbook := headcount_workbook(spark, raw, headcount)):
        said = file_of(workbook)
        for role, df in headcount_lists(readable(read_workbooks(spark, [workbook])), columns).items():
            tx.write_unless_empty(f"silver/headcount_{role}", df)
    ref_only, master_only, report = qa.ref_only(master, roster), qa.master_only(master, roster), qa.report(master, roster)
    ref_only, master_only, report = tx.write("qa/mismatch_ref_only", ref_only), tx.write("qa/mismatch_master_only", master_only), tx.write("qa/qa_report", report)
    sheets = b.live("bronze/sheets", "file string, sheet string, sheet_idx int, kind string, columns array<string>, cols_sample array<string>, rows long, generation string")
    _watched(tx, sheets)
    errors = tx.write("bronze/errors", read_errors(b.live("bronze/cells", CELLS + ", generation string")))
    good = b.files.join(errors.select(F.col("file").alias("path")), "path", "left_anti")
    tx.write("bronze/manifest", good)
    ingest = b.report(observed, master.count(), began, said)
    tx.write("bronze/ingest_report", spark.createDataFrame([(json.dumps(ingest, ensure_ascii=False),)], "value string"))
    tx.keep_generations({r.generation for r in b.index.select("generation").distinct().collect()})
    snapshot = tx.commit()
    Snapshots(spark, processed).clean(keep, grace)
    return BuildResult(master, roster, skills, recruits, tables, gold.headcount(master), ref_only, master_only, report, sheets, errors, snapshot, ingest, b.parsed)


def file_of(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def headcount_workbook(spark: SparkSession, raw: str, name: str | None = None) -> str | None:
    """The named workbook in raw or raw/headcount, else the last by name in the latter."""
    named = [f"{raw}/{name}", f"{raw}/headcount/{name}"] if name else []
    return files.first_existing(spark, *named) or files.newest(spark, f"{raw}/headcount", "*.xls*")


def headcount_lists(cells: DataFrame, mapping: dict[str, str]) -> dict[str, DataFrame]:
    """The active, exited and survey lists of a headcount workbook, by a config's column map."""
    from ..sources.grid import header_by_needles, headers

    rows = header_by_needles(cells, K.HEADCOUNT_NEEDLES, K.HEADCOUNT_ROWS)
    found = headers(cells, rows).join(rows, SHEET)
    chosen = classify.best_sheets(found.select("file", "sheet", "sheet_idx", "rows")).join(found, ["file", "sheet"])
    out = {}
    for s in chosen.orderBy("file", "role").collect():
        df = promote(cells, s.file, s.sheet, s.header_row, len(s.columns), s.columns)
        out[s.role] = canonical.drop_sensitive(df) if s.role == "survey" else canonical.standardise(df, mapping)
    return out


def main(argv: list[str] | None = None) -> int:
    """python -m crewgrid.plans.build RAW PROCESSED [--force | --check] [--alias CSV] [--headcount NAME] [--config JSON_OR_YAML]

    The config may have files.org_alias_map_csv, files.headcount_2024_xlsx, columns.headcount_2024 (a column map), paths.mapping_dir and skip_sheets; options come first."""
    import argparse

    from ..session import session
    from ..sources.config import of, read_config

    args = argparse.ArgumentParser(description=main.__doc__)
    args.add_argument("raw")
    args.add_argument("processed")
    args.add_argument("--force", action="store_true")
    args.add_argument("--check", action="store_true")
    args.add_argument("--alias")
    args.add_argument("--headcount")
    args.add_argument("--config")
    given = args.parse_args(argv)
    spark = session()
    config = read_config(spark, given.config) if given.config else {}
    _, status = new_and_changed(spark, given.raw, Snapshots(spark, given.processed).latest(), given.force)
    counts = {r.status: r["count"] for r in status.groupBy("status").count().collect()}
    print(counts)
    if given.check or not set(counts) - {"unchanged"}:
        return 0
    mapping = of(config, "paths", "mapping_dir")
    alias_at = given.alias or (f"{mapping}/{of(config, 'files', 'org_alias_map_csv')}" if mapping and of(config, "files", "org_alias_map_csv") else f"{given.processed}/org_alias_map.csv")
    result = build(
        spark, given.raw, given.processed, alias=files.read_alias(spark, alias_at), force=given.force,
        headcount=given.headcount or of(config, "files", "headcount_2024_xlsx"), columns=of(config, "columns", "headcount_2024"), skip=tuple(of(config, "skip_sheets", default=())),
    )
    result.report.show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
