"""The tables of a build, for panels: each from where it is first found, empty where it is nowhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MASTER
from ..sources import files
from ..sources.snapshots import Snapshot, Snapshots

#: Of each table: its layer, its name, its columns.
TABLES = {
    "master": ("silver", "master", MASTER),
    "yearly": ("gold", "turnover_yearly", "year long, hires long, exits long, net long"),
    "monthly": ("gold", "monthly", "month date, hires long, exits long, net long"),
    "dept": ("gold", "dept_monthly", "org string, dept string, month date, hires long, exits long"),
    "early": ("gold", "early_exit_30d", MASTER + ", tenure_days int"),
    "attrition": ("gold", "attrition_scored", "emp_id string, name string, attrition_risk_score double"),
    "hc_active": ("silver", "headcount_active", "emp_id string, name string, org string, dept string, join_date date"),
    "hc_exited": ("silver", "headcount_exited", "emp_id string, name string, org string, dept string, exit_date date"),
}


REPORT = (
    "raw_files long, read_ok long, read_fail long, read_fail_list array<string>, classified_skips map<string, array<string>>, skipped_files array<string>, "
    "master_auto_rows long, fast_path boolean, parsed long, cells long, error_rows long, status map<string, long>, headcount string, elapsed_sec double"
)


def read_table(snapshot: Snapshot, layer: str, name: str, schema: str) -> DataFrame:
    """The snapshot's table, else a CSV of that name at the root, else in the layer or in gold, else no rows."""
    if f"{layer}/{name}" in snapshot:
        return snapshot.read(f"{layer}/{name}")
    spark, processed = snapshot.spark, snapshot.root
    found = files.first_existing(spark, *(f"{processed}/{x}{name}.csv" for x in ("", f"{layer}/", "gold/")))
    return spark.createDataFrame([], schema) if found is None else files.read_csv(spark, found, schema)


def load(spark: SparkSession, processed: str, at: int | None = None) -> dict[str, DataFrame]:
    """All tables by name, of one snapshot (the last, or that of a number), and the ingest report as `report`: whatever is built meanwhile, they stay what they are."""
    snapshots = Snapshots(spark, processed)
    snapshot = snapshots.latest() if at is None else snapshots.at(at)
    out = {k: read_table(snapshot, *v) for k, v in TABLES.items()}
    report = snapshot.read("bronze/ingest_report", "value string").select(F.from_json("value", REPORT).alias("r")).select("r.*")
    return out | {"report": report}
