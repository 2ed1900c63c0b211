"""Flows and headcounts over the canonical master table.

A hire and an exit of one row are counted in one pass: the row becomes up to
two events, and one aggregation counts both kinds, so there is one scan and
one exchange of already reduced rows where two aggregations and an outer
join would need three.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import EARLY_DAYS, UNKNOWN_LABEL
from ..functions.scalars import is_early, month_of, percent, since_founding, tenure_days


def events(df: DataFrame, *keep: str, joined: str = "join_date", left: str = "exit_date") -> DataFrame:
    """kind (hire, exit) and day of each dated event, with the columns in keep."""
    pairs = F.array(F.struct(F.lit("hire").alias("kind"), F.col(joined).alias("day")), F.struct(F.lit("exit").alias("kind"), F.col(left).alias("day")))
    return df.select(*keep, F.explode(pairs).alias("e")).select(*keep, "e.kind", "e.day").where("day is not null")


def flow(ev: DataFrame, *by: Column) -> DataFrame:
    return ev.groupBy(*by).agg(F.count_if(F.col("kind") == "hire").alias("hires"), F.count_if(F.col("kind") == "exit").alias("exits"))


def monthly(master: DataFrame) -> DataFrame:
    return flow(events(master), month_of("day").alias("month")).withColumn("net", F.col("hires") - F.col("exits"))


def dept_monthly(master: DataFrame) -> DataFrame:
    """By org, dept and month; a null org or dept is a group."""
    return flow(events(master, "org", "dept"), F.trim("org").alias("org"), F.trim("dept").alias("dept"), month_of("day").alias("month"))


def turnover_yearly(master: DataFrame) -> DataFrame:
    return flow(events(master), F.year("day").cast("long").alias("year")).withColumn("net", F.col("hires") - F.col("exits"))


def early_exits(master: DataFrame, days: int = EARLY_DAYS) -> DataFrame:
    return master.withColumn("tenure_days", tenure_days("join_date", "exit_date").cast("long")).where(is_early("tenure_days", days))


def in_order(early: DataFrame) -> DataFrame:
    """By exit, then join, then all else."""
    rest = [c for c in early.columns if c not in ("exit_date", "join_date")]
    return early.orderBy("exit_date", "join_date", *[F.col(c).asc_nulls_first() for c in rest])


def added(before: DataFrame, flows: Callable[[DataFrame], DataFrame], delta: DataFrame) -> DataFrame:
    """Counts by `flows` (monthly, dept_monthly or turnover_yearly) of a table that changed: delta has the rows that came (sign 1) and went (sign -1).
    Groups without any hires and exits left are gone, as if they had never been; in order of the groups."""
    by = [c for c in before.columns if c not in ("hires", "exits", "net")]
    came, went = (flows(delta.where(F.col("sign") == sign).drop("sign")).select(*by, (F.col("hires") * sign).alias("hires"), (F.col("exits") * sign).alias("exits")) for sign in (1, -1))
    both = before.select(*by, "hires", "exits").unionByName(came).unionByName(went)
    out = both.groupBy(*by).agg(F.sum("hires").alias("hires"), F.sum("exits").alias("exits")).where("hires <> 0 or exits <> 0")
    return (out.withColumn("net", F.col("hires") - F.col("exits")) if "net" in before.columns else out).select(before.columns).orderBy(*by)


def active_at(year_end: Column) -> Column:
    return F.col("exit_date").isNull() | (F.col("exit_date") > F.make_date(year_end, F.lit(12), F.lit(31)))


def headcount(master: DataFrame) -> DataFrame:
    """Named rows that are active at the end of the latest snapshot's year: over all snapshots, and people of the latest one."""
    last = master.agg(F.max("snapshot_year")).scalar()
    active = master.withColumn("last_year", last).where(active_at(F.col("last_year")))
    return active.agg(*_active_counts())


def _active_counts() -> list[Column]:
    person = F.coalesce(F.nullif(F.trim("emp_id"), F.lit("")), F.col("name"))
    return [
        F.count("name").alias("active_all_snapshots"),
        F.countDistinct(F.when(F.col("snapshot_year") == F.col("last_year"), person)).alias("active_latest_people"),
    ]


def headcount_and_list(master: DataFrame) -> DataFrame:
    """headcount, with the size of the active list (ground_truth), in one pass after that for the last year."""
    last = master.agg(F.max("snapshot_year")).scalar()
    rows = master.withColumn("last_year", last).withColumn("active", active_at(F.col("last_year")))
    of_active = rows.withColumns({c: F.when(F.col("active"), F.col(c)) for c in ("name", "emp_id")})
    return of_active.agg(*_active_counts(), F.count_if(F.col("exit_date").isNull()).alias("ground_truth"))


def turnover_pivot(lists: DataFrame) -> DataFrame:
    """lists: year, type (hire or exit)."""
    out = lists.groupBy("year").pivot("type", ["hire", "exit"]).count().na.fill(0)
    return out.select("year", F.col("hire").alias("hires"), F.col("exit").alias("exits"), (F.col("hire") - F.col("exit")).alias("net"))


def turnover_rates(yearly: DataFrame, average: Column) -> DataFrame:
    """yearly with its exits against an average headcount (a scalar subquery or literal)."""
    return yearly.withColumn("average", average).withColumn("turnover_rate", percent("exits", "average")).drop("average")


def monthly_hires_exits(active: DataFrame, exited: DataFrame) -> DataFrame:
    """Hires of both lists, exits of the second, from the founding on; with the running headcount."""
    joined = active.select(F.lit("hire").alias("kind"), since_founding("join_date").alias("day"))
    joined = joined.unionByName(exited.select(F.lit("hire").alias("kind"), since_founding("join_date").alias("day")))
    left = exited.select(F.lit("exit").alias("kind"), since_founding("exit_date").alias("day"))
    out = flow(joined.unionByName(left).where("day is not null"), F.date_format("day", "yyyy-MM").alias("period"))
    return running(out.withColumn("net", F.col("hires") - F.col("exits")), "period", F.col("net"), "headcount")


def running(periods: DataFrame, by: str, what: Column, name: str) -> DataFrame:
    """Running total over periods. These are few (hundreds) whatever the input, as they are already counted, so one task orders them."""
    return periods.withColumn(name, F.sum(what).over(W.orderBy(by).rowsBetween(W.unboundedPreceding, W.currentRow)))


def running_floored(periods: DataFrame, by: str) -> DataFrame:
    """Running net total, cut off at 0 after the sum."""
    return running(periods, by, F.col("hires") - F.col("exits"), "total").withColumn("total", F.greatest("total", F.lit(0)))


def early_exit_by_dept(exited: DataFrame, days: int = EARLY_DAYS) -> DataFrame:
    """By dept (by org in lists without depts), most first."""
    key = "dept" if "dept" in exited.columns else "org"
    early = exited.where(is_early(tenure_days(since_founding("join_date"), since_founding("exit_date")), days)).where(F.col(key).isNotNull())
    return early.groupBy(F.col(key).alias("group")).agg(F.count("*").alias(f"early_exit_{days}d")).orderBy(F.desc(f"early_exit_{days}d"), "group")


def dept_monthly_counts(active: DataFrame, exited: DataFrame) -> DataFrame:
    """By org, dept and yyyy-MM; org and dept a list lacks are labelled unknown."""
    def labelled(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.lit(UNKNOWN_LABEL) for c in ("org", "dept") if c not in df.columns})

    active, exited = labelled(active), labelled(exited)
    hires = active.select("org", "dept", F.lit("hire").alias("kind"), F.col("join_date").alias("day"))
    both = hires.unionByName(events(exited, "org", "dept")).where("day is not null and org is not null and dept is not null")
    return flow(both, "org", "dept", F.date_format("day", "yyyy-MM").alias("period"))


def first_seen(master: DataFrame) -> DataFrame:
    """First month of each org and dept: of its joins and of its snapshots' Januaries."""
    snap = F.make_date("snapshot_year", F.lit(1), F.lit(1))
    named = master.where("org is not null and dept is not null")
    return named.groupBy(F.trim("org").alias("org"), F.trim("dept").alias("dept")).agg(F.least(F.min(month_of("join_date")), F.min(snap)).alias("first_seen"))


def trim_before_first_seen(by_month: DataFrame, master: DataFrame) -> DataFrame:
    out = by_month.join(first_seen(master), ["org", "dept"], "left")
    return out.where("first_seen is null or month >= first_seen").drop("first_seen")


def dept_rates(counts: DataFrame, people: DataFrame) -> DataFrame:
    """counts with the headcount of each org and dept and rates against it."""
    heads = people.groupBy("org", "dept").agg(F.count("*").alias("headcount"))
    out = counts.join(heads, ["org", "dept"], "left").na.fill({"headcount": 0})
    return out.withColumns({"hire_rate": percent("hires", "headcount"), "exit_rate": percent("exits", "headcount")})
