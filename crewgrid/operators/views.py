"""What the panels of a dashboard ask for; each is a function of tables and filter settings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import EARLY_WARN, EXIT_RATE_BAD, EXIT_RATE_WARN, NULL_TOKENS, RISK_HIGH, RISK_MID
from ..functions.scalars import is_early, month_of, one_place, percent, risk_level, tenure_days


def apply_filter(df: DataFrame, first: int | None = None, last: int | None = None, orgs=(), depts=()) -> DataFrame:
    """Years, orgs and depts, each only where the table has the column and a choice is made."""
    if first and last:
        year = next((c for c in ("year", "snapshot_year") if c in df.columns), None)
        if year:
            df = df.where(F.col(year).between(first, last))
        if "month" in df.columns:
            df = df.where(F.year("month").between(first, last))
    if orgs and "org" in df.columns:
        df = df.where(F.col("org").isin(*orgs))
    if depts and "dept" in df.columns:
        df = df.where(F.col("dept").isin(*depts))
    return df


def org_headcount(master: DataFrame) -> DataFrame:
    return master.where("exit_date is null and org is not null").groupBy("org").agg(F.count("*").alias("people"))


def dept_headcount(master: DataFrame, orgs=()) -> DataFrame:
    """Fewest first, as bars are drawn from below."""
    named = master.where("exit_date is null").withColumn("dept", F.trim("dept")).where(~F.col("dept").isin(NULL_TOKENS))
    return apply_filter(named, orgs=orgs).groupBy("dept").agg(F.count("*").alias("people")).orderBy("people", "dept")


def early_by_month(early: DataFrame) -> DataFrame:
    return early.groupBy(month_of("exit_date").alias("month")).agg(F.count("*").alias("early_exits"))


def kpis(people: DataFrame, yearly: DataFrame, early: DataFrame, year: int) -> DataFrame:
    """One row for a reference year; growth is against exactly the year before. Rates are rounded to one place, and levels go by the rounded rate."""
    this, before = F.col("year") == year, F.col("year") == year - 1
    flow = yearly.agg(
        F.coalesce(F.sum(F.when(this, F.col("hires"))), F.lit(0)).alias("hires"),
        F.coalesce(F.sum(F.when(this, F.col("exits"))), F.lit(0)).alias("exits"),
        F.coalesce(F.sum(F.when(before, F.col("hires"))), F.lit(0)).alias("hires_before"),
    )
    return _kpis(flow.withColumns({"total": people.agg(F.count("*")).scalar(), "early": early.agg(F.count("*")).scalar()}), year)


def kpis_of(master: DataFrame, year: int) -> DataFrame:
    """The same of a master table itself, in one pass: people without an exit, its flows and early exits."""
    in_year = lambda c, y: F.count_if(F.year(c) == y)
    counts = master.agg(
        in_year("join_date", year).alias("hires"), in_year("exit_date", year).alias("exits"), in_year("join_date", year - 1).alias("hires_before"),
        F.count_if(F.col("exit_date").isNull()).alias("total"), F.count_if(is_early(tenure_days("join_date", "exit_date"))).alias("early"),
    )
    return _kpis(counts, year)


def _kpis(out: DataFrame, year: int) -> DataFrame:
    rate = one_place(percent("exits", "total"))
    return out.select(
        F.lit(year).cast("long").alias("year"), "total", "hires", "exits", "early",
        rate.alias("exit_rate"),
        one_place(F.when(F.col("hires_before") > 0, (F.col("hires") - F.col("hires_before")) / F.col("hires_before") * 100.0)).alias("hires_growth"),
        F.when(rate >= EXIT_RATE_BAD, "exit").when(rate >= EXIT_RATE_WARN, "warn").otherwise("ok").alias("rate_level"),
        F.when(F.col("early") > EARLY_WARN, "warn").otherwise("ok").alias("early_level"),
    )


def risk_buckets(scored: DataFrame) -> DataFrame:
    s = F.col("attrition_risk_score")
    return scored.agg(F.count_if(s >= RISK_HIGH).alias("high"), F.count_if((s >= RISK_MID) & (s < RISK_HIGH)).alias("mid"), F.count("*").alias("total"))


def risk_top(scored: DataFrame, n: int = 20, *ties: str) -> DataFrame:
    """A report of the n highest scores, with what a bar is labelled with."""
    top = risk_ordered(scored, *ties).limit(n)
    return top.withColumns({"level": risk_level("attrition_risk_score"), "label": one_place("attrition_risk_score")})


def risk_ordered(scored: DataFrame, *ties: str) -> DataFrame:
    """Everyone, the highest score first."""
    return scored.orderBy(F.desc("attrition_risk_score"), *ties)


def peak_exit_year(yearly: DataFrame) -> DataFrame:
    """The year with most exits, the first of several."""
    return yearly.orderBy(F.desc("exits"), "year").limit(1).select("year", "exits")


def domains(df: DataFrame, orgs=()) -> DataFrame:
    """Choices of the filters: years, orgs, and depts of the chosen orgs. kind, value."""
    kinds = [("year", F.col("snapshot_year").cast("string")), ("org", F.col("org")), ("dept", F.when(F.col("org").isin(*orgs), F.col("dept")) if orgs else F.col("dept"))]
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds])
    return df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null").distinct()


def default_period(yearly: DataFrame) -> DataFrame:
    """The last five years that the table has a start for."""
    return yearly.agg(F.min("year").alias("a"), F.max("year").alias("b")).select(F.greatest("a", F.col("b") - 4).alias("first"), F.col("b").alias("last"))


def last_months(monthly: DataFrame, n: int = 12) -> DataFrame:
    """A report of the last n months, labelled yy.MM."""
    return monthly.orderBy(F.desc("month")).limit(n).withColumn("label", F.date_format("month", "yy.MM"))


def dept_detail(by_month: DataFrame, n: int = 300) -> DataFrame:
    """A report of the first n rows in order."""
    return by_month.orderBy(F.col("org").asc_nulls_last(), F.col("dept").asc_nulls_last(), "month").limit(n)


def net_sign(monthly: DataFrame) -> DataFrame:
    net = F.col("hires") - F.col("exits")
    return monthly.withColumns({"net": net, "sign": F.when(net > 0, "up").when(net < 0, "down").otherwise("even")})


def display_names(df: DataFrame) -> DataFrame:
    """The table with the names that panels show."""
    names = {"month": "월", "year": "연도", "hires": "입사", "exits": "퇴사", "net": "순증", "name": "이름", "org": "본부", "dept": "팀", "join_date": "입사일", "exit_date": "퇴사일"}
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})
