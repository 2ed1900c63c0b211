"""Reconciliation of the master table with an independent roster, and data-quality counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import person_name
from ..schema import MASTER_ONLY


#: Up to so many different years are broadcast.
YEARS = 10_000


def ref_only(master: DataFrame, roster: DataFrame) -> DataFrame:
    """Roster rows whose name the master lacks in that year."""
    known = master.select(F.col("snapshot_year").alias("__y"), person_name("name").alias("__n")).where("__n is not null").distinct()
    named = roster.where("year is not null and name is not null").withColumn("name", person_name("name"))
    return named.join(known, (F.col("year") == F.col("__y")) & (F.col("name") == F.col("__n")), "left_anti")


def master_only(master: DataFrame, roster: DataFrame) -> DataFrame:
    """Master rows of years for which the roster has names, whose name it lacks."""
    named = roster.where("year is not null and name is not null").select(F.col("year").alias("__y"), person_name("name").alias("__n")).distinct()
    years = named.select(F.col("__y").alias("__year")).distinct()
    # A few calendar years: sent to all tasks if their count says so, so that the master isn't shuffled for them.
    years = F.broadcast(years) if years.limit(YEARS + 1).count() <= YEARS else years
    covered = master.join(years, F.col("snapshot_year") == F.col("__year"), "left_semi")
    lacking = covered.join(named, (F.col("snapshot_year") == F.col("__y")) & (person_name("name") == F.col("__n")), "left_anti")
    return lacking.select([c for c in MASTER_ONLY if c in lacking.columns])


def counters(master: DataFrame) -> DataFrame:
    """One row: rows, rows with a repeated id, missing org and dept, exits before joins, the years."""
    ids = master.select(F.nullif(F.trim("emp_id"), F.lit("")).alias("id")).where("id is not null").groupBy("id").count()
    repeated = ids.where("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0))).scalar()
    return master.agg(
        F.count("*").alias("master_rows"),
        F.count_if(F.col("org").isNull()).alias("missing_org_rows"),
        F.count_if(F.col("dept").isNull()).alias("missing_dept_rows"),
        F.count_if(F.col("join_date") > F.col("exit_date")).alias("bad_date_rows"),
        F.array_join(F.sort_array(F.collect_set("snapshot_year")), ",").alias("years"),
    ).withColumn("duplicate_emp_id_rows", repeated)


def report(master: DataFrame, roster: DataFrame) -> DataFrame:
    """counters with the sizes of the roster and of both differences: one scan of either table, whose rows meet by year and name, and by id."""
    zero, one = F.lit(0), F.lit(1)
    flags = {"missing_org": F.col("org").isNull(), "missing_dept": F.col("dept").isNull(), "bad_date": F.coalesce(F.col("join_date") > F.col("exit_date"), F.lit(False))}

    def row(kind: str, year, key, m, r, told: bool):
        return F.struct(
            F.lit(kind).alias("kind"), year.cast("int").alias("year"), key.alias("key"), m.alias("m"), r.alias("r"), *[(c.cast("int") if told else zero).alias(n) for n, c in flags.items()]
        )

    nothing = F.lit(None)
    of_name, of_id = row("name", F.col("snapshot_year"), person_name("name"), one, zero, True), row("id", nothing, F.nullif(F.trim("emp_id"), F.lit("")), one, zero, False)
    masters = master.select(F.inline(F.array(of_name, of_id))).where("kind = 'name' or key is not null")
    # A name that is null stays null, so such rows of the roster only count.
    listed = roster.select(F.inline(F.array(row("name", F.col("year"), person_name("name"), zero, one, False))))
    total = lambda c, when=None: F.coalesce(F.sum(c if when is None else F.when(when, c)), F.lit(0))
    # Keys are almost as many as rows, so nothing is gained by counting them where the tables are joined, which would hold them all beside the join's
    # rows: they are dealt first, in parts that grow with the input by their size only. Rows without a key are not compared and stay spread.
    dealt = masters.unionByName(listed).withColumn("part", F.when(F.col("key").isNull(), F.spark_partition_id()).otherwise(0))
    dealt = dealt.repartition(int(master.sparkSession.conf.get("spark.sql.shuffle.partitions")), "kind", "year", "key", "part")
    keys = dealt.groupBy("kind", "year", "key", "part").agg(*[F.sum(c).alias(c) for c in ("m", "r", *flags)])
    named = F.col("year").isNotNull() & F.col("key").isNotNull()
    years = keys.groupBy("kind", "year").agg(
        *[F.sum(c).alias(c) for c in ("m", "r", *flags)],
        total(F.col("r"), named & (F.col("m") == 0)).alias("ref_only"), total(F.col("m"), F.col("key").isNull() | (F.col("r") == 0)).alias("lacking"),
        F.max(named & (F.col("r") > 0)).alias("covered"), total(F.col("m"), F.col("m") > 1).alias("repeated"),
    )
    is_name = F.col("kind") == "name"
    return years.agg(
        total(F.col("m"), is_name).alias("master_rows"), total(F.col("missing_org")).alias("missing_org_rows"), total(F.col("missing_dept")).alias("missing_dept_rows"),
        total(F.col("bad_date")).alias("bad_date_rows"), F.array_join(F.sort_array(F.collect_set(F.when(is_name & (F.col("m") > 0), F.col("year")))), ",").alias("years"),
        total(F.col("repeated"), F.col("kind") == "id").alias("duplicate_emp_id_rows"), total(F.col("r")).alias("reference_roster_rows"),
        total(F.col("ref_only"), is_name).alias("mismatch_ref_only_rows"), total(F.col("lacking"), is_name & F.col("covered")).alias("mismatch_master_only_rows"),
    )


def reconciliation(estimate: DataFrame, truth: DataFrame) -> DataFrame:
    """estimate: active_all_snapshots, active_latest_people; truth: the active list. Both side by side with the gap."""
    return _gap(estimate.withColumn("ground_truth", truth.agg(F.count("*")).scalar()))


def reconciliation_of(master: DataFrame) -> DataFrame:
    """The same where the active list is the master's rows without an exit."""
    from .gold import headcount_and_list

    return _gap(headcount_and_list(master))


def _gap(both: DataFrame) -> DataFrame:
    return both.withColumn("gap", F.col("active_latest_people") - F.col("ground_truth"))
