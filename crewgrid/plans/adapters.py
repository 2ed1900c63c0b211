"""Order tables as personnel tables, so that every query can run on generated data of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's order is a snapshot row: placed is joined, first shipped (of finished orders) is left. With order_key to break ties."""
    orders = table(spark, sf_dir, "orders")
    finished = orders.where("o_orderstatus = 'F'").select("o_orderkey")
    shipped = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").join(finished, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    shipped = shipped.groupBy("l_orderkey").agg(F.min("l_shipdate").cast("date").alias("exit_date"))
    people = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    rows = orders.join(people, F.col("o_custkey") == F.col("c_custkey")).join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.select(
        F.col("o_custkey").cast("string").alias("emp_id"), F.col("c_name").alias("name"), F.col("r_name").alias("org"), F.col("n_name").alias("dept"),
        F.col("c_mktsegment").alias("title"), F.col("o_orderpriority").alias("grade"), F.col("o_orderdate").cast("date").alias("join_date"), "exit_date",
        F.year("o_orderdate").alias("snapshot_year"), F.col("o_orderstatus").alias("data_source"), F.lit("orders").alias("sheet_name"), F.col("o_orderkey").alias("order_key"),
    )


MASTER_SQL = """
master AS (
  SELECT CAST(o_custkey AS VARCHAR) AS emp_id, c_name AS name, r_name AS org, n_name AS dept, c_mktsegment AS title, o_orderpriority AS grade,
         CAST(o_orderdate AS DATE) AS join_date, CASE WHEN o_orderstatus = 'F' THEN shipped END AS exit_date, CAST(year(o_orderdate) AS INTEGER) AS snapshot_year,
         o_orderstatus AS data_source, 'orders' AS sheet_name, o_orderkey AS order_key
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS shipped FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An independent list, for reconciliation: it covers the years 1996 to 1999, lacks every fourth order there and has some people of its own."""
    return _listed(table(spark, sf_dir, "orders").where("year(o_orderdate) between 1996 and 1999 and o_orderkey % 4 <> 0"))


def whole_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an entry of a hire and exit list."""
    return _listed(table(spark, sf_dir, "orders"))


def _listed(rows: DataFrame) -> DataFrame:
    name = F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit("Guest "), F.col("o_custkey").cast("string"))).otherwise(F.format_string("Customer#%09d", "o_custkey"))
    kind = F.when(F.col("o_orderkey") % 2 == 0, "hire").otherwise("exit")
    return rows.select(F.year("o_orderdate").alias("year"), kind.alias("type"), name.alias("name"), F.lit("roster").alias("source_file"), F.col("o_orderstatus").alias("sheet")).distinct()


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a risk score from 0 to 100."""
    score = (F.col("c_acctbal") + 1000) / 110
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("emp_id"), F.col("c_name").alias("name"), score.alias("attrition_risk_score"))


def sheet_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as sheets, one a nation: title rows with one cell, a header, then data."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.withColumn("place", F.row_number().over(W.partitionBy("n_nationkey").orderBy("s_suppkey")))
    key = [F.lit("suppliers.xlsx").alias("file"), F.col("n_name").alias("sheet"), F.col("n_nationkey").cast("int").alias("sheet_idx")]

    def spread(row, values):
        cells = F.posexplode(F.array(*values))
        return [*key, row.alias("row_idx"), cells.alias("col_idx", "value")]

    titles = F.col("n_nationkey") % 4
    data = s.select(*spread((titles + F.col("place")).cast("int"), [F.col("s_suppkey").cast("string"), F.col("s_name"), F.lit("2020.01.15"), F.col("s_acctbal").cast("string")]))
    each = s.select("n_name", "n_nationkey").distinct()
    head = each.select(*spread(titles.cast("int"), [F.lit("사번"), F.lit("성명"), F.lit("입사일"), F.lit("금액")]))
    top = each.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(2)))).where(F.col("t") < titles).select(*spread(F.col("t").cast("int"), [F.lit("Title"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("")]))
    return data.unionByName(head).unionByName(top)
