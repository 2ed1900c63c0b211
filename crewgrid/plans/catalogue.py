"""Named queries of the workforce engine and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalars as S
from ..operators import canonical, classify, gold, qa, views
from ..sources import files, grid
from .adapters import MASTER_SQL, master, roster, scored, sheet_cells, table, whole_roster

#: The reference year of time-dependent figures, and the choices that filtered panels are shown with.
YEAR, ORGS = 1998, ("ASIA", "EUROPE")


def _active(m: DataFrame) -> DataFrame:
    return m.where("exit_date is null")


def _exited(m: DataFrame) -> DataFrame:
    return m.where("exit_date is not null")


def _alias(spark: SparkSession, d: str) -> DataFrame:
    """Every second nation has a standard name."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).where("n_nationkey % 2 = 0")
    return n.select(
        F.col("r_name").alias("raw_org"), F.col("n_name").alias("raw_dept"), F.concat(F.lit("STD "), "r_name").alias("std_org"),
        F.concat(F.lit("STD "), "n_name").alias("std_dept"), F.lit("").alias("note"),
    )


def _dates(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string")
    forms = [
        F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy.MM.dd"), F.date_format(day, "yyyyMMdd"), serial, F.concat(serial, F.lit(".0")),
        F.date_format(day, "yyyy/M/d"), F.lit("abc"), F.lit("1970-01-01"), F.date_format(day, "M/d/yyyy"), F.date_format(day, "yyyy년 M월 d일"), F.date_format(day, "MMM d yyyy"),
        F.date_format(day, "d MMMM yyyy"), F.date_format(day, "MMMM d, yyyy"), F.concat(serial, F.lit(".75")), F.date_format(day, "yyyy-MM-dd HH:mm:ss"), F.lit("13/13/2020"),
        F.date_format(day, "yyyy-MM-dd 'abc'"), F.date_format(day, "MMM d, yyyy 'xx'"), F.date_format(day, "MMM d, yyyy h:mm a"), F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    ]
    raw = F.element_at(F.array(*forms), (F.pmod("o_orderkey", F.lit(len(forms))) + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", S.to_date(raw).alias("day"))


def _text_normalise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(S.normalise("text")).alias("normalised"), S.key_of("source").alias("source_key"))


def _names(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    name = F.concat(F.lit("list_"), (F.col("p_size") + 1990).cast("string"), F.lit("0115 v"), F.col("p_partkey").cast("string"))
    return p.select("p_partkey", S.year_in(name).alias("year"), S.date_in(name).alias("day"), S.digits_year(F.concat(F.lit("y"), F.col("p_size").cast("string"))).alias("digits"))


def _org_split(spark: SparkSession, d: str) -> DataFrame:
    whole = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_brand", F.lit("-"), "p_type", F.lit("-x"))).when(F.col("p_partkey") % 3 == 1, F.concat("p_brand", F.lit("·"), "p_type"))
    org, dept = S.split_org(F.coalesce(whole, "p_type"))
    return table(spark, d, "part").select("p_partkey", org.alias("org"), dept.alias("dept"))


#: Sheet names, headers and the kind that the rules give them; at least one for each rule.
GOLDEN = [
    ("작성기준", ["사번", "입사일"], "skip"), ("Sheet2", ["a"], "skip"), ("Sheet1", ["조직도", "비고"], "org_chart"), ("Sheet1", ["성명", "휴대폰", "이메일"], "sensitive_drop"),
    ("Sheet1", ["사번", "성명", "입사일", "휴대폰", "이메일"], "master"), ("재직자", ["성명", "입사일"], "master"), ("2023", ["성명", "퇴사일"], "reference_roster"),
    ("2023", ["입사자", "퇴사자"], "reference_roster"), ("Sheet1", ["성명", "등급", "연봉"], "aux_pricing"), ("Sheet1", ["성명", "주민등록번호"], "aux_personalcard"),
    ("Sheet1", ["성명", "기술스택"], "aux_skill"), ("Sheet1", ["지원자", "전공"], "aux_recruit"), ("Sheet1", ["이름", "최종확정"], "aux_personalcard"),
    ("Sheet1", ["번호", "입사일"], "master"), ("Sheet1", ["항목", "비고"], "unknown"), ("Sheet1", [], "unknown"), ("Sheet1", ["", "항목"], "unknown"),
]


#: Of files: what stands before and after their number; the kind and what decides it, where that isn't the sheets; the kind that the name gives where
#: the sheets tell nothing, or, for old binary workbooks, always.
GOLDEN_FILES = [
    ("raw/f", ".xlsx", None, None, None), ("raw/unknown/f", ".xlsx", "unmatched_excel", "folder", None), ("raw/headcount/f", ".xlsx", "master_candidate", "folder", None),
    ("raw/Roster/f", ".xlsm", "aux_reference_roster", "folder", None), ("raw/skills/단가 f", ".xlsx", "aux_skill", "folder", "aux_pricing"),
    ("raw/evaluation/f", ".xls", "aux_personalcard", "folder", "unknown"), ("raw/조직도 f", ".xlsx", "org_chart", "name", "org_chart"),
    ("raw/연봉 f", ".xls", "aux_pricing", "name", "aux_pricing"), ("raw/f", ".xls", "master_candidate", "default", "unknown"),
    ("raw/인력등급표 f", ".xls", "master_candidate", "default", "master"), ("raw/인사평가 f", ".xls", "master_candidate", "default", "aux_personalcard"),
    ("raw/명단 f", ".XLS", "master_candidate", "default", "reference_roster"), ("raw/투입 채용 f", ".xls", "aux_recruit", "name", "aux_recruit"),
    ("raw/pricing/f", ".xlsx", "aux_pricing", "folder", None), ("raw/sensitive/f", ".xlsx", "sensitive_drop", "folder", None), ("raw/org_chart/f", ".xlsx", "org_chart", "folder", None),
    ("raw/recruit/f", ".xlsx", "aux_recruit", "folder", None), ("raw/연락망 f", ".xlsx", "sensitive_drop", "name", "sensitive_drop"),
]


def _sheets(spark: SparkSession, d: str) -> DataFrame:
    """Every part as a sheet with one of the golden names and headers; four to a file, in golden places."""
    sheets = F.array(*[F.lit(s) for s, _, _ in GOLDEN])
    columns = F.array(*[F.array(*[F.lit(c) for c in cs]).cast("array<string>") for _, cs, _ in GOLDEN])
    at = (F.pmod("p_partkey", F.lit(len(GOLDEN))) + 1).cast("int")
    p = table(spark, d, "part").select("p_partkey", F.element_at(sheets, at).alias("sheet"), F.element_at(columns, at).alias("columns"))
    number = F.floor(F.col("p_partkey") / 4)
    of = lambda i: F.element_at(F.array(*[F.lit(g[i]) for g in GOLDEN_FILES]), (F.pmod(number, F.lit(len(GOLDEN_FILES))) + 1).cast("int"))
    file = F.concat(of(0), number.cast("string"), of(1))
    return p.select("p_partkey", file.alias("file"), "sheet", classify.sheet_kind(F.col("sheet"), F.col("columns")).alias("kind"))


def _sheet_choice(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    sizes = c.groupBy("n_regionkey", "n_nationkey", "n_name").agg(F.count("*").alias("rows"))
    prefix = F.element_at(F.array(F.lit("재직 "), F.lit("퇴사 "), F.lit("기타 "), F.lit("설문 ")), (F.col("n_nationkey") % 4 + 1).cast("int"))
    sheets = sizes.select(F.col("n_regionkey").cast("string").alias("file"), F.concat(prefix, "n_name").alias("sheet"), F.col("n_nationkey").alias("sheet_idx"), "rows")
    return classify.best_sheets(sheets)


def _header_rows(spark: SparkSession, d: str) -> DataFrame:
    cells = sheet_cells(spark, d)
    at = grid.header_by_share(cells)
    found = grid.headers(cells, at).join(at, grid.SHEET)
    return found.select("sheet", F.col("header_row").cast("long").alias("header_row"), F.col("rows").cast("long").alias("n_rows"), F.array_join("columns", ",").alias("columns"))


def _scan(spark: SparkSession, d: str) -> DataFrame:
    return grid.scan_sheets(sheet_cells(spark, d)).groupBy("kind").agg(F.count("*").alias("sheets"), F.sum("rows").alias("n_rows"))


def _manifest(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, d, "part")
    day = F.lit("2024-01-01 00:00:00").cast("timestamp")
    both = p.select(F.concat(F.lit("raw/"), "p_name", F.lit("/"), F.col("p_partkey").cast("string")).alias("path"), "p_partkey", F.col("p_size").cast("long").alias("size"), day.alias("mtime"), F.sha1("p_brand").alias("sha1"))
    now = both.where("p_partkey % 7 <> 0").withColumn("size", F.when(F.col("p_partkey") % 5 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return now.drop("p_partkey"), both.where("p_partkey % 11 <> 0").drop("p_partkey")


def _files_diff(spark: SparkSession, d: str) -> DataFrame:
    return files.diff(*_manifest(spark, d))


def _files_upsert(spark: SparkSession, d: str) -> DataFrame:
    now, old = _manifest(spark, d)
    return files.upsert(old, now).agg(F.count("*").alias("n"), F.sum("size").alias("size"))


def _filtered_yearly(spark: SparkSession, d: str) -> DataFrame:
    yearly = gold.turnover_yearly(views.apply_filter(master(spark, d), orgs=ORGS))
    return gold.running_floored(views.apply_filter(yearly, 1997, 2001), "year")


def _dept_rates(spark: SparkSession, d: str) -> DataFrame:
    m = master(spark, d)
    by_dept = gold.flow(gold.events(m, "org", "dept"), "org", "dept")
    return gold.dept_rates(by_dept, _active(m))


def _turnover_rates(spark: SparkSession, d: str) -> DataFrame:
    m = master(spark, d)
    return gold.turnover_rates(gold.turnover_yearly(m), _active(m).agg((F.count("*") / 2).alias("average")).scalar())


def _dept_monthly_trimmed(spark: SparkSession, d: str) -> DataFrame:
    """Months of each dept, and the same 24 months earlier, most of which are before its first."""
    m = master(spark, d)
    months = gold.dept_monthly(m)
    return gold.trim_before_first_seen(months.unionByName(months.withColumn("month", F.add_months("month", -24))), m)


_M: dict[str, Callable[[DataFrame], DataFrame]] = {
    "turnover_yearly": lambda m: gold.turnover_yearly(m).orderBy("year"),
    "monthly_flow": lambda m: gold.monthly(m).orderBy("month"),
    "dept_monthly_flow": lambda m: gold.dept_monthly(m).orderBy("org", "dept", "month"),
    "early_exit_30d": lambda m: gold.in_order(gold.early_exits(m)),
    "headcount_est": gold.headcount,
    "dedup_master": lambda m: canonical.deduplicate(m, "order_key"),
    "latest_snapshot_people": lambda m: canonical.latest_people(m, "order_key"),
    "latest_per_name": lambda m: canonical.latest_by_name(m, "join_date", "order_key"),
    "qa_counters": qa.counters,
    "running_monthly": lambda m: gold.running_floored(gold.monthly(m), "month"),
    "monthly_hires_exits": lambda m: gold.monthly_hires_exits(*[x.withColumns({c: F.add_months(c, 72) for c in ("join_date", "exit_date")}) for x in (_active(m), _exited(m))]),
    "early_exit_by_dept": lambda m: gold.early_exit_by_dept(_exited(m).withColumns({c: F.date_add(c, 2557) for c in ("join_date", "exit_date")}), 60),
    "dept_monthly_counts": lambda m: gold.dept_monthly_counts(_active(m), _exited(m).drop("dept")),
    "org_headcount": lambda m: views.org_headcount(m).orderBy(F.desc("people"), "org"),
    "dept_headcount": lambda m: views.dept_headcount(m, ORGS),
    "early_exit_monthly": lambda m: views.early_by_month(gold.early_exits(m)),
    "kpi_bundle": lambda m: views.kpis_of(m, YEAR),
    "peak_exit_year": lambda m: views.peak_exit_year(gold.turnover_yearly(m)),
    "filter_domains": lambda m: views.domains(m, ORGS),
    "default_period": lambda m: views.default_period(gold.turnover_yearly(m)),
    "last_12_months": lambda m: views.last_months(gold.monthly(m)),
    "dept_detail_300": lambda m: views.dept_detail(gold.dept_monthly(m)),
    "monthly_net_sign": lambda m: views.net_sign(gold.monthly(m)),
    "monthly_display": lambda m: views.display_names(gold.monthly(m).orderBy("month")),
    "missing_dept": lambda m: canonical.missing_dept(m.withColumn("dept", F.when(F.col("order_key") % 50 == 0, F.lit(None)).when(F.col("order_key") % 51 == 0, " ").otherwise(F.col("dept")))),
    "dept_fix": lambda m: canonical.fix_dept(m, " Customer#000000007 ", "MOVED").groupBy("dept").agg(F.count("*").alias("n")),
}


def _over_master(f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: f(master(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _over_master(f) for k, f in _M.items()}
    return out | {
        "alias_apply": lambda s, d: canonical.apply_alias(master(s, d), _alias(s, d)).groupBy("org", "dept").agg(F.count("*").alias("n")),
        "alias_missing": lambda s, d: canonical.alias_missing(master(s, d), _alias(s, d)),
        "qa_ref_only": lambda s, d: qa.ref_only(master(s, d), roster(s, d)),
        "qa_master_only": lambda s, d: qa.master_only(master(s, d), roster(s, d)),
        "qa_report": lambda s, d: qa.report(master(s, d), roster(s, d)),
        "headcount_reconciliation": lambda s, d: qa.reconciliation_of(master(s, d)),
        "turnover_pivot": lambda s, d: gold.turnover_pivot(whole_roster(s, d)),
        "roster_distinct": whole_roster,
        "turnover_rates": _turnover_rates,
        "dept_rates": _dept_rates,
        "dept_trim_first_seen": _dept_monthly_trimmed,
        "filtered_yearly": _filtered_yearly,
        "risk_buckets": lambda s, d: views.risk_buckets(scored(s, d)),
        "risk_ordered": lambda s, d: views.risk_ordered(scored(s, d), "emp_id"),
        "risk_top20": lambda s, d: views.risk_top(scored(s, d), 20, "emp_id"),
        "date_coerce": _dates,
        "text_normalise": _text_normalise,
        "year_from_name": _names,
        "org_split": _org_split,
        "sheet_classify": lambda s, d: _sheets(s, d).groupBy("sheet", "kind").agg(F.count("*").alias("n")),
        "file_kinds": lambda s, d: classify.file_kinds(_sheets(s, d)),
        "sort_plan": lambda s, d: classify.sort_plan(_sheets(s, d)),
        "best_sheet": _sheet_choice,
        "header_row": _header_rows,
        "sheet_scan": _scan,
        "incremental_diff": _files_diff,
        "manifest_upsert": _files_upsert,
    }


def _sql(body: str, *more: str) -> str:
    return f"WITH {', '.join([MASTER_SQL, *more])} {body}"


_EVENTS = """
ev AS (SELECT *, 'hire' AS kind, join_date AS day FROM master WHERE join_date IS NOT NULL
       UNION ALL SELECT *, 'exit', exit_date FROM master WHERE exit_date IS NOT NULL)"""
_HE = "count(*) FILTER (WHERE kind = 'hire') AS hires, count(*) FILTER (WHERE kind = 'exit') AS exits"
_YEARLY = f"yearly AS (SELECT CAST(year(day) AS BIGINT) AS year, {_HE} FROM ev GROUP BY 1)"
_MONTHLY = f"monthly AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, {_HE} FROM ev GROUP BY 1)"
_DEPT = f"dept_monthly AS (SELECT org, dept, CAST(date_trunc('month', day) AS DATE) AS month, {_HE} FROM ev GROUP BY ALL)"
_EARLY = "early AS (SELECT *, date_diff('day', join_date, exit_date) AS tenure_days FROM master WHERE date_diff('day', join_date, exit_date) BETWEEN 0 AND 30)"
_LAST = "last AS (SELECT max(snapshot_year) AS y FROM master)"
_ORGS = ", ".join(f"'{o}'" for o in ORGS)
_LISTED = """
roster AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_orderkey % 2 = 0 THEN 'hire' ELSE 'exit' END AS type,
         CASE WHEN o_orderkey % 97 = 0 THEN 'Guest ' || o_custkey ELSE printf('Customer#%09d', o_custkey) END AS name, 'roster' AS source_file, o_orderstatus AS sheet
  FROM orders{where})"""
_ROSTER, _WHOLE_ROSTER = _LISTED.format(where=" WHERE year(o_orderdate) BETWEEN 1996 AND 1999 AND o_orderkey % 4 <> 0"), _LISTED.format(where="")
_REF_ONLY = "ref_only AS (SELECT r.* FROM roster r WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.snapshot_year = r.year AND m.name = r.name))"
_MASTER_ONLY = """
master_only AS (SELECT snapshot_year, emp_id, name, org, dept, data_source, sheet_name FROM master m
  WHERE snapshot_year IN (SELECT year FROM roster) AND NOT EXISTS (SELECT 1 FROM roster r WHERE m.snapshot_year = r.year AND m.name = r.name))"""
_COUNTERS = """
counters AS (SELECT count(*) AS master_rows, count(*) FILTER (WHERE org IS NULL) AS missing_org_rows, count(*) FILTER (WHERE dept IS NULL) AS missing_dept_rows,
  count(*) FILTER (WHERE join_date > exit_date) AS bad_date_rows, array_to_string(list_sort(list(DISTINCT snapshot_year)), ',') AS years,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM master GROUP BY emp_id) WHERE n > 1) AS duplicate_emp_id_rows FROM master)"""
_COLUMNS = "emp_id, name, org, dept, title, grade, join_date, exit_date, snapshot_year, data_source, sheet_name, order_key"
_HEADCOUNT = """
headcount AS (SELECT count(name) AS active_all_snapshots, count(DISTINCT emp_id) FILTER (WHERE snapshot_year = y) AS active_latest_people
  FROM master, last WHERE exit_date IS NULL OR exit_date > make_date(y, 12, 31))"""
_FILES = """
b AS (SELECT 'raw/' || p_name || '/' || p_partkey AS path, p_partkey AS k, CAST(p_size AS BIGINT) AS size FROM part),
cur AS (SELECT path, CASE WHEN k % 5 = 0 THEN size + 1 ELSE size END AS size FROM b WHERE k % 7 <> 0), old AS (SELECT path, size FROM b WHERE k % 11 <> 0)"""
_GOLDEN_ROWS = ", ".join(f"({i}, '{s}', '{k}')" for i, (s, _, k) in enumerate(GOLDEN))
_FILE_ROWS = ", ".join("(" + ", ".join([str(i), *("NULL" if x is None else f"'{x}'" for x in row)]) + ")" for i, row in enumerate(GOLDEN_FILES))
_SHEETS = f"""
golden AS (SELECT * FROM (VALUES {_GOLDEN_ROWS}) AS t(i, sheet, kind)),
places AS (SELECT * FROM (VALUES {_FILE_ROWS}) AS t(k, before, after, given, decided, named)),
sheets AS (SELECT before || (p_partkey // 4) || after AS file, sheet, kind, k FROM part JOIN golden ON i = p_partkey % {len(GOLDEN)} JOIN places ON k = (p_partkey // 4) % {len(GOLDEN_FILES)})"""
_RANK = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(K.KINDS)) + f" ELSE {len(K.KINDS)} END"
_BEST = f"best AS (SELECT file, k, arg_min(kind, ({_RANK}, kind)) AS kind FROM sheets GROUP BY file, k)"
_ALIAS_SQL = """
alias AS (SELECT r_name AS raw_org, n_name AS raw_dept, 'STD ' || r_name AS std_org, 'STD ' || n_name AS std_dept
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0)"""


def oracle_sql() -> dict[str, str]:
    white = r"[\t\n\v\f\r\x{85}\p{Z}]"
    normalised = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '{white}+', ' ', 'g'))"
    running = "greatest(CAST(sum(hires - exits) OVER (ORDER BY {k} ROWS UNBOUNDED PRECEDING) AS BIGINT), 0) AS total"
    return {
        "turnover_yearly": _sql("SELECT *, hires - exits AS net FROM yearly", _EVENTS, _YEARLY),
        "monthly_flow": _sql("SELECT *, hires - exits AS net FROM monthly", _EVENTS, _MONTHLY),
        "dept_monthly_flow": _sql("SELECT * FROM dept_monthly", _EVENTS, _DEPT),
        "early_exit_30d": _sql("SELECT * FROM early", _EARLY),
        "headcount_est": _sql("SELECT * FROM headcount", _LAST, _HEADCOUNT),
        "dedup_master": _sql(
            f"""SELECT {_COLUMNS} FROM master QUALIFY row_number() OVER (PARTITION BY emp_id, snapshot_year ORDER BY
                (CASE WHEN exit_date IS NULL THEN 0 ELSE 100 END) DESC, exit_date DESC NULLS LAST, join_date DESC NULLS LAST, order_key) = 1"""
        ),
        "latest_snapshot_people": _sql(
            f"""SELECT {_COLUMNS} FROM master, last WHERE snapshot_year = y AND (exit_date IS NULL OR exit_date > make_date(y, 12, 31))
                QUALIFY row_number() OVER (PARTITION BY emp_id ORDER BY order_key) = 1""",
            _LAST,
        ),
        "latest_per_name": _sql(f"SELECT {_COLUMNS} FROM master QUALIFY row_number() OVER (PARTITION BY name ORDER BY join_date DESC NULLS LAST, order_key) = 1"),
        "qa_counters": _sql("SELECT * FROM counters", _COUNTERS),
        "running_monthly": _sql(f"SELECT month, hires, exits, hires - exits AS net, {running.format(k='month')} FROM monthly", _EVENTS, _MONTHLY),
        "monthly_hires_exits": _sql(
            f"""SELECT period, hires, exits, hires - exits AS net, CAST(sum(hires - exits) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS BIGINT) AS headcount
                FROM (SELECT strftime(day + INTERVAL 72 MONTH, '%Y-%m') AS period, {_HE} FROM ev WHERE CAST(day + INTERVAL 72 MONTH AS DATE) >= DATE '{K.FOUNDED}' GROUP BY 1)""",
            _EVENTS,
        ),
        "early_exit_by_dept": _sql(
            f"""SELECT dept AS "group", count(*) AS early_exit_60d FROM master WHERE date_diff('day', join_date, exit_date) BETWEEN 0 AND 60
                AND join_date + 2557 >= DATE '{K.FOUNDED}' GROUP BY 1"""
        ),
        "dept_monthly_counts": _sql(
            f"""SELECT org, d AS dept, strftime(day, '%Y-%m') AS period, {_HE}
                FROM (SELECT org, kind, day, CASE WHEN exit_date IS NULL THEN dept ELSE '{K.UNKNOWN_LABEL}' END AS d FROM ev) GROUP BY ALL""",
            _EVENTS,
        ),
        "org_headcount": _sql("SELECT org, count(*) AS people FROM master WHERE exit_date IS NULL GROUP BY 1"),
        "dept_headcount": _sql(f"SELECT dept, count(*) AS people FROM master WHERE exit_date IS NULL AND org IN ({_ORGS}) GROUP BY 1"),
        "early_exit_monthly": _sql("SELECT CAST(date_trunc('month', exit_date) AS DATE) AS month, count(*) AS early_exits FROM early GROUP BY 1", _EARLY),
        "kpi_bundle": _sql(
            f"""SELECT year, total, hires, exits, early, exit_rate, round_even(CASE WHEN before > 0 THEN (hires - before) / before * 100.0 END, 1) AS hires_growth,
                       CASE WHEN exit_rate >= {K.EXIT_RATE_BAD} THEN 'exit' WHEN exit_rate >= {K.EXIT_RATE_WARN} THEN 'warn' ELSE 'ok' END AS rate_level,
                       CASE WHEN early > {K.EARLY_WARN} THEN 'warn' ELSE 'ok' END AS early_level
                FROM (SELECT *, round_even(CASE WHEN total > 0 THEN exits / total * 100.0 ELSE 0.0 END, 1) AS exit_rate
                      FROM (SELECT CAST({YEAR} AS BIGINT) AS year, (SELECT count(*) FROM master WHERE exit_date IS NULL) AS total,
                                   (SELECT CAST(coalesce(sum(hires), 0) AS BIGINT) FROM yearly WHERE year = {YEAR}) AS hires,
                                   (SELECT CAST(coalesce(sum(exits), 0) AS BIGINT) FROM yearly WHERE year = {YEAR}) AS exits,
                                   (SELECT CAST(coalesce(sum(hires), 0) AS BIGINT) FROM yearly WHERE year = {YEAR - 1}) AS before,
                                   (SELECT count(*) FROM early) AS early))""",
            _EVENTS, _YEARLY, _EARLY,
        ),
        "peak_exit_year": _sql("SELECT year, exits FROM yearly ORDER BY exits DESC, year LIMIT 1", _EVENTS, _YEARLY),
        "filter_domains": _sql(
            f"""SELECT DISTINCT 'year' AS kind, CAST(snapshot_year AS VARCHAR) AS value FROM master UNION SELECT 'org', org FROM master
                UNION SELECT 'dept', dept FROM master WHERE org IN ({_ORGS})"""
        ),
        "default_period": _sql('SELECT greatest(min(year), max(year) - 4) AS "first", max(year) AS "last" FROM yearly', _EVENTS, _YEARLY),
        "last_12_months": _sql("SELECT month, hires, exits, hires - exits AS net, strftime(month, '%y.%m') AS label FROM monthly ORDER BY month DESC LIMIT 12", _EVENTS, _MONTHLY),
        "dept_detail_300": _sql("SELECT * FROM dept_monthly ORDER BY org, dept, month LIMIT 300", _EVENTS, _DEPT),
        "monthly_net_sign": _sql(
            "SELECT month, hires, exits, hires - exits AS net, CASE WHEN hires > exits THEN 'up' WHEN hires < exits THEN 'down' ELSE 'even' END AS sign FROM monthly", _EVENTS, _MONTHLY
        ),
        "monthly_display": _sql('SELECT month AS "월", hires AS "입사", exits AS "퇴사", hires - exits AS "순증" FROM monthly', _EVENTS, _MONTHLY),
        "missing_dept": _sql(
            f"""SELECT * REPLACE (CASE WHEN order_key % 50 = 0 THEN NULL ELSE ' ' END AS dept) FROM (SELECT {_COLUMNS} FROM master WHERE order_key % 50 = 0 OR order_key % 51 = 0)"""
        ),
        "dept_fix": _sql("SELECT CASE WHEN name = 'Customer#000000007' THEN 'MOVED' ELSE dept END AS dept, count(*) AS n FROM master GROUP BY 1"),
        "alias_apply": _sql(
            "SELECT coalesce(std_org, org) AS org, coalesce(std_dept, dept) AS dept, count(*) AS n FROM master LEFT JOIN alias ON org = raw_org AND dept = raw_dept GROUP BY ALL", _ALIAS_SQL
        ),
        "alias_missing": _sql("SELECT DISTINCT org, dept FROM master WHERE NOT EXISTS (SELECT 1 FROM alias WHERE org = raw_org AND dept = raw_dept)", _ALIAS_SQL),
        "qa_ref_only": _sql("SELECT * FROM ref_only", _ROSTER, _REF_ONLY),
        "qa_master_only": _sql("SELECT * FROM master_only", _ROSTER, _MASTER_ONLY),
        "qa_report": _sql(
            """SELECT counters.*, (SELECT count(*) FROM roster) AS reference_roster_rows, (SELECT count(*) FROM ref_only) AS mismatch_ref_only_rows,
                      (SELECT count(*) FROM master_only) AS mismatch_master_only_rows FROM counters""",
            _ROSTER, _REF_ONLY, _MASTER_ONLY, _COUNTERS,
        ),
        "headcount_reconciliation": _sql(
            "SELECT headcount.*, t AS ground_truth, active_latest_people - t AS gap FROM headcount, (SELECT count(*) AS t FROM master WHERE exit_date IS NULL)", _LAST, _HEADCOUNT
        ),
        "turnover_pivot": f"WITH {_WHOLE_ROSTER} SELECT year, h AS hires, e AS exits, h - e AS net FROM (SELECT year, count(*) FILTER (WHERE type = 'hire') AS h, count(*) FILTER (WHERE type = 'exit') AS e FROM roster GROUP BY 1)",
        "roster_distinct": f"WITH {_WHOLE_ROSTER} SELECT * FROM roster",
        "turnover_rates": _sql(
            "SELECT year, hires, exits, hires - exits AS net, CASE WHEN a > 0 THEN exits / a * 100.0 ELSE 0.0 END AS turnover_rate FROM yearly, (SELECT count(*) / 2 AS a FROM master WHERE exit_date IS NULL)",
            _EVENTS, _YEARLY,
        ),
        "dept_rates": _sql(
            f"""SELECT c.org, c.dept, hires, exits, coalesce(n, 0) AS headcount, CASE WHEN n > 0 THEN hires / n * 100.0 ELSE 0.0 END AS hire_rate,
                       CASE WHEN n > 0 THEN exits / n * 100.0 ELSE 0.0 END AS exit_rate
                FROM (SELECT org, dept, {_HE} FROM ev GROUP BY ALL) c
                LEFT JOIN (SELECT org, dept, count(*) AS n FROM master WHERE exit_date IS NULL GROUP BY ALL) h ON c.org = h.org AND c.dept = h.dept""",
            _EVENTS,
        ),
        "dept_trim_first_seen": _sql(
            """SELECT a.* FROM (SELECT * FROM dept_monthly UNION ALL SELECT * REPLACE (CAST(month - INTERVAL 24 MONTH AS DATE) AS month) FROM dept_monthly) a
               JOIN (SELECT org, dept, least(CAST(date_trunc('month', min(join_date)) AS DATE), make_date(min(snapshot_year), 1, 1)) AS f FROM master GROUP BY ALL) s
               ON a.org = s.org AND a.dept = s.dept WHERE month >= f""",
            _EVENTS, _DEPT,
        ),
        "filtered_yearly": _sql(
            f"SELECT year, hires, exits, hires - exits AS net, {running.format(k='year')} FROM (SELECT CAST(year(day) AS BIGINT) AS year, {_HE} FROM ev WHERE org IN ({_ORGS}) GROUP BY 1) WHERE year BETWEEN 1997 AND 2001",
            _EVENTS,
        ),
        "risk_buckets": f"SELECT count(*) FILTER (WHERE s >= {K.RISK_HIGH}) AS high, count(*) FILTER (WHERE s >= {K.RISK_MID} AND s < {K.RISK_HIGH}) AS mid, count(*) AS total FROM (SELECT (c_acctbal + 1000) / 110 AS s FROM customer)",
        "risk_ordered": "SELECT c_custkey AS emp_id, c_name AS name, (c_acctbal + 1000) / 110 AS attrition_risk_score FROM customer",
        "risk_top20": f"""SELECT emp_id, name, s AS attrition_risk_score, round_even(s, 1) AS label, CASE WHEN s >= {K.RISK_HIGH} THEN 'high' WHEN s >= {K.RISK_MID} THEN 'mid' ELSE 'low' END AS level
            FROM (SELECT c_custkey AS emp_id, c_name AS name, (c_acctbal + 1000) / 110 AS s FROM customer) ORDER BY s DESC, emp_id LIMIT 20""",
        "date_coerce": "SELECT o_orderkey, CASE WHEN o_orderkey % 20 NOT IN (6, 7, 15, 16, 17) THEN CAST(o_orderdate AS DATE) END AS day FROM orders",
        "text_normalise": f"SELECT doc_id, md5({normalised('text')}) AS normalised, lower(regexp_replace({normalised('source')}, '[\\s()\\[\\]{{}}_:-]', '', 'g')) AS source_key FROM documents",
        "year_from_name": "SELECT p_partkey, CAST(p_size + 1990 AS INTEGER) AS year, (p_size + 1990) || '0115' AS day, CAST(p_size AS INTEGER) AS digits FROM part",
        "org_split": """SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN p_brand ELSE p_type END AS org,
            CASE p_partkey % 3 WHEN 0 THEN p_type || '-x' WHEN 1 THEN p_type END AS dept FROM part""",
        "sheet_classify": f"WITH {_SHEETS} SELECT sheet, kind, count(*) AS n FROM sheets GROUP BY ALL",
        "file_kinds": f"""WITH {_SHEETS}, {_BEST} SELECT file, coalesce(given, CASE kind WHEN 'master' THEN 'master_candidate' WHEN 'reference_roster' THEN 'aux_reference_roster'
            WHEN 'skip' THEN 'unmatched_excel' WHEN 'unknown' THEN 'master_candidate' ELSE kind END) AS kind, coalesce(decided, 'content') AS decided_by FROM best JOIN places USING (k)""",
        "sort_plan": f"""WITH {_SHEETS}, {_BEST}, k AS (SELECT file, CASE WHEN lower(after) = '.xls' THEN named WHEN kind IN ('unknown', 'skip') THEN coalesce(named, 'unknown') ELSE kind END AS kind FROM best JOIN places USING (k))
            SELECT file, kind, CASE kind {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in K.FOLDERS.items())} END AS folder FROM k""",
        "best_sheet": """
            WITH s AS (SELECT CAST(n_regionkey AS VARCHAR) AS file, ['재직 ', '퇴사 ', '기타 ', '설문 '][n_nationkey % 4 + 1] || n_name AS sheet, n_nationkey AS i, n_nationkey % 4 AS t, count(*) AS n
                       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
            x AS (SELECT file, sheet, 'exited' AS role FROM s WHERE t = 1 QUALIFY row_number() OVER (PARTITION BY file ORDER BY n DESC, i) = 1),
            a AS (SELECT file, sheet, 'active' AS role FROM s WHERE (file, sheet) NOT IN (SELECT file, sheet FROM x)
                  QUALIFY row_number() OVER (PARTITION BY file ORDER BY CASE WHEN t = 0 THEN 0 ELSE 1 END, n DESC, i) = 1),
            v AS (SELECT file, sheet, 'survey' AS role FROM s WHERE t = 3 QUALIFY row_number() OVER (PARTITION BY file ORDER BY i) = 1)
            SELECT * FROM x UNION ALL SELECT * FROM a UNION ALL SELECT * FROM v""",
        "header_row": "SELECT n_name AS sheet, CAST(n_nationkey % 4 AS BIGINT) AS header_row, count(*) AS n_rows, '사번,성명,입사일,금액' AS columns FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL",
        "sheet_scan": "SELECT 'master' AS kind, count(DISTINCT s_nationkey) AS sheets, count(*) AS n_rows FROM supplier",
        "incremental_diff": f"""WITH {_FILES} SELECT coalesce(cur.path, old.path) AS path,
            CASE WHEN cur.path IS NULL THEN 'deleted' WHEN old.path IS NULL THEN 'new' WHEN cur.size = old.size THEN 'unchanged' ELSE 'changed' END AS status
            FROM cur FULL JOIN old ON cur.path = old.path""",
        "manifest_upsert": f"WITH {_FILES} SELECT count(*) AS n, CAST(sum(size) AS BIGINT) AS size FROM (SELECT * FROM cur UNION ALL SELECT * FROM old WHERE path NOT IN (SELECT path FROM cur))",
    }
