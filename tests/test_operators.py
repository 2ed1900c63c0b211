from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crewgrid.operators import canonical, classify, gold, qa, views
from crewgrid.plans.catalogue import GOLDEN
from crewgrid.schema import MASTER
from tests.conftest import rows

D = date


def person(emp=None, name=None, org=None, dept=None, title=None, grade=None, join=None, left=None, year=None):
    return (emp, name, org, dept, title, grade, join, left, year, "f.xlsx", "s")


def test_dedup_keeps_the_best(spark):
    m = spark.createDataFrame(
        [
            person("1", "A", "o", "d", "t", "g", D(2020, 1, 1), None, 2023), person("1", "A", None, "d", None, None, D(2020, 1, 1), D(2023, 5, 1), 2023),
            person("1", "A", "o", "d", None, None, D(2020, 1, 1), None, 2024), person(None, "B", join=D(2021, 1, 1), year=2023), person(None, "B", join=D(2022, 1, 1), year=2023),
            person(None, "C"), person(None, "C"),
        ],
        MASTER,
    )
    out = rows(canonical.deduplicate(m).select("name", "snapshot_year", "join_date", "exit_date"))
    assert out == sorted([("A", 2023, D(2020, 1, 1), D(2023, 5, 1)), ("A", 2024, D(2020, 1, 1), None), ("B", 2023, D(2022, 1, 1), None), ("C", None, None, None)], key=repr)


def test_reconciliation(spark):
    m = spark.createDataFrame([person("1", "A", year=2023), person("2", "B", year=2023), person("3", "D", year=2024)], MASTER)
    r = spark.createDataFrame([(2023, "hire", "B"), (2023, "hire", "C"), (2024, "hire", None)], "year int, type string, name string")
    assert rows(qa.ref_only(m, r).select("year", "name")) == [(2023, "C")]
    assert rows(qa.master_only(m, r).select("snapshot_year", "name")) == [(2023, "A")]
    assert qa.report(m, r).first().asDict() == {
        "master_rows": 3, "missing_org_rows": 3, "missing_dept_rows": 3, "bad_date_rows": 0, "years": "2023,2024", "duplicate_emp_id_rows": 0,
        "reference_roster_rows": 3, "mismatch_ref_only_rows": 1, "mismatch_master_only_rows": 1,
    }


def test_sheet_kinds(spark):
    df = spark.createDataFrame([(i, s, c, k) for i, (s, c, k) in enumerate(GOLDEN)], "i int, s string, c array<string>, k string")
    assert [(r.s, r.c, r.got) for r in df.select("*", classify.sheet_kind(F.col("s"), F.col("c")).alias("got")).where("got <> k").collect()] == []


def test_file_kinds_and_plans(spark):
    s = spark.createDataFrame(
        [("raw/roster/a.xlsx", "master"), ("raw/단가표.xlsx", "master"), ("raw/b.xlsx", "aux_skill"), ("raw/b.xlsx", "unknown"), ("raw/c.xls", "unknown"), ("raw/d.xlsx", "skip")], "file string, kind string"
    )
    assert {r.file: (r.kind, r.decided_by) for r in classify.file_kinds(s).collect()} == {
        "raw/roster/a.xlsx": ("aux_reference_roster", "folder"), "raw/단가표.xlsx": ("aux_pricing", "name"), "raw/b.xlsx": ("aux_skill", "content"),
        "raw/c.xls": ("master_candidate", "default"), "raw/d.xlsx": ("unmatched_excel", "content"),
    }
    assert {r.file: r.folder for r in classify.sort_plan(s).collect()}["raw/b.xlsx"] == "skills"
    assert spark.range(1).select(classify.bump_version(F.lit("v1.9"))).first()[0] == "v1.10"


def test_columns():
    assert canonical.find_column(["사 번", "이름"], ["emp_id", "사번"]) == "사 번"
    assert canonical.find_column(["팀장 이름"], ["이름"]) == "팀장 이름"
    assert canonical.sensitive(["번호", "주민등록번호", "E-Mail 주소", "", "성명"]) == ["주민등록번호", "E-Mail 주소"]


def test_canonicalise(spark):
    df = spark.createDataFrame([("7.0", " 홍 길동 ", "nan", "45306", None, "010"), (None, None, "x", None, None, None)], "`사번` string, `성명` string, `본부` string, `입사일` string, `퇴사일` string, `휴대폰` string")
    out = canonical.canonicalise(df, "명단2023.xlsx", "s")
    assert rows(out) == [("7", "홍 길동", None, None, None, None, D(2024, 1, 15), None, 2023, "명단2023.xlsx", "s")]
    assert canonical.canonicalise(df.drop("사번", "성명"), "f", "s") is None


def test_alias_keeps_nulls(spark):
    a = spark.createDataFrame([("PMO/사업관리본부", "PMO/사업관리본부", "PMO사업관리본부", "PMO사업관리본부", "")], "raw_org string, raw_dept string, std_org string, std_dept string, note string")
    m = spark.createDataFrame([("PMO/사업관리본부", "PMO/사업관리본부"), ("x", None), ("x", None)], "org string, dept string")
    assert rows(canonical.apply_alias(m, a)) == sorted([("PMO사업관리본부", "PMO사업관리본부"), ("x", None), ("x", None)], key=repr)
    assert rows(canonical.alias_missing(m, a)) == [("x", "")]


def test_standardise_drops_sensitive(spark):
    df = spark.createDataFrame([("1", "A", "x", "010", "2024.01.15"), ("2", "nan", "x", "010", None)], "`사번` string, `이름` string, `팀` string, `휴대폰` string, `입사일` string")
    out = canonical.standardise(df, {"emp_id": "사번", "name": "이름", "dept": "팀", "title": "팀", "join_date": "입사일"})
    assert out.columns == ["emp_id", "name", "dept", "join_date"] and rows(out) == [("1", "A", "x", D(2024, 1, 15))]


def test_running_total_is_cut_after_the_sum(spark):
    df = spark.createDataFrame([(1, 0, 5), (2, 3, 0), (3, 4, 0)], "year int, hires long, exits long")
    assert [r.total for r in gold.running_floored(df, "year").orderBy("year").collect()] == [0, 0, 2]


def test_peak_is_the_first(spark):
    df = spark.createDataFrame([(2001, 5), (2000, 5), (1999, 1)], "year int, exits int")
    assert rows(views.peak_exit_year(df)) == [(2000, 5)]


def test_best_sheets(spark):
    s = spark.createDataFrame([("f", "재직자", 0, 5), ("f", "현원(퇴사포함)", 1, 50), ("f", "퇴사자", 2, 9), ("f", "설문", 3, 1), ("g", "a", 0, 1), ("g", "b", 1, 7)], "file string, sheet string, sheet_idx int, rows long")
    assert rows(classify.best_sheets(s)) == sorted([("f", "재직자", "active"), ("f", "현원(퇴사포함)", "exited"), ("f", "설문", "survey"), ("g", "b", "active")], key=repr)


def test_empty_tables(spark):
    m = spark.createDataFrame([], MASTER)
    for f in (gold.monthly, gold.dept_monthly, gold.turnover_yearly, gold.early_exits, canonical.deduplicate, canonical.latest_people, views.org_headcount):
        assert f(m).count() == 0
    assert qa.counters(m).first()["master_rows"] == 0


days = st.one_of(st.none(), st.dates(D(2000, 1, 1), D(2003, 12, 31)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["1", "2", None]), st.sampled_from(["A", "B"]), days, days, st.sampled_from([2000, 2001, None])), max_size=20))
def test_flows_and_dedup_hold_for_any_rows(spark, people):
    m = spark.createDataFrame([person(e, n, join=j, left=x, year=y) for e, n, j, x, y in people], MASTER)
    joined, left = sum(p[2] is not None for p in people), sum(p[3] is not None for p in people)
    for table in (gold.monthly(m), gold.turnover_yearly(m), gold.dept_monthly(m)):
        got = table.agg(F.coalesce(F.sum("hires"), F.lit(0)), F.coalesce(F.sum("exits"), F.lit(0))).first()
        assert tuple(got) == (joined, left)
    once = canonical.deduplicate(m)
    assert rows(canonical.deduplicate(once)) == rows(once)
    keys = {((e or n), y) for e, n, _, _, y in people}
    assert once.count() == len(keys)


def test_the_order_of_day_and_month_is_one_of_the_column(spark):
    """The first sheet's joins have the day first, its exits and the second sheet the month, as the other dates of the column tell."""
    rows_ = [("f", "a", "13/2/2024", "2/13/2024"), ("f", "a", "1/2/2024", "1/2/2024"), ("f", "a", "2024-03-04", None), ("f", "b", "1/2/2024", "14/14/2024")]
    df = spark.createDataFrame([(*r, str(i)) for i, r in enumerate(rows_)], "file string, sheet string, join_date string, exit_date string, emp_id string")
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("name", "org", "dept", "title", "grade", "snapshot_year")}).withColumn("has_year", F.lit(False))
    got = {r.emp_id: (str(r.join_date), str(r.exit_date)) for r in canonical.project(df).collect()}
    assert got == {"0": ("2024-02-13", "2024-02-13"), "1": ("2024-02-01", "2024-01-02"), "2": ("2024-03-04", "None"), "3": ("2024-01-02", "None")}
    told = {(r.sheet, r.column, r.spelling): (r.n, r.first_over_12, r.second_over_12) for r in canonical.date_spellings(df, ["sheet"], ["join_date", "exit_date"]).collect()}
    assert told[("a", "join_date", "year_last")] == (2, 1, 0) and told[("a", "join_date", "year_first")] == (1, 0, 0) and told[("b", "exit_date", "year_last")] == (1, 1, 1)


def test_row_order(spark):
    day = "cast('2020-01-01' as date)"
    m = spark.range(40).selectExpr("cast(id as string) emp_id", "concat('n', id) name", "concat('o', id % 2) org", "concat('d', id * id % 7) dept", f"date_add({day}, cast(id * 7 % 11 as int)) join_date", f"date_add({day}, cast(20 - id % 3 as int)) exit_date")
    early = [(r.exit_date, r.join_date) for r in gold.in_order(gold.early_exits(m)).collect()]
    assert early == sorted(early) and len(early) == 40
    by = [(-r[1], r[0]) for r in gold.early_exit_by_dept(m).collect()]
    assert by == sorted(by) and len({n for n, _ in by}) > 1
    heads = [(r.people, r.dept) for r in views.dept_headcount(m.withColumn("exit_date", F.lit(None).cast("date"))).collect()]
    assert heads == sorted(heads) and len(heads) > 3


def test_one_pass_counters(spark):
    """The report equals its parts, rows without years, names and ids among them."""
    m = [(str(i % 5) if i % 7 else None, f"n{i % 6}" if i % 9 else None, "o" if i % 4 else None, None, f"2020-01-{1 + i:02d}", "2020-01-09" if i % 3 else None, 2019 + i % 3 if i % 8 else None) for i in range(30)]
    master = spark.createDataFrame(m, "emp_id string, name string, org string, dept string, j string, e string, snapshot_year int")
    master = master.withColumns({"join_date": F.col("j").cast("date"), "exit_date": F.col("e").cast("date"), "data_source": F.lit("d"), "sheet_name": F.lit("s")}).drop("j", "e")
    roster = spark.createDataFrame([(2019, "hire", "n1"), (2019, "exit", "n1"), (2019, "exit", "zz"), (2020, "hire", None), (None, "hire", "n2"), (2030, "hire", "q")], "year int, type string, name string").withColumns({"source_file": F.lit("f"), "sheet": F.lit("s")})
    for a, b in ((master, roster), (master, roster.limit(0)), (master.limit(0), roster)):
        got = qa.report(a, b).first().asDict()
        assert got == qa.counters(a).first().asDict() | {"reference_roster_rows": b.count(), "mismatch_ref_only_rows": qa.ref_only(a, b).count(), "mismatch_master_only_rows": qa.master_only(a, b).count()}
    active = master.where("exit_date is null")
    assert qa.reconciliation_of(master).first().asDict() == qa.reconciliation(gold.headcount(master), active).first().asDict()
    for y in (2020, 2021, 1990):
        assert views.kpis_of(master, y).first() == views.kpis(active, gold.turnover_yearly(master), gold.early_exits(master), y).first()
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD")
    assert scans(qa.report(master, roster)) == 2 and scans(views.kpis_of(master, 2020)) == 1


def test_report_counts_keys_apart_from_the_join(spark):
    """Keys are dealt before they are counted, so no task holds them beside the join's rows; rows without a name count too."""
    m = spark.createDataFrame([(f"e{i % 7}", None if i % 2 else f"n{i}", "o", "d", None, None, 2020) for i in range(40)], "emp_id string, name string, org string, dept string, join_date date, exit_date date, snapshot_year int").repartition(4)
    r = spark.createDataFrame([(2020, "n0"), (2020, "x"), (2020, None)], "year int, name string")
    out = qa.report(m, r)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "keys=[kind" not in plan[plan.index("REPARTITION_BY_NUM") :]
    got = out.first()
    assert (got.master_rows, got.duplicate_emp_id_rows, got.reference_roster_rows) == (40, 40, 3)
    assert (got.mismatch_ref_only_rows, got.mismatch_master_only_rows) == (1, 39)
