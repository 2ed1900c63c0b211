import json
import zipfile
from datetime import date
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from crewgrid import constants as K
from crewgrid.plans import build, load
from crewgrid.schema import CELLS
from crewgrid.sources import files, grid, lists, sinks
from crewgrid.sources.snapshots import Snapshots
from crewgrid.sources.config import of, read_config
from crewgrid.sources.xlsx import read_cells, read_errors, readable
from crewgrid.streaming import incremental
from tests.conftest import rows


def workbook(path, sheets):
    """A minimal workbook: shared strings for text, plain numbers for numbers."""
    strings = sorted({v for grid_ in sheets.values() for row in grid_ for v in row if isinstance(v, str)})
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

    def cell(r, c, v):
        ref = f"{chr(65 + c)}{r + 1}"
        return f'<c r="{ref}" t="s"><v>{strings.index(v)}</v></c>' if isinstance(v, str) else f'<c r="{ref}"><v>{v}</v></c>'

    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>")
        for i, g in enumerate(sheets.values()):
            body = "".join(f'<row r="{r + 1}">' + "".join(cell(r, c, v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(g))
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")


PEOPLE = [["인사 현황", None, None, None], ["사번", "성명", "본부", "입사일", "퇴사일", "휴대폰"], [1, "홍길동", "본부A", 45306, None, "010"], [2, "김철수", "본부A", "2023.02.01", "2023-02-20", "011"], [], [1, "홍길동", None, 45306, None, "010"]]


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "raw" / "roster").mkdir(parents=True)
    workbook(tmp_path / "raw" / "현황2024.xlsx", {"재직자": PEOPLE, "가이드": [["설명"], ["x"]]})
    workbook(tmp_path / "raw" / "roster" / "명단2024.xlsx", {"2024": [["제목"], ["입사자", "퇴사자"], ["홍길동", "박영희"], ["", "박영희"]]})
    workbook(tmp_path / "raw" / "기술스택.xlsx", {"s": [["사번", "이름", "기술", "경험여부"], [7, "이순신", "Spark", "Y"], [None, None, "x", None]]})
    (tmp_path / "raw" / "broken.xlsx").write_bytes(b"no zip")
    (tmp_path / "raw" / "~$lock.xlsx").write_bytes(b"")
    return tmp_path


def test_cells_and_headers(spark, raw):
    every = read_cells(spark, str(raw / "raw"))
    assert [r.file.rsplit("/", 1)[1] for r in read_errors(every).collect()] == ["broken.xlsx"]
    cells = readable(every).where(F.col("file").contains("현황"))
    assert rows(grid.header_by_share(cells).where("sheet = '재직자'").select("header_row")) == [(1,)]
    kinds = {r.sheet: (r.kind, r.rows) for r in grid.scan_sheets(cells).collect()}
    assert kinds == {"재직자": ("master", 3), "가이드": ("skip", 1)}


def test_header_names(spark):
    assert grid.unique_names(["a", "a", "", None, "a "]) == ["a", "a_1", "col_2", "col_3", "a_2"]
    cells = spark.createDataFrame([("f", "s", 0, 0, i, v) for i, v in enumerate(["a", "a", "", "b"])] + [("f", "s", 0, 1, 0, "1")], "file string, sheet string, sheet_idx int, row_idx int, col_idx int, value string")
    assert grid.headers(cells, grid.header_by_needles(cells, ["b"], 10)).first()["columns"] == ["a", "a_1", "col_2", "b"]


def test_roster_and_lists(spark, raw):
    cells = readable(read_cells(spark, str(raw / "raw")))
    got = rows(lists.roster(cells.where(F.col("file").contains("명단"))).select("year", "type", "name"))
    assert got == [(2024, "exit", "박영희"), (2024, "hire", "홍길동")]
    assert rows(lists.turnover_lists(cells.where(F.col("file").contains("명단"))).select("year", "type", "name").distinct()) == got
    assert rows(lists.skills(cells.where(F.col("file").contains("기술")))) == [("이순신", "7", "Spark", "Y", "기술스택.xlsx", "s")]


def test_careers(spark):
    row = {0: "1", 2: "홍길동", 4: "본부-팀", 5: "secret", 8: "2020.01.02", 21: "12", 25: "x"}
    data = [("/d/경력연차_20240301.xlsx", "재직자", 0, 1, 2, "이름")] + [(f"/d/경력연차_{d}.xlsx", "재직자", 0, 2, c, v) for d in ("20240301", "20230301") for c, v in row.items()]
    out = lists.careers(spark.createDataFrame(data, "file string, sheet string, sheet_idx int, row_idx int, col_idx int, value string"))
    assert "secret" not in str(out.collect())
    r = out.first()
    assert out.count() == 1 and (r.name, r.org, r.dept, r.snapshot_date, r.prev_career_months, r.total_career_months, r.join_date) == ("홍길동", "본부", "팀", "20240301", 12.0, None, date(2020, 1, 2))


def test_build_is_incremental(spark, raw):
    out = build.build(spark, str(raw / "raw"), str(raw / "out"), buckets=2)
    assert rows(out.master.select("emp_id", "name", "org", "join_date", "exit_date", "snapshot_year")) == [("1", "홍길동", "본부A", date(2024, 1, 15), None, 2024), ("2", "김철수", "본부A", date(2023, 2, 1), date(2023, 2, 20), 2024)]
    assert "휴대폰" not in out.master.columns
    assert rows(out.gold["turnover_yearly"]) == [(2023, 1, 1, 0), (2024, 1, 0, 1)]
    assert rows(out.gold["early_exit_30d"].select("name", "tenure_days")) == [("김철수", 19)]
    assert rows(out.roster.select("type", "name")) == [("exit", "박영희"), ("hire", "홍길동")]
    assert rows(out.ref_only.select("name")) == [("박영희",)] and rows(out.master_only.select("name")) == [("김철수",)]
    assert out.skills.count() == 1 and out.errors.count() == 1
    statuses = lambda force=False: {r.path.rsplit("/", 1)[1]: r.status for r in build.new_and_changed(spark, str(raw / "raw"), out.snapshot, force)[1].collect()}
    assert statuses() == {"현황2024.xlsx": "unchanged", "명단2024.xlsx": "unchanged", "기술스택.xlsx": "unchanged", "broken.xlsx": "new"}
    assert statuses(True)["현황2024.xlsx"] == "changed"
    (raw / "raw" / "기술스택.xlsx").unlink()
    workbook(raw / "raw" / "현황2024.xlsx", {"재직자": PEOPLE[:3]})
    assert statuses() == {"현황2024.xlsx": "changed", "명단2024.xlsx": "unchanged", "기술스택.xlsx": "deleted", "broken.xlsx": "new"}


def names(paths):
    return sorted(p.rsplit("/", 1)[1] for p in paths)


def test_a_second_build_parses_only_what_changed(spark, raw):
    src, out = str(raw / "raw"), str(raw / "out")
    first = build.build(spark, src, out, buckets=2)
    assert names(first.parsed) == sorted(["broken.xlsx", "기술스택.xlsx", "명단2024.xlsx", "현황2024.xlsx"])
    before = rows(first.master)
    second = build.build(spark, src, out, buckets=2)
    assert names(second.parsed) == ["broken.xlsx"] and rows(second.master) == before
    workbook(raw / "raw" / "현황2025.xlsx", {"재직자": PEOPLE[:3]})
    (raw / "raw" / "roster" / "명단2024.xlsx").unlink()
    third = build.build(spark, src, out, buckets=2)
    assert names(third.parsed) == ["broken.xlsx", "현황2025.xlsx"] and third.roster.count() == 0
    assert {r.snapshot_year for r in third.master.collect()} == {2024, 2025}
    assert names(build.build(spark, src, out, buckets=2, force=True).parsed) == sorted(["broken.xlsx", "기술스택.xlsx", "현황2024.xlsx", "현황2025.xlsx"])
    build.build(spark, src, out, buckets=2, keep=1, grace=0)
    for folder in ("manifest", "index", "status", "cells"):
        assert len([x for x in (raw / "out" / "bronze" / folder).iterdir() if x.name.startswith("v-")]) == 1 + (folder == "cells")


def test_build_with_settings(spark, raw, capsys):
    (raw / "raw" / "headcount").mkdir()
    (raw / "raw" / "unknown").mkdir()
    workbook(raw / "raw" / "unknown" / "x2024.xlsx", {"재직자": [["사번", "성명", "입사일"], [9, "아무개", "2020-01-01"]]})
    workbook(raw / "raw" / "headcount" / "hc2024.xlsx", {"재직 현황": [["사번", "이름", "소속", "입사일"], [5, "유관순", "본부B", "2022-03-01"]]})
    workbook(raw / "raw" / "odd.xlsx", {"Z": [["항목", "비고"], ["x", "y"]], "본부별 년차별 인원수": [["사번", "입사일"], [77, "2020-01-01"]]})
    (raw / "old.xls").write_bytes(b"binary")
    (raw / "old.xls").rename(raw / "raw" / "old.xls")
    (raw / "alias.csv").write_text("raw_org,raw_dept,std_org,std_dept\n본부A,,본부에이,\n")
    (raw / "config.json").write_text(json.dumps({"columns": {"headcount_2024": {"emp_id": "사번", "name": "이름", "org": "소속"}}, "files": {"headcount_2024_xlsx": "hc2024.xlsx"}, "skip_sheets": ["Z"]}))
    assert build.main([str(raw / "raw"), str(raw / "out"), "--config", str(raw / "config.json"), "--alias", str(raw / "alias.csv")]) == 0
    got = load.load(spark, str(raw / "out"))
    people = rows(got["master"].select("name", "org"))
    assert ("유관순", "본부B") in people and not {"아무개", None} & {n for n, _ in people}
    assert rows(got["hc_active"].select("emp_id", "name", "org")) == [("5", "유관순", "본부B")] and got["hc_exited"].count() == 0
    assert got["report"].count() == 1 and got["attrition"].columns == ["emp_id", "name", "attrition_risk_score"]
    assert Snapshots(spark, str(raw / "out")).latest().read("qa/alias_missing").count() >= 1
    errors = {r.error for r in build.build(spark, str(raw / "raw"), str(raw / "out"), buckets=2).errors.collect()}
    assert any("neither a zipped nor a compound workbook" in e for e in errors)


def test_unknown_sheets_are_reported_once(spark, tmp_path):
    cells = lambda f, head: spark.createDataFrame([(f, "Z", 0, 0, 0, head), (f, "Z", 0, 0, 1, "비고"), (f, "Z", 0, 1, 0, "x"), (f, "Z", 0, 1, 1, "y")], CELLS)
    one = grid.scan_sheets(cells("odd.xlsx", "항목"))
    assert build.watch(spark, str(tmp_path), one).count() == 1 and build.watch(spark, str(tmp_path), one).count() == 0
    build.watch(spark, str(tmp_path), one.unionByName(grid.scan_sheets(cells("odder.xlsx", "품목"))))
    last = Snapshots(spark, str(tmp_path)).latest()
    assert rows(last.read("qa/alerts").select("file")) == [("odd.xlsx",), ("odder.xlsx",)]
    assert rows(last.read("bronze/registry").select("columns", "type_no")) == [(["품목", "비고"], 2), (["항목", "비고"], 1)]


def test_tables_are_found_where_they_are(spark, tmp_path):
    (tmp_path / "gold").mkdir()
    (tmp_path / "gold" / "turnover_yearly.csv").write_text("year,hires,exits,other\n2024,3,x,1\n")
    (tmp_path / "monthly.csv").write_text("month,hires,exits,net\n2024-01-01,1,0,1\n")
    got = load.load(spark, str(tmp_path))
    assert rows(got["yearly"]) == [(2024, 3, None, None)] and rows(got["monthly"]) == [(date(2024, 1, 1), 1, 0, 1)] and got["master"].count() == 0


def test_needles_find_headers_below_titles(spark):
    cells = [("f", "a", 0, 0, 0, "소속별 현황"), ("f", "a", 0, 1, 0, "사번"), ("f", "a", 0, 2, 0, "1"), ("f", "b", 1, 0, 0, "list"), ("f", "b", 1, 3, 0, "Employee Name"), ("f", "b", 1, 4, 0, "Kim")]
    cells = spark.createDataFrame(cells, CELLS)
    found = {r.sheet: r.header_row for r in grid.header_by_needles(cells, K.HEADCOUNT_NEEDLES, K.HEADCOUNT_ROWS).collect()}
    assert found == {"a": 1, "b": 3}
    grade = lists.grades(spark.createDataFrame([("g", "s", 0, 1, 0, "이름"), ("g", "s", 0, 1, 1, "등급"), ("g", "s", 0, 2, 0, "김"), ("g", "s", 0, 2, 1, "S")], CELLS))
    assert grade.columns == ["이름", "등급"] and rows(grade) == [("김", "S")] and lists.grades(cells.limit(0)) is None


def test_settings(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a": {"b": ""}}')
    config = read_config(spark, str(tmp_path / "c.json"))
    assert of(config, "a", "b", default=1) == 1 and of(config, "x", "y") is None and of(config, "a") == {"b": ""}


def test_headcount_lists(spark, tmp_path):
    workbook(tmp_path / "hc.xlsx", {"재직 현황": [["x"], ["사번", "이름", "소속", "핸드폰"], [1, "A", "o", "010"], [2, "nan", "o", "010"]], "퇴사자": [["이름", "퇴사일"], ["B", "2024.01.15"]]})
    out = build.headcount_lists(readable(read_cells(spark, str(tmp_path))), {"emp_id": "사번", "name": "이름", "org": "소속", "exit_date": "퇴사일"})
    assert rows(out["active"]) == [("1", "A", "o")] and out["active"].columns == ["emp_id", "name", "org"]
    assert rows(out["exited"].select("name", "exit_date")) == [("B", date(2024, 1, 15))]


def test_stream_takes_each_file_once(spark, raw):
    seen = []

    def each(df, number):
        seen.append({r.file.rsplit("/", 1)[1] for r in df.select("file").distinct().collect()})

    def run():
        seen.clear()
        incremental.run_available(incremental.cells_of(incremental.new_files(spark, str(raw / "raw"), "*.xlsx")), str(raw / "checkpoint"), each)
        return set().union(*seen)

    assert {"현황2024.xlsx", "명단2024.xlsx", "기술스택.xlsx", "broken.xlsx"} <= run()
    workbook(raw / "raw" / "new.xlsx", {"s": [["a"], ["b"]]})
    assert run() == {"new.xlsx"}


def test_manifest(spark):
    t = "2024-01-01 00:00:00"
    old = spark.createDataFrame([("a", 1, t, "x"), ("b", 1, t, "x"), ("c", 1, t, None)], "path string, size long, mtime string, sha1 string")
    now = spark.createDataFrame([("a", 1, t, "x"), ("b", 1, t, "y"), ("d", 1, t, "x")], "path string, size long, mtime string, sha1 string")
    assert rows(files.diff(now, old)) == [("a", "unchanged"), ("b", "changed"), ("c", "deleted"), ("d", "new")]
    assert rows(files.upsert(old, now).select("path", "sha1")) == [("a", "x"), ("b", "y"), ("c", None), ("d", "x")]


def test_readers_and_sinks(spark, tmp_path):
    assert files.read_csv(spark, str(tmp_path / "none.csv"), "a int").count() == 0
    (tmp_path / "b.csv").write_text("a,b\n1,x\n")
    assert rows(files.read_csv(spark, str(tmp_path / "none.csv"), "a int, b string", str(tmp_path / "b.csv"))) == [(1, "x")]
    (tmp_path / "alias.csv").write_text("raw_org,raw_dept,std_org,std_dept\no,,O,\n")
    assert rows(files.read_alias(spark, str(tmp_path / "alias.csv"))) == [("o", "", "O", "", "")]
    (tmp_path / "bad.csv").write_text("raw_org\no\n")
    with pytest.raises(ValueError):
        files.read_alias(spark, str(tmp_path / "bad.csv"))
    assert files.read_alias(spark, str(tmp_path / "no.csv")) is None
    (tmp_path / "r.json").write_text(json.dumps({"n": 3}))
    assert rows(files.read_json(spark, str(tmp_path / "r.json"), "n int")) == [(3,)]
    df = spark.createDataFrame([(1, "010")], "a int, phone string")
    assert spark.read.parquet(sinks.save(df, str(tmp_path), "gold", "t", csv=True)).columns == ["a"]
    assert sinks.save_unless_empty(df.limit(0), str(tmp_path), "gold", "u") is None
    with pytest.raises(ValueError):
        sinks.save(df, str(tmp_path), "brass", "t")
