"""Incremental builds against full ones, one commit for all tables, the report."""

import json
import random

import pytest
from pyspark.sql import functions as F

from crewgrid.operators import gold
from crewgrid.plans import build, load
from crewgrid.sources.snapshots import ConcurrentBuild, Snapshots, Transaction
from tests.conftest import rows
from tests.test_sources import PEOPLE, workbook

HEAD = ["사번", "성명", "본부", "부서", "입사일", "퇴사일"]


def people(seed, n):
    r = random.Random(seed)
    out = [HEAD]
    for _ in range(n):
        i, y = r.randrange(60), r.choice(["2021", "2022", "2023"])
        out.append([i if r.random() < 0.9 else None, f"이름{i}", r.choice(["본부A", "본부B", None]), r.choice(["팀1", None]), f"{y}.0{r.randrange(1, 9)}.1{r.randrange(9)}", f"{y}-0{r.randrange(1, 9)}-2{r.randrange(9)}" if r.random() < 0.5 else None])
    return out


def state(got):
    return {name: rows(got[name]) for name in ("master", "yearly", "monthly", "dept", "early")}


def placed(snapshot):
    return {p["bucket"]: p["path"] for p in snapshot.tables["silver/master"]}


def test_after_every_change_gold_equals_a_full_build(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    for y in (2021, 2022, 2023):
        workbook(raw / f"현황{y}.xlsx", {"재직자": people(y, 40)})
    first = build.build(spark, str(raw), out, buckets=16)
    assert len(first.parsed) == 3
    workbook(raw / "현황2022.xlsx", {"재직자": people(2022, 40)[:-1] + people(99, 2)[1:]})
    workbook(raw / "현황2024.xlsx", {"재직자": people(7, 3), "퇴사자": people(8, 2)})
    (raw / "현황2021.xlsx").unlink()
    second = build.build(spark, str(raw), out, buckets=16)
    assert {p.rsplit("/", 1)[1] for p in second.parsed} == {"현황2022.xlsx", "현황2024.xlsx"}
    got, want = load.load(spark, out), build.build(spark, str(raw), str(tmp_path / "full"), buckets=16) and load.load(spark, str(tmp_path / "full"))
    assert state(got) == state(want) and len(rows(got["master"])) > 30
    for name in ("monthly", "dept", "early"):
        assert [tuple(r) for r in got[name].collect()] == [tuple(r) for r in want[name].collect()]  # in order too
    early = [tuple(r) for r in got["early"].select("exit_date", "join_date").collect()]
    assert early == sorted(early)
    # One more file with two people: only their keys' buckets are read and written.
    workbook(raw / "현황2025.xlsx", {"재직자": people(5, 2)})
    third = build.build(spark, str(raw), out, buckets=16)
    before, after = placed(second.snapshot), placed(third.snapshot)
    touched = {r.bucket for r in third.snapshot.read("bronze/touched_keys").collect()}
    assert 0 < len(touched) <= 2 and {k for k, v in after.items() if before.get(k) != v} == touched
    assert third.snapshot.read("bronze/touched_keys").count() <= 2 >= third.snapshot.read("bronze/delta").where("sign = 1").count() and third.snapshot.number == 3
    assert rows(third.gold["turnover_yearly"]) == rows(gold.turnover_yearly(third.master))
    assert rows(third.gold["dept_monthly"]) == rows(gold.dept_monthly(third.master))
    assert rows(third.gold["early_exit_30d"]) == rows(gold.early_exits(third.master))


def test_changed_settings_make_all_anew(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    workbook(raw / "현황2024.xlsx", {"재직자": PEOPLE})
    assert build.build(spark, str(raw), out, buckets=2).parsed
    alias = spark.createDataFrame([("본부A", "", "본부에이", "", "")], "raw_org string, raw_dept string, std_org string, std_dept string, note string")
    got = build.build(spark, str(raw), out, alias=alias, buckets=2)
    assert len(got.parsed) == 1 and ("본부에이",) in rows(got.master.select("org"))
    again = build.build(spark, str(raw), out, alias=alias, buckets=2)
    assert not again.parsed and again.ingest["fast_path"] and rows(again.master) == rows(got.master)


class Killed(Exception):
    pass


def test_a_build_killed_anywhere_leaves_the_old_set(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    workbook(raw / "현황2024.xlsx", {"재직자": PEOPLE})
    build.build(spark, str(raw), out, buckets=2)
    old = state(load.load(spark, out))
    workbook(raw / "현황2025.xlsx", {"재직자": people(1, 10)})
    put, count = Transaction._put, [0]

    def dying(self, name, df, buckets=False):
        count[0] -= 1
        done = put(self, name, df, buckets)
        if not count[0]:
            raise Killed(name)
        return done

    monkeypatch.setattr(Transaction, "_put", dying)
    died = []
    for at in (4, 14):
        count[0] = at
        with pytest.raises(Killed) as error:
            build.build(spark, str(raw), out, buckets=2)
        died.append(str(error.value))
        assert state(load.load(spark, out)) == old and Snapshots(spark, out).numbers() == [1]
    assert len({d.split("/")[0] for d in died}) >= 2
    monkeypatch.setattr(Transaction, "_put", put)
    monkeypatch.setattr(Snapshots, "add", lambda *_: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        build.build(spark, str(raw), out, buckets=2)
    monkeypatch.undo()
    assert state(load.load(spark, out)) == old
    whole = build.build(spark, str(raw), out, buckets=2, grace=0, keep=1)
    assert whole.snapshot.number == 2 and whole.master.count() > len(old["master"])
    named = {p["path"].split("/")[2] for parts in whole.snapshot.tables.values() for p in parts}
    assert {v.name for v in (tmp_path / "out").glob("*/*/v-*")} == named  # the broken builds' folders are gone


def test_two_builds_at_a_time_and_pinned_readers(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    one, two = store.begin(), store.begin()
    one.write("gold/t", spark.range(3))
    two.write("gold/t", spark.range(5))
    first = one.commit()
    with pytest.raises(ConcurrentBuild):
        two.commit()
    assert store.latest().read("gold/t").count() == 3 and not list(tmp_path.glob("_snapshots/*.aside"))
    again = store.begin()
    again.write("gold/t", spark.range(7))
    again.append("gold/log", spark.range(1))
    again.write("gold/secret", spark.createDataFrame([(1, "010")], "a int, phone string"))
    second = again.commit()
    assert first.read("gold/t").count() == 3 and second.read("gold/t").count() == 7 and second.read("gold/secret").columns == ["a"]
    assert store.at(1).read("gold/t").count() == 3 and second.read("gold/none", "x int").count() == 0
    third = store.begin()
    third.append("gold/log", spark.range(2))
    third.drop("gold/secret")
    assert third.commit().read("gold/log").count() == 3
    store.clean(keep=1, grace=0)
    assert store.numbers() == [3] and "gold/secret" not in store.latest() and store.latest().read("gold/t").count() == 7
    assert len(list(tmp_path.glob("gold/t/v-*"))) == 1 and not list(tmp_path.glob("gold/secret/v-*"))


def test_the_report_accounts_for_every_file(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    (raw / "pricing").mkdir(parents=True)
    workbook(raw / "현황2024.xlsx", {"재직자": PEOPLE})
    workbook(raw / "조직도.xlsx", {"s": [["x"], ["y"]]})
    workbook(raw / "pricing" / "p.xlsx", {"s": [["단가"], [1]]})
    workbook(raw / "기술스택.xlsx", {"s": [["사번", "이름", "기술", "경험여부"], [7, "이순신", "Spark", "Y"]]})
    workbook(raw / "other.xlsx", {"s": [["항목", "비고"], ["x", "y"]]})
    (raw / "note.txt").write_text("x")
    (raw / "broken.xlsx").write_bytes(b"PK")
    ingest = build.build(spark, str(raw), out, buckets=2).ingest
    assert (ingest["raw_files"], ingest["read_ok"], ingest["read_fail"], ingest["parsed"], ingest["master_auto_rows"]) == (7, 5, 1, 6, 2)
    assert ingest["cells"] > 20 and ingest["error_rows"] == 1 and ingest["read_fail_list"][0].startswith("broken.xlsx (")
    skips = {k: v for k, v in ingest["classified_skips"].items() if v}
    assert skips == {"org_chart": ["조직도.xlsx"], "aux_pricing": ["p.xlsx"], "aux_skill": ["기술스택.xlsx"], "unmatched_excel": ["other.xlsx"], "non_excel": ["note.txt"]}
    assert ingest["skipped_files"] == ["조직도.xlsx"] and ingest["headcount"] == "no column map"
    kept = load.load(spark, out)["report"].first()
    assert kept.raw_files == 7 and kept.classified_skips["non_excel"] == ["note.txt"] and kept.status == {"new": 7}
    again = build.build(spark, str(raw), out, buckets=2).ingest
    assert again["status"] == {"unchanged": 6, "new": 1} and again["classified_skips"] == ingest["classified_skips"] and again["read_fail"] == 1
    assert json.dumps(again)


def test_empty_headcount_lists_are_not_written(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    (raw / "headcount").mkdir(parents=True)
    workbook(raw / "headcount" / "hc.xlsx", {"재직 현황": [["사번", "이름", "소속"], [5, "유관순", "본부B"]], "퇴사자": [["이름", "퇴사일"], ["nan", "2024.01.15"]]})
    got = build.build(spark, str(raw), out, buckets=2, columns={"emp_id": "사번", "name": "이름", "exit_date": "퇴사일"})
    assert "silver/headcount_active" in got.snapshot and "silver/headcount_exited" not in got.snapshot and got.ingest["headcount"] == "hc.xlsx"


def test_registry_versions(spark, tmp_path):
    cells = lambda f, head: spark.createDataFrame([(f, "Z", 0, r, c, v) for r, row in enumerate(((head, "비고"), ("x", "y"))) for c, v in enumerate(row)], "file string, sheet string, sheet_idx int, row_idx int, col_idx int, value string")
    from crewgrid.sources import grid

    for f, head in (("odd.xlsx", "항목"), ("odder.xlsx", "품목"), ("odd.xlsx", "항목")):
        build.watch(spark, str(tmp_path), grid.scan_sheets(cells(f, head)))
    snapshot = Snapshots(spark, str(tmp_path)).latest()
    assert rows(snapshot.read("bronze/registry").select("type_no", "version")) == [(1, "v1.1"), (2, "v1.2")]
    assert snapshot.read("qa/alerts").where(F.col("detected_at").isNotNull()).count() == 2
