"""CSV of three encodings, broken files, columns by name; writing with the mark, staged and moved."""

import codecs

import pytest

from crewgrid.sources import csvs, files, sinks
from tests.conftest import rows

TEXT = '이름,본부,year\n홍길동,"본부 A\n둘째 줄",2024\n"김 ""철수""",,x\n'
WANT = [('김 "철수"', None, None), ("홍길동", "본부 A\n둘째 줄", 2024)]
SCHEMA = "`이름` string, `본부` string, year int"


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "cp949", "utf-16"])
@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_encodings(spark, tmp_path, monkeypatch, encoding, piece):
    monkeypatch.setattr(csvs, "_PIECE", piece)
    (tmp_path / "a.csv").write_bytes(TEXT.encode(encoding))
    with open(tmp_path / "a.csv", "rb") as f:
        assert csvs.encoding_of(f) == encoding
    assert sorted(csvs.whole_rows(str(tmp_path / "a.csv"))) == sorted([["이름", "본부", "year"], ["홍길동", "본부 A\n둘째 줄", "2024"], ['김 "철수"', "", "x"]])
    if piece == 7:
        assert rows(files.read_csv(spark, str(tmp_path / "a.csv"), SCHEMA)) == WANT


def test_columns_by_name_and_broken_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("year,other,이름\n2024,1,홍\n2023\n\n")
    assert rows(files.read_csv(spark, str(tmp_path / "a.csv"), SCHEMA)) == [("홍", None, 2024), (None, None, 2023)]
    late = TEXT.encode() + b"x," * 100_000 + b"\xff\xff\n"
    for broken in (late, b"a,b\n\"x", b'a,b\n"x"y,1\n', b"\xff\xfe\x00", b""):
        (tmp_path / "b.csv").write_bytes(broken)
        assert files.read_csv(spark, str(tmp_path / "b.csv"), SCHEMA).count() == 0
    assert files.read_csv(spark, str(tmp_path / "none.csv"), SCHEMA).count() == 0
    (tmp_path / "alias.csv").write_bytes("std_org,raw_org,raw_dept,std_dept\n본부에이,본부A,,\n".encode("cp949"))
    assert rows(files.read_alias(spark, str(tmp_path / "alias.csv"))) == [("본부A", "", "본부에이", "", "")]


def test_written_with_the_mark_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([("홍길동", "본부 A\n둘째", 2024), ('김 "철수"', None, None)], SCHEMA)
    csvs.write_marked(df.coalesce(1), str(tmp_path / "t"))
    (one,) = (tmp_path / "t").glob("*.csv")
    assert one.read_bytes() == codecs.BOM_UTF8 + '이름,본부,year\n홍길동,"본부 A\n둘째",2024\n"김 ""철수""",,\n'.encode()
    assert rows(files.read_csv(spark, str(tmp_path / "t"), SCHEMA)) == [('김 "철수"', None, None), ("홍길동", "본부 A\n둘째", 2024)]
    csvs.write_marked(spark.range(40).selectExpr("cast(id as string) `이름`", "'x' `본부`", "cast(id as int) year", "date'2024-01-02' as day").repartition(4), str(tmp_path / "t"))
    parts = sorted((tmp_path / "t").iterdir())
    assert len(parts) == 4 and all(p.read_bytes().startswith(codecs.BOM_UTF8 + "이름,본부,year,day\n".encode()) for p in parts) and b",2024-01-02\n" in parts[0].read_bytes()
    assert files.read_csv(spark, str(tmp_path / "t"), SCHEMA).count() == 40
    csvs.write_marked(df.limit(0), str(tmp_path / "empty"))
    assert files.read_csv(spark, str(tmp_path / "empty"), SCHEMA).count() == 0


def test_a_write_that_fails_leaves_the_old_files(spark, tmp_path):
    df = spark.range(3).selectExpr("cast(id as string) `이름`", "'x' `본부`", "cast(id as int) year")
    csvs.write_marked(df, str(tmp_path / "t"))
    before = {p.name: p.read_bytes() for p in (tmp_path / "t").iterdir()}
    with pytest.raises(Exception):
        csvs.write_marked(df.selectExpr("`이름`", "`본부`", "cast(raise_error('no') as int) year"), str(tmp_path / "t"))
    assert {p.name: p.read_bytes() for p in (tmp_path / "t").iterdir()} == before


def test_a_fixed_dept_is_saved(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", "1"), ("b", None, "2")], "name string, dept string, phone string")
    sinks.save_fixed(df, " b", "팀", str(tmp_path / "fixed"))
    assert rows(files.read_csv(spark, str(tmp_path / "fixed"), "name string, dept string")) == [("a", "x"), ("b", "팀")]
    assert csvs.header(str(next((tmp_path / "fixed").glob("*.csv")))) == ["name", "dept"]
