from datetime import date

import pytest

from crewgrid.functions import scalars as S


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "x string").select(f("x")).first()[0]


@pytest.mark.parametrize(
    ("text", "day"),
    [(t, date(2024, 1, 15)) for t in ("2024-01-15", "2024.01.15", "20240115", "45306", "45306.0", "20240115.0", " 2024-01-15 ")]
    + [(t, date(2024, 1, 5)) for t in ("2024/1/5", "2024-1-5 00:00:00", "1/5/2024", "01-05-2024", "2024년 1월 5일", "2024 년 1 월 5 일", "Jan 5 2024", "jan. 5, 2024", "January 5, 2024", "5 JAN 2024", "5-Jan-2024", "45296.75", "2024-01-05T10:11:12.5Z", "Jan 5, 2024 9:05 PM", "5-Jan-2024 00:00", "1/5/2024 23:59:59 +09:00", "Sept 5 2024".replace("Sept", "Jan"))]
    + [(t, None) for t in ("5", "61000", "1970-01-01", "abc", "", None, "2024-13-40", "99999999", "13/13/2024", "Foo 5 2024", "2/30/2024", "61000.5", "2024-01-15 abc", "Jan 5, 2020 xx", "2024-01-15 10", "5 Foo 2024", "Jan 5", "2024년 1월 5일 밤", "janx", "123456789012345678901234567890")],
)
def test_dates(spark, text, day):
    assert one(spark, text, S.to_date) == day


def test_dates_with_the_day_first(spark):
    assert one(spark, "5/1/2024", lambda c: S.to_date(c, True)) == date(2024, 1, 5) == one(spark, "5.1.2024 10:00", lambda c: S.to_date(c, S.F.lit(True)))
    assert one(spark, "5/1/2024", lambda c: S.to_date(c, S.F.lit(None).cast("boolean"))) == date(2024, 5, 1)
    spelled = {"20240115": "eight", "45306.5": "serial", "2024.1.5": "year_first", "1-5-2024": "year_last", "2024 년": "korean", "Jan 5": "month_name", "5 jan": "day_name", "x": None, None: None}
    assert {t: one(spark, t, S.date_spelling) for t in spelled} == spelled


def test_text(spark):
    assert one(spark, None, S.normalise) == ""
    assert one(spark, "　a\r\n b \t c　", S.normalise) == "a b c"
    assert one(spark, " a\r\nb ", S.normalise_light) == "a  b"
    assert one(spark, None, S.normalise_light) is None
    assert one(spark, " 사원 번호(No.)_:-[x]{y} ", S.key_of) == "사원번호no.xy"
    assert one(spark, "nan", S.clean_text) is None
    assert one(spark, "100.05", S.emp_id) == "100.05"
    assert one(spark, "100.0", S.emp_id) == "100"
    assert one(spark, "　홍길동　", S.person_name) == "홍길동"


def test_names(spark):
    assert one(spark, "명단_2023_v2", S.year_in) == 2023
    assert one(spark, "명단", S.year_in) is None
    assert one(spark, "2021년", S.digits_year) == 2021
    assert one(spark, "년", S.digits_year) is None
    assert one(spark, "경력연차_20240301.xlsx", S.date_in) == "20240301"
    split = lambda c: S.F.array(*S.split_org(c))
    assert one(spark, "본부-팀-x", split) == ["본부", "팀-x"]
    assert one(spark, "본부·팀", split) == ["본부", "팀"]
    assert one(spark, "본부", split) == ["본부", None]
    assert one(spark, "/a/b/c.XLSX", S.file_name) == "c.XLSX"
    assert one(spark, "/a/b/c.XLSX", S.file_suffix) == ".xlsx"
    assert one(spark, "/a/b/c.XLSX", S.parent_folder) == "b"
    assert one(spark, "2001.05.06", S.dotted_date) is None
    assert one(spark, "2002.05.06", S.dotted_date) == date(2002, 5, 6)


def test_rates(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (1, None), (1, -2)], "a int, b int")
    assert [r[0] for r in df.select(S.percent("a", "b")).collect()] == [0.0, 25.0, 0.0, 0.0]
