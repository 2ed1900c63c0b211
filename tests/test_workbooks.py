"""Workbooks old and new: the same cells from either, sheets as tasks, rows and sheets pushed into the scan."""

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from crewgrid.sources import xls, xlsx
from tests.conftest import rows
from tests.test_sources import PEOPLE, workbook
from tests.xls_twin import compound, records

LONG = ["가나다 " * 90, "plain " * 80, "é" * 300, ""]


def grids():
    r = random.Random(4)
    many = [[r.choice([None, r.randrange(-10, 1 << 27), r.random() * 1e6, f"문자열{r.randrange(400)}", "text", 2.5]) for _ in range(9)] for _ in range(300)]
    return {"재직자": PEOPLE, "긴 글": [LONG, [None, "a", 1, 2, 3, None, 0.1, 1e20, -5.25]], "many": many, "empty": []}


def cells_of(source, **options):
    return list(xlsx.workbook_cells(source, **options))


@pytest.mark.parametrize("room", [30, 200, 8000])
@pytest.mark.parametrize("scatter", [False, True])
def test_an_old_workbook_gives_its_twins_cells(tmp_path, room, scatter):
    for name, g in (("small", {"s": PEOPLE}), ("large", grids())):
        workbook(tmp_path / f"{name}.xlsx", g)
        old = compound({"SummaryInformation": b"x" * 70, "Workbook": records(g, room)}, scatter)
        assert cells_of(io.BytesIO(old)) == cells_of(open(tmp_path / f"{name}.xlsx", "rb"))


def test_short_numbers_truth_values_and_errors():
    assert xls._rk(0x3FF00000) == "1" and xls._rk((12345 << 2 | 3)) == "123.45" and xls._rk((-7 << 2 | 2) & 0xFFFFFFFF) == "-7"
    assert cells_of(io.BytesIO(compound({"Workbook": records({"s": [[True, "x"]]})})))[0][4] == "1"


@pytest.mark.parametrize(
    ("data", "says"),
    [
        (compound({"Workbook": records({"s": PEOPLE}, locked=True)}), "encrypted"),
        (compound({"EncryptedPackage": b"x" * 5000, "EncryptionInfo": b"y"}), "encrypted"),
        (compound({"WordDocument": b"x"}), "without a workbook"),
        (compound({"Workbook": records({"s": PEOPLE})})[:700], ""),
        (xls.MAGIC, ""),
        (b"<html>", "neither"),
        (b"PK<html>", ""),
    ],
)
def test_what_is_no_readable_workbook_is_an_error_row(spark, tmp_path, data, says):
    (tmp_path / "a.xls").write_bytes(data)
    workbook(tmp_path / "b.xlsx", {"s": [["x"], ["y"]]})
    cells = xlsx.read_cells(spark, str(tmp_path))
    errors = xlsx.read_errors(cells).collect()
    assert len(errors) == 1 and errors[0].file.endswith("a.xls") and says in errors[0].error
    assert rows(xlsx.readable(cells).select("value")) == [("x",), ("y",)]


def test_old_and_new_workbooks_in_one_folder(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", grids())
    (tmp_path / "b.xls").write_bytes(compound({"Workbook": records(grids())}))
    (tmp_path / "c.xls").write_bytes((tmp_path / "a.xlsx").read_bytes())  # a new one by an old name
    by = {f.rsplit("/", 1)[1]: n for f, n in rows(xlsx.read_cells(spark, str(tmp_path)).groupBy("file").count())}
    assert set(by) == {"a.xlsx", "b.xls", "c.xls"} and len(set(by.values())) == 1


def test_a_large_workbook_is_a_task_a_sheet(spark, tmp_path):
    sheets = {f"s{i}": [[f"h{i}", "x"], *[[i, j] for j in range(50)]] for i in range(20)}
    workbook(tmp_path / "big.xlsx", sheets)
    (tmp_path / "old.xls").write_bytes(compound({"Workbook": records(sheets)}))
    whole, split = (xlsx.read_cells(spark, str(tmp_path), splitBytes=n) for n in (1 << 30, 1))
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() == 40
    assert rows(whole) == rows(split) and whole.count() == 2 * 20 * 102
    each = split.withColumn("task", F.spark_partition_id()).groupBy("file", "sheet").agg(F.countDistinct("task").alias("n"))
    assert {r.n for r in each.collect()} == {1}


class Counted(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


def test_a_scan_ends_with_its_rows(tmp_path):
    r = random.Random(1)
    big = [[f"t{r.getrandbits(60)}" for _ in range(5)] for _ in range(20_000)]
    workbook_inline(tmp_path / "w.xlsx", big)
    source = Counted((tmp_path / "w.xlsx").read_bytes())
    assert len(cells_of(source, last=7)) == 40 and source.taken < len(source.getvalue()) / 5
    assert [c[2] for c in cells_of(Counted((tmp_path / "w.xlsx").read_bytes()), first=3, last=4)] == [3] * 5 + [4] * 5


def workbook_inline(path, grid):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="s" sheetId="1" r:id="r0"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r0" Target="/xl/worksheets/s.xml"/></Relationships>')
        body = "".join("<row>" + "".join(f'<c t="inlineStr"><is><t>{v}</t></is></c>' for v in row) + "</row>" for row in grid)
        z.writestr("xl/worksheets/s.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")


def test_filters_reach_the_scan(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", {"p": [[i] for i in range(30)], "q": [[i] for i in range(30)]})
    (tmp_path / "bad.xlsx").write_bytes(b"x")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        cells = xlsx.read_cells(spark, str(tmp_path), splitBytes=1)
        assert rows(cells.where("row_idx < 3 and sheet = 'q'").select("value")) == [("0",), ("1",), ("2",)]
        assert cells.where("row_idx >= 28").count() == 4 and cells.where("row_idx = 5").count() == 2 and cells.where("row_idx > 3 and row_idx <= 5").count() == 4
        assert xlsx.read_errors(cells).count() == 1
        wanted = cells.where("sheet in ('p') and row_idx < 8")
        assert wanted.rdd.getNumPartitions() <= 2 and wanted.count() == 8
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert xlsx.read_cells(spark, str(tmp_path), lastRow=4).where("sheet is not null").count() == 10
    reader = xlsx.PushedReader(str(tmp_path), True)
    list(reader.pushFilters([xlsx.LessThan(("row_idx",), 8), xlsx.In(("sheet",), ("p",))]))
    assert (reader.wanted.last, reader.wanted.sheets) == (7, {"p"}) and {r[1] for r in reader.read(reader.partitions()[0])} == {"p", None}
