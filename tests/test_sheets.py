"""Workbooks: what is written is read again, and a workbook made by hand."""

import datetime
import zipfile

from pyspark.sql import functions as F

from folioscope.sources import sheets

SPACE = sheets.MAIN[1:-1]
HAND = {
    "xl/workbook.xml": f'<workbook xmlns="{SPACE}" xmlns:r="{sheets.REFERENCE[1:-3]}"><sheets><sheet name="A &amp; B" sheetId="1" r:id="x"/><sheet name="Second" sheetId="2" r:id="y"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="p"><Relationship Id="y" Target="worksheets/b.xml"/><Relationship Id="x" Target="/xl/worksheets/a.xml"/></Relationships>',
    "xl/sharedStrings.xml": f'<sst xmlns="{SPACE}"><si><t>name</t></si><si><r><t>two </t></r><r><t>runs</t></r></si></sst>',
    "xl/styles.xml": f'<styleSheet xmlns="{SPACE}"><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/><numFmt numFmtId="171" formatCode="0.0 &quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>',
    "xl/worksheets/a.xml": f'<worksheet xmlns="{SPACE}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="4"><c r="A4" s="1"><v>43831.5</v></c><c r="B4" s="2"><v>43831</v></c><c r="C4" s="3"><v>2.5</v></c><c r="D4" t="b"><v>1</v></c><c r="E4" t="e"><v>#N/A</v></c><c r="AA4" t="inlineStr"><is><t>far</t></is></c></row></sheetData></worksheet>',
    "xl/worksheets/b.xml": f'<worksheet xmlns="{SPACE}"><sheetData/></worksheet>',
}


def test_a_workbook_made_by_hand(spark, tmp_path):
    with zipfile.ZipFile(f"{tmp_path}/hand.xlsx", "w") as book:
        for name, content in HAND.items():
            book.writestr(name, content)
    spark.dataSource.register(sheets.Workbook)
    got = sorted(spark.read.format("workbook").load(str(tmp_path)).collect(), key=lambda r: r.row)
    assert [(r.sheet, r.row) for r in got] == [("A & B", 1), ("A & B", 4)]
    assert got[0].cells == ["name", None, "two runs"]
    assert got[1].cells == ["2020-01-01T12:00:00", "2020-01-01", "2.5", "true", None, *[None] * 21, "far"]
    assert [s.name for s in sheets.sheets_of(f"{tmp_path}/hand.xlsx")] == ["A & B", "Second"]


def test_round_trip(spark, tmp_path, monkeypatch):
    rows = [("g1", "a <b> & c", 1, 2.5, True, datetime.date(2024, 2, 29)), ("g1", None, None, None, None, None), ("g1", " é ", -3, 1e-9, False, datetime.date(1999, 12, 31)), ("g 2", "x", 4, 0.0, None, None)]
    df = spark.createDataFrame(rows, "grp string, t string, n long, d double, b boolean, day date")
    monkeypatch.setattr(sheets, "SHEET_ROWS", 3)
    made = sheets.workbook_bytes({"big": (["t"], [(f"r{i}",) for i in range(5)])})
    (tmp_path / "x.xlsx").write_bytes(made)
    assert [(s.name, list(sheets.read_sheet(s))[1:]) for s in sheets.sheets_of(f"{tmp_path}/x.xlsx")] == [("big", [(2, ["r0"]), (3, ["r1"])]), ("big 2", [(2, ["r2"]), (3, ["r3"])]), ("big 3", [(2, ["r4"])])]
    monkeypatch.undo()
    assert sorted(r.n for r in sheets.write_workbooks(df, f"{tmp_path}/out", "grp").collect()) == [1, 3]
    spark.dataSource.register(sheets.Workbook)
    names = ["day", "t", "n", "d", "b", "none"]
    got = sheets.header_rows(spark.read.format("workbook").load(f"{tmp_path}/out"), names).orderBy("sheet", "row").select("sheet", *names).collect()
    text = lambda v: None if v is None else str(v).lower() if isinstance(v, bool) else repr(v) if isinstance(v, float) else str(v)
    assert [tuple(r) for r in got if r.sheet == "g1"] == [("g1", text(r[5]), r[1], text(r[2]), text(r[3]), text(r[4]), None) for r in rows[:3]]
    assert spark.read.format("workbook").load(f"{tmp_path}/out").where(F.col("row") == 1).count() == 2
