"""Spreadsheet workbooks (zipped XML) as tables: a reader with a partition per sheet, and a writer of a workbook per group.

``spark.read.format("workbook").load(folder)`` gives (file, sheet, row, cells): a sheet's rows in order with their cells as text, empty ones
null. Sheets are parsed as a stream, row by row; a workbook's shared strings are held while one of its sheets is read. Dates are
numbers with a date's format and come as ISO text, truth values as ``true`` and ``false``, errors and empty cells as null. A row that the sheet
leaves out has no row here. ``header_rows`` turns the first row into column names.
"""

from __future__ import annotations

import datetime
import io
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Names of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REFERENCE = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMATS = frozenset((*range(14, 23), 27, 30, 36, 45, 46, 47, 50, 57))
EPOCH = datetime.datetime(1899, 12, 30)
#: Rows that a sheet can have; further ones go to a further sheet.
SHEET_ROWS = 1_048_576
CELL = re.compile(r"([A-Z]+)")


@dataclass
class Sheet(InputPartition):
    file: str
    name: str
    entry: str


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _open(path: str) -> zipfile.ZipFile:
    fs, at = _filesystem(path)
    return zipfile.ZipFile(fs.open_input_file(at))


def _workbooks(path: str) -> list[str]:
    fs, at = _filesystem(path)
    info = fs.get_file_info(at)
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    if info.type == pafs.FileType.File:
        return [path]
    return sorted(prefix + f.path for f in fs.get_file_info(pafs.FileSelector(at, recursive=True)) if f.path.endswith(".xlsx") and not f.base_name.startswith("~"))


def sheets_of(path: str) -> list[Sheet]:
    """The sheets of a workbook, in their order."""
    with _open(path) as book:
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        found = ET.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")
        return [Sheet(path, s.get("name"), posixpath.normpath(posixpath.join("xl", targets[s.get(REFERENCE)])).lstrip("/").replace("xl/xl/", "xl/")) for s in found]


def _texts(book: zipfile.ZipFile) -> list[str]:
    """Shared strings; the runs of a formatted one are joined."""
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, node in ET.iterparse(part):
            if node.tag == f"{MAIN}si":
                out.append("".join(t.text or "" for t in node.iter(f"{MAIN}t")))
                node.clear()
    return out


def _date_styles(book: zipfile.ZipFile) -> list[bool]:
    """Of every cell style whether it shows a date."""
    if "xl/styles.xml" not in book.namelist():
        return []
    root = ET.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode") or "") for f in root.iter(f"{MAIN}numFmt")}
    styles = root.find(f"{MAIN}cellXfs")
    ids = [int(x.get("numFmtId") or 0) for x in styles] if styles is not None else []
    return [i in DATE_FORMATS or bool(re.search(r"[dmyhs]", own.get(i, ""), re.IGNORECASE)) for i in ids]


def _column(reference: str) -> int:
    number = 0
    for letter in CELL.match(reference)[1]:
        number = number * 26 + ord(letter) - 64
    return number - 1


def _shown(cell: ET.Element, texts: list[str], dates: list[bool]) -> str | None:
    kind, value = cell.get("t", "n"), cell.findtext(f"{MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{MAIN}t"))
    if value is None or kind == "e":
        return None
    if kind == "s":
        return texts[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    style = int(cell.get("s") or 0)
    if kind == "n" and style < len(dates) and dates[style]:
        moment = EPOCH + datetime.timedelta(seconds=round(float(value) * 86_400))
        return moment.date().isoformat() if moment.time() == datetime.time() else moment.isoformat()
    return value


def read_sheet(sheet: Sheet) -> Iterator[tuple[int, list[str | None]]]:
    """(row number from 1, cells) of a sheet."""
    with _open(sheet.file) as book:
        texts, dates, number = _texts(book), _date_styles(book), 0
        with book.open(sheet.entry) as part:
            for _, node in ET.iterparse(part):
                if node.tag == f"{MAIN}row":
                    number = int(node.get("r") or number + 1)
                    cells: list[str | None] = []
                    for c in node.iter(f"{MAIN}c"):
                        at = _column(c.get("r")) if c.get("r") else len(cells)
                        cells.extend([None] * (at - len(cells)))
                        cells.append(_shown(c, texts, dates))
                    yield number, cells
                    node.clear()


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[InputPartition]:
        return [s for book in _workbooks(self.path) for s in sheets_of(book)] or [Sheet("", "", "")]

    def read(self, partition: Sheet) -> Iterator[tuple]:
        if partition.file:
            for number, cells in read_sheet(partition):
                yield partition.file, partition.name, number, cells


class Workbook(DataSource):
    """Register with ``spark.dataSource.register(Workbook)``."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return "file string, sheet string, row long, cells array<string>"

    def reader(self, schema) -> DataSourceReader:
        return WorkbookReader(self.options)


def header_rows(rows: DataFrame, names: list[str]) -> DataFrame:
    """The named columns of every sheet, found by its first row; sheets may order them differently."""
    heads = rows.where("row = 1").select("file", "sheet", F.col("cells").alias("_head"))
    body = rows.where("row > 1").join(heads, ["file", "sheet"])
    place = lambda n: F.array_position("_head", F.lit(n)).cast("int")
    return body.select("file", "sheet", "row", *[F.when(place(n) > 0, F.get("cells", place(n) - 1)).alias(n) for n in names])


def _cell(value, number: int, column: int, texts: dict[str, int]) -> str:
    letters, at = "", column + 1
    while at:
        at, left = divmod(at - 1, 26)
        letters = chr(65 + left) + letters
    place = f'r="{letters}{number}"'
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c {place} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float):
        return f"<c {place}><v>{value!r}</v></c>"
    if isinstance(value, datetime.datetime | datetime.date):
        moment = value if isinstance(value, datetime.datetime) else datetime.datetime(value.year, value.month, value.day)
        return f'<c {place} s="1"><v>{(moment.replace(tzinfo=None) - EPOCH).total_seconds() / 86_400!r}</v></c>'
    return f'<c {place} t="s"><v>{texts.setdefault(str(value), len(texts))}</v></c>'


def workbook_bytes(tables: dict[str, tuple[list[str], list[tuple]]]) -> bytes:
    """A workbook of sheets (name, then column names and rows)."""
    texts: dict[str, int] = {}
    parts = [(f"{name[:25]} {i + 1}" if i else name[:31], head, rows[at : at + SHEET_ROWS - 1]) for name, (head, rows) in tables.items() for i, at in enumerate(range(0, max(1, len(rows)), SHEET_ROWS - 1))]
    space, package = MAIN[1:-1], "http://schemas.openxmlformats.org/package/2006"
    office = REFERENCE[1 : REFERENCE.index("}")]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for i, (_, head, rows) in enumerate(parts, 1):
            lines = [f'<row r="{n}">{"".join(_cell(v, n, c, texts) for c, v in enumerate(row))}</row>' for n, row in enumerate([tuple(head), *rows], 1)]
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{space}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
        listed = "".join(f'<sheet name="{escape(name, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, (name, _, _) in enumerate(parts, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{space}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>')
        kinds = [(f"rId{i}", "worksheet", f"worksheets/sheet{i}.xml") for i in range(1, len(parts) + 1)] + [("rIdS", "styles", "styles.xml"), ("rIdT", "sharedStrings", "sharedStrings.xml")]
        links = "".join(f'<Relationship Id="{i}" Type="{office}/{kind}" Target="{target}"/>' for i, kind, target in kinds)
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">{links}</Relationships>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{space}"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{space}">{"".join(f"<si><t xml:space={chr(34)}preserve{chr(34)}>{escape(t)}</t></si>" for t in texts)}</sst>')
        sheet = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        kinds = [("workbook.xml", "sheet.main"), ("styles.xml", "styles"), ("sharedStrings.xml", "sharedStrings")] + [(f"worksheets/sheet{i}.xml", "worksheet") for i in range(1, len(parts) + 1)]
        overrides = "".join(f'<Override PartName="/xl/{p}" ContentType="{sheet}.{k}+xml"/>' for p, k in kinds)
        book.writestr("[Content_Types].xml", f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>{overrides}</Types>')
    return out.getvalue()


def write_workbooks(df: DataFrame, folder: str, by: str) -> DataFrame:
    """A workbook for every value of ``by`` (its sheet's name), written by the tasks under ``folder``; their (file, rows).

    A report's group is meant to be read by people, so a task holds it; a file is there in whole or not at all.
    """
    names = [c for c in df.columns if c != by]

    def write(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        fs, at = _filesystem(folder)
        fs.create_dir(at)
        rows = list(zip(*(group[n].to_pylist() for n in names)))
        target, draft = f"{at}/{uuid.uuid5(uuid.NAMESPACE_OID, repr(key[0].as_py())).hex}.xlsx", f"{at}/draft-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as file:
            file.write(workbook_bytes({str(key[0].as_py()): (names, rows)}))
        fs.move(draft, target)
        return pa.table({"file": pa.array([target], pa.string()), "n": pa.array([len(rows)], pa.int64())})

    return df.groupBy(by).applyInArrow(write, "file string, n long")
