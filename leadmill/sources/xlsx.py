"""Workbooks: a reader and a writer for the sheet format, on the standard library, and a data source."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def _letters(n: int) -> str:
    out = ""
    while n >= 0:
        out, n = chr(65 + n % 26) + out, n // 26 - 1
    return out


def sheet_names(path: str) -> list[str]:
    with zipfile.ZipFile(path) as z:
        return [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]


def read_rows(path: str, sheet: str | None = None) -> Iterator[list[str | None]]:
    """The rows of a sheet (the first one by default) as lists of texts, one by one."""
    with zipfile.ZipFile(path) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter(f"{_PACKAGE}Relationship")}
        sheets = {s.get("name"): targets[s.get(f"{_REL}id")] for s in book.iter(f"{_MAIN}sheet")}
        target = sheets[sheet] if sheet is not None else next(iter(sheets.values()))
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        with z.open("xl/" + target.lstrip("/").removeprefix("xl/")) as f:
            for _, element in ElementTree.iterparse(f):
                if element.tag != f"{_MAIN}row":
                    continue
                row: list[str | None] = []
                for cell in element.iter(f"{_MAIN}c"):
                    at = _column(cell.get("r")) if cell.get("r") else len(row)
                    row += [None] * (at + 1 - len(row))
                    value, kind = cell.find(f"{_MAIN}v"), cell.get("t")
                    if kind == "inlineStr":
                        row[at] = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                    elif value is not None:
                        row[at] = shared[int(value.text)] if kind == "s" else value.text
                yield row
                element.clear()


def write_rows(path: str, header: list[str], rows: Iterator[tuple], sheet: str = "Sheet1") -> int:
    """A workbook with one sheet: bold frozen header, column widths, texts and numbers. Rows are streamed."""
    count = 0
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        main, rel = _MAIN[1:-1], _REL[1:-1]
        z.writestr("[Content_Types].xml", head + '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>')
        z.writestr("_rels/.rels", head + f'<Relationships xmlns="{_PACKAGE[1:-1]}"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", head + f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", head + f'<Relationships xmlns="{_PACKAGE[1:-1]}"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", head + f'<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>')
        with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as f:
            widths = "".join(f'<col min="{i}" max="{i}" width="{min(60, max(12, len(h or "") + 4))}" customWidth="1"/>' for i, h in enumerate(header, 1))
            f.write((head + f'<worksheet xmlns="{main}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews><cols>{widths}</cols><sheetData>').encode())
            f.write(_row(1, header, bold=True))
            for count, row in enumerate(rows, 1):
                f.write(_row(count + 1, row))
            f.write(b"</sheetData></worksheet>")
    return count


def _row(number: int, values, bold: bool = False) -> bytes:
    cells = []
    for k, v in enumerate(values):
        at = f"{_letters(k)}{number}"
        if v is None:
            continue
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            cells.append(f'<c r="{at}"><v>{v}</v></c>')
        else:
            safe = escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(v)))
            cells.append(f'<c r="{at}" t="inlineStr"{" s=" + chr(34) + "1" + chr(34) if bold else ""}><is><t xml:space="preserve">{safe}</t></is></c>')
    return f'<row r="{number}">{"".join(cells)}</row>'.encode()


class _Part(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, width: int, path: str, sheet: str | None, header: int) -> None:
        self.width, self.path, self.sheet, self.header = width, path, sheet, header

    def partitions(self):
        return [_Part(0)]

    def read(self, _):
        for k, row in enumerate(read_rows(self.path, self.sheet)):
            if k > self.header and any(v is not None for v in row):
                yield tuple((row + [None] * self.width)[: self.width])


class XlsxSource(DataSource):
    """``spark.read.format("xlsx")`` with options path, sheet, headerRow; all columns are texts."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> StructType:
        skip = int(self.options.get("headerRow", "0"))
        for k, row in enumerate(read_rows(self.options["path"], self.options.get("sheet"))):
            if k == skip:
                return StructType([StructField((v or f"_c{i}").strip(), StringType()) for i, v in enumerate(row)])
        return StructType([])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(len(schema.fields), self.options["path"], self.options.get("sheet"), int(self.options.get("headerRow", "0")))


def register(spark) -> None:
    spark.dataSource.register(XlsxSource)
