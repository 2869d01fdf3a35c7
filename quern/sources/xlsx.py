"""Spreadsheets as a Spark data source, read and written with the stdlib only.

``spark.read.format("xlsx").option("sheet", ...).load(path)`` gives _row_idx
(the physical row, 1-based) and c0..cN as strings: cached values of formula
cells, NULL for gaps. One partition per file. Rows are streamed from the zip
entry; only the shared strings are held.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DEFAULT_COLUMNS = 43


def _column(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, el in ElementTree.iterparse(f):
            if el.tag == _MAIN + "si":
                # phonetic runs aren't part of the text
                out.append("".join(t.text or "" for r in (el, *el.findall(_MAIN + "r")) for t in r.findall(_MAIN + "t")))
                el.clear()
    return out


def sheet_names(path: str) -> list[str]:
    with zipfile.ZipFile(path) as book:
        return [name for name, _ in _sheets(book)]


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    out = []
    for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(_MAIN + "sheet"):
        target = rels[s.get(_REL)]
        out.append((s.get("name"), target.lstrip("/") if target.startswith("/") else "xl/" + target))
    return out


def _number(text: str) -> str:
    """A cell's number as text: whole numbers without a decimal point."""
    try:
        v = float(text)
    except ValueError:
        return text
    return str(int(v)) if v == int(v) and abs(v) < 1e15 else repr(v)


def read_rows(path: str, sheet: str | None = None) -> Iterator[tuple[int, list[str | None]]]:
    """(physical row, cells) of a sheet; the first sheet if none is named."""
    with zipfile.ZipFile(path) as book:
        sheets = _sheets(book)
        target = sheets[0][1] if sheet is None else dict(sheets)[sheet]
        strings = _strings(book)
        at = 0
        with book.open(target) as f:
            for _, el in ElementTree.iterparse(f):
                if el.tag != _MAIN + "row":
                    continue
                at = int(el.get("r") or at + 1)
                cells: list[str | None] = []
                for c in el.findall(_MAIN + "c"):
                    i = _column(c.get("r")) if c.get("r") else len(cells)
                    kind, v = c.get("t"), c.find(_MAIN + "v")
                    value: str | None
                    if kind == "inlineStr":
                        inner = c.find(_MAIN + "is")
                        value = "".join(t.text or "" for t in inner.iter(_MAIN + "t")) if inner is not None else None
                    elif v is None or v.text is None:
                        value = None
                    elif kind == "s":
                        value = strings[int(v.text)]
                    elif kind == "b":
                        value = "True" if v.text == "1" else "False"
                    else:
                        value = v.text if kind in ("str", "e") else _number(v.text)
                    cells += [None] * (i + 1 - len(cells))
                    cells[i] = value
                el.clear()
                yield at, cells


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options, width: int):
        self.paths = [p for p in re.split(r"\s*,\s*", options["path"]) if p]
        self.sheet, self.width = options.get("sheet"), width

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, partition):
        width = self.width
        for at, cells in read_rows(partition.path.removeprefix("file://"), self.sheet):
            yield (at, *(cells[:width] + [None] * (width - len(cells))))


class XlsxSource(DataSource):
    """Options: path (several with commas), sheet, columns (default 43)."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _width(self) -> int:
        return int(self.options.get("columns", DEFAULT_COLUMNS))

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("_row_idx", T.IntegerType())] + [T.StructField(f"c{i}", T.StringType()) for i in range(self._width())])

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, self._width())


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None, columns: int = DEFAULT_COLUMNS) -> DataFrame:
    spark.dataSource.register(XlsxSource)
    reader = spark.read.format("xlsx").option("columns", columns)
    return (reader.option("sheet", sheet) if sheet else reader).load(path)


def _ref(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


_TYPES = """<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{}</Types>"""
_ROOT = """<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>"""


def write_rows(path: str, sheets: Sequence[tuple[str, Iterable[Sequence]]]) -> None:
    """Writes a workbook; rows are streamed, text cells stand inline."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        n = len(sheets)
        part = '<Override PartName="/xl/worksheets/sheet{}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
        book.writestr("[Content_Types].xml", _TYPES.format("".join(part.format(i + 1) for i in range(n))))
        book.writestr("_rels/.rels", _ROOT)
        listed = "".join(f'<sheet name="{escape(name, {chr(34): "&quot;"})}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, (name, _) in enumerate(sheets))
        book.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL[1:-3]}"><sheets>{listed}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{i + 1}" Type="{_REL[1:-3]}/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(n))
        book.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for i, (_, rows) in enumerate(sheets):
            with book.open(f"xl/worksheets/sheet{i + 1}.xml", "w") as f:
                f.write(f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{_MAIN[1:-1]}"><sheetData>'.encode())
                for r, row in enumerate(rows, 1):
                    f.write(f'<row r="{r}">'.encode())
                    for c, v in enumerate(row):
                        if v is None or v == "" or (isinstance(v, float) and v != v):
                            continue
                        at = f"{_ref(c)}{r}"
                        if isinstance(v, bool):
                            cell = f'<c r="{at}" t="b"><v>{int(v)}</v></c>'
                        elif isinstance(v, int | float):
                            cell = f'<c r="{at}"><v>{v!r}</v></c>'
                        else:
                            text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", str(v))
                            cell = f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
                        f.write(cell.encode())
                    f.write(b"</row>")
                f.write(b"</sheetData></worksheet>")


def write_xlsx(df: DataFrame, path: str, title: str = "Sheet1", header: bool = True) -> None:
    """A (small) result table as a workbook: rows come partition by partition;
    an empty table still gets its header. Large results belong in parquet."""

    def rows() -> Iterator[Sequence]:
        if header:
            yield list(df.columns)
        for r in df.toLocalIterator():
            yield list(r)

    write_rows(path, [(title, rows())])
