"""Spreadsheets as a data source: ``df.write.format("xlsx").save("sheet.xlsx")`` makes one OOXML file.

Tasks write their rows as fragments of a worksheet; the commit, on the driver, streams them into one file and puts that in place, so
that a reader finds the whole file or none. A worksheet that is full is followed by another.
"""

from __future__ import annotations

import re
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from xml.sax.saxutils import escape

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Rows of a worksheet, and characters of a cell, that the format allows; rows that set a column's width; the widest column.
MOST_ROWS, MOST_CHARS, WIDTH_ROWS, WIDEST = 1_048_576, 32_767, 500, 60
# The format's names.
MAIN, OFFICE, PACKAGE = (
    "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org/package/2006",
)
KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml."
_NOT_XML = re.compile(r"[^\t\n\r\x20-퟿-�\U00010000-\U0010FFFF]")


@dataclass
class Fragment(WriterCommitMessage):
    """What a task wrote: files of at most a worksheet's rows each, and the sizes of its first rows' values by column."""

    part: int
    files: tuple[tuple[str, int], ...]
    sizes: tuple[tuple[int, ...], ...]


def _cell(value: object) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and value == value and abs(value) != float("inf"):
        return f"<c><v>{value!r}</v></c>"
    text = escape(_NOT_XML.sub("", str(value))[:MOST_CHARS])
    return f'<c t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def _row(values: tuple) -> str:
    return f"<row>{''.join(map(_cell, values))}</row>\n"


class XlsxWriter(DataSourceWriter):
    def __init__(self, options: Mapping[str, str], schema: StructType, overwrite: bool) -> None:
        self.path, self.overwrite, self.sheet = options["path"], overwrite, options.get("sheetName", "Sheet1")
        self.most, self.names = int(options.get("rowsPerSheet", MOST_ROWS)), schema.names
        self.fragments = f"{self.path}-{uuid.uuid4().hex}"

    def _open(self, path: str) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def write(self, rows: Iterator[Row]) -> Fragment:
        system, folder = self._open(self.fragments)
        system.create_dir(folder, recursive=True)
        part, files, sizes, out, n = TaskContext.get().partitionId(), [], [], None, 0
        try:
            for row in rows:
                if out is None or n == self.most - 1:  # the header has a row, too
                    if out is not None:
                        out.close()
                        files.append((name, n))
                    name, n = f"{self.fragments}/{uuid.uuid4().hex}", 0
                    out = system.open_output_stream(self._open(name)[1])
                if len(sizes) < WIDTH_ROWS:
                    sizes.append(tuple(len(str(v)) for v in row))
                out.write(_row(tuple(row)).encode())
                n += 1
        finally:
            if out is not None:
                out.close()
                files.append((name, n))
        return Fragment(part, tuple(files), tuple(sizes))

    def commit(self, messages: list[Fragment | None]) -> None:
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.part)
        sizes = [s for m in parts for s in m.sizes][:WIDTH_ROWS]
        widths = [min(max([len(name), *(s[i] for s in sizes)]) + 2, WIDEST) for i, name in enumerate(self.names)]
        system, target = self._open(self.path)
        fresh = f"{target}-{uuid.uuid4().hex}"
        with system.open_output_stream(fresh) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED, allowZip64=True) as book:
            sheets = self._sheets([f for m in parts for f in m.files])
            for number, files in enumerate(sheets, 1):
                with book.open(f"xl/worksheets/sheet{number}.xml", "w", force_zip64=True) as out:
                    columns = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths, 1))
                    out.write(f'<?xml version="1.0" encoding="UTF-8"?>\n<worksheet xmlns="{MAIN}"><cols>{columns}</cols><sheetData>\n'.encode())
                    out.write(_row(tuple(self.names)).encode())
                    for name in files:
                        with system.open_input_stream(self._open(name)[1]) as own:
                            while block := own.read(1 << 20):
                                out.write(block)
                    out.write(b"</sheetData></worksheet>")
            for name, text in self._frame(len(sheets)).items():
                book.writestr(name, f'<?xml version="1.0" encoding="UTF-8"?>\n{text}')
        if self.overwrite and system.get_file_info(target).type == fs.FileType.Directory:
            system.delete_dir(target)
        system.move(fresh, target)
        self.abort(messages)

    def _sheets(self, files: list[tuple[str, int]]) -> list[list[str]]:
        """The fragments of each worksheet, in order; none has more rows than fit under a header."""
        out, room = [[]], self.most - 1
        for name, n in files:
            if n > room:
                out.append([])
                room = self.most - 1
            out[-1].append(name)
            room -= n
        return out

    def _frame(self, sheets: int) -> dict[str, str]:
        ids = range(1, sheets + 1)
        title = lambda i: escape(self.sheet if i == 1 else f"{self.sheet} ({i})", {'"': "&quot;"})
        books = "".join(f'<sheet name="{title(i)}" sheetId="{i}" r:id="rId{i}"/>' for i in ids)
        links = "".join(f'<Relationship Id="rId{i}" Type="{OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in ids)
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{KIND}worksheet+xml"/>' for i in ids)
        default = '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        return {
            "[Content_Types].xml": f'<Types xmlns="{PACKAGE}/content-types">{default}<Override PartName="/xl/workbook.xml" ContentType="{KIND}sheet.main+xml"/>{kinds}</Types>',
            "_rels/.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}"><sheets>{books}</sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}/relationships">{links}</Relationships>',
        }

    def abort(self, messages: list[Fragment | None]) -> None:
        system, folder = self._open(self.fragments)
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class Xlsx(DataSource):
    """Options: ``sheetName`` (Sheet1), ``rowsPerSheet`` (as many as the format allows). The folder of the path must be
    shared by the driver and the executors. Nested columns are written as their text; longer texts than a cell holds are cut, as the format asks."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def writer(self, schema: StructType, overwrite: bool) -> XlsxWriter:
        return XlsxWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Xlsx)
