"""ZIP archives of CSV members and XLSX workbooks as Spark data sources.

``register(spark)`` adds the formats ``zipped_csv`` and ``xlsx_cells``. A partition is planned for each member or sheet; a task streams it and
holds a batch of rows (and, for a workbook, its shared texts). Paths are files, folders or stores that Arrow's file systems reach.
Both formats can be written as well, one archive a task.
"""

from __future__ import annotations

import csv
import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from itertools import islice
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

from sparkloom.sources.files import snake

BATCH = 4096
CELLS = "file string, sheet string, row int, col int, value string"
#: Name spaces of workbooks, and built-in formats of dates and times (fixed values).
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def files_below(path: str, ending: str) -> list[str]:
    """Files with an ending at a path or below it, sorted, as URIs or paths that ``open_file`` takes."""
    store, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    info = store.get_file_info(place)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(place, recursive=True))
    prefix = path.partition("://")[0] + "://" if "://" in path else "file:" if path.startswith("file:") else ""
    return sorted(prefix + i.path for i in found if i.type == fs.FileType.File and i.path.lower().endswith(ending))


def open_file(path: str):
    """A seekable file."""
    store, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(place)


def batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length."""
    while part := list(islice(rows, BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


@dataclass
class Member(InputPartition):
    file: str
    member: str
    title: str = ""


class ZippedCsv(DataSource):
    """Options: ``path``, ``sep`` (sniffed from the first header if unset), ``encoding``, ``columns`` (wanted ones, comma-separated), ``ragged`` (``keep`` fills short rows with nulls, ``skip`` leaves them out).

    Members ending in .csv, .txt or .tsv are tables with a header; all columns are text, named in snake case and found by name in each member, empty
    cells null. ``archive`` and ``member`` name where a row comes from.
    """

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def separator(self, line: str) -> str:
        given = self.options.get("sep")
        return {"\\t": "\t"}.get(given, given) if given else max("|,;\t", key=lambda c: (line.count(c), -"|,;\t".index(c)))

    def members(self) -> list[Member]:
        found = []
        for path in files_below(self.options["path"], ".zip"):
            with open_file(path) as f, zipfile.ZipFile(f) as archive:
                found += [Member(path, m) for m in sorted(archive.namelist()) if m.lower().endswith((".csv", ".txt", ".tsv"))]
        return found

    def header(self, stream: io.TextIOWrapper) -> tuple[list[str], str]:
        first = stream.readline()
        separator = self.separator(first)
        return [snake(c) for c in next(csv.reader([first], delimiter=separator), [])], separator

    def schema(self) -> StructType:
        wanted = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        if not wanted:
            for part in self.members()[:1]:
                with open_file(part.file) as f, zipfile.ZipFile(f) as archive, archive.open(part.member) as raw:
                    wanted = self.header(io.TextIOWrapper(raw, self.options.get("encoding", "utf-8-sig"), newline=""))[0]
        return StructType([StructField(c, StringType()) for c in ("archive", "member", *wanted)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return ZippedReader(self, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArchiveWriter(self.options, "csv")


class ZippedReader(DataSourceReader):
    def __init__(self, source: ZippedCsv, schema: StructType):
        self.source, self.columns = source, schema.fieldNames()

    def partitions(self) -> list[InputPartition]:
        return self.source.members()

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Member):  # nothing to read
            return
        with open_file(partition.file) as f, zipfile.ZipFile(f) as archive, archive.open(partition.member) as raw:
            stream = io.TextIOWrapper(raw, self.source.options.get("encoding", "utf-8-sig"), newline="")
            header, separator = self.source.header(stream)
            places = [header.index(c) if c in header else None for c in self.columns[2:]]
            skip = self.source.options.get("ragged", "keep") == "skip"

            def rows() -> Iterator[tuple]:
                for row in csv.reader(stream, delimiter=separator):
                    if not row or (skip and len(row) < len(header)):
                        continue
                    yield (partition.file.rpartition("/")[2], partition.member, *[row[p].strip() or None if p is not None and p < len(row) else None for p in places])

            yield from batches(rows(), pa.schema([(c, pa.string()) for c in self.columns]))


class XlsxCells(DataSource):
    """Option ``path``: the filled cells of all sheets of all workbooks, ``(file, sheet, row, col, value)``, counted from 1; dates are ISO text."""

    @classmethod
    def name(cls) -> str:
        return "xlsx_cells"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema: StructType) -> DataSourceReader:
        return XlsxReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArchiveWriter(self.options, "xlsx")


class XlsxReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        found = []
        for path in files_below(self.path, ".xlsx"):
            with open_file(path) as f, zipfile.ZipFile(f) as book:
                targets = {r.get("Id"): r.get("Target") for r in ElementTree.parse(book.open("xl/_rels/workbook.xml.rels")).getroot()}
                for sheet in ElementTree.parse(book.open("xl/workbook.xml")).getroot().iter(f"{MAIN}sheet"):
                    target = targets[sheet.get(LINK)]
                    found.append(Member(path, target.lstrip("/") if target.startswith("/") else f"xl/{target}", sheet.get("name")))
        return found

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Member):
            return
        with open_file(partition.file) as f, zipfile.ZipFile(f) as book:
            texts, dates, start = shared_texts(book), date_styles(book), first_day(book)
            name = partition.file.rpartition("/")[2]

            def rows() -> Iterator[tuple]:
                with book.open(partition.member) as raw:
                    for row, col, value in sheet_cells(raw, texts, dates, start):
                        yield name, partition.title, row, col, value

            yield from batches(rows(), pa.schema([("file", pa.string()), ("sheet", pa.string()), ("row", pa.int32()), ("col", pa.int32()), ("value", pa.string())]))


def elements(raw, tag: str) -> Iterator[ElementTree.Element]:
    """Closed elements of a tag; what has been read is let go."""
    root = None
    for event, e in ElementTree.iterparse(raw, events=("start", "end")):
        root = e if root is None else root
        if event == "end" and e.tag == tag:
            yield e
            e.clear()
            if root is not e:
                root.clear()


def shared_texts(book: zipfile.ZipFile) -> list[str]:
    """A workbook's shared texts, without readings."""
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as raw:
        return [plain_text(e) for e in elements(raw, f"{MAIN}si")]


def plain_text(e: ElementTree.Element) -> str:
    return "".join(t.text or "" for part in e for t in ([part] if part.tag == f"{MAIN}t" else part.findall(f"{MAIN}t") if part.tag == f"{MAIN}r" else []))


def date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show dates."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.parse(book.open("xl/styles.xml")).getroot()
    own = {int(f.get("numFmtId")) for f in root.iter(f"{MAIN}numFmt") if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")).lower())}
    return {i for i, x in enumerate(root.find(f"{MAIN}cellXfs") or []) if int(x.get("numFmtId", 0)) in DATE_FORMATS | own}


def first_day(book: zipfile.ZipFile) -> datetime:
    """Day 0 of the workbook's serial dates."""
    flag = ElementTree.parse(book.open("xl/workbook.xml")).getroot().find(f"{MAIN}workbookPr")
    return datetime(1904, 1, 1) if flag is not None and flag.get("date1904") in ("1", "true") else datetime(1899, 12, 30)


def sheet_cells(raw, texts: list[str], dates: set[int], start: datetime) -> Iterator[tuple[int, int, str]]:
    """``(row, column, value)`` of a sheet's filled cells, row by row."""
    row = 0
    for e in elements(raw, f"{MAIN}row"):
        row = int(e.get("r", row + 1))
        col = 0
        for cell in e.iter(f"{MAIN}c"):
            letters = re.match("[A-Z]+", cell.get("r", ""))
            col = sum((ord(c) - 64) * 26**i for i, c in enumerate(reversed(letters[0]))) if letters else col + 1
            kind, value = cell.get("t", "n"), cell.findtext(f"{MAIN}v")
            if kind == "inlineStr":
                value = "".join(plain_text(x) for x in cell.iter(f"{MAIN}is"))
            elif kind == "s" and value:
                value = texts[int(value)]
            elif kind == "b":
                value = {"1": "true", "0": "false"}.get(value, value)
            elif kind == "n" and value and int(cell.get("s", 0)) in dates:
                at = start + timedelta(seconds=round(float(value) * 86400))
                value = at.date().isoformat() if at.time() == datetime.min.time() else at.isoformat(sep=" ")
            if value not in (None, ""):
                yield row, col, value


@dataclass
class Written(WriterCommitMessage):
    path: str


class ArchiveWriter(DataSourceArrowWriter):
    """One archive a task: a CSV member with a header, or a workbook of one sheet with ``title`` lines above the header.

    Files have names of their own, and those of tasks that failed are deleted; the folder is only added to.
    """

    def __init__(self, options, kind: str):
        self.options, self.kind = dict(options), kind

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        path = self.options["path"]
        store, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        store.create_dir(place, recursive=True)
        file = f"{place}/part-{uuid.uuid4().hex}.{'zip' if self.kind == 'csv' else 'xlsx'}"
        try:
            with store.open_output_stream(file) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                (self.as_csv if self.kind == "csv" else self.as_sheet)(archive, batches)
        except BaseException:
            store.delete_file(file)
            raise
        return Written(file)

    def as_csv(self, archive: zipfile.ZipFile, batches: Iterator[pa.RecordBatch]) -> None:
        with archive.open("rows.csv", "w") as raw:
            stream = io.TextIOWrapper(raw, self.options.get("encoding", "utf-8-sig"), newline="")
            lines = csv.writer(stream, delimiter=self.options.get("sep", ";"))
            for i, batch in enumerate(batches):
                if not i:
                    lines.writerow(batch.schema.names)
                lines.writerows(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            stream.flush()
            stream.detach()

    def as_sheet(self, archive: zipfile.ZipFile, batches: Iterator[pa.RecordBatch]) -> None:
        main, links = MAIN[1:-1], LINK[1:].rpartition("}")[0]
        archive.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets><sheet name="{escape(self.options.get("sheet", "rows"))}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        archive.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{links}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        archive.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        archive.writestr("_rels/.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{links}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        with archive.open("xl/worksheets/sheet1.xml", "w") as raw:
            raw.write(f'<worksheet xmlns="{main}"><sheetData>'.encode())
            for i, batch in enumerate(batches):
                if not i:
                    head = [[line] for line in self.options.get("title", "").split("\n") if line] + [batch.schema.names]
                    raw.write("".join(map(self.line, head)).encode())
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    raw.write(self.line(row).encode())
            raw.write(b"</sheetData></worksheet>")

    @staticmethod
    def line(row) -> str:
        cell = lambda v: "<c/>" if v is None else f"<c><v>{v}</v></c>" if isinstance(v, int | float) and not isinstance(v, bool) else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'
        return f"<row>{''.join(map(cell, row))}</row>"

    def abort(self, messages) -> None:
        for m in messages:
            if m is not None:
                path = self.options["path"]
                store = fs.FileSystem.from_uri(path)[0] if "://" in path or path.startswith("file:") else fs.LocalFileSystem()
                store.delete_file(m.path)


def register(spark: SparkSession) -> SparkSession:
    """The session with both formats."""
    spark.dataSource.register(ZippedCsv)
    spark.dataSource.register(XlsxCells)
    return spark
