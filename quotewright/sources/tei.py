"""TEI documents: read from storage, parsed into papers."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.functions.records import PARSED, WARNING

NS = "{http://www.tei-c.org/ns/1.0}"
SHORTEST_FLAT_TABLE = 25


def read_tei(spark: SparkSession, path: str) -> DataFrame:
    """(paper_id, xml) of the *.tei.xml files under ``path``; the id is the file name without .tei.xml."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.tei.xml")
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.tei\.xml$", 1)
    return files.select(name.alias("paper_id"), F.col("value").alias("xml"))


def read_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """(paper_id, path, content) of the PDF files right under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path)
    stem = F.regexp_extract(F.col("path"), r"([^/]*)\.pdf$", 1)
    return files.select(stem.alias("paper_id"), "path", "content")


def _said(node: ET.Element | None) -> str:
    return "" if node is None else " ".join("".join(node.itertext()).split())


def _markdown(table: ET.Element) -> tuple[str, int]:
    """Rows with any text as Markdown, and the number of rows under the first."""
    rows = [[_said(c) for c in row.findall(f"{NS}cell")] for row in table.findall(f"{NS}row")]
    rows = [r for r in rows if any(r)]
    width = max(map(len, rows), default=0)
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
    lines[1:1] = ["|" + "---|" * width] if rows else []
    return "\n".join(lines), max(0, len(rows) - 1)


def _paper(xml: str | None) -> dict | None:
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return None
    sections = []
    body = root.find(f".//{NS}text/{NS}body")
    for div in [] if body is None else body.iter(f"{NS}div"):
        texts = (_said(child) for child in div if child.tag != f"{NS}head")
        if text := " ".join(t for t in texts if t):
            sections.append({"header": _said(div.find(f"{NS}head")) or "(sem titulo)", "text": text})
    figures = [f for text in root.iter(f"{NS}text") for f in text.iter(f"{NS}figure") if f.get("type") == "table"]
    tables, lost = [], []
    for place, figure in enumerate(figures, 1):
        label, caption, table = _said(figure.find(f"{NS}label")) or "table", _said(figure.find(f"{NS}head")), figure.find(f"{NS}table")
        text, n_rows = ("", 0) if table is None else _markdown(table)
        if not text:
            text = _said(figure if table is None else table)
            n_rows = int(len(text) >= SHORTEST_FLAT_TABLE)
        if text and n_rows:
            tables.append({"label": label, "caption": caption, "text": text})
        else:
            lost.append(f"{caption or f'table label={label!r}'} (#{place} de {len(figures)} tabelas no PDF)")
    found = {"title": _said(root.find(f".//{NS}titleStmt/{NS}title")), "abstract": _said(root.find(f".//{NS}abstract"))}
    return found | {"sections": sections, "tables": tables, "empty_table_labels": lost}


def _parse(xml: pa.Array) -> pa.Array:
    pair = lambda *names: pa.list_(pa.struct([(n, pa.string()) for n in names]))
    kind = pa.struct(
        [("title", pa.string()), ("abstract", pa.string()), ("sections", pair("header", "text")), ("tables", pair("label", "caption", "text")), ("empty_table_labels", pa.list_(pa.string()))]
    )
    return pa.array([_paper(x.as_py()) for x in xml], kind)


def parsed(xml: Column) -> Column:
    """A TEI document as struct<title, abstract, sections, tables, empty_table_labels>; null where it is not XML.

    Every division is a section, nested ones both inside their parent and alone. Tables keep rows and columns as
    Markdown; a table without a data row, or without rows and under 25 characters, is listed as lost.
    """
    return F.arrow_udf(_parse, PARSED.simpleString())(xml)


def parse_papers(files: DataFrame) -> DataFrame:
    """(paper_id, xml) -> parsed papers."""
    return files.select("paper_id", parsed(F.col("xml")).alias("p")).select("paper_id", "p.*")


def title_of(xml: Column) -> Column:
    """The title by XPath, native."""
    return F.regexp_replace(F.trim(F.xpath_string(xml, F.lit("//titleStmt/title"))), r"(?U)\s+", " ")


class TeiBlocks:
    """The blocks of one TEI document, in order: what ``operators.blocks.segment`` makes of its parsed paper."""

    def eval(self, xml: str) -> Iterator[tuple[int, str, str, str]]:
        found = _paper(xml)
        if found is None:
            return
        rows = [("fixed", "title_abstract", f"TITLE: {found['title']}\nABSTRACT: {found['abstract']}")]
        rows += [("section", x["header"], f"\n=== SECTION: {x['header']} ===\n{x['text']}") for x in found["sections"]]
        named = ((f"{t['label']} - {t['caption']}", t["text"]) for t in found["tables"])
        rows += [("table", label, f"\n=== TABLE: {label} ===\n{text}") for label, text in named]
        if found["empty_table_labels"]:
            rows.append(("warning", "aviso_parsing", WARNING[0] + "; ".join(found["empty_table_labels"]) + WARNING[1]))
        for pos, row in enumerate(rows):
            yield pos, *row


def register(spark: SparkSession) -> None:
    """``tei_blocks`` for SQL: ``SELECT f.paper_id, b.* FROM files f, LATERAL tei_blocks(f.xml) b``. What is not XML has no rows."""
    spark.udtf.register("tei_blocks", F.udtf(TeiBlocks, returnType="block_pos int, kind string, label string, rendered string"))
