import json

import pytest
from pyspark.sql import functions as F

from quotewright.sources import tables, tei
from quotewright.streaming import incremental

NS = 'xmlns="http://www.tei-c.org/ns/1.0"'


def paper(spark, body, head=""):
    xml = f"<TEI {NS}><teiHeader><titleStmt><title> A <hi>b</hi>\n c </title></titleStmt>{head}</teiHeader><text><body>{body}</body></text></TEI>"
    return tei.parse_papers(spark.createDataFrame([("p", xml)], "paper_id string, xml string")).first()


def test_sections_and_nesting(spark):
    r = paper(spark, "<div><head>H</head><p>x</p><div><p>y</p></div></div><div><head>empty</head></div>", "<abstract><p>abs</p></abstract>")
    assert (r.title, r.abstract) == ("A b c", "abs")
    assert [(s.header, s.text) for s in r.sections] == [("H", "x y"), ("(sem titulo)", "y")]


def test_tables(spark):
    row = lambda *c: "<row>" + "".join(f"<cell>{x}</cell>" for x in c) + "</row>"
    figure = lambda inner: f'<figure type="table">{inner}</figure>'
    r = paper(
        spark,
        figure("<label>1</label><head>Res</head><table>" + row("m", "auc") + row("", "") + row("rf") + "</table>")
        + figure("<label>4</label><table>" + row("Models") + "</table>")
        + figure("<head>Table 5</head>")
        + figure("<table>flat text that is long enough here</table>"),
    )
    assert [(t.label, t.caption, t.text) for t in r.tables] == [("1", "Res", "| m | auc |\n|---|---|\n| rf |  |"), ("table", "", "flat text that is long enough here")]
    assert r.empty_table_labels == ["table label='4' (#2 de 4 tabelas no PDF)", "Table 5 (#3 de 4 tabelas no PDF)"]


def test_broken_xml_is_null(spark):
    df = tei.parse_papers(spark.createDataFrame([("p", "<TEI"), ("q", None)], "paper_id string, xml string"))
    assert all(r.title is None and r.sections is None for r in df.collect())


def test_tei_files(spark, tmp_path):
    (tmp_path / "x.tei.xml").write_text(f"<TEI {NS}/>")
    (tmp_path / "y.txt").write_text("no")
    assert [r.paper_id for r in tei.read_tei(spark, str(tmp_path)).collect()] == ["x"]


def test_checkpoints(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"paper_id": "a", "source_text_len": 3}, indent=1))
    (tmp_path / "b.partial.json").write_text(json.dumps({"paper_id": "b", "fallback_level": 1}))
    (tmp_path / "c.json").write_text("{ cut")
    assert [r.paper_id for r in tables.read_checkpoints(spark, str(tmp_path)).collect()] == ["a"]
    assert [r.paper_id for r in tables.read_partial_checkpoints(spark, str(tmp_path)).collect()] == ["b"]
    assert tables.read_screenings(spark, str(tmp_path / "none")).count() == 0
    work = spark.createDataFrame([("a",), ("z",)], "paper_id string")
    done = tables.read_checkpoints(spark, str(tmp_path))
    assert [r.paper_id for r in tables.unfinished(work, done).collect()] == ["z"]
    assert tables.unfinished(work, done, force=True).count() == 2


def test_checkpoints_that_were_written_are_read(spark, tmp_path):
    rows = tables.read_checkpoints(spark, str(tmp_path / "none")).schema
    df = spark.createDataFrame([(f"p{i}", i) for i in range(5)], "paper_id string, source_text_len int")
    made = df.select(*(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in rows))
    tables.write_documents(made.repartition(2), str(tmp_path / "c"))
    (tmp_path / "c" / "alone.json").write_text(json.dumps({"paper_id": "alone"}, indent=1))
    got = {r.paper_id: r.source_text_len for r in tables.read_checkpoints(spark, str(tmp_path / "c")).collect()}
    assert got == {f"p{i}": i for i in range(5)} | {"alone": None}


def test_registry_file(spark, tmp_path):
    place = tmp_path / "registry.jsonl"
    place.write_text('{"record_id":"a","doi":"1"}\n\nbroken\n{"doi":"x"}\n{"record_id":"a","doi":"2"}\n{"record_id":"b"}\n')
    rows = tables.read_registry(spark, str(place))
    assert {r.record_id: r.doi for r in rows.collect()} == {"a": "2", "b": None}
    assert tables.malformed_lines(spark, str(place)).count() == 1
    assert tables.read_registry(spark, str(tmp_path / "none")).count() == 0
    out = str(tmp_path / "out")
    for _ in range(2):
        tables.write_registry(rows, out)
        assert {r.record_id for r in tables.read_registry(spark, out).collect()} == {"a", "b"}


def test_sheet_file_has_a_mark(spark, tmp_path):
    df = spark.createDataFrame([("é", 1)], "a string, b int")
    tables.write_sheet(df, str(tmp_path / "s"))
    text = b"".join(f.read_bytes() for f in sorted((tmp_path / "s").glob("*.csv")))
    assert text.startswith("﻿a,b\n".encode()) and "é,1".encode() in text
    assert {r.column: r.width for r in tables.column_widths(df.select("a", F.repeat(F.lit("x"), F.lit(99)).alias("long"))).collect()} == {"a": 3, "long": 60}


def test_profiles(tmp_path):
    (tmp_path / "local.json").write_text(json.dumps({"name": "local", "model": "m", "api_base": "u", "fallback_budgets": [1, None], "temperature_a": 0.5}))
    profile = tables.load_profile("local", str(tmp_path))
    assert profile.fallback_budgets == (1, None) and profile.temperatures() == (0.5, 0.5)
    assert profile.override(model="n", api_base=None) == tables.Profile("local", "n", "u", temperature_a=0.5, fallback_budgets=(1, None))
    with pytest.raises(FileNotFoundError, match="local"):
        tables.load_profile("other", str(tmp_path))
    (tmp_path / "bad.json").write_text('{"nam": 1}')
    with pytest.raises(ValueError, match="nam"):
        tables.load_profile("bad", str(tmp_path))


def test_increments_are_worked_once(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    (folder / "a.json").write_text('{"paper_id":"a"}')
    for want in (1, 2, 2):
        stream = incremental.new_documents(spark, str(folder), spark.createDataFrame([], "paper_id string").schema)
        incremental.run_available(stream, incremental.append_new(target, "paper_id"), str(tmp_path / "state"))
        assert spark.read.parquet(target).count() == want
        (folder / "b.json").write_text('{"paper_id":"a"}\n{"paper_id":"b"}')
