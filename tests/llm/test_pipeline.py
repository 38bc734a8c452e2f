"""The corpus pipeline, stage by stage, against what each stage promises."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from quotewright.llm import line_dedup, simhash

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("stages")
    docs, found = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{at}/{i}")
        found.append((docs, spark.read.parquet(f"{at}/{i}")))
        docs = found[-1][1]
    return found


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay(spark, stages):
    want = spark.read.parquet(f"{SMALL}/documents.parquet").schema.simpleString()
    assert all(after.schema.simpleString() == want for _, after in stages[:-1]) and len(stages) == 5


def test_classifier_keeps_clean_documents(spark, stages):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = rows(stages[0][1])
    clean = [i for i, r in labels.items() if r.quality == 1 and not r.toxic]
    junk = [i for i, r in labels.items() if r.quality == 0]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean) and sum(i in kept for i in junk) <= 0.4 * len(junk)


def test_spread_lines_go(stages):
    before, after = rows(stages[1][0]), rows(stages[1][1])
    sites = {}
    strip = " \t\n\x0b\x0c\r"
    for r in before.values():
        for line in r.text.split("\n"):
            sites.setdefault(line.strip(strip), set()).add(r.source)
    assert set(before) == set(after)
    for i, r in before.items():
        kept = "\n".join(x for x in r.text.split("\n") if not x.strip(strip) or len(sites[x.strip(strip)]) < 8)
        want = kept if len(kept) >= 0.5 * len(r.text) else r.text
        assert after[i].text == want and after[i].n_chars == len(want)


def test_one_of_each_group_stays(stages):
    before, after = rows(stages[2][0]), rows(stages[2][1])
    groups = {r.doc_id: r.component_id for r in simhash.similar_groups(stages[2][0]).collect()}
    assert set(after) == set(groups.values()) and all(after[i] == before[i] for i in after)
    copies = Counter(r.text for r in before.values())
    assert max(Counter(r.text for r in after.values()).values()) == 1 and max(copies.values()) > 1


def test_mixing_keeps_all(stages):
    assert rows(stages[3][0]) == rows(stages[3][1])


def test_packing_holds_all_tokens(stages):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in stages[4][1].collect():
        pieces.setdefault(r.doc_id, []).append(r)
    docs = rows(stages[4][0])
    assert set(pieces) == set(docs)
    for i, own in pieces.items():
        ids = np.array([*t.encode(docs[i].text, add_special_tokens=False).ids, 0], "<u4")
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)
        assert sum(r.length for r in own) == len(ids)
    full = stages[4][1].groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.sum("n"), F.count("*")).first()
    assert full[0] <= 2048 and full[2] <= full[1] / 2048 * 1.1 + 1


def test_run_equals_the_stages(spark, stages):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = pipeline.run(spark, SMALL).select(*names).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, stages[4][1].select(*names).collect()))


def test_odd_documents_pass_through(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "word " * 60_000, "xx", "s", None), (3, "word " * 60_000, "xx", "s", None), (4, "a b", "en", None, 3)]
    for table in (odd, []):
        docs = spark.createDataFrame(table, kind)
        for _, stage in pipeline.STAGES[1:]:
            out = stage(spark, docs, SMALL)
            assert out.count() >= (len(table) > 0)
            docs = docs if "text" not in out.columns else out
    assert line_dedup.drop_spread_lines(spark.createDataFrame(odd, kind)).count() == 5


def test_pages_of_mostly_boilerplate_are_cleaned(spark):
    own = lambda i: " ".join(f"own{k}x{i}" for k in range(40))
    menu = [f"a rather long line of a menu that all the sites share, number {i}" for i in range(8)]
    rows = [(i, "\n".join([own(i), *menu]), "en", f"s{i}", None) for i in range(12)]
    rows += [(50 + i, "\n".join(menu), "en", "s1", None) for i in range(2)]
    story = [" ".join(f"w{k}x{i}" for k in range(60)) for i in range(9)]
    rows += [(100 + i, "\n".join([*story, f"altered {i}"]), "en", f"s{i}", None) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    after = {r.doc_id: r.text for r in pipeline.line_dedup(spark, docs, SMALL).collect()}
    assert all(after[i] == own(i) for i in range(12))
    assert all(after[r[0]] == r[1] for r in rows[12:])  # nothing else in them, or altered copies


def test_sequences_follow_the_schedule(spark):
    sources = ["hot"] * 12_000 + ["a"] * 3000 + ["b"] * 3000
    docs = spark.createDataFrame([(i, f"text {i}", "en", s, None) for i, s in enumerate(sources)], "doc_id long, text string, lang string, source string, n_chars long")
    packed = pipeline.packing(spark, docs, SMALL).orderBy("sequence_id", "offset").collect()
    assert len(packed) == len(sources)
    first = Counter(sources[r.doc_id] for r in packed[:4000])  # the schedule's first 1000 slots; weights of 2, 1, 1
    assert all(abs(first[s] / 4000 - w) < 0.01 for s, w in (("hot", 0.5), ("a", 0.25), ("b", 0.25)))
