"""Every query of the subpackage on the smallest tables, and its rows against its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from quotewright.llm import queries as llm

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
COLUMNS = {
    "op1": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op2": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op3": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op5": {"query_id", "rank", "vec_id", "score"},
    "op8": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op9": {"doc_id", "fingerprint", "component_id"},
    "op11": {"doc_id", "n_features", "weight", "score", "rank"},
    "op12": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op13": {"lang", "source", "part", "item", "value", "rank"},
}


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.QUERIES) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(llm.QUERIES))
def test_query(spark, name):
    df = llm.QUERIES[name](spark, entry.SMALL)
    got = sorted(map(repr, ({k: v for k, v in sorted(r.asDict().items())} for r in df.collect())))
    assert got and set(df.columns) >= COLUMNS.get(name.split("_")[0], set())
    if name in llm.ORACLE_SQL:
        db = duckdb.connect()
        for t in TABLES.split():
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{entry.SMALL}/{t}.parquet'")
        want = db.sql(llm.ORACLE_SQL[name])
        rows = [dict(sorted(zip(want.columns, r))) for r in want.fetchall()]
        assert got == sorted(map(repr, rows))
