"""Resampling, word BPE and source divergence against brute force, and their odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from quotewright.llm import divergence, ranking, resampling
from quotewright.llm.common import save, table
from quotewright.llm.divergence import source_divergence
from quotewright.llm.ranking import numbered, top_of_groups
from quotewright.llm.resampling import importance_resample
from quotewright.llm.word_bpe import decode_ids, encode_texts, word_bpe

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LONG = "Eine sehr lange Zeile über alles, " * 20_000
DOCS = "doc_id long, text string, lang string, source string"
ODD = [
    (1, None, None, None), (2, "", "", "a"), (3, LONG, "de", "a"), (4, " \t\n\x0b ", "de", "b"), (5, "same text here", "en", "a"), (5, "same text here", "en", "a"),
    (None, "no id, same text here", "en", "b"), (6, "Ünïcode straße İSTANBUL ΣΑΣ x　y 漢字 😀", "en", None), (7, "same text here", None, "b"), (8, "12 34 -- ##", "de", "b"),
]


def words(text, pattern):
    return re.findall(pattern, re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


# Resampling --------------------------------------------------------------------------------------------------------------


def resampled(docs, target, longest=1, buckets=10_000, percent=10, least_words=20, seed=2024):
    def features(text):
        w = words(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        return w, [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    own = [features(t) for _, t in docs]
    s, t = Counter(b for _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in s}
    rows = []
    for (i, _), (w, f) in zip(docs, own):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[2] >= least_words), key=lambda r: (-r[4], -1 if r[0] is None else r[0], r[3]))
    ranks = {id(r): n for n, r in enumerate(able[: percent * len(able) // 100], 1)}
    return [(*r, ranks.get(id(r))) for r in rows]


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_by_brute_force(spark, monkeypatch, longest):
    monkeypatch.setattr(resampling, "LISTS", 1)  # salts for every block
    docs, target = (table(spark, entry.SMALL, t) for t in ("documents", "benchmark"))
    want = resampled([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], longest, buckets=500, percent=30, least_words=40)
    got = importance_resample(docs.repartition(7), target, longest, buckets=500, percent=30, least_words=40).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(r["rank"] is not None for r in got) > 10


def test_resampling_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t, *_ in ODD], "doc_id long, text string, block int, `rank` int")
    target = spark.createDataFrame([(None,), ("same text",), ("straße",)], "text string")
    got = sorted(importance_resample(docs, target, least_words=0, percent=50).select("doc_id", "n_features", "n_words", "weight", "score", "rank").collect(), key=repr)
    want = sorted(resampled([(i, t) for i, t, *_ in ODD], [None, "same text", "straße"], least_words=0, percent=50), key=repr)
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(repr(w[:5]) for w in want)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 6))
    assert importance_resample(docs.limit(0), target).count() == 0
    assert {r["weight"] for r in importance_resample(docs, target.limit(0)).where("n_features = 0").collect()} == {0}


def test_numbered_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RANGE", 50)
    rows = save(spark.range(1000).select((F.col("id") % 3).alias("a"), "id"), "test")
    got = [(r.a, r.id, r.number) for r in numbered(rows, [F.desc("a"), "id"], 1000).collect()]
    assert sorted(got, key=lambda r: r[2]) == [(2 - i // 333 if i < 666 else 0, r, n) for n, (i, (_, r)) in enumerate(enumerate(sorted((2 - i % 3, i) for i in range(1000))), 1)]


# Word BPE ----------------------------------------------------------------------------------------------------------------


def library(texts):
    found = Tokenizer.from_file(TOKENIZER).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in found], [Tokenizer.from_file(TOKENIZER).decode(e.ids, skip_special_tokens=False) for e in found[:20]]


def test_encoding_equals_the_library(spark):
    rng, names = random.Random(5), list(word_bpe(TOKENIZER).vocab)
    letters = "abcdefghijklmnopqrstuvwxyzéüñ'0123456789-!. \n\tAEIOU<|>ÇŐ漢"
    texts = [t for _, t, *_ in ODD] + ["a<|endoftext|>b <|startoftext|><|endoftext|> <|end", "́abc é ﬁ", "a'S it's 'LL'd''s", "x" * 5000, "ab" * 3000 + "!!!" * 500, "\x00 \x1c\x85 \x1f"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 300))) for _ in range(300)]
    texts += ["".join(rng.choice(names).replace("</w>", "") for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    texts += ["".join(rng.choice("aehlnost") for _ in range(rng.randint(1, 90))) for _ in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("ids", F.lit("clash"))
    rows = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in encode_texts(docs, TOKENIZER).collect()}
    ids, decoded = library(texts)
    assert [rows[i] for i in range(len(texts))] == ids
    back = {r.doc_id: r.text for r in decode_ids(encode_texts(docs, TOKENIZER), TOKENIZER).collect()}
    assert [back[i] for i in range(20)] == decoded


def test_pairs_are_judged_as_merging_does():
    bpe, rng = word_bpe(TOKENIZER), np.random.default_rng(3)
    inner, every = np.array(list(bpe.inner.values())), np.array(list(bpe.vocab.values()))
    a, b = rng.choice(inner[:9000], 4000), rng.choice(every[:9000], 4000)

    def exact(x, y):
        end = bpe.names[y].endswith("</w>")
        text = bpe.names[x] + bpe.names[y].removesuffix("</w>")
        return bpe.merge(bpe.symbols(text) if end else [bpe.vocab[c] for c in text])[0] == [x, y]

    want = [exact(x, y) for x, y in zip(a.tolist(), b.tolist())]
    assert bpe.compatible(a, b).tolist() == want and 100 < sum(want) < 3900


def test_bpe_of_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([r[:2] for r in ODD], "doc_id long, text string")
    got = encode_texts(docs, TOKENIZER)
    assert got.count() == len(ODD) and got.where("doc_id IS NULL").count() == 1
    assert {bytes(r.ids) for r in got.where("doc_id IN (1, 2, 4)").collect()} == {b""}
    assert decode_ids(got.withColumn("ids", F.lit(None).cast("binary")), TOKENIZER).where("text = ''").count() == len(ODD)
    assert encode_texts(docs.limit(0), TOKENIZER).count() == 0


# Divergence --------------------------------------------------------------------------------------------------------------


def diverged(docs, least=3, top=200):
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source, found = lang or "", source or "", words(text, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
        groups.add((lang, source))
        counts[lang, source].update(found)
        seen[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in seen[lang].items() if n >= least]
        of = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        p, whole = of(counts[lang, source]), of(sum((c for (x, _), c in counts.items() if x == lang), Counter()))
        pairs = []
        for other in (s for x, s in groups if x == lang and s != source):
            q = of(counts[lang, other])
            pairs.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other))
        terms = [(-((p[t] - whole[t]) ** 2 // whole[t]), t) for t in kept if counts[lang, source][t] and p[t] > whole[t]]
        for part, rows in (("pair", pairs), ("term", sorted(terms, key=lambda r: (r[0], r[1].encode()))[:top])):
            out += [(lang, source, part, t, -v, n) for n, (v, t) in enumerate(sorted(rows, key=lambda r: (r[0], r[1].encode())), 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(10**6, 48, 200_000, 4096, 100_000), (200, 3, 500, 5, 0)])
def test_divergence_by_brute_force(spark, monkeypatch, sizes):
    for module, name, n in zip((divergence, divergence, divergence, ranking, ranking), ("HELD", "TILE", "BLOCK", "CELL", "SMALL"), sizes):
        monkeypatch.setattr(module, name, n)
    docs = table(spark, entry.SMALL, "documents").where("lang <> 'en'")
    got = source_divergence(docs.repartition(3), top=12).collect()
    assert sorted(map(tuple, got)) == diverged([(r.text, r.lang, r.source) for r in docs.collect()], top=12)


def test_divergence_of_odd_rows(spark):
    docs = spark.createDataFrame([(t, x, s, 1) for _, t, x, s in ODD] * 2, "text string, lang string, source string, value int")
    assert sorted(map(tuple, source_divergence(docs).collect())) == diverged([r[1:] for r in ODD] * 2)
    assert source_divergence(docs.limit(0)).count() == 0


def test_top_of_groups_tells_ties_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(ranking, "CELL", 3)
    rng = random.Random(2)
    rows = [(g, rng.choice([0, 1, 5, 1 << 40, (1 << 40) + 1, 10**18]), f"{'long common start ' * 3}{'é' if n % 2 else 'z'}{n}") for g in "abc" for n in range(80)]
    got = top_of_groups(spark.createDataFrame(rows, "g string, v long, item string"), ["g"], "v", "item", 33, 3).collect()
    want = [r for g in "abc" for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2].encode()))[:33]]
    assert sorted(map(tuple, got)) == sorted(want)
