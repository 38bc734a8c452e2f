"""Packing, quality, language models, mixing, search and revisits against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotewright.llm import lm_interpolation, mixing, packing, quality_model, quality_rules, revisit, topk

BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark, rows, kind="doc_id long, text string, lang string, source string, threshold double, share int, kept string"):
    width = kind.count(",") + 1
    return spark.createDataFrame([(*r, *[None] * width)[:width] for r in rows], kind)


def text(r, n):
    return " ".join("".join(r.choice("etaoinshrdluçé") for _ in range(r.randint(1, 9))) for _ in range(n))


# --- packing


def test_ids_are_the_tokenizers():
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    r = random.Random(1)
    samples = [text(r, 50), "", "a  b\n\n\tc  ", "don't we'll I'M", "日本語 ¼ 12,345.67 ‰", "\u0085  x", "<|endoftext|>", "!!!???", "aaaa" * 500, "\r\n \r\n"]
    for s in samples:
        assert packing.encoder(BPE).encode_ordinary(s) == t.encode(s, add_special_tokens=False).ids, s


def check_packed(rows, texts, capacity):
    t = Tokenizer.from_file(BPE)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, s in texts.items():
        ids = np.array([*t.encode(s or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and own[0].start == 0 and sum(r.length for r in own) == len(ids)
        assert all(r.length == capacity for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_is_whole_and_tight(spark):
    r = random.Random(4)
    texts = {i: text(r, r.randint(0, 90)) for i in range(300)} | {1000: None, 1001: "", 1002: text(r, 3000)}
    rows = packing.pack_documents(table(spark, texts.items()), BPE, capacity=256).collect()
    used = check_packed(rows, texts, 256)
    assert used <= math.ceil(sum(x.length for x in rows) / 256) * 1.03 + 1


def test_added_tokens_have_their_ids(spark):
    texts = {1: "a<|endoftext|>b", 2: "<|endoftext|>", 3: " x  <|endoftext|>\n<|endoftext|><|endoftext|> y", 4: "<|endoftext |>"}
    rows = packing.pack_documents(table(spark, texts.items()), BPE, keep_ids=True).collect()
    check_packed(rows, texts, 2048)
    assert {r.doc_id: r.ids.count(50256) for r in rows} == {1: 1, 2: 1, 3: 3, 4: 0}


def test_packing_of_odd_tables(spark):
    assert packing.pack_documents(table(spark, []), BPE).count() == 0
    rows = packing.pack_documents(table(spark, [(1, "same"), (1, "same"), (None, "x")]), BPE, keep_ids=True).collect()
    assert len(rows) == 3 and len({(x.sequence_id, x.offset) for x in rows}) == 3 and all(x.ids[-1] == 0 for x in rows)


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_the_methods_own_plan_is_as_small_as_best_fit(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    counts = {r.length: r.n for r in packing.pieces(docs, BPE).groupBy("length").agg(F.count("*").alias("n")).collect()}
    have = np.zeros(2049, np.int64)
    for length, n in counts.items():
        have[length] = n
    plan = packing.plan(counts, 2048)
    made = [packing._complements(have, 2048, max(1, int(2048 * share))) for share in packing.HELD_BACK]
    size = lambda p: sum(n for _, n in p)
    assert plan in made and size(plan) <= size(packing._best_fit(have, 2048))
    assert sum(n for held, n in plan if sum(held) == 2048) >= 0.6 * size(plan)


def test_sums_are_found_under_the_counts():
    for seed in range(30):
        r = random.Random(seed)
        have = np.zeros(41, np.int64)
        for _ in range(r.randint(1, 14)):
            have[r.randint(1, 40)] += 1
        sums = packing._Sums(have)
        while have.any():  # as the plan asks: ever fewer pieces
            for gap in range(1, 41):
                own = [x for x in range(1, 41) for _ in range(have[x])]
                want = any(sum(c) == gap for k in (1, 2, 3) for c in itertools.combinations(own, k))
                got = sums.fill(gap)
                assert (got is not None) == want and (got is None or (sum(got) == gap and sums._left(*got)))
            have[r.choice(np.flatnonzero(have))] -= 1


def test_plan_uses_exact_complements():
    plan = packing.plan({60: 3, 40: 3, 50: 1, 30: 1, 20: 1, 35: 2, 25: 2, 15: 2}, 100)
    assert sum(n for _, n in plan) == 6 and all(sum(h) == 100 for h, _ in plan if len(h) > 1 and 60 in h)
    for seed in range(20):
        r = random.Random(seed)
        counts = Counter(r.randint(1, 64) for _ in range(200))
        used = Counter()
        for held, n in packing.plan(dict(counts), 64):
            assert sum(held) <= 64
            for x in held:
                used[x] += n
        assert used == counts


# --- quality rules


def brute_rules(s):
    s = s or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", s) if x]
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in s.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in s), len(lines) - len(set(lines)), len(hit), failed


def test_rule_counts(spark):
    r = random.Random(8)
    texts = [text(r, n) for n in (0, 3, 9, 10, 40)] + [None, "", " \x0b\x0c", "a b c d e a b c d e", "a " * 40, "x y z v w " + text(r, 30) + " x y z v w", "é#|<>\n\né#|<>\n é#|<>", text(r, 20000)]
    kind = "doc_id long, text string, n_words string, `_words` int, kept int"
    rows = {x.doc_id: x for x in quality_rules.clean_lines(table(spark, list(enumerate(texts)), kind)).collect()}
    for i, s in enumerate(texts):
        x = rows[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == brute_rules(s), s and s[:40]
    assert quality_rules.clean_lines(table(spark, [])).count() == 0


def test_lines_go_first(spark):
    good = "A plain sentence of ordinary words that says something and ends well."
    rows = [(1, good + "\nHome | News | Sport | About"), (2, good + "\n" + "\n".join(["All rights reserved, whatever the rest of this line says to the reader."] * 3)), (3, "WORDS!! ARE!! SHOUTED!! AND!! EVERY!! ONE!! OF!! THEM!! HAS!! TWO!! MARKS!!")]
    got = {x.doc_id: x for x in quality_rules.clean_lines(table(spark, rows)).collect()}
    assert got[1].kept and got[1].clean_text == good and not got[2].kept and not got[3].kept and got[3].clean_text == ""


# --- language models


def brute_mixture(docs, held, parts):
    """Scores by the definition: counts of training texts, weights by EM on the fold with its own counts taken out."""
    tokens = {i: [*(s or "").encode().lower().split(), None] for i, s in docs.items()}

    def counts(ids):
        c = [Counter() for _ in range(5)]  # words, pairs, triples, contexts of one and of two words
        for i in ids:
            t = ["<<", "<", *tokens[i]]
            for k in range(2, len(t)):
                for order in range(3):
                    c[order][tuple(t[k - order : k + 1])] += 1
                c[3][t[k - 1]] += 1
                c[4][t[k - 2], t[k - 1]] += 1
        return c

    def estimates(t, k, c, n, v):
        one, two = c[3][t[k - 1]], c[4][t[k - 2], t[k - 1]]
        p = [c[2][tuple(t[k - 2 : k + 1])] / two if two else 0, c[1][tuple(t[k - 1 : k + 1])] / one if one else 0, c[0][(t[k],)] / max(n, 1), 1 / (v + 1)]
        return (32 + int(math.log2(two)) if two else int(math.log2(one + 1))), p

    train = [i for i in docs if not held(i)]
    fold = [i for i in train if parts[i] % lm_interpolation.FOLDS == 0]
    rest = counts([i for i in train if i not in set(fold)])
    n, v = sum(rest[0].values()), len(rest[0])
    rows = {}
    for i in fold:
        t = ["<<", "<", *tokens[i]]
        for k in range(2, len(t)):
            b, p = estimates(t, k, rest, n, v)
            rows.setdefault(b, []).append([2 ** (-round(-4 * math.log2(x)) / 4) if x else 0 for x in p[:3]] + [p[3]])
    weights = lm_interpolation.all_weights({b: lm_interpolation.mixture(np.array(p), np.ones(len(p))).tolist() for b, p in rows.items()})
    full = counts(train)
    n, v = sum(full[0].values()), len(full[0])
    out = {}
    for i, own in tokens.items():
        t, score = ["<<", "<", *own], 0
        for k in range(2, len(t)):
            b, p = estimates(t, k, full, n, v)
            score += math.log10(sum(a * w for a, w in zip(p, weights[b])))
        out[i] = (len(own), sum(full[0][(w,)] > 0 for w in own), n, sum(math.log10((full[0][(w,)] + 1) / (n + v + 1)) for w in own), score)
    return out


def scored(spark, docs, held):
    df = table(spark, list(docs.items()), "doc_id long, text string, held string, part int, score int")
    parts = {x.doc_id: x.p for x in df.select("doc_id", F.pmod(F.xxhash64("doc_id", "text"), F.lit(4)).alias("p")).collect()}
    return {x.doc_id: x for x in lm_interpolation.interpolated_scores(df, held).collect()}, parts


def test_interpolated_scores(spark):
    r = random.Random(12)
    vocabulary = [text(r, 1) for _ in range(12)]
    docs = {i: " ".join(r.choice(vocabulary) if r.random() < 0.9 else text(r, 1) for _ in range(r.randint(0, 60))) for i in range(150)}
    docs |= {500: None, 501: "", 502: "A a\tA\x0ba é É", 503: " ".join(vocabulary * 3000)}
    rows, parts = scored(spark, docs, F.col("doc_id") % 7 == 2)
    want = brute_mixture(docs, lambda i: i % 7 == 2, parts)
    assert set(rows) == set(want)
    for i, x in rows.items():
        assert (x.n_tokens, x.n_known, x.train_tokens, x.base_score, x.score) == pytest.approx(want[i], rel=1e-6)
    assert sum(x.score for x in rows.values()) > sum(x.base_score for x in rows.values())
    # held-out texts teach nothing: other words in them change no training text's score
    other, _ = scored(spark, {i: "quite other words" if i % 7 == 2 else s for i, s in docs.items()}, F.col("doc_id") % 7 == 2)
    assert all(other[i].score == pytest.approx(x.score) for i, x in rows.items() if i % 7 != 2)


def test_mixture_raises_the_likelihood():
    cells = np.array([(4 << 16) + (8 << 8) + 32, (lm_interpolation.NONE << 16) + (16 << 8) + 16])
    p, n = lm_interpolation.cell_estimates(cells, 100), np.array([10, 5])
    assert np.allclose(p, [[2.0**-1, 2.0**-2, 2.0**-8, 1 / 101], [0, 2.0**-4, 2.0**-4, 1 / 101]])
    w = lm_interpolation.mixture(p, n)
    assert w.sum() == pytest.approx(1) and (w >= 0).all() and (n * np.log(p @ w)).sum() > (n * np.log(p.mean(1))).sum()
    weights = lm_interpolation.all_weights({3: w, 40: w})
    assert np.allclose(weights.sum(1), 1) and np.allclose(weights[31], w) and not np.allclose(weights[32], w) and np.allclose(weights[63], w)


def test_scores_of_odd_tables(spark):
    assert lm_interpolation.interpolated_scores(table(spark, []), F.lit(False)).count() == 0
    rows = lm_interpolation.interpolated_scores(table(spark, [(1, "a b"), (1, "a b"), (None, "c")]), F.lit(True)).collect()
    assert sorted(map(str, (x.doc_id for x in rows))) == ["1", "1", "None"]
    assert all(x.train_tokens == 0 and x.n_known == 0 and math.isfinite(x.score) for x in rows)


def brute_kneser_ney(texts, order):
    symbols = lambda s: ["<"] * (order - 1) + [*s.encode(), ">"]
    counts = [Counter() for _ in range(order + 1)]
    for s in texts:
        b = symbols(s)
        counts[order].update(tuple(b[i : i + order]) for i in range(len(b) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k].update(g[1:] for g in counts[k + 1])
    discounts = {}
    for k in range(1, order + 1):
        n = [max(1, sum(c == i for c in counts[k].values())) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        discounts[k] = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3)]

    def p(g, k):
        if not k:
            return 1 / quality_model.VOCABULARY
        own = {x: c for x, c in counts[k].items() if x[:-1] == g[:-1]}
        if not own:
            return p(g[1:], k - 1)
        d = lambda c: discounts[k][min(c, 3) - 1]
        c = own.get(g, 0)
        return ((c - d(c)) if c else 0) / sum(own.values()) + sum(map(d, own.values())) / sum(own.values()) * p(g[1:], k - 1)

    def score(s):
        b = symbols(s)
        return sum(math.log10(p(tuple(b[i : i + order]), order)) for i in range(len(b) - order + 1))

    return score


def test_kneser_ney_against_brute_force(spark):
    r = random.Random(3)
    texts = [text(r, 6) for _ in range(12)] + ["\x02\x03 of a text", "\x03"]
    model = quality_model.train(spark.createDataFrame([(t,) for t in texts], "text string"), order=3)
    want = brute_kneser_ney(texts, 3)
    probes = [*texts[:3], "", "zzz ZZZ", "the é", text(r, 5), "\x03\x02", "a\x03", None, text(r, 4000)]
    docs = table(spark, [*enumerate(probes), (None, "no id"), (3, texts[0])])
    got = quality_model.scores(model, docs, "doc_id", "text").collect()
    texts_of = {**dict(enumerate(probes)), None: "no id"}
    assert len(got) == len(probes) + 2 and sum(x.id == 3 for x in got) == 2
    for x in got:
        s = texts_of[x.id] or ""
        if x.id == 3 and x.n_tokens != 1:
            s = texts[0]
        assert x.n_tokens == len(s.encode()) + 1 and x.log10_prob == pytest.approx(want(s), rel=1e-6)


def test_classifier(spark):
    r = random.Random(21)
    good = [(i, text(r, 40), "xx", "s") for i in range(200)]
    junk = [(1000 + i, "".join(r.choice("#$%&*QWXYZ") for _ in range(200)), "xx", "s") for i in range(20)]
    odd = [(2000, None, "xx", "s"), (2001, "", None, None), (2002, text(r, 30), "new", "s"), (2002, text(r, 30), None, "s")]
    trusted = table(spark, good[:160]).select("doc_id")
    named = table(spark, good + junk + odd).withColumns({c: F.lit("x") for c in ("__lang", "__limit", "lang_", "row", "id", "limit", "text_hash", "pick", "perplexity")})
    rows = quality_model.classify(named, trusted, sample=80).collect()
    assert len(rows) == 224 and not any(x.kept for x in rows if 1000 <= (x.doc_id or 0) < 2000)
    assert sum(x.kept for x in rows if x.doc_id < 1000) >= 190 and all(x.threshold is not None for x in rows)
    assert quality_model.classify(table(spark, []), trusted).count() == 0
    assert all(x.kept for x in quality_model.classify(table(spark, good), trusted.limit(0)).collect())


def test_classifier_learns_from_all_of_one_half(spark):
    """Each trusted row of the half, over 4000, and the repeated and the null ids as well, counts in the model."""
    r = random.Random(23)
    rows = [(i, text(r, 3), "xx", "s") for i in range(9000)] + [(0, "another text", "xx", "s"), (1, text(r, 3), "xx", "s"), (None, "no id", "xx", "s")]
    docs = table(spark, rows)
    half = {x.doc_id for x in docs.where("pmod(hash(doc_id), 2) = 0 AND doc_id < 8900").select("doc_id").distinct().collect()}
    found = quality_model.classify(docs, docs.where("doc_id < 8900").select("doc_id"), order=3).collect()
    want = brute_kneser_ney([x[1] for x in rows if x[0] in half], 3)
    assert len(half) > 4000 and len(found) == len(rows)
    texts_of = {i: t for i, t, *_ in rows[2:9000]}
    for x in found[::500]:
        if x.doc_id in texts_of:
            assert x.log10_prob == pytest.approx(want(texts_of[x.doc_id]), rel=1e-6)


def test_thresholds_cover_all_other_trusted_rows(spark):
    r = random.Random(22)
    rows = [(i, text(r, r.randint(3, 30)), "rare" if i % 10 == 0 else "hot", "s") for i in range(600)]
    docs = table(spark, rows)
    ids = docs.select("doc_id").withColumn("half", F.pmod(F.hash("doc_id"), F.lit(2))).orderBy(F.xxhash64("doc_id")).collect()
    trained = [x.doc_id for x in ids if x.half == 0][:20]
    found = quality_model.classify(docs, docs.select("doc_id"), sample=20).collect()
    for lang in ("rare", "hot"):
        own = [x.perplexity for x in found if x.lang == lang and x.doc_id not in trained]
        assert len(own) > 50 and [x.threshold for x in found if x.lang == lang] == pytest.approx([np.quantile(own, 0.99)] * (60 if lang == "rare" else 540))


def test_exact_quantile(spark):
    r = random.Random(24)
    rows = [(r.choice("ab"), 10 ** r.uniform(0, 3)) for _ in range(500)] + [("same", 7.0)] * 90 + [("one", 3.0), (None, 2.0), (None, 4.0)]
    for q in (0.0, 0.5, 0.99, 1.0):
        got = {x.lang: x.limit for x in quality_model.exact_quantile(spark.createDataFrame(rows, "lang string, x double"), ["lang"], q).collect()}
        assert got == {k: pytest.approx(np.quantile([x for c, x in rows if c == k], q)) for k in ("a", "b", "same", "one", None)}


# --- mixing


def test_schedule_meets_windows_and_weights(spark):
    rows = [(i, f"t{i}", "l", "a" if i % 3 else f"b{i % 4}") for i in range(600)] + [(900, "n", "l", None), (None, "m", "l", "a"), (5, "again", "l", "a")]
    df = table(spark, rows)
    out = mixing.mix_sources(df, block=2, period=50).collect()
    assert len(out) == len(rows) and all(x.release <= x.slot < x.deadline for x in out)
    blocks = {(x.source or "", x.block): x.slot for x in out}
    assert len(set(blocks.values())) == len(blocks) and max(Counter((x.source or "", x.block) for x in out).values()) == 2
    weights = spark.createDataFrame([("a", 0.5), ("b0", 0.3), ("b1", 0.2), ("none", 0.0)], "source string, weight double")
    out = mixing.mix_sources(df, weights, block=1, period=40).collect()
    assert {x.source for x in out} == {"a", "b0", "b1"}
    slots = {s: sorted(x.slot for x in out if x.source == s) for s in ("a", "b0", "b1")}
    shares = {x.source: x.share for x in mixing.shares(weights.where("weight > 0"), 40).collect()}
    assert sum(shares.values()) == 40
    for t in range(1, 1 + min(s[-1] for s in slots.values())):
        for s, own in slots.items():
            assert abs(sum(x < t for x in own) - t * shares[s] / 40) < 1
    assert mixing.mix_sources(table(spark, [])).count() == 0


@pytest.mark.parametrize("sources", [3, 40, 300])
def test_weights_are_met_however_long_the_schedule_is(spark, sources):
    weights = spark.createDataFrame([("big", sources / 2)] + [(f"s{i}", 1.0) for i in range(sources)], "source string, weight double")
    shares = {x.source: x.share / x.period for x in mixing.shares(weights).collect()}
    assert shares["big"] == pytest.approx(1 / 3, abs=1e-3) and sum(shares.values()) == pytest.approx(1)
    assert {x.source: x.share for x in mixing.shares(spark.createDataFrame([("a", 7.0), ("b", 3.0)], "source string, weight double")).collect()} == {"a": 7, "b": 3}
    df = spark.range(20_000).selectExpr("id AS doc_id", "'big' AS source")
    slots = mixing.mix_sources(df, weights, block=1).agg(F.max("slot")).first()[0]
    assert abs((slots + 1) * shares["big"] - 20_000) <= 1
    few = mixing.mix_sources(df.limit(300), weights, block=1, buckets=2).collect()
    assert {(x.doc_id, x.slot) for x in few} == {(x.doc_id, x.slot) for x in mixing.mix_sources(df.limit(300), weights, block=1).collect()}


# --- search


def brute_top(ids, vectors, queries, k):
    out = set()
    for q in queries:
        own = [(-int(vectors[q] @ vectors[j]), ids[j]) for j in range(len(ids)) if ids[j] != ids[q]]
        out |= {(ids[q], rank, i, -s) for rank, (s, i) in enumerate(sorted(own)[:k], 1)}
    return out


def test_top_k_with_ties_and_copies(spark):
    r = np.random.default_rng(7)
    x = np.concatenate([r.normal(c, 0.3, (60, 8)) for c in (-1, 0, 2)] + [np.tile(r.normal(0, 1, 8), (40, 1)), np.zeros((5, 8))]).astype(np.float32)
    ids = list(range(len(x)))
    rows = [(i, v.tolist(), 0.0, i) for i, v in zip(ids, x)]
    kind = "vec_id long, embedding array<float>, v double, id int"
    odd = [(1000, None, 0.0, 0), (1050, [float("nan")] * 8, 0.0, 0), (1100, [1.0, None] * 4, 0.0, 0), (1150, [float("inf")] * 8, 0.0, 0)]
    whole = np.floor(256 * x.astype(np.float64)).astype(int)
    for sample, chunk in ((2048, None), (30, 16)):
        got = topk.exact_top_k(spark.createDataFrame(rows + odd, kind), "vec_id % 50 = 0", k=5, sample=sample, chunk=chunk, query_block=2).collect()
        want = brute_top(ids, whole, [i for i in ids if i % 50 == 0], 5)
        assert {(g.query_id, g["rank"], g.vec_id, g.score) for g in got} == want


def test_top_k_of_few_and_large(spark):
    kind = "vec_id long, embedding array<double>"
    make = lambda *rows: topk.exact_top_k(spark.createDataFrame(list(rows), kind), "vec_id = 0", k=5)
    assert make().count() == 0 and make((1, [1.0])).count() == 0 and make((0, [1.0])).count() == 0
    assert [tuple(r) for r in make((0, [1.0, 2.0]), (1, [1.0]), (2, [])).orderBy("rank").collect()] == [(0, 1, 1, 65536), (0, 2, 2, 0)]
    big = make((0, [1e6, 1.0]), (1, [1e6, 1.0]), (2, [1e6, 1.5])).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in big] == [(2, 256_000_000**2 + 256 * 384), (1, 256_000_000**2 + 256 * 256)]


# --- revisits


def test_canonical_urls(spark):
    same = ["http://www.Ex.org/a/?b=2&utm_source=x&a=1#f", "https://ex.org:443/a?a=1&b=2", "EX.ORG/a/?ref=q&b=2&a=1"]
    df = spark.createDataFrame([(u,) for u in [*same, "http://ex.org", None, ""]], "u string")
    got = [r[0] for r in df.select(revisit.canonical_url(F.col("u"))).collect()]
    assert got == ["ex.org/a?a=1&b=2"] * 3 + ["ex.org", None, ""]


RECORDS = "record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>, payload string, span int"


@pytest.mark.parametrize("buckets", [None, 1, 7])
def test_revisits(spark, buckets):
    u = "http://x.org/p"
    rows = [
        (1, u, 10, "response", '"a"', "d1", {"ETag": '"a"', "Vary": "X", "Content-Type": "t"}, "one"),
        (2, u, 20, "response", '"b"', "d2", {}, "two"),
        (3, u, 20, "response", '"c"', "d3", None, "three"),
        (4, u, 10, "revisit", '"a"', None, {}, None),
        (5, u + "#x", 15, "revisit", 'W/"a"', None, {"VARY": "Y", "Content-Length": "0"}, None),
        (6, u, 25, "revisit", '"b"', "d3", {"a": "b"}, None),
        (7, u, 30, "revisit", None, "d3", {}, None),
        (8, u, 31, "revisit", None, None, {}, None),
        (9, None, 40, "revisit", '"a"', None, {}, None),
        (10, u, None, "revisit", '"a"', None, None, None),
        (11, "other", 50, "revisit", '"a"', None, {}, None),
        (12, u, 60, "metadata", None, None, {}, None),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], RECORDS)
    got = {r.record_id: r for r in revisit.resolve_revisits(df, buckets).collect()}
    assert {i: (r.verdict, r.resolved_id) for i, r in got.items()} == {
        4: ("no-response", None), 5: ("etag", 1), 6: ("mismatch", None), 7: ("last-modified", 3), 8: ("no-validator", None),
        9: ("no-response", None), 10: ("no-response", None), 11: ("no-response", None),
    }
    assert [tuple(h) for h in got[5].headers] == [("content-type", "t"), ("etag", '"a"'), ("vary", "Y")] and got[5].payload == "one"
    assert [tuple(h) for h in got[6].headers] == [("a", "b")] and got[6].payload is None
    assert revisit.resolve_revisits(df.limit(0)).count() == 0
