"""Suffix arrays, SimHash and spread lines against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quotewright.llm import common, components, line_dedup, simhash, suffix_dedup

DOCS = "doc_id long, text string, source string, fp long, part int, site string"


def docs(spark, rows, schema=DOCS):
    return spark.createDataFrame([(*r, None, None, None, None)[:6] for r in rows], schema)


def words(r, n):
    return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(n))


def brute_repeats(rows, length):
    seen, out = set(), {}
    for i, t in sorted((i, (t or "").encode()) for i, t in rows):
        change = np.zeros(len(t) + 1, int)
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            if w in seen:
                change[p] += 1
                change[p + length] -= 1
            seen.add(w)
        cover = np.cumsum(change[:-1]) > 0
        turn = np.flatnonzero(np.diff(cover.astype(np.int8), prepend=0, append=0))
        kept = bytes(np.frombuffer(t, np.uint8)[~cover])
        out[i] = (list(zip(turn[::2].tolist(), turn[1::2].tolist())), hashlib.sha256(kept).hexdigest(), len(t))
    return out


def repeats(df, length=100):
    rows = suffix_dedup.remove_repeats(df, length).withColumn("h", F.sha2("kept", 256)).collect()
    return {r.doc_id: ([tuple(s) for s in r.spans], r.h, r.n_bytes) for r in rows}


def test_repeats_match_brute_force(spark):
    r = random.Random(5)
    base = [words(r, 120) for _ in range(6)]
    rows = [(i, words(r, r.randint(1, 90))) for i in range(30)]
    for i in range(30, 90):
        a, b = r.choice(base), r.choice(base)
        k = r.randint(0, 200)
        rows.append((i, words(r, 20) + a[k : k + r.randint(80, 300)] + words(r, 3) + b[:k]))
    rows += [(90, "ab" * 400), (91, "x" * 700), (92, base[0]), (93, base[0]), (94, None), (95, ""), (96, "short"), (97, "y" * 99), (98, "y" * 100)]
    r.shuffle(rows)
    assert repeats(docs(spark, rows)) == brute_repeats(rows, 100)


def test_repeats_in_texts_over_a_segment(spark, monkeypatch):
    r = random.Random(6)
    long = words(r, 70_000)
    rows = [(1, long + long[1000:9000]), (2, words(r, 400) + long[260_000:263_000])]
    assert len(rows[0][1].encode()) > suffix_dedup.SEGMENT
    assert repeats(docs(spark, rows)) == brute_repeats(rows, 100)


def test_repeats_of_odd_tables(spark):
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0
    rows = suffix_dedup.remove_repeats(docs(spark, [(1, "z" * 150), (1, "z" * 150), (None, "z" * 150)])).collect()
    assert sorted((str(r.doc_id), len(r.kept)) for r in rows) == [("1", 0), ("1", 1), ("None", 150)]
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs(spark, []), length=40)


def test_levels_merge_geometrically():
    levels, n = suffix_dedup.Levels(400), 0
    r = np.random.default_rng(1)
    for _ in range(40):
        key = np.sort(r.integers(0, 300, 10).astype(np.uint64))
        levels.add((key, np.arange(n, n + 10).astype(np.uint64), np.arange(n, n + 10), np.zeros(10, int), np.arange(n, n + 10)))
        n += 10
    sizes = [len(a[0]) for a in levels.levels]
    assert sum(sizes) == 400 and all(a > 2 * b for a, b in zip(sizes, sizes[1:])) and len(sizes) < 8
    assert levels.close().max() == suffix_dedup.OPEN


def brute_fingerprint(text, n):
    w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if x]
    if not w:
        return 0
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark):
    r = random.Random(2)
    texts = [words(r, n) for n in (1, 2, 3, 4, 50)] + ["", None, " \t\n", "ÀB c  D\x0be\x1ff", "a" * 100_000, "w " * 30_000]
    got = {x.doc_id: x.fp & (2**64 - 1) for x in simhash.fingerprints(docs(spark, list(enumerate(texts)))).collect()}
    for n, t in enumerate(texts):
        assert got[n] == brute_fingerprint(t, 3), t and t[:30]


def brute_components(fps, distance):
    label = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if (fps[i] ^ fps[j]).bit_count() <= distance and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@pytest.mark.parametrize("group", [2, 64])
def test_close_pairs_make_the_same_components(spark, group):
    r = random.Random(9)
    values = {r.getrandbits(64) for _ in range(20)}
    for v in list(values)[:8]:
        for _ in range(12):
            for _ in range(r.randint(1, 3)):
                v ^= 1 << r.randrange(64)
            values.add(v)
    values |= {0, 3, 2**63, 2**64 - 1}
    fps = dict(enumerate(sorted(values)))
    signed = {i: v - 2**64 if v >> 63 else v for i, v in fps.items()}
    pairs = simhash.close_pairs(spark.createDataFrame([(v,) for v in signed.values()], "fp long"), 2, group=group).collect()
    back = {v: i for i, v in signed.items()}
    assert all((fps[back[p.u]] ^ fps[back[p.v]]).bit_count() <= 2 for p in pairs)
    roots = {back[x.node]: x.root for x in components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    want, got = brute_components(fps, 2), {}
    for i in fps:
        got.setdefault(roots.get(i, signed[i]), []).append(i)
    groups = {}
    for i, x in want.items():
        groups.setdefault(x, []).append(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_groups_of_odd_rows(spark):
    rows = [(5, "a b c d"), (3, "A b  c D"), (9, None), (7, ""), (4, "other words here now"), (4, "other words here now"), (None, "a b c d")]
    got = sorted(((x.doc_id, x.component_id) for x in simhash.simhash_groups(docs(spark, rows)).collect()), key=lambda x: (x[0] is None, x))
    assert got == [(3, 3), (4, 4), (4, 4), (5, 3), (7, 7), (9, 7), (None, 3)]
    assert simhash.simhash_groups(docs(spark, [])).count() == 0


def test_no_row_but_copies_goes(spark):
    a, b, c = ("first text of five words and more", "another text with the same number of words", "a third one that nobody has copied")
    rows = [(1, a), (1, b), (None, c), (1, a), (2, a.upper()), (None, None), (9, " "), (None, b)]
    df = docs(spark, rows)
    kept = simhash.drop_near_copies(df)
    assert sorted(map(repr, ((x.doc_id, x.text) for x in kept.collect()))) == sorted(map(repr, [(1, a), (1, b), (None, c), (9, " ")]))
    assert kept.columns == df.columns and simhash.drop_near_copies(docs(spark, [])).count() == 0
    groups = sorted(map(repr, ((x.doc_id, x.component_id) for x in simhash.similar_groups(df).collect())))
    assert groups == sorted(map(repr, [(1, 1), (1, 1), (None, None), (1, 1), (2, 1), (None, 9), (9, 9), (None, 1)]))


def jaccard(a, b, n=5):
    sets = [{tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


@pytest.mark.parametrize("group", [4, 32])
def test_similar_groups_meet_near_copies(spark, group, monkeypatch):
    r = random.Random(17)
    vocabulary = [words(r, 1) + str(i) for i in range(4000)]
    texts = [[r.choice(vocabulary) for _ in range(r.randint(200, 400))] for _ in range(120)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    of = {}
    for i in range(300):  # copies of sixty texts with one to three words changed; one text has sixty copies
        source = i % 60 if i < 240 else 7
        t = list(texts[source])
        for _ in range(r.randint(1, 3)):
            t[r.randrange(len(t))] = r.choice(vocabulary)
        of[1000 + i] = source
        rows.append((1000 + i, " ".join(t)))
    rows += [(5000, None), (5001, " "), (5002, "too few"), (None, rows[0][1]), (1, rows[1][1])]
    whole = simhash.similar_roots
    monkeypatch.setattr(simhash, "similar_roots", lambda nodes, n, s: whole(nodes, n, s, group=group))
    got = {x.doc_id: x.component_id for x in simhash.similar_groups(docs(spark, rows)).collect()}
    by_id = dict((i, t) for i, t in rows if i is not None)
    near = [i for i, s in of.items() if jaccard(by_id[i], by_id[s]) >= 0.85]
    assert len(near) > 250 and sum(got[i] == of[i] for i in near) >= 0.97 * len(near)
    assert all(got[i] == i for i in range(120)) and got[5001] == 5000 and got[5002] == 5002
    assert simhash.similar_groups(docs(spark, [])).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(100, 160)] + [(5, 5), (7000, 8000), (8000, 7000), (None, 3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[i] == 100 for i in (*range(101, 160), 1000)) and got[8000] == 7000
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_spread_lines(spark):
    common, near, rare = "Shared by many sites.", "Shared by just enough.", "Shared by too few."
    rows = []
    for i in range(30):
        lines = [f"own words of document {i} that nobody else has", f" {common}\t" if i < 12 else "", near if i < 8 else "x" * i, rare if i < 7 else ""]
        rows.append((i, "\n".join(lines), f"s{i}"))
    rows += [(90, f"{common}\n{common}", "s1"), (91, None, "s2"), (92, "", None), (93, f"long enough own text here\n{rare}", None), (93, "another row", "s3"), (None, f"{common}\nnull id", "s9")]
    got = {(r.doc_id, r.source): r for r in line_dedup.drop_spread_lines(docs(spark, rows), least_sites=8).collect()}
    assert len(got) == len(rows)
    assert got[0, "s0"].text == f"own words of document 0 that nobody else has\n{rare}" and (got[0, "s0"].n_lines, got[0, "s0"].n_removed) == (4, 2)
    assert got[11, "s11"].n_removed == 1 and got[12, "s12"].n_removed == 0 and got[12, "s12"].text == rows[12][1]
    assert got[90, "s1"].n_removed == 2 and got[90, "s1"].text == "" and got[None, "s9"].text == "null id"
    assert got[91, "s2"].text is None and got[91, "s2"].n_lines == 0 and got[92, None].text == "" and got[93, None].n_removed == 0
    assert line_dedup.drop_spread_lines(docs(spark, [])).count() == 0


def test_sketches_estimate_the_similarity(spark):
    r, rows = np.random.default_rng(5), []
    for n in (1, 5, 40, 150, 400, 3000, 40_000):
        for share in (0.0, 0.3, 0.7, 0.8, 0.9, 1.0):
            for _ in range(6):
                both = r.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2)
                cut = round(n * share)
                a, b = np.unique(both), np.unique(np.concatenate((both[:cut], r.integers(0, 2**63, n - cut, dtype=np.int64).astype(np.uint64))))
                rows.append((simhash.sketch(a).tolist(), simhash.sketch(b).tolist(), len(np.intersect1d(a, b)) / len(np.union1d(a, b))))
    rows.append(([0] * 64, [0] * 64, 1.0))
    got = spark.createDataFrame(rows, "a array<long>, b array<long>, j double").select("j", simhash.sketch_similarity("a", "b").alias("s")).collect()
    assert all(abs(x.j - x.s) < 0.073 or x.j < 0.6 for x in got) and all(x.s == 1 for x in got if x.j == 1) and max(abs(x.j - x.s) for x in got) < 0.2


def test_pairs_at_the_threshold_are_linked_and_others_are_not(spark):
    r = random.Random(23)
    vocabulary = [words(r, 1) + str(i) for i in range(4000)]
    rows, near, far = [], [], []
    for i in range(240):
        t = [r.choice(vocabulary) for _ in range(300)]
        rows.append((i, " ".join(t)))
        cut = r.choice((26, 27, 28, 38, 42))  # words changed in one run: similarities of 0.73, 0.75 and 0.80 to 0.82
        t[100 : 100 + cut] = [r.choice(vocabulary) + "x" for _ in range(cut)]
        rows.append((1000 + i, " ".join(t)))
        (near if jaccard(rows[-2][1], rows[-1][1]) >= 0.8 else far).append(i)
    got = {x.doc_id: x.component_id for x in simhash.similar_groups(docs(spark, rows)).collect()}
    assert len(near) > 30 and sum(got[1000 + i] == i for i in near) >= 0.85 * len(near)
    assert len(far) > 80 and all(got[1000 + i] == 1000 + i for i in far)


def test_large_blocks_are_compared_pair_by_pair(spark):
    """Near copies in a family with a long common passage: all blocks are large, and their smallest node is near none."""
    r = random.Random(31)
    vocabulary = [words(r, 1) + str(i) for i in range(4000)]
    common = [r.choice(vocabulary) for _ in range(200)]
    rows = []
    for i in range(200):
        own = [r.choice(vocabulary) for _ in range(100)]
        rows.append((i, " ".join(common + own)))
        own[50:54] = [r.choice(vocabulary) + "x" for _ in range(4)]
        rows.append((1000 + i, " ".join(common + own)))
    rows.append((-1, " ".join(common)))
    whole = simhash.similar_roots
    simhash.similar_roots = lambda nodes, n, s: whole(nodes, n, s, group=4)
    try:
        got = {x.doc_id: x.component_id for x in simhash.similar_groups(docs(spark, rows)).collect()}
    finally:
        simhash.similar_roots = whole
    assert sum(got[1000 + i] == i for i in range(200)) >= 190


@pytest.mark.parametrize("side", [8, 2048])
def test_each_member_of_a_crowd_meets_the_others(spark, side, monkeypatch):
    """Texts near one member of a crowd alone: that one is rarely the member that a block draws for its crowd."""
    r = random.Random(41)
    fresh = lambda n: [f"{words(r, 1)}{r.randrange(10**9)}" for _ in range(n)]
    centre, rows = fresh(300), []
    for i in range(60):
        member = [*centre[: 4 * i], *fresh(13), *centre[4 * i + 13 :]]  # 0.89 to the centre, 0.80 or less to other members
        partner = list(member)
        at = (4 * i + 150) % 270
        partner[at : at + 16] = fresh(16)  # 0.87 to its member, less than 0.8 to the rest
        rows += [(i, " ".join(member)), (1000 + i, " ".join(partner))]
    rows.append((-1, " ".join(centre)))
    close = {i for i in range(60) if jaccard(rows[2 * i][1], rows[2 * i + 1][1]) >= 0.84}
    only = {i for i in close if all(jaccard(rows[2 * i + 1][1], t) < 0.8 for k, t in rows if k != i and k != 1000 + i)}
    assert len(only) >= 50
    grid, whole = simhash._grid_pairs, simhash.similar_roots
    monkeypatch.setattr(simhash, "_grid_pairs", lambda large, s: grid(large, s, side))
    monkeypatch.setattr(simhash, "similar_roots", lambda nodes, n, s: whole(nodes, n, s, group=4))
    got = {x.doc_id: x.component_id for x in simhash.similar_groups(docs(spark, rows)).collect()}
    assert all(got[i] == -1 for i in range(60)) and sum(got[1000 + i] == -1 for i in only) >= 0.97 * len(only)


@pytest.mark.parametrize("side", [40, 1024])
def test_families_of_near_copies_make_no_row_for_each_pair(spark, side, monkeypatch):
    """One text with one to five words changed: about half of the pairs are alike enough, and others nearly so."""
    made, saved, whole, families = {}, simhash.save, simhash.similar_roots, simhash._family_links

    def save(df, tag, rows=None):
        out = saved(df, tag, rows)
        made[tag] = max(made.get(tag, 0), out.count())
        return out

    monkeypatch.setattr(simhash, "save", save)
    monkeypatch.setattr(components, "save", save)
    monkeypatch.setattr(simhash, "similar_roots", lambda nodes, n, s: whole(nodes, n, s, group=4))
    monkeypatch.setattr(simhash, "_family_links", lambda family, nodes, s: families(family, nodes, s, side, 100 * side))
    for n in (80, 240):
        r = random.Random(n)
        centre, rows = words(r, 150).split(), []
        for i in range(n):
            t = list(centre)
            for at in r.sample(range(150), r.choice((1, 2, 3, 4, 5))):
                t[at] = words(r, 1) + str(r.randrange(10**6))
            rows.append((i, " ".join(t)))
        rows += [(1000 + i, words(r, 60)) for i in range(n)]
        label = {i: i for i, _ in rows}
        sets = [set(zip(*(t.split()[k:] for k in range(5)))) for _, t in rows[:n]]
        for a in range(n):
            for b in range(a):
                if label[a] != label[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    old, new = max(label[a], label[b]), min(label[a], label[b])
                    label = {k: new if v == old else v for k, v in label.items()}
        assert len(set(label.values())) > n + 2
        made.clear()
        got = {x.doc_id: x.component_id for x in simhash.similar_groups(docs(spark, rows)).collect()}
        assert got == label
        assert max(made["pairs"], made["candidates"], made["edges"]) < 20 * n and made["family_links"] > 0, made


def broadcast_explodes(df):
    """The lines of the plan of ``df`` that make rows by explode inside a broadcast, without a shuffle between."""
    found, inside, past = [], [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        inside, past = ([d for d in at if d < depth] for at in (inside, past))
        name = line[depth:].split(" ")[0]
        if name == "BroadcastExchange":
            inside, past = [*inside, depth], []
        elif name == "Exchange":
            past.append(depth)
        elif name == "Generate" and " explode(" in line and inside and not past:
            found.append(line.strip()[:200])
    return found


def test_exploded_rows_are_never_broadcast(spark, monkeypatch):
    """Spark takes rows made by explode for as many as went in: a few MB of blocks' members made broadcasts of 1.6 GB."""
    found, planned, saved = [], [], simhash.save

    def save(df, tag, rows=None):
        planned.append(tag)
        found.extend(f"{tag}: {x}" for x in broadcast_explodes(df))
        return saved(df, tag, rows)

    n, r = 3000, np.random.default_rng(5)
    w = r.integers(-(1 << 63), 1 << 63, (n, 4 + 64), dtype=np.int64).tolist()
    prints = spark.createDataFrame([(i, x[:4], 100, x[4:], False, i, i) for i, x in enumerate(w)], "node long, w array<long>, size long, sketch array<long>, no_id boolean, id long, text_hash long")
    prints, none = saved(prints, "prints"), docs(spark, [])
    for module in (simhash, line_dedup, components):
        monkeypatch.setattr(module, "save", save)
    assert simhash.similar_roots(simhash.Nodes(prints, none, "doc_id", "text", 5), n, group=4).isEmpty()
    fps = saved(prints.select(F.get("w", F.lit(0)).alias("fp")), "fps")
    found += broadcast_explodes(simhash.close_pairs(fps.select(F.expr("fp & 65535").alias("fp")).distinct()))
    pages = spark.createDataFrame([(i, f"everywhere\nonly {i}", f"s{i % 20}") for i in range(200)], "doc_id long, text string, source string")
    cleaned = line_dedup.drop_spread_lines(saved(pages, "pages"))
    found += broadcast_explodes(cleaned)
    assert {"hubs", "blocks", "pairs", "cells", "lines"} <= {*planned} and not found, found
    assert {x.text for x in cleaned.collect()} == {f"only {i}" for i in range(200)}


def test_the_driver_is_cleaned_between_many_queries(spark, monkeypatch):
    asked, cleaned = [], common.clean
    monkeypatch.setattr(common, "clean", lambda s: asked.append(cleaned(s)))
    for _ in range(2 * common.CLEAN_AFTER):
        common.save(spark.range(1), "one")
    assert len(asked) == 2
