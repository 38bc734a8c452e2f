import pytest
from pyspark.sql import functions as F

from quotewright.functions import fuzzy
from quotewright.functions.numbers import numbers_close, parse_int, parse_number, shown
from quotewright.functions.text import collapse, estimated_tokens, normalize_doi, normalize_title, record_id, recovered_json

NUMBERS = [
    ("0.87", 0.87), ("87%", 0.87), ("63,02%", 0.6302), ("1.234", 1234.0), ("1,234", 1234.0), ("1.234,56", 1234.56),
    ("1,234.56", 1234.56), ("3.844", 3844.0), ("AUC=0.91", 0.91), ("-0.5", -0.5), ("1200 farmers", 1200.0),
    ("no data available", None), (None, None), ("0.875", 875.0), ("1,234,567", 1234.567), ("F1 0.9", 1.0),
    ("Accuracy 87", 0.87), ("", None), ("5", 5.0), ("recall of 12 %", 0.12), ("-1.234", -1234.0), ("1.,5", 1.5),
]


def test_numbers_of_every_locale(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(NUMBERS)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", parse_number(F.col("s"))["value"].alias("v")).collect()}
    for i, (s, want) in enumerate(NUMBERS):
        assert got[i] == pytest.approx(want) if want is not None else got[i] is None, s


def test_number_details_and_modes(spark):
    df = spark.createDataFrame([("0.875",), ("2.5",), ("3.5",), ("12%",)], "s string")
    n = parse_number(F.col("s"))
    rows = df.select("s", n.alias("n"), parse_number(F.col("s"), "metric")["value"].alias("m"), parse_int(F.col("s")).alias("w")).collect()
    assert [r.m for r in rows] == [0.875, 2.5, 3.5, 0.12]
    assert [r.w for r in rows] == [875, 2, 4, 0]
    assert rows[3].n.is_percent and rows[3].n.raw_match == "12"
    with pytest.raises(ValueError):
        parse_number(F.col("s"), "other")


def test_closeness_is_unknown_without_numbers(spark):
    df = spark.createDataFrame([("0.95", "0.96"), ("0.95", "0.60"), ("x", "0.9"), (None, "1"), ("0", "0")], "a string, b string")
    assert [r[0] for r in df.select(numbers_close(F.col("a"), F.col("b"))).collect()] == [True, False, None, None, True]


def test_shown_doubles(spark):
    values = [1.5, 87.0, 1e-05, 1.5e20, 0.0005, 12345678.9, 1e16, None, 0.0, -3.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(shown(F.col("x"))).collect()] == [str(v) for v in values]


def test_text_functions(spark):
    df = spark.createDataFrame([(" HTTPS://dx.doi.org/10.1/A ", "Á b-C 1"), ("doi:  10.2/b", ""), (None, "Título"), ("", None)], "d string, t string")
    rows = df.select(normalize_doi(F.col("d")), normalize_title(F.col("t")), record_id(F.col("d"), F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("10.1/a", "bc1", "doi:10.1/a"), ("10.2/b", "", "doi:10.2/b"), ("", "ttulo", "title:ttulo"), ("", "", None)]
    df = spark.createDataFrame([("a  b\n c ",), (None,)], "s string")
    assert [r[0] for r in df.select(collapse(F.col("s"))).collect()] == ["a b c", ""]
    assert spark.range(1).select(estimated_tokens(F.lit("x" * 300))).first()[0] == 100


def test_recovered_json(spark):
    df = spark.createDataFrame([('```json\n{"a": 1}\n```',), ("nothing",), ("} {",), (None,)], "s string")
    assert [r[0] for r in df.select(recovered_json(F.col("s"))).collect()] == ['{"a": 1}', None, None, None]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            row[j + 1], last = (last + 1 if x == y else max(row[j + 1], row[j])), row[j + 1]
    return row[-1]


def _partial(a, b):
    if len(a) > len(b):
        a, b = b, a
    windows = (b[max(0, i) : i + len(a)] for i in range(1 - len(a), len(b)))
    return max(200 * _lcs(a, w) / (len(a) + len(w)) for w in windows if w)


def test_ratios_against_brute_force():
    import random

    r = random.Random(3)
    for _ in range(120):
        a, b = ("".join(r.choice("abç ") for _ in range(r.randint(1, n))) for n in (80, 140))
        assert fuzzy.ratio(a, b) == pytest.approx(200 * _lcs(a, b) / (len(a) + len(b)))
        want = max(_partial(a, b), _partial(b, a)) if len(a) == len(b) else _partial(a, b)
        assert fuzzy.partial_ratio(a, b) == pytest.approx(want)


def test_seeded_windows_are_the_best_ones(monkeypatch):
    """Quotes altered in few or many places, in texts of few letters: the bound holds, whichever way is taken."""
    import random

    r, full = random.Random(8), []
    whole = fuzzy._best_full_window
    monkeypatch.setattr(fuzzy, "_best_full_window", lambda a, b: full.append(1) or whole(a, b))
    for letters, size in (("ab", 60), ("abc ", 150), ("abcdefghijk ", 400)):
        for _ in range(300):
            text = "".join(r.choice(letters) for _ in range(r.randint(40, size)))
            at = r.randrange(len(text))
            quote = list(text[at : at + r.randint(9, 70)])
            for _ in range(r.randint(0, 6)):
                i = r.randrange(len(quote) + 1)
                quote[i : i + r.randint(0, 1)] = r.choice(["", r.choice(letters), "\u00a4"])
            quote = "".join(quote)
            if 8 < len(quote) < len(text):
                assert fuzzy._best_window(quote, text) == whole(quote, text)
    assert 0 < len(full) < 700


def test_similar_names_against_all_pairs():
    import random

    from quotewright.operators.pairing import greedy_pairs

    r, kinds = random.Random(4), ["Random Forest", "Logistic Regression", "Gradient Boosting", "Support Vector Machine", "XGBoost", "LightGBM"]

    def name():
        s = list(r.choice(kinds) + r.choice(["", " (tuned)", " v2", " with SMOTE", " + PCA"]))
        for _ in range(r.randint(0, 2)):
            s[r.randrange(len(s))] = r.choice("abcxyz ")
        return "".join(s) if r.random() > 0.05 else ""

    for least in (60, 75, 90, 100):
        for _ in range(15):
            a, b = ([name() for _ in range(r.randint(0, 20))] for _ in "ab")
            score = lambda x, y: fuzzy.token_sort_ratio(x, y) if x and y else -1
            want = sorted((score(x, y), i, j) for i, x in enumerate(a) for j, y in enumerate(b) if score(x, y) >= least)
            assert sorted(fuzzy.similar_pairs(a, b, least)) == want
            assert sorted(fuzzy.similar_pairs(a, None, least)) == sorted((score(x, y), i, j) for i, x in enumerate(a) for j, y in enumerate(a) if i < j and score(x, y) >= least)
            pairs, taken = {}, set()
            for s, i, j in sorted(want, key=lambda s: (-s[0], s[1], s[2])):
                if i not in pairs and j not in taken:
                    pairs[i] = (j, s)
                    taken.add(j)
            assert greedy_pairs(a, b, least) == pairs


def test_large_papers_compare_few_names():
    import random

    from quotewright.operators.pairing import greedy_pairs

    r = random.Random(5)
    a = [f"{r.choice(['Random Forest', 'Logistic Regression', 'Deep Neural Network'])} setting {i} {r.randrange(10**6)}" for i in range(400)]
    b = [x if r.random() < 0.7 else f"{x} b" if r.random() < 0.8 else f"lost {i}" for i, x in enumerate(a)]
    r.shuffle(b)
    seen = []
    assert len(greedy_pairs(a, b, 60, seen)) > 370 and len(seen) < 400 * 400 / 10
    seen.clear()
    assert not list(fuzzy.similar_pairs(a, None, 97, seen)) and len(seen) < 400 * 399 / 2 / 10


def test_ratio_edges():
    assert fuzzy.token_sort_ratio("XGBoost", "XG Boost") == pytest.approx(66.667, abs=0.01)
    assert fuzzy.token_sort_ratio("Forest Random", "Random  Forest") == 100
    assert fuzzy.partial_ratio("", "") == 100 and fuzzy.partial_ratio("", "a") == 0 and fuzzy.partial_ratio("bc", "abcd") == 100


def test_registered_functions(spark):
    fuzzy.register(spark)
    assert spark.sql("SELECT token_sort_ratio('b a', 'a b'), partial_ratio('ab', NULL)").first()[:] == (100.0, None)
