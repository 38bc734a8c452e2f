"""Line-first cleaning: rules on each line, then on what a document has left. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import SPACE

SYMBOLS = "[#*$%&|<>]"
#: Fixed phrases of legal and site furniture, in lower case.
BOILERPLATE = (
    "all rights reserved", "copyright", "terms of use", "terms of service", "privacy policy", "cookie", "click here",
    "sign up", "log in", "subscribe", "licensed under", "spdx-license-identifier", "powered by", "javascript",
    "alle rechte vorbehalten", "datenschutz", "impressum", "tous droits réservés", "mentions légales",
    "todos los derechos reservados", "aviso legal",
)


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def line_fails(line: Column) -> Column:
    """Whether a line breaks a rule on punctuation, navigation or boilerplate. Blank lines do not.

    Punctuation: over one symbol or exclamation mark for five words, or no letter at all. Navigation: two
    or more separators of menu entries. Boilerplate: a fixed phrase.
    """
    n_words = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    marks = F.regexp_count(line, F.lit(r"[#*$%&|<>!{}~^=]"))
    menu = F.regexp_count(line, F.lit(r" [|»›·•] "))
    phrase = F.lower(line).rlike("|".join(BOILERPLATE))
    letters = line.rlike(r"\p{L}")
    return (n_words > 0) & ((5 * marks > n_words) | ~letters | (menu >= 2) | phrase)


def clean_lines(
    docs: DataFrame, text_col: str = "text", most_repeated: int = 20, least_words: int = 10, least_left: float = 0.5
) -> DataFrame:
    """``docs`` with the counts below, ``clean_text`` and ``kept``.

    n_words; word_chars (code points in words); n_symbols; n_dup_lines (lines with a word, equal to an earlier line);
    n_repeat_words (words in five-word windows found twice or more in the text); base_failed (under ``least_words``
    words, or over ``most_repeated`` percent repeated); clean_text (the lines that pass their rules); kept: not
    base_failed, and the clean text has ``least_left`` of the words' characters.

    Windows are told apart by 64-bit hashes, inside one text. Null and empty texts have no words and fail.
    ``text_col`` is left as it is; input columns with the names of added ones are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("__rules_words", words(F.col(text_col))).withColumn("__rules_lines", F.split(text, "\n"))
    out = out.withColumn("n_words", F.size("__rules_words").cast("long"))
    windows = F.transform(F.sequence(F.lit(1), F.size("__rules_words") - 4), lambda i: F.xxhash64(F.slice("__rules_words", i, 5)))
    out = out.withColumn("__rules_windows", F.when(F.size("__rules_words") >= 5, windows).otherwise(F.array().cast("array<bigint>")))
    numbered = F.transform("__rules_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    again = F.size(F.array_distinct("__rules_windows")) < F.size("__rules_windows")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.withColumn("__rules_sorted", F.when(again, F.sort_array(numbered)).otherwise(none)).drop("__rules_windows", "__rules_words")
    twice = F.expr(
        """sort_array(transform(
             filter(__rules_sorted, (x, k) -> x.h = get(__rules_sorted, k - 1).h OR x.h = get(__rules_sorted, k + 1).h), x -> x.i))"""
    )
    out = out.withColumn("__rules_twice", twice).drop("__rules_sorted")
    covered = F.expr(
        """aggregate(__rules_twice, named_struct('n', 0L, 'last', -5),
             (a, i) -> named_struct('n', a.n + least(5, i - a.last), 'last', i), a -> a.n)"""
    )
    lines = F.filter("__rules_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    clean = F.array_join(F.filter("__rules_lines", lambda x: ~line_fails(x)), "\n")
    size = lambda c: F.length(F.regexp_replace(c, SPACE, "")).cast("long")
    out = (
        out.withColumn("n_repeat_words", covered)
        .withColumn("__rules_full", lines)
        .withColumn("word_chars", size(text))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_dup_lines", (F.size("__rules_full") - F.size(F.array_distinct("__rules_full"))).cast("long"))
        .withColumn("clean_text", clean)
        .drop("__rules_lines", "__rules_full", "__rules_twice")
    )
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (size(F.col("clean_text")) >= least_left * F.col("word_chars")))
