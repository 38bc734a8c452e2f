"""Text, identifier and scoring expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that mark results, models and evaluation in Portuguese and English papers.
METRIC_PATTERN = (
    r"(auc|roc[ -]?auc|accuracy|acuracia|precision|precisao|recall|sensitiv\w*|"
    r"specificity|especificidade|f1[ -]?score|rmse|\bmae\b|\bmse\b|\br2\b|r²|"
    r"brier|calibra\w*|gini|kolmogorov|\bks\b|log[ -]?loss|matthews|\bmcc\b|balanced accuracy)"
)
MODEL_PATTERN = (
    r"(regress\w+|random[ ]?forest|floresta|xgboost|lightgbm|catboost|gradient[ ]?boost|"
    r"\bgbm\b|\bsvm\b|support vector|neural|deep learning|lstm|cnn|rnn|transformer|"
    r"naive bayes|bayesian|knn|k-nearest|decision tree|arvore de decis|discriminant|"
    r"ensemble|stacking|voting|bagging|survival|\bcox\b|elastic net|lasso|ridge)"
)
ANCHOR_PATTERN = (
    r"(performance|desempenho|validation|valida\w+|discrimination|discrimina\w+|"
    r"comparison|compara\w+|evaluation|avalia\w+|baseline)"
)
#: Letters that count as ASCII ones where case does not, and do not become these in lower case.
FOLDED = ("\u017f\u0131\u0130\u212a", "siik")


def by_first_letter(pattern: str) -> str:
    """The same alternatives, grouped by the letter they begin with, so that most places in a text fail at one look."""
    groups: dict[str, list[str]] = {}
    for word in pattern[1:-1].split("|"):
        groups.setdefault(word.removeprefix(r"\b")[0], []).append(word)
    return f"(?=[{''.join(groups)}])(?:" + "|".join(f"(?={c})(?:{'|'.join(words)})" for c, words in groups.items()) + ")"


def matches(text: Column, pattern: str) -> Column:
    """How often one of a pattern's alternatives, in lower case, occurs in any case, with Unicode word characters. The text is
    folded once, which is cheaper than to match each letter in both cases."""
    return F.regexp_count(F.lower(F.translate(text, *FOLDED)), F.lit("(?U)" + by_first_letter(pattern)))


def collapse(text: Column) -> Column:
    """Runs of white space, Unicode's included, as one space; none at the ends; null as ''."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "), "^ | $", "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def estimated_tokens(text: Column) -> Column:
    """A third of the characters, which leaves room for accented text."""
    return F.floor(F.length(text) / 3).cast("int")


def context_size(prompt_chars: Column, floor: int, max_tokens: int, margin: int = 1024) -> Column:
    """Context to ask a model server for: the prompt's estimated tokens, the answer's and a margin, but ``floor`` at least."""
    return F.greatest(F.lit(floor), (F.floor(prompt_chars / 3) + max_tokens + margin).cast("int"))


def digit_density(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\d")) / F.greatest(F.length(text), F.lit(1))


def normalize_doi(doi: Column) -> Column:
    bare = F.regexp_replace(F.lower(collapse_ends(doi)), r"^https?://(dx\.)?doi\.org/", "")
    return F.coalesce(collapse_ends(F.regexp_replace(bare, r"^doi:(?U)\s*", "")), F.lit(""))


def collapse_ends(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalize_title(title: Column) -> Column:
    """Letters a-z and digits only; accented letters go."""
    return F.coalesce(F.regexp_replace(F.lower(title), "[^a-z0-9]", ""), F.lit(""))


def record_id(doi: Column, title: Column) -> Column:
    d, t = normalize_doi(doi), normalize_title(title)
    return F.when(d != "", F.concat(F.lit("doi:"), d)).when(t != "", F.concat(F.lit("title:"), t))


def paper_id_of(record: Column) -> Column:
    """A record id as a safe file stem."""
    return F.regexp_replace(record, "[^a-zA-Z0-9._-]", "_")


def now_iso() -> Column:
    """UTC, to the second; needs a UTC session time zone."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def recovered_json(raw: Column) -> Column:
    """The text between the first { and the last } of an answer with fences or chatter around; null without both."""
    found = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)
