"""Numbers in free text with mixed locales, as native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"-?\d[\d.,]*\d|-?\d"
# Words that mark a proportion, so that a number over 1 beside them is a percentage.
PROPORTION_HINTS = ("auc", "acc", "f1", "recall", "specificity")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: an expression that names it many times stays small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_number(raw: Column, mode: str = "reference") -> Column:
    """The first number in a text, as struct<value double, is_percent boolean, raw_match string>; null without one.

    Of several separators the last is the decimal one. A single separator before exactly three digits groups
    thousands, even in ``0.875`` (= 875); ``mode='metric'`` reads a leading zero as a decimal instead. A percent sign
    anywhere divides by 100, and so does a proportion hint where the value is over 1.
    """
    if mode not in ("reference", "metric"):
        raise ValueError(f"unknown mode {mode!r}")

    def found(match: Column) -> Column:
        def scaled(value: Column) -> Column:
            size = scaled_value(raw, value)
            return F.when(value.isNotNull(), F.struct(size.alias("value"), is_percent(raw).alias("is_percent"), match.alias("raw_match")))

        return let(unscaled_value(match, mode), scaled)

    return let(number_in(raw), found)


def number_in(raw: Column) -> Column:
    """The first number in a text as it stands there; null without one."""
    return F.regexp_substr(raw, F.lit(NUMBER))


def unscaled_value(match: Column, mode: str = "reference") -> Column:
    """The value of a number's text, percent signs aside."""
    digits = F.translate(match, "-", "")
    plain = F.translate(digits, ".,", "")
    separators = F.length(digits) - F.length(plain)
    dotted = F.translate(digits, ",", ".")
    tail = F.substring_index(dotted, ".", -1)
    groups = (separators == 1) & (F.length(tail) == 3)
    if mode == "metric":
        groups &= F.translate(F.substring_index(dotted, ".", 1), "0", "") != ""
    head = F.substr(plain, F.lit(1), F.length(plain) - F.length(tail))
    text = F.when((separators == 0) | groups, plain).otherwise(F.concat(head, F.lit("."), tail))
    return text.try_cast("double") * F.when(match.startswith("-"), -1.0).otherwise(1.0)


def is_percent(raw: Column) -> Column:
    return F.contains(raw, F.lit("%"))


def scaled_value(raw: Column, value: Column) -> Column:
    """A number's value as its text means it: percentages and hinted proportions over 1 are divided by 100."""
    hinted = (value > 1) & F.lower(raw).rlike("|".join(PROPORTION_HINTS))
    return F.when(is_percent(raw) | hinted, value / 100).otherwise(value)


def parse_float(raw: Column, mode: str = "reference") -> Column:
    return parse_number(raw, mode)["value"]


def parse_int(raw: Column, mode: str = "reference") -> Column:
    """Rounded half to even."""
    return F.rint(parse_float(raw, mode)).try_cast("bigint")


def relative_difference(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1e-9))


def numbers_close(a: Column, b: Column, tolerance: float = 0.05) -> Column:
    """Whether two texts hold numbers within a relative tolerance; null if either holds none."""
    pair = F.struct(parse_float(a).alias("a"), parse_float(b).alias("b"))
    return let(pair, lambda p: relative_difference(p["a"], p["b"]) <= tolerance)


def shown(x: Column) -> Column:
    """A double as messages show it: shortest digits, plain from 1e-4 to 1e16, else with a signed exponent; 'None' if null."""
    size = F.abs(x)
    text = x.cast("string")
    trimmed = lambda s: F.regexp_replace(F.regexp_replace(s, "0+$", ""), r"\.$", ".0")
    mantissa = F.regexp_replace(F.regexp_extract(text, "^(.*)E", 1), r"\.0$", "")
    power = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    return (
        F.when(x.isNull(), "None")
        .when((size >= 1e7) & (size < 1e16), trimmed(x.try_cast("decimal(38,9)").cast("string")))
        .when((size > 0) & (size < 1e-3) & (size >= 1e-4), trimmed(x.try_cast("decimal(38,22)").cast("string")))
        .when(((size >= 1e16) | (size < 1e-4)) & (size > 0) & power.isNotNull(), F.concat(mantissa, F.lit("e"), exponent))
        .otherwise(text)
    )
