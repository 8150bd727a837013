"""Text normalisation and word-list tests as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# White space as a crawler's text has it: every Unicode space plus the four ASCII
# separators. Java's \s needs the U flag for that.
SPACE = r"(?U)[\s\x1c-\x1f]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, however often the body mentions it.

    The value is the start of a fold over nothing and the body its finish, so that no
    array is built around it.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def blank_to_null(c: Column | str) -> Column:
    """NULL for the empty string, the value otherwise."""
    return F.nullif(col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Trim all Unicode white space, not only U+0020."""
    return F.regexp_replace(col(c), f"^{SPACE}+|{SPACE}+$", "")


def collapse_spaces(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(c), f"{SPACE}+", " "))


def normalize_text(c: Column | str) -> Column:
    """Matching key of a text: lower case, ё as е, only digits and Latin or Cyrillic
    letters, single spaces; NULL when nothing is left."""
    folded = F.replace(F.lower(col(c)), F.lit("ё"), F.lit("е"))
    return blank_to_null(F.trim(F.regexp_replace(folded, "[^0-9a-zа-я]+", " ")))


def normalize_phone(c: Column | str) -> Column:
    """Digits only; an 11-digit number starting with 8 gets the country code 7."""
    digits = F.regexp_replace(col(c), r"(?U)\D+", "")
    domestic = (F.length(digits) == 11) & digits.startswith("8")
    return blank_to_null(
        F.when(domestic, F.concat(F.lit("7"), F.substring(digits, 2, 10))).otherwise(digits)
    )


def contains_any(text: Column, words: list[str], normalize: bool = True) -> Column:
    """True when any word occurs in `text` as a substring.

    Words are literals, so their normalisation folds away at planning time and each
    test stays a byte search inside generated code.
    """
    def needle(word: str) -> Column:
        return F.coalesce(normalize_text(F.lit(word)), F.lit("")) if normalize else F.lit(word)

    tests = [F.contains(text, needle(word)) for word in words]
    return reduce(Column.__or__, tests, F.lit(False))


def ordered_unique(values: Column | str) -> Column:
    """Trimmed, non-blank values of an array in order of first occurrence."""
    trimmed = F.transform(col(values), strip)
    return F.array_distinct(F.filter(trimmed, lambda v: v.isNotNull() & (v != "")))
