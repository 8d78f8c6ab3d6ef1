"""Predicates with two-valued logic and rule lists that become one CASE expression.

A null never matches, and its negation does: every predicate is wrapped so
that ``~predicate`` keeps rows with nulls.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_in(col: Column, values: Sequence) -> Column:
    return sure(col.isin(*values))


def not_in(col: Column, values: Sequence) -> Column:
    """Every value differs; a null differs from all."""
    return ~is_in(col, values)


def matches_any(col: Column, patterns: Sequence[str], ignore_case: bool = False) -> Column:
    """Some regular expression is found in the text."""
    pattern = "|".join(patterns)
    return sure(col.rlike(f"(?i){pattern}" if ignore_case else pattern))


def starts_any(col: Column, prefixes: Sequence[str]) -> Column:
    return sure(col.cast("string").rlike("^(" + "|".join(prefixes) + ")"))


def greater(col: Column, value) -> Column:
    return sure(col > value)


def keyword_in(col: Column, words: Sequence[str]) -> Column:
    """Some keyword occurs literally in the text."""
    hit = F.lit(False)
    for word in words:
        hit = hit | sure(F.contains(col.cast("string"), F.lit(word)))
    return hit


def char_at(col: Column, index: int, char: str) -> Column:
    return sure(F.substring(col, index + 1, 1) == char)


def first_char_in(col: Column, chars: Sequence[str]) -> Column:
    return is_in(F.substring(col, 1, 1), chars)


def has_length(col: Column, length: int) -> Column:
    return sure(F.length(col) == length)


def month_from(date: Column, month: int) -> Column:
    return sure(F.month(date) >= month)


def label(condition: Column, yes: str, no: str | None) -> Column:
    return F.when(condition, yes).otherwise(F.lit(no))


def position_label(col: Column, index: int, char: str, yes: str, no: str, length: int | None = None) -> Column:
    hit = char_at(col, index, char)
    return label(hit & has_length(col, length) if length else hit, yes, no)


def acquisition_flag(col: Column, length: int, first: Sequence[str], yes: str = "Acq", no: str = "NonAcq") -> Column:
    return label(has_length(col, length) & first_char_in(col, first), yes, no)


def classify(rules: Sequence[tuple[Column, str | Column]], default=None, match: str = "first") -> Column:
    """Label of the first (or last) rule that holds, as one CASE."""
    ordered = list(rules) if match == "first" else list(reversed(rules))
    out = None
    for condition, value in ordered:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(sure(condition), value) if out is None else out.when(sure(condition), value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def first_true_label(columns: Sequence[str]) -> Column:
    """Name of the first true boolean column, else ``no_label``."""
    return classify([(F.col(c), c) for c in columns], "no_label")


def appeal_program(code: Column, letters: dict[str, str], nulls: Sequence[str], exact: dict[str, str]) -> Column:
    """Program of an appeal: excluded codes, then first letter of 3-4 character codes, then exact codes."""
    short = sure(F.length(code).isin(3, 4))
    rules = [(is_in(code, nulls), None)]
    rules += [(short & first_char_in(code, [k]), v) for k, v in letters.items()]
    rules += [(sure(F.upper(code) == k), v) for k, v in exact.items()]
    return classify(rules)


def appeal_filter(code: Column, first: Sequence[str], words: Sequence[str], yes: str = "Tracked", no: str = "Other") -> Column:
    short = sure(F.length(code).isin(3, 4)) & first_char_in(code, first)
    dashed = (char_at(code, 1, "-") | char_at(code, 2, "-")) & sure(F.length(code) >= 4)
    return label(short | dashed | matches_any(code, words), yes, no)


# ---- registry of named transforms -------------------------------------------------

class Registry:
    """Named DataFrame transforms, applied in order; hooks and features use the same one."""

    def __init__(self) -> None:
        self._steps: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def register(self, name: str, step: Callable[[DataFrame], DataFrame] | None = None):
        if step is None:
            return lambda f: self.register(name, f)
        self._steps[name] = step
        return step

    def __contains__(self, name: str) -> bool:
        return name in self._steps

    def names(self) -> list[str]:
        return list(self._steps)

    def apply(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        """Unknown names and columns that already exist are skipped."""
        for name in names:
            if name in self._steps and name not in df.columns:
                df = df.transform(self._steps[name])
        return df
