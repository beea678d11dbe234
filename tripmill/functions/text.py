"""Expressions on text columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A top-level column by its exact name, dots included."""
    return F.col(quoted(name))


def any_of(terms: Iterable[Column]) -> Column:
    return reduce(or_, terms, F.lit(False))


def has_outer_blanks(text: Column) -> Column:
    """False, not null, where the text is null."""
    return F.coalesce(F.length(text) != F.length(F.trim(text)), F.lit(False))


def is_all_upper(text: Column) -> Column:
    """True for any text without a lower-case letter, digits and '' included."""
    return F.upper(text) == text


def is_all_lower(text: Column) -> Column:
    return F.lower(text) == text


def contains_word(text: Column, word: str, ignore_case: bool = True) -> Column:
    return F.lower(text).contains(word.lower()) if ignore_case else text.contains(word)


def equals_ignoring_case(text: Column, other: str) -> Column:
    """Both in Spark's lower case."""
    return F.lower(text) == F.lower(F.lit(other))


def any_contains(names: Iterable[str], word: str, ignore_case: bool = True) -> Column:
    return any_of(contains_word(column(n), word, ignore_case) for n in names)


def remove_pattern(text: Column, pattern: str) -> Column:
    """Remove every match of ``pattern``."""
    return F.regexp_replace(text, pattern, "")
