"""Regex flags and first-match labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regex_flags(
    df: DataFrame,
    text_col: str,
    rules: Iterable[tuple[str, str]],
    prefix: str,
    literals: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One boolean column per (name, pattern); null text gives false, never null.

    ``literals`` names, per rule, lower-case ASCII words of which at least one is
    in every text the pattern matches. The pattern is then searched only in
    texts that hold one of them; a word search costs a small part of a pattern
    search, and most texts match few rules. The result is the same.

    All flags come from a single ``select``, so that analysis stays cheap
    however many rules there are.
    """
    lowered = f"_{text_col}_lowered"

    def flag(name: str, pattern: str) -> Column:
        found = F.col(text_col).rlike(pattern)
        words = [F.contains(F.col(lowered), F.lit(w)) for w in (literals or {}).get(name, ())]
        if words:
            found = reduce(or_, words) & found
        return F.coalesce(found, F.lit(False)).alias(prefix + name)

    # A column of its own: Spark keeps it in a separate projection and lowers
    # each text once, not once per word.
    return df.withColumn(lowered, F.lower(text_col)).select(
        *df.columns, *[flag(name, pattern) for name, pattern in rules]
    )


def first_match(labels: Iterable[tuple[str, str]], default: str) -> Column:
    """Label of the first true flag in (flag column, label) order."""
    branches = list(labels)
    if not branches:
        return F.lit(default)
    flag, label = branches[0]
    result = F.when(F.col(flag), label)
    for flag, label in branches[1:]:
        result = result.when(F.col(flag), label)
    return result.otherwise(default)
