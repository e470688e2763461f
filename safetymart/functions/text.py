"""Text, date and key helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """True for null, empty and spaces-only text (a tab is not a blank)."""
    return text.isNull() | (F.trim(text) == "")


def first_list_item(text: Column, separator: str = ",") -> Column:
    """First element of a separated list, trimmed; '' stays '' and null stays null."""
    return F.trim(F.substring_index(text, separator, 1))


def parse_date(text: Column, pattern: str) -> Column:
    """Date from text, null where the text is not a real date in that pattern.

    ``to_date`` raises on such text when ANSI mode is on, the default in Spark 4.
    """
    return F.try_to_date(text, pattern)


def state_code(state: Column, codes: dict[str, str]) -> Column:
    """Two-letter code of a state name; anything else passes in upper case.

    Two-character values are codes already and not looked up.
    """
    name = F.trim(state)
    code_of = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    looked_up = F.when(F.length(name) != 2, code_of[F.lower(name)])
    return F.coalesce(looked_up, F.upper(name))


def content_key(prefix: str, *fields: str) -> Column:
    """``prefix`` + md5 of the given fields: equal records get equal keys.

    Unlike a generated row number the key does not depend on how the input is
    split, so that a lost executor or a rerun gives the same ids. Each value goes
    in with its length, so that neither a separator inside a value nor a value
    that looks like the null mark can make two different records equal.
    """
    parts = [
        F.coalesce(
            F.concat(F.length(name).cast("string"), F.lit(":"), F.col(name)), F.lit("~")
        )
        for name in fields
    ]
    return F.concat(F.lit(prefix), F.md5(F.concat_ws("|", *parts)))


def surrogate_key(*values: Column, null_marker: str) -> Column:
    """md5 of the values joined by a hyphen, nulls spelled as ``null_marker``."""
    spelled = [F.coalesce(v.cast("string"), F.lit(null_marker)) for v in values]
    return F.md5(F.concat_ws("-", *spelled))
