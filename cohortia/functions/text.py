"""Text predicates and the small string parsers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains(value: Column, part: str, *, case_insensitive: bool = True) -> Column:
    """Substring test; NULL stays NULL so a filter drops the row."""
    if case_insensitive:
        return F.contains(F.lower(value), F.lit(part.lower()))
    return F.contains(value, F.lit(part))


def lacks(value: Column, part: str, *, case_insensitive: bool = True) -> Column:
    """``NOT LIKE '%part%'`` with three-valued logic: a NULL value is dropped."""
    return ~contains(value, part, case_insensitive=case_insensitive)


def same_text(value: Column, text: str, *, case_insensitive: bool = True) -> Column:
    """A ``LIKE`` without wildcards, i.e. equality under the chosen case rule."""
    if case_insensitive:
        return F.lower(value) == F.lit(text.lower())
    return value == F.lit(text)


def not_blank(value: Column) -> Column:
    """``value <> ''`` where trailing blanks do not count; NULL is dropped."""
    return F.rtrim(value) != F.lit("")


def concat_blank(*values: Column) -> Column:
    """Concatenation in which NULL counts as an empty text."""
    return F.concat(*[F.coalesce(v, F.lit("")) for v in values])


def tutorial_experiment(tutorial: Column) -> Column:
    """``journey_A:4`` -> ``journey_4``: text up to ``_`` plus text after ``:``.

    A missing ``_`` contributes nothing; a missing ``:`` contributes the whole
    name, because an absent marker has position 0.
    """
    head = F.substring(tutorial, F.lit(1), F.locate("_", tutorial))
    tail = F.substring(tutorial, F.locate(":", tutorial) + 1, F.length(tutorial))
    return concat_blank(head, tail)


def tutorial_group(tutorial: Column) -> Column:
    """``journey_A:4`` -> ``A``: the one character after ``_``."""
    return F.substring(tutorial, F.locate("_", tutorial) + 1, F.lit(1))
