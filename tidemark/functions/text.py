"""Text, key and change expressions."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the collation under which case and trailing blanks do not count.
CASELESS = "UTF8_LCASE_RTRIM"
BINARY = "UTF8_BINARY"


def nth_token(text: Column, delimiters: str, n: int) -> Column:
    """The n-th non-empty token (from 1); NULL past the end."""
    pieces = F.split(F.collate(text, BINARY), "[" + re.escape(delimiters) + "]")
    return F.try_element_at(F.filter(pieces, lambda piece: piece != ""), F.lit(n))


def fold(text: Column) -> Column:
    """Text as the source system compares it: case and trailing blanks do not count."""
    return F.upper(F.rtrim(text))


def caseless_key(text: Column) -> Column:
    """Plain text that is equal where ``text``, declared caseless, is equal.

    Keys made of it are hashed alike in joins, groupings and windows; a caseless text is not.
    """
    return F.translate(F.lower(F.rtrim(F.collate(text, BINARY))), "\u03c2", "\u03c3")


def caseless_value(text: str) -> str:
    """What ``caseless_key`` makes of a literal."""
    return text.rstrip(" ").lower().replace("\u03c2", "\u03c3")


def is_caseless(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType
    return isinstance(kind, T.StringType) and kind.collation == CASELESS


def _collated(df: DataFrame, columns: Sequence[str] | None, collation: str) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    wanted = texts if columns is None else list(columns)
    if other := [c for c in wanted if c not in texts]:
        raise ValueError(f"no text columns: {other}")
    return df.withColumns({c: F.collate(F.col(f"`{c}`"), collation) for c in wanted})


def caseless(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns (all, or those named) that compare as in the source system.

    The texts stay as they are, but joins, ``IN``, comparisons with literals, windows and groupings
    of these columns pass over case and trailing blanks. Both sides of a join must be declared.
    Grouping by such a column is planned as a sort; ``folded`` keeps hash aggregation.
    """
    return _collated(df, columns, CASELESS)


def cased(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Back to plain text, for files that know no collations and for readers that compare bytes."""
    return _collated(df, columns, BINARY)


def folded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named text columns folded once where they are read: equal texts become the same text."""
    return df.withColumns({c: fold(F.collate(F.col(f"`{c}`"), BINARY)) for c in columns})


def like(df: DataFrame, text: str | Column, pattern: str) -> Column:
    """``LIKE`` as the text is declared in ``df``: without case where it is caseless.

    Trailing blanks count in both forms, as a pattern speaks of the whole text.
    """
    column = F.col(text) if isinstance(text, str) else text
    kind = df.select(column.alias("text")).schema["text"].dataType
    if kind.collation == BINARY:
        return column.like(pattern)
    return F.collate(column, BINARY).ilike(pattern)


def text_key(columns: Iterable[str | Column], null_mark: str = "NA") -> Column:
    """All values joined into one text, NULL as ``null_mark``.

    Two different rows can give the same text (NULL and the mark itself, or shifted borders);
    ``value_key`` has neither fault.
    """
    parts = [c if isinstance(c, Column) else F.col(c) for c in columns]
    return F.concat(*[F.coalesce(p.cast("string"), F.lit(null_mark)) for p in parts])


def value_key(columns: Sequence[str]) -> Column:
    """All values as one struct, to be compared null-safely."""
    return F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])


def any_differs(pairs: Iterable[tuple[Column, Column]], null_safe: bool = False) -> Column:
    """True when one pair differs. Plain ``!=`` misses a change from or to NULL."""
    if null_safe:
        tests = [~old.eqNullSafe(new) for old, new in pairs]
    else:
        tests = [old != new for old, new in pairs]
    if not tests:
        return F.lit(False)
    return F.coalesce(functools.reduce(operator.or_, tests), F.lit(False))


def yes_no(condition: Column) -> Column:
    """``Y`` when the condition is true, ``N`` when false or unknown."""
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))
