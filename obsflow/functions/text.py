"""Small text helpers shared by the message formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ends(text) -> Column:
    """Text without its first and last character."""
    text = _col(text)
    return F.substring(text, F.lit(2), F.greatest(F.length(text) - 2, F.lit(0)))


def split_pairs(text, pair_sep: str = ",", key_sep: str = ":") -> Column:
    return F.str_to_map(_col(text), F.lit(pair_sep), F.lit(key_sep))


def join_text(*parts, sep: str = ",") -> Column:
    return F.concat_ws(sep, *parts)


def number_text(number) -> Column:
    return _col(number).cast("string")


def number_from_text(text) -> Column:
    """Double from text that may carry blanks around the number; null if it is no number."""
    return F.trim(_col(text)).try_cast("double")


def station_from_path(path, pattern: str = r"([^/]+)\.json$") -> Column:
    """Station named by a file path; the default takes the stem of a ``.json`` file."""
    return F.regexp_extract(_col(path), pattern, 1)
