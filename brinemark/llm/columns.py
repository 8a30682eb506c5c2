"""Column helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from brinemark.session import stored

__all__ = ["ascii_lower", "packed", "quoted", "stored", "without"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` that do not clash with ``names`` (case does not count)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, but: Iterable[str] = ()) -> Column:
    """The columns of ``df`` other than ``but`` as one struct ``row_``, safe from clashes with an operator's own."""
    return F.struct(*[quoted(c) for c in without(df, but)]).alias("row_")
