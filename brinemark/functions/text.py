"""Expressions over raw lines, file names and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brinemark.fixed_values import COASTS, MONTH_NAMES, SEA_STATES, UNKNOWN_SEA_STATE


WHITESPACE = " \t\n\r\f\v"


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def tokens(line: Column, reference_trim: bool = False) -> Column:
    """Whitespace-separated tokens of a line.

    All leading and trailing whitespace is dropped first; ``reference_trim``
    drops spaces only, so that a leading tab yields an empty first token.
    """
    clean = F.trim(line) if reference_trim else F.trim(line, F.lit(WHITESPACE))
    return F.split(clean, r"\s+")


def coast_from_path(path: Column, coasts: dict[str, str] = COASTS) -> Column:
    """Coast named by a file's stem (text before the first dot); '' if unknown."""
    file_name = F.substring_index(path, "/", -1)
    stem = F.lower(F.substring_index(file_name, ".", 1))
    return F.coalesce(F.try_element_at(literal_map(coasts), stem), F.lit(""))


def norm_month(value: Column) -> Column:
    """Month number for '1', '01', or a Spanish or English name; else NULL."""
    lookup = {}
    for number, names in MONTH_NAMES.items():
        for name in [str(number), f"{number:02d}", *names]:
            lookup[name] = number
    return F.try_element_at(literal_map(lookup), F.lower(F.trim(value.cast("string"))))


def sea_state_name(label: Column) -> Column:
    """Sea state of a model label 1..7; the sentinel for anything else."""
    names = {i: name for i, name in enumerate(SEA_STATES, start=1)}
    return F.coalesce(F.try_element_at(literal_map(names), label.cast("int")), F.lit(UNKNOWN_SEA_STATE))


def embedded_integer(value: Column) -> Column:
    """First integer inside a label, NULL if there is none."""
    return F.regexp_extract(value, r"\d+", 0).try_cast("bigint")


def unit_hash(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) that depends only on the seed and the row's values.

    Repeatable after task retries, unlike ``rand``. Built on md5 so that other
    SQL engines can reproduce it.
    """
    return hash_32(F.lit(seed), *cols) / F.lit(4294967296.0)


def hash_32(*cols: Column) -> Column:
    """32 hash bits of the joined values, as a bigint."""
    joined = F.concat_ws("-", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")
