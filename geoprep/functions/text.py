"""Scalar string helpers, all plain Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoprep.spec import COUNTRY_CODE_MAP


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def underscore(c) -> Column:
    """Every space becomes ``_``; null stays null."""
    return F.replace(_col(c), F.lit(" "), F.lit("_"))


def country_code_map() -> Column:
    """The ISO-3 -> ISO-2 map as a literal map column."""
    return F.create_map(*[F.lit(x) for kv in COUNTRY_CODE_MAP.items() for x in kv])


def map_country(c) -> Column:
    """Mapped code when listed, the code itself otherwise; null stays null."""
    c = _col(c)
    # try_element_at: an absent key gives null (element_at raises under ANSI).
    return F.coalesce(F.try_element_at(country_code_map(), c), c)


def empty_to_null(c) -> Column:
    """'' -> null: empty partition values read back as null anyway, so make it explicit."""
    c = _col(c)
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)
