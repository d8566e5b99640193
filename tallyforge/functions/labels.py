"""Codes to labels, names and text clean-up."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge import fixed_values as V


def code_label(code: Column, labels: Mapping, otherwise: Column | None = None) -> Column:
    """Label of a code; unknown codes give ``otherwise`` (null when not given)."""
    chain = None
    for key, label in labels.items():
        chain = (F.when if chain is None else chain.when)(code == F.lit(key), F.lit(label))
    return chain if otherwise is None else chain.otherwise(otherwise)


def gender_label(code: Column) -> Column:
    return code_label(code, V.GENDER_LABELS)


def student_label(flag: Column) -> Column:
    return code_label(flag, V.STUDENT_LABELS)


def astronomy_label(flag: Column) -> Column:
    return code_label(flag, V.ASTRONOMY_LABELS)


def nationality_label(country: Column) -> Column:
    """National for the home country; any other country, or none, is "Other"."""
    return F.when(country == V.NATIONAL_COUNTRY, V.NATIONAL_LABEL).otherwise(V.OTHER_LABEL)


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def project_code(code: Column) -> Column:
    """The short code: the first four characters."""
    return F.substring(code, 1, 4)


def project_type(code: Column) -> Column:
    """The type suffix: from the sixth character on."""
    return F.substring(code, 6, 2147483647)


def dash_to_empty(token: Column) -> Column:
    """Log files write an absent string as ``-``."""
    return F.when(token == "-", "").otherwise(token)


def strip(text: Column) -> Column:
    """Remove white space, tabs and line ends included, from both ends."""
    return F.btrim(text, F.lit(" \t\r\n\x0b\x0c"))


def words(text: Column, limit: int = -1) -> Column:
    """Split on runs of white space, as an array without empty words at the ends.

    With a limit of n the first n - 1 words are split off, and the last one holds the rest.

    Most lines are separated by single spaces, and splitting on one plain character is about twice
    as fast as on a pattern; the pattern is kept for the lines that need it.
    """
    irregular = text.contains("  ") | text.startswith(" ") | text.endswith(" ")
    for character in "\t\r\n\x0b\x0c":
        irregular = irregular | text.contains(character)
    return F.when(irregular, F.split(strip(text), r"\s+", limit)).otherwise(F.split(text, " ", limit))


def dataset_family(database: Column) -> Column:
    """Dataset family of a database name; null for a missing or empty name."""
    chain = F.when(database.isNull() | (database == ""), None)
    for needle, family in V.DATASET_FAMILIES:
        chain = chain.when(database.contains(needle), family)
    return chain.otherwise(V.READY_MADE_FAMILY)
