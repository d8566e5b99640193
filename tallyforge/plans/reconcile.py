"""Comparison of a roster file with the user directory."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge.functions.labels import code_label
from tallyforge.operators.latest import first_by


def user_matches(
    roster: DataFrame,
    directory_users: DataFrame,
    code_map: Mapping[str, str] | DataFrame = V.INSTITUTION_CODES,
) -> DataFrame:
    """Each roster line with what of it agrees with the directory.

    A user in several institutions is compared at the one with the smallest id.  The institution
    agrees when the codes are equal or the map leads to the directory's; a code the map does not
    know is a mismatch.  The map is a table (code, mapped_code), or what makes one, and is joined.
    """
    one = first_by(directory_users, ["username"], ["institution_id", "institution_code"])
    known = one.select(
        "username",
        F.col("institution_code").alias("known_institution"),
        F.col("student").alias("known_student"),
        code_label(F.col("gender"), V.LEGACY_GENDER_LABELS).alias("known_gender"),
        F.lit(True).alias("found"),
    )
    if not isinstance(code_map, DataFrame):
        code_map = roster.sparkSession.createDataFrame(list(code_map.items()), "code string, mapped_code string")
    codes = code_map.select(F.col("code").alias("institution_code"), "mapped_code")
    coded = roster.join(codes, "institution_code", "left")

    found = F.coalesce("found", F.lit(False))
    student = code_label(F.col("student"), V.ROSTER_STUDENT_FLAGS)
    gender = code_label(F.trim("gender"), V.ROSTER_GENDER_LABELS)
    institution = F.coalesce(
        F.col("institution_code") == F.col("known_institution"), F.lit(False)
    ) | F.coalesce(F.col("mapped_code") == F.col("known_institution"), F.lit(False))

    def when_found(agrees):
        return F.when(F.col("found"), F.coalesce(agrees, F.lit(False)))

    return coded.join(known, "username", "left").select(
        "username",
        found.alias("found"),
        when_found(student == F.col("known_student")).alias("student_match"),
        when_found(institution).alias("institution_match"),
        when_found(gender == F.col("known_gender")).alias("gender_match"),
    )


def summary(matches: DataFrame) -> DataFrame:
    """Mismatch totals over the users that were found."""

    def mismatches(column):
        return F.count_if(~F.col(column)).alias(column.replace("_match", "_mismatches"))

    return matches.agg(
        F.count("*").alias("roster_users"),
        F.count_if(F.col("found")).alias("found_users"),
        mismatches("gender_match"),
        mismatches("institution_match"),
        mismatches("student_match"),
    )
