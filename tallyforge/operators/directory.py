"""The user directory: users, departments, institutions and dated affiliations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge import schemas
from tallyforge.functions import labels as L
from tallyforge.operators.latest import first_by, newest_first
from tallyforge.operators.materialize import materialize
from tallyforge.sources.tables import JdbcSource, ParquetSource, load_table


TABLES = {
    "users": ("user", schemas.USERS),
    "departments": ("department", schemas.DEPARTMENTS),
    "institutions": ("institution", schemas.INSTITUTIONS),
    "affiliations": ("userdepartment", schemas.AFFILIATIONS),
    "user_systems": ("usersystem", schemas.USER_SYSTEMS),
    "projects": ("project", schemas.PROJECTS),
    "project_users": ("userproject", schemas.PROJECT_USERS),
}


class Directory:
    """The seven directory tables, each opened when first used.

    ``open_table`` gives a table by the name of its attribute.
    """

    def __init__(self, open_table: Callable[[str], DataFrame]):
        self._open_table = open_table

    @classmethod
    def load(
        cls, spark: SparkSession, source: ParquetSource | JdbcSource, prefix: str = ""
    ) -> "Directory":
        """Tables of a source in their declared schemas; ``prefix`` comes before each name."""

        def open_table(attribute: str) -> DataFrame:
            name, schema = TABLES[attribute]
            return load_table(spark, prefix + name, source, schema)

        return cls(open_table)

    def __getattr__(self, attribute: str) -> DataFrame:
        if attribute not in TABLES:
            raise AttributeError(attribute)
        table = self._open_table(attribute)
        setattr(self, attribute, table)
        return table

    #: Every affiliation with its person, place and systems, once ``prepared``.
    frame: DataFrame | None = None

    def prepared(self, systems: tuple[int, ...] = (V.EVENT_SYSTEM, V.EXTRACT_SYSTEM)) -> "Directory":
        """This directory with its affiliations joined once, written to the shared folder.

        Memberships, counts and labels then read that frame instead of joining the tables again.
        """
        other = Directory(lambda table: getattr(self, table))
        other.frame = materialize(affiliation_frame(self, systems), "directory")
        return other

    def system_users(self, system_id: int) -> DataFrame:
        return self.user_systems.filter(F.col("system_id") == system_id).select("user_id")


def places(directory: Directory) -> DataFrame:
    """Departments with their institution."""
    departments = directory.departments.select(
        F.col("id").alias("department_id"),
        "institution_id",
        F.col("name").alias("department"),
        "is_astronomy",
    )
    institutions = directory.institutions.select(
        F.col("id").alias("institution_id"), F.col("name").alias("institution"), "country"
    )
    return departments.join(institutions, "institution_id")


def people(directory: Directory) -> DataFrame:
    return directory.users.select(
        F.col("id").alias("user_id"),
        "username",
        "first_name",
        "last_name",
        "email_address",
        "gender",
        "is_student",
    )


def memberships(directory: Directory, system_id: int | None = None) -> DataFrame:
    """Affiliation rows with user, department and institution, one per affiliation row.

    With a system, only its users.  User joins come first and share one partitioning by user;
    departments follow, so a department or institution with very many members needs no shuffle
    when those small tables are broadcast, and is split at run time when they are not.
    """
    if directory.frame is not None:
        rows = directory.frame.filter("known AND placed")
        if system_id is None:
            return rows
        # A user entered twice in a system counts twice, as in the join.
        return rows.select("*", F.explode(F.array_repeat(F.lit(True), F.col(_rows_in(system_id)).cast("int")))).drop("col")
    rows = directory.affiliations.join(people(directory), "user_id")
    if system_id is not None:
        rows = rows.join(directory.system_users(system_id), "user_id")
    return rows.join(places(directory), "department_id")


def _rows_in(system_id: int) -> str:
    return f"rows_in_system_{system_id}"


def affiliation_frame(directory: Directory, systems: tuple[int, ...]) -> DataFrame:
    """Every affiliation row, with its person and place where they are known.

    ``known`` and ``placed`` say whether they are; ``rows_in_system_1`` and so on hold the user's
    number of entries in each system, null for none.  Each directory table is read once.
    """
    counts = directory.user_systems.filter(F.col("system_id").isin(*systems)).groupBy("user_id").agg(
        *[F.nullif(F.count_if(F.col("system_id") == s), F.lit(0)).alias(_rows_in(s)) for s in systems]
    )
    return (
        directory.affiliations.join(people(directory).withColumn("known", F.lit(True)), "user_id", "left")
        .join(counts, "user_id", "left")
        .join(places(directory).withColumn("placed", F.lit(True)), "department_id", "left")
    )


def affiliations_of(directory: Directory, system_id: int) -> DataFrame:
    """The outer rows of ``affiliation_frame``, with ``system_rows`` for one system."""
    frame = directory.frame if directory.frame is not None else affiliation_frame(directory, (system_id,))
    return frame.withColumn("system_rows", F.col(_rows_in(system_id)))


def is_open():
    """Affiliation without an end date."""
    return F.col("end_date").isNull()


def latest_affiliation(rows: DataFrame) -> DataFrame:
    """Per user the affiliation that started last; the smaller department id breaks a tie."""
    order = [newest_first(F.col("start_date")), "department_id"]
    return first_by(rows, ["user_id"], order)


def labelled_users(directory: Directory, system_id: int) -> DataFrame:
    """One row per username of a system, codes as labels, at its latest affiliation."""
    rows = memberships(directory, system_id).select(
        "username", "first_name", "last_name", "gender", "is_student", "is_astronomy",
        "institution", "country", "start_date", "department_id",
    )
    order = [newest_first(F.col("start_date")), "department_id"]
    one = first_by(rows, ["username"], order)
    return one.select(
        "username",
        L.full_name(F.col("first_name"), F.col("last_name")).alias("name"),
        L.gender_label(F.col("gender")).alias("gender"),
        L.student_label(F.col("is_student")).alias("student"),
        L.astronomy_label(F.col("is_astronomy")).alias("is_astronomy"),
        "institution",
        "country",
        L.nationality_label(F.col("country")).alias("is_australia"),
    )


def projects_with_admin(directory: Directory) -> DataFrame:
    """Projects with the e-mail address of their administrator, ordered by code."""
    admins = directory.users.select(F.col("id").alias("project_administrator"), "email_address")
    return (
        directory.projects.join(admins, "project_administrator")
        .orderBy("code", "id")
        .select(
            L.project_code(F.col("code")).alias("code"),
            L.project_type(F.col("code")).alias("type"),
            "name",
            F.col("email_address").alias("admin_email"),
        )
    )
