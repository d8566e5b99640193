"""Relational tables, from Parquet folders, over JDBC or a Python driver, behind one loader."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge import schemas
from tallyforge.sources.relational import DbApiTable


@dataclass(frozen=True)
class ParquetSource:
    """Tables as Parquet folders or files under one root."""

    root: str
    suffix: str = ""

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root.rstrip('/')}/{name}{self.suffix}")


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database.

    ``partitions`` maps a table to (column, number of readers).  The bounds are asked from the
    database, one row, so that each executor reads one range; other tables use one connection.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    partitions: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    fetch_size: int = 10_000

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        reader = (
            spark.read.format("jdbc")
            .option("url", self.url)
            .option("fetchsize", self.fetch_size)
            .options(**self.properties)
        )
        if name not in self.partitions:
            return reader.option("dbtable", name).load()
        column, readers = self.partitions[name]
        bounds = f"SELECT min({column}) AS low, max({column}) AS high FROM {name}"
        low, high = reader.option("query", bounds).load().first()
        reader = (
            spark.read.format("jdbc")
            .option("url", self.url)
            .option("fetchsize", self.fetch_size)
            .options(**self.properties)
            .option("dbtable", name)
        )
        if low is None:
            return reader.load()
        return (
            reader.option("partitionColumn", column)
            .option("lowerBound", str(low))
            .option("upperBound", str(high))
            .option("numPartitions", readers)
            .load()
        )


@dataclass(frozen=True)
class DbApiSource:
    """Tables of a database by its Python driver; ``partitions`` as for ``JdbcSource``, over whole numbers.

    ``schemas`` declares the columns of each table.  ``text_moments`` is for databases that keep dates
    and times as text.  Filters on single columns are part of the query sent to the database.
    """

    driver: str
    connect: Mapping[str, object]
    schemas: Mapping[str, T.StructType]
    partitions: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    fetch_size: int = 10_000
    text_moments: bool = False
    quote: str = '"'

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        spark.dataSource.register(DbApiTable)
        # A setting of the session, off by default.
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        options = {
            "driver": self.driver, "connect": json.dumps(dict(self.connect)), "table": self.quote + name + self.quote,
            "fetchsize": str(self.fetch_size), "quote": self.quote, "textmoments": str(self.text_moments).lower(),
        }
        if name in self.partitions:
            column, readers = self.partitions[name]
            options |= {"partitioncolumn": column, "numpartitions": str(readers)}
        return spark.read.format("dbapi").schema(self.schemas[name]).options(**options).load()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns, in order and in the declared types; others are pruned."""
    return df.select(*[F.col(f"`{c.name}`").cast(c.dataType).alias(c.name) for c in schema.fields])


def load_table(
    spark: SparkSession,
    name: str,
    source: ParquetSource | JdbcSource | DbApiSource,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One table of a source, in its declared schema when one is given."""
    table = source.read(spark, name)
    return table if schema is None else conform(table, schema)


def load_events(
    spark: SparkSession,
    source: ParquetSource | JdbcSource | DbApiSource,
    name: str = "job_event",
    id_column: str = "ID",
) -> DataFrame:
    """A relational table of finished jobs in the columns of the event table.

    CPU seconds are whole, so they are found again from hours that were stored as doubles.  A fact
    table behind a database is refused unless its reading is divided among executors.
    """
    if not isinstance(source, ParquetSource) and name not in source.partitions:
        raise ValueError(f"name a partition column for {name}: one connection would read all of it")
    table = source.read(spark, name).withColumnRenamed(id_column, "event_id")
    if "cpu_seconds" not in table.columns:
        table = table.withColumn("cpu_seconds", F.round(F.col("service_units") * 3600).cast("decimal(38,0)"))
    return conform(table, schemas.EVENT)


def legacy_users(users: DataFrame, institutions: DataFrame, user_institutions: DataFrame) -> DataFrame:
    """Legacy directory rows: one per user and institution."""
    return (
        user_institutions.join(users, "user_id")
        .join(institutions, "institution_id")
        .select("username", "institution_id", "institution_code", "student", "gender")
    )


def load_legacy_users(spark: SparkSession, source: ParquetSource | JdbcSource | DbApiSource) -> DataFrame:
    return legacy_users(
        load_table(spark, "user", source, schemas.LEGACY_USERS),
        load_table(spark, "institution", source, schemas.LEGACY_INSTITUTIONS),
        load_table(spark, "user_institutions", source, schemas.LEGACY_USER_INSTITUTIONS),
    )
