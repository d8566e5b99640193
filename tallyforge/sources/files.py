"""Text inputs: event logs, the usage extract and the roster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge import schemas
from tallyforge.functions.labels import strip, words


def log_glob(path_glob: str, month: str | None = None, year: int | str | None = None) -> str:
    """Narrow a log glob to the month and year written in the file names."""
    if month is None and year is None:
        return path_glob
    return f"{path_glob}{month or ''}*{year or ''}*"


def with_position(lines: DataFrame) -> DataFrame:
    """Add ``file`` and a position: block start in the file, then row order within the block.

    The row counter grows in reading order inside one task, so together the three order every
    line as it stands in its file, however Spark packs files and blocks into tasks.
    """
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_event_log(
    spark: SparkSession,
    path_glob: str | list[str],
    month: str | None = None,
    year: int | str | None = None,
) -> DataFrame:
    """Non-blank log lines with the file and position of each."""
    if isinstance(path_glob, str):
        path_glob = log_glob(path_glob, month, year)
    lines = with_position(spark.read.text(path_glob))
    return lines.withColumn("value", strip(F.col("value"))).filter(F.length("value") > 0)


def list_files(spark: SparkSession, path_glob: str) -> DataFrame:
    """Name and size of every file of a glob; the file contents are not read."""
    listing = spark.read.format("binaryFile").load(path_glob)
    return listing.select(F.col("path").alias("name"), F.col("length").alias("size"))


def _extract_rows(spark: SparkSession, path: str, mode: str) -> DataFrame:
    broken = T.StructField("_broken", T.StringType())
    return (
        spark.read.schema(T.StructType([*schemas.USAGE_EXTRACT.fields, broken]))
        .option("sep", "|")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", "_broken")
        .csv(path)
    )


def _unreadable(rows: DataFrame) -> Column:
    return F.col("_broken").isNotNull() | F.col("used").isNull()


def read_usage_extract(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Pipe-separated, headerless usage extract: one row per user and account.

    A line that is too short or long, or whose usage cannot be read, fails the read; no usage is
    lost in silence.  With ``strict=False`` such lines are left out: ``usage_extract_rejects`` has
    them.
    """
    rows = _extract_rows(spark, path, "PERMISSIVE")
    if strict:
        told = F.concat(F.lit("unreadable line of the usage extract: "), F.coalesce("_broken", "login", F.lit("")))
        used = F.when(_unreadable(rows), F.raise_error(told).cast("decimal(38,18)")).otherwise(F.col("used"))
        rows = rows.withColumn("used", used)
    else:
        rows = rows.where(~_unreadable(rows))
    return rows.drop("_broken")


def usage_extract_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_usage_extract`` cannot read: login and account as far as read, and the line."""
    rows = _extract_rows(spark, path, "PERMISSIVE")
    return rows.where(_unreadable(rows)).select("login", "account", F.col("_broken").alias("value"))


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """White-space separated roster, five fields; blank lines are skipped."""
    fields = spark.read.text(path).select(F.explode(F.array(words(F.col("value")))).alias("f"))
    return fields.filter(F.get("f", F.lit(0)) != "").select(
        *[F.get("f", F.lit(i)).alias(c.name) for i, c in enumerate(schemas.ROSTER.fields)]
    )
