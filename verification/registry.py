"""Every library query on the views, by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge import schemas
from tallyforge.functions import labels as L
from tallyforge.functions import period as P
from tallyforge.functions.events import epoch_to_timestamp, parse_events, quarantine
from tallyforge.operators import attribution, directory, event_store, filters
from tallyforge.operators.latest import first_by, newest_first
from tallyforge.operators.residual import residual_percent
from tallyforge.plans import (
    collaboration,
    datasets,
    event_path,
    extract_path,
    reconcile,
    report,
    user_counts,
)
from tallyforge.session import shuffles_removed, working_folder
from tallyforge.sources import files, tables
from tallyforge.streaming.ingest import REJECTS, ingest_changed_files, ingest_stream
from verification.views import DATASET_ADMINS, DATASET_PERIOD, ELIGIBLE, EVENT_ADMINS, PERIOD, Views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LOG_FILE_LINES = 500_000

MEN = [("is_astronomy", V.ASTRONOMY), ("gender", V.MALE)]
WOMEN = [("is_astronomy", V.ASTRONOMY), ("gender", V.FEMALE)]
STUDENTS = [("is_astronomy", V.ASTRONOMY), ("is_student", V.STUDENT)]


def query(function):
    """Register a function of the views under its own name."""
    QUERIES[function.__name__] = lambda spark, folder: function(Views(spark, folder))
    return function


# Sources


def write_log_files(v: Views) -> str:
    """The log lines as text files, in one folder per month named in the files' own style."""
    # The month of the last token, which every line has, also those without an event ID.  Items are dealt and
    # sorted while they are a few numbers, and become text where they are written.
    log = F.concat(F.lit("events_"), F.date_format(epoch_to_timestamp(F.expr(ELIGIBLE)), "MMM_yyyy")).alias("log")
    root = working_folder(v.spark, "logs")
    items = v.log_items().select("*", log).repartition("log")
    items = items.sortWithinPartitions("log", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    lines = v.log_lines(items).select("value", "log")
    # Logs are kept compressed, as rotated logs are.  A reader takes such a file whole, so a busy month is several.
    with shuffles_removed(v.spark):
        files_of = lines.write.partitionBy("log").option("maxRecordsPerFile", LOG_FILE_LINES)
        files_of.option("zlib.compress.level", "BEST_SPEED").text(root, compression="gzip")
    return root


@query
def src_event_log(v):
    root = write_log_files(v)
    lines = files.read_event_log(v.spark, f"{root}/log=events*", "Jan", 1998)
    tokens = F.split("value", " ")
    return lines.groupBy(F.get(tokens, F.lit(4)).alias("type")).agg(
        F.count("*").alias("lines"), F.sum(F.length("value")).alias("characters")
    )


@query
def src_usage_extract(v):
    folder = working_folder(v.spark, "extract")
    v.usage_extract().write.option("sep", "|").csv(folder)
    rows = files.read_usage_extract(v.spark, folder)
    return rows.withColumn("used", F.col("used").cast("double"))


@query
def src_roster(v):
    folder = working_folder(v.spark, "roster")
    v.roster().select(F.concat_ws("  ", *v.roster().columns).alias("value")).write.text(folder)
    return files.read_roster(v.spark, folder)


@query
def src_legacy_directory(v):
    return tables.legacy_users(*v.legacy_tables())


# Event parsing and storing


@query
def evt_parse(v):
    parsed = parse_events(v.log_lines())
    return parsed.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *_event_columns(parsed)
    )


def _event_columns(events: DataFrame) -> list:
    decimals = {"cpu_seconds"}
    return [
        F.col(f"`{f}`").cast("double").alias(f) if f in decimals else F.col(f"`{f}`")
        for f in events.columns
        if not f.startswith("l_")
    ]


@query
def evt_service_units(v):
    parsed = parse_events(v.log_lines())
    return parsed.groupBy("user").agg(
        F.count("*").alias("jobs"), attribution.units_sum(parsed).cast("double").alias("units")
    )


@query
def evt_quarantine(v):
    return quarantine(v.log_lines()).select("l_orderkey", "l_linenumber", "l_partkey", "reason")


@query
def flt_drop_admin_usage(v):
    """Events stored before the administrators were named, as a report reads them."""
    table = working_folder(v.spark, "events")
    event_store.append_events(v.spark, table, parse_events(v.log_lines()), ("l_partkey", "l_suppkey"))
    kept = event_store.reported_events(v.spark, table, EVENT_ADMINS)
    return kept.select("event_id", "user", F.col("service_units").cast("double").alias("units"))


@query
def snk_append_new_events(v):
    """What a load adds to a table that holds events, of one day, with the IDs of every third order."""
    table, order = working_folder(v.spark, "events"), ("l_partkey", "l_suppkey")
    columns = {"event_id": F.col("event_id"), "time": F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")}
    columns |= {c: F.lit(0) for c in order}
    stored = [columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.EVENT.fields]
    event_store.append_events(v.spark, table, v.stored_ids().select(*stored, *[columns[c].alias(c) for c in order]), order)
    load = event_store.append_events(v.spark, table, parse_events(v.log_lines()), order)
    return event_store.read_loads(v.spark, table, [load.name]).select(
        "event_id", "user", "account", F.col("service_units").cast("double").alias("units")
    )


@query
def snk_purge_admins(v):
    """A table from which the events of administrators were removed, loaded in two parts."""
    table, order = working_folder(v.spark, "events"), ("l_partkey", "l_suppkey")
    for part in ("l_orderkey % 2 = 0", "true"):
        event_store.append_events(v.spark, table, parse_events(v.log_lines().filter(part)), order)
    event_store.purge_admins(v.spark, table, EVENT_ADMINS)
    stored = event_store.read_stored(v.spark, table)
    return stored.select("event_id", "user", F.col("service_units").cast("double").alias("units"))


@query
def snk_ledger_plan(v):
    return event_store.plan_files(v.file_listing(), v.file_ledger())


@query
def snk_ledger_next(v):
    return event_store.next_ledger(v.file_listing(), v.file_ledger())


@query
def strm_ingest(v):
    """Stream the log files into an event table, twice, and read the table back."""
    root = write_log_files(v)
    table = working_folder(v.spark, "events")
    for _ in range(2):
        checkpoint = working_folder(v.spark, "progress")
        ingest_stream(v.spark, f"{root}/*", table, checkpoint, EVENT_ADMINS).awaitTermination()
    stored = event_store.read_stored(v.spark, table)
    return stored.groupBy("event_date").agg(
        F.count("*").alias("events"),
        F.count_distinct("event_id").alias("event_ids"),
        attribution.units_sum(stored).cast("double").alias("units"),
    )


@query
def strm_rejects(v):
    """The lines two streams over the same files keep as rejected."""
    root = write_log_files(v)
    table, rejects = working_folder(v.spark, "events"), working_folder(v.spark, "rejects")
    for _ in range(2):
        checkpoint = working_folder(v.spark, "progress")
        ingest_stream(v.spark, f"{root}/*", table, checkpoint, EVENT_ADMINS, rejects).awaitTermination()
    kept = v.spark.read.schema(REJECTS).parquet(rejects)
    return kept.groupBy("reason", "value").agg(F.sum("times").alias("times"))


@query
def strm_grown_files(v):
    """Logs loaded by the ledger of their sizes: those of January first, then all that is left."""
    root = write_log_files(v)
    table, ledger = working_folder(v.spark, "events"), working_folder(v.spark, "ledger")
    for glob in (f"{root}/log=events_Jan_*/*", f"{root}/*/*"):
        ingest_changed_files(v.spark, glob, table, ledger, EVENT_ADMINS)
    stored = event_store.read_stored(v.spark, table)
    return stored.select("event_id", "user", F.col("service_units").cast("double").alias("units"))


@query
def src_usage_extract_rejects(v):
    """Lines of the extract cut short, or with an amount that is no number."""
    folder = working_folder(v.spark, "extract")
    rows = v.usage_extract().withColumn("used", F.when(F.col("account").like("p%2"), F.lit("n/a")).otherwise(F.col("used").cast("string")))
    line = F.when(F.col("account").like("oz%3"), F.concat_ws("|", "cluster", "login", "name", "account"))
    rows.select(line.otherwise(F.concat_ws("|", *rows.columns)).alias("value")).write.text(folder)
    return files.usage_extract_rejects(v.spark, folder).select("login", "account")


# Dimensions, filters, joins


@query
def dim_user_labels(v):
    return directory.labelled_users(v.directory(), V.EVENT_SYSTEM)


@query
def dim_projects(v):
    return directory.projects_with_admin(v.directory())


@query
def dim_latest_affiliation(v):
    rows = directory.memberships(v.directory(), V.EXTRACT_SYSTEM).filter(directory.is_open())
    latest = directory.latest_affiliation(rows)
    return latest.select("user_id", "username", "department_id", "institution", "start_date")


@query
def agg_one_per_user(v):
    rows = directory.memberships(v.directory(), V.EVENT_SYSTEM).select(
        "username", "department_id", "start_date", "end_date"
    )
    return first_by(rows, ["username"], [newest_first(F.col("start_date")), "department_id"])


@query
def per_fiscal_quarter(v):
    day = F.to_date("o_orderdate")
    days = v.given("orders").groupBy(day.alias("day")).agg(F.count("*").alias("orders"))
    return days.groupBy(
        P.fiscal_quarter_of(F.col("day")).cast("bigint").alias("fiscal_quarter"),
        P.quarter_start_of(F.col("day")).alias("first_day"),
        P.quarter_end_of(F.col("day")).alias("last_day"),
        P.display_date(P.quarter_start_of(F.col("day"))).alias("first_day_text"),
    ).agg(F.sum("orders").alias("orders"))


@query
def flt_dynamic_conjunction(v):
    rows = user_counts.open_affiliations(v.directory())
    wanted = {
        "all": [],
        "male": MEN,
        "female": WOMEN,
        "student": STUDENTS,
        "department": [("department_id", V.HOME_DEPARTMENT_ID)],
    }
    counts = rows.agg(*[F.count_if(filters.all_of(f)).alias(n) for n, f in wanted.items()])
    return counts.unpivot([], list(wanted), "predicate", "users")


@query
def flt_discard_accounts(v):
    kept = filters.discard_accounts(v.usage_extract())
    return kept.select("login", "account", F.col("used").cast("double").alias("used"))


@query
def jn_directory(v):
    return directory.memberships(v.directory(), V.EVENT_SYSTEM).select(
        "user_id", "username", "department_id", "department", "institution", "country",
        "start_date", "end_date",
    )


@query
def jn_interval_affiliation(v):
    dated = directory.memberships(v.directory()).select(
        "username", "department_id", "institution", "start_date", "end_date"
    )
    joined = attribution.affiliation_at_event(filters.finished_in(v.events(), PERIOD), dated)
    return joined.select(
        "l_orderkey", "l_linenumber", "user", "department_id", "institution",
        F.col("service_units").cast("double").alias("units"),
    )


@query
def jn_semi_active(v):
    active = user_counts.active_usernames(v.events(), PERIOD)
    rows = user_counts.open_affiliations(v.directory())
    return rows.join(active, "username", "left_semi").select("user_id", "username", "department_id")


@query
def jn_anti_excluded(v):
    listed = v.spark.createDataFrame([(a,) for a in DATASET_ADMINS], "username string")
    kept = filters.excluding(v.dataset_jobs(), "username", listed)
    return kept.select("username", "database", "filesize", "recordscount")


@query
def win_residual_percent(v):
    """The residual rule over countries, of which there are more than two."""
    shares = event_path.percent_by_institution(_daily(v), v.directory())
    countries = v.institutions().select(F.col("name").alias("institution"), "country")
    share = F.col("percentage").cast("decimal(18,2)")
    groups = (
        shares.join(countries, "institution")
        .groupBy(F.lit("country").alias("criterion"), F.col("country").alias("grp"))
        .agg(
            F.sum(share).alias("share"),
            F.min(F.struct((-share).alias("share"), "institution")).alias("first_seen"),
        )
    )
    return residual_percent(groups).select(
        "criterion",
        F.col("position").cast("bigint").alias("position"),
        "grp",
        F.col("share").cast("double").alias("share"),
        "residual_pct",
    )


# Event path


def _daily(v: Views) -> DataFrame:
    return attribution.daily_usage(v.events(), PERIOD)


def _finished(v: Views) -> DataFrame:
    return attribution.finished_usage(v.events(), PERIOD)


@query
def use_total(v):
    return event_path.total_usage(_finished(v))


@query
def use_by_account(v):
    return event_path.usage_by_account(_finished(v))


@query
def use_by_account_text(v):
    return event_path.usage_by_account_text(event_path.usage_by_account(_finished(v)))


@query
def use_by_user(v):
    sums = event_path.usage_by_user(_finished(v))
    return sums.withColumn("units", F.col("units").cast("double"))


@query
def use_pct_by_project(v):
    return event_path.percent_by_project(_finished(v), v.directory())


@query
def use_pct_by_institution(v):
    return event_path.percent_by_institution(_daily(v), v.directory())


@query
def use_pct_by_institution_stored(v):
    """Over a stored table, of which only the dates of the period are opened."""
    table = working_folder(v.spark, "events")
    stored = v.events().withColumn("event_date", F.to_date("time"))
    stored.repartition("event_date").write.partitionBy("event_date").parquet(table)
    return event_path.percent_by_institution(attribution.daily_usage(v.spark.read.parquet(table), PERIOD), v.directory())


@query
def use_pct_national_users(v):
    return event_path.percent_by_national_user(_daily(v), v.directory())


@query
def use_pct_national_users_text(v):
    shares = event_path.percent_by_national_user(_daily(v), v.directory())
    return event_path.percent_by_national_user_text(shares)


@query
def use_pct_by_person(v):
    return event_path.percent_by_person(_daily(v), v.directory())


@query
def use_pct_by_demographic(v):
    persons = event_path.percent_by_person(_daily(v), v.directory())
    return event_path.percent_by_demographic(persons).drop("criterion_no")


@query
def collab_by_project(v):
    return collaboration.by_project(v.directory())


@query
def collab_summary(v):
    return collaboration.summary(collaboration.by_project(v.directory()))


# User counts


@query
def cnt_users(v):
    return user_counts.users_count(v.directory(), MEN)


@query
def cnt_active_users(v):
    return user_counts.active_users_count(v.directory(), v.events(), PERIOD, MEN)


@query
def cnt_department_users(v):
    return user_counts.department_users_count(v.directory())


@query
def cnt_department_active(v):
    return user_counts.department_active_count(v.directory(), v.events(), PERIOD)


@query
def cnt_astronomers_by_department(v):
    return user_counts.astronomers_by_department(v.directory())


@query
def rpt_account_holders(v):
    return user_counts.account_holders(v.directory(), v.events(), PERIOD)


# Extract path


def _charged(v: Views) -> DataFrame:
    return extract_path.charged_usage(v.usage_extract())


@query
def ext_total(v):
    return extract_path.total_usage(_charged(v))


@query
def ext_pct_by_project(v):
    return extract_path.percent_by_project(_charged(v), v.directory())


@query
def ext_pct_by_institution(v):
    return extract_path.percent_by_institution(_charged(v), v.directory())


@query
def ext_pct_by_demographic(v):
    return extract_path.percent_by_demographic(_charged(v), v.directory()).drop("criterion_no")


@query
def ext_active_users(v):
    return extract_path.active_users_count(_charged(v), v.directory(), WOMEN)


@query
def ext_department_active(v):
    return extract_path.department_active_count(_charged(v), v.directory())


@query
def ext_users(v):
    return extract_path.users_count(v.directory(), STUDENTS)


@query
def ext_department_users(v):
    return extract_path.department_users_count(v.directory())


@query
def ext_astronomers_by_institution(v):
    return extract_path.astronomers_by_institution(v.directory())


@query
def ext_account_holders(v):
    return extract_path.account_holders(_charged(v), v.directory())


# Dataset path


def _counted(v: Views) -> DataFrame:
    return datasets.counted_jobs(v.dataset_jobs(), DATASET_PERIOD, DATASET_ADMINS)


@query
def ds_jobs(v):
    return datasets.jobs_count(_counted(v))


@query
def ds_registered_users(v):
    return datasets.registered_users_count(v.site_users(), DATASET_ADMINS)


@query
def ds_active_users(v):
    return datasets.active_users_count(_counted(v))


@query
def ds_data_size(v):
    return datasets.data_returned(_counted(v))


@query
def ds_jobs_by_family(v):
    return datasets.jobs_by_family(_counted(v))


@query
def ds_active_user_profiles(v):
    """A quarter of the users have no profile on the other source."""
    known = v.site_users().filter("CAST(username AS BIGINT) % 4 <> 0")
    return datasets.active_user_profiles(_counted(v), known)


# Reconciliation


def _matches(v: Views) -> DataFrame:
    known = tables.legacy_users(*v.legacy_tables())
    return reconcile.user_matches(v.roster(), known, v.institution_code_map())


@query
def rec_user_matches(v):
    return _matches(v)


@query
def rec_summary(v):
    return reconcile.summary(_matches(v))


# Reports


@query
def rpt_event_path(v):
    return report.event_report(v.events(), v.directory(), PERIOD)


@query
def rpt_extract_path(v):
    return report.extract_report(v.usage_extract(), v.directory())


@query
def rpt_dataset_section(v):
    parts = report.dataset_sections(
        6, _counted(v), v.site_users(), DATASET_ADMINS, DATASET_PERIOD
    )
    return report.report_rows(parts)


@query
def rpt_fixed_width(v):
    rows = report.event_report(v.events(), v.directory(), PERIOD)
    return report.report_text(rows).select("section_no", "label", "line")


def _service(v: Views) -> report.DatasetService:
    return report.DatasetService(v.dataset_jobs(), v.site_users(), DATASET_ADMINS, DATASET_PERIOD)


def _event_full(v: Views) -> DataFrame:
    return report.event_report(v.events(), v.directory(), PERIOD, "FRANCE", "FRANCE", _service(v))


def _extract_full(v: Views) -> DataFrame:
    return report.extract_report(
        v.usage_extract(), v.directory(), "FRANCE", other_than="FRANCE", service=_service(v)
    )


@query
def rpt_event_full(v):
    return _event_full(v)


@query
def rpt_extract_full(v):
    return _extract_full(v)


@query
def rpt_event_full_text(v):
    return report.report_text(_event_full(v)).select("section_no", "label", "line")


@query
def rpt_extract_full_text(v):
    return report.report_text(_extract_full(v)).select("section_no", "label", "line")
