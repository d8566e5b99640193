"""Declared schemas of every table and file the reports read or write."""

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "SECONDS": T.DecimalType(38, 0),
    "UNITS": T.DecimalType(38, 18),
}


def _struct(columns: str) -> T.StructType:
    """Schema of ``name TYPE, ...``; built without a session, so it can be a module constant."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


EVENT = _struct(
    "event_id STRING, time TIMESTAMP_NTZ, type STRING, nodes BIGINT, cpus BIGINT, user STRING, "
    "group STRING, account STRING, job_id STRING, submit_time TIMESTAMP_NTZ, "
    "start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, eligible_time TIMESTAMP_NTZ, "
    "queue STRING, reqwall BIGINT, features STRING, memory BIGINT, partition STRING, rsv STRING, "
    "qos_requested STRING, qos_delivered STRING, service_units DOUBLE, cpu_seconds SECONDS"
)
STORED_EVENT = T.StructType(EVENT.fields + [T.StructField("event_date", T.DateType())])
LEDGER = _struct("name STRING, size BIGINT")
QUARANTINE = _struct("value STRING, reason STRING")

USERS = _struct(
    "id BIGINT, username STRING, first_name STRING, last_name STRING, email_address STRING, "
    "gender INT, is_student INT"
)
DEPARTMENTS = _struct("id BIGINT, institution_id BIGINT, name STRING, is_astronomy INT")
INSTITUTIONS = _struct("id BIGINT, name STRING, country STRING")
AFFILIATIONS = _struct("user_id BIGINT, department_id BIGINT, start_date DATE, end_date DATE")
USER_SYSTEMS = _struct("user_id BIGINT, system_id INT")
PROJECTS = _struct(
    "id BIGINT, code STRING, name STRING, project_administrator BIGINT, system_id INT"
)
PROJECT_USERS = _struct("id BIGINT, project_id BIGINT, user_id BIGINT")

LEDGER_LOG = _struct("name STRING, size BIGINT, loaded_at TIMESTAMP")

# CPU hours are read as exact decimals so that a distributed sum does not depend on task order.
USAGE_EXTRACT = _struct(
    "cluster STRING, login STRING, name STRING, account STRING, used UNITS, energy DOUBLE"
)

DATASET_JOBS = _struct(
    "username STRING, database STRING, latestjobversion BOOLEAN, insertdate TIMESTAMP_NTZ, "
    "filesize BIGINT, recordscount BIGINT"
)
SITE_USERS = _struct(
    "username STRING, gender INT, institution STRING, country STRING, is_student INT"
)

LEGACY_USERS = _struct("user_id BIGINT, username STRING, student INT, gender INT")
LEGACY_INSTITUTIONS = _struct("institution_id BIGINT, institution_code STRING")
LEGACY_USER_INSTITUTIONS = _struct("user_id BIGINT, institution_id BIGINT")
ROSTER = _struct(
    "username STRING, institution_code STRING, field_2 STRING, gender STRING, student STRING"
)

REPORT = _struct(
    "section_no INT, section STRING, order_key DOUBLE, label STRING, value STRING, "
    "active_value STRING"
)
