"""Library inputs derived from the given tables.  ``twins`` states the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge import fixed_values as V
from tallyforge.functions.period import Period
from tallyforge.operators.attribution import finished_usage
from tallyforge.operators.directory import Directory

PERIOD = Period.of("1997-07-01", "1997-09-30")
DATASET_PERIOD = Period.of("2024-01-01", "2024-01-15")
DATASET_ADMINS = ["0", "1"]
EVENT_ADMINS = ["u3", "u17"]
FIRST_EPOCH = 883612800
# The last token of a log line, by the epoch second of its job's end.
ELIGIBLE = "moment - 7000"
HOUSEHOLD = "IF(c_mktsegment = 'HOUSEHOLD', 1, 0)"

# Declared schemas of the given tables that are read: opening one needs no look at its footer.
GIVEN = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
}


class Views:
    """Lazy views over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def given(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    # Directory

    def institutions(self) -> DataFrame:
        nation, region = self.given("nation"), self.given("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
            "CAST(n_nationkey AS BIGINT) AS id",
            "n_name AS name",
            "CASE WHEN n_regionkey = 0 THEN 'AU' ELSE r_name END AS country",
        )

    def departments(self) -> DataFrame:
        rows = self.given("nation").selectExpr("*", "explode(array(0, 1)) AS k")
        return rows.selectExpr(
            "CAST(n_nationkey * 2 + k AS BIGINT) AS id",
            "CAST(n_nationkey AS BIGINT) AS institution_id",
            "concat_ws('/', n_name, k) AS name",
            "1 - k AS is_astronomy",
        )

    def users(self) -> DataFrame:
        return self.given("customer").selectExpr(
            "c_custkey AS id",
            "c_name AS username",
            "'Customer' AS first_name",
            "substring(c_name, 10) AS last_name",
            "concat(c_name, '@example.org') AS email_address",
            "CAST(c_custkey % 3 AS INT) AS gender",
            f"{HOUSEHOLD} AS is_student",
        )

    def user_systems(self) -> DataFrame:
        return self.given("customer").selectExpr(
            "c_custkey AS user_id",
            """explode(array_compact(array(
                 IF(c_custkey % 2 = 0, 1, NULL), IF(c_custkey % 3 <> 0, 2, NULL)))) AS system_id""",
        )

    def affiliations(self) -> DataFrame:
        return self.given("customer").selectExpr(
            "c_custkey AS user_id",
            """inline(array_compact(array(
                 named_struct(
                   'department_id', c_nationkey * 2 + c_custkey % 2,
                   'start_date', DATE'1995-01-01',
                   'end_date', IF(c_custkey % 5 = 0, DATE'1997-06-30', NULL)),
                 IF(c_custkey % 5 = 0, named_struct(
                   'department_id', CAST((c_nationkey + 7) % 25 * 2 AS BIGINT),
                   'start_date', DATE'1997-07-01', 'end_date', CAST(NULL AS DATE)), NULL),
                 IF(c_custkey % 11 = 0, named_struct(
                   'department_id', CAST((c_nationkey + 3) % 25 * 2 + 1 AS BIGINT),
                   'start_date', DATE'1996-01-01', 'end_date', CAST(NULL AS DATE)), NULL))))""",
        )

    def projects(self) -> DataFrame:
        return self.given("supplier").selectExpr(
            "s_suppkey AS id",
            "concat(IF(s_suppkey % 2 = 0, 'p', 'oz'), s_suppkey) AS code",
            "s_name AS name",
            "s_suppkey AS project_administrator",
            "CAST(1 + s_suppkey % 2 AS INT) AS system_id",
        )

    def project_users(self) -> DataFrame:
        line = self.given("lineitem")
        orders = self.given("orders").select("o_orderkey", "o_custkey")
        pairs = line.join(orders, line.l_orderkey == orders.o_orderkey).selectExpr(
            "l_suppkey AS project_id", "o_custkey AS user_id"
        )
        return pairs.distinct().selectExpr(
            "project_id * 10000000000 + user_id AS id", "project_id", "user_id"
        )

    def directory(self) -> Directory:
        return Directory(lambda table: getattr(self, table)())

    # Usage

    def events(self) -> DataFrame:
        """One event per line item."""
        line = self.given("lineitem")
        orders = self.given("orders").select("o_orderkey", "o_custkey")
        customer = self.given("customer").select("c_custkey", "c_name")
        named = orders.join(customer, orders.o_custkey == customer.c_custkey)
        return line.join(named, line.l_orderkey == named.o_orderkey).selectExpr(
            "l_orderkey",
            "l_linenumber",
            "l_shipdate AS time",
            "IF(l_linestatus = 'F', 'JOBEND', 'JOBSTART') AS type",
            "c_name AS user",
            """CASE WHEN l_suppkey % 7 = 0 THEN 'root'
                 ELSE concat(IF(l_suppkey % 2 = 0, 'p', 'oz'), l_suppkey) END AS account""",
            "CAST(l_quantity AS DECIMAL(18,2)) AS service_units",
        )

    def usage_extract(self) -> DataFrame:
        usage = finished_usage(self.events(), PERIOD)
        sums = usage.groupBy("user", "account").agg(F.sum("units").alias("used"))
        return sums.select(
            F.lit("c1").alias("cluster"),
            F.col("user").alias("login"),
            F.col("user").alias("name"),
            "account",
            F.col("used").cast("decimal(18,6)").alias("used"),
            F.lit(0.0).alias("energy"),
        )

    def log_items(self) -> DataFrame:
        """The line items that log lines are made of, with the epoch second of each."""
        moment = f"{FIRST_EPOCH} + l_orderkey * 120 + l_linenumber AS moment"
        keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        return self.given("lineitem").selectExpr(*keys, "l_linestatus", moment)

    def log_lines(self, items: DataFrame | None = None) -> DataFrame:
        """One 56-token log line per line item, with its key columns; other columns of ``items`` are kept."""
        moment = "moment"
        tokens = {
            "time_and_id": f"""concat({moment}, IF(l_orderkey % 37 = 0, '', ':'),
                l_orderkey, '.', l_linenumber % 4)""",
            "object": "IF(l_orderkey % 29 = 0, 'node', 'job')",
            "job_id": "'-'",
            "type": "IF(l_linestatus = 'F', 'JOBEND', 'JOBSTART')",
            "nodes": "'1'",
            "cpus": "IF(l_orderkey % 31 = 0, 'bad', CAST(l_linenumber AS STRING))",
            "user": "concat('u', l_partkey % 40)",
            "group": "'grp'",
            "reqwall": "'3600'",
            "queue": "IF(l_orderkey % 11 = 0, '-', '[q:1]')",
            "submit_time": f"{moment} - 7200",
            "start_time": f"{moment} - 3600 * l_linenumber - l_partkey % 977",
            "end_time": moment,
            "features": "IF(l_orderkey % 3 = 0, '-', 'feat')",
            "qos": """CASE WHEN l_orderkey % 41 = 0 THEN 'normal' WHEN l_orderkey % 7 = 0 THEN '-:high'
                WHEN l_orderkey % 7 = 1 THEN 'normal:-' ELSE 'normal:high' END""",
            "account": "concat('oz', l_suppkey)",
            "partition": "'part'",
            "memory": "concat(l_orderkey * 1000000, 'M')",
            "rsv": "IF(l_orderkey % 5 = 0, '-', 'rsv1')",
            "eligible_time": ELIGIBLE,
        }
        at = {V.EVENT_TOKENS[name]: f"CAST({sql} AS STRING)" for name, sql in tokens.items()}
        line = ", ".join(at.get(i, "'-'") for i in range(V.EVENT_LINE_TOKENS))
        if items is None:
            # Logs come as many files, the given table as one with a single row group: its few narrow columns
            # are dealt to all cores before they become text.  Without it sf0.1 is parsed by one task, 13.7 s for 3.5.
            items = self.log_items().hint("rebalance")
        others = [c for c in items.columns if c not in ("l_linestatus", "moment")]
        return items.selectExpr(*others, f"concat_ws(' ', {line}) AS value")

    def stored_ids(self) -> DataFrame:
        """IDs of the events an earlier load has stored: those of every third order."""
        line = self.given("lineitem").filter(
            "l_orderkey % 3 = 0 AND l_orderkey % 29 <> 0 AND l_orderkey % 31 <> 0"
        )
        return line.filter("l_linestatus = 'F'").selectExpr(
            "concat(l_orderkey, '.', l_linenumber % 4) AS event_id"
        )

    # Dataset service

    def dataset_jobs(self) -> DataFrame:
        return self.given("events").selectExpr(
            "CAST(user_id AS STRING) AS username",
            """element_at(array('web_multidark_a', 'multidark_b', 'vishnu_bolshoi_x', 'bolshoi_planck',
                 'bolshoi', 'mini_millennium', 'other', ''), CAST(event_id % 8 + 1 AS INT)) AS database""",
            "event_type <> 'error' AS latestjobversion",
            "ts AS insertdate",
            "CAST(floor(value * 1000000) AS BIGINT) AS filesize",
            "CAST(floor(value * 100) AS BIGINT) AS recordscount",
        )

    def site_users(self) -> DataFrame:
        customer, nation = self.given("customer"), self.given("nation")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
            "CAST(c_custkey AS STRING) AS username",
            "CAST(c_custkey % 3 AS INT) AS gender",
            "n_name AS institution",
            "IF(n_regionkey = 0, 'AU', n_name) AS country",
            f"{HOUSEHOLD} AS is_student",
        )

    # Reconciliation

    def legacy_tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Users, institutions and user-institution pairs of the legacy directory."""
        customer = self.given("customer")
        users = customer.selectExpr(
            "c_custkey AS user_id",
            "c_name AS username",
            f"{HOUSEHOLD} AS student",
            "CAST(c_custkey % 3 AS INT) AS gender",
        )
        institutions = self.given("nation").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS institution_id", "n_name AS institution_code"
        )
        pairs = customer.selectExpr(
            "c_custkey AS user_id", "CAST(c_nationkey AS BIGINT) AS institution_id"
        )
        return users, institutions, pairs

    def roster(self) -> DataFrame:
        customer, nation = self.given("customer"), self.given("nation")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
            "IF(c_custkey % 19 = 0, concat('ghost', c_custkey), c_name) AS username",
            """CASE WHEN c_custkey % 13 = 0 THEN 'XXX' WHEN c_custkey % 2 = 0 THEN n_name
                 ELSE concat('N', n_nationkey) END AS institution_code""",
            "'-' AS field_2",
            """CASE WHEN c_custkey % 7 = 0 THEN 'M' WHEN c_custkey % 3 = 2 THEN 'M'
                 WHEN c_custkey % 3 = 1 THEN 'F' ELSE '-' END AS gender""",
            """CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN IF(c_custkey % 17 = 0, 'N', 'Y')
                 ELSE IF(c_custkey % 17 = 0, 'Y', 'N') END AS student""",
        )

    def institution_code_map(self) -> DataFrame:
        return self.given("nation").selectExpr(
            "concat('N', n_nationkey) AS code", "n_name AS mapped_code"
        )

    # Ledger

    def file_listing(self) -> DataFrame:
        return self.given("nation").selectExpr(
            "concat('events_', n_nationkey) AS name", "CAST(n_nationkey * 100 AS BIGINT) AS size"
        )

    def file_ledger(self) -> DataFrame:
        return self.given("nation").filter("n_nationkey % 4 <> 0").selectExpr(
            "concat('events_', n_nationkey) AS name",
            "CAST(n_nationkey * IF(n_nationkey % 3 = 0, 100, 90) AS BIGINT) AS size",
        )
