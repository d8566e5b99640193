"""Tables of any database with a Python driver (DB-API 2.0), read in parts with filters pushed down.

The driver is imported by the tasks, so it must be installed where they run, and the database must be
reachable from them; a file database must lie in a folder that all of them mount.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import datasource as D
from pyspark.sql import types as T

#: Placeholders of the parameter styles that need no names.
PLACEHOLDERS = {"qmark": "?", "format": "%s", "pyformat": "%s"}
COMPARED = {
    D.EqualTo: "=", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<=",
}


@dataclass
class Range(D.InputPartition):
    """Rows whose partition column is in [low, high); without bounds all, ``or_null`` those without a value too."""

    low: int | None = None
    high: int | None = None
    or_null: bool = False


class DbApiTable(D.DataSource):
    """``spark.read.format("dbapi")`` with a schema and the options of ``DbApiSource``."""

    @classmethod
    def name(cls) -> str:
        return "dbapi"

    def reader(self, schema: T.StructType) -> DbApiReader:
        return DbApiReader(schema, dict(self.options))


class DbApiReader(D.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.options = schema, {k.lower(): v for k, v in options.items()}
        self.conditions: list[str] = []
        self.values: list = []

    # The database

    def _driver(self):
        return importlib.import_module(self.options["driver"])

    def _rows(self, query: str, values: list) -> Iterator[list[tuple]]:
        connection = self._driver().connect(**json.loads(self.options.get("connect", "{}")))
        try:
            cursor = connection.cursor()
            cursor.execute(query, values)
            while rows := cursor.fetchmany(int(self.options.get("fetchsize", "10000"))):
                yield rows
        finally:
            connection.close()

    def _quoted(self, name: str) -> str:
        quote = self.options.get("quote", '"')
        return quote + name.replace(quote, quote * 2) + quote

    # Filters

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for one in filters:
            if not self._push(one):
                yield one

    def _push(self, one: D.Filter) -> bool:
        if isinstance(one, D.Not) and isinstance(one.child, D.IsNull):
            one = D.IsNotNull(one.child.attribute)
        attribute = getattr(one, "attribute", ())
        if len(attribute) != 1 or attribute[0] not in self.schema.names:
            return False
        column, mark = self._quoted(attribute[0]), PLACEHOLDERS[self._driver().paramstyle]
        if isinstance(one, (D.IsNull, D.IsNotNull)):
            self.conditions.append(f"{column} IS {'NOT ' * isinstance(one, D.IsNotNull)}NULL")
            return True
        values = list(one.value) if isinstance(one, D.In) else [getattr(one, "value", None)]
        if not all(isinstance(v, (str, int, float, dt.date)) for v in values):
            return False
        if isinstance(one, D.In):
            self.conditions.append(f"{column} IN ({', '.join([mark] * len(values))})")
        elif type(one) in COMPARED:
            self.conditions.append(f"{column} {COMPARED[type(one)]} {mark}")
        else:
            return False
        self.values += [self._plain(v) for v in values]
        return True

    def _plain(self, value):
        """Moments in the form the database keeps them, text where it has no type for them."""
        if isinstance(value, dt.datetime) and self.options.get("textmoments") == "true":
            return value.replace(tzinfo=None).isoformat(sep=" ")
        if isinstance(value, dt.date) and self.options.get("textmoments") == "true":
            return value.isoformat()
        return value

    # Reading

    def partitions(self) -> list[Range]:
        """Even ranges of the partition column between the bounds that the database gives."""
        column, count = self.options.get("partitioncolumn"), int(self.options.get("numpartitions", "1"))
        if not column or count <= 1:
            return [Range()]
        quoted = self._quoted(column)
        where = f" WHERE {' AND '.join(self.conditions)}" if self.conditions else ""
        ((low, high),) = next(self._rows(f"SELECT min({quoted}), max({quoted}) FROM {self.options['table']}{where}", self.values))
        if low is None:
            return [Range()]
        step = max(1, -(-(high + 1 - low) // count))
        starts = range(low, high + 1, step)
        return [Range(None if s == low else s, None if s + step > high else s + step, s == low) for s in starts]

    def read(self, partition: Range) -> Iterator[tuple]:
        conditions, values = list(self.conditions), list(self.values)
        mark, column = PLACEHOLDERS[self._driver().paramstyle], self._quoted(self.options.get("partitioncolumn", ""))
        bounds = [(sign, bound) for sign, bound in ((">=", partition.low), ("<", partition.high)) if bound is not None]
        inside = " AND ".join(f"{column} {sign} {mark}" for sign, _ in bounds)
        if inside:
            conditions.append(f"({inside} OR {column} IS NULL)" if partition.or_null else f"({inside})")
            values += [bound for _, bound in bounds]
        where = f" WHERE {' AND '.join(conditions)}" if conditions else ""
        names = ", ".join(map(self._quoted, self.schema.names))
        convert = [_from_database(f.dataType) for f in self.schema.fields]
        for rows in self._rows(f"SELECT {names} FROM {self.options['table']}{where}", values):
            for row in rows:
                yield tuple(None if v is None else c(v) for c, v in zip(convert, row))


def _from_database(kind: T.DataType):
    """From what a driver gives for a column to what Spark takes for its declared type."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return lambda v: dt.datetime.fromisoformat(v) if isinstance(v, str) else v
    if isinstance(kind, T.DateType):
        return lambda v: dt.date.fromisoformat(v) if isinstance(v, str) else v
    if isinstance(kind, T.BooleanType):
        return bool
    if isinstance(kind, T.DecimalType):
        import decimal

        return lambda v: decimal.Decimal(str(v))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float
    return lambda v: v
