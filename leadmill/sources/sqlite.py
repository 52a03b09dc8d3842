"""Tables of a SQLite file as a data source, read in ranges of row ids.

``spark.read.format("sqlite")`` with options path, table, partitions. Values come as texts, whole
numbers or floats by the declared type of their column; other declared types come as texts.
"""

from __future__ import annotations

import sqlite3
from contextlib import closing

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _named(table: str) -> str:
    return '"' + table.replace('"', '""') + '"'


def _type(declared: str):
    d = declared.upper()
    return LongType() if "INT" in d else DoubleType() if any(x in d for x in ("REAL", "FLOA", "DOUB")) else StringType()


class _Range(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        super().__init__((low, high))


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, table: str, partitions: int) -> None:
        self.types, self.path, self.table, self.parts = [(f.name, type(f.dataType)) for f in schema.fields], path, table, partitions

    def partitions(self):
        with closing(_connect(self.path)) as c:
            low, high = c.execute(f"SELECT min(rowid), max(rowid) FROM {_named(self.table)}").fetchone()
        if low is None:
            return []
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Range(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition):
        if partition is None:  # an empty table has no ranges
            return
        low, high = partition.value
        columns = ", ".join(_named(n) for n, _ in self.types)
        with closing(_connect(self.path)) as c:
            for row in c.execute(f"SELECT {columns} FROM {_named(self.table)} WHERE rowid >= ? AND rowid < ?", (low, high)):
                yield tuple(self._cast(v, t) for v, (_, t) in zip(row, self.types))

    @staticmethod
    def _cast(value, kind):
        if value is None:
            return None
        try:
            return int(value) if kind is LongType else float(value) if kind is DoubleType else str(value)
        except (TypeError, ValueError):
            return None


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        with closing(_connect(self.options["path"])) as c:
            columns = c.execute(f"PRAGMA table_info({_named(self.options['table'])})").fetchall()
        return StructType([StructField(name, _type(declared or "")) for _, name, declared, *_ in columns])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options["path"], self.options["table"], int(self.options.get("partitions", "8")))


def read(spark, path: str, table: str, partitions: int = 8):
    """A table of the file as a DataFrame."""
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite").option("path", path).option("table", table).option("partitions", str(partitions)).load()
