"""Star tables in the Spark catalog."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.config import PICKUP
from tripmill.operators.star import Star

log = logging.getLogger(__name__)

# Partition column of the fact; ours, hidden from readers of the table.
PARTITION = "pickup_month"
STAR_TABLES = ("dim_datetime", "dim_fare", "hot_fares", "fact_trips")
LOADED = (*STAR_TABLES, "dim_weather")
# Property of the database that names the tables of the current load.
POINTER = "tripmill.tables"


class Warehouse:
    """Tables of a database. Those of the star belong to loads.

    A load writes tables of its own, ``fact_trips__<load>`` and so on, which never change. One property of
    the database names the current ones and is set by one statement, so readers see the old star or the new
    one and never tables of both. Tables that the property does not name go when the next load begins; until
    then queries on the load before can end. One load may run at a time, next to any number of readers.
    """

    def __init__(self, spark: SparkSession, database: str = "trips", location: str | None = None):
        self.spark = spark
        self.database = database
        self.location = location
        self.new_load()

    def create(self) -> "Warehouse":
        place = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`{place}")
        return self

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def save_dimension(self, df: DataFrame, table: str) -> DataFrame:
        """Replace a table. Spark writes its partitions in parallel, so there are no chunks to choose."""
        df.write.mode("overwrite").format("parquet").saveAsTable(self.name(table))
        return self.table(table)

    def save_fact(self, df: DataFrame, table: str = "fact_trips", compact: bool = False) -> DataFrame:
        """Replace the fact, partitioned by pickup month.

        ``compact`` lets AQE rebalance rows by month before the write: fewer and fuller files, for one more
        shuffle of the fact. A month of any size is split into files of the advisory size.
        """
        placed = df.withColumn(PARTITION, F.trunc(F.col(PICKUP), "month"))
        if compact:
            placed = placed.hint("rebalance", F.col(PARTITION))
        placed.write.mode("overwrite").format("parquet").partitionBy(PARTITION).saveAsTable(self.name(table))
        return self.table(table)

    def new_load(self) -> None:
        """What is saved from here on belongs to a load of its own."""
        self._load = uuid.uuid4().hex[:12]

    def pending(self, table: str) -> str:
        """Name of a star table in the load that is being written."""
        return f"{table}__{self._load}"

    def save(self, df: DataFrame, table: str) -> DataFrame:
        """Store a star table for the load that is being written; ``publish`` makes it the current one."""
        return self.save_dimension(df, self.pending(table))

    def current(self) -> dict[str, str]:
        """Star tables of the current load, with the names they are stored under."""
        if not self.spark.catalog.databaseExists(self.database):
            return {}
        about = self.spark.sql(f"DESCRIBE DATABASE EXTENDED `{self.database}`").collect()
        properties = next((r["info_value"] for r in about if r["info_name"] == "Properties"), "")
        named = re.search(rf"\({re.escape(POINTER)},([^)]*)\)", properties)
        if named:
            return {stored.rsplit("__", 1)[0]: stored for stored in named[1].split(",")}
        # A warehouse from before there were loads.
        return {table: table for table in LOADED if self._stored(table)}

    def begin(self) -> None:
        """Start a load, and forget what older and unpublished loads left behind."""
        self.create()
        self.new_load()
        kept = set(self.current().values())
        stored = [r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN `{self.database}`").collect() if not r["isTemporary"]]
        self.drop([t for t in stored if re.sub("__[0-9a-f]{12}$", "", t) in LOADED and t not in kept])

    def publish(self) -> Star:
        """Replace the current star by the load just written. The weather dimension goes with the old hours."""
        written = {table: self.pending(table) for table in STAR_TABLES if self._stored(self.pending(table))}
        missing = {"dim_datetime", "dim_fare", "fact_trips"} - written.keys()
        if missing:
            raise RuntimeError(f"the load is not complete: {', '.join(sorted(missing))}")
        self._point(written)
        return self.load_star()

    def add(self, table: str, star: dict[str, str]) -> None:
        """Add a written table to the current load, or replace it there. ``star`` is what the table was made
        from; if another load has become current since, the table does not fit and is not added."""
        now = self.current()
        if {t: now.get(t) for t in STAR_TABLES} != {t: star.get(t) for t in STAR_TABLES}:
            raise RuntimeError(f"{table} was made for another load than the current one")
        self._point(now | {table: self.pending(table)})

    def _point(self, tables: dict[str, str]) -> None:
        names = ",".join(tables.values())
        self.spark.sql(f"ALTER DATABASE `{self.database}` SET DBPROPERTIES ('{POINTER}' = '{names}')")
        self.new_load()

    def _stored(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.name(name))

    def _name_now(self, table: str) -> str:
        """The name that a table is stored under. A star table without a current load keeps its own name."""
        return self.current().get(table, table) if table in LOADED else table

    def exists(self, table: str) -> bool:
        return table in self.current() if table in LOADED else self._stored(table)

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(self._name_now(table))).drop(PARTITION)

    def load_star(self, pending: bool = False, tables: dict[str, str] | None = None) -> Star:
        """The stored star, all of it from one load: the current one, the one being written, or the one
        whose ``tables`` are given. The fact keeps its partition column, which lets marts prune months."""
        if pending:
            tables = {table: self.pending(table) for table in STAR_TABLES if self._stored(self.pending(table))}
        elif tables is None:
            tables = self.current()

        def optional(table: str) -> DataFrame | None:
            return self.table(tables[table]) if table in tables else None

        def required(table: str) -> str:
            return tables.get(table, table)

        return Star(
            dim_datetime=self.table(required("dim_datetime")),
            dim_fare=self.table(required("dim_fare")),
            fact_trips=self.spark.table(self.name(required("fact_trips"))),
            hot_fares=optional("hot_fares"),
            dim_weather=optional("dim_weather"),
        )

    def drop(self, tables: Iterable[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def query(self, sql: str, on_error: str = "raise") -> DataFrame:
        """Run SQL with the warehouse as current database and the star tables of the current load, all of
        one load. A temporary view of the session goes before a table of the same name. ``on_error='empty'``
        gives an empty frame for a statement that cannot be analysed."""
        catalog = self.spark.catalog
        before = catalog.currentDatabase()
        catalog.setCurrentDatabase(self.database)
        own = {t.name for t in catalog.listTables() if t.isTemporary}
        views = {t: stored for t, stored in self.current().items() if t != stored and t not in own}
        try:
            # Names are resolved when the statement is analysed, which is before this method returns.
            for table, stored in views.items():
                self.spark.table(self.name(stored)).createOrReplaceTempView(table)
            return self.spark.sql(sql)
        except AnalysisException as error:
            if on_error != "empty":
                raise
            log.warning("query failed, result taken as empty: %s", error)
            return self.spark.createDataFrame([], "struct<>")
        finally:
            for table in views:
                catalog.dropTempView(table)
            catalog.setCurrentDatabase(before)
