"""Write, audit, publish: tables are loaded aside, checked there, and take the place of the old ones only then."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..schemas import Table
from ..session import remove
from . import tables as sink

#: Property of a published table: where its rows were before, for readers that are still at it.
PREVIOUS = "tidemark.previous"


def location_of(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def _database_location(spark: SparkSession, database: str) -> str:
    return spark.sql(f"DESCRIBE DATABASE `{database}`").filter("info_name = 'Location'").first()["info_value"].rstrip("/")


class Candidates:
    """New contents of declared tables of a database, in a database of their own until they are published.

    When replacing (``truncate``), the new rows are all there is, and publishing points the table at them: no
    row moves, and a reader has the old rows or the new ones. When appending, the candidate is a view of the
    old rows with the new ones, and publishing inserts the new ones.
    The tables are published one after the other; each switch is a change of the catalog alone.
    """

    def __init__(self, spark: SparkSession, tables: Iterable[Table], database: str, truncate: bool):
        self.spark, self.tables, self.target, self.truncate = spark, list(tables), database, truncate
        sink.create_tables(spark, self.tables, database)
        run = uuid.uuid4().hex
        self.root = f"{_database_location(spark, database)}/_published/{run}"
        self.database = f"{database}_candidate_{run[:12]}"
        spark.sql(f"CREATE DATABASE `{self.database}` LOCATION '{self.root}/_catalog'")
        for table in self.tables:
            spark.sql(f"CREATE TABLE `{self.database}`.`{self._new(table).name}` ({table.ddl}) {sink.STORED} "
                      f"LOCATION '{self.root}/{table.name}'")
            if not truncate:
                columns = ", ".join(f"`{n}`" for n in table.names)
                spark.sql(f"CREATE VIEW `{self.database}`.`{table.name}` AS "
                          f"SELECT {columns} FROM `{database}`.`{table.name}` UNION ALL "
                          f"SELECT {columns} FROM `{self.database}`.`{self._new(table).name}`")

    def _new(self, table: Table) -> Table:
        return table if self.truncate else replace(table, name=f"{table.name}__new")

    def load(self, df: DataFrame, table: Table) -> DataFrame:
        """Load a table's candidate; returns the table as it would be published."""
        sink.load_table(df, self._new(table), self.database)
        return self.spark.table(f"`{self.database}`.`{table.name}`")

    def redirected(self, query: str) -> str:
        """A check's query with the names that the target database qualifies, or ``{db}``, read from the candidates."""
        query = query.replace("`{db}`", "{db}").replace("{db}", f"`{self.database}`")
        return re.sub(rf"(?<![\w`.])`?{re.escape(self.target)}`?\s*\.\s*(?=[\w`])", f"`{self.database}`.", query)

    def publish(self) -> None:
        for table in self.tables:
            name = f"`{self.target}`.`{table.name}`"
            if not self.truncate:
                self.spark.table(f"`{self.database}`.`{self._new(table).name}`").write.insertInto(name)
                continue
            before = location_of(self.spark, name)
            properties = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{self.root}/{table.name}'")
            self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{before}')")
            if PREVIOUS in properties:
                remove(self.spark, properties[PREVIOUS])
        self._drop(keep_rows=self.truncate)

    def discard(self) -> None:
        """Forget the candidates; the target's tables are as they were."""
        self._drop(keep_rows=False)

    def _drop(self, keep_rows: bool) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
        if not keep_rows:
            remove(self.spark, self.root)
