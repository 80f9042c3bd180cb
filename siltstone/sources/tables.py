"""Catalog tables in versions, published together; views and logs with comments.

A run writes its tables beside those of earlier runs, each under its name and
the run's id. Publishing points the public names at them: a public name is a
view of one stored table. So readers see whole runs only, and a run that stops
leaves everything as it was.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "run_id"
#: The property of a public view that names its run.
_PROPERTY = "published_run"
_HISTORY = "history"


def new_run_id() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True)
class Store:
    """Parquet tables of one database per layer.

    With ``location`` the tables are external, under ``location/layer/table``;
    without it they live in the warehouse folder of the session.
    """

    spark: SparkSession
    location: str | None = None
    prefix: str = ""

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        """The table as published."""
        return self.spark.table(self.name(layer, table))

    def read_run(self, layer: str, table: str, run_id: str) -> DataFrame:
        """The table as one run wrote it."""
        return self.spark.table(self.name(layer, _stored(table, run_id)))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def published(self, layer: str, table: str) -> str | None:
        """The run a public table shows."""
        if not self.exists(layer, table):
            return None
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").where(F.col("key") == _PROPERTY)
        found = shown.first()
        return found and found["value"]

    def partitions(self, layer: str, table: str, run_id: str) -> list[dict[str, str]]:
        """The partition values of a stored table, from the catalog: no file is opened."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(layer, _stored(table, run_id))}").collect()
        return [dict(part.split("=", 1) for part in row[0].split("/")) for row in listed]

    def run(self, run_id: str | None = None) -> Run:
        """A run; one with the id of an earlier one replaces what that wrote."""
        run_id = run_id or new_run_id()
        if not re.fullmatch(r"[A-Za-z0-9_]+", run_id):
            raise ValueError(f"a run id has letters, digits and _ only, got {run_id!r}")
        return Run(self, run_id.lower())

    def refresh(self, layer: str, table: str, df: DataFrame, comment: str = "", partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace one table as a run of its own, and return it as published."""
        run = self.run()
        run.refresh(layer, table, df, comment, partition_by)
        run.publish()
        return self.read(layer, table)

    def create_view(self, layer: str, view: str, sql: str, comment: str, **properties: str) -> None:
        """Create or replace a view in the catalog, with its comment."""
        self._database(layer)
        given = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(layer, view)} COMMENT {_quoted(comment)} "
            + (f"TBLPROPERTIES ({given}) " if given else "")
            + f"AS {sql}"
        )

    def append(self, layer: str, table: str, df: DataFrame, run_id: str, comment: str = "", keep: bool = True) -> DataFrame:
        """Add a run's rows to a table that outlives runs, and publish it.

        Rows are partitioned by run, and only that partition is overwritten, so a
        run that is repeated replaces its own rows. Without ``keep`` the rows of
        all other runs go.
        """
        self._database(layer)
        stored = _stored(table, _HISTORY)
        if keep and self.exists(layer, stored):
            columns = [c for c in self.read(layer, stored).columns if c != RUN]
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {self.name(layer, stored)} PARTITION ({RUN} = {_quoted(run_id)}) "
                "SELECT * FROM {rows}",
                rows=df.select(*columns),
            )
        else:
            self._save(layer, stored, df.withColumn(RUN, F.lit(run_id)), comment, (RUN,))
        self.create_view(layer, table, f"SELECT * FROM {self.name(layer, stored)}", comment, **{_PROPERTY: run_id})
        return self.read(layer, table)

    def history(self, layer: str, table: str) -> DataFrame | None:
        """All rows of a table that outlives runs, also those not published yet."""
        stored = _stored(table, _HISTORY)
        return self.read(layer, stored) if self.exists(layer, stored) else None

    def _database(self, layer: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}")

    def _save(self, layer: str, stored: str, df: DataFrame, comment: str, partition_by: Sequence[str]) -> DataFrame:
        self._database(layer)
        writer = df.write.format("parquet").mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.location:
            writer = writer.option("path", self._path(layer, stored))
        writer.saveAsTable(self.name(layer, stored))
        if comment:
            self.spark.sql(f"COMMENT ON TABLE {self.name(layer, stored)} IS {_quoted(comment)}")
        return self.read(layer, stored)

    def _path(self, layer: str, stored: str) -> str:
        return f"{self.location.rstrip('/')}/{layer}/{stored}"

    def _drop(self, layer: str, stored: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, stored)}")
        if self.location:  # external tables leave their files
            place = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(layer, stored))
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def _versions(self, layer: str, table: str) -> list[str]:
        found = self.spark.sql(f"SHOW TABLES IN {self.prefix}{layer} LIKE '{table}__*'").collect()
        runs = [row["tableName"].removeprefix(f"{table}__") for row in found]
        return [run for run in runs if run != _HISTORY and "__" not in run]


@dataclass
class Run:
    """Tables written under one run id, published together."""

    store: Store
    run_id: str
    written: dict[tuple[str, str], str] = field(default_factory=dict)

    def refresh(
        self, layer: str, table: str, df: DataFrame, comment: str = "", partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write a table once, beside the published one, and return it as written."""
        self.written[layer, table] = comment
        return self.store._save(layer, _stored(table, self.run_id), df, comment, partition_by)

    def publish(self, last: tuple[str, str] | None = None) -> None:
        """Point the public names at this run; the table ``last`` names goes last.

        The run before stays stored, for readers that began with it; older ones
        and those that never were published are dropped.
        """
        before = {key: self.store.published(*key) for key in self.written}
        for (layer, table), comment in sorted(self.written.items(), key=lambda entry: entry[0] == last):
            name = self.store.name(layer, _stored(table, self.run_id))
            self.store.create_view(layer, table, f"SELECT * FROM {name}", comment, **{_PROPERTY: self.run_id})
        for (layer, table), earlier in before.items():
            for run in self.store._versions(layer, table):
                if run not in (self.run_id, earlier):
                    self.store._drop(layer, _stored(table, run))


def _stored(table: str, run_id: str) -> str:
    return f"{table}__{run_id}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
