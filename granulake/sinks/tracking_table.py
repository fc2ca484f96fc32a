"""Tracked files as a catalog table of row states, of which the latest counts."""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granulake.schemas import TRACKING_SCHEMA
from granulake.session import working_path

_COLUMNS = [f for f in TRACKING_SCHEMA if f.name != "project"]
_KEY = ["project", "path"]
_STATE = ["data", "inqueue"]
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


class TrackingStore:
    """The rows that projects track, under one root folder.

    The table is partitioned by project and load. A write is one load: it fills a
    partition of its own by dynamic partition overwrite, so any number of jobs may
    write at once and a task tried again adds nothing. An update adds states of rows,
    by project and path, and costs no more than its own size. Reading is one grouped
    maximum: of each row the state stored last. `fold` puts a project's loads into one.
    """

    def __init__(self, spark: SparkSession, root: str, project: str):
        self.spark = spark
        self.project = project
        self.root = root.rstrip("/")
        self.table = f"tracking_{hashlib.md5(self.root.encode()).hexdigest()[:16]}"
        self._stored = 0
        if not spark.catalog.tableExists(self.table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _COLUMNS)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, stored BIGINT, project STRING, load STRING) "
                f"USING parquet PARTITIONED BY (project, load) LOCATION '{self.root.replace("'", "\\'")}'"
            )
            if spark.conf.get("spark.sql.catalogImplementation") == "hive":
                spark.catalog.recoverPartitions(self.table)

    def _rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _own(self) -> DataFrame:
        return self._rows().filter(F.col("project") == self.project)

    def _write(self, rows: DataFrame, stored: Column | None = None) -> None:
        # later writes of one process are later, whatever the clock does
        self._stored = max(self._stored + 1, time.time_ns() // 1000)
        load = f"{self._stored}-{uuid.uuid4().hex[:8]}"
        given = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in _COLUMNS
        ]
        stored = F.lit(self._stored) if stored is None else stored
        whole = rows.select(*given, stored.alias("stored"), "project", F.lit(load).alias("load"))
        # rows may come from this table, so they are finished before it changes
        path = working_path(self.spark, "tracking")
        whole.write.parquet(path)
        finished = self.spark.read.schema(whole.schema).parquet(path)
        # only the partitions of this load; a write option does not reach tables of the catalog
        before = self.spark.conf.get(_OVERWRITE)
        self.spark.conf.set(_OVERWRITE, "dynamic")
        try:
            finished.write.insertInto(self.table, overwrite=True)
        finally:
            self.spark.conf.set(_OVERWRITE, before)

    @staticmethod
    def _latest(rows: DataFrame, *more: str) -> DataFrame:
        """One row per project and path, with its latest state."""
        last = F.max_by(F.struct(*_STATE), F.struct("stored", *_STATE)).alias("last")
        fixed = [F.max(name).alias(name) for name in ("filename", "mtime", "file_type")]
        found = rows.groupBy(*_KEY).agg(last, *fixed, F.max("stored").alias("stored"))
        # a state of a row that was never added is none
        found = found.filter(F.col("filename").isNotNull()).select(*_KEY, "filename", "mtime", "file_type", "last.*", "stored")
        return found.select(*TRACKING_SCHEMA.names, *more)

    def read(self) -> DataFrame:
        """The project's rows as they are now."""
        return self._latest(self._own())

    def whole(self) -> DataFrame:
        """The rows of all projects."""
        return self._latest(self._rows())

    def files(self) -> DataFrame:
        """`project, filename, path` of the project's rows, which no update changes."""
        added = self._own().filter(F.col("filename").isNotNull())
        return added.select("project", "filename", "path")

    def append(self, rows: DataFrame) -> None:
        self._write(rows)

    def update(self, rows: DataFrame) -> None:
        """Give the rows of a project and path new `data, inqueue`."""
        self._write(rows)

    def loads(self) -> list[str]:
        """Names of the project's loads that hold rows, oldest first."""
        return sorted(r.load for r in self._own().select("load").distinct().collect())

    def fold(self) -> None:
        """Put the loads there are into one, and empty them.

        Merged rows keep the time their state was stored, so a state stored
        meanwhile stays the later one, and loads that came meanwhile are left alone. Stopped half-way,
        rows are there twice with equal states, which reads as once.
        """
        loads = self.loads()
        if len(loads) < 2:
            return
        merged = self._latest(self._own().filter(F.col("load").isin(loads)), "stored")
        self._write(merged, F.col("stored"))
        values = ", ".join(f"`{f.name}`" for f in _COLUMNS)
        project = self.project.replace("'", "\\'")
        for load in loads:
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {self.table} PARTITION (project = '{project}', load = '{load}') "
                f"SELECT {values}, stored FROM {{none}}",
                none=self.spark.createDataFrame([], merged.schema),
            )
