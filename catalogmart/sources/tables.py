"""Written tables: shared working folder, kept results, guarded replacement."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalogmart.functions.public_text import multiset_digest
from catalogmart.sources.versions import Versions


#: Names of watched aggregates that are scalars begin so; the others count rows.
SCALAR = "kpi "


class EmptyLoadError(RuntimeError):
    """A load produced no rows; the target was left as it was."""


class IncompleteLoadError(RuntimeError):
    """A load misses rows it must have; the target was left as it was."""


_PRIVATE: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A private folder, one per application, stands in only in local mode, where
    driver and executors are one process.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if context.master.startswith("local"):
        if context.applicationId not in _PRIVATE:
            _PRIVATE[context.applicationId] = tempfile.mkdtemp(prefix="catalogmart-")
        return _PRIVATE[context.applicationId]
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def deleted_on_exit(spark: SparkSession, folder: str) -> None:
    """Make the folder, to be deleted when the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)


class KeptTables:
    """Results that several plans read, written once as Parquet.

    A written table survives lost executors, cuts the lineage, and tells the
    planner its true size: joins against it broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffle beyond. The tables go
    when the application ends, or with ``discard``.

    ``watched`` names aggregates per relation, which are taken along while it is
    written and then stand in ``observed``, or in ``scalars`` if they count no
    rows: neither needs a scan of its own. Aggregates of distinct values cannot
    be taken along.
    """

    def __init__(self, spark: SparkSession, watched: Mapping[str, Mapping[str, Column]] | None = None):
        self.spark = spark
        self.watched = watched or {}
        self.observed: dict[str, dict[str, int]] = {}
        self.scalars: dict[str, dict] = {}
        self.folder = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
        deleted_on_exit(spark, self.folder)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        self._watching(name, lambda tap: tap(df).write.mode("error").parquet(path))
        return self.spark.read.schema(df.schema).parquet(path)

    def _watching(self, name: str, write: Callable):
        """write(tap), in which tap takes the relation's aggregates along; it must be the last step before the rows are
        written, since Spark counts a task of that stage once even if it runs again, but not one of an earlier stage."""
        metrics = self.watched.get(name)
        if not metrics:
            return write(lambda rows: rows)
        seen = Observation()
        result = write(lambda rows: rows.observe(seen, *[metric.alias(key) for key, metric in metrics.items()]))
        taken = seen.get
        self.observed[name] = {key: n for key, n in taken.items() if not key.startswith(SCALAR)}
        self.scalars[name] = {key: value for key, value in taken.items() if key.startswith(SCALAR)}
        return result

    def keep_listed(self, name: str, df: DataFrame, position: str) -> DataFrame:
        """A small ordered list, written to one file in its order; ``position`` is the place a row really has there."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.coalesce(1).write.mode("error").parquet(path)
        rows = self.spark.read.schema(df.schema).parquet(path)
        return rows.select("*", (F.col("_metadata.row_index") + 1).cast("int").alias(position))

    def layer(self, name: str, df: DataFrame) -> DataFrame:
        """A relation of the curated or analytics layer; read where it is needed, not kept."""
        return df

    def discard(self) -> None:
        """Delete everything kept here; results that read it stop working."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Buckets(NamedTuple):
    """Rows hashed by a column into a fixed number of files, for joins without a shuffle."""

    column: str
    count: int


class LayerTables(KeptTables):
    """Writes the named relations as tables of their layer's database.

    ``databases`` maps relation names to databases, ``buckets`` those that are
    joined again and again to their bucketing. Each relation is written once;
    whatever reads it afterwards reads the table.
    """

    def __init__(
        self,
        spark: SparkSession,
        databases: Mapping[str, str],
        folder: str,
        buckets: Mapping[str, Buckets] | None = None,
        watched: Mapping[str, Mapping[str, Column]] | None = None,
    ):
        super().__init__(spark, watched)
        self.databases = databases
        self.buckets = buckets or {}
        self.tables_folder = folder.rstrip("/")
        for database in sorted(set(databases.values())):
            ensure_database(spark, database, self.tables_folder)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        return self.layer(name, df) if name in self.databases else super().keep(name, df)

    def layer(self, name: str, df: DataFrame) -> DataFrame:
        database = self.databases[name]
        folder = f"{self.tables_folder}/{database}/{name}"
        target = Replacement(self.spark, f"{database}.{name}", folder, self.buckets.get(name))
        return self._watching(name, lambda tap: target.publish(df, allow_empty=True, tap=tap))


def ensure_database(spark: SparkSession, database: str, folder: str) -> None:
    """A database whose own location is in the given folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder.rstrip('/')}/{database}'")


class Replacement:
    """A load that replaces all rows of an external Parquet table, or leaves it untouched.

    It begins on the version that is live then. ``publish`` writes the new rows to
    a folder of their own, checks them, and commits them as the next version; if
    another load has done so since, it raises ConcurrentLoadError and leaves the
    table to that load. Readers see either the old or the new rows, and go on
    reading the version they began with. A table's columns and bucketing stay as
    first created. ``Versions.expire`` removes old versions. With
    ``skip_unchanged`` a load that brings the rows the table already has, in any
    order, makes no new version; both are read once more for that. ``tap`` is put
    on the rows right before they are written, as an observation is.
    """

    def __init__(self, spark: SparkSession, table: str, folder: str, buckets: Buckets | None = None):
        self.spark, self.table, self.buckets = spark, table, buckets
        self.versions = Versions(spark, folder)
        self.began_on = self.versions.latest().number

    def publish(
        self, df: DataFrame, allow_empty: bool = False, skip_unchanged: bool = False, tap: Callable = lambda rows: rows
    ) -> DataFrame:
        exists = self.spark.catalog.tableExists(self.table)
        if exists:
            df = self._as_target(df)
        slot = self.versions.new_slot()
        try:
            _write_slot(df, self.table, slot, self.buckets, tap)
            if not allow_empty and self.spark.read.schema(df.schema).parquet(slot).isEmpty():
                raise EmptyLoadError(f"load of {self.table} has no rows; the table was left unchanged")
            if skip_unchanged and exists and self._digest(slot, df) == self._digest(self.versions.latest().slot, df):
                self.versions.discard(slot)
                return self.spark.table(self.table)
            self.versions.commit(self.began_on, slot)
        except BaseException:
            self.versions.discard(slot)
            raise
        self._point(df)
        return self.spark.table(self.table)

    def _digest(self, slot: str, df: DataFrame) -> tuple:
        return tuple(multiset_digest(self.spark.read.schema(df.schema).parquet(slot)).first())

    def _as_target(self, df: DataFrame) -> DataFrame:
        target = self.spark.table(self.table).schema
        missing = set(target.names) ^ set(df.columns)
        if missing:
            raise ValueError(f"columns do not match {self.table}: {sorted(missing)}")
        if _described(self.spark, self.table, "Num Buckets") != (str(self.buckets.count) if self.buckets else None):
            raise ValueError(f"bucketing does not match {self.table}")
        return df.select(*[F.col(field.name).cast(field.dataType) for field in target])

    def _point(self, df: DataFrame) -> None:
        """Let the catalog's table read the last version; again if a later load committed meanwhile."""
        while True:
            version = self.versions.latest()
            if not self.spark.catalog.tableExists(self.table):
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
                layout = f"CLUSTERED BY ({self.buckets.column}) INTO {self.buckets.count} BUCKETS" if self.buckets else ""
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING parquet {layout} LOCATION '{version.slot}'")
            self.spark.sql(f"ALTER TABLE {self.table} SET LOCATION '{version.slot}'")
            self.spark.catalog.refreshTable(self.table)
            if self.versions.latest().number == version.number:
                return


def guarded_replace(
    df: DataFrame, table: str, folder: str, allow_empty: bool = False, buckets: Buckets | None = None
) -> DataFrame:
    """Replace all rows of an external Parquet table, or leave it untouched; see Replacement."""
    return Replacement(df.sparkSession, table, folder, buckets).publish(df, allow_empty)


def _write_slot(df: DataFrame, table: str, slot: str, buckets: Buckets | None, tap: Callable) -> None:
    if buckets is None:
        tap(df).write.mode("error").parquet(slot)
        return
    # Bucketed files can only be written through a table; dropping an external one keeps them.
    following = f"{table}_next_{uuid.uuid4().hex}"
    by_bucket = df.repartition(buckets.count, buckets.column)  # one file per bucket
    tap(by_bucket).write.mode("error").bucketBy(*reversed(buckets)).option("path", slot).saveAsTable(following)
    df.sparkSession.sql(f"DROP TABLE {following}")


def _described(spark: SparkSession, table: str, property_name: str) -> str | None:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    rows = described.filter(F.col("col_name") == property_name).collect()
    return rows[0]["data_type"] if rows else None
