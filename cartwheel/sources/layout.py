"""Where the pipeline's tables live: folders below a root, or names in a catalog.

Both layouts offer the same four steps (``read``, ``exists``, ``replace``, ``append``), so the pipeline,
its verification and the acceptance suite do not know which one they run on.

``CatalogTables.replace`` never leaves a name empty or missing: every run writes a fresh table
``<name>__v_<time>_<id>`` in a folder of its own, and one ``CREATE OR REPLACE VIEW`` then moves the name
to it.  A reader sees the old rows or the new ones; the version before stays, for readers that had
already resolved it.  Appended tables (the quality history) are plain catalog tables.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cartwheel.sources.tables import append_table, delete_path, overwrite_changed, read_table, table_exists, table_location, write_table


class PathTables:
    """Tables as folders below ``root``.  Partitioned tables are overwritten by changed partition only."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def target(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return table_exists(self.spark, self.target(name))

    def read(self, name: str, merge_schema: bool = False) -> DataFrame:
        return read_table(self.spark, self.target(name), self.fmt, merge_schema)

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] | None = None) -> None:
        if partition_by:
            overwrite_changed(df, self.target(name), partition_by, self.fmt)
        else:
            write_table(df, self.target(name), "overwrite", self.fmt)

    def append(self, name: str, df: DataFrame) -> None:
        append_table(df, self.target(name), self.fmt)


class CatalogTables:
    """Tables by name in ``database``, their files below ``location``; ``keep`` older versions stay."""

    def __init__(self, spark: SparkSession, database: str, location: str, fmt: str = "parquet", keep: int = 1):
        self.spark, self.database, self.location, self.fmt, self.keep = spark, database, location.rstrip("/"), fmt, keep
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.location}'")

    def target(self, name: str) -> str:
        return f"{self.database}.{name}"

    def exists(self, name: str) -> bool:
        return table_exists(self.spark, self.target(name))

    def read(self, name: str, merge_schema: bool = False) -> DataFrame:
        return read_table(self.spark, self.target(name), self.fmt)

    def versions(self, name: str) -> list[str]:
        """The stored versions of ``name``, oldest first."""
        found = self.spark.sql(f"SHOW TABLES IN `{self.database}` LIKE '{name}__v_*'").collect()
        return sorted(r["tableName"] for r in found if r["tableName"].startswith(f"{name}__v_"))

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] | None = None) -> None:
        version = f"{name}__v_{time.time_ns() // 1000:018d}_{uuid.uuid4().hex[:6]}"
        writer = df.write.format(self.fmt).option("path", f"{self.location}/{version}")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(self.target(version))
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.target(name)} AS SELECT * FROM {self.target(version)}")
        for old in self.versions(name)[: -(self.keep + 1)]:
            at = table_location(self.spark, self.target(old))
            self.spark.sql(f"DROP TABLE IF EXISTS {self.target(old)}")
            if at:
                delete_path(self.spark, at)

    def append(self, name: str, df: DataFrame) -> None:
        append_table(df, self.target(name), self.fmt)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, location: str | None = None) -> DataFrame:
    """Catalog table ``name`` in ``buckets`` files, hashed and sorted by ``keys`` (one file a bucket).  Joins and groupings
    on the keys of tables with the same number of buckets need no exchange.  Choose buckets of 1 to 4 GB."""
    writer = df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", location) if location else writer).saveAsTable(name)
    return df.sparkSession.read.table(name)


def layout_of(spark: SparkSession, where: str | PathTables | CatalogTables, fmt: str) -> PathTables | CatalogTables:
    return PathTables(spark, where, fmt) if isinstance(where, str) else where
