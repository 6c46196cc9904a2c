"""Table IO: scans, overwrite/append sinks, schema evolution, existence probes.

Tables are addressed either by catalog name or by path (anything containing
``/``).  Writes never overwrite a table while reading it: an overwrite whose
input reads the target is first written to a staging location and swapped
in.  Appends with new columns evolve the schema (``unionByName`` with missing
columns as NULL); Parquet path tables are read with ``mergeSchema``.  ``overwrite_changed`` rewrites
only the partitions whose content changed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def records_to_frame(spark: SparkSession, records, schema=None) -> DataFrame:
    """Small driver-side records (dicts or tuples) as a DataFrame with a declared
    schema (default: the bronze schema) — for fixtures and hand-made rows only;
    data that grows belongs in files or ``spark.range``-based generators."""
    from cartwheel.schemas import BRONZE

    schema = schema or BRONZE
    names = [f.name for f in schema.fields]
    rows = [tuple(r.get(n) for n in names) if isinstance(r, dict) else tuple(r) for r in records]
    return spark.createDataFrame(rows, schema)


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def read_table(spark: SparkSession, target: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Scan a path or catalog table.  ``merge_schema`` reads every file's
    footer: only for append-only tables whose columns may have grown."""
    if _is_path(target):
        reader = spark.read.format(fmt)
        if merge_schema and fmt in ("parquet", "orc"):
            reader = reader.option("mergeSchema", "true")
        return reader.load(target)
    return spark.read.table(target)


def table_exists(spark: SparkSession, target: str) -> bool:
    if _is_path(target):
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return bool(fs.exists(path))
    return spark.catalog.tableExists(target)


def _fs(spark: SparkSession, target: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete_path(spark: SparkSession, target: str) -> None:
    fs, path = _fs(spark, target)
    fs.delete(path, True)


def table_location(spark: SparkSession, name: str) -> str | None:
    """The folder of a catalog table (None for a view)."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return found[0].data_type if found else None


def input_folders(df: DataFrame) -> list[str]:
    """The root folders of all file relations in the analysed plan, views and subqueries included."""

    def roots(plan) -> list[str]:
        out, leaves, inner = [], plan.collectLeaves(), plan.subqueriesAll()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            relation = leaf.relation() if leaf.getClass().getSimpleName() == "LogicalRelation" else None
            if relation is not None and relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                out += [paths.apply(j).toString() for j in range(paths.size())]
        return out + [r for i in range(inner.size()) for r in roots(inner.apply(i))]

    return roots(df._jdf.queryExecution().analyzed())


def _reads_target(df: DataFrame, target: str) -> bool:
    """Does ``df`` scan files of ``target`` (path or catalog table)?"""
    spark = df.sparkSession
    at = target if _is_path(target) else table_location(spark, target)
    if at is None:
        return False
    qualified = []
    for x in (at, *input_folders(df)):
        fs, path = _fs(spark, x)
        qualified.append(fs.makeQualified(path).toString().rstrip("/") + "/")
    return any(x.startswith(qualified[0]) or qualified[0].startswith(x) for x in qualified[1:])


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
) -> str:
    """Write ``df`` to a catalog table or a path and return the target."""
    spark = df.sparkSession
    if mode == "append" and table_exists(spark, target):
        return append_table(df, target, fmt)
    if mode == "overwrite" and table_exists(spark, target) and _reads_target(df, target):
        return _overwrite_via_staging(df, target, fmt, partition_by)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)
    return target


def _overwrite_via_staging(df: DataFrame, target: str, fmt: str, partition_by) -> str:
    spark = df.sparkSession
    stage = f"{target.rstrip('/')}__stage_{uuid.uuid4().hex[:8]}" if _is_path(target) else f"{target}__stage_{uuid.uuid4().hex[:8]}"
    write_table(df, stage, "overwrite", fmt, partition_by)
    if _is_path(target):
        fs, dst = _fs(spark, target)
        _, src = _fs(spark, stage)
        _, old = _fs(spark, f"{target.rstrip('/')}__old_{uuid.uuid4().hex[:8]}")
        if not fs.rename(dst, old):
            raise OSError(f"{target} could not be set aside; the new rows are in {stage}")
        if not fs.rename(src, dst):
            fs.rename(old, dst)
            raise OSError(f"{stage} could not be moved to {target}")
        fs.delete(old, True)
    else:
        writer = spark.read.table(stage).write.format(fmt).mode("overwrite")
        keep = partition_by or partition_columns(spark, target)
        (writer.partitionBy(*keep) if keep else writer).saveAsTable(target)
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
    return target


def content_digest(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """A row per partition: rows and two sums of row hashes, independent of the rows' order."""
    cols = sorted(df.columns)
    one, two = F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)
    wide = lambda h: F.sum(h.cast("decimal(20,0)"))
    return df.groupBy(*by).agg(F.count("*").alias("_rows"), wide(one).alias("_one"), wide(two).alias("_two"))


def overwrite_changed(df: DataFrame, target: str, partition_by: Sequence[str], fmt: str = "parquet") -> tuple[int, int]:
    """Make ``target`` (a path or a partitioned catalog table) hold exactly ``df``, rewriting only the partitions
    whose content differs; returns (partitions written, partitions removed).

    Contents are compared by a digest per partition, so both sides are read once; then the changed partitions of
    ``df`` replace the stored ones (dynamic partition overwrite) and stored partitions that ``df`` lacks are
    deleted.  ``df`` is computed twice, and must give the same rows both times; one that reads ``target`` is
    staged first.  A missing table, or one of other columns or types, is written whole."""
    spark, by = df.sparkSession, list(partition_by)
    stored = read_table(spark, target, fmt) if table_exists(spark, target) else None
    shape = lambda d: {f.name: f.dataType for f in d.schema.fields}
    if stored is None or shape(stored) != shape(df):
        write_table(df, target, "overwrite", fmt, by)
        return df.select(*by).distinct().count(), 0
    stage = None
    if _reads_target(df, target):
        root = target if _is_path(target) else table_location(spark, target)
        stage = f"{root.rstrip('/')}__stage_{uuid.uuid4().hex[:8]}"
        df.write.format(fmt).save(stage)
        df = spark.read.format(fmt).schema(df.schema).load(stage)
    new, old = content_digest(df, by).alias("new"), content_digest(stored, by).alias("old")
    same_key = lambda a, b: [a[c].eqNullSafe(b[c]) for c in by]
    both = new.join(old, [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in by], "full")
    state = F.when(F.col("old._rows").isNull() | (F.struct("new._rows", "new._one", "new._two") != F.struct("old._rows", "old._one", "old._two")), 1)
    state = F.when(F.col("new._rows").isNull(), 2).otherwise(state)
    key = [F.when(F.col("new._rows").isNull(), F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c) for c in by]
    found = both.select(*key, state.alias("_state")).where("_state IS NOT NULL").collect()  # a row per changed partition
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    part = lambda state: spark.createDataFrame([tuple(r)[:-1] for r in found if r["_state"] == state], kinds)
    changed, gone = part(1), part(2)
    counts = tuple(sum(r["_state"] == s for r in found) for s in (1, 2))
    if counts[0]:
        rows = df.join(F.broadcast(changed), same_key(df, changed), "left_semi").select(*stored.columns)
        folder = target if _is_path(target) else table_location(spark, target)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt).partitionBy(*by).save(folder)
    if counts[1]:
        rows = stored.join(F.broadcast(gone), same_key(stored, gone), "left_semi")
        for r in rows.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("at")).distinct().collect():  # a folder per partition
            delete_path(spark, r["at"])
    if any(counts) and not _is_path(target):
        spark.sql(f"MSCK REPAIR TABLE {target} SYNC PARTITIONS")
        spark.catalog.refreshTable(target)
    if stage:
        delete_path(spark, stage)
    return counts


def append_table(df: DataFrame, target: str, fmt: str = "parquet") -> str:
    """Append rows; new columns evolve the table's schema."""
    spark = df.sparkSession
    if not table_exists(spark, target):
        return write_table(df, target, "overwrite", fmt)
    existing = read_table(spark, target, fmt, merge_schema=True)
    types = {f.name: f.dataType for f in existing.schema.fields}
    for f in df.schema.fields:
        if f.name in types and types[f.name] != f.dataType:
            raise ValueError(f"{target}: column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    if _is_path(target):  # files may differ in columns; readers merge schemas
        df.write.format(fmt).mode("append").save(target)
        return target
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in types]
    if new:
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({', '.join(new)})")
    stored = spark.read.table(target).schema.fields
    rows = df.select(*(f.name if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in stored))
    rows.write.format(fmt).mode("append").saveAsTable(target)
    return target
