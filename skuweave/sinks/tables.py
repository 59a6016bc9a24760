"""Writing tables so that readers see the old or the new content, never a part.

``replace_table`` repoints a table of the same shape in one statement; where the shape
changes, it renames two tables, and between these a reader finds none. ``replace_view``
has no such moment.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skuweave.functions.json_values import quoted
from skuweave.operators.merge import upsert, without_keys_of
from skuweave.session import cut_lineage

# The columns that keep a JSON type when written.
JSON_COLUMNS = ("raw_values", "data")


#: The partition column of tables that are stored in buckets of a key.
BUCKET = "_bucket"


def with_json_types(df: DataFrame, columns: Sequence[str] = JSON_COLUMNS) -> DataFrame:
    """Parse the JSON text columns that exist into the variant type."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.parse_json(F.col(quoted(c))) for c in present})


def with_json_text(df: DataFrame, columns: Sequence[str] = JSON_COLUMNS) -> DataFrame:
    """Normalised JSON text of the columns, for formats without a variant type."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.to_json(F.parse_json(F.col(quoted(c)))) for c in present})


def replace_table(df: DataFrame, table: str, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new version below ``root`` and point the catalog table at it.

    The new files are complete before the catalog changes, so ``df`` may read the
    table it replaces, and a job that fails half-way leaves the table as it was.
    Earlier versions stay until :func:`remove_versions`. Returns the new folder.
    """
    spark = df.sparkSession
    folder = f"{_versions(table, root)}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(folder)
    schema = spark.read.parquet(folder).schema
    if spark.catalog.tableExists(table) and not partition_by and spark.table(table).schema == schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        # The shape changed, or partitions must be registered anew.
        def register(name: str) -> None:
            spark.catalog.createTable(name, path=folder, source="parquet")
            if partition_by:
                spark.catalog.recoverPartitions(name)

        _swap_in(spark, table, register)
    return folder


def _versions(table: str, root: str) -> str:
    return f"{root.rstrip('/')}/{table.replace('.', '/')}"


def _swap_in(spark: SparkSession, table: str, register: Callable[[str], None]) -> None:
    """Make a table under another name, then exchange the names.

    Whatever fails before the exchange leaves the old table; should the exchange
    itself be cut short, the old table is there under its name with ``__old``.
    """
    new, old = f"{table}__{uuid.uuid4().hex[:8]}", f"{table}__old"
    try:
        register(new)
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        held = spark.catalog.tableExists(table)
        if held:
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        except Exception:
            if held:
                spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.catalog.refreshTable(table)


def remove_versions(spark: SparkSession, table: str, root: str, keep: int = 2) -> int:
    """Delete all but the ``keep`` latest versions of a table below ``root``.

    For callers that know that no reader uses an older version any more. The version
    that the table points at stays in any case. Returns how many were deleted.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_versions(table, root))
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return 0
    used = None
    if spark.catalog.tableExists(table):
        # A view's version bears the name of its folder.
        version = view_properties(spark, table).get(_VERSION)
        used = version.rsplit("__", 1)[-1] if version else table_folder(spark, table).rstrip("/").rsplit("/", 1)[-1]
    versions = sorted(system.listStatus(folder), key=lambda s: s.getModificationTime(), reverse=True)
    old = [v.getPath() for v in versions[max(keep, 0) :] if v.getPath().getName() != used]
    for path in old:
        spark.sql(f"DROP TABLE IF EXISTS {table}__{path.getName()}")
        system.delete(path, True)
    return len(old)


def table_folder(spark: SparkSession, table: str) -> str:
    """Where the files of a catalog table are."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to a table, matching columns by name.

    Columns that the table lacks are added to it, as the other modes do; earlier rows
    have null there, as have new rows where the batch lacks a column.
    """
    spark = df.sparkSession
    known = spark.table(table).schema
    added = [f for f in df.schema if f.name not in known.names]
    if added:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        spark.catalog.refreshTable(table)
    columns = [
        F.col(quoted(f.name)) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema
    ]
    df.select(*columns).write.mode("append").insertInto(table)


def upsert_table(batch: DataFrame, table: str, keys: Sequence[str] | str, root: str) -> str:
    """Merge a batch into a catalog table by writing its next version."""
    return replace_table(upsert(batch.sparkSession.table(table), batch, keys), table, root)


def upsert_partitions(
    batch: DataFrame,
    path: str,
    keys: Sequence[str] | str,
    partition_by: str,
) -> None:
    """Merge a batch into a Parquet folder, rewriting only the partitions it touches.

    These are the partitions of the batch's rows and those in which a key of the batch
    has a row now, so a key that moves leaves no old row behind. Only key and partition
    columns are read to find them, and other partitions are neither read further nor
    written. Spark writes the new partitions aside and swaps them in when the job
    commits; partitions that lost all their rows are deleted after that.
    """
    spark = batch.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    # Folder names do not tell the type of the partition column, the batch does.
    known = spark.read.parquet(path).schema
    stored = T.StructType([f for f in known if f.name != partition_by]).add(batch.schema[partition_by])
    target = spark.read.schema(stored).parquet(path).select(*known.names)
    part = F.col(quoted(partition_by)).alias("_part")
    holding = target.join(batch.select(*keys), keys, "left_semi").select(part)
    touched = cut_lineage(batch.select(part).union(holding).distinct())
    same = F.col(quoted(partition_by)).eqNullSafe(F.col("_part"))
    merged = cut_lineage(upsert(target.join(touched, same, "left_semi"), batch, keys))
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )
    emptied = touched.join(merged.select(quoted(partition_by)).distinct(), same, "left_anti")
    jvm = spark.sparkContext._jvm
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in emptied.select(F.col("_part").cast("string")).toLocalIterator():
        folder = jvm.org.apache.hadoop.fs.Path(path, names.getPartitionPathString(partition_by, row[0]))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key, the same in every run."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def replace_buckets(
    spark: SparkSession, table: str, gone: DataFrame, batch: DataFrame, key: str, buckets: int, part: str = BUCKET
) -> list[int]:
    """Rows of ``batch`` take the place of those whose key is in ``gone``, bucket by bucket.

    ``table`` is partitioned by ``part``, the bucket of ``key``, and ``gone`` holds every key
    of the batch. Only the buckets of these keys are read and written; all others keep
    their files. Spark writes the new buckets aside and swaps them in when the job commits.
    Returns the buckets that were rewritten, of which there are ``buckets`` at most.
    """
    folder, schema = table_folder(spark, table), spark.table(table).schema
    gone = cut_lineage(gone.select(key).distinct())
    touched = [row[0] for row in gone.select(bucket_of(F.col(quoted(key)), buckets)).distinct().collect()]
    if not touched:
        return []
    # A list of bucket numbers: Spark prunes the folders before it lists their files.
    kept = without_keys_of(spark.table(table).where(F.col(part).isin(touched)), gone, [key])
    merged = kept.unionByName(batch.withColumn(part, bucket_of(F.col(quoted(key)), buckets)), allowMissingColumns=True)
    merged = cut_lineage(merged.select(*schema.names))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(folder)
    left = {row[0] for row in merged.select(part).distinct().collect()}
    for bucket in sorted(set(touched) - left):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({part} = {bucket}) PURGE")
        _delete(spark, f"{folder}/{part}={bucket}")
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return sorted(touched)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


_VERSION = "skuweave.version"


def replace_view(
    df: DataFrame, view: str, root: str, partition_by: Sequence[str] = (), hidden: Sequence[str] = (), **properties: str
) -> str:
    """Write a new version as a table of its own and let ``view`` read it.

    The view is redefined in one statement, whatever the shape of old and new: a reader
    finds one of both at any moment, and a failure before that leaves the old one. Earlier
    versions stay in the catalog and on disk, for readers that have resolved them already,
    until :func:`remove_versions`. ``hidden``
    columns are stored and not shown, ``properties`` are kept with the view. Returns the
    table of the version.
    """
    spark = df.sparkSession
    version = f"{view}__{uuid.uuid4().hex}"
    folder = f"{_versions(view, root)}/{version.rsplit('__', 1)[-1]}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(folder)
    spark.catalog.createTable(version, path=folder, source="parquet")
    if partition_by:
        spark.catalog.recoverPartitions(version)
    shown = ", ".join(quoted(name) for name in df.columns if name not in hidden)
    kept = "".join(f", '{name}' = '{value}'" for name, value in properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{_VERSION}' = '{version}'{kept}) AS SELECT {shown} FROM {version}")
    return version


def view_properties(spark: SparkSession, view: str) -> dict[str, str]:
    """What is kept with a view; nothing where there is none."""
    if not spark.catalog.tableExists(view):
        return {}
    return {row[0]: row[1] for row in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}


def view_version(spark: SparkSession, view: str) -> str:
    """The table that a view of :func:`replace_view` reads."""
    return view_properties(spark, view)[_VERSION]


def write_database(
    df: DataFrame, url: str, table: str, mode: str, batch_rows: int = 10_000, **options: str
) -> None:
    """Write over JDBC; ``overwrite`` empties the table and keeps its definition."""
    (
        df.write.format("jdbc")
        .options(**options, url=url, dbtable=table, batchsize=str(batch_rows), truncate="true")
        .mode(mode)
        .save()
    )


def create_table_as(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Create a table with the rows of ``df``; one of that name is replaced.

    The rows are written before the old table goes, so ``df`` may read it, and a
    query that fails leaves it as it was.
    """
    _swap_in(spark, table, lambda name: df.write.saveAsTable(name))
