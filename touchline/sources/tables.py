"""Declared source tables, and tables written by earlier steps."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from touchline.session import shared_folder


def source(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """A declared table of the catalog."""
    return spark.table(f"{schema}.{table}")


def parquet_source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table kept as parquet; only the columns and row groups a query needs are read."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


VERSION, PREVIOUS = "touchline.version", "touchline.previous"
_switching = threading.Lock()


def create_or_replace(df: DataFrame, table: str, accept: Callable[[DataFrame], object] | None = None) -> DataFrame:
    """Replace a catalog table with ``df`` and return the new table.

    The name is a view of a version of its own. A new version is written beside it, and when it is
    complete the view is pointed there, in one step: a job that fails changes nothing, a reader sees
    the old rows or the new ones, and ``df`` may read what it replaces. The version before stays
    until the next replacement, for readers that have begun on it. Only a plain table that something else
    made has to make room for the view first, so its readers find nothing for a moment.

    ``accept`` gets the written version before the view is pointed there. If it raises, the version is
    dropped and the table stays as it was.

    Replacements of one application may run side by side: each takes the version that it finds when it is
    complete as the one before, so all take effect, in that order, and none is left behind.
    """
    spark = df.sparkSession
    fresh = f"{table}__{uuid.uuid4().hex}"
    try:
        df.write.saveAsTable(fresh)
        if accept is not None:
            accept(spark.table(fresh))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    with _switching:
        before = _properties(spark, table)
        if before is not None and VERSION not in before:
            # a plain table of that name, made by something else: it becomes the first version
            before = {VERSION: f"{table}__{uuid.uuid4().hex}"}
            spark.sql(f"ALTER TABLE {table} RENAME TO {before[VERSION]}")
        before = before or {}
        properties = f"'{VERSION}' = '{fresh}', '{PREVIOUS}' = '{before.get(VERSION, '')}'"
        spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({properties}) AS SELECT * FROM {fresh}")
        if before.get(PREVIOUS):
            spark.sql(f"DROP TABLE IF EXISTS {before[PREVIOUS]}")
    return spark.table(table)


def _properties(spark: SparkSession, table: str) -> dict[str, str] | None:
    if not spark.catalog.tableExists(table):
        return None
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write a shared intermediate result to the shared folder and read it from there.

    It lives as long as the application: the file system deletes it when that ends.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.parquet(folder)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)
