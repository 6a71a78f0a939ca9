"""Catalog tables: namespaces, overwrite, idempotent build, checked writes.

A table is replaced by writing its rows under a staged name and then giving
that table the old one's name. The rows may therefore come from the table they replace, and a
write that fails leaves the old table as it was.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def use_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    spark.sql(f"USE {name}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Replace a table, its schema included, and return the written table."""
    spark = df.sparkSession
    if fmt == "delta":
        # one commit replaces a delta table, readers of the old version included
        df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true").saveAsTable(name)
        return spark.table(name)
    staged = f"{name}__staged_{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).saveAsTable(staged)
        drop_table(spark, name)
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    finally:
        drop_table(spark, staged)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and an observation that counts its rows while they are written.

    The frame lives in a copy of its session: a session that has observed
    something cannot be serialised any more, and fitted models hold theirs.
    """
    spark = df.sparkSession
    copy = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    rows = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(
        copy._jsparkSession, df._jdf.queryExecution().analyzed()
    )
    seen = Observation()
    return DataFrame(rows, copy).observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    df.write.mode("append").format(fmt).saveAsTable(name)
    return df.sparkSession.table(name)


def write_checked(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    severity: str = "error",
    expected_rows: int | None = None,
) -> DataFrame:
    """Overwrite a table and compare the rows sent with the rows stored.

    Without ``expected_rows`` the rows are counted on their way into the
    table, so the input is computed once.
    """
    spark = df.sparkSession
    if expected_rows is None:
        observed, seen = counted(df)
        overwrite_table(observed, name, fmt)
        expected = seen.get["rows"]
        spark.catalog.refreshTable(name)
    else:
        expected = expected_rows
        overwrite_table(df, name, fmt)
    written = spark.table(name)
    stored = written.count()
    if stored != expected:
        message = f"{name}: sent {expected} rows, stored {stored}"
        if severity == "error":
            raise RuntimeError(message)
        warnings.warn(message, stacklevel=2)
    return written


def ensure_table(
    spark: SparkSession,
    name: str,
    build: Callable[[], DataFrame],
    expected_rows: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Keep a table that has the expected rows; else drop it and build it.

    Without an expectation nothing shows that the stored rows are the right
    ones, so the table is rebuilt. A rebuilt table with another number of rows
    than expected is an error.
    """
    if table_exists(spark, name):
        if expected_rows is not None and spark.table(name).count() == expected_rows:
            return spark.table(name)
        drop_table(spark, name)
    return write_checked(build(), name, fmt, expected_rows=expected_rows)
