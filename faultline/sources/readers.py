"""Scans: delimited files, tables, the field log, ordered fallbacks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from faultline.operators.risk import with_probability
from faultline.schemas import log_schema, predictions_csv_schema, predictions_text_schema


def read_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """Header CSV read by the executors; columns are found by name.

    The header line decides the order, the schema the type of each named
    column; other columns are text, and an absent one is left to the caller's
    column check. Every file must carry the same header. A blank field is a
    missing value.

    ``multiline`` allows line breaks inside quotes; such a file cannot be
    split, so it is for logs of free text and not for sensor tables.
    """

    def reader():
        return (
            spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
        )

    kinds = {field.name: field.dataType for field in schema}
    header = reader().csv(path).columns
    named = StructType([StructField(c, kinds.get(c, StringType())) for c in header])
    return reader().schema(named).option("enforceSchema", False).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_predictions(spark: SparkSession, path: str, vector_text: bool = False) -> DataFrame:
    """Exported predictions, whether the score is a number or vector text."""
    schema = predictions_text_schema() if vector_text else predictions_csv_schema()
    return with_probability(read_csv(spark, path, schema))


def read_or_none(spark: SparkSession, source: str, schema: StructType | None) -> DataFrame | None:
    """A path (given a schema) or a table, or None when it does not exist."""
    try:
        return spark.table(source) if schema is None else read_csv(spark, source, schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
            return None
        raise


def first_available(
    spark: SparkSession, sources: Sequence[tuple[str, StructType | None]]
) -> DataFrame:
    """The first source of the list that exists: (path, schema) or (table, None)."""
    for source, schema in sources:
        found = read_or_none(spark, source, schema)
        if found is not None:
            return with_probability(found)
    raise FileNotFoundError(f"none of the sources exists: {[s for s, _ in sources]}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Field log, or an empty frame with its nine columns before the first write."""
    try:
        return read_csv(spark, path, log_schema(), multiline=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], log_schema())
