"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.storage import enable_checkpoints, materialize, new_path

__all__ = [
    "bind",
    "columns_of",
    "enable_checkpoints",
    "materialize",
    "new_path",
    "partitions",
    "ship",
    "table",
    "WORD",
]

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Pickle the functions of ``module`` by value, for executors without it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, found by their whole names, dots and all."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that mentions an outer expression would compute it again for
    each element; a variable bound by a one-element transform is a value.
    """
    return F.transform(F.array(value), body)[0]
