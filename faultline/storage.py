"""Reliable intermediate tables.

A few operators need rows to keep the position they were given once (global
rank, cumulative curves). Those positions are written as data to the shared
folder named by ``spark.checkpoint.dir``, so a lost executor never changes
them. Files rather than ``DataFrame.checkpoint``: the next pass often needs
two columns out of many and parquet prunes the rest, and Spark then knows the
real size of the table when it chooses between broadcast and shuffle joins.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: How often this process has released its tables; caches of frames key on it.
releases = 0


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        folder = tempfile.mkdtemp(prefix="faultline-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def enable_checkpoints(spark: SparkSession) -> None:
    """Give iterative learners a folder for their periodic checkpoints."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/faultline-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never used before."""
    return f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, apart: str | None = None) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written rows.

    Rows of different values of the column ``apart`` go to different files, so a
    filter on it leaves the others unread.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    (df.write.partitionBy(apart) if apart else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Give a written file or folder its final name, in place of what has it.

    A file replaces a file in one step. A folder cannot replace a folder: the old one
    goes first, and the rename is all that can be lost in between.
    """
    jvm = spark._jvm.org.apache.hadoop.fs
    source, target = jvm.Path(staged), jvm.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target) and not (files.isFile(target) and files.isFile(source)):
        files.delete(target, True)
    parent = target.getParent()
    if parent is not None:
        files.mkdirs(parent)
    overwrite = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    overwrite[0] = jvm.Options.Rename.OVERWRITE
    context = jvm.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(source), files.makeQualified(target), overwrite)


def beside(path: str) -> str:
    """A fresh hidden name in the folder of ``path``, on the same file system."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}{'/' if folder else ''}.{name}-{uuid.uuid4().hex}"


def only_part(spark: SparkSession, folder: str) -> str:
    """The one data file of a folder that a single task wrote."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [f.getPath().toString() for f in files.listStatus(place) if f.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise ValueError(f"{folder} holds {len(parts)} data files")
    return parts[0]


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table this application has written."""
    global releases
    releases += 1
    delete(spark, application_folder(spark))
