"""Helpers that the training-data operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one Arrow batch that goes to a Python worker; a batch holds one row at least, so one text bounds it.
ARROW_BATCH_BYTES = 8 << 20
#: Folders of stored tables, of each block of ``recorded`` that is open.
_open: list[list[str]] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound what a Python worker gets at once by bytes, so that long texts cannot fill its memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Only in local mode, where none is set (tests, a notebook), this is a folder of the machine; elsewhere it must be set.
    """
    conf = spark.sparkContext.getConf()
    if folder := conf.get("spark.checkpoint.dir"):
        return folder
    if not conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(tempfile.gettempdir(), "pairloom-checkpoints")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and go on from there.

    Unlike a checkpoint, whose size is what its plan was estimated at, a table has its true size, by which Spark plans
    joins; estimates of repeated joins would grow without bound.
    """
    folder = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    for folders in _open:
        folders.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Collects the folders of the tables that are stored within, for ``drop_stored``."""
    folders: list[str] = []
    _open.append(folders)
    try:
        yield folders
    finally:
        _open[:] = [f for f in _open if f is not folders]


def drop_stored(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete stored tables that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def distinct_names(df: DataFrame, *columns: str) -> DataFrame:
    """Only ``columns``; further columns of the input, whatever their names, cannot clash with working columns."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def whole_rows(df: DataFrame, *columns: str) -> DataFrame:
    """``columns``, and all columns together as struct ``row``: names of the input cannot clash with working columns.

    ``select("row.*")`` gives the input's columns back, also those with dots or back-ticks in their names.
    """
    return df.select(*[F.col(f"`{c}`") for c in columns], F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias("row"))


def text_key(text: Column) -> Column:
    """Tells texts apart; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b"))


def texts(column: pa.Array) -> Iterator[str]:
    """Texts of an Arrow column; null counts as empty."""
    for value in column:
        yield value.as_py() or ""
