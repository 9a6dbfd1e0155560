"""Files of any store that Spark reads: Hadoop's FileSystem, through the session's JVM, on the driver."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def joined(base: str, *names: str) -> str:
    """A path below another; the scheme of a remote one stays as it is."""
    return "/".join([str(base).rstrip("/"), *(str(n).strip("/") for n in names)])


def _at(path: str) -> tuple[Any, Any]:
    spark = session()
    p = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(path: str) -> bool:
    fs, p = _at(path)
    return bool(fs.exists(p))


def read_text(path: str) -> str:
    fs, p = _at(path)
    stream = fs.open(p)
    try:
        return bytes(session()._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(path: str, text: str) -> None:
    """Written beside and renamed, so that readers see a whole file or none."""
    fs, p = _at(path)
    part = session()._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(part, p):  # some stores don't replace a file by renaming
        fs.delete(p, False)
        if not fs.rename(part, p):
            raise OSError(f"cannot write {path}")


def listed(path: str) -> list[dict[str, Any]]:
    """Files at or below a path with size and time, in order of their names."""
    fs, p = _at(path)
    if not fs.exists(p):
        return []
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        found.append({"path": f.getPath().toString(), "size": f.getLen(), "mtime_ms": f.getModificationTime()})
    return sorted(found, key=lambda f: f["path"])


def delete(path: str) -> None:
    fs, p = _at(path)
    fs.delete(p, True)


def folders(path: str) -> list[str]:
    """Names of the folders in a folder."""
    fs, p = _at(path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


#: Paths of staged tables, of each block of ``staging`` that is open.
_staging: list[list[str]] = []


@contextmanager
def staging() -> Iterator[None]:
    """Tables that are staged within are deleted at the end, when what was made from them has been written."""
    paths: list[str] = []
    _staging.append(paths)
    try:
        yield
    finally:
        _staging[:] = [p for p in _staging if p is not paths]
        for path in paths:
            delete(path)


def shared_path(name: str) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``)."""
    conf = session().sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir")
    if not base:
        if not conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "pairloom-staged")
    return joined(base, f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that all executors share (``spark.checkpoint.dir``) and read again: made once, however often it is used."""
    spark, path = df.sparkSession, shared_path("staged")
    for paths in _staging[-1:]:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
