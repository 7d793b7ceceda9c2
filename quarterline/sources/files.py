"""Hadoop file system calls, and the shared folder for tables that outlive a query plan."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    Where none is named, a cluster has its warehouse, which must not be a folder of one machine, and a local session a
    temporary folder that goes with the process.
    """
    key = "spark.checkpoint.dir"
    named = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)
    if not named and not re.match(r"local(\[[^,\]]*\])?$", spark.sparkContext.master):
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if named.startswith("file:") and not spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share: {named} is a machine's own")
    elif not named:
        named = tempfile.mkdtemp(prefix="quarterline-")
        atexit.register(shutil.rmtree, named, True)
        spark.conf.set(key, named)
    return named.rstrip("/")


_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, deleted by sweep() or when the process ends."""
    if not _made:
        atexit.register(_sweep_at_exit, spark)
    _made.append(path := f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return path


def sweep(spark: SparkSession) -> None:
    """Delete what scratch() gave out so far; for sessions that live long, between results."""
    while _made:
        delete(spark, _made.pop())


def _sweep_at_exit(spark: SparkSession) -> None:
    try:
        sweep(spark)
    except Exception:  # the session is gone; who owns the folder cleans it
        _made.clear()


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a new path under the shared folder and read back: its lineage ends there, and plans know
    its size."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@lru_cache(maxsize=1)
def _hadoop(context: SparkContext):
    """The class of paths and the configuration; finding them anew each time would cost several calls to the JVM."""
    return context._jvm.org.apache.hadoop.fs.Path, context._jsc.hadoopConfiguration()


def _path(spark: SparkSession, path: str):
    cls, configuration = _hadoop(spark.sparkContext)
    hadoop = cls(path)
    return hadoop, hadoop.getFileSystem(configuration)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it doesn't exist."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _linked(part: str, final: str) -> bool:
    """A file under a second name; False if that is taken. Where there are no links it is created anew, by one only."""
    try:
        os.link(part, final)
    except FileExistsError:
        return False
    except OSError:
        try:
            with open(part, "rb") as text, open(final, "xb") as out:
                out.write(text.read())
        except FileExistsError:
            return False
    return True


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with the text in one step; False, and nothing changed, if it exists already.

    Of several writers exactly one succeeds: a local file is linked under its name, which fails if that is taken, and
    the renames of HDFS and its like fail, too. Object stores without such a rename don't suit commits.
    """
    part, fs = _path(spark, f"{path}.{uuid.uuid4().hex}.part")
    final, _ = _path(spark, path)
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.getScheme() == "file":
        done = _linked(*(fs.makeQualified(p).toUri().getPath() for p in (part, final)))
    else:
        done = not fs.exists(final) and fs.rename(part, final)
    if fs.exists(part):
        fs.delete(part, False)
    return done


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
