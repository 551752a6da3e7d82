"""Session helpers: tables, and the shared folder in which long lineages are cut."""

from __future__ import annotations

import re
import tempfile
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-taxaloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in spark.checkpoint.dir; on a local master, where there is
    one machine, a folder of our own if it names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(named or _own_folder()).rstrip('/')}/taxaloom"


def free_name(df: DataFrame) -> str:
    """A name that no column of ``df`` has."""
    return "_" + "_".join(df.columns)


def cut(df: DataFrame, *superseded: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder, without its lineage; then tables cut before that nothing reads any more are deleted.

    The folder is shared by driver and executors, so the table outlives lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid4().hex}"
    df.write.parquet(path)
    for old in superseded:
        _delete(spark, getattr(old, "cut_path", None))
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def _delete(spark: SparkSession, path: str | None) -> None:
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
