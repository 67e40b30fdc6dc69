"""Helpers that the text operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as in the class \x20\x09-\x0D.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The runs of characters other than ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names. Where that is unset, a temporary one on a single machine, as in tests;
    on a cluster an error, as executors don't share such a folder."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not where and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not where:
        where = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has yet."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: the lineage ends there, and lost executors lose nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hidden(df: DataFrame, *names: str) -> list[str]:
    """Column names for inside use that df, in whatever case, does not have."""
    mine = {c.lower() for c in df.columns}
    mark = "_"
    while any(f"{mark}{n}".lower() in mine for n in names):
        mark += "_"
    return [f"{mark}{n}" for n in names]


def discard(df: DataFrame) -> None:
    """Deletes the files of a stored() frame that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_folder(spark, name)


def row_key(df: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """96 bits that tell rows apart by id and text, nulls included; rows equal in both are one document."""
    return [F.xxhash64(F.col(id_col), F.col(text_col)).alias("_k1"), F.hash(F.col(text_col), F.col(id_col)).alias("_k2")]
