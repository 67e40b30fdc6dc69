"""Sources, sinks and the catalog: SRC, SNK and CAT operators."""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections.abc import Callable
from types import CodeType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    """SRC01, SRC02, SRC07: any format that the session knows; csv has a header unless told otherwise."""
    reader = spark.read.format(fmt).options(**({"header": "true"} if fmt == "csv" else {}) | options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC03"""
    return spark.table(name)


def latest_partition(df: DataFrame, partition: str) -> DataFrame:
    """SRC04: the rows with the largest value. The maximum is one pruned aggregate, joined as a one-row broadcast, so no action
    runs here and a partition column prunes files dynamically."""
    return df.join(F.broadcast(df.agg(F.max(partition).alias(partition))), partition, "left_semi")


def partition_at(df: DataFrame, partition: str, date: str, lag_months: int = 0) -> DataFrame:
    """SRC05: the rows of the date `lag_months` before date."""
    return df.where(F.col(partition).cast("date") == F.add_months(F.lit(date).cast("date"), -lag_months))


def lookup(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """SRC08: a small table from literals, such as bin counts from a configuration."""
    return spark.createDataFrame(rows, schema)


def synthetic_transactions(customers: DataFrame, id_col: str, per_customer: int = 10, fraud_share: float = 0.02) -> DataFrame:
    """SRC09: transactions for each customer, from the md5 of the ids: the same on every run and any number of executors.

    (transaction_id, customer_id, merchant_id, amount, merchant_category, is_fraud); frauds cost 1000 to 10000."""
    u = lambda salt, n: F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(salt), "customer_id", "k")), 1, 12), 16, 10).cast("long") % F.lit(n)
    rows = customers.select(F.col(id_col).alias("customer_id"), F.explode(F.sequence(F.lit(1), F.lit(per_customer))).alias("k"))
    rows = rows.withColumn("is_fraud", (u("fraud", 10_000) < int(fraud_share * 10_000)).cast("int"))
    amount = F.when(F.col("is_fraud") == 1, 1000 + u("amount", 900_001) / 100).otherwise(5 + u("amount", 49_501) / 100)
    kinds = F.when(F.col("is_fraud") == 1, F.array(F.lit("online"), F.lit("atm"))).otherwise(F.array(*map(F.lit, ("grocery", "gas", "restaurant", "retail", "online", "atm"))))
    return rows.select(
        F.concat(F.lit("txn_"), F.col("customer_id"), F.lit("_"), F.col("k")).alias("transaction_id"),
        "customer_id",
        F.concat(F.lit("m_"), u("merchant", 1000)).alias("merchant_id"),
        F.round(amount.cast("double"), 2).alias("amount"),
        F.get(kinds, (u("kind", 1 << 30) % F.size(kinds)).cast("int")).alias("merchant_category"),
        "is_fraud",
    )


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error", partition_by: list[str] | None = None, **options: str) -> None:
    """SNK01, SNK04, SNK08: parquet, json or csv (with a header)."""
    writer = df.write.format(fmt).mode(mode).options(**({"header": "true"} if fmt == "csv" else {}) | options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_table(df: DataFrame, name: str, mode: str = "error", fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """SNK02"""
    writer = df.write.format(fmt).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def overwrite_partitions(df: DataFrame, target: str, partition_by: list[str]) -> None:
    """SNK03: replaces exactly the partitions that df has rows for; a name with a dot or without a slash is a table."""
    if "/" in target:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(target)
        return
    spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"  # insertInto takes it from the session alone
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df.select(*spark.table(target).columns).write.mode("overwrite").insertInto(target)
    finally:
        spark.conf.set(key, before)


def create_partitioned_table(spark: SparkSession, name: str, columns: list[tuple[str, str]], partition_by: list[tuple[str, str]], fmt: str = "parquet") -> None:
    """SNK05: from a list of names and types, if it isn't there yet."""
    fields = ", ".join(f"`{n}` {t}" for n, t in [*columns, *partition_by])
    parts = ", ".join(f"`{n}`" for n, _ in partition_by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING {fmt}" + (f" PARTITIONED BY ({parts})" if parts else ""))


def shared_folder(spark: SparkSession, name: str = "stream") -> str:
    """A new folder in the one that spark.checkpoint.dir names. Where that is unset, a temporary one on a single machine, as in
    tests; on a cluster an error, as executors don't share such a folder."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not where and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(where or tempfile.mkdtemp(prefix='spark-', dir='/tmp')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: computed once, and whole when executors are lost."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a stored() frame that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing path, in whatever store Spark reaches."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return bool(mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark))


def fingerprint(spark: SparkSession, inputs: list[str]) -> dict[str, int | str]:
    """How many files some paths hold, how many bytes, and a sum of hashes of their names, sizes and times; the listing is Spark's own, and one
    row reaches the driver."""
    if not inputs:
        return {"files": 0, "bytes": 0, "digest": "0"}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(inputs).select("path", "length", "modificationTime")
    n, size, mark = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38, 0)")), F.lit(0).cast("decimal(38, 0)"))).first()
    return {"files": n, "bytes": size, "digest": str(mark)}


def code_version(make: Callable) -> str:
    """A digest of a function's code and of the functions written inside it; what it calls is not in it."""

    def parts(code: CodeType) -> list[str]:
        return [code.co_code.hex(), repr(code.co_names), *(x for c in code.co_consts for x in (parts(c) if isinstance(c, CodeType) else [repr(c)]))]

    return hashlib.sha256("\n".join(parts(make.__code__)).encode()).hexdigest()


def _manifest(spark: SparkSession, path: str, text: str | None = None, drop: bool = False) -> str | None:
    """Reads, writes or drops the manifest of path, a file that readers of data pass over."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path, "_MANIFEST")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if drop:
        fs.delete(at, False)
    elif text is not None:
        out = fs.create(at, True)
        out.write(bytearray(text.encode()))
        out.close()
    elif fs.exists(at):
        source = fs.open(at)
        try:
            return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
    return None


def materialize(spark: SparkSession, path: str, make: Callable[[], DataFrame], partition_by: list[str] | None = None, inputs: list[str] | None = None, version: str | None = None) -> DataFrame:
    """SNK07: reads path if it is complete, else makes it, writes it and reads it back.

    inputs: the paths that make() reads. With them, a manifest beside the data says what files these were, with sizes and times, and
    of what version the code was (by default a digest of make's own code); where either has changed, or the manifest is missing, the data
    is made again. The manifest is dropped before the data is touched and written after it, so that a run that breaks off leaves none."""
    if inputs is None:
        if not is_complete(spark, path):
            write(make(), path, mode="overwrite", partition_by=partition_by)
        return spark.read.parquet(path)
    want = json.dumps(fingerprint(spark, inputs) | {"version": version or code_version(make)}, sort_keys=True)
    if not is_complete(spark, path) or _manifest(spark, path) != want:
        _manifest(spark, path, drop=True)
        write(make(), path, mode="overwrite", partition_by=partition_by)
        _manifest(spark, path, want)
    return spark.read.parquet(path)


#: CAT06. What the metadata's types mean.
SAS_TYPES = {"Char": "string", "Num": "int"}


def sas_type(kind: str, fmt: str | None) -> str:
    """Num with decimals in its format ("12.2") is a double."""
    decimals = (fmt or "").rpartition(".")[2]
    return "double" if kind == "Num" and decimals.isdigit() and int(decimals) > 0 else SAS_TYPES[kind]


def cast_by_metadata(df: DataFrame, meta: list[tuple[str, str, str | None]]) -> DataFrame:
    """CAT06: df's columns cast as (name, type, format) rows say; what doesn't cast becomes null, and _rejected counts such
    values of the row."""
    typed = {name: F.col(name).try_cast(sas_type(kind, fmt)) for name, kind, fmt in meta}
    bad = sum(((F.col(n).isNotNull() & c.isNull()).cast("int") for n, c in typed.items()), F.lit(0))
    return df.select(*(c.alias(n) for n, c in typed.items()), bad.alias("_rejected"))


def conform(df: DataFrame, schema: list[tuple[str, str]], rename: dict[str, str] | None = None, constants: dict[str, Column] | None = None) -> DataFrame:
    """PRJ01, PRJ02, PRJ03: renames, adds constants, then order and types of the contract."""
    out = df.withColumnsRenamed(rename or {})
    out = out.withColumns(constants) if constants else out
    return out.select(*(F.col(n).cast(t).alias(n) for n, t in schema))
