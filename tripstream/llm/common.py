"""Helpers shared by the operators: staging on the shared folder and carrying a caller's columns."""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstream.session import work_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared folder and read it back.

    Cuts the lineage durably: a lost executor re-reads files that every node sees
    instead of recomputing (or losing) what came before.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove staged tables whose successors are staged, and let Spark's cleaner drop the
    shuffle files of finished steps."""
    for f in frames:
        remove(f.sparkSession, f.staged_path)
    release(f.sparkSession)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner, which follows the driver's garbage collection, drop the shuffle files of finished steps."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(df: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """Columns renamed to ``_k0.._kn`` so that no caller's name clashes with an operator's.

    Returns (renamed frame, internal names, original names).
    """
    names = list(df.columns)
    inner = [f"_k{i}" for i in range(len(names))]
    return df.toDF(*inner), inner, names


HOT_SHARE = 1_000


def joined_by_key(rows: DataFrame, keys: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """``rows`` joined with ``keys`` (one row per key, ``weight``: how many of ``rows`` have it, ``total``: of how many).

    Keys with over ``1 / HOT_SHARE`` of the rows are fewer than ``HOT_SHARE``: they are
    broadcast, and their rows stay where they are; only the others' rows move.
    """
    hot = F.col(weight) * HOT_SHARE > total
    often = F.broadcast(keys.where(hot))
    rare = rows.join(F.broadcast(keys.where(hot).select(*on)), on, "left_anti").join(keys.where(~hot), on)
    return rare.unionByName(rows.join(often, on))


def ascii_lower(col):
    """Lower-case A-Z only (Spark's lower() also maps other letters)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def extended(batch: pa.RecordBatch, keep: list[str], **new: pa.Array) -> pa.RecordBatch:
    """The columns of ``keep`` as they are (Arrow keeps nulls and long ids exact) and the new ones."""
    return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + list(new.values()), names=[*keep, *new])


def pieces(batches, rows: int = 1_000):
    """The batches in slices of at most ``rows`` rows, so that few long values are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ddl(schema) -> str:
    """Schema of a frame as field DDL, for mapInArrow."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
