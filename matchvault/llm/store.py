"""Intermediate results in the folder that the cluster shares, and bit maps of bounded size."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def small_batches(spark: SparkSession, rows: int = 2000, size: str = "64m", read: int = 4096) -> None:
    """Texts are long and several tasks share an executor's memory, so batches are kept short: of ``rows`` and ``size`` on
    the way to Python, of ``read`` rows in Parquet readers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(read))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; set to a local folder only where it is unset and the session is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="matchvault-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/matchvault-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(columns, name: str) -> str:
    """``name``, with underscores added until it is unlike all of ``columns`` in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(docs: DataFrame, *names: str):
    """``docs`` with columns called like one of ``names`` renamed, and a function that gives the columns back their names.

    The function selects the columns of ``docs``, in their order, from a frame made of the renamed one.
    """
    wanted, columns, other = {n.lower() for n in names}, list(docs.columns), {}
    for c in docs.columns:
        if c.lower() in wanted:
            other[c] = unused([*columns, *names], c)
            columns.append(other[c])
    return docs.withColumnsRenamed(other), lambda df: df.select(*(F.col(f"`{other.get(c, c)}`").alias(c) for c in docs.columns))


def bit_map(at: DataFrame, bits: int) -> np.ndarray:
    """The map with the bits in the one column of ``at`` set, as bytes: 2^bits / 8 of them whatever the rows.

    A test against it has no false negatives; false positives only make later exact steps read more.
    """
    words = (
        at.toDF("at")
        .groupBy(F.shiftright("at", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 AS int))")).alias("mask"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 5), dtype=np.uint32)
    out[words["word"].to_numpy()] = words["mask"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)
