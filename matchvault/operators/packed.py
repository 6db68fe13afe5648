"""Training rows as packed blocks, for solvers that read all rows again and again.

A vector of one-hot slots takes hundreds of bytes a row, as objects more. A block holds the scaled numbers of many rows, the
indices of their categories and their labels as plain arrays, some tens of bytes a row, so that what is read in every pass
stays in memory up to far larger tables. A pass is a job whose tasks send one array of sums each; their number does not
grow with the rows.
"""

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 65_536
BLOCKS_AT_ONCE = 4
TASKS = 16  # at least, where cores are fewer; a task costs some 0.1 s beside its rows
SCHEMA = "n long, numbers binary, codes binary, labels binary"


@contextmanager
def _setting(spark, name, value):
    """``value`` for plans that are made inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Shape:
    """What the fitted preprocessing makes of a row: scaled numbers, and per category an index below its width.

    The index one past the width is that of unseen values, all of whose slots are zero.
    """

    def __init__(self, prepared, numeric, categorical):
        self.numbers = len(numeric)
        indexer = next((s for s in prepared.stages if hasattr(s, "labelsArray")), None)
        self.widths = [len(v) for v in indexer.labelsArray] if categorical else []
        self.starts = [self.numbers + sum(self.widths[:i]) for i in range(len(self.widths))]
        self.indexed = [f"{c}_index" for c in categorical]
        self.size = self.numbers + sum(self.widths)
        self.dtype = np.min_scalar_type(max([*self.widths, 0]))


def _blocks(shape, encode):
    def task(batches):
        held, rows = [], 0

        def block():
            numbers, codes, labels = (np.concatenate(parts, axis=at) for parts, at in zip(zip(*held), (0, 1, 0)))
            data = [len(labels)], [encode(numbers).tobytes()], [codes.tobytes()], [labels.tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array(d, t) for d, t in zip(data, (pa.int64(), *[pa.binary()] * 3))], ["n", "numbers", "codes", "labels"]
            )

        for batch in batches:
            n = batch.num_rows
            numbers, *codes, labels = batch.columns
            if labels.null_count:
                raise ValueError("a label is NULL")
            labels = labels.to_numpy(zero_copy_only=False)
            if not np.isin(labels, (0, 1)).all():
                raise ValueError("labels are 0 and 1")
            numbers = numbers.flatten().to_numpy(zero_copy_only=False).reshape(n, shape.numbers)
            if not np.isfinite(numbers).all():
                raise ValueError("a number is NaN or infinite")
            codes = np.array([c.to_numpy(zero_copy_only=False) for c in codes], shape.dtype).reshape(len(codes), n)
            held.append((numbers.copy(), codes, labels.astype(np.int8)))
            rows += n
            if rows >= ROWS_PER_BLOCK:
                yield block()
                held, rows = [], 0
        if rows:
            yield block()

    return task


@contextmanager
def packed(prepared, rows, shape, label, encode=lambda numbers: numbers):
    """Yield the blocks of ``rows``, kept, and the number of rows; ``encode`` changes a block's numbers, rows first."""
    numbers = vector_to_array("scaled") if shape.numbers else F.array().cast("array<double>")
    told = prepared.transform(rows).select(
        numbers.alias("numbers"), *[F.col(c).cast("int") for c in shape.indexed], F.col(label).cast("double").alias("labels")
    )
    kept = told.mapInArrow(_blocks(shape, encode), SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept, kept.agg(F.sum("n")).first()[0] or 0
    finally:
        kept.unpersist()


def reads(blocks):
    """Context for planning passes over ``blocks``: few blocks come to Python at once."""
    return _setting(blocks.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCKS_AT_ONCE))


def blocks_of(batch):
    """Dictionaries of one block each: bytes by column name."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        yield {c: v[i].as_py() if c == "n" else v[i].as_buffer() for c, v in zip(names, batch.columns)}


def summed(blocks, make, size):
    """The sum over all blocks of the arrays of ``size`` numbers that a task's function, made by ``make()``, returns."""

    def task(batches):
        total, of = np.zeros(size), make()
        for batch in batches:
            for block in blocks_of(batch):
                total += of(block)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    with reads(blocks):
        tasks = max(TASKS, 2 * blocks.sparkSession.sparkContext.defaultParallelism)
        found = blocks.coalesce(tasks).mapInArrow(task, "sums binary").collect()
    return np.sum([np.frombuffer(r["sums"]) for r in found], axis=0) if found else np.zeros(size)
