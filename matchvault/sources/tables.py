"""Named Parquet tables with swap-safe overwrite, dated snapshots and a load log.

A table is a folder of versions. An overwrite writes a new version next to the one being read and
readers take the newest version that has Spark's ``_SUCCESS`` marker, so ``new = f(old)`` may read and
replace one table, and a failed or lost job leaves the old version in force.
"""

import tempfile
import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F


class TableStore:
    """Tables under one root folder on a file system all executors share.

    Every write returns how many rows it wrote, counted by the write itself.
    """

    def __init__(self, spark, root):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, name):
        return f"{self.root}/{name.replace('.', '/')}"

    def _fs(self, path):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _children(self, folder):
        fs, path = self._fs(folder)
        if not fs.exists(path):
            return []
        return [s.getPath().getName() for s in fs.listStatus(path)]

    def _is_complete(self, folder):
        fs, path = self._fs(f"{folder}/_SUCCESS")
        return fs.exists(path)

    def _versions(self, name):
        folder = self._folder(name)
        numbers = [int(c[2:]) for c in self._children(folder) if c.startswith("v=")]
        return sorted(numbers)

    def _current(self, name):
        folder = self._folder(name)
        for number in reversed(self._versions(name)):
            if self._is_complete(f"{folder}/v={number}"):
                return number
        return None

    def exists(self, name):
        """Whether the table has a complete version; nothing else counts as a first load."""
        return self._current(name) is not None

    def read(self, name, schema=None):
        number = self._current(name)
        if number is None:
            raise LookupError(f"no such table: {name}")
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(f"{self._folder(name)}/v={number}")

    def read_or_none(self, name):
        return self.read(name) if self.exists(name) else None

    def count(self, name):
        """Rows of the table, read from file footers only."""
        return self.read(name).count()

    def overwrite(self, df, name, partition_by=()):
        """Write the next version of the table."""
        number = max(self._versions(name), default=0) + 1
        return self._write(df, f"{self._folder(name)}/v={number}", "errorifexists", partition_by)

    def append(self, df, name, partition_by=()):
        """Add rows to the version in force, or start the table."""
        number = self._current(name)
        if number is None:
            return self.overwrite(df, name, partition_by)
        return self._write(df, f"{self._folder(name)}/v={number}", "append", partition_by)

    def replace_partitions(self, df, name, partition_by):
        """Replace only the partitions that ``df`` holds, so a rerun of a batch adds nothing twice."""
        number = self._current(name)
        if number is None:
            return self.overwrite(df, name, partition_by)
        return self._write(
            df, f"{self._folder(name)}/v={number}", "overwrite", partition_by,
            partitionOverwriteMode="dynamic",
        )

    def _write(self, df, path, mode, partition_by, **options):
        written = Observation()
        out = df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**options)
        if partition_by:
            out = out.partitionBy(*partition_by)
        out.parquet(path)
        return written.get.get("rows", 0)

    def save_model(self, model, name):
        """Keep a fitted pipeline; the newest complete one is loaded."""
        number = max(self._versions(name), default=0) + 1
        model.write().save(f"{self._folder(name)}/v={number}")
        fs, marker = self._fs(f"{self._folder(name)}/v={number}/_SUCCESS")
        fs.create(marker, True).close()

    def load_model(self, name):
        from pyspark.ml import PipelineModel

        number = self._current(name)
        if number is None:
            raise LookupError(f"no such model: {name}")
        return PipelineModel.load(f"{self._folder(name)}/v={number}")

    def drop_old_versions(self, name, keep=2):
        """Delete versions older than the last ``keep`` complete ones."""
        folder = self._folder(name)
        done = [n for n in self._versions(name) if self._is_complete(f"{folder}/v={n}")]
        for number in done[:-keep] if keep else done:
            fs, path = self._fs(f"{folder}/v={number}")
            fs.delete(path, True)


def scratch_store(spark):
    """A store in a new folder under ``spark.checkpoint.dir``; under a local one only where that is unset in a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="store-")
    return TableStore(spark, f"{folder.rstrip('/')}/store-{uuid.uuid4().hex}")


SNAPSHOT = "snapshot_date"
LOG = "source.load_log"
LOG_SCHEMA = "table_name string, updated_at timestamp_ntz"


def stamp(df, load_ts, source):
    """Add load time and source."""
    return df.withColumns(
        {
            "_source_load_datetime": F.lit(load_ts).cast("timestamp_ntz"),
            "_source": F.lit(source),
        }
    )


def write_snapshot(store, df, name, ds, load_ts, source):
    """Keep the full extract of a day and log the load; a rerun of the day replaces it."""
    dated = stamp(df, load_ts, source).withColumn(SNAPSHOT, F.lit(ds).cast("date"))
    rows = store.replace_partitions(dated, name, [SNAPSHOT])
    line = store.spark.createDataFrame([(name, str(load_ts))], "table_name string, ts string")
    store.append(line.select("table_name", F.col("ts").cast("timestamp_ntz").alias("updated_at")), LOG)
    return rows


def read_snapshot(store, name, ds):
    """The extract of one day, read through the partition filter."""
    return store.read(name).filter(F.col(SNAPSHOT) == F.lit(ds).cast("date")).drop(SNAPSHOT)


def previous_load(log, name, ds):
    """Date of the last load before ``ds`` as a one-row frame; a rerun of the day is not its own past."""
    day = F.to_date("updated_at")
    return (
        log.filter((F.col("table_name") == F.lit(name)) & (day < F.lit(ds).cast("date")))
        .agg(F.max(day).alias("updated_on"))
        .filter(F.col("updated_on").isNotNull())
    )


def read_previous_snapshot(store, name, ds):
    """The extract before ``ds``, or None on the first load."""
    if not store.exists(LOG):
        return None
    row = previous_load(store.read(LOG), name, ds).first()
    return read_snapshot(store, name, row["updated_on"]) if row else None


def read_jdbc(spark, url, table, column=None, lower=None, upper=None, parts=None, **options):
    """A database table, read in parallel ranges of ``column`` where bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if column is not None:
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
        )
    return reader.load()


def write_jdbc(df, url, table, mode="overwrite", **options):
    """Write to a database; ``truncate`` keeps the table's definition on overwrite."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option(
        "truncate", "true"
    ).options(**options).mode(mode).save()
