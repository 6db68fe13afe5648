"""Ordered scans: lag, lead, running sums and fills that survive a hot key.

A window over ``partitionBy(key).orderBy(...)`` puts every row of one key into one task. That is the
right plan while keys are small, so it is the plan used then. When a key has more rows than a task
should hold, its rows are cut into chunks at quantiles of the order columns, the window runs inside
``(key, chunk)``, and what earlier or later chunks contribute is carried in from one summary row per
chunk. The result is the same row for row; only the work per task is bounded.

Without keys the rows are range-partitioned by the order columns, and a chunk is a partition: no row is joined
with cut points, and the summaries of the partitions are summed up in order.

Sizes: a key of ``n`` rows gets ``n / rowsPerChunk`` chunks, however many keys are split and however many
chunks that makes. Cut points and carried summaries are tables with about one entry per chunk. They are
broadcast while their measured size allows (``BROADCAST_ROWS``, ``BROADCAST_BYTES``); beyond it they are
joined by key, where Spark divides skewed partitions at run time.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_CHUNK_CONF = "matchvault.scan.rowsPerChunk"
ROWS_PER_CHUNK = 2_000_000
BROADCAST_ROWS = 1 << 20
BROADCAST_BYTES = 64 << 20
SAMPLES_PER_CHUNK = 64

CHUNK = "_chunk"
TIE = "_tie"
_CUTS = "_cuts"


def _as_col(c):
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Value:
    """One windowed value: inside a chunk, its chunk summary, and how the summary is carried on."""

    local: callable  # (windows over the rows) -> Column
    summary: callable  # (order struct) -> aggregate Column
    carry: callable  # (summary Column, windows over the chunks) -> Column
    combine: callable  # (local, carried) -> Column
    finish: callable = lambda c: c


def _sum(expr, window):
    zero = lambda c: F.coalesce(c, F.lit(0))
    return Value(
        local=lambda w: zero(F.sum(_as_col(expr)).over(w[window])),
        summary=lambda order: F.sum(_as_col(expr)),
        carry=lambda s, w: zero(F.sum(s).over(w["before"])),
        combine=lambda local, carried: local + zero(carried),
    )


def sum_before(expr) -> Value:
    """Sum over the rows before this one, 0 at the start; NULLs count as nothing."""
    return _sum(expr, "before")


def sum_through(expr) -> Value:
    """Sum over the rows up to and including this one."""
    return _sum(expr, "through")


def previous(expr) -> Value:
    """Value on the row before, NULL on the first row."""
    boxed = F.struct(_as_col(expr).alias("v"))
    return Value(
        local=lambda w: F.lag(boxed).over(w["rows"]),
        summary=lambda order: F.max_by(boxed, order),
        carry=lambda s, w: F.lag(s).over(w["rows"]),
        combine=lambda local, carried: F.coalesce(local, carried),
        finish=lambda c: c["v"],
    )


def following(expr) -> Value:
    """Value on the row after, NULL on the last row."""
    boxed = F.struct(_as_col(expr).alias("v"))
    return Value(
        local=lambda w: F.lead(boxed).over(w["rows"]),
        summary=lambda order: F.min_by(boxed, order),
        carry=lambda s, w: F.lead(s).over(w["rows"]),
        combine=lambda local, carried: F.coalesce(local, carried),
        finish=lambda c: c["v"],
    )


def last_known(expr) -> Value:
    """Latest non-NULL value up to and including this row."""
    e = _as_col(expr)
    return Value(
        local=lambda w: F.last(e, ignorenulls=True).over(w["through"]),
        summary=lambda order: F.max_by(e, F.when(e.isNotNull(), order)),
        carry=lambda s, w: F.last(s, ignorenulls=True).over(w["before"]),
        combine=lambda local, carried: F.coalesce(local, carried),
    )


def next_known(expr) -> Value:
    """Earliest non-NULL value from this row on."""
    e = _as_col(expr)
    return Value(
        # Read backwards: a frame that ends at unbounded following is re-aggregated for every row.
        local=lambda w: F.last(e, ignorenulls=True).over(w["back_through"]),
        summary=lambda order: F.min_by(e, F.when(e.isNotNull(), order)),
        carry=lambda s, w: F.last(s, ignorenulls=True).over(w["back_before"]),
        combine=lambda local, carried: F.coalesce(local, carried),
    )


def _windows(part, order):
    rows = Window.partitionBy(*part).orderBy(*order)
    back = Window.partitionBy(*part).orderBy(*[F.col(o).desc() for o in order])
    start = Window.unboundedPreceding
    return {
        "rows": rows,
        "before": rows.rowsBetween(start, -1),
        "through": rows.rowsBetween(start, Window.currentRow),
        "back_before": back.rowsBetween(start, -1),
        "back_through": back.rowsBetween(start, Window.currentRow),
    }


@dataclass(frozen=True)
class OrderedScan:
    """Rows tagged for an ordered scan. ``part`` is what to group, repartition or window by."""

    df: DataFrame
    keys: tuple
    order: tuple
    split: bool
    small: bool = True  # the cut points were measured and fit a broadcast

    @property
    def part(self):
        return [*self.keys, CHUNK] if self.split else list(self.keys)

    def map(self, fn) -> "OrderedScan":
        """The same cut over derived rows; ``fn`` must keep the key, order and part columns."""
        df = fn(self.df)
        return replace(self, df=df, order=tuple(o for o in self.order if o != TIE or o in df.columns))

    def rows(self) -> DataFrame:
        return self.df.drop(CHUNK, TIE)

    def with_values(self, by=(), **values: Value) -> "OrderedScan":
        """Add one column per value, each within the keys and the columns ``by``.

        So one cut of the rows serves scans by different columns: within a chunk each of them is a sort and no exchange.
        """
        part = [*self.keys, *by, CHUNK] if self.split else [*self.keys, *by]
        w = _windows(part, self.order)
        local = self.df.withColumns({name: v.local(w) for name, v in values.items()})
        if not self.split:
            return replace(
                self, df=local.withColumns({n: v.finish(F.col(n)) for n, v in values.items()})
            )
        carried = self._carried(values, by)
        if by:
            carried = _written(carried)
            small = _fits_broadcast(*carried.agg(F.count(F.lit(1)), _text_size()).first())
        else:
            # One row per chunk, with keys as in the cut points; the values must have a known width too.
            small = self.small and all(_fixed_width(carried.schema[f"_carry_{n}"].dataType) for n in values)
        on = [local[k].eqNullSafe(carried[f"_c_{k}"]) for k in part]
        joined = local.join(F.broadcast(carried) if small else carried, on, "left")
        done = {
            n: v.finish(v.combine(F.col(n), F.col(f"_carry_{n}"))) for n, v in values.items()
        }
        return replace(self, df=joined.withColumns(done).select(*local.columns))

    def _carried(self, values, by=()):
        order = F.struct(*self.order)
        part = [*self.keys, *by, CHUNK]
        summaries = (
            self.df.filter(F.col(CHUNK).isNotNull())
            .groupBy(*part)
            .agg(*[v.summary(order).alias(n) for n, v in values.items()])
        )
        w = _windows([*self.keys, *by], [CHUNK])
        return summaries.select(
            *[F.col(k).alias(f"_c_{k}") for k in part],
            *[v.carry(F.col(n), w).alias(f"_carry_{n}") for n, v in values.items()],
        )


def ordered_scan(df: DataFrame, keys, order, rows_per_chunk=None) -> OrderedScan:
    """Prepare ``df`` for scans per ``keys`` in ascending ``order``.

    ``order`` should be a total order within a key. Rows that tie on all of it may come in any order,
    as in a window; more of them than a task should hold are divided too, at the price of a checkpoint.
    Runs one counting job (pre-aggregated per key on the map side), and a sampling job for cut points
    only if some key is too large for a task.
    """
    spark = df.sparkSession
    limit = int(rows_per_chunk or spark.conf.get(ROWS_PER_CHUNK_CONF, str(ROWS_PER_CHUNK)))
    keys, order = tuple(keys), tuple(order)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
    if sizes.isEmpty():
        return OrderedScan(df, keys, order, split=False)
    if not keys:
        return _ranged(df, order, limit, sizes.first()["_rows"])
    chunks = F.expr(f"(_rows + {limit - 1}) div {limit}").alias("_n")
    hot = _written(sizes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_rows", chunks))
    cuts = _cut_points(df, keys, order, hot)
    if not cuts.filter(F.size(F.array_distinct(_CUTS)) < F.size(_CUTS)).isEmpty():
        # Copies of one moment fill more than a chunk. Number the rows so that they can be divided,
        # and write the numbers down: all uses have to see the same ones.
        df = _written(df.withColumn(TIE, F.monotonically_increasing_id()))
        order = (*order, TIE)
        cuts = _cut_points(df, keys, order, hot)
    longest, total, size = cuts.agg(F.max(F.size(_CUTS)), F.sum(F.size(_CUTS) + 1), _text_size()).first()
    small = _fits_broadcast(total, size)
    on = [df[k].eqNullSafe(cuts[f"_k_{k}"]) for k in keys]
    tagged = df.join(F.broadcast(cuts) if small else cuts, on, "left")
    tagged = tagged.withColumn(CHUNK, _position(F.col(_CUTS), F.struct(*order), longest or 0))
    return OrderedScan(tagged.select(*df.columns, CHUNK), keys, order, split=True, small=small)


def _ranged(df, order, limit, rows):
    """A keyless scan cut into range partitions, written down so that all uses see the same ones.

    Rows that tie on the whole order fall into one partition; where that makes one too large for a task, the rows are
    numbered and the numbers take part in the order.
    """
    n = -(-rows // limit)

    def cut(frame, by):
        return _written(frame.repartitionByRange(n, *by).withColumn(CHUNK, F.spark_partition_id()))

    tagged = cut(df, order)
    largest = tagged.groupBy(CHUNK).count().agg(F.max("count")).first()[0]
    # Partitions follow a sample, so they may be somewhat larger than planned without a tie.
    if largest > 2 * limit:
        order = (*order, TIE)
        tagged = cut(_written(df.withColumn(TIE, F.monotonically_increasing_id())), order)
    # One summary row per partition, and as many partitions as the shuffle has.
    return OrderedScan(tagged, (), order, split=True, small=n <= BROADCAST_ROWS)


def _text_size():
    return F.sum(F.octet_length(F.to_json(F.struct("*"))))


def _fits_broadcast(rows, size):
    return (rows or 0) <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def _fixed_width(kind):
    if isinstance(kind, T.StructType):
        return all(_fixed_width(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))


def _written(df):
    """``df`` cut off from its lineage by a checkpoint in the folder the cluster shares."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def _cut_points(df, keys, order, hot):
    """One row per key of ``hot`` with its sorted cut points, written down so that all uses agree."""
    names = [f"_k_{k}" for k in keys]
    narrow = df.select(*dict.fromkeys([*keys, *order]))
    rate = F.least(F.lit(1.0), SAMPLES_PER_CHUNK * F.col("_n") / F.col("_rows"))
    plan = hot.withColumn("_p", rate).drop("_rows")
    if plan.count() <= BROADCAST_ROWS and all(_fixed_width(plan.schema[n].dataType) for n in names):
        plan = F.broadcast(plan)
    picked = narrow.join(plan, [narrow[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    # The sample only places the cuts; every row is still scanned.
    picked = picked.filter(F.rand(17) < F.col("_p"))
    w = Window.partitionBy(*names)
    slot = lambda rn: F.floor((rn - 1) * F.col("_n") / F.col("_size"))
    cuts = (
        picked.withColumn("_rn", F.row_number().over(w.orderBy(*order)))
        .withColumn("_size", F.count(F.lit(1)).over(w))
        .filter((F.col("_rn") > 1) & (slot(F.col("_rn")) != slot(F.col("_rn") - 1)))
        .groupBy(*names)
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias(_CUTS))
    )
    return _written(cuts)


def _position(cuts: Column, at: Column, longest: int) -> Column:
    """How many cut points are <= ``at``, by binary search; NULL for a key that has none."""
    powers = [1 << i for i in range(longest.bit_length(), -1, -1)]
    found = F.aggregate(
        F.array(*[F.lit(p) for p in powers]),
        F.lit(0),
        lambda pos, step: F.when(F.get(cuts, pos + step - 1) <= at, pos + step).otherwise(pos),
    )
    return F.when(cuts.isNotNull(), found)
