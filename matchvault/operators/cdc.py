"""Change capture between snapshots, upserts and deletes by key."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

DELETED = "_source_is_deleted"
LOADED = "_source_load_datetime"
BATCH = "_batch_id"


def snapshot_delta(cur, prev, keys, compare, load_ts, batch_id, keys_unique=False):
    """Rows of ``cur`` that are new or changed, and rows of ``prev`` that are gone.

    A row counts as changed when its ``compare`` values are not among the values its key had before
    (NULL equals NULL). Gone rows are flagged ``"True"`` and stamped with the new load time. Without
    a previous snapshot every row is emitted. A NULL key equals no other: such a row of ``cur`` cannot
    be matched and is left out, one of ``prev`` counts as gone.

    ``keys_unique=True`` promises one row per key in each snapshot and takes one full outer join.
    Otherwise keys may repeat: values are first reduced per key on the map side, so a key holding a
    large share of the rows is never paired with itself.
    """
    batch = F.lit(batch_id).alias(BATCH)
    if prev is None:
        return cur.select("*", F.lit("False").alias(DELETED), batch)
    if keys_unique:
        return _delta_by_join(cur, prev, keys, compare, load_ts, batch)

    side = lambda df, name: df.select(*keys, *compare, F.lit(name).alias("_side"))
    only_now = (F.col("_first") == 1) & (F.col("_last") == 1)
    status = (
        side(cur, 1)
        .unionByName(side(prev, 2))
        .groupBy(*keys, *compare)
        .agg(F.min("_side").alias("_first"), F.max("_side").alias("_last"))
        .groupBy(*keys)
        .agg(F.max(only_now).alias("_changed"), F.min("_first").alias("_first"))
    )
    changed = cur.join(status.filter("_changed"), list(keys), "left_semi").withColumn(
        DELETED, F.lit("False")
    )
    gone = (
        prev.join(status.filter("_first = 1"), list(keys), "left_anti")
        .withColumn(LOADED, F.lit(load_ts).cast(cur.schema[LOADED].dataType))
        .withColumn(DELETED, F.lit("True"))
    )
    return changed.unionByName(gone).select(*cur.columns, DELETED, batch)


def _delta_by_join(cur, prev, keys, compare, load_ts, batch):
    c = cur.withColumn("_here", F.lit(True)).alias("c")
    p = prev.withColumn("_here", F.lit(True)).alias("p")
    # Plain equality keeps a partitioning by key that an input already has.
    on = [F.col(f"c.{k}") == F.col(f"p.{k}") for k in keys]
    gone = F.col("c._here").isNull()
    same = F.col("p._here").isNotNull()
    keyed = reduce(lambda a, b: a & b, [F.col(f"c.{k}").isNotNull() for k in keys])
    for name in compare:
        same = same & F.col(f"c.{name}").eqNullSafe(F.col(f"p.{name}"))
    stamped = F.lit(load_ts).cast(cur.schema[LOADED].dataType)
    old = {n: F.col(f"p.{n}") for n in cur.columns} | {LOADED: stamped}
    return (
        c.join(p, on, "full_outer")
        .filter(gone | (keyed & ~same))
        .select(
            *[F.when(gone, old[n]).otherwise(F.col(f"c.{n}")).alias(n) for n in cur.columns],
            F.when(gone, "True").otherwise("False").alias(DELETED),
            batch,
        )
    )


def latest_per_key(df, keys, order):
    """Newest row per key; ``order`` names columns compared descending, tie-breakers last.

    The filter on the row number lets Spark keep one row per key and task before the shuffle, so a
    key with very many rows sends few of them.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_per_key(df, keys, order):
    """Oldest row per key by ``order`` ascending."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert(target, changes, keys, order):
    """``target`` with ``changes`` written over it by key; the last change by ``order`` wins."""
    tagged = target.withColumn("_new", F.lit(0)).unionByName(
        changes.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(tagged, keys, ["_new", *order]).drop("_new")


def delete_by_key(target, gone, keys):
    """``target`` without the keys listed in ``gone``."""
    return target.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def nth_newest(df, by, value, n=2):
    """The ``n``-th newest distinct ``value`` per group; groups with fewer have no row."""
    w = Window.partitionBy(*by).orderBy(F.col(value).desc())
    return (
        df.select(*by, value)
        .distinct()
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= n)
        .filter(F.col("_rn") == n)
        .drop("_rn")
    )
