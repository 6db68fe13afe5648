"""Data Vault loads: standardised batches, hubs, SCD2 satellites, links, PIT tables, dimensions."""

from functools import reduce

from pyspark.sql import functions as F

from matchvault.functions.keys import data_hash
from matchvault.operators.cdc import DELETED, LOADED, latest_per_key
from matchvault.operators.scan import following, last_known, ordered_scan, previous

SOURCE = "_source"
REJECTED = "_rejected_for"
# Fixed value: the end of an interval that is still open.
OPEN_END = "2040-01-01 00:00:00"
# Partitions that a filter names; more of them are found by a join.
NAMED_PARTITIONS = 1000


def _open_end(df):
    return F.lit(OPEN_END).cast(df.schema["effective_from"].dataType)


def _flag(condition):
    return F.when(condition, "True").otherwise("False")


def standardise(df, mapping, **derived):
    """Project source names to target names and types, then add derived columns.

    ``mapping`` gives ``target: source`` or ``target: (source, type)``.
    """
    cols = []
    for target, source in mapping.items():
        name, type_ = source if isinstance(source, tuple) else (source, None)
        cols.append((F.col(name).cast(type_) if type_ else F.col(name)).alias(target))
    out = df.select(*cols)
    return out.withColumns(derived) if derived else out


def lookup_key(df, hub, business_key, on, key, as_):
    """Add the hub's surrogate ``key`` for the business key in ``on``, NULL where unknown.

    The hub is reduced to one row per business key first, so a repeated one cannot multiply rows.
    """
    small = hub.groupBy(F.col(business_key).alias("_bk")).agg(F.min(key).alias(as_))
    return df.join(small, df[on] == small["_bk"], "left").drop("_bk")


def checked(df, required, lookups=()):
    """Add ``_rejected_for``: why a row cannot be loaded, NULL for rows that can.

    ``required`` names columns without which a row has no place. ``lookups`` gives ``surrogate key: business key``, where
    ``lookup_key`` has left the surrogate NULL for a business key that the hub does not know. All reasons of a row are
    given. Both outputs come from one pass: write the checked rows once, then read ``admitted`` and ``rejected`` from it.
    """
    lookups = dict(lookups)
    gaps = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in [*required, *lookups.values()]]
    known = [
        F.when(F.col(k).isNull() & F.col(b).isNotNull(), F.concat(F.lit(f"{b} "), F.col(b).cast("string"), F.lit(" is unknown")))
        for k, b in lookups.items()
    ]
    why = F.concat_ws("; ", *gaps, *known)
    return df.withColumn(REJECTED, F.when(why != "", why))


def admitted(df):
    return df.filter(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected(df):
    """Rows kept apart, with the reason."""
    return df.filter(F.col(REJECTED).isNotNull())


def with_null_keys(df, keys):
    """Rows that cannot be linked because a key is missing."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def without_null_keys(df, keys):
    return df.dropna(subset=list(keys))


def hub_new(hub, batch, key, attrs):
    """Keys of the batch the hub does not have, with their earliest load time and its source."""
    first = F.min(F.struct(LOADED, SOURCE, *attrs)).alias("_first")
    new = (
        batch.groupBy(key)
        .agg(first)
        .select(key, *[F.col(f"_first.{c}").alias(c) for c in (*attrs, LOADED, SOURCE)])
    )
    return new if hub is None else new.join(hub.select(key), key, "left_anti")


def hub_load(hub, batch, key, attrs):
    """Insert-only hub: the hub and the new keys of the batch."""
    new = hub_new(hub, batch, key, attrs)
    return new if hub is None else hub.select(*new.columns).unionByName(new)


def scd2_merge(sat, increment, key, attrs, prefer=()):
    """Merge a batch into a type 2 satellite.

    ``increment`` has the key, ``attrs``, the deletion flag, load time and source. If a key comes
    twice with one load time, the row largest by ``prefer`` (then by content) is used. Closed rows
    pass through, as do open rows of keys the batch does not touch; the others are cut anew: a row
    whose attributes equal those of the row before belongs to the same version, an interval ends one
    second before the next starts. Batches are expected in time order: a closed row is not reopened.
    """
    columns = [key, *attrs, DELETED, "effective_from", SOURCE, "_data_hash"]
    batch = increment.select(
        key,
        *attrs,
        DELETED,
        F.col(LOADED).alias("effective_from"),
        SOURCE,
        data_hash(*attrs, DELETED).alias("_data_hash"),
        *[F.col(c).alias(f"_prefer_{c}") for c in prefer],
        F.lit(1).alias("_new"),
    )
    choose = ["_new", *[f"_prefer_{c}" for c in prefer], "_data_hash", SOURCE]
    if sat is None:
        return _versions(batch, key, attrs, columns, choose)
    keys = batch.select(key).distinct()
    is_open = sat.filter(F.col("is_active") == "True")
    kept = sat.filter(F.col("is_active") == "False").unionByName(
        is_open.join(keys, key, "left_anti")
    )
    touched = is_open.join(keys, key, "left_semi").select(*columns)
    merged = _versions(
        batch.unionByName(touched, allowMissingColumns=True), key, attrs, columns, choose
    )
    return kept.select(*merged.columns).unionByName(merged)


def _versions(rows, key, attrs, columns, choose):
    """Cut rows into versions. One exchange on the key serves all three windows."""
    scan = ordered_scan(rows, [key], ["effective_from"])
    if scan.split:
        # A large key may be many copies of one moment, which no cut divides: reduce them to one row
        # per task before they are brought together.
        rows = latest_per_key(rows, [key, "effective_from"], choose)
        scan = ordered_scan(rows, [key], ["effective_from"])
    one = scan.map(
        lambda df: latest_per_key(
            df.repartition(*scan.part), [*scan.part, "effective_from"], choose
        ).select(*dict.fromkeys([*columns, *scan.part]))
    )
    # Only the first row of a version matters: its attributes are those of all rows in it.
    starts = one.with_values(_before=previous("_data_hash")).map(
        lambda df: df.filter(F.col("_before").isNull() | (F.col("_before") != F.col("_data_hash")))
    )
    ended = starts.with_values(_next=following("effective_from")).rows()
    open_ = F.col("_next").isNull()
    return ended.select(
        key,
        *attrs,
        DELETED,
        "_data_hash",
        "effective_from",
        F.when(open_, _open_end(rows))
        .otherwise(F.col("_next") - F.expr("interval 1 second"))
        .alias("effective_to"),
        SOURCE,
        _flag(open_).alias("is_active"),
        version_key().alias("_version"),
    )


def version_key():
    """Version id of a satellite row."""
    return F.sha1(F.concat_ws("_", "_data_hash", F.col("effective_from").cast("string")))


def link_latest(df, keys, order):
    """Transactional link: the newest row per key; rows with a missing key are left out."""
    return latest_per_key(without_null_keys(df, keys), keys, order)


def link_merge(link, batch, keys, order):
    """Incremental link load: the newest row per key of the link and the batch."""
    rows = batch if link is None else link.unionByName(batch.select(*link.columns))
    return link_latest(rows, keys, order)


def link_partitions(link, batch, keys, order, by):
    """Incremental link load by partition: the rows of the partitions ``by`` that the batch falls into.

    ``by`` is a column that the keys determine, so that a key has one partition for good. The partitions of a batch
    are read by their names while there are at most ``NAMED_PARTITIONS``, and found by a join beyond that, so the driver
    never holds more names; the others are not returned.
    """
    if link is None:
        return link_latest(batch, keys, order)
    parts = batch.select(F.col(by).alias("_here")).distinct()
    here = [r[0] for r in parts.limit(NAMED_PARTITIONS + 1).collect()]
    if len(here) > NAMED_PARTITIONS:
        touched = link.join(parts, link[by].eqNullSafe(parts["_here"]), "left_semi")
    else:
        named = F.col(by).isin([v for v in here if v is not None])
        touched = link.filter(named | F.col(by).isNull() if None in here else named)
    return link_merge(touched, batch, keys, order)


def pit_increment(key, before, sats):
    """The open rows ``before`` of a point-in-time table brought forward over what the satellites added.

    ``before`` has one open interval per key, ``sats`` the versions that may have started since: those in force and
    those closed by the same batch. Keys without a newer version keep their row; of the others the open interval is
    cut at each newer start. Returned are all intervals open now and those this batch closed; older ones are not
    needed. Batches come in time order, as for ``scd2_merge``.
    """
    if before is None:
        return pit(key, sats)
    since = before.select(key, F.col("effective_from").alias("_since"))
    newer = {
        name: sat.join(since, key, "left")
        .filter(F.col("_since").isNull() | (F.col("effective_from") > F.col("_since")))
        .drop("_since")
        for name, sat in sats.items()
    }
    keys = reduce(lambda a, b: a.unionByName(b), [s.select(key) for s in newer.values()]).distinct()
    versions = [f"sat_{name}_version" for name in sats]
    points = before.join(keys, key, "left_semi").select(key, "effective_from", *versions)
    cut = pit(key, newer, points)
    return before.join(keys, key, "left_anti").select(*cut.columns).unionByName(cut)


def pit(key, sats, points=None):
    """Point-in-time table over the satellites in ``{name: satellite}``.

    Every start of a version in any satellite opens an interval that ends where the next one starts;
    ``sat_<name>_version`` is the version in force, carried forward over other satellites' changes. ``points`` are
    further starts whose versions are known: key, ``effective_from`` and the versions.
    """
    versions = [f"sat_{name}_version" for name in sats]
    parts = [] if points is None else [points]
    for name, sat in sats.items():
        here = [
            (F.col("_version") if v == f"sat_{name}_version" else F.lit(None).cast("string")).alias(v)
            for v in versions
        ]
        parts.append(sat.select(key, "effective_from", *here))
    union = reduce(lambda a, b: a.unionByName(b), parts)
    scan = ordered_scan(union, [key], ["effective_from"])
    # One exchange on the key serves the grid and both windows.
    grid = scan.map(
        lambda df: df.repartition(*scan.part)
        .groupBy(*scan.part, "effective_from")
        .agg(*[F.max(v).alias(v) for v in versions])
    )
    done = grid.with_values(
        _next=following("effective_from"), **{v: last_known(v) for v in versions}
    ).rows()
    return done.select(
        key,
        "effective_from",
        F.coalesce("_next", _open_end(union)).alias("effective_to"),
        *versions,
        _flag(F.col("_next").isNull()).alias("is_active"),
    )


def dimension(hub, pit_table, key, sats, hub_cols=()):
    """History view: hub, intervals of the PIT table, attributes of the version in force.

    ``sats`` is ``{name: (satellite, columns)}``, columns as names or ``(name, alias)``.
    """
    out = pit_table.join(hub.select(key, *hub_cols), key, "inner")
    cols = []
    for name, (sat, wanted) in sats.items():
        picked, names = [], []
        for c in wanted:
            source, alias = c if isinstance(c, tuple) else (c, c)
            picked.append(F.col(source).alias(alias))
            names.append(alias)
        version = f"sat_{name}_version"
        out = out.join(
            sat.select(key, F.col("_version").alias(version), *picked), [key, version], "left"
        )
        cols += names
    return out.select(key, *hub_cols, *cols, "effective_from", "effective_to", "is_active")


def current(dim, include_deleted=True):
    """Rows of a dimension in force now."""
    rows = dim.filter(F.col("is_active") == "True")
    return rows if include_deleted else rows.filter(F.col(DELETED) == "False")


def as_of(dim, ts):
    """Rows in force at ``ts``; intervals are closed at the start and open at the end."""
    at = F.lit(ts).cast(dim.schema["effective_from"].dataType)
    return dim.filter((F.col("effective_from") <= at) & (at < F.col("effective_to")))
