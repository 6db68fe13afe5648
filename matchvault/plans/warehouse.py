"""Warehouse loads over the tables at hand."""

from pyspark.sql import functions as F

from matchvault.functions import data_hash, hash_key, mmss_to_seconds
from matchvault.operators import cdc, vault
from matchvault.plans import fixtures as fx
from matchvault.plans.registry import query, table
from matchvault.sources.tables import scratch_store
from matchvault.sources.landing import json_field

COMPARE = ["c_name", "c_mktsegment", "priority", "status"]


@query(
    "snapshot_delta",
    "WITH"
    + fx.SNAPSHOTS_SQL
    + """
SELECT cur.*, 'False' AS _source_is_deleted, '1998-05-02' AS _batch_id
FROM cur WHERE id IN (SELECT id FROM (
  SELECT id, c_name, c_mktsegment, priority, status FROM cur
  EXCEPT SELECT id, c_name, c_mktsegment, priority, status FROM prev))
UNION ALL
SELECT prev.* REPLACE (TIMESTAMP '1998-05-02 08:00:00' AS _source_load_datetime), 'True', '1998-05-02'
FROM prev WHERE id NOT IN (SELECT id FROM cur)""",
)
def snapshot_delta(spark, sf_dir):
    cur, prev = fx.customer_snapshots(spark, sf_dir)
    return cdc.snapshot_delta(
        cur, prev, ["id"], COMPARE, "1998-05-02 08:00:00", "1998-05-02", keys_unique=True
    )


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_SPLIT = "1998-06-01"


def _line_extracts(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        "l_returnflag",
        "l_linestatus",
        F.lit("1998-06-02 08:00:00").cast("timestamp_ntz").alias("_source_load_datetime"),
        "l_shipdate",
    )
    old = F.col("l_shipdate") < F.lit(LINE_SPLIT).cast("timestamp_ntz")
    return line.filter(~old).drop("l_shipdate"), line.filter(old).drop("l_shipdate")


@query(
    "snapshot_delta_repeated_keys",
    f"""
WITH lines AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
                      TIMESTAMP '1998-06-02 08:00:00' AS _source_load_datetime, l_shipdate FROM lineitem),
cur AS (SELECT * EXCLUDE (l_shipdate) FROM lines WHERE l_shipdate >= TIMESTAMP '{LINE_SPLIT}'),
prev AS (SELECT * EXCLUDE (l_shipdate) FROM lines WHERE l_shipdate < TIMESTAMP '{LINE_SPLIT}'),
changed AS (SELECT DISTINCT l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM cur
  EXCEPT SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM prev))
SELECT cur.*, 'False' AS _source_is_deleted, '1998-06-02' AS _batch_id FROM cur
SEMI JOIN changed USING (l_orderkey, l_linenumber)
UNION ALL
SELECT prev.*, 'True', '1998-06-02' FROM prev ANTI JOIN cur USING (l_orderkey, l_linenumber)""",
)
def snapshot_delta_repeated_keys(spark, sf_dir):
    cur, prev = _line_extracts(spark, sf_dir)
    return cdc.snapshot_delta(
        cur, prev, LINE_KEY, ["l_returnflag", "l_linestatus"], "1998-06-02 08:00:00", "1998-06-02"
    )


@query(
    "snapshot_full_first_load",
    "WITH"
    + fx.SNAPSHOTS_SQL
    + " SELECT *, 'False' AS _source_is_deleted, '1998-05-02' AS _batch_id FROM cur",
)
def snapshot_full_first_load(spark, sf_dir):
    cur, _ = fx.customer_snapshots(spark, sf_dir)
    return cdc.snapshot_delta(cur, None, ["id"], COMPARE, "1998-05-02 08:00:00", "1998-05-02")


@query(
    "penultimate_load",
    """
SELECT event_type, strftime(day, '%Y-%m-%d') AS day FROM (
  SELECT event_type, day, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) rn
  FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM events)) WHERE rn = 2""",
)
def penultimate_load(spark, sf_dir):
    days = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"))
    found = cdc.nth_newest(days, ["event_type"], "day", 2)
    return found.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "standardise_hash_keys",
    """
SELECT s_suppkey AS supplier_source_id, s_name AS supplier_name, s_nationkey AS team_source_id,
       sha1(concat_ws('_', s_suppkey, 'SRC')) AS supplier_id,
       concat_ws('_', s_suppkey, 'SRC') AS supplier_business_id,
       sha1(concat_ws(chr(31), s_name, CAST(s_nationkey AS VARCHAR))) AS data_hash,
       n_name AS team_name, sha1(concat_ws('_', n_nationkey, 'SRC')) AS team_id
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def standardise_hash_keys(spark, sf_dir):
    batch = vault.standardise(
        table(spark, sf_dir, "supplier"),
        {
            "supplier_source_id": ("s_suppkey", "bigint"),
            "supplier_name": "s_name",
            "team_source_id": "s_nationkey",
        },
        supplier_id=hash_key("supplier_source_id", F.lit("SRC")),
        supplier_business_id=F.concat_ws("_", "supplier_source_id", F.lit("SRC")),
        data_hash=data_hash("supplier_name", "team_source_id"),
    )
    hub = _team_hub(spark, sf_dir)
    named = vault.lookup_key(
        batch, hub, "team_source_id", "team_source_id", "team_name", "team_name"
    )
    return vault.lookup_key(named, hub, "team_source_id", "team_source_id", "team_id", "team_id")


def _team_hub(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("team_source_id"),
        F.col("n_name").alias("team_name"),
        hash_key("n_nationkey", F.lit("SRC")).alias("team_id"),
    )


@query(
    "two_role_key_lookup",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       sha1(concat_ws('_', s_nationkey, 'SRC')) AS team_id,
       sha1(concat_ws('_', c_nationkey, 'SRC')) AS opponent_team_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
JOIN customer ON o_custkey = c_custkey WHERE s_nationkey <> c_nationkey""",
)
def two_role_key_lookup(spark, sf_dir):
    hub = _team_hub(spark, sf_dir)
    games = fx.pairings(spark, sf_dir).select(
        *fx.MATCH_KEY, "home_team_code", "visiting_team_code"
    )
    one = vault.lookup_key(games, hub, "team_source_id", "home_team_code", "team_id", "team_id")
    two = vault.lookup_key(
        one, hub, "team_source_id", "visiting_team_code", "team_id", "opponent_team_id"
    )
    return two.drop("home_team_code", "visiting_team_code")


# Teams that the hub does not know yet, and the status under which the extract names no team.
UNKNOWN_REGION, NAMELESS = 3, "P"


@query(
    "quarantine_unknown_keys",
    f"""
SELECT o_orderkey, c_nationkey, CASE WHEN n_nationkey IS NOT NULL THEN sha1(concat_ws('_', c_nationkey, 'SRC')) END AS team_id,
       n_nationkey IS NOT NULL AS loaded,
       CASE WHEN c_nationkey IS NULL THEN 'c_nationkey is missing'
            WHEN n_nationkey IS NULL THEN 'c_nationkey ' || c_nationkey || ' is unknown' END AS _rejected_for
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> '{NAMELESS}' THEN c_nationkey END AS c_nationkey
      FROM orders JOIN customer ON o_custkey = c_custkey) AS log
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> {UNKNOWN_REGION}) AS hub ON c_nationkey = n_nationkey""",
)
def quarantine_unknown_keys(spark, sf_dir):
    """A load whose hub lacks a region's teams: rows written once, then what was loaded and what was kept apart."""
    store = scratch_store(spark)
    known = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") != UNKNOWN_REGION)
    hub = known.select("n_nationkey", hash_key("n_nationkey", F.lit("SRC")).alias("team_key"))
    team = F.when(F.col("o_orderstatus") != NAMELESS, F.col("c_nationkey")).alias("c_nationkey")
    customers = table(spark, sf_dir, "customer")
    log = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", team)
    keyed = vault.lookup_key(log, hub, "n_nationkey", "c_nationkey", "team_key", "team_id")
    store.overwrite(vault.checked(keyed, ["o_orderkey"], {"team_id": "c_nationkey"}), "operational.log")
    batch = store.read("operational.log")
    loaded = vault.admitted(batch).withColumns({"loaded": F.lit(True), "_rejected_for": F.lit(None).cast("string")})
    return loaded.unionByName(vault.rejected(batch).withColumn("loaded", F.lit(False)))


@query(
    "hub_load",
    """
SELECT user_id, ts AS _source_load_datetime, 'API_' || event_type AS _source FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) rn FROM events) WHERE rn = 1""",
)
def hub_load(spark, sf_dir):
    early, late = fx.before_after(fx.user_batch(spark, sf_dir))
    return vault.hub_load(vault.hub_load(None, early, "user_id", []), late, "user_id", [])


SAT_SQL = "WITH" + fx.SAT_TYPE_SQL + " SELECT * FROM sat_type"


@query("scd2_satellite", SAT_SQL)
def scd2_satellite(spark, sf_dir):
    return vault.scd2_merge(None, fx.user_batch(spark, sf_dir), "user_id", ["event_type"])


@query("scd2_incremental", SAT_SQL)
def scd2_incremental(spark, sf_dir):
    early, late = fx.before_after(fx.user_batch(spark, sf_dir))
    first = vault.scd2_merge(None, early, "user_id", ["event_type"])
    return vault.scd2_merge(first, late, "user_id", ["event_type"])


LINK_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) rn FROM lineitem) WHERE rn = 1"""
LINK_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


def _link_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*fx.MATCH_KEY, "l_shipdate")


@query("link_latest", LINK_SQL)
def link_latest(spark, sf_dir):
    return vault.link_latest(_link_rows(spark, sf_dir), LINE_KEY, LINK_ORDER)


@query("link_merge", LINK_SQL)
def link_merge(spark, sf_dir):
    rows = _link_rows(spark, sf_dir)
    old = F.col("l_shipdate") < F.lit(LINE_SPLIT).cast("timestamp_ntz")
    link = vault.link_latest(rows.filter(old), LINE_KEY, LINK_ORDER)
    return vault.link_merge(link, rows.filter(~old), LINE_KEY, LINK_ORDER)


@query("link_by_partition", LINK_SQL)
def link_by_partition(spark, sf_dir):
    """Two loads, the second returning only the partitions it touches: here of ten orders each."""
    rows = _link_rows(spark, sf_dir).withColumn("_part", F.expr("l_orderkey div 10"))
    old = F.col("l_shipdate") < F.lit(LINE_SPLIT).cast("timestamp_ntz")
    first = vault.link_partitions(None, rows.filter(old), LINE_KEY, LINK_ORDER, "_part")
    second = vault.link_partitions(first, rows.filter(~old), LINE_KEY, LINK_ORDER, "_part")
    untouched = first.join(rows.filter(~old).select("_part").distinct(), "_part", "left_anti")
    return untouched.unionByName(second).drop("_part")


def _sats(spark, sf_dir):
    batch = fx.user_batch(spark, sf_dir)
    return {
        "type": vault.scd2_merge(None, batch, "user_id", ["event_type"]),
        "band": vault.scd2_merge(None, batch, "user_id", ["band"]),
    }


@query("pit_table", "WITH" + fx.PIT_SQL + " SELECT * FROM pit")
def pit_table(spark, sf_dir):
    return vault.pit("user_id", _sats(spark, sf_dir))


DIMENSION_SQL = (
    "WITH"
    + fx.PIT_SQL
    + """,
dim AS (
  SELECT p.user_id, h.first_seen, t.event_type, t._source_is_deleted, b.band,
         p.effective_from, p.effective_to, p.is_active
  FROM pit p JOIN (SELECT user_id, min(ts) AS first_seen FROM events GROUP BY user_id) h
    ON h.user_id = p.user_id
  LEFT JOIN sat_type t ON t.user_id = p.user_id AND t._version = p.sat_type_version
  LEFT JOIN sat_band b ON b.user_id = p.user_id AND b._version = p.sat_band_version
)"""
)


def _dimension(spark, sf_dir):
    hub = vault.hub_load(None, fx.user_batch(spark, sf_dir), "user_id", [])
    hub = hub.withColumnRenamed("_source_load_datetime", "first_seen")
    sats = _sats(spark, sf_dir)
    return vault.dimension(
        hub, vault.pit("user_id", sats), "user_id",
        {"type": (sats["type"], ["event_type", "_source_is_deleted"]), "band": (sats["band"], ["band"])},
        ["first_seen"],
    )


def _pit_by_batch(spark, sf_dir):
    """Intervals closed by the first of two batches, then those closed by the second or open, each with the versions
    that its batch had to read: the open ones and those it closed itself."""
    early, late = fx.before_after(fx.user_batch(spark, sf_dir))
    attributes = {"type": "event_type", "band": "band"}
    first = {n: vault.scd2_merge(None, early, "user_id", [a]) for n, a in attributes.items()}
    is_open = F.col("is_active") == "True"
    second = {n: vault.scd2_merge(first[n].filter(is_open), late, "user_id", [a]) for n, a in attributes.items()}
    before = vault.pit("user_id", first)
    after = vault.pit_increment("user_id", before.filter(is_open), second)
    return [(before.filter(~is_open), first), (after, second)]


@query("pit_incremental", "WITH" + fx.PIT_SQL + " SELECT * FROM pit")
def pit_incremental(spark, sf_dir):
    (closed, _), (rest, _) = _pit_by_batch(spark, sf_dir)
    return closed.unionByName(rest)


@query("dimension_incremental", DIMENSION_SQL + " SELECT * FROM dim")
def dimension_incremental(spark, sf_dir):
    hub = vault.hub_load(None, fx.user_batch(spark, sf_dir), "user_id", [])
    hub = hub.withColumnRenamed("_source_load_datetime", "first_seen")
    views = [
        vault.dimension(
            hub, intervals, "user_id",
            {"type": (sats["type"], ["event_type", "_source_is_deleted"]), "band": (sats["band"], ["band"])},
            ["first_seen"],
        )
        for intervals, sats in _pit_by_batch(spark, sf_dir)
    ]
    return views[0].unionByName(views[1])


@query("dimension_view", DIMENSION_SQL + " SELECT * FROM dim")
def dimension_view(spark, sf_dir):
    return _dimension(spark, sf_dir)


@query("dimension_current", DIMENSION_SQL + " SELECT * FROM dim WHERE is_active = 'True'")
def dimension_current(spark, sf_dir):
    return vault.current(_dimension(spark, sf_dir), include_deleted=False)


@query(
    "dimension_as_of",
    DIMENSION_SQL
    + " SELECT * FROM dim WHERE effective_from <= TIMESTAMP '2024-01-15'"
    " AND effective_to > TIMESTAMP '2024-01-15'",
)
def dimension_as_of(spark, sf_dir):
    return vault.as_of(_dimension(spark, sf_dir), "2024-01-15 00:00:00")


@query(
    "json_landing",
    """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k,
       coalesce(json_extract_string(props, '$.name'), '') AS name FROM events""",
)
def json_landing(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", json_field("props", "k").alias("k"), json_field("props", "name").alias("name")
    )


@query(
    "upsert_latest",
    """
SELECT user_id, event_type, event_id, value, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) rn
  FROM events) WHERE rn = 1""",
)
def upsert_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    early = F.col("ts") < F.lit(fx.MID_MONTH).cast("timestamp_ntz")
    keys = ["user_id", "event_type"]
    target = cdc.latest_per_key(rows.filter(early), keys, ["ts", "event_id"])
    return cdc.upsert(target, rows.filter(~early), keys, ["ts", "event_id"])


@query(
    "delete_by_key",
    """
SELECT event_id, user_id, event_type, value FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error'
                      AND ts >= TIMESTAMP '2024-01-25')""",
)
def delete_by_key(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    gone = rows.filter(
        (F.col("event_type") == "error")
        & (F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz"))
    )
    return cdc.delete_by_key(rows.drop("ts"), gone, ["user_id"])


@query(
    "time_on_ice_seconds",
    f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {fx.TOI_SQL} AS toi FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN len(string_split(toi, ':')) = 2 THEN coalesce(
         TRY_CAST(split_part(toi, ':', 1) AS BIGINT) * 60 + TRY_CAST(split_part(toi, ':', 2) AS BIGINT), 0)
       ELSE 0 END AS toi
FROM t""",
)
def time_on_ice_seconds(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *fx.MATCH_KEY, mmss_to_seconds(fx.toi_text()).alias("toi")
    )


