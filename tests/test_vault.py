import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchvault.functions import hash_key
from matchvault.operators import vault

BATCH = (
    "k int, a string, _source_is_deleted string, _source_load_datetime timestamp_ntz, _source string"
)
END = datetime(2040, 1, 1)


def day(d, hour=8):
    return datetime(2024, 1, d, hour)


def batch(spark, data):
    return spark.createDataFrame([(k, a, dele, t, "API") for k, a, t, dele in data], BATCH)


def live(spark, data):
    return batch(spark, [(*r, "False") for r in data])


SHOW = ["k", "a", "effective_from", "effective_to", "is_active"]


def test_versions_collapse_and_close(spark):
    """h1 h1 h2 h1: the first version spans two rows, the returning value is a version of its own."""
    got = vault.scd2_merge(
        None, live(spark, [(1, "x", day(1)), (1, "x", day(2)), (1, "y", day(3)), (1, "x", day(4))]), "k", ["a"]
    )
    second = timedelta(seconds=1)
    assert rows(got, *SHOW) == [
        (1, "x", day(1), day(3) - second, "False"),
        (1, "x", day(4), END, "True"),
        (1, "y", day(3), day(4) - second, "False"),
    ]
    assert got.select("_version").distinct().count() == 3


def test_incremental_equals_full(spark):
    rnd = random.Random(3)
    data = [
        (k, rnd.choice(["x", "y", None]), day(d), rnd.choice(["False", "False", "True"]))
        for k in range(12) for d in range(1, 21) if rnd.random() < 0.6
    ]
    full = vault.scd2_merge(None, batch(spark, data), "k", ["a"])
    sat = None
    for start in range(1, 21, 5):
        part = [r for r in data if start <= r[2].day < start + 5]
        sat = vault.scd2_merge(sat, batch(spark, part), "k", ["a"])
    assert rows(sat, *full.columns) == rows(full)
    check_intervals(sat)


def check_intervals(sat):
    by_key = {}
    for r in sat.collect():
        by_key.setdefault(r["k"], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r["effective_from"])
        assert [v["is_active"] for v in versions] == ["False"] * (len(versions) - 1) + ["True"]
        assert versions[-1]["effective_to"] == END
        for one, two in zip(versions, versions[1:]):
            assert one["effective_to"] + timedelta(seconds=1) == two["effective_from"]
            assert one["_data_hash"] != two["_data_hash"]


def test_replayed_batch_changes_nothing(spark):
    sat = vault.scd2_merge(None, live(spark, [(1, "x", day(1)), (2, "x", day(1))]), "k", ["a"])
    inc = live(spark, [(1, "y", day(2)), (3, "n", day(2))])
    once = vault.scd2_merge(sat, inc, "k", ["a"])
    twice = vault.scd2_merge(once, inc, "k", ["a"])
    assert rows(once) == rows(twice, *once.columns)


def test_untouched_keys_pass_through(spark):
    sat = vault.scd2_merge(None, live(spark, [(k, "x", day(1)) for k in range(5)]), "k", ["a"])
    got = vault.scd2_merge(sat, live(spark, [(2, "y", day(2))]), "k", ["a"])
    assert rows(got.filter("k <> 2")) == rows(sat.filter("k <> 2"), *got.columns)
    assert got.filter("k = 2").count() == 2


def test_delete_is_a_version_and_key_may_return(spark):
    got = vault.scd2_merge(
        None,
        batch(spark, [(1, "x", day(1), "False"), (1, "x", day(2), "True"), (1, "x", day(3), "False")]),
        "k",
        ["a"],
    )
    assert [r[0] for r in rows(got.orderBy("effective_from"), "_source_is_deleted")].count("True") == 1
    assert got.count() == 3


def test_two_rows_with_one_load_time_use_the_preferred_one(spark):
    inc = live(spark, [(1, "old", day(1)), (1, "new", day(1))]).withColumn(
        "date", F.when(F.col("a") == "new", 2).otherwise(1)
    )
    got = vault.scd2_merge(None, inc, "k", ["a"], prefer=["date"])
    assert rows(got, *SHOW) == [(1, "new", day(1), END, "True")]


def test_hot_key_versions(spark, small_chunks):
    data = [(1, "xy"[i // 3 % 2], day(1) + timedelta(minutes=i)) for i in range(400)]
    data += [(k, "x", day(1)) for k in range(2, 20)]
    got = vault.scd2_merge(None, live(spark, data), "k", ["a"])
    assert got.filter("k = 1").count() == 134
    check_intervals(got)


def test_copies_of_one_moment_are_reduced_before_the_shuffle(spark, small_chunks):
    data = [(1, "x", day(1))] * 300 + [(1, "y", day(2))] + [(2, "x", day(1))]
    got = vault.scd2_merge(None, live(spark, data), "k", ["a"])
    assert rows(got, "k", "a", "is_active") == [(1, "x", "False"), (1, "y", "True"), (2, "x", "True")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_hub_keeps_earliest_and_never_moves(spark):
    data = [(1, "b", day(3)), (1, "a", day(2)), (2, "c", day(2))]
    hub = vault.hub_load(None, live(spark, data), "k", [])
    assert rows(hub, "k", "_source_load_datetime") == [(1, day(2)), (2, day(2))]
    again = vault.hub_load(hub, live(spark, [(1, "z", day(5)), (3, "n", day(5))]), "k", ["a"][:0])
    assert rows(again, "k", "_source_load_datetime") == [(1, day(2)), (2, day(2)), (3, day(5))]


def test_links(spark):
    schema = "g int, h int, v int, t int"
    df = spark.createDataFrame([(1, 1, 2, 1), (1, 1, 2, 5), (1, 2, 1, 3), (2, None, 1, 9)], schema)
    link = vault.link_latest(df, ["g", "h", "v"], ["t"])
    assert rows(link) == [(1, 1, 2, 5), (1, 2, 1, 3)]
    assert rows(vault.with_null_keys(df, ["g", "h", "v"])) == [(2, None, 1, 9)]
    late = spark.createDataFrame([(1, 1, 2, 4), (1, 2, 1, 7)], schema)
    assert rows(vault.link_merge(link, late, ["g", "h", "v"], ["t"])) == [(1, 1, 2, 5), (1, 2, 1, 7)]
    assert vault.link_merge(None, df, ["g", "h", "v"], ["t"]).count() == 2


def test_lookup_key_does_not_multiply(spark):
    hub = spark.createDataFrame([("BOS", "id2"), ("BOS", "id1"), ("NYR", "id3")], "code string, id string")
    df = spark.createDataFrame([("BOS",), ("XXX",), (None,)], "team string")
    got = vault.lookup_key(df, hub, "code", "team", "id", "team_id")
    assert rows(got) == [(None, None), ("BOS", "id1"), ("XXX", None)]


def test_standardise(spark):
    df = spark.createDataFrame([(1, "7")], "gameId long, homeScore string")
    got = vault.standardise(
        df, {"game_source_id": ("gameId", "string"), "home_score": ("homeScore", "int")},
        game_id=hash_key("game_source_id", F.lit("API")),
    )
    assert got.columns == ["game_source_id", "home_score", "game_id"]
    assert got.first()["home_score"] == 7


@pytest.fixture
def two_sats(spark):
    one = vault.scd2_merge(None, live(spark, [(1, "x", day(1)), (1, "y", day(5)), (2, "q", day(2))]), "k", ["a"])
    other = live(spark, [(1, "m", day(3)), (1, "n", day(5)), (1, "o", day(7))])
    two = vault.scd2_merge(None, other.withColumnRenamed("a", "b"), "k", ["b"])
    return {"one": one, "two": two}


def check_dimension(spark, sats):
    hub = spark.createDataFrame([(1, "H1"), (2, "H2")], "k int, name string")
    pit = vault.pit("k", sats)
    dim = vault.dimension(hub, pit, "k", {"one": (sats["one"], ["a"]), "two": (sats["two"], ["b"])}, ["name"])
    assert rows(dim, "k", "a", "b", "effective_from", "effective_to", "is_active") == [
        (1, "x", None, day(1), day(3), "False"),
        (1, "x", "m", day(3), day(5), "False"),
        (1, "y", "n", day(5), day(7), "False"),
        (1, "y", "o", day(7), END, "True"),
        (2, "q", None, day(2), END, "True"),
    ]
    assert rows(vault.as_of(dim, "2024-01-05 08:00:00"), "k", "b") == [(1, "n"), (2, None)]
    assert rows(vault.current(dim), "k", "b") == [(1, "o"), (2, None)]


def test_pit_and_dimension_over_two_satellites(spark, two_sats):
    check_dimension(spark, two_sats)


def test_pit_with_split_keys(spark, two_sats):
    from matchvault.operators.scan import ROWS_PER_CHUNK_CONF

    spark.conf.set(ROWS_PER_CHUNK_CONF, "2")
    try:
        check_dimension(spark, two_sats)
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_CONF)


def test_current_can_leave_out_deleted(spark):
    sat = vault.scd2_merge(
        None, batch(spark, [(1, "x", day(1), "False"), (1, "x", day(2), "True"), (2, "x", day(1), "False")]), "k", ["a"]
    )
    assert vault.current(sat).count() == 2
    assert rows(vault.current(sat, include_deleted=False), "k") == [(2,)]


def test_scd2_plan_has_one_exchange(spark):
    df = live(spark, [(1, "x", day(1))]).coalesce(1)
    text = vault.scd2_merge(None, df, "k", ["a"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in text and "Python" not in text


def test_many_link_partitions_are_joined_not_listed(spark):
    """More partitions than a filter should name: the plan holds none of them, and NULL is a partition too."""
    n = 3 * vault.NAMED_PARTITIONS
    part = F.when(F.col("k") % n > 0, F.col("k") % n).alias("part")
    link = spark.range(2 * n).select(F.col("id").alias("k"), F.lit(1).alias("t")).select("*", part)
    batch = link.filter("k < 1500").withColumn("t", F.lit(2)).select(*link.columns)
    got = vault.link_partitions(link, batch, ["k"], ["t"], "part")
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 5000
    assert rows(got, "k", "t") == rows(link.filter(f"k % {n} < 1500").selectExpr("k", "IF(k < 1500, 2, 1) AS t"))
    few = batch.filter("k < 3")
    assert rows(vault.link_partitions(link, few, ["k"], ["t"], "part"), "k", "t") == rows(
        link.filter(f"k % {n} < 3").selectExpr("k", "IF(k < 3, 2, 1) AS t")
    )
