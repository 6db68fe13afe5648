import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchvault.operators import cdc

SCHEMA = "id int, a string, b int, _source_load_datetime string, _source string"


def snap(spark, data, loaded):
    return spark.createDataFrame([(*r, loaded, "API") for r in data], SCHEMA)


PREV = [(1, "x", 1), (2, "x", 1), (3, None, 1), (4, "x", None), (5, None, None), (6, "gone", 1)]
CUR = [(1, "x", 1), (2, "y", 1), (3, "x", 1), (4, None, None), (5, None, None), (7, "new", 1)]
WANT = [(2, "False", "d2"), (3, "False", "d2"), (4, "False", "d2"), (6, "True", "d2"), (7, "False", "d2")]


@pytest.mark.parametrize("unique", [True, False])
def test_new_changed_deleted(spark, unique):
    got = cdc.snapshot_delta(
        snap(spark, CUR, "d2"), snap(spark, PREV, "d1"), ["id"], ["a", "b"], "d2", "2024-01-02", unique
    )
    assert rows(got, "id", cdc.DELETED, cdc.LOADED) == WANT
    assert rows(got.filter("id = 6"), "a", "_batch_id") == [("gone", "2024-01-02")]


@pytest.mark.parametrize("unique", [True, False])
def test_delta_applied_to_previous_gives_current(spark, unique):
    cur, prev = snap(spark, CUR, "d2"), snap(spark, PREV, "d1")
    delta = cdc.snapshot_delta(cur, prev, ["id"], ["a", "b"], "d2", "b", unique)
    live = delta.filter(F.col(cdc.DELETED) == "False").select("id", "a", "b")
    rebuilt = prev.join(delta.select("id"), "id", "left_anti").select("id", "a", "b").unionByName(live)
    assert rows(rebuilt) == rows(cur, "id", "a", "b")


@pytest.mark.parametrize("unique", [True, False])
def test_same_snapshot_and_null_keys(spark, unique):
    cur, prev = snap(spark, CUR, "d2"), snap(spark, CUR, "d1")
    assert cdc.snapshot_delta(cur, prev, ["id"], ["a", "b"], "d2", "b", unique).count() == 0
    cur, prev = snap(spark, [(None, "x", 1)], "d2"), snap(spark, [(None, "y", 1)], "d1")
    got = cdc.snapshot_delta(cur, prev, ["id"], ["a", "b"], "d2", "b", unique)
    assert rows(got, "a", cdc.DELETED) == [("y", "True")]


def test_first_load_and_empty_previous(spark):
    cur = snap(spark, CUR, "d2")
    assert cdc.snapshot_delta(cur, None, ["id"], ["a"], "d2", "b").count() == len(CUR)
    empty = snap(spark, [], "d1")
    assert cdc.snapshot_delta(cur, empty, ["id"], ["a"], "d2", "b", True).count() == len(CUR)


def test_repeated_keys_do_not_multiply(spark):
    """A player listed twice: changed if any of the listed values is new, each row emitted once."""
    prev = snap(spark, [(1, "x", 1), (1, "y", 1), (2, "x", 1), (2, "x", 1), (3, "x", 1), (3, "x", 1)], "d1")
    cur = snap(spark, [(1, "y", 1), (1, "z", 1), (1, "w", 1), (2, "x", 1)] + [(4, "n", 1)] * 50, "d2")
    got = cdc.snapshot_delta(cur, prev, ["id"], ["a", "b"], "d2", "b")
    counts = {(r["id"], r[cdc.DELETED]): r["count"] for r in got.groupBy("id", cdc.DELETED).count().collect()}
    assert counts == {(1, "False"): 3, (3, "True"): 2, (4, "False"): 50}


def test_upsert_and_delete(spark):
    target = spark.createDataFrame([(1, 1, "old", 5), (1, 2, "keep", 1)], "u int, g int, v string, t int")
    changes = spark.createDataFrame(
        [(1, 1, "first", 1), (1, 1, "last", 2), (2, 1, "new", 1)], "u int, g int, v string, t int"
    )
    got = cdc.upsert(target, changes, ["u", "g"], ["t"])
    assert rows(got, "u", "g", "v") == [(1, 1, "last"), (1, 2, "keep"), (2, 1, "new")]
    gone = spark.createDataFrame([(1,), (1,), (9,)], "u int")
    assert rows(cdc.delete_by_key(got, gone, ["u"]), "u", "v") == [(2, "new")]


def test_nth_newest(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("a", 2), ("b", 9)], "k string, d int")
    assert rows(cdc.nth_newest(df, ["k"], "d", 2)) == [("a", 2)]


def test_latest_keeps_one_row_per_key_and_task_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = cdc.latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
