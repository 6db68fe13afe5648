import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchvault.operators.scan import (
    CHUNK,
    following,
    last_known,
    next_known,
    ordered_scan,
    previous,
    sum_before,
    sum_through,
)


def wanted():
    return dict(
        n=sum_before(F.lit(1)),
        s=sum_through("v"),
        back=previous("v"),
        ahead=following("v"),
        known=last_known("v"),
        upcoming=next_known("v"),
    )


def data(size, seed):
    """A third of the rows under one key, some under NULL, the rest spread."""
    rnd = random.Random(seed)
    out = []
    for i in range(size):
        key = 1 if i % 3 == 0 else None if i % 7 == 0 else rnd.randrange(2, 40)
        t = None if i % 11 == 0 else rnd.randrange(size // 4)
        out.append((key, t, i, None if rnd.random() < 0.4 else rnd.randrange(9)))
    rnd.shuffle(out)
    return out


def brute(raw, keyed):
    groups = {}
    for r in raw:
        groups.setdefault(r[0] if keyed else 0, []).append(r)
    out = []
    for group in groups.values():
        group.sort(key=lambda r: (r[1] is not None, r[1], r[2]) if r[1] is not None else (False, 0, r[2]))
        vs = [r[3] for r in group]
        for i, r in enumerate(group):
            out.append(
                (
                    *r, i, sum(v or 0 for v in vs[: i + 1]),
                    vs[i - 1] if i else None,
                    vs[i + 1] if i + 1 < len(vs) else None,
                    next((v for v in reversed(vs[: i + 1]) if v is not None), None),
                    next((v for v in vs[i:] if v is not None), None),
                )
            )
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("limit", [10**9, 100, 7])
def test_scan_matches_brute_force(spark, keyed, limit):
    raw = data(900, 5)
    df = spark.createDataFrame(raw, "k int, t int, id int, v int").repartition(5)
    scan = ordered_scan(df, ["k"] if keyed else [], ["t", "id"], rows_per_chunk=limit)
    assert scan.split == (limit < 900)
    assert rows(scan.with_values(**wanted()).rows()) == brute(raw, keyed)


def test_hot_key_is_split_into_bounded_chunks(spark):
    raw = data(3000, 6)
    df = spark.createDataFrame(raw, "k int, t int, id int, v int")
    scan = ordered_scan(df, ["k"], ["t", "id"], rows_per_chunk=100)
    sizes = scan.df.groupBy("k", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 250
    assert sizes.filter("k = 1").count() >= 8
    whole = sizes.filter("_chunk IS NULL").select("k").distinct().count()
    assert whole > 10  # small keys stay whole


@pytest.mark.parametrize("keyed", [True, False])
def test_copies_of_one_row_are_divided(spark, keyed):
    raw = [(1, 5, 0, 2)] * 600 + data(300, 8)
    df = spark.createDataFrame(raw, "k int, t int, id int, v int").repartition(6)
    scan = ordered_scan(df, ["k"] if keyed else [], ["t", "id"], rows_per_chunk=50)
    assert rows(scan.with_values(**wanted()).rows()) == brute(raw, keyed)
    sizes = scan.df.groupBy(*(["k"] if keyed else []), "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 150


def test_empty_input(spark):
    df = spark.createDataFrame([], "k int, t int, v int")
    assert rows(ordered_scan(df, ["k"], ["t"]).with_values(n=sum_before("v")).rows()) == []


def test_no_python_and_one_exchange_when_nothing_is_hot(spark):
    df = spark.createDataFrame(data(300, 7), "k int, t int, id int, v int")
    plan = ordered_scan(df, ["k"], ["t", "id"]).with_values(**wanted()).rows()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "Python" not in text


def test_any_number_of_hot_keys_is_split(spark):
    """More keys above the limit than any fixed number of split keys: each chunk stays within the limit."""
    df = spark.range(15_000).selectExpr("id % 5000 AS k", "id AS t", "id % 7 AS v")
    scan = ordered_scan(df, ["k"], ["t"], rows_per_chunk=2)
    assert scan.split and scan.df.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0] <= 2
    values = dict(n=sum_before(F.lit(1)), s=sum_through("v"), back=previous("v"))
    plain = ordered_scan(df, ["k"], ["t"]).with_values(**values).rows()
    assert rows(scan.with_values(**values).rows()) == rows(plain)


@pytest.mark.parametrize("keys", [["k"], []])
def test_split_without_broadcast(spark, monkeypatch, keys):
    """Cut points too large for a broadcast are joined by key, with the same result."""
    from matchvault.operators import scan as module

    df = spark.range(600).selectExpr("IF(id % 3 = 0, 'hot', cast(id % 50 AS string)) AS k", "id AS t", "cast(id % 7 AS string) AS v")
    values = dict(back=previous("v"), known=last_known("v"))
    plain = rows(ordered_scan(df, keys, ["t"]).with_values(**values).rows())
    monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    scan = ordered_scan(df, keys, ["t"], rows_per_chunk=20)
    assert scan.split and not scan.small
    assert rows(scan.with_values(**values).rows()) == plain


def test_keyless_scan_over_range_partitions(spark):
    """No nested loop, every chunk within bounds, ties divided, nulls first: the same values as one window."""
    for distinct in (4000, 7):
        df = spark.range(4000).select(
            "id", F.when(F.col("id") % 50 != 0, F.col("id") * 7919 % distinct).alias("at"), (F.col("id") % 13).alias("v")
        )
        order = ["at", "id"] if distinct > 7 else ["at"]
        scanned = ordered_scan(df, [], order, rows_per_chunk=100)
        assert scanned.split and scanned.df.groupBy(CHUNK).count().agg(F.max("count")).first()[0] <= 200
        out = scanned.with_values(total=sum_through("v"), first=previous("id")).rows()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
        got = out.collect()
        assert len(got) == 4000 and max(r.total for r in got) == sum(r.v for r in got)
        if distinct > 7:
            seen = 0
            for i, r in enumerate(sorted(got, key=lambda r: (r["at"] is not None, r["at"] or 0, r.id))):
                seen += r.v
                assert r.total == seen and (r["first"] is None) == (i == 0)
