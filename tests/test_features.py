import random
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchvault.operators import features, profile

GAMES = "id int, t int, season int, home_team_code string, visiting_team_code string, home_team_winner int"


def games(spark):
    return spark.createDataFrame(
        [
            (1, 1, 1, "A", "B", 1),
            (2, 2, 1, "A", "C", 0),
            (3, 2, 1, "A", "B", 1),  # same time as 2: the key decides
            (4, 3, 1, "A", "B", None),  # not played
            (5, 4, 1, "B", "A", 1),
            (6, 5, 2, "A", "B", 1),  # a new season starts from nothing
        ],
        GAMES,
    )


def test_home_form_sees_only_the_past(spark):
    got = features.home_form(games(spark), ["t", "id"])
    assert rows(got, "id", "home_matches", "home_wins", "home_win_pctg") == [
        (1, 0, 0, None), (2, 1, 1, 1.0), (3, 2, 1, 0.5), (4, 3, 2, 2 / 3), (5, 0, 0, None), (6, 0, 0, None),
    ]


def test_road_form(spark):
    got = features.road_form(games(spark), ["t", "id"])
    assert rows(got, "id", "road_matches", "road_wins") == [
        (1, 0, 0), (2, 0, 0), (3, 1, 0), (4, 2, 0), (5, 0, 0), (6, 0, 0),
    ]


def test_overall_form_joins_by_match(spark):
    got = features.overall_form(games(spark), ["id"], ["t", "id"])
    assert rows(got, "id", "h_games_played_cumsum", "h_wins_cumsum", "v_games_played_cumsum", "v_wins_cumsum") == [
        (1, 0, 0, 0, 0), (2, 1, 1, 0, 0), (3, 2, 1, 1, 0), (4, 3, 2, 2, 0), (5, 2, 0, 3, 2), (6, 0, 0, 0, 0),
    ]


def test_form_of_a_dominant_team(spark, small_chunks):
    rnd = random.Random(9)
    data = [(i, i // 2, 1, "A" if i % 3 else "B", "C", rnd.choice([0, 1, None])) for i in range(500)]
    got = features.home_form(spark.createDataFrame(data, GAMES), ["t", "id"])
    want = []
    for i, _, _, home, _, _ in data:
        past = [r[5] for r in data[:i] if r[3] == home and r[5] is not None]
        want.append((i, len(past), sum(past)))
    assert sorted(rows(got, "id", "home_matches", "home_wins")) == want


def test_gap_fill(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 5), ("a", 3, None), ("a", 4, 7), ("a", 5, None), ("b", 1, None), ("b", 2, None)],
        "k string, t int, v int",
    )
    assert features.columns_with_nulls(df) == ["v"]
    both = features.gap_fill(df, ["k"], ["t"], ["v"])
    assert [r[2] for r in rows(both)] == [5, 5, 5, 7, 7, None, None]
    past_only = features.gap_fill(df, ["k"], ["t"], ["v"], backward=False)
    assert [r[2] for r in rows(past_only)] == [None, 5, 5, 7, 7, None, None]


def test_fill_ratios_join(spark):
    df = spark.createDataFrame([(1, None, 3, 0), (2, 4, 9, 2)], "id int, a int, b int, c int")
    assert rows(features.fill_from(df, {"a": "b"}), "a") == [(3,), (4,)]
    assert rows(features.ratios(df, {"r": ("b", "c")}), "r") == [(None,), (4.5,)]
    odds = spark.createDataFrame([(2, None)], "id int, price double")
    assert rows(features.join_fill(df, odds, ["id"]), "id", "a", "price") == [(2, 4, 0.0)]


def test_imputation(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "x"), ("a", 3.0, "y"), ("a", None, None), (None, 8.0, "z"), (None, None, None), ("c", None, None)],
        "k string, v double, s string",
    )
    assert rows(features.mean_impute(df, ["k"], ["v"]), "k", "v") == rows(
        spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 2.0), (None, 8.0), (None, 8.0), ("c", None)], "k string, v double")
    )
    filled = features.mode_impute(df, ["k"], ["s"])
    assert sorted(r[0] or "" for r in rows(filled.filter("k = 'a'"), "s")) == ["x", "x", "y"]
    assert rows(filled.filter("k IS NULL"), "s") == [("z",), ("z",)]
    inf = spark.createDataFrame([(1.0,), (float("inf"),), (None,), (float("nan"),), (3.0,)], "v double")
    assert sorted(r[0] for r in rows(features.global_mean_impute(inf, ["v"]))) == [1, 2, 2, 2, 3]


def test_remap_and_types(spark):
    df = spark.createDataFrame([("old", 1), ("x", 2)], "n string, v int")
    assert rows(features.remap(df, {"old": "new"}, ["n"]), "n") == [("new",), ("x",)]
    assert features.numeric_columns(df) == ["v"] and features.string_columns(df) == ["n"]


@pytest.mark.parametrize("share", [0.0, 0.06, 0.5, 1.0])
def test_tail_split_takes_exactly_the_share(spark, share):
    rnd = random.Random(4)
    data = [(i, date(2024, 1, rnd.choice([1, 2, 2, 2, 3]))) for i in range(101)]
    got = features.tail_split(spark.createDataFrame(data, "id int, d date"), "d", share, ["id"])
    k = int(share * 101)
    want = {i for i, _ in sorted(data, key=lambda r: (r[1], r[0]))[101 - k :]} if k else set()
    assert got.count() == 101
    assert {r["id"] for r in got.filter("is_test").collect()} == want


def test_split_by_date(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "id int, d date")
    train, test = features.split_by_date(df, "d", "2024-01-02")
    assert rows(train, "id") == [(1,)] and rows(test, "id") == [(2,)]


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, 1.0), (2, float("inf")), (3, None), (None, float("nan"))], "i int, v double"
    )
    assert rows(profile.null_profile(df)) == [("i", 4, 1, 0, 0), ("v", 4, 1, 1, 1)]
    assert rows(profile.histogram(df.filter("v = 1 OR v IS NULL"), "v", 0.5), "bin", "cnt") == [(2, 1)]
    assert rows(profile.distinct_sorted(df, "i")) == [(None,), (1,), (2,), (3,)]


def test_quantiles_with_a_hot_class(spark, small_chunks):
    rnd = random.Random(2)
    data = [("hot" if i % 3 else f"c{i % 5}", rnd.randrange(300) / 4) for i in range(1200)]
    df = spark.createDataFrame(data, "c string, v double")
    got = profile.quantiles_by_class(df, ["c"], "v", {"q1": 0.25, "q2": 0.5, "q9": 0.9})
    want = df.groupBy("c").agg(
        F.count("v").alias("cnt"),
        *[F.percentile("v", p).alias(n) for n, p in (("q1", 0.25), ("q2", 0.5), ("q9", 0.9))],
    )
    for a, b in zip(rows(got), rows(want)):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:])
