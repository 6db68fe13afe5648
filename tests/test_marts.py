from datetime import date

from conftest import rows
from pyspark.sql import functions as F

from matchvault.operators import marts

GAMES = (
    "game_source_id int, game_date date, season int, home_team_code string, "
    "visiting_team_code string, game_type int, home_score int, visiting_score int"
)


def d(n):
    return date(2024, 1, n)


def games(spark):
    return spark.createDataFrame(
        [
            (1, d(2), 2024, "A", "B", 2, 3, 1),
            (2, d(3), 2024, "B", "A", 3, 0, 2),
            (3, d(4), 2024, "A", "C", 2, 0, 0),  # overdue, never played
            (4, d(20), 2024, "A", "B", 2, 0, 0),  # still to come
            (5, d(2), 2024, "A", "B", 1, 5, 1),  # another kind of game
        ],
        GAMES,
    )


def standings(spark):
    return spark.createDataFrame(
        [("A", d(1), 5), ("B", d(2), 7), ("A", d(3), 6)], "team_code string, date date, points int"
    )


def test_previous_day_join_never_uses_the_same_day(spark):
    got = marts.match_wide(games(spark), standings(spark), "2024-01-15")
    assert rows(got, "game_source_id", "h_points", "v_points") == [
        (1, 5, None),  # B has a row only for the day of the game
        (2, 7, None),  # A's rows are two days before and the same day
        (4, None, None),
    ]
    assert "h_date" not in got.columns and "v_team_code" not in got.columns


def test_labels(spark):
    got = marts.label_games(games(spark))
    assert rows(got, "game_source_id", "home_team_winner") == [(1, 1), (2, 0), (3, 1), (4, 1), (5, 1)]
    strict = marts.label_games(games(spark), unplayed_as_null=True)
    assert rows(strict.filter("home_team_winner IS NULL"), "game_source_id") == [(3,), (4,)]


def test_role_join_names_both_sides(spark):
    dim = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "code string, name string")
    roles = {"home_team_code": {"name": "home"}, "visiting_team_code": {"name": "visiting"}}
    inner = marts.role_join(games(spark), dim, "code", roles)
    assert rows(inner, "game_source_id", "home", "visiting")[0] == (1, "Alpha", "Beta")
    assert inner.count() == 4  # C is unknown
    left = marts.role_join(games(spark), dim, "code", roles, how="left")
    assert rows(left.filter("game_source_id = 3"), "home", "visiting") == [("Alpha", None)]


def test_unpivot(spark):
    got = marts.unpivot_sides(
        games(spark).filter("game_source_id = 1"),
        {"team": "home_team_code", "score": "home_score"},
        {"team": "visiting_team_code", "score": "visiting_score"},
        ["game_source_id"],
        min_season=2013,
    )
    assert rows(got, "team", "home_road_flag", "score") == [("A", "H", 3), ("B", "R", 1)]


def test_latest_and_running_totals(spark):
    daily = spark.createDataFrame(
        [("A", 2024, d(1), 1), ("A", 2024, d(3), 2), ("A", 2023, d(2), 9)],
        "team string, season_id int, date date, wins int",
    )
    total = marts.running_totals(daily, ["team", "season_id"], "date", ["wins"])
    assert rows(total, "season_id", "date", "wins") == [(2023, d(2), 9), (2024, d(1), 1), (2024, d(3), 3)]
    last = marts.latest_standings(total, ("team", "season_id"))
    assert rows(last, "season_id", "wins") == [(2023, 9), (2024, 3)]


def test_player_log_and_totals(spark):
    log = spark.createDataFrame(
        [(1, 10, "12:34", "C", d(2)), (2, 10, "x", "C", d(3)), (3, 11, "1:00", "G", d(3)), (4, 99, None, None, d(4)),
         (5, 10, "9:00", "C", date(2010, 1, 1))],
        "game int, player int, toi string, position string, game_date date",
    )
    players = spark.createDataFrame([(10, "Ann"), (11, "Bo")], "id int, name string")
    wide = marts.player_log_wide(log, [(players, "player", "id", {"name": "full"})], "2018-10-03")
    assert rows(wide, "game", "full", "toi") == [(1, "Ann", 754), (2, "Ann", 0), (3, "Bo", 60), (4, None, 0)]
    skaters = marts.season_totals(wide, ["player"], ["toi"], F.col("position") != "G", ("games", "game"))
    assert rows(skaters) == [(10, 2, 754)]  # an unknown position is neither


def test_prefix_and_without(spark):
    df = standings(spark)
    assert marts.with_prefix(df, "h_", keep=["date"]).columns == ["h_team_code", "date", "h_points"]
    assert marts.without(df, ["points"]).columns == ["team_code", "date"]
    assert rows(spark.range(1).select(marts.full_name(F.lit("A"), F.lit(None), F.lit("B")))) == [("A B",)]
