from datetime import date, datetime

from conftest import rows

from matchvault.operators import serving

TOTALS = (
    "season int, headshot string, player_full_name string, team_logo string, birth_date string, birth_city string, "
    "birth_country string, position_code string, team_business_id string, team_full_name string, home_road_flag string, "
    "game_cnt long, goals double, points double, plus_minus double, shots_against double, goals_against double"
)


def totals(spark):
    def line(season, name, flag, games, goals, shots, against):
        return (
            season, "pic", name, "logo", "2000-03-02", "City", "CAN", "C", "BOS", "Boston", flag,
            games, goals, goals * 2, 1.0, shots, against,
        )

    return spark.createDataFrame(
        [
            line(2023, "Ann O'Neil", "H", 40, 9.0, 10.0, 1.0),
            line(2024, "Ann O'Neil", "H", 3, 1.0, 10.0, 1.0),
            line(2024, "Ann O'Neil", "R", 4, 2.0, 30.0, 3.0),
            line(2024, "Bo", "R", 4, 2.0, 0.0, 0.0),
        ],
        TOTALS,
    )


def test_player_cards(spark):
    card = serving.skater_card(totals(spark), "Ann O'Neil", "2024-03-01")
    assert rows(card, "years_old", "game_cnt", "goals", "points", "plus_minus") == [(23, 7, 3.0, 6.0, 2.0)]
    assert rows(serving.goalie_card(totals(spark), "Ann O'Neil", "2024-03-02"), "years_old", "shots_against_pctg") == [(24, 0.9)]
    assert rows(serving.goalie_card(totals(spark), "Bo", "2024-03-02"), "shots_against_pctg") == [(None,)]
    assert serving.skater_card(totals(spark), "x' OR '1'='1", "2024-03-01").count() == 0


def test_team_lookups(spark):
    df = spark.createDataFrame(
        [("Boston", "BOS", 2024, 9), ("Boston", "BOS", 2023, 8), ("Gone", "GON", 2023, 1)],
        "team_name string, team_business_id string, season_id int, wins int",
    )
    for who in ("Boston", "BOS"):
        assert rows(serving.team_card(df, who, ["team_name", "wins"])) == [("Boston", 9)]
    assert rows(serving.current_entities(df)) == [("Boston",)]
    sat = spark.createDataFrame(
        [("Boston", "new", "True"), ("Boston", "old", "False")], "team_name string, team_logo string, is_active string"
    )
    assert rows(serving.active_attribute(sat, "team_name", "Boston", "team_logo")) == [("new",)]


GAMES = (
    "game_source_id int, game_date date, eastern_start_time timestamp_ntz, home_team_name string, "
    "visiting_team_name string, home_score int, visiting_score int"
)


def games(spark):
    def game(i, day, hour, score=(0, 0), names=("A", "B")):
        return (i, date(2024, 1, day), datetime(2024, 1, day, hour), *names, *score)

    return spark.createDataFrame(
        [
            game(1, 8, 19, (3, 1)), game(2, 15, 19, (1, 2)), game(3, 7, 19, (1, 0)), game(4, 15, 21),
            game(5, 15, 20), game(6, 19, 20), game(7, 19, 21), game(8, 14, 22), game(9, 14, 20),
            game(10, 16, 1, (1, 1)),
        ],
        GAMES,
    )


def test_recent_results(spark):
    got = serving.recent_results(games(spark), "2024-01-15")
    assert [(r["game_source_id"], r["winner"]) for r in got.collect()] == [(2, "B"), (1, "A")]


def test_upcoming_games_in_shown_time(spark):
    bets = spark.createDataFrame([(7, 4), (8, 5), (7, 4)], "user_id int, game_id int")
    got = serving.upcoming_games(games(spark), bets, 7, "2024-01-15").collect()
    # Five days from midnight in shown time: 21:00 of the day before up to 21:00 of the fifth day.
    assert [(r["game_source_id"], r["bet_placed"]) for r in got] == [
        (8, False), (5, False), (4, True), (6, False), (7, False),
    ]
    assert got[0]["shown_time"] == datetime(2024, 1, 15, 1)
    assert rows(serving.game_details(games(spark), 4), "shown_time") == [(datetime(2024, 1, 16),)]


def test_upcoming_predictions(spark):
    schema = (
        "game_source_id int, eastern_start_time timestamp_ntz, home_team_name string, visiting_team_name string, "
        "home_team_win int, home_team_win_proba double"
    )
    df = spark.createDataFrame(
        [
            (1, datetime(2024, 1, 15, 19), "A", "B", 1, 0.55), (2, datetime(2024, 1, 17, 19), "A", "B", 1, 0.99),
            (3, datetime(2024, 1, 15, 19), "C", "D", 0, 0.2), (4, datetime(2024, 1, 30), "E", "F", 1, 0.9),
        ],
        schema,
    )
    got = serving.upcoming_predictions(df, "2024-01-15").collect()
    assert [(r["game_source_id"], r["confidence_level"]) for r in got] == [(1, 6), (3, 8)]


def test_bets_and_favourites(spark):
    schema = "user_id int, game_id int, home_team_winner boolean, selected_at int"
    stored = spark.createDataFrame([(1, 1, True, 1)], schema)
    new = spark.createDataFrame([(1, 1, False, 2), (1, 2, True, 2)], schema)
    saved = serving.save_bets(stored, new)
    assert rows(saved, "game_id", "home_team_winner") == [(1, False), (2, True)]
    favourites = spark.createDataFrame([(1, "BOS", 1), (2, "NYR", 1)], "user_id int, team_id string, selected_at int")
    changed = spark.createDataFrame([(1, "SJS", 2), (3, "CAR", 2)], favourites.schema)
    now = serving.save_favourites(favourites, changed)
    assert rows(now, "user_id", "team_id") == [(1, "SJS"), (2, "NYR"), (3, "CAR")]
    left = serving.clear_favourites(now, spark.createDataFrame([(2,), (9,)], "user_id int"))
    assert rows(left, "user_id") == [(1,), (3,)]


def test_check_bets(spark):
    df = spark.createDataFrame([("3:1", True), ("3:1", False), ("x", True), (None, False)], "score string, home_team_winner boolean")
    assert rows(serving.check_bets(df), "score", "home_team_winner", "home_score", "is_valid") == [
        (None, False, None, False), ("3:1", False, 3, False), ("3:1", True, 3, True), ("x", True, None, False),
    ]


def test_win_pct_series(spark):
    df = spark.createDataFrame(
        [("A", 2, "d2", 0.5), ("A", 2, "d1", 0.4), ("B", 2, "d1", 0.1), ("A", 1, "d0", 0.9)],
        "team_name string, season_id int, date string, win_pctg double",
    )
    got = [tuple(r) for r in serving.win_pct_series(df, 2, ["A"]).collect()]
    assert got == [("A", "d1", 0.4), ("A", "d2", 0.5)]
