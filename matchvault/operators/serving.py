"""Parameterised lookups over the marts.

Values reach the queries as bound parameters, never as text, and ``as_of`` stands for the current
time, so a query gives the same answer whenever it is run.
"""

from pyspark.sql import functions as F

from matchvault.functions import (
    age_years,
    confidence,
    parse_score,
    result_line,
    score_agrees,
    shift_hours,
    winner_name,
)
from matchvault.operators.cdc import delete_by_key, first_per_key, upsert
from matchvault.sources.keyed import KeyedTable

# Fixed value: hours from the stored start time to the time zone shown to users.
SHOWN_TIME_SHIFT = 3
UPCOMING_DAYS = 5
RECENT_DAYS = 7


def recent_results(games, as_of, days=RECENT_DAYS):
    """Games with a score from the last days, newest first, with the winner and a text line."""
    day = F.lit(as_of).cast("date")
    return (
        games.filter(F.col("game_date").between(F.date_sub(day, days), day))
        .filter((F.col("home_score") != 0) | (F.col("visiting_score") != 0))
        .withColumns(
            {
                "winner": winner_name(
                    "home_team_name", "visiting_team_name", "home_score", "visiting_score"
                ),
                "line": result_line(
                    "game_date", "home_team_name", "visiting_team_name", "home_score",
                    "visiting_score",
                ),
            }
        )
        .orderBy(F.desc("eastern_start_time"), "game_date")
    )


CARD = (
    "headshot", "player_full_name", "team_logo", "birth_date", "birth_city", "birth_country",
    "position_code", "team_business_id", "team_full_name",
)


def _current_player(totals, name, as_of):
    """This player's rows of the newest season in ``totals``, with the age on ``as_of``."""
    rows = totals.sparkSession.sql(
        """
        SELECT * FROM {totals}
        WHERE player_full_name = :name AND season = (SELECT max(season) FROM {totals})
        """,
        args={"name": name},
        totals=totals,
    )
    at = F.lit(as_of).cast("date")
    return rows.withColumn("years_old", age_years(F.col("birth_date").cast("date"), at))


def skater_card(totals, name, as_of, by=CARD, sums=("goals", "points", "plus_minus")):
    """Season card of a skater: home and road totals added up."""
    return (
        _current_player(totals, name, as_of)
        .groupBy(*by, "years_old")
        .agg(F.sum("game_cnt").alias("game_cnt"), *[F.sum(c).alias(c) for c in sums])
    )


def goalie_card(totals, name, as_of, by=CARD):
    """Season card of a goalie with the share of shots saved, NULL without shots."""
    against, conceded = F.sum("shots_against"), F.sum("goals_against")
    return (
        _current_player(totals, name, as_of)
        .groupBy(*by, "years_old")
        .agg(
            F.sum("game_cnt").alias("game_cnt"),
            F.try_divide((against - conceded).cast("double"), against.cast("double")).alias(
                "shots_against_pctg"
            ),
        )
    )


def team_card(standings, team, cols):
    """Latest-season standings of a team given by name or code."""
    rows = standings.sparkSession.sql(
        """
        SELECT * FROM {standings}
        WHERE (team_name = :team OR team_business_id = :team)
          AND season_id = (SELECT max(season_id) FROM {standings})
        """,
        args={"team": team},
        standings=standings,
    )
    return rows.select(*cols)


def active_attribute(sat, name_col, name, attribute):
    """An attribute of an entity's version now in force."""
    return sat.filter((F.col(name_col) == F.lit(name)) & (F.col("is_active") == "True")).select(
        attribute
    )


def current_entities(standings, name="team_name", season="season_id"):
    """Distinct names in the newest season."""
    return standings.sparkSession.sql(
        f"SELECT DISTINCT {name} FROM {{standings}} "
        f"WHERE {season} = (SELECT max({season}) FROM {{standings}})",
        standings=standings,
    )


def _shown(games):
    return games.withColumn("shown_time", shift_hours("eastern_start_time", SHOWN_TIME_SHIFT))


def _within_days(games, as_of, days):
    start = F.lit(as_of).cast(games.schema["eastern_start_time"].dataType)
    end = start + F.expr(f"interval {int(days)} day")
    # The same window on the stored column, so that it reaches the scan.
    back = F.expr(f"interval {SHOWN_TIME_SHIFT} hour")
    return games.filter(F.col("eastern_start_time").between(start - back, end - back))


def upcoming_games(games, bets, user_id, as_of, days=UPCOMING_DAYS):
    """Games of the next days that are not played, flagged where the user has placed a bet."""
    mine = (
        bets.filter(F.col("user_id") == F.lit(user_id))
        .select(F.col("game_id").alias("game_source_id"), F.lit(True).alias("bet_placed"))
        .distinct()
    )
    upcoming = _within_days(games, as_of, days).filter(
        (F.col("home_score") == 0) & (F.col("visiting_score") == 0)
    )
    return (
        _shown(upcoming)
        .join(mine, "game_source_id", "left")
        .withColumn("bet_placed", F.coalesce("bet_placed", F.lit(False)))
        .orderBy("eastern_start_time")
        .select("game_source_id", "shown_time", "home_team_name", "visiting_team_name", "bet_placed")
    )


def game_details(games, game_id):
    """One game with the time shown to users."""
    return _shown(games.filter(F.col("game_source_id") == F.lit(game_id))).select(
        "game_source_id", "shown_time", "home_team_name", "visiting_team_name"
    )


def upcoming_predictions(predictions, as_of, days=UPCOMING_DAYS, tie=("game_source_id",)):
    """First meeting of each pair in the next days with a 0-10 confidence, likeliest home win first."""
    rows = _within_days(predictions, as_of, days)
    first = first_per_key(
        rows, ["home_team_name", "visiting_team_name"], ["eastern_start_time", *tie]
    )
    return (
        _shown(first)
        .withColumn("confidence_level", confidence("home_team_win", "home_team_win_proba"))
        .orderBy(F.desc("home_team_win_proba"), *tie)
        .select(
            "game_source_id", "shown_time", "home_team_name", "visiting_team_name",
            "home_team_win", "confidence_level",
        )
    )


def save_bets(bets, changes, order=("selected_at",)):
    """Bets with new ones written over them by (user, game), the last one winning."""
    return upsert(bets, changes, ["user_id", "game_id"], order)


def save_favourites(favourites, changes, order=("selected_at",)):
    """Favourite team per user, the last choice winning."""
    return upsert(favourites, changes, ["user_id"], order)


def clear_favourites(favourites, users):
    return delete_by_key(favourites, users, ["user_id"])


def bet_table(store, name, schema, buckets=64):
    """Stored bets by (user, game): saving a batch rewrites the buckets of its keys only."""
    return KeyedTable(store, name, ["user_id", "game_id"], schema, buckets)


def favourite_table(store, name, schema, buckets=64):
    """Stored favourite team by user."""
    return KeyedTable(store, name, ["user_id"], schema, buckets)


def check_bets(bets, score="score", winner="home_team_winner"):
    """Bets with the parsed score and whether it is valid: two integers that fit the picked winner."""
    parsed = bets.withColumn("_score", parse_score(score))
    return parsed.select(
        *bets.columns,
        F.col("_score.home").alias("home_score"),
        F.col("_score.visiting").alias("visiting_score"),
        score_agrees(winner, F.col("_score")).alias("is_valid"),
    )


def win_pct_series(standings, season_from, teams=None, season="season_id", team="team_name"):
    """Win share per team and date from a season on."""
    rows = standings.filter(F.col(season) >= F.lit(season_from))
    if teams is not None:
        rows = rows.filter(F.col(team).isin(list(teams)))
    return rows.select(team, "date", "win_pctg").orderBy(team, "date")
