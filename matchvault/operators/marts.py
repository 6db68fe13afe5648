"""Wide marts: role-playing joins, previous-day statistics, unpivoted sides, season totals."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from matchvault.functions import mmss_to_seconds
from matchvault.operators.cdc import latest_per_key


def with_prefix(df, prefix, keep=()):
    """All columns renamed with a role prefix, except those in ``keep``."""
    return df.select([F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def without(df, names):
    """Projection by exclusion."""
    return df.select([c for c in df.columns if c not in set(names)])


def role_join(fact, dim, key, roles, how="inner"):
    """Join one dimension once per role.

    ``roles`` is ``{fact key: {dim column: output name}}``. The dimension is left to Spark's size
    check for broadcasting; a large one is joined by sort-merge, where a hot key is split at run time.
    """
    out = fact
    for fact_key, names in roles.items():
        role = dim.select(
            F.col(key).alias("_role_key"), *[F.col(c).alias(a) for c, a in names.items()]
        )
        out = out.join(role, out[fact_key] == role["_role_key"], how).drop("_role_key")
    return out


def previous_day_join(games, stats, on, date="game_date", stat_date="date", drop=()):
    """Attach to each game the statistics of the day before it, NULL where that day has none.

    ``on`` maps a game column to the statistics column it equals. The date is moved on the statistics
    side, the smaller one, so the join stays an equi-join on untouched game columns.
    """
    moved = stats.withColumn("_next_day", F.date_add(F.col(stat_date), 1))
    cond = games[date] == moved["_next_day"]
    for left, right in on.items():
        cond = cond & (games[left] == moved[right])
    return games.join(moved, cond, "left").drop(
        "_next_day", *[F.col(c) for c in {stat_date, *on.values(), *drop} if c not in games.columns]
    )


def label_games(games, unplayed_as_null=False):
    """Score difference, home win label and month.

    The label is 0 when the visitors scored more and 1 otherwise, also for a game not played yet
    (0:0) unless ``unplayed_as_null``.
    """
    delta = F.col("home_score") - F.col("visiting_score")
    label = F.when(delta < 0, 0).when(delta >= 0, 1)
    if unplayed_as_null:
        label = F.when((F.col("home_score") != 0) | (F.col("visiting_score") != 0), label)
    return games.withColumns(
        {
            "score_delta": delta,
            "home_team_winner": label.cast("int"),
            "game_month": F.month("game_date"),
        }
    )


def scored_or_upcoming(games, as_of):
    """Drop games without a score that should have been played before the day before ``as_of``."""
    scored = (F.col("home_score") != 0) | (F.col("visiting_score") != 0)
    recent = F.col("game_date") >= F.date_sub(F.lit(as_of).cast("date"), 1)
    return games.filter(scored | recent)


def match_wide(games, standings, as_of, game_types=(2, 3)):
    """One row per game with both sides' standings of the day before, prefixed ``h_`` and ``v_``.

    ``games`` has home_/visiting_team_code, game_date, game_type and scores; ``standings`` has
    team_code, date and statistics. Filters run before the joins.
    """
    out = scored_or_upcoming(
        label_games(games.filter(F.col("game_type").isin(*game_types))), as_of
    )
    for prefix, code in (("h_", "home_team_code"), ("v_", "visiting_team_code")):
        out = previous_day_join(
            out, with_prefix(standings, prefix), {code: f"{prefix}team_code"},
            stat_date=f"{prefix}date",
        )
    return out


def standings_wide(stats, names, key):
    """Daily standings with the names now in force."""
    return stats.join(names, key, "inner")


def latest_standings(stats, keys=("team_name", "season_id"), date="date", tie=()):
    """Last row per team and season."""
    return latest_per_key(stats, list(keys), [date, *tie])


def unpivot_sides(games, home, visiting, keep, flag="home_road_flag", min_season=None):
    """Each game as two rows, seen from the home side ("H") and from the road side ("R").

    ``home`` and ``visiting`` map output names to the game column each side reads. One pass over the
    games instead of two scans and a union.
    """
    if min_season is not None:
        games = games.filter(F.col("season") >= F.lit(min_season))
    side = lambda label, names: F.struct(
        F.lit(label).alias(flag), *[F.col(c).alias(a) for a, c in names.items()]
    )
    rows = F.array(side("H", home), side("R", visiting))
    return games.select(*keep, F.inline(rows))


def daily_totals(sides, keys, sums):
    """Sums and counts per key (season, team, day ...), reduced on the map side."""
    return sides.groupBy(*keys).agg(*[expr.alias(name) for name, expr in sums.items()])


def running_totals(daily, keys, date, cols):
    """Standings: totals up to and including each day.

    Works on one row per key and day, so a window partition has at most as many rows as days.
    """
    w = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumns({c: F.sum(c).over(w) for c in cols})


def player_log_wide(log, joins, min_date=None, date="game_date", toi="toi"):
    """Per-game player log with player, team, opponent and game attributes.

    ``joins`` lists ``(dimension, log key, dimension key, {dimension column: output name})``, all left
    joins. Time on ice becomes seconds.
    """
    out = log
    if min_date is not None:
        out = out.filter(F.col(date) >= F.lit(min_date).cast("date"))
    if toi in out.columns:
        out = out.withColumn(toi, mmss_to_seconds(toi))
    for dim, log_key, dim_key, names in joins:
        out = role_join(out, dim, dim_key, {log_key: names}, how="left")
    return out


def full_name(*parts):
    """Name parts joined by a blank, missing ones skipped."""
    return F.concat_ws(" ", *parts)


def season_totals(log, by, sums, where=None, count=("game_cnt", "game_source_id")):
    """Games played and sums per player, season and side.

    ``where`` selects the kind of player; a row for which it is NULL is left out.
    """
    rows = log if where is None else log.filter(where)
    name, counted = count
    return rows.groupBy(*by).agg(
        F.count(counted).alias(name),
        *[
            (F.sum(c) if isinstance(c, str) else c).alias(a)
            for a, c in (sums.items() if isinstance(sums, dict) else ((s, s) for s in sums))
        ],
    )

