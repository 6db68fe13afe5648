"""Marts over matches, standings and game logs."""

from pyspark.sql import functions as F

from matchvault.operators import features, marts
from matchvault.plans import fixtures as fx
from matchvault.plans.registry import iso_dates, query, table

# Fixed value: the day the marts are built for, after the last match.
BUILT_ON = "2001-08-01"

LATEST_SQL = (
    "WITH"
    + fx.STANDINGS_WIDE_SQL
    + """,
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY team_name, season_id ORDER BY date DESC) rn
    FROM standings_wide) WHERE rn = 1
)"""
)
DATE_TEXT = "REPLACE (strftime(date, '%Y-%m-%d') AS date)"


def latest_of(spark, sf_dir):
    return marts.latest_standings(fx.standings_with_names(spark, sf_dir))


@query("latest_standings", LATEST_SQL + f" SELECT * {DATE_TEXT} FROM latest")
def latest_standings(spark, sf_dir):
    return iso_dates(latest_of(spark, sf_dir))


@query("standings_wide", "WITH" + fx.STANDINGS_WIDE_SQL + f" SELECT * {DATE_TEXT} FROM standings_wide")
def standings_wide(spark, sf_dir):
    return iso_dates(fx.standings_with_names(spark, sf_dir))


STAT_COLS = (
    "games_played", "wins", "win_pctg", "points", "home_wins", "home_games_played",
    "home_goals_for", "home_goals_against", "road_wins", "road_games_played", "road_goals_for",
    "road_goals_against",
)

MATCH_WIDE_SQL = (
    "WITH"
    + fx.STANDINGS_WIDE_SQL
    + f""",
match_wide AS (
  SELECT m.*, home_score - visiting_score AS score_delta,
         CASE WHEN home_score < visiting_score THEN 0 ELSE 1 END AS home_team_winner,
         CAST(month(m.game_date) AS INT) AS game_month,
         {", ".join(f"h.{c} AS h_{c}" for c in STAT_COLS)},
         h.team_name AS h_team_name, h.conference_name AS h_conference_name,
         {", ".join(f"v.{c} AS v_{c}" for c in STAT_COLS)},
         v.team_name AS v_team_name, v.conference_name AS v_conference_name
  FROM matches m
  LEFT JOIN standings_wide h ON h.team_code = m.home_team_code AND h.date + 1 = m.game_date
  LEFT JOIN standings_wide v ON v.team_code = m.visiting_team_code AND v.date + 1 = m.game_date
  WHERE game_type IN (2, 3)
    AND (home_score <> 0 OR visiting_score <> 0 OR m.game_date >= DATE '{BUILT_ON}' - 1)
)"""
)


def match_mart(spark, sf_dir):
    stats = marts.without(
        fx.standings_with_names(spark, sf_dir), ["season_id", "goals_for", "goals_against"]
    )
    return marts.match_wide(fx.matches(spark, sf_dir), stats, BUILT_ON)


@query(
    "match_wide",
    MATCH_WIDE_SQL
    + " SELECT * REPLACE (strftime(game_date, '%Y-%m-%d') AS game_date) FROM match_wide",
)
def match_wide(spark, sf_dir):
    return iso_dates(match_mart(spark, sf_dir))


SIDE_KEEP = ["game_source_id", "game_date", "eastern_start_time", "season", "game_type"]


@query(
    "side_unpivot",
    MATCH_WIDE_SQL
    + """
SELECT game_source_id, strftime(game_date, '%Y-%m-%d') AS game_date, eastern_start_time, season,
       game_type, 'H' AS home_road_flag, home_team_name AS team_name, home_team_code AS team_code,
       visiting_team_name AS opposing_team_name, visiting_team_code AS opposing_team_code,
       home_score AS score, visiting_score AS opposing_score, h_win_pctg AS win_pctg
FROM match_wide WHERE season >= 1996
UNION ALL
SELECT game_source_id, strftime(game_date, '%Y-%m-%d'), eastern_start_time, season, game_type, 'R',
       visiting_team_name, visiting_team_code, home_team_name, home_team_code,
       visiting_score, home_score, v_win_pctg
FROM match_wide WHERE season >= 1996""",
)
def side_unpivot(spark, sf_dir):
    def side(me, other, stat):
        return {
            "team_name": f"{me}_team_name", "team_code": f"{me}_team_code",
            "opposing_team_name": f"{other}_team_name", "opposing_team_code": f"{other}_team_code",
            "score": f"{me}_score", "opposing_score": f"{other}_score", "win_pctg": stat,
        }

    sides = marts.unpivot_sides(
        match_mart(spark, sf_dir),
        side("home", "visiting", "h_win_pctg"),
        side("visiting", "home", "v_win_pctg"),
        SIDE_KEEP,
        min_season=1996,
    )
    return iso_dates(sides)


LOG_SQL = (
    "WITH"
    + f"""
log AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey AS player_source_id,
         CAST(o_orderdate AS DATE) AS game_date, CAST(year(o_orderdate) AS INT) AS season,
         CASE WHEN o_orderpriority < '3' THEN 'H' ELSE 'R' END AS home_road_flag,
         l_returnflag AS position_code,
         {fx.TOI_SQL} AS toi_text,
         CAST(l_quantity AS BIGINT) AS goals, l_linenumber AS points,
         CAST(l_quantity AS BIGINT) + 3 AS shots_against,
         s_nationkey AS team_id, c_nationkey AS opponent_team_id,
         concat_ws(' ', c_mktsegment, c_name) AS player_full_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey
  WHERE o_orderdate >= TIMESTAMP '1995-10-03'
),
player_log AS (
  SELECT log.* EXCLUDE (toi_text, team_id, opponent_team_id),
         CASE WHEN len(string_split(toi_text, ':')) = 2 THEN
           coalesce(TRY_CAST(split_part(toi_text, ':', 1) AS BIGINT) * 60
                    + TRY_CAST(split_part(toi_text, ':', 2) AS BIGINT), 0) ELSE 0 END AS toi,
         t.n_name AS team_full_name, t.n_regionkey AS team_logo, o.n_name AS opponent_team_full_name
  FROM log LEFT JOIN nation t ON t.n_nationkey = team_id
  LEFT JOIN nation o ON o.n_nationkey = opponent_team_id
)"""
)


def player_log(spark, sf_dir):
    """Game log of players: joins by key for line facts, then left star joins for the dimensions."""
    line = table(spark, sf_dir, "lineitem").select(
        *fx.MATCH_KEY,
        F.col("l_returnflag").alias("position_code"),
        fx.toi_text().alias("toi"),
        F.col("l_quantity").cast("bigint").alias("goals"),
        F.col("l_linenumber").alias("points"),
        (F.col("l_quantity").cast("bigint") + 3).alias("shots_against"),
    )
    order = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("player_source_id"),
        F.to_date("o_orderdate").alias("game_date"),
        F.year("o_orderdate").alias("season"),
        F.when(F.col("o_orderpriority") < "3", "H").otherwise("R").alias("home_road_flag"),
    )
    log = line.join(order, line["l_orderkey"] == order["o_orderkey"]).drop("o_orderkey")
    player = table(spark, sf_dir, "customer").withColumn(
        "player_full_name", marts.full_name("c_mktsegment", "c_name")
    )
    nation = table(spark, sf_dir, "nation")
    return marts.player_log_wide(
        log,
        [
            (
                player, "player_source_id", "c_custkey",
                {"player_full_name": "player_full_name", "c_nationkey": "opponent_team_id"},
            ),
            (table(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", {"s_nationkey": "team_id"}),
            (
                nation, "team_id", "n_nationkey",
                {"n_name": "team_full_name", "n_regionkey": "team_logo"},
            ),
            (nation, "opponent_team_id", "n_nationkey", {"n_name": "opponent_team_full_name"}),
        ],
        min_date="1995-10-03",
    ).drop("team_id", "opponent_team_id")


@query(
    "player_log_wide",
    LOG_SQL + " SELECT * REPLACE (strftime(game_date, '%Y-%m-%d') AS game_date) FROM player_log",
)
def player_log_wide(spark, sf_dir):
    return iso_dates(player_log(spark, sf_dir))


PLAYER_BY = [
    "player_source_id", "season", "player_full_name", "team_full_name", "team_logo",
    "home_road_flag", "position_code",
]


def skater_totals(spark, sf_dir):
    return marts.season_totals(
        player_log(spark, sf_dir), PLAYER_BY, ["goals", "points", "toi"],
        F.col("position_code") != "R", ("game_cnt", "l_orderkey"),
    )


def goalie_totals(spark, sf_dir):
    return marts.season_totals(
        player_log(spark, sf_dir),
        PLAYER_BY,
        {"goals_against": "goals", "shots_against": "shots_against", "toi": "toi"},
        F.col("position_code") == "R",
        ("game_cnt", "l_orderkey"),
    )


BY = ", ".join(PLAYER_BY)
SKATERS_SQL = f"""
skaters AS (
  SELECT {BY}, count(*) AS game_cnt, CAST(sum(goals) AS BIGINT) AS goals,
         CAST(sum(points) AS BIGINT) AS points, CAST(sum(toi) AS BIGINT) AS toi
  FROM player_log WHERE position_code <> 'R' GROUP BY ALL
)"""
GOALIES_SQL = f"""
goalies AS (
  SELECT {BY}, count(*) AS game_cnt, CAST(sum(goals) AS BIGINT) AS goals_against,
         CAST(sum(shots_against) AS BIGINT) AS shots_against, CAST(sum(toi) AS BIGINT) AS toi
  FROM player_log WHERE position_code = 'R' GROUP BY ALL
)"""


@query("season_totals_a", LOG_SQL + "," + SKATERS_SQL + " SELECT * FROM skaters")
def season_totals_a(spark, sf_dir):
    return skater_totals(spark, sf_dir)


@query("season_totals_b", LOG_SQL + "," + GOALIES_SQL + " SELECT * FROM goalies")
def season_totals_b(spark, sf_dir):
    return goalie_totals(spark, sf_dir)


@query(
    "entity_remap",
    """
SELECT CASE n_name WHEN 'NATION_3' THEN 'NATION_4' WHEN 'NATION_7' THEN 'NATION_8' ELSE n_name END
         AS team_name,
       count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1""",
)
def entity_remap(spark, sf_dir):
    order = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # Reduced to one row per nation before names are joined and renamed.
    per_nation = (
        order.join(customer, order["o_custkey"] == customer["c_custkey"])
        .groupBy("c_nationkey")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
        )
    )
    named = marts.role_join(
        per_nation, table(spark, sf_dir, "nation"), "n_nationkey", {"c_nationkey": {"n_name": "team_name"}}
    )
    renamed = features.remap(named, {"NATION_3": "NATION_4", "NATION_7": "NATION_8"}, ["team_name"])
    return renamed.groupBy("team_name").agg(
        F.sum("orders").alias("orders"), F.sum("total").cast("double").alias("total")
    )
