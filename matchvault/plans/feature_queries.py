"""Features, gap filling and data profile."""

from pyspark.sql import functions as F

from matchvault.operators import features, profile
from matchvault.plans import fixtures as fx
from matchvault.plans import mart_queries as mq
from matchvault.plans.registry import query, table

KEYS = ", ".join(fx.MATCH_KEY)
SHARE = "CAST({w} AS DOUBLE) / nullif(CAST({n} AS DOUBLE), 0)"


def _form_sql(team, win, prefix):
    n = "sum(CASE WHEN home_team_winner IS NULL THEN 0 ELSE 1 END) OVER w"
    wins = f"sum({win}) OVER w"
    return (
        "WITH"
        + fx.LABELLED_SQL
        + f"""
SELECT {KEYS}, season, {team}, home_team_winner,
       CAST(coalesce({n}, 0) AS BIGINT) AS {prefix}matches,
       CAST(coalesce({wins}, 0) AS BIGINT) AS {prefix}wins,
       CAST({wins} AS DOUBLE) / nullif(CAST({n} AS DOUBLE), 0) AS {prefix}win_pctg
FROM labelled
WINDOW w AS (PARTITION BY {team}, season ORDER BY eastern_start_time, {KEYS}
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    )


def _games(spark, sf_dir, *extra):
    return fx.labelled(spark, sf_dir).select(
        *fx.MATCH_KEY, "eastern_start_time", "season", *extra, "home_team_winner"
    )


@query("home_form", _form_sql("home_team_code", "home_team_winner", "home_"))
def home_form(spark, sf_dir):
    games = _games(spark, sf_dir, "home_team_code")
    return features.home_form(games, fx.MATCH_ORDER).drop("eastern_start_time")


@query("road_form", _form_sql("visiting_team_code", "1 - home_team_winner", "road_"))
def road_form(spark, sf_dir):
    games = _games(spark, sf_dir, "visiting_team_code")
    return features.road_form(games, fx.MATCH_ORDER).drop("eastern_start_time")


OVERALL_SQL = (
    "WITH"
    + fx.LABELLED_SQL
    + f""",
both_sides AS (
  SELECT {KEYS}, season, eastern_start_time, 'h' AS side, home_team_code AS team,
         home_team_winner AS win FROM labelled
  UNION ALL
  SELECT {KEYS}, season, eastern_start_time, 'v', visiting_team_code, 1 - home_team_winner FROM labelled
),
formed AS (
  SELECT {KEYS}, side,
         CAST(coalesce(sum(CASE WHEN win IS NULL THEN 0 ELSE 1 END) OVER w, 0) AS BIGINT) AS n,
         CAST(coalesce(sum(win) OVER w, 0) AS BIGINT) AS wins
  FROM both_sides
  WINDOW w AS (PARTITION BY team, season ORDER BY eastern_start_time, {KEYS}, side
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
folded AS (
  SELECT {KEYS},
         max(CASE WHEN side = 'h' THEN n END) AS hn, max(CASE WHEN side = 'h' THEN wins END) AS hw,
         max(CASE WHEN side = 'v' THEN n END) AS vn, max(CASE WHEN side = 'v' THEN wins END) AS vw
  FROM formed GROUP BY {KEYS}
)
SELECT {KEYS},
       hn AS h_games_played_cumsum, hw AS h_wins_cumsum, {SHARE.format(w="hw", n="hn")} AS h_wins_pctg_cumsum,
       vn AS v_games_played_cumsum, vw AS v_wins_cumsum, {SHARE.format(w="vw", n="vn")} AS v_wins_pctg_cumsum
FROM folded"""
)


@query("overall_form", OVERALL_SQL)
def overall_form(spark, sf_dir):
    games = _games(spark, sf_dir, "home_team_code", "visiting_team_code")
    formed = features.overall_form(games, fx.MATCH_KEY, fx.MATCH_ORDER)
    return formed.drop(
        "eastern_start_time", "season", "home_team_code", "visiting_team_code", "home_team_winner"
    )


READINGS_SQL = """
readings AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events
)"""


def readings(spark, sf_dir):
    """Events in which an error carries no reading."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
    )


@query(
    "gap_fill",
    "WITH"
    + READINGS_SQL
    + """
SELECT event_id, user_id, coalesce(last_value(value IGNORE NULLS) OVER back,
                                   first_value(value IGNORE NULLS) OVER ahead) AS value
FROM readings
WINDOW back AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING),
       ahead AS (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def gap_fill(spark, sf_dir):
    rows = readings(spark, sf_dir)
    cols = features.columns_with_nulls(rows, prefix="v")
    filled = features.gap_fill(rows, ["user_id"], ["ts", "event_id"], cols)
    return filled.select("event_id", "user_id", "value")


def _ratio(a, b):
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


RATIOS = {
    "h_avg_home_goals_for": ("h_home_goals_for", "h_home_games_played"),
    "v_avg_road_goals_against": ("v_road_goals_against", "v_road_games_played"),
    "v_avg_road_goals_for": ("v_road_goals_for", "v_road_games_played"),
    "h_avg_home_goals_against": ("h_home_goals_against", "h_home_games_played"),
}


@query(
    "ratio_features",
    mq.MATCH_WIDE_SQL
    + f" SELECT game_source_id, {', '.join(f'{_ratio(a, b)} AS {n}' for n, (a, b) in RATIOS.items())}"
    " FROM match_wide",
)
def ratio_features(spark, sf_dir):
    mart = mq.match_mart(spark, sf_dir)
    return features.ratios(mart, RATIOS).select("game_source_id", *RATIOS)


@query(
    "fill_from_form",
    mq.MATCH_WIDE_SQL
    + """,
formed AS (
  SELECT *, CAST(count(*) OVER w AS BIGINT) AS home_matches,
         CAST(coalesce(sum(home_team_winner) OVER w, 0) AS BIGINT) AS home_wins
  FROM match_wide
  WINDOW w AS (PARTITION BY home_team_code, season ORDER BY eastern_start_time, game_source_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT game_source_id, coalesce(h_home_wins, home_wins) AS h_home_wins,
       coalesce(h_home_games_played, home_matches) AS h_home_games_played,
       CAST(home_wins AS DOUBLE) / nullif(CAST(home_matches AS DOUBLE), 0) AS h_home_win_pctg
FROM formed""",
)
def fill_from_form(spark, sf_dir):
    games = mq.match_mart(spark, sf_dir).select(
        "game_source_id", "eastern_start_time", "season", "home_team_code", "home_team_winner",
        "h_home_wins", "h_home_games_played",
    )
    formed = features.home_form(games, ["eastern_start_time", "game_source_id"])
    filled = features.fill_from(
        formed, {"h_home_wins": "home_wins", "h_home_games_played": "home_matches"}
    )
    return filled.select(
        "game_source_id", "h_home_wins", "h_home_games_played",
        F.col("home_win_pctg").alias("h_home_win_pctg"),
    )


ODDS_SQL = (
    "WITH"
    + fx.MATCHES_SQL
    + """,
odds AS (
  SELECT home_team_name, visiting_team_name, game_date, 1 + min(l_discount) AS win_home_team,
         nullif(1 + min(l_tax), 1) AS win_visiting_team
  FROM matches JOIN lineitem USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)
  GROUP BY ALL HAVING count(*) > 1
)
SELECT game_source_id, home_score, win_home_team, coalesce(win_visiting_team, 0) AS win_visiting_team
FROM matches JOIN odds USING (home_team_name, visiting_team_name, game_date)"""
)


@query("natural_key_join_fill", ODDS_SQL)
def natural_key_join_fill(spark, sf_dir):
    """Odds exist for pairings that meet more than once on a day; a price of one is missing."""
    keys = ["home_team_name", "visiting_team_name", "game_date"]
    games = fx.matches(spark, sf_dir).select(*keys, "game_source_id", "home_score", *fx.MATCH_KEY)
    line = table(spark, sf_dir, "lineitem").select(*fx.MATCH_KEY, "l_discount", "l_tax")
    odds = (
        games.join(line, fx.MATCH_KEY)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            (1 + F.min("l_discount")).alias("win_home_team"),
            F.nullif(1 + F.min("l_tax"), F.lit(1.0)).alias("win_visiting_team"),
        )
        .filter("_n > 1")
        .drop("_n")
    )
    return features.join_fill(games, odds, keys).select(
        "game_source_id", "home_score", "win_home_team", "win_visiting_team"
    )


@query(
    "group_impute",
    """
WITH r AS (
  SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
         CASE WHEN value > 100 THEN NULL ELSE event_type END AS event_type FROM events
),
m AS (SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / count(value) AS mean
      FROM r GROUP BY user_id),
o AS (SELECT user_id, event_type AS mode FROM (
        SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id
                                                       ORDER BY count(*) DESC, event_type) rn
        FROM r WHERE event_type IS NOT NULL GROUP BY user_id, event_type) WHERE rn = 1)
SELECT event_id, user_id, coalesce(value, mean) AS value,
       coalesce(event_type, mode) AS event_type
FROM r LEFT JOIN m USING (user_id) LEFT JOIN o USING (user_id)""",
)
def group_impute(spark, sf_dir):
    reading = F.when(F.col("event_type") != "error", F.col("value")).cast("decimal(18,2)")
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", reading.alias("value"),
        F.when(F.col("value") <= 100, F.col("event_type")).alias("event_type"),
    )
    filled = features.mean_impute(rows, ["user_id"], ["value"])
    return features.mode_impute(filled, ["user_id"], ["event_type"])


DIRTY_SQL = """
dirty AS (
  SELECT event_id, event_type,
         CASE event_type WHEN 'error' THEN 'inf'::DOUBLE WHEN 'signup' THEN NULL ELSE value END AS value
  FROM events
)"""


def dirty(spark, sf_dir):
    """Events whose value is infinite or missing for some types."""
    kind = F.col("event_type")
    value = F.when(kind == "error", float("inf")).when(kind != "signup", F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", "event_type", value.alias("value"))


@query(
    "global_mean_impute",
    "WITH"
    + DIRTY_SQL
    + """,
m AS (SELECT CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS mean
      FROM dirty WHERE value IS NOT NULL AND NOT isinf(value))
SELECT event_id, round(CASE WHEN value IS NULL OR isinf(value) THEN mean ELSE value END, 4) AS value
FROM dirty, m""",
)
def global_mean_impute(spark, sf_dir):
    filled = features.global_mean_impute(dirty(spark, sf_dir), ["value"])
    return filled.select("event_id", F.round("value", 4).alias("value"))


@query(
    "null_profile",
    "WITH"
    + DIRTY_SQL
    + """
SELECT 'event_id' AS column_name, count(*) AS row_cnt, count(*) - count(event_id) AS null_cnt,
       0 AS nan_cnt, 0 AS inf_cnt FROM dirty
UNION ALL
SELECT 'event_type', count(*), count(*) - count(event_type), 0, 0 FROM dirty
UNION ALL
SELECT 'value', count(*), count(*) - count(value), CAST(sum(CASE WHEN isnan(value) THEN 1 ELSE 0 END) AS BIGINT),
       CAST(sum(CASE WHEN isinf(value) THEN 1 ELSE 0 END) AS BIGINT) FROM dirty""",
)
def null_profile(spark, sf_dir):
    return profile.null_profile(dirty(spark, sf_dir))


@query(
    "histogram",
    """
SELECT CAST(floor(o_totalprice / 25000) AS BIGINT) AS bin,
       CAST(floor(o_totalprice / 25000) AS BIGINT) * 25000 AS bin_from, count(*) AS cnt
FROM orders GROUP BY 1, 2""",
)
def histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "orders"), "o_totalprice", 25000)


@query(
    "class_counts",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS cnt FROM orders GROUP BY ALL",
)
def class_counts(spark, sf_dir):
    return profile.class_counts(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    "quartiles_by_class",
    """
SELECT l_returnflag, count(*) AS cnt, round(quantile_cont(l_extendedprice, 0.25), 4) AS q1,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS q3
FROM lineitem GROUP BY l_returnflag""",
)
def quartiles_by_class(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    found = profile.quantiles_by_class(
        rows, ["l_returnflag"], "l_extendedprice", {"q1": 0.25, "median": 0.5, "q3": 0.75}
    )
    return found.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query("distinct_sorted", "SELECT DISTINCT event_type FROM events ORDER BY event_type")
def distinct_sorted(spark, sf_dir):
    return profile.distinct_sorted(table(spark, sf_dir, "events"), "event_type")


@query(
    "temporal_tail_split",
    """
SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC)
                   <= CAST(floor(0.06 * (SELECT count(*) FROM orders)) AS BIGINT) AS is_test
FROM orders""",
)
def temporal_tail_split(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return features.tail_split(rows, "o_orderdate", 0.06, ["o_orderkey"]).drop("o_orderdate")


@query(
    "split_by_date",
    """
SELECT CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS part,
       count(*) AS cnt FROM orders GROUP BY 1""",
)
def split_by_date(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    train, test = features.split_by_date(rows, "o_orderdate", "2000-01-01")
    parts = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    return profile.class_counts(parts, ["part"])
