"""Lookups over the marts with fixed parameters."""

from pyspark.sql import functions as F

from matchvault.functions import abbreviate_name, matchup_label, snapshot_suffix, url_quote
from matchvault.operators import cdc, serving, vault
from matchvault.plans import fixtures as fx
from matchvault.plans import mart_queries as mq
from matchvault.plans.registry import iso_dates, query, table
from matchvault.sources.tables import scratch_store

NOW = "2000-01-01"
CUP = "\N{TROPHY}"


@query(
    "recent_results",
    "WITH"
    + fx.MATCHES_SQL
    + f"""
SELECT game_source_id, strftime(game_date, '%Y-%m-%d') AS game_date, eastern_start_time,
       home_team_name, visiting_team_name, home_score, visiting_score,
       CASE WHEN home_score > visiting_score THEN home_team_name
            WHEN home_score < visiting_score THEN visiting_team_name END AS winner,
       strftime(game_date, '%Y-%m-%d') || '   '
         || CASE WHEN home_score > visiting_score THEN '{CUP} <b>' || home_team_name || '</b>'
                 ELSE home_team_name END
         || ' ' || home_score || ' : ' || visiting_score || ' '
         || CASE WHEN home_score < visiting_score THEN '<b>' || visiting_team_name || '</b> {CUP}'
                 ELSE visiting_team_name END AS line
FROM matches
WHERE game_date BETWEEN DATE '{NOW}' - 7 AND DATE '{NOW}'
  AND (home_score <> 0 OR visiting_score <> 0)""",
)
def recent_results(spark, sf_dir):
    games = fx.matches(spark, sf_dir).select(
        "game_source_id", "game_date", "eastern_start_time", "home_team_name",
        "visiting_team_name", "home_score", "visiting_score",
    )
    return iso_dates(serving.recent_results(games, NOW))


# Cards: a customer's season totals, with a birth date read off the first order of the customer.

CARD_BY = ["player_full_name", "team_full_name", "team_logo", "position_code", "birth_date"]

BORN_SQL = """
born AS (SELECT o_custkey AS player_source_id,
                CAST(min(o_orderdate) AS DATE) - INTERVAL 20 YEAR AS birth_date FROM orders GROUP BY 1)"""
AGE_SQL = (
    f"CAST(year(DATE '{NOW}') - year(birth_date) - CASE WHEN strftime(DATE '{NOW}', '%m%d')"
    " < strftime(birth_date, '%m%d') THEN 1 ELSE 0 END AS INT)"
)


def _card_sql(source, aggs):
    return f""",
{BORN_SQL}
SELECT player_full_name, team_full_name, team_logo, position_code,
       strftime(birth_date, '%Y-%m-%d') AS birth_date, {AGE_SQL} AS years_old,
       CAST(sum(game_cnt) AS BIGINT) AS game_cnt, {aggs}
FROM {source} JOIN born USING (player_source_id)
WHERE player_full_name = (SELECT min(player_full_name) FROM {source}
                          WHERE season = (SELECT max(season) FROM {source}))
  AND season = (SELECT max(season) FROM {source})
GROUP BY ALL"""


def _with_birth(spark, sf_dir, totals):
    born = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("player_source_id"))
        .agg(F.add_months(F.to_date(F.min("o_orderdate")), -240).alias("birth_date"))
    )
    return totals.join(born, "player_source_id")


def _first_name(totals):
    """The alphabetically first player of the newest season, as one looked up by name."""
    row = totals.agg(F.max("season").alias("s")).first()
    return totals.filter(F.col("season") == row["s"]).agg(F.min("player_full_name")).first()[0]


@query(
    "entity_card_a",
    mq.LOG_SQL
    + ","
    + mq.SKATERS_SQL
    + _card_sql(
        "skaters", "CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(points) AS BIGINT) AS points"
    ),
)
def entity_card_a(spark, sf_dir):
    totals = mq.skater_totals(spark, sf_dir)
    card = serving.skater_card(
        _with_birth(spark, sf_dir, totals), _first_name(totals), NOW, CARD_BY, ("goals", "points")
    )
    return iso_dates(card)


@query(
    "entity_card_b",
    mq.LOG_SQL
    + ","
    + mq.GOALIES_SQL
    + _card_sql(
        "goalies",
        "CAST(sum(shots_against) - sum(goals_against) AS DOUBLE)"
        " / nullif(CAST(sum(shots_against) AS DOUBLE), 0) AS shots_against_pctg",
    ),
)
def entity_card_b(spark, sf_dir):
    totals = mq.goalie_totals(spark, sf_dir)
    card = serving.goalie_card(
        _with_birth(spark, sf_dir, totals), _first_name(totals), NOW, CARD_BY
    )
    return iso_dates(card)


TEAM_COLS = [
    "team_name", "team_business_id", "conference_name", "games_played", "points", "win_pctg",
    "wins", "goals_for", "goals_against",
]


def _team_standings(spark, sf_dir):
    return mq.latest_of(spark, sf_dir).withColumn(
        "team_business_id", F.concat(F.lit("T"), F.col("team_code").cast("string"))
    )


@query(
    "team_card",
    mq.LATEST_SQL
    + f"""
SELECT {", ".join(c for c in TEAM_COLS if c != "team_business_id")}, 'T' || team_code AS team_business_id
FROM latest WHERE (team_name = 'T5' OR 'T' || team_code = 'T5')
  AND season_id = (SELECT max(season_id) FROM latest)""",
)
def team_card(spark, sf_dir):
    return serving.team_card(_team_standings(spark, sf_dir), "T5", TEAM_COLS)


@query(
    "current_entities",
    mq.LATEST_SQL
    + " SELECT DISTINCT team_name FROM latest WHERE season_id = (SELECT max(season_id) FROM latest)",
)
def current_entities(spark, sf_dir):
    return serving.current_entities(_team_standings(spark, sf_dir))


@query(
    "active_attribute",
    "WITH"
    + fx.SAT_TYPE_SQL
    + " SELECT effective_from FROM sat_type WHERE event_type = 'error' AND is_active = 'True'",
)
def active_attribute(spark, sf_dir):
    sat = vault.scd2_merge(None, fx.user_batch(spark, sf_dir), "user_id", ["event_type"])
    return serving.active_attribute(sat, "event_type", "error", "effective_from")


# Bets: an order is a bet its customer's nation placed on the game of that order.

USER = 2


def bets(spark, sf_dir):
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return order.join(customer, order["o_custkey"] == customer["c_custkey"]).select(
        F.col("c_nationkey").alias("user_id"), F.col("o_orderkey").alias("game_id")
    )


UPCOMING_SQL = f"""
SELECT o_orderkey AS game_source_id, o_orderdate + INTERVAL 3 HOUR AS shown_time,
       c_name AS home_team_name, n_name AS visiting_team_name,
       c_nationkey = {USER} AS bet_placed
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate + INTERVAL 3 HOUR BETWEEN TIMESTAMP '{NOW}' AND TIMESTAMP '{NOW}' + INTERVAL 5 DAY
  AND o_orderstatus = 'O'"""


def fixtures_list(spark, sf_dir):
    """Orders as scheduled games; an open one is not played yet."""
    order = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    return (
        order.join(customer, order["o_custkey"] == customer["c_custkey"])
        .join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .select(
            F.col("o_orderkey").alias("game_source_id"),
            F.col("o_orderdate").alias("eastern_start_time"),
            F.col("c_name").alias("home_team_name"),
            F.col("n_name").alias("visiting_team_name"),
            F.when(F.col("o_orderstatus") == "O", 0).otherwise(1).alias("home_score"),
            F.lit(0).alias("visiting_score"),
        )
    )


@query("upcoming_with_flag", UPCOMING_SQL)
def upcoming_with_flag(spark, sf_dir):
    return serving.upcoming_games(fixtures_list(spark, sf_dir), bets(spark, sf_dir), USER, NOW)


@query(
    "match_details",
    """
SELECT o_orderkey AS game_source_id, o_orderdate + INTERVAL 3 HOUR AS shown_time,
       c_name AS home_team_name, n_name AS visiting_team_name
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderkey = 42""",
)
def match_details(spark, sf_dir):
    return serving.game_details(fixtures_list(spark, sf_dir), 42)


PROBA_SQL = "(CAST(l_quantity AS INT) * 17 % 100) / 100.0::DOUBLE"


@query(
    "top_predictions",
    "WITH"
    + fx.MATCHES_SQL
    + f""",
predicted AS (
  SELECT m.*, {PROBA_SQL} AS p, CASE WHEN {PROBA_SQL} >= 0.48 THEN 1 ELSE 0 END AS win
  FROM matches m JOIN lineitem USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)
),
prep AS (
  SELECT *, row_number() OVER (PARTITION BY home_team_name, visiting_team_name
                               ORDER BY eastern_start_time, game_source_id) AS rn
  FROM predicted
  WHERE eastern_start_time + INTERVAL 3 HOUR
        BETWEEN TIMESTAMP '{NOW}' AND TIMESTAMP '{NOW}' + INTERVAL 5 DAY
)
SELECT game_source_id, eastern_start_time + INTERVAL 3 HOUR AS shown_time, home_team_name,
       visiting_team_name, win AS home_team_win,
       CAST(10 * round(CASE WHEN win = 1 THEN CAST(p AS DECIMAL(18, 15))
                            ELSE 1 - CAST(p AS DECIMAL(18, 15)) END, 1) AS INT) AS confidence_level
FROM prep WHERE rn = 1""",
)
def top_predictions(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(*fx.MATCH_KEY, "l_quantity")
    proba = (F.col("l_quantity").cast("int") * 17 % 100) / F.lit(100.0)
    predicted = (
        fx.matches(spark, sf_dir)
        .join(line, fx.MATCH_KEY)
        .withColumn("home_team_win_proba", proba)
        .withColumn("home_team_win", (F.col("home_team_win_proba") >= 0.48).cast("int"))
    )
    return serving.upcoming_predictions(predicted, NOW)


SCORE_TEXT_SQL = """
bets AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag = 'R' AS home_team_winner,
         CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN 'three:two' WHEN 5 THEN '1:2:3'
              ELSE concat(CAST(l_quantity AS INT) % 7, ':', l_linenumber) END AS score
  FROM lineitem
),
parsed AS (
  SELECT *, CASE WHEN len(string_split(score, ':')) = 2 THEN TRY_CAST(split_part(score, ':', 1) AS BIGINT) END AS h,
         CASE WHEN len(string_split(score, ':')) = 2 THEN TRY_CAST(split_part(score, ':', 2) AS BIGINT) END AS v
  FROM bets
)"""


@query(
    "validate_scores",
    "WITH"
    + SCORE_TEXT_SQL
    + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, home_team_winner, score,
       CASE WHEN v IS NOT NULL THEN h END AS home_score, CASE WHEN h IS NOT NULL THEN v END AS visiting_score,
       coalesce(CASE WHEN home_team_winner THEN h > v ELSE h < v END, false) AS is_valid
FROM parsed""",
)
def validate_scores(spark, sf_dir):
    n = F.col("l_linenumber")
    good = F.concat((F.col("l_quantity").cast("int") % 7).cast("string"), F.lit(":"), n.cast("string"))
    text = F.when(n == 7, None).when(n == 6, "three:two").when(n == 5, "1:2:3").otherwise(good)
    placed = table(spark, sf_dir, "lineitem").select(
        *fx.MATCH_KEY, (F.col("l_returnflag") == "R").alias("home_team_winner"), text.alias("score")
    )
    return serving.check_bets(placed)


@query(
    "favourite_upsert",
    """
SELECT user_id, event_type AS team_id, ts AS selected_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) rn FROM events)
WHERE rn = 1 AND event_type <> 'error'""",
)
def favourite_upsert(spark, sf_dir):
    """The last choice per user, and a user whose last choice is a reset has none."""
    rows = table(spark, sf_dir, "events").select(
        "user_id", F.col("event_type").alias("team_id"), F.col("ts").alias("selected_at")
    )
    early = F.col("selected_at") < F.lit(fx.MID_MONTH).cast("timestamp_ntz")
    stored = cdc.latest_per_key(rows.filter(early), ["user_id"], ["selected_at", "team_id"])
    saved = serving.save_favourites(stored, rows.filter(~early), ("selected_at", "team_id"))
    return serving.clear_favourites(saved, saved.filter(F.col("team_id") == "error"))


KEPT_DAYS = ("2024-01-10", "2024-01-20")


@query(
    "bets_by_bucket",
    f"""
SELECT user_id, event_type AS game_id, event_id, value, ts AS selected_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) rn FROM events)
WHERE rn = 1 AND (event_type <> 'error' OR user_id % 3 <> 0 OR ts >= TIMESTAMP '{KEPT_DAYS[1]}')""",
)
def bets_by_bucket(spark, sf_dir):
    """Bets saved in three batches, some withdrawn before the last one, in a table that rewrites touched buckets."""
    rows = table(spark, sf_dir, "events").select(
        "user_id", F.col("event_type").alias("game_id"), "event_id", "value", F.col("ts").alias("selected_at")
    )
    bets = serving.bet_table(scratch_store(spark), "public.bets", rows.schema)
    start, end = (F.lit(d).cast("timestamp_ntz") for d in KEPT_DAYS)
    at = F.col("selected_at")
    order = ["selected_at", "event_id"]
    bets.upsert(rows.filter(at < start), order)
    bets.upsert(rows.filter((at >= start) & (at < end)), order)
    bets.delete(rows.filter((F.col("game_id") == "error") & (F.col("user_id") % 3 == 0)))
    bets.upsert(rows.filter(at >= end), order)
    return bets.read()


@query(
    "win_pct_series",
    "WITH"
    + fx.STANDINGS_WIDE_SQL
    + " SELECT team_name, strftime(date, '%Y-%m-%d') AS date, win_pctg FROM standings_wide"
    " WHERE season_id >= 1998",
)
def win_pct_series(spark, sf_dir):
    standings = fx.standings_with_names(spark, sf_dir)
    return iso_dates(serving.win_pct_series(standings, 1998, season="season_id"))


@query(
    "label_strings",
    """
WITH p AS (SELECT p_partkey, p_name || ' ' || p_type AS name, 'Part ' || p_name AS other, p_name FROM part)
SELECT p_partkey, replace(name, ' ', '%20') AS quoted,
       CASE WHEN len(string_split(name, ' ')) > 2
            THEN concat_ws(' ', split_part(name, ' ', 1), split_part(name, ' ', 2),
                           left(split_part(name, ' ', 3), 3))
            ELSE concat_ws(' ', split_part(name, ' ', 1), left(split_part(name, ' ', 2), 3)) END AS short_name,
       concat('01-15 22:00 ', split_part(name, ' ', 1), ' ', split_part(name, ' ', 2), ' ',
              left(split_part(name, ' ', 3), 3), ' vs ', split_part(other, ' ', 1), ' ',
              split_part(other, ' ', 2), ' ', left(split_part(other, ' ', 3), 3)) AS label,
       '2024_01_15' AS suffix
FROM p""",
)
def label_strings(spark, sf_dir):
    name = F.concat_ws(" ", "p_name", "p_type")
    shown = F.lit("2024-01-15 22:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        url_quote(name).alias("quoted"),
        abbreviate_name(name).alias("short_name"),
        matchup_label(name, F.concat_ws(" ", F.lit("Part"), "p_name"), shown).alias("label"),
        snapshot_suffix(F.lit("2024-01-15 08:00:00")).alias("suffix"),
    )
