"""The tables at hand read as entities, snapshots, matches and standings."""

from pyspark.sql import functions as F

from matchvault.operators import marts
from matchvault.plans.registry import table

MATCH_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
MATCH_ORDER = ["eastern_start_time", *MATCH_KEY]

# --- matches: a line is a game of the supplier's nation against the customer's nation

MATCHES_SQL = """
matches AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS game_source_id,
         l_orderkey, l_linenumber, l_partkey, l_suppkey,
         o_orderdate + l_linenumber * INTERVAL 1 HOUR AS eastern_start_time,
         CAST(o_orderdate AS DATE) AS game_date,
         CAST(year(o_orderdate) AS INT) AS season,
         s_nationkey AS home_team_code, hn.n_name AS home_team_name,
         c_nationkey AS visiting_team_code, vn.n_name AS visiting_team_name,
         l_linenumber % 3 + 1 AS game_type,
         CAST(l_quantity AS INT) % 7 AS home_score,
         l_linenumber % 5 AS visiting_score
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation hn ON s_nationkey = hn.n_nationkey
  JOIN nation vn ON c_nationkey = vn.n_nationkey
  WHERE s_nationkey <> c_nationkey
)"""


def pairings(spark, sf_dir):
    """Lines with both sides' team keys, before names are looked up."""
    line = table(spark, sf_dir, "lineitem").select(*MATCH_KEY, "l_quantity")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    home = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey"), F.col("s_nationkey").alias("home_team_code")
    )
    visiting = table(spark, sf_dir, "customer").select(
        F.col("c_custkey"), F.col("c_nationkey").alias("visiting_team_code")
    )
    # Orders meet their customers first: lines, of which there are most, then move only once.
    ordered = order.join(visiting, F.col("o_custkey") == visiting["c_custkey"])
    return (
        line.join(ordered, line["l_orderkey"] == ordered["o_orderkey"])
        .join(home, F.col("l_suppkey") == home["s_suppkey"])
        .filter(F.col("home_team_code") != F.col("visiting_team_code"))
    )


def unnamed_matches(spark, sf_dir):
    return pairings(spark, sf_dir).select(
        F.concat_ws("-", *MATCH_KEY).alias("game_source_id"),
        *MATCH_KEY,
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias(
            "eastern_start_time"
        ),
        F.to_date("o_orderdate").alias("game_date"),
        F.year("o_orderdate").alias("season"),
        "home_team_code",
        "visiting_team_code",
        (F.col("l_linenumber") % 3 + 1).alias("game_type"),
        (F.col("l_quantity").cast("int") % 7).alias("home_score"),
        (F.col("l_linenumber") % 5).alias("visiting_score"),
    )


def matches(spark, sf_dir):
    return marts.role_join(
        unnamed_matches(spark, sf_dir),
        table(spark, sf_dir, "nation"),
        "n_nationkey",
        {
            "home_team_code": {"n_name": "home_team_name"},
            "visiting_team_code": {"n_name": "visiting_team_name"},
        },
    )


def labelled(spark, sf_dir):
    """Matches with the label NULL where no goal was scored, which here means not played."""
    return marts.label_games(unnamed_matches(spark, sf_dir), unplayed_as_null=True)


LABELLED_SQL = (
    MATCHES_SQL
    + """,
labelled AS (
  SELECT *, CASE WHEN home_score = 0 AND visiting_score = 0 THEN NULL
                 WHEN home_score < visiting_score THEN 0 ELSE 1 END AS home_team_winner
  FROM matches
)"""
)

# --- standings: totals of each team's season up to and including a day

SUMS = (
    "games_played", "wins", "goals_for", "goals_against",
    "home_games_played", "home_wins", "home_goals_for", "home_goals_against",
    "road_games_played", "road_wins", "road_goals_for", "road_goals_against",
)


def standings(spark, sf_dir):
    played = labelled(spark, sf_dir).filter(F.col("home_team_winner").isNotNull())
    played = played.withColumn("road_winner", 1 - F.col("home_team_winner"))
    sides = marts.unpivot_sides(
        played,
        home={
            "team_code": "home_team_code", "win": "home_team_winner",
            "goals_for": "home_score", "goals_against": "visiting_score",
        },
        visiting={
            "team_code": "visiting_team_code", "win": "road_winner",
            "goals_for": "visiting_score", "goals_against": "home_score",
        },
        keep=["season", "game_date"],
    )
    at_home = F.col("home_road_flag") == "H"
    sums = {
        "games_played": F.count(F.lit(1)),
        "wins": F.sum("win"),
        "goals_for": F.sum("goals_for"),
        "goals_against": F.sum("goals_against"),
    }
    for name, cond in (("home", at_home), ("road", ~at_home)):
        pick = lambda c, cond=cond: F.sum(F.when(cond, c).otherwise(0))
        sums |= {
            f"{name}_games_played": pick(F.lit(1)),
            f"{name}_wins": pick(F.col("win")),
            f"{name}_goals_for": pick(F.col("goals_for")),
            f"{name}_goals_against": pick(F.col("goals_against")),
        }
    daily = marts.daily_totals(
        sides, ["team_code", F.col("season").alias("season_id"), F.col("game_date").alias("date")], sums
    )
    total = marts.running_totals(daily, ["team_code", "season_id"], "date", SUMS)
    return total.withColumns(
        {
            "points": F.col("wins") * 2,
            "win_pctg": F.try_divide("wins", "games_played"),
        }
    )


STANDINGS_SQL = (
    LABELLED_SQL
    + """,
sides AS (
  SELECT season, game_date, home_team_code AS team_code, home_team_winner AS win,
         home_score AS gf, visiting_score AS ga, 1 AS h FROM labelled
  WHERE home_team_winner IS NOT NULL
  UNION ALL
  SELECT season, game_date, visiting_team_code, 1 - home_team_winner,
         visiting_score, home_score, 0 FROM labelled
  WHERE home_team_winner IS NOT NULL
),
daily AS (
  SELECT team_code, season AS season_id, game_date AS date,
         count(*) AS games_played, sum(win) AS wins, sum(gf) AS goals_for, sum(ga) AS goals_against,
         sum(h) AS home_games_played, sum(win * h) AS home_wins,
         sum(gf * h) AS home_goals_for, sum(ga * h) AS home_goals_against,
         sum(1 - h) AS road_games_played, sum(win * (1 - h)) AS road_wins,
         sum(gf * (1 - h)) AS road_goals_for, sum(ga * (1 - h)) AS road_goals_against
  FROM sides GROUP BY ALL
),
standings AS (
  SELECT team_code, season_id, date, """
    + ", ".join(f"CAST(sum({c}) OVER w AS BIGINT) AS {c}" for c in SUMS)
    + """,
         CAST(sum(wins) OVER w AS BIGINT) * 2 AS points,
         CAST(sum(wins) OVER w AS DOUBLE) / CAST(sum(games_played) OVER w AS DOUBLE) AS win_pctg
  FROM daily
  WINDOW w AS (PARTITION BY team_code, season_id ORDER BY date)
)"""
)


def teams(spark, sf_dir):
    """Names in force: nation with its region as conference."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("team_code"),
        F.col("n_name").alias("team_name"),
        F.col("r_name").alias("conference_name"),
    )


TEAMS_SQL = """
teams AS (
  SELECT n_nationkey AS team_code, n_name AS team_name, r_name AS conference_name
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def standings_with_names(spark, sf_dir):
    return marts.standings_wide(standings(spark, sf_dir), teams(spark, sf_dir), "team_code")


STANDINGS_WIDE_SQL = (
    STANDINGS_SQL
    + ","
    + TEAMS_SQL
    + """,
standings_wide AS (SELECT * FROM standings JOIN teams USING (team_code))"""
)

# --- snapshots: a customer as the orders of the first and of the second half of the history show it

SPLIT_DATE = "1998-05-01"


def customer_snapshots(spark, sf_dir):
    """(current, previous) extract, one row per customer that ordered in that half."""
    order = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), "c_name", "c_mktsegment"
    )

    def extract(rows, loaded):
        last = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus"))
        state = rows.groupBy(F.col("o_custkey").alias("id")).agg(last.alias("s"))
        return state.join(customer, "id").select(
            "id", "c_name", "c_mktsegment",
            F.col("s.o_orderpriority").alias("priority"),
            F.col("s.o_orderstatus").alias("status"),
            F.lit(loaded).cast("timestamp_ntz").alias("_source_load_datetime"),
            F.lit("ORDERS").alias("_source"),
        )

    old = F.col("o_orderdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz")
    return (
        extract(order.filter(~old), "1998-05-02 08:00:00"),
        extract(order.filter(old), "1998-05-01 08:00:00"),
    )


def _extract_sql(condition, loaded):
    return f"""
  SELECT o_custkey AS id, c_name, c_mktsegment, o_orderpriority AS priority,
         o_orderstatus AS status, TIMESTAMP '{loaded}' AS _source_load_datetime,
         'ORDERS' AS _source
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
        FROM orders WHERE {condition}) JOIN customer ON o_custkey = c_custkey WHERE rn = 1"""


SNAPSHOTS_SQL = f"""
cur AS ({_extract_sql(f"o_orderdate >= TIMESTAMP '{SPLIT_DATE}'", "1998-05-02 08:00:00")}),
prev AS ({_extract_sql(f"o_orderdate < TIMESTAMP '{SPLIT_DATE}'", "1998-05-01 08:00:00")})"""

# --- entities with attribute history: a user and the type (or value band) of its latest event


def user_batch(spark, sf_dir):
    """Every event as a loaded state of its user."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        F.floor(F.col("value") / 50).cast("int").alias("band"),
        F.lit("False").alias("_source_is_deleted"),
        F.col("ts").alias("_source_load_datetime"),
        F.concat_ws("_", F.lit("API"), "event_type").alias("_source"),
    )


MID_MONTH = "2024-01-15"


def before_after(df, at=MID_MONTH):
    """A batch cut in two at a load time."""
    early = F.col("_source_load_datetime") < F.lit(at).cast("timestamp_ntz")
    return df.filter(early), df.filter(~early)


def _sat_sql(name, attribute, expr):
    return f"""
{name}_changes AS (
  SELECT user_id, {expr} AS {attribute}, ts, 'API_' || event_type AS _source,
         sha1(concat_ws(chr(31), CAST({expr} AS VARCHAR), 'False')) AS h,
         lag(sha1(concat_ws(chr(31), CAST({expr} AS VARCHAR), 'False')))
           OVER (PARTITION BY user_id ORDER BY ts) AS p
  FROM events
),
{name} AS (
  SELECT user_id, {attribute}, 'False' AS _source_is_deleted, h AS _data_hash, ts AS effective_from,
         coalesce(lead(ts) OVER w - INTERVAL 1 SECOND, TIMESTAMP '2040-01-01') AS effective_to,
         _source, CASE WHEN lead(ts) OVER w IS NULL THEN 'True' ELSE 'False' END AS is_active,
         sha1(h || '_' || CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
              ELSE rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0') END) AS _version
  FROM {name}_changes WHERE p IS NULL OR p <> h
  WINDOW w AS (PARTITION BY user_id ORDER BY ts)
)"""


SAT_TYPE_SQL = _sat_sql("sat_type", "event_type", "event_type")
SAT_BAND_SQL = _sat_sql("sat_band", "band", "CAST(floor(value / 50) AS INT)")

PIT_SQL = (
    SAT_TYPE_SQL
    + ","
    + SAT_BAND_SQL
    + """,
grid AS (
  SELECT user_id, effective_from FROM sat_type UNION SELECT user_id, effective_from FROM sat_band
),
pit AS (
  SELECT g.user_id, g.effective_from,
         coalesce(lead(g.effective_from) OVER w, TIMESTAMP '2040-01-01') AS effective_to,
         last_value(t._version IGNORE NULLS) OVER f AS sat_type_version,
         last_value(b._version IGNORE NULLS) OVER f AS sat_band_version,
         CASE WHEN lead(g.effective_from) OVER w IS NULL THEN 'True' ELSE 'False' END AS is_active
  FROM grid g
  LEFT JOIN sat_type t ON t.user_id = g.user_id AND t.effective_from = g.effective_from
  LEFT JOIN sat_band b ON b.user_id = g.user_id AND b.effective_from = g.effective_from
  WINDOW w AS (PARTITION BY g.user_id ORDER BY g.effective_from),
         f AS (PARTITION BY g.user_id ORDER BY g.effective_from ROWS UNBOUNDED PRECEDING)
)"""
)

# --- game log: a line as a player's game, the customer as player, the supplier's nation as team

TOI_SQL = """CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN 'x' WHEN 5 THEN '1:2:3' WHEN 4 THEN ''
     ELSE concat(CAST(CAST(l_quantity AS INT) AS VARCHAR), ':', lpad(CAST(l_linenumber AS VARCHAR), 2, '0')) END"""


def toi_text():
    text = F.concat(
        F.col("l_quantity").cast("int").cast("string"),
        F.lit(":"),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
    )
    n = F.col("l_linenumber")
    return F.when(n == 7, None).when(n == 6, "x").when(n == 5, "1:2:3").when(n == 4, "").otherwise(text)


# --- classifier scores: labelled documents scored by simple rules

SCORED_SQL = """
scored AS (
  SELECT l.doc_id, l.quality AS y, d.lang,
         least(1.0::DOUBLE, d.n_chars / 4000.0::DOUBLE) AS by_length,
         1.0::DOUBLE / (1 + l.toxic) AS by_toxicity,
         1 + (d.n_chars % 40) / 20.0::DOUBLE AS odds_a, 1 + (d.doc_id % 30) / 10.0::DOUBLE AS odds_b
  FROM labels l JOIN documents d USING (doc_id)
)"""


def scored(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return labels.join(docs, "doc_id").select(
        "doc_id",
        F.col("quality").alias("y"),
        "lang",
        F.least(F.lit(1.0), F.col("n_chars") / 4000.0).alias("by_length"),
        (F.lit(1.0) / (1 + F.col("toxic"))).alias("by_toxicity"),
        (1 + (F.col("n_chars") % 40) / F.lit(20.0)).alias("odds_a"),
        (1 + (F.col("doc_id") % 30) / F.lit(10.0)).alias("odds_b"),
    )
