"""The daily batch over a table store: entity loads, marts, features, model and predictions.

Each job is a function of the store and a day; it reads tables, composes the operators and writes
tables. Nothing looks at the clock. Tables: ``source`` dated extracts, ``operational`` standardised
batches, ``detailed`` hubs, satellites and links, ``common`` histories, ``public`` marts.
"""

import re
from dataclasses import dataclass, field

from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchvault.functions import clean_number, hash_key
from matchvault.operators import cdc, features, marts, ml, vault
from matchvault.sources import tables

BATCH = cdc.BATCH
# Partitions of links, and of histories by the batch that closed a row.
PART, CLOSED_IN, OPEN = "_part", "_closed_in", "open"
TECHNICAL = [cdc.LOADED, cdc.DELETED, "_source", BATCH]


def snake(name):
    """camelCase as snake_case."""
    return re.sub("([A-Z])", r"_\1", name).lower()


# --- what each source delivers (fixed values: field names, types and keys of the extracts)


@dataclass(frozen=True)
class Extract:
    """An extract: its key, whether one row per key is certain, field types and target names."""

    name: str
    keys: tuple
    types: dict
    keys_unique: bool = True
    names: dict = field(default_factory=dict)
    full: bool = False  # whole extract every day instead of a delta

    @property
    def schema(self):
        return ", ".join(f"{n} {t}" for n, t in self.types.items())

    @property
    def compare(self):
        return [n for n in self.types if n not in self.keys]

    @property
    def mapping(self):
        return {self.names.get(n, snake(n)): (n, t) for n, t in self.types.items()}


def _typed(**groups):
    return {name: type_ for type_, names in groups.items() for name in names.split()}


TEAMS = Extract(
    "teams",
    ("id",),
    _typed(bigint="id", string="fullName triCode"),
    names={"id": "team_source_id", "fullName": "team_full_name", "triCode": "team_business_id"},
)

GAMES = Extract(
    "games",
    ("id",),
    _typed(
        bigint="id homeTeamId visitingTeamId",
        string="easternStartTime gameDate",
        int="gameNumber gameScheduleStateId gameStateId gameType homeScore period season visitingScore",
    ),
    names={
        "id": "game_source_id",
        "homeTeamId": "home_team_source_id",
        "visitingTeamId": "visiting_team_source_id",
    },
)

# A traded player may be listed by two teams, so an id may repeat.
ROSTER = Extract(
    "teams_roster",
    ("id",),
    _typed(
        bigint="id",
        string="headshot firstName lastName positionCode shootsCatches birthDate birthCity "
        "birthCountry birthStateProvince triCodeCurrent",
        int="sweaterNumber heightInInches weightInPounds heightInCentimeters weightInKilograms",
    ),
    keys_unique=False,
    names={"id": "player_source_id", "triCodeCurrent": "team_business_id"},
)

GAME_LOG = Extract(
    "players_games_stat",
    ("gameId", "playerId"),
    _typed(
        bigint="gameId playerId",
        string="teamAbbrev opponentAbbrev homeRoadFlag gameDate commonName opponentCommonName toi decision",
        int="goals assists points plusMinus powerPlayGoals powerPlayPoints gameWinningGoals otGoals "
        "shots shifts shorthandedGoals shorthandedPoints pim gamesStarted shotsAgainst goalsAgainst shutouts",
        double="savePctg",
    ),
    names={
        "gameId": "game_source_id",
        "playerId": "player_source_id",
        "teamAbbrev": "team_business_id",
        "opponentAbbrev": "opponent_team_business_id",
    },
)

# Counts exist overall and for home games, road games and the last ten games; places in the league,
# the conference and the division exist for the same cuts.
CUTS = ("home", "l10", "road")
COUNTS = (
    "GamesPlayed GoalDifferential GoalsAgainst GoalsFor Losses OtLosses Points RegulationPlusOtWins "
    "RegulationWins Ties Wins"
).split()
PLACES = [
    f"{group}{cut}Sequence"
    for group in ("conference", "division", "league")
    for cut in ("Home", "L10", "Road", "")
]

STANDINGS = Extract(
    "teams_stat",
    ("teamAbbrev", "date"),
    _typed(
        string="date teamName teamCommonName teamAbbrev conferenceAbbrev conferenceName divisionAbbrev "
        "divisionName placeName streakCode teamLogo",
        int="seasonId gameTypeId gamesPlayed goalDifferential goalAgainst goalFor losses otLosses points "
        "regulationPlusOtWins regulationWins shootoutLosses shootoutWins streakCount ties "
        "waiversSequence wildcardSequence wins "
        + " ".join([*PLACES, *(cut + count for cut in CUTS for count in COUNTS)]),
        double="goalDifferentialPctg goalsForPctg pointPctg regulationPlusOtWinPctg "
        "regulationWinPctg winPctg",
    ),
    names={"teamAbbrev": "team_business_id"},
    full=True,
)

GAME_ATTRS = [
    "game_date", "season", "eastern_start_time", "game_number", "game_type", "home_score",
    "visiting_score", "period",
]
PLAYER_ATTRS = [
    "team_tri_code", "headshot", "first_name", "last_name", "sweater_number", "position_code",
    "shoots_catches", "height_in_inches", "weight_in_pounds", "height_in_centimeters",
    "weight_in_kilograms", "birth_date", "birth_city", "birth_country", "birth_state_province",
]
TEAM_ATTRS = [
    "team_name", "team_common_name", "conference_abbrev", "conference_name", "division_abbrev",
    "division_name", "place_name", "team_logo",
]


# --- loads


def stage(store, extract, ds):
    """What changed since the extract before ``ds``, or the whole extract for ``full`` ones."""
    name = f"source.{extract.name}"
    cur = tables.read_snapshot(store, name, ds)
    prev = None if extract.full else tables.read_previous_snapshot(store, name, ds)
    if prev is None:
        return cdc.snapshot_delta(cur, None, extract.keys, extract.compare, None, ds)
    loaded = cur.agg(F.max(cdc.LOADED)).first()[0]
    return cdc.snapshot_delta(
        cur, prev, extract.keys, extract.compare, loaded, ds, extract.keys_unique
    )


def standard(staged, extract):
    """Target names and types; text that is not a number becomes NULL instead of failing the batch."""
    read = {n: clean_number(n, t) for n, t in extract.types.items() if t in ("int", "double")}
    mapping = extract.mapping | {c: c for c in TECHNICAL}
    return vault.standardise(staged.withColumns(read), mapping)


def _business_key(df, entity):
    source_id = f"{entity}_source_id"
    return df.withColumns(
        {
            f"{entity}_business_id": F.concat_ws("_", source_id, "_source"),
            f"{entity}_id": hash_key(source_id, "_source"),
        }
    )


def _operational(store, extract, ds, df, required, lookups=()):
    """Keep the batch, checked (a rerun replaces it), and read back the rows that can be loaded."""
    name = f"operational.{extract.name}"
    store.replace_partitions(vault.checked(df, required, lookups), name, [BATCH])
    return batch_of(store, extract, ds)


def _checked_batch(store, extract, ds):
    rows = store.read(f"operational.{extract.name}")
    return rows.filter(F.col(BATCH).cast("string") == F.lit(ds))


def batch_of(store, extract, ds):
    """Rows of a batch that could be loaded."""
    return vault.admitted(_checked_batch(store, extract, ds))


def rejects_of(store, extract, ds):
    """Rows of a batch kept apart, with ``_rejected_for``; with ``batch_of`` they make up the whole batch."""
    return vault.rejected(_checked_batch(store, extract, ds))


def _load_hub(store, name, batch, key, attrs):
    """Append the new keys; what is in the hub is never rewritten."""
    table = f"detailed.{name}"
    store.append(vault.hub_new(store.read_or_none(table), batch, key, attrs), table)


def _load_satellite(store, name, batch, key, attrs, ds, prefer=()):
    """Merge into the open versions; versions that close are kept under the batch that closed them.

    Closed history is neither read nor rewritten. It is written first, so a job lost in between is
    repaired by running the day again: the same versions close and replace themselves.
    """
    merged = vault.scd2_merge(
        store.read_or_none(f"detailed.{name}_open"), batch, key, attrs, prefer
    )
    closed = merged.filter(F.col("is_active") == "False").withColumn(BATCH, F.lit(ds))
    store.replace_partitions(closed, f"detailed.{name}_closed", [BATCH])
    store.overwrite(merged.filter(F.col("is_active") == "True"), f"detailed.{name}_open")


def satellite(store, name):
    """All versions of a satellite."""
    now_open = store.read(f"detailed.{name}_open")
    closed = store.read(f"detailed.{name}_closed", now_open.schema)  # may hold no file yet
    return now_open.unionByName(closed.select(*now_open.columns))


def open_versions(store, name):
    """Versions of a satellite in force."""
    return store.read(f"detailed.{name}_open")


def _load_history(store, entity, key, sat, attrs, hub_cols, ds):
    """PIT table and history view of an entity with one satellite, brought forward by the batch.

    Both are partitioned by the batch that closed an interval. A day rewrites its own partition and the open one; the
    files of earlier days are neither read nor touched.
    """
    name = sat.removeprefix("sat_")
    now_open = open_versions(store, sat)
    schema = T.StructType([*now_open.schema.fields, T.StructField(BATCH, T.StringType())])
    closed = store.read(f"detailed.{sat}_closed", schema)
    closed = closed.filter(F.col(BATCH).cast("string") == F.lit(ds))
    rows = now_open.unionByName(closed.select(*now_open.columns))
    table = f"common.pit_{entity}"
    before = open_rows(store, table) if store.exists(table) else None
    store.replace_partitions(_by_close(vault.pit_increment(key, before, {name: rows}), ds), table, [CLOSED_IN])
    intervals = store.read(table).filter(F.col(CLOSED_IN).isin(OPEN, ds)).drop(CLOSED_IN)
    hub = store.read(f"detailed.hub_{entity}")
    view = vault.dimension(hub, intervals, key, {name: (rows, attrs)}, hub_cols)
    store.replace_partitions(_by_close(view, ds), f"common.dm_{entity}", [CLOSED_IN])


def _by_close(df, ds):
    return df.withColumn(CLOSED_IN, F.when(F.col("is_active") == "True", OPEN).otherwise(F.lit(ds)))


def open_rows(store, name):
    """Rows in force of a history table: one partition, however long the history."""
    return store.read(name).filter(F.col(CLOSED_IN) == OPEN).drop(CLOSED_IN)


def _load_link(store, name, batch, keys, order, part):
    """Merge a batch into a link, rewriting only the partitions that it falls into."""
    table = f"detailed.{name}"
    rows = batch.withColumn(PART, part.cast("int"))
    merged = vault.link_partitions(store.read_or_none(table), rows, keys, order, PART)
    store.replace_partitions(merged, table, [PART])


def link(store, name):
    return store.read(f"detailed.{name}").drop(PART)


def _season(source_id):
    """The year that a match's source id begins with: four digits before six others."""
    return F.floor(F.col(source_id) / 1_000_000)


def load_teams(store, ds):
    df = standard(stage(store, TEAMS, ds), TEAMS)
    df = df.withColumn("team_id", hash_key("team_source_id", "_source"))
    batch = _operational(store, TEAMS, ds, df, ["team_source_id"])
    _load_hub(store, "hub_teams", batch, "team_id", ["team_business_id", "team_source_id"])


def _team_key(store, df, on, as_):
    hub = store.read("detailed.hub_teams")
    return vault.lookup_key(df, hub, "team_business_id", on, "team_id", as_)


def load_games(store, ds):
    df = _business_key(standard(stage(store, GAMES, ds), GAMES), "game")
    for side in ("home", "visiting"):
        df = df.withColumn(f"{side}_team_id", hash_key(f"{side}_team_source_id", "_source"))
    required = ["game_source_id", "home_team_source_id", "visiting_team_source_id"]
    batch = _operational(store, GAMES, ds, df, required)
    _load_hub(store, "hub_games", batch, "game_id", ["game_business_id", "game_source_id"])
    _load_satellite(store, "sat_games", batch, "game_id", GAME_ATTRS, ds)
    keys = ["game_id", "home_team_id", "visiting_team_id"]
    rows = batch.select("game_date", *keys, cdc.LOADED, "game_source_id")
    _load_link(store, "tl_teams_games", rows, keys, [cdc.LOADED, "game_date"], _season("game_source_id"))
    _load_history(
        store, "games", "game_id", "sat_games", [*GAME_ATTRS, cdc.DELETED], ["game_source_id"], ds
    )


def load_players(store, ds):
    df = _business_key(standard(stage(store, ROSTER, ds), ROSTER), "player")
    # A player of an unknown team is still a player: the satellite keeps the team's code.
    df = _team_key(store, df, "team_business_id", "team_id")
    batch = _operational(store, ROSTER, ds, df, ["player_source_id"])
    _load_hub(store, "hub_players", batch, "player_id", ["player_business_id", "player_source_id"])
    named = batch.withColumn("team_tri_code", F.col("team_business_id"))
    _load_satellite(store, "sat_players", named, "player_id", PLAYER_ATTRS, ds)
    _load_history(
        store, "players", "player_id", "sat_players",
        [*PLAYER_ATTRS[1:], cdc.DELETED], ["player_source_id"], ds,
    )


def load_standings(store, ds):
    df = standard(stage(store, STANDINGS, ds), STANDINGS)
    df = df.withColumn("date", F.col("date").cast("date"))
    df = _team_key(store, df, "team_business_id", "team_id")
    batch = _operational(store, STANDINGS, ds, df, ["date"], {"team_id": "team_business_id"})
    # One load carries two weeks of days; the newest day names the team.
    _load_satellite(store, "sat_teams_core", batch, "team_id", TEAM_ATTRS, ds, prefer=["date"])
    month = F.year("date") * 100 + F.month("date")
    _load_link(store, "tl_teams_stat", marts.without(batch, TEAM_ATTRS), ["team_id", "date"], [cdc.LOADED], month)
    _load_history(store, "teams", "team_id", "sat_teams_core", TEAM_ATTRS, ["team_business_id"], ds)


def load_game_log(store, ds):
    df = _business_key(standard(stage(store, GAME_LOG, ds), GAME_LOG), "game")
    df = _team_key(store, _business_key(df, "player"), "team_business_id", "team_id")
    df = _team_key(store, df, "opponent_team_business_id", "opponent_team_id")
    teams = {"team_id": "team_business_id", "opponent_team_id": "opponent_team_business_id"}
    batch = _operational(store, GAME_LOG, ds, df, ["game_source_id", "player_source_id"], teams)
    keys = ["game_id", "player_id", "team_id", "opponent_team_id"]
    _load_link(store, "tl_players_games_stat", batch, keys, [cdc.LOADED], _season("game_source_id"))


def load_all(store, ds):
    """Every entity in the order their keys need."""
    for job in (load_teams, load_games, load_players, load_standings, load_game_log):
        job(store, ds)


# --- marts


def standings_mart(store):
    names = open_versions(store, "sat_teams_core").select(
        "team_id", "team_name", "conference_name", "division_name"
    )
    return marts.standings_wide(link(store, "tl_teams_stat"), names, "team_id")


def games_mart(store, as_of):
    teams = vault.current(open_rows(store, "common.dm_teams"))
    keys = link(store, "tl_teams_games").select("game_id", "home_team_id", "visiting_team_id")
    games = vault.current(open_rows(store, "common.dm_games")).join(keys, "game_id")
    sides = {
        f"{s}_team_id": {"team_business_id": f"{s}_team_code", "team_name": f"{s}_team_name"}
        for s in ("home", "visiting")
    }
    named = marts.role_join(games, teams, "team_id", sides).select(
        "game_source_id", F.col("game_date").cast("date").alias("game_date"), "eastern_start_time",
        "season", "home_team_code", "home_team_name", "visiting_team_code", "visiting_team_name",
        "game_type", "home_score", "visiting_score",
    )
    stats = marts.without(
        store.read("public.teams_stat_wide_datamart"),
        ["season_id", "team_id", "team_source_id", *TECHNICAL],
    ).withColumnRenamed("team_business_id", "team_code")
    return marts.match_wide(named, stats, as_of)


def sides_mart(games):
    keep = ["game_source_id", "game_date", "eastern_start_time", "season", "game_type"]

    def side(me, other, prefix):
        return {
            "team_name": f"{me}_team_name", "team_code": f"{me}_team_code",
            "opposing_team_name": f"{other}_team_name", "opposing_team_code": f"{other}_team_code",
            "score": f"{me}_score", "opposing_score": f"{other}_score",
            "win_pctg": f"{prefix}_win_pctg",
        }

    return marts.unpivot_sides(
        games, side("home", "visiting", "h"), side("visiting", "home", "v"), keep, min_season=20122013
    )


def players_mart(store):
    players = vault.current(open_rows(store, "common.dm_players")).withColumn(
        "player_full_name", marts.full_name("first_name", "last_name")
    )
    shown = [
        c for c in players.columns
        if c not in ("player_id", "player_source_id", "first_name", "last_name", "effective_from",
                     "effective_to", "is_active", cdc.DELETED)
    ]
    teams = vault.current(open_rows(store, "common.dm_teams"))
    games = vault.current(open_rows(store, "common.dm_games"))
    log = marts.without(
        link(store, "tl_players_games_stat"),
        [*TECHNICAL, "player_business_id", "game_business_id", "common_name", "opponent_common_name"],
    ).withColumn("game_date", F.col("game_date").cast("date"))
    joins = [
        (players, "player_id", "player_id", {c: c for c in shown}),
        (teams, "team_id", "team_id", {"team_name": "team_full_name", "team_logo": "team_logo"}),
        (teams, "opponent_team_id", "team_id", {"team_name": "opponent_team_full_name"}),
        (games, "game_id", "game_id", {"season": "season"}),
    ]
    wide = marts.player_log_wide(log, joins, min_date="2018-10-03")
    return wide.drop("player_id", "team_id", "opponent_team_id", "game_id")


PLAYER_BY = [
    "player_source_id", "season", "headshot", "player_full_name", "team_business_id", "team_full_name",
    "team_logo", "home_road_flag", "birth_date", "birth_city", "birth_country",
    "birth_state_province", "position_code", "shoots_catches",
]
SKATER_SUMS = [
    "goals", "points", "plus_minus", "power_play_goals", "power_play_points", "game_winning_goals",
    "ot_goals", "shots", "shifts", "shorthanded_goals", "toi", "pim",
]
GOALIE_SUMS = ["goals", "games_started", "shots_against", "goals_against", "shutouts", "toi", "pim"]


def build_marts(store, as_of):
    """All marts, in the order they read each other."""
    store.overwrite(standings_mart(store), "public.teams_stat_wide_datamart")
    standings = store.read("public.teams_stat_wide_datamart")
    last = marts.latest_standings(standings, tie=("team_business_id",))
    store.overwrite(
        marts.without(last, ["team_id", "team_source_id", "team_logo", "game_type_id", *TECHNICAL]),
        "public.teams_stat_agg",
    )
    store.overwrite(games_mart(store, as_of), "public.games_wide_datamart")
    games = store.read("public.games_wide_datamart")
    store.overwrite(sides_mart(games), "public.teams_games_all")
    store.overwrite(players_mart(store), "public.players_stat_datamart")
    log = store.read("public.players_stat_datamart")
    goalie = F.col("position_code") == "G"
    store.overwrite(marts.season_totals(log, PLAYER_BY, SKATER_SUMS, ~goalie), "public.skaters_agg")
    store.overwrite(marts.season_totals(log, PLAYER_BY, GOALIE_SUMS, goalie), "public.goalies_agg")


# --- features, model, predictions

ORDER = ["eastern_start_time", "game_source_id"]
RATIOS = {
    "h_avg_home_goals_for": ("h_home_goals_for", "h_home_games_played"),
    "v_avg_road_goals_against": ("v_road_goals_against", "v_road_games_played"),
    "v_avg_road_goals_for": ("v_road_goals_for", "v_road_games_played"),
    "h_avg_home_goals_against": ("h_home_goals_against", "h_home_games_played"),
}
CATEGORICAL = [
    "season", "home_team_code", "visiting_team_code", "h_division_name", "h_streak_code",
    "v_division_name", "v_streak_code", "game_month",
]
NOT_FEATURES = [
    "game_source_id", "eastern_start_time", "game_date", "game_type", "score_delta", "home_team_name",
    "visiting_team_name", "home_score", "visiting_score", "v_team_name", "h_team_name",
    "home_team_winner",
]


def with_form(games):
    """Standings columns filled from running form where the day before has none.

    The label of a game not yet played must not count as a win, so form is computed on played games.
    """
    played = (F.col("home_score") != 0) | (F.col("visiting_score") != 0)
    out = games.withColumn("_played_win", F.when(played, F.col("home_team_winner")))
    out = features.home_form(out, ORDER, label="_played_win")
    out = features.road_form(out, ORDER, label="_played_win")
    out = features.overall_form(out, ["game_source_id"], ORDER, label="_played_win")
    out = features.fill_from(
        out,
        {
            "h_home_wins": "home_wins", "h_home_games_played": "home_matches",
            "v_road_wins": "road_wins", "v_road_games_played": "road_matches",
            **{
                f"{s}_{c}": f"{s}_{f}_cumsum"
                for s in "hv"
                for c, f in (
                    ("win_pctg", "wins_pctg"), ("games_played", "games_played"), ("wins", "wins"),
                )
            },
        },
    )
    out = out.withColumns(
        {"h_home_win_pctg": F.col("home_win_pctg"), "v_road_win_pctg": F.col("road_win_pctg")}
    )
    return out.select(*dict.fromkeys([*games.columns, "h_home_win_pctg", "v_road_win_pctg"]))


def make_dataset(store, odds, renames=(), backward=False):
    """Model rows: form, gap filling, ratios, odds. ``renames`` is ``[(old -> new, columns)]``."""
    games = store.read("public.games_wide_datamart")
    for mapping, cols in renames:
        games = features.remap(games, mapping, cols)
    out = with_form(games)
    for prefix, team in (("h_", "home_team_code"), ("v_", "visiting_team_code")):
        gaps = features.columns_with_nulls(out, prefix)
        if gaps:
            out = features.gap_fill(out, [team], ORDER, gaps, backward)
    out = features.ratios(out.filter(F.col("game_date") >= F.lit("2012-01-01").cast("date")), RATIOS)
    out = features.join_fill(out, odds, ["home_team_name", "game_date", "visiting_team_name"])
    group = ["season", "home_team_code", "visiting_team_code"]
    gaps = [c for c in features.columns_with_nulls(out) if c in features.string_columns(out)]
    out = features.mode_impute(out, group, gaps) if gaps else out
    store.overwrite(out, "public.model_dataset")


def feature_columns(dataset):
    """``(numeric, categorical)`` feature names."""
    numeric = [
        c for c in features.numeric_columns(dataset) if c not in CATEGORICAL and c not in NOT_FEATURES
    ]
    return numeric, [c for c in CATEGORICAL if c in dataset.columns]


def _ready(dataset, numeric, categorical):
    return dataset.withColumns(
        {
            **{c: F.col(c).cast("double") for c in numeric},
            **{c: F.col(c).cast("string") for c in categorical},
            "label": F.col("home_team_winner").cast("double"),
        }
    )


MODEL = "public.win_model"
FEATURES = "public.win_model_features"


def train_model(store, cutoff, classifier, top=None):
    """Fit on games before ``cutoff`` and keep the model, its feature list and their importance.

    ``top`` keeps only that many of the features most important in the model trained before.
    """
    spark = store.spark
    dataset = store.read("public.model_dataset")
    numeric, categorical = feature_columns(dataset)
    if top is not None:
        best = ml.top_features(store.read(FEATURES), top)
        kept = {r["feature"] for r in best.collect()}  # at most ``top`` names
        numeric, categorical = ([c for c in cols if c in kept] for cols in (numeric, categorical))
    train, _ = features.split_by_date(_ready(dataset, numeric, categorical), "game_date", cutoff)
    model = ml.fit(train, numeric, categorical, classifier)
    store.save_model(model, MODEL)
    store.overwrite(ml.feature_importance(model, numeric, categorical, spark), FEATURES)


def predict(store, cutoff, threshold=ml.PRODUCTION_THRESHOLD):
    """Score games from ``cutoff`` on and merge them with the stored predictions of earlier ones."""
    names = {r["feature"] for r in store.read(FEATURES).select("feature").collect()}
    dataset = store.read("public.model_dataset")
    numeric, categorical = ([c for c in cols if c in names] for cols in feature_columns(dataset))
    _, test = features.split_by_date(_ready(dataset, numeric, categorical), "game_date", cutoff)
    new = ml.score(store.load_model(MODEL), test, threshold).select(
        "game_source_id", "game_date", "eastern_start_time",
        *[F.col(c).cast(dataset.schema[c].dataType) for c in ("season", "home_team_code")],
        "home_team_name", "visiting_team_code", "visiting_team_name", "game_type",
        F.col("score").alias("home_team_win_proba"), F.col("y_pred").alias("home_team_win"),
    )
    name = "public.games_winner_prediction"
    old = store.read_or_none(name)
    store.overwrite(new if old is None else ml.merge_predictions(old, new, "game_date", cutoff), name)
