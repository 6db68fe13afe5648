"""The whole batch over three days of made-up extracts."""

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchvault.operators import evaluate, ml, serving, vault
from matchvault.plans import daily
from matchvault.sources import tables

TEAMS = ["AAA", "BBB", "CCC", "DDD"]
START = date(2024, 1, 1)
DAYS = ["2024-01-10", "2024-01-11", "2024-01-12"]


def frame(spark, extract, dicts):
    names = list(extract.types)
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in dicts], extract.schema)


def schedule():
    rnd = random.Random(11)
    out = []
    for n in range(60):
        home, visiting = rnd.sample(range(4), 2)
        out.append(
            dict(
                id=2023020000 + n, day=START + timedelta(days=n // 4), hour=18 + n % 4, home=home,
                visiting=visiting, score=(rnd.randrange(1, 6), rnd.randrange(0, 5)),
            )
        )
    return out


def games_on(ds):
    """All games as known on a day: those of later days have no score yet."""
    today = date.fromisoformat(ds)
    for g in schedule():
        played = g["day"] < today
        yield dict(
            id=g["id"], easternStartTime=f"{g['day']}T{g['hour']}:00:00", gameDate=str(g["day"]),
            gameNumber=g["id"] % 1000, gameScheduleStateId=1, gameStateId=7 if played else 1, gameType=2,
            homeScore=g["score"][0] if played else 0, visitingScore=g["score"][1] if played else 0,
            homeTeamId=g["home"], visitingTeamId=g["visiting"], period=3 if played else None,
            season=20232024,
        )


def standings_on(ds):
    today = date.fromisoformat(ds)
    for back in range(14):
        day = today - timedelta(days=back)
        for i, code in enumerate(TEAMS):
            won = lost = 0
            for g in schedule():
                if g["day"] <= day and g["day"] < today and i in (g["home"], g["visiting"]):
                    home_won = g["score"][0] >= g["score"][1]
                    won += home_won == (g["home"] == i)
                    lost += home_won != (g["home"] == i)
            if won + lost == 0:
                continue
            yield dict(
                teamAbbrev=code, date=str(day), seasonId=20232024, teamName=f"Team {code}",
                teamCommonName=code, conferenceName="East", conferenceAbbrev="E", divisionName="North",
                divisionAbbrev="N", placeName=code, teamLogo=f"{code}-{'new' if ds > DAYS[0] else 'old'}.svg",
                gamesPlayed=won + lost, wins=won, winPctg=won / (won + lost), homeGamesPlayed=max(won, 1),
                homeGoalsFor=won * 3, homeGoalsAgainst=lost, homeWins=won // 2, roadGamesPlayed=lost,
                roadGoalsFor=lost * 2, roadGoalsAgainst=won, roadWins=won - won // 2, streakCode="W",
                leagueSequence=i + 1, points=won * 2,
            )


def roster_on(ds):
    for p in range(12):
        goalie = p % 3 == 0
        if p == 5 and ds == DAYS[2]:
            continue  # leaves on the last day
        yield dict(
            id=8470000 + p, headshot="pic", firstName=f"First{p}", lastName=f"Last{p}",
            positionCode="G" if goalie else "C", shootsCatches="L", birthDate="1999-05-05",
            birthCity="City", birthCountry="CAN", birthStateProvince="", triCodeCurrent=TEAMS[p % 4],
            sweaterNumber=p + (50 if p == 1 and ds > DAYS[0] else 0), heightInInches=70,
        )
    if ds == DAYS[1]:
        yield dict(id=8470002, firstName="First2", lastName="Last2", positionCode="C", triCodeCurrent="DDD")  # traded


def log_on(ds):
    for g in schedule():
        if g["day"] >= date.fromisoformat(ds):
            continue
        for p in range(12):
            team = p % 4
            if team not in (g["home"], g["visiting"]):
                continue
            other = g["visiting"] if team == g["home"] else g["home"]
            goalie = p % 3 == 0
            yield dict(
                gameId=g["id"], playerId=8470000 + p, teamAbbrev=TEAMS[team], opponentAbbrev=TEAMS[other],
                homeRoadFlag="H" if team == g["home"] else "R", gameDate=str(g["day"]), toi="10:30",
                goals=0 if goalie else p % 2, points=1, shots=2, pim=0,
                shotsAgainst=20 if goalie else None, goalsAgainst=2 if goalie else None,
            )


SOURCES = [
    (daily.TEAMS, lambda ds: [dict(id=i, fullName=f"Team {c}", triCode=c) for i, c in enumerate(TEAMS)]),
    (daily.GAMES, games_on),
    (daily.ROSTER, roster_on),
    (daily.STANDINGS, standings_on),
    (daily.GAME_LOG, log_on),
]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    out = tables.TableStore(spark, str(tmp_path_factory.mktemp("warehouse")))
    for ds in DAYS:
        for extract, make in SOURCES:
            df = frame(spark, extract, list(make(ds)))
            tables.write_snapshot(out, df, f"source.{extract.name}", ds, f"{ds} 08:00:00", "API")
        daily.load_all(out, ds)
    daily.build_marts(out, DAYS[-1])
    return out


def test_hubs_and_operational(store):
    assert store.read("detailed.hub_teams").count() == 4
    hub = store.read("detailed.hub_games")
    assert hub.count() == 60 and hub.select("_source_load_datetime").distinct().count() == 1
    assert store.read("detailed.hub_players").count() == 12
    # The second day stages only games whose score became known.
    by_day = store.read("operational.games").groupBy(F.col("_batch_id").cast("string")).count()
    assert {tuple(r) for r in by_day.collect()} == {(DAYS[0], 60), (DAYS[1], 4), (DAYS[2], 4)}


def test_histories(store):
    games = store.read("common.dm_games")
    assert games.filter("is_active = 'True'").count() == 60
    assert games.count() == 68
    players = store.read("common.dm_players").filter("player_source_id = 8470001").collect()
    assert sorted((p["sweater_number"], p["is_active"]) for p in players) == [(1, "False"), (51, "True")]
    gone = store.read("common.dm_players").filter("player_source_id = 8470005 AND is_active = 'True'")
    assert rows(gone, "_source_is_deleted") == [("True",)]
    teams = store.read("common.dm_teams")
    assert teams.count() == 8  # the logo changed once
    assert {r["team_logo"][4:7] for r in teams.filter("is_active = 'True'").collect()} == {"new"}


def test_rerun_of_a_day_changes_nothing(spark, store):
    names = [
        "detailed.hub_games", "detailed.sat_games_open", "detailed.sat_games_closed",
        "detailed.sat_players_closed", "detailed.tl_teams_stat", "detailed.tl_players_games_stat",
        "common.dm_games", "common.dm_teams",
    ]
    before = {n: rows(store.read(n)) for n in names}
    daily.load_all(store, DAYS[-1])
    for n in names:
        assert rows(store.read(n), *store.read(n).columns) == before[n], n


def _files(store, name):
    """Partition folder -> names of its data files, for a partitioned table."""
    (version,) = [p for p in Path(store.root, *name.split(".")).iterdir() if p.name.startswith("v=")]
    return {p.name: {f.name for f in p.iterdir() if f.suffix == ".parquet"} for p in version.iterdir() if p.is_dir()}


def test_a_day_leaves_files_of_other_partitions_alone(spark, tmp_path):
    """Three days of standings around a month's end, and histories: only touched partitions get new files."""
    store = tables.TableStore(spark, str(tmp_path))
    names = ["detailed.tl_teams_stat", "common.pit_teams", "common.dm_teams"]
    seen = []
    for ds, logo, days in (("2024-01-31", "a", ["2023-12-31", "2024-01-31"]), ("2024-02-01", "b", ["2024-01-31", "2024-02-01"]),
                           ("2024-02-02", "c", ["2024-02-01", "2024-02-02"])):
        teams = [dict(id=i, fullName=f"Team {c}", triCode=c) for i, c in enumerate(TEAMS)]
        tables.write_snapshot(store, frame(spark, daily.TEAMS, teams), "source.teams", ds, f"{ds} 08:00:00", "API")
        daily.load_teams(store, ds)
        made = [
            dict(teamAbbrev=c, date=d, seasonId=1, teamName=f"Team {c}", teamLogo=logo if c == "AAA" else "x", wins=len(logo))
            for c in TEAMS for d in days
        ]
        df = frame(spark, daily.STANDINGS, made)
        tables.write_snapshot(store, df, f"source.{daily.STANDINGS.name}", ds, f"{ds} 08:00:00", "API")
        daily.load_standings(store, ds)
        seen.append({n: _files(store, n) for n in names})
    link = [s["detailed.tl_teams_stat"] for s in seen]
    assert set(link[2]) == {"_part=202312", "_part=202401", "_part=202402"}
    assert link[1]["_part=202312"] == link[0]["_part=202312"] and link[2]["_part=202401"] == link[1]["_part=202401"]
    assert not link[1]["_part=202401"] & link[0]["_part=202401"] and not link[2]["_part=202402"] & link[1]["_part=202402"]
    for name in names[1:]:
        history = [s[name] for s in seen]
        assert [set(h) for h in history] == [
            {"_closed_in=open"}, {"_closed_in=open", "_closed_in=2024-02-01"},
            {"_closed_in=open", "_closed_in=2024-02-01", "_closed_in=2024-02-02"},
        ]
        assert history[2]["_closed_in=2024-02-01"] == history[1]["_closed_in=2024-02-01"]
    # The same as one rebuild over the whole satellite.
    whole = vault.pit("team_id", {"teams_core": daily.satellite(store, "sat_teams_core")})
    got = store.read("common.pit_teams").drop(daily.CLOSED_IN)
    assert rows(got, *whole.columns) == rows(whole) and got.count() == 6
    view = store.read("common.dm_teams").filter("team_logo IN ('a', 'b', 'c')").orderBy("effective_from").collect()
    assert [(r.team_logo, r.is_active) for r in view] == [("a", "False"), ("b", "False"), ("c", "True")]


def test_rows_that_cannot_be_loaded_are_kept_apart(spark, tmp_path):
    """Every load: rows in are rows loaded and rows rejected, each with its reasons, on the day and on a rerun."""
    store, ds = tables.TableStore(spark, str(tmp_path)), DAYS[0]
    sent = {}
    for extract, make in SOURCES:
        good = list(make(ds))
        bad = [dict(good[0]) | {extract.keys[0]: None}]
        if extract is daily.GAMES:
            bad.append(good[1] | dict(id=1, homeTeamId=None))
        if extract is daily.ROSTER:
            good.append(good[1] | dict(id=1, triCodeCurrent="ZZZ"))
        if extract is daily.STANDINGS:
            bad += [good[0] | dict(teamAbbrev="ZZZ"), good[0] | dict(date=None)]
        if extract is daily.GAME_LOG:
            bad += [good[0] | dict(playerId=1, teamAbbrev="YYY", opponentAbbrev="ZZZ"), good[0] | dict(playerId=2, opponentAbbrev=None)]
        sent[extract.name] = len(good), len(bad)
        df = frame(spark, extract, good + bad)
        tables.write_snapshot(store, df, f"source.{extract.name}", ds, f"{ds} 08:00:00", "API")
    for _ in range(2):
        daily.load_all(store, ds)
        got = {e.name: (daily.batch_of(store, e, ds).count(), daily.rejects_of(store, e, ds).count()) for e, _ in SOURCES}
        assert got == sent
    why = {e.name: sorted(r._rejected_for for r in daily.rejects_of(store, e, ds).collect()) for e, _ in SOURCES}
    assert why["teams"] == ["team_source_id is missing"]
    assert why["games"] == ["game_source_id is missing", "home_team_source_id is missing"]
    assert why["teams_stat"] == ["date is missing", "team_business_id ZZZ is unknown", "team_business_id is missing"]
    assert why["players_games_stat"] == [
        "game_source_id is missing", "opponent_team_business_id is missing",
        "team_business_id YYY is unknown; opponent_team_business_id ZZZ is unknown",
    ]
    assert store.read("detailed.hub_games").count() == 60 and store.read("detailed.hub_players").count() == 13
    assert daily.link(store, "tl_players_games_stat").count() == sent["players_games_stat"][0]
    assert daily.link(store, "tl_teams_stat").count() == sent["teams_stat"][0]
    assert vault.REJECTED not in daily.link(store, "tl_teams_stat").columns


def test_link_keeps_newest_standings(store):
    link = store.read("detailed.tl_teams_stat")
    assert link.count() == link.select("team_id", "date").distinct().count()
    newest = link.filter("date = '2024-01-10'").select("_source_load_datetime").distinct().collect()
    assert newest == [(datetime(2024, 1, 12, 8),)]


def test_game_mart(store):
    mart = store.read("public.games_wide_datamart")
    # Games to come stay; all games before the last day have been played.
    assert mart.count() == 60 and mart.filter("home_score = 0 AND visiting_score = 0").count() == 16
    one = mart.filter("game_date = '2024-01-08'").first()
    want = next(
        s for s in standings_on(DAYS[2]) if s["date"] == "2024-01-07" and s["teamAbbrev"] == one["home_team_code"]
    )
    assert one["h_wins"] == want["wins"] and one["h_win_pctg"] == want["winPctg"]
    assert one["h_team_name"] == f"Team {one['home_team_code']}" and one["game_month"] == 1
    assert mart.filter("game_date = '2024-01-01' AND h_wins IS NOT NULL").count() == 0
    assert store.read("public.teams_games_all").count() == 120
    last = store.read("public.teams_stat_agg")
    assert rows(last, "team_business_id", "season_id") == [(t, 20232024) for t in TEAMS]


def test_player_marts(store):
    log = store.read("public.players_stat_datamart")
    assert log.filter("toi <> 630").count() == 0 and log.count() == len(list(log_on(DAYS[2])))
    assert log.filter("team_full_name IS NULL OR opponent_team_full_name IS NULL").count() == 0
    skaters, goalies = store.read("public.skaters_agg"), store.read("public.goalies_agg")
    counted = skaters.agg(F.sum("game_cnt")).first()[0] + goalies.agg(F.sum("game_cnt")).first()[0]
    assert counted == log.count()
    card = serving.goalie_card(goalies, "First0 Last0", "2024-01-12").first()
    assert card["years_old"] == 24 and card["shots_against_pctg"] == pytest.approx(0.9)
    assert serving.skater_card(skaters, "First1 Last1", "2024-01-12").first()["game_cnt"] > 0


def test_features_model_and_predictions(spark, store):
    mart = store.read("public.games_wide_datamart")
    odds = mart.select("home_team_name", "game_date", "visiting_team_name").distinct()
    odds = odds.withColumn("win_home_team", F.lit(1.8)).withColumn("win_visiting_team", F.lit(2.1))
    daily.make_dataset(store, odds, [({"Team AAA": "Team Alpha"}, ["h_team_name"])])
    dataset = store.read("public.model_dataset")
    assert dataset.count() == 60
    assert dataset.filter("h_home_games_played IS NULL OR h_win_pctg IS NULL").count() == 0
    assert dataset.filter("h_team_name = 'Team AAA'").count() == 0
    first = dataset.orderBy("eastern_start_time").first()
    assert first["h_wins"] == 0 and first["v_games_played"] == 0

    daily.train_model(store, "2024-01-11", ml.boosted_trees(rounds=2))
    names = {r["feature"] for r in store.read(daily.FEATURES).collect()}
    assert "season" in names and not names & {"home_score", "score_delta", "home_team_winner"}
    daily.train_model(store, "2024-01-11", ml.logistic, top=10)
    assert store.count(daily.FEATURES) == 10
    daily.predict(store, "2024-01-11")
    daily.predict(store, "2024-01-13")  # the next run keeps older days
    got = store.read("public.games_winner_prediction")
    assert got.count() == dataset.filter("game_date >= '2024-01-11'").count() == 20
    assert got.columns[-2:] == ["home_team_win_proba", "home_team_win"]
    assert got.filter("home_team_win_proba BETWEEN 0 AND 1").count() == 20
    joined = got.join(dataset.select("game_source_id", F.col("home_team_winner").alias("y")), "game_source_id")
    assert evaluate.confusion_matrix(joined, "y", "home_team_win").agg(F.sum("cnt")).first()[0] == 20
