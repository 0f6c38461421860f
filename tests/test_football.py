from __future__ import annotations

import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tallyspark.plans import football as fb
from tallyspark.plans import players as pl
from tallyspark.sources import schemas

TEAMS = ["Alfa", "Beta", "Gama", "Dolt"]
GOAL = ["Goal", "Not accurate"]


def event(match, home, away, kind, team, tags, period="1H", time=0.0, league="L", season="2017-2018"):
    return (league, season, match, 1, home, away, kind, None, team, None, period, time, tags, None, None)


def made_season(seed=4):
    """A double round robin with random goals, passes and misleading events."""
    random.seed(seed)
    made, match = [], 0
    for league in ("L", "M"):
        for home in TEAMS:
            for away in TEAMS:
                if home == away:
                    continue
                match += 1
                made.append(event(match, home, away, "Whistle", home, [], league=league))
                for _ in range(random.choice([0, 0, 1, 2, 5])):
                    team = random.choice([home, away])
                    period, time = random.choice(["1H", "2H"]), random.uniform(0, 2900)
                    made.append(event(match, home, away, "Save attempt", team, GOAL, period, time, league))
                    scorer = away if team == home else home
                    made.append(event(match, home, away, "Shot", scorer, ["Goal", "Accurate"], period, time, league))
                made.append(event(match, home, away, "Save attempt", home, ["Accurate"], league=league))
                made.append(event(match, home, away, "Save attempt", home, ["Not accurate"], league=league))
                for team in (home, away):
                    for _ in range(random.randrange(1, 9)):
                        tags = random.choice([["Accurate"], ["Not accurate"], ["Accurate", "Key"]])
                        made.append(event(match, home, away, "Pass", team, tags, league=league))
    return made


@pytest.fixture(scope="module")
def log():
    return made_season()


@pytest.fixture(scope="module")
def events(spark, log):
    return spark.createDataFrame(log, schemas.MATCH_EVENTS).repartition(5).cache()


def expected_seasons(log):
    goals, teams = defaultdict(lambda: [0, 0]), {}
    for league, season, match, _, home, away, kind, _, team, _, _, _, tags, *_ in log:
        teams[match] = (league, season, home, away)
        if kind == "Save attempt" and "Goal" in tags and "Not accurate" in tags:
            goals[match][0 if team == away else 1] += 1
    table = defaultdict(lambda: [0] * 7)
    for match, (league, season, home, away) in teams.items():
        h, a = goals[match]
        for team, scored, conceded in ((home, h, a), (away, a, h)):
            row = table[league, season, team]
            row[0] += 1
            row[1] += scored > conceded
            row[2] += scored == conceded
            row[3] += scored < conceded
            row[4] += scored
            row[5] += conceded
            row[6] += 3 * (scored > conceded) + (scored == conceded)
    return sorted((*k, *v) for k, v in table.items())


def expected_ratios(log):
    passes = defaultdict(lambda: [0, 0])
    for league, season, match, _, _, _, kind, _, team, _, _, _, tags, *_ in log:
        if kind == "Pass":
            passes[league, season, team, match][0] += "Accurate" in tags
            passes[league, season, team, match][1] += 1
    ratios = defaultdict(list)
    for (league, season, team, _), (good, total) in passes.items():
        ratios[league, season, team].append(Fraction(good, total))
    return {k: float(100 * sum(v) / len(v)) for k, v in ratios.items()}


def test_results_keep_goalless_matches(events):
    results = fb.match_results(events)
    assert results.count() == 24
    check = fb.match_checks(results).first()
    assert check.matches == 24 and check.goalless > 0


def test_season_table_against_plain_python(events, log):
    assert rows(fb.season_table(fb.match_results(events))) == expected_seasons(log)


def test_season_invariants(events):
    results = fb.match_results(events)
    check = fb.season_checks(fb.season_table(results), 5).first()
    assert check.goals_scored == check.goals_conceded == fb.match_checks(results).first().all_goals
    draws = results.filter("homeTeamGoals = awayTeamGoals").count()
    assert check.all_points == 3 * (24 - draws) + 2 * draws
    assert fb.team_results(results).count() == 2 * 24


def test_league_table_order_and_signed_difference(spark):
    made = [
        ("L", "S", "Zeta", 2, 1, 0, 1, 3, 3, 3), ("L", "S", "Acme", 2, 1, 0, 1, 3, 3, 3), ("L", "S", "Top", 2, 2, 0, 0, 5, 0, 6),
        ("L", "S", "Most", 2, 1, 0, 1, 4, 4, 3), ("L", "S", "Low", 2, 0, 0, 2, 0, 5, 0), ("L", "T", "Solo", 2, 0, 0, 2, 0, 5, 0),
    ]
    seasons = spark.createDataFrame(made, "competition string, season string, team string, games int, wins int, draws int, losses int, goalsScored int, goalsConceded int, points int")
    table = [(r.Pos, r.Team, r.GD) for r in fb.league_table(seasons, "L", "S").orderBy("Pos").collect()]
    assert table == [(1, "Top", "+5"), (2, "Most", "0"), (3, "Acme", "0"), (4, "Zeta", "0"), (5, "Low", "-5")]
    assert [r.Pos for r in fb.league_tables(seasons).filter("season = 'T'").collect()] == [1]


def test_pass_ratios_and_worst_passers(events, log):
    got = {(r.competition, r.season, r.team): r.passSuccessRatio for r in fb.pass_ratios(fb.match_passes(events)).collect()}
    want = expected_ratios(log)
    assert got == pytest.approx(want, abs=0.00500001)
    worst = fb.worst_passers(fb.match_passes(events), "2017-2018").collect()
    assert [r.passSuccessRatio for r in worst] == sorted(r.passSuccessRatio for r in worst)
    assert {r.competition: r.team for r in worst} == {
        league: min((got[k], k[2]) for k in got if k[0] == league)[1] for league in ("L", "M")
    }


def test_pass_checks(events):
    check = fb.pass_checks(fb.match_passes(events), 5, 3).first()
    passes = fb.match_passes(events).collect()
    assert check.team_matches == len(passes) == 48
    assert check.many_passes == sum(p.totalPasses > 5 for p in passes)
    assert check.many_successful == sum(p.successfulPasses > 3 for p in passes)


def test_best_teams_agree_with_the_separate_tables(events):
    seasons, ratios = fb.season_table(fb.match_results(events)), fb.pass_ratios(fb.match_passes(events))
    tables = fb.league_tables(seasons).join(ratios.withColumnRenamed("team", "Team"), ["competition", "season", "Team"])
    want = tables.filter("Pos <= 2").select("Team", "competition", "Pos", "GD", "Pts", "passSuccessRatio")
    best = fb.best_teams(events, season="2017-2018")
    assert rows(best.select("Team", "League", "Pos", "GD", "Pts", "PassRatio")) == rows(want)
    averages = [r.Avg for r in best.collect()]
    assert averages == sorted(averages, reverse=True) and len(averages) == 4
    assert rows(fb.best_teams(events, season="1900-1901")) == []


def test_best_teams_shuffle_the_events_once(spark, log, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame(log, schemas.MATCH_EVENTS).write.parquet(path)
    text = plan(fb.best_teams(spark.read.parquet(path)))
    assert text.count("FileScan") == 1 and "Join" not in text and "Python" not in text
    assert "startPosition" not in text  # unused columns are not read


def team(name, lineup, bench, *subs):
    padded = [*subs, None, None, None][:3]
    return (name, 1, lineup, bench, *padded)


def match(number, home, away, season="2017-2018"):
    return (number, "L", season, 1, 1, None, "Played", home, away)


@pytest.fixture
def records(spark):
    made = [
        # 3 replaces 1 at 45 (first half), 4 replaces 3 at 80, 9 never plays
        match(1, team("H", [1, 2], [3, 4, 9], (3, 1, 45), (4, 3, 80)), team("A", [5, 6], [7], (7, 5, 46))),
        match(2, team("A", [5, 6], []), team("H", None, [1])),
    ]
    return spark.createDataFrame(made, schemas.MATCHES)


def goal(number, home, away, against, period, time):
    return event(number, home, away, "Save attempt", against, GOAL, period, time)


@pytest.fixture
def goals(spark):
    made = [
        goal(1, "H", "A", "A", "1H", 2699.9),  # home goal just before minute 45
        goal(1, "H", "A", "A", "1H", 2750.0),  # home goal in the added time of the first half
        goal(1, "H", "A", "H", "2H", 0.0),  # away goal at once after the break
        goal(1, "H", "A", "A", "2H", 60.0),  # home goal in minute 46
        goal(1, "H", "A", "H", "2H", 2100.0),  # away goal at the start of minute 80
        event(1, "H", "A", "Pass", "H", ["Accurate"], "2H", 2845.0),
        event(2, "A", "H", "Pass", "H", ["Accurate"], "1H", 2900.0),
    ]
    return spark.createDataFrame(made, schemas.MATCH_EVENTS).repartition(3)


def test_match_lengths(goals):
    assert rows(pl.match_lengths(goals)) == [(1, 93), (2, 45)]


def test_stints(records):
    got = rows(pl.stints(records).filter("matchId = 1").select("team", "sign", "playerId", "enter", "exit"))
    assert got == [
        ("A", -1, 5, 0, 46), ("A", -1, 6, 0, None), ("A", -1, 7, 46, None),
        ("H", 1, 1, 0, 45), ("H", 1, 2, 0, None), ("H", 1, 3, 45, 80), ("H", 1, 4, 80, None),
    ]
    assert rows(pl.stints(records).filter("matchId = 2").select("playerId")) == [(5,), (6,)]


def test_minutes_played(records, goals):
    minutes = pl.minutes_played(records, goals)
    assert rows(minutes.select("playerId", "minutes")) == [(1, 45), (2, 93), (3, 35), (4, 13), (5, 91), (6, 138), (7, 47)]


def test_plus_minus_respects_halves_and_substitutions(records, goals):
    balance = pl.plus_minus(records, pl.goal_points(goals))
    # player 3 enters at second 2700 of the first half: sees +1 (2750), -1, +1, and leaves before the last goal
    want = {1: 1, 2: 1, 3: 1, 4: -1, 5: -1, 6: -1, 7: 0}
    assert {r.playerId: r.plusMinus for r in balance.collect()} == want


def test_rankings_of_players(spark, records, goals):
    people = spark.createDataFrame(
        [(i, f"F{i}", f"L{i}", "Land", "Keeper" if i == 6 else "Forward", "left") for i in range(1, 10)], schemas.PLAYERS
    )
    best = pl.longest_per_role(pl.minutes_played(records, goals), people, "2017-2018")
    assert rows(best.select("role", "player", "minutes")) == [("Forward", "F2 L2", 93), ("Keeper", "F6 L6", 138)]
    above = pl.above_plus_minus(pl.plus_minus(records, pl.goal_points(goals)), people, above=0)
    assert rows(above.select("player", "plusMinus")) == [("F1 L1", 1), ("F2 L2", 1), ("F3 L3", 1)]
    assert rows(pl.above_plus_minus(pl.plus_minus(records, pl.goal_points(goals)), people, season="1999-2000")) == []


def test_player_totals_against_brute_force(spark):
    random.seed(9)
    made, log = [], []
    for number in range(1, 30):
        sides = []
        for base in (0, 100):
            squad = random.sample(range(base, base + 9), 7)
            subs, on = [], squad[:4]
            for incoming, minute in zip(squad[4:], sorted(random.sample(range(1, 90), 3)), strict=True):
                if random.random() < 0.7:
                    out = random.choice(on)
                    subs.append((incoming, out, minute))
                    on = [incoming if p == out else p for p in on]
            sides.append(team("H" if base == 0 else "A", squad[:4], squad[4:], *subs))
        made.append(match(number, *sides))
        for _ in range(random.randrange(6)):
            log.append(goal(number, "H", "A", random.choice("HA"), random.choice(["1H", "2H"]), random.randrange(2900) + 0.5))
        log.append(event(number, "H", "A", "Pass", "H", [], "2H", 2800.0))

    want = defaultdict(int)
    for number, _, _, _, _, _, _, *sides in made:
        for name, _, lineup, _, *subs in sides:
            subs = [s for s in subs if s]
            for player, enter in [(p, 0) for p in lineup] + [(s[0], s[2]) for s in subs]:
                exit_ = min([s[2] for s in subs if s[1] == player], default=999)
                total = 0
                for e in log:
                    if e[2] != number or e[6] != "Save attempt":
                        continue
                    at = (1 if e[10] == "1H" else 2, e[11])
                    since, until = ((1, m * 60) if m <= 45 else (2, (m - 45) * 60) for m in (enter, exit_))
                    if since <= at < until:
                        total += 1 if e[8] != name else -1
                want[player] += total
    matches = spark.createDataFrame(made, schemas.MATCHES).repartition(4)
    events = spark.createDataFrame(log, schemas.MATCH_EVENTS).repartition(4)
    got = pl.plus_minus(matches, pl.goal_points(events))
    assert {r.playerId: r.plusMinus for r in got.collect()} == dict(want)
    assert got.filter(F.col("plusMinus").isNull()).count() == 0
