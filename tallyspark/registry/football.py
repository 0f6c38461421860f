"""Football: results, tables, passes, players."""

from __future__ import annotations

from tallyspark import bindings as b
from tallyspark.plans import football as fb
from tallyspark.plans import players as pl
from tallyspark.registry.core import query

EVENTS = f"WITH {b.MATCH_EVENTS_SQL}"
TABLE_COLUMNS_SQL = """games AS Pld, wins AS W, draws AS D, losses AS L, goalsScored AS GF, goalsConceded AS GA,
  CASE WHEN goalsScored > goalsConceded THEN '+' ELSE '' END || (goalsScored - goalsConceded) AS GD, points AS Pts"""


def _seasons(spark, sf):
    return fb.season_table(fb.match_results(b.match_events(spark, sf)))


def _passes(spark, sf):
    return fb.match_passes(b.match_events(spark, sf))


@query("match_results", "DP1 FLT5 AG12", sql=f"{EVENTS} SELECT * FROM match_results")
def match_results(spark, sf):
    return fb.match_results(b.match_events(spark, sf))


@query("season_table", "DP2 AG13 AG14 PRJ2 SC16", sql=f"{EVENTS} SELECT * FROM season_table")
def season_table(spark, sf):
    return _seasons(spark, sf)


LEAGUE_ORDER = "points DESC, goalsScored - goalsConceded DESC, goalsScored DESC, team"


@query(
    "league_tables", "DP3 WN1 SC14",
    sql=f"""{EVENTS} SELECT competition, season, CAST(row_number() OVER (
              PARTITION BY competition, season ORDER BY {LEAGUE_ORDER}) AS INTEGER) AS Pos,
            team AS Team, {TABLE_COLUMNS_SQL} FROM season_table""",
)
def league_tables(spark, sf):
    return fb.league_tables(_seasons(spark, sf))


@query(
    "league_table_of_one_season", "DP3 FLT1",
    sql=f"""{EVENTS} SELECT CAST(row_number() OVER (ORDER BY {LEAGUE_ORDER}) AS INTEGER) AS Pos, team AS Team,
            {TABLE_COLUMNS_SQL} FROM season_table WHERE competition = 'League 0' AND season = '1997-1998'""",
)
def league_table_of_one_season(spark, sf):
    return fb.league_table(_seasons(spark, sf), "League 0", "1997-1998").orderBy("Pos")


@query("match_passes", "DP4", sql=f"{EVENTS} SELECT * FROM match_passes")
def match_passes(spark, sf):
    return _passes(spark, sf)


@query("pass_ratios", "AG15", sql=f"{EVENTS} SELECT * FROM pass_ratios")
def pass_ratios(spark, sf):
    return fb.pass_ratios(_passes(spark, sf))


@query(
    "worst_passers", "DP5 AG15 AG23",
    sql=f"""{EVENTS} SELECT competition, season, team, passSuccessRatio FROM pass_ratios
            QUALIFY row_number() OVER (PARTITION BY competition, season ORDER BY passSuccessRatio, team) = 1""",
)
def worst_passers(spark, sf):
    return fb.worst_passers(_passes(spark, sf))


@query(
    "best_teams", "DP6 JN2 WN2 SC14",
    sql=f"""{EVENTS}, placed AS (
              SELECT *, CAST(row_number() OVER (PARTITION BY competition, season
                ORDER BY CAST(points AS DOUBLE) / games DESC, {LEAGUE_ORDER}) AS INTEGER) AS Pos FROM season_table)
            SELECT team AS Team, competition AS League, season, Pos, {TABLE_COLUMNS_SQL},
                   CAST(round(CAST(CAST(points AS DOUBLE) / games AS DECIMAL(30, 8)), 2) AS DOUBLE) AS Avg,
                   passSuccessRatio AS PassRatio
            FROM placed LEFT JOIN pass_ratios USING (competition, season, team) WHERE Pos <= 2""",
)
def best_teams(spark, sf):
    return fb.best_teams(b.match_events(spark, sf))


@query(
    "season_tables_with_passes", "JN2 DP2 DP4",
    sql=f"{EVENTS} SELECT * FROM season_table JOIN pass_ratios USING (competition, season, team)",
)
def season_tables_with_passes(spark, sf):
    return fb.season_table_with_passes(b.match_events(spark, sf))


@query(
    "match_checks", "AG26",
    sql=f"""{EVENTS} SELECT count(*) AS matches, count(*) FILTER (WHERE homeTeamGoals + awayTeamGoals = 0) AS goalless,
            max(homeTeamGoals + awayTeamGoals) AS most_goals,
            CAST(sum(homeTeamGoals + awayTeamGoals) AS BIGINT) AS all_goals FROM match_results""",
)
def match_checks(spark, sf):
    return fb.match_checks(fb.match_results(b.match_events(spark, sf)))


@query(
    "season_checks", "AG27",
    sql=f"""{EVENTS} SELECT count(*) AS team_seasons, count(*) FILTER (WHERE points > 40) AS above,
            min(points) AS lowest_points, CAST(sum(points) AS BIGINT) AS all_points,
            CAST(sum(goalsScored) AS BIGINT) AS goals_scored, CAST(sum(goalsConceded) AS BIGINT) AS goals_conceded
            FROM season_table""",
)
def season_checks(spark, sf):
    return fb.season_checks(_seasons(spark, sf), 40)


@query(
    "pass_checks", "AG28",
    sql=f"""{EVENTS} SELECT count(*) AS team_matches, count(*) FILTER (WHERE totalPasses > 3) AS many_passes,
            count(*) FILTER (WHERE successfulPasses > 2) AS many_successful FROM match_passes""",
)
def pass_checks(spark, sf):
    return fb.pass_checks(_passes(spark, sf), 3, 2)


# --- players -----------------------------------------------------------------

PLAYERS = f"{EVENTS}, {b.STINTS_SQL}"


@query("match_lengths", "NP1 SC20", sql=f"{PLAYERS} SELECT * FROM lengths")
def match_lengths(spark, sf):
    return pl.match_lengths(b.match_events(spark, sf))


@query(
    "player_stints", "NP2 SRC14",
    sql=f"""{PLAYERS} SELECT matchId, competition, season, team, CAST(sign AS INTEGER) AS sign, playerId,
            CAST(enter AS INTEGER) AS enter, CAST(exit AS INTEGER) AS exit FROM stints""",
)
def player_stints(spark, sf):
    return pl.stints(b.matches(spark, sf))


@query("minutes_played", "NP3", sql=f"{PLAYERS} SELECT * FROM minutes_played")
def minutes_played(spark, sf):
    return pl.minutes_played(b.matches(spark, sf), b.match_events(spark, sf))


@query(
    "longest_per_role", "NP3 NP5 WN3 JN5",
    sql=f"""{PLAYERS} SELECT season, role, player, birthArea, minutes
            FROM minutes_played JOIN players USING (playerId)
            QUALIFY row_number() OVER (PARTITION BY season, role ORDER BY minutes DESC, playerId) = 1""",
)
def longest_per_role(spark, sf):
    minutes = pl.minutes_played(b.matches(spark, sf), b.match_events(spark, sf))
    return pl.longest_per_role(minutes, b.players(spark, sf))


@query(
    "goals_while_on_field", "JN4",
    sql=f"""{PLAYERS} SELECT matchId, competition, season, team, CAST(sign AS INTEGER) AS sign, playerId,
            CAST(enter AS INTEGER) AS enter, CAST(exit AS INTEGER) AS exit, balance FROM balances""",
)
def goals_while_on_field(spark, sf):
    goals = pl.goal_points(b.match_events(spark, sf))
    return pl.stint_goal_balance(b.matches(spark, sf), goals)


@query(
    "plus_minus", "NP4 JN4",
    sql=f"""{PLAYERS} SELECT playerId, season, CAST(sum(balance) AS BIGINT) AS plusMinus
            FROM balances GROUP BY playerId, season""",
)
def plus_minus(spark, sf):
    goals = pl.goal_points(b.match_events(spark, sf))
    return pl.plus_minus(b.matches(spark, sf), goals)


@query(
    "players_above_plus_minus", "NP4 NP5 JN5",
    sql=f"""{PLAYERS}, totals AS (
              SELECT playerId, season, CAST(sum(balance) AS BIGINT) AS plusMinus FROM balances GROUP BY playerId, season)
            SELECT season, player, birthArea, role, plusMinus FROM totals JOIN players USING (playerId)
            WHERE plusMinus > 3""",
)
def players_above_plus_minus(spark, sf):
    goals = pl.goal_points(b.match_events(spark, sf))
    totals = pl.plus_minus(b.matches(spark, sf), goals)
    return pl.above_plus_minus(totals, b.players(spark, sf), 3)


@query(
    "player_names", "NP5",
    sql="SELECT c_custkey AS playerId, 'Player ' || split_part(c_name, '#', 2) AS player FROM customer",
)
def player_names(spark, sf):
    return b.players(spark, sf).select("playerId", pl.full_name().alias("player"))
