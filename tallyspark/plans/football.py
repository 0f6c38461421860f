"""Match results, season tables and passing figures from an event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.numeric import exact_mean, rounded, signed_text
from tallyspark.operators.ranking import top_n

# Event names and tags of the event log.
SAVE_ATTEMPT = "Save attempt"
PASS = "Pass"
GOAL_TAG = "Goal"
MISSED_TAG = "Not accurate"
ACCURATE_TAG = "Accurate"

MATCH_KEYS = ["matchId", "competition", "season", "homeTeam", "awayTeam"]
EVENT_COLUMNS = [*MATCH_KEYS, "eventId", "event", "eventTeam", "tags"]
TEAM_SEASON = ["competition", "season", "team"]


def is_goal():
    """The keeper's side of a goal: a save attempt tagged as goal and missed."""
    return (
        (F.col("event") == SAVE_ATTEMPT)
        & F.array_contains("tags", GOAL_TAG)
        & F.array_contains("tags", MISSED_TAG)
    )


def goals_against(side: str):
    """Goals that the named team's keeper let in, i.e. goals of the other team."""
    return F.count_if(is_goal() & (F.col("eventTeam") == F.col(side))).cast("int")


def match_results(events: DataFrame) -> DataFrame:
    """One row per match with the goals of both teams.

    One conditional aggregation over all events of a match: matches without a
    goal keep a row with zeros, and no distinct, second scan or join is needed.
    """
    return events.groupBy(*MATCH_KEYS).agg(
        goals_against("awayTeam").alias("homeTeamGoals"),
        goals_against("homeTeam").alias("awayTeamGoals"),
    )


def team_results(matches: DataFrame, more: dict[str, str] | None = None) -> DataFrame:
    """Two rows per match, one from each team's point of view.

    ``more`` maps further columns to carry to the endings of their
    ``home...``/``away...`` columns.
    """

    def view(side: str, other: str):
        return F.struct(
            F.col(f"{side}Team").alias("team"),
            F.col(f"{side}TeamGoals").alias("goalsScored"),
            F.col(f"{other}TeamGoals").alias("goalsConceded"),
            *[F.col(f"{side}{ending}").alias(name) for name, ending in (more or {}).items()],
        )

    views = F.array(view("home", "away"), view("away", "home"))
    return matches.select("matchId", "competition", "season", F.inline(views))


def _season_measures():
    scored, conceded = F.col("goalsScored"), F.col("goalsConceded")
    wins, draws, losses = (F.count_if(c) for c in (scored > conceded, scored == conceded, scored < conceded))
    measures = {
        "games": F.count(F.lit(1)),
        "wins": wins,
        "draws": draws,
        "losses": losses,
        "goalsScored": F.sum(scored),
        "goalsConceded": F.sum(conceded),
        "points": wins * 3 + draws,
    }
    return [value.cast("int").alias(name) for name, value in measures.items()]


def season_table(matches: DataFrame) -> DataFrame:
    """Games, wins, draws, losses, goals and 3-1-0 points per team and season."""
    return team_results(matches).groupBy(*TEAM_SEASON).agg(*_season_measures())


def _goal_difference():
    return F.col("goalsScored") - F.col("goalsConceded")


def _table_columns():
    return [
        F.col("games").alias("Pld"),
        F.col("wins").alias("W"),
        F.col("draws").alias("D"),
        F.col("losses").alias("L"),
        F.col("goalsScored").alias("GF"),
        F.col("goalsConceded").alias("GA"),
        signed_text(_goal_difference()).alias("GD"),
        F.col("points").alias("Pts"),
    ]


def league_tables(seasons: DataFrame) -> DataFrame:
    """League table of every league and season.

    Classified by points, goal difference, goals scored, then team name. A
    window sees one row per team of a league: matches are added up before.
    """
    order = [F.desc("points"), F.desc(_goal_difference()), F.desc("goalsScored"), F.asc("team")]
    window = Window.partitionBy("competition", "season").orderBy(*order)
    ranked = seasons.withColumn("Pos", F.row_number().over(window))
    return ranked.select("competition", "season", "Pos", F.col("team").alias("Team"), *_table_columns())


def league_table(seasons: DataFrame, competition: str, season: str) -> DataFrame:
    """Table of one league and season; filter first, so little is ranked."""
    picked = seasons.filter((F.col("competition") == competition) & (F.col("season") == season))
    return league_tables(picked).drop("competition", "season")


def match_passes(events: DataFrame) -> DataFrame:
    """Passes and successful passes per team and match."""
    return (
        events.filter(F.col("event") == PASS)
        .groupBy("matchId", "competition", "season", F.col("eventTeam").alias("team"))
        .agg(
            F.count(F.lit(1)).cast("int").alias("totalPasses"),
            F.count_if(F.array_contains("tags", ACCURATE_TAG)).cast("int").alias("successfulPasses"),
        )
    )


def pass_ratios(passes: DataFrame) -> DataFrame:
    """Mean of the match ratios per team and season, in percent, two decimals."""
    ratio = "try_divide(CAST(successfulPasses AS DOUBLE), CAST(totalPasses AS DOUBLE))"
    return passes.groupBy(*TEAM_SEASON).agg(
        rounded(exact_mean(ratio) * 100, 2).alias("passSuccessRatio")
    )


def worst_passers(passes: DataFrame, season: str | None = None) -> DataFrame:
    """Team with the lowest pass ratio per league and season, lowest first."""
    picked = passes if season is None else passes.filter(F.col("season") == season)
    order = [F.asc("passSuccessRatio"), F.asc("team")]
    worst = top_n(pass_ratios(picked), ["competition", "season"], order, 1)
    return worst.orderBy("passSuccessRatio", "competition", "season", "team")


def match_summary(events: DataFrame) -> DataFrame:
    """Goals and passes of both teams per match, in one pass over the events."""

    def passes(side: str, *more):
        test = (F.col("event") == PASS) & (F.col("eventTeam") == F.col(side))
        for condition in more:
            test = test & condition
        return F.count_if(test).cast("int")

    accurate = F.array_contains("tags", ACCURATE_TAG)
    return events.groupBy(*MATCH_KEYS).agg(
        goals_against("awayTeam").alias("homeTeamGoals"),
        goals_against("homeTeam").alias("awayTeamGoals"),
        passes("homeTeam").alias("homePasses"),
        passes("awayTeam").alias("awayPasses"),
        passes("homeTeam", accurate).alias("homeSuccessful"),
        passes("awayTeam", accurate).alias("awaySuccessful"),
    )


def season_table_with_passes(events: DataFrame) -> DataFrame:
    """Season table and pass ratio from one pass over the events, without a join."""
    rows = team_results(match_summary(events), {"passes": "Passes", "successful": "Successful"})
    ratio = "try_divide(CAST(successful AS DOUBLE), CAST(passes AS DOUBLE))"
    return rows.groupBy(*TEAM_SEASON).agg(
        *_season_measures(), rounded(exact_mean(ratio) * 100, 2).alias("passSuccessRatio")
    )


def best_teams(events: DataFrame, n: int = 2, season: str | None = None) -> DataFrame:
    """Best ``n`` teams per league and season by mean points, best first.

    Season table and pass ratio come from the same match rows: the events are
    shuffled once, and nothing is joined.
    """
    picked = events if season is None else events.filter(F.col("season") == season)
    rows = team_results(match_summary(picked), {"passes": "Passes", "successful": "Successful"})
    ratio = "try_divide(CAST(successful AS DOUBLE), CAST(passes AS DOUBLE))"
    seasons = rows.groupBy(*TEAM_SEASON).agg(
        *_season_measures(), rounded(exact_mean(ratio) * 100, 2).alias("PassRatio")
    )
    average = F.col("points").cast("decimal(18,8)") / F.col("games").cast("decimal(10,0)")
    order = [
        F.desc(average),
        F.desc("points"),
        F.desc(_goal_difference()),
        F.desc("goalsScored"),
        F.asc("team"),
    ]
    best = top_n(seasons, ["competition", "season"], order, n, position="Pos")
    return best.select(
        F.col("team").alias("Team"),
        F.col("competition").alias("League"),
        "season",
        "Pos",
        *_table_columns(),
        F.round(average, 2).cast("double").alias("Avg"),
        "PassRatio",
    ).orderBy(F.desc("Avg"), "League", "season", "Pos")


def match_checks(matches: DataFrame) -> DataFrame:
    """Matches, goalless matches, most goals in a match, goals in all."""
    goals = F.col("homeTeamGoals") + F.col("awayTeamGoals")
    return matches.agg(
        F.count(F.lit(1)).alias("matches"),
        F.count_if(goals == 0).alias("goalless"),
        F.max(goals).alias("most_goals"),
        F.sum(goals).alias("all_goals"),
    )


def season_checks(seasons: DataFrame, points_above: int = 70) -> DataFrame:
    return seasons.agg(
        F.count(F.lit(1)).alias("team_seasons"),
        F.count_if(F.col("points") > points_above).alias("above"),
        F.min("points").alias("lowest_points"),
        F.sum("points").alias("all_points"),
        F.sum("goalsScored").alias("goals_scored"),
        F.sum("goalsConceded").alias("goals_conceded"),
    )


def pass_checks(passes: DataFrame, total_above: int = 700, successful_above: int = 600) -> DataFrame:
    return passes.agg(
        F.count(F.lit(1)).alias("team_matches"),
        F.count_if(F.col("totalPasses") > total_above).alias("many_passes"),
        F.count_if(F.col("successfulPasses") > successful_above).alias("many_successful"),
    )
