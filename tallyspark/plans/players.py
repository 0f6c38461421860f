"""Time on the field and plus-minus of players, from nested match records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.temporal import whole_minutes
from tallyspark.operators.joins import lookup, points_per_group, sum_inside
from tallyspark.operators.ranking import top_n
from tallyspark.plans.football import is_goal

# Halves, length of the first one, and number of substitutions.
FIRST_HALF, SECOND_HALF = "1H", "2H"
FIRST_HALF_MINUTES = 45
SUBSTITUTIONS = ("substitution1", "substitution2", "substitution3")

# The clock puts every moment of the second half after every moment of the
# first one, however long the first half ran over.
SECOND_HALF_CLOCK = 1_000_000


def clock_of_minute(minute: Column) -> Column:
    """Clock of the start of a match minute; minutes up to 45 are first half."""
    second_half = F.lit(SECOND_HALF_CLOCK) + (minute - FIRST_HALF_MINUTES) * 60
    return F.when(minute <= FIRST_HALF_MINUTES, minute * 60).otherwise(second_half).cast("int")


def clock_of_event() -> Column:
    """Clock of an event, in whole seconds of its half."""
    offset = F.when(F.col("eventPeriod") == SECOND_HALF, SECOND_HALF_CLOCK).otherwise(0)
    return (offset + F.floor("eventTime")).cast("int")


def match_lengths(events: DataFrame) -> DataFrame:
    """Minutes per match: 45, plus the last second-half event rounded up."""
    last = F.max(F.when(F.col("eventPeriod") == SECOND_HALF, F.col("eventTime")))
    second = F.coalesce(whole_minutes(last), F.lit(0))
    return events.groupBy("matchId").agg((F.lit(FIRST_HALF_MINUTES) + second).cast("int").alias("minutes"))


def stints(matches: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per player on the field: match, team, side, enter and exit minute.

    Starters enter at 0, substitutes at their minute; ``exit`` is NULL for a
    player who stayed to the end. Players left on the bench get no row. All of
    it happens inside the match row; nothing is shuffled. ``keep`` names more
    columns of the match to carry along.
    """
    sides = F.array(
        F.struct(F.lit(1).alias("sign"), F.col("homeTeamData").alias("data")),
        F.struct(F.lit(-1).alias("sign"), F.col("awayTeamData").alias("data")),
    )
    team = matches.select("matchId", "competition", "season", *keep, F.inline(sides))
    changes = [F.col(f"data.{s}") for s in SUBSTITUTIONS]
    starters = F.coalesce("data.lineup", F.array().cast("array<int>"))
    on_field = F.concat(starters, F.array(*[c["playerIn"] for c in changes]))
    unfolded = team.select("*", F.size(starters).alias("starters"), F.posexplode(on_field).alias("place", "playerId"))

    # Places after the starters belong to the substitutes, in order.
    nth = F.col("place") - F.col("starters")
    enter = F.when(nth < 0, 0)
    for number, change in enumerate(changes):
        enter = enter.when(nth == number, change["minute"])
    leaves = F.least(*[F.when(c["playerOut"] == F.col("playerId"), c["minute"]) for c in changes])
    return unfolded.select(
        "matchId",
        "competition",
        "season",
        *keep,
        F.col("data.team").alias("team"),
        "sign",
        "playerId",
        enter.alias("enter"),
        leaves.alias("exit"),
    ).filter(F.col("playerId").isNotNull() & F.col("enter").isNotNull())


def minutes_played(matches: DataFrame, events: DataFrame) -> DataFrame:
    """Total minutes per player and season.

    Match rows and their lengths are joined one to one before the players are
    unfolded, so the shuffle moves matches and not player rows. A match without
    any event lasts as long as one without a second half.
    """
    timed = matches.join(match_lengths(events), "matchId", "left").fillna(FIRST_HALF_MINUTES, ["minutes"])
    played = F.coalesce("exit", "minutes") - F.col("enter")
    return (
        stints(timed, keep=("minutes",))
        .groupBy("playerId", "season")
        .agg(F.sum(F.greatest(played, F.lit(0))).cast("bigint").alias("minutes"))
    )


def goal_points(events: DataFrame) -> DataFrame:
    """Goals as (matchId, clock, value): +1 for the home team, -1 for the away team."""
    value = F.when(F.col("eventTeam") == F.col("awayTeam"), 1).when(
        F.col("eventTeam") == F.col("homeTeam"), -1
    )
    return events.filter(is_goal()).select(
        "matchId", clock_of_event().alias("clock"), value.cast("bigint").alias("value")
    )


def stint_goal_balance(matches: DataFrame, goals: DataFrame) -> DataFrame:
    """Goals for minus goals against while each player was on the field.

    Interval join on the match: enter <= goal < exit. A match gets its running
    score as one short array (at most one entry per second) in a one-to-one join; each
    stint takes the difference of two scores, found by binary search, within the row.
    """
    gathered = points_per_group(goals, ["matchId"], "clock", "value")
    start = clock_of_minute(F.col("enter"))
    end = F.coalesce(clock_of_minute(F.col("exit")), F.lit(2 * SECOND_HALF_CLOCK))
    balance = F.col("sign") * sum_inside(F.col("points"), start, end)
    matched = matches.join(gathered, "matchId", "left")
    return stints(matched, keep=("points",)).withColumn("balance", balance).drop("points")


def plus_minus(matches: DataFrame, goals: DataFrame) -> DataFrame:
    """Total plus-minus per player and season."""
    return (
        stint_goal_balance(matches, goals)
        .groupBy("playerId", "season")
        .agg(F.sum("balance").cast("bigint").alias("plusMinus"))
    )


def full_name() -> Column:
    return F.concat_ws(" ", "firstName", "lastName")


def with_player(totals: DataFrame, players: DataFrame) -> DataFrame:
    """Add name, birth area and role; totals hold one row per player by now."""
    named = players.withColumn("player", full_name())
    return lookup(totals, named, ["playerId"], ["player", "birthArea", "role"])


def longest_per_role(minutes: DataFrame, players: DataFrame, season: str | None = None) -> DataFrame:
    """The player with the most minutes for each role (of a season)."""
    picked = minutes if season is None else minutes.filter(F.col("season") == season)
    order = [F.desc("minutes"), F.asc("playerId")]
    best = top_n(with_player(picked, players), ["season", "role"], order, 1)
    return best.select("season", "role", "player", "birthArea", "minutes")


def above_plus_minus(
    totals: DataFrame, players: DataFrame, above: int = 65, season: str | None = None
) -> DataFrame:
    """Players whose season total is higher than ``above``."""
    picked = totals if season is None else totals.filter(F.col("season") == season)
    named = with_player(picked.filter(F.col("plusMinus") > above), players)
    return named.select("season", "player", "birthArea", "role", "plusMinus")
