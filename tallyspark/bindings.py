"""Views of the shared tables in the shapes that the analyses expect.

Everything is computed row by row or by one equi join; arrays have fixed
lengths. So each view grows with its tables and has no hot spot of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import fresh_dir
from tallyspark.sinks.writers import write_json_lines
from tallyspark.sources.readers import read_json_lines
from tallyspark.tables import table

LEAGUE_SIZE = 150  # players (customers) per league
TEAMS = 10  # teams per league
SQUAD = LEAGUE_SIZE // TEAMS
STARTERS = 11
AWAY_SHIFT = 7


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as daily weather: flag as country, ship date as day."""
    mean = F.col("l_quantity") - 20
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("country"),
        F.col("l_shipdate").cast("date").alias("date"),
        mean.alias("temperature_avg"),
        (mean - F.round(F.col("l_discount") * 100)).alias("temperature_min"),
        (mean + F.round(F.col("l_tax") * 100)).alias("temperature_max"),
        F.col("l_linenumber").cast("double").alias("precipitation"),
        (F.col("l_extendedprice") / 100).alias("snow_depth"),
    )


WEATHER_SQL = """weather AS (
  SELECT l_returnflag AS country, CAST(l_shipdate AS DATE) AS date,
         l_quantity - 20 AS temperature_avg,
         l_quantity - 20 - round(l_discount * 100) AS temperature_min,
         l_quantity - 20 + round(l_tax * 100) AS temperature_max,
         CAST(l_linenumber AS DOUBLE) AS precipitation,
         l_extendedprice / 100 AS snow_depth,
         CAST(year(l_shipdate) AS INTEGER) AS year
  FROM lineitem)"""


def power_series(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a sparse series: one measurement column per event type, with many decimals.

    Views of every second event are the third consumer.
    """

    def only(kind: str) -> Column:
        return F.when(F.col("event_type") == kind, F.col("value") / 7)

    return table(spark, sf, "events").select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("Time"),
        only("click").alias("SolarPower"),
        F.when(F.col("event_id") % 2 == 0, only("view")).alias("WaterCooling01Power"),
        F.when(F.col("event_id") % 2 == 1, only("view")).alias("VentilationPower"),
        only("purchase").alias("WaterCooling02Power"),
        only("signup").alias("Temperature"),
        only("error").alias("ElectricityPrice"),
    )


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return as_sales(table(spark, sf, "events"))


def as_sales(events: DataFrame) -> DataFrame:
    """Events (batch or stream) as sales: price and a count from the properties."""
    return events.select(
        F.col("event_id").cast("string").alias("orderId"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("orderDate"),
        (F.col("value") / 7).alias("productPrice"),
        F.get_json_object("props", "$.k").cast("int").alias("productCount"),
    )


SALES_SQL = """sales AS (
  SELECT CAST(event_id AS VARCHAR) AS orderId, strftime(ts, '%Y-%m-%d') AS orderDate,
         value / 7 AS productPrice, CAST(json_extract_string(props, '$.k') AS INTEGER) AS productCount
  FROM events)"""


def game_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as titles, the customer's nation as publisher; status P lacks regional sales."""
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    world = F.col("o_totalprice") / 7000
    regional = F.when(F.col("o_orderstatus") != "P", world)
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.col("n_name").alias("publisher"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
            F.col("o_orderdate").alias("released"),
            F.year("o_orderdate").alias("year"),
            regional.alias("na_sales"),
            world.alias("total_sales"),
        )
    )


GAME_SALES_SQL = """game_sales AS (
  SELECT n_name AS publisher, CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 7000 END AS na_sales, o_totalprice / 7000 AS total_sales
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def accidents(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as incidents: status as city, customer number as temperature."""
    start = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("A-"), F.col("o_orderkey").cast("string")).alias("ID"),
        start.alias("Start_Time"),
        F.timestamp_add("HOUR", F.lit(2), start).alias("End_Time"),
        F.concat(F.lit("Priority "), "o_orderpriority").alias("Description"),
        F.col("o_orderstatus").alias("City"),
        F.col("o_orderpriority").alias("County"),
        F.substring("o_orderpriority", 1, 1).alias("State"),
        (F.col("o_custkey") % 130 - 20).cast("double").alias("Temperature_F"),
    )


ACCIDENTS_SQL = """accidents AS (
  SELECT 'A-' || o_orderkey AS ID, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS Start_Time,
         strftime(o_orderdate + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS End_Time,
         'Priority ' || o_orderpriority AS Description, o_orderstatus AS City,
         o_orderpriority AS County, substr(o_orderpriority, 1, 1) AS State,
         CAST(o_custkey % 130 - 20 AS DOUBLE) AS Temperature_F
  FROM orders)"""


def _match_columns() -> list[Column]:
    """Orders as matches: customers form leagues of ten teams."""
    league = F.expr(f"o_custkey div {LEAGUE_SIZE}")
    home = F.col("o_custkey") % TEAMS
    away = (home + 1 + F.col("o_orderkey") % (TEAMS - 1)) % TEAMS
    year = F.year("o_orderdate")

    def team(number: Column) -> Column:
        return F.concat(F.lit("Team "), league.cast("string"), F.lit("-"), number.cast("string"))

    return [
        F.col("o_orderkey").alias("matchId"),
        F.concat(F.lit("League "), league.cast("string")).alias("competition"),
        F.concat(year.cast("string"), F.lit("-"), (year + 1).cast("string")).alias("season"),
        team(home).alias("homeTeam"),
        team(away).alias("awayTeam"),
        (league * LEAGUE_SIZE).alias("first_player"),
        home.alias("home"),
        away.alias("away"),
    ]


MATCH_SQL = f"""match_list AS (
  SELECT o_orderkey AS matchId, 'League ' || (o_custkey // {LEAGUE_SIZE}) AS competition,
         year(o_orderdate) || '-' || (year(o_orderdate) + 1) AS season,
         'Team ' || (o_custkey // {LEAGUE_SIZE}) || '-' || (o_custkey % {TEAMS}) AS homeTeam,
         'Team ' || (o_custkey // {LEAGUE_SIZE}) || '-'
           || ((o_custkey % {TEAMS} + 1 + o_orderkey % {TEAMS - 1}) % {TEAMS}) AS awayTeam,
         (o_custkey // {LEAGUE_SIZE}) * {LEAGUE_SIZE} AS first_player,
         o_custkey % {TEAMS} AS home,
         (o_custkey % {TEAMS} + 1 + o_orderkey % {TEAMS - 1}) % {TEAMS} AS away
  FROM orders)"""


def match_events(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as events of their order's match."""
    matches = table(spark, sf, "orders").select(*_match_columns())
    lines = table(spark, sf, "lineitem")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    shot = (flag == "A") & (status == "O") & (F.col("l_tax") > 0.05)
    event = F.when(flag == "R", "Save attempt").when(shot, "Shot").otherwise("Pass")
    accurate = F.when(F.col("l_discount") >= 0.05, "Accurate").otherwise("Not accurate")
    tags = (
        F.when((flag == "R") & (status == "F"), F.array(F.lit("Goal"), F.lit("Not accurate")))
        .when(shot, F.array(F.lit("Goal"), F.lit("Accurate")))
        .otherwise(F.array(accurate))
    )
    return lines.join(matches, lines.l_orderkey == matches.matchId).select(
        "matchId",
        "competition",
        "season",
        "homeTeam",
        "awayTeam",
        F.col("l_linenumber").alias("eventId"),
        event.alias("event"),
        F.when(F.col("l_suppkey") % 2 == 0, F.col("homeTeam")).otherwise(F.col("awayTeam")).alias("eventTeam"),
        F.when(F.col("l_linenumber") % 2 == 1, "1H").otherwise("2H").alias("eventPeriod"),
        (F.col("l_quantity") * 57.5).alias("eventTime"),
        tags.alias("tags"),
    )


MATCH_EVENTS_SQL = f"""{MATCH_SQL},
match_events AS (
  SELECT matchId, competition, season, homeTeam, awayTeam, l_linenumber AS eventId,
         CASE WHEN l_returnflag = 'R' THEN 'Save attempt'
              WHEN l_returnflag = 'A' AND l_linestatus = 'O' AND l_tax > 0.05 THEN 'Shot'
              ELSE 'Pass' END AS event,
         CASE WHEN l_suppkey % 2 = 0 THEN homeTeam ELSE awayTeam END AS eventTeam,
         CASE WHEN l_linenumber % 2 = 1 THEN '1H' ELSE '2H' END AS eventPeriod,
         l_quantity * 57.5 AS eventTime,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN ['Goal', 'Not accurate']
              WHEN l_returnflag = 'A' AND l_linestatus = 'O' AND l_tax > 0.05 THEN ['Goal', 'Accurate']
              WHEN l_discount >= 0.05 THEN ['Accurate'] ELSE ['Not accurate'] END AS tags
  FROM lineitem JOIN match_list ON l_orderkey = matchId),
match_results AS (
  SELECT matchId, competition, season, homeTeam, awayTeam,
         CAST(count(*) FILTER (WHERE event = 'Save attempt' AND list_contains(tags, 'Goal')
              AND list_contains(tags, 'Not accurate') AND eventTeam = awayTeam) AS INTEGER) AS homeTeamGoals,
         CAST(count(*) FILTER (WHERE event = 'Save attempt' AND list_contains(tags, 'Goal')
              AND list_contains(tags, 'Not accurate') AND eventTeam = homeTeam) AS INTEGER) AS awayTeamGoals
  FROM match_events GROUP BY ALL),
team_results AS (
  SELECT matchId, competition, season, homeTeam AS team, homeTeamGoals AS goalsScored,
         awayTeamGoals AS goalsConceded FROM match_results
  UNION ALL
  SELECT matchId, competition, season, awayTeam, awayTeamGoals, homeTeamGoals FROM match_results),
season_table AS (
  SELECT competition, season, team, CAST(count(*) AS INTEGER) AS games,
         CAST(count(*) FILTER (WHERE goalsScored > goalsConceded) AS INTEGER) AS wins,
         CAST(count(*) FILTER (WHERE goalsScored = goalsConceded) AS INTEGER) AS draws,
         CAST(count(*) FILTER (WHERE goalsScored < goalsConceded) AS INTEGER) AS losses,
         CAST(sum(goalsScored) AS INTEGER) AS goalsScored,
         CAST(sum(goalsConceded) AS INTEGER) AS goalsConceded,
         CAST(sum(CASE WHEN goalsScored > goalsConceded THEN 3
                       WHEN goalsScored = goalsConceded THEN 1 ELSE 0 END) AS INTEGER) AS points
  FROM team_results GROUP BY competition, season, team),
match_passes AS (
  SELECT matchId, competition, season, eventTeam AS team, CAST(count(*) AS INTEGER) AS totalPasses,
         CAST(count(*) FILTER (WHERE list_contains(tags, 'Accurate')) AS INTEGER) AS successfulPasses
  FROM match_events WHERE event = 'Pass' GROUP BY matchId, competition, season, eventTeam),
pass_ratios AS (
  SELECT competition, season, team,
         CAST(round(CAST(CAST(sum(CAST(CAST(successfulPasses AS DOUBLE) / totalPasses AS DECIMAL(24, 12))) AS DOUBLE)
              / count(*) * 100 AS DECIMAL(30, 8)), 2) AS DOUBLE) AS passSuccessRatio
  FROM match_passes GROUP BY competition, season, team)"""


def matches(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as nested match records with lineups, benches and substitutions."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    flat = orders.select(*_match_columns(), F.col("o_orderdate").cast("date").alias("date"))

    def team_data(team: str, number: str, shift: int) -> Column:
        key = F.col("matchId") + shift

        def player(place: int) -> Column:
            return F.col("first_player") + F.col(number) + TEAMS * ((key + place) % SQUAD)

        def substitution(k: int) -> Column:
            out = player(k)
            if k == 2:  # sometimes the first substitute leaves again
                out = F.when((key % 5 == 0) & (key % 4 != 0), player(STARTERS)).otherwise(out)
            change = F.struct(
                player(STARTERS + k).alias("playerIn"),
                out.alias("playerOut"),
                (40 + 15 * k + key % 15).cast("int").alias("minute"),
            )
            return F.when((key + k) % 4 != 0, change)

        return F.struct(
            F.col(team).alias("team"),
            F.array(*[player(i) for i in range(STARTERS)]).alias("lineup"),
            F.array(*[player(i) for i in range(STARTERS, SQUAD)]).alias("bench"),
            *[substitution(k).alias(f"substitution{k + 1}") for k in range(3)],
        )

    return flat.select(
        "matchId",
        "competition",
        "season",
        "date",
        F.lit("Played").alias("status"),
        team_data("homeTeam", "home", 0).alias("homeTeamData"),
        team_data("awayTeam", "away", AWAY_SHIFT).alias("awayTeamData"),
    )


SUBSTITUTIONS_SQL = f"""sides AS (
  SELECT matchId, competition, season, homeTeam AS team, 1 AS sign, first_player + home AS base,
         matchId AS k0 FROM match_list
  UNION ALL
  SELECT matchId, competition, season, awayTeam, -1, first_player + away, matchId + {AWAY_SHIFT} FROM match_list),
subs AS (
  SELECT matchId, competition, season, team, sign,
         base + {TEAMS} * ((k0 + {STARTERS} + k) % {SQUAD}) AS playerIn,
         CASE WHEN k = 2 AND k0 % 5 = 0 AND k0 % 4 <> 0 THEN base + {TEAMS} * ((k0 + {STARTERS}) % {SQUAD})
              ELSE base + {TEAMS} * ((k0 + k) % {SQUAD}) END AS playerOut,
         40 + 15 * k + k0 % 15 AS minute
  FROM sides, range(3) r(k) WHERE (k0 + k) % 4 <> 0)"""

STINTS_SQL = f"""{SUBSTITUTIONS_SQL},
enters AS (
  SELECT matchId, competition, season, team, sign, base + {TEAMS} * ((k0 + i) % {SQUAD}) AS playerId, 0 AS enter
  FROM sides, range({STARTERS}) r(i)
  UNION ALL
  SELECT matchId, competition, season, team, sign, playerIn, minute FROM subs),
stints AS (
  SELECT e.matchId, e.competition, e.season, e.team, e.sign, e.playerId, e.enter, min(s.minute) AS exit
  FROM enters e LEFT JOIN subs s
    ON s.matchId = e.matchId AND s.sign = e.sign AND s.playerOut = e.playerId
  GROUP BY ALL),
lengths AS (
  SELECT matchId, CAST(45 + coalesce(ceil(max(eventTime) FILTER (WHERE eventPeriod = '2H') / 60), 0) AS INTEGER) AS minutes
  FROM match_events GROUP BY matchId),
minutes_played AS (
  SELECT playerId, season, CAST(sum(greatest(coalesce(exit, minutes, 45) - enter, 0)) AS BIGINT) AS minutes
  FROM stints LEFT JOIN lengths USING (matchId) GROUP BY playerId, season),
goals AS (
  SELECT matchId, CASE WHEN eventTeam = awayTeam THEN 1 ELSE -1 END AS value,
         CASE WHEN eventPeriod = '2H' THEN 2 ELSE 1 END AS half, eventTime
  FROM match_events
  WHERE event = 'Save attempt' AND list_contains(tags, 'Goal') AND list_contains(tags, 'Not accurate')),
balances AS (
  SELECT s.matchId, s.competition, s.season, s.team, s.sign, s.playerId, s.enter, s.exit,
         CAST(coalesce(sum(s.sign * g.value), 0) AS BIGINT) AS balance
  FROM stints s LEFT JOIN goals g ON g.matchId = s.matchId
    AND (g.half > CASE WHEN s.enter > 45 THEN 2 ELSE 1 END
         OR (g.half = CASE WHEN s.enter > 45 THEN 2 ELSE 1 END
             AND g.eventTime >= CASE WHEN s.enter > 45 THEN s.enter - 45 ELSE s.enter END * 60))
    AND (s.exit IS NULL OR g.half < CASE WHEN s.exit > 45 THEN 2 ELSE 1 END
         OR (g.half = CASE WHEN s.exit > 45 THEN 2 ELSE 1 END
             AND g.eventTime < CASE WHEN s.exit > 45 THEN s.exit - 45 ELSE s.exit END * 60))
  GROUP BY ALL),
players AS (
  SELECT c_custkey AS playerId, 'Player ' || split_part(c_name, '#', 2) AS player,
         n_name AS birthArea, c_mktsegment AS role
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def players(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as players: segment as role, nation as birth area."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("playerId"),
        F.lit("Player").alias("firstName"),
        F.split("c_name", "#")[1].alias("lastName"),
        F.col("n_name").alias("birthArea"),
        F.col("c_mktsegment").alias("role"),
    )


def images(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as images: four pixels from the digest of every word."""
    digests = F.transform(F.split("text", " "), lambda w: F.md5(w.cast("binary")))
    documents = table(spark, sf, "documents").select("doc_id", "source", "text")
    return documents.select(
        F.concat(F.lit("file:/images/"), "source", F.lit("/img%20"), F.col("doc_id").cast("string"), F.lit(".png")).alias("origin"),
        F.size(F.split("text", " ")).alias("height"),
        F.lit(4).alias("width"),
        F.lit(4).alias("nChannels"),
        F.lit(24).alias("mode"),
        F.unhex(F.array_join(digests, "")).alias("data"),
    )


def image_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Written and read as JSON lines; every label has metadata but no image as well."""
    of_images = table(spark, sf, "documents").select(
        F.concat(F.lit("img "), F.col("doc_id").cast("string")).alias("image"),
        annotation(F.col("n_chars"), F.col("source")).alias("annotation"),
        F.col("lang").alias("group"),
    )
    without = table(spark, sf, "labels").select(
        F.concat(F.lit("lost "), F.col("doc_id").cast("string")).alias("image"),
        F.lit("nowhere").alias("annotation"),
        F.lit("en").alias("group"),
    )
    path = write_json_lines(of_images.unionByName(without), fresh_dir(spark, "metadata"))
    return read_json_lines(spark, path, "image string, annotation string, `group` string")


def annotation(n_chars: Column, source: Column) -> Column:
    """A text that cannot be told from the name of an image."""
    return F.concat(source, F.lit(" of "), (n_chars % 89).cast("string"))


IMAGES_SQL = """images AS (
  SELECT 'img ' || doc_id AS image, source || ' of ' || n_chars % 89 AS annotation, lang AS "group",
         upper(array_to_string(list_transform(string_split(text, ' '), lambda w: md5(w)), '')) AS hex
  FROM documents),
pixels AS (
  SELECT image, annotation, "group", unnest(regexp_extract_all(hex, '.{8}')) AS pixel FROM images),
channels AS (
  SELECT image, annotation, "group", pixel, CAST('0x' || substr(pixel, 1, 2) AS INTEGER) AS b,
         CAST('0x' || substr(pixel, 3, 2) AS INTEGER) AS g, CAST('0x' || substr(pixel, 5, 2) AS INTEGER) AS r,
         CAST('0x' || substr(pixel, 7, 2) AS INTEGER) AS a FROM pixels),
named AS (
  -- fixed values: the color of each step of red, green and blue
  SELECT image, annotation, "group", pixel, CASE WHEN a < 128 THEN 'None' ELSE
    ['Black', 'Blue', 'Blue', 'Green', 'Green', 'Blue', 'Green', 'Green', 'Blue',
     'Red', 'Purple', 'Purple', 'Green', 'Gray', 'Purple', 'Green', 'Green', 'Blue',
     'Red', 'Pink', 'Purple', 'Orange', 'Orange', 'Pink', 'Yellow', 'Yellow', 'White'][
      9 * CASE WHEN r < 85 THEN 0 WHEN r < 170 THEN 1 ELSE 2 END
      + 3 * CASE WHEN g < 85 THEN 0 WHEN g < 170 THEN 1 ELSE 2 END
      + CASE WHEN b < 85 THEN 0 WHEN b < 170 THEN 1 ELSE 2 END + 1] END AS color
  FROM channels),
color_counts AS (
  SELECT image, annotation, "group", color, count(*) AS n FROM named GROUP BY ALL)"""


def energy_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as minutes with measurements, some of them missing."""
    hour = (F.col("l_linenumber") * 3 + F.col("l_quantity").cast("int")) % 24
    day = F.unix_timestamp(F.col("l_shipdate").cast("timestamp"))
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_key"),
        (day + hour * 3600).alias("time"),
        F.col("l_quantity").alias("temperature"),
        (F.col("l_discount") * 100).alias("humidity"),
        F.when(F.col("l_returnflag") != "A", F.col("l_tax") * 100).alias("wind_speed"),
        F.col("l_extendedprice").alias("power_tenants"),
        F.when(F.col("l_linestatus") != "F", F.col("l_partkey").cast("double")).alias("power_maintenance"),
        F.col("l_suppkey").cast("double").alias("power_solar_panels"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("electricity_price"),
    )


def line_points(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as points: price over quantity."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    return lines.select(
        F.col("l_quantity").alias("X"), F.col("l_extendedprice").alias("label"), F.col("l_orderkey").alias("key")
    )


def class_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Ship month as label, order month as prediction, with made probabilities."""
    from pyspark.ml.functions import array_to_vector

    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    predicted = F.month("o_orderdate")
    chances = [
        F.lit(0.0),
        *[F.when(predicted == m, F.lit(0.45)).otherwise(F.lit(0.05)) for m in range(1, 13)],
    ]
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.month("l_shipdate").cast("double").alias("label"),
        predicted.cast("double").alias("prediction"),
        array_to_vector(F.array(*chances)).alias("probability"),
    )


CLASS_SQL = """predictions AS (
  SELECT month(l_shipdate) AS label, month(o_orderdate) AS prediction,
         CASE WHEN month(l_shipdate) = month(o_orderdate) THEN 0.45 ELSE 0.05 END AS given
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts."""
    return table(spark, sf, "documents").select("text")


def lines_of_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document."""
    return documents(spark, sf).select(F.explode(F.split("text", "\n")).alias("value"))


LINES_SQL = "lines AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)"
