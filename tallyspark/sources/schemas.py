"""Declared schemas; a declared schema saves the pass that inference costs."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
DATE, TS = T.DateType(), T.TimestampType()

# Column names and types of the known inputs.
WEATHER = _schema(
    ("country", S), ("date", DATE), ("temperature_avg", D), ("temperature_min", D),
    ("temperature_max", D), ("precipitation", D), ("snow_depth", D),
)
POWER_SERIES = _schema(
    ("Time", L), ("SolarPower", D), ("WaterCooling01Power", D), ("WaterCooling02Power", D),
    ("VentilationPower", D), ("Temperature", D), ("WindSpeed", D), ("Humidity", D),
    ("ElectricityPrice", D),
)
POINTS = _schema(("X", D), ("label", D))
SALES = _schema(
    ("orderId", S), ("orderDate", S), ("customerId", S), ("country", S), ("city", S),
    ("productId", S), ("category", S), ("subCategory", S), ("productPrice", D),
    ("productCount", I), ("shipDate", S), ("shipMode", S),
)
ACCIDENTS = _schema(
    ("ID", S), ("Start_Time", TS), ("End_Time", TS), ("Description", S), ("City", S),
    ("County", S), ("State", S), ("Temperature_F", D),
)
GAME_SALES = _schema(
    ("name", S), ("platform", S), ("release_date", S), ("publisher", S), ("na_sales", D),
    ("total_sales", D),
)
ENERGY_MINUTES = _schema(
    ("time", L), ("temperature", D), ("humidity", D), ("wind_speed", D), ("power_tenants", D),
    ("power_maintenance", D), ("power_solar_panels", D), ("electricity_price", D),
)

_POSITION = _schema(("x", D), ("y", D))
MATCH_EVENTS = _schema(
    ("competition", S), ("season", S), ("matchId", I), ("eventId", I), ("homeTeam", S),
    ("awayTeam", S), ("event", S), ("subEvent", S), ("eventTeam", S), ("eventPlayerId", I),
    ("eventPeriod", S), ("eventTime", D), ("tags", T.ArrayType(S)), ("startPosition", _POSITION),
    ("enPosition", _POSITION),
)

_SUBSTITUTION = _schema(("playerIn", I), ("playerOut", I), ("minute", I))
TEAM_DATA = _schema(
    ("team", S), ("coachId", I), ("lineup", T.ArrayType(I)), ("bench", T.ArrayType(I)),
    ("substitution1", _SUBSTITUTION), ("substitution2", _SUBSTITUTION),
    ("substitution3", _SUBSTITUTION),
)
MATCHES = _schema(
    ("matchId", I), ("competition", S), ("season", S), ("roundId", I), ("gameWeek", I),
    ("date", DATE), ("status", S), ("homeTeamData", TEAM_DATA), ("awayTeamData", TEAM_DATA),
)
PLAYERS = _schema(
    ("playerId", I), ("firstName", S), ("lastName", S), ("birthArea", S), ("role", S),
    ("foot", S),
)
