from __future__ import annotations

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tallyspark.plans import energy, sales, weather, words
from tallyspark.sources import schemas

DAYS = [
    ("Finland", date(2016, 1, 1), -12.0, -29.63, -10.0, 0.0, 173.2),
    ("Finland", date(2016, 1, 2), -9.0, -10.0, 24.96, 0.0, 172.9),
    ("Finland", date(2015, 1, 3), -11.0, -22.04, 23.75, 0.0, 186.0),
    ("Sweden", date(2017, 7, 1), 6.0, -21.85, 21.55, 0.0, 101.0),
    ("Sweden", date(2015, 7, 1), 6.0, -16.1, 25.7, 0.0, 71.4),
    ("Norway", date(2018, 2, 1), 5.0, -13.25, 27.85, 0.0, 158.0),
    ("Norway", date(2015, 2, 1), 8.0, -11.1, 22.3, 0.0, None),
]


@pytest.fixture
def days(spark):
    return spark.createDataFrame(DAYS, schemas.WEATHER).repartition(3)


def test_weather_extremes(days):
    assert rows(weather.extremes(days)) == [(-29.63, 27.85)]
    assert rows(weather.extremes_by_year(days)) == [
        (2015, -22.04, 25.7), (2016, -29.63, 24.96), (2017, -21.85, 21.55), (2018, -13.25, 27.85),
    ]


def test_weather_summary_and_picked_values(days):
    summary = weather.summary_by_year_and_country(days)
    got = {(r.year, r.country): (r.entries, r.temperature_min, r.temperature_max, r.snow_depth_avg) for r in summary.collect()}
    assert got[2016, "Finland"] == (2, -29.6, 25.0, 173)
    assert got[2015, "Norway"] == (1, -11.1, 22.3, None)
    picked = weather.picked_values(summary, (2016, "Finland"), (2017, "Sweden"), (2018, "Norway"), 2015)
    # 27.9 + 13.3 after rounding half up; mean of 186 and 71 skips the unknown depth
    assert rows(picked) == [(-29.6, 21.6, 41.2, 129)]


def test_weather_counts_and_ranges(days):
    assert rows(weather.cold_days_by_year(days, "Finland", -10)) == [(2015, 1), (2016, 1)]
    assert rows(weather.warm_days_with_snow(days)) == [("Sweden", 1)]
    widest = [tuple(r) for r in weather.widest_days(days, "Finland", 2).collect()]
    assert widest == [(date(2015, 1, 3), 45.79), (date(2016, 1, 2), 34.96)]


def test_weather_of_no_days(spark):
    none = spark.createDataFrame([], schemas.WEATHER)
    assert rows(weather.extremes(none)) == [(None, None)]
    assert rows(weather.summary_by_year_and_country(none)) == []


HOUR = 3600 * 1000
T0 = 1716163200000  # 2024-05-20 00:00 UTC


def power(time, **values):
    names = schemas.POWER_SERIES.names[1:]
    return (time, *[values.get(n) for n in names])


@pytest.fixture
def series(spark):
    made = [
        power(T0, Temperature=10.0),
        power(T0 + 5, ElectricityPrice=50.0),
        power(T0 + 10, SolarPower=1000.0),
        power(T0 + 11, SolarPower=3000.0),
        power(T0 + 20, WaterCooling01Power=4000.0),
        power(T0 + 21, WaterCooling02Power=1000.0),
        power(T0 + 22, VentilationPower=5000.0),
        power(T0 + 23, Temperature=12.0),
        # second hour: more produced than consumed
        power(T0 + HOUR, ElectricityPrice=100.0, SolarPower=9000.0, Temperature=20.0),
        power(T0 + HOUR + 1, WaterCooling01Power=1000.0, WaterCooling02Power=1000.0, VentilationPower=1000.0),
        # third hour: one consumer has no value
        power(T0 + 2 * HOUR, WaterCooling01Power=1000.0, ElectricityPrice=1.0),
    ]
    return spark.createDataFrame(made, schemas.POWER_SERIES).repartition(4)


def test_hourly_balance_and_costs(series):
    hourly = energy.hourly_balance(series).orderBy("Time")
    got = [tuple(r)[1:] for r in hourly.collect()]
    assert got == [(11.0, 2.0, 10.0, 50.0), (20.0, 9.0, 3.0, 100.0), (None, None, None, 1.0)]
    costs = energy.hourly_cost(hourly)
    assert [r.HourlyCost for r in costs.orderBy("Time").collect()] == [0.4, -0.6, None]
    floored = energy.hourly_cost(hourly, floor_at_zero=True)
    assert [r.HourlyCost for r in floored.orderBy("Time").collect()] == [0.4, 0.0, None]
    daily = energy.daily_table(costs)
    assert rows(daily) == [(date(2024, 5, 20), 15.5, 11.0, 13.0, -0.2)]
    assert rows(energy.total_cost(daily)) == [(-0.2,)]


def test_hourly_balance_is_a_hash_aggregation(series):
    text = plan(energy.hourly_balance(series))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text and "Window" not in text


def test_price_is_the_first_known_one_of_the_hour(spark):
    made = [power(T0 + 9, ElectricityPrice=3.0), power(T0 + 2), power(T0 + 4, ElectricityPrice=7.0)]
    hourly = energy.hourly_balance(spark.createDataFrame(made, schemas.POWER_SERIES).repartition(3))
    assert hourly.first().Price == 7.0


TITLES = [
    ("Ann", 2006, 1.0, 2.0), ("Ann", 2006, None, 1.0), ("Ann", 2007, 0.105, 0.2), ("Ann", 1999, 90.0, 90.0),
    ("Bob", 2006, 1.0, 9.0), ("Bob", 2010, None, 9.0), ("Cat", 2015, None, 1.0),
]


def test_best_publisher(frame):
    df = frame(TITLES, "publisher string, year int, na_sales double, total_sales double")
    rollup = sales.publisher_years(df, 2006, 2015)
    assert rows(sales.missing_titles_of_best(rollup)) == [("Ann", 1.105, 1)]
    best = sales.best_publisher_years(rollup)
    assert rows(best.select("year", "na_total", "global_total", "missing_titles")) == [(2006, 1.0, 3.0, 1), (2007, 0.11, 0.2, 0)]


def test_best_publisher_reads_the_sales_once(spark, tmp_path):
    path = str(tmp_path / "titles")
    spark.createDataFrame(TITLES, "publisher string, year int, na_sales double, total_sales double").write.parquet(path)
    best = sales.best_publisher_years(sales.publisher_years(spark.read.parquet(path), 2006, 2015))
    assert plan(best).count("FileScan") == 1 and "TakeOrderedAndProject" in plan(best)


def test_best_publisher_of_none(spark):
    df = spark.createDataFrame([], "publisher string, year int, na_sales double, total_sales double")
    assert rows(sales.best_publisher_years(sales.publisher_years(df, 2006, 2015))) == []


def test_best_days(frame):
    df = frame([("d1", 10.0, 2), ("d1", 0.1, 3), ("d2", 30.0, 1), ("d3", 20.3, 1)], "orderDate string, productPrice double, productCount int")
    assert rows(sales.daily_totals(df)) == [("d1", 20.3, 5), ("d2", 30.0, 1), ("d3", 20.3, 1)]
    assert [tuple(r) for r in sales.best_days(df, 2).collect()] == [("d2", 30.0), ("d1", 20.3)]


def test_word_statistics(frame):
    text = ["Science is fun", "", "science. Science, 42 seventh", "   ", "seventh Seventh 7th"]
    lines = frame([(t,) for t in text], "value string")
    assert words.text_lines(lines).count() == 3
    counts = words.word_counts(words.words(lines))
    assert dict((r["word"], r["count"]) for r in counts.collect()) == {
        "Science": 1, "is": 1, "fun": 1, "science.": 1, "Science,": 1, "seventh": 2, "Seventh": 1,
    }
    assert rows(words.word_totals(counts)) == [(8, 7)]
    folded = words.word_counts(words.words(lines, rule="ascii"))
    assert rows(words.most_common(folded, 7, "s")) == [("science", 3)]
    assert rows(words.most_common(folded, 9, "q")) == []


def test_word_totals_of_nothing(spark):
    lines = spark.createDataFrame([], "value string")
    assert rows(words.word_totals(words.word_counts(words.words(lines)))) == [(0, 0)]


def test_a_word_that_is_a_third_of_all(spark):
    random.seed(1)
    made = [" ".join("hot" if i % 3 == 0 else f"w{chr(97 + random.randrange(26))}" for i in range(90)) for _ in range(200)]
    lines = spark.createDataFrame([(t,) for t in made], "value string").repartition(6)
    got = {r["word"]: r["count"] for r in words.word_counts(words.words(lines)).collect()}
    assert got == Counter(w for t in made for w in t.split())


def test_words_stay_inside_the_jvm(spark):
    lines = spark.createDataFrame([("a b",)], "value string")
    for rule in ("no_digits", "letters", "ascii"):
        assert "Python" not in plan(words.word_totals(words.word_counts(words.words(lines, rule=rule))))


def test_sum_of_cubes_and_polynomial(spark):
    df = spark.createDataFrame([(n,) for n in (2, 3, 5, 7, 11, 13, 17, 19)], "n int")
    x = F.col("n")
    assert tuple(df.agg(F.sum(x * x * x), F.max(1 + 9 * x - x * x)).first()) == (15803, 21)
