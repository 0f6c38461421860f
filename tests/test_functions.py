from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import numeric, pixels, temporal, words
from conftest import plan, rows


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    ("value", "root"),
    [(32, 2), (3125, 5), (1e10, 100), (1e-10, 0.01), (-243, -3), (-4, -(4**0.2)), (0, 0), (1e15, 1000), (1, 1), (1e-30, 1e-6)],
)
def test_fifth_root(spark, value, root):
    df = spark.createDataFrame([(float(value),)], "x double")
    assert one(df, numeric.fifth_root("x"))[0] == pytest.approx(root, rel=1e-12, abs=1e-300)


def test_fifth_root_of_null_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert one(df, numeric.fifth_root("x")) == [None]


def test_rounded_is_half_up_on_the_decimal_value(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.5,), (None,)], "x double")
    assert one(df, numeric.rounded("x", 2)) == [1.01, -1.01, 2.5, None]
    assert one(df, numeric.rounded("x", 0)) == [1.0, -1.0, 3.0, None]


def test_signed_text_marks_only_positive_numbers(spark):
    df = spark.createDataFrame([(3,), (0,), (-2,), (None,)], "x int")
    assert one(df, numeric.signed_text("x")) == ["+3", "0", "-2", None]


def test_temperature_and_floor(spark):
    df = spark.createDataFrame([(49.0,), (-13.0,), (None,)], "x double")
    assert one(df, numeric.fahrenheit_to_celsius("x"))[:2] == pytest.approx([9.444444444, -25.0])
    assert one(df, numeric.floored("x")) == [49.0, 0.0, None]


def test_exact_aggregates_skip_null_and_ignore_order(frame):
    values = [0.1] * 10 + [None, 0.2]
    df = frame([(v,) for v in values], "x double")
    total = df.agg(numeric.exact_sum("x"), numeric.exact_mean("x")).first()
    assert total[0] == pytest.approx(1.2, abs=1e-15) and total[1] == pytest.approx(0.1, abs=0.01)
    empty = df.filter("x > 5").agg(numeric.exact_sum("x"), numeric.exact_mean("x")).first()
    assert tuple(empty) == (None, None)


@pytest.mark.parametrize(
    ("values", "total"),
    [
        ([0.004] * 1000, 4.0),
        ([1e17] * 3, 3e17),
        ([-0.125, 0.125, -0.125], -0.125),
        ([1.1, 2.2, 3.3], 6.6),
        ([1e16, 0.5, 0.5, -1e16], 1.0),
        ([-0.75, -0.75, None], -1.5),
        ([2.0**70, 1.0], 2.0**70),
        ([float("inf"), 1.0], float("inf")),
    ],
)
def test_exact_sum_adds_first_and_rounds_nothing(frame, values, total):
    got = frame([(v,) for v in values], "x double").agg(numeric.exact_sum("x")).first()[0]
    assert got == pytest.approx(total, rel=1e-15)


def test_exact_sum_is_the_same_in_any_order(spark):
    random.seed(3)
    values = [random.uniform(-1e9, 1e9) for _ in range(3000)] + [random.uniform(-1, 1) for _ in range(3000)]
    sums = set()
    for parts in (1, 3, 7):
        random.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        sums.add(df.agg(numeric.exact_sum("x")).first()[0])
    assert len(sums) == 1 and sums.pop() == pytest.approx(math.fsum(values), abs=1e-9)


def fsum_of(spark, values, parts=4, limbs=numeric.USUAL_LIMBS):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(numeric.exact_sum("x", limbs)).first()[0]


@pytest.mark.parametrize(
    ("value", "times"), [(1e-19, 1000), (3e-10, 1000), (1e-12, 777), (1e12 / 3, 999), (2.0**63, 5), (1e25 / 7, 300), (-0.1, 1000)]
)
def test_exact_sum_of_equal_values_is_the_rounded_product(spark, value, times):
    assert fsum_of(spark, [value] * times) == math.fsum([value] * times)


@pytest.mark.parametrize("seed", range(6))
def test_exact_sum_is_correctly_rounded(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([-1, 1]) * rng.random() * 10 ** rng.uniform(-19, 27) for _ in range(400)]
    assert fsum_of(spark, values) == math.fsum(values)
    cancelled = values + [-v for v in values[::-1]] + [rng.random() * 1e-15 for _ in range(9)]
    assert fsum_of(spark, cancelled) == math.fsum(cancelled)


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0**-53, 2.0**-100],  # just above a tie
        [1.0, 2.0**-53, -(2.0**-100)],
        [1.0, 2.0**-53],
        [1.0 + 2.0**-52, 2.0**-53],
        [2.0**24, -(2.0**23), 2.0**-30],
        [-(2.0**94), 2.0**94 - 2.0**41, 2.0**-120],
        [2.0**94] * 1000,
        [0.0, -0.0],
    ],
)
def test_exact_sum_of_ties_and_carries(spark, values):
    assert fsum_of(spark, values, 1) == math.fsum(values)


def test_exact_sum_of_tiny_values_is_rounded_evenly_and_of_huge_ones_stays_a_sum(spark):
    assert fsum_of(spark, [1e-300] * 100 + [0.5]) == 0.5
    assert fsum_of(spark, [1e300, 1.0, 1e300]) == 2e300


def test_exact_sum_over_the_whole_range_of_doubles(spark):
    cases = [
        [1e300, 1.0, -1e300],
        [5e-324] * 7,
        [1e-300] * 100,
        [1.7e308, -1.7e308, 5e-324],
        [1e308, 1e-308, -1e308, 1e-320],
        [2.0**-1074, 2.0**1000, -(2.0**1000), 3.0],
    ]
    rows = [(i, v) for i, values in enumerate(cases) for v in values] + [(99, 1.7e308), (99, 1.7e308)]
    df = spark.createDataFrame(rows, "k int, x double").coalesce(2)
    got = {r.k: r.s for r in df.groupBy("k").agg(numeric.exact_sum("x", numeric.ALL_LIMBS).alias("s")).collect()}
    assert got == {i: math.fsum(values) for i, values in enumerate(cases)} | {99: float("inf")}


def test_exact_sum_of_a_column_object_is_that_of_its_text(spark):
    values = [random.Random(5).uniform(-1, 1) * 10.0**i for i in range(-18, 25)] + [None, 1e200]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for rows_in in (df.filter("x < 1e28"), df, df.filter("x IS NULL")):
        a, b = rows_in.agg(numeric.exact_sum("x / 3"), numeric.exact_sum(F.col("x") / 3)).first()
        assert a == b
    assert df.agg(numeric.exact_mean(F.col("x"))).first() == df.agg(numeric.exact_mean("x")).first()


def test_exact_sum_keeps_infinite_values(spark):
    assert fsum_of(spark, [float("-inf"), 1.0]) == float("-inf")


def test_exact_sum_of_groups_has_no_decimals_in_its_plan(spark):
    rows = [(i % 5, (i * 7919 % 1000) / 7 * (-1) ** i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, x double").repartition(7)
    sums = df.groupBy("k").agg(numeric.exact_sum("x").alias("s"))
    assert {r.k: r.s for r in sums.collect()} == {k: math.fsum(x for g, x in rows if g == k) for k in range(5)}
    assert "decimal" not in plan(sums).lower()


def test_exact_sum_keeps_not_a_number(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert math.isnan(df.agg(numeric.exact_sum("x")).first()[0])


def test_rounding_looks_at_the_whole_number(spark):
    df = spark.createDataFrame([(0.0049999999999,), (1e22,), (0.285,)], "x double")
    assert one(df, numeric.rounded("x", 2)) == [0.0, 1e22, 0.29]


def test_fifth_root_of_infinity_and_nan(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),)], "x double")
    got = one(df, numeric.fifth_root("x"))
    assert got[:2] == [float("inf"), float("-inf")] and math.isnan(got[2])


def test_cyclic_distance(spark):
    df = spark.createDataFrame([(1, 12), (1, 2), (5, 7), (12, 2), (6, 12)], "a int, b int")
    assert one(df, numeric.cyclic_distance("a", "b", 12)) == [1, 1, 2, 2, 6]


def test_hour_bucket_follows_the_session_time_zone(spark):
    df = spark.createDataFrame([(1716152400906,)], "t long")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Helsinki")
        text = F.date_format(temporal.hour_of_millis("t"), "yyyy-MM-dd HH:mm:ss")
        assert one(df, text) == ["2024-05-20 00:00:00"]
        seconds = df.select((F.col("t") / 1000).cast("long").alias("s"))
        assert rows(seconds.select(temporal.month_of_seconds("s"), temporal.hour_number_of_seconds("s"))) == [(5, 0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_whole_minutes_round_up(spark):
    df = spark.createDataFrame([(2845.0,), (2880.0,), (0.0,), (None,)], "s double")
    assert one(df, temporal.whole_minutes("s")) == [48, 48, 0, None]


def test_parsed_year_of_bad_text_is_null(spark):
    df = spark.createDataFrame([("2015-03-01",), ("soon",), (None,)], "d string")
    assert one(df, temporal.parsed_year("d")) == [2015, None, None]


def words_by_python(text, rule):
    if rule == "no_digits":
        return [w for w in text.split() if not any(c in "0123456789" for c in w)]
    if rule == "letters":
        return [w for w in text.replace(".", "").split() if w.isalpha()]
    cleaned = text.translate({ord(c): None for c in words.DROPPED_MARKS}).lower()
    return [w for w in cleaned.split() if w.isalpha() and w.isascii()]


@pytest.mark.parametrize("rule", sorted(words.WORD_RULES))
def test_word_rules_against_plain_python(spark, rule):
    texts = ["The cat. The CAT's (cat), v2 3 words", "  Ärger über Öl.  ", "", "a\tb  c\n d'e", "x.y z! 12", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    candidates, valid = words.word_rule("value", rule)
    got = df.select(F.explode(candidates).alias("w")).filter(valid(F.col("w"))).collect()
    want = [w for t in texts if t is not None for w in words_by_python(t, rule)]
    assert sorted(r.w for r in got) == sorted(want)


def color_by_python(pixel: str) -> str:
    blue, green, red, alpha = bytes.fromhex(pixel)
    if alpha < 128:
        return "None"
    step = [0 if v < 85 else 1 if v < 170 else 2 for v in (red, green, blue)]
    return pixels.COLOR_NAMES[step[0] * 9 + step[1] * 3 + step[2]]


def test_color_names_of_pixels(spark):
    random.seed(5)
    edges = [0, 84, 85, 127, 128, 169, 170, 255]
    made = [bytes(random.choice(edges) for _ in range(4)).hex().upper() for _ in range(400)]
    df = spark.createDataFrame([(p,) for p in made], "p string")
    assert one(df, pixels.color_name("p")) == [color_by_python(p) for p in made]


def test_known_and_malformed_pixels(spark):
    known = [("000000ff", "Black"), ("FFFFFFFF", "White"), ("0000FFFF", "Red"), ("FF0000FF", "Blue"), ("00FF00FF", "Green"), ("00FFFFFF", "Yellow"), ("808080FF", "Gray")]
    bad = [("FFFFFF7F", "None"), ("FFFFFF", "None"), ("GG0000FF", "None"), ("", "None"), (None, "None")]
    df = spark.createDataFrame(known + bad, "p string, want string")
    assert [r for r in df.select(pixels.color_name("p").alias("got"), "want").collect() if r.got != r.want] == []


def test_bytes_and_text_give_the_same_color(spark):
    random.seed(6)
    data = bytes(random.randrange(256) for _ in range(4 * 300))
    df = spark.createDataFrame([(data,)], "data binary").select("data", F.explode(F.sequence(F.lit(0), F.lit(299))).alias("i"))
    both = df.select(
        pixels.color_of_number(pixels.color_number("data", F.col("i"))).alias("a"),
        pixels.color_name(pixels.pixel_hex("data", F.col("i"), 4)).alias("b"),
    )
    assert both.filter("a <> b").count() == 0 and both.filter("a is null").count() == 0


def test_histogram_of_bytes_equals_the_names_of_single_pixels(spark, monkeypatch):
    from tallyspark.plans import images

    monkeypatch.setattr(pixels, "PIXELS_AT_ONCE", 7)
    rng = random.Random(11)
    levels = [0, 84, 85, 127, 128, 169, 170, 255]
    made = [bytes(rng.choice(levels) for _ in range(rng.randrange(400))) for _ in range(40)]
    for data in made:
        want = [color_by_python(data[i : i + 4].hex().upper()) for i in range(0, len(data) // 4 * 4, 4)]
        counts = pixels.color_histogram(data)
        assert {c: want.count(c) for c in pixels.PIXEL_COLORS} == dict(zip(pixels.PIXEL_COLORS, counts.tolist(), strict=True))
    rows_in = [(f"i{n % 30}", 24, 4, data) for n, data in enumerate(made)]
    rows_in += [("grey", 0, 1, b"abc"), ("rgb", 16, 3, b"abcdefgh"), ("no", 24, 4, None), ("odd", 24, None, b"x"), ("zero", 24, 0, b"x"), (None, 24, 4, b"\x00\x00\xff\xff" * 3)]
    df = spark.createDataFrame(rows_in, "image string, mode int, nChannels int, data binary").repartition(3)
    got = images.color_counts(df, ["image"])
    want = {}
    for name, mode, channels, data in rows_in:
        for i in range(len(data or b"") // channels if channels else 0):
            color = color_by_python(data[4 * i : 4 * i + 4].hex().upper()) if mode == 24 else "None"
            want[name, color] = want.get((name, color), 0) + 1
    assert {(r.image, r.color): r.n for r in got.collect()} == want
    assert "Generate" not in plan(got)
    facts = {r.image: tuple(r)[1:] for r in images.pixel_statistics(df.filter("image IN ('grey', 'rgb', 'odd') OR image IS NULL"), ["image"]).collect()}
    assert facts["grey"] == (3, 3, 0x63, 2, 0x61) and facts["rgb"] == (2, 2, 0x646566, 1, 0x616263)
    assert facts["odd"] == (0, 0, None, None, None) and facts[None] == (3, 1, 0xFFFF, 2, 0xFFFF)
