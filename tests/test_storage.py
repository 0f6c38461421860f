from __future__ import annotations

import random
import struct
import zlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SMALL, plan, rows
from tallyspark.operators.sampling import sample_by_suffix
from tallyspark.plans import images, schema_change
from tallyspark.session import fresh_dir, work_root
from tallyspark.sinks import storage, writers
from tallyspark.sinks.image_files import image_folders, write_images
from tallyspark.sources import readers, schemas
from tallyspark.sources.readers import CsvOptions

AWKWARD = [
    (1, "plain", 1.5),
    (2, 'with "quotes" and | pipes; and , commas', None),
    (3, "two\nlines", -2.25),
    (4, "  blanks  ", 0.0),
    (5, "back\\slash", 3.0),
    (6, None, 4.0),
    (7, "", 5.0),
]


@pytest.mark.parametrize("sep", [",", ";", "|"])
def test_csv_round_trip_keeps_awkward_text(frame, spark, sep):
    df = frame(AWKWARD, "k int, t string, v double")
    options = CsvOptions(sep=sep, multi_line=True)
    path = writers.write_csv(df, fresh_dir(spark, "csv"), options)
    assert rows(readers.read_csv(spark, path, options, schema=df.schema)) == rows(df)


def test_line_breaks_need_a_multi_line_store(frame, spark):
    with pytest.raises(PySparkException, match="line break in column t"):
        writers.write_csv(frame([(1, "two\nlines")], "k int, t string"), fresh_dir(spark, "csv"))


def test_rows_per_file_tells_files_of_one_name_apart(spark, tmp_path):
    for day in (1, 2):
        spark.range(5).coalesce(1).write.parquet(str(tmp_path / "raw" / str(day)))
        (tmp_path / "all" / f"d={day}").mkdir(parents=True)
        part = next((tmp_path / "raw" / str(day)).glob("part-*"))
        (tmp_path / "all" / f"d={day}" / "part-0.parquet").write_bytes(part.read_bytes())
    assert [r.n_rows for r in storage.rows_per_file(spark.read.parquet(str(tmp_path / "all"))).collect()] == [5, 5]


def test_file_stems_of_uris_are_decoded(spark):
    paths = ["file:/x/my%20flag.png", "file:///x/a%231.png", "/x/100%25.png", "file:/x/a+b.png", "file:/x/50%.png"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(readers.file_stem("p")).collect()] == ["my flag", "a#1", "100%25", "a+b", "50%"]


def test_csv_types(frame, spark):
    path = writers.write_csv(frame([(1, "a", 1.5)], "k int, t string, v double"), fresh_dir(spark, "csv"))
    assert [t for _, t in readers.read_csv(spark, path).dtypes] == ["string"] * 3
    assert [t for _, t in readers.read_csv(spark, path, infer=True).dtypes] == ["int", "string", "double"]


def test_json_and_text_round_trip(frame, spark):
    df = frame([(1, "a"), (2, "bä")], "k bigint, t string")
    assert rows(readers.read_json_lines(spark, writers.write_json_lines(df, fresh_dir(spark, "j")))) == rows(df)
    lines = frame([("one\n\n two ",), ("three",)], "value string")
    read = readers.read_lines(spark, writers.write_lines(lines, fresh_dir(spark, "t"), "value"))
    assert rows(read) == [("",), (" two ",), ("one",), ("three",)]


def test_parquet_scan_prunes_columns_and_pushes_filters(spark):
    df = readers.read_parquet(spark, f"{SMALL}/lineitem.parquet").filter("l_quantity > 45").select("l_orderkey")
    text = plan(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    assert "GreaterThan(l_quantity,45.0)" in text


ACCIDENTS = "ID string, Start_Time timestamp, End_Time timestamp, Description string, City string, County string, State string, Temperature_F double"


def accidents(spark):
    made = spark.range(200).select(
        F.concat(F.lit("A-"), F.col("id")).alias("ID"),
        F.timestamp_seconds(F.col("id") * 3600).alias("Start_Time"),
        F.timestamp_seconds(F.col("id") * 3600 + 60).alias("End_Time"),
        F.lit("text").alias("Description"),
        F.when(F.col("id") % 2 == 0, "Los Angeles").otherwise("Whitehall").alias("City"),
        F.lit("X").alias("County"),
        F.lit("CA").alias("State"),
        F.col("id").cast("double").alias("Temperature_F"),
    )
    assert made.schema.simpleString().replace("`", "") == spark.createDataFrame([], ACCIDENTS).schema.simpleString()
    return made


def test_schema_change_study(spark):
    base = accidents(spark)
    path = writers.write_parquet(base, fresh_dir(spark, "store"))
    same = schema_change.same_schema_rows(schema_change.latest_rows(base, "Los Angeles", 73))
    changed = schema_change.changed_schema_rows(same)
    writers.append_parquet(same, path)
    assert readers.read_parquet(spark, path).count() == 273
    writers.append_parquet(changed, path)
    merged = readers.read_parquet(spark, path, merge=True)
    assert merged.count() == 200 + 2 * 73 and len(merged.columns) == 8 + 3
    newest = rows(sample_by_suffix(merged, "ID", ["Z2"], 1).filter("sample_class = 'Z2'").select("ID", "Description", "Temperature_F", "AddedColumn1", "AddedColumn2"))
    assert newest == [("A-100_Z2", None, None, "prefix-Los Angeles", "New column")]
    assert merged.filter("ID = 'A-198_Z2'").first().Temperature_C == pytest.approx((198 - 32) * 5 / 9)


def test_positional_csv_store_is_corrupted_by_other_columns(spark):
    base = accidents(spark)
    options = CsvOptions(sep="|")
    path = writers.write_csv(base, fresh_dir(spark, "store"), options)
    same = schema_change.same_schema_rows(schema_change.latest_rows(base, "Los Angeles", 5))
    writers.append_csv(schema_change.changed_schema_rows(same), path, options)
    text_schema = ", ".join(f"{c} string" for c in base.columns)
    shifted = readers.read_csv(spark, path, options, schema=text_schema).filter("ID like '%_Z2'")
    assert {r.Description for r in shifted.collect()} == {"Los Angeles"}


def test_storage_profile_counts_files_and_bytes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.bin").write_bytes(b"x" * 1024 * 1024)
    (tmp_path / "sub" / "b.bin").write_bytes(b"y" * 512)
    assert rows(storage.storage_profile(spark, str(tmp_path))) == [(2, 1024 * 1024 + 512, 1.0)]
    assert sorted(r.bytes for r in storage.storage_files(spark, str(tmp_path)).collect()) == [512, 1024 * 1024]


def test_round_trip_check_sees_lost_rows_and_types(frame):
    df = frame([(1, "a"), (2, "b")], "k int, t string")
    assert rows(storage.round_trip_check(df, df)) == [(2, 2, True, True)]
    assert rows(storage.round_trip_check(df, df.limit(1).withColumn("k", F.col("k").cast("long")))) == [(2, 1, False, False)]


def png(width: int, height: int, rgba: list[tuple[int, int, int, int]]) -> bytes:
    raw = b"".join(
        b"\0" + b"".join(bytes(p) for p in rgba[y * width : (y + 1) * width]) for y in range(height)
    )

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


BLUE, YELLOW, BLACK, RED, CLEAR = (0, 0, 255, 255), (255, 255, 0, 255), (0, 0, 0, 255), (255, 0, 0, 255), (9, 9, 9, 0)


@pytest.fixture
def gallery(spark, tmp_path):
    pictures = {
        "1F1": [BLUE] * 3 + [YELLOW] * 2 + [BLACK],
        "1F2": [RED] * 4 + [CLEAR] * 2,
        "1F3": [CLEAR] * 5 + [BLUE],
        "1F4": [BLUE] * 2 + [YELLOW] * 2 + [BLACK] * 2,
    }
    (tmp_path / "more").mkdir()
    for i, (name, content) in enumerate(pictures.items()):
        folder = tmp_path / "more" if i % 2 else tmp_path
        (folder / f"{name}.png").write_bytes(png(3, 2, content))
    scanned = images.image_key(readers.read_images(spark, str(tmp_path)), name="hexcode")
    meta = spark.createDataFrame(
        [("1F1", "flag: one", "flags"), ("1F2", "red", "activities"), ("1F3", "dot", "activities"), ("1F4", "tie", "flags"), ("2AA", "other", "flags")],
        "hexcode string, annotation string, group string",
    )
    return scanned, meta


def test_image_scan(gallery):
    scanned, _ = gallery
    fields = scanned.select("hexcode", "height", "width", "nChannels", "mode", F.octet_length("data"))
    assert rows(fields) == [(n, 2, 3, 4, 24, 24) for n in ("1F1", "1F2", "1F3", "1F4")]


def test_a_broken_image_keeps_its_row_but_has_no_pixels(spark, tmp_path):
    (tmp_path / "good.png").write_bytes(png(1, 1, [RED]))
    (tmp_path / "bad.png").write_bytes(b"no image")
    scanned = images.image_key(readers.read_images(spark, str(tmp_path)))
    assert rows(scanned.select("image", "height")) == [("bad", -1), ("good", 1)]
    assert rows(images.color_counts(scanned, ["image"])) == [("good", "Red", 1)]


def test_image_questions(gallery):
    scanned, meta = gallery
    keys = ["hexcode", "annotation", "group"]
    counts = images.with_metadata(images.color_counts(scanned, ["hexcode"]), meta, "hexcode", keys[1:])
    assert [r.annotation for r in images.most_colored(counts, keys, 3).collect()] == ["flag: one", "tie", "red"]
    least = images.least_colored(counts, keys, 5).collect()
    assert [(r.annotation, r.ratio) for r in least] == [("dot", 0.2), ("red", 2.0), ("flag: one", None), ("tie", None)]
    flag = images.top_colors(counts.filter("annotation = 'flag: one'"), keys, 3)
    assert rows(flag.select("place", "color", "share")) == [(1, "Blue", 50.0), (2, "Yellow", 33.33), (3, "Black", 16.67)]
    assert rows(images.images_with_top_colors(counts, ["hexcode"], ["Blue", "Yellow", "Black"])) == [("1F1",)]
    assert rows(images.images_with_top_colors(counts, ["hexcode"], ["Black", "Blue", "Yellow"])) == [("1F4",)]
    red = images.most_of_color(counts.filter("group = 'activities'"), ["annotation"], "Red", 5)
    assert rows(red) == [("red", 4)]


def test_pixels_keep_position_and_odd_images_are_uncolored(spark):
    made = spark.createDataFrame(
        [("a", 24, 4, bytes.fromhex("FF0000FF0000FFFFAA")), ("b", 16, 3, bytes.fromhex("FF0000")), ("c", 24, 4, b""), ("d", 24, 0, b"xx")],
        "image string, mode int, nChannels int, data binary",
    )
    assert rows(images.pixels(made, ["image"]).select("image", "position", "pixel")) == [
        ("a", 0, "FF0000FF"), ("a", 1, "0000FFFF"), ("b", 0, "FF0000"),
    ]
    assert rows(images.color_counts(made, ["image"])) == [("a", "Blue", 1), ("a", "Red", 1), ("b", "None", 1)]


def test_counting_colors_needs_one_shuffle_and_no_row_per_pixel(gallery):
    scanned, _ = gallery
    text = plan(images.color_counts(scanned, ["hexcode"]))
    assert text.count("Exchange") == 1 and "Generate" not in text


IMAGE_ROWS = "origin string, height int, width int, nChannels int, mode int, data binary, note string"


def test_images_written_as_files_are_read_back_as_they_were(spark, tmp_path):
    rng = random.Random(2)
    made = [(f"file:/x/pic%20{i}.jpg", 1 + i % 5, 1 + i % 7, c) for i, c in enumerate([4, 3, 1] * 8)]
    made = [(o, h, w, c, 24, bytes(rng.randrange(256) for _ in range(h * w * c)), "x") for o, h, w, c in made]
    odd = [("a/none.png", 1, 1, 4, 24, None, "x"), (None, 0, 0, 4, 24, b"", "x"), ("a/same.png", 1, 1, 1, 0, b"a", ""), ("b/same.png", 1, 1, 1, 0, b"b", "")]
    path = write_images(spark.createDataFrame(made + odd, IMAGE_ROWS).repartition(3), str(tmp_path / "store"))
    back = images.image_key(readers.read_images(spark, path)).collect()
    assert len(back) == len(made) + len(odd)
    sizes = {r.image: (r.height, r.width, r.nChannels, bytes(r.data)) for r in back if r.image.startswith("pic")}
    assert sizes == {f"pic {i}": (h, w, c, d) for i, (_, h, w, c, _, d, _) in enumerate(made)}
    assert sorted(r.height for r in back if not r.image.startswith("pic")) == [-1, -1, 1, 1]
    assert {bytes(r.data) for r in back if r.image.startswith("same")} == {b"a", b"b"}
    assert int((tmp_path / "store" / "_SUCCESS").read_text()) == len(back)
    assert not list((tmp_path / "store").glob("_attempt*"))
    none = write_images(spark.createDataFrame([], IMAGE_ROWS), str(tmp_path / "none"))
    assert (tmp_path / "none" / "_SUCCESS").read_text() == "0" and none == str(tmp_path / "none")


def test_folders_of_images_make_portions_of_bounded_size(spark, tmp_path):
    made = spark.range(53).selectExpr("concat('p', id, '.png') AS origin", "1 AS height", "1 AS width", "1 AS nChannels", "0 AS mode", "unhex('07') AS data", "'' AS note")
    path = write_images(made.repartition(2), str(tmp_path / "store"), 4)
    folders = [f for portion in image_folders(path, 10) for f in portion]
    assert sorted(folders) == sorted(str(p) for p in (tmp_path / "store").glob("part*/*")) and len(folders) > 13
    portions = [readers.read_images(spark, portion) for portion in image_folders(path, 10)]
    assert max(len(p.inputFiles()) for p in portions) <= 10 and sum(p.count() for p in portions) == 53
    assert len(image_folders(path, 53)) == 1 and len(image_folders(path, 1)) == len(folders)
    back = readers.from_images(spark, image_folders(path, 10), lambda df: df.select("origin", "height"), str(tmp_path / "sizes"))
    assert rows(back) == rows(readers.read_images(spark, path).select("origin", "height"))
    assert readers.from_images(spark, [], lambda df: df.select("height"), str(tmp_path / "nothing")).collect() == []


def test_image_fields_does_not_list_all_files_at_once(spark, monkeypatch):
    from __spark_entry__ import queries
    from tallyspark.registry import storage as registered

    monkeypatch.setattr(registered, "write_images", lambda df, path: write_images(df.repartition(3), path, 10))
    monkeypatch.setattr(registered, "FILES_AT_ONCE", 30)
    seen, read = [], readers.read_images

    def listed(session, path):
        found = read(session, path)
        seen.append(len(found.inputFiles()))
        return found

    monkeypatch.setattr(readers, "read_images", listed)
    before = dict(spark.conf.getAll)
    got = queries()["image_fields"](spark, SMALL)
    assert got.count() == 200 == sum(seen) and max(seen) <= 30
    assert dict(spark.conf.getAll) == before  # settings for small files hold for the scans alone


def test_an_image_whose_bytes_do_not_fit_its_sizes_fails_and_leaves_nothing_to_read(spark, tmp_path):
    rows_in = [("a.png", 1, 1, 4, 24, b"abcd", ""), ("b.png", 2, 1, 4, 24, b"abcd", "")]
    with pytest.raises(Exception, match="4 bytes are no image of 2 x 1"):
        write_images(spark.createDataFrame(rows_in, IMAGE_ROWS).coalesce(1), str(tmp_path / "bad"))
    assert not list((tmp_path / "bad").glob("part*"))


def test_declared_schemas_match_their_data(spark, tmp_path):
    nested = spark.createDataFrame([], schemas.MATCHES)
    path = writers.write_parquet(nested, str(tmp_path / "m"))
    assert readers.read_parquet(spark, path).schema == schemas.MATCHES


def test_work_root_is_the_configured_folder(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
