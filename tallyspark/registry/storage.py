"""Sources and sinks: write a table, read it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import bindings as b
from tallyspark.functions.numeric import exact_sum, rounded
from tallyspark.functions.words import NOT_BLANK, not_blank
from tallyspark.plans import schema_change as change
from tallyspark.plans.images import image_key
from tallyspark.registry.core import TOTAL_DIGITS, query, total_sum
from tallyspark.session import fresh_dir
from tallyspark.sinks import storage, writers
from tallyspark.sinks.image_files import image_folders, write_images
from tallyspark.sources import readers
from tallyspark.sources.readers import CsvOptions, from_images
from tallyspark.tables import table

SEMICOLON, PIPE = CsvOptions(sep=";"), CsvOptions(sep="|")
BLOCK_TEXT = CsvOptions(sep="|", multi_line=True)
# Image files whose states the driver holds at a time, some 1 kB each.
FILES_AT_ONCE = 50_000


def _orders_as_text(spark, sf):
    """Orders with the date as text, so that every CSV type is a plain one."""
    return table(spark, sf, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


ORDERS_TEXT_SQL = """orders_text AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders)"""


@query(
    "literal_rows", "SRC1",
    sql="""SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'pending' END AS label,
                  count(*) AS n FROM orders GROUP BY 1""",
)
def literal_rows(spark, sf):
    names = spark.createDataFrame(
        [
            {"status": "F", "label": "finished"},
            {"status": "O", "label": "open"},
            {"status": "P", "label": "pending"},
        ]
    )
    per_status = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return per_status.join(names, F.col("o_orderstatus") == F.col("status")).select("label", "n")


@query(
    "literal_rows_with_schema", "SRC2 AG8",
    sql=f"""SELECT CAST(w.weight AS INTEGER) AS weight,
                  {total_sum("o_totalprice / 7")} AS total
           FROM orders JOIN (VALUES ('1', 5), ('2', 4), ('3', 3), ('4', 2), ('5', 1)) w(rank, weight)
             ON substr(o_orderpriority, 1, 1) = w.rank GROUP BY 1""",
)
def literal_rows_with_schema(spark, sf):
    schema = T.StructType([T.StructField("rank", T.StringType()), T.StructField("weight", T.IntegerType())])
    weights = spark.createDataFrame([("1", 5), ("2", 4), ("3", 3), ("4", 2), ("5", 1)], schema)
    totals = (
        table(spark, sf, "orders")
        .groupBy(F.substring("o_orderpriority", 1, 1).alias("rank"))
        .agg(exact_sum("o_totalprice / 7").alias("t"))
    )
    joined = totals.join(weights, "rank").groupBy("weight").agg(rounded(exact_sum("t"), TOTAL_DIGITS).alias("total"))
    return joined


@query(
    "csv_header_strings", "SRC3 SNK1",
    sql=f"""WITH {ORDERS_TEXT_SQL} SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
            CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
            o_orderdate, o_orderpriority FROM orders_text""",
)
def csv_header_strings(spark, sf):
    path = writers.write_csv(_orders_as_text(spark, sf), fresh_dir(spark, "csv"))
    return readers.read_csv(spark, path)


@query(
    "csv_semicolon_inferred", "SRC4",
    sql=f"""WITH {ORDERS_TEXT_SQL} SELECT o_orderstatus, CAST(sum(o_custkey) AS BIGINT) AS key_sum,
            max(o_totalprice) AS highest, CAST(max(o_orderdate) AS VARCHAR) AS last_date
            FROM orders_text GROUP BY o_orderstatus""",
)
def csv_semicolon_inferred(spark, sf):
    path = writers.write_csv(_orders_as_text(spark, sf), fresh_dir(spark, "csv"), SEMICOLON)
    read = readers.read_csv(spark, path, SEMICOLON, infer=True)
    return read.groupBy("o_orderstatus").agg(
        F.sum("o_custkey").cast("bigint").alias("key_sum"),
        F.max("o_totalprice").alias("highest"),
        F.max("o_orderdate").cast("string").alias("last_date"),
    )


@query(
    "csv_pipe_directory", "SRC5 SNK3",
    sql=f"""WITH {ORDERS_TEXT_SQL}, both_parts AS (
              SELECT * FROM orders_text
              UNION ALL SELECT * REPLACE (-1 - o_orderkey AS o_orderkey) FROM orders_text)
            SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
            CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderdate, o_orderpriority FROM both_parts""",
)
def csv_pipe_directory(spark, sf):
    orders = _orders_as_text(spark, sf)
    path = writers.write_csv(orders, fresh_dir(spark, "csv"), PIPE)
    negated = orders.withColumn("o_orderkey", F.lit(-1) - F.col("o_orderkey"))
    writers.append_csv(negated, path, PIPE)
    return readers.read_csv(spark, path, PIPE)


@query(
    "csv_declared_multiline", "SRC6",
    sql="SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS digest, lang FROM documents",
)
def csv_declared_multiline(spark, sf):
    schema = "doc_id bigint, text string, lang string"
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    path = writers.write_csv(docs, fresh_dir(spark, "csv"), BLOCK_TEXT)
    read = readers.read_csv(spark, path, BLOCK_TEXT, schema=schema)
    digest = F.md5(F.col("text").cast("binary")).alias("digest")
    return read.select("doc_id", F.length("text").alias("n_chars"), digest, "lang")


@query("parquet_scan", "SRC7 AG1", sql="SELECT count(*) AS n, count(DISTINCT l_returnflag) AS flags FROM lineitem")
def parquet_scan(spark, sf):
    lines = readers.read_parquet(spark, f"{sf}/lineitem.parquet")
    per_flag = lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("k"))
    return per_flag.agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("flags"))


@query(
    "parquet_selected_columns", "SRC8 PRJ1",
    sql="SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
)
def parquet_selected_columns(spark, sf):
    return readers.read_parquet(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderstatus", "o_totalprice"])


@query(
    "text_lines", "SRC9 FLT11",
    sql=f"""WITH {b.LINES_SQL} SELECT count(*) AS n_lines, count(DISTINCT value) AS distinct_lines,
            CAST(sum(length(value)) AS BIGINT) AS n_chars FROM lines WHERE regexp_matches(value, '{NOT_BLANK}')""",
)
def text_lines(spark, sf):
    path = writers.write_lines(table(spark, sf, "documents"), fresh_dir(spark, "text"), "text")
    lines = readers.read_lines(spark, path).filter(not_blank("value"))
    per_line = lines.groupBy("value").agg(F.count(F.lit(1)).alias("k"))
    return per_line.agg(
        F.sum("k").alias("n_lines"),
        F.count(F.lit(1)).alias("distinct_lines"),
        F.sum(F.col("k") * F.length("value")).alias("n_chars"),
    )


@query(
    "snapshot_scan", "SRC10 SNK2",
    sql=f"WITH {b.ACCIDENTS_SQL} SELECT * FROM accidents",
)
def snapshot_scan(spark, sf):
    path = writers.write_parquet(b.accidents(spark, sf), fresh_dir(spark, "snapshot"))
    return _accident_text(readers.read_parquet(spark, path))


def _accident_text(df):
    """Timestamps as text, for comparisons between engines."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("Start_Time", "End_Time")})


@query(
    "image_fields", "SRC11",
    sql=f"""WITH {b.IMAGES_SQL} SELECT image, CAST(length(hex) / 8 AS INTEGER) AS n_pixels, md5(hex) AS digest
            FROM images""",
)
def image_fields(spark, sf):
    """Documents become image files; Spark's image reader reads these."""
    folder = write_images(b.images(spark, sf), fresh_dir(spark, "images"))

    def fields(scanned):
        return image_key(scanned).select(
            "image",
            (F.col("height") * F.col("width")).alias("n_pixels"),
            F.md5(F.hex("data").cast("binary")).alias("digest"),
        )

    return from_images(spark, image_folders(folder, FILES_AT_ONCE), fields, fresh_dir(spark, "fields"))


@query(
    "json_lines", "SRC12",
    sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def json_lines(spark, sf):
    customer = table(spark, sf, "customer")
    path = writers.write_json_lines(customer, fresh_dir(spark, "json"))
    return readers.read_json_lines(spark, path).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@query(
    "nested_parquet", "SRC14",
    sql=f"""WITH {b.MATCH_SQL}, {b.SUBSTITUTIONS_SQL}
            SELECT m.matchId, m.homeTeam, m.first_player + m.home + {b.TEAMS} * (m.matchId % {b.SQUAD}) AS first_starter,
                   CAST(s.minute AS INTEGER) AS first_change
            FROM match_list m LEFT JOIN subs s
              ON s.matchId = m.matchId AND s.sign = 1 AND s.minute < 55""",
)
def nested_parquet(spark, sf):
    path = writers.write_parquet(b.matches(spark, sf), fresh_dir(spark, "nested"))
    return readers.read_parquet(spark, path).select(
        "matchId",
        F.col("homeTeamData.team").alias("homeTeam"),
        F.get("homeTeamData.lineup", 0).alias("first_starter"),
        F.col("homeTeamData.substitution1.minute").alias("first_change"),
    )


@query(
    "sql_over_name", "SRC15",
    sql="SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def sql_over_name(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("tallyspark_customer")
    table(spark, sf, "nation").createOrReplaceTempView("tallyspark_nation")
    return spark.sql(
        """SELECT n_name, count(*) AS customers
           FROM tallyspark_customer JOIN tallyspark_nation ON c_nationkey = n_nationkey GROUP BY n_name"""
    )


@query(
    "append_parquet", "SNK4 KT1",
    sql="""SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer
           UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal FROM supplier""",
)
def append_parquet(spark, sf):
    first = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    more = table(spark, sf, "supplier").select(
        (F.lit(-1) - F.col("s_suppkey")).alias("key"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    path = writers.write_parquet(first, fresh_dir(spark, "append"))
    return readers.read_parquet(spark, writers.append_parquet(more, path))


@query("overwrite_target", "SNK5", sql="SELECT s_suppkey, s_name FROM supplier")
def overwrite_target(spark, sf):
    path = writers.write_parquet(table(spark, sf, "customer"), fresh_dir(spark, "overwrite"))
    writers.write_parquet(table(spark, sf, "supplier").select("s_suppkey", "s_name"), path, mode="overwrite")
    return readers.read_parquet(spark, path)


CHANGED_SQL = f"""{b.ACCIDENTS_SQL},
latest AS (SELECT * FROM accidents WHERE City = 'F' ORDER BY Start_Time DESC, ID DESC LIMIT 73),
same_rows AS (SELECT * REPLACE (ID || '_Z1' AS ID) FROM latest),
changed_rows AS (
  SELECT ID || '_Z2' AS ID, Start_Time, End_Time, City, County, State,
         (Temperature_F - 32) * 5 / 9 AS Temperature_C, 'prefix-' || City AS AddedColumn1,
         'New column' AS AddedColumn2 FROM latest),
store AS (
  SELECT * FROM accidents UNION ALL BY NAME SELECT * FROM same_rows
  UNION ALL BY NAME SELECT * FROM changed_rows)"""


def _changed_store(spark, sf) -> str:
    base = b.accidents(spark, sf)
    path = writers.write_parquet(base, fresh_dir(spark, "store"))
    # The latest rows are picked once; both appends read them from a table.
    picked = writers.write_parquet(change.latest_rows(readers.read_parquet(spark, path), "F", 73), fresh_dir(spark, "latest"))
    same = change.same_schema_rows(readers.read_parquet(spark, picked))
    writers.append_parquet(same, path)
    return writers.append_parquet(change.changed_schema_rows(same), path)


@query("append_merged_schema", "SNK6 DP10 KT2", sql=f"WITH {CHANGED_SQL} SELECT * FROM store")
def append_merged_schema(spark, sf):
    return _accident_text(readers.read_parquet(spark, _changed_store(spark, sf), merge=True))


@query(
    "csv_store_after_changed_append", "DP10 SNK3 SRC6",
    sql=f"""WITH {CHANGED_SQL}
            SELECT ID, Start_Time, End_Time,
                   CASE WHEN Temperature_C IS NULL THEN Description ELSE City END AS Description,
                   CASE WHEN Temperature_C IS NULL THEN City ELSE County END AS City,
                   CASE WHEN Temperature_C IS NULL THEN County ELSE State END AS County,
                   CASE WHEN Temperature_C IS NULL THEN State ELSE CAST(Temperature_C AS VARCHAR) END AS State,
                   CASE WHEN Temperature_C IS NULL THEN CAST(Temperature_F AS VARCHAR) ELSE AddedColumn1 END AS Temperature_F
            FROM store""",
)
def csv_store_after_changed_append(spark, sf):
    """A CSV store matches columns by position, so the changed rows are shifted."""
    base = _accident_text(b.accidents(spark, sf))
    path = writers.write_csv(base, fresh_dir(spark, "store"), PIPE)
    same = change.same_schema_rows(change.latest_rows(base, "F", 73))
    writers.append_csv(same, path, PIPE)
    writers.append_csv(change.changed_schema_rows(same), path, PIPE)
    names = ["ID", "Start_Time", "End_Time", "Description", "City", "County", "State", "Temperature_F"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return readers.read_csv(spark, path, PIPE, schema=schema)


@query(
    "rows_per_file", "SNK9",
    sql="SELECT count(*) AS n_rows, true AS one_row_per_file, true AS have_bytes FROM lineitem",
)
def rows_per_file(spark, sf):
    """Files of the table, however many it has: their rows add up to those of the table."""
    per_file = storage.rows_per_file(table(spark, sf, "lineitem"))
    return per_file.agg(
        F.sum("n_rows").alias("n_rows"),
        (F.count(F.lit(1)) == F.count_distinct("file_path")).alias("one_row_per_file"),
        (F.min("file_bytes") > 0).alias("have_bytes"),
    )


@query(
    "storage_profile", "SNK9",
    sql="SELECT true AS has_files, true AS same_bytes, true AS same_megabytes",
)
def storage_profile(spark, sf):
    """The profile of a written table against the list of its files."""
    path = writers.write_parquet(table(spark, sf, "lineitem"), fresh_dir(spark, "profile"))
    listed = storage.storage_files(spark, path).agg(F.sum("bytes").alias("listed"), F.count(F.lit(1)).alias("n"))
    profile = storage.storage_profile(spark, path)
    # One row each, joined on what must be equal: their number of files.
    return profile.join(listed, F.col("files") == F.col("n")).select(
        (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") == F.col("listed")).alias("same_bytes"),
        (F.abs(F.col("megabytes") - F.col("listed") / 1048576) <= 0.005).alias("same_megabytes"),
    )


@query(
    "round_trip_check", "SNK10",
    sql="""SELECT count(*) AS rows_before, count(*) AS rows_after, true AS same_rows, true AS same_types
           FROM lineitem""",
)
def round_trip_check(spark, sf):
    lines = table(spark, sf, "lineitem")
    path = writers.write_parquet(lines, fresh_dir(spark, "trip"))
    return storage.round_trip_check(lines, readers.read_parquet(spark, path))
