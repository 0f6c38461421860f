from __future__ import annotations

import random

import pytest

from conftest import rows
from tallyspark.plans.sales import daily_totals
from tallyspark.session import fresh_dir
from tallyspark.sinks import writers
from tallyspark.sources import readers, schemas
from tallyspark.sources.readers import CsvOptions
from tallyspark.streaming import totals

NO_HEADER = CsvOptions(sep=";", header=False)


def made_sales(n, seed):
    random.seed(seed)
    return [
        (str(i), f"2014-0{random.randrange(1, 6)}-11", "c", "FI", "x", "p", "a", "b", random.randrange(1, 9999) / 100, random.randrange(1, 9), "d", "m")
        for i in range(n)
    ]


@pytest.fixture
def folder(spark):
    """Five header-less files, written one after the other."""
    path = fresh_dir(spark, "stream")
    for part in range(5):
        df = spark.createDataFrame(made_sales(40, part), schemas.SALES).coalesce(1)
        writers.append_csv(df, path, NO_HEADER)
    return path


def test_stream_equals_batch_over_several_batches(spark, folder):
    stream = readers.stream_csv(spark, folder, schemas.SALES, NO_HEADER, files_per_batch=1)
    path, state = fresh_dir(spark, "r"), fresh_dir(spark, "s")
    query = totals.finish(totals.start_to_files(totals.running_totals(stream), path, state, drain=True))
    assert query.lastProgress["batchId"] == 4
    final = spark.read.parquet(f"{path}/batch=4")
    batch = daily_totals(readers.read_csv(spark, folder, NO_HEADER, schema=schemas.SALES))
    assert rows(final) == rows(batch)
    assert rows(totals.agreement(batch, final, "orderDate")) == [(5, 0)]


def test_no_row_of_a_headerless_file_is_lost(spark, folder):
    batch = readers.read_csv(spark, folder, NO_HEADER, schema=schemas.SALES)
    assert batch.count() == 200
    drained = totals.drain_to_table(spark, totals.running_totals(readers.stream_csv(spark, folder, schemas.SALES)))
    assert sum(r.totalCount for r in drained.collect()) == sum(r.productCount for r in batch.collect())


def test_sorted_running_result(spark, folder):
    stream = readers.stream_csv(spark, folder, schemas.SALES)
    drained = totals.drain_to_table(spark, totals.running_totals(stream, best_first=True)).collect()
    prices = [r.totalPrice for r in drained]
    assert prices == sorted(prices, reverse=True) and len(prices) == 5


def test_named_result_grows_with_new_files(spark, folder):
    result = totals.running_totals(readers.stream_csv(spark, folder, schemas.SALES))
    name, state = "growing_totals", fresh_dir(spark, "s")
    query = totals.start_in_memory(result, name, state)
    try:
        query.processAllAvailable()
        before = sum(r.totalCount for r in readers.named_table(spark, name).collect())
        more = spark.createDataFrame(made_sales(10, 99), schemas.SALES)
        writers.append_csv(more, folder, NO_HEADER)
        query.processAllAvailable()
        after = sum(r.totalCount for r in readers.named_table(spark, name).collect())
        assert after == before + sum(s[9] for s in made_sales(10, 99))
    finally:
        query.stop()


def test_restart_goes_on_where_it_stopped(spark, folder):
    path, state = fresh_dir(spark, "r"), fresh_dir(spark, "s")

    def run():
        result = totals.running_totals(readers.stream_csv(spark, folder, schemas.SALES))
        return totals.finish(totals.start_to_files(result, path, state, drain=True))

    run()
    writers.append_csv(spark.createDataFrame(made_sales(10, 7), schemas.SALES), folder, NO_HEADER)
    last = run().lastProgress["batchId"]
    batch = daily_totals(readers.read_csv(spark, folder, NO_HEADER, schema=schemas.SALES))
    assert rows(spark.read.parquet(f"{path}/batch={last}")) == rows(batch)


def test_a_stream_without_files_has_no_rows(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    stream = readers.stream_csv(spark, str(tmp_path / "empty"), schemas.SALES, NO_HEADER)
    drained = totals.drain_to_files(spark, totals.running_totals(stream))
    assert drained.count() == 0 and drained.columns == ["orderDate", "totalPrice", "totalCount"]


def test_agreement_reports_differences(frame):
    schema = "orderDate string, totalPrice double, totalCount bigint"
    a = frame([("d1", 1.0, 1), ("d2", 2.0, 2), ("d3", 3.0, 3)], schema)
    b = frame([("d1", 1.0, 1), ("d2", 2.5, 2)], schema)
    assert rows(totals.agreement(a, b, "orderDate")) == [(1, 2)]
