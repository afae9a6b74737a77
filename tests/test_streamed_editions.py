"""Editions of a stream against those of a batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.operators import editorial
from newsloom.streaming import editions

START = dt.datetime(2025, 7, 1, tzinfo=dt.timezone.utc)
SCHEMA = "id long, published_at string, fetched_at timestamp"


def rows(hours, first_id=0):
    dates = ["2025-06-01 10:00:00", "Tue, 01 Jul", None, "2025-06-01", ""]
    return [(first_id + k, dates[k % 5], START + dt.timedelta(hours=h)) for k, h in enumerate(hours)]


def landed(spark, folder, n, some):
    spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(spark, folder, **options):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    query = editions.start_editions(stream, f"{folder}/out", f"{folder}/checkpoint", **options)
    query.awaitTermination()
    return query


def batch(spark, some, size):
    found = editorial.editions(spark.createDataFrame(some, SCHEMA), size)
    return sorted(map(tuple, found.select(F.unix_seconds("edition"), "rank", "id").collect()))


def streamed(spark, folder):
    return sorted(map(tuple, editions.current_editions(spark, f"{folder}/out").collect()))


@pytest.mark.parametrize("size", [1, 3, 50])
def test_equals_the_batch(spark, tmp_path, size):
    parts = [rows([1, 2, 3, 13, 5, 9, 11.5]), rows([12, 14, 11, 20, 26], 100), rows([25, 13, 40, 38, 24.5, 27], 200)]
    for n, some in enumerate(parts):
        landed(spark, tmp_path, n, some)
        run(spark, tmp_path, size=size, delay="3 days")
        assert streamed(spark, tmp_path) == batch(spark, sum(parts[:n + 1], []), size)
    assert editions.late_articles(spark, f"{tmp_path}/out").count() == 0


def test_late_rows_are_written_and_change_nothing(spark, tmp_path):
    first, later = rows([1, 2, 30]), rows([3, 31, 50], 100)
    landed(spark, tmp_path, 0, first)
    run(spark, tmp_path)
    landed(spark, tmp_path, 1, rows([50], 50))
    run(spark, tmp_path)
    before = streamed(spark, tmp_path)
    landed(spark, tmp_path, 2, later)
    run(spark, tmp_path)
    late = {r["id"] for r in editions.late_articles(spark, f"{tmp_path}/out").collect()}
    assert late == {100, 101}
    assert streamed(spark, tmp_path) == batch(spark, first + rows([50], 50) + later[2:], editions.SIZE)
    assert [r for r in streamed(spark, tmp_path) if r[0] < 1751371200 + 43200] == [r for r in before if r[0] < 1751371200 + 43200]


def test_nothing_new_adds_no_batch(spark, tmp_path):
    landed(spark, tmp_path, 0, [*rows([1, 1, 2]), *rows([1]), (9, None, None)])
    run(spark, tmp_path)
    once = editions._written(spark, f"{tmp_path}/out").count()
    run(spark, tmp_path)
    assert editions._written(spark, f"{tmp_path}/out").count() == once == 3


def test_order_is_that_of_the_text():
    found = editions.ranked([(1, "b", 5), (2, "ba", 1), (3, None, 9), (4, "b", 7), (5, "é", 0), (6, "", 3), (7, "b", 7)], 9)
    assert [r[0] for r in found] == [5, 2, 4, 7, 1, 6, 3]
